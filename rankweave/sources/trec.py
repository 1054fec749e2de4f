"""Readers and writers of the text formats around a ranking task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The constant second columns of run and judgment lines.
RUN_MARK = "Q0"
QREL_MARK = "0"


def _lines(spark: SparkSession, paths: str | list[str], separator: str, schema: str, plain: bool = False) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", separator)
    reader = reader.option("quote", "") if plain else reader.option("quote", '"').option("escape", '"')
    return reader.csv(paths)


def read_docs(spark: SparkSession, path: str, num_docs: int | None = None) -> DataFrame:
    """(docid, url, title, body) from tab-separated lines. Quotes are text.

    Trailing white space is cut first; a line that then has not exactly four fields is no document.
    """
    parts = F.split(F.regexp_replace("value", r"\s+$", ""), "\t")
    rows = spark.read.text(path).select(parts.alias("p")).filter(F.size("p") == 4)
    docs = rows.select(*[F.get("p", F.lit(i)).alias(name) for i, name in enumerate(("docid", "url", "title", "body"))])
    return docs.limit(num_docs) if num_docs is not None else docs


def placed(rows: DataFrame) -> DataFrame:
    """Rows read from files with `_place`: by file name and, inside a file, by line. Parts of a file are ordered by where they
    begin, lines of a part by their row numbers."""
    return rows.withColumn("_place", F.struct(F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id()))


def merge_queries(sources: list[DataFrame]) -> DataFrame:
    """One row per qid over several query tables; the text of the last table and row wins.

    The rows of a table are in the order of its files (see `placed`). Spark can't tell the file of a row after a join, so a
    table that is joined before it is merged is placed before the join and keeps its `_place`.
    """
    ordered = [source if "_place" in source.columns else placed(source) for source in sources]
    tagged = [source.select("qid", "text", F.struct(F.lit(i), "_place").alias("_order")) for i, source in enumerate(ordered)]
    rows = tagged[0]
    for source in tagged[1:]:
        rows = rows.unionByName(source)
    return rows.groupBy("qid").agg(F.max_by("text", "_order").alias("text"))


def read_queries(spark: SparkSession, paths: list[str], plain: bool = False) -> DataFrame:
    """(qid, text) from tab-separated files; `plain` takes quotes as text."""
    return merge_queries([_lines(spark, path, "\t", "qid string, text string", plain) for path in paths])


def read_qrels(spark: SparkSession, paths: str | list[str], min_rel: int | None = None,
               only_rel: int | None = None) -> DataFrame:
    """(qid, docid, rel); `min_rel` drops lower grades, `only_rel` fails on any other grade."""
    rows = _lines(spark, paths, " ", "qid string, mark string, docid string, rel int")
    if only_rel is not None:
        checked = F.when(F.col("rel") == only_rel, F.col("rel")).otherwise(
            F.raise_error(F.concat(F.lit("unexpected grade "), F.col("rel").cast("string"))).cast("int")
        )
        rows = rows.withColumn("rel", checked)
    if min_rel is not None:
        rows = rows.filter(F.col("rel") >= min_rel)
    return rows.select("qid", "docid", "rel")


def read_candidates(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(qid, docid, rank, score)."""
    schema = "qid string, mark string, docid string, rank int, score double, run_id string"
    return _lines(spark, paths, " ", schema).select("qid", "docid", "rank", "score")


def read_run(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(run_id, qid, docid, rank, score)."""
    schema = "qid string, mark string, docid string, rank int, score double, run_id string"
    return _lines(spark, paths, " ", schema).select("run_id", "qid", "docid", "rank", "score")


def read_metrics(spark: SparkSession, paths: str | list[str], run_id: str) -> DataFrame:
    """(run_id, qid, metric, value) from padded measure lines; lines whose value is no number are left out."""
    rows = _lines(spark, paths, "\t", "metric string, qid string, value string", plain=True)
    value = F.trim("value").try_cast("double")
    return rows.select(
        F.lit(run_id).alias("run_id"), F.trim("qid").alias("qid"), F.trim("metric").alias("metric"),
        value.alias("value"),
    ).filter(F.col("value").isNotNull())


def read_passages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(pid, text)."""
    return _lines(spark, paths, "\t", "pid string, text string")


def read_passage_pairs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(qid, pid, rel)."""
    return _lines(spark, paths, "\t", "qid string, pid string, rel int")


def candidate_docs(candidates: DataFrame) -> DataFrame:
    """The distinct documents of all candidate lists."""
    return candidates.select("docid").distinct()


def run_line(score: Column | None = None) -> Column:
    shown = F.format_string("%.6f", F.col("score")) if score is None else score
    return F.concat_ws(" ", "qid", F.lit(RUN_MARK), "docid", F.col("rank").cast("string"), shown, "run_id")


def qrel_line() -> Column:
    return F.concat_ws(" ", "qid", F.lit(QREL_MARK), "docid", F.col("rel").cast("string"))


def triple_line(columns: list[str]) -> Column:
    return F.concat_ws("\t", *columns)


def write_run(run: DataFrame, path: str) -> None:
    run.orderBy("qid", "rank").select(run_line().alias("value")).write.text(path)


def write_qrels(qrels: DataFrame, path: str) -> None:
    qrels.select(qrel_line().alias("value")).write.text(path)


def write_triples(triples: DataFrame, path: str) -> None:
    triples.select(triple_line(triples.columns).alias("value")).write.text(path)


def write_docs(docs: DataFrame, path: str) -> None:
    """Tab-separated documents; tabs and line ends inside a field become spaces."""
    flat = [F.regexp_replace(name, r"[\t\r\n]", " ") for name in ("docid", "url", "title", "body")]
    docs.select(F.concat_ws("\t", *flat).alias("value")).write.text(path)


def write_queries(queries: DataFrame, path: str) -> None:
    flat = F.regexp_replace("text", r"[\t\r\n]", " ")
    queries.select("qid", flat.alias("text")).write.option("sep", "\t").option("escape", '"').csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    line = F.concat(F.rpad("metric", 22, " "), F.lit("\t"), F.col("qid"), F.lit("\t"), F.format_string("%.4f", "value"))
    metrics.select(line.alias("value")).write.text(path)


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table at `path`, built and written first when there is none or `force` is set."""
    if not force:
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # nothing committed there yet
            pass
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
