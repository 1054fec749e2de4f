"""Inverted index and collection statistics.

An index is a folder of Parquet tables, each split by `batch` (one value per group of documents added together):

- `docs(docid)`;
- `postings(field, docid, dl, term, tf)`; postings carry the field length of their document, so scoring needs no
  join on docid;
- `doc_lens(field, docid, dl)`: field lengths, one row per document and field with tokens;
- `term_parts(field, term, df, cf)` and `field_parts(field, field_len)`: statistics per batch. The statistics of the
  collection are sums over batches, so adding documents never re-reads the older ones;
- `replaced(field, docid, keep, turn)`: documents whose field was written anew. Of their rows of that field only those of
  the batch `keep` count (of several, the one with the latest `turn`); its statistics hold what the older rows take away.
  Readers leave dead rows out of that field's files; `compact_index` writes an index without them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions import text
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.session import exists, materialize, new_path

FIELDS = ("body", "title", "url_text")
BASE_BATCH = "base"
TEXT_PART = 8 * 1024 * 1024  # bytes of text whose postings a task counts and sorts in memory
MAX_PARTS = 100_000
SCHEMAS = {
    "docs": "docid string, batch string",
    "postings": "docid string, dl bigint, term string, tf bigint, batch string, field string",
    "doc_lens": "field string, docid string, dl bigint, batch string",
    "term_parts": "field string, term string, df bigint, cf bigint, batch string",
    "field_parts": "field string, field_len bigint, batch string",
}
REPLACED = "field string, docid string, keep string, turn bigint, batch string"


@dataclass(frozen=True)
class FieldTotals:
    n_docs: int
    field_len: int

    @property
    def avg_len(self) -> float:
        return self.field_len / self.n_docs


@dataclass(frozen=True)
class Index:
    docs: DataFrame
    postings: DataFrame
    doc_lens: DataFrame
    term_parts: DataFrame
    field_parts: DataFrame
    stem: bool = False

    def field(self, name: str) -> DataFrame:
        """(docid, dl, term, tf) of one field; reads only that field's files."""
        return self.postings.filter(F.col("field") == name).select("docid", "dl", "term", "tf")

    def term_stats(self, vocabulary: DataFrame | None = None, vocabulary_fits: bool = False) -> DataFrame:
        """(field, term, df, cf), of the terms in `vocabulary(term)` only when it is given."""
        parts = self.term_parts
        if vocabulary is not None:
            # a term has one row per field and batch, too few to need salt
            parts = lookup_join(parts, vocabulary, ["term"], ["field", "batch"], vocabulary_fits, "left_semi", salts=1)
        return parts.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")

    def totals(self) -> dict[str, FieldTotals]:
        """One entry per field; reads counts only."""
        n_docs = self.docs.count()
        rows = self.field_parts.groupBy("field").agg(F.sum("field_len").alias("field_len")).collect()
        return {row["field"]: FieldTotals(n_docs, row["field_len"]) for row in rows}

    def field_stats(self) -> DataFrame:
        """(field, n_docs, field_len, avg_len); the average is over all documents, also those without the field."""
        n_docs = F.lit(self.docs.count())
        lengths = self.field_parts.groupBy("field").agg(F.sum("field_len").alias("field_len"))
        return lengths.select(
            "field", n_docs.cast("long").alias("n_docs"), "field_len", (F.col("field_len") / n_docs).alias("avg_len")
        )

    def doc_len(self) -> DataFrame:
        """(field, docid, dl) for documents with at least one token in the field."""
        return self.doc_lens.select("field", "docid", "dl")


def field_text(name: str) -> Column:
    return text.url_text(F.col("url")) if name == "url_text" else F.col(name)


def field_tokens(docs: DataFrame, fields: tuple[str, ...] = FIELDS, stem: bool = False) -> DataFrame:
    """(docid, field, tokens), one row per document and field."""
    entries = [F.struct(F.lit(f).alias("field"), text.analyze(field_text(f), stem).alias("tokens")) for f in fields]
    return docs.select("docid", F.inline(F.array(*entries)))


def text_parts(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> int:
    """Partitions for the measured text of `docs`: TEXT_PART bytes each, less where that leaves cores without work."""
    size = sum((F.coalesce(F.octet_length(field_text(f)), F.lit(0)).cast("long") for f in fields), F.lit(0))
    size = docs.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, min(math.ceil(size / TEXT_PART), MAX_PARTS), min(math.ceil(16 * size / TEXT_PART), cores))


def build_postings(docs: DataFrame, fields: tuple[str, ...] = FIELDS, stem: bool = False,
                   with_positions: bool = False) -> DataFrame:
    """One row per (field, docid, term).

    The text is shuffled by docid before its terms are counted: it is many times smaller than its postings, and the
    grouping by (docid, ...) then needs no shuffle of its own. Spark forgets how rows lie where they pass through Python, so
    the stems are made before, and shuffled as one string; a scan of few splits is best dealt out first.

    A task holds the postings of its text, so partitions are numbered by the size of the text.
    """
    parts = text_parts(docs, fields)
    if stem:
        tokens = field_tokens(docs, fields, stem).filter(F.size("tokens") > 0)
        lines = tokens.select("field", "docid", F.array_join("tokens", " ").alias("line"))
        tokens = lines.repartition(parts, "docid").select("field", "docid", F.split("line", " ").alias("tokens"))
    else:
        tokens = field_tokens(docs.repartition(parts, "docid"), fields).filter(F.size("tokens") > 0)
    entry = F.posexplode("tokens").alias("pos", "term") if with_positions else F.explode("tokens").alias("term")
    extra = [F.array_sort(F.collect_list("pos")).alias("positions")] if with_positions else []
    return (
        tokens.select("field", "docid", F.size("tokens").cast("long").alias("dl"), entry)
        .groupBy("field", "docid", "dl", "term")
        .agg(F.count(F.lit(1)).alias("tf"), *extra)
    )


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs / df)


def smoothed_idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs / (df + 1))


def write_index(docs: DataFrame, path: str, fields: tuple[str, ...] = FIELDS, stem: bool = False) -> Index:
    """Build the index under `path`, replacing what is there."""
    clear_index(docs.sparkSession, path)
    _write_batch(path, docs, build_postings(docs, fields, stem), BASE_BATCH)
    return read_index(docs.sparkSession, path, stem)


def build_index(docs: DataFrame, fields: tuple[str, ...] = FIELDS, stem: bool = False) -> Index:
    """An index in a fresh folder of the shared checkpoint area."""
    path = new_path(docs.sparkSession, "index")
    _write_batch(path, docs, build_postings(docs, fields, stem), BASE_BATCH)
    return read_index(docs.sparkSession, path, stem)


def read_index(spark: SparkSession, path: str, stem: bool = False, without: str | None = None) -> Index:
    """The index at `path`; `without` leaves out what one batch has written."""
    def table(name: str, schema: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(f"{path}/{name}")
        return rows.filter(F.col("batch") != without) if without else rows

    tables = {name: table(name, schema) for name, schema in SCHEMAS.items()}
    if exists(spark, f"{path}/replaced"):
        replaced = table("replaced", REPLACED)
        fields = [r["field"] for r in replaced.select("field").distinct().collect()]  # fields of an index are few
        if fields:
            latest = replaced.groupBy("field", "docid").agg(F.max_by("keep", "turn").alias("keep"))
            few = fits_in_memory(latest)
            for name, spread in (("postings", "term"), ("doc_lens", "batch")):
                tables[name] = _alive(tables[name], latest, fields, spread, few)
    return Index(**tables, stem=stem)


def _alive(rows: DataFrame, latest: DataFrame, fields: list[str], spread: str, few: bool) -> DataFrame:
    """Rows of the fields without those that a later batch has replaced; other fields' rows are not touched."""
    touched = lookup_join(rows.filter(F.col("field").isin(fields)), latest, ["field", "docid"], [spread], few, "left")
    alive = touched.filter(F.col("keep").isNull() | (F.col("keep") == F.col("batch"))).drop("keep").select(*rows.columns)
    return rows.filter(~F.col("field").isin(fields)).unionByName(alive)


def append_documents(path: str, docs: DataFrame, batch: str, fields: tuple[str, ...] = FIELDS,
                     stem: bool = False) -> Index:
    """Add the documents of `docs` that the index does not hold yet, as `batch`.

    Running the same batch again replaces what it wrote before, so a batch that died half-way can be repeated.
    """
    spark = docs.sparkSession
    older = read_index(spark, path, stem).docs.filter(F.col("batch") != batch)
    fresh = docs.dropDuplicates(["docid"])
    ids = fresh.select("docid")
    fits = fits_in_memory(ids)
    repeated = lookup_join(older.select("docid"), ids, ["docid"], ["docid"], fits, "left_semi")
    fresh = fresh.join(repeated, "docid", "left_anti")
    _write_batch(path, fresh, build_postings(fresh, fields, stem), batch)
    return read_index(spark, path, stem)


def upsert_field(path: str, docs: DataFrame, field: str, batch: str, stem: bool = False) -> Index:
    """Write `field` of the documents of `docs` anew in the index at `path`, as `batch`; documents it lacks are added.

    Nothing that is there is written again. The batch holds the new rows of that field, the documents whose older rows of
    it no longer count, and statistics that add the new rows and take the older ones away. Running the same batch again
    replaces what it wrote before.
    """
    spark = docs.sparkSession
    old = read_index(spark, path, stem, without=batch)
    fresh = docs.dropDuplicates(["docid"])
    ids = materialize(fresh.select("docid"), "upserted")
    few = fits_in_memory(ids)
    gone = lookup_join(old.postings.filter(F.col("field") == field), ids, ["docid"], ["term"], few, "left_semi")
    gone = materialize(gone.select("field", "docid", "dl", "term", "tf"), "gone")
    turn = 0
    if exists(spark, f"{path}/replaced"):
        earlier = spark.read.schema(REPLACED).parquet(f"{path}/replaced").filter(F.col("batch") != batch)
        turn = (earlier.agg(F.max("turn")).first()[0] or 0) + 1
    known = lookup_join(old.docs.select("docid"), ids, ["docid"], ["docid"], few, "left_semi")
    _write_batch(path, ids.join(known, "docid", "left_anti"), build_postings(fresh, (field,), stem), batch, gone)
    kept = ids.select(F.lit(field).alias("field"), "docid", F.lit(batch).alias("keep"), F.lit(turn).cast("long").alias("turn"))
    kept.write.mode("overwrite").parquet(f"{path}/replaced/batch={batch}")
    return read_index(spark, path, stem)


def compact_index(path: str, target: str, spark: SparkSession, stem: bool = False) -> Index:
    """Write to `target` the index at `path` as one batch, without rows that no longer count."""
    old = read_index(spark, path, stem)
    _write_batch(target, old.docs.select("docid").distinct(), old.postings.drop("batch"), BASE_BATCH)
    return read_index(spark, target, stem)


def clear_index(spark: SparkSession, path: str) -> None:
    """Leave an empty index at `path`."""
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.mode("overwrite").partitionBy("batch").parquet(f"{path}/{name}")
    if exists(spark, f"{path}/replaced"):
        spark.createDataFrame([], REPLACED).write.mode("overwrite").partitionBy("batch").parquet(f"{path}/replaced")


def _write_batch(path: str, docs: DataFrame, postings: DataFrame, batch: str, gone: DataFrame | None = None) -> None:
    """Write one batch folder per table, the id list last; statistics come from the written postings, less those of
    the rows in `gone`, which the batch replaces."""
    spark = docs.sparkSession
    postings.write.mode("overwrite").partitionBy("field").parquet(f"{path}/postings/batch={batch}")
    schema = "docid string, dl bigint, term string, tf bigint, field string"
    written = spark.read.schema(schema).parquet(f"{path}/postings/batch={batch}")
    lens = written.groupBy("field", "docid").agg(F.max("dl").alias("dl"))
    lens.write.mode("overwrite").parquet(f"{path}/doc_lens/batch={batch}")
    counted = written.select("field", "term", "tf", F.lit(1).cast("long").alias("one"))
    if gone is not None:
        counted = counted.unionByName(gone.select("field", "term", (-F.col("tf")).alias("tf"), F.lit(-1).cast("long").alias("one")))
    terms = counted.groupBy("field", "term").agg(F.sum("one").alias("df"), F.sum("tf").alias("cf"))
    terms.write.mode("overwrite").parquet(f"{path}/term_parts/batch={batch}")
    lengths = spark.read.schema("field string, cf bigint").parquet(f"{path}/term_parts/batch={batch}")
    lengths = lengths.groupBy("field").agg(F.sum("cf").alias("field_len"))
    lengths.write.mode("overwrite").parquet(f"{path}/field_parts/batch={batch}")
    docs.select("docid").write.mode("overwrite").parquet(f"{path}/docs/batch={batch}")
