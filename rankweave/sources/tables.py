"""The relations of a ranking task, taken from the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.operators.index import Index
from rankweave.operators.search import matches

# A document is judged for a query when it holds at least one in so many of the query's terms.
JUDGED_SHARE = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(docid, url, title, body); the title is the first line of the text, the body the whole text."""
    source = table(spark, folder, "documents")
    docid = F.col("doc_id").cast("string")
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/"), F.col("lang"), F.lit("/"), docid)
    return source.select(
        docid.alias("docid"), url.alias("url"), F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
    )


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A file scan with fewer splits than the session has cores (a file of few row groups), dealt out by `key`.

    Large inputs have more splits than cores and are left alone.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(wanted, key) if scan.rdd.getNumPartitions() < wanted else scan


def web_urls(spark: SparkSession, folder: str) -> DataFrame:
    """(docid, url) of the web pages."""
    return table(spark, folder, "pages").select(F.col("page_id").cast("string").alias("docid"), "url")


def queries(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, text); a query is the whole text of a benchmark item."""
    return table(spark, folder, "benchmark").select(F.col("item_id").cast("string").alias("qid"), "text")


def judgments(spark: SparkSession, folder: str, index: Index) -> DataFrame:
    """(qid, docid, rel) for labelled documents that hold at least a fifth of a query's distinct terms.

    Poor or toxic documents get grade 0, others 1, from two fifths of the terms on 2, with all terms 3.
    """
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("docid"), "quality", "toxic"
    )
    found = matches(queries(spark, folder), index, "body", JUDGED_SHARE, within=labels)
    shared = found.groupBy("qid", "docid").agg(F.count(F.lit(1)).alias("c"), F.max("n_terms").alias("n"))
    c, n = F.col("c"), F.col("n")
    rel = (
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 0)
        .when(c == n, 3)
        .when(5 * c >= 2 * n, 2)
        .otherwise(1)
    )
    return shared.filter(JUDGED_SHARE * c >= n).join(labels, "docid").select("qid", "docid", rel.alias("rel"))


def _turn_id(turn: Column) -> Column:
    return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))


def passage_queries(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, text): user turns of conversations."""
    turns = table(spark, folder, "conversations").filter(F.col("role") == "user")
    return turns.select(_turn_id(F.col("turn")).alias("qid"), "text")


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """(pid, text): assistant turns of conversations."""
    turns = table(spark, folder, "conversations").filter(F.col("role") == "assistant")
    return turns.select(_turn_id(F.col("turn")).alias("pid"), "text")


def passage_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, pid, rel): a user turn and the assistant turn right after it, graded 1..5 by the turn number."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn")
    answered = turns.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"))
    return asked.join(answered, ["conv_id", "turn"]).select(
        _turn_id(F.col("turn")).alias("qid"), _turn_id(F.col("turn") + 1).alias("pid"),
        (F.col("turn") % 5 + 1).cast("int").alias("rel"),
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    """(id, cluster, point): labelled vectors."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster"),
        F.col("embedding").cast("array<double>").alias("point"),
    )
