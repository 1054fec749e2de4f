"""Comparison of runs and per-query error tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions import text
from rankweave.functions.scoring import stable
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.ordering import positions, top_k

# Rows shown per category, the damping of long ranks, and the measures of the header.
SHOWN = 5
RANK_POWER = 0.75
HEADER_MEASURES = ("map", "ndcg_cut_10", "recip_rank")


def win_count(first: DataFrame, second: DataFrame, metric: str = "ndcg_cut_10") -> DataFrame:
    """(wins, total): queries of `first` on which `second` has the higher value of `metric`."""

    def values(metrics: DataFrame, name: str) -> DataFrame:
        rows = metrics.filter((F.col("metric") == metric) & (F.col("qid") != "all"))
        return rows.select("qid", F.col("value").alias(name))

    both = values(first, "one").join(values(second, "two"), "qid", "left")
    return both.agg(F.count_if(F.col("two") > F.col("one")).alias("wins"), F.count(F.lit(1)).alias("total"))


def _relevant(qrels: DataFrame) -> DataFrame:
    return qrels.filter(F.col("rel") > 0)


def query_summary(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """(qid, predicted, relevant_predicted, relevant) of the queries with a relevant document."""
    good = _relevant(qrels)
    relevant = good.groupBy("qid").agg(F.count(F.lit(1)).alias("relevant"))
    flagged = run.select("qid", "docid").join(
        good.select("qid", "docid", F.lit(1).alias("hit")), ["qid", "docid"], "left"
    )
    found = flagged.groupBy("qid").agg(
        F.count(F.lit(1)).alias("predicted"), F.count("hit").alias("relevant_predicted")
    )
    return relevant.join(found, "qid", "left").select(
        "qid",
        F.coalesce("predicted", F.lit(0)).alias("predicted"),
        F.coalesce("relevant_predicted", F.lit(0)).alias("relevant_predicted"),
        "relevant",
    )


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    shown = docs.select("docid", "title", "url", text.snippet(F.col("body")).alias("snippet"))
    return rows.join(shown, "docid")


def false_positives(run: DataFrame, qrels: DataFrame, docs: DataFrame | None = None, n: int = SHOWN) -> DataFrame:
    """(qid, docid, rank): the first n retrieved documents that are not relevant, of queries with a relevant one."""
    good = _relevant(qrels)
    rows = run.join(good.select("qid").distinct(), "qid", "left_semi")
    rows = rows.join(good.select("qid", "docid"), ["qid", "docid"], "left_anti")
    rows = top_k(rows, n, order=[F.asc("rank")], rank="_place").select("qid", "docid", "rank")
    return _with_text(rows, docs) if docs is not None else rows


def relevant_on_top(run: DataFrame, qrels: DataFrame, docs: DataFrame | None = None, n: int = SHOWN) -> DataFrame:
    """(qid, docid, rank): the first n retrieved documents that are relevant."""
    rows = run.join(_relevant(qrels).select("qid", "docid"), ["qid", "docid"])
    rows = top_k(rows, n, order=[F.asc("rank")], rank="_place").select("qid", "docid", "rank")
    return _with_text(rows, docs) if docs is not None else rows


def _too_low(run: DataFrame, qrels: DataFrame, gap: Column, n: int) -> DataFrame:
    """The n relevant retrieved documents with the largest gap between their rank and their true place."""
    good = _relevant(qrels).select("qid", "docid", "rel")
    ideal = positions(good, ["qid"], [F.desc("rel"), F.asc("docid")]).withColumnRenamed("pos", "true_rank")
    counts = good.groupBy("qid").agg(F.count(F.lit(1)).alias("relevant"))
    found = run.select("qid", "docid", "rank").join(ideal, ["qid", "docid"])
    rows = lookup_join(found, counts, ["qid"], ["docid"], fits_in_memory(counts))
    rows = rows.withColumn("gap", stable(gap))
    return top_k(rows, n, order=[F.desc("gap"), F.desc("rank")], rank="place").select(
        "qid", "docid", F.col("rank").cast("long").alias("rank"), "true_rank", "relevant", "gap"
    )


def ranked_too_low(run: DataFrame, qrels: DataFrame, docs: DataFrame | None = None, n: int = SHOWN) -> DataFrame:
    """Gap = rank ** 0.75 minus the 0-based true place."""
    rows = _too_low(run, qrels, F.pow(F.col("rank"), F.lit(RANK_POWER)) - (F.col("true_rank") - 1), n)
    return _with_text(rows, docs) if docs is not None else rows


def ranked_too_low_linear(run: DataFrame, qrels: DataFrame, docs: DataFrame | None = None,
                          n: int = SHOWN) -> DataFrame:
    """Gap = rank minus the 0-based true place; of the first n, those with a positive gap."""
    rows = _too_low(run, qrels, (F.col("rank") - (F.col("true_rank") - 1)).cast("double"), n)
    rows = rows.filter(F.col("gap") > 0)
    return _with_text(rows, docs) if docs is not None else rows


def _wide(metrics: DataFrame, names: tuple[str, ...]) -> DataFrame:
    rows = metrics.filter(F.col("metric").isin(*names))
    return rows.groupBy("qid").agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])


def worst_first(metrics: DataFrame) -> DataFrame:
    """(place, qid, badness): queries by map / average map + ndcg_cut_10 / average ndcg_cut_10, worst first."""
    wide = _wide(metrics, ("map", "ndcg_cut_10"))
    average = wide.filter(F.col("qid") == "all").first()  # one row
    share = F.col("map") / F.lit(average["map"] or 1.0) + F.col("ndcg_cut_10") / F.lit(
        average["ndcg_cut_10"] or 1.0
    )
    rows = wide.filter(F.col("qid") != "all").select("qid", stable(share).alias("badness"))
    return positions(rows, [], [F.asc("badness"), F.asc("qid")]).withColumnRenamed("pos", "place")


def query_headers(queries: DataFrame, metrics: DataFrame, stem: bool = False) -> DataFrame:
    """(qid, text, tokens, map, ndcg_cut_10, recip_rank) of the evaluated queries."""
    tokens = F.array_join(text.analyze(F.col("text"), stem), " ").alias("tokens")
    return queries.select("qid", "text", tokens).join(_wide(metrics, HEADER_MEASURES), "qid")
