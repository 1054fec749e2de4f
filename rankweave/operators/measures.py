"""Ranking measures of runs against relevance judgments.

A run is re-ranked by (score descending, docid descending); its rank column is not used. A document counts as
relevant when its grade is at least 1. Measures are computed per query for the queries that are in both the run
and the judgments, and averaged over those queries (counts are summed) in the rows with qid `all`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.ordering import positions

# Cut-offs and levels of the measure family, the floor of geometric means, the prior of infAP.
CUTS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
SUCCESS_CUTS = (1, 5, 10)
RECALL_LEVELS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
RPREC_FACTORS = (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0)
CUT_ROUNDING = 0.9
GEO_FLOOR = 1e-5
INFAP_PRIOR = 1e-5
IDEAL_CHUNK = 4096

COUNTS = ("num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret")
GEOMETRIC = {"gm_map": "map", "gm_bpref": "bpref"}


def rank_hits(run: DataFrame, qrels: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(qid, docid, pos, rel, rel_above, nonrel_above) of the retrieved documents; rel is null when unjudged.

    `max_depth` says that no query has more rows than that; without it a query may have any number of rows.
    """
    judged = qrels.select("qid", "docid", "rel")
    hits = run.select("qid", "docid", "score").join(judged, ["qid", "docid"], "left")
    is_rel = F.coalesce((F.col("rel") > 0).cast("int"), F.lit(0))
    is_nonrel = F.coalesce((F.col("rel") <= 0).cast("int"), F.lit(0))
    placed = positions(
        hits.withColumn("is_rel", is_rel).withColumn("is_nonrel", is_nonrel),
        ["qid"], [F.desc("score"), F.desc("docid")],
        {"rel_upto": F.col("is_rel"), "nonrel_upto": F.col("is_nonrel")},
        bounded=max_depth is not None,
    )
    return placed.select(
        "qid", "docid", "pos", "rel", "is_rel", "is_nonrel",
        (F.col("rel_upto") - F.col("is_rel")).alias("rel_above"),
        (F.col("nonrel_upto") - F.col("is_nonrel")).alias("nonrel_above"),
    )


def judged_totals(qrels: DataFrame) -> DataFrame:
    """(qid, n_rel, n_nonrel)."""
    return qrels.groupBy("qid").agg(
        F.count_if(F.col("rel") > 0).alias("n_rel"), F.count_if(F.col("rel") <= 0).alias("n_nonrel")
    )


def ideal_gains(qrels: DataFrame) -> DataFrame:
    """(qid, ideal, ideal_5, ...): discounted gain of the best possible order, whole and at each cut-off.

    Judgments are first counted by grade, so a query with very many of them is never sorted in one task; the
    places of a grade are then laid out in chunks of a fixed size.
    """
    grades = qrels.filter(F.col("rel") > 0).groupBy("qid", "rel").agg(F.count(F.lit(1)).alias("n"))
    placed = positions(grades, ["qid"], [F.desc("rel")], {"upto": F.col("n")}, bounded=True)
    upto, n = F.col("upto").cast("long"), F.col("n")
    first, last = upto - n + 1, upto
    chunked = placed.select(
        "qid", "rel", first.alias("first"), last.alias("last"),
        F.explode(F.sequence(F.floor(first / IDEAL_CHUNK), F.floor(last / IDEAL_CHUNK))).alias("chunk"),
    )
    start = F.greatest(F.col("first"), F.col("chunk") * IDEAL_CHUNK)
    end = F.least(F.col("last"), F.col("chunk") * IDEAL_CHUNK + IDEAL_CHUNK - 1)
    # A grade that starts a chunk before its first place has an empty range there, which `end >= start` removes.
    places = chunked.filter(end >= start).select("qid", "rel", F.explode(F.sequence(start, end)).alias("pos"))
    gain = F.col("rel") / F.log2(F.col("pos") + 1.0)
    return places.groupBy("qid").agg(
        F.sum(gain).alias("ideal"),
        *[F.sum(F.when(F.col("pos") <= k, gain)).alias(f"ideal_{k}") for k in CUTS],
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _cut(share: float, n_rel: Column) -> Column:
    return F.floor(F.lit(share) * n_rel + F.lit(CUT_ROUNDING))


def query_measures(run: DataFrame, qrels: DataFrame, max_depth: int | None = None,
                   names: list[str] | None = None) -> DataFrame:
    """One row per query in both tables, one column per measure; `names` picks some of `MEASURES`."""
    names = names or list(MEASURES)
    totals = judged_totals(qrels)
    hits = lookup_join(rank_hits(run, qrels, max_depth), totals, ["qid"], ["docid"], fits_in_memory(totals))
    pos, rel_above, nonrel_above = F.col("pos"), F.col("rel_above"), F.col("nonrel_above")
    is_rel = F.col("is_rel") == 1
    n_rel, n_nonrel = F.col("n_rel"), F.col("n_nonrel")
    precision_here = (rel_above + 1) / pos
    gain = F.when(is_rel, F.col("rel") / F.log2(pos + 1.0)).otherwise(F.lit(0.0))
    judged_above = rel_above + nonrel_above
    expected = 1 / pos + ((pos - 1) / pos) * (judged_above / (pos - 1)) * (
        (rel_above + INFAP_PRIOR) / (judged_above + 2 * INFAP_PRIOR)
    )
    penalty = F.when(nonrel_above > 0, F.least(nonrel_above, n_rel) / F.least(n_nonrel, n_rel)).otherwise(F.lit(0.0))

    def at_hits(value: Column) -> Column:
        return F.sum(F.when(is_rel, value).otherwise(F.lit(0.0)))

    sums = {
        "n_rel": F.max(n_rel),
        "n_ret": F.count(F.lit(1)),
        "n_hit": F.sum("is_rel"),
        "n_bad": F.sum("is_nonrel"),
        "s_ap": at_hits(precision_here),
        "s_infap": at_hits(F.when(pos == 1, F.lit(1.0)).otherwise(expected)),
        "s_bpref": at_hits(1 - penalty),
        "s_bing": at_hits(1 / F.log2(pos - rel_above - 1 + F.lit(2.0))),
        "first_hit": F.min(F.when(is_rel, pos)),
        "s_rprec": F.sum(F.when(pos <= n_rel, F.col("is_rel")).otherwise(0)),
        "s_gain": F.sum(gain),
    }
    for k in CUTS:
        sums[f"hits_{k}"] = F.sum(F.when(pos <= k, F.col("is_rel")).otherwise(0))
        sums[f"ap_{k}"] = at_hits(F.when(pos <= k, precision_here).otherwise(F.lit(0.0)))
        sums[f"gain_{k}"] = F.sum(F.when(pos <= k, gain).otherwise(F.lit(0.0)))
    for level in RECALL_LEVELS:
        enough = is_rel & (rel_above + 1 >= _cut(level, n_rel))
        sums[f"iprec_{level:.2f}"] = F.coalesce(F.max(F.when(enough, precision_here)), F.lit(0.0))
    for factor in RPREC_FACTORS:
        sums[f"rprec_{factor:.2f}"] = F.sum(F.when(pos <= _cut(factor, n_rel), F.col("is_rel")).otherwise(0))

    totals = hits.groupBy("qid").agg(*[value.alias(name) for name, value in sums.items()])
    if any(name.startswith("ndcg") for name in names):
        totals = totals.join(ideal_gains(qrels), "qid", "left")
    return totals.select("qid", *[MEASURES[name]().cast("double").alias(name) for name in names])


def _measures() -> dict:
    c = F.col

    def hits(k):
        return c(f"hits_{k}")

    table = {
        "num_ret": lambda: c("n_ret"),
        "num_rel": lambda: c("n_rel"),
        "num_rel_ret": lambda: c("n_hit"),
        "num_nonrel_judged_ret": lambda: c("n_bad"),
        "map": lambda: _share(c("s_ap"), c("n_rel")),
        "Rprec": lambda: _share(c("s_rprec"), c("n_rel")),
        "bpref": lambda: _share(c("s_bpref"), c("n_rel")),
        "recip_rank": lambda: F.coalesce(1 / c("first_hit"), F.lit(0.0)),
        "infAP": lambda: _share(c("s_infap"), c("n_rel")),
        "utility": lambda: 2 * c("n_hit") - c("n_ret"),
        "binG": lambda: _share(c("s_bing"), c("n_rel")),
        "ndcg": lambda: _share(c("s_gain"), c("ideal")),
        "set_P": lambda: c("n_hit") / c("n_ret"),
        "set_relative_P": lambda: _share(c("n_hit"), F.least(c("n_ret"), c("n_rel"))),
        "set_recall": lambda: _share(c("n_hit"), c("n_rel")),
        "set_map": lambda: _share(c("n_hit") * c("n_hit"), c("n_ret") * c("n_rel")),
        "set_F": lambda: 2 * c("n_hit") / (c("n_ret") + c("n_rel")),
        "11pt_avg": lambda: sum((c(f"`iprec_{v:.2f}`") for v in RECALL_LEVELS), F.lit(0.0)) / len(RECALL_LEVELS),
    }
    for level in RECALL_LEVELS:
        table[f"iprec_at_recall_{level:.2f}"] = lambda v=level: c(f"`iprec_{v:.2f}`")
    for factor in RPREC_FACTORS:
        table[f"Rprec_mult_{factor:.2f}"] = lambda v=factor: _share(c(f"`rprec_{v:.2f}`"), _cut(v, c("n_rel")))
    for k in SUCCESS_CUTS:
        table[f"success_{k}"] = lambda k=k: F.coalesce((c("first_hit") <= k).cast("double"), F.lit(0.0))
    for k in CUTS:
        table[f"P_{k}"] = lambda k=k: hits(k) / k
        table[f"recall_{k}"] = lambda k=k: _share(hits(k), c("n_rel"))
        table[f"relative_P_{k}"] = lambda k=k: _share(hits(k), F.least(F.lit(k), c("n_rel")))
        table[f"map_cut_{k}"] = lambda k=k: _share(c(f"ap_{k}"), c("n_rel"))
        table[f"ndcg_cut_{k}"] = lambda k=k: _share(c(f"gain_{k}"), c(f"ideal_{k}"))
    return table


MEASURES = _measures()


def evaluate(run: DataFrame, qrels: DataFrame, max_depth: int | None = None, names: list[str] | None = None,
             run_id: str | None = None) -> DataFrame:
    """(run_id, qid, metric, value): one row per query and measure, and rows with qid `all` over all queries.

    `names` may also hold the geometric means gm_map and gm_bpref and the count num_q, which have only `all` rows.
    """
    names = names or [*MEASURES, *GEOMETRIC, "num_q"]
    plain = [name for name in names if name in MEASURES]
    needed = list(dict.fromkeys([*plain, *[GEOMETRIC[name] for name in names if name in GEOMETRIC]]))
    wide = query_measures(run, qrels, max_depth, needed or ["num_ret"])
    run_label = F.lit(run_id) if run_id else F.lit("run")

    def quoted(name: str) -> Column:
        return F.col(f"`{name}`")

    # What each measure contributes per query: its value, the logarithm for a geometric mean, 1 for the query count.
    parts = {name: quoted(name) for name in plain}
    parts |= {
        name: F.log(F.greatest(quoted(GEOMETRIC[name]), F.lit(GEO_FLOOR))) for name in names if name in GEOMETRIC
    }
    if "num_q" in names:
        parts["num_q"] = F.lit(1.0)
    per_query = wide.select(
        "qid",
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("metric"), part.cast("double").alias("value")) for name, part in parts.items()
        ])),
    )
    metric = F.col("metric")
    both = per_query.groupingSets([["qid", "metric"], ["metric"]], "qid", "metric").agg(
        F.grouping("qid").alias("overall"), F.sum("value").alias("total"), F.avg("value").alias("mean")
    )
    pooled_only = metric.isin(*GEOMETRIC, "num_q")
    value = (
        F.when(metric.isin(*COUNTS, "num_q"), F.col("total"))
        .when(metric.isin(*GEOMETRIC), F.exp("mean"))
        .otherwise(F.col("mean"))
    )
    return both.filter((F.col("overall") == 1) | ~pooled_only).select(
        run_label.alias("run_id"),
        F.when(F.col("overall") == 1, F.lit("all")).otherwise(F.col("qid")).alias("qid"),
        "metric", value.alias("value"),
    )


def binary_ndcg(scored: DataFrame, cut: int | None = None, pooled: bool = False, max_depth: int | None = None,
                ideal: DataFrame | None = None) -> DataFrame:
    """(qid, ndcg) with gain 1 for a positive, from (qid, docid, score, label); an ideal gain of 0 counts as 1.

    By default each query ranks its own documents. `pooled` ranks the documents of all queries together and lets
    every query score its own positives in that one order. `ideal(qid, ideal)` saves computing it again.
    """
    label = (F.col("label") > 0).cast("int")
    group = [] if pooled else ["qid"]
    placed = positions(
        scored.select("qid", "docid", "score", label.alias("label")), group,
        [F.desc("score"), F.desc("docid"), F.desc("qid")], bounded=max_depth is not None and not pooled,
    )
    inside = F.col("pos") <= cut if cut else F.lit(True)
    got = placed.groupBy("qid").agg(
        F.sum(F.when(inside & (F.col("label") == 1), 1 / F.log2(F.col("pos") + 1.0)).otherwise(F.lit(0.0))).alias("dcg")
    )
    ideal = ideal if ideal is not None else ideal_gains_at(scored.filter(F.col("label") > 0), cut)
    best = F.coalesce(F.col("ideal"), F.lit(1.0))
    return got.join(ideal, "qid", "left").select("qid", (F.col("dcg") / best).alias("ndcg"))


def ideal_gains_at(positives: DataFrame, cut: int | None) -> DataFrame:
    """(qid, ideal): discounted gain of all positives on top, from one row per positive, down to any cut-off."""
    n = F.count(F.lit(1))
    counts = positives.groupBy("qid").agg((F.least(n, F.lit(cut)) if cut else n).cast("long").alias("n"))
    chunks = counts.select(
        "qid", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / IDEAL_CHUNK))).alias("chunk")
    )
    start = F.col("chunk") * IDEAL_CHUNK + 1
    end = F.least(F.col("n"), start + IDEAL_CHUNK - 1)
    places = chunks.select("qid", F.explode(F.sequence(start, end)).alias("pos"))
    return places.groupBy("qid").agg(F.sum(1 / F.log2(F.col("pos") + 1.0)).alias("ideal"))


def precision_at(scored: DataFrame, cut: int, max_depth: int | None = None) -> DataFrame:
    """(qid, precision) of the first `cut` documents, from (qid, docid, score, label)."""
    placed = positions(scored.select("qid", "docid", "score", "label"), ["qid"],
                       [F.desc("score"), F.desc("docid")], bounded=max_depth is not None)
    hit = (F.col("pos") <= cut) & (F.col("label") > 0)
    return placed.groupBy("qid").agg((F.count_if(hit) / cut).alias("precision"))
