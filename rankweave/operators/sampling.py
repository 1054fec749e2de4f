"""Seeded sampling and the construction of labelled training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.draws import draw, draw_int, draw_share
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.ordering import positions
from rankweave.session import materialize

# Depth of the candidate lists, and grades given to sampled positives and negatives.
CANDIDATE_DEPTH = 100
POSITIVE_GRADES = (4, 3)
NEGATIVE_GRADES = (1, 2)


def sample_rows(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k draws with replacement: `draw` (0..k-1) and the columns of the drawn row; `key` is unique in `df`."""
    placed = positions(df, [], [F.asc(key)])
    n = df.count()
    draws = df.sparkSession.range(k).withColumnRenamed("id", "draw")
    draws = draws.withColumn("pos", draw_int(seed, F.lit(n), "draw") + 1) if n else draws.limit(0).withColumn("pos", F.lit(0))
    return draws.join(placed, "pos").drop("pos")


def pick_one(df: DataFrame, group: str, item: str, seed: int) -> DataFrame:
    """One random `item` per `group`, in a single aggregation that is combined before the shuffle."""
    return df.groupBy(group).agg(F.min_by(item, draw(seed, group, item)).alias(item))


def choose_member(draws: DataFrame, members: DataFrame, group: str, item: str, seed: int,
                  bounded: bool = False) -> DataFrame:
    """For each row of `draws(draw, group)` one random `item` of its group; groups without members drop out."""
    placed = positions(members.select(group, item), [group], [F.asc(item)], bounded=bounded)
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    known = lookup_join(draws, sizes, [group], ["draw"], fits_in_memory(sizes))
    chosen = known.withColumn("pos", draw_int(seed, F.col("_n"), "draw") + 1)
    return chosen.join(placed, [group, "pos"]).drop("_n", "pos")


def shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """`df` with `place`, its position in a random order."""
    hashed = df.withColumn("_draw", draw(seed, key))
    return positions(hashed, [], [F.asc("_draw"), F.asc(key)]).withColumnRenamed("pos", "place").drop("_draw")


def split(df: DataFrame, key: str, test_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test); a key always falls on the same side."""
    in_test = draw_share(seed, key) < F.lit(test_share)
    return df.filter(~in_test), df.filter(in_test)


def replicate(df: DataFrame, times: int) -> DataFrame:
    """`times` copies of every row, numbered by `copy` from 1."""
    if times < 1:
        return df.withColumn("copy", F.lit(1)).limit(0)
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))


def positives(qrels: DataFrame) -> DataFrame:
    return qrels.filter(F.col("rel") > 0)


def best_grades(qrels: DataFrame) -> DataFrame:
    """One row per (qid, docid) with its highest grade."""
    return qrels.groupBy("qid", "docid").agg(F.max("rel").alias("rel"))


def negatives(candidates: DataFrame, qrels: DataFrame) -> DataFrame:
    """Candidates that are not judged relevant."""
    return candidates.join(positives(qrels).select("qid", "docid"), ["qid", "docid"], "left_anti")


def judge_triples(candidates: DataFrame, qrels: DataFrame, seed: int, depth: int = CANDIDATE_DEPTH) -> DataFrame:
    """Every candidate with its outcome: skipped (not at the rank drawn for its topic), docid_collision or kept.

    One rank in 1..depth is drawn per topic; topics without a relevant document are left out.
    """
    good = positives(qrels)
    topics = candidates.join(good.select("qid").distinct(), "qid", "left_semi")
    at_rank = F.col("rank") == draw_int(seed, F.lit(depth), "qid") + 1
    flagged = topics.select("qid", "docid", "rank", at_rank.alias("drawn")).join(
        good.select("qid", "docid", F.lit(True).alias("is_positive")), ["qid", "docid"], "left"
    )
    outcome = (
        F.when(~F.col("drawn"), "skipped").when(F.col("is_positive"), "docid_collision").otherwise("kept")
    )
    return flagged.select("qid", "docid", "rank", outcome.alias("outcome"))


def triple_outcomes(candidates: DataFrame, qrels: DataFrame, seed: int, depth: int = CANDIDATE_DEPTH) -> DataFrame:
    """(outcome, n)."""
    return judge_triples(candidates, qrels, seed, depth).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def triples(queries: DataFrame, docs: DataFrame, candidates: DataFrame, qrels: DataFrame, seed: int,
            depth: int = CANDIDATE_DEPTH, limit: int | None = None) -> DataFrame:
    """At most one (query, positive, hard negative) per topic, with the four columns of both documents."""
    kept = judge_triples(candidates, qrels, seed, depth).filter(F.col("outcome") == "kept")
    kept = kept.select("qid", F.col("docid").alias("rnd_docid"))
    if limit is not None:
        kept = kept.orderBy("qid").limit(limit)
    chosen = pick_one(positives(qrels), "qid", "docid", seed).withColumnRenamed("docid", "pos_docid")
    rows = queries.withColumnRenamed("text", "query").join(kept, "qid").join(chosen, "qid")
    rows = materialize(rows.select("qid", "query", "pos_docid", "rnd_docid"), "triple-ids")
    ids = rows.select(F.explode(F.array("pos_docid", "rnd_docid")).alias("docid")).distinct()
    # triples are few: documents are met where they lie, and only theirs are moved
    shown = lookup_join(docs.select("docid", "url", "title", "body"), ids, ["docid"], ["docid"], fits_in_memory(ids), "left_semi", salts=1)
    shown = materialize(shown, "triple-docs")
    for side in ("pos", "rnd"):
        rows = rows.join(shown.select(*[F.col(name).alias(f"{side}_{name}") for name in shown.columns]), f"{side}_docid")
    return rows.select(
        "qid", "query", *[f"{side}_{name}" for side in ("pos", "rnd") for name in ("docid", "url", "title", "body")]
    )


def train_pairs(queries: DataFrame, qrels: DataFrame, candidates: DataFrame, docs: DataFrame, n: int, seed: int,
                graded: bool = False, bounded: bool = False) -> DataFrame:
    """(draw, qid, docid, label): n // 2 drawn queries with one positive and one non-positive candidate each.

    Labels are 1 and 0, or with `graded` one of the two upper and lower grades. A draw whose query lacks either
    side, or whose document is missing, gives no row. `bounded` vouches for a fixed largest candidate list.
    """
    drawn = sample_rows(queries.select("qid"), "qid", n // 2, seed)
    good = positives(qrels).select("qid", "docid").distinct()
    chosen = choose_member(drawn, good, "qid", "docid", seed + 1)
    other = choose_member(drawn, negatives(candidates, qrels).select("qid", "docid"), "qid", "docid", seed + 2, bounded)
    high, low = F.lit(1), F.lit(0)
    if graded:
        high = F.when(draw_share(seed + 3, "draw") < 0.5, POSITIVE_GRADES[0]).otherwise(POSITIVE_GRADES[1])
        low = F.when(draw_share(seed + 4, "draw") < 0.5, NEGATIVE_GRADES[0]).otherwise(NEGATIVE_GRADES[1])
    both = chosen.select("draw", "qid", F.col("docid").alias("pos")).join(
        other.select("draw", F.col("docid").alias("neg")), "draw"
    )
    labelled = both.select(
        "draw", "qid",
        F.inline(F.array(
            F.struct(F.col("pos").alias("docid"), high.cast("double").alias("label")),
            F.struct(F.col("neg").alias("docid"), low.cast("double").alias("label")),
        )),
    )
    return labelled.join(docs.select("docid"), "docid", "left_semi").select("draw", "qid", "docid", "label")


def dropped_draws(pairs: DataFrame, n: int) -> DataFrame:
    """(drawn, complete, dropped): how many of the n // 2 draws gave both rows."""
    whole = pairs.groupBy("draw").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") == 2)
    drawn = F.lit(n // 2).cast("long")
    return whole.agg(F.count(F.lit(1)).alias("complete")).select(
        drawn.alias("drawn"), "complete", (drawn - F.col("complete")).alias("dropped")
    )


def graded_pairs(qrels: DataFrame, queries: DataFrame, num_graded: int) -> DataFrame:
    """(qid, docid, label, copy): judged pairs of known queries, repeated to about `num_graded` rows."""
    judged = best_grades(qrels).join(queries.select("qid"), "qid", "left_semi")
    n = judged.count()
    rows = judged.select("qid", "docid", F.col("rel").cast("double").alias("label"))
    return replicate(rows, num_graded // n if n else 0)


def training_rows(sampled: DataFrame, graded: DataFrame | None = None) -> DataFrame:
    """(qid, docid, label) of sampled pairs and, when given, graded ones."""
    rows = sampled.select("qid", "docid", "label")
    return rows.unionByName(graded.select("qid", "docid", "label")) if graded is not None else rows


def sampled_corpus(candidates: DataFrame, docs: DataFrame, k: int, seed: int) -> DataFrame:
    """(docid, copies, body): k draws with replacement from the candidate documents, empty bodies left out.

    A document has one row with the number of its draws, so many draws do not copy bodies.
    """
    placed = positions(candidates.select("docid").distinct(), [], [F.asc("docid")])
    n = placed.count()
    if not n:
        return docs.select("docid", F.lit(0).cast("long").alias("copies"), "body").limit(0)
    draws = candidates.sparkSession.range(k).select((draw_int(seed, F.lit(n), "id") + 1).alias("pos"))
    copies = draws.groupBy("pos").agg(F.count(F.lit(1)).alias("copies"))
    drawn = materialize(placed.join(copies, "pos").select("docid", "copies"), "drawn")
    bodies = docs.select("docid", "body").filter(F.length(F.rtrim("body")) > 0)
    # candidates are few: bodies are met where they lie, and only those drawn are moved
    return lookup_join(bodies, drawn, ["docid"], ["docid"], fits_in_memory(drawn), salts=1).select("docid", "copies", "body")
