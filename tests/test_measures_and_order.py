import math
import random

import pytest
from pyspark.sql import functions as F

from rankweave.operators import analysis, measures, ordering, rerank


@pytest.fixture(scope="module")
def tiny(spark):
    run = spark.createDataFrame(
        [("q", "d2", 3.0), ("q", "d1", 2.0), ("q", "d4", 2.0), ("q", "d3", 1.0)], "qid string, docid string, score double")
    qrels = spark.createDataFrame(
        [("q", "d1", 2), ("q", "d3", 1), ("q", "d2", 0), ("q", "d5", 1)], "qid string, docid string, rel int")
    return run, qrels


# Order after the tie-break: d2, d4, d1, d3.
BY_HAND = {
    "num_ret": 4, "num_rel": 3, "num_rel_ret": 2, "num_nonrel_judged_ret": 1, "map": 0.277778, "Rprec": 0.333333,
    "bpref": 0, "recip_rank": 0.333333, "P_5": 0.4, "recall_5": 0.666667, "relative_P_5": 0.666667, "success_1": 0,
    "success_5": 1, "binG": 0.333333, "ndcg": 0.456949, "set_P": 0.5, "set_recall": 0.666667, "utility": 0,
}


@pytest.mark.parametrize("depth", [100, None])
def test_by_hand(tiny, depth):
    got = {r["metric"]: r["value"] for r in measures.evaluate(*tiny, depth).filter("qid = 'q'").collect()}
    for name, value in BY_HAND.items():
        assert got[name] == pytest.approx(value, abs=1e-6), name


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(3)
    run, qrels = [], []
    for q in range(6):
        for d in range(60 if q else 400):  # one query holds most rows
            run.append((f"q{q}", f"d{d:03d}", float(rng.randint(0, 9))))
            if rng.random() < 0.4:
                qrels.append((f"q{q}", f"d{d:03d}", rng.choice([0, 0, 1, 2, 3])))
        qrels.append((f"q{q}", "missed", 2))
    qrels.append(("unasked", "d001", 1))
    return (spark.createDataFrame(run, "qid string, docid string, score double"),
            spark.createDataFrame(qrels, "qid string, docid string, rel int"))


def brute(run, qrels):
    judged = {(q, d): r for q, d, r in qrels}
    out = {}
    for q in {q for q, _, _ in run}:
        order = sorted(((s, d) for x, d, s in run if x == q), reverse=True)
        grades = [judged.get((q, d)) for _, d in order]
        rels = sorted((r for (x, _), r in judged.items() if x == q and r > 0), reverse=True)
        hits = [g is not None and g > 0 for g in grades]
        n_rel = len(rels)
        precision = [sum(hits[: i + 1]) / (i + 1) for i in range(len(hits))]

        def dcg(values, k):
            return sum(v / math.log2(i + 2) for i, v in enumerate(values[:k]))

        gains = [max(g or 0, 0) for g in grades]
        out[q] = {
            "map": sum(p for p, h in zip(precision, hits, strict=True) if h) / n_rel,
            "P_10": sum(hits[:10]) / 10, "recall_30": sum(hits[:30]) / n_rel,
            "ndcg": dcg(gains, None) / dcg(rels, None), "ndcg_cut_5": dcg(gains, 5) / dcg(rels, 5),
            "Rprec": sum(hits[:n_rel]) / n_rel, "utility": 2 * sum(hits) - len(hits),
            "iprec_at_recall_0.50": max(
                [p for i, p in enumerate(precision) if sum(hits[: i + 1]) >= math.floor(0.5 * n_rel + 0.9)] or [0]),
        }
    return out


@pytest.mark.parametrize("depth", [1000, None])
def test_against_loops(noisy, depth):
    run, qrels = noisy
    wanted = brute([tuple(r) for r in run.collect()], [tuple(r) for r in qrels.collect()])
    rows = measures.evaluate(run, qrels, depth).collect()
    got = {(r["qid"], r["metric"]): r["value"] for r in rows}
    assert {q for q, _ in got} == set(wanted) | {"all"}
    for q, values in wanted.items():
        for name, value in values.items():
            assert got[q, name] == pytest.approx(value, abs=1e-9), (q, name)
    assert got["all", "num_q"] == 6
    assert got["all", "num_ret"] == 700
    assert got["all", "map"] == pytest.approx(sum(v["map"] for v in wanted.values()) / 6)
    assert got["all", "gm_map"] == pytest.approx(math.exp(sum(math.log(v["map"]) for v in wanted.values()) / 6))


def test_identities(noisy):
    rows = measures.query_measures(*noisy, 1000).collect()
    for r in rows:
        assert r["infAP"] <= r["map"] + 1e-3
        assert r["utility"] == 2 * r["num_rel_ret"] - r["num_ret"]
        assert r["set_map"] == pytest.approx(r["set_P"] * r["set_recall"])
        recalls = [r[f"recall_{k}"] for k in measures.CUTS]
        assert recalls == sorted(recalls)
        assert r["Rprec_mult_1.00"] == pytest.approx(r["Rprec"])
        assert r["11pt_avg"] == pytest.approx(
            sum(r[f"iprec_at_recall_{v:.2f}"] for v in measures.RECALL_LEVELS) / 11)


def test_infap_equals_map_when_everything_is_judged(spark):
    run = spark.createDataFrame([("q", f"d{i}", float(-i)) for i in range(30)], "qid string, docid string, score double")
    qrels = spark.createDataFrame([("q", f"d{i}", int(i % 4 == 1)) for i in range(30)], "qid string, docid string, rel int")
    row = measures.query_measures(run, qrels, 100, ["map", "infAP"]).first()
    assert row["infAP"] == pytest.approx(row["map"], abs=1e-3)


def test_every_reported_measure_is_there():
    names = {*measures.MEASURES, *measures.GEOMETRIC, "num_q"}
    # 94 lines of a full report, without the run label and the three measures that are left out.
    assert len(names) == 94 - 4


def test_blocks_equal_one_window(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randint(0, 5)}", i, rng.randint(0, 3)) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    for group in (["g"], []):
        both = [
            sorted(map(tuple, ordering.positions(
                df, group, [F.desc("v"), F.asc("id")], {"upto": F.col("v")}, bounded).collect()))
            for bounded in (True, False)
        ]
        assert both[0] == both[1]


def test_median_of_values_that_repeat(spark, monkeypatch):
    """One value in a third of the rows, one group in most of them, weights and nulls; nothing but counts is placed."""
    draw = random.Random(8)
    rows = [("hot" if draw.random() < 0.8 else f"g{draw.randint(0, 4)}", 5.0 if draw.random() < 0.35 else round(draw.uniform(0, 10), 1), draw.randint(0, 3))
            for _ in range(3000)] + [("hot", None, 2), ("none", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    placed, real = [], ordering.positions
    monkeypatch.setattr(ordering, "positions", lambda df, *a, **k: placed.append(df.count()) or real(df, *a, **k))
    for weight in (None, "w"):
        wanted = {}
        for g in {r[0] for r in rows}:
            many = sorted(v for h, v, n in rows if h == g and v is not None for _ in range(n if weight else 1))
            if many:
                wanted[g] = (many[(len(many) - 1) // 2] + many[len(many) // 2]) / 2
        assert {r["g"]: r["median"] for r in ordering.exact_median(df, ["g"], "v", weight).collect()} == wanted
    assert all(n <= 6 * 101 for n in placed)


def test_exact_median(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 4), float(rng.randint(0, 50))) for _ in range(301)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["median"] for r in ordering.exact_median(df, ["g"], "v").collect()}
    wanted = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got == wanted


def test_rank_gap(spark):
    scored = spark.createDataFrame([("q", "a", 0.5), ("q", "b", 0.0), ("q", "c", -0.5)],
                                   "qid string, docid string, score double")
    for depth in (10, None):
        got = sorted((r["rank"], r["docid"]) for r in rerank.rerank(scored, "x", depth).collect())
        assert got == [(1, "a"), (3, "c")]


def test_binary_ndcg(spark):
    rows = [("q", "a", 3.0, 0), ("q", "b", 2.0, 1), ("r", "c", 2.5, 1), ("r", "d", 1.0, 0), ("s", "e", 9.0, 0)]
    df = spark.createDataFrame(rows, "qid string, docid string, score double, label int")
    own = {r["qid"]: r["ndcg"] for r in measures.binary_ndcg(df).collect()}
    assert own == {"q": pytest.approx(1 / math.log2(3)), "r": 1.0, "s": 0.0}
    pooled = {r["qid"]: r["ndcg"] for r in measures.binary_ndcg(df, pooled=True).collect()}
    assert pooled == {"q": pytest.approx(1 / math.log2(5)), "r": pytest.approx(1 / math.log2(4)), "s": 0.0}
    assert {r["qid"]: r["precision"] for r in measures.precision_at(df, 2).collect()} == {"q": 0.5, "r": 0.5, "s": 0.0}


def test_error_tables(spark):
    run = spark.createDataFrame(
        [("q", f"d{i}", i, 10.0 - i) for i in range(1, 9)], "qid string, docid string, rank int, score double")
    qrels = spark.createDataFrame(
        [("q", "d8", 3), ("q", "d2", 1), ("q", "d5", 2), ("q", "d1", 0), ("other", "d1", 1)],
        "qid string, docid string, rel int")
    summary = {r["qid"]: tuple(r)[1:] for r in analysis.query_summary(run, qrels).collect()}
    assert summary == {"q": (8, 3, 3), "other": (0, 0, 1)}
    wrong = sorted((r["rank"], r["docid"]) for r in analysis.false_positives(run, qrels).collect())
    assert wrong == [(1, "d1"), (3, "d3"), (4, "d4"), (6, "d6"), (7, "d7")]
    right = sorted((r["rank"], r["docid"]) for r in analysis.relevant_on_top(run, qrels).collect())
    assert right == [(2, "d2"), (5, "d5"), (8, "d8")]
    low = {r["docid"]: (r["true_rank"], r["gap"]) for r in analysis.ranked_too_low(run, qrels).collect()}
    assert low["d8"] == (1, pytest.approx(8 ** 0.75, abs=1e-6)) and low["d2"][0] == 3
    linear = {r["docid"] for r in analysis.ranked_too_low_linear(run, qrels).collect()}
    assert linear == {"d8", "d5"}


def test_win_count(spark):
    def table(rows):
        return spark.createDataFrame(rows, "qid string, metric string, value double")

    one = table([("a", "ndcg_cut_10", 0.1), ("b", "ndcg_cut_10", 0.5), ("c", "ndcg_cut_10", 0.2),
                 ("all", "ndcg_cut_10", 0.3), ("a", "map", 0.0)])
    two = table([("a", "ndcg_cut_10", 0.2), ("b", "ndcg_cut_10", 0.5), ("all", "ndcg_cut_10", 0.9)])
    assert tuple(analysis.win_count(one, two).first()) == (1, 3)
