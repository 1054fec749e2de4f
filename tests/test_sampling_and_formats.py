import random

import pytest
from pyspark.sql import functions as F

from rankweave.operators import sampling
from rankweave.session import new_path
from rankweave.sources import trec


@pytest.fixture(scope="module")
def pool(spark):
    rng = random.Random(1)
    queries = spark.createDataFrame([(f"q{i}", f"text {i}") for i in range(12)], "qid string, text string")
    docs = spark.createDataFrame(
        [(f"d{i}", f"u{i}", f"t{i}", f"body {i}" if i % 7 else "  ") for i in range(200)],
        "docid string, url string, title string, body string")
    candidates, qrels = [], []
    for q in range(11):
        for rank, d in enumerate(rng.sample(range(200), 100), 1):
            candidates.append((f"q{q}", f"d{d}", rank))
        for d in rng.sample(range(200), 90 if q == 0 else 6):
            qrels.append((f"q{q}", f"d{d}", rng.randint(0, 4)))
    return (queries, docs, spark.createDataFrame(candidates, "qid string, docid string, rank int"),
            spark.createDataFrame(qrels, "qid string, docid string, rel int"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_same_rows_for_any_partitioning(spark, pool):
    queries, docs, candidates, qrels = pool

    def everything(n):
        spread = [df.repartition(n) for df in (queries, docs, candidates, qrels)]
        q, d, c, r = spread
        return [
            rows(sampling.sample_rows(q.select("qid"), "qid", 50, 3)),
            rows(sampling.pick_one(sampling.positives(r), "qid", "docid", 3)),
            rows(sampling.shuffle(q, "qid", 3)),
            rows(sampling.triples(q, d, c, r, 3)),
            rows(sampling.train_pairs(q, r, c, d, 60, 3, graded=True)),
            rows(sampling.sampled_corpus(c, d, 40, 3)),
        ]

    assert everything(1) == everything(7)


def test_sample_size_and_range(pool):
    drawn = sampling.sample_rows(pool[0], "qid", 500, 9).collect()
    assert len(drawn) == 500 and {r["draw"] for r in drawn} == set(range(500))
    assert len({r["qid"] for r in drawn}) == 12
    assert sampling.sample_rows(pool[0].limit(0), "qid", 5, 9).count() == 0


def test_split_shares(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    train, test = sampling.split(df, "k", 0.1, 5)
    assert train.count() + test.count() == 20_000
    assert 1700 < test.count() < 2300
    assert train.intersect(test).count() == 0


def test_train_pairs_are_sound(pool):
    queries, docs, candidates, qrels = pool
    good = {(r["qid"], r["docid"]) for r in qrels.collect() if r["rel"] > 0}
    listed = {(r["qid"], r["docid"]) for r in candidates.collect()}
    pairs = sampling.train_pairs(queries, qrels, candidates, docs, 200, 4).collect()
    assert {r["label"] for r in pairs} == {0.0, 1.0}
    for r in pairs:
        pair = (r["qid"], r["docid"])
        assert (pair in good) if r["label"] == 1 else (pair in listed - good)
    report = sampling.dropped_draws(sampling.train_pairs(queries, qrels, candidates, docs, 200, 4), 200).first()
    assert report["complete"] * 2 == len(pairs) and report["complete"] + report["dropped"] == 100
    assert report["dropped"] > 0  # q11 has neither judgments nor candidates
    graded = sampling.train_pairs(queries, qrels, candidates, docs, 200, 4, graded=True).collect()
    assert {r["label"] for r in graded} == {1.0, 2.0, 3.0, 4.0}


def test_triples(pool):
    queries, docs, candidates, qrels = pool
    good = {(r["qid"], r["docid"]) for r in qrels.collect() if r["rel"] > 0}
    made = sampling.triples(queries, docs, candidates, qrels, 8).collect()
    outcomes = {r["outcome"]: r["n"] for r in sampling.triple_outcomes(candidates, qrels, 8).collect()}
    topics = len({q for q, _ in good})
    assert len(made) == outcomes["kept"] == topics - outcomes.get("docid_collision", 0)
    assert outcomes["skipped"] == topics * 99
    for r in made:
        assert (r["qid"], r["pos_docid"]) in good and (r["qid"], r["rnd_docid"]) not in good
        assert r["pos_body"] is not None and r["rnd_url"] == "u" + r["rnd_docid"][1:]
    assert sampling.triples(queries, docs, candidates, qrels, 8, limit=2).count() == 2


def test_graded_pairs(spark, pool):
    repeated = spark.createDataFrame([("q1", "d1", 1), ("q1", "d1", 2), ("q2", "d3", 5)], "qid string, docid string, rel int")
    got = rows(sampling.graded_pairs(repeated, pool[0], 7))
    assert got == [("q1", "d1", 2.0, i) for i in (1, 2, 3)] + [("q2", "d3", 5.0, i) for i in (1, 2, 3)]
    assert sampling.graded_pairs(repeated, pool[0], 1).count() == 0


def test_docs_file(spark, tmp_path):
    (tmp_path / "docs.tsv").write_text(
        'd1\thttp://a\tT "x"\tbody "quoted" text  \nd2\thttp://b\ttitle\t\nd3\thttp://c\n', encoding="utf8")
    path = str(tmp_path / "docs.tsv")
    assert rows(trec.read_docs(spark, path)) == [("d1", "http://a", 'T "x"', 'body "quoted" text')]
    assert trec.read_docs(spark, path, num_docs=0).count() == 0


def test_queries_later_file_wins(spark, tmp_path):
    (tmp_path / "train.tsv").write_text('1\told\n2\t"a ""b"" c"\n2\tlast of file\n', encoding="utf8")
    (tmp_path / "dev.tsv").write_text("1\tnew\n3\t5\" pipe\n", encoding="utf8")
    paths = [str(tmp_path / name) for name in ("train.tsv", "dev.tsv")]
    assert rows(trec.read_queries(spark, paths)) == [("1", "new"), ("2", "last of file"), ("3", '5" pipe')]
    plain = rows(trec.read_queries(spark, [str(tmp_path / "train.tsv")], plain=True))
    assert plain == [("1", "old"), ("2", "last of file")]


def test_merged_queries_may_come_from_a_join(spark, tmp_path):
    spark.createDataFrame([("1", "a"), ("2", "b")], "qid string, text string").coalesce(1).write.parquet(str(tmp_path / "q"))
    spark.createDataFrame([("2", "d")], "qid string, docid string").write.parquet(str(tmp_path / "j"))
    queries = trec.placed(spark.read.parquet(str(tmp_path / "q")))
    judged = queries.join(spark.read.parquet(str(tmp_path / "j")), "qid", "left_semi")
    merged = trec.merge_queries([queries, judged.withColumn("text", F.concat("text", F.lit("!")))])
    assert rows(merged) == [("1", "a"), ("2", "b!")]


def test_qrels_checks(spark, tmp_path):
    (tmp_path / "qrels").write_text("1 0 d1 1\n1 0 d2 0\n2 0 d3 3\n", encoding="utf8")
    path = str(tmp_path / "qrels")
    assert rows(trec.read_qrels(spark, path, min_rel=1)) == [("1", "d1", 1), ("2", "d3", 3)]
    with pytest.raises(Exception, match="unexpected grade"):
        trec.read_qrels(spark, path, only_rel=1).collect()


def test_runs_and_metrics(spark, tmp_path):
    run = spark.createDataFrame([("r", "1", "d1", 1, 2.5), ("r", "1", "d2", 4, -1.0)],
                                "run_id string, qid string, docid string, rank int, score double")
    trec.write_run(run, str(tmp_path / "run"))
    assert spark.read.text(str(tmp_path / "run")).first()[0] == "1 Q0 d1 1 2.500000 r"
    assert rows(trec.read_run(spark, str(tmp_path / "run"))) == rows(run)
    (tmp_path / "m.txt").write_text("runid                 \tall\tokapi\nmap                   \t7\t0.1188\n", encoding="utf8")
    assert rows(trec.read_metrics(spark, str(tmp_path / "m.txt"), "okapi")) == [("okapi", "7", "map", 0.1188)]


def test_cached_table(spark):
    path, calls = new_path(spark, "cached"), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    assert trec.cached(spark, path, build).count() == 1
    assert trec.cached(spark, path, build).count() == 1
    assert trec.cached(spark, path, build, force=True).count() == 2
    assert len(calls) == 2


def test_documents_are_met_where_they_lie(spark, pool, monkeypatch):
    queries, docs, candidates, qrels = pool
    kept = {}

    def keep(df, label):
        kept[label] = df
        return table(df, label)

    table = sampling.materialize
    monkeypatch.setattr(sampling, "materialize", keep)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = sampling.triples(queries, docs, candidates, qrels, 8).collect()
        corpus = sampling.sampled_corpus(candidates, docs, 40, 3)
        drawn = rows(corpus)
        for df in (kept["triple-docs"], corpus):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r["docid"] for r in kept["triple-docs"].collect()} == {r[f"{s}_docid"] for r in made for s in ("pos", "rnd")}
    bodies = {r["docid"]: r["body"] for r in docs.collect()}
    assert drawn and all(body == bodies[docid] and body.strip() for docid, _, body in drawn)
    assert sum(copies for _, copies, _ in drawn) <= 40
