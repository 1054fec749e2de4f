import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from rankweave.functions import scoring
from rankweave.operators import blocks, cooccurrence, index, joins, search
from rankweave.operators.features import FIELD_FEATURES, VECTOR, pair_features, query_features
from rankweave.operators.search import query_terms
from rankweave.session import new_path
from rankweave.streaming.ingest import index_new_files


@pytest.fixture(scope="module")
def built(micro):
    return index.build_index(micro[0])


def stats_of(ix):
    return sorted(tuple(r) for r in ix.term_stats().select("field", "term", "df", "cf").collect())


def as_map(run):
    return {(r["qid"], r["docid"]): r["score"] for r in run.collect()}


# Six-digit values worked out by hand: N = 3, 12 tokens, average length 4.
OKAPI = {("q1", "d1"): 0.962980, ("q1", "d2"): 0.509728, ("q1", "d3"): 0.336613, ("q2", "d2"): 0.509728,
         ("q2", "d3"): 0.488780}
SMOOTHED = {("q1", "d1"): 2.375000, ("q1", "d2"): 1.257143, ("q1", "d3"): 0.830189, ("q2", "d2"): 1.257143,
            ("q2", "d3"): 1.205479}


@pytest.mark.parametrize("scorer, expected", [(scoring.okapi, OKAPI), (scoring.smoothed, SMOOTHED)])
def test_scores(micro, built, scorer, expected):
    assert as_map(search.search(micro[1], built, scorer, mode="or")) == expected


def test_all_terms_required(micro, built):
    strict = as_map(search.search(micro[1], built))
    assert set(strict) == {("q1", "d1"), ("q2", "d2"), ("q2", "d3")}
    assert set(strict) <= set(as_map(search.search(micro[1], built, mode="or")))


def test_depth_ranks_and_ties(spark, micro):
    docs = spark.createDataFrame(
        [(f"d{i}", "u", "t", "alpha beta") for i in range(9)] + [("z", "u", "t", "gamma")],
        "docid string, url string, title string, body string")
    queries = spark.createDataFrame([("q", "alpha")], "qid string, text string")
    ix = index.build_index(docs)
    for k in (3, 2000):
        got = [(r["rank"], r["docid"]) for r in search.search(queries, ix, k=k).orderBy("rank").collect()]
        assert got == [(i + 1, f"d{8 - i}") for i in range(min(k, 9))]


def test_unknown_term_blocks_and_mode(spark, built):
    queries = spark.createDataFrame([("q", "solar nonsense")], "qid string, text string")
    assert search.search(queries, built).count() == 0
    assert search.search(queries, built, mode="or").count() == 2
    with pytest.raises(ValueError):
        search.search(queries, built, mode="xor")


@pytest.fixture(scope="module")
def skewed(spark):
    """Documents that all hold one word, one document with every word, and queries of mixed rarity."""
    draw = random.Random(5)
    words = [f"word{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(["common", *draw.sample(words, draw.randint(1, 6))]) for _ in range(120)] + [" ".join(["common", *words])]
    docs = spark.createDataFrame([(f"d{i:03}", "u", "t", t) for i, t in enumerate(texts)], "docid string, url string, title string, body string")
    asked = [" ".join(["common", *draw.sample(words, draw.randint(0, 5)), *["nowhere"] * (i % 3 == 0)]) for i in range(40)]
    queries = spark.createDataFrame([(f"q{i:02}", t) for i, t in enumerate(asked)], "qid string, text string")
    return docs, queries, index.build_index(docs)


@pytest.mark.parametrize("mode", ["and", 2, 3, 5])
@pytest.mark.parametrize("fits", [True, False])
def test_every_way_of_matching_gives_the_same_run(skewed, monkeypatch, mode, fits):
    _, queries, ix = skewed
    plan = search.planned
    if not fits:
        monkeypatch.setattr(search, "fits_in_memory", lambda *a, **k: False)
    runs = {}
    for name, way in (("chosen", None), ("direct", F.lit(False)), ("lookup", F.lit(True))):
        monkeypatch.setattr(search, "planned", lambda w, d, way=way: plan(w, d) if way is None else plan(w, d).withColumn("_lookup", way))
        runs[name] = as_map(search.search(queries, ix, k=50, mode=mode))
    anything = search.score_matches(search.matches(queries, ix), ix, {"okapi": scoring.okapi}, mode)
    assert runs["chosen"] == runs["direct"] == runs["lookup"] and runs["chosen"]
    assert set(runs["chosen"]) <= {(r.qid, r.docid) for r in anything.collect()}


@pytest.mark.parametrize("mode", ["and", 2, 5])
@pytest.mark.parametrize("k", [2, 50])
def test_scores_added_up_in_blocks_give_the_same_run(spark, skewed, monkeypatch, mode, k):
    docs, queries, _ = skewed
    odd = [("d000", "u", "t", "common worda worda wordb"), (None, "u", "t", "common worda"), (None, "u", "t", "common wordb wordb")]
    ix = index.build_index(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    again = [("q00", "common worda wordb wordc wordd"), (None, "common worda"), ("q40", "common worda"), ("q40", "common wordb")]
    queries = queries.unionByName(spark.createDataFrame(again, queries.schema))
    plan = search.planned
    monkeypatch.setattr(search, "planned", lambda w, d: plan(w, d).withColumn("_lookup", F.coalesce(F.col("qid") == "q01", F.lit(False))))
    rows = lambda: sorted(search.search(queries, ix, k=k, mode=mode).drop("run_id").collect(), key=str)
    expected = rows()
    monkeypatch.setattr(search, "BLOCK_MATCHES", 0)
    monkeypatch.setattr(blocks, "BLOCK_POSTINGS", 100)
    monkeypatch.setattr(blocks, "CHUNK_TERMS", 60)
    asked, called = search._planned_matches, []
    monkeypatch.setattr(search, "_planned_matches", lambda w, *a: called.append(w.select("qid").distinct().count()) or asked(w, *a))
    assert rows() == expected and len(expected) > 20
    assert sum(called) <= 2  # one that is looked up, and one whose texts differ in length


@pytest.mark.parametrize("mode", ["and", 2, 5])
def test_no_query_makes_more_rows_than_taking_all_postings(skewed, mode):
    _, queries, ix = skewed
    terms = search.query_terms(queries)
    weighted = search._weighted(terms, True, ix, "body")
    rows = search.planned(weighted, search.wanted_share(mode)).collect()
    postings = {(r.docid, r.term) for r in ix.field("body").collect()}
    ways = set()
    for qid in {r.qid for r in rows}:
        mine = [r for r in rows if r.qid == qid]
        ways.add(mine[0]["_lookup"])
        if mine[0]["_lookup"]:
            anchors = {r.term for r in mine if r["_anchor"]}
            anchored = [d for d, t in postings if t in anchors]
            held = len(anchored) + len(set(anchored)) * len(mine)
            assert held < sum(r.df for r in mine)
    assert ways == {True, False} if mode != 5 else False in ways


@pytest.mark.parametrize("mode", ["or", 5])
def test_matches_of_shared_terms_are_not_shuffled(skewed, monkeypatch, mode):
    _, queries, ix = skewed
    plan = search.planned
    monkeypatch.setattr(search, "planned", lambda w, d: plan(w, d).withColumn("_lookup", F.lit(False)))
    runs = []
    for shared, moved in ((search.SHARED, ["docid"]), (10**9, ["docid", "qid"])):
        monkeypatch.setattr(search, "SHARED", shared)
        scored = search.score_matches(search.matches(queries, ix, mode=mode), ix, {"okapi": scoring.okapi}, mode)
        steps = scored._jdf.queryExecution().executedPlan().toString().splitlines()
        keys = [re.findall(r"(\w+)#", s.split("hashpartitioning(")[1]) for s in steps if "hashpartitioning(" in s]
        assert [sorted(k) for k in keys if "docid" in k] == [moved]
        runs.append(as_map(scored))
    assert runs[0] == runs[1] and runs[0]


def test_salted_join_equals_broadcast(spark):
    big = spark.range(500).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        both = [sorted(map(str, joins.lookup_join(big, small, ["k"], ["v"], fits, how).collect()))
                for fits in (True, False)]
        assert both[0] == both[1]


def test_only_frequent_keys_are_cut_and_copies_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "FREQUENT_ROWS", 100)
    big = spark.range(500).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.when(F.col("id") % 7 > 0, F.col("id").cast(
        "string"))).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3), (None, 4)], "k string, w int")
    often = joins.frequent_keys(big.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"], "n")
    assert [r["k"] for r in often.collect()] == ["hot"]
    for how in ("inner", "left", "left_semi", "left_anti"):
        cut = joins.lookup_join(big, small, ["k"], ["v"], False, how, frequent=often)
        whole = joins.lookup_join(big, small, ["k"], ["v"], True, how)
        assert cut.columns == whole.columns and sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    plan = joins.lookup_join(big, small, ["k"], ["v"], False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("limit", [0, 100_000])
def test_search_without_broadcast(micro, built, monkeypatch, limit):
    monkeypatch.setattr(joins, "FREQUENT_ROWS", limit)
    monkeypatch.setattr(search, "fits_in_memory", lambda *a, **k: False)
    assert as_map(search.search(micro[1], built, mode="or")) == OKAPI


def test_size_check(spark):
    assert joins.fits_in_memory(spark.range(10), max_rows=10)
    assert not joins.fits_in_memory(spark.range(11), max_rows=10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not joins.fits_in_memory(wide, max_bytes=5000)


def test_counts_agree(built):
    tf = built.postings.groupBy("field").agg(F.sum("tf")).collect()
    cf = built.term_stats().groupBy("field").agg(F.sum("cf")).collect()
    dl = built.doc_len().groupBy("field").agg(F.sum("dl")).collect()
    assert sorted(map(tuple, tf)) == sorted(map(tuple, cf)) == sorted(map(tuple, dl))
    assert built.totals()["body"] == index.FieldTotals(3, 12)
    assert built.totals()["body"].avg_len == 4


def test_matched_terms(micro, built):
    run = search.search(micro[1], built, mode="or")
    got = {(r["qid"], r["docid"]): r["terms"] for r in search.matched_terms(micro[1], built, run).collect()}
    assert got[("q1", "d1")] == "panel solar" and got[("q1", "d2")] == "solar"


def test_positions_of_terms(micro):
    rows = index.build_postings(micro[0], ("body",), with_positions=True).collect()
    assert {(r["docid"], r["term"]): r["positions"] for r in rows}[("d1", "panel")] == [1, 3]


def test_append_repeat_and_stream(spark, micro):
    docs = micro[0]
    path = new_path(spark, "append")
    index.write_index(docs.filter("docid = 'd1'"), path)
    index.append_documents(path, docs, "b1")
    whole = stats_of(index.build_index(docs))
    assert stats_of(index.read_index(spark, path)) == whole
    assert stats_of(index.append_documents(path, docs, "b1")) == whole
    assert stats_of(index.append_documents(path, docs.filter("docid = 'd2'"), "b2")) == whole

    source, streamed, state = (new_path(spark, name) for name in ("in", "streamed", "state"))
    index.clear_index(spark, streamed)
    assert index.read_index(spark, streamed).docs.count() == 0
    for part in ("d1", "d2", "d3"):
        docs.filter(F.col("docid") == part).coalesce(1).write.mode("append").parquet(source)
        index_new_files(spark, source, streamed, state).awaitTermination()
    assert stats_of(index.read_index(spark, streamed)) == whole


def test_half_written_batch_is_replaced(spark, micro):
    docs = micro[0]
    path = new_path(spark, "broken")
    index.write_index(docs.filter("docid = 'd1'"), path)
    # The postings of a batch exist, its id list does not.
    lost = index.build_postings(docs.filter("docid = 'd2'"))
    lost.write.partitionBy("field").parquet(f"{path}/postings/batch=b1")
    assert stats_of(index.append_documents(path, docs, "b1")) == stats_of(index.build_index(docs))


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def rows_of(ix):
    return sorted(tuple(r) for r in ix.postings.select("field", "docid", "term", "tf", "dl").collect())


def test_upsert_field(spark, micro):
    docs = micro[0]
    path = new_path(spark, "old")
    index.write_index(docs, path, ("body", "title"))
    first = docs.withColumn("title", F.lit("fresh words"))
    got = index.upsert_field(path, first.filter("docid != 'd3'"), "title", "u1")
    titles = {r["term"]: r["df"] for r in got.term_stats().filter("field = 'title'").collect()}
    assert titles == {"fresh": 2, "words": 2}
    assert got.docs.count() == 3

    # A second replacement, a new document, a repeat of either batch: the same as an index built from the final texts.
    added = spark.createDataFrame([("d9", "u", "late title", "")], docs.schema)
    second = docs.filter("docid = 'd1'").withColumn("title", F.lit("last title")).unionByName(added)
    whole = docs.withColumn("title", F.expr("CASE docid WHEN 'd1' THEN 'last title' WHEN 'd2' THEN 'fresh words' ELSE title END"))
    wanted = index.build_index(whole.unionByName(added), ("body", "title"))
    for _ in range(2):
        got = index.upsert_field(path, second, "title", "u2")
        assert rows_of(got) == rows_of(wanted) and stats_of(got) == stats_of(wanted)
        assert sorted(map(tuple, got.doc_len().collect())) == sorted(map(tuple, wanted.doc_len().collect()))
        assert sorted(map(tuple, got.field_stats().collect())) == sorted(map(tuple, wanted.field_stats().collect()))
    compact = index.compact_index(path, new_path(spark, "compact"), spark)
    assert rows_of(compact) == rows_of(wanted) and stats_of(compact) == stats_of(wanted)
    queries = spark.createDataFrame([("q", "title fresh cost")], "qid string, text string")
    for field in ("title", "body"):
        runs = [as_map(search.search(queries, ix, mode="or", field=field)) for ix in (got, compact, wanted)]
        assert runs[0] == runs[1] == runs[2] and runs[0]


def test_an_upsert_writes_the_field_only(spark):
    """The body, here 100 times the title, is not written again; dead rows go with a broadcast or through a shuffle."""
    words = [f"word{i}" for i in range(400)]
    docs = spark.createDataFrame([(f"d{i}", "u", "old title", " ".join(random.Random(i).sample(words, 200))) for i in range(60)],
                                 "docid string, url string, title string, body string")
    path = new_path(spark, "large")
    index.write_index(docs, path, ("body", "title"))
    before = size_of(path.removeprefix("file:"))
    index.upsert_field(path, docs.withColumn("title", F.lit("new title")), "title", "u")
    written = sum(size_of(f"{path.removeprefix('file:')}/{t}/batch=u") for t in ("postings", "term_parts", "doc_lens", "docs", "replaced"))
    assert 0 < written < before / 3


def test_dead_rows_without_broadcast(spark, micro, monkeypatch):
    path = new_path(spark, "dead")
    index.write_index(micro[0], path)
    monkeypatch.setattr(index, "fits_in_memory", lambda *a, **k: False)
    got = index.upsert_field(path, micro[0].withColumn("title", F.lit("panel")), "title", "u")
    assert rows_of(got) == rows_of(index.build_index(micro[0].withColumn("title", F.lit("panel"))))


def test_drawn_pmi_counts_a_document_as_often_as_it_was_drawn(spark, micro):
    corpus = micro[0].select("docid", F.expr("CASE docid WHEN 'd1' THEN 3L WHEN 'd2' THEN 1L ELSE 2L END").alias("copies"), "body")
    copied = corpus.select(F.explode(F.sequence(F.lit(1), "copies")).alias("i"), F.concat_ws("-", "docid", "i").alias("docid"), "body")
    got, wanted = cooccurrence.drawn_pmi(corpus), cooccurrence.corpus_pmi(copied)
    assert {(r.t1, r.t2): (r.n, round(r.pmi, 9)) for r in got.collect()} == {(r.t1, r.t2): (r.n, round(r.pmi, 9)) for r in wanted.collect()}


def test_query_search_and_transfer(spark, micro, built):
    pairs = spark.createDataFrame([("p1", "x1", 4), ("p2", "x2", 2), ("p3", "x1", 1)], "qid string, pid string, rel int")
    asked = spark.createDataFrame([("p1", "solar"), ("p2", "energy"), ("p3", "nothing here")], "qid string, text string")
    shown = spark.createDataFrame([("x1", "panel cost"), ("x2", "energy policy")], "pid string, text string")
    queries = search.query_index(micro[1])
    got = search.transfer_judgments(pairs, asked, shown, queries, built, mode="or").collect()
    # p1: one near query (q1), two near documents: the shorter list decides. p3 finds no query.
    assert sorted(map(tuple, got)) == [("q1", "d1", 4), ("q2", "d3", 2)]


def test_pmi(micro, built):
    got = {(r["t1"], r["t2"]): round(r["pmi"], 6) for r in cooccurrence.corpus_pmi(micro[0]).collect()}
    assert got == {
        ("solar", "panel"): 0.693147, ("solar", "energy"): 0.693147, ("panel", "cost"): 1.386294,
        ("cost", "panel"): 1.386294, ("panel", "discussion"): 1.386294, ("discussion", "over"): 2.484907,
        ("over", "energy"): 1.386294, ("energy", "policy"): 1.386294, ("policy", "energy"): 1.386294,
    }
    terms = query_terms(micro[1]).select("term").distinct()
    for fits in (True, False):
        part = cooccurrence.vocabulary_pmi(micro[0], built, terms, fits)
        kept = {(r["t1"], r["t2"]): round(r["pmi"], 6) for r in part.collect()}
        assert kept == {pair: v for pair, v in got.items() if pair[0] in ("solar", "panel", "energy")}


def test_body_features(micro, built):
    docs, queries = micro
    pairs = queries.filter("qid = 'q1'").select("qid", F.lit("d1").alias("docid"))
    got = pair_features(pairs, queries, docs, built, use_title=False).first()["features"]
    expected = [
        0.916291, 0, 0, 0.628609, 0.318454, 0.271934, 0.393048, -0.170969, 1.098612, 0, 0, 0.693147, 0.405465, 0.318454,
        0.443091, -0.118301, 1.386294, 0, 0, 1.011601, 0.559616, 0.485508, 0.674464, -0.377321, 0.104735, 0.080119]
    assert len(got) == len(FIELD_FEATURES)
    assert got == pytest.approx(expected, abs=1e-6)


def test_whole_vector_against_loops(spark, micro, built):
    """Pairs of every query and document, PMI by two plain loops."""
    docs, queries = micro
    pmi_table = cooccurrence.corpus_pmi(docs)
    pmi = {(r["t1"], r["t2"]): r["pmi"] for r in pmi_table.collect()}
    pairs = spark.createDataFrame([(q, d) for q in ("q1", "q2") for d in ("d1", "d2", "d3")] + [("q1", "gone")],
                                  "qid string, docid string")
    rows = {(r["qid"], r["docid"]): r["features"] for r in
            pair_features(pairs, queries, docs, built, pmi_table).collect()}
    assert len(rows) == 6
    query_text = {r["qid"]: r["text"].split() for r in queries.collect()}
    tokens = {}
    for r in index.field_tokens(docs).collect():
        tokens[r["docid"], r["field"]] = r["tokens"]

    def signed(x):
        return math.log(x + 1) if x > 0 else -math.log(1 - x)

    for (qid, docid), vector in rows.items():
        named = dict(zip(VECTOR, vector, strict=True))
        for field in index.FIELDS:
            scores = [pmi.get((t, x), -20.0) for t in query_text[qid] for x in tokens[docid, field]]
            wanted = [sum(scores), max(scores), sum(scores) / len(scores)] if scores else [0, 0, 0]
            got = [named[f"pmi_{how}_{field}"] for how in ("sum", "max", "mean")]
            assert got == pytest.approx([signed(x) for x in wanted], abs=1e-9)
            if not set(query_text[qid]) & set(tokens[docid, field]):
                assert all(named[f"{field}_{name}"] == 0 for name in FIELD_FEATURES)
            assert named[f"len_{field}"] == pytest.approx(math.log(1 + len(tokens[docid, field])))


def test_query_features_against_loops(spark, micro, built):
    docs, _ = micro
    queries = spark.createDataFrame(
        [("a", "solar solar energy"), ("b", "absent panel"), ("none", "the")], "qid string, text string")
    pmi_table = cooccurrence.corpus_pmi(docs)
    pmi = {(r["t1"], r["t2"]): r["pmi"] for r in pmi_table.collect()}
    stats = {r["term"]: (r["df"], r["cf"]) for r in built.term_stats().filter("field = 'body'").collect()}
    rows = {r["qid"]: list(r)[1:] for r in query_features(queries, built, pmi_table).collect()}
    assert set(rows) == {"a", "b"}

    def signed(x):
        return math.log(x + 1) if x > 0 else -math.log(1 - x)

    for qid, words in (("a", ["solar", "solar", "energy"]), ("b", ["absent", "panel"])):
        table = []
        for word in words:
            df, cf = stats.get(word, (0, 0))
            idf = math.log(3 / (df + 1))
            table.append([idf, cf + 1, (cf + 1) * idf, 3 / (cf + 1), sum(pmi.get((word, x), -20.0) for x in words)])
        columns = list(zip(*table, strict=True))
        wanted = [sum(c) / len(words) for c in columns] + [max(c) for c in columns] + [sum(c) for c in columns]
        wanted.append(math.log(len(words) + 1))
        assert rows[qid] == pytest.approx([signed(x) for x in wanted], abs=1e-9)


def test_features_without_broadcast(micro, built, monkeypatch):
    from rankweave.operators import features

    docs, queries = micro
    pmi_table = cooccurrence.corpus_pmi(docs)
    pairs = queries.select("qid", F.explode(F.array(*[F.lit(d) for d in ("d1", "d2", "d3")])).alias("docid"))

    def vectors():
        rows = pair_features(pairs, queries, docs, built, pmi_table).collect()
        asked = query_features(queries, built, pmi_table).collect()
        return ({(r["qid"], r["docid"]): r["features"] for r in rows}, {r["qid"]: list(r)[1:] for r in asked})

    small = vectors()
    monkeypatch.setattr(features, "fits_in_memory", lambda *a, **k: False)
    large = vectors()
    for one, two in zip(small, large, strict=True):
        assert one.keys() == two.keys()
        for key in one:
            assert one[key] == pytest.approx(two[key], abs=1e-9)


def exchanges(df):
    return len(re.findall(r"Exchange \w*(?:hash|range|Round)", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("stem", [False, True])
def test_text_is_shuffled_once_and_in_parts_of_its_size(spark, micro, monkeypatch, stem):
    docs = spark.createDataFrame(
        [(f"d{i % 30}", "http://a.b", "panels", "running panels. runs running") for i in range(40)] + [("e", None, "", None)],
        "docid string, url string, title string, body string")
    whole = index.build_postings(docs, stem=stem)
    rows = sorted(tuple(r) for r in whole.collect())
    size = sum(len(r[n].encode()) for r in docs.collect() for n in ("url", "title", "body") if r[n])
    monkeypatch.setattr(index, "TEXT_PART", 100)
    small = index.build_postings(docs, stem=stem)
    assert exchanges(small) == 1
    assert small.rdd.getNumPartitions() == math.ceil(size / 100)
    assert sorted(tuple(r) for r in small.collect()) == rows
    body = {(r["docid"], r["term"]): (r["dl"], r["tf"]) for r in whole.filter("field = 'body'").collect()}
    # documents d0 to d9 have two rows of equal length, which count together
    assert body["d0", "run" if stem else "running"] == (4, 6 if stem else 4)
    assert body["d20", "run" if stem else "running"] == (4, 3 if stem else 2)
