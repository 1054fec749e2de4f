"""Registered queries against their SQL forms on the smallest tables, and the contract of the entry module."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from rankweave.operators import measures, sampling
from rankweave.plans import study
from rankweave.plans.workbench import DEPTH, Workbench

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
CHECKED = (
    "tokens", "tokens_url", "url_statics", "ngrams", "stems", "postings", "term_stats", "field_stats", "pmi",
    "bm25_top10", "bm25_or_top10", "bm25_lib_top10", "bm25_plain_top10", "plain_term_stats", "matched_terms", "scorer_compare",
    "judgment_transfer", "features_title", "features_pmi", "features_static", "query_features", "linear_rank",
    "score_fusion", "ev_counts", "ev_bpref", "ev_iprec", "ev_ndcg", "ev_pooled_ndcg", "win_count", "err_too_low",
    "err_worst_first", "triples", "train_pairs_graded", "qrel_lists", "src_docs", "trec_lines", "adarank_round",
    "pmi_corpus", "term_pairs", "shared_terms", "bm25_scores", "num_docs", "first_triples", "passage_to_doc", "group_summary",
    "calinski_harabasz", "davies_bouldin", "silhouette", "density_clusters",
    "kmeans_assign", "query_clusters", "pmi_drawn", "upserted_postings", "index_compact", "feature_cache", "weighted_measures", "cluster_report", "regression_report", "index_append",
)


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in sorted(os.listdir(FOLDER)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(row[i]) for i in places) for row in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, database, name):
    df = entry_module.queries()[name](spark, FOLDER)
    result = database.execute(entry_module.oracle_sql()[name])
    wanted = ordered([c[0] for c in result.description], result.fetchall())
    got = ordered(df.columns, df.collect())
    assert got[1], "no rows"
    assert got == wanted


def test_contract(spark):
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries)
    assert entry_module.entry(spark).columns == ["qid", "docid", "rank", "score"]


def test_trained_ranker_beats_a_random_order(spark):
    w = Workbench.of(spark, FOLDER)
    train, test = sampling.split(w.queries, "qid", 0.5, 1)
    judged = w.qrels.join(test.select("qid"), "qid", "left_semi")
    shuffled = w.candidates.withColumn("score", F.conv(F.substring(F.md5(F.concat("qid", "docid")), 1, 8), 16, 10).cast("double"))
    base = measures.evaluate(shuffled, judged, DEPTH, ["ndcg_cut_10"]).filter("qid = 'all'").first()["value"]
    rows = study.train_and_evaluate(
        "svc", train, w.queries, w.qrels, w.candidates, w.docs, w.index, w.pmi, num_pairs=400, max_depth=DEPTH)
    held_out = rows.join(judged.select("qid"), "qid", "left_semi").filter(F.col("metric") == "ndcg_cut_10")
    assert held_out.agg(F.avg("value")).first()[0] > base
    with pytest.raises(ValueError):
        study.train_and_evaluate("odd", train, w.queries, w.qrels, w.candidates, w.docs, w.index, w.pmi)
