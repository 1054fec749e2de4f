"""Training, re-ranking and evaluation of a ranker as one job chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.operators import adarank, features, measures, models, rerank, sampling
from rankweave.operators.index import Index
from rankweave.session import materialize

# Rows drawn for training and graded rows added, unless asked otherwise.
NUM_PAIRS = 25_000
NUM_GRADED = 25_000
# Clusters of the clustered ranker.
CLUSTERS = 8


def join_features(rows: DataFrame, queries: DataFrame, docs: DataFrame, index: Index, pmi: DataFrame) -> DataFrame:
    """`rows(qid, docid, ...)` with their feature vectors, which are computed once per distinct pair."""
    vectors = features.pair_features(rows, queries, docs, index, pmi)
    return rows.join(vectors, ["qid", "docid"])


def query_vectors(queries: DataFrame, index: Index, pmi: DataFrame) -> DataFrame:
    """(qid, query_features) as one array per query."""
    named = features.query_features(queries, index, pmi)
    return named.select("qid", F.array(*features.QUERY_FEATURES).alias("query_features"))


def train_and_evaluate(model: str, train_queries: DataFrame, queries: DataFrame, qrels: DataFrame,
                       candidates: DataFrame, docs: DataFrame, index: Index, pmi: DataFrame,
                       num_pairs: int = NUM_PAIRS, num_graded: int = NUM_GRADED, seed: int = 7,
                       max_depth: int | None = None, classes: bool = False, fused: bool = False,
                       clusters: int = CLUSTERS, topics: int | None = None) -> DataFrame:
    """Fit `model` (svc, svr, cluster or adarank) on `train_queries`, re-rank all candidates and evaluate the run.

    `classes` ranks by the class of the classifier instead of its margin, `fused` adds a share of the first score.
    `topics` lets AdaRank train on so many draws of training queries, with replacement; documents without a body are
    left out of its training lists then.
    """
    if model not in ("svc", "svr", "cluster", "adarank"):
        raise ValueError(f"unknown model {model!r}")
    own = qrels.join(train_queries.select("qid"), "qid", "left_semi")
    vectors = materialize(features.pair_features(candidates, queries, docs, index, pmi), "study-features")
    if model == "adarank":
        good = sampling.positives(own).select("qid", "docid")
        asked = train_queries.select("qid")
        trained = vectors
        if topics is not None:
            asked = sampling.sample_rows(asked, "qid", topics, seed).select("qid").distinct()
            bodies = docs.filter(F.length(F.rtrim("body")) > 0).select("docid")
            trained = trained.join(bodies, "docid", "left_semi")
        trained = trained.join(asked, "qid", "left_semi")
        alpha = adarank.fit(_labelled(trained, good), max_depth=max_depth)
        scored = rerank.linear_score(vectors, alpha)
    else:
        graded = model != "svc"
        pairs = materialize(sampling.train_pairs(
            train_queries, own, candidates, docs, num_pairs, seed, graded, bounded=max_depth is not None), "study-pairs")
        extra = sampling.graded_pairs(own, train_queries, num_graded) if graded else None
        rows = materialize(join_features(sampling.training_rows(pairs, extra), queries, docs, index, pmi), "study-rows")
        if model == "cluster":
            asked = materialize(query_vectors(queries, index, pmi), "study-queries")
            scored = models.fit_cluster_ranker(rows, asked, clusters, seed=seed).score(vectors, asked)
        else:
            fit = models.fit_regressor if graded else models.fit_classifier
            scored = models.score(fit(rows, seed=seed), vectors, "value" if graded or classes else "margin")
    if fused:
        scored = rerank.fuse(scored, candidates)
    run = materialize(rerank.rerank(scored, model, max_depth), "study-run")
    return measures.evaluate(run, qrels, max_depth, run_id=model)


def fit_quality(rows: DataFrame, graded: bool, test_share: float = 0.1, seed: int = 7) -> DataFrame:
    """(part, measure, value) of a model fitted on nine tenths of the training rows, for both parts.

    A regressor is measured by squared error, R2 and median absolute error, a classifier by accuracy. All rows of
    a pair are on one side. The part `fit` tells whether the solver settled (`converged`, 1 or 0), after how many `steps`, at
    which `objective` and with which `gradient_norm`.
    """
    keyed = rows.withColumn("pair", F.concat_ws(" ", "qid", "docid"))
    train, test = (materialize(part, "quality-rows") for part in sampling.split(keyed, "pair", test_share, seed))
    model = (models.fit_regressor if graded else models.fit_classifier)(train, seed=seed)
    out = None
    for name, part in (("train", train), ("test", test)):
        predicted = model.transform(models.with_vector(part)).select("prediction", F.col("label").cast("double").alias("label"))
        report = models.regression_report(predicted) if graded else models.accuracy(predicted)
        wide = report.select(F.lit(name).alias("part"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in report.columns])))
        out = wide if out is None else out.unionByName(wide)
    return out.unionByName(rows.sparkSession.createDataFrame(models.solver_report(model), "measure string, value double").select(
        F.lit("fit").alias("part"), "measure", "value"))


def _labelled(vectors: DataFrame, good: DataFrame) -> DataFrame:
    hits = good.withColumn("label", F.lit(1))
    return vectors.join(hits, ["qid", "docid"], "left").fillna(0, ["label"])
