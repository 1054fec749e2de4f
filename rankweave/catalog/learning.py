"""Learned rankers and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.catalog.evaluation import labelled
from rankweave.catalog.ranking_features import FEATURE_CTES, QUERY_CTES
from rankweave.catalog.registry import register
from rankweave.catalog.training import sampled_pairs
from rankweave.operators import adarank, clustering, density, models, rerank, sampling
from rankweave.operators.features import QUERY_FEATURES, VECTOR
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.ordering import exact_median
from rankweave.plans import study
from rankweave.plans.workbench import DEPTH, Workbench
from rankweave.session import materialize, new_path
from rankweave.sources import tables

SEED = 7
CLUSTERS = 8
TOPIC_DRAWS = 1000
SWEEP_DRAWS = 20_000


def training_features(w: Workbench, graded: bool = False):
    name = "training-features-graded" if graded else "training-features"
    return w.stage(name, lambda: study.join_features(
        sampled_pairs(w, graded), w.queries, w.docs, w.index, w.pmi))


def query_vectors(w: Workbench):
    return w.query_features.select("qid", F.array(*QUERY_FEATURES).alias("query_features"))


@register("svc_rank", "run_id:s qid:s docid:s rank:i score:d")
def svc_rank(w: Workbench):
    model = models.fit_classifier(training_features(w), seed=SEED)
    return rerank.rerank(models.score(model, w.features, "margin"), "svc", max_depth=DEPTH)


@register("svc_rank_linear", "run_id:s qid:s docid:s rank:i score:d")
def svc_rank_linear(w: Workbench):
    model = models.fit_classifier(training_features(w), kernel=False, seed=SEED)
    return rerank.rerank(models.score(model, w.features, "margin"), "svc", max_depth=DEPTH)


@register("svc_class", "run_id:s qid:s docid:s rank:i score:d")
def svc_class(w: Workbench):
    path = new_path(w.spark, "model")
    models.save_model(models.fit_classifier(training_features(w), seed=SEED), path)
    return rerank.rerank(models.score(models.load_model(path), w.features), "svc", max_depth=DEPTH)


@register("svr_rank", "run_id:s qid:s docid:s rank:i score:d")
def svr_rank(w: Workbench):
    model = models.fit_regressor(training_features(w, graded=True), seed=SEED)
    return rerank.rerank(models.score(model, w.features), "svr", max_depth=DEPTH)


@register("cluster_rank", "run_id:s qid:s docid:s rank:i score:d")
def cluster_rank(w: Workbench):
    rows = training_features(w, graded=True)
    ranker = models.fit_cluster_ranker(rows, query_vectors(w), 3, seed=SEED)
    path = new_path(w.spark, "cluster-ranker")
    ranker.save(path)
    scored = models.ClusterRanker.load(path).score(w.features, query_vectors(w))
    return rerank.rerank(scored, "cluster", max_depth=DEPTH)


def labelled_features(w: Workbench):
    return w.features.join(labelled(w).select("qid", "docid", "label"), ["qid", "docid"])


_WEAK = FEATURE_CTES | {
    "weak": (("long_features", "positives", "candidates"), """
        SELECT r.qid, feat, coalesce(sum(1 / log2(pos + 1)) FILTER (label = 1), 0) / coalesce(max(i.ideal), 1) AS score
        FROM (SELECT f.qid, f.feat, CASE WHEN p.rel IS NULL THEN 0 ELSE 1 END AS label,
                     row_number() OVER (
                         PARTITION BY f.qid, f.feat ORDER BY round(f.value, 6) + 0.0 DESC, f.docid DESC) AS pos
              FROM long_features f LEFT JOIN positives p ON p.qid = f.qid AND p.docid = f.docid) r
        LEFT JOIN (SELECT qid, sum(1 / log2(pos + 1)) AS ideal FROM (
                       SELECT p.qid, row_number() OVER (PARTITION BY p.qid) AS pos
                       FROM positives p JOIN candidates c ON c.qid = p.qid AND c.docid = p.docid) GROUP BY qid) i
            ON i.qid = r.qid
        GROUP BY r.qid, feat"""),
}


@register("adarank_weak", "qid:s feat:i score:d", "SELECT * FROM weak", "weak", extra=_WEAK)
def adarank_weak(w: Workbench):
    return adarank.weak_scores(labelled_features(w), max_depth=DEPTH)


@register("adarank_round", "feat:i avg:d alpha:d", """
    SELECT feat, avg(score) AS avg, 0.5 * ln((1 + avg(score)) / (1 - avg(score))) AS alpha FROM weak GROUP BY feat""",
          "weak", extra=_WEAK)
def adarank_round(w: Workbench):
    return adarank.weighted_choice(adarank.weak_scores(labelled_features(w), max_depth=DEPTH))


# Boosting round by round: a row of the recursion holds the weights of features and queries after that many rounds.
_BOOSTED = _WEAK | {
    "boost_rows": (("long_features", "positives"), """
        SELECT f.qid, f.docid, max(CASE WHEN p.rel IS NULL THEN 0 ELSE 1 END) AS label, list(f.value ORDER BY f.feat) AS x
        FROM long_features f LEFT JOIN positives p ON p.qid = f.qid AND p.docid = f.docid GROUP BY f.qid, f.docid"""),
    "boost_ideal": (("boost_rows",), """
        SELECT qid, sum(1 / log2(pos + 1)) AS ideal FROM (
            SELECT qid, row_number() OVER (PARTITION BY qid) AS pos FROM boost_rows WHERE label = 1) GROUP BY qid"""),
    "boosted": (("weak", "boost_rows", "boost_ideal"), f"""
        WITH RECURSIVE state AS (
            SELECT 0 AS round, list_transform(range({len(VECTOR)}), lambda i: 0.0::DOUBLE) AS alpha, []::BIGINT[] AS used,
                   (SELECT list({{'qid': qid, 'weight': 1 / n}}) FROM (
                        SELECT DISTINCT qid, (SELECT count(DISTINCT qid) FROM weak)::DOUBLE AS n FROM weak)) AS weights,
                   0.0::DOUBLE AS mean
            UNION ALL (
            WITH asked AS (SELECT unnest(weights, recursive := true) FROM state),
            means AS (SELECT k.feat, sum(k.score * a.weight) AS m FROM weak k JOIN asked a ON a.qid = k.qid GROUP BY k.feat),
            choice AS (
                SELECT feat, least(m, {adarank.BEST_SHARE!r}) AS m FROM means
                WHERE NOT list_contains((SELECT used FROM state), feat) ORDER BY round(m, 9) DESC, feat LIMIT 1),
            turned AS (
                SELECT s.round, s.used, c.feat, list_transform(s.alpha, lambda v, i:
                    CASE WHEN i = c.feat + 1 THEN v + 0.5 * ln((1 + c.m) / (1 - c.m)) ELSE v END) AS alpha
                FROM state s, choice c),
            placed AS (
                SELECT r.qid, r.label, row_number() OVER (PARTITION BY r.qid ORDER BY
                    round(list_sum(list_transform(list_zip(r.x, t.alpha), lambda z: z[1] * z[2])), 6) + 0.0 DESC, r.docid DESC) AS pos
                FROM boost_rows r, turned t),
            served AS (
                SELECT p.qid, coalesce(sum(1 / log2(pos + 1)) FILTER (label = 1), 0) / coalesce(max(i.ideal), 1) AS value
                FROM placed p LEFT JOIN boost_ideal i ON i.qid = p.qid GROUP BY p.qid)
            SELECT t.round + 1, t.alpha, list_append(t.used, t.feat::BIGINT),
                   (SELECT list({{'qid': qid, 'weight': exp(-value) / (SELECT sum(exp(-value)) FROM served)}}) FROM served),
                   (SELECT avg(value) FROM served)
            FROM turned t WHERE t.round < {min(adarank.ROUNDS, len(VECTOR))}))
        SELECT CASE WHEN mean > 0 THEN alpha ELSE list_transform(alpha, lambda v: 0.0) END AS alpha
        FROM state WHERE round > 0 ORDER BY round(mean, 9) DESC, round LIMIT 1"""),
}


@register("adarank_weights", "feat:i name:s alpha:d", f"""
    SELECT unnest(range({len(VECTOR)})) AS feat, unnest([{", ".join(f"'{name}'" for name in VECTOR)}]) AS name,
           unnest(alpha) AS alpha FROM boosted""", "boosted", extra=_BOOSTED)
def adarank_weights(w: Workbench):
    alpha = adarank.fit(labelled_features(w), max_depth=DEPTH)
    path = new_path(w.spark, "adarank")
    adarank.save_weights(adarank.weight_table(w.spark, alpha, VECTOR), path)
    return adarank.weight_table(w.spark, adarank.load_weights(w.spark, path), VECTOR)


@register("adarank_rank", "run_id:s qid:s docid:s rank:i score:d", """
    SELECT 'adarank' AS run_id, qid, docid, rank, score FROM (
        SELECT qid, docid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid DESC) AS rank FROM (
            SELECT qid, docid, round(list_sum(list_transform(list_zip(x, alpha), lambda z: z[1] * z[2])), 6) + 0.0 AS score
            FROM boost_rows, boosted))
    WHERE score != 0""", "boost_rows", "boosted", extra=_BOOSTED)
def adarank_rank(w: Workbench):
    alpha = adarank.fit(labelled_features(w), max_depth=DEPTH)
    return rerank.rerank(rerank.linear_score(w.features, alpha), "adarank", max_depth=DEPTH)


_PREDICTED = {
    "predicted": (("candidates", "qrels"), """
        SELECT c.qid, c.docid, round(c.score / 10, 1) AS prediction, CAST(r.rel AS DOUBLE) AS label
        FROM candidates c JOIN qrels r ON r.qid = c.qid AND r.docid = c.docid"""),
    "classified": (("candidates", "qrels"), """
        SELECT CASE WHEN c.score > 20 THEN 1 ELSE 0 END AS prediction, CASE WHEN r.rel > 0 THEN 1 ELSE 0 END AS label
        FROM candidates c JOIN qrels r ON r.qid = c.qid AND r.docid = c.docid"""),
}


def _judged(w: Workbench):
    return w.candidates.select("qid", "docid", "score").join(w.qrels, ["qid", "docid"])


@register("regression_report", "mse:d r2:d median_ae:d exact:d", """
    SELECT avg((prediction - label) ** 2) AS mse,
           1 - avg((prediction - label) ** 2) / var_pop(label) AS r2, median(abs(prediction - label)) AS median_ae,
           avg(CAST(prediction = label AS INTEGER)) AS exact
    FROM predicted""", "predicted", extra=_PREDICTED)
def regression_report(w: Workbench):
    return models.regression_report(_judged(w).select(
        F.round(F.col("score") / 10, 1).alias("prediction"), F.col("rel").cast("double").alias("label")))


@register("accuracy", "accuracy:d", "SELECT avg(CAST(prediction = label AS INTEGER)) AS accuracy FROM classified",
          "classified", extra=_PREDICTED)
def accuracy(w: Workbench):
    return models.accuracy(_judged(w).select(
        (F.col("score") > 20).cast("int").alias("prediction"), (F.col("rel") > 0).cast("int").alias("label")))


_STRENGTH = {
    "dims": ((), """
        SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings"""),
    "centres": (("dims",), "SELECT label, d, avg(x) AS c FROM dims GROUP BY label, d"),
    "distances": (("dims", "centres"), """
        SELECT a.vec_id, a.label, sqrt(sum((a.x - c.c) ** 2)) AS dist
        FROM dims a JOIN centres c ON c.label = a.label AND c.d = a.d GROUP BY a.vec_id, a.label"""),
    "spreads": (("distances",), "SELECT label, avg(dist) AS s FROM distances GROUP BY label"),
}


@register("cluster_report",
          "clusters:i size_min:i size_mean:d size_max:i strength_min:d strength_mean:d strength_max:d", """
    SELECT count(*) AS clusters, min(n) AS size_min, avg(n) AS size_mean, max(n) AS size_max,
           min(m) AS strength_min, avg(m) AS strength_mean, max(m) AS strength_max
    FROM (SELECT label, count(*) AS n, median(norm) AS m FROM (
              SELECT label, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm
              FROM embeddings) GROUP BY label)""")
def cluster_report(w: Workbench):
    norm = F.sqrt(F.aggregate(F.transform("point", lambda x: x * x), F.lit(0.0), lambda total, x: total + x))
    return clustering.cluster_report(tables.points(w.spark, w.folder).select("cluster", norm.alias("strength")))


@register("cluster_medians", "cluster:i median:d", """
    SELECT label AS cluster, median(dist) AS median FROM distances GROUP BY label""", "distances", extra=_STRENGTH)
def cluster_medians(w: Workbench):
    points = tables.points(w.spark, w.folder)
    centres = clustering.centroids(points).select("cluster", "centre")
    gaps = F.zip_with("point", "centre", lambda x, c: (x - c) * (x - c))
    dist = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g))
    placed = lookup_join(points, centres, ["cluster"], ["id"], fits_in_memory(centres))
    return exact_median(placed.select("cluster", dist.alias("dist")), ["cluster"], "dist")


def _lloyd_sql(points: str, *reads: str) -> dict:
    """The clusters of a relation (id, x): seeded points as the start, then rounds of nearest centres and means."""
    return {
        "lloyd_points": (reads, points),
        "lloyd": (("lloyd_points",), f"""
            WITH RECURSIVE state AS (
                SELECT 0 AS round, list(x ORDER BY place) AS centres FROM (
                    SELECT x, row_number() OVER (ORDER BY md5('{SEED}|' || id), id) AS place FROM lloyd_points)
                WHERE place <= {CLUSTERS}
                UNION ALL (
                WITH centres AS (SELECT unnest(centres) AS c, generate_subscripts(centres, 1) AS i FROM state),
                placed AS (
                    SELECT p.id, p.x, arg_min(c.i, list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) ** 2))) AS i
                    FROM lloyd_points p, centres c GROUP BY p.id, p.x),
                moved AS (
                    SELECT i, list(m ORDER BY d) AS c FROM (
                        SELECT i, d, avg(v) AS m FROM (SELECT i, unnest(x) AS v, generate_subscripts(x, 1) AS d FROM placed)
                        GROUP BY i, d) GROUP BY i)
                SELECT max(s.round) + 1, list(coalesce(m.c, c.c) ORDER BY c.i)
                FROM centres c CROSS JOIN state s LEFT JOIN moved m ON m.i = c.i
                HAVING max(s.round) < {clustering.ROUNDS}))
            SELECT centres FROM state ORDER BY round DESC LIMIT 1"""),
        "assigned": (("lloyd_points", "lloyd"), """
            SELECT id, arg_min(i, dist) - 1 AS cluster, sqrt(min(dist)) AS strength FROM (
                SELECT p.id, c.i, list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) ** 2)) AS dist
                FROM lloyd_points p, (SELECT unnest(centres) AS c, generate_subscripts(centres, 1) AS i FROM lloyd) c)
            GROUP BY id"""),
    }


@register("kmeans_assign", "id:i cluster:i strength:d", "SELECT * FROM assigned", "assigned",
          extra=_lloyd_sql("SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings"))
def kmeans_assign(w: Workbench):
    points = tables.points(w.spark, w.folder).drop("cluster")
    return clustering.assign(clustering.lloyd(points, "id", CLUSTERS, SEED), points)


@register("query_clusters", "qid:s cluster:i strength:d", "SELECT id AS qid, cluster, strength FROM assigned", "assigned",
          extra=QUERY_CTES | _lloyd_sql(f"SELECT qid AS id, [{', '.join(QUERY_FEATURES)}] AS x FROM query_features", "query_features"))
def query_clusters(w: Workbench):
    rows = query_vectors(w)
    return clustering.assign(clustering.lloyd(rows, "qid", CLUSTERS, SEED, column="query_features"), rows, "query_features")


@register("kmeans_sizes", "clusters:i points:i")
def kmeans_sizes(w: Workbench):
    """Clusters of the library's own KMeans (seeded by k-means||), and the points in them."""
    points = tables.points(w.spark, w.folder).drop("cluster")
    placed = clustering.kmeans_assign(clustering.kmeans_fit(points, CLUSTERS, SEED), points)
    return placed.agg(F.count_distinct("cluster").alias("clusters"), F.count(F.lit(1)).alias("points"))


@register("k_sweep", "k:i calinski_harabasz:d davies_bouldin:d silhouette:d")
def k_sweep(w: Workbench):
    return clustering.k_sweep(query_vectors(w).withColumnRenamed("query_features", "point"), "qid", draws=SWEEP_DRAWS)


@register("weighted_measures", "calinski_harabasz:d davies_bouldin:d silhouette:d", """
    SELECT (SELECT (sum(n * sq) / (k - 1)) / ((SELECT sum(w * dist * dist) FROM far) / (total - k))
            FROM wide, (SELECT count(*) AS k, sum(n) AS total FROM wide_size) GROUP BY k, total) AS calinski_harabasz,
           (SELECT avg(worst) FROM (
                SELECT a.label, max((a.s + b.s) / m.apart) AS worst FROM spread a JOIN (
                    SELECT x.label AS l1, y.label AS l2, sqrt(sum((x.c - y.c) ** 2)) AS apart
                    FROM mid x JOIN mid y ON y.d = x.d AND y.label != x.label GROUP BY x.label, y.label) m ON m.l1 = a.label
                JOIN spread b ON b.label = m.l2 GROUP BY a.label)) AS davies_bouldin,
           (SELECT sum(w * s) / sum(w) FROM (
                SELECT id, max(w) AS w, CASE WHEN max(n) FILTER (own) = 1 THEN 0 ELSE
                       (min(total / n) FILTER (NOT own) - max(total / (n - 1)) FILTER (own))
                       / greatest(min(total / n) FILTER (NOT own), max(total / (n - 1)) FILTER (own)) END AS s
                FROM (SELECT p.id, p.w, q.label = p.label AS own, sum(q.w) AS n,
                             sum(q.w * list_sum(list_transform(list_zip(p.x, q.x), lambda z: (z[1] - z[2]) ** 2))) AS total
                      FROM heavy p, heavy q GROUP BY p.id, p.w, p.label, q.label) GROUP BY id)) AS silhouette""",
          "wide", "wide_size", "far", "mid", "spread", "heavy", extra={
    "heavy": ((), "SELECT vec_id AS id, label, embedding::DOUBLE[] AS x, 1 + vec_id % 3 AS w FROM embeddings"),
    "flat": (("heavy",), "SELECT id, label, w, unnest(x) AS v, generate_subscripts(x, 1) AS d FROM heavy"),
    "mid": (("flat",), "SELECT label, d, sum(w * v) / sum(w) AS c FROM flat GROUP BY label, d"),
    "far": (("flat", "mid"), """
        SELECT f.id, f.label, f.w, sqrt(sum((f.v - m.c) ** 2)) AS dist FROM flat f JOIN mid m ON m.label = f.label AND m.d = f.d
        GROUP BY f.id, f.label, f.w"""),
    "spread": (("far",), "SELECT label, sum(w * dist) / sum(w) AS s FROM far GROUP BY label"),
    "wide_size": (("heavy",), "SELECT label, sum(w) AS n FROM heavy GROUP BY label"),
    "wide": (("mid", "flat", "wide_size"), """
        SELECT m.label, max(s.n) AS n, sum((m.c - g.c) ** 2) AS sq FROM mid m
        JOIN (SELECT d, sum(w * v) / sum(w) AS c FROM flat GROUP BY d) g ON g.d = m.d JOIN wide_size s ON s.label = m.label
        GROUP BY m.label"""),
})
def weighted_measures(w: Workbench):
    """The three measures of labelled vectors that count one, two or three times."""
    points = materialize(tables.points(w.spark, w.folder).withColumn("times", 1 + F.col("id") % 3), "weighted-points")
    values = [float(measure(points, "times").first()[0]) for measure in (
        clustering.calinski_harabasz, clustering.davies_bouldin, clustering.weighted_silhouette)]
    return w.spark.createDataFrame([tuple(values)], "calinski_harabasz double, davies_bouldin double, silhouette double")


@register("calinski_harabasz", "calinski_harabasz:d", """
    SELECT ((SELECT sum(n * sq) FROM between_c) / (k - 1)) / ((SELECT sum(dist * dist) FROM distances) / (n - k))
           AS calinski_harabasz
    FROM (SELECT count(DISTINCT label) AS k, count(*) AS n FROM embeddings)""", "distances", "between_c",
          extra=_STRENGTH | {"between_c": (("dims", "centres"), """
        SELECT c.label, (SELECT count(*) FROM embeddings e WHERE e.label = c.label) AS n, sum((c.c - g.c) ** 2) AS sq
        FROM centres c JOIN (SELECT d, avg(x) AS c FROM dims GROUP BY d) g ON g.d = c.d GROUP BY c.label""")})
def calinski_harabasz(w: Workbench):
    return clustering.calinski_harabasz(tables.points(w.spark, w.folder))


@register("davies_bouldin", "davies_bouldin:d", """
    SELECT avg(worst) AS davies_bouldin FROM (
        SELECT a.label, max((a.s + b.s) / m.apart) AS worst
        FROM spreads a JOIN (SELECT x.label AS l1, y.label AS l2, sqrt(sum((x.c - y.c) ** 2)) AS apart
                             FROM centres x JOIN centres y ON y.d = x.d AND y.label != x.label
                             GROUP BY x.label, y.label) m ON m.l1 = a.label
        JOIN spreads b ON b.label = m.l2 GROUP BY a.label)""", "spreads", "centres", extra=_STRENGTH)
def davies_bouldin(w: Workbench):
    return clustering.davies_bouldin(tables.points(w.spark, w.folder))


@register("silhouette", "silhouette:d", """
    SELECT avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
        SELECT vec_id, max(n) FILTER (own) AS n, max(total / (n - 1)) FILTER (own) AS a,
               min(total / n) FILTER (NOT own) AS b
        FROM (SELECT p.vec_id, q.label = p.label AS own, count(*) AS n,
                     sum(list_sum(list_transform(list_zip(p.embedding, q.embedding),
                         lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))) AS total
              FROM embeddings p, embeddings q GROUP BY p.vec_id, p.label, q.label)
        GROUP BY vec_id)""")
def silhouette(w: Workbench):
    value = clustering.silhouette(tables.points(w.spark, w.folder))
    return w.spark.createDataFrame([(float(value),)], "silhouette double")


# The distance within which points are near, and how many make a core point.
EPS, MIN_POINTS = 1.15, 5


@register("density_clusters", "id:i kind:s cluster:i", f"""
    SELECT e.vec_id AS id,
           CASE WHEN c.id IS NOT NULL THEN 'core' WHEN b.id IS NOT NULL THEN 'border' ELSE 'noise' END AS kind,
           coalesce(c.cluster, b.cluster) AS cluster
    FROM embeddings e LEFT JOIN named c ON c.id = e.vec_id LEFT JOIN (
        SELECT n.a AS id, min_by(c.cluster, n.b) AS cluster FROM near n JOIN named c ON c.id = n.b GROUP BY n.a) b
        ON b.id = e.vec_id""", "near", "named", extra={
    "near": ((), f"""
        SELECT p.vec_id AS a, q.vec_id AS b FROM embeddings p, embeddings q
        WHERE list_sum(list_transform(list_zip(p.embedding, q.embedding),
                                      lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2)) <= {EPS} * {EPS}"""),
    "core": (("near",), f"SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_POINTS}"),
    "named": (("near", "core"), """
        SELECT id, min(root) AS cluster FROM (
            WITH RECURSIVE reach AS (
                SELECT id, id AS root FROM core
                UNION SELECT n.b, r.root FROM reach r JOIN near n ON n.a = r.id JOIN core c ON c.id = n.b)
            SELECT * FROM reach) GROUP BY id"""),
})
def density_clusters(w: Workbench):
    points = tables.points(w.spark, w.folder).select("id", "point")
    return density.density_clusters(points, EPS, MIN_POINTS)


@register("svr_quality", "part:s measure:s value:d")
def svr_quality(w: Workbench):
    return study.fit_quality(training_features(w, graded=True), graded=True)


@register("svc_quality", "part:s measure:s value:d")
def svc_quality(w: Workbench):
    return study.fit_quality(training_features(w), graded=False)


def _study(w: Workbench, model: str, **options):
    train, _ = sampling.split(w.queries, "qid", 0.25, SEED)
    return study.train_and_evaluate(
        model, train, w.queries, w.qrels, w.candidates, w.docs, w.index, w.pmi, max_depth=DEPTH, **options)


@register("train_and_evaluate", "run_id:s qid:s metric:s value:d")
def train_and_evaluate(w: Workbench):
    return _study(w, "svc")


@register("study_classes", "run_id:s qid:s metric:s value:d")
def study_classes(w: Workbench):
    """Ranks by the classifier's class, with a share of the first score."""
    return _study(w, "svc", classes=True, fused=True)


@register("study_clusters", "run_id:s qid:s metric:s value:d")
def study_clusters(w: Workbench):
    """One regressor per cluster of queries, with a share of the first score."""
    return _study(w, "cluster", fused=True, clusters=3)


@register("study_adarank", "run_id:s qid:s metric:s value:d")
def study_adarank(w: Workbench):
    """AdaRank on drawn topics, documents without a body left out."""
    return _study(w, "adarank", topics=TOPIC_DRAWS)
