"""Clusters of points and measures of their quality."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.draws import draw
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.models import with_vector
from rankweave.operators.ordering import exact_median
from rankweave.operators.sampling import sample_rows, split
from rankweave.operators.vectors import as_matrix, nearest
from rankweave.session import discard, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_CLUSTERS = 10_000
ROUNDS = 20  # the limit of rounds of one fit
ROUNDING = 1e-12  # a difference of two sums is taken as 0 below this share of them
BLOCK = 1000  # centres that are compared with as many others at a time


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _square_norm(vector: Column) -> Column:
    return _sum(F.transform(vector, lambda x: x * x))


def cluster_report(assigned: DataFrame) -> DataFrame:
    """One row: number of clusters, least / mean / largest size and median strength, from (cluster, strength)."""
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    joined = sizes.join(exact_median(assigned.select("cluster", "strength"), ["cluster"], "strength"), "cluster")
    return joined.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.min("n").alias("size_min"), F.avg("n").alias("size_mean"), F.max("n").alias("size_max"),
        F.min("median").alias("strength_min"), F.avg("median").alias("strength_mean"),
        F.max("median").alias("strength_max"),
    )


def lloyd(points: DataFrame, key: str, k: int, seed: int = 7, rounds: int = ROUNDS, column: str = "point") -> np.ndarray:
    """The centres of k clusters: Lloyd's rounds from k seeded points, until no centre moves or for `rounds` rounds.

    Every round is one pass that leaves k sums per task. A cluster that loses all its points keeps its centre. The start depends on
    seed and keys alone, so equal tables give equal clusters.
    """
    rows = materialize(points.select(key, F.col(column).cast("array<double>").alias("point")), "lloyd")
    start = rows.orderBy(draw(seed, key), key).limit(k).collect()
    centres = np.array([r["point"] for r in start])
    mean = vector_to_array(Summarizer.mean(F.col("vector")))
    for _ in range(rounds if len(centres) else 0):
        placed = with_vector(rows.select("point", nearest(F.col("point"), centres)["cell"].alias("cluster")), "point")
        moved = centres.copy()
        for r in placed.groupBy("cluster").agg(mean.alias("centre")).collect():  # k rows
            moved[r["cluster"]] = r["centre"]
        if np.array_equal(moved, centres):
            break
        centres = moved
    discard(rows)
    return centres


def assign(centres: np.ndarray, points: DataFrame, column: str = "point") -> DataFrame:
    """`points` with `cluster`, the number of the nearest centre, and `strength`, the distance to it."""
    at = nearest(F.col(column).cast("array<double>"), centres)
    return points.withColumn("_at", at).select(*points.columns, F.col("_at.cell").alias("cluster"), F.col("_at.gap").alias("strength"))


def kmeans_fit(points: DataFrame, k: int, seed: int = 7):
    """KMeans on an array column `point`."""
    return KMeans(k=k, seed=seed, featuresCol="vector", predictionCol="cluster").fit(with_vector(points, "point"))


def kmeans_assign(model, points: DataFrame) -> DataFrame:
    """`points` with the column `cluster`."""
    return model.transform(with_vector(points, "point")).drop("vector")


def centroids(points: DataFrame, weight: str | None = None) -> DataFrame:
    """(cluster, n, centre, squares): size, mean and sum of squared norms, in one combined aggregation.

    With `weight`, a column of whole numbers, a point counts so many times, here and in the measures below.
    """
    times = F.col(weight).cast("double") if weight else F.lit(1.0)
    stats = Summarizer.metrics("mean", "normL2").summary(F.col("vector"), times).alias("s")
    return with_vector(points, "point").groupBy("cluster").agg(stats, F.sum(times).alias("n")).select(
        "cluster",
        "n",
        vector_to_array("s.mean").alias("centre"),
        _square_norm(vector_to_array("s.normL2")).alias("squares"),
    )


def calinski_harabasz(points: DataFrame, weight: str | None = None) -> DataFrame:
    """(calinski_harabasz) of points(cluster, point array): dispersion between over dispersion within clusters.

    It is 1 where every cluster holds copies of one point, as in scikit-learn: nothing but rounding is left within them then.
    """
    groups = centroids(points, weight)
    overall = centroids(points.withColumn("cluster", F.lit(0)), weight).first()  # one row
    whole = overall["n"] * sum(v * v for v in overall["centre"])
    spread = F.sum(F.col("n") * _square_norm(F.col("centre")))
    between = spread - F.lit(whole)
    within = F.sum("squares") - spread
    k, n = F.count(F.lit(1)), F.lit(float(overall["n"]))
    ratio = F.when(within > ROUNDING * F.sum("squares"), (between / (k - 1)) / (within / (n - k))).otherwise(F.lit(1.0))
    return groups.agg(ratio.alias("calinski_harabasz"))


def davies_bouldin(points: DataFrame, weight: str | None = None) -> DataFrame:
    """(davies_bouldin): mean over clusters of the worst ratio of spreads to centre distance.

    Centres are looked up by every point through a measured broadcast or with salt, and compared with each other:
    clusters x clusters rows, whatever the number of points, in blocks of about BLOCK x BLOCK pairs.
    """
    centres = materialize(centroids(points, weight).select("cluster", "centre"), "centres")
    gaps = F.zip_with("point", "centre", lambda x, c: (x - c) * (x - c))
    times = F.col(weight).cast("double") if weight else F.lit(1.0)
    placed = points.select("cluster", F.col("point").cast("array<double>").alias("point"), times.alias("times"))
    spreads = lookup_join(placed, centres, ["cluster"], ["point"], fits_in_memory(centres)).groupBy("cluster", "centre").agg(
        (F.sum(F.col("times") * F.sqrt(_sum(gaps))) / F.sum("times")).alias("spread"))
    known = materialize(spreads, "spreads")
    parts = -(-known.count() // BLOCK) or 1
    part, every = F.pmod(F.xxhash64("cluster"), F.lit(parts)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    one = known.select("*", part.alias("part"), every.alias("other_part"))
    other = known.select(*[F.col(c).alias(f"other_{c}") for c in known.columns], part.alias("other_part"), every.alias("part"))
    apart = F.sqrt(_sum(F.zip_with("centre", "other_centre", lambda x, c: (x - c) * (x - c))))
    ratios = one.join(other, ["part", "other_part"]).filter(F.col("cluster") != F.col("other_cluster")).select(
        "cluster", F.try_divide(F.col("spread") + F.col("other_spread"), apart).alias("ratio"))
    return ratios.groupBy("cluster").agg(F.max("ratio").alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def silhouette(points: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distances."""
    rows = with_vector(points, "point").withColumn("prediction", F.col("cluster").cast("double"))
    return ClusteringEvaluator(featuresCol="vector", predictionCol="prediction").evaluate(rows)


def weighted_silhouette(points: DataFrame, weight: str) -> DataFrame:
    """(silhouette): the mean silhouette of points that count `weight` times, with squared Euclidean distances.

    The distances of a point to a whole cluster follow from the cluster's size, mean and sum of squared norms, so no
    pairs of points are made. One row per cluster comes to the driver.
    """
    stats = centroids(points, weight).limit(MOST_CLUSTERS + 1).collect()
    if len(stats) > MOST_CLUSTERS:
        raise ValueError(f"more than {MOST_CLUSTERS} clusters")
    number = {r["cluster"]: i for i, r in enumerate(stats)}
    sizes, centres = np.array([r["n"] for r in stats]), np.array([r["centre"] for r in stats])
    norms = np.array([r["squares"] for r in stats])

    def values(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, clusters in columns:
            rows = as_matrix(x, centres.shape[1])
            total = np.maximum(0.0, sizes * (rows**2).sum(axis=1)[:, None] - 2 * sizes * (rows @ centres.T) + norms)
            own, at = np.array([number[c] for c in clusters.to_pylist()], int), np.arange(len(rows))
            size = sizes[own]
            inside = total[at, own] / np.maximum(size - 1, 1)
            mean = total / sizes
            mean[at, own] = np.inf
            outside = mean.min(axis=1)
            both = np.maximum(inside, outside)
            yield pa.array(np.where((size > 1) & (both > 0), (outside - inside) / np.where(both > 0, both, 1), 0.0))

    values.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    told = points.select(F.col(weight).alias("times"), F.arrow_udf(values, "double")(F.col("point").cast("array<double>"), F.col("cluster")).alias("value"))
    return told.agg((F.sum(F.col("times") * F.col("value")) / F.sum("times")).alias("silhouette"))


def k_sweep(points: DataFrame, key: str, ks: Iterable[int] = range(10, 300, 10), test_share: float = 0.25,
            seed: int = 7, draws: int | None = None) -> DataFrame:
    """(k, calinski_harabasz, davies_bouldin, silhouette) on held-out points, a new split for each k.

    With `draws` the fits and measures are over so many draws of points, with replacement; a point counts as often as it
    was drawn to a side, and its vector is there once. Values are null where the held-out points lie in one cluster or each in
    its own, for which they are not defined.
    """
    schema = "k int, calinski_harabasz double, davies_bouldin double, silhouette double"
    drawn = materialize(sample_rows(points.select(key), key, draws, seed), "draws") if draws else None
    rows = []
    for k in ks:
        if drawn is None:
            sides = [part.withColumn("times", F.lit(1)) for part in split(points, key, test_share, seed + k)]
        else:
            counts = [part.groupBy(key).agg(F.count(F.lit(1)).alias("times")) for part in split(drawn, "draw", test_share, seed + k)]
            sides = [points.join(n, key) for n in counts]
        train, test = sides
        model = KMeans(k=k, seed=seed, featuresCol="vector", predictionCol="cluster", weightCol="times").fit(
            with_vector(train.withColumn("times", F.col("times").cast("double")), "point"))
        assigned = materialize(kmeans_assign(model, test), "swept")
        used, n = assigned.agg(F.count_distinct("cluster"), F.sum("times")).first()
        if not 1 < used < (n or 0):
            rows.append((k, None, None, None))
            continue
        rows.append((k, *(measure(assigned, "times").first()[0] for measure in (calinski_harabasz, davies_bouldin, weighted_silhouette))))
    return points.sparkSession.createDataFrame(rows, schema)
