"""Trained rankers: margin classifier, robust regression, one regressor per query cluster.

Kernel machines are approximated by random Fourier features (Rahimi and Recht, 2007) under a linear model, which is
fitted to its optimum by Newton steps (`operators/solver.py`).
"""

from __future__ import annotations

import json
import sys
import warnings
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.operators import solver
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.ordering import exact_median
from rankweave.session import discard, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The limit of solver steps. A fit that has not settled by then says so.
MOST_STEPS = 100_000
# Fixed value: the error, in grades, from which the regressor's loss is linear.
HUBER_WIDTH = 1.0


def fourier_map(gamma: float, components: int, seed: int):
    """An Arrow function from arrays to cosines of random projections; the projection follows from the seed."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return rows
        x = np.stack(rows.to_numpy())
        rng = np.random.default_rng(seed)
        directions = rng.normal(0.0, np.sqrt(2.0 * (gamma or 1.0 / x.shape[1])), (x.shape[1], components))
        offsets = rng.uniform(0.0, 2.0 * np.pi, components)
        return pd.Series(list(np.sqrt(2.0 / components) * np.cos(x @ directions + offsets)), index=rows.index)

    return project


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of a radial kernel; `gamma` 0 stands for 1 / number of inputs."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "number of outputs", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="scaled", outputCol="projected", gamma=0.0, components=256, seed=7):
        super().__init__()
        self._setDefault(inputCol="scaled", outputCol="projected", gamma=0.0, components=256, seed=7)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        project = fourier_map(self.getOrDefault("gamma"), self.getOrDefault("components"), self.getSeed())
        arrays = vector_to_array(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(arrays)))


def with_vector(rows: DataFrame, column: str = "features") -> DataFrame:
    return rows.withColumn("vector", array_to_vector(F.col(column).cast("array<double>")))


class LinearScorer(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """`margin`, the weighted sum of the input plus an intercept, and `prediction`: the margin, or its class (0 or 1)."""

    weights = Param(Params._dummy(), "weights", "one number per input", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "the margin of zeros", TypeConverters.toFloat)
    classes = Param(Params._dummy(), "classes", "whether predictions are classes", TypeConverters.toBoolean)
    report = Param(Params._dummy(), "report", "converged, steps, objective and gradient norm of the fit", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="scaled", weights=None, intercept=0.0, classes=False, report=None):
        super().__init__()
        self._setDefault(inputCol="scaled", weights=[], intercept=0.0, classes=False, report=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        products = F.zip_with(vector_to_array(F.col(self.getInputCol())), F.lit(self.getOrDefault("weights")), lambda x, w: x * w)
        margin = F.aggregate(products, F.lit(self.getOrDefault("intercept")), lambda total, x: total + x)
        placed = dataset.withColumn("margin", margin)
        value = (F.col("margin") > 0).cast("double") if self.getOrDefault("classes") else F.col("margin")
        return placed.withColumn("prediction", value)


def _fit(rows: DataFrame, loss: solver.Loss, classes: bool, kernel: bool, components: int, seed: int, max_iter: int,
         reg: float) -> PipelineModel:
    scaler = StandardScaler(inputCol="vector", outputCol="scaled", withMean=True, withStd=True)
    stages = [scaler, FourierFeatures(components=components, seed=seed)] if kernel else [scaler]
    last = "projected" if kernel else "scaled"
    prepared = Pipeline(stages=stages).fit(with_vector(rows))
    inputs = prepared.transform(with_vector(rows)).select(vector_to_array(last).alias("x"), F.col("label").cast("double").alias("label"))
    design = materialize(inputs, "design")
    first = design.first()
    if first is None:
        raise ValueError("no rows to fit")
    found = solver.minimise(design, len(first["x"]), loss, reg, max_iter)
    discard(design)
    if not found.converged:
        warnings.warn(f"the solver stopped after {found.steps} steps before it converged", RuntimeWarning, stacklevel=3)
    report = [float(found.converged), float(found.steps), found.objective, found.gradient_norm]
    learner = LinearScorer(inputCol=last, weights=found.weights.tolist(), intercept=found.intercept, classes=classes, report=report)
    return PipelineModel([*prepared.stages, learner])


def fit_classifier(rows: DataFrame, kernel: bool = True, components: int = 256, seed: int = 7,
                   max_iter: int = MOST_STEPS, reg: float = 1e-4) -> PipelineModel:
    """Margin classifier (squared hinge) on rows with columns `features` (array) and `label` (0 or 1)."""
    return _fit(rows, solver.squared_hinge, True, kernel, components, seed, max_iter, reg)


def fit_regressor(rows: DataFrame, kernel: bool = True, components: int = 256, seed: int = 7,
                  max_iter: int = MOST_STEPS, reg: float = 1e-3) -> PipelineModel:
    """Robust (Huber) regression on rows with columns `features` (array) and `label`."""
    return _fit(rows, solver.Huber(HUBER_WIDTH), False, kernel, components, seed, max_iter, reg)


def solver_report(model: PipelineModel) -> list[tuple[str, float]]:
    """(measure, value) of a fitted model: whether it settled, steps, objective and the norm of its gradient."""
    names = ("converged", "steps", "objective", "gradient_norm")
    return list(zip(names, model.stages[-1].getOrDefault("report"), strict=True))


def score(model: PipelineModel, features: DataFrame, kind: str = "value") -> DataFrame:
    """(qid, docid, score): `value` is the regression value or the class, `margin` the distance to the boundary."""
    if kind not in ("value", "margin"):
        raise ValueError(f"kind must be 'value' or 'margin', not {kind!r}")
    out = F.col("prediction" if kind == "value" else "margin")
    return model.transform(with_vector(features)).select("qid", "docid", out.alias("score"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def regression_report(predicted: DataFrame) -> DataFrame:
    """(mse, r2, median_ae, exact) from columns `prediction` and `label`."""
    error = F.col("prediction") - F.col("label")
    median = exact_median(predicted.select(F.abs(error).alias("ae")), [], "ae").first()[0]
    r2 = F.when(F.var_pop("label") > 0, 1 - F.avg(error * error) / F.var_pop("label")).otherwise(F.lit(0.0))
    return predicted.agg(
        F.avg(error * error).alias("mse"), r2.alias("r2"), F.lit(median).cast("double").alias("median_ae"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("exact"),
    )


def accuracy(predicted: DataFrame) -> DataFrame:
    """(accuracy) from columns `prediction` and `label`."""
    return predicted.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def fit_query_clusters(query_rows: DataFrame, k: int, seed: int = 7) -> KMeansModel:
    """KMeans on rows with an array column `query_features`."""
    return KMeans(k=k, seed=seed, featuresCol="vector", predictionCol="cluster").fit(
        with_vector(query_rows, "query_features")
    )


def assign_clusters(model: KMeansModel, rows: DataFrame, column: str = "query_features") -> DataFrame:
    """`rows` with `cluster` and `strength`, the distance to the cluster's centre."""
    centres = F.lit([[float(v) for v in centre] for centre in model.clusterCenters()])
    assigned = model.transform(with_vector(rows, column)).drop("vector")
    gaps = F.zip_with(F.col(column), F.get(centres, F.col("cluster")), lambda x, c: (x - c) * (x - c))
    return assigned.withColumn("strength", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g)))


def _routed(rows: DataFrame, clusters: KMeansModel, query_rows: DataFrame) -> DataFrame:
    """`rows` with the cluster of their query, which may have any number of rows."""
    of_query = assign_clusters(clusters, query_rows).select("qid", "cluster")
    return lookup_join(rows, of_query, ["qid"], ["docid"] if "docid" in rows.columns else ["features"], fits_in_memory(of_query))


@dataclass
class ClusterRanker:
    """A regressor per query cluster; a cluster without training rows uses the one fitted on all rows."""

    clusters: KMeansModel
    shared: PipelineModel
    own: dict[int, PipelineModel] = field(default_factory=dict)

    def score(self, features: DataFrame, query_rows: DataFrame) -> DataFrame:
        """(qid, docid, score) of `features(qid, docid, features)`, each row by the model of its query's cluster."""
        routed = materialize(_routed(features, self.clusters, query_rows), "routed")
        out = score(self.shared, routed.filter(F.col("cluster").isin(*self.unfitted)) if self.unfitted else routed.limit(0))
        for cluster, model in self.own.items():
            out = out.unionByName(score(model, routed.filter(F.col("cluster") == cluster)))
        return out

    @property
    def unfitted(self) -> list[int]:
        """The clusters that had no training row."""
        return [c for c in range(len(self.clusters.clusterCenters())) if c not in self.own]

    def save(self, path: str) -> None:
        self.clusters.write().overwrite().save(f"{path}/clusters")
        save_model(self.shared, f"{path}/shared")
        for cluster, model in self.own.items():
            save_model(model, f"{path}/own-{cluster}")
        spark = SparkSession.active()
        listed = json.dumps(sorted(self.own))
        spark.createDataFrame([(listed,)], "value string").write.mode("overwrite").text(f"{path}/own")

    @classmethod
    def load(cls, path: str) -> ClusterRanker:
        listed = json.loads(SparkSession.active().read.text(f"{path}/own").first()[0])
        own = {cluster: load_model(f"{path}/own-{cluster}") for cluster in listed}
        return cls(KMeansModel.load(f"{path}/clusters"), load_model(f"{path}/shared"), own)


def fit_cluster_ranker(rows: DataFrame, query_rows: DataFrame, k: int, seed: int = 7, **options) -> ClusterRanker:
    """Fit on `rows(qid, features, label)` and `query_rows(qid, query_features)`, for a small number k of clusters.

    Every cluster that has a training row gets its own regressor.
    """
    clusters = fit_query_clusters(query_rows.join(rows.select("qid"), "qid", "left_semi"), k, seed)
    routed = materialize(_routed(rows, clusters, query_rows), "cluster-rows")
    used = sorted(row["cluster"] for row in routed.select("cluster").distinct().collect())  # at most k
    own = {c: fit_regressor(routed.filter(F.col("cluster") == c), seed=seed, **options) for c in used}
    return ClusterRanker(clusters, fit_regressor(routed, seed=seed, **options), own)
