import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.operators import adarank, clustering, models, solver
from rankweave.plans import study
from rankweave.session import new_path


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    rows = []
    for q in range(12):
        for d in range(8):
            x = rng.normal(size=3)
            label = int(x[1] + 0.5 * x[0] + 0.1 * rng.normal() > 0.2)
            rows.append((f"q{q}", f"d{d}", label, [round(float(v), 6) for v in x]))
    return rows, spark.createDataFrame(rows, "qid string, docid string, label int, features array<double>")


def ndcg(rows, score):
    out = {}
    for q in {r[0] for r in rows}:
        mine = sorted(((round(score(r[3]), 6), r[1], r[2]) for r in rows if r[0] == q), reverse=True)
        got = sum(l / math.log2(i + 2) for i, (_, _, l) in enumerate(mine))
        best = sum(1 / math.log2(i + 2) for i in range(sum(l for _, _, l in mine))) or 1.0
        out[q] = got / best
    return out


def loops(rows, rounds):
    weak = [ndcg(rows, lambda x, k=k: x[k]) for k in range(3)]
    weights = {q: 1 / len(weak[0]) for q in weak[0]}
    alpha, best, best_mean, used = [0.0] * 3, [0.0] * 3, 0.0, set()
    for _ in range(min(rounds, 3)):
        averages = {k: sum(weights[q] * weak[k][q] for q in weights) for k in range(3) if k not in used}
        k = max(averages, key=averages.get)
        used.add(k)
        alpha[k] += 0.5 * math.log((1 + averages[k]) / (1 - averages[k]))
        result = ndcg(rows, lambda x: sum(a * v for a, v in zip(alpha, x, strict=True)))
        total = sum(math.exp(-v) for v in result.values())
        weights = {q: math.exp(-v) / total for q, v in result.items()}
        mean = sum(result.values()) / len(result)
        if mean > best_mean:
            best, best_mean = list(alpha), mean
    return best


def test_adarank_against_loops(labelled):
    rows, df = labelled
    for rounds in (1, 3):
        assert adarank.fit(df, rounds=rounds, max_depth=8) == pytest.approx(loops(rows, rounds), abs=1e-9)


def test_adarank_weights_survive_storage(spark):
    path = new_path(spark, "weights")
    adarank.save_weights(adarank.weight_table(spark, [0.5, 0.0, -1.0], ["a", "b", "c"]), path)
    assert adarank.load_weights(spark, path) == [0.5, 0.0, -1.0]


def accuracy(scored, df):
    joined = scored.join(df.select("qid", "docid", "label"), ["qid", "docid"])
    return joined.agg(F.avg(((F.col("score") > 0.0) == (F.col("label") == 1)).cast("double"))).first()[0]


@pytest.mark.parametrize("kernel", [True, False])
def test_classifier(spark, labelled, kernel):
    df = labelled[1]
    model = models.fit_classifier(df, kernel=kernel, components=64)
    path = new_path(spark, "svc")
    models.save_model(model, path)
    loaded = models.load_model(path)
    assert accuracy(models.score(loaded, df, "margin"), df) > 0.85
    assert {r["score"] for r in models.score(loaded, df).collect()} == {0.0, 1.0}
    with pytest.raises(ValueError):
        models.score(loaded, df, "odd")


def test_cluster_ranker(spark, labelled):
    df = labelled[1]
    queries = spark.createDataFrame(
        [(f"q{i}", [float(i < 6) * 10, 0.0]) for i in range(12)], "qid string, query_features array<double>")
    ranker = models.fit_cluster_ranker(df, queries, 2, kernel=False)
    assert len(ranker.own) == 2 and not ranker.unfitted
    path = new_path(spark, "ranker")
    ranker.save(path)
    again = models.ClusterRanker.load(path)
    first = {(r["qid"], r["docid"]): r["score"] for r in ranker.score(df, queries).collect()}
    second = {(r["qid"], r["docid"]): r["score"] for r in again.score(df, queries).collect()}
    assert len(first) == df.count() and first == pytest.approx(second)
    pooled = models.ClusterRanker(ranker.clusters, ranker.shared, {})
    assert pooled.unfitted == [0, 1] and pooled.score(df, queries).count() == df.count()


def test_one_row_is_enough_for_a_cluster_of_its_own(spark, labelled):
    df = labelled[1]
    queries = spark.createDataFrame(
        [(f"q{i}", [float(i < 1) * 10, 0.0]) for i in range(12)], "qid string, query_features array<double>")
    few = df.filter("qid != 'q0'").unionByName(df.filter("qid = 'q0'").orderBy("docid").limit(3))
    assert len(models.fit_cluster_ranker(few, queries, 2, kernel=False).own) == 2


def test_a_fit_that_stops_at_its_limit_says_so(labelled):
    with pytest.warns(RuntimeWarning):
        models.fit_classifier(labelled[1], kernel=False, max_iter=1)


@pytest.fixture(scope="module")
def design(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 5))
    y = x @ np.array([1.0, -2.0, 0.5, 0.0, 3.0]) + 0.3 * rng.standard_t(2, size=400)
    rows = [([float(v) for v in r], float(t), float(t > 0)) for r, t in zip(x, y, strict=True)]
    return x, y, spark.createDataFrame(rows, "x array<double>, value double, class double").repartition(7)


@pytest.mark.parametrize("loss, column", [(solver.squared_hinge, "class"), (solver.Huber(0.5), "value")])
@pytest.mark.parametrize("reg", [1e-4, 0.5])
def test_newton_steps_reach_the_optimum(design, loss, column, reg):
    """The gradient, written out row by row, is zero at the result, and no point nearby has a lower objective."""
    x, y, df = design
    target = y if column == "value" else (y > 0).astype(float)
    found = solver.minimise(df.withColumnRenamed(column, "label"), 5, loss, reg, 100)
    assert found.converged and found.steps < 30

    def plain(point):
        total = reg / 2 * sum(v * v for v in point[:5])
        for row, t in zip(x, target, strict=True):
            m = float(row @ point[:5]) + point[5]
            if column == "class":
                total += max(0.0, 1 - (1 if t else -1) * m) ** 2 / len(x)
            else:
                e = abs(m - t)
                total += (e * e / 2 if e <= 0.5 else 0.5 * (e - 0.25)) / len(x)
        return total

    best = np.append(found.weights, found.intercept)
    assert found.objective == pytest.approx(plain(best), abs=1e-10)
    for i in range(6):
        step = np.zeros(6)
        step[i] = 1e-5
        assert abs(plain(best + step) - plain(best - step)) / 2e-5 < 1e-5
        assert plain(best) <= plain(best + 100 * step) and plain(best) <= plain(best - 100 * step)


def test_newton_steps_on_odd_rows(spark):
    one = spark.createDataFrame([([1.0, 2.0], 1.0)], "x array<double>, label double")
    assert solver.minimise(one, 2, solver.squared_hinge, 1e-3, 50).converged
    far = spark.createDataFrame([([1.0], 1e6), ([2.0], -1e6), ([2.0], 5.0)], "x array<double>, label double")
    assert solver.minimise(far, 1, solver.Huber(1.0), 1e-2, 200).converged
    with pytest.raises(ValueError):
        solver.minimise(one.limit(0), 2, solver.squared_hinge, 1e-3, 50)


def test_projection_is_the_same_everywhere(spark):
    df = spark.range(40).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    project = models.fourier_map(0.5, 16, 3)
    both = [sorted(r[0] for r in df.repartition(n).select(project("x")).collect()) for n in (1, 5)]
    assert both[0] == both[1] and len(both[0][0]) == 16


def test_reports(spark):
    rows = [(1.0, 2.0), (3.0, 3.0), (5.0, 4.0), (0.0, 4.0)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    got = models.regression_report(df).first()
    y = np.array([r[1] for r in rows])
    p = np.array([r[0] for r in rows])
    assert got["mse"] == pytest.approx(np.mean((p - y) ** 2))
    assert got["r2"] == pytest.approx(1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))
    assert (got["median_ae"], got["exact"]) == (1.0, 0.25)
    assert models.accuracy(df).first()[0] == 0.25


def test_cluster_measures_against_numpy(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 1.0, (30, 4)) for c in (0.0, 4.0, 9.0)])
    labels = np.repeat([0, 1, 2], 30)
    df = spark.createDataFrame(
        [(i, int(c), [float(v) for v in x]) for i, (c, x) in enumerate(zip(labels, points, strict=True))],
        "id int, cluster int, point array<double>")
    centres = np.stack([points[labels == c].mean(axis=0) for c in range(3)])
    between = sum(30 * np.sum((c - points.mean(axis=0)) ** 2) for c in centres)
    within = sum(np.sum((points[labels == c] - centres[c]) ** 2) for c in range(3))
    assert clustering.calinski_harabasz(df).first()[0] == pytest.approx((between / 2) / (within / 87))
    spread = [np.linalg.norm(points[labels == c] - centres[c], axis=1).mean() for c in range(3)]
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i)
             for i in range(3)]
    assert clustering.davies_bouldin(df).first()[0] == pytest.approx(np.mean(worst))
    assert clustering.silhouette(df) > 0.7
    model = clustering.kmeans_fit(df.drop("cluster"), 3)
    sizes = clustering.kmeans_assign(model, df.drop("cluster")).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in sizes) == [30, 30, 30]
    sweep = clustering.k_sweep(df.drop("cluster"), "id", [2, 3]).collect()
    assert [r["k"] for r in sweep] == [2, 3]
    assert sweep[1]["silhouette"] > sweep[0]["silhouette"]
    few = clustering.k_sweep(df.drop("cluster").limit(12), "id", [11]).first()
    assert few["k"] == 11 and few["silhouette"] is None


def test_weights_count_like_copies(spark):
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(c, 1.0, (20, 3)) for c in (0.0, 2.0, 5.0)])
    times = rng.integers(1, 5, 60)
    rows = [(i, i // 20, [float(v) for v in x], int(t)) for i, (x, t) in enumerate(zip(points, times, strict=True))]
    df = spark.createDataFrame([*rows, (60, 3, [9.0, 9.0, 9.0], 1)], "id int, cluster int, point array<double>, times int")
    copies = df.select(F.explode(F.sequence(F.lit(1), "times")), "cluster", "point").drop("col")
    for measure in (clustering.calinski_harabasz, clustering.davies_bouldin):
        assert measure(df, "times").first()[0] == pytest.approx(measure(copies).first()[0])
    x, labels = np.array([r.point for r in copies.collect()]), np.array([r.cluster for r in copies.collect()])
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    values = []
    for i, own in enumerate(labels):
        inside = apart[i, labels == own].sum() / max((labels == own).sum() - 1, 1)
        outside = min(apart[i, labels == c].mean() for c in set(labels) - {own})
        values.append(0.0 if (labels == own).sum() == 1 else (outside - inside) / max(inside, outside))
    assert clustering.weighted_silhouette(df, "times").first()[0] == pytest.approx(np.mean(values))
    sweep = clustering.k_sweep(df.drop("cluster", "times"), "id", [2, 3], draws=300).collect()
    assert [r["k"] for r in sweep] == [2, 3] and all(r["silhouette"] > 0 for r in sweep)


def test_clusters_of_copies_of_one_point(spark):
    df = spark.createDataFrame([(i, i, [0.1 * i, 0.7], 3) for i in range(5)], "id int, cluster int, point array<double>, times int")
    assert clustering.calinski_harabasz(df, "times").first()[0] == 1.0
    sweep = clustering.k_sweep(df.drop("cluster", "times"), "id", [5], draws=400).first()
    assert tuple(sweep) == (5, 1.0, pytest.approx(0.0, abs=1e-9), pytest.approx(1.0))


def test_lloyd_reaches_a_fixed_point(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.5, (30, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(points)], "id int, point array<double>")
    centres = clustering.lloyd(df, "id", 3)
    placed = clustering.assign(centres, df).collect()
    assert clustering.lloyd(df.repartition(5), "id", 3) == pytest.approx(centres)
    for r in placed:
        gaps = np.linalg.norm(centres - np.array(r["point"]), axis=1)
        assert r["cluster"] == gaps.argmin() and r["strength"] == pytest.approx(gaps.min())
    for c in range(3):
        assert centres[c] == pytest.approx(np.mean([r["point"] for r in placed if r["cluster"] == c], axis=0))
    assert clustering.lloyd(df.limit(0), "id", 3).size == 0 and len(clustering.lloyd(df.limit(2), "id", 3)) == 2


def test_centres_are_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = spark.createDataFrame([(i % 23, [float(v) for v in rng.normal(i % 23, 1.0, 3)]) for i in range(115)], "cluster int, point array<double>")
    whole = clustering.davies_bouldin(points).first()[0]
    monkeypatch.setattr(clustering, "BLOCK", 4)
    blocked = clustering.davies_bouldin(points)
    assert blocked.first()[0] == pytest.approx(whole)
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("steps", [1, 2000])
def test_fit_quality_tells_whether_the_solver_settled(labelled, monkeypatch, steps):
    fit = models.fit_classifier
    monkeypatch.setattr(models, "fit_classifier", lambda rows, seed: fit(rows, kernel=False, max_iter=steps, reg=0.1, seed=seed))
    found = {(r.part, r.measure): r.value for r in study.fit_quality(labelled[1], graded=False).collect()}
    assert found["fit", "converged"] == float(found["fit", "gradient_norm"] < 1e-7) == float(steps > 1)
    assert found["fit", "objective"] > 0 and ("test", "accuracy") in found
