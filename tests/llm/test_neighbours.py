"""Graph search against brute force: recall, exact scores, ties, hot vectors and rows that take no part."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import neighbours


def truth(vectors, query, k):
    told = [((vectors[i] * vectors[query]).sum(), i) for i in vectors if i != query]
    return sorted(told, key=lambda x: (-x[0], x[1]))[:k]


def recall(found, vectors, queries, k):
    """The share of the true neighbours found; ranks, scores and ties are checked on the way."""
    by_query = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query[r.query_id].append(r)
    assert set(by_query) == set(queries)
    hits = total = 0
    for q, rows in by_query.items():
        assert [r.rank for r in rows] == list(range(1, min(k, len(vectors) - 1) + 1))
        assert q not in {r.vec_id for r in rows} and len({r.vec_id for r in rows}) == len(rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert all(abs(r.score - (vectors[r.vec_id] * vectors[q]).sum()) <= 1e-12 * max(1, abs(r.score)) for r in rows)
        wanted = truth(vectors, q, k)
        hits += len({i for _, i in wanted} & {r.vec_id for r in rows})
        total += len(wanted)
    return hits / total


def table(spark, vectors):
    return spark.createDataFrame([(int(i), None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in vectors],
                                 "vec_id long, embedding array<float>, shard string")


def nearest(spark, vectors, k=10, shard_size=300, every=10, query_block=7):
    rows = neighbours.vectors(table(spark, vectors.items()))
    index, shards = neighbours.build(rows, k, shard_size)
    return neighbours.search(index, shards, rows.filter(F.col("vec_id") % every == 0), k, query_block=query_block).collect(), shards


@pytest.mark.parametrize("kind", ["even", "norms", "clusters", "copies"])
def test_recall(spark, kind):
    draw = np.random.default_rng(3)
    many = draw.normal(size=(900, 24))
    if kind == "norms":
        many *= draw.lognormal(sigma=1.0, size=(900, 1))
    if kind == "clusters":
        many[:500] = many[0] + 0.01 * draw.normal(size=(500, 24))
    if kind == "copies":
        many[:400] = many[0]
    many = many.astype(np.float32).astype(float)
    vectors = dict(enumerate(many))
    found, shards = nearest(spark, vectors)
    assert shards[24] == (2 if kind == "copies" else 3)
    assert recall(found, vectors, range(0, 900, 10), 10) >= 0.95


def test_graph_reaches_every_node():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 700):
        points = neighbours._on_sphere(draw.normal(size=(n, 8))) if n else np.empty((0, 9), np.float32)
        graph = neighbours.Graph.build(points)
        front = graph.entries.tolist()
        reached = set(front)
        while front:
            front = [x for node in front for x in graph.edges[node] if x >= 0 and x not in reached and not reached.add(x)]
        assert len(reached) == n
        for node, row in enumerate(graph.edges):
            kept = [x for x in row if x >= 0]
            assert len(set(kept)) == len(kept) and node not in kept


def test_pruning_keeps_diverse_edges():
    """Of two candidates in one place only the nearer stays; one on the other side stays, and so does one far beyond the
    nearest, which is not nearer to it by the factor."""
    angle = np.array([0.0, 0.1, 0.12, -0.2, 1.5])
    points = np.column_stack([np.cos(angle), np.sin(angle)]).astype(np.float32)
    graph = neighbours.Graph(points, np.full((5, neighbours.DEGREE), -1, np.int32), np.zeros(1, np.int32))
    kept = graph._pruned(np.array([0]), np.array([[1, 2, 3, 4]]))[0]
    assert [x for x in kept if x >= 0] == [1, 3, 4]


def test_rows_that_take_no_part(spark):
    good = {i: np.array([np.cos(i), np.sin(i), 1.0]).astype(np.float32).astype(float) for i in range(30)}
    odd = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 0.0]), (180, [float("nan"), 1.0, 0.0]), (200, [float("inf"), 0.0, 0.0])]
    other = [(220, [1.0, 2.0]), (240, [2.0, 1.0])]
    df = table(spark, [*good.items(), *odd, *other]).unionByName(table(spark, [(0, good[0]), (20, good[20])]))
    df = df.unionByName(spark.createDataFrame([(None, [1.0, 1.0, 1.0], "x")], df.schema))
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 40).collect()
    three = [r for r in found if r.query_id < 100]
    assert recall(three, good, [0, 20], 40) == 1.0
    assert [(r.query_id, r.vec_id, r.rank, r.score) for r in sorted(found, key=lambda r: r.query_id) if r.query_id >= 100] == [(220, 240, 1, 4.0), (240, 220, 1, 4.0)]
    empty = spark.createDataFrame([], df.schema)
    assert neighbours.nearest(empty, F.col("vec_id") % 20 == 0, 5).count() == 0
    assert neighbours.nearest(table(spark, [(1, [1.0]), (3, [2.0])]), F.col("vec_id") % 20 == 0, 5).count() == 0


def test_huge_and_tiny_numbers(spark):
    draw = np.random.default_rng(2)
    for scale in (1e30, 1e-30):
        many = (draw.normal(size=(80, 6)) * scale).astype(np.float32).astype(float)
        found, _ = nearest(spark, dict(enumerate(many)), k=5)
        assert len(found) == 8 * 5
        wanted = {(q, i) for q in range(0, 80, 10) for _, i in truth(dict(enumerate(many)), q, 5)}
        assert len(wanted & {(r.query_id, r.vec_id) for r in found}) >= 38
