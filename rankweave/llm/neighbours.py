"""Nearest vectors by inner product: a pruned directed graph per shard, walked by beam search.

1. One row per id; equal vectors become one node with its smallest ids, as many as an answer can need.
2. Nodes are dealt by hash into shards of bounded size. A task builds the graph of a shard: nodes enter in doubling
   batches, a greedy search from the entries (the node nearest the mean and those of the largest norms, which answer most
   queries where norms differ) proposes neighbours, and pruning keeps a candidate only if no kept one is nearer to it,
   by the factor `RELAXED`, than the node itself is. Kept edges are also entered backwards, and full lists are pruned again.
3. Queries go in blocks to every shard. A beam search returns the best nodes; their ids are scored in double
   precision on the original vectors, and the best per query stay.

Inner product becomes distance by one more component, the root of what a vector lacks to the largest norm, so that
all nodes lie on a sphere; queries have zero there and keep their order of inner products.

Rows: a vector that is null, empty, zero or holds a null or non-finite component takes no part, neither does a row without id.
Of rows that repeat an id the smallest vector counts. Vectors meet only vectors of their own length. Ties of the score go to the smaller
id. Fewer candidates than k give fewer rows, an empty table gives none. Extra columns are not read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.common import column
from rankweave.session import materialize

SHARD_SIZE = 8192
QUERY_BLOCK = 4096
MOST_LENGTHS = 1000
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAXED = 1.2
EXPANDED = 4
ENTRIES = 32
FIRST_BATCH = 64
LARGEST_BATCH = 512

INDEX = "dim int, shard int, ids binary, counts binary, vectors binary, points binary, edges binary, entries binary"
FOUND = "query_id long, vec_id long, score double"


def vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec, dim): the rows that take part, one per id."""
    typed = table.select(column(key).cast("long").alias("vec_id"), column(vector).cast("array<double>").alias("vec"))
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = typed.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(finite & F.exists("vec", lambda x: x != 0))
    one = fit.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    return one.select("vec_id", "vec", F.size("vec").alias("dim"))


def nodes(rows: DataFrame, k: int) -> DataFrame:
    """(dim, vec, ids): distinct vectors with their k + 1 smallest ids; no answer holds more of them."""
    placed = rows.withColumn("_place", F.row_number().over(W.partitionBy("vec").orderBy("vec_id")))
    few = placed.filter(F.col("_place") <= k + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.size("vec").alias("dim"), "vec", "ids")


def _shards(rows: DataFrame, size: int) -> dict[int, int]:
    """Shards for each vector length."""
    counts = rows.groupBy("dim").count().limit(MOST_LENGTHS + 1).collect()
    if len(counts) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} different lengths")
    return {r["dim"]: -(-r["count"] // size) for r in counts}


def _by_length(numbers: dict[int, int]) -> Column:
    return F.create_map(*[F.lit(x).cast("int") for pair in numbers.items() for x in pair])[F.col("dim")]


class Graph:
    """A directed graph over points of one norm; `walk` finds those with the largest inner products."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.points, self.edges, self.entries = points, edges, entries

    @classmethod
    def build(cls, points: np.ndarray) -> Graph:
        """Points enter in batches that double up to a fixed size, the entries first."""
        n = len(points)
        entries = np.empty(0, np.int32)
        if n:
            largest = np.argsort(points[:, -1], kind="stable")[: ENTRIES - 1]
            entries = np.unique([int(np.argmax(points @ points.mean(axis=0))), *largest]).astype(np.int32)
        graph = cls(points, np.full((n, DEGREE), -1, np.int32), entries)
        others = np.concatenate([entries, np.setdiff1d(np.arange(n, dtype=np.int32), entries)])
        first = others[:FIRST_BATCH]
        if len(first) > 1:
            near = np.argsort(-(points[first] @ points[first].T), axis=1, kind="stable")
            graph.edges[first] = graph._pruned(first, first[near])
        done = len(first)
        while done < len(others):
            batch = others[done : done + min(done, LARGEST_BATCH)]
            found, _ = graph.walk(points[batch], BUILD_BEAM)
            graph.edges[batch] = graph._pruned(batch, found)
            graph._enter_backwards(batch)
            done += len(batch)
        graph._reach_all()
        return graph

    def _pruned(self, rows: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """At most DEGREE diverse candidates of each row: the nearest that is left is kept and takes away those that
        it is nearer to, by the factor RELAXED, than the row."""
        own = self.points[rows]
        held = self.points[np.maximum(candidates, 0)]
        norm = float((own[0] ** 2).sum())
        apart = 2 * (norm - np.einsum("bcd,bd->bc", held, own))
        between = 2 * (norm - held @ held.transpose(0, 2, 1))
        left = (candidates >= 0) & (candidates != rows[:, None])
        out = np.full((len(rows), DEGREE), -1, np.int32)
        at = np.arange(len(rows))
        for place in range(DEGREE):
            best = np.where(left, apart, np.inf).argmin(axis=1)
            some = left[at, best]
            if not some.any():
                break
            out[some, place] = candidates[at, best][some]
            left &= ~((RELAXED**2 * between[at, best] <= apart) & some[:, None])
            left[at, best] = False
        return out

    def _enter_backwards(self, batch: np.ndarray) -> None:
        """Each edge of the batch the other way too; lists that overflow are pruned."""
        to = self.edges[batch]
        pairs = np.stack([to.ravel(), np.repeat(batch, DEGREE)], axis=1)
        pairs = pairs[pairs[:, 0] >= 0]
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        targets, starts, counts = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        for width in np.unique(-(-counts // DEGREE)):  # lists of like length at a time
            pick = np.flatnonzero(-(-counts // DEGREE) == width)
            for part in np.array_split(pick, -(-len(pick) // LARGEST_BATCH)):
                new = np.full((len(part), int(width) * DEGREE), -1, np.int32)
                for i, p in enumerate(part):
                    new[i, : counts[p]] = pairs[starts[p] : starts[p] + counts[p], 1]
                self._add(targets[part], new)

    def _add(self, rows: np.ndarray, new: np.ndarray) -> None:
        both = np.concatenate([self.edges[rows], new], axis=1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
        fits = (both >= 0).sum(axis=1) <= DEGREE
        self.edges[rows[fits]] = both[fits][:, :DEGREE]
        if not fits.all():
            self.edges[rows[~fits]] = self._pruned(rows[~fits], both[~fits])

    def _reach_all(self) -> None:
        """Nodes that no path from the entries reaches get an edge from the nearest reached node with room, else in place of
        its last one."""
        n = len(self.points)
        while n:
            reached = np.zeros(n, bool)
            reached[self.entries] = True
            front = self.entries
            while len(front):
                step = np.unique(self.edges[front])
                step = step[step >= 0]
                front = step[~reached[step]]
                reached[front] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            found, _ = self.walk(self.points[lost[:LARGEST_BATCH]], BUILD_BEAM)
            changed = False
            for node, near in zip(lost, found, strict=False):
                near = near[near >= 0]
                room = near[(self.edges[near] < 0).any(axis=1)]
                if len(room):
                    self.edges[room[0], int(np.argmax(self.edges[room[0]] < 0))] = node
                    changed = True
            if not changed:  # every list near the lost nodes is full
                self.edges = np.concatenate([self.edges, np.full((n, DEGREE), -1, np.int32)], axis=1)

    def walk(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, inner products), best first, of as many nodes as the beam holds; -1 where fewer were met.

        All queries advance together: each expands the best nodes of its beam that it has not expanded, until none is left.
        """
        n, m = len(self.points), len(queries)
        ids = np.full((m, beam), -1, np.int32)
        scores = np.full((m, beam), -np.inf, np.float32)
        if not n or not m:
            return ids, scores
        open_ = np.zeros((m, beam), bool)
        begin = queries @ self.points[self.entries].T
        best = np.argsort(-begin, axis=1, kind="stable")[:, :beam]
        width = best.shape[1]
        ids[:, :width], scores[:, :width], open_[:, :width] = self.entries[best], np.take_along_axis(begin, best, axis=1), True
        seen = np.zeros((m, n), bool)
        seen[:, self.entries] = True
        live = np.arange(m)
        while len(live):
            order = np.argsort(~open_[live], axis=1, kind="stable")[:, :EXPANDED]  # beams are kept best first
            rows = live[:, None]
            some = open_[rows, order]
            open_[rows, order] = False
            next_ = self.edges[ids[rows, order]].reshape(len(live), -1)
            wanted = (next_ >= 0) & np.repeat(some, self.edges.shape[1], axis=1)
            next_ = np.sort(np.where(wanted, next_, n), axis=1)
            wanted = next_ < n
            wanted[:, 1:] &= next_[:, 1:] != next_[:, :-1]
            next_ = np.where(wanted, next_, 0)
            wanted &= ~seen[rows, next_]
            at, place = np.nonzero(wanted)
            seen[live[at], next_[at, place]] = True
            told = np.full(next_.shape, -np.inf, np.float32)
            told[at, place] = np.einsum("ij,ij->i", self.points[next_[at, place]], queries[live[at]])
            all_ids = np.concatenate([ids[live], np.where(wanted, next_, -1).astype(np.int32)], axis=1)
            all_scores = np.concatenate([scores[live], told], axis=1)
            all_open = np.concatenate([open_[live], wanted], axis=1)
            best = np.argsort(-all_scores, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, axis=1)
            scores[live] = np.take_along_axis(all_scores, best, axis=1)
            open_[live] = np.take_along_axis(all_open, best, axis=1)
            live = live[open_[live].any(axis=1)]
        return ids, scores


def _matrix(column_: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column_.chunks]) if column_.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _on_sphere(vectors_: np.ndarray) -> np.ndarray:
    """Scaled so that the largest norm is 1, with the component that brings every norm to 1."""
    scaled = vectors_ / np.abs(vectors_).max()
    scaled /= np.sqrt((scaled**2).sum(axis=1).max())
    lacking = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
    return np.column_stack([scaled, lacking]).astype(np.float32)


def _built(keys: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    dim, shard = (k.as_py() for k in keys)
    ids = group["ids"].to_pylist()
    order = np.argsort([x[0] for x in ids], kind="stable")  # a shard's graph does not depend on how its rows arrived
    exact = _matrix(group["vec"], dim)[order]
    points = _on_sphere(exact)
    graph = Graph.build(points)
    ids = [ids[i] for i in order]
    row = {
        "dim": dim, "shard": shard, "ids": np.array([x for of in ids for x in of], np.int64).tobytes(),
        "counts": np.array([len(x) for x in ids], np.int32).tobytes(), "vectors": exact.tobytes(),
        "points": points.tobytes(), "edges": graph.edges.tobytes(), "entries": graph.entries.tobytes(),
    }
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
    return pa.table({n: pa.array([v], t) for (n, v), t in zip(row.items(), types, strict=True)})


def build(rows: DataFrame, k: int, shard_size: int = SHARD_SIZE) -> tuple[DataFrame, dict[int, int]]:
    """The index, one row per shard, written to the shared folder; and the number of shards for each vector length."""
    points = materialize(nodes(rows, k), "nodes")
    shards = _shards(points, shard_size)
    if not shards:
        return rows.sparkSession.createDataFrame([], INDEX), shards
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec"), _by_length(shards)).cast("int"))
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(_built, INDEX), "graphs"), shards


def _searcher(k: int, beam: int):
    def search(keys: tuple[pa.Scalar, ...], index: pa.Table, asked: pa.Table) -> pa.Table:
        if not index.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        row, dim = index.to_pylist()[0], keys[0].as_py()
        counts = np.frombuffer(row["counts"], np.int32)
        ids, starts = np.frombuffer(row["ids"], np.int64), np.concatenate([[0], np.cumsum(counts)])
        exact = np.frombuffer(row["vectors"]).reshape(-1, dim)
        points = np.frombuffer(row["points"], np.float32).reshape(-1, dim + 1)
        graph = Graph(points, np.frombuffer(row["edges"], np.int32).reshape(len(points), -1), np.frombuffer(row["entries"], np.int32))
        query_ids, wanted = asked["vec_id"].to_numpy(), _matrix(asked["vec"], dim)
        scaled = (wanted / np.abs(wanted).max(axis=1)[:, None]).astype(np.float32)
        scaled = np.column_stack([scaled, np.zeros(len(scaled), np.float32)])
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(wanted), LARGEST_BATCH):
            found, _ = graph.walk(scaled[at : at + LARGEST_BATCH], max(beam, k + 1))
            for query, vector, near in zip(query_ids[at:], wanted[at:], found, strict=False):
                near = near[near >= 0]
                told = (exact[near] * vector).sum(axis=1)
                each = counts[near]
                places = np.repeat(starts[near] - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())
                who, score = ids[places], np.repeat(told, each)
                other = who != query
                who, score = who[other], score[other]
                best = np.lexsort((who, -score))[:k]
                out.append((np.full(len(best), query), who[best], score[best]))
        return pa.table({n: np.concatenate([x[i] for x in out]) for i, n in enumerate(("query_id", "vec_id", "score"))})

    return search


def search(index: DataFrame, shards: dict[int, int], queries: DataFrame, k: int, beam: int = SEARCH_BEAM,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best found of each query(vec_id, vec, dim), its own id left out."""
    known = queries.filter(F.col("dim").isin(list(shards)))
    blocks = max(1, -(-known.count() // query_block))
    if not shards:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def each(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    copies = index.withColumn("block", each(F.lit(blocks))).groupBy("dim", "shard", "block")
    asked = known.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", each(_by_length(shards))).groupBy("dim", "shard", "block")
    found = copies.cogroup(asked).applyInArrow(_searcher(k, beam), FOUND)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, asked: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest of the rows whose id fulfils `asked` (over `vec_id`) among all others."""
    rows = materialize(vectors(table, key, vector), "vectors")
    index, shards = build(rows, k)
    return search(index, shards, rows.filter(asked), k)


_built.__annotations__ = {"keys": tuple[pa.Scalar, ...], "group": pa.Table, "return": pa.Table}
