from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rankweave.llm import sharding
from rankweave.session import new_path


def test_fisher_yates_gives_every_order_alike():
    draw = np.random.default_rng(4)
    seen = Counter(tuple(sharding.fisher_yates(4, draw)) for _ in range(12_000))
    assert len(seen) == 24 and max(seen.values()) < 1.3 * min(seen.values())
    assert sharding.fisher_yates(0, draw) == [] and sharding.fisher_yates(1, draw) == [0]


def check(rows, shards, whole):
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == whole
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_hard_rows_stay_whole(hard, hard_rows):
    placed = sharding.shuffle_into_shards(hard, 4)
    rows = placed.collect()
    check(rows, 4, len(hard_rows))
    kept = [c for c in hard.columns if c not in ("shard", "slot")]
    at = [hard.columns.index(c) for c in kept]
    assert placed.columns == [*kept, "shard", "slot"]
    assert Counter(tuple(r[c] for c in kept) for r in rows) == Counter(tuple(r[i] for i in at) for r in hard_rows)


def test_repeatable_and_seeded(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))

    def order(seed, parts):
        rows = sharding.shuffle_into_shards(df.repartition(parts), 3, seed=seed).collect()
        return [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]

    assert order(1, 2) == order(1, 7) != order(2, 2)


def test_equal_rows_are_spread_over_buckets(spark):
    df = spark.range(3000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    rows = sharding.shuffle_into_shards(df, 4, bucket_bytes=8192).collect()
    check(rows, 4, 3000)


def test_empty(spark, nothing):
    assert sharding.shuffle_into_shards(nothing, 4).count() == 0
    assert sharding.write_shards(nothing, new_path(spark, "none"), 4).count() == 0


def test_written_shards(spark, hard, hard_rows):
    path = new_path(spark, "shards")
    rows = sharding.write_shards(hard, path, 2).collect()
    check(rows, 2, len(hard_rows))
    assert spark.read.parquet(f"{path}/shard=0").count() in (len(hard_rows) // 2, -(-len(hard_rows) // 2))
