"""Two-pass external shuffle into shards.

Pass one scatters rows uniformly over memory-sized buckets by a seeded hash of the whole row. Pass two loads one bucket
at a time, puts it in a canonical order, shuffles it by Fisher-Yates under a seed of its own and sends it out. The
buckets one after another are the global order; shard s is its s-th equal run, so shard counts differ by one at most.

Rows: null keys and null or empty texts are rows like others. Equal rows are told apart by a copy number when they
would overfill a bucket, so a row that makes up a third of the input is spread too. Columns of the input named `shard`
or `slot` give way to the result's. An empty input gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.llm.common import column, packed, with_result

BUCKET_BYTES = 32 << 20
BUCKETS_PER_SHARD = 4
RUN = 1024


def fisher_yates(n: int, draw: np.random.Generator) -> list[int]:
    """A uniformly random order of 0..n-1."""
    order = list(range(n))
    for i, step in enumerate(draw.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else ()):
        order[i], order[i + step] = order[i + step], order[i]
    return order


def _bucket(seed: int, parts: int, *of: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(parts)).cast("long")


def _scattered(rows: DataFrame, seed: int, parts: int) -> DataFrame:
    return rows.withColumn("bucket", _bucket(seed, parts, F.col("copy"), F.col("row")))


def _bucket_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


def _offsets(sizes: DataFrame) -> DataFrame:
    """(bucket, first): rows before each bucket, summed in two levels so that no task sees all buckets."""
    by_run = sizes.select("bucket", "n", F.floor(F.col("bucket") / RUN).alias("run"))
    within = W.partitionBy("run").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    over = W.orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = by_run.groupBy("run").agg(F.sum("n").alias("run_n")).select("run", F.coalesce(F.sum("run_n").over(over), F.lit(0)).alias("base"))
    placed = by_run.select("bucket", "run", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inside"))
    return placed.join(runs, "run").select("bucket", (F.col("base") + F.col("inside")).alias("first"))


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 17, size_of: str = "text",
                        bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of `df` with `shard` (0 to shards - 1) and `slot` (0, 1, ... in each shard), in a random order.

    `bucket_bytes` bounds the rows that one task holds, measured by the bytes of column `size_of`.
    """
    size = (F.coalesce(F.octet_length(column(size_of)), F.lit(0)) + 64).cast("long")
    plain = packed(df, size.alias("size"), F.lit(1).cast("long").alias("copy"))
    rows, bytes_ = plain.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(BUCKETS_PER_SHARD * shards, -(-bytes_ // bucket_bytes))
    scattered = _scattered(plain, seed, parts)
    sizes = _bucket_sizes(scattered)
    if (sizes.agg(F.max("bytes")).first()[0] or 0) > 4 * bucket_bytes:
        counted = plain.groupBy("row", "size").agg(F.count(F.lit(1)).alias("copies"))
        numbered = counted.select("row", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        scattered = _scattered(numbered, seed, parts)
        sizes = _bucket_sizes(scattered)
    sent = scattered.select("bucket", F.xxhash64(F.lit(seed + 1), "copy", "row").alias("tie"), "row")
    out = T.StructType([T.StructField("row", sent.schema["row"].dataType), T.StructField("shard", T.IntegerType()),
                        T.StructField("slot", T.LongType())])

    def place(bucket: pa.Table, offset: pa.Table) -> pa.Table:
        tie = pc.sort_indices(bucket.column("tie"))
        n = bucket.num_rows
        number = bucket.column("bucket")[0].as_py() if n else 0
        order = fisher_yates(n, np.random.Generator(np.random.PCG64([seed, number])))
        place_ = np.arange(n, dtype=np.int64) + (offset.column("first")[0].as_py() if n else 0)
        shard = place_ * shards // max(rows, 1)
        slot = place_ - -(-shard * rows // shards)
        taken = bucket.column("row").combine_chunks().take(pc.take(tie, pa.array(order, pa.int64())))
        return pa.table({"row": taken, "shard": pa.array(shard, pa.int32()), "slot": pa.array(slot, pa.int64())})

    offsets = _offsets(sizes).withColumnRenamed("bucket", "of_bucket")
    placed = sent.groupBy("bucket").cogroup(offsets.groupBy("of_bucket")).applyInArrow(place, out)
    return placed.select(*with_result(df, ["shard", "slot"]), "shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int, **options) -> DataFrame:
    """Write the shuffled rows as one folder per shard and read them back."""
    placed = shuffle_into_shards(df, shards, **options)
    placed.write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)
