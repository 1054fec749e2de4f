"""Positions and running sums inside groups of any size, top-k, and exact medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.session import materialize

GROUP_LIMIT = 1000


def positions(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column] | None = None,
              bounded: bool = False, size: str | None = None, wholes: dict[str, str] | None = None) -> DataFrame:
    """Add `pos` (1-based place in its group) and running sums up to and including the row; `size` names a column for
    the number of rows of the group, `wholes` names columns for the group's totals of some of the sums.

    Rows that are equal in group and order stay in one block, so values that repeat are to be counted first.

    With `bounded=True` the caller vouches for a fixed largest group (such as a run cut at depth k) and one window
    is enough. Otherwise a group may be larger than a task should hold: rows are range-partitioned by
    (group, order) into blocks, so a large group spans many blocks; each block is counted on its own and shifted
    by the totals of the blocks before it, of which there are at most as many as partitions.
    """
    sums, wholes = sums or {}, wholes or {}
    rows = df.select("*", *[value.cast("double").alias(f"_v_{name}") for name, value in sums.items()])

    def local(frame: DataFrame, keys: list[str]) -> DataFrame:
        ordered = W.partitionBy(*keys).orderBy(*order)
        upto = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
        return frame.select(
            "*",
            F.row_number().over(ordered).cast("long").alias("pos"),
            *[F.sum(f"_v_{name}").over(upto).alias(name) for name in sums],
        ).drop(*[f"_v_{name}" for name in sums])

    if bounded:
        group_rows = W.partitionBy(*group)
        whole = [F.count(F.lit(1)).over(group_rows).alias(size)] if size else []
        whole += [F.sum(f"_v_{name}").over(group_rows).alias(column) for name, column in wholes.items()]
        return local(rows.select("*", *whole), group)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(name) for name in group]
    blocks = materialize(
        rows.repartitionByRange(parts, *keys, *order).withColumn("_block", F.spark_partition_id()), "blocks"
    )
    totals = blocks.groupBy(*group, "_block").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in sums]
    )
    before = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        *group,
        "_block",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0.0)).alias(f"_b_{name}") for name in sums],
        *([F.sum("_n").over(W.partitionBy(*group)).alias(size)] if size else []),
        *[F.sum(f"_t_{name}").over(W.partitionBy(*group)).alias(column) for name, column in wholes.items()],
    )
    joined = local(blocks, [*group, "_block"]).join(shifts, [*group, "_block"])
    return joined.select(
        *df.columns,
        (F.col("pos") + F.col("_before")).alias("pos"),
        *([size] if size else []),
        *wholes.values(),
        *[(F.col(name) + F.col(f"_b_{name}")).alias(name) for name in sums],
    )


def top_k(scored: DataFrame, k: int, group: list[str] | None = None, order: list[Column] | None = None,
          rank: str = "rank") -> DataFrame:
    """The k best rows of each group with a 1-based rank; ties go to the larger docid."""
    group = group or ["qid"]
    order = order or [F.desc("score"), F.desc("docid")]
    if k <= GROUP_LIMIT:  # Spark keeps only k rows per group and task before it shuffles
        ranked = scored.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    else:
        ranked = positions(scored, group, order).withColumnRenamed("pos", rank)
    return ranked.filter(F.col(rank) <= k)


def exact_median(df: DataFrame, group: list[str], value: str, weight: str | None = None) -> DataFrame:
    """(group, median) of the values that are not null, each counted `weight` times (an integer; once without it).

    Equal values become one row with their number before anything is placed, so a value that makes a third of the rows
    is one row per task. The median lies where the running numbers pass the middle of the group.
    """
    number = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(number.cast("double").alias("_n"))
    placed = positions(counted.filter("_n > 0"), group, [F.asc(value)], {"_upto": F.col("_n")}, wholes={"_upto": "_size"})
    before = F.col("_upto") - F.col("_n")
    lower, upper = F.floor((F.col("_size") + 1) / 2), F.floor(F.col("_size") / 2) + 1
    middle = placed.filter((F.col("_upto") >= lower) & (before < upper))
    return middle.groupBy(*group).agg(((F.min(value) + F.max(value)) / 2).alias("median"))
