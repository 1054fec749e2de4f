"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
FREQUENT_ROWS = 100_000  # rows of one key that a task may hold
FREQUENT_KEYS = 10_000


def fits_in_memory(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measured size check: stops reading after `max_rows` + 1 rows."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def frequent_keys(counts: DataFrame, on: list[str], rows: str) -> DataFrame:
    """The keys of `counts`, one row per key, with more than FREQUENT_ROWS `rows`; of very many the FREQUENT_KEYS largest.

    A key that is left out holds a ten-thousandth of all rows at most.
    """
    return counts.filter(F.col(rows) > FREQUENT_ROWS).orderBy(F.desc(rows), *on).limit(FREQUENT_KEYS).select(*on)


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], spread: list[str], small_fits: bool,
                how: str = "inner", salts: int = SALTS, frequent: DataFrame | None = None) -> DataFrame:
    """Join `big` to `small`, where `on` may be very uneven on the big side.

    A small side that was measured to fit is broadcast, so `big` is not moved. Otherwise both sides are shuffled
    on `on` plus a salt taken from the `spread` columns of `big`, which cuts every key into `salts` parts. With `frequent`,
    distinct keys (see `frequent_keys`), only those are cut, and only their rows of `small` are copied.
    `how` is inner, left, left_semi or left_anti.

    Spark estimates the copies at the size of what is copied and would broadcast them, so the join is fixed to a merge.
    """
    if small_fits:
        return big.join(F.broadcast(small), on, how)
    salt, all_salts = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"), F.sequence(F.lit(0), F.lit(salts - 1))
    if frequent is not None:
        marks = F.broadcast(frequent.select(*on, F.lit(True).alias("_cut")))
        big, small = big.join(marks, on, "left"), small.join(marks, on, "left")
        salt = F.when(F.col("_cut"), salt).otherwise(0)
        all_salts = F.when(F.col("_cut"), all_salts).otherwise(F.array(F.lit(0)))
    salted = big.withColumn("_salt", salt).drop("_cut")
    copies = small.withColumn("_salt", F.explode(all_salts)).drop("_cut")
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")
