"""Repeatable random numbers: a hash of a seed and key columns, independent of partitions and row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, *keys: str) -> Column:
    """32 hexadecimal digits; comparing them as text gives a random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(key).cast("string") for key in keys]))


def draw_int(seed: int, below: Column, *keys: str) -> Column:
    """An integer in [0, below)."""
    return F.pmod(F.conv(F.substring(draw(seed, *keys), 1, 15), 16, 10).cast("long"), below)


def draw_share(seed: int, *keys: str) -> Column:
    """A number in [0, 1) in steps of 1/10000."""
    return draw_int(seed, F.lit(10_000), *keys) / 10_000
