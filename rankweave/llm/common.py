"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(parts)).cast("int")


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns in one struct `row`, so that no working column can clash with one of the input."""
    return df.select(F.struct(*[column(c) for c in df.columns]).alias("row"), *more)


def with_result(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns of `row` again, without those whose names the result takes."""
    taken = {n.lower() for n in names}
    return [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in taken]


def utf8(column_: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [x or b"" for x in column_.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Returns unused memory of this process to the system: what Arrow keeps for later, and what the C library does."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # a C library without this call
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(batches: Iterator[Any]) -> Iterator[Any]:
    """The batches of a task. A worker waits for its next task with little memory, as an executor has more workers than
    cores where a stage runs two Python functions at a time."""
    try:
        yield from batches
    finally:
        give_back()


def arrow_function(make: Callable[[], Callable[[pa.Array], pa.Array]], kind: T.DataType | str):
    """An Arrow function of one column whose worker state is made once per task."""

    def batches(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from giving_back(map(make(), columns))

    batches.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, kind)


def of_worker(shared: Broadcast, name: str, build: Callable[[Any], Any]) -> Any:
    """What a Python worker derives from a broadcast value; kept as long as the value is, over all tasks of the worker."""
    value = shared.value
    if name not in value:
        value[name] = build(value)
    return value[name]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64) of each number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` word hashes, in order; none if there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = mixed(total + words[i : i + n] + np.uint64(i + 1))
    return total
