"""Texts that repeat an earlier one, found exactly; a counting Bloom filter spares the unique ones their shuffle.

1. Every task counts its texts into the cells of a counting Bloom filter: a text's hash picks a block and three
   cells in it. The counts of all tasks add up to the filter of the whole table. A text with a cell that was met
   once occurs nowhere else.
2. Whether a cell was met twice is one bit. The bits are broadcast in blocks, at most `MOST_CELLS` of them, and every
   text is tested where it is read. Only possible repeats are grouped by their whole text for its smallest key; equal
   texts of a task are one row before they move, so a text that makes a third of the table moves once per task.
3. Rows learn the smallest key of their text by its hash (two 64-bit numbers). The groups hold whole texts, so two texts with
   one hash are seen; then everything is done again with another seed.

With more texts than cells the filter clears fewer of them and more are grouped; what is found never changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.session import materialize

CELLS_PER_TEXT = 16
MOST_CELLS = 2**29
BLOCK = 512
WORD = 64
PROBES = 3
HASH = ["_h", "_g"]


def hashes(text: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed + i), text).alias(name) for i, name in enumerate(HASH)]


def cells_for(rows: int) -> int:
    """The filter's size for a table of `rows` rows, a power of two."""
    return min(MOST_CELLS, max(BLOCK, 1 << (CELLS_PER_TEXT * rows - 1).bit_length()))


def _block(cells: int) -> Column:
    return F.pmod(F.col("_h"), F.lit(cells // BLOCK))


def _places() -> list[Column]:
    """The cells of a text inside its block, from the second hash."""
    width = BLOCK.bit_length() - 1
    return [F.shiftrightunsigned("_g", i * width).bitwiseAND(F.lit(BLOCK - 1)).cast("int") for i in range(PROBES)]


def met_twice(hashed: DataFrame, cells: int) -> DataFrame:
    """(_block, _bits): for each block with a cell that was met twice or more, one bit per cell, in words of 64."""
    places = F.array_distinct(F.array(*_places()))  # a text never meets a cell twice by itself
    counts = hashed.select(_block(cells).alias("_block"), F.explode(places).alias("cell")).groupBy("_block", "cell").count()
    twice = counts.filter(F.col("count") > 1)
    bit = F.expr(f"shiftleft(1L, cell % {WORD})")
    words = [
        F.coalesce(F.bit_or(F.when(F.floor(F.col("cell") / WORD) == i, bit)), F.lit(0).cast("long"))
        for i in range(BLOCK // WORD)
    ]
    return twice.groupBy("_block").agg(F.array(*words).alias("_bits"))


def possible(rows: DataFrame, bits: DataFrame, cells: int) -> DataFrame:
    """The rows all of whose cells were met twice."""
    def marked(place: Column) -> Column:
        word = F.element_at("_bits", F.floor(place / WORD).cast("int") + 1)
        return F.call_function("shiftrightunsigned", word, place % WORD).bitwiseAND(F.lit(1).cast("long")) == 1

    tested = rows.withColumn("_block", _block(cells)).join(F.broadcast(bits), "_block")
    for place in _places():
        tested = tested.filter(marked(place))
    return tested.drop("_block", "_bits")


def firsts(texts: DataFrame, hashed: DataFrame, n_rows: int) -> DataFrame | None:
    """(_h, _g, _first): the smallest key of each text that more than one row has; None if two texts share a hash.

    `texts(_key, _text, _h, _g)` are the rows to group, `hashed(_h, _g)` the hashes of the same rows.
    """
    cells = cells_for(n_rows)
    bits = materialize(met_twice(hashed, cells), "met-twice")
    grouped = possible(texts, bits, cells).groupBy(*HASH, "_text").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("n"))
    groups = materialize(grouped.filter("n > 1").drop("_text"), "repeats")
    shared = groups.groupBy(*HASH).count().filter("count > 1")
    return None if shared.limit(1).count() else groups.select(*HASH, "_first")


def mark(docs: DataFrame, key: Column, text: Column, described: dict[str, Column], name: str = "repeats") -> DataFrame:
    """The columns `described` (expressions over `docs`) of every row and `name`: whether a row with a smaller key has
    the same text.

    Null texts are empty. A null key is smaller than none and greater than none. `docs` is read twice, whole.
    """
    seed = 0
    while True:
        whole = F.coalesce(text, F.lit("")).alias("_text")
        rows = docs.select(key.alias("_key"), whole, *[c.alias(n) for n, c in described.items()])
        hashed = materialize(rows.select("_key", *described, *hashes(F.col("_text"), seed)), "hashed")
        found = firsts(rows.select("_key", "_text", *hashes(F.col("_text"), seed)), hashed.select(*HASH), hashed.count())
        if found is not None:
            break
        seed += len(HASH)
    joined = lookup_join(hashed, found, HASH, ["_key"], fits_in_memory(found), "left")
    return joined.select(*described, F.coalesce(F.col("_key") > F.col("_first"), F.lit(False)).alias(name))
