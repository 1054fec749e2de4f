"""Bottom-k sketches of shingle hashes, with Spark's own functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's runs of words; with fewer than k runs it
holds all of them. Sketches of parts merge into the sketch of the whole, and estimate the resemblance and containment of
two texts and the number of distinct runs.

Rows: words are runs without ASCII blanks. A text with fewer words than a run has one run of all its words. Null counts
as empty; a text without words has an empty sketch. Two empty sketches resemble each other fully, an empty and a filled
one not at all. Equal texts have equal sketches. Whole texts are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 128
WIDTH = 5
BLANKS = " \t\n\x0b\f\r"
HASH_RANGE = 2.0**64


def words(text: Column) -> Column:
    """Runs without ASCII blanks; none for null."""
    bare = F.btrim(F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS)))
    return F.filter(F.split(bare, " "), lambda w: w != "")


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """array<bigint>: the k smallest distinct hashes of the text's runs of `width` words, in order."""

    def of_words(w: Column) -> Column:
        runs = F.greatest(F.size(w) - F.lit(width - 1), F.lit(1))
        hashes = F.transform(F.sequence(F.lit(1), runs), lambda i: F.xxhash64(F.slice(w, i, width)))
        return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)

    # One array around the words binds them to a name, so that they are split once.
    sketched = F.transform(F.array(words(text)), lambda w: F.when(F.size(w) > 0, of_words(w)).otherwise(F.array().cast("array<bigint>")))
    return F.element_at(sketched, 1)


def merged(one: Column, two: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(one, two)), 1, k)


def merge_groups(df: DataFrame, group: list[str], of: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its rows; only k hashes of a group leave a task."""
    hashes = df.select(*group, F.explode(F.col(of)).alias("hash")).distinct()
    ranked = hashes.withColumn("place", F.row_number().over(W.partitionBy(*group).orderBy("hash")))
    return ranked.filter(F.col("place") <= k).groupBy(*group).agg(F.sort_array(F.collect_list("hash")).alias(of))


def distinct_runs(of: Column, k: int = K) -> Column:
    """The estimated number of distinct runs: exact below k hashes, (k - 1) over the k-th hash's share of the range else."""
    share = (F.element_at(of, -1).cast("double") + HASH_RANGE / 2) / HASH_RANGE
    return F.when(F.size(of) < k, F.size(of).cast("double")).otherwise((k - 1) / share)


def resemblance(one: Column, two: Column, k: int = K) -> Column:
    """The estimated Jaccard similarity: the share of the merged sketch's hashes that both sketches hold."""
    def of(m: Column) -> Column:
        return F.size(F.array_intersect(F.array_intersect(m, one), two)) / F.size(m)

    by_merge = F.element_at(F.transform(F.array(merged(one, two, k)), of), 1)
    return F.when((F.size(one) == 0) & (F.size(two) == 0), F.lit(1.0)).when((F.size(one) == 0) | (F.size(two) == 0), F.lit(0.0)).otherwise(by_merge)


def containment(one: Column, two: Column, k: int = K) -> Column:
    """The estimated share of the first text's runs that the second one has."""
    both = resemblance(one, two, k) * distinct_runs(merged(one, two, k), k)
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_runs(one, k)))


def spelled(of: Column) -> Column:
    """A sketch as text: hashes in hexadecimal, joined by commas."""
    return F.array_join(F.transform(of, lambda h: F.lower(F.hex(h))), ",")


def with_next(df: DataFrame, key: str, carried: list[str], blocks: int) -> DataFrame:
    """Add `next`, a struct of the carried columns of the row with the next greater key; after the last, of the first.

    Rows are dealt into blocks by quantiles of the key. A block begins at a key that is in the table, and the rows of
    that key also go to the block before it, so every block sees the row after its last one. One block is one task.
    Rows with a null key come first; among equal keys the order is by the carried columns. A column `next` of the input
    gives way; all others stay, whatever their names.
    """
    df = df.drop("next")
    block_, own_, last_ = (_free(df, name) for name in ("_block", "_own", "_last"))
    order = [F.asc_nulls_first(key), *[F.asc_nulls_first(c) for c in carried]]
    at = [i / blocks for i in range(1, blocks)]
    quantiles = F.percentile_approx(key, at, 100 * blocks) if at else F.lit(None)
    found = df.agg(quantiles.alias("at"), F.min(key).alias("least"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
    starts = sorted({x for x in found["at"] or () if x is not None and x != found["least"]})
    block = _place(F.col(key), starts)
    begins = F.col(key).isin(starts) if starts else F.lit(False)
    own = df.withColumn(block_, block).withColumn(own_, F.lit(True))
    halo = df.filter(F.coalesce(begins, F.lit(False))).withColumn(block_, block - 1).withColumn(own_, F.lit(False))
    least = F.col(key).isNull() if found["nulls"] else F.col(key) == F.lit(found["least"])
    first = df.filter(least).orderBy(*order).limit(1)
    first = first.withColumn(block_, F.lit(len(starts))).withColumn(own_, F.lit(False)).withColumn(last_, F.lit(True))
    rows = own.unionByName(halo).withColumn(last_, F.lit(False)).unionByName(first)
    along = W.partitionBy(block_).orderBy(last_, *order)
    return rows.withColumn("next", F.lead(F.struct(*carried)).over(along)).filter(own_).drop(block_, own_, last_)


def _free(df: DataFrame, name: str) -> str:
    """`name`, made longer until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _place(key: Column, starts: list) -> Column:
    """How many of the sorted `starts` are not greater than the key; looked up in two steps."""
    if not starts:
        return F.lit(0)
    step = max(1, int(len(starts) ** 0.5))
    runs = [starts[i : i + step] for i in range(0, len(starts), step)]

    def not_greater(of: Column) -> Column:
        return F.size(F.filter(of, lambda s: s <= key))

    run = not_greater(F.array(*[F.lit(r[0]) for r in runs]))
    table = F.array(*[F.array(*[F.lit(x) for x in r]) for r in runs])
    inside = not_greater(F.element_at(table, run))
    return F.when(key.isNull() | (run == 0), F.lit(0)).otherwise((run - 1) * step + inside)
