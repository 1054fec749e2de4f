"""What each filter of a chain removes, in every order of the filters.

A document's failures are a mask of one bit per filter. Documents with one mask behave alike in every order, so the
counts by (part, mask) say all: removed, kept and redundant documents of any order, those that one filter alone would
catch, good documents lost, and each filter's total over all orders (its Shapley share times their number).

Rows: a null text is empty, a null part is the empty string. A document is good or toxic if any of its labels says so;
labels without a document count nowhere, null labels and null keys match nothing. Repeated rows count each. An empty
table gives no rows. Extra columns are not read. Whole texts are read, however long.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm import repeats
from rankweave.llm.common import column, utf8
from rankweave.llm.text_stats import CONTINUATION, UPPER
from rankweave.operators.joins import fits_in_memory, lookup_join

# The filters in the order of their bits, and their limits.
LETTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
MARKS = b"#$%&*|"


def text_mask(data: bytes) -> int:
    """The bits of the four filters that look at one text alone."""
    words = data.split()
    n_chars = len(data.translate(None, CONTINUATION))
    n_upper = len(data) - len(data.translate(None, UPPER))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
        | (100 * n_upper > MOST_UPPER_PERCENT * n_chars) << 2
        | (len(data) > len(data.translate(None, MARKS))) << 3
    )


def _masks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([text_mask(x) for x in utf8(texts)], pa.int32())


_masks.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of `docs(doc_id, text, lang)`."""
    described = {
        "doc_id": column("doc_id"),
        "part": F.coalesce(column("lang").cast("string"), F.lit("")),
        "mask": F.arrow_udf(_masks, "int")(column("text")),
    }
    marked = repeats.mark(docs, column("doc_id"), column("text"), described)
    last = 1 << LETTERS.index("E")
    return marked.select("doc_id", "part", (F.col("mask") + F.when(F.col("repeats"), last).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail exactly the filters of the mask."""
    alike = masked.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    told = labels.filter(column("doc_id").isNotNull()).groupBy(column("doc_id").alias("doc_id")).agg(
        *[F.max(F.when(column(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    joined = lookup_join(alike, told, ["doc_id"], ["part", "mask"], fits_in_memory(told), "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def steps(letters: str = LETTERS) -> Column:
    """array<struct<filter_order, step, own, before>>: the steps of every order, with the step's bit and those before it."""
    bit = {x: 1 << i for i, x in enumerate(letters)}
    rows = [
        {"filter_order": "".join(order), "step": i + 1, "own": bit[x], "before": sum(bit[y] for y in order[:i])}
        for order in permutations(letters) for i, x in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, own: int, before: int>>")


def report(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step from the counts by mask, zeros included."""
    orders = factorial(len(letters))
    mask, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails = mask.bitwiseAND(own) != 0
    gone = mask.bitwiseAND(before) != 0
    share = F.when(fails, F.lit(orders) / F.greatest(F.bit_count(mask), F.lit(1))).otherwise(0).cast("long")

    def total(value: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(0)).cast("long")

    expanded = counts.withColumn("s", F.explode(steps(letters))).select(*counts.columns, "s.*")
    return expanded.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~gone).alias("kept"),
        total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", mask == own).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"),
        total("toxic", fails & ~gone).alias("toxic_lost"),
        F.sum(F.col("n") * share).cast("long").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the seven counts of `docs(doc_id, text, lang)` under `labels(doc_id, quality, toxic)`."""
    return report(mask_counts(masks(docs), labels))
