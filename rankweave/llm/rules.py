"""Quality rules as a short-circuit cascade.

A document is rejected when any rule rejects it, so the order of the rules changes the cost and never the verdict. The
cascade measures every rule on a sample (seconds per document, share of documents rejected) and runs the rules in order
of rejections per second; a document leaves at the first rule that rejects it. A rule computes the statistics it needs
when it is asked, and rules share what has been computed.

Rows: a null text counts as empty; an empty text has no words and is rejected by `few_words`. Whole texts are read.
An empty input gives an empty result; without rows to measure the rules keep the order given.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import arrow_function, column, utf8
from rankweave.llm.text_stats import TextStats

SAMPLE_ROWS = 2_000
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE = ("few_words", "repeated_runs")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextStats], bool]


# Thresholds leave ordinary prose alone by a wide margin; the SQL form of the query states them again.
RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_runs", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > 3 * t.n_words),
    Rule("shouting", lambda t: 10 * t.n_upper > 6 * (t.n_upper + t.n_lower)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("repeated_lines", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = SAMPLE_ROWS,
            seed: int = 3) -> DataFrame:
    """(rule, seconds, rejected, seen) of each rule over a random sample of about `rows` documents."""
    total = docs.count()
    sample = docs.select(column(text).alias("text"))
    if total > rows:
        sample = sample.sample(rows / total, seed)

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for rule in rules:
                start = time.perf_counter()
                rejected = sum(rule.rejects(TextStats(x)) for x in texts)
                spent = time.perf_counter() - start
                yield pa.RecordBatch.from_pydict({"rule": [rule.name], "seconds": [spent], "rejected": [rejected], "seen": [len(texts)]})

    parts = sample.mapInArrow(timed, "rule string, seconds double, rejected long, seen long")
    return parts.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("seen").alias("seen"))


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules in order of rejections per second; one row per rule comes to the driver."""
    found = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in measure(docs, rules, text, rows).collect()}
    return tuple(sorted(rules, key=lambda rule: -found.get(rule.name, 0.0)))


def first_rejection(text: Column, ordered: tuple[Rule, ...]) -> Column:
    """The rule that rejects the text first in the order given, or null."""

    def make():
        def apply(texts: pa.Array) -> pa.Array:
            stats = map(TextStats, utf8(texts))
            return pa.array([next((r.name for r in ordered if r.rejects(t)), None) for t in stats], pa.string())

        return apply

    return arrow_function(make, "string")(text)


def verdicts(text: Column, ordered: tuple[Rule, ...]) -> Column:
    """struct of the metrics, `base_failed` (a base rule rejects) and `kept` (no rule rejects)."""
    base = [r for r in RULES if r.name in BASE]

    def make():
        def apply(texts: pa.Array) -> pa.Array:
            rows = []
            for stats in map(TextStats, utf8(texts)):
                kept = not any(r.rejects(stats) for r in ordered)
                rows.append([getattr(stats, m) for m in METRICS] + [not kept and any(r.rejects(stats) for r in base), kept])
            columns = [pa.array([r[i] for r in rows], pa.int64() if i < len(METRICS) else pa.bool_()) for i in range(len(METRICS) + 2)]
            return pa.StructArray.from_arrays(columns, names=[*METRICS, "base_failed", "kept"])

        return apply

    return arrow_function(make, "struct<" + ",".join(f"{m}:bigint" for m in METRICS) + ",base_failed:boolean,kept:boolean>")(text)


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns as they were."""
    return docs.filter(first_rejection(column(text), cascade(docs, rules, text)).isNull())
