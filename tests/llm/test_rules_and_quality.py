import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import quality, rules
from rankweave.llm.text_stats import TextStats

from .conftest import prose


def plain_metrics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


@pytest.mark.parametrize("text", [
    "", " \n\t", "a b c d e f g h a b c d e f g h", "x " * 30, "x\n" * 30, "a\r\na\n\na", prose(1, 50) + "\n" + prose(1, 50), "ÄÖ#é 😀|中 | <b>",
])
def test_metrics(text):
    stats = TextStats(text.encode())
    assert [getattr(stats, m) for m in rules.METRICS] == plain_metrics(text)


def test_colliding_hashes_count_by_content(monkeypatch):
    import rankweave.llm.text_stats as module

    monkeypatch.setattr(module, "window_hashes", lambda w, n: np.zeros(max(len(w) - n + 1, 0), np.uint64))
    for text in (prose(2, 40), prose(2, 20) + " " + prose(2, 20)):
        assert TextStats(text.encode()).n_repeat_words == plain_metrics(text)[4]


def test_order_of_rules_does_not_change_the_verdict(spark, hard, texts):
    measured = {r.rule: r for r in rules.measure(hard).collect()}
    assert set(measured) == {r.name for r in rules.RULES} and all(r.seen == len(texts) for r in measured.values())
    ordered = rules.cascade(hard)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules.RULES)
    wanted = [not any(r.rejects(TextStats(t.encode())) for r in rules.RULES) for t in texts]
    for order in (ordered, rules.RULES, rules.RULES[::-1]):
        rows = hard.select(rules.verdicts(F.col("text"), order).alias("v"), rules.first_rejection(F.col("text"), order).alias("r")).collect()
        assert [r.v.kept for r in rows] == [r.r is None for r in rows] == wanted
        assert [[r.v[m] for m in rules.METRICS] for r in rows] == [plain_metrics(t) for t in texts]
        assert all(r.v.base_failed == (r.v.n_words < 20 or 100 * r.v.n_repeat_words > 30 * r.v.n_words) for r in rows)


def test_cheap_and_selective_rules_come_first(spark):
    docs = spark.createDataFrame([(prose(i, 300),) for i in range(30)], "text string")
    slow = rules.Rule("slow", lambda t: sum(t.n_distinct for _ in range(20_000)) < 0)
    quick = rules.Rule("quick", lambda t: t.data[:1] < b"m")
    assert [r.name for r in rules.cascade(docs, (slow, quick))] == ["quick", "slow"]


def test_keep_leaves_columns_alone(hard, nothing):
    assert rules.keep(hard).columns == hard.columns
    assert rules.keep(nothing).count() == 0 and rules.keep(nothing).columns == nothing.columns


def plain_scores(x, y, new):
    n, d = x.shape
    pooled = np.maximum(x.var(axis=0), quality.LEAST_VARIANCE)
    density = []
    for c in (0, 1):
        own = x[y == c]
        weight = max(quality.SHRINKAGE, d / (len(own) + d))
        spread = (1 - weight) * np.cov(own.T, bias=True) + weight * np.diag(pooled) + 1e-9 * np.eye(d)
        off = new - own.mean(axis=0)
        density.append(np.log(len(own) / n) - 0.5 * np.linalg.slogdet(spread)[1] - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off))
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def test_discriminant_by_its_definition(spark):
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.normal(0, 1, (80, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0], [0, 0, 2.0]]), draw.normal(1.5, 1, (120, 3))])
    y = np.repeat([0, 1], [80, 120])
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(y, x, strict=True)], "quality int, features array<double>").repartition(5)
    model = quality.fit(rows)
    assert np.allclose(model.scores(x), plain_scores(x, y, x), atol=1e-9)
    scored = rows.select("features", quality.score(F.col("features"), model).alias("s")).collect()
    assert np.allclose([r.s for r in scored], model.scores(np.array([r.features for r in scored])))


def test_labels_that_do_not_train(spark):
    described = spark.createDataFrame([(i, [float(i)]) for i in range(20)] + [(None, [1.0])], "doc_id long, features array<double>")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(15)] + [(None, 1, 0), (16, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    import zlib

    rows = quality.training_rows(described, labels).collect()
    assert sorted(r.features[0] for r in rows) == [float(i) for i in range(15) if zlib.crc32(str(i).encode()) % 5]


def test_one_class_or_none(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int")
    for given, wanted in ((labels, 1.0), (labels.limit(0), 0.5), (labels.withColumn("quality", F.lit(0)), 0.0)):
        model = quality.fit_documents(hard, given)
        assert {r.s for r in hard.select(quality.score(quality.features(F.col("text")), model).alias("s")).collect()} == {wanted}
    assert quality.keep(hard, quality.fit_documents(hard, labels)).columns == hard.columns
    assert quality.keep(nothing, quality.fit_documents(nothing, labels)).count() == 0
    assert all(np.isfinite(quality.transformed(t)).all() for t in (b"", b" ", "é".encode(), b"1"))


def test_statistics_of_the_quality_model(texts):
    """The twelve statistics, written out with regular expressions and plain counts."""
    def plain_statistics(t):
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", t), [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, chars, n_lines = max(len(words), 1), max(sum(map(len, words)), 1), max(len(lines), 1)
        upper, lower, digits = (len(re.findall(p, t)) for p in ("[A-Z]", "[a-z]", "[0-9]"))
        beyond = sum(ord(c) > 127 for c in t)
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        counts = Counter(words)
        entropy = 1.0 if len(words) < 2 else -sum(c / len(words) * math.log2(c / len(words)) for c in counts.values()) / math.log2(len(words))
        metrics = plain_metrics(t)
        repeats, duplicates = metrics[rules.METRICS.index("n_repeat_words")], metrics[rules.METRICS.index("n_dup_lines")]
        return [math.log1p(len(words)), math.log(chars / n + 0.1), math.log(symbols / chars + 0.001), math.log(upper / max(upper + lower, 1) + 0.01),
                math.log(digits / chars + 0.001), math.log(max(chars - upper - lower - digits - beyond, 0) / chars + 0.01),
                math.sqrt(duplicates / n_lines), math.sqrt(repeats / n), math.log(n / n_lines), entropy, beyond / chars, math.log(len(counts) / n + 0.001)]

    for t in [*texts, "A a A a\n\nA a A a\n x", "é É é 12 #", "a b c d e f g h " * 5]:
        assert quality.transformed(t.encode()) == pytest.approx(plain_statistics(t), abs=1e-9), t[:80]
