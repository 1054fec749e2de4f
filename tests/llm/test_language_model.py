import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import language_model as lm
from rankweave.llm.common import remainder

from .conftest import prose


class PlainModel:
    """The same model by its definition, from plain counters."""

    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in self.tokens(t))
        self.tokens_seen = sum(self.words.values())
        self.counts, self.total, self.kinds = defaultdict(Counter), Counter(), Counter()
        for t in texts:
            s = self.spelled(t)
            for i in range(1, len(s)):
                for k in range(min(lm.ORDER, i + 1)):
                    self.counts[s[i - k:i]][s[i]] += 1
        self.p = lru_cache(None)(self._p)

    @staticmethod
    def tokens(text):
        return [*text.lower().split(), b"\n"]

    def spelled(self, text):
        return b"\n" + b"".join(w if w == b"\n" else w + b" " for w in self.tokens(text))

    def _p(self, context, symbol):
        lower = self.p(context[1:], symbol) if context else 1 / 256
        seen = self.counts.get(context)
        if not seen:
            return lower
        return (max(seen[symbol] - lm.DISCOUNT, 0) + lm.DISCOUNT * len(seen) * lower) / sum(seen.values())

    def score(self, text):
        s, at, total, base = self.spelled(text), 1, 0.0, 0.0
        for w in self.tokens(text):
            n = 1 if w == b"\n" else len(w) + 1
            spelling = math.prod(self.p(s[max(0, i - lm.ORDER + 1):i], s[i]) for i in range(at, at + n))
            at += n
            share = lm.WORD_SHARE if self.tokens_seen else 0.0
            total += math.log10(share * self.words[w] / max(self.tokens_seen, 1) + (1 - share) * spelling)
            base += math.log10((self.words[w] + 0.1) / (self.tokens_seen + 0.1 * (len(self.words) + 1)))
        return base, total


def compare(df, held_out, rows):
    trained = [(t or "").encode() for t, h in rows if not h]
    model = PlainModel(trained)
    found = lm.score_documents(df, held_out).collect()
    assert len(found) == len(rows)
    wanted = Counter()
    for t, h in rows:
        text = (t or "").encode()
        base, total = model.score(text)
        known = sum(model.words[w] > 0 for w in model.tokens(text))
        wanted[h, len(model.tokens(text)), known, model.tokens_seen, round(base, 6), round(total, 6)] += 1
    got = Counter((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found)
    assert got == wanted


@pytest.mark.parametrize("block", [1, 500, 16 << 20])
def test_scores_by_the_definition(spark, hard, hard_rows, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm, "STREAM_BYTES", 200)
    monkeypatch.setattr(lm, "SLICE", 37)
    short = hard.filter("doc_id IS NULL OR doc_id NOT IN (4, 10)")
    rows = [(r[1], zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 0) for r in hard_rows if r[0] not in (4, 10)]
    compare(short, remainder(F.col("doc_id"), 3) == 0, rows)


def test_nothing_to_learn_from(spark, nothing):
    rows = [(1, "Some text"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    compare(df, F.lit(True), [(t, True) for _, t in rows])
    assert lm.score_documents(nothing, F.lit(False)).count() == 0


def test_very_long_text_is_scored_whole(spark, hard):
    r = {r.doc_id: r for r in lm.score_documents(hard, F.lit(False)).collect()}
    assert r[4].n_tokens == 60_001 and r[10].n_tokens == 2 and r[4].score < r[1].score < 0


def test_probabilities_add_up():
    texts = [prose(1, 30).encode(), b"ab ab abc", b""]
    model = PlainModel(texts)
    for context in (b"", b"a", b"\n", b"ab ", b"zzz", b"\nab ab"[-5:]):
        assert abs(sum(model.p(context, s) for s in range(256)) - 1) < 1e-9


def test_walk_equals_definition_after_any_state():
    texts = [prose(7, 40).encode(), b"aaaa aaa aa a"]
    model = PlainModel(texts)
    stream = b"".join(model.spelled(t)[1:] for t in texts)
    grams, counts = lm.all_orders(*lm.counted_grams(b"\n" + stream))
    place = {int(g): i for i, g in enumerate(grams)}
    grams, counts = np.append(grams, lm.ROOT), np.append(counts, 0)
    total, kinds = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
    place[lm.ROOT] = len(grams) - 1
    for g, n in zip(grams.tolist(), counts.tolist(), strict=True):
        if n and g >> 8 in place:
            total[place[g >> 8]] += n
            kinds[place[g >> 8]] += 1
    automaton = lm.Automaton(grams, counts, total, kinds)
    for text in (b"stone9 aab zq\x00 \xff\xfe", texts[0], b"a" * 50):
        s = b"\n" + text
        wanted = sum(math.log10(model.p(s[max(0, i - lm.ORDER + 1):i], s[i])) for i in range(1, len(s)))
        assert abs(automaton.walk(automaton.start, text)[0] - wanted) < 1e-8


def test_packed_numbers():
    draw = np.random.default_rng(1)
    for numbers in ([], [0], [127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1], draw.integers(0, 2**28, 500).tolist(), draw.integers(0, 300, 500).tolist()):
        assert lm.unpacked_numbers(lm.packed_numbers(np.array(numbers, np.int64))).tolist() == numbers


def test_contexts_have_five_bytes(spark):
    """What follows "bcde" is told by the byte before it only."""
    rows = [(i, ("abcdex", "zbcdey")[i % 2], False) for i in range(20)] + [(20, "abcdexq", True), (21, "abcdeyq", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    score = {r.doc_id: r.score for r in lm.score_documents(df, F.col("held_out")).collect()}
    assert score[20] > score[21] + 0.5
    assert int.from_bytes(b"\x01cdefgh", "big") in lm.counted_grams(b"\nabcdefgh")[0].tolist()


def test_ngrams_are_shuffled_once_for_their_counts_and_their_contexts(spark):
    docs = spark.createDataFrame([(i, i % 3 == 0, prose(i, 20)) for i in range(12)], "doc_id long, held_out boolean, text string")
    gathered = lm.materialize(lm._gathered(docs), "gathered")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lm._counts(gathered)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert "ReusedExchange" in plan
    roots = gathered.filter((F.col("kind") == lm.GRAM) & (F.col("key") == lm.ROOT))
    assert roots.agg(F.max("n")).first()[0] == 0
