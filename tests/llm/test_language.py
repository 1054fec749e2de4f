import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import language

SYLLABLES = {"en": "the ing ion and er ough".split(), "de": "sch ung ein der über ich".split(), "fr": "eau ét les ment que ou".split(),
             "es": "ción los que ado ar ño".split(), "xx": "то на ой и ст".split()}


def sample(lang, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(40))


def test_codes_correct_errors():
    for n in (2, 3, 4, 7):
        code = language.codewords(n)
        assert code.shape == (n, 2 ** (n - 1) - 1) and len({tuple(c) for c in code.T}) == code.shape[1]
    wide = language.codewords(12)
    assert len(wide) == 12 and language.least_distance(wide) >= 10
    assert language.codewords(1).shape == (1, 0)


def test_counts_of_grams():
    assert language.gram_counts(b"ab").sum() == 3 + 2
    assert (language.gram_counts(b"AB") == language.gram_counts(b"ab")).all()


def test_held_out_accuracy(spark):
    rows = [(i, sample(lang, i), lang) for lang in SYLLABLES for i in range(60)]
    rows += [(900 + i, sample("en", 900 + i), None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.filter("doc_id < 40"))
    assert model.languages == tuple(sorted(SYLLABLES))
    told = docs.filter("doc_id >= 40 AND lang IS NOT NULL").select("lang", language.predict(F.col("text"), model).alias("told")).collect()
    assert np.mean([r.lang == r.told.lang for r in told]) > 0.98
    assert all(0 <= r.told.score <= 1 for r in told)


def plain_decision(text, training, tuning):
    """Profiles, classifiers, loss weights and decoding of the definition, with dictionaries and loops."""
    def grams(t):
        b = b" " + t.encode().lower() + b" "
        out = Counter()
        for i in range(len(b) - 1):
            two = b[i] << 8 | b[i + 1]
            out[two * 2654435761 % 2**32 >> 19] += 1
            if i + 2 < len(b):
                out[(two << 8 | b[i + 2]) % 2**32 * 2246822519 % 2**32 >> 19] += 1
        return out

    names = sorted({lang for lang, _ in training})
    profile = {lang: Counter() for lang in names}
    for lang, t in training:
        profile[lang].update(grams(t))
    share = {lang: {g: (profile[lang][g] + 0.5) / (sum(profile[lang].values()) + 0.5 * 8192) for g in range(8192)} for lang in names}
    code = language.codewords(len(names)).tolist()
    bits = range(len(code[0]))

    def weight(bit, g):
        ones, zeros = ([share[lang][g] for lang, word in zip(names, code) if word[bit] == v] for v in (1, 0))
        return math.log(sum(ones) / len(ones)) - math.log(sum(zeros) / len(zeros))

    cache = {}

    def margin(t, bit):
        counts = grams(t)
        return sum(n * cache.setdefault((bit, g), weight(bit, g)) for g, n in counts.items()) / sum(counts.values())

    scale, trust = [], []
    for bit in bits:
        margins = [(lang, margin(t, bit)) for lang, t in tuning]
        scale.append(max(sum(abs(m) for _, m in margins) / len(margins), 1e-6))
        right = sum((m > 0) == (code[names.index(lang)][bit] > 0) for lang, m in margins) / len(margins)
        right = min(max(right, 0.51), 0.999)
        trust.append(math.log(right / (1 - right)))
    loss = [sum(trust[bit] * len(bits) / sum(trust) * math.log1p(math.exp(-(2 * word[bit] - 1) * margin(text, bit) / scale[bit])) for bit in bits) for word in code]
    share = [math.exp(-4 * (x - min(loss))) for x in loss]
    best = loss.index(min(loss))
    return names[best], share[best] / sum(share)


def test_against_a_plain_version(spark):
    rows = [(i, sample(lang, i), lang) for lang in ("en", "de", "fr", "es") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)  # fewer rows than the tuning sample takes: all of them weigh the bits
    training = [(lang, text) for _, text, lang in rows]
    asked = [sample(lang, 100 + i) for lang in ("en", "de", "fr") for i in range(2)] + [sample("en", 7) + " " + sample("de", 7), "x", "The"]
    told = spark.createDataFrame([(t,) for t in asked], "text string").select("text", language.predict(F.col("text"), model).alias("told")).collect()
    for r in told:
        lang, score = plain_decision(r.text, training, training)
        assert r.told.lang == lang and abs(r.told.score - score) < 1e-4, r.text


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError):
        language.fit(spark.createDataFrame([("a b", x) for x in "abc"], "text string, lang string"))


def test_mixed_text_is_flagged(spark):
    rows = [(i, sample(lang, i), lang) for lang in ("en", "de") for i in range(40)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    margins = model.margins([sample("en", 99).encode()])
    _, sure, _ = model.decode(margins)
    _, unsure, flag = model.decode(margins * 0)
    assert sure[0] > 0.9 and abs(unsure[0] - 0.5) < 1e-9 and flag[0]


def test_hard_rows(spark, hard, nothing):
    model = language.fit(hard)
    told = {(r.doc_id, r.text): r.told for r in hard.select("doc_id", "text", language.predict(F.col("text"), model).alias("told")).collect()}
    for (_, text), r in told.items():
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang, r.score) == ("und", 0.0)
        else:
            assert r.lang in ("en", "de")
    none = language.fit(nothing)
    assert {r.told.lang for r in hard.select(language.predict(F.col("text"), none).alias("told")).collect()} == {"und"}
    one = language.fit(hard.filter("lang = 'de'"))
    assert {r.told.lang for r in hard.select(language.predict(F.col("text"), one).alias("told")).collect()} == {"und", "de"}
