"""Language identification by error-correcting output codes.

Each language gets a codeword; each bit of the code is a binary classifier over hashed byte n-grams (two and three
bytes). A classifier's weights are the smoothed log odds of an n-gram among the languages whose bit is 1 against those
whose bit is 0, every language counting alike. The counts come from all training rows, added up in Spark as one vector
per language. A text's margin for a bit is the mean weight of its n-grams. Decoding adds up a logistic loss per bit,
weighted by how well the bit's classifier does on a bounded sample of training rows, and takes the codeword with the
least loss. The score is that codeword's share under a softmax of the losses; a text is flagged as ambiguous when the
runner-up is close or when more bits disagree with the codeword than the code can correct.

Up to seven languages use the exhaustive code; more use the seeded random code with the largest least distance.

Rows: texts that are null or have no letter are `und` with score 0 and do not train, nor do rows without language.
More than MOST_LANGUAGES languages are an error.
With no language learned everything is `und`; with one language learned it is given to every text with a letter.
Whole texts are read, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import arrow_function, column, utf8

DIMENSIONS = 1 << 13
SMOOTHING = 0.5
TUNING_ROWS = 4_000
MOST_LANGUAGES = 1_000
AMBIGUOUS_SHARE = 0.6
SHARPNESS = 4.0
UNKNOWN = "und"
RESULT = "struct<lang:string,score:double,ambiguous:boolean>"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(data: bytes) -> bool:
    return bool(_ASCII_LETTER.search(data)) or (not data.isascii() and any(map(str.isalpha, data.decode("utf-8", "replace"))))


def gram_counts(data: bytes) -> np.ndarray:
    """Hashed counts of the two- and three-byte runs of a text, ASCII letters in lower case."""
    b = np.frombuffer(b" " + data.lower() + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    codes = [(two * np.uint32(2654435761)) >> shift, (three * np.uint32(2246822519)) >> shift]
    return np.bincount(np.concatenate(codes).astype(np.int64), minlength=DIMENSIONS)


def codewords(n: int, seed: int = 5, tries: int = 200) -> np.ndarray:
    """n codewords of 0 and 1 as rows."""
    if n <= 1:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        # every split of the languages into two non-empty sides, once
        return np.array([[(split >> row) & 1 for split in range(1, 2**n - 1) if split & 1] for row in range(n)], np.int8)
    draw, bits, best, best_distance = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(n))), None, -1
    for _ in range(tries):
        code = draw.integers(0, 2, (n, bits)).astype(np.int8)
        code = code[:, (code.min(axis=0) == 0) & (code.max(axis=0) == 1)]
        distance = least_distance(code)
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def least_distance(code: np.ndarray) -> int:
    return min((int((code[i] != code[j]).sum()) for i in range(len(code)) for j in range(i)), default=0)


@dataclass(frozen=True)
class LanguageCode:
    """languages in order of name; code: codewords in rows; weights: one column per bit; bit_weight and scale per bit."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bit_weight: np.ndarray
    scale: np.ndarray

    def margins(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), self.weights.shape[1]))
        for i, data in enumerate(texts):
            counts = gram_counts(data)
            out[i] = counts.astype(np.float32) @ self.weights / max(counts.sum(), 1)
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous) of each row of margins."""
        sign = 2.0 * self.code - 1.0
        loss = np.log1p(np.exp(-np.clip((margins / self.scale)[:, None, :] * sign[None], -50, 50))) @ self.bit_weight
        share = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        errors = ((margins > 0) != (self.code[best] > 0)).sum(axis=1)
        score = share[np.arange(len(best)), best]
        return best, score, (score < AMBIGUOUS_SHARE) | (2 * errors >= max(least_distance(self.code), 1))


def language_counts(rows: DataFrame) -> DataFrame:
    """(lang, place, value): hashed n-gram shares of the training rows (lang, text), added up by language.

    A document adds as many counts as it has n-grams, so long texts weigh more; the model learns whole texts alike,
    however they are cut into documents.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
                if has_letter(data):
                    total.setdefault(lang, np.zeros(DIMENSIONS, np.int64))
                    total[lang] += gram_counts(data)
        for lang, counts in total.items():
            place = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(place)), "place": pa.array(place, pa.int32()), "value": pa.array(counts[place], pa.int64())})

    parts = rows.select("lang", "text").mapInArrow(sums, "lang string, place int, value long")
    return parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", tuning_rows: int = TUNING_ROWS, seed: int = 9) -> LanguageCode:
    """A code from all rows with a language. The driver gets DIMENSIONS numbers per language, and more than
    MOST_LANGUAGES languages are refused; `tuning_rows` bounds the sample that weighs the bits."""
    rows = docs.select(column(lang).cast("string").alias("lang"), column(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    if rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts: dict[str, np.ndarray] = {}
    for r in language_counts(rows).collect():
        counts.setdefault(r.lang, np.zeros(DIMENSIONS))[r.place] = r.value
    languages = tuple(sorted(counts))
    code = codewords(len(languages))
    if not code.shape[1]:
        return LanguageCode(languages, code, np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0), np.ones(0))
    share = np.array([(counts[x] + SMOOTHING) / (counts[x] + SMOOTHING).sum() for x in languages])
    sides = [(share[code[:, bit] == 1].mean(axis=0), share[code[:, bit] == 0].mean(axis=0)) for bit in range(code.shape[1])]
    weights = np.stack([np.log(one) - np.log(zero) for one, zero in sides], axis=1).astype(np.float32)
    draft = LanguageCode(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))
    total = rows.count()
    sample = rows.sample(min(1.0, tuning_rows / max(total, 1)), seed)
    scale, right = _tuned(sample, draft)
    bit_weight = np.log(np.clip(right, 0.51, 0.999) / (1 - np.clip(right, 0.51, 0.999)))
    return LanguageCode(languages, code, weights, bit_weight / bit_weight.sum() * code.shape[1], scale)


def _tuned(sample: DataFrame, draft: LanguageCode) -> tuple[np.ndarray, np.ndarray]:
    """Per bit: the mean size of a margin, and the share of sampled rows whose bit is told right."""
    bits = draft.code.shape[1]
    number = {x: i for i, x in enumerate(draft.languages)}

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), utf8(batch.column("text"))
            known = [(number[a], b) for a, b in zip(langs, texts, strict=True) if a in number and has_letter(b)]
            if known:
                margin = draft.margins([b for _, b in known])
                right = (margin > 0) == (draft.code[[a for a, _ in known]] > 0)
                yield pa.RecordBatch.from_pydict({
                    "bit": pa.array(np.arange(bits), pa.int32()), "size": pa.array(np.abs(margin).sum(axis=0)),
                    "right": pa.array(right.sum(axis=0), pa.int64()), "n": pa.array([len(known)] * bits, pa.int64())})

    totals = sample.mapInArrow(tell, "bit int, size double, right long, n long").groupBy("bit").agg(
        F.sum("size").alias("size"), F.sum("right").alias("right"), F.sum("n").alias("n"))
    scale, right = np.ones(bits), np.full(bits, 0.9)
    for r in totals.collect():
        scale[r.bit], right[r.bit] = max(r["size"] / r.n, 1e-6), r.right / r.n
    return scale, right


def predict(text: Column, model: LanguageCode) -> Column:
    """struct<lang, score, ambiguous> of a text."""

    def make():
        def apply(texts: pa.Array) -> pa.Array:
            data = utf8(texts)
            known = [i for i, x in enumerate(data) if model.languages and has_letter(x)]
            lang, score, flag = [UNKNOWN] * len(data), np.zeros(len(data)), np.zeros(len(data), bool)
            if known and model.code.shape[1]:
                best, share, unclear = model.decode(model.margins([data[i] for i in known]))
                for i, b in zip(known, best, strict=True):
                    lang[i] = model.languages[b]
                score[known], flag[known] = share, unclear
            elif known:
                for i in known:
                    lang[i] = model.languages[0]
                score[known] = 1.0
            return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(flag)], names=["lang", "score", "ambiguous"])

        return apply

    return arrow_function(make, RESULT)(text)
