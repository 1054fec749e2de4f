"""English suffix stripping (Porter 1980, in the form its author later published).

`stem_tokens` runs over Arrow batches and stems each distinct token of a batch once, so it needs no shuffle;
`stem_vocabulary` is the same work as a job over a table of distinct terms.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the functions themselves, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Suffix pairs of the published algorithm.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """One letter per character: v for a vowel sound, c otherwise (y is a vowel after a consonant)."""
    shape = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and shape[-1] == "c")
        shape.append("v" if vowel else "c")
    return "".join(shape)


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _has_vowel(word: str) -> bool:
    return "v" in _shape(word)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _swap(word: str, pairs) -> str:
    matches = [pair for pair in pairs if word.endswith(pair[0])]
    if not matches:
        return word
    old, new = max(matches, key=lambda pair: len(pair[0]))
    root = word[: len(word) - len(old)]
    return root + new if _measure(root) > 0 else word


def _plural(word: str) -> str:
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = next((e for e in ("ed", "ing") if word.endswith(e)), None)
    if ending is None or not _has_vowel(word[: -len(ending)]):
        return word
    root = word[: -len(ending)]
    if root.endswith(("at", "bl", "iz")):
        return root + "e"
    if _double_consonant(root) and root[-1] not in "lsz":
        return root[:-1]
    if _measure(root) == 1 and _short_end(root):
        return root + "e"
    return root


def _strip(word: str) -> str:
    endings = [e for e in STEP4 if word.endswith(e)]
    if not endings:
        return word
    ending = max(endings, key=len)
    root = word[: len(word) - len(ending)]
    if _measure(root) < 2 or (ending == "ion" and not root.endswith(("s", "t"))):
        return word
    return root


def _tidy(word: str) -> str:
    if word.endswith("e"):
        root = word[:-1]
        m = _measure(root)
        if m > 1 or (m == 1 and not _short_end(root)):
            word = root
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem(word: str) -> str:
    if len(word) < 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    return _tidy(_strip(_swap(_swap(word, STEP2), STEP3)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pd.Series) -> pd.Series:
    sizes = tokens.map(len).to_numpy()
    if not sizes.sum():
        return tokens
    codes, words = pd.factorize(np.concatenate(tokens.to_numpy()))
    stems = np.array([stem(word) for word in words], dtype=object)[codes]
    return pd.Series(np.split(stems, np.cumsum(sizes)[:-1]), index=tokens.index)


@F.pandas_udf(T.StringType())
def stem_term(terms: pd.Series) -> pd.Series:
    return terms.map(stem)


def stem_vocabulary(terms: DataFrame, column: str = "term") -> DataFrame:
    """One row (term, stem) per distinct term."""
    return terms.select(F.col(column).alias("term")).distinct().select("term", stem_term(F.col("term")).alias("stem"))
