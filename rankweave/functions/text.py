"""Text analysis as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankweave.functions.stemming import stem_tokens

# The English stop list, the shortest token kept, and the token shape
# (word characters, with single dots allowed between them).
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "for", "from", "have", "if", "in", "is", "it", "may",
    "not", "of", "on", "or", "tbd", "that", "the", "this", "to", "us", "we", "when", "will", "with", "yet", "you",
    "your",
)
MIN_TOKEN_LENGTH = 2
# Possessive quantifiers match the same strings and keep the Java matcher from recursing on long dotted runs.
TOKEN_PATTERN = r"[\p{L}\p{N}_]++(?:\.[\p{L}\p{N}_]++)*+"
SNIPPET_LENGTH = 250


def tokenize(text: Column) -> Column:
    """Lower-cased tokens in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def analyze(text: Column, stem: bool = False) -> Column:
    """Tokens without stop words and one-character tokens, optionally stemmed; null text gives no tokens."""
    kept = F.filter(
        tokenize(F.coalesce(text, F.lit(""))),
        lambda token: (F.length(token) >= MIN_TOKEN_LENGTH) & ~token.isin(*STOP_WORDS),
    )
    return stem_tokens(kept) if stem else kept


def url_text(url: Column) -> Column:
    """A URL as analysable text: dots separate words."""
    return F.replace(url, F.lit("."), F.lit(" "))


def slash_count(url: Column) -> Column:
    return (F.length(url) - F.length(F.replace(url, F.lit("/"), F.lit("")))).cast("long")


def snippet(body: Column, length: int = SNIPPET_LENGTH) -> Column:
    return F.substring(body, 1, length)


def with_next(tokens: Column) -> Column:
    """Every token with the one after it, as structs (t1, t2); t2 is null for the last token."""
    return F.transform(tokens, lambda token, i: F.struct(token.alias("t1"), F.get(tokens, i + 1).alias("t2")))
