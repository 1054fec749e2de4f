"""Unigram and bigram counts and pointwise mutual information (PMI)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions import text
from rankweave.operators.index import Index, field_tokens
from rankweave.operators.joins import fits_in_memory, frequent_keys, lookup_join
from rankweave.session import materialize

# Fixed value: the score of a pair that never occurs.
NO_PAIR = -20.0


def successor_counts(tokens: DataFrame, weight: str | None = None) -> DataFrame:
    """(t1, t2, n) from (docid, tokens): how often t2 follows t1 in a document; t2 is null where t1 ends one.

    Every token is the t1 of exactly one pair, so unigram counts are sums over these rows. With `weight`, a column of
    whole numbers, a document counts so many times without being copied.
    """
    if weight:
        pairs = tokens.select(F.col(weight).alias("_times"), F.inline(text.with_next(F.col("tokens"))))
        return pairs.groupBy("t1", "t2").agg(F.sum("_times").alias("n"))
    pairs = tokens.select(F.inline(text.with_next(F.col("tokens"))))
    return pairs.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"))


def unigram_counts(successors: DataFrame) -> DataFrame:
    """(term, n)."""
    return successors.groupBy(F.col("t1").alias("term")).agg(F.sum("n").alias("n"))


def bigram_counts(successors: DataFrame) -> DataFrame:
    """(t1, t2, n)."""
    return successors.filter(F.col("t2").isNotNull())


def pmi(bigrams: DataFrame, unigrams: DataFrame, n_tokens: int, unigrams_fit: bool = False) -> DataFrame:
    """(t1, t2, n, pmi) with pmi = ln( (n12/N) / ((n1/N)(n2/N)) ) for every pair that occurs.

    A frequent term starts or ends very many pairs, so the counts are looked up by broadcast or with salt. Its count bounds its
    pairs and tells whether it needs salt.
    """
    first = unigrams.select(F.col("term").alias("t1"), F.col("n").alias("_n1"))
    second = unigrams.select(F.col("term").alias("t2"), F.col("n").alias("_n2"))
    counts = lookup_join(bigrams, first, ["t1"], ["t2"], unigrams_fit, frequent=frequent_keys(first, ["t1"], "_n1"))
    counts = lookup_join(counts, second, ["t2"], ["t1"], unigrams_fit, frequent=frequent_keys(second, ["t2"], "_n2"))
    total = F.lit(float(n_tokens))
    return counts.select("t1", "t2", "n", F.log(F.col("n") * total / (F.col("_n1") * F.col("_n2"))).alias("pmi"))


def corpus_pmi(docs: DataFrame, stem: bool = False) -> DataFrame:
    """PMI of all neighbouring terms in the bodies of `docs`, which are read and analysed once.

    A pair that is missing from the result scores `NO_PAIR`.
    """
    return _pmi_of(successor_counts(field_tokens(docs, ("body",), stem)))


def drawn_pmi(corpus: DataFrame, stem: bool = False) -> DataFrame:
    """PMI over `corpus(docid, copies, body)`, where a document counts as often as it was drawn."""
    tokens = corpus.repartition("docid").select("copies", F.explode(F.array(text.analyze(F.col("body"), stem))).alias("tokens"))
    return _pmi_of(successor_counts(tokens, "copies"))


def _pmi_of(counts: DataFrame) -> DataFrame:
    successors = materialize(counts, "successors")
    n_tokens = successors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    unigrams = unigram_counts(successors)
    return pmi(bigram_counts(successors), unigrams, n_tokens, fits_in_memory(unigrams))


def vocabulary_pmi(docs: DataFrame, index: Index, vocabulary: DataFrame, vocabulary_fits: bool) -> DataFrame:
    """PMI of the pairs whose first term is in `vocabulary(term)`, for the collection behind `index`.

    Only those pairs are counted and shuffled; unigram counts come from the index.
    """
    wanted = vocabulary.select(F.col("term").alias("t1"))
    pairs = field_tokens(docs, ("body",), index.stem).select("docid", F.inline(text.with_next(F.col("tokens"))))
    pairs = lookup_join(pairs.filter(F.col("t2").isNotNull()), wanted, ["t1"], ["docid", "t2"], vocabulary_fits,
                        "left_semi")
    bigrams = pairs.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"))
    unigrams = index.term_stats().filter(F.col("field") == "body").select("term", F.col("cf").alias("n"))
    return pmi(bigrams, unigrams, index.totals()["body"].field_len, fits_in_memory(unigrams))
