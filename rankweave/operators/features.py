"""Query-document and query feature vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions import scoring, text
from rankweave.functions.scoring import DIRICHLET_MU, JM_LONG, JM_LONG_FROM, JM_SHORT, finite_or, signed_log
from rankweave.operators.cooccurrence import NO_PAIR
from rankweave.operators.index import FIELDS, Index
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.search import query_terms

# Names of the per-term values, in the order of the vector.
SUMMED = ("tf", "idf", "ntf_idf", "inv_cf", "ntf", "ntf_inv_cf", "bm25", "kl")
MULTIPLIED = ("jm", "dirichlet")
FIELD_FEATURES = tuple(f"{how}_{name}" for how in ("mean", "max", "sum") for name in SUMMED) + tuple(
    f"prod_{name}" for name in MULTIPLIED
)
STATIC_FEATURES = ("len_body", "len_title", "len_url_text", "slashes", "url_chars")
PMI_FEATURES = tuple(f"pmi_{how}_{field}" for field in FIELDS for how in ("sum", "max", "mean"))
VECTOR = tuple(f"{field}_{name}" for field in FIELDS for name in FIELD_FEATURES) + STATIC_FEATURES + PMI_FEATURES
QUERY_VALUES = ("idf", "cf", "cf_idf", "inv_cf", "pmi")
QUERY_FEATURES = tuple(f"{how}_{name}" for how in ("mean", "max", "sum") for name in QUERY_VALUES) + ("length",)


def term_values(n_docs: Column, field_len: Column, compat: bool = False) -> dict[str, Column]:
    """The ten values of one matched term, from columns tf, dl, df, cf, q_len.

    `compat=True` feeds the collection count instead of the document count into the BM25 value.
    """
    tf, dl, df, q_len = F.col("tf"), F.col("dl"), F.col("df"), F.col("q_len")
    cf1 = F.col("cf") + 1
    idf = F.log(n_docs / (df + 1))
    ntf = tf / dl
    mix = F.when(q_len > JM_LONG_FROM, F.lit(JM_LONG)).otherwise(F.lit(JM_SHORT))
    bm25_tf = cf1 if compat else tf
    return {
        "tf": tf.cast("double"),
        "idf": idf,
        "ntf_idf": ntf * idf,
        "inv_cf": n_docs / cf1,
        "ntf": ntf,
        "ntf_inv_cf": tf * n_docs / (dl * cf1),
        "bm25": scoring.okapi(scoring.Stats(n_docs, df, bm25_tf, dl, field_len / n_docs)),
        "kl": finite_or(-F.log(ntf + 1) / q_len, 0.0),
        "jm": mix * ntf + (1 - mix) * cf1 / field_len,
        "dirichlet": (tf + DIRICHLET_MU * cf1 / field_len) / (dl + DIRICHLET_MU),
    }


def matched_values(pairs: DataFrame, terms: DataFrame, small: bool, index: Index, fields: tuple[str, ...] = FIELDS,
                   compat: bool = False) -> DataFrame:
    """(qid, docid, field, the ten values) for every query term found in a field of a paired document."""
    stats = index.term_stats(terms.select("term").distinct(), small)
    wanted = pairs.select("qid", "docid").join(terms, "qid")
    postings = index.postings.filter(F.col("field").isin(*fields)).select("field", "docid", "dl", "term", "tf")
    vocabulary = terms.select("term").distinct()
    postings = lookup_join(postings, vocabulary, ["term"], ["docid"], small, "left_semi")
    ids = pairs.select("docid").distinct()
    postings = lookup_join(postings, ids, ["docid"], ["term"], fits_in_memory(ids), "left_semi")
    few = fits_in_memory(stats)
    found = lookup_join(postings.join(wanted, ["docid", "term"]), stats, ["field", "term"], ["qid", "docid"], few)
    totals = index.totals()
    n_docs = F.lit(float(next(iter(totals.values())).n_docs))
    field_len = F.lit(None).cast("double")
    for name in fields:
        if name in totals:
            field_len = F.when(F.col("field") == name, F.lit(float(totals[name].field_len))).otherwise(field_len)
    values = term_values(n_docs, field_len, compat)
    return found.select("qid", "docid", "field", *[value.alias(name) for name, value in values.items()])


def field_features(values: DataFrame) -> DataFrame:
    """(qid, docid, field, 26 features): ln(x + 1) of the mean, maximum, sum and product over the matched terms."""

    def damped(x: Column) -> Column:
        return F.when(x > -1, F.log(x + 1)) + F.lit(0.0)

    reduced = values.groupBy("qid", "docid", "field").agg(
        *[F.avg(name).alias(f"mean_{name}") for name in SUMMED],
        *[F.max(name).alias(f"max_{name}") for name in SUMMED],
        *[F.sum(name).alias(f"sum_{name}") for name in SUMMED],
        *[F.product(name).alias(f"prod_{name}") for name in MULTIPLIED],
    )
    return reduced.select("qid", "docid", "field", *[damped(F.col(name)).alias(name) for name in FIELD_FEATURES])


def static_features(pairs: DataFrame, docs: DataFrame, index: Index) -> DataFrame:
    """(docid, field lengths, slash count, URL length) of the paired documents, each as ln(x + 1).

    Lengths come from the index, so of `docs` only docid and url are read.
    """
    ids = pairs.select("docid").distinct()
    lengths = _lengths(pairs, index)
    urls = docs.select("docid", "url").join(ids, "docid", "left_semi").select(
        "docid", text.slash_count(F.col("url")).alias("slashes"), F.length("url").alias("url_chars")
    )
    counted = urls.join(lengths, "docid", "left")
    return counted.select(
        "docid", *[F.log(F.coalesce(F.col(name), F.lit(0)) + 1.0).alias(name) for name in STATIC_FEATURES]
    )


def _lengths(pairs: DataFrame, index: Index) -> DataFrame:
    """(docid, len_body, len_title, len_url_text) of the paired documents; null where a field has no tokens."""
    ids = pairs.select("docid").distinct()
    return index.doc_len().join(ids, "docid", "left_semi").groupBy("docid").agg(
        *[F.max(F.when(F.col("field") == f, F.col("dl"))).alias(f"len_{f}") for f in FIELDS]
    )


def pmi_features(pairs: DataFrame, terms: DataFrame, small: bool, index: Index, pmi: DataFrame) -> DataFrame:
    """(qid, docid, nine PMI features): sum, maximum and mean over query terms x field tokens.

    Only pairs that occur are joined. Of the |q| * dl pairs of a field, the rest score `NO_PAIR` each, which is
    added by counting. `pmi` may hold more pairs than the queries need.
    """
    first = terms.select("qid", F.col("term").alias("t1"), "qtf")
    after = (
        lookup_join(pmi.select("t1", "t2", "pmi"), first, ["t1"], ["t2"], small)
        .groupBy("qid", F.col("t2").alias("term"))
        .agg(
            F.sum(F.col("qtf") * F.col("pmi")).alias("w_sum"),
            F.max("pmi").alias("w_max"),
            F.sum("qtf").alias("w_count"),
        )
    )
    pairs = pairs.select("qid", "docid")
    few = fits_in_memory(pairs)
    lists = lookup_join(
        index.postings.select("field", "docid", "term", "tf"), pairs, ["docid"], ["term"], few
    )
    hits = lists.join(after, ["qid", "term"]).groupBy("qid", "docid", "field").agg(
        F.sum(F.col("tf") * F.col("w_sum")).alias("hit_sum"),
        F.max("w_max").alias("hit_max"),
        F.sum(F.col("tf") * F.col("w_count")).alias("hits"),
    )
    lengths = _lengths(pairs, index)
    sizes = pairs.join(terms.select("qid", "q_len").distinct(), "qid").join(lengths, "docid").select(
        "qid", "docid",
        F.inline(F.array(*[
            F.struct(F.lit(f).alias("field"), (F.col("q_len") * F.col(f"len_{f}")).alias("pairs")) for f in FIELDS
        ])),
    )
    scored = sizes.filter(F.col("pairs") > 0).join(hits, ["qid", "docid", "field"], "left").select(
        "qid", "docid", "field", "pairs", "hit_max",
        F.coalesce("hit_sum", F.lit(0.0)).alias("hit_sum"), F.coalesce("hits", F.lit(0)).alias("hits"),
    )
    total = F.col("hit_sum") + F.lit(NO_PAIR) * (F.col("pairs") - F.col("hits"))
    best = F.when(F.col("hits") == F.col("pairs"), F.col("hit_max")).otherwise(
        F.greatest(F.coalesce(F.col("hit_max"), F.lit(NO_PAIR)), F.lit(NO_PAIR))
    )
    values = scored.select(
        "qid", "docid", "field",
        signed_log(total).alias("pmi_sum"), signed_log(best).alias("pmi_max"),
        signed_log(total / F.col("pairs")).alias("pmi_mean"),
    )
    per_field = [
        F.coalesce(F.max(F.when(F.col("field") == field, F.col(f"pmi_{how}"))), F.lit(0.0)).alias(f"pmi_{how}_{field}")
        for field in FIELDS for how in ("sum", "max", "mean")
    ]
    return values.groupBy("qid", "docid").agg(*per_field)


def pair_features(pairs: DataFrame, queries: DataFrame, docs: DataFrame, index: Index, pmi: DataFrame | None = None,
                  use_title: bool = True, compat: bool = False, clean: bool = True) -> DataFrame:
    """(qid, docid, features array<double>) for each distinct pair whose query and document exist.

    With `use_title` the vector holds the 92 values named in `VECTOR` (`pmi` is needed), without it the 26 of the
    body. `clean` turns values that are not finite into 0.
    """
    pairs = pairs.select("qid", "docid").distinct()
    asked = queries.join(pairs.select("qid").distinct(), "qid", "left_semi")
    terms = query_terms(asked, index.stem)
    small = fits_in_memory(terms)
    fields = FIELDS if use_title else FIELDS[:1]
    per_field = field_features(matched_values(pairs, terms, small, index, fields, compat))
    blocks = per_field.groupBy("qid", "docid").agg(
        *[F.max(F.when(F.col("field") == f, F.array(*FIELD_FEATURES))).alias(f"_{f}") for f in fields]
    )
    known = pairs.join(queries.select("qid"), "qid", "left_semi")
    zeros = F.array(*[F.lit(0.0)] * len(FIELD_FEATURES))
    parts = [F.coalesce(F.col(f"_{f}"), zeros) for f in fields]
    if use_title:
        rows = known.join(static_features(pairs, docs, index), "docid").join(blocks, ["qid", "docid"], "left")
        rows = rows.join(pmi_features(pairs, terms, small, index, pmi), ["qid", "docid"], "left")
        parts.append(F.array(*STATIC_FEATURES))
        parts.append(F.array(*[F.coalesce(F.col(name), F.lit(0.0)) for name in PMI_FEATURES]))
    else:
        rows = known.join(docs.select("docid"), "docid", "left_semi").join(blocks, ["qid", "docid"], "left")
    vector = F.concat(*parts)
    if clean:
        vector = F.transform(vector, lambda x: finite_or(x, 0.0))
    return rows.select("qid", "docid", vector.alias("features"))


def long_features(features: DataFrame, names: tuple[str, ...] = VECTOR) -> DataFrame:
    """(qid, docid, feat, name, value), one row per vector entry."""
    labels = F.array(*[F.lit(name) for name in names])
    return features.select("qid", "docid", F.posexplode("features").alias("feat", "value")).select(
        "qid", "docid", "feat", F.get(labels, F.col("feat")).alias("name"), "value"
    )


def own_pairs(terms: DataFrame) -> DataFrame:
    """(qid, t1, t2, qtf2): the pairs of each query's own terms; the square of a query's length at most.

    A pair of terms is a key without skew, unlike its first term.
    """
    first = terms.select("qid", F.col("term").alias("t1"))
    return first.join(terms.select("qid", F.col("term").alias("t2"), F.col("qtf").alias("qtf2")), "qid")


def query_features(queries: DataFrame, index: Index, pmi: DataFrame) -> DataFrame:
    """(qid, 16 features) over the term positions of each query; a query without terms gives no row."""
    terms = query_terms(queries, index.stem)
    small = fits_in_memory(terms)
    vocabulary = terms.select("term").distinct()
    stats = index.term_stats(vocabulary, small).filter(F.col("field") == "body").select("term", "df", "cf")
    with_stats = lookup_join(terms, stats, ["term"], ["qid"], small, "left")
    pairs = own_pairs(terms)
    hits = (
        pairs.join(pmi.select("t1", "t2", "pmi"), ["t1", "t2"])
        .groupBy("qid", F.col("t1").alias("term"))
        .agg(F.sum(F.col("qtf2") * F.col("pmi")).alias("hit_sum"), F.sum("qtf2").alias("hits"))
    )
    rows = with_stats.join(hits, ["qid", "term"], "left")
    n_docs = F.lit(float(index.totals()["body"].n_docs))
    idf = F.log(n_docs / (F.coalesce(F.col("df"), F.lit(0)) + 1))
    cf1 = F.coalesce(F.col("cf"), F.lit(0)) + 1
    hit_sum, hits_n = F.coalesce(F.col("hit_sum"), F.lit(0.0)), F.coalesce(F.col("hits"), F.lit(0))
    values = rows.select(
        "qid", "qtf", "q_len",
        idf.alias("idf"), cf1.cast("double").alias("cf"), (cf1 * idf).alias("cf_idf"),
        (n_docs / cf1).alias("inv_cf"),
        (hit_sum + F.lit(NO_PAIR) * (F.col("q_len") - hits_n)).alias("pmi"),
    )
    weight = F.col("qtf")
    reduced = values.groupBy("qid").agg(
        *[(F.sum(F.col(v) * weight) / F.max("q_len")).alias(f"mean_{v}") for v in QUERY_VALUES],
        *[F.max(v).alias(f"max_{v}") for v in QUERY_VALUES],
        *[F.sum(F.col(v) * weight).alias(f"sum_{v}") for v in QUERY_VALUES],
        F.log(F.max("q_len") + 1.0).alias("length"),
    )
    return reduced.select("qid", *[signed_log(F.col(name)).alias(name) for name in QUERY_FEATURES])
