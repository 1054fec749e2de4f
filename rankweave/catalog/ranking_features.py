"""Query-document and query features."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.catalog.registry import register
from rankweave.catalog.sqltext import signed_log
from rankweave.operators import features
from rankweave.operators.features import (
    FIELD_FEATURES, MULTIPLIED, PMI_FEATURES, QUERY_FEATURES, QUERY_VALUES, STATIC_FEATURES, SUMMED, VECTOR,
)
from rankweave.operators.index import FIELDS
from rankweave.operators.joins import fits_in_memory
from rankweave.operators.search import query_terms
from rankweave.plans.workbench import Workbench

_WIDE = " ".join(f"{name}:d" for name in FIELD_FEATURES)


def _damped(x: str) -> str:
    return f"coalesce(CASE WHEN {x} > -1 THEN ln(1 + {x}) END, 0)"


_REDUCED = ", ".join(
    [f"{_damped(f'{how}({name})')} AS {label}_{name}"
     for label, how in (("mean", "avg"), ("max", "max"), ("sum", "sum")) for name in SUMMED]
    + [f"{_damped(f'product({name})')} AS prod_{name}" for name in MULTIPLIED]
)
_EXTRA = {
    "reduced": (("term_values",), f"SELECT qid, docid, field, {_REDUCED} FROM term_values GROUP BY qid, docid, field"),
    "statics": (("docs", "toks"), """
        SELECT d.docid,
               ln(1 + max(CASE WHEN t.field = 'body' THEN len(t.toks) END)) AS len_body,
               ln(1 + max(CASE WHEN t.field = 'title' THEN len(t.toks) END)) AS len_title,
               ln(1 + max(CASE WHEN t.field = 'url_text' THEN len(t.toks) END)) AS len_url_text,
               ln(1 + length(d.url) - length(replace(d.url, '/', ''))) AS slashes, ln(1 + length(d.url)) AS url_chars
        FROM docs d JOIN toks t ON t.docid = d.docid GROUP BY d.docid, d.url"""),
    "pair_pmi": (("pmi_pairs",), f"""
        SELECT qid, docid, field, {signed_log('sum(w * v)')} AS total, {signed_log('max(v)')} AS best,
               {signed_log('sum(w * v) / sum(w)')} AS average
        FROM pmi_pairs GROUP BY qid, docid, field"""),
    "pmi_wide": (("pair_pmi", "candidates"), "SELECT c.qid, c.docid, " + ", ".join(
        f"coalesce(max(CASE WHEN p.field = '{field}' THEN p.{column} END), 0) AS pmi_{how}_{field}"
        for field in FIELDS for how, column in (("sum", "total"), ("max", "best"), ("mean", "average"))
    ) + """ FROM candidates c LEFT JOIN pair_pmi p ON p.qid = c.qid AND p.docid = c.docid GROUP BY c.qid, c.docid"""),
}
_FIELD_SQL = "SELECT c.qid, c.docid, " + ", ".join(
    f"coalesce(r.{name}, 0) AS {name}" for name in FIELD_FEATURES
) + " FROM candidates c LEFT JOIN reduced r ON r.qid = c.qid AND r.docid = c.docid AND r.field = '{field}'"


def _slice(w: Workbench, names: tuple[str, ...], labels: tuple[str, ...]):
    columns = [F.get("features", F.lit(VECTOR.index(n))).alias(label) for n, label in zip(names, labels, strict=True)]
    return w.features.select("qid", "docid", *columns)


def _field(name: str, field: str):
    @register(name, f"qid:s docid:s {_WIDE}", _FIELD_SQL.format(field=field), "candidates", "reduced", extra=_EXTRA)
    def query(w: Workbench):
        return _slice(w, tuple(f"{field}_{feature}" for feature in FIELD_FEATURES), FIELD_FEATURES)


_field("features_body", "body")
_field("features_title", "title")
_field("features_url", "url_text")


@register("features_body_only", f"qid:s docid:s {_WIDE}", _FIELD_SQL.format(field="body"), "candidates", "reduced",
          extra=_EXTRA)
def features_body_only(w: Workbench):
    rows = features.pair_features(w.candidates, w.queries, w.docs, w.index, use_title=False)
    return rows.select(
        "qid", "docid", *[F.get("features", F.lit(i)).alias(name) for i, name in enumerate(FIELD_FEATURES)])


@register("features_compat_bm25", "qid:s docid:s field:s mean_bm25:d max_bm25:d sum_bm25:d", """
    SELECT qid, docid, field, ln(1 + avg(v)) AS mean_bm25, ln(1 + max(v)) AS max_bm25, ln(1 + sum(v)) AS sum_bm25
    FROM (SELECT c.qid, c.docid, p.field,
                 ln(t.n_docs / s.df) * 2.2 * (s.cf + 1) / (1.2 * (0.25 + 0.75 * p.dl / t.avg_len) + (s.cf + 1)) AS v
          FROM candidates c JOIN qterms q ON q.qid = c.qid JOIN postings p ON p.docid = c.docid AND p.term = q.term
          JOIN term_stats s ON s.field = p.field AND s.term = p.term JOIN totals t ON t.field = p.field)
    GROUP BY qid, docid, field""", "candidates", "qterms", "postings", "term_stats", "totals")
def features_compat_bm25(w: Workbench):
    terms = query_terms(w.queries, w.index.stem)
    values = features.matched_values(
        w.candidates.select("qid", "docid"), terms, fits_in_memory(terms), w.index, compat=True)
    return features.field_features(values)


@register("features_static", "qid:s docid:s " + " ".join(f"{n}:d" for n in STATIC_FEATURES),
          "SELECT c.qid, s.* FROM candidates c JOIN statics s ON s.docid = c.docid", "candidates", "statics",
          extra=_EXTRA)
def features_static(w: Workbench):
    return _slice(w, STATIC_FEATURES, STATIC_FEATURES)


@register("features_pmi", "qid:s docid:s " + " ".join(f"{n}:d" for n in PMI_FEATURES), "SELECT * FROM pmi_wide",
          "pmi_wide", extra=_EXTRA)
def features_pmi(w: Workbench):
    return _slice(w, PMI_FEATURES, PMI_FEATURES)


_ALL_COLUMNS = ", ".join(
    [f"coalesce({alias}.{name}, 0) AS {field}_{name}"
     for field, alias in zip(FIELDS, ("b", "t", "u"), strict=True) for name in FIELD_FEATURES]
    + [f"s.{name} AS {name}" for name in STATIC_FEATURES] + [f"p.{name} AS {name}" for name in PMI_FEATURES]
)
_ALL_SQL = f"SELECT c.qid, c.docid, {_ALL_COLUMNS} FROM candidates c " + " ".join(
    f"LEFT JOIN reduced {alias} ON {alias}.qid = c.qid AND {alias}.docid = c.docid AND {alias}.field = '{field}'"
    for field, alias in zip(FIELDS, ("b", "t", "u"), strict=True)
) + " JOIN statics s ON s.docid = c.docid JOIN pmi_wide p ON p.qid = c.qid AND p.docid = c.docid"
FEATURE_CTES = _EXTRA | {
    "all_features": (("candidates", "reduced", "statics", "pmi_wide"), _ALL_SQL),
    "long_features": (("all_features",), "SELECT qid, docid, feat, name, value FROM (" + " UNION ALL ".join(
        f"SELECT qid, docid, {i} AS feat, '{name}' AS name, {name} AS value FROM all_features"
        for i, name in enumerate(VECTOR)) + ")"),
}


@register("features_all", "qid:s docid:s feat:i name:s value:d", "SELECT * FROM long_features", "long_features",
          extra=FEATURE_CTES)
def features_all(w: Workbench):
    return features.long_features(
        features.pair_features(w.candidates, w.queries, w.docs, w.index, w.pmi))


_POSITIONS = {
    "places": (("qtoks",), """
        SELECT qid, q_len, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos
        FROM (SELECT qid, toks, len(toks) AS q_len FROM qtoks)"""),
    "place_pmi": (("places", "pmi"), """
        SELECT a.qid, a.pos, sum(coalesce(m.pmi, -20.0)) AS pmi
        FROM places a JOIN places b ON b.qid = a.qid LEFT JOIN pmi m ON m.t1 = a.term AND m.t2 = b.term
        GROUP BY a.qid, a.pos"""),
    "place_values": (("places", "place_pmi", "term_stats", "totals"), """
        SELECT a.qid, a.q_len, ln(t.n_docs / (coalesce(s.df, 0) + 1)) AS idf,
               CAST(coalesce(s.cf, 0) + 1 AS DOUBLE) AS cf,
               (coalesce(s.cf, 0) + 1) * ln(t.n_docs / (coalesce(s.df, 0) + 1)) AS cf_idf,
               t.n_docs / (coalesce(s.cf, 0) + 1) AS inv_cf, p.pmi
        FROM places a JOIN place_pmi p ON p.qid = a.qid AND p.pos = a.pos
        LEFT JOIN term_stats s ON s.field = 'body' AND s.term = a.term JOIN totals t ON t.field = 'body'"""),
}
_QUERY_SQL = "SELECT qid, " + ", ".join(
    f"{signed_log(f'{how}({value})')} AS {label}_{value}"
    for label, how in (("mean", "avg"), ("max", "max"), ("sum", "sum")) for value in QUERY_VALUES
) + f", {signed_log('ln(max(q_len) + 1)')} AS length FROM place_values GROUP BY qid"

QUERY_CTES = _POSITIONS | {"query_features": (("place_values",), _QUERY_SQL)}


@register("query_features", "qid:s " + " ".join(f"{n}:d" for n in QUERY_FEATURES), _QUERY_SQL, "place_values",
          extra=_POSITIONS)
def query_features(w: Workbench):
    return features.query_features(w.queries, w.index, w.pmi)


@register("query_term_values", "qid:s term:s n:i idf:d cf:i", """
    SELECT q.qid, q.term, q.qtf AS n, ln(t.n_docs / (coalesce(s.df, 0) + 1)) AS idf, coalesce(s.cf, 0) + 1 AS cf
    FROM qterms q LEFT JOIN term_stats s ON s.field = 'body' AND s.term = q.term JOIN totals t ON t.field = 'body'""",
          "qterms", "term_stats", "totals")
def query_term_values(w: Workbench):
    terms = query_terms(w.queries, w.index.stem)
    stats = w.index.term_stats(terms.select("term").distinct(), fits_in_memory(terms))
    stats = stats.filter(F.col("field") == "body").select("term", "df", "cf")
    n_docs = F.lit(float(w.index.totals()["body"].n_docs))
    return terms.join(stats, "term", "left").select(
        "qid", "term", F.col("qtf").alias("n"),
        F.log(n_docs / (F.coalesce("df", F.lit(0)) + 1)).alias("idf"), (F.coalesce("cf", F.lit(0)) + 1).alias("cf"),
    )
