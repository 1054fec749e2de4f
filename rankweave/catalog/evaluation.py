"""Ranking measures, run comparison, error analysis, and the joins and filters around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.catalog.registry import register
from rankweave.catalog.ranking_features import FEATURE_CTES
from rankweave.catalog.sqltext import CTES, tokens_of
from rankweave.operators import analysis, measures, rerank, sampling, search
from rankweave.operators.features import FIELD_FEATURES
from rankweave.operators.measures import (
    COUNTS, CUTS, GEO_FLOOR, GEOMETRIC, RECALL_LEVELS, RPREC_FACTORS, SUCCESS_CUTS,
)
from rankweave.plans.workbench import DEPTH, Workbench
from rankweave.sources import tables, trec


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0 END"


def _sum_at_hits(value: str) -> str:
    return f"coalesce(sum({value}) FILTER (is_rel = 1), 0)"


_PRECISION = "(rel_above + 1.0) / pos"
_PENALTY = "CASE WHEN nonrel_above > 0 THEN CAST(least(nonrel_above, n_rel) AS DOUBLE) / least(n_nonrel, n_rel) ELSE 0 END"
_EXPECTED = """CASE WHEN pos = 1 THEN 1.0 ELSE 1.0 / pos + ((pos - 1.0) / pos) * ((rel_above + nonrel_above) / (pos - 1.0))
    * ((rel_above + 1e-5) / (rel_above + nonrel_above + 2e-5)) END"""


def _best_precision(level: float) -> str:
    return f"coalesce(max({_PRECISION}) FILTER (is_rel = 1 AND rel_above + 1 >= floor({level}e0 * n_rel + 0.9e0)), 0)"


# measure -> SQL over the `hits` of one query
_SQL: dict[str, str] = {
    "num_ret": "count(*)",
    "num_rel": "max(n_rel)",
    "num_rel_ret": "sum(is_rel)",
    "num_nonrel_judged_ret": "sum(is_nonrel)",
    "map": _ratio(_sum_at_hits(_PRECISION), "max(n_rel)"),
    "Rprec": _ratio("count(*) FILTER (is_rel = 1 AND pos <= n_rel)", "max(n_rel)"),
    "bpref": _ratio(_sum_at_hits(f"1 - {_PENALTY}"), "max(n_rel)"),
    "recip_rank": "coalesce(1.0 / min(pos) FILTER (is_rel = 1), 0)",
    "infAP": _ratio(_sum_at_hits(_EXPECTED), "max(n_rel)"),
    "utility": "2 * sum(is_rel) - count(*)",
    "binG": _ratio(_sum_at_hits("1 / log2(2 + pos - 1 - rel_above)"), "max(n_rel)"),
    "ndcg": _ratio(_sum_at_hits("rel / log2(pos + 1)"),
                   "max((SELECT sum(i.rel / log2(i.pos + 1)) FROM ideal i WHERE i.qid = hits.qid))"),
    "set_P": "CAST(sum(is_rel) AS DOUBLE) / count(*)",
    "set_relative_P": _ratio("sum(is_rel)", "least(count(*), max(n_rel))"),
    "set_recall": _ratio("sum(is_rel)", "max(n_rel)"),
    "set_map": _ratio("sum(is_rel) * sum(is_rel)", "(count(*) * max(n_rel))"),
    "set_F": "2.0 * sum(is_rel) / (count(*) + max(n_rel))",
    "11pt_avg": "(" + " + ".join(_best_precision(v) for v in RECALL_LEVELS) + ") / 11",
}
for _v in RECALL_LEVELS:
    _SQL[f"iprec_at_recall_{_v:.2f}"] = _best_precision(_v)
for _v in RPREC_FACTORS:
    _cut = f"floor({_v}e0 * n_rel + 0.9e0)"
    _SQL[f"Rprec_mult_{_v:.2f}"] = _ratio(f"count(*) FILTER (is_rel = 1 AND pos <= {_cut})", f"max({_cut})")
for _k in SUCCESS_CUTS:
    _SQL[f"success_{_k}"] = f"CAST(count(*) FILTER (is_rel = 1 AND pos <= {_k}) > 0 AS INTEGER)"
for _k in CUTS:
    _found = f"count(*) FILTER (is_rel = 1 AND pos <= {_k})"
    _SQL[f"P_{_k}"] = f"{_found} / {_k}"
    _SQL[f"recall_{_k}"] = _ratio(_found, "max(n_rel)")
    _SQL[f"relative_P_{_k}"] = _ratio(_found, f"least({_k}, max(n_rel))")
    _SQL[f"map_cut_{_k}"] = _ratio(f"coalesce(sum({_PRECISION}) FILTER (is_rel = 1 AND pos <= {_k}), 0)", "max(n_rel)")
    _SQL[f"ndcg_cut_{_k}"] = _ratio(
        f"coalesce(sum(rel / log2(pos + 1)) FILTER (is_rel = 1 AND pos <= {_k}), 0)",
        f"max((SELECT sum(i.rel / log2(i.pos + 1)) FROM ideal i WHERE i.qid = hits.qid AND i.pos <= {_k}))")


def evaluation_sql(names: list[str], source: str = "hits") -> str:
    plain = [name for name in names if name in _SQL]
    needed = list(dict.fromkeys([*plain, *[GEOMETRIC[name] for name in names if name in GEOMETRIC]])) or ["num_ret"]
    wide = f"SELECT qid, {', '.join(f'CAST({_SQL[n]} AS DOUBLE) AS m_{i}' for i, n in enumerate(needed))} FROM {source} hits GROUP BY qid"
    rows = []
    for name in names:
        if name == "num_q":
            rows.append("SELECT 'all' AS qid, 'num_q' AS metric, count(*) AS value FROM wide")
        elif name in GEOMETRIC:
            column = f"m_{needed.index(GEOMETRIC[name])}"
            rows.append(f"SELECT 'all' AS qid, '{name}' AS metric, exp(avg(ln(greatest({column}, {GEO_FLOOR})))) AS value FROM wide")
        else:
            column = f"m_{needed.index(name)}"
            how = "sum" if name in COUNTS else "avg"
            rows.append(f"SELECT qid, '{name}' AS metric, {column} AS value FROM wide")
            rows.append(f"SELECT 'all' AS qid, '{name}' AS metric, {how}({column}) AS value FROM wide")
    return f"WITH wide AS ({wide}) " + " UNION ALL ".join(rows)


_FAMILIES = {
    "ev_counts": [*COUNTS, "num_q"],
    "ev_map": ["map", "gm_map"],
    "ev_rprec": ["Rprec", *[f"Rprec_mult_{v:.2f}" for v in RPREC_FACTORS]],
    "ev_bpref": ["bpref", "gm_bpref"],
    "ev_recip_rank": ["recip_rank"],
    "ev_iprec": [*[f"iprec_at_recall_{v:.2f}" for v in RECALL_LEVELS], "11pt_avg"],
    "ev_precision": [f"P_{k}" for k in CUTS],
    "ev_recall": [f"recall_{k}" for k in CUTS],
    "ev_infap": ["infAP"],
    "ev_utility": ["utility"],
    "ev_bing": ["binG"],
    "ev_ndcg": ["ndcg", *[f"ndcg_cut_{k}" for k in CUTS]],
    "ev_map_cut": [f"map_cut_{k}" for k in CUTS],
    "ev_relative_p": [f"relative_P_{k}" for k in CUTS],
    "ev_success": [f"success_{k}" for k in SUCCESS_CUTS],
    "ev_set": ["set_P", "set_relative_P", "set_recall", "set_map", "set_F"],
}


def _family(name: str, names: list[str]):
    @register(name, "qid:s metric:s value:d", evaluation_sql(names), "hits", "ideal")
    def query(w: Workbench):
        return measures.evaluate(w.candidates, w.qrels, DEPTH, names)


for _name, _names in _FAMILIES.items():
    _family(_name, _names)


@register("ev_all", "qid:s metric:s value:d", evaluation_sql([n for names in _FAMILIES.values() for n in names]),
          "hits", "ideal")
def ev_all(w: Workbench):
    return measures.evaluate(w.candidates, w.qrels)


_LABELLED = {
    "labelled": (("candidates", "positives"), """
        SELECT c.qid, c.docid, c.score, CASE WHEN p.rel IS NULL THEN 0 ELSE 1 END AS label
        FROM candidates c LEFT JOIN positives p ON p.qid = c.qid AND p.docid = c.docid"""),
    "ideal_binary": (("labelled",), """
        SELECT qid, sum(1 / log2(pos + 1)) AS ideal, sum(1 / log2(pos + 1)) FILTER (pos <= 10) AS ideal_10
        FROM (SELECT qid, row_number() OVER (PARTITION BY qid) AS pos FROM labelled WHERE label = 1) GROUP BY qid"""),
}


def labelled(w: Workbench):
    good = sampling.positives(w.qrels).select("qid", "docid", F.lit(1).alias("hit"))
    return w.candidates.join(good, ["qid", "docid"], "left").select(
        "qid", "docid", "score", F.coalesce("hit", F.lit(0)).alias("label"))


def _dcg_sql(partition: str, cut: str, ideal: str) -> str:
    return f"""
    SELECT r.qid, coalesce(sum(1 / log2(pos + 1)) FILTER (label = 1 AND {cut}), 0) / coalesce(max(i.{ideal}), 1) AS ndcg
    FROM (SELECT *, row_number() OVER ({partition} ORDER BY score DESC, docid DESC, qid DESC) AS pos FROM labelled) r
    LEFT JOIN ideal_binary i ON i.qid = r.qid GROUP BY r.qid"""


@register("ev_binary_ndcg", "qid:s ndcg:d", _dcg_sql("PARTITION BY qid", "true", "ideal"), "labelled", "ideal_binary",
          extra=_LABELLED)
def ev_binary_ndcg(w: Workbench):
    return measures.binary_ndcg(labelled(w), max_depth=DEPTH)


@register("ev_binary_ndcg_10", "qid:s ndcg:d", _dcg_sql("PARTITION BY qid", "pos <= 10", "ideal_10"), "labelled",
          "ideal_binary", extra=_LABELLED)
def ev_binary_ndcg_10(w: Workbench):
    return measures.binary_ndcg(labelled(w), cut=10)


@register("ev_pooled_ndcg", "qid:s ndcg:d", _dcg_sql("", "true", "ideal"), "labelled", "ideal_binary", extra=_LABELLED)
def ev_pooled_ndcg(w: Workbench):
    return measures.binary_ndcg(labelled(w), pooled=True)


@register("ev_precision_at", "qid:s precision:d", """
    SELECT qid, sum(label) FILTER (pos <= 10) / 10.0 AS precision FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid DESC) AS pos FROM labelled)
    GROUP BY qid""", "labelled", extra=_LABELLED)
def ev_precision_at(w: Workbench):
    return measures.precision_at(labelled(w), 10)


# joins, filters, sets

@register("doc_lookup", "qid:s docid:s title:s url:s", """
    SELECT c.qid, d.docid, d.title, d.url FROM candidates c JOIN docs d ON d.docid = c.docid""", "candidates", "docs")
def doc_lookup(w: Workbench):
    return w.candidates.join(w.docs.select("docid", "title", "url"), "docid")


@register("qid_join", "qid:s text:s docid:s rel:i rank:i", """
    SELECT q.qid, q.text, r.docid, r.rel, c.rank FROM queries q JOIN qrels r ON r.qid = q.qid
    JOIN candidates c ON c.qid = r.qid AND c.docid = r.docid""", "queries", "qrels", "candidates")
def qid_join(w: Workbench):
    return w.queries.join(w.qrels, "qid").join(w.candidates.select("qid", "docid", "rank"), ["qid", "docid"])


@register("judged_semi", "qid:s docid:s rank:i", """
    SELECT * FROM candidates WHERE qid IN (SELECT qid FROM positives)""", "candidates", "positives")
def judged_semi(w: Workbench):
    return search.judged_queries(w.candidates, sampling.positives(w.qrels))


@register("negatives", "qid:s docid:s rank:i", """
    SELECT c.* FROM candidates c
    WHERE NOT EXISTS (SELECT 1 FROM positives p WHERE p.qid = c.qid AND p.docid = c.docid)""",
          "candidates", "positives")
def negatives(w: Workbench):
    return sampling.negatives(w.candidates, w.qrels)


@register("relevant_hits", "qid:s docid:s rank:i rel:i", """
    SELECT c.qid, c.docid, c.rank, p.rel FROM candidates c JOIN positives p ON p.qid = c.qid AND p.docid = c.docid""",
          "candidates", "positives")
def relevant_hits(w: Workbench):
    return w.candidates.join(sampling.positives(w.qrels), ["qid", "docid"])


_STRICT = {"strict": (("scored",), "SELECT qid, docid FROM scored WHERE has_all")}


@register("queries_without_hits", "qid:s hits:i", """
    SELECT q.qid, count(s.docid) AS hits FROM queries q LEFT JOIN strict s ON s.qid = q.qid GROUP BY q.qid""",
          "queries", "strict", extra=_STRICT)
def queries_without_hits(w: Workbench):
    found = search.search(w.queries, w.index).groupBy("qid").agg(F.count(F.lit(1)).alias("hits"))
    return w.queries.select("qid").join(found, "qid", "left").select("qid", F.coalesce("hits", F.lit(0)).alias("hits"))


@register("zip_by_rank", "qid:s rank:i first:s second:s", """
    SELECT a.qid, a.rank, a.docid AS first, b.docid AS second
    FROM candidates a JOIN other_run b ON b.qid = a.qid AND b.rank = a.rank""", "candidates", "other_run")
def zip_by_rank(w: Workbench):
    first = w.candidates.select("qid", "rank", F.col("docid").alias("first"))
    return first.join(w.other_run.select("qid", "rank", F.col("docid").alias("second")), ["qid", "rank"])


@register("run_union", "run_id:s qid:s docid:s rank:i score:d", """
    SELECT run_id, qid, docid, rank, score FROM candidates UNION ALL
    SELECT run_id, qid, docid, rank, score FROM other_run""", "candidates", "other_run")
def run_union(w: Workbench):
    return w.candidates.unionByName(w.other_run)


@register("candidate_docs", "docid:s", "SELECT DISTINCT docid FROM candidates", "candidates")
def candidate_docs(w: Workbench):
    return trec.candidate_docs(w.candidates)


# re-ranking

WEIGHTS = [1.0 / (2 + i) for i in range(26)]


def _linear(features: str) -> str:
    return " + ".join(f"{w!r} * {features}.{name}" for w, name in zip(WEIGHTS, FIELD_FEATURES, strict=True))


def _reranked(score: str) -> str:
    return f"""
    SELECT qid, docid, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid DESC) AS rank
        FROM (SELECT r.qid, r.docid, round({score}, 6) + 0.0 AS score FROM reduced r
              JOIN candidates c ON c.qid = r.qid AND c.docid = r.docid WHERE r.field = 'body'))
    WHERE score != 0"""


def body_vectors(w: Workbench):
    return w.features.select("qid", "docid", F.slice("features", 1, 26).alias("features"))


@register("linear_rank", "qid:s docid:s rank:i score:d", _reranked(_linear("r")), "reduced", "candidates",
          extra=FEATURE_CTES)
def linear_rank(w: Workbench):
    return rerank.rerank(rerank.linear_score(body_vectors(w), WEIGHTS), "linear")


@register("score_fusion", "qid:s docid:s rank:i score:d", _reranked(f"({_linear('r')}) + 0.01 * c.score"),
          "reduced", "candidates", extra=FEATURE_CTES)
def score_fusion(w: Workbench):
    scored = rerank.linear_score(body_vectors(w), WEIGHTS)
    return rerank.rerank(rerank.fuse(scored, w.candidates), "fused", max_depth=DEPTH)


@register("rank_gaps", "qid:s docid:s rank:i score:d", """
    SELECT * FROM (SELECT qid, docid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid DESC) AS rank
                   FROM (SELECT c.qid, c.docid, CAST(coalesce(r.rel, 0) - 1 AS DOUBLE) AS score FROM candidates c
                         LEFT JOIN qrels r ON r.qid = c.qid AND r.docid = c.docid))
    WHERE score != 0""", "candidates", "qrels")
def rank_gaps(w: Workbench):
    scored = w.candidates.drop("score").join(w.qrels, ["qid", "docid"], "left").select(
        "qid", "docid", (F.coalesce("rel", F.lit(0)) - 1).cast("double").alias("score"))
    return rerank.rerank(scored, "grades")


# comparison and errors

def _hits_of(run: str) -> tuple[tuple[str, ...], str]:
    return ((run, "qrels"), CTES["hits"][1].replace("FROM candidates c", f"FROM {run} c"))


_COMPARE = {
    "other_hits": _hits_of("other_run"),
    "one": (("hits", "ideal"), f"SELECT qid, round({_SQL['ndcg_cut_10']}, 12) AS v FROM hits GROUP BY qid"),
    "two": (("other_hits", "ideal"), f"SELECT qid, round({_SQL['ndcg_cut_10']}, 12) AS v FROM other_hits hits GROUP BY qid"),
}


@register("win_count", "wins:i total:i", """
    SELECT count(*) FILTER (two.v > one.v) AS wins, count(*) AS total FROM one LEFT JOIN two ON two.qid = one.qid""",
          "one", "two", extra=_COMPARE)
def win_count(w: Workbench):
    def cut_10(run):
        rows = measures.evaluate(run, w.qrels, DEPTH, ["ndcg_cut_10"])
        return rows.withColumn("value", F.round("value", 12))

    return analysis.win_count(cut_10(w.candidates), cut_10(w.other_run))


@register("err_summary", "qid:s predicted:i relevant_predicted:i relevant:i", """
    SELECT p.qid, coalesce(max(c.n), 0) AS predicted, coalesce(max(c.hits), 0) AS relevant_predicted,
           count(*) AS relevant
    FROM positives p LEFT JOIN (
        SELECT c.qid, count(*) AS n, count(p.docid) AS hits FROM candidates c
        LEFT JOIN positives p ON p.qid = c.qid AND p.docid = c.docid GROUP BY c.qid) c ON c.qid = p.qid
    GROUP BY p.qid""", "positives", "candidates")
def err_summary(w: Workbench):
    return analysis.query_summary(w.candidates, w.qrels)


_SHOWN = "qid:s docid:s rank:i title:s url:s snippet:s"
_SHOWN_SQL = """
    SELECT t.qid, t.docid, t.rank, d.title, d.url, substring(d.body, 1, 250) AS snippet
    FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS place FROM ({rows})) t
    JOIN docs d ON d.docid = t.docid WHERE place <= 5"""


@register("err_false_pos", _SHOWN, _SHOWN_SQL.format(rows="""
    SELECT c.qid, c.docid, c.rank FROM candidates c LEFT JOIN positives p ON p.qid = c.qid AND p.docid = c.docid
    WHERE p.docid IS NULL AND c.qid IN (SELECT qid FROM positives)"""), "candidates", "positives", "docs")
def err_false_pos(w: Workbench):
    return analysis.false_positives(w.candidates, w.qrels, w.docs)


@register("err_relevant_top", _SHOWN, _SHOWN_SQL.format(rows="""
    SELECT c.qid, c.docid, c.rank FROM candidates c JOIN positives p ON p.qid = c.qid AND p.docid = c.docid"""),
          "candidates", "positives", "docs")
def err_relevant_top(w: Workbench):
    return analysis.relevant_on_top(w.candidates, w.qrels, w.docs)


_GAPS = """
    SELECT qid, docid, rank, true_rank, relevant, gap FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY gap DESC, rank DESC) AS place FROM (
            SELECT c.qid, c.docid, c.rank, i.true_rank, i.relevant, round({gap}, 6) + 0.0 AS gap
            FROM candidates c JOIN (
                SELECT qid, docid, row_number() OVER (PARTITION BY qid ORDER BY rel DESC, docid) AS true_rank,
                       count(*) OVER (PARTITION BY qid) AS relevant
                FROM positives) i ON i.qid = c.qid AND i.docid = c.docid))
    WHERE place <= 5"""
_GAP_COLUMNS = "qid:s docid:s rank:i true_rank:i relevant:i gap:d"


@register("err_too_low", _GAP_COLUMNS, _GAPS.format(gap="pow(c.rank, 0.75) - (i.true_rank - 1)"),
          "candidates", "positives")
def err_too_low(w: Workbench):
    return analysis.ranked_too_low(w.candidates, w.qrels)


@register("err_too_low_linear", _GAP_COLUMNS,
          f"SELECT * FROM ({_GAPS.format(gap='CAST(c.rank - (i.true_rank - 1) AS DOUBLE)')}) WHERE gap > 0",
          "candidates", "positives")
def err_too_low_linear(w: Workbench):
    return analysis.ranked_too_low_linear(w.candidates, w.qrels)


_PER_QUERY = {
    "per_query": (("hits", "ideal"), f"""
        SELECT qid, {_SQL['map']} AS map, {_SQL['ndcg_cut_10']} AS ndcg_cut_10, {_SQL['recip_rank']} AS recip_rank
        FROM hits GROUP BY qid"""),
}


@register("err_worst_first", "place:i qid:s badness:d", """
    SELECT row_number() OVER (ORDER BY badness, qid) AS place, qid, badness FROM (
        SELECT qid, round(map / (SELECT avg(map) FROM per_query)
                          + ndcg_cut_10 / (SELECT avg(ndcg_cut_10) FROM per_query), 6) + 0.0 AS badness FROM per_query)""",
          "per_query", extra=_PER_QUERY)
def err_worst_first(w: Workbench):
    return analysis.worst_first(measures.evaluate(w.candidates, w.qrels, DEPTH, ["map", "ndcg_cut_10"]))


@register("err_header", "qid:s text:s tokens:s map:d ndcg_cut_10:d recip_rank:d", f"""
    SELECT q.qid, q.text, array_to_string({tokens_of('q.text')}, ' ') AS tokens, p.map, p.ndcg_cut_10, p.recip_rank
    FROM queries q JOIN per_query p ON p.qid = q.qid""", "queries", "per_query", extra=_PER_QUERY)
def err_header(w: Workbench):
    metrics = measures.evaluate(w.candidates, w.qrels, DEPTH, list(analysis.HEADER_MEASURES))
    return analysis.query_headers(w.queries, metrics)


@register("passage_pairs", "qid:s pid:s rel:i", """
    SELECT a.conv_id || '-' || a.turn AS qid, b.conv_id || '-' || b.turn AS pid, a.turn % 5 + 1 AS rel
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user' AND b.role = 'assistant'""")
def passage_pairs(w: Workbench):
    return tables.passage_pairs(w.spark, w.folder)
