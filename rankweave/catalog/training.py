"""Sampling, training sets and aggregates over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.catalog.registry import register
from rankweave.operators import cooccurrence, sampling
from rankweave.operators.ordering import exact_median, positions
from rankweave.plans import study
from rankweave.plans.workbench import Workbench
from rankweave.sources.tables import table

SEED = 17
PAIRS = study.NUM_PAIRS
GRADED = study.NUM_GRADED
CORPUS_DRAWS = 1_000_000
LIST_PAGE = 1000


def _draw(seed: int, *keys: str) -> str:
    return "md5(" + " || '|' || ".join([f"'{seed}'", *keys]) + ")"


def _draw_int(seed: int, below: str, *keys: str) -> str:
    return f"(CAST('0x' || substr({_draw(seed, *keys)}, 1, 15) AS BIGINT) % {below})"


def _draw_share(seed: int, *keys: str) -> str:
    return f"({_draw_int(seed, '10000', *keys)} / 10000.0)"


@register("sample_k", "draw:i qid:s", f"""
    SELECT d.draw, q.qid FROM (
        SELECT draw, {_draw_int(SEED, "(SELECT count(*) FROM queries)", "draw")} + 1 AS pos
        FROM (SELECT unnest(range({PAIRS})) AS draw)) d
    JOIN (SELECT qid, row_number() OVER (ORDER BY qid) AS pos FROM queries) q ON q.pos = d.pos""", "queries")
def sample_k(w: Workbench):
    return sampling.sample_rows(w.queries.select("qid"), "qid", PAIRS, SEED)


@register("pick_one", "qid:s docid:s", f"""
    SELECT qid, arg_min(docid, {_draw(SEED, "qid", "docid")}) AS docid FROM positives GROUP BY qid""", "positives")
def pick_one(w: Workbench):
    return sampling.pick_one(sampling.positives(w.qrels), "qid", "docid", SEED)


@register("shuffle", "place:i qid:s", f"""
    SELECT row_number() OVER (ORDER BY {_draw(SEED, "qid")}, qid) AS place, qid FROM queries""", "queries")
def shuffle(w: Workbench):
    return sampling.shuffle(w.queries, "qid", SEED)


@register("split", "part:s docid:s", f"""
    SELECT CASE WHEN {_draw_share(SEED, "docid")} < 0.25 THEN 'test' ELSE 'train' END AS part, docid FROM docs""", "docs")
def split(w: Workbench):
    train, test = sampling.split(w.docs.select("docid"), "docid", 0.25, SEED)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@register("replicate", "qid:s docid:s rel:i copy:i", """
    SELECT qid, docid, rel, unnest([1, 2, 3]) AS copy FROM qrels""", "qrels")
def replicate(w: Workbench):
    return sampling.replicate(w.qrels, 3)


_RANK = _draw_int(SEED, "100", "c.qid") + " + 1"
_TRIPLES = {
    "judged_triples": (("candidates", "positives"), f"""
        SELECT c.qid, c.docid, c.rank,
               CASE WHEN c.rank != {_RANK} THEN 'skipped' WHEN p.docid IS NOT NULL THEN 'docid_collision'
                    ELSE 'kept' END AS outcome
        FROM candidates c LEFT JOIN positives p ON p.qid = c.qid AND p.docid = c.docid
        WHERE c.qid IN (SELECT qid FROM positives)"""),
    "triples": (("judged_triples", "positives", "queries", "docs"), f"""
        SELECT q.qid, q.text AS query, a.docid AS pos_docid, a.url AS pos_url, a.title AS pos_title, a.body AS pos_body,
               b.docid AS rnd_docid, b.url AS rnd_url, b.title AS rnd_title, b.body AS rnd_body
        FROM judged_triples j JOIN queries q ON q.qid = j.qid
        JOIN (SELECT qid, arg_min(docid, {_draw(SEED, "qid", "docid")}) AS docid FROM positives GROUP BY qid) p
            ON p.qid = j.qid
        JOIN docs a ON a.docid = p.docid JOIN docs b ON b.docid = j.docid WHERE j.outcome = 'kept'"""),
}


@register("triple_outcomes", "outcome:s n:i", "SELECT outcome, count(*) AS n FROM judged_triples GROUP BY outcome",
          "judged_triples", extra=_TRIPLES)
def triple_outcomes(w: Workbench):
    return sampling.triple_outcomes(w.candidates, w.qrels, SEED)


_TRIPLE_COLUMNS = ("qid:s query:s pos_docid:s pos_url:s pos_title:s pos_body:s "
                   "rnd_docid:s rnd_url:s rnd_title:s rnd_body:s")


@register("triples", _TRIPLE_COLUMNS, "SELECT * FROM triples", "triples", extra=_TRIPLES)
def triples(w: Workbench):
    return sampling.triples(w.queries, w.docs, w.candidates, w.qrels, SEED)


@register("first_triples", _TRIPLE_COLUMNS, "SELECT * FROM triples ORDER BY qid LIMIT 5", "triples", extra=_TRIPLES)
def first_triples(w: Workbench):
    """Stops after five triples; the limit is the feature."""
    return sampling.triples(w.queries, w.docs, w.candidates, w.qrels, SEED, limit=5)


def _member(members: str, seed: int, label: str) -> str:
    return f"""
        SELECT d.draw, d.qid, m.docid, {label} AS label FROM drawn d
        JOIN (SELECT qid, docid, row_number() OVER (PARTITION BY qid ORDER BY docid) AS pos,
                     count(*) OVER (PARTITION BY qid) AS n FROM {members}) m
            ON m.qid = d.qid AND m.pos = {_draw_int(seed, "m.n", "d.draw")} + 1"""


_HIGH = f"CASE WHEN {_draw_share(SEED + 3, 'd.draw')} < 0.5 THEN 4.0 ELSE 3.0 END"
_LOW = f"CASE WHEN {_draw_share(SEED + 4, 'd.draw')} < 0.5 THEN 1.0 ELSE 2.0 END"
_PAIRS = {
    "drawn": (("queries",), f"""
        SELECT d.draw, q.qid FROM (
            SELECT draw, {_draw_int(SEED, "(SELECT count(*) FROM queries)", "draw")} + 1 AS pos
            FROM (SELECT unnest(range({PAIRS // 2})) AS draw)) d
        JOIN (SELECT qid, row_number() OVER (ORDER BY qid) AS pos FROM queries) q ON q.pos = d.pos"""),
    "negatives": (("candidates", "positives"), """
        SELECT c.qid, c.docid FROM candidates c
        WHERE NOT EXISTS (SELECT 1 FROM positives p WHERE p.qid = c.qid AND p.docid = c.docid)"""),
    "good": (("drawn", "positives"), _member("positives", SEED + 1, "1.0")),
    "bad": (("drawn", "negatives"), _member("negatives", SEED + 2, "0.0")),
    "good_graded": (("drawn", "positives"), _member("positives", SEED + 1, _HIGH)),
    "bad_graded": (("drawn", "negatives"), _member("negatives", SEED + 2, _LOW)),
}
_PAIR_SQL = """
    SELECT * FROM {good} WHERE draw IN (SELECT draw FROM bad)
    UNION ALL SELECT * FROM {bad} WHERE draw IN (SELECT draw FROM good)"""


def sampled_pairs(w: Workbench, graded: bool = False):
    name = "train-pairs-graded" if graded else "train-pairs"
    return w.stage(name, lambda: sampling.train_pairs(
        w.queries, w.qrels, w.candidates, w.docs, PAIRS, SEED, graded, bounded=True))


@register("train_pairs", "draw:i qid:s docid:s label:d", _PAIR_SQL.format(good="good", bad="bad"), "good", "bad",
          extra=_PAIRS)
def train_pairs(w: Workbench):
    return sampled_pairs(w)


@register("train_pairs_graded", "draw:i qid:s docid:s label:d",
          _PAIR_SQL.format(good="good_graded", bad="bad_graded"), "good", "bad", "good_graded", "bad_graded",
          extra=_PAIRS)
def train_pairs_graded(w: Workbench):
    return sampled_pairs(w, graded=True)


@register("train_pairs_dropped", "drawn:i complete:i dropped:i", f"""
    SELECT {PAIRS // 2} AS drawn, count(*) AS complete, {PAIRS // 2} - count(*) AS dropped
    FROM good JOIN bad ON bad.draw = good.draw""", "good", "bad", extra=_PAIRS)
def train_pairs_dropped(w: Workbench):
    return sampling.dropped_draws(sampled_pairs(w), PAIRS)


@register("graded_pairs", "qid:s docid:s label:d copy:i", f"""
    SELECT qid, docid, rel AS label, unnest(range(1, CAST({GRADED} // (SELECT count(*) FROM qrels) AS BIGINT) + 1)) AS copy
    FROM qrels""", "qrels")
def graded_pairs(w: Workbench):
    return sampling.graded_pairs(w.qrels, w.queries, GRADED)


@register("training_rows", "qid:s docid:s label:d", f"""
    SELECT qid, docid, label FROM ({_PAIR_SQL.format(good="good_graded", bad="bad_graded")})
    UNION ALL
    SELECT qid, docid, rel FROM qrels, range(CAST({GRADED} // (SELECT count(*) FROM qrels) AS BIGINT))""",
          "good", "bad", "good_graded", "bad_graded", "qrels", extra=_PAIRS)
def training_rows(w: Workbench):
    return sampling.training_rows(
        sampled_pairs(w, graded=True), sampling.graded_pairs(w.qrels, w.queries, GRADED))


@register("best_grades", "qid:s docid:s rel:i", """
    SELECT qid, docid, max(rel) AS rel FROM (
        SELECT qid, docid, rel FROM qrels UNION ALL SELECT qid, docid, 1 FROM candidates) GROUP BY qid, docid""",
          "qrels", "candidates")
def best_grades(w: Workbench):
    return sampling.best_grades(w.qrels.unionByName(w.candidates.select("qid", "docid", F.lit(1).alias("rel"))))


_DRAWN = {
    "drawn": (("candidates",), f"""
        SELECT s.docid, d.copies FROM (
            SELECT pos, count(*) AS copies FROM (
                SELECT {_draw_int(SEED, "(SELECT count(DISTINCT docid) FROM candidates)", "draw")} + 1 AS pos
                FROM (SELECT unnest(range({CORPUS_DRAWS})) AS draw)) GROUP BY pos) d
        JOIN (SELECT docid, row_number() OVER (ORDER BY docid) AS pos FROM (SELECT DISTINCT docid FROM candidates)) s
            ON s.pos = d.pos"""),
    "drawn_pairs": (("drawn", "toks", "docs"), """
        SELECT t1, t2, CAST(sum(copies) AS BIGINT) AS n FROM (
            SELECT copies, toks[i] AS t1, toks[i + 1] AS t2 FROM (
                SELECT d.copies, t.toks, unnest(range(1, len(t.toks) + 1)) AS i
                FROM drawn d JOIN toks t ON t.docid = d.docid AND t.field = 'body'
                JOIN docs c ON c.docid = d.docid WHERE length(rtrim(c.body)) > 0))
        GROUP BY t1, t2"""),
    "drawn_terms": (("drawn_pairs",), "SELECT t1 AS term, CAST(sum(n) AS DOUBLE) AS n FROM drawn_pairs GROUP BY t1"),
}


@register("pmi_corpus", "docid:s copies:i body:s", """
    SELECT c.docid, d.copies, c.body FROM drawn d JOIN docs c ON c.docid = d.docid WHERE length(rtrim(c.body)) > 0""",
          "drawn", "docs", extra=_DRAWN)
def pmi_corpus(w: Workbench):
    return sampling.sampled_corpus(w.candidates, w.docs, CORPUS_DRAWS, SEED)


@register("pmi_drawn", "t1:s t2:s n:i pmi:d", """
    SELECT p.t1, p.t2, p.n, ln(p.n * t.total / (a.n * b.n)) AS pmi
    FROM drawn_pairs p JOIN drawn_terms a ON a.term = p.t1 JOIN drawn_terms b ON b.term = p.t2,
         (SELECT sum(n) AS total FROM drawn_terms) t
    WHERE p.t2 IS NOT NULL""", "drawn_pairs", "drawn_terms", extra=_DRAWN)
def pmi_drawn(w: Workbench):
    """PMI over the drawn corpus; a document counts as often as it was drawn."""
    return cooccurrence.drawn_pmi(sampling.sampled_corpus(w.candidates, w.docs, CORPUS_DRAWS, SEED), stem=True)


@register("qrel_lists", "qid:s page:i docids:s", f"""
    SELECT qid, (pos - 1) // {LIST_PAGE} AS page, string_agg(docid, ' ' ORDER BY pos) AS docids FROM (
        SELECT qid, docid, row_number() OVER (PARTITION BY qid ORDER BY docid) AS pos FROM positives)
    GROUP BY qid, (pos - 1) // {LIST_PAGE}""", "positives")
def qrel_lists(w: Workbench):
    return paged_lists(sampling.positives(w.qrels))


def paged_lists(qrels):
    """Judged documents of each query as lists of at most `LIST_PAGE`, however many there are."""
    placed = positions(qrels.select("qid", "docid"), ["qid"], [F.asc("docid")])
    pages = placed.withColumn("page", F.floor((F.col("pos") - 1) / LIST_PAGE))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "docid"))), lambda entry: entry["docid"])
    return pages.groupBy("qid", "page").agg(F.array_join(listed, " ").alias("docids"))


@register("candidate_lists", "qid:s docids:s", """
    SELECT qid, string_agg(docid, ' ' ORDER BY rank) AS docids FROM candidates GROUP BY qid""", "candidates")
def candidate_lists(w: Workbench):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "docid"))), lambda entry: entry["docid"])
    return w.candidates.groupBy("qid").agg(F.array_join(listed, " ").alias("docids"))


@register("group_summary", "source:s lang:s docs:i chars_mean:d chars_median:d chars_min:i chars_max:i", """
    SELECT source, lang, count(*) AS docs, avg(n_chars) AS chars_mean, median(n_chars) AS chars_median,
           min(n_chars) AS chars_min, max(n_chars) AS chars_max
    FROM documents GROUP BY source, lang""")
def group_summary(w: Workbench):
    docs = table(w.spark, w.folder, "documents").select("source", "lang", "n_chars")
    sums = docs.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("docs"), F.avg("n_chars").alias("chars_mean"),
        F.min("n_chars").alias("chars_min"), F.max("n_chars").alias("chars_max"))
    medians = exact_median(docs, ["source", "lang"], "n_chars").withColumnRenamed("median", "chars_median")
    return sums.join(medians, ["source", "lang"])
