"""Text analysis, collection statistics, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.catalog.registry import register
from rankweave.catalog.sqltext import tokens_of
from rankweave.functions import scoring, text
from rankweave.functions.stemming import stem_vocabulary
from rankweave.operators import cooccurrence, index, search
from rankweave.operators.features import own_pairs
from rankweave.operators.index import field_tokens
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.operators.ordering import top_k
from rankweave.operators.search import query_terms
from rankweave.plans.workbench import CANDIDATE_SHARE, Workbench
from rankweave.session import new_path
from rankweave.sources import tables

# Texts are near a document that holds at least one in so many of their terms.
NEAR_SHARE = 5


@register("tokens", "docid:s pos:i term:s", """
    SELECT docid, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM plain_toks WHERE field = 'body'""", "plain_toks")
def tokens(w: Workbench):
    return w.texts.select("docid", F.posexplode(text.analyze(F.col("body"))).alias("pos", "term"))


@register("tokens_url", "docid:s pos:i term:s", f"""
    SELECT docid, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos
    FROM (SELECT CAST(page_id AS VARCHAR) AS docid, {tokens_of("replace(url, '.', ' ')")} AS toks FROM pages)""")
def tokens_url(w: Workbench):
    urls = tables.web_urls(w.spark, w.folder)
    return urls.select("docid", F.posexplode(text.analyze(text.url_text(F.col("url")))).alias("pos", "term"))


@register("stems", "term:s stem:s", "SELECT DISTINCT s.term, s.stem FROM stems s JOIN plain_tokens t ON t.term = s.term",
          "stems", "plain_tokens")
def stems(w: Workbench):
    return stem_vocabulary(w.plain_index.postings)


@register("stemmed_tokens", "docid:s pos:i term:s", """
    SELECT t.docid, t.pos, s.stem AS term FROM (
        SELECT docid, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM plain_toks WHERE field = 'body') t
    JOIN stems s ON s.term = t.term""", "plain_toks", "stems")
def stemmed_tokens(w: Workbench):
    return w.texts.select("docid", F.posexplode(text.analyze(F.col("body"), stem=True)).alias("pos", "term"))


@register("url_statics", "docid:s slashes:i url_chars:i", """
    SELECT CAST(page_id AS VARCHAR) AS docid, length(url) - length(replace(url, '/', '')) AS slashes,
           length(url) AS url_chars FROM pages""")
def url_statics(w: Workbench):
    urls = tables.web_urls(w.spark, w.folder)
    return urls.select("docid", text.slash_count(F.col("url")).alias("slashes"), F.length("url").alias("url_chars"))


@register("ngrams", "docid:s t1:s t2:s n:i", """
    SELECT docid, t1, t2, count(*) AS n FROM (
        SELECT docid, toks[i] AS t1, toks[i + 1] AS t2
        FROM (SELECT docid, toks, unnest(range(1, len(toks))) AS i FROM plain_toks WHERE field = 'body'))
    GROUP BY docid, t1, t2""", "plain_toks")
def ngrams(w: Workbench):
    pairs = field_tokens(w.texts, ("body",)).select("docid", F.inline(text.with_next(F.col("tokens"))))
    return pairs.filter(F.col("t2").isNotNull()).groupBy("docid", "t1", "t2").agg(F.count(F.lit(1)).alias("n"))


@register("snippets", "docid:s title:s url:s snippet:s", "SELECT *, substring(body, 1, 250) AS snippet FROM docs", "docs")
def snippets(w: Workbench):
    return w.docs.select("docid", "title", "url", text.snippet(F.col("body")).alias("snippet"))


@register("term_freq", "field:s docid:s term:s tf:i dl:i", "SELECT * FROM plain_postings", "plain_postings")
def term_freq(w: Workbench):
    return index.build_postings(w.docs)


@register("postings", "field:s docid:s term:s tf:i places:s", """
    SELECT field, docid, term, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS places
    FROM (SELECT field, docid, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM plain_toks)
    GROUP BY field, docid, term""", "plain_toks")
def postings(w: Workbench):
    rows = index.build_postings(w.docs, with_positions=True)
    return rows.withColumn("places", F.array_join(F.col("positions").cast("array<string>"), " "))


@register("term_stats", "field:s term:s df:i cf:i idf:d smoothed_idf:d", """
    SELECT s.*, ln(t.n_docs / s.df) AS idf, ln(t.n_docs / (s.df + 1)) AS smoothed_idf
    FROM term_stats s JOIN totals t ON t.field = s.field""", "term_stats", "totals")
def term_stats(w: Workbench):
    n_docs = F.lit(float(w.index.docs.count()))
    df = F.col("df")
    return w.index.term_stats().select(
        "field", "term", "df", "cf", index.idf(n_docs, df).alias("idf"),
        index.smoothed_idf(n_docs, df).alias("smoothed_idf"),
    )


@register("field_stats", "field:s n_docs:i field_len:i avg_len:d", "SELECT * FROM totals", "totals")
def field_stats(w: Workbench):
    return w.index.field_stats()


@register("num_docs", "n:i", "SELECT count(*) AS n FROM docs", "docs")
def num_docs(w: Workbench):
    return w.index.docs.agg(F.count(F.lit(1)).alias("n"))


@register("doc_len", "field:s docid:s dl:i", """
    SELECT field, docid, sum(tf) AS dl FROM postings GROUP BY field, docid""", "postings")
def doc_len(w: Workbench):
    return w.index.doc_len()


@register("unigram_counts", "term:s n:i", "SELECT * FROM unigrams", "unigrams")
def unigram_counts(w: Workbench):
    return cooccurrence.unigram_counts(cooccurrence.successor_counts(field_tokens(w.texts, ("body",), stem=True)))


@register("bigram_counts", "t1:s t2:s n:i", "SELECT * FROM successors WHERE t2 IS NOT NULL", "successors")
def bigram_counts(w: Workbench):
    return cooccurrence.bigram_counts(cooccurrence.successor_counts(field_tokens(w.texts, ("body",), stem=True)))


@register("pmi", "t1:s t2:s n:i pmi:d", "SELECT * FROM pmi", "pmi")
def pmi(w: Workbench):
    return cooccurrence.corpus_pmi(w.texts, stem=True)


_TOP = """SELECT qid, docid, rank, score FROM (
    SELECT qid, docid, {name} AS score, row_number() OVER (PARTITION BY qid ORDER BY {name} DESC, docid DESC) AS rank
    FROM scored WHERE {where}) WHERE rank <= 10"""


@register("bm25_top10", "qid:s docid:s rank:i score:d", _TOP.format(name="okapi", where="has_all"), "scored")
def bm25_top10(w: Workbench):
    return search.search(w.queries, w.index, k=10)


@register("bm25_or_top10", "qid:s docid:s rank:i score:d", _TOP.format(name="okapi", where="true"), "scored")
def bm25_or_top10(w: Workbench):
    return search.search(w.queries, w.index, k=10, mode="or")


@register("bm25_lib_top10", "qid:s docid:s rank:i score:d", _TOP.format(name="bm25", where="has_all"), "scored")
def bm25_lib_top10(w: Workbench):
    return search.search(w.queries, w.index, scoring.smoothed, k=10)


@register("bm25_plain_top10", "qid:s docid:s rank:i score:d",
          _TOP.format(name="okapi", where="has_all").replace("FROM scored", "FROM plain_scored"), "plain_scored")
def bm25_plain_top10(w: Workbench):
    """The same search without stemming."""
    return search.search(w.queries, w.plain_index, k=10)


@register("plain_term_stats", "field:s term:s df:i cf:i", "SELECT * FROM plain_term_stats", "plain_term_stats")
def plain_term_stats(w: Workbench):
    return w.plain_index.term_stats()


@register("bm25_scores", "qid:s docid:s term:s score:d", """
    SELECT m.qid, m.docid, term, ln(n_docs / df) * 2.2 * tf / (1.2 * (0.25 + 0.75 * dl / avg_len) + tf) AS score
    FROM matches m JOIN candidates c ON c.qid = m.qid AND c.docid = m.docid""", "matches", "candidates")
def bm25_scores(w: Workbench):
    totals = w.index.totals()["body"]
    stats = scoring.Stats(
        F.lit(float(totals.n_docs)), F.col("df"), F.col("tf"), F.col("dl"), F.lit(totals.avg_len)
    )
    found = search.run_matches(w.queries, w.index, w.candidates)
    return found.select("qid", "docid", "term", scoring.okapi(stats).alias("score"))


@register("search_run", "run_id:s qid:s docid:s rank:i score:d", """
    SELECT 'okapi' AS run_id, qid, docid, rank, score FROM (
        SELECT qid, docid, okapi AS score, row_number() OVER (PARTITION BY qid ORDER BY okapi DESC, docid DESC) AS rank
        FROM scored WHERE has_fifth) WHERE rank <= 1000""", "scored")
def search_run(w: Workbench):
    return search.search(w.queries, w.index, mode=CANDIDATE_SHARE)


@register("matched_terms", "qid:s docid:s terms:s", """
    SELECT m.qid, m.docid, string_agg(m.term, ' ' ORDER BY m.term) AS terms
    FROM matches m JOIN candidates c ON c.qid = m.qid AND c.docid = m.docid GROUP BY m.qid, m.docid""",
          "matches", "candidates")
def matched_terms(w: Workbench):
    return search.matched_terms(w.queries, w.index, w.candidates)


@register("scorer_compare", "run_id:s qid:s docid:s rank:i score:d", f"""
    SELECT 'okapi' AS run_id, * FROM ({_TOP.format(name="okapi", where="has_fifth")})
    UNION ALL SELECT 'bm25', * FROM ({_TOP.format(name="bm25", where="has_fifth")})""", "scored")
def scorer_compare(w: Workbench):
    return search.compare_scorers(
        w.queries, w.index, {"okapi": scoring.okapi, "bm25": scoring.smoothed}, k=10, mode=CANDIDATE_SHARE)


def _near_sql(asked: str, collection: str, share: int = NEAR_SHARE) -> str:
    """The five documents of a collection nearest to each asked text, among those with one in `share` of its terms."""
    return f"""
    SELECT qid, docid, rank, score FROM (
        SELECT qid, docid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid DESC) AS rank
        FROM (SELECT a.qid, p.docid,
                     round(sum(ln(n.n / s.df) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / n.avg_len))), 6) + 0.0
                         AS score
              FROM (SELECT DISTINCT qid, unnest(toks) AS term, len(list_distinct(toks)) AS n_terms FROM {asked}) a
              JOIN {collection}_p p ON p.term = a.term
              JOIN (SELECT term, count(*) AS df FROM {collection}_p GROUP BY term) s ON s.term = a.term,
                   (SELECT (SELECT count(*) FROM {collection}) AS n,
                           sum(tf) / (SELECT count(*) FROM {collection}) AS avg_len FROM {collection}_p) n
              GROUP BY a.qid, p.docid HAVING {share} * count(*) >= max(a.n_terms)))
    WHERE rank <= 5"""


_TURNS = {
    "asked": ((), f"""SELECT conv_id || '-' || turn AS qid, {tokens_of('text')} AS toks
                      FROM conversations WHERE role = 'user'"""),
    "shown": (("stems",), f"""
        SELECT qid, list(s.stem) AS toks
        FROM (SELECT conv_id || '-' || turn AS qid, unnest({tokens_of('text')}) AS term
              FROM conversations WHERE role = 'assistant') t JOIN stems s ON s.term = t.term GROUP BY qid"""),
    "pairs": ((), """SELECT a.conv_id || '-' || a.turn AS qid, b.conv_id || '-' || b.turn AS pid, a.turn % 5 + 1 AS rel
                     FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
                     WHERE a.role = 'user' AND b.role = 'assistant'"""),
    "paired_asked": (("asked", "pairs"), "SELECT * FROM asked WHERE qid IN (SELECT qid FROM pairs)"),
    "paired_shown": (("shown", "pairs"), "SELECT * FROM shown WHERE qid IN (SELECT pid FROM pairs)"),
    "queries_p": (("plain_qtoks",), """
        SELECT qid AS docid, len(toks) AS dl, term, count(*) AS tf
        FROM (SELECT qid, toks, unnest(toks) AS term FROM plain_qtoks) GROUP BY qid, toks, term"""),
    "docs_p": (("postings",), "SELECT docid, dl, term, tf FROM postings WHERE field = 'body'"),
    "near_queries": (("paired_asked", "queries", "queries_p"), _near_sql("paired_asked", "queries")),
    "near_docs": (("paired_shown", "docs", "docs_p"), _near_sql("paired_shown", "docs")),
    "full_queries": (("paired_asked", "queries", "queries_p"), _near_sql("paired_asked", "queries", 1)),
    "full_docs": (("paired_shown", "docs", "docs_p"), _near_sql("paired_shown", "docs", 1)),
}


def _near_queries(w: Workbench, mode: str | int):
    pairs = tables.passage_pairs(w.spark, w.folder)
    asked = search.judged_queries(tables.passage_queries(w.spark, w.folder), pairs)
    return search.search(asked, search.query_index(w.queries), k=5, mode=mode)


def _near_docs(w: Workbench, mode: str | int):
    pairs = tables.passage_pairs(w.spark, w.folder).select("pid")
    shown = tables.passages(w.spark, w.folder).join(pairs, "pid", "left_semi")
    return search.search(shown.withColumnRenamed("pid", "qid"), w.index, k=5, mode=mode)


def _transferred(w: Workbench, mode: str | int):
    return search.transfer_judgments(
        tables.passage_pairs(w.spark, w.folder), tables.passage_queries(w.spark, w.folder),
        tables.passages(w.spark, w.folder), search.query_index(w.queries), w.index, mode=mode)


_TRANSFER = """
    SELECT q.docid AS qid, d.docid, p.rel FROM pairs p JOIN {0}_queries q ON q.qid = p.qid
    JOIN {0}_docs d ON d.qid = p.pid AND d.rank = q.rank"""


@register("query_to_query", "qid:s docid:s rank:i score:d", "SELECT * FROM near_queries", "near_queries", extra=_TURNS)
def query_to_query(w: Workbench):
    return _near_queries(w, NEAR_SHARE)


@register("query_to_query_all", "qid:s docid:s rank:i score:d", "SELECT * FROM full_queries", "full_queries", extra=_TURNS)
def query_to_query_all(w: Workbench):
    """Every term of the query wanted."""
    return _near_queries(w, "and")


@register("passage_to_doc", "qid:s docid:s rank:i score:d", "SELECT * FROM near_docs", "near_docs", extra=_TURNS)
def passage_to_doc(w: Workbench):
    return _near_docs(w, NEAR_SHARE)


@register("passage_to_doc_all", "qid:s docid:s rank:i score:d", "SELECT * FROM full_docs", "full_docs", extra=_TURNS)
def passage_to_doc_all(w: Workbench):
    """Every term of the passage wanted."""
    return _near_docs(w, "and")


@register("judgment_transfer", "qid:s docid:s rel:i", _TRANSFER.format("near"), "pairs", "near_queries", "near_docs", extra=_TURNS)
def judgment_transfer(w: Workbench):
    return _transferred(w, NEAR_SHARE)


@register("judgment_transfer_all", "qid:s docid:s rel:i", _TRANSFER.format("full"), "pairs", "full_queries", "full_docs", extra=_TURNS)
def judgment_transfer_all(w: Workbench):
    return _transferred(w, "and")


@register("judged_queries", "qid:s text:s", "SELECT * FROM queries WHERE qid IN (SELECT qid FROM qrels)",
          "queries", "qrels")
def judged_queries(w: Workbench):
    return search.judged_queries(w.queries, w.qrels)


@register("term_pairs", "qid:s t1:s t2:s n:i", """
    SELECT a.qid, s.t1, s.t2, s.n FROM qterms a JOIN qterms b ON b.qid = a.qid
    JOIN successors s ON s.t1 = a.term AND s.t2 = b.term""", "qterms", "successors")
def term_pairs(w: Workbench):
    return own_pairs(query_terms(w.queries, w.index.stem)).join(w.pmi.select("t1", "t2", "n"), ["t1", "t2"])


@register("shared_terms", "qid:s docid:s field:s shared:i", """
    SELECT c.qid, c.docid, p.field, count(*) AS shared FROM candidates c JOIN qterms q ON q.qid = c.qid
    JOIN postings p ON p.docid = c.docid AND p.term = q.term GROUP BY c.qid, c.docid, p.field""",
          "candidates", "qterms", "postings")
def shared_terms(w: Workbench):
    wanted = w.candidates.select("qid", "docid").join(query_terms(w.queries, w.index.stem).select("qid", "term"), "qid")
    ids = wanted.select("docid").distinct()
    near = lookup_join(w.index.postings.select("field", "docid", "term"), ids, ["docid"], ["term"], fits_in_memory(ids), "left_semi")
    found = near.join(wanted, ["docid", "term"])
    return found.groupBy("qid", "docid", "field").agg(F.count(F.lit(1)).alias("shared"))


@register("field_search", "qid:s docid:s rank:i score:d", """
    SELECT qid, docid, rank, score FROM (
        SELECT qid, docid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid DESC) AS rank FROM (
            SELECT q.qid, p.docid, round(sum(
                ln(t.n_docs / s.df) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / t.avg_len))), 6) + 0.0 AS score
            FROM qterms q JOIN postings p ON p.term = q.term AND p.field = 'title'
            JOIN term_stats s ON s.term = q.term AND s.field = 'title' JOIN totals t ON t.field = 'title'
            GROUP BY q.qid, p.docid))
    WHERE rank <= 10""", "qterms", "postings", "term_stats", "totals")
def field_search(w: Workbench):
    return search.search(w.queries, w.index, k=10, mode="or", field="title")


@register("first_n", "docid:s title:s", "SELECT docid, title FROM docs ORDER BY docid LIMIT 100", "docs")
def first_n(w: Workbench):
    return w.docs.select("docid", "title").orderBy("docid").limit(100)


@register("first_five_per_query", "qid:s docid:s rank:i", "SELECT * FROM candidates WHERE rank <= 5", "candidates")
def first_five_per_query(w: Workbench):
    return top_k(w.candidates.drop("rank"), 5)


@register("index_append", "field:s term:s df:i cf:i", "SELECT * FROM term_stats", "term_stats")
def index_append(w: Workbench):
    path = new_path(w.spark, "appended")
    source = tables.table(w.spark, w.folder, "documents").select(F.col("doc_id").cast("string").alias("docid"), "lang")
    english = w.texts.join(source.filter(F.col("lang") == "en"), "docid", "left_semi")
    index.write_index(english, path, stem=True)
    index.append_documents(path, w.docs, "second", stem=True)
    return index.append_documents(path, english, "third", stem=True).term_stats()


def _upserted(w: Workbench) -> str:
    """An index with a wrong URL field, of which the English documents and then all are replaced in place."""
    path = new_path(w.spark, "upserted")
    index.write_index(w.texts.withColumn("url", F.concat(F.lit("old "), "title")), path, stem=True)
    source = tables.table(w.spark, w.folder, "documents").select(F.col("doc_id").cast("string").alias("docid"), "lang")
    english = w.docs.join(source.filter(F.col("lang") == "en"), "docid", "left_semi")
    index.upsert_field(path, english.withColumn("url", F.lit("wrong again")), "url_text", "first", stem=True)
    index.upsert_field(path, w.docs, "url_text", "second", stem=True)
    return path


@register("index_upsert", "field:s term:s df:i cf:i", "SELECT * FROM term_stats", "term_stats")
def index_upsert(w: Workbench):
    return index.read_index(w.spark, _upserted(w), stem=True).term_stats()


@register("upserted_postings", "field:s docid:s term:s tf:i dl:i", "SELECT * FROM postings", "postings")
def upserted_postings(w: Workbench):
    """The rows that count after two replacements in place, with the older ones still in the files."""
    return index.read_index(w.spark, _upserted(w), stem=True).postings


@register("index_compact", "field:s docid:s term:s tf:i dl:i", "SELECT * FROM postings", "postings")
def index_compact(w: Workbench):
    return index.compact_index(_upserted(w), new_path(w.spark, "compacted"), w.spark, stem=True).postings


@register("index_clear", "field:s n_docs:i field_len:i avg_len:d", "SELECT * FROM totals", "totals")
def index_clear(w: Workbench):
    path = new_path(w.spark, "rebuilt")
    index.write_index(w.texts.withColumn("body", F.col("title")), path, stem=True)
    index.clear_index(w.spark, path)
    return index.write_index(w.texts, path, stem=True).field_stats()
