"""Common table expressions for the SQL forms of the registered queries."""

from __future__ import annotations

# Fixed values, stated here on their own so that a wrong one in the library shows: the stop list, the shortest token
# and the suffixes of three stemming steps with what replaces them.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "for", "from", "have", "if", "in", "is", "it", "may",
    "not", "of", "on", "or", "tbd", "that", "the", "this", "to", "us", "we", "when", "will", "with", "yet", "you", "your",
)
MIN_TOKEN_LENGTH = 2
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
    ("biliti", "ble"), ("logi", "log"),
)
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous",
    "ive", "ize",
)
TOKEN = r"[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*"
_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)


def tokens_of(text: str) -> str:
    """SQL for the analysed tokens of a text expression."""
    return (
        f"list_filter(regexp_extract_all(lower({text}), '{TOKEN}'), "
        f"lambda t: length(t) >= {MIN_TOKEN_LENGTH} AND t NOT IN ({_STOPS}))"
    )


def _shape(word: str) -> str:
    """One letter per character, v or c, built from left to right because y depends on the letter before it."""
    return (
        f"list_reduce(string_split({word}, ''), lambda s, ch: s || CASE WHEN ch IN ('a', 'e', 'i', 'o', 'u') "
        "OR (ch = 'y' AND right(s, 1) = 'c') THEN 'v' ELSE 'c' END, '')"
    )


def _measure(word: str) -> str:
    shape = _shape(word)
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) // 2)"


def _cut(ending: str) -> str:
    return f"left(w, length(w) - {len(ending)})"


def _short_end(word: str) -> str:
    return f"(right({_shape(word)}, 3) = 'cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y'))"


def _swaps(pairs) -> str:
    cases = " ".join(
        f"WHEN suffix(w, '{old}') THEN CASE WHEN {_measure(_cut(old))} > 0 THEN {_cut(old)} || '{new}' ELSE w END"
        for old, new in sorted(pairs, key=lambda pair: -len(pair[0]))
    )
    return f"CASE {cases} ELSE w END"


def _strips() -> str:
    cases = []
    for ending in sorted(STEP4, key=lambda e: -len(e)):
        root = _cut(ending)
        extra = f" AND right({root}, 1) IN ('s', 't')" if ending == "ion" else ""
        cases.append(f"WHEN suffix(w, '{ending}') THEN CASE WHEN {_measure(root)} > 1{extra} THEN {root} ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


def _past() -> str:
    mended = (
        "CASE WHEN suffix(r, 'at') OR suffix(r, 'bl') OR suffix(r, 'iz') THEN r || 'e' "
        f"WHEN length(r) > 1 AND right(r, 1) = left(right(r, 2), 1) AND right({_shape('r')}, 1) = 'c' "
        "AND right(r, 1) NOT IN ('l', 's', 'z') THEN left(r, length(r) - 1) "
        f"WHEN {_measure('r')} = 1 AND {_short_end('r')} THEN r || 'e' ELSE r END"
    )
    return (
        f"CASE WHEN suffix(w, 'eed') THEN CASE WHEN {_measure(_cut('eed'))} > 0 THEN {_cut('d')} ELSE w END "
        f"WHEN r IS NOT NULL AND contains({_shape('r')}, 'v') THEN {mended} ELSE w END"
    )


def _final_e() -> str:
    root = _cut("e")
    return (
        f"CASE WHEN suffix(w, 'e') AND ({_measure(root)} > 1 OR ({_measure(root)} = 1 AND NOT {_short_end(root)})) "
        f"THEN {root} ELSE w END"
    )


# Suffix stripping over the table `words(term)`, one step per line.
_STEM_STEPS = (
    ("w", f"""CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN {_cut('ss')}
              WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN {_cut('s')} ELSE w END"""),
    ("r", f"CASE WHEN suffix(w, 'ed') THEN {_cut('ed')} WHEN suffix(w, 'ing') THEN {_cut('ing')} END"),
    ("w", _past()),
    ("w", f"CASE WHEN suffix(w, 'y') AND contains({_shape(_cut('y'))}, 'v') THEN {_cut('y')} || 'i' ELSE w END"),
    ("w", _swaps(STEP2)),
    ("w", _swaps(STEP3)),
    ("w", _strips()),
    ("w", _final_e()),
    ("w", f"CASE WHEN suffix(w, 'll') AND {_measure(_cut('l'))} > 1 THEN {_cut('l')} ELSE w END"),
)


def _stem_ctes() -> dict[str, tuple[tuple[str, ...], str]]:
    out = {"stem_0": (("words",), "SELECT term, term AS w, NULL::VARCHAR AS r FROM words WHERE length(term) > 2")}
    for i, (column, expression) in enumerate(_STEM_STEPS):
        kept = "r" if column == "w" else "w"
        out[f"stem_{i + 1}"] = ((f"stem_{i}",), f"SELECT term, {expression} AS {column}, {kept} FROM stem_{i}")
    out["stems"] = ((f"stem_{len(_STEM_STEPS)}", "words"), f"""
        SELECT term, w AS stem FROM stem_{len(_STEM_STEPS)} UNION ALL
        SELECT term, term FROM words WHERE length(term) <= 2""")
    return out


def signed_log(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln(abs({x}) + 1) ELSE -ln(abs({x}) + 1) END)"


# name -> (names it reads, text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "docs": ((), """
        SELECT CAST(doc_id AS VARCHAR) AS docid,
               'https://' || source || '.example.org/' || lang || '/' || CAST(doc_id AS VARCHAR) AS url,
               split_part(text, chr(10), 1) AS title, text AS body
        FROM documents"""),
    "queries": ((), "SELECT CAST(item_id AS VARCHAR) AS qid, text FROM benchmark"),
    "fields": (("docs",), """
        SELECT docid, 'body' AS field, body AS raw FROM docs
        UNION ALL SELECT docid, 'title', title FROM docs
        UNION ALL SELECT docid, 'url_text', replace(url, '.', ' ') FROM docs"""),
    "plain_toks": (("fields",), f"SELECT docid, field, {tokens_of('raw')} AS toks FROM fields"),
    "plain_tokens": (("plain_toks",), """
        SELECT docid, field, len(toks) AS dl, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos
        FROM plain_toks"""),
    "tokens": (("plain_tokens", "stems"), """
        SELECT t.docid, t.field, t.dl, s.stem AS term, t.pos FROM plain_tokens t JOIN stems s ON s.term = t.term"""),
    "toks": (("tokens",), "SELECT docid, field, list(term ORDER BY pos) AS toks FROM tokens GROUP BY docid, field"),
    "plain_postings": (("plain_tokens",), """
        SELECT field, docid, dl, term, count(*) AS tf FROM plain_tokens GROUP BY field, docid, dl, term"""),
    "plain_term_stats": (("plain_postings",), """
        SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM plain_postings GROUP BY field, term"""),
    "postings": (("tokens",), """
        SELECT field, docid, dl, term, count(*) AS tf FROM tokens GROUP BY field, docid, dl, term"""),
    "term_stats": (("postings",), """
        SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM postings GROUP BY field, term"""),
    "totals": (("postings",), """
        SELECT field, (SELECT count(*) FROM documents) AS n_docs, CAST(sum(tf) AS BIGINT) AS field_len,
               CAST(sum(tf) AS DOUBLE) / (SELECT count(*) FROM documents) AS avg_len
        FROM postings GROUP BY field"""),
    "plain_qtoks": (("queries",), f"SELECT qid, {tokens_of('text')} AS toks FROM queries"),
    "qtoks": (("plain_qtoks", "stems"), """
        SELECT qid, list(s.stem ORDER BY pos) AS toks
        FROM (SELECT qid, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM plain_qtoks) q
        JOIN stems s ON s.term = q.term GROUP BY qid"""),
    "plain_qterms": (("plain_qtoks",), """
        SELECT qid, term, q_len, n_terms, count(*) AS qtf
        FROM (SELECT qid, len(toks) AS q_len, len(list_distinct(toks)) AS n_terms, unnest(toks) AS term
              FROM plain_qtoks)
        GROUP BY qid, term, q_len, n_terms"""),
    "plain_scored": (("plain_qterms", "plain_postings", "plain_term_stats", "totals"), """
        SELECT q.qid, p.docid, count(*) = max(q.n_terms) AS has_all,
               round(sum(ln(t.n_docs / s.df) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / t.avg_len))), 6) + 0.0
                   AS okapi
        FROM plain_qterms q JOIN plain_postings p ON p.term = q.term AND p.field = 'body'
        JOIN plain_term_stats s ON s.term = q.term AND s.field = 'body' JOIN totals t ON t.field = 'body'
        GROUP BY q.qid, p.docid"""),
    "qterms": (("qtoks",), """
        SELECT qid, term, q_len, n_terms, count(*) AS qtf
        FROM (SELECT qid, len(toks) AS q_len, len(list_distinct(toks)) AS n_terms, unnest(toks) AS term FROM qtoks)
        GROUP BY qid, term, q_len, n_terms"""),
    "matches": (("qterms", "postings", "term_stats", "totals"), """
        SELECT q.qid, p.docid, q.term, p.tf, p.dl, s.df, t.n_docs, t.avg_len, q.n_terms
        FROM qterms q JOIN postings p ON p.term = q.term AND p.field = 'body'
        JOIN term_stats s ON s.term = q.term AND s.field = 'body' JOIN totals t ON t.field = 'body'"""),
    "scored": (("matches",), """
        SELECT qid, docid, count(*) = max(n_terms) AS has_all, 5 * count(*) >= max(n_terms) AS has_fifth,
               round(sum(ln(n_docs / df) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg_len))), 6) + 0.0 AS okapi,
               round(sum((ln(n_docs / (df + 1)) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg_len))), 6) + 0.0
                   AS bm25
        FROM matches GROUP BY qid, docid"""),
    "candidates": (("scored",), """
        SELECT * FROM (SELECT 'okapi' AS run_id, qid, docid, okapi AS score,
                              row_number() OVER (PARTITION BY qid ORDER BY okapi DESC, docid DESC) AS rank
                       FROM scored WHERE has_fifth)
        WHERE rank <= 100"""),
    "other_run": (("scored",), """
        SELECT * FROM (SELECT 'bm25' AS run_id, qid, docid, bm25 AS score,
                              row_number() OVER (PARTITION BY qid ORDER BY bm25 DESC, docid DESC) AS rank
                       FROM scored WHERE has_fifth)
        WHERE rank <= 100"""),
    "qrels": (("qterms", "postings"), """
        SELECT o.qid, o.docid, CASE WHEN l.quality = 0 OR l.toxic = 1 THEN 0 WHEN c = n THEN 3
                                    WHEN 5 * c >= 2 * n THEN 2 ELSE 1 END AS rel
        FROM (SELECT q.qid, p.docid, count(*) AS c, max(q.n_terms) AS n
              FROM qterms q JOIN postings p ON p.term = q.term AND p.field = 'body' GROUP BY q.qid, p.docid) o
        JOIN labels l ON CAST(l.doc_id AS VARCHAR) = o.docid
        WHERE 5 * c >= n"""),
    "positives": (("qrels",), "SELECT qid, docid, rel FROM qrels WHERE rel > 0"),
    "successors": (("toks",), """
        SELECT t1, t2, count(*) AS n
        FROM (SELECT toks[i] AS t1, toks[i + 1] AS t2
              FROM (SELECT toks, unnest(range(1, len(toks) + 1)) AS i FROM toks WHERE field = 'body'))
        GROUP BY t1, t2"""),
    "unigrams": (("tokens",), "SELECT term, count(*) AS n FROM tokens WHERE field = 'body' GROUP BY term"),
    "pmi": (("successors", "unigrams"), """
        SELECT s.t1, s.t2, s.n, ln((s.n / t.total) / ((a.n / t.total) * (b.n / t.total))) AS pmi
        FROM successors s JOIN unigrams a ON a.term = s.t1 JOIN unigrams b ON b.term = s.t2,
             (SELECT CAST(sum(n) AS DOUBLE) AS total FROM unigrams) t"""),
    # features
    "term_values": (("candidates", "qterms", "postings", "term_stats", "totals"), """
        SELECT c.qid, c.docid, p.field, CAST(p.tf AS DOUBLE) AS tf, ln(t.n_docs / (s.df + 1)) AS idf,
               p.tf / p.dl * ln(t.n_docs / (s.df + 1)) AS ntf_idf, t.n_docs / (s.cf + 1) AS inv_cf,
               p.tf / p.dl AS ntf, p.tf * t.n_docs / (p.dl * (s.cf + 1)) AS ntf_inv_cf,
               ln(t.n_docs / s.df) * 2.2 * p.tf / (1.2 * (0.25 + 0.75 * p.dl / t.avg_len) + p.tf) AS bm25,
               -(1 / q.q_len) * ln(p.tf / p.dl + 1) AS kl,
               CASE WHEN q.q_len > 3 THEN 0.25 * p.tf / p.dl + 0.75 * (s.cf + 1) / t.field_len
                    ELSE 0.65 * p.tf / p.dl + 0.35 * (s.cf + 1) / t.field_len END AS jm,
               (p.tf + 2000.0 * (s.cf + 1) / t.field_len) / (p.dl + 2000.0) AS dirichlet
        FROM candidates c JOIN qterms q ON q.qid = c.qid JOIN postings p ON p.docid = c.docid AND p.term = q.term
        JOIN term_stats s ON s.field = p.field AND s.term = p.term JOIN totals t ON t.field = p.field"""),
    "pmi_pairs": (("candidates", "qterms", "postings", "pmi"), """
        SELECT c.qid, c.docid, p.field, q.qtf * p.tf AS w, coalesce(m.pmi, -20.0) AS v
        FROM candidates c JOIN qterms q ON q.qid = c.qid JOIN postings p ON p.docid = c.docid
        LEFT JOIN pmi m ON m.t1 = q.term AND m.t2 = p.term"""),
    # evaluation
    "hits": (("candidates", "qrels"), """
        SELECT h.*, t.n_rel, t.n_nonrel,
               coalesce(sum(is_rel) OVER w, 0) AS rel_above, coalesce(sum(is_nonrel) OVER w, 0) AS nonrel_above
        FROM (SELECT c.qid, c.docid, c.score, r.rel, CASE WHEN r.rel > 0 THEN 1 ELSE 0 END AS is_rel,
                     CASE WHEN r.rel <= 0 THEN 1 ELSE 0 END AS is_nonrel,
                     row_number() OVER (PARTITION BY c.qid ORDER BY c.score DESC, c.docid DESC) AS pos
              FROM candidates c LEFT JOIN qrels r ON r.qid = c.qid AND r.docid = c.docid) h
        JOIN (SELECT qid, count(*) FILTER (rel > 0) AS n_rel, count(*) FILTER (rel <= 0) AS n_nonrel
              FROM qrels GROUP BY qid) t ON t.qid = h.qid
        WINDOW w AS (PARTITION BY h.qid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
    "ideal": (("positives",), """
        SELECT qid, rel, row_number() OVER (PARTITION BY qid ORDER BY rel DESC) AS pos FROM positives"""),
}

CTES |= _stem_ctes() | {
    "words": (("plain_tokens", "plain_qtoks"), f"""
        SELECT term FROM plain_tokens UNION SELECT unnest(toks) FROM plain_qtoks
        UNION SELECT unnest({tokens_of('text')}) FROM conversations"""),
}


def with_ctes(body: str, *names: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """`body` behind a WITH clause that holds the named expressions and all they read."""
    known = CTES | (extra or {})
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in known[name][0]:
                visit(other)
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({known[name][1]})" for name in ordered) + "\n" + body


def select(columns: str, source: str, *names: str, **options) -> str:
    """SELECT with explicit types. Columns are space-separated `name:type`; types are s (text), i, d (rounded)."""
    parts = []
    for column in columns.split():
        name, kind = column.rsplit(":", 1)
        quoted = f'"{name}"'
        if kind == "s":
            parts.append(quoted)
        elif kind == "i":
            parts.append(f"CAST({quoted} AS BIGINT) AS {quoted}")
        else:
            parts.append(f"round(CAST({quoted} AS DOUBLE), 6) + 0.0 AS {quoted}")
    return with_ctes(f"SELECT {', '.join(parts)} FROM ({source})", *names, **options)
