"""BM25 retrieval for whole query tables at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.functions import scoring, text
from rankweave.operators.blocks import best_of_blocks
from rankweave.operators.index import Index, build_index
from rankweave.operators.joins import fits_in_memory, frequent_keys, lookup_join
from rankweave.operators.ordering import GROUP_LIMIT, top_k
from rankweave.session import materialize

Scorer = Callable[[scoring.Stats], Column]

RUN_COLUMNS = ("run_id", "qid", "docid", "rank", "score")
SHARED = 4  # matches of a posting, on average, from which its document's postings are brought together first
BLOCK_MATCHES = 20_000_000  # matches from which scores are added up in blocks of documents


def query_terms(queries: DataFrame, stem: bool = False) -> DataFrame:
    """(qid, term, qtf, q_len, n_terms): distinct analysed terms with their count in the query."""
    analyzed = queries.select("qid", F.explode(F.array(text.analyze(F.col("text"), stem))).alias("tokens"))
    return (
        analyzed.select(
            "qid",
            F.size("tokens").cast("long").alias("q_len"),
            F.size(F.array_distinct("tokens")).cast("long").alias("n_terms"),
            F.explode("tokens").alias("term"),
        )
        .groupBy("qid", "term", "q_len", "n_terms")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def wanted_share(mode: str | int) -> int | None:
    """The d of "at least one in d query terms": 1 for `and`, None for `or`, else the number given."""
    known = {"and": 1, "or": None}
    if isinstance(mode, int) and mode > 0:
        return mode
    if mode not in known:
        raise ValueError(f"mode must be 'and', 'or' or a positive number, not {mode!r}")
    return known[mode]


def _weighted(terms: DataFrame, small: bool, index: Index, field: str) -> DataFrame:
    """`terms` that occur in the field, with their df."""
    stats = index.term_stats(terms.select("term").distinct(), small).filter(F.col("field") == field)
    stats = stats.select("term", "df")
    if small:  # streaming the statistics keeps the rows of a term together in a table that is broadcast later
        return lookup_join(stats, terms, ["term"], ["term"], small)
    return lookup_join(terms, stats, ["term"], ["qid"], small, frequent=_frequent(terms, ["term"]))


def _frequent(rows: DataFrame, on: list[str], times: Column | None = None) -> DataFrame:
    """The keys with very many `rows`; with `times` a key counts its rows times the largest `times`."""
    number = F.count(F.lit(1)) if times is None else F.count(F.lit(1)) * F.max(times)
    return frequent_keys(rows.groupBy(*on).agg(number.alias("_rows")), on, "_rows")


def planned(weighted: DataFrame, one_in: int) -> DataFrame:
    """The terms of the queries that can match, with `_anchor` and `_lookup`.

    Anchors are a query's rarest terms, one of which is in every document that can match: a document with m of n
    terms lacks n - m of them, so it holds one of any n - m + 1. Terms that occur nowhere are the rarest of all and need no
    look-up; a query with fewer known terms than it wants matches nothing and is left out.

    `_lookup` tells the cheaper way for the query, by the rows that it makes. Taking all postings of all terms makes
    the sum of their df. Finding documents by the anchors and looking up every known term for each makes the anchors'
    df times one more than the known terms at most. So no query makes more rows than taking all postings would.
    """
    whole = W.partitionBy("qid")  # as many rows as a query has terms
    known = F.count(F.lit(1)).over(whole)
    least = F.ceil(F.col("n_terms") / one_in)
    placed = weighted.select(
        "*", known.alias("_known"), F.row_number().over(whole.orderBy("df", "term")).alias("_pos"))
    possible = placed.filter(F.col("_known") >= least).withColumn("_anchor", F.col("_pos") <= F.col("_known") - least + 1)
    anchored = F.sum(F.when(F.col("_anchor"), F.col("df")).otherwise(0)).over(whole)
    lookup = anchored * (F.col("_known") + 1) < F.sum("df").over(whole)
    return possible.withColumn("_lookup", lookup).drop("_known", "_pos")


def pair_matches(pairs: DataFrame, weighted: DataFrame, small: bool, index: Index, field: str = "body") -> DataFrame:
    """The matches of the given (qid, docid) pairs only, looked up by (docid, term).

    Postings are met by distinct keys, so neither a document of many queries nor a term of many pairs makes a large
    group; the few postings found are then looked up by the pairs' terms.
    """
    asked = lookup_join(pairs, weighted, ["qid"], ["docid"], small, frequent=_frequent(pairs, ["qid"]))
    asked = materialize(asked, "pair-terms")
    wanted = asked.select("docid", "term").distinct()
    few = fits_in_memory(wanted)
    near = index.field(field)
    if not few:  # what is shuffled holds terms of the queries only
        near = _of_terms(near, weighted, small)
    # files of few bytes may hold many rows, so without the measured size Spark is not left to broadcast them
    found = near.join(F.broadcast(wanted) if few else wanted.hint("merge"), ["docid", "term"], "left_semi")
    return lookup_join(asked, found, ["docid", "term"], ["qid"], few, frequent=_frequent(asked, ["docid", "term"]))


def _of_terms(postings: DataFrame, weighted: DataFrame, small: bool) -> DataFrame:
    """The postings of the terms in `weighted`."""
    terms = weighted.groupBy("term").agg(F.max("df").alias("df"))
    frequent = frequent_keys(terms, ["term"], "df")
    return lookup_join(postings, terms.select("term"), ["term"], ["docid"], small, "left_semi", frequent=frequent)


def _by_document(postings: DataFrame, weighted: DataFrame, small: bool) -> DataFrame:
    """`postings`; where queries share their terms, those of the terms only, with a document's in one partition.

    A posting makes a match for each query that asks for its term. Where these are many, moving postings before they are
    met is the smaller shuffle, and sums by query and document then need none of their own, partial sums neither.
    """
    if not small:
        return postings
    terms = weighted.groupBy("term").agg(F.max("df").alias("df"), F.count(F.lit(1)).alias("n"))
    alone, met = terms.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum(F.col("df") * F.col("n")), F.lit(0))).first()
    if met <= SHARED * alone:
        return postings
    # a number that is given is kept: rows are few here, but each makes many matches
    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _of_terms(postings, weighted, small).repartition(parts, "docid")


def matches(queries: DataFrame, index: Index, field: str = "body", mode: str | int = "or",
            within: DataFrame | None = None) -> DataFrame:
    """(query term, posting) matches: qid, docid, term, tf, dl, df, qtf, q_len, n_terms.

    With a mode that wants more than one term, each query goes the way that makes fewer rows (see `planned`).
    `within(docid)` keeps only those documents.
    """
    one_in = wanted_share(mode)
    terms = materialize(query_terms(queries, index.stem), "query-terms")
    small = fits_in_memory(terms)
    weighted = _weighted(terms, small, index, field)
    postings = index.field(field)
    if within is not None:
        ids = within.select("docid").distinct()
        few = fits_in_memory(ids)
        if not few:  # what is shuffled holds terms of the queries only
            postings = _of_terms(postings, weighted, small)
        # the terms of one document are too few to need salt
        postings = lookup_join(postings, ids, ["docid"], ["term"], few, "left_semi", salts=1)

    if one_in is None:
        return _met(_by_document(postings, weighted, small), weighted, weighted, small)
    return _planned_matches(materialize(planned(weighted, one_in), "weighted-terms"), postings, small, index, field)


def _met(postings: DataFrame, asked: DataFrame, weighted: DataFrame, small: bool) -> DataFrame:
    return lookup_join(postings, asked, ["term"], ["docid"], small, frequent=_frequent(weighted, ["term"], F.col("df")))


def _planned_matches(weighted: DataFrame, postings: DataFrame, small: bool, index: Index, field: str) -> DataFrame:
    """The matches of the queries in `weighted`, each taken the way that `planned` chose."""
    ways = {r["_lookup"] for r in weighted.select("_lookup").distinct().collect()}
    direct = weighted.filter(~F.col("_lookup")).drop("_anchor", "_lookup")
    if True not in ways:
        return _met(_by_document(postings, direct, small), direct, weighted, small)
    taken = _met(postings, direct, weighted, small)
    looked = weighted.filter("_lookup")
    anchors = looked.filter("_anchor").select("qid", "term")
    anchored = _met(postings.select("docid", "term"), anchors, weighted, small)
    pairs = materialize(anchored.select("qid", "docid").distinct(), "anchored")
    found = pair_matches(pairs, looked.drop("_anchor", "_lookup"), small, index, field)
    return taken.unionByName(found) if False in ways else found


def run_matches(queries: DataFrame, index: Index, run: DataFrame, field: str = "body") -> DataFrame:
    """The matches of a run's (qid, docid) pairs."""
    terms = materialize(query_terms(queries, index.stem), "query-terms")
    small = fits_in_memory(terms)
    weighted = materialize(_weighted(terms, small, index, field), "weighted-terms")
    return pair_matches(run.select("qid", "docid").distinct(), weighted, small, index, field)


def search(queries: DataFrame, index: Index, scorer: Scorer = scoring.okapi, k: int = 1000, mode: str | int = "and",
           field: str = "body", run_id: str = "okapi") -> DataFrame:
    """The k best documents of each query as a run (run_id, qid, docid, rank, score).

    `and` keeps documents that hold every query term, `or` those that hold at least one, a number d those that hold
    at least one in d of the terms.
    """
    one_in = wanted_share(mode)
    if one_in is None or k > GROUP_LIMIT:
        scored = score_matches(matches(queries, index, field, mode), index, {run_id: scorer}, mode, field)
        return top_k(scored, k).select(*RUN_COLUMNS)
    terms = materialize(query_terms(queries, index.stem), "query-terms")
    small = fits_in_memory(terms)
    weighted = planned(_weighted(terms, small, index, field), one_in)
    whole = W.partitionBy("qid")  # a qid with texts of several lengths has no one number of terms to want
    weighted = weighted.withColumn(
        "_dense", ~F.col("_lookup") & (F.min("n_terms").over(whole) == F.max("n_terms").over(whole)))
    weighted = materialize(weighted, "weighted-terms")
    dense = weighted.filter("_dense")
    postings = index.field(field)
    if (dense.agg(F.sum("df")).first()[0] or 0) <= BLOCK_MATCHES:
        found = _planned_matches(weighted.drop("_dense"), postings, small, index, field)
        return top_k(score_matches(found, index, {run_id: scorer}, mode, field), k).select(*RUN_COLUMNS)
    best = best_of_blocks(dense, postings, scorer(_stats(index, field)), one_in, k)
    best = best.select(F.lit(run_id).alias("run_id"), "qid", "docid", scoring.stable(F.col("score")).alias("score"))
    rest = weighted.filter(~F.col("_dense")).drop("_dense")
    if not rest.isEmpty():
        found = _planned_matches(rest, postings, small, index, field)
        best = best.unionByName(score_matches(found, index, {run_id: scorer}, mode, field))
    return top_k(best, k).select(*RUN_COLUMNS)


def _stats(index: Index, field: str) -> scoring.Stats:
    totals = index.totals()[field]
    return scoring.Stats(F.lit(float(totals.n_docs)), F.col("df"), F.col("tf"), F.col("dl"), F.lit(totals.avg_len))


def score_matches(matched: DataFrame, index: Index, scorers: dict[str, Scorer], mode: str | int = "and",
                  field: str = "body") -> DataFrame:
    """(run_id, qid, docid, score), one row per scorer, all from one aggregation over the matched terms."""
    one_in = wanted_share(mode)
    stats = _stats(index, field)
    scored = matched.groupBy("qid", "docid").agg(
        F.count(F.lit(1)).alias("_matched"),
        F.max("n_terms").alias("_wanted"),
        *[scoring.stable(F.sum(scorer(stats))).alias(f"_s_{run_id}") for run_id, scorer in scorers.items()],
    )
    if one_in is not None:
        scored = scored.filter(one_in * F.col("_matched") >= F.col("_wanted"))
    if len(scorers) == 1:
        run_id = next(iter(scorers))
        return scored.select(F.lit(run_id).alias("run_id"), "qid", "docid", F.col(f"_s_{run_id}").alias("score"))
    return scored.select(
        "qid", "docid",
        F.inline(F.array(*[
            F.struct(F.lit(run_id).alias("run_id"), F.col(f"_s_{run_id}").alias("score")) for run_id in scorers
        ])),
    ).select("run_id", "qid", "docid", "score")


def matched_terms(queries: DataFrame, index: Index, run: DataFrame, field: str = "body") -> DataFrame:
    """(qid, docid, terms): the query terms found in each retrieved document, in alphabetical order."""
    found = run_matches(queries, index, run, field).select("qid", "docid", "term")
    return found.groupBy("qid", "docid").agg(
        F.array_join(F.array_sort(F.collect_set("term")), " ").alias("terms")
    )


def compare_scorers(queries: DataFrame, index: Index, scorers: dict[str, Scorer], k: int = 10, mode: str | int = "and",
                    field: str = "body") -> DataFrame:
    """The runs of several scorers on the same matches, tagged by run_id."""
    scored = score_matches(matches(queries, index, field, mode), index, scorers, mode, field)
    return top_k(scored, k, group=["run_id", "qid"]).select(*RUN_COLUMNS)


def query_index(queries: DataFrame) -> Index:
    """Queries as an unstemmed collection, so that queries can be searched for queries."""
    return build_index(queries.select(F.col("qid").alias("docid"), F.col("text").alias("body")), ("body",))


def judged_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """Queries that have at least one judgment."""
    return queries.join(qrels.select("qid").distinct(), "qid", "left_semi")


def transfer_judgments(pairs: DataFrame, pair_queries: DataFrame, passages: DataFrame, queries_index: Index,
                       docs_index: Index, k: int = 5, mode: str | int = "and",
                       scorer: Scorer = scoring.okapi) -> DataFrame:
    """Carry (qid, pid, rel) judgments of passages over to documents: (qid, docid, rel).

    The k queries nearest to the pair's query and the k documents nearest to its passage are paired by rank;
    a pair with no query or no document gives nothing.
    """
    asked = pair_queries.join(pairs.select("qid"), "qid", "left_semi")
    shown = passages.join(pairs.select("pid"), "pid", "left_semi")
    near_queries = search(asked, queries_index, scorer, k, mode).select(
        "qid", F.col("docid").alias("to_qid"), "rank"
    )
    near_docs = search(
        shown.select(F.col("pid").alias("qid"), "text"), docs_index, scorer, k, mode
    ).select(F.col("qid").alias("pid"), "docid", "rank")
    return (
        pairs.join(near_queries, "qid")
        .join(near_docs, ["pid", "rank"])
        .select(F.col("to_qid").alias("qid"), "docid", "rel")
    )
