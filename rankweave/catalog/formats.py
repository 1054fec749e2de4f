"""Text formats: the tables are written in each format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.catalog.evaluation import evaluation_sql
from rankweave.catalog.ranking_features import FEATURE_CTES
from rankweave.catalog.registry import register
from rankweave.catalog.training import _TRIPLE_COLUMNS, _TRIPLES, SEED
from rankweave.operators import measures, sampling
from rankweave.operators.features import long_features
from rankweave.operators.index import append_documents, clear_index, read_index
from rankweave.operators.search import judged_queries
from rankweave.plans.workbench import DEPTH, Workbench
from rankweave.session import new_path
from rankweave.sources import tables, trec
from rankweave.streaming.ingest import index_new_files

_FLAT = "regexp_replace({}, '[\\t\\r\\n]', ' ', 'g')"


@register("src_docs", "docid:s url:s title:s body:s", f"""
    SELECT docid, url, {_FLAT.format('title')} AS title, regexp_replace({_FLAT.format('body')}, '\\s+$', '') AS body
    FROM docs WHERE regexp_replace(body, '\\s+$', '') != ''""", "docs")
def src_docs(w: Workbench):
    path = new_path(w.spark, "docs-tsv")
    trec.write_docs(w.docs, path)
    return trec.read_docs(w.spark, path)


@register("src_queries", "qid:s text:s", f"""
    SELECT qid, {_FLAT.format('text')} AS text FROM queries
    UNION ALL SELECT conv_id || '-' || turn, {_FLAT.format('text')} FROM conversations WHERE role = 'user'""", "queries")
def src_queries(w: Workbench):
    first, second = new_path(w.spark, "queries"), new_path(w.spark, "queries")
    trec.write_queries(w.queries, first)
    trec.write_queries(tables.passage_queries(w.spark, w.folder), second)
    return trec.read_queries(w.spark, [first, second])


@register("split_union", "qid:s text:s", """
    SELECT qid, CASE WHEN qid IN (SELECT qid FROM positives) THEN text || ' (second)' ELSE text END AS text
    FROM queries""", "queries", "positives")
def split_union(w: Workbench):
    queries = trec.placed(w.queries)
    judged = judged_queries(queries, sampling.positives(w.qrels))
    return trec.merge_queries([queries, judged.withColumn("text", F.concat("text", F.lit(" (second)")))])


@register("src_qrels", "qid:s docid:s rel:i", "SELECT * FROM positives", "positives")
def src_qrels(w: Workbench):
    path = new_path(w.spark, "qrels")
    trec.write_qrels(w.qrels, path)
    return trec.read_qrels(w.spark, path, min_rel=1)


@register("src_qrels_binary", "qid:s docid:s rel:i", "SELECT qid, docid, 1 AS rel FROM positives", "positives")
def src_qrels_binary(w: Workbench):
    path = new_path(w.spark, "qrels")
    trec.write_qrels(sampling.positives(w.qrels).withColumn("rel", F.lit(1)), path)
    return trec.read_qrels(w.spark, path, only_rel=1)


@register("src_candidates", "qid:s docid:s rank:i", "SELECT * FROM candidates", "candidates")
def src_candidates(w: Workbench):
    path = new_path(w.spark, "candidates")
    trec.write_run(w.candidates, path)
    return trec.read_candidates(w.spark, path)


@register("src_run", "run_id:s qid:s docid:s rank:i score:d", "SELECT * FROM candidates", "candidates")
def src_run(w: Workbench):
    path = new_path(w.spark, "run")
    trec.write_run(w.candidates, path)
    return trec.read_run(w.spark, path)


@register("src_metrics", "qid:s metric:s value:d",
          f"SELECT qid, metric, round(value + 1e-9, 4) AS value FROM ({evaluation_sql(['num_ret', 'set_P', 'recip_rank'])})",
          "hits")
def src_metrics(w: Workbench):
    path = new_path(w.spark, "metrics")
    rows = measures.evaluate(w.candidates, w.qrels, DEPTH, ["num_ret", "set_P", "recip_rank"])
    trec.write_metrics(rows.withColumn("value", F.col("value") + 1e-9), path)
    return trec.read_metrics(w.spark, path, "okapi")


@register("src_passages", "pid:s text:s", f"""
    SELECT conv_id || '-' || turn AS pid, {_FLAT.format('text')} AS text FROM conversations
    WHERE role = 'assistant'""")
def src_passages(w: Workbench):
    path = new_path(w.spark, "passages")
    trec.write_queries(tables.passages(w.spark, w.folder).withColumnRenamed("pid", "qid"), path)
    return trec.read_passages(w.spark, path)


@register("src_passage_pairs", "qid:s pid:s rel:i", """
    SELECT a.conv_id || '-' || a.turn AS qid, b.conv_id || '-' || b.turn AS pid, a.turn % 5 + 1 AS rel
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user' AND b.role = 'assistant'""")
def src_passage_pairs(w: Workbench):
    path = new_path(w.spark, "pairs")
    tables.passage_pairs(w.spark, w.folder).write.option("sep", "\t").csv(path)
    return trec.read_passage_pairs(w.spark, path)


@register("trec_lines", "line:s", """
    SELECT qid || ' Q0 ' || docid || ' ' || rank || ' ' || printf('%.6f', score) || ' ' || run_id AS line
    FROM candidates""", "candidates")
def trec_lines(w: Workbench):
    path = new_path(w.spark, "run")
    trec.write_run(w.candidates, path)
    return w.spark.read.text(path).withColumnRenamed("value", "line")


@register("qrel_lines", "line:s", "SELECT qid || ' 0 ' || docid || ' ' || rel AS line FROM qrels", "qrels")
def qrel_lines(w: Workbench):
    path = new_path(w.spark, "qrels")
    trec.write_qrels(w.qrels, path)
    return w.spark.read.text(path).withColumnRenamed("value", "line")


_NAMES = [column.split(":")[0] for column in _TRIPLE_COLUMNS.split()]


@register("triple_lines", "line:s",
          f"SELECT {_FLAT.format('concat_ws(chr(9), ' + ', '.join(_NAMES) + ')').replace('[\\t\\r\\n]', '[\\r\\n]')} AS line FROM triples",
          "triples", extra=_TRIPLES)
def triple_lines(w: Workbench):
    path = new_path(w.spark, "triples")
    rows = sampling.triples(w.queries, w.docs, w.candidates, w.qrels, SEED)
    trec.write_triples(rows.select(*[F.regexp_replace(name, r"[\r\n]", " ").alias(name) for name in _NAMES]), path)
    return w.spark.read.text(path).withColumnRenamed("value", "line")


@register("feature_cache", "qid:s docid:s feat:i name:s value:d", "SELECT * FROM long_features", "long_features", extra=FEATURE_CTES)
def feature_cache(w: Workbench):
    """Every value, read from the cache that an earlier call wrote."""
    path = new_path(w.spark, "feature-cache")
    trec.cached(w.spark, path, lambda: w.features)
    return long_features(trec.cached(w.spark, path, lambda: w.features.limit(0)))


@register("index_stream", "field:s term:s df:i cf:i", "SELECT * FROM term_stats", "term_stats")
def index_stream(w: Workbench):
    source, path, state = (new_path(w.spark, label) for label in ("arriving", "streamed", "progress"))
    w.docs.repartition(3, "docid").write.parquet(source)
    clear_index(w.spark, path)
    index_new_files(w.spark, source, path, state, stem=True, files_per_batch=1).awaitTermination()
    append_documents(path, w.docs, "again")
    return read_index(w.spark, path).term_stats()
