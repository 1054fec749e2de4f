"""The registered queries on the smallest tables against plain Python or SQL, and the pipeline stage by stage."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from rankweave.llm import QUERIES, SQL, near_dedup, quality, rules, secrets
from rankweave.llm.queries import tokenizer_path
from rankweave.llm.text_stats import TextStats
from rankweave.session import new_path

from .conftest import FOLDER, SCHEMA, document, prose
from .test_language_model import PlainModel
from .test_near_dedup import expected
from .test_neighbours import recall
from .test_rules_and_quality import plain_metrics
from .test_secrets import plain
from .test_sharding import check
from .test_tokens import check_packing

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.fixture(scope="module")
def text(rows):
    return {r.doc_id: r.text or "" for r in rows}


def crc(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def sha(of):
    return hashlib.sha256(of.encode()).hexdigest()


def test_entry_lists_everything():
    names = entry_module.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(SQL) <= set(entry_module.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


def test_op1(spark, text):
    found = QUERIES["op1_external_shuffle"](spark, FOLDER).collect()
    check(found, 16, len(text))
    for r in found:
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_op2(spark, text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    found = QUERIES["op2_byte_bpe"](spark, FOLDER).collect()
    assert len(found) == len(text)
    for r in found:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_op3(spark, text):
    found = QUERIES["op3_secrets"](spark, FOLDER).collect()
    assert len(found) == len(text)
    for r in found:
        base = plain(text[r.doc_id])
        spelled = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base]
        kinds = Counter(k for _, k, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (kinds[0], kinds[1], kinds[2], sha(",".join(spelled)))
        assert [x for x in r.spans.split(",") if x and not x.startswith("literal")] == spelled


def test_op4(spark, text):
    model = PlainModel([t.encode() for d, t in text.items() if crc(d, 10)])
    found = QUERIES["op4_backoff_automaton"](spark, FOLDER).collect()
    assert len(found) == len(text)
    for r in found:
        data = text[r.doc_id].encode()
        base, total = model.score(data)
        tokens = model.tokens(data)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (not crc(r.doc_id, 10), len(tokens), model.tokens_seen)
        assert r.n_known == sum(model.words[w] > 0 for w in tokens)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and abs(r.score - total) < 1e-6 * abs(total)


def test_op5(spark, rows):
    found = {r.doc_id: r for r in QUERIES["op5_language_codes"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    right = [found[r.doc_id].lang_pred == r.lang for r in rows if crc(r.doc_id, 3) == 1 and r.lang]
    assert sum(right) / len(right) > 0.97
    assert all(found[r.doc_id].held_out == (crc(r.doc_id, 3) == 1) and 0 <= found[r.doc_id].score <= 1 for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    result = con.execute(SQL[name])
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert sorted(c[0] for c in result.description) == columns
    at = [[c[0] for c in result.description].index(c) for c in columns]
    wanted = sorted(tuple(r[i] for i in at) for r in result.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == wanted


def test_op6_metrics(spark, text):
    for r in QUERIES["op6_rule_cascade"](spark, FOLDER).collect():
        assert [r[m] for m in rules.METRICS] == plain_metrics(text[r.doc_id])


def test_op7(spark, text):
    found = QUERIES["op7_best_fit_packing"](spark, FOLDER).collect()
    used = check_packing(found, {d: [t] for d, t in text.items()}, 2048)
    assert used <= -(-sum(r.length for r in found) // 2048) * 1.02 + 1


def test_op8(spark, rows):
    found = {r.doc_id: r.class_id for r in QUERIES["op8_prob_minhash"](spark, FOLDER).collect()}
    assert found == expected(sorted((r.doc_id, r.text) for r in rows))


def test_op9(spark, text):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    found = QUERIES["op9_quality_discriminant"](spark, FOLDER).collect()
    assert len(found) == len(text)
    assert all(r.held_out == (not crc(r.doc_id, 5)) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in found)
    held = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_op12(spark):
    found = QUERIES["op12_pruned_graph"](spark, FOLDER).collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    assert recall(found, vectors, [q for q in vectors if q % 20 == 0], 20) >= 0.95


def tables(spark, docs, labels):
    folder = new_path(spark, "tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    vectors = [(i, [1.0 + i, 2.0, -1.0], "x") for i in range(40)] if docs.head(1) else []
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, shard string").write.parquet(f"{folder}/embeddings.parquet")
    return folder


def test_pipeline_stage_by_stage(spark, rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.fit_documents(docs, labels)
    good = [r for r in rows if model.scores([quality.transformed((r.text or "").encode())])[0] >= quality.THRESHOLD]
    now = stages["quality"](spark, docs, FOLDER)
    assert sorted(r.doc_id for r in now.collect()) == sorted(r.doc_id for r in good) and len(good) < len(rows)
    fine = [r for r in good if not any(x.rejects(TextStats((r.text or "").encode())) for x in rules.RULES)]
    now = stages["rules"](spark, spark.createDataFrame(good, docs.schema), FOLDER)
    assert sorted(now.collect()) == sorted(fine) and len(fine) < len(good)
    classes = expected([(r.doc_id, r.text) for r in sorted(fine)])
    now = stages["near_dedup"](spark, spark.createDataFrame(fine, docs.schema), FOLDER)
    alone = sorted(r for r in fine if classes[r.doc_id] == r.doc_id)
    assert sorted(now.collect()) == alone and len(alone) < len(fine)
    now = stages["secrets"](spark, spark.createDataFrame(alone, docs.schema), FOLDER)
    masked = sorted(now.collect())
    assert now.columns == docs.columns
    assert [(r.doc_id, r.text, r.n_chars) for r in masked] == [(r.doc_id, secrets.redacted(r.text), len(secrets.redacted(r.text))) for r in alone]
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    by_id = defaultdict(list)
    for r in masked:
        by_id[r.doc_id].append(r.text)
    check_packing(packed, by_id, 2048)
    assert {r.doc_id for r in packed} == set(by_id)


def test_stages_on_hard_and_empty_tables(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (2, 0, None), (4, None, 1), (None, 1, 0), (14, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (hard, nothing):
        folder = tables(spark, docs, labels)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert name == "packing" or out.schema.names == docs.schema.names
            assert (out.count() > 0) == (docs is hard) or name == "quality"
        assert (corpus_pipeline.run(spark, folder).count() == 0) == (docs is nothing) or docs is hard


def test_queries_on_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = tables(spark, nothing, labels)
    for name, query in QUERIES.items():
        assert query(spark, folder).count() == 0, name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_the_hard_table(spark, hard, name):
    """Nulls, empty and long texts, ties, repeated rows and extra columns: one row per document where the query says so."""
    labels = spark.createDataFrame([(1, 1, 0, "h"), (3, 0, 0, "h"), (2, 0, None, "h"), (4, None, 1, "h"), (None, 1, 0, None), (14, 1, 0, "h"), (1, 1, 1, "h")],
                                   "doc_id long, quality int, toxic int, part string")
    found = QUERIES[name](spark, tables(spark, hard, labels)).collect()
    if name == "op12_pruned_graph":
        assert len(found) == 2 * 20
    elif name == "op11_filter_audit":
        assert len(found) == 600 * len({r.lang or "" for r in hard.collect()})
    elif name != "op7_best_fit_packing":
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in hard.collect())


def test_clean_documents_stay(spark):
    docs = [document(i, ". ".join(prose(1000 * i + j, 12) for j in range(8))) for i in range(40)]
    junk = [document(100 + i, "### $$$ " * 40 + prose(i, 3)) for i in range(20)]
    df = spark.createDataFrame(docs + junk, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in corpus_pipeline.run(spark, tables(spark, df, labels)).collect()} == set(range(40))


def test_one_of_equal_rows_stays(spark):
    df = spark.createDataFrame([document(1, prose(1, 30)), document(1, prose(1, 30)), document(1, prose(1, 30), "de"), document(2, prose(1, 30))], SCHEMA)
    assert [r.doc_id for r in near_dedup.keep_one(df).collect()] == [1]
