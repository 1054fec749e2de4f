"""The registered queries of the operators: each runs over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import bpe, filter_audit, filter_audit_sql, fingerprints, language, language_model, middle, middle_sql
from rankweave.llm import near_dedup, neighbours, packing, quality, rules, rules_sql, secrets, sharding
from rankweave.llm.common import remainder
from rankweave.session import materialize, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SHARDS = 16
NEIGHBOURS = 20
QUERY_EVERY = 20


def register(name: str, sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_external_shuffle")
def external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    shards = sharding.write_shards(docs, new_path(spark, "shards"), SHARDS)
    return shards.select(
        "doc_id",
        (F.octet_length(text()) + 1).cast("long").alias("size"),
        F.crc32(text()).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op2_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.share(spark, tokenizer_path("byte_bpe_50k.json"))
    docs = table(spark, folder, "documents", "doc_id", "text")
    both = docs.select("doc_id", bpe.round_trip(text(), vocabulary).alias("both")).select("doc_id", "both.*")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op3_secrets")
def find_secrets(spark: SparkSession, folder: str) -> DataFrame:
    def joined(of: str) -> Column:
        each = F.transform(F.col(of), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(each, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(F.col("found"), lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    scanned = table(spark, folder, "documents", "doc_id", "text").select("doc_id", secrets.scan(text()).alias("found"))
    base = scanned.withColumn("base", F.filter(F.col("found"), lambda x: x["kind"] != "literal"))
    return base.select(
        "doc_id", *[count(kind) for kind in secrets.KINDS[:3]],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"), count("literal"),
    )


@register("op5_language_codes")
def language_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = language.fit(docs.filter(~held_out))
    told = docs.select("doc_id", held_out.alias("held_out"), language.predict(F.col("text"), model).alias("told"))
    return told.select("doc_id", "held_out", F.col("told.lang").alias("lang_pred"), "told.score", "told.ambiguous")


@register("op6_rule_cascade", rules_sql.SQL)
def rule_cascade(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    judged = docs.select("doc_id", rules.verdicts(F.col("text"), rules.cascade(docs)).alias("verdict"))
    return judged.select("doc_id", "verdict.*")


@register("op9_quality_discriminant")
def quality_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text").select("doc_id", quality.features(F.col("text")).alias("features"))
    described = materialize(docs, "features")
    model = quality.fit(quality.training_rows(described, table(spark, folder, "labels", "doc_id", "quality")))
    scored = described.select("doc_id", quality.score(F.col("features"), model).alias("score"))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), quality.HELD_OUT_PARTS) == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@register("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = packing.share(spark, tokenizer_path("word_bpe_49k.json"))
    return packing.pack(table(spark, folder, "documents", "doc_id", "text"), tokenizer)


@register("op8_prob_minhash")
def prob_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))


@register("op10_bottom_k")
def bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text").select("doc_id", text().alias("text"))
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketched = docs.withColumn("sketch", fingerprints.sketch(F.col("text")))
    along = fingerprints.with_next(sketched, "doc_id", ["text", "sketch"], blocks)
    chars = F.char_length("text")
    moved = F.floor(chars / 2).cast("int")
    edited = along.select(
        "doc_id", chars.cast("long").alias("n_chars"), "sketch", F.col("next.sketch").alias("next_sketch"),
        F.concat(F.substring("text", F.lit(1), chars - moved), F.substring(F.col("next.text"), F.lit(1), moved)).alias("edited"))
    both = edited.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.spelled(F.col("sketch")).alias("fingerprint"),
        fingerprints.spelled(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


@register("op4_backoff_automaton")
def backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return language_model.score_documents(docs, remainder(F.col("doc_id"), 10) == 0)


@register("op11_filter_audit", filter_audit_sql.SQL)
def audit_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    return filter_audit.audit(docs, table(spark, folder, "labels", "doc_id", "quality", "toxic"))


@register("op12_pruned_graph")
def pruned_graph(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(embeddings, F.col("vec_id") % QUERY_EVERY == 0, NEIGHBOURS)


@register("op13_middle_regex", middle_sql.SQL)
def middle_regex(spark: SparkSession, folder: str) -> DataFrame:
    made = middle.transform(table(spark, folder, "documents", "doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
