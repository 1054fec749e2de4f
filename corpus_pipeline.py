"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents they got.

1. quality: a discriminant trained on the labelled documents; documents below the threshold go.
2. rules: the rule cascade; documents that a rule rejects go.
3. near_dedup: one document of each group of near copies stays.
4. secrets: secrets are masked in the text, and `n_chars` follows where a text has changed.
5. packing: pieces of at most 2048 tokens with their ids, sequence and offset.

Rows: a null text counts as empty; an empty text fails the rules. Null keys, repeated keys and ties are allowed: of rows
equal in class, the one with the smallest key stays, of rows equal in key and text one, and a null key is smaller than none.
Columns of any name pass all stages but the last. Labels without a document train nothing. Very long texts go whole
through every stage. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import near_dedup, packing, quality, rules, secrets
from rankweave.llm.common import column
from rankweave.llm.queries import tokenizer_path
from rankweave.session import materialize

TOKENIZER = "word_bpe_49k.json"
# Documents are kilobytes and sometimes megabytes long, so batches for Python hold fewer rows than Spark's default.
BATCH_ROWS, DEFAULT_BATCH_ROWS = "1000", "10000"
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Bounds what a task holds outside the heap, in the session; a size that its owner has chosen stays."""
    if spark.conf.get(BATCH_KEY) == DEFAULT_BATCH_ROWS:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.fit_documents(docs, labels))


def within_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return rules.keep(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return near_dedup.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    masked = "masked"
    while masked in docs.columns:
        masked += "_"
    changed = ~column(masked).eqNullSafe(column("text"))
    new = {
        "text": column(masked),
        "n_chars": F.when(changed, F.char_length(column(masked)).cast("long")).otherwise(column("n_chars")) if "n_chars" in docs.columns else None,
    }
    scanned = docs.withColumn(masked, secrets.redact(column("text")))
    return scanned.select(*[new[c].alias(c) if c in new else column(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return packing.pack(docs, packing.share(spark, tokenizer_path(TOKENIZER)), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("rules", within_rules),
    ("near_dedup", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed_sequences),
]

#: Shrunken covariances, signatures, lexing and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
