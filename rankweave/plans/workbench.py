"""The stage tables of a ranking study over one data folder.

A study analyses its collection once and then asks many questions of it. Each stage (index, candidates, judgments,
features) is written to the shared folder on first use and read from there by everything built on it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from rankweave.functions import scoring
from rankweave.operators import cooccurrence, features, sampling
from rankweave.operators.index import Index, build_index
from rankweave.operators.joins import fits_in_memory
from rankweave.operators.search import query_terms, search
from rankweave.session import materialize
from rankweave.sources import tables

DEPTH = sampling.CANDIDATE_DEPTH
# A candidate holds at least one in so many of the query's terms.
CANDIDATE_SHARE = 5
_OPEN: dict[tuple[str, str], Workbench] = {}


class Workbench:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._stages: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Workbench:
        """The workbench of this application and folder."""
        key = (spark.sparkContext.applicationId, folder)
        if key not in _OPEN:
            _OPEN[key] = cls(spark, folder)
        return _OPEN[key]

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stages:
            self._stages[name] = materialize(build(), name)
        return self._stages[name]

    @property
    def docs(self) -> DataFrame:
        return tables.documents(self.spark, self.folder)

    @property
    def texts(self) -> DataFrame:
        """The documents for work on their whole text, over all cores."""
        return tables.spread(self.docs, "docid")

    @property
    def queries(self) -> DataFrame:
        return tables.queries(self.spark, self.folder)

    @cached_property
    def index(self) -> Index:
        """The stemmed index, on which everything else builds."""
        return build_index(self.texts, stem=True)

    @cached_property
    def plain_index(self) -> Index:
        return build_index(self.docs)

    @property
    def candidates(self) -> DataFrame:
        """The 100 best documents of each query among those with a fifth of its terms."""
        return self.stage("candidates", lambda: search(self.queries, self.index, k=DEPTH, mode=CANDIDATE_SHARE))

    @property
    def other_run(self) -> DataFrame:
        return self.stage("other-run", lambda: search(
            self.queries, self.index, scoring.smoothed, k=DEPTH, mode=CANDIDATE_SHARE, run_id="bm25"))

    @property
    def qrels(self) -> DataFrame:
        return self.stage("qrels", lambda: tables.judgments(self.spark, self.folder, self.index))

    @property
    def pmi(self) -> DataFrame:
        """PMI of pairs that start with a query term."""

        def build() -> DataFrame:
            vocabulary = query_terms(self.queries, self.index.stem).select("term").distinct()
            return cooccurrence.vocabulary_pmi(self.texts, self.index, vocabulary, fits_in_memory(vocabulary))

        return self.stage("pmi", build)

    @property
    def features(self) -> DataFrame:
        """The 92 features of every candidate pair."""
        return self.stage("features", lambda: features.pair_features(
            self.candidates, self.queries, self.docs, self.index, self.pmi))

    @property
    def query_features(self) -> DataFrame:
        return self.stage("query-features", lambda: features.query_features(self.queries, self.index, self.pmi))
