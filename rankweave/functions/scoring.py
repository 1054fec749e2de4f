"""Scoring formulas as column expressions; a scorer maps `Stats` to a Column."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring formulas.
K1 = 1.2
B = 0.75
DIRICHLET_MU = 2000.0
JM_SHORT = 0.65
JM_LONG = 0.25
JM_LONG_FROM = 3
SCORE_DIGITS = 6


class Stats(NamedTuple):
    """What a scorer may use about one (term, document) match."""

    n_docs: Column
    df: Column
    tf: Column
    dl: Column
    avg_dl: Column


def saturation(tf: Column, dl: Column, avg_dl: Column, k1: float = K1, b: float = B) -> Column:
    return tf * (k1 + 1) / (tf + k1 * ((1 - b) + b * dl / avg_dl))


def okapi(stats: Stats) -> Column:
    """BM25 with the plain inverse document frequency ln(N / df)."""
    return F.log(stats.n_docs / stats.df) * saturation(stats.tf, stats.dl, stats.avg_dl)


def smoothed(stats: Stats) -> Column:
    """BM25 with the always-defined frequency ln(N / (df + 1)) + 1."""
    return (F.log(stats.n_docs / (stats.df + 1)) + 1) * saturation(stats.tf, stats.dl, stats.avg_dl)


def stable(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """Rounded so that the order of additions cannot change a rank; adding zero drops a negative zero."""
    return F.round(score, digits) + F.lit(0.0)


def signed_log(x: Column) -> Column:
    return F.when(x > 0, F.log(F.abs(x) + 1)).otherwise(-F.log(F.abs(x) + 1))


def finite_or(x: Column, other: float) -> Column:
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(other)).otherwise(x)
