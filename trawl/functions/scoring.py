"""Scoring formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idf(df: Column, n_docs: Column | int) -> Column:
    return F.log10((F.lit(n_docs) + 1) / (df + 1))


def bm25_idf(df: Column, n: Column | int) -> Column:
    return F.log(1 + (F.lit(n) - df + 0.5) / (df + 0.5))


def bm25_gain(weight: Column, tf: Column, k1: float, relative_length: Column | float = 1.0) -> Column:
    """One term's gain; ``relative_length`` is what the document's length makes of ``k1``, 1 for an average one."""
    return weight * tf * (k1 + 1) / (tf + k1 * relative_length)


def or_one(x: Column) -> Column:
    """A zero (or missing) norm counts as 1."""
    return F.when(x != 0, x).otherwise(F.lit(1.0))


def norm_linear(x: Column, top: Column) -> Column:
    return F.when((top != 0) & (x > 0), x / top).otherwise(F.lit(0.0))


def norm_log(x: Column, top: Column) -> Column:
    return F.when((top != 0) & (x > 0), F.log1p(x) / F.log1p(top)).otherwise(F.lit(0.0))


def sort_key(score: Column) -> Column:
    """Score on a 1e-9 grid, so that ties do not hang on summation order."""
    return F.floor(score * 1e9 + 0.5)


def round3(x: Column) -> Column:
    """Round a non-negative double to 3 places as Python does: by its exact binary value.

    Only at a decimal tie does this differ from ordinary rounding. There the
    distance to the tie is computed without error, by splitting x into a 24-bit
    and a 29-bit half, and its sign decides; a true tie goes to the even digit.
    """
    high = x.cast("float").cast("double")
    low = x - high
    halves = F.rint(x * 2000)
    beyond = (high * 2000 - halves) + low * 2000
    at_tie = (halves % 2 == 1) & (F.abs(beyond) < 1e-6)
    rounded = (F.when(at_tie & (beyond > 0), (halves + 1) / 2)
               .when(at_tie & (beyond < 0), (halves - 1) / 2)
               .when(at_tie, F.rint(halves / 4) * 2)
               .otherwise(F.rint(x * 1000)))
    return rounded / 1000
