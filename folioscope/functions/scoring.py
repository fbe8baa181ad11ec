"""Scores and limits as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear(x: Column, low: float, high: float) -> Column:
    """Where ``x`` lies from ``low`` (0) to ``high`` (1), clamped; 0 if they are equal."""
    if high == low:
        return F.lit(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (high - low)))


def citation_weight(citations: Column) -> Column:
    return F.log1p(F.greatest(F.coalesce(citations, F.lit(0)), F.lit(0)).cast("double"))


def candidate_score(doc_freq: Column, total_freq: Column, weight: Column) -> Column:
    return 3.0 * doc_freq + total_freq + 0.75 * weight


def extra_claims(citations: Column, words: Column) -> Column:
    """0 to 10 claims beyond the first ten: 35 % by citations from 100 to 2,000, 65 % by words from 1,500 to 12,000, half to even."""
    score = 0.35 * linear(F.coalesce(citations, F.lit(0)), 100, 2000) + 0.65 * linear(words, 1500, 12000)
    return F.bround(10 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 0).cast("int")
