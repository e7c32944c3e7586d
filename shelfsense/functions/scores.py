"""Scoring formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores that differ only by the order of a floating-point sum must count as ties.
TIE_DIGITS = 10


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def bm25_idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log((n_docs - doc_freq + 0.5) / (doc_freq + 0.5) + 1.0)


def bm25_weight(tf: Column, doc_len: Column, avg_doc_len: Column, k1: float, b: float) -> Column:
    return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * doc_len / avg_doc_len))


def smooth_idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log((1.0 + n_docs) / (1.0 + doc_freq)) + 1.0


def discount(rank: Column) -> Column:
    return 1.0 / F.log2(rank + 1.0)


def ideal_dcg(n_relevant: Column, k: int) -> Column:
    """DCG of a ranking that starts with min(n_relevant, k) relevant items."""
    total, prefix = 0.0, [0.0]
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1.0)
        prefix.append(total)
    position = F.least(n_relevant, F.lit(k)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(value) for value in prefix]), position)
