"""Columns over numeric arrays and character histograms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if either is a null vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def letter_counts(text: Column, alphabet: Column) -> Column:
    """How often each character of the alphabet is in a text."""
    return F.transform(alphabet, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double"))


def shares(counts: Column) -> Column:
    """Counts by their sum; null if it is 0. counts should be a column, not an expression, as it is read more than once."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))
