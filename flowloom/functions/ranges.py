"""Ranges of a number: which of many sorted cuts a value lies beyond, as an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(value: Column, cuts: list) -> Column:
    """The number of cuts below value (NULL: NULL), found in two steps of about sqrt(n) comparisons."""
    if not cuts:
        return F.when(value.isNotNull(), F.lit(0)).cast("int")
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    numbers = lambda xs: F.array(*[F.lit(x) for x in xs])
    coarse = F.size(F.filter(numbers([g[-1] for g in groups]), lambda c: c < value))
    padded = [[*g, *[g[-1]] * (width - len(g))] for g in groups]
    fine = F.coalesce(F.size(F.filter(F.get(F.array(*[numbers(g) for g in padded]), coarse), lambda c: c < value)), F.lit(0))
    inside = F.when(coarse < len(groups), F.greatest(fine, F.lit(0))).otherwise(F.lit(0))
    return F.when(value.isNotNull(), F.least(coarse * width + inside, F.lit(len(cuts)))).cast("int")
