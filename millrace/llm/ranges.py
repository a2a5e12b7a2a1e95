"""Splitters of sorted keys, and the range that a key falls into, as column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def range_of(splitters: list[tuple[int, ...]], *key: str) -> Column:
    """How many splitters are at or below the key (bigint columns, compared in order): a binary search."""
    if not splitters:
        return F.lit(0)
    columns = [F.lit(np.array([s[i] for s in splitters], np.int64)) for i in range(len(key))]
    steps = [1 << b for b in reversed(range(len(splitters).bit_length()))]

    def reaches(at: Column, i: int = 0) -> Column:
        own = F.element_at(columns[i], at)
        if i == len(key) - 1:
            return own <= F.col(key[i])
        return (own < F.col(key[i])) | ((own == F.col(key[i])) & reaches(at, i + 1))

    def step(low: Column, by: Column) -> Column:
        at = low + by
        return F.when((at <= len(splitters)) & reaches(F.least(at, F.lit(len(splitters)))), at).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)
