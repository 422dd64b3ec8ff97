"""Similarity of names by longest common subsequence, in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cauce.functions.text import token_sort


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 and more characters of ``a`` at a time (bit-parallel)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        m = masks.get(c, 0)
        row = ((row + (row & m)) | (row & ~m)) & full
    return len(a) - row.bit_count()


def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b, strict=True):
        if x is None or y is None:
            out.append(None)
        else:
            out.append(100.0 if not x and not y else 200.0 * common_subsequence(x, y) / (len(x) + len(y)))
    return pd.Series(out, dtype="float64")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """DED-9: 200 * LCS / (length + length) of the word-sorted texts; null if either is null."""
    # made here: the module is also imported by workers, which have no session
    return F.pandas_udf(_ratio, "double")(token_sort(a), token_sort(b))


def may_reach(a: Column, b: Column, threshold: float) -> Column:
    """Whether the lengths allow the ratio at all; keeps pairs out of Python."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= threshold * (F.length(a) + F.length(b))
