"""Writing results: nothing into the raw area, nothing over what is there."""

from __future__ import annotations

import posixpath
from pathlib import Path, PurePosixPath
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.operators.legal import APPROVED, check_enriched


def _place(path: str) -> tuple[str, PurePosixPath]:
    """File system and path of a path or URI; local ones without links and dots."""
    uri = urlsplit(path)
    if uri.scheme in ("", "file"):
        return "file", PurePosixPath(Path(unquote(uri.path) if uri.scheme else path).resolve().as_posix())
    return f"{uri.scheme}://{uri.netloc}", PurePosixPath(posixpath.normpath(unquote(uri.path) or "/"))


def outside(target: str, raw: str) -> str:
    """SNK-2: the target, if it does not lie in the raw area; else PermissionError."""
    (system, there), (raw_system, area) = _place(target), _place(raw)
    if system == raw_system and (there == area or area in there.parents):
        raise PermissionError(f"{target} lies in the raw area {raw}")
    return target


def write_parquet(df: DataFrame, target: str, raw: str) -> None:
    """SNK-1: a new Parquet table."""
    df.write.mode("errorifexists").parquet(outside(target, raw))


def write_list(df: DataFrame, target: str, raw: str, columns: list[str], position: str) -> None:
    """SNK-4: a bounded ranked list as one CSV with exactly these columns, by position; unique positions from 1.

    The checks are one aggregate; the rows of a top list are few by definition, so one file holds them.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    n, unique, low, high = df.agg(F.count("*"), F.count_distinct(position), F.min(position), F.max(position)).first()
    if n and (unique != n or low != 1 or high != n):
        raise ValueError("positions must be 1 to the number of rows")
    df.select(*columns).orderBy(position).coalesce(1).write.mode("errorifexists").option("header", True).csv(outside(target, raw))


def write_enriched(rows: DataFrame, target: str, raw: str, n: int) -> None:
    """SNK-5: the enriched list of n rows as one CSV, by position; checked before anything is written."""
    checked = check_enriched(rows, n)
    write_list(checked, target, raw, APPROVED, "posicion_diversificada")


def write_table(rows: DataFrame, target: str, raw: str, order: str) -> None:
    """SNK-3, ING-15, ING-16: a small report (a row for each source) as one CSV with a header."""
    rows.orderBy(order).coalesce(1).write.mode("errorifexists").option("header", True).csv(outside(target, raw))
