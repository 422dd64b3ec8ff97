"""A register that is appended to: closed vocabularies, running numbers, blank records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_vocabulary(field: str, vocabularies: dict[str, list[str]]) -> Column:
    """INT-2: whether a field's value is in its vocabulary; fields without one take any value."""
    return F.coalesce(F.col(field).isin(*vocabularies[field]), F.lit(False)) if field in vocabularies else F.lit(True)


def vocabulary_errors(rows: DataFrame, vocabularies: dict[str, list[str]]) -> DataFrame:
    """INT-1: ``rows`` with ``errores``: one text for each field whose value is not in its vocabulary; blanks are skipped."""
    one = lambda f: F.when((F.coalesce(F.col(f), F.lit("")) != "") & ~in_vocabulary(f, vocabularies), F.format_string(f + ": '%s' no es válido", F.col(f)))
    return rows.withColumn("errores", F.array_compact(F.array(*[one(f) for f in vocabularies if f in rows.columns]).cast("array<string>")))


def next_numbers(existing: DataFrame, entity: str, number: str) -> DataFrame:
    """INT-3: for each entity the number that follows its greatest; entities without any start at 1 (see ``appended``)."""
    return existing.groupBy(entity).agg((F.coalesce(F.max(F.col(number).try_cast("bigint")), F.lit(0)) + 1).alias("siguiente"))


def appended(existing: DataFrame, new: DataFrame, entity: str, number: str, *order: str) -> DataFrame:
    """INT-3: ``new`` with running numbers that go on from ``existing``, in ``order`` within an entity."""
    start = next_numbers(existing, entity, number)
    within = F.row_number().over(Window.partitionBy(entity).orderBy(*order))
    return new.join(start, entity, "left").withColumn(number, F.coalesce("siguiente", F.lit(1)) + within - 1).drop("siguiente")


def blank_records(rows: DataFrame, inherited: list[str], fields: list[str], entity: str, number: str, existing: DataFrame | None = None) -> DataFrame:
    """INT-4: a record to fill in for each row: inherited columns, the next number and empty texts."""
    base = rows.select(*inherited)
    start = next_numbers(existing, entity, number) if existing is not None else None
    numbered = base.withColumn(number, F.lit(1).cast("bigint")) if start is None else base.join(start, entity, "left").withColumn(number, F.coalesce("siguiente", F.lit(1))).drop("siguiente")
    return numbered.select("*", *[F.lit("").alias(f) for f in fields if f not in inherited and f != number])
