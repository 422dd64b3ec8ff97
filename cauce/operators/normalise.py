"""From heterogeneous sources to one canonical table."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.text import blank, comparison_text, light_clean, place_parts
from cauce.operators.parse_rows import CANONICAL as HEADERS


def column_name(name: str) -> str:
    """NRM-9: a header without accents, in upper case, white space collapsed."""
    text = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", text.upper().strip())


def inverted(synonyms: dict[str, list[str]]) -> dict[str, str]:
    """NRM-10: header to canonical field; ValueError where one header means two fields."""
    out: dict[str, str] = {}
    for field, names in synonyms.items():
        for name in names:
            key = column_name(name)
            if out.setdefault(key, field) != field:
                raise ValueError(f"{name!r} stands for {out[key]} and {field}")
    return out


def mapped_columns(columns: list[str], synonyms: dict[str, list[str]]) -> dict[str, str | None]:
    """NRM-11: each column of a source with its canonical field or None."""
    known = inverted(synonyms)
    return {c: known.get(column_name(c)) for c in columns}


def first_filled(*columns: Column) -> Column:
    """NRM-12: the first value that is not blank."""
    return F.coalesce(*[F.when(~blank(c), c) for c in columns])


def canonical(source: DataFrame, synonyms: dict[str, list[str]], fields: list[str], *keep: str) -> DataFrame:
    """NRM-12: a source in canonical fields (strings); several columns of one field give the first filled value, absent ones null.

    Columns of the source that are neither kept nor mapped are dropped, also ones named like a canonical field
    of other meaning: only the synonyms decide.
    """
    by_field: dict[str, list[str]] = {}
    for column, field in mapped_columns(source.columns, synonyms).items():
        if field:
            by_field.setdefault(field, []).append(column)
    quoted = lambda c: F.col(f"`{c}`").cast("string")
    return source.select(*keep, *[(light_clean(first_filled(*[quoted(c) for c in by_field[f]])) if f in by_field else F.lit(None).cast("string")).alias(f) for f in fields])


# Fixed value: how categories of internal sources begin.
INTERNAL = "interno"


def external(catalogue: DataFrame) -> DataFrame:
    """NRM-15: the sources that are normalised; internal ones are left out."""
    return catalogue.filter(~F.coalesce(F.col("categoria").startswith(INTERNAL), F.lit(False)))


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """NRM-15: all rows of all sources by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def derived(rows: DataFrame) -> DataFrame:
    """NRM-2, NRM-8, NRM-14: normalised name, place code and name, and whether a row names nobody."""
    place = place_parts(F.col("municipio_comercial"))
    return rows.withColumns(
        {
            "razon_social_normalizada": comparison_text(F.col("razon_social")), "municipio_codigo_dane_extraido": place["codigo"], "municipio_nombre_normalizado": place["nombre"],
            "sin_identificador": blank(F.col("nit")) & blank(F.col("razon_social")),
        }
    )


def quality(rows: DataFrame, fields: list[str]) -> DataFrame:
    """NRM-16: by source: rows, rows that name nobody, rows with a coded place, and filled values of each field."""
    filled = [F.count(f).alias(f"con_{f}") for f in fields]
    return rows.groupBy("source_id").agg(
        F.count("*").alias("filas"), F.count_if(blank(F.col("nit")) & blank(F.col("razon_social"))).alias("sin_identificador"), F.count_if(F.col("municipio_codigo_dane_extraido").isNotNull()).alias("con_codigo"), *filled
    )


def header_report(header: list[str], synonyms: dict[str, list[str]] = HEADERS) -> tuple[int, int, str, str]:
    """NRM-16: columns of a source, those mapped, the names of the others, and fields that several columns mean (``campo<-a,b``)."""
    mapped = mapped_columns(header, synonyms)
    by_field: dict[str, list[str]] = {}
    for column, name in mapped.items():
        if name:
            by_field.setdefault(name, []).append(column)
    return len(header), sum(v is not None for v in mapped.values()), "; ".join(sorted(c for c, v in mapped.items() if v is None)), "; ".join(f"{k}<-{','.join(v)}" for k, v in by_field.items() if len(v) > 1)


def source_report(rows: DataFrame, catalogue: DataFrame, synonyms: dict[str, list[str]] = HEADERS) -> DataFrame:
    """NRM-16, SNK-3: the 11 columns of the quality report, a row for each source of the catalogue (a small table, read by the driver)."""
    described = [
        (r.source_id, r.archivo, r.categoria, *header_report([h.strip() for h in (r.encabezado or "").split((r.delimitador or ",").replace("\\t", "\t"))], synonyms))
        for r in catalogue.select("source_id", "archivo", "categoria", "encabezado", "delimitador").collect()
    ]
    named = rows.sparkSession.createDataFrame(described, "source_id string, archivo string, categoria string, columnas_originales bigint, columnas_mapeadas bigint, columnas_sin_mapear string, colisiones string")
    counts = rows.groupBy("source_id").agg(F.count("*").alias("registros"), F.count_if("sin_identificador").alias("registros_sin_identificador"), F.count_if("flag_codigo_dane_ambiguo").alias("registros_dane_ambiguo"))
    out = named.join(counts, "source_id", "left").na.fill(0, ["registros", "registros_sin_identificador", "registros_dane_ambiguo"])
    share = F.when(F.col("registros") > 0, 100.0 * F.col("registros_sin_identificador") / F.col("registros")).otherwise(0.0)
    return out.select(
        "source_id", "archivo", "categoria", "registros", "columnas_originales", "columnas_mapeadas", "columnas_sin_mapear", "colisiones", "registros_sin_identificador", F.format_string("%.1f", share).alias("pct_sin_identificador"), "registros_dane_ambiguo"
    )
