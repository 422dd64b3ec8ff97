"""Phases from the command line: ``python -m cauce PHASE --datos FOLDER``. No phase starts another one.

Every phase reads Parquet tables of the data folder and writes one there; nothing is written over what exists.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.config import load
from cauce.operators import dedup, exclude, normalise, rank, reports, scoring
from cauce.session import ship
from cauce.sources import files, sinks
from cauce.sources.tables import table


def _write(df: DataFrame, a: argparse.Namespace, name: str) -> None:
    sinks.write_parquet(df, f"{a.datos}/{name}.parquet", a.crudos)
    print(f"{name}: {df.sparkSession.read.parquet(f'{a.datos}/{name}.parquet').count()}")


def catalogue(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = table(spark, a.datos, "fuentes")
    rows = rows if "duplicado_de" in rows.columns else rows.withColumn("duplicado_de", F.lit(None).cast("string"))
    files.listed(rows, a.categoria, not a.incluir_duplicados).select("source_id", "archivo", "formato", "categoria").show(1000, False)


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    results = files.ingest_catalogue(spark, files.ingest(spark, load(a.config)["fuentes"], a.datos, a.limite))
    files.ingest_summary(results).show(1, False)
    sinks.write_table(results, f"{a.datos}/fuentes_registradas", a.crudos, "source_id")


def normalize(spark: SparkSession, a: argparse.Namespace) -> None:
    config = load(a.config)
    made = []
    for s in config["fuentes"]:
        if not (s.get("categoria") or "").startswith(normalise.INTERNAL):
            raw = table(spark, a.datos, f"{s['source_id']}__ingestado").withColumn("fuente_archivo", F.lit(s.get("archivo", s["source_id"])))
            made.append(normalise.canonical(raw, config["sinonimos"], dedup.FIELDS, "source_id", "hoja_origen", "fila_origen", "fuente_archivo"))
    _write(normalise.derived(normalise.union_sources(made)).withColumn("row_order", F.monotonically_increasing_id()), a, "empresas_normalizado")


def deduplicate(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = table(spark, a.datos, "empresas_normalizado")
    groups = dedup.entities(dedup.keyed(rows, table(spark, a.datos, "fuentes")))
    _write(groups, a, "grupos_deduplicacion")
    _write(dedup.masters(rows.join(table(spark, a.datos, "grupos_deduplicacion").drop("tamano_grupo"), "row_order")), a, "empresas_deduplicado")


def exclude_internal(spark: SparkSession, a: argparse.Namespace) -> None:
    states, matches = exclude.cascade(table(spark, a.datos, "empresas_deduplicado"), exclude.internal_keys(table(spark, a.datos, "claves_internas")), table(spark, a.datos, "fuentes"), a.camara)
    _write(table(spark, a.datos, "empresas_deduplicado").join(states, "entidad_dedup_id"), a, "empresas_con_exclusion")
    _write(matches, a, "coincidencias")


def enrich(spark: SparkSession, a: argparse.Namespace) -> None:
    entities = table(spark, a.datos, "empresas_con_exclusion")
    _write(scoring.prepared(entities, entities.select("entidad_dedup_id", "tamano_empresa")), a, "empresas_preparado")


def score(spark: SparkSession, a: argparse.Namespace) -> None:
    weights = scoring.Weights(**load(a.config)["pesos"]) if a.config else scoring.Weights()
    scored = scoring.scored(table(spark, a.datos, "empresas_preparado"), weights)
    _write(scored, a, "empresas_scored")
    scoring.score_stats(table(spark, a.datos, "empresas_scored")).show(20, False)


def diversify(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = table(spark, a.datos, "empresas_scored")
    rank.universe(rows).show(1, False)
    sinks.write_list(reports.check_list(reports.top_export(rows, a.n), a.n), f"{a.datos}/top_{a.n}", a.crudos, reports.EXPORTED, "posicion_diversificada")


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    wanted = reports.Filters(a.ciudad, a.departamento, a.sector, a.actividad_economica, a.tamano, True if a.contacto_disponible else None, a.score_minimo, a.prioridad)
    reports.filtered_top(table(spark, a.datos, "empresas_scored"), wanted, a.top).select("entidad_dedup_id", "razon_social", "sector_vertical", "score_prioridad_comercial").show(a.top, False)


PHASES: dict[str, tuple[Callable, list[tuple[str, dict]]]] = {
    "catalogo": (catalogue, [("--categoria", {}), ("--incluir-duplicados", {"action": "store_true"})]),
    "ingesta": (ingest, [("--config", {"required": True}), ("--limite", {"type": int})]),
    "normalizar": (normalize, [("--config", {"required": True})]),
    "deduplicar": (deduplicate, []),
    "excluir": (exclude_internal, [("--camara", {"required": True})]),
    "enriquecer": (enrich, []),
    "scorear": (score, [("--config", {})]),
    "diversificar": (diversify, [("--n", {"type": int, "required": True})]),
    "reportar": (
        report,
        [("--top", {"type": int, "default": 25, "choices": [10, 25, 50, 100]}), ("--ciudad", {}), ("--departamento", {}), ("--sector", {}), ("--actividad-economica", {}), ("--tamano", {}), ("--contacto-disponible", {"action": "store_true"}), ("--score-minimo", {"type": float}), ("--prioridad", {"choices": ["Alta", "Media", "Baja"]})],
    ),
}


def parser() -> argparse.ArgumentParser:
    """CLI-1."""
    top = argparse.ArgumentParser(prog="cauce")
    sub = top.add_subparsers(dest="fase", required=True)
    for name, (_, options) in PHASES.items():
        p = sub.add_parser(name)
        p.add_argument("--datos", required=True)
        p.add_argument("--crudos", default="raw")
        for flag, how in options:
            p.add_argument(flag, **how)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("cauce").getOrCreate()
    ship(spark)
    PHASES[a.fase][0](spark, a)


if __name__ == "__main__":
    main()
