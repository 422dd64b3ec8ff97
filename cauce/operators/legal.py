"""Prospects against the records of a legal registry, given as a table of answers (no network).

``responses`` has one row for each record of an answer: ``nit_consultado`` (the id asked for, without check digit),
``ok`` (whether the registry answered), ``orden`` (place of the record in the answer; null in an answer without
records) and the record's ``nit, digito_verificacion, razon_social, representante_legal, estado_matricula, matricula,
camara_comercio, organizacion_juridica``. Answers are summed up by id before they meet the prospects, so an id with
any number of records is one row.

Defined results: an id that cannot be asked for is NO_CONSULTABLE whatever the table says, one without any row in it
is an error of the query, as is an answer that is not ok. Repeated prospects come out each; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.registry import askable_id, comparable_name

# States of a registration that are in force, and those that are history.
IN_FORCE = ["ACTIVA", "MATRÍCULA NUEVA, CONSTITUCIÓN POR TRASLADO"]
HISTORIC = ["CANCELADA", "MATRÍCULA CANCELADA POR TRASLADO DE DOMICILIO"]
# Outcomes, the columns that are approved, the one that never is, and texts of the representative.
OUTCOMES = ["MATCH_CONFIRMADO", "MATCH_CON_OBSERVACION", "NO_MATCH", "NO_CONSULTABLE", "ERROR_CONSULTA", "MATCH_RESUELTO_HISTORICO"]
APPROVED = [
    "entidad_dedup_id", "posicion_diversificada", "nit", "nit_confecamaras", "digito_verificacion", "razon_social_confecamaras", "representante_legal", "estado_matricula", "matricula", "camara_comercio", "resultado_match", "nit_consultado",
]
FORBIDDEN = "num_identificacion_representante_legal"
NATURAL, NOT_APPLICABLE, NOT_REPORTED = "PERSONA NATURAL", "no aplica", "no informado por la fuente"
# Seconds for which an outcome is kept; null for ever, others not at all.
KEPT = {"MATCH_CONFIRMADO": 7 * 24 * 3600, "MATCH_CON_OBSERVACION": 7 * 24 * 3600, "NO_MATCH": 72 * 3600, "NO_CONSULTABLE": None}
RECORD = ["nit", "digito_verificacion", "razon_social", "representante_legal", "estado_matricula", "matricula", "camara_comercio", "organizacion_juridica"]
REQUIRED = ["entidad_dedup_id", "posicion_diversificada", "nit", "razon_social"]


def answers(responses: DataFrame) -> DataFrame:
    """LEG-5: one row for each id asked for: ``ok``, number of records, ``resuelto`` and the record that counts.

    Of several records the one in force counts if it is the only one and all others are history; else none does.
    """
    state, record = F.col("estado_matricula"), F.struct(*RECORD)
    there = F.col("orden").isNotNull()
    counted = responses.groupBy("nit_consultado").agg(
        F.min("ok").alias("ok"), F.count("orden").alias("n"), F.count_if(there & F.coalesce(state.isin(*IN_FORCE), F.lit(False))).alias("_now"), F.count_if(there & F.coalesce(state.isin(*HISTORIC), F.lit(False))).alias("_then"),
        F.min_by(record, "orden").alias("_first"), F.min_by(record, F.when(state.isin(*IN_FORCE), F.col("orden"))).alias("_force"),
    )
    solved = (F.col("n") > 1) & (F.col("_now") == 1) & (F.col("_then") == F.col("n") - 1)
    return counted.select("nit_consultado", "ok", "n", solved.alias("resuelto"), F.when(F.col("n") == 1, F.col("_first")).when(solved, F.col("_force")).alias("registro"))


def outcome(askable: Column, digit: Column, own: Column, other: Column) -> Column:
    """LEG-6: the outcome for a prospect joined with ``answers``, in fixed order of precedence; names as ``comparable_name``."""
    alike = F.coalesce((own == other) | F.contains(own, other) | F.contains(other, own), F.lit(False))
    sure = alike & F.col("registro.digito_verificacion").eqNullSafe(digit)
    return (
        F.when(~askable, "NO_CONSULTABLE").when(~F.coalesce(F.col("ok"), F.lit(False)), "ERROR_CONSULTA").when(F.col("n") == 0, "NO_MATCH")
        .when((F.col("n") > 1) & F.col("resuelto"), "MATCH_RESUELTO_HISTORICO").when(F.col("n") > 1, "ERROR_CONSULTA").when(sure, "MATCH_CONFIRMADO").otherwise("MATCH_CON_OBSERVACION")
    )


def enriched(prospects: DataFrame, responses: DataFrame) -> DataFrame:
    """LEG-7, LEG-8: one row for each prospect, in the columns ``APPROVED`` and no others."""
    asked = prospects.select(*REQUIRED, askable_id(F.col("nit")).alias("_q")).withColumn("nit_consultado", F.when(F.col("_q.consultable"), F.col("_q.base")))
    met = asked.join(answers(responses), "nit_consultado", "left")
    # names are made comparable once each, not once for every comparison
    named = met.withColumns({"_own": comparable_name(F.col("razon_social")), "_other": comparable_name(F.col("registro.razon_social"))})
    judged = named.withColumn("resultado_match", outcome(F.col("_q.consultable"), F.col("_q.digito"), F.col("_own"), F.col("_other")))
    of = F.when(F.col("resultado_match").isin("MATCH_CONFIRMADO", "MATCH_CON_OBSERVACION", "MATCH_RESUELTO_HISTORICO"), F.col("registro"))
    person = F.when(of.isNotNull(), F.when(of["organizacion_juridica"].eqNullSafe(NATURAL), NOT_APPLICABLE).when(F.trim(F.coalesce(of["representante_legal"], F.lit(""))) == "", NOT_REPORTED).otherwise(of["representante_legal"]))
    return judged.select(
        "entidad_dedup_id", "posicion_diversificada", "nit", of["nit"].alias("nit_confecamaras"), of["digito_verificacion"].alias("digito_verificacion"), of["razon_social"].alias("razon_social_confecamaras"), person.alias("representante_legal"),
        of["estado_matricula"].alias("estado_matricula"), of["matricula"].alias("matricula"), of["camara_comercio"].alias("camara_comercio"), "resultado_match", "nit_consultado",
    )


def outcome_counts(rows: DataFrame) -> DataFrame:
    """LEG-14: prospects by outcome."""
    return rows.groupBy("resultado_match").agg(F.count("*").alias("filas"))


def kept_until(result: Column, since: Column) -> Column:
    """LEG-11: the second until which an answer is kept; null for outcomes kept for ever and for those never kept."""
    seconds = F.create_map(*[x for k, v in KEPT.items() if v is not None for x in (F.lit(k), F.lit(v))])
    return since + F.element_at(seconds, result)


def to_ask(prospects: DataFrame, cache: DataFrame, now: int) -> DataFrame:
    """LEG-8, LEG-11: the ids to ask the registry for: askable, once each, without a kept answer (``nit_consultado, resultado_match, guardado_en``)."""
    ids = prospects.select(askable_id(F.col("nit")).alias("q")).filter("q.consultable").select(F.col("q.base").alias("nit_consultado")).distinct()
    until = kept_until(F.col("resultado_match"), F.col("guardado_en"))
    valid = cache.filter(F.col("resultado_match").isin(*KEPT) & (until.isNull() | (until >= now))).select("nit_consultado")
    return ids.join(valid, "nit_consultado", "left_anti")


class EnrichmentError(ValueError):
    """Rows that break a rule of the enriched list; nothing has been written."""


def check_enriched(rows: DataFrame, n: int) -> DataFrame:
    """LEG-13: ``rows``, if they are n, with exactly the approved columns, unique ids, whole positions within 1 to n, and known outcomes."""
    if FORBIDDEN in rows.columns:
        raise EnrichmentError(f"{FORBIDDEN} is never approved")
    if sorted(rows.columns) != sorted(APPROVED):
        raise EnrichmentError(f"columns differ: {sorted(set(rows.columns) ^ set(APPROVED))}")
    if dict(rows.dtypes)["posicion_diversificada"] not in ("int", "bigint", "smallint", "tinyint"):
        raise EnrichmentError("positions are not whole numbers")
    position = F.col("posicion_diversificada")
    r = rows.agg(
        F.count("*").alias("n"), F.count_distinct("entidad_dedup_id").alias("ids"), F.count_distinct(position).alias("p"), F.count_if(~F.coalesce(position.between(1, n), F.lit(False))).alias("out"),
        F.count_if(~F.coalesce(F.col("resultado_match").isin(*OUTCOMES), F.lit(False))).alias("odd"),
    ).first()
    if r.n != n or r.ids != n or r.p != n or r.out or r.odd:
        raise EnrichmentError(f"{r.n} rows, {r.ids} ids and {r.p} positions where {n} are expected; {r.out} positions and {r.odd} outcomes out of range")
    return rows


def read_prospects(spark, path: str) -> DataFrame:
    """LEG-15: the needed columns of a list in CSV, ids as text; ValueError where one is missing."""
    rows = spark.read.option("header", True).csv(path)
    missing = [c for c in REQUIRED if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return rows.select("entidad_dedup_id", F.col("posicion_diversificada").cast("int").alias("posicion_diversificada"), "nit", "razon_social")
