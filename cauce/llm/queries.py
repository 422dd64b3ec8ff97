"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm import addresses, chunks, leaks, linkage, mixture, names, places, survivors, variety
from cauce.llm.oracle import P1_FOUND, P1_SURVIVORS
from cauce.plans.registry import Registry
from cauce.session import cut
from cauce.sources.tables import table

R = Registry()


@R.query("p5_found")
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return places.mapped(table(spark, folder, "empresas_normalizado"), table(spark, folder, "municipios_referencia"))


@R.query("p5_misses")
def p5_misses(spark: SparkSession, folder: str) -> DataFrame:
    return places.misses(table(spark, folder, "empresas_normalizado"), table(spark, folder, "municipios_referencia"))


@R.query("p4_found")
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return addresses.same_place_pairs(table(spark, folder, "empresas_normalizado"), table(spark, folder, "municipios_referencia"))


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    return addresses.classed(table(spark, folder, "empresas_normalizado"), table(spark, folder, "municipios_referencia"))


@R.query("p4_classes")
def p4_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per address row: its place class, its municipality and how many rows are of that class."""
    return addresses.members(cut(_placed(spark, folder)))


@R.query("p4_links")
def p4_links(spark: SparkSession, folder: str) -> DataFrame:
    """The classes of unknown municipality, with those they may be the same as."""
    return addresses.class_links(cut(_placed(spark, folder)))


@R.query("p3_found")
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.variant_pairs(table(spark, folder, "empresas_normalizado"))


@R.query("p3_classes")
def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per spelling: the canonical form it is attached to and its rows."""
    return names.classed(table(spark, folder, "empresas_normalizado")).groupBy("clase", "core").agg(F.count("*").alias("filas"))


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.matched(table(spark, folder, "empresas_con_exclusion"), table(spark, folder, "claves_internas"), table(spark, folder, "municipios_referencia"))


@R.query("p2_found")
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _linked(spark, folder).filter(F.col("confianza") >= linkage.ACCEPT).select("entidad_dedup_id", "internal_order")


@R.query("p2_confidence")
def p2_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted pair with its confidence."""
    return _linked(spark, folder).filter(F.col("confianza") >= linkage.ACCEPT).select("entidad_dedup_id", "internal_order", F.round("confianza", 6).alias("confianza"))


@R.query("p2_calibration")
def p2_calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Confidences by tenths, against identifiers left out of the fit."""
    return linkage.calibration(table(spark, folder, "empresas_con_exclusion"), table(spark, folder, "claves_internas"), table(spark, folder, "municipios_referencia"))


def _grouped(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, folder, "empresas_normalizado"), table(spark, folder, "grupos_deduplicacion"), table(spark, folder, "fuentes")


@R.query("p1_found", P1_FOUND)
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return survivors.guides(*_grouped(spark, folder))


@R.query("p1_survivors", P1_SURVIVORS)
def p1_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return survivors.survivors(*_grouped(spark, folder))


def _leaked(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


@R.query("p8_found")
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaked(spark, folder).select("doc_id", "item_id")


@R.query("p8_report")
def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Leaked items with their number of documents, the longest run and the best copy of the passage."""
    return _leaked(spark, folder).groupBy("item_id").agg(F.count("*").alias("documentos"), F.max("racha").alias("racha"), F.min("cambios").alias("cambios"))


@R.query("p9_mix")
def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mixed(table(spark, folder, "documents"), table(spark, folder, "mezcla_objetivo"))


@R.query("p9_shares")
def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.shares_reached(table(spark, folder, "documents"), table(spark, folder, "mezcla_objetivo"))


@R.query("p10_pieces")
def p10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.split(table(spark, folder, "documents"))


@R.query("p6_subset")
def p6_subset(spark: SparkSession, folder: str) -> DataFrame:
    return variety.subset(table(spark, folder, "empresas_scored"), table(spark, folder, "municipios_referencia"))


@R.query("p6_coverage")
def p6_coverage(spark: SparkSession, folder: str) -> DataFrame:
    rows, reference = table(spark, folder, "empresas_scored"), table(spark, folder, "municipios_referencia")
    return variety.coverage(variety.subset(rows, reference), rows, reference)


@R.query("p6_contrast")
def p6_contrast(spark: SparkSession, folder: str) -> DataFrame:
    """The subset against a random one and one without clusters."""
    return variety.contrast(table(spark, folder, "empresas_scored"), table(spark, folder, "municipios_referencia"))
