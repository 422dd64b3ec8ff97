"""Invented entities for demonstrations, the same for one seed however they are partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions.registry import EXACT_CODES, SECTIONS
from cauce.operators.exclude import NO_MATCH

NAMES = ["ALBORADA", "BRISAS", "CAMPANA", "DELTA", "ESPIGA", "FARO", "GUADUAL", "HORIZONTE", "ISLA", "JARDIN", "KIOSCO", "LUCERO"]
KINDS = ["Tienda", "Taller", "Restaurante", "Droguería", "Ferretería", "Colegio"]
PLACES = ["ALMIRA", "BRESAL", "CORVAL", "DRUNELA", "IZARCO"]
SIZES = ["MICRO EMPRESA", "PEQUEÑA EMPRESA", "MEDIANA EMPRESA", "GRAN EMPRESA"]
STATES = [NO_MATCH] * 17 + ["CANDIDATO_AMBIGUO", "EXCLUSION_MEDIA", "EXCLUSION_ALTA"]


def _draw(seed: int, what: str) -> Column:
    """A number from 0 up to 2**31, from the row's id alone."""
    return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(what)), F.lit(1 << 31))


def _pick(seed: int, what: str, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (_draw(seed, what) % len(values)).cast("int"))


def _often(seed: int, what: str, share: float, value: Column) -> Column:
    return F.when(_draw(seed, what) < int(share * (1 << 31)), value)


def entities(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    """GEN-1: n entities with what the score needs; sectors, places and contact data by chance."""
    codes = [f"{s}{1000 + 7 * k}" for k, s in enumerate(SECTIONS)] + list(EXACT_CODES)
    digits = lambda what, length: F.lpad((_draw(seed, what) % 10**length).cast("string"), length, "0")
    return spark.range(1, n + 1).select(
        F.format_string("ENT-%07d", "id").alias("entidad_dedup_id"), F.concat(F.lit("9"), digits("nit", 8)).alias("nit"), F.concat_ws(" ", _pick(seed, "k", KINDS), _pick(seed, "n", NAMES), _pick(seed, "m", NAMES)).alias("razon_social"),
        _often(seed, "c?", 0.92, _pick(seed, "c", codes)).alias("ciiu_1"), _pick(seed, "p", PLACES).alias("municipio_comercial"), _often(seed, "t?", 0.8, _pick(seed, "t", SIZES)).alias("tamano_empresa"),
        _often(seed, "e?", 0.6, (_draw(seed, "e") % 240 + 1).cast("string")).alias("num_empleados"), _often(seed, "y?", 0.85, (2016 + _draw(seed, "y") % 11).cast("string")).alias("ultimo_ano_renovado"),
        _often(seed, "f?", 0.7, F.concat(F.lit("3"), digits("f", 9))).alias("telefono_comercial_1"), F.lit(None).cast("string").alias("telefono_comercial_2"), F.lit(None).cast("string").alias("telefono_comercial_3"),
        _often(seed, "m?", 0.55, F.concat(F.lit("info"), digits("mail", 5), F.lit("@ejemplo.test"))).alias("email_comercial"), F.concat(F.lit("CL "), (_draw(seed, "a") % 90 + 1).cast("string"), F.lit(" # 1-"), (_draw(seed, "b") % 90).cast("string")).alias("direccion_comercial"),
        F.lit(None).cast("string").alias("representante_legal"), _pick(seed, "s", STATES).alias("estado_exclusion"), _often(seed, "d?", 0.3, F.lit("alta")).alias("confianza_deduplicacion"), F.lit("").alias("campos_en_conflicto"),
    )
