"""Values derived from the data themselves: repaired activity codes, ambiguous places, distribution ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.functions.registry import lookup

# The code that stands in for none, and the mark of the source for unusable ones.
PLACEHOLDER_CODE, NOT_FOUND_MARK = "9999", "NO LOCALIZADO"


def code_letters(codes: DataFrame) -> DataFrame:
    """The section letters with which each number occurs: ``digitos, letras``."""
    valid = codes.filter(F.col("ciiu_1").rlike(r"^[A-Z]\d{3,4}") & ~F.col("ciiu_1").contains(NOT_FOUND_MARK))
    return valid.groupBy(F.regexp_extract("ciiu_1", r"^[A-Z](\d{3,4})", 1).alias("digitos")).agg(F.collect_set(F.substring("ciiu_1", 1, 1)).alias("letras"))


def repaired_codes(rows: DataFrame) -> DataFrame:
    """ENR-4: ``ciiu_1, estado, reconstruido`` of every distinct code: a number gets a letter if it occurs with only one.

    The table of letters has one row per number of three or four digits, so it is bounded and broadcast; codes
    are judged once per distinct value.
    """
    codes = rows.select("ciiu_1").distinct()
    known = code_letters(codes)
    candidate = F.col("ciiu_1").isNotNull() & ~F.col("ciiu_1").rlike(r"^[A-Z]")
    clean = F.regexp_replace(F.translate("ciiu_1", ",.", ""), r"(?U)^\s+|\s+$", "")
    numeric = clean.rlike(r"^\d{3,4}$")
    bare = F.when(numeric, clean)
    stripped = F.coalesce(F.nullif(F.regexp_replace(bare, "^0+", ""), F.lit("")), F.when(bare.isNotNull(), F.lit("0")))
    raw = known.select(F.col("digitos").alias("_a"), F.col("letras").alias("_la"))
    short = known.select(F.col("digitos").alias("_b"), F.col("letras").alias("_lb"))
    with_keys = codes.select("ciiu_1", bare.alias("_a"), stripped.alias("_b"))
    joined = with_keys.join(F.broadcast(raw), "_a", "left").join(F.broadcast(short), "_b", "left")
    none = F.array().cast("array<string>")
    letters = F.array_union(F.coalesce("_la", none), F.coalesce("_lb", none))
    marked = F.col("ciiu_1").contains(NOT_FOUND_MARK)
    state = (
        F.when(~candidate, "no_aplica").when(marked, "invalido_marcado_por_fuente").when(F.col("_a").isNull(), "formato_no_reconocido")
        .when(F.col("_a") == PLACEHOLDER_CODE, "placeholder_9999_excluido").when(F.size(letters) == 0, "sin_evidencia_no_reconstruido")
        .when(F.size(letters) > 1, "ambiguo_no_reconstruido").otherwise("reconstruido_inequivoco")
    )
    return joined.select("ciiu_1", state.alias("estado"), F.when(state == "reconstruido_inequivoco", F.concat(letters[0], F.col("_a"))).alias("reconstruido"))


def ambiguous_places(rows: DataFrame, *by: str) -> DataFrame:
    """NRM-13, ENR-8: ``*by, nombre, codigos, ambiguo``: names that come with more than one code."""
    coded = rows.filter("codigo is not null and nombre is not null").groupBy(*by, "nombre").agg(F.count_distinct("codigo").alias("codigos"))
    return coded.withColumn("ambiguo", F.col("codigos") > 1)


# What the levels of trust mean.
TRUST_LEVELS = {
    "confirmado": "Dato tomado directamente de fuente oficial sin transformación que altere su significado.",
    "externo": "Dato de fuente externa de menor autoridad o certeza.",
    "inferido": "Dato calculado o deducido por el sistema.",
    "validado_manual": "Dato revisado y confirmado explícitamente por una persona del equipo.",
}
UNKNOWN_TRUST = "desconocido"


def trust_description(level: Column) -> Column:
    """ENR-3: what a level of trust means; null for unknown levels."""
    return lookup(level, TRUST_LEVELS)


def source_trust(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """ENR-3: ``source_id, nivel, filas``; rows are counted before the catalogue is joined."""
    levels = sources.select("source_id", F.col("nivel_confianza_fuente").alias("nivel")).dropDuplicates(["source_id"])
    return rows.groupBy("source_id").agg(F.count("*").alias("filas")).join(levels, "source_id", "left").na.fill(UNKNOWN_TRUST, ["nivel"])


def reference_rank(rows: DataFrame, value: str, is_reference: Column) -> DataFrame:
    """SCO-5: ``value, percentil``: the share of reference rows that are not above each value.

    Counted on the distinct values: a histogram by value, partial sums of ranges of it, and the running sum
    within each range, so that no task orders all values. Without reference rows every rank is null.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.sum(is_reference.cast("bigint")).alias("_n"))
    # values are spread over ranges by order of magnitude and leading digits: order-preserving, at most a few hundred ranges
    size = F.when(F.col(value) == 0, F.lit(0)).otherwise(F.signum(F.col(value)) * F.floor(F.log10(F.abs(F.col(value).cast("double")) + 1) * 20))
    ranged = counts.withColumn("_range", size.cast("int"))
    sums = ranged.groupBy("_range").agg(F.sum("_n").alias("_s"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    starts = sums.select("_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"), F.sum("_s").over(everything).alias("_all"))
    within = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(F.broadcast(starts), "_range")
    return placed.select(value, F.when(F.col("_all") > 0, (F.col("_before") + F.sum("_n").over(within)) / F.col("_all")).alias("percentil"))
