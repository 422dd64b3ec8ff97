"""A score of several weighted dimensions that may be missing, and the data set it is computed on.

Weights and scales are a parameter; a missing dimension leaves both sums of the weighted mean, and the share of
dimensions that are there lowers the result. Ranks of numbers are taken against a reference population, on distinct
values only. Everything is expressions and equi-joins; no window holds more than the distinct values of a range.

Defined results: rows outside the scored states have null in every column of the score, empty tables stay empty,
null and unreadable values are missing, repeated rows are scored each by itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.registry import activity, contact_channels, lookup, plausible_employees, renewal_year, size_class
from cauce.functions.text import light_clean, place_parts
from cauce.operators.dedup import completeness
from cauce.operators.enrich import ambiguous_places, reference_rank

# How sectors fit, by sector and by the label of the activity's section; sizes; contact; coverage.
STRATEGIC = {"Gastronomía y Hotelería": 1.0, "Ferretería y construcción menor": 0.92, "Salud": 0.92, "Salud / Farmacias": 0.92, "Educación": 0.92}
GENERIC = {"alto": 0.85, "medio": 0.60, "bajo": 0.35, "no_aplica": 0.10}
SIZES = {"micro": 0.25, "pequeña": 0.50, "mediana": 0.75, "grande": 1.00}
CONTACT = [0.0, 0.6, 1.0]
COVERAGE_BASE, COVERAGE_RANGE, DIMENSIONS = 0.70, 0.30, 3
# States that are scored, and the one that numbers are ranked against.
SCORED, REFERENCE = ["SIN_COINCIDENCIA", "CANDIDATO_AMBIGUO"], "SIN_COINCIDENCIA"
# A code where a size should be.
CODE_FOR_SIZE = r"^[A-Z]\d{3,4}$"
SCORES = [
    "score_fit", "score_escala", "score_escala_senal_tamano", "score_escala_senal_vigencia", "score_contactabilidad", "score_base", "factor_cobertura", "dimensiones_con_dato", "score_prioridad_comercial", "nivel_confianza_score",
]


@dataclass(frozen=True)
class Weights:
    """SCO-1, SCO-12: the configuration of a score; it must be declared valid and its weights sum to one."""

    fit: float = 0.40
    scale: float = 0.35
    contact: float = 0.25
    defined: bool = False
    strategic: dict[str, float] = field(default_factory=lambda: dict(STRATEGIC))
    generic: dict[str, float] = field(default_factory=lambda: dict(GENERIC))
    sizes: dict[str, float] = field(default_factory=lambda: dict(SIZES))
    contacts: tuple[float, float, float] = tuple(CONTACT)

    @property
    def usable(self) -> bool:
        return self.defined and abs(self.fit + self.scale + self.contact - 1.0) < 1e-9


def _number(c: Column, table: dict[str, float]) -> Column:
    return lookup(c, {k: str(v) for k, v in table.items()}).cast("double")


def numeric(c: Column) -> Column:
    """A text that is a plain number, as one."""
    text = F.trim(c)
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"), text.try_cast("double"))


def fit_score(sector: Column, label: Column, weights: Weights) -> Column:
    """SCO-2: by strategic sector, else by the fit of the section."""
    return F.coalesce(_number(sector, weights.strategic), _number(label, weights.generic))


def mean_of(*values: Column) -> Column:
    """SCO-6: the mean of the values that are there."""
    count = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    return F.when(count > 0, sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0)) / count)


def confidence_level(confidence: Column, conflicts: Column, ambiguous: Column) -> Column:
    """SCO-9: high for entities merged on sure keys, else medium; one defect lowers it a step, two to the lowest."""
    high = confidence.eqNullSafe("alta")
    defects = (F.coalesce(conflicts, F.lit("")) != "").cast("int") + F.coalesce(ambiguous, F.lit(False)).cast("int")
    return F.when((defects == 2) | ((defects == 1) & ~high), "Baja").when((defects == 1) | ~high, "Media").otherwise("Alta")


def _ranked(rows: DataFrame, value: str, rank: str) -> DataFrame:
    """``rows`` with the rank of ``value``; the ranks are one row for each distinct value."""
    ranks = reference_rank(rows, value, F.col("estado_exclusion").eqNullSafe(REFERENCE)).withColumnRenamed("percentil", rank)
    return rows.join(ranks, value, "left")


def scored(prepared: DataFrame, weights: Weights) -> DataFrame:
    """SCO-2..10: ``prepared`` with the columns ``SCORES``.

    RuntimeError if the weights are not usable. Columns named like scores are replaced.
    """
    if not weights.usable:
        raise RuntimeError("the weights of the score are not defined or don't sum to one")
    rows = prepared.drop(*SCORES).withColumns({"_staff": numeric(F.col("num_empleados")), "_year": renewal_year(F.col("ultimo_ano_renovado"))})
    rows = _ranked(_ranked(rows, "_staff", "_staff_rank"), "_year", "_year_rank")
    size = F.coalesce(_number(size_class(F.trim("tamano_empresa")), weights.sizes), F.col("_staff_rank"))
    contact = F.get(F.array(*[F.lit(float(x)) for x in weights.contacts]), contact_channels([F.col(f"telefono_comercial_{i}") for i in (1, 2, 3)], F.col("email_comercial")))
    parts = rows.withColumns({
        "score_fit": fit_score(F.col("sector_vertical"), F.col("encaje_pagos_declarado"), weights), "score_escala_senal_tamano": size, "score_escala_senal_vigencia": F.col("_year_rank"), "score_contactabilidad": contact,
        "nivel_confianza_score": confidence_level(F.col("confianza_deduplicacion"), F.col("campos_en_conflicto"), F.col("flag_codigo_dane_ambiguo")),
    }).withColumn("score_escala", mean_of(F.col("score_escala_senal_tamano"), F.col("score_escala_senal_vigencia")))
    dims = [(F.col("score_fit"), weights.fit), (F.col("score_escala"), weights.scale), (F.col("score_contactabilidad"), weights.contact)]
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in dims), F.lit(0.0))
    share = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in dims), F.lit(0.0))
    there = sum((v.isNotNull().cast("int") for v, _ in dims), F.lit(0))
    done = parts.withColumns({"score_base": F.when(share > 0, 100 * total / share), "dimensiones_con_dato": there, "factor_cobertura": F.lit(COVERAGE_BASE) + COVERAGE_RANGE * there / DIMENSIONS})
    done = done.withColumn("score_prioridad_comercial", F.col("score_base") * F.col("factor_cobertura"))
    inside = F.col("estado_exclusion").isin(*SCORED)
    return done.withColumns({c: F.when(inside, F.col(c)) for c in SCORES}).drop("_staff", "_year", "_staff_rank", "_year_rank")


def score_stats(rows: DataFrame) -> DataFrame:
    """SCO-11: by state: rows, scored and unscored."""
    return rows.groupBy("estado_exclusion").agg(F.count("*").alias("filas"), F.count("score_prioridad_comercial").alias("con_score"), (F.count("*") - F.count("score_prioridad_comercial")).alias("sin_score"))


def priority_band(score: Column, high: float = 70.0, medium: float = 45.0) -> Column:
    """REP-9: the band of a score."""
    return F.when(score >= high, "ALTA").when(score >= medium, "MEDIA").when(score.isNotNull(), "BAJA")


def explained(priority: Column, score: Column, parts: Column) -> Column:
    """SCO-13: a text with the contributions, larger ones first (``parts``: array of ``nombre, valor, contribucion``); halves go to the even number."""
    order = F.array_sort(F.zip_with(parts, F.sequence(F.lit(1), F.size(parts)), lambda p, i: F.struct((-p["contribucion"]).alias("by"), i.alias("i"), p.alias("p"))))
    texts = F.transform(order, lambda o: F.format_string("%s (%s, %+.0f)", o["p"]["nombre"], o["p"]["valor"], F.bround(o["p"]["contribucion"], 0)))
    return F.when(F.size(parts) > 0, F.concat(F.format_string("Prioridad %s (%.0f/100) — ", F.upper(priority), F.bround(score, 0)), F.array_join(texts, "; "), F.lit(".")))


def corrected_sizes(rows: DataFrame, groups: DataFrame, corrections: DataFrame, source: str) -> DataFrame:
    """ENR-5: ``entidad_dedup_id, tamano_empresa``: the first size of each entity once one source's sizes are replaced.

    ``corrections`` has ``source_id, fila_origen, tamano`` for the rows of ``source``; a row of it without a correction has
    no size. The order of an entity's rows (completeness, then row) is that of the values before the correction, so only
    the size can change. Groups are combined before they are shuffled.
    """
    right = corrections.filter(F.col("source_id") == source).groupBy("source_id", "fila_origen").agg(F.min(light_clean(F.col("tamano"))).alias("_right"))
    own = rows.select("row_order", "source_id", "fila_origen", "tamano_empresa", completeness().alias("_full"))
    fixed = own.join(right, ["source_id", "fila_origen"], "left").withColumn("_size", F.when(F.col("source_id") == source, F.col("_right")).otherwise(F.col("tamano_empresa")))
    grouped = fixed.join(groups.select("row_order", "entidad_dedup_id"), "row_order")
    order = F.when(F.col("_size").isNotNull(), F.struct((-F.col("_full")).alias("c"), F.col("row_order").alias("o")))
    return grouped.groupBy("entidad_dedup_id").agg(F.min_by("_size", order).alias("tamano_empresa"))


def prepared(entities: DataFrame, sizes: DataFrame) -> DataFrame:
    """ENR-5..9: entities with corrected size and employees, sector, fit, place and its flag; originals are kept beside.

    ``sizes`` has ``entidad_dedup_id, tamano_empresa``, the corrected ones.
    """
    staff, code, place = plausible_employees(F.col("num_empleados_original")), activity(F.col("ciiu_1")), place_parts(F.col("municipio_comercial"))
    own = entities.withColumnsRenamed({"tamano_empresa": "tamano_empresa_original", "num_empleados": "num_empleados_original"}).join(sizes.select("entidad_dedup_id", "tamano_empresa"), "entidad_dedup_id", "left")
    out = own.withColumns({
        "tamano_empresa_corregido_flag": F.coalesce(F.col("tamano_empresa_original").rlike(CODE_FOR_SIZE), F.lit(False)), "num_empleados": staff["valor"], "num_empleados_anomalia_flag": staff["anomalo"],
        "sector_vertical": code["sector"], "encaje_pagos_declarado": code["encaje"], "municipio_nombre_normalizado": place["nombre"], "municipio_codigo_dane_extraido": place["codigo"],
    })
    coded = out.select(F.col("municipio_codigo_dane_extraido").alias("codigo"), F.col("municipio_nombre_normalizado").alias("nombre"))
    flags = ambiguous_places(coded).select(F.col("nombre").alias("municipio_nombre_normalizado"), F.col("ambiguo").alias("flag_codigo_dane_ambiguo"))
    return out.join(flags, "municipio_nombre_normalizado", "left").na.fill(False, ["flag_codigo_dane_ambiguo"])
