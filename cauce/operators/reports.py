"""Checks and summaries of results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.functions.registry import tie_key
from cauce.operators.rank import RANKED_STATE, ranked
from cauce.operators.scoring import priority_band

# The columns of an exported list, and those that must not be empty throughout.
EXPORTED = [
    "posicion_diversificada", "entidad_dedup_id", "razon_social", "nit", "sector_vertical", "sector_bucket_diversificacion", "municipio_nombre_normalizado", "direccion_comercial", "telefono_comercial_1", "telefono_comercial_2",
    "telefono_comercial_3", "email_comercial", "representante_legal", "score_prioridad_comercial", "posicion_ranking_puro", "metodo_seleccion", "motivo_diversificacion", "candidato_desplazado_id", "score_candidato_desplazado", "diferencia_score",
]
COVERED = ["razon_social", "nit", "sector_vertical", "score_prioridad_comercial"]


@dataclass(frozen=True)
class Filters:
    """REP-6: optional conditions; only those set are applied."""

    municipio: str | None = None
    departamento: str | None = None
    sector: str | None = None
    actividad: str | None = None
    tamano: str | None = None
    con_contacto: bool | None = None
    score_minimo: float | None = None
    prioridad: str | None = None
    estado: str | None = None
    en_pipeline: bool | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        contact = F.coalesce("telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3", "email_comercial").isNotNull()
        conditions = [
            (self.municipio, lambda v: F.col("municipio_nombre_normalizado") == v), (self.departamento, lambda v: F.col("departamento") == v), (self.actividad, lambda v: F.upper(F.trim("ciiu_1")).startswith(v.upper())),
            (self.prioridad, lambda v: priority_band(F.col("score_prioridad_comercial")) == v.upper()), (self.en_pipeline, lambda v: (F.col("estado_exclusion") != RANKED_STATE) == F.lit(v)), (self.sector, lambda v: F.col("sector_vertical") == v), (self.tamano, lambda v: F.col("tamano_empresa") == v),
            (self.con_contacto, lambda v: contact == F.lit(v)), (self.score_minimo, lambda v: F.col("score_prioridad_comercial") >= v), (self.estado, lambda v: F.col("estado_exclusion") == v),
        ]
        for value, condition in conditions:
            if value is not None:
                df = df.filter(condition(value))
        return df


def filtered_top(rows: DataFrame, filters: Filters, n: int) -> DataFrame:
    """REP-7: the best ``n`` rows that pass the filters; ties by the hash of the id."""
    chosen = filters.apply(rows).filter("score_prioridad_comercial is not null")
    return chosen.orderBy(F.desc("score_prioridad_comercial"), tie_key(F.col("entidad_dedup_id")), "entidad_dedup_id").limit(n)


def repeated_ids(rows: DataFrame, key: str) -> DataFrame:
    """REP-2: ids that occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("veces")).filter("veces > 1")


def unmatched_ids(rows: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """REP-3: ids without a row in the reference."""
    return rows.select(key).join(reference.select(key), key, "left_anti")


def completeness_by_field(rows: DataFrame, fields: list[str]) -> DataFrame:
    """REP-8: ``campo, llenos, porcentaje``, one pass over the rows."""
    counts = rows.agg(F.count("*").alias("_all"), *[F.count(f).alias(f) for f in fields])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f).alias("llenos")) for f in fields])).alias("p")
    return counts.select("_all", pairs).select("p.campo", "p.llenos", F.when(F.col("_all") > 0, F.round(100.0 * F.col("p.llenos") / F.col("_all"), 1)).alias("porcentaje"))


def coverage_by_place(rows: DataFrame) -> DataFrame:
    """REP-8 (extension): rows by department and place with subtotals (rollup); ``nivel`` tells the level."""
    return (
        rows.withColumns({"departamento": F.coalesce("departamento", F.lit("SIN_DATO")), "lugar": F.coalesce("municipio_nombre_normalizado", F.lit("SIN_DATO"))})
        .rollup("departamento", "lugar").agg(F.count("*").alias("filas"), F.grouping_id().cast("int").alias("nivel"))
    )


def merge_summary(groups: DataFrame) -> DataFrame:
    """REP-8: rows and entities by method of merging."""
    return groups.groupBy("metodo_deduplicacion").agg(F.count("*").alias("filas"), F.count_distinct("entidad_dedup_id").alias("entidades"))


class ListError(ValueError):
    """A list that breaks a rule of the export; nothing has been written."""


def top_export(rows: DataFrame, n: int) -> DataFrame:
    """REP-1: the diversified list with the commercial columns of the same rows, in the columns ``EXPORTED``.

    ListError where an id is not unique in ``rows`` (REP-2), a listed one is missing there (REP-3) or has another
    state (REP-4). Each check is one small job on the listed ids.
    """
    listed = ranked(rows, n)[0]
    ids = listed.select("entidad_dedup_id")
    found = rows.join(ids, "entidad_dedup_id", "left_semi")
    if not repeated_ids(found, "entidad_dedup_id").isEmpty():
        raise ListError("an id occurs more than once in the scored rows")
    if not unmatched_ids(ids, found, "entidad_dedup_id").isEmpty():
        raise ListError("a listed id has no scored row")
    if not other_state(found).isEmpty():
        raise ListError(f"a listed id has another state than {RANKED_STATE}")
    kept = ["razon_social", "nit", "direccion_comercial", "telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3", "email_comercial", "representante_legal", "sector_vertical", "score_prioridad_comercial"]
    mine = listed.select(
        "entidad_dedup_id", "posicion_diversificada", F.col("posicion_pura").alias("posicion_ranking_puro"), F.col("sector").alias("sector_bucket_diversificacion"), F.col("lugar").alias("municipio_nombre_normalizado"),
        F.col("metodo").alias("metodo_seleccion"), F.col("motivo").alias("motivo_diversificacion"), F.col("desplazada").alias("candidato_desplazado_id"), F.col("score_desplazada").alias("score_candidato_desplazado"), F.col("diferencia").alias("diferencia_score"),
    )
    return mine.join(found.select("entidad_dedup_id", *kept), "entidad_dedup_id").select(*EXPORTED)


def other_state(rows: DataFrame, state: str = RANKED_STATE) -> DataFrame:
    """REP-4: rows of another state."""
    return rows.filter(~F.col("estado_exclusion").eqNullSafe(state))


def check_list(listed: DataFrame, n: int, columns: list[str] = EXPORTED, covered: list[str] = COVERED, position: str = "posicion_diversificada", key: str = "entidad_dedup_id") -> DataFrame:
    """REP-5: ``listed``, if it has exactly these columns, n rows, unique ids, positions 1 to n and no empty covered column; else ListError."""
    if sorted(listed.columns) != sorted(columns):
        raise ListError(f"columns differ: {sorted(set(listed.columns) ^ set(columns))}")
    r = listed.agg(F.count("*").alias("n"), F.count_distinct(key).alias("ids"), F.count_distinct(position).alias("p"), F.min(position).alias("lo"), F.max(position).alias("hi"), *[F.count(c).alias(f"c_{c}") for c in covered]).first()
    if r.n != n or r.ids != n:
        raise ListError(f"{r.n} rows and {r.ids} ids where {n} are expected")
    if n and (r.p != n or r.lo != 1 or r.hi != n):
        raise ListError("positions are not 1 to the number of rows")
    empty = [c for c in covered if n and not r[f"c_{c}"]]
    if empty:
        raise ListError(f"columns without any value: {empty}")
    return listed


def comparison_report(metrics: dict[int, dict]) -> str:
    """SNK-7: a Markdown report of pure and diversified lists by size; ``metrics`` has figures, sectors and scores of each."""
    lines = ["# Ranking puro y diversificado", ""]
    for n, m in sorted(metrics.items()):
        figures = m["figures"]
        lines += [f"## Top {n}", "", f"- Tamaño final: {figures['final']}", f"- Reemplazos: {figures['reemplazos']}", f"- Protección de calidad: {figures['proteccion_calidad']}", f"- Diferidos por tope duro: {figures['diferidos_tope_duro']}", f"- Recuperados en fase 2: {figures['recuperados_fase2']}", ""]
        for title, rows in (("Sector", m["sectors"]), ("Municipio", m["places"])):
            lines += [f"| {title} | Puro | Diversificado |", "|---|---:|---:|", *[f"| {k} | {a} ({a / n:.1%}) | {b} ({b / n:.1%}) |" for k, a, b in rows], ""]
        lines += [f"Media {m['pure']:.3f} → {m['diversified']:.3f}, pérdida {m['pure'] - m['diversified']:.3f}", ""]
    return "\n".join(lines)


def comparison(rows: DataFrame, sizes: tuple[int, ...] = (100, 500, 1000, 5000), places: int = 8) -> dict[int, dict]:
    """SNK-7: the contents of ``comparison_report``; every list has at most as many rows as its size."""
    from cauce.operators.rank import compared, pure_top, score_loss

    out = {}
    for n in sizes:
        pure, (listed, figures) = pure_top(rows, n), ranked(rows, n)
        counts = lambda c: [(r[c], r.pura, r.diversificada) for r in compared(pure, listed, c).orderBy(F.desc(F.greatest("pura", "diversificada")), c).limit(places if c == "lugar" else 1000).collect()]  # noqa: B023, E731
        loss = score_loss(pure, listed).first()
        out[n] = {"figures": figures.first().asDict(), "sectors": counts("sector"), "places": counts("lugar"), "pure": loss.media_pura or 0.0, "diversified": loss.media_diversificada or 0.0}
    return out
