"""Ranking under soft limits for each sector and place.

Shares, limits and order are computed on all rows; the selection itself is sequential and runs on a prefix of
the order in one task. The result on a prefix is exact if the list was filled before the prefix ended and no
window of replacements ran over its end; otherwise the prefix is doubled.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.registry import PLACE_SHARES, SECTOR_BUCKETS, SECTOR_SHARES, SHARE_FACTOR, SHARE_MARGIN, SMOOTHING, clamp, lookup, tie_key
from cauce.session import cut

# The least window of replacements and its share of the list, the least score of one, absolute and of the displaced.
LEAST_WINDOW, WINDOW_SHARE, LEAST_SCORE, RELATIVE_SCORE = 50, 0.01, 60.0, 0.85
NO_SECTOR, NO_PLACE, OTHER = "Sin sector", "SIN_DATO", "Otros"
RANKED_STATE = "SIN_COINCIDENCIA"
LATE_REASON = "reincorporado en cierre de fase 2 (universo insuficiente bajo el umbral de activación)"
#: The row that carries the figures of a run.
RUN = "_run"


def bucket(c: Column) -> Column:
    """DIV-1: sector group; unknown sectors and missing ones have groups of their own."""
    return F.when(c.isNull(), NO_SECTOR).otherwise(F.coalesce(lookup(c, SECTOR_BUCKETS), F.lit(OTHER)))


def prepared(rows: DataFrame) -> DataFrame:
    """DIV-1..3: ``id, score, sector, lugar, clave`` of the rows that can be ranked."""
    return rows.filter("estado_exclusion = 'SIN_COINCIDENCIA' AND score_prioridad_comercial IS NOT NULL").select(
        F.col("entidad_dedup_id").alias("id"), F.col("score_prioridad_comercial").alias("score"), bucket(F.col("sector_vertical")).alias("sector"),
        F.coalesce("municipio_nombre_normalizado", F.lit(NO_PLACE)).alias("lugar"), tie_key(F.col("entidad_dedup_id")).alias("clave"),
    )


def limits(ready: DataFrame, column: str, shares: tuple[float, float, float], total: int | None = None) -> DataFrame:
    """DIV-4, DIV-5: ``categoria, n, p, activacion, tope`` of every category."""
    low, high, hard = shares
    # the total is one number; free-typed categories may be many, so no window holds them all
    total = ready.count() if total is None else total
    counts = ready.groupBy(F.col(column).alias("categoria")).agg(F.count("*").alias("n"))
    p = F.col("n") / F.lit(max(total, 1))
    start = clamp(p * SHARE_FACTOR, low, high)
    return counts.select("categoria", "n", p.alias("p"), start.alias("activacion"), clamp(start + SHARE_MARGIN, low, hard).alias("tope"))


def select(rows: pd.DataFrame, n: int, whole: bool) -> tuple[list[tuple], bool, dict[str, int]]:
    """DIV-8, DIV-9 on ordered rows with their shares and limits: chosen rows, whether that is the result of all rows, and figures of the run.

    A chosen row is ``(place, method, place of the displaced one, reason)``.
    """
    score, sector, place = rows["score"].tolist(), rows["sector"].tolist(), rows["lugar"].tolist()
    base = {("s", s): v for s, v in zip(sector, zip(rows["ps"], rows["as_"], rows["ts"], strict=True), strict=True)} | {("p", s): v for s, v in zip(place, zip(rows["pl"], rows["al"], rows["tl"], strict=True), strict=True)}
    held: dict[tuple[str, str], int] = {}
    window, count = max(LEAST_WINDOW, math.ceil(WINDOW_SHARE * n)), len(rows)
    used = [False] * count
    chosen: list[tuple] = []
    later: list[int] = []
    exact = True
    figures = {"ventana": window, "evaluados_fase1": 0, "reemplazos": 0, "proteccion_calidad": 0, "diferidos_tope_duro": 0, "recuperados_fase2": 0}

    def share(key: tuple[str, str]) -> float:
        return (held.get(key, 0) + 1 + SMOOTHING * base[key][0]) / (len(chosen) + 1 + SMOOTHING)

    def over(i: int, at: int) -> bool:
        """Whether admitting row i would pass a limit (1 where restraint begins, 2 the hard one)."""
        return any(share(key) > base[key][at] for key in (("s", sector[i]), ("p", place[i])))

    def reason(i: int) -> str:
        """Why restraint begins at row i."""
        parts = [f"{name}='{key[1]}' superaría {share(key):.1%} (umbral de activación {base[key][1]:.1%})" for name, key in (("sector", ("s", sector[i])), ("municipio", ("p", place[i]))) if share(key) > base[key][1]]
        return "; ".join(parts) or "umbral superado"

    def admit(i: int, how: str, instead: int | None = None, why: str | None = None) -> None:
        used[i] = True
        for key in (("s", sector[i]), ("p", place[i])):
            held[key] = held.get(key, 0) + 1
        chosen.append((i, how, instead, why))

    def replacement(i: int) -> int | None:
        nonlocal exact
        seen = 0
        for j in range(i + 1, count):
            if seen >= window:
                return None
            if used[j]:
                continue
            seen += 1
            if score[j] >= LEAST_SCORE and score[j] >= RELATIVE_SCORE * score[i] and not over(j, 1):
                return j
        exact &= whole or seen >= window
        return None

    for i in range(count):
        if len(chosen) >= n:
            break
        if used[i]:
            continue
        figures["evaluados_fase1"] += 1
        if not over(i, 1):
            admit(i, "tolerancia")
            continue
        why = reason(i)
        if over(i, 2):
            later.append(i)
            figures["diferidos_tope_duro"] += 1
        elif (j := replacement(i)) is not None:
            admit(j, "diversificacion", i, why)
            later.append(i)
            figures["reemplazos"] += 1
        else:
            admit(i, "proteccion_calidad", None, why)
            figures["proteccion_calidad"] += 1
    exact &= whole or len(chosen) >= n
    for i in later:
        if len(chosen) >= n:
            break
        if not used[i] and not over(i, 2):
            admit(i, "cierre_fase2", None, LATE_REASON)
            figures["recuperados_fase2"] += 1
    figures |= {"final": len(chosen), "diferidos": len(later), "diferidos_nunca_recuperados": len(later) - figures["recuperados_fase2"]}
    return chosen, exact, figures


LIST = (
    "entidad_dedup_id string, posicion_diversificada int, posicion_pura int, score double, sector string, lugar string, metodo string, motivo string, desplazada string, score_desplazada double, diferencia double"
)
FIGURES = ["ventana", "evaluados_fase1", "reemplazos", "proteccion_calidad", "diferidos_tope_duro", "recuperados_fase2", "final", "diferidos", "diferidos_nunca_recuperados"]


def _selection(n: int, whole: bool):
    """``select`` on the one group of a prefix, in the order in which the list is shown; the last row has the figures."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["score", "clave", "id"], ascending=[False, True, True]).reset_index(drop=True)
        chosen, exact, figures = select(b, n, whole)
        of = lambda i, c: None if i is None else b.at[i, c]
        out = pd.DataFrame(
            [(b.at[i, "id"], i + 1, b.at[i, "score"], b.at[i, "sector"], b.at[i, "lugar"], how, why, of(j, "id"), of(j, "score"), None if j is None else b.at[i, "score"] - b.at[j, "score"], b.at[i, "clave"]) for i, how, j, why in chosen],
            columns=["entidad_dedup_id", "posicion_pura", "score", "sector", "lugar", "metodo", "motivo", "desplazada", "score_desplazada", "diferencia", "clave"],
        )
        out = out.sort_values(["score", "clave"], ascending=[False, True]).reset_index(drop=True)
        out["posicion_diversificada"] = range(1, len(out) + 1)
        out = pd.concat([out.drop(columns="clave"), pd.DataFrame([{"metodo": RUN, **figures}])], ignore_index=True)
        out["exacto"] = exact
        names = [f.split()[0] for f in LIST.split(", ")]
        for c in ("posicion_diversificada", "posicion_pura", *FIGURES):
            out[c] = out[c].astype("Int64")
        return out[[*names, *FIGURES, "exacto"]].astype({c: object for c in ("entidad_dedup_id", "sector", "lugar", "metodo", "motivo", "desplazada")}).where(out.notna(), None) if len(out) else out

    return run


def checked(rows: DataFrame) -> DataFrame:
    """DIV-7: ``rows``, if all are of the state that is ranked; else ValueError. One aggregate."""
    other = rows.filter(~F.col("estado_exclusion").eqNullSafe(RANKED_STATE)).limit(1).count()
    if other:
        raise ValueError(f"rows of another state than {RANKED_STATE}")
    return rows


def universe(rows: DataFrame) -> DataFrame:
    """DIV-10: one row: all rows, those that can be ranked, ambiguous and excluded ones."""
    state = F.col("estado_exclusion")
    return rows.agg(
        F.count("*").alias("total"), F.count_if(state == RANKED_STATE).alias("elegibles"), F.count_if(state == "CANDIDATO_AMBIGUO").alias("ambiguos"),
        F.count_if(~F.coalesce(state.isin(RANKED_STATE, "CANDIDATO_AMBIGUO"), F.lit(False))).alias("excluidos"),
    )


def ranked(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """DIV-8, DIV-9: the list (see ``diversified``) and one row of figures of the run; both are written, and read as often as wanted. Without rows neither has any."""
    if n <= 0:
        raise ValueError("n must be positive")
    ready = prepared(rows)
    own = lambda df, c, a, b, d: df.select(F.col("categoria").alias(c), F.col("p").alias(a), F.col("activacion").alias(b), F.col("tope").alias(d))
    total = ready.count()
    full = ready.join(own(limits(ready, "sector", SECTOR_SHARES, total), "sector", "ps", "as_", "ts"), "sector").join(own(limits(ready, "lugar", PLACE_SHARES, total), "lugar", "pl", "al", "tl"), "lugar")
    size = max(20 * n, n + 10 * max(LEAST_WINDOW, math.ceil(WINDOW_SHARE * n)))
    schema = LIST + "".join(f", {c} int" for c in FIGURES) + ", exacto boolean"
    while True:
        whole = size >= total
        first = full.orderBy(F.desc("score"), "clave", "id").limit(size)
        result = cut(first.groupBy(F.lit(1).alias("_all")).applyInPandas(_selection(n, whole), schema))
        if whole or (r := result.select("exacto").first()) is not None and r.exacto:
            return result.filter(F.col("metodo") != RUN).drop("exacto", *FIGURES), result.filter(F.col("metodo") == RUN).select(*FIGURES)
        size *= 4


def diversified(rows: DataFrame, n: int) -> DataFrame:
    """DIV-8: ``entidad_dedup_id, posicion_diversificada, posicion_pura, score, sector, lugar, metodo, motivo, desplazada, score_desplazada, diferencia``.

    Fewer than ``n`` rows come out where the limits leave no more. Scores tie by the hash of the id.
    """
    return ranked(rows, n)[0]


def pure_top(rows: DataFrame, n: int) -> DataFrame:
    """DIV-11: the best ``n`` by score, ties by id."""
    return prepared(rows).orderBy(F.desc("score"), "id").limit(n).select(F.col("id").alias("entidad_dedup_id"), "score", "sector", "lugar")


def compared(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """DIV-12: counts of a column in two lists."""
    count = lambda df, name: df.groupBy(column).agg(F.count("*").alias(name))
    return count(a, "pura").join(count(b, "diversificada"), column, "full").na.fill(0, ["pura", "diversificada"])


def list_metrics(ranked_rows: DataFrame) -> DataFrame:
    """DIV-12: size, mean, exact median and least score of a list."""
    return ranked_rows.agg(F.count("*").alias("filas"), F.avg("score").alias("media"), F.percentile("score", 0.5).alias("mediana"), F.min("score").alias("minimo"))


def score_loss(a: DataFrame, b: DataFrame) -> DataFrame:
    """DIV-12: means of two lists (pure, diversified), the loss and its percentage."""
    both = a.select(F.lit(0).alias("l"), "score").unionByName(b.select(F.lit(1).alias("l"), "score")).agg(F.avg(F.when(F.col("l") == 0, F.col("score"))).alias("media_pura"), F.avg(F.when(F.col("l") == 1, F.col("score"))).alias("media_diversificada"))
    loss = F.col("media_pura") - F.col("media_diversificada")
    return both.select("*", loss.alias("perdida"), F.when(F.col("media_pura") != 0, 100 * loss / F.col("media_pura")).alias("perdida_pct"))
