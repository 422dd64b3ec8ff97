"""Queries of whole phases (exclusion, scoring), each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions import registry as reg
from cauce.functions import messages as msg
from cauce.operators import dedup, exclude, legal, normalise, rank, register, reports, scoring
from cauce.operators.numbering import numbered
from cauce.plans.reference import _INT, _KEYS, _L1, _L2, _READY, E, G, I, N, S, X, _cmp, _dig, _ok, _ratio, _sorted_words, _stars
from cauce.plans.registry import Registry
from cauce.sources.tables import table

R = Registry()

# ---- exclusion ----

CHAMBER = "serena"
_PLACE = "CASE WHEN regexp_matches({c}, '^ *[0-9]+ * - ') THEN regexp_replace({c}, '^ *[0-9]+ * - ', '') ELSE {c} END"
_CASCADE = f"""
WITH {_INT},
x AS (SELECT entidad_dedup_id, {_ok(_dig('nit'))} AS nit_valido, {_ok('matricula')} AS mat, {_cmp('razon_social')} AS nombre, {_cmp(_PLACE.format(c='municipio_comercial'))} AS lugar, fuentes_consolidadas FROM {E}),
p AS (
  SELECT x.*, CASE WHEN nit_valido IN (SELECT nit_valido FROM i WHERE nit_valido IS NOT NULL) THEN 'A'
    WHEN mat IN (SELECT matricula_valida FROM i WHERE matricula_valida IS NOT NULL)
      AND EXISTS (SELECT 1 FROM fuentes s WHERE coalesce(s.camara_grupo, s.source_id) = '{CHAMBER}' AND position(';' || s.source_id || ';' IN ';' || x.fuentes_consolidadas || ';') > 0) THEN 'B'
    WHEN nombre IS NOT NULL AND lugar IS NOT NULL AND EXISTS (SELECT 1 FROM i WHERE i.nombre = x.nombre AND i.lugar = x.lugar) THEN 'C1m' WHEN nombre IN (SELECT nombre FROM i WHERE nombre IS NOT NULL) THEN 'C1' END AS pase
  FROM x),
q AS (SELECT entidad_dedup_id, nombre AS na, lugar FROM p WHERE pase IS NULL AND nombre IS NOT NULL AND lugar IS NOT NULL),
d AS (SELECT DISTINCT lugar, nombre AS nb FROM i WHERE nombre IS NOT NULL AND lugar IS NOT NULL),
small AS (SELECT lugar FROM (SELECT lugar FROM q GROUP BY 1 HAVING count(*) <= 300) JOIN (SELECT lugar FROM d GROUP BY 1 HAVING count(*) <= 300) USING (lugar)),
c AS (SELECT DISTINCT na, lugar, nb, {_sorted_words('na')} AS a, {_sorted_words('nb')} AS b FROM q JOIN d USING (lugar) JOIN small USING (lugar)),
r AS ({_ratio('c', 'na, lugar')}),
z AS (SELECT p.* REPLACE (coalesce(pase, CASE WHEN (nombre, lugar) IN (SELECT (na, lugar) FROM r WHERE ratio >= 85) THEN 'C2' END) AS pase) FROM p),
m AS (
  SELECT entidad_dedup_id, 'nit' AS identificador_tipo, z.nit_valido AS identificador_valor, fuente_interna, 'nit_exacto' AS tipo_coincidencia, 'alta' AS confianza, 'EXCLUSION_ALTA' AS estado_resultante,
         arg_min_null(tipo_antecedente, internal_order) AS tipo_antecedente_crm, CAST(epoch(arg_min_null(fecha_referencia, internal_order)) AS BIGINT) AS fecha_referencia FROM z JOIN i ON z.nit_valido = i.nit_valido WHERE pase = 'A' GROUP BY ALL
  UNION ALL SELECT DISTINCT entidad_dedup_id, 'matricula', mat, fuente_interna, 'matricula_contexto_camara', 'media', 'EXCLUSION_MEDIA', NULL, NULL FROM z JOIN i ON z.mat = i.matricula_valida WHERE pase = 'B'
  UNION ALL SELECT DISTINCT entidad_dedup_id, 'razon_social', NULL, fuente_interna, 'razon_social_municipio', 'media', 'CANDIDATO_AMBIGUO', NULL, NULL FROM z JOIN i ON z.nombre = i.nombre AND z.lugar = i.lugar WHERE pase = 'C1m'
  UNION ALL SELECT DISTINCT entidad_dedup_id, 'razon_social', NULL, fuente_interna, 'razon_social_sola', 'baja', 'CANDIDATO_AMBIGUO', NULL, NULL FROM z JOIN i ON z.nombre = i.nombre WHERE pase = 'C1'
  UNION ALL SELECT entidad_dedup_id, 'razon_social', NULL, 'multiples', 'fuzzy_razon_social', 'baja', 'CANDIDATO_AMBIGUO', NULL, NULL FROM z WHERE pase = 'C2')
"""


def _cascade(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return exclude.cascade(table(spark, d, E), exclude.internal_keys(table(spark, d, I)), table(spark, d, "fuentes"), CHAMBER)


@R.query(
    "exc12_states",
    _CASCADE + ", s AS (SELECT entidad_dedup_id, count(DISTINCT fuente_interna) AS n, string_agg(DISTINCT fuente_interna, ';' ORDER BY fuente_interna) AS f, min(tipo_coincidencia) AS t, min(confianza) AS c, min(estado_resultante) AS e FROM m GROUP BY 1) "
    f"SELECT x.entidad_dedup_id, coalesce(s.e, 'SIN_COINCIDENCIA') AS estado_exclusion, coalesce(s.n, 0) AS num_fuentes_internas_coincidentes, s.f AS fuentes_internas_coincidentes, s.t AS mejor_tipo_coincidencia, s.c AS mejor_confianza FROM x LEFT JOIN s USING (entidad_dedup_id)",
)
def exc12_states(spark: SparkSession, d: str) -> DataFrame:
    return _cascade(spark, d)[0]


@R.query("exc12_matches", _CASCADE + "SELECT * FROM m")
def exc12_matches(spark: SparkSession, d: str) -> DataFrame:
    return _cascade(spark, d)[1].withColumn("fecha_referencia", F.unix_timestamp("fecha_referencia"))


# ---- preparation and score ----

_FULL = " + ".join(f"CAST(n.{c} IS NOT NULL AS INTEGER)" for c in dedup.FIELDS)
_SIZES = f"""
fix AS (SELECT source_id, fila_origen, min(CASE WHEN {_cmp('tamano_empresa')} IS NOT NULL THEN trim(regexp_replace(lower(tamano_empresa), '\\s+', ' ', 'g')) END) AS t FROM {N} WHERE source_id = (SELECT min(source_id) FROM fuentes) GROUP BY 1, 2),
own AS (SELECT g.entidad_dedup_id, n.row_order, {_FULL} AS full_, CASE WHEN n.source_id = (SELECT min(source_id) FROM fuentes) THEN fix.t ELSE n.tamano_empresa END AS t FROM {N} n JOIN {G} g USING (row_order) LEFT JOIN fix ON n.source_id = fix.source_id AND n.fila_origen = fix.fila_origen),
sizes AS (SELECT entidad_dedup_id, arg_min(t, {{'a': -full_, 'b': row_order}}) FILTER (t IS NOT NULL) AS tamano_empresa FROM own GROUP BY 1)
"""


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "fuentes").agg(F.min("source_id")).first()[0]
    rows = table(spark, d, N)
    corrections = rows.filter(F.col("source_id") == source).select("source_id", "fila_origen", F.lower("tamano_empresa").alias("tamano"))
    return scoring.corrected_sizes(rows, table(spark, d, G), corrections, source)


@R.query("enr5_corrected_sizes", f"WITH {_SIZES} SELECT * FROM sizes")
def enr5(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d)


_SECTION = "CASE code[1] " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.SECTIONS.items()) + " END"
_EXACT = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.EXACT_CODES.items()) + " END"
_FIT = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.EXACT_FIT.items()) + " ELSE CASE code[1] " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.SECTION_FIT.items()) + " END END"
_PREPARED = f"""
WITH {_SIZES},
a AS (
  SELECT e.*, x.estado_exclusion, s.tamano_empresa AS size_, nullif(regexp_extract(upper(trim(e.ciiu_1)), '^[A-Z][0-9]{{3,4}}'), '') AS code, position(' - ' IN e.municipio_comercial) AS k,
         coalesce(regexp_full_match(e.num_empleados, '0*[1-9][0-9]{{5,}}'), false) AS absurd
  FROM {E} e JOIN {X} x USING (entidad_dedup_id) LEFT JOIN sizes s USING (entidad_dedup_id)),
b AS (SELECT *, k > 0 AND regexp_full_match(trim(substr(municipio_comercial, 1, k - 1)), '[0-9]+') AS coded FROM a),
c AS (SELECT *, CASE WHEN coded THEN trim(substr(municipio_comercial, 1, k - 1)) END AS codigo, CASE WHEN coded THEN substr(municipio_comercial, k + 3) ELSE municipio_comercial END AS resto FROM b),
h AS (SELECT *, {_cmp('resto')} AS lugar FROM c),
amb AS (SELECT lugar FROM h WHERE codigo IS NOT NULL AND lugar IS NOT NULL GROUP BY 1 HAVING count(DISTINCT codigo) > 1),
prep AS (
  SELECT entidad_dedup_id, estado_exclusion, tamano_empresa AS tamano_empresa_original, size_ AS tamano_empresa, coalesce(regexp_full_match(tamano_empresa, '[A-Z][0-9]{{3,4}}'), false) AS tamano_empresa_corregido_flag,
         num_empleados AS num_empleados_original, CASE WHEN NOT absurd THEN num_empleados END AS num_empleados, absurd AS num_empleados_anomalia_flag, coalesce({_EXACT}, {_SECTION}) AS sector_vertical, {_FIT} AS encaje_pagos_declarado,
         lugar AS municipio_nombre_normalizado, codigo AS municipio_codigo_dane_extraido, lugar IS NOT NULL AND lugar IN (SELECT lugar FROM amb) AS flag_codigo_dane_ambiguo,
         telefono_comercial_1, telefono_comercial_2, telefono_comercial_3, email_comercial, ultimo_ano_renovado, confianza_deduplicacion, campos_en_conflicto
  FROM h)
"""
_KEPT = [
    "entidad_dedup_id", "estado_exclusion", "tamano_empresa_original", "tamano_empresa", "tamano_empresa_corregido_flag", "num_empleados_original", "num_empleados", "num_empleados_anomalia_flag", "sector_vertical",
    "encaje_pagos_declarado", "municipio_nombre_normalizado", "municipio_codigo_dane_extraido", "flag_codigo_dane_ambiguo",
]


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    entities = table(spark, d, E).join(table(spark, d, X, "entidad_dedup_id", "estado_exclusion"), "entidad_dedup_id")
    return scoring.prepared(entities, _sizes(spark, d))


@R.query("enr9_prepared", _PREPARED + f"SELECT {', '.join(_KEPT)} FROM prep")
def enr9(spark: SparkSession, d: str) -> DataFrame:
    return _prepared(spark, d).select(*_KEPT)


_WEIGHTS = scoring.Weights(defined=True)
_CLASS = "CASE WHEN t LIKE '%gran%' THEN 1.0 WHEN t LIKE '%median%' THEN 0.75 WHEN t LIKE '%pequen%' THEN 0.5 WHEN t LIKE '%micro%' THEN 0.25 END"
_STRATEGIC = "CASE sector_vertical " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in scoring.STRATEGIC.items()) + " END"
_GENERIC = "CASE encaje_pagos_declarado " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in scoring.GENERIC.items()) + " END"
_YEAR = "CASE WHEN regexp_full_match(trim(replace(replace(ultimo_ano_renovado, ',', ''), '.', '')), '[0-9]{4}') THEN CAST(trim(replace(replace(ultimo_ano_renovado, ',', ''), '.', '')) AS INTEGER) END"
_SCORED = (
    _PREPARED
    + f""",
n AS (
  SELECT *, replace(lower(trim(tamano_empresa)), 'ñ', 'n') AS t, CASE WHEN regexp_full_match(trim(num_empleados), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]{{1,3}})?') THEN try_cast(trim(num_empleados) AS DOUBLE) END AS staff,
         CASE WHEN {_YEAR} BETWEEN 1990 AND 2026 THEN {_YEAR} END AS anio, estado_exclusion = 'SIN_COINCIDENCIA' AS ref, estado_exclusion IN ('SIN_COINCIDENCIA', 'CANDIDATO_AMBIGUO') AS dentro FROM prep),
rs AS (SELECT staff, sum(c) OVER (ORDER BY staff) / nullif((SELECT count(*) FROM n WHERE ref AND staff IS NOT NULL), 0) AS r FROM (SELECT staff, count(*) FILTER (ref) AS c FROM n WHERE staff IS NOT NULL GROUP BY 1)),
ry AS (SELECT anio, sum(c) OVER (ORDER BY anio) / nullif((SELECT count(*) FROM n WHERE ref AND anio IS NOT NULL), 0) AS r FROM (SELECT anio, count(*) FILTER (ref) AS c FROM n WHERE anio IS NOT NULL GROUP BY 1)),
d AS (
  SELECT n.*, coalesce({_STRATEGIC}, {_GENERIC}) AS fit, coalesce({_CLASS}, rs.r) AS st, ry.r AS sv, [0.0, 0.6, 1.0][1 + CAST(coalesce(telefono_comercial_1, telefono_comercial_2, telefono_comercial_3) IS NOT NULL AS INTEGER) + CAST(email_comercial IS NOT NULL AS INTEGER)] AS co,
         CAST(coalesce(campos_en_conflicto, '') <> '' AS INTEGER) + CAST(flag_codigo_dane_ambiguo AS INTEGER) AS def, coalesce(confianza_deduplicacion = 'alta', false) AS alta
  FROM n LEFT JOIN rs USING (staff) LEFT JOIN ry USING (anio)),
f AS (SELECT *, CASE WHEN st IS NULL AND sv IS NULL THEN NULL ELSE (coalesce(st, 0) + coalesce(sv, 0)) / (CAST(st IS NOT NULL AS INTEGER) + CAST(sv IS NOT NULL AS INTEGER)) END AS es FROM d),
g2 AS (SELECT *, 100 * (coalesce(0.40 * fit, 0) + coalesce(0.35 * es, 0) + coalesce(0.25 * co, 0)) / (CASE WHEN fit IS NULL THEN 0 ELSE 0.40 END + CASE WHEN es IS NULL THEN 0 ELSE 0.35 END + CASE WHEN co IS NULL THEN 0 ELSE 0.25 END) AS base,
         CAST(fit IS NOT NULL AS INTEGER) + CAST(es IS NOT NULL AS INTEGER) + CAST(co IS NOT NULL AS INTEGER) AS dims FROM f)
"""
)


@R.query(
    "sco10_scored",
    _SCORED + "SELECT entidad_dedup_id, estado_exclusion, CASE WHEN dentro THEN round(fit, 6) END AS score_fit, CASE WHEN dentro THEN round(es, 6) END AS score_escala, CASE WHEN dentro THEN round(co, 6) END AS score_contactabilidad, CASE WHEN dentro THEN round(base, 6) END AS score_base, "
    "CASE WHEN dentro THEN round(0.70 + 0.30 * dims / 3, 6) END AS factor_cobertura, CASE WHEN dentro THEN dims END AS dimensiones_con_dato, CASE WHEN dentro THEN round(base * (0.70 + 0.30 * dims / 3), 6) END AS score_prioridad_comercial, "
    "CASE WHEN dentro THEN CASE WHEN def = 2 OR (def = 1 AND NOT alta) THEN 'Baja' WHEN def = 1 OR NOT alta THEN 'Media' ELSE 'Alta' END END AS nivel_confianza_score FROM g2",
)
def sco10(spark: SparkSession, d: str) -> DataFrame:
    out = scoring.scored(_prepared(spark, d), _WEIGHTS)
    numbers = ["score_fit", "score_escala", "score_contactabilidad", "score_base", "factor_cobertura", "score_prioridad_comercial"]
    return out.select("entidad_dedup_id", "estado_exclusion", *[F.round(c, 6).alias(c) for c in numbers], "dimensiones_con_dato", "nivel_confianza_score")


@R.query("sco11_stats", _SCORED + "SELECT estado_exclusion, count(*) AS filas, count(CASE WHEN dentro THEN base END) AS con_score, count(*) - count(CASE WHEN dentro THEN base END) AS sin_score FROM g2 GROUP BY 1")
def sco11(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_stats(scoring.scored(_prepared(spark, d), _WEIGHTS))


@R.query("sco13_explained", _SCORED + """
, parts AS (SELECT entidad_dedup_id, base, 'Encaje' AS nombre, round(fit, 2) AS v, 40 * fit AS c, 1 AS i FROM g2 WHERE dentro AND fit IS NOT NULL UNION ALL SELECT entidad_dedup_id, base, 'Escala', round(es, 2), 35 * es, 2 FROM g2 WHERE dentro AND es IS NOT NULL UNION ALL SELECT entidad_dedup_id, base, 'Contacto', round(co, 2), 25 * co, 3 FROM g2 WHERE dentro)
SELECT entidad_dedup_id, printf('Prioridad %s (%.0f/100) — ', CASE WHEN any_value(base) >= 70 THEN 'ALTA' WHEN any_value(base) >= 45 THEN 'MEDIA' ELSE 'BAJA' END, any_value(base)) || string_agg(nombre || ' (' || printf('%.2f', v) || ', ' || printf('%+.0f', c) || ')', '; ' ORDER BY c DESC, i) || '.' AS texto FROM parts GROUP BY 1
""")
def sco13(spark: SparkSession, d: str) -> DataFrame:
    rows = scoring.scored(_prepared(spark, d), _WEIGHTS).filter("score_base is not null")
    part = lambda name, c, w: F.when(F.col(c).isNotNull(), F.struct(F.lit(name).alias("nombre"), F.format_string("%.2f", F.round(c, 2)).alias("valor"), (F.col(c) * (100 * w)).alias("contribucion")))
    parts = F.array_compact(F.array(part("Encaje", "score_fit", 0.40), part("Escala", "score_escala", 0.35), part("Contacto", "score_contactabilidad", 0.25)))
    return rows.select("entidad_dedup_id", scoring.explained(scoring.priority_band(F.col("score_base")), F.col("score_base"), parts).alias("texto"))


# ---- figures of the deduplication ----

_STATS = f"""
WITH RECURSIVE {_KEYS}, {_stars("SELECT * FROM e WHERE metodo = 'sin_consolidar' AND razon_social_normalizada IS NOT NULL AND municipio_nombre_normalizado IS NOT NULL")},
cand AS (
  SELECT count(*) AS n, (count(direccion_comercial) = count(*) AND count(DISTINCT direccion_comercial) = 1) OR (count(telefono_comercial_1) = count(*) AND count(DISTINCT telefono_comercial_1) = 1)
    OR (count(email_comercial) = count(*) AND count(DISTINCT email_comercial) = 1) AS ok FROM so GROUP BY razon_social_normalizada, municipio_nombre_normalizado HAVING count(*) > 1),
big AS (SELECT count(*) AS n FROM sf GROUP BY mun, pre HAVING count(*) > 300)
SELECT 'registros_entrada' AS estadistica, count(*) AS valor FROM e UNION ALL SELECT 'registros_salida', count(DISTINCT ent) FROM e
UNION ALL SELECT 'n_grupos_nit', count(DISTINCT clave) FROM e WHERE metodo IN ('nit', 'nit_multisede') UNION ALL SELECT 'n_registros_nit', count(*) FROM e WHERE metodo IN ('nit', 'nit_multisede')
UNION ALL SELECT 'n_nit_multisede', count(DISTINCT nk) FROM e WHERE nk IS NOT NULL AND seats > 1 UNION ALL SELECT 'n_filas_nit_multisede_sin_municipio', count(*) FROM e WHERE nk IS NOT NULL AND seats > 1 AND mun IS NULL
UNION ALL SELECT 'n_grupos_matricula', count(DISTINCT clave) FROM e WHERE metodo = 'matricula_camara' UNION ALL SELECT 'n_registros_matricula', count(*) FROM e WHERE metodo = 'matricula_camara'
UNION ALL SELECT 'n_grupos_rs_mun', count(*) FROM cand UNION ALL SELECT 'n_registros_rs_mun', CAST(coalesce(sum(n), 0) AS BIGINT) FROM cand UNION ALL SELECT 'n_grupos_rs_mun_corroborados', count(*) FROM cand WHERE ok
UNION ALL SELECT 'n_grupos_fuzzy', count(*) FROM stars UNION ALL SELECT 'n_registros_fuzzy', CAST(coalesce(sum(len(grupo)), 0) AS BIGINT) FROM stars
UNION ALL SELECT 'n_bloques_fuzzy_omitidos', count(*) FROM big UNION ALL SELECT 'n_registros_en_bloques_omitidos', CAST(coalesce(sum(n), 0) AS BIGINT) FROM big
"""


@R.query("ded16_run_stats", _STATS)
def ded16_run(spark: SparkSession, d: str) -> DataFrame:
    return dedup.run_stats(dedup.keyed(table(spark, d, N), table(spark, d, "fuentes")), table(spark, d, N))


# ---- ranking and export ----

# The sequential selection as a recursion: one step takes the next row in order; counts are of the rows chosen so far.
TOP = 100
_SHARES = "list(p ORDER BY k) AS p, list(least(greatest(3 * p, {0}), {1}) ORDER BY k) AS a, list(least(greatest(least(greatest(3 * p, {0}), {1}) + 0.1, {0}), {2}) ORDER BY k) AS h"


def _share(of: str) -> str:
    """SQL: the smoothed shares of sector and place once row ``of`` is admitted."""
    return f"(len(list_filter(used, lambda q: s[q] = s[{of}])) + 1 + 22 * es.p[s[{of}]]) / (len(used) + 1 + 22), (len(list_filter(used, lambda q: l[q] = l[{of}])) + 1 + 22 * ep.p[l[{of}]]) / (len(used) + 1 + 22)"


def _pair(of: str) -> list[str]:
    return [x + ("" if k else " / (len(used) + 1 + 22)") for k, x in enumerate(_share(of).split(" / (len(used) + 1 + 22), "))]


_PS, _PL = _pair("i")
_JS, _JL = _pair("j")
_SELECTED = f"""
WITH RECURSIVE {_READY},
tot AS (SELECT count(*) AS t FROM u),
ls AS (SELECT sector AS c, row_number() OVER (ORDER BY sector) AS k, count(*) / (SELECT t FROM tot) AS p FROM u GROUP BY 1),
lp AS (SELECT lugar AS c, row_number() OVER (ORDER BY lugar) AS k, count(*) / (SELECT t FROM tot) AS p FROM u GROUP BY 1),
o AS (SELECT u.*, row_number() OVER (ORDER BY score DESC, clave, id) AS rn, ls.k AS ks, lp.k AS kp FROM u JOIN ls ON u.sector = ls.c JOIN lp ON u.lugar = lp.c),
d AS (SELECT list(score ORDER BY rn) AS sc, list(ks ORDER BY rn) AS s, list(kp ORDER BY rn) AS l, count(*) AS n FROM o),
es AS (SELECT {_SHARES.format(0.25, 0.5, 0.55)} FROM ls), ep AS (SELECT {_SHARES.format(0.15, 0.35, 0.45)} FROM lp),
w AS (
  SELECT CAST(1 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS used, CAST([] AS STRUCT(i BIGINT, how VARCHAR, instead BIGINT, why VARCHAR)[]) AS chosen, CAST([] AS BIGINT[]) AS later, 0 AS ev, 0 AS rep, 0 AS prot, 0 AS dif
  UNION ALL
  SELECT i + 1, CASE WHEN was OR (act AND hard) THEN used ELSE list_append(used, CASE WHEN act THEN coalesce(j, i) ELSE i END) END,
         CASE WHEN was OR (act AND hard) THEN chosen ELSE list_append(chosen, CASE WHEN NOT act THEN {{'i': i, 'how': 'tolerancia', 'instead': CAST(NULL AS BIGINT), 'why': CAST(NULL AS VARCHAR)}} WHEN j IS NOT NULL THEN {{'i': j, 'how': 'diversificacion', 'instead': i, 'why': why}} ELSE {{'i': i, 'how': 'proteccion_calidad', 'instead': CAST(NULL AS BIGINT), 'why': why}} END) END,
         CASE WHEN NOT was AND act AND (hard OR j IS NOT NULL) THEN list_append(later, i) ELSE later END,
         ev + CAST(NOT was AS INTEGER), rep + CAST(NOT was AND act AND NOT hard AND j IS NOT NULL AS INTEGER), prot + CAST(NOT was AND act AND NOT hard AND j IS NULL AS INTEGER), dif + CAST(NOT was AND act AND hard AS INTEGER)
  FROM (
    SELECT y.*, CASE WHEN NOT was AND act AND NOT hard THEN list_filter(list_filter(range(i + 1, n + 1), lambda j: NOT list_contains(used, j))[1:50], lambda j: sc[j] >= 60 AND sc[j] >= 0.85 * sc[i] AND {_JS} <= es_a[s[j]] AND {_JL} <= ep_a[l[j]])[1] END AS j
    FROM (
      SELECT w.*, d.*, es, ep, es.a AS es_a, ep.a AS ep_a, list_contains(used, i) AS was, {_PS} > es.a[s[i]] OR {_PL} > ep.a[l[i]] AS act, {_PS} > es.h[s[i]] OR {_PL} > ep.h[l[i]] AS hard,
             concat_ws('; ', CASE WHEN {_PS} > es.a[s[i]] THEN printf('sector=''%s'' superaría %.1f%% (umbral de activación %.1f%%)', (SELECT c FROM ls WHERE ls.k = s[i]), 100 * ({_PS}), 100 * es.a[s[i]]) END,
                             CASE WHEN {_PL} > ep.a[l[i]] THEN printf('municipio=''%s'' superaría %.1f%% (umbral de activación %.1f%%)', (SELECT c FROM lp WHERE lp.k = l[i]), 100 * ({_PL}), 100 * ep.a[l[i]]) END) AS why
      FROM w, d, es, ep WHERE len(used) < {TOP} AND i <= n) y)),
v AS (
  SELECT CAST(1 AS BIGINT) AS k, used, chosen, later, ev, rep, prot, dif, 0 AS rec FROM (SELECT * FROM w ORDER BY i DESC LIMIT 1)
  UNION ALL
  SELECT k + 1, CASE WHEN ok THEN list_append(used, i) ELSE used END, CASE WHEN ok THEN list_append(chosen, {{'i': i, 'how': 'cierre_fase2', 'instead': CAST(NULL AS BIGINT), 'why': '{rank.LATE_REASON}'}}) ELSE chosen END, later, ev, rep, prot, dif, rec + CAST(ok AS INTEGER)
  FROM (SELECT z.*, NOT list_contains(used, i) AND {_PS} <= es.h[s[i]] AND {_PL} <= ep.h[l[i]] AS ok FROM (SELECT v.*, later[k] AS i FROM v WHERE k <= len(later) AND len(used) < {TOP}) z, d, es, ep)),
fin AS (SELECT * FROM v ORDER BY k DESC LIMIT 1),
c AS (SELECT unnest(chosen) AS x FROM fin),
list_ AS (
  SELECT a.id AS entidad_dedup_id, row_number() OVER (ORDER BY a.score DESC, a.clave) AS posicion_diversificada, a.rn AS posicion_pura, a.score, a.sector, a.lugar, x.how AS metodo, x.why AS motivo, b.id AS desplazada, b.score AS score_desplazada, a.score - b.score AS diferencia
  FROM c JOIN o a ON a.rn = x.i LEFT JOIN o b ON b.rn = x.instead)
"""


@R.query("div8_diversified_top", _SELECTED + "SELECT * REPLACE (round(score, 9) AS score, round(diferencia, 9) AS diferencia) FROM list_")
def div8(spark: SparkSession, d: str) -> DataFrame:
    return rank.diversified(table(spark, d, S), TOP).withColumns({c: F.round(c, 9) for c in ("score", "diferencia")})


@R.query("div9_figures", _SELECTED + f"SELECT 50 AS ventana, ev AS evaluados_fase1, rep AS reemplazos, prot AS proteccion_calidad, dif AS diferidos_tope_duro, rec AS recuperados_fase2, len(chosen) AS final, len(later) AS diferidos, len(later) - rec AS diferidos_nunca_recuperados FROM fin")
def div9(spark: SparkSession, d: str) -> DataFrame:
    """The figures of a run of the sequential selection."""
    return rank.ranked(table(spark, d, S), TOP)[1]


_PURE = f"pure AS (SELECT score, sector, lugar FROM u ORDER BY score DESC, id LIMIT {TOP})"


@R.query(
    "div12_compared",
    _SELECTED + f", {_PURE} " + " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, coalesce(a.{c}, b.{c}) AS categoria, coalesce(a.n, 0) AS pura, coalesce(b.n, 0) AS diversificada FROM (SELECT {c}, count(*) AS n FROM pure GROUP BY 1) a FULL JOIN (SELECT {c}, count(*) AS n FROM list_ GROUP BY 1) b USING ({c})" for c in ("sector", "lugar")
    ),
)
def div12_compared(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, S)
    pure, listed = rank.pure_top(rows, TOP), rank.diversified(rows, TOP)
    both = [rank.compared(pure, listed, c).select(F.lit(c).alias("dimension"), F.col(c).alias("categoria"), "pura", "diversificada") for c in ("sector", "lugar")]
    return both[0].unionByName(both[1])


@R.query(
    "div12_score_loss",
    _SELECTED + f", {_PURE}, m AS (SELECT (SELECT avg(score) FROM pure) AS a, (SELECT avg(score) FROM list_) AS b) SELECT round(a, 9) AS media_pura, round(b, 9) AS media_diversificada, round(a - b, 9) AS perdida, round(100 * (a - b) / a, 9) AS perdida_pct FROM m",
)
def div12_loss(spark: SparkSession, d: str) -> DataFrame:
    """Mean scores of the pure and the diversified list."""
    rows = table(spark, d, S)
    out = rank.score_loss(rank.pure_top(rows, TOP), rank.diversified(rows, TOP))
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


_JOINED = ["razon_social", "nit", "direccion_comercial", "telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3", "email_comercial", "representante_legal", "sector_vertical"]


@R.query(
    "rep1_export",
    _SELECTED + "SELECT entidad_dedup_id, posicion_diversificada, posicion_pura AS posicion_ranking_puro, sector AS sector_bucket_diversificacion, lugar AS municipio_nombre_normalizado, metodo AS metodo_seleccion, motivo AS motivo_diversificacion, "
    f"desplazada AS candidato_desplazado_id, score_desplazada AS score_candidato_desplazado, round(diferencia, 9) AS diferencia_score, {', '.join('x.' + c for c in _JOINED)}, x.score_prioridad_comercial FROM list_ JOIN {S} x USING (entidad_dedup_id)",
)
def rep1(spark: SparkSession, d: str) -> DataFrame:
    """The exported list with its 20 columns, checked."""
    return reports.check_list(reports.top_export(table(spark, d, S), TOP), TOP).withColumn("diferencia_score", F.round("diferencia_score", 9))


@R.query(
    "div10_universe",
    f"SELECT count(*) AS total, count(*) FILTER (estado_exclusion = 'SIN_COINCIDENCIA') AS elegibles, count(*) FILTER (estado_exclusion = 'CANDIDATO_AMBIGUO') AS ambiguos, count(*) FILTER (NOT coalesce(estado_exclusion IN ('SIN_COINCIDENCIA', 'CANDIDATO_AMBIGUO'), false)) AS excluidos FROM {S}",
)
def div10(spark: SparkSession, d: str) -> DataFrame:
    return rank.universe(table(spark, d, S))


@R.query("rep4_other_state", f"SELECT entidad_dedup_id, estado_exclusion FROM {S} WHERE estado_exclusion IS DISTINCT FROM 'SIN_COINCIDENCIA'")
def rep4(spark: SparkSession, d: str) -> DataFrame:
    return reports.other_state(table(spark, d, S)).select("entidad_dedup_id", "estado_exclusion")


@R.query(
    "rep9_bands",
    f"SELECT CASE WHEN score_prioridad_comercial >= 70 THEN 'ALTA' WHEN score_prioridad_comercial >= 45 THEN 'MEDIA' WHEN score_prioridad_comercial IS NOT NULL THEN 'BAJA' END AS prioridad, count(*) AS filas FROM {S} GROUP BY 1",
)
def rep9(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, S).groupBy(scoring.priority_band(F.col("score_prioridad_comercial")).alias("prioridad")).agg(F.count("*").alias("filas"))


# ---- legal registry ----

# registry rows stand for the answers: a record for each row with a usable id; ids divisible by seven are not answered
_BASE = f"CASE WHEN length({_dig('nit')}) BETWEEN 7 AND 12 THEN substr({_dig('nit')}, 1, length({_dig('nit')}) - 1) END"
_COMPARABLE = "nullif(trim(regexp_replace(regexp_replace({l2}, '[.,;:''\"()]', ' ', 'g'), '\\s+', ' ', 'g')), '')".replace("{l2}", _L2)
_LEGAL = f"""
WITH rec AS (
  SELECT {_BASE} AS b, right({_dig('nit')}, 1) AS dv, row_order AS o, razon_social AS rs, representante_legal AS rep, CASE WHEN estado_matricula LIKE '%ACTIV%' THEN 'ACTIVA' ELSE estado_matricula END AS est, matricula AS mat, source_id AS cam,
         CASE WHEN upper(tipo_organizacion) = 'PERSONA NATURAL' THEN 'PERSONA NATURAL' END AS org FROM {N} WHERE {_BASE} IS NOT NULL),
ans AS (SELECT b, CAST(b AS HUGEINT) % 7 <> 0 AS ok, count(*) AS n, count(*) FILTER (est = 'ACTIVA') AS vig, count(*) FILTER (est = 'CANCELADA') AS his, min(o) AS first_, min(o) FILTER (est = 'ACTIVA') AS force_ FROM rec GROUP BY 1),
pro AS (SELECT entidad_dedup_id, nit, razon_social, row_number() OVER (ORDER BY entidad_dedup_id) AS pos, {_BASE} AS b, right({_dig('nit')}, 1) AS dv FROM {E}),
j AS (SELECT p.*, a.ok, a.n, n > 1 AND vig = 1 AND his = n - 1 AS res, CASE WHEN n = 1 THEN first_ WHEN n > 1 AND vig = 1 AND his = n - 1 THEN force_ END AS pick FROM pro p LEFT JOIN ans a USING (b)),
k AS (SELECT j.*, r.b AS rb, r.dv AS rdv, r.rs, r.rep, r.est, r.mat, r.cam, r.org FROM j LEFT JOIN rec r ON r.o = j.pick),
t1 AS (SELECT entidad_dedup_id AS key, {_cmp('razon_social')} AS t FROM k), s1 AS (SELECT key, {_L1} AS s FROM t1), n1 AS (SELECT key, {_COMPARABLE} AS a FROM s1),
t2 AS (SELECT entidad_dedup_id AS key, {_cmp('rs')} AS t FROM k), s2 AS (SELECT key, {_L1} AS s FROM t2), n2 AS (SELECT key, {_COMPARABLE} AS z FROM s2),
m AS (
  SELECT k.*, CASE WHEN b IS NULL THEN 'NO_CONSULTABLE' WHEN NOT coalesce(ok, false) THEN 'ERROR_CONSULTA' WHEN n = 0 THEN 'NO_MATCH' WHEN n > 1 AND res THEN 'MATCH_RESUELTO_HISTORICO' WHEN n > 1 THEN 'ERROR_CONSULTA'
    WHEN coalesce(a = z OR position(z IN a) > 0 OR position(a IN z) > 0, false) AND rdv IS NOT DISTINCT FROM dv THEN 'MATCH_CONFIRMADO' ELSE 'MATCH_CON_OBSERVACION' END AS resultado
  FROM k JOIN n1 ON k.entidad_dedup_id = n1.key JOIN n2 ON k.entidad_dedup_id = n2.key)
"""


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, N).withColumn("q", reg.askable_id(F.col("nit"))).filter("q.consultable")
    state = F.when(F.col("estado_matricula").contains("ACTIV"), "ACTIVA").otherwise(F.col("estado_matricula"))
    responses = rows.select(
        F.col("q.base").alias("nit_consultado"), (F.col("q.base").cast("decimal(20,0)") % 7 != 0).alias("ok"), F.col("row_order").alias("orden"), F.col("q.base").alias("nit"), F.col("q.digito").alias("digito_verificacion"), "razon_social", "representante_legal",
        state.alias("estado_matricula"), "matricula", F.col("source_id").alias("camara_comercio"), F.when(F.upper("tipo_organizacion") == legal.NATURAL, legal.NATURAL).alias("organizacion_juridica"),
    )
    return legal.enriched(numbered(table(spark, d, E, "entidad_dedup_id", "nit", "razon_social"), "entidad_dedup_id", name="posicion_diversificada"), responses)


_IF = "CASE WHEN resultado LIKE 'MATCH%' THEN {} END AS {}"


@R.query(
    "leg8_enriched",
    _LEGAL
    + "SELECT entidad_dedup_id, pos AS posicion_diversificada, nit, resultado AS resultado_match, b AS nit_consultado, "
    + ", ".join(_IF.format(a, b) for a, b in (("rb", "nit_confecamaras"), ("rdv", "digito_verificacion"), ("rs", "razon_social_confecamaras"), ("est", "estado_matricula"), ("mat", "matricula"), ("cam", "camara_comercio")))
    + ", " + _IF.format("CASE WHEN org = 'PERSONA NATURAL' THEN 'no aplica' WHEN trim(coalesce(rep, '')) = '' THEN 'no informado por la fuente' ELSE rep END", "representante_legal") + " FROM m",
)
def leg8(spark: SparkSession, d: str) -> DataFrame:
    return _enriched(spark, d)


@R.query("leg14_outcomes", _LEGAL + "SELECT resultado AS resultado_match, count(*) AS filas FROM m GROUP BY 1")
def leg14(spark: SparkSession, d: str) -> DataFrame:
    return legal.outcome_counts(_enriched(spark, d))


# ---- messages and the register ----


def _has(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"position('{w}' IN {text}) > 0" for w in words) + ")"


def _danger(which: int) -> str:
    """SQL: the intent (0) or the reason (1) of the first rule of safety that a text breaks."""
    both = " AND ".join(f"position('{w}' IN lower(text)) > 0" for w in msg.THIRD_PARTY[2])
    return "CASE " + " ".join(f"WHEN {_has('lower(text)', r[2])} THEN '{r[which]}'" for r in msg.SAFETY) + f" WHEN {both} THEN '{msg.THIRD_PARTY[which]}' END"


_ORDER = sorted(msg.INTENTS.items(), key=lambda x: -x[1][0])
_WISH = "CASE " + " ".join(f"WHEN {_has('lower(trim(text))', words)} THEN '{k}'" for k, (_, words) in _ORDER) + f" ELSE '{msg.UNKNOWN}' END"
_WORD = "CASE " + " ".join(f"WHEN position('{w}' IN lower(trim(text))) > 0 THEN '{w}'" for _, (_, words) in _ORDER for w in words) + " END"


def _by_wish(values: dict[str, str], otherwise: str) -> str:
    return "CASE wish " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {otherwise} END"


_SURE = _by_wish({k: str(c) for k, (c, _) in msg.INTENTS.items()}, "0.0")
_RISK = _by_wish({k: f"'{v[0]}'" for k, v in msg.RISKS.items()}, "'LOW'")
_ASK = _by_wish({k: str(v[1]).lower() for k, v in msg.RISKS.items()}, "false")
_BECAUSE = _by_wish({k: f"'{v[2]}'" for k, v in msg.RISKS.items() if v[2]}, "NULL")


@R.query(
    "msg5_classified",
    f"WITH c AS (SELECT doc_id, {_danger(0)} AS danger, {_danger(1)} AS why, {_WISH} AS wish, {_WORD} AS palabra FROM documents WHERE text IS NOT NULL) "
    f"SELECT doc_id, coalesce(danger, wish) AS intent, CASE WHEN danger IS NOT NULL THEN 1.0 ELSE {_SURE} END AS confianza, CASE WHEN danger IS NULL THEN palabra END AS palabra, CASE WHEN danger IS NOT NULL THEN 'CRITICAL' ELSE {_RISK} END AS riesgo, "
    f"danger IS NOT NULL OR {_ASK} AS requiere_aprobacion, coalesce(why, {_BECAUSE}) AS motivo FROM c",
)
def msg5(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents", "doc_id", "text").filter("text is not null")
    return msg.classified(rows).drop("text", "entidades")


_VOCABULARIES = {"bic": ["SI", "NO"], "grupo_niif": ["1", "2", "3"], "categoria_matricula": ["PRINCIPAL", "SUCURSAL"]}
_ERRORS = " || ".join(f"CASE WHEN coalesce({k}, '') <> '' AND {k} NOT IN ({', '.join(repr(x) for x in v)}) THEN '{k}: ''' || {k} || ''' no es válido;' ELSE '' END" for k, v in _VOCABULARIES.items())


@R.query("int1_vocabulary_errors", f"SELECT row_order, {_ERRORS} AS errores FROM {N}")
def int1(spark: SparkSession, d: str) -> DataFrame:
    found = register.vocabulary_errors(table(spark, d, N, "row_order", *_VOCABULARIES), _VOCABULARIES)
    return found.select("row_order", F.array_join(F.transform("errores", lambda e: F.concat(e, F.lit(";"))), "").alias("errores"))


@R.query("int3_next_numbers", f"SELECT source_id, max(fila_origen) + 1 AS siguiente FROM {N} GROUP BY 1")
def int3(spark: SparkSession, d: str) -> DataFrame:
    return register.next_numbers(table(spark, d, N), "source_id", "fila_origen")


# ---- reports of the normalisation ----

_MAPPED = ", ".join(f"'{n}'" for names in normalise.HEADERS.values() for n in names)


@R.query(
    "nrm16_report",
    "WITH s AS (SELECT source_id, archivo, categoria, list_transform(string_split(encabezado, CASE WHEN delimitador = '\\t' THEN chr(9) ELSE delimitador END), lambda x: upper(trim(x))) AS h FROM fuentes), "
    f"k AS (SELECT *, len(h) AS total, len(list_filter(h, lambda x: x IN ({_MAPPED}))) AS mapeadas FROM s), "
    f"r AS (SELECT source_id, count(*) AS registros, count(*) FILTER (sin_identificador) AS sin, count(*) FILTER (flag_codigo_dane_ambiguo) AS amb FROM {N} GROUP BY 1) "
    "SELECT k.source_id, archivo, categoria, coalesce(registros, 0) AS registros, total AS columnas_originales, mapeadas AS columnas_mapeadas, coalesce(sin, 0) AS registros_sin_identificador, "
    "printf('%.1f', CASE WHEN coalesce(registros, 0) = 0 THEN 0.0 ELSE 100.0 * coalesce(sin, 0) / registros END) AS pct_sin_identificador, coalesce(amb, 0) AS registros_dane_ambiguo FROM k LEFT JOIN r USING (source_id)",
)
def nrm16_report(spark: SparkSession, d: str) -> DataFrame:
    return normalise.source_report(table(spark, d, N), table(spark, d, "fuentes")).drop("columnas_sin_mapear", "colisiones")
