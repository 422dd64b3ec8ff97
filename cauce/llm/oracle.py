"""SQL that checks the queries of this subpackage, written apart from them."""

from cauce.operators.dedup import FIELDS as _FIELDS

_WORDS = "'NULL', 'NONE', 'S/D', 'S/I', 'ND', 'N/D', 'PENDIENTE', 'POR DEFINIR', 'SIN INFORMACION', 'NO TIENE', 'NINGUNO', 'NINGUNA', 'NO REGISTRA', 'N/A', 'NA', 'NO REPORTA', 'NO APLICA', 'NO REPORTADO', 'SIN DATO', '<NA>', 'NAN', 'NAT'"


def _full(c: str) -> str:
    t = f"upper(trim({c}))"
    bad = [f"{t} IN ({_WORDS})", f"regexp_full_match({t}, 'XX+')", f"NOT regexp_matches({t}, '[\\p{{L}}\\p{{N}}]')"]
    if c in ("nit", "matricula", "matricula_establecimiento") or c.startswith("telefono"):
        bad.append(f"(regexp_full_match({t}, '[0-9]+') AND replace({t}, {t}[1], '') = '')")
    if c.startswith("fecha") or c in ("municipio_comercial", "direccion_comercial"):
        bad.append(f"regexp_full_match({t}, '[^\\p{{L}}1-9]*')")
    return f"CASE WHEN {c} IS NULL OR {' OR '.join(bad)} THEN 0 ELSE 1 END"


P1_FOUND = f"""
WITH d AS (
  SELECT row_order, source_id, {' + '.join(_full(c) for c in _FIELDS)} AS n,
         regexp_replace(trim(fecha_renovacion), ' [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$', '') AS f
  FROM empresas_normalizado),
p AS (
  SELECT row_order, source_id, n,
         CASE WHEN regexp_full_match(f, '[0-9]{{8}}') THEN substr(f, 1, 4) || '-' || substr(f, 5, 2) || '-' || substr(f, 7, 2)
              WHEN regexp_full_match(f, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN f
              WHEN regexp_full_match(f, '[0-9]{{1,2}}[/.-][0-9]{{1,2}}[/.-][0-9]{{4}}')
                THEN regexp_extract(f, '[0-9]{{4}}$') || '-' || lpad(regexp_extract(f, '^[0-9]+[/.-]([0-9]+)', 1), 2, '0') || '-' || lpad(regexp_extract(f, '^[0-9]+'), 2, '0')
              WHEN regexp_full_match(f, '[0-9]{{1,2}} [a-z]{{3}} [0-9]{{4}}')
                THEN regexp_extract(f, '[0-9]{{4}}$') || '-' || lpad(CAST((position(regexp_extract(f, '[a-z]{{3}}') IN 'ene feb mar abr may jun jul ago sep oct nov dic') + 3) // 4 AS VARCHAR), 2, '0')
                     || '-' || lpad(regexp_extract(f, '^[0-9]+'), 2, '0') END AS iso
  FROM d),
r AS (
  SELECT g.entidad_dedup_id, p.row_order, n, coalesce(CAST(try_cast(iso AS DATE) AS VARCHAR), '') AS dia,
         CASE nivel_confianza_fuente WHEN 'confirmado' THEN 2 WHEN 'externo' THEN 1 ELSE 0 END AS t
  FROM p JOIN grupos_deduplicacion g USING (row_order) LEFT JOIN fuentes s ON p.source_id = s.source_id),
m AS (SELECT entidad_dedup_id, count(*) AS k, max(n) AS n, max(dia) AS dia, max(t) AS t FROM r GROUP BY 1)
SELECT r.entidad_dedup_id, min(r.row_order) AS row_order
FROM r JOIN m USING (entidad_dedup_id) WHERE m.k >= 2 AND r.n = m.n AND r.dia = m.dia AND r.t = m.t GROUP BY 1
"""


_SIZE = "CASE WHEN t LIKE '%GRAN%' THEN 'GRANDE' WHEN t LIKE '%MEDIAN%' THEN 'MEDIANA' WHEN t LIKE '%PEQUEN%' THEN 'PEQUENA' WHEN t LIKE '%MICRO%' THEN 'MICRO' END"
_STATE = "CASE WHEN t LIKE '%CANCEL%' THEN 'CANCELADA' WHEN t LIKE '%SUSPEN%' THEN 'SUSPENDIDA' WHEN t LIKE '%ACTIV%' THEN 'ACTIVA' END"
_PLAIN = "trim(regexp_replace(t, '[^A-Z0-9]+', ' ', 'g'))"
_NIIF = f"CASE {_PLAIN} WHEN '1' THEN 'GRUPO I' WHEN '2' THEN 'GRUPO II' WHEN '3' THEN 'GRUPO III' WHEN 'I' THEN 'GRUPO I' WHEN 'II' THEN 'GRUPO II' WHEN 'III' THEN 'GRUPO III' WHEN 'S' THEN 'SI' WHEN 'N' THEN 'NO' ELSE {_PLAIN} END"
_YEAR = "CASE WHEN try_cast(regexp_replace(regexp_extract(t, '^\\s*([0-9][.,]?[0-9]{3})(?:[.,]0+)?\\s*$', 1), '[.,]', '') AS INTEGER) BETWEEN 1990 AND 2026 THEN regexp_replace(regexp_extract(t, '^\\s*([0-9][.,]?[0-9]{3})(?:[.,]0+)?\\s*$', 1), '[.,]', '') END"
_EVOLVING = {"tamano_empresa": _SIZE, "estado_matricula": _STATE, "tipo_organizacion": _PLAIN, "grupo_niif": _NIIF, "categoria_matricula": _PLAIN, "bic": _NIIF, "ultimo_ano_renovado": _YEAR}
_READ = P1_FOUND[: P1_FOUND.index("m AS (SELECT")].rstrip().rstrip(",").replace("WITH d AS", "d AS")
_RANK = "{'d': coalesce(dia, ''), 't': t, 'n': n, 'o': -row_order}"

# Edges, what they reach, the edges in no circle, what those reach; then the choice of every group, by joins of values.
P1_SURVIVORS = f"""
WITH RECURSIVE {_READ},
k AS (SELECT entidad_dedup_id FROM r GROUP BY 1 HAVING count(*) > 1),
g AS (SELECT r.* REPLACE (nullif(r.dia, '') AS dia), x.* EXCLUDE (row_order, source_id), x.source_id FROM r JOIN k USING (entidad_dedup_id) JOIN empresas_normalizado x USING (row_order)),
v AS (
  {' UNION ALL '.join(f"SELECT entidad_dedup_id, row_order, dia, t_ AS t, n, '{f}' AS f, texto, {e} AS valor FROM (SELECT entidad_dedup_id, row_order, dia, t AS t_, n, {f} AS texto, upper(strip_accents({f})) AS t FROM g WHERE {_full(f)} = 1)" for f, e in _EVOLVING.items())}),
days AS (SELECT entidad_dedup_id, f, dia, arg_max(valor, {{'t': t, 'n': n, 'o': -row_order}}) AS valor, arg_max(t, {{'t': t, 'n': n, 'o': -row_order}}) + 1 AS t FROM v WHERE dia IS NOT NULL AND valor IS NOT NULL GROUP BY ALL),
moves AS (SELECT f, lag(valor) OVER w AS a, valor AS b, t * lag(t) OVER w AS p FROM days WINDOW w AS (PARTITION BY entidad_dedup_id, f ORDER BY dia)),
mv AS (SELECT f, a, b, count(*) AS c, sum(p) AS p, sum(p * p) AS pp FROM moves WHERE a <> b GROUP BY ALL),
edge AS (
  SELECT m.f, m.a, m.b FROM mv m LEFT JOIN mv o ON m.f = o.f AND m.a = o.b AND m.b = o.a
  WHERE m.c + coalesce(o.c, 0) >= 8 AND m.p > coalesce(o.p, 0) AND (m.p - coalesce(o.p, 0)) * (m.p - coalesce(o.p, 0)) > 4 * (m.pp + coalesce(o.pp, 0))),
reach AS (SELECT f, a, b FROM edge UNION SELECT r.f, r.a, e.b FROM reach r JOIN edge e ON r.f = e.f AND r.b = e.a),
sure AS (SELECT f, a, b FROM edge e WHERE NOT EXISTS (SELECT 1 FROM reach x WHERE x.f = e.f AND x.a = e.b AND x.b = e.a)),
after AS (SELECT f, a, b FROM sure UNION SELECT r.f, r.a, e.b FROM after r JOIN sure e ON r.f = e.f AND r.b = e.a),
top AS (SELECT entidad_dedup_id, f, arg_max(valor, {_RANK}) AS valor, arg_max(texto, {_RANK}) AS texto, count(*) AS con_dia FROM v WHERE dia IS NOT NULL GROUP BY ALL),
topv AS (SELECT entidad_dedup_id, f, valor FROM (SELECT entidad_dedup_id, f, valor, row_number() OVER (PARTITION BY entidad_dedup_id, f ORDER BY dia DESC, t DESC, n DESC, row_order) AS k FROM v WHERE dia IS NOT NULL) WHERE k = 1),
undated AS (
  SELECT v.* FROM v LEFT JOIN topv ON v.entidad_dedup_id = topv.entidad_dedup_id AND v.f = topv.f
  WHERE v.dia IS NULL AND NOT EXISTS (SELECT 1 FROM v o WHERE o.entidad_dedup_id = v.entidad_dedup_id AND o.f = v.f AND o.dia IS NOT NULL AND o.valor = v.valor)
    AND (topv.f IS NULL OR EXISTS (SELECT 1 FROM after x WHERE x.f = v.f AND x.a = topv.valor AND x.b = v.valor))),
last_ AS (
  SELECT u.* FROM undated u WHERE NOT EXISTS (SELECT 1 FROM undated o JOIN after x ON x.f = u.f AND x.a = u.valor AND x.b = o.valor WHERE o.entidad_dedup_id = u.entidad_dedup_id AND o.f = u.f)),
lastv AS (SELECT entidad_dedup_id, f, texto FROM (SELECT entidad_dedup_id, f, texto, row_number() OVER (PARTITION BY entidad_dedup_id, f ORDER BY t DESC, n DESC, row_order) AS k FROM last_) WHERE k = 1),
chosen AS (SELECT entidad_dedup_id, f, coalesce(l.texto, top.texto) AS texto FROM top FULL JOIN lastv l USING (entidad_dedup_id, f)),
wide AS (SELECT entidad_dedup_id, {', '.join(f"max(texto) FILTER (f = '{f}') AS {f}" for f in _EVOLVING)} FROM chosen GROUP BY 1),
plain AS (
  SELECT entidad_dedup_id, {', '.join(f"arg_max({f}, {_RANK}) FILTER ({_full(f)} = 1) AS {f}" for f in _FIELDS if f not in _EVOLVING)},
         string_agg(DISTINCT source_id, ';' ORDER BY source_id) AS fuentes_consolidadas, count(*) AS registros, max(n) AS mn, max(coalesce(dia, '')) AS md, max(t) AS mt
  FROM g GROUP BY 1),
guide AS (SELECT g.entidad_dedup_id, min(row_order) AS guia FROM g JOIN plain p USING (entidad_dedup_id) WHERE g.n = mn AND coalesce(g.dia, '') = md AND g.t = mt GROUP BY 1)
SELECT p.* EXCLUDE (mn, md, mt), wide.* EXCLUDE (entidad_dedup_id), guia FROM plain p LEFT JOIN wide USING (entidad_dedup_id) LEFT JOIN guide USING (entidad_dedup_id)
"""
