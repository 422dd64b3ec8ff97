"""Queries on the raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cauce.operators import parse_rows
from cauce.plans.registry import Registry
from cauce.sources.tables import table

R = Registry()

# The oracle walks another way: RE2 has no look-ahead, so a bare field is spelt by its first character.
_JUDGE = r"""
WITH f AS (
  SELECT source_id, CASE WHEN delimitador IN ('\t', chr(9)) THEN '\t' WHEN delimitador = '|' THEN '\|' ELSE delimitador END AS d,
         string_split(encabezado, CASE WHEN delimitador = '\t' THEN chr(9) ELSE delimitador END) AS h
  FROM fuentes),
s AS (
  SELECT source_id, d, len(h) AS n, list_position(list_transform(h, lambda x: x IN ('NIT', 'IDENTIFICACION', 'NUMERO DE IDENTIFICACION')), true) AS ni,
         list_position(list_transform(h, lambda x: x IN ('NUMERO DE EMPLEADOS', 'EMPLEADOS', 'PERSONAL OCUPADO')), true) AS ei,
         '(?:"[^"]*(?:""[^"]*)*"|[^"' || d || '][^' || d || ']*|)' AS fld
  FROM f),
r AS (
  SELECT linea_id, r.source_id, coalesce(linea, '') AS linea, n, ni, ei, d, fld FROM registros_crudos r LEFT JOIN s USING (source_id)),
q AS (
  SELECT *, n IS NOT NULL AND regexp_full_match(linea, '(?s)' || fld || '(?:' || d || fld || ')*') AS quoted,
         n IS NOT NULL AND regexp_full_match(linea, '(?s)' || fld || repeat(d || fld, CAST(n - 1 AS BIGINT))) AS counted
  FROM r),
v AS (
  SELECT *, CASE WHEN counted THEN regexp_extract(linea, '(?s)^' || repeat(fld || d, CAST(ni - 1 AS BIGINT)) || '(' || fld || ')' || repeat(d || fld, CAST(n - ni AS BIGINT)) || '$', 1) END AS raw_nit,
            CASE WHEN counted THEN regexp_extract(linea, '(?s)^' || repeat(fld || d, CAST(ei - 1 AS BIGINT)) || '(' || fld || ')' || repeat(d || fld, CAST(n - ei AS BIGINT)) || '$', 1) END AS raw_emp
  FROM q),
u AS (
  SELECT *, trim(CASE WHEN raw_nit LIKE '"%' THEN substr(raw_nit, 2, length(raw_nit) - 2) ELSE raw_nit END) AS nit,
            trim(CASE WHEN raw_emp LIKE '"%' THEN substr(raw_emp, 2, length(raw_emp) - 2) ELSE raw_emp END) AS emp
  FROM v),
j AS (
  SELECT linea_id, source_id,
         CASE WHEN n IS NULL THEN 'columnas' WHEN NOT quoted THEN 'comillas' WHEN NOT counted THEN 'columnas'
              WHEN NOT (upper(nit) IN ('', 'N/A', 'NA', 'NO REPORTA', 'NO APLICA', 'NO REPORTADO', 'SIN DATO', '<NA>', 'NAN', 'NAT', 'NULL', 'NONE')
                        OR (regexp_full_match(nit, '[0-9. -]*') AND length(regexp_replace(nit, '[^0-9]', '', 'g')) BETWEEN 6 AND 11)) THEN 'nit'
              WHEN NOT (upper(emp) IN ('', 'N/A', 'NA', 'NO REPORTA', 'NO APLICA', 'NO REPORTADO', 'SIN DATO', '<NA>', 'NAN', 'NAT', 'NULL', 'NONE')
                        OR regexp_full_match(emp, '0*[0-9]{1,5}|0?[0-9]{1,2}[.,][0-9]{3}')) THEN 'num_empleados' END AS motivo
  FROM u)
"""


@R.query("p7_found", _JUDGE + "SELECT linea_id, motivo FROM j WHERE motivo IS NOT NULL")
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return parse_rows.rejected(table(spark, folder, "registros_crudos"), table(spark, folder, "fuentes")).select("linea_id", "motivo")


@R.query("p7_report", _JUDGE + "SELECT source_id, coalesce(motivo, 'cargado') AS motivo, count(*) AS filas FROM j GROUP BY 1, 2")
def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    return parse_rows.load_report(table(spark, folder, "registros_crudos"), table(spark, folder, "fuentes"))


_NAMES = {k: ", ".join(f"'{n}'" for n in names) for k, names in parse_rows.CANONICAL.items()}
_RAW = "CASE WHEN x{k} LIKE '\"%' THEN replace(substr(x{k}, 2, length(x{k}) - 2), '\"\"', '\"') ELSE x{k} END"
_LOADED = (
    _JUDGE
    + ", g AS (SELECT q.linea_id, q.source_id, q.linea, q.n, q.d, q.fld, list_transform(f.h, lambda x: upper(trim(x))) AS h FROM q JOIN j USING (linea_id) JOIN f ON q.source_id = f.source_id WHERE j.motivo IS NULL), "
    + "i AS (SELECT *, " + ", ".join(f"list_position(list_transform(h, lambda x: x IN ({v})), true) AS i{k}" for k, v in enumerate(_NAMES.values())) + " FROM g), "
    + "e AS (SELECT linea_id, source_id, " + ", ".join(
        f"CASE WHEN i{k} > 0 THEN regexp_extract(linea, '(?s)^' || repeat(fld || d, CAST(i{k} - 1 AS BIGINT)) || '(' || fld || ')' || repeat(d || fld, CAST(n - i{k} AS BIGINT)) || '$', 1) END AS x{k}" for k in range(len(_NAMES))
    ) + " FROM i) "
    + "SELECT linea_id, source_id, " + ", ".join(f"nullif(trim({_RAW.format(k=k)}), '') AS {name}" for k, name in enumerate(_NAMES)) + " FROM e"
)

# A field's own rule is spelt out where it has one; the first prefix that fails ends at the broken field.
_BROKEN = (
    _JUDGE
    + ", ws AS (SELECT source_id, '[ ' || CASE WHEN d = '\\t' THEN '' ELSE '\\t' END || '\\n\\r\\f\\x0b]*' AS w FROM f), "
    + "rules AS (SELECT source_id, w || '(?i:|N/A|NA|NO +REPORTA|NO +APLICA|NO +REPORTADO|SIN +DATO|<NA>|NAN|NAT|NULL|NONE)' || w AS none, w || '[. -]*(?:[0-9][. -]*){6,11}' || w AS nit, w || '(?:0*[0-9]{1,5}|0?[0-9]{1,2}[.,][0-9]{3})' || w AS emp FROM ws), "
    + f"flds AS (SELECT f.source_id, f.d, f.h, list_transform(f.h, lambda x: CASE WHEN upper(trim(x)) IN ({_NAMES['nit']}) THEN '(?:\"(?:' || none || '|' || nit || ')\"|(?:' || none || '|' || nit || '))' WHEN upper(trim(x)) IN ({_NAMES['num_empleados']}) THEN '(?:\"(?:' || none || '|' || emp || ')\"|(?:' || none || '|' || emp || '))' ELSE s.fld END) AS p FROM f JOIN s USING (source_id) JOIN rules USING (source_id)), "
    + "b AS (SELECT j.linea_id, j.source_id, j.motivo, q.linea, x.d, x.h, x.p FROM j JOIN q USING (linea_id) LEFT JOIN flds x ON j.source_id = x.source_id WHERE j.motivo IS NOT NULL), "
    + "k AS (SELECT *, list_filter(range(1, len(h) + 1), lambda k: NOT regexp_matches(linea, '(?s)^' || list_reduce(p[1:k], lambda a, b: a || d || b) || CASE WHEN k < len(h) THEN d ELSE '$' END))[1] AS roto FROM b) "
    + "SELECT linea_id, source_id, motivo, trim(h[roto]) AS campo_roto FROM k"
)


@R.query("p7_loaded", _LOADED)
def p7_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return parse_rows.loaded(table(spark, folder, "registros_crudos"), table(spark, folder, "fuentes"))


@R.query("p7_broken_field", _BROKEN)
def p7_broken_field(spark: SparkSession, folder: str) -> DataFrame:
    return parse_rows.rejected(table(spark, folder, "registros_crudos"), table(spark, folder, "fuentes"))
