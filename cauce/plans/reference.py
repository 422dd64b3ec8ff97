"""Queries for normalisation, deduplication, enrichment, exclusion, ranking and reports, each with its SQL.

The SQL is written apart from the operators: windows where they aggregate, string functions where they use
patterns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions import registry as reg
from cauce.functions import text as tx
from cauce.functions.dates import typed_day
from cauce.functions.similarity import token_sort_ratio
from cauce.operators import dedup, enrich, exclude, normalise, rank, reports
from cauce.plans.registry import Registry
from cauce.sources import files
from cauce.sources.tables import table
from cauce.streaming.messages import once, with_entities

R = Registry()
N, G, E, X, S, I, M = "empresas_normalizado", "grupos_deduplicacion", "empresas_deduplicado", "empresas_con_exclusion", "empresas_scored", "claves_internas", "municipios_referencia"

_NULLS = "('', 'N/A', 'NA', 'NO REPORTA', 'NO APLICA', 'NO REPORTADO', 'SIN DATO', '<NA>', 'NAN', 'NAT')"


def _sq(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _cmp(c: str) -> str:
    t = _sq(f"upper(strip_accents({c}))")
    return f"CASE WHEN {t} NOT IN {_NULLS} THEN {t} END"


def _dig(c: str) -> str:
    return f"nullif(regexp_replace({c}, '[^0-9]', '', 'g'), '')"


def _ok(c: str) -> str:
    """SQL: the identifier unless it is a stand-in (no back references in RE2)."""
    return f"CASE WHEN {c} <> '' AND NOT ({c}[1] BETWEEN '0' AND '9' AND replace({c}, {c}[1], '') = '') THEN {c} END"


def _sorted_words(c: str) -> str:
    return f"array_to_string(list_sort(string_split({_sq(c)}, ' ')), ' ')"


def _ratio(source: str, keep: str) -> str:
    """SQL: 200 * LCS / lengths of the columns ``a`` and ``b`` of ``source`` (up to 126 characters), by bits of a 128-bit number."""
    masks = "list_transform(string_split(b, ''), lambda ch: coalesce(list_sum(list_transform(range(length(a)), lambda i: CASE WHEN substr(a, CAST(i + 1 AS BIGINT), 1) = ch THEN CAST(1 AS HUGEINT) << CAST(i AS HUGEINT) ELSE CAST(0 AS HUGEINT) END)), 0))"
    return (
        f"SELECT {keep}, CASE WHEN a = '' AND b = '' THEN 100.0 WHEN a = '' OR b = '' THEN 0.0 ELSE 200.0 * (length(a) - bit_count(list_reduce(list_prepend(lleno, masks), lambda r, m: ((r + (r & m)) | (r - (r & m))) & lleno))) / (length(a) + length(b)) END AS ratio "
        f"FROM (SELECT *, (CAST(1 AS HUGEINT) << CAST(length(a) AS HUGEINT)) - 1 AS lleno, CAST({masks} AS HUGEINT[]) AS masks FROM {source})"
    )


# ---- sources ----


# sources whose files have one and the same header count as declared duplicates of the first of them
_SOURCES = "f AS (SELECT *, nullif(min(source_id) OVER (PARTITION BY delimitador, encabezado), source_id) AS duplicado_de FROM fuentes), z AS (SELECT source_id, CAST(sum(length(linea)) AS BIGINT) AS tamano_bytes FROM registros_crudos GROUP BY 1)"
_SMALL_LIMIT = 20_000


def _catalogue(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "fuentes")
    first = own.groupBy("delimitador", "encabezado").agg(F.min("source_id").alias("_first"))
    sizes = table(spark, d, "registros_crudos").groupBy("source_id").agg(F.sum(F.length("linea")).alias("tamano_bytes"))
    return own.join(first, ["delimitador", "encabezado"]).withColumn("duplicado_de", F.nullif("_first", "source_id")).drop("_first").join(sizes, "source_id", "left")


@R.query("ing1_sources", f"WITH {_SOURCES} SELECT source_id, archivo, duplicado_de FROM f WHERE categoria = 'sectorial' AND duplicado_de IS NULL")
def ing1(spark: SparkSession, d: str) -> DataFrame:
    return files.listed(_catalogue(spark, d), "sectorial").select("source_id", "archivo", "duplicado_de")


@R.query(
    "ing2_triage",
    f"WITH {_SOURCES} SELECT f.source_id, CASE WHEN coalesce(categoria = 'nacional', false) OR coalesce(tamano_bytes > {_SMALL_LIMIT}, false) THEN 'excluido_nacional' WHEN duplicado_de IS NOT NULL THEN 'omitido_duplicado' ELSE 'ingerir' END AS tratamiento FROM f LEFT JOIN z USING (source_id)",
)
def ing2(spark: SparkSession, d: str) -> DataFrame:
    return files.triage(_catalogue(spark, d), largest=_SMALL_LIMIT).select("source_id", "tratamiento")


@R.query("ing13_same_content", "SELECT sha256(encabezado) AS sha256, string_agg(source_id, ';' ORDER BY source_id) AS fuentes FROM fuentes GROUP BY 1 HAVING count(*) > 1")
def ing13(spark: SparkSession, d: str) -> DataFrame:
    hashes = table(spark, d, "fuentes").select("source_id", F.sha2("encabezado", 256).alias("sha256"))
    return files.same_files(hashes).select("sha256", F.array_join("fuentes", ";").alias("fuentes"))


@R.query("ing13_declared", f"WITH {_SOURCES} SELECT duplicado_de AS original, string_agg(source_id, ';' ORDER BY source_id) AS copias FROM f WHERE duplicado_de IS NOT NULL GROUP BY 1")
def ing13_declared(spark: SparkSession, d: str) -> DataFrame:
    return files.declared_duplicates(_catalogue(spark, d)).select("original", F.array_join("copias", ";").alias("copias"))


@R.query(
    "ing15_summary",
    f"WITH {_SOURCES}, t AS (SELECT CASE WHEN coalesce(categoria = 'nacional', false) OR coalesce(tamano_bytes > {_SMALL_LIMIT}, false) THEN 'excluido_nacional' WHEN duplicado_de IS NOT NULL THEN 'omitido_duplicado' ELSE 'ingerir' END AS tratamiento, tamano_bytes FROM f LEFT JOIN z USING (source_id)) "
    "SELECT tratamiento, count(*) AS fuentes, CAST(sum(tamano_bytes) AS BIGINT) AS bytes FROM t GROUP BY 1",
)
def ing15(spark: SparkSession, d: str) -> DataFrame:
    return files.treatment_summary(_catalogue(spark, d), largest=_SMALL_LIMIT)


# ---- cleansing ----


@R.query("nrm1_accents", f"SELECT row_order, strip_accents(razon_social) AS v FROM {N}")
def nrm1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N, "row_order", "razon_social").select("row_order", tx.strip_accents(F.col("razon_social")).alias("v"))


@R.query("nrm2_comparison_text", f"SELECT row_order, {_cmp('razon_social')} AS nombre, {_cmp('barrio_comercial')} AS barrio FROM {N}")
def nrm2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", tx.comparison_text(F.col("razon_social")).alias("nombre"), tx.comparison_text(F.col("barrio_comercial")).alias("barrio"))


@R.query("nrm3_tax_id", f"SELECT row_order, {_dig('nit')} AS nit FROM {N}")
def nrm3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", tx.digits(F.col("nit")).alias("nit"))


@R.query("nrm4_phone", f"SELECT row_order, " + ", ".join(f"CASE WHEN {_cmp(f'telefono_comercial_{i}')} IS NOT NULL THEN {_dig(f'telefono_comercial_{i}')} END AS telefono_{i}" for i in (1, 2, 3)) + f" FROM {N}")
def nrm4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", *[tx.phone(F.col(f"telefono_comercial_{i}")).alias(f"telefono_{i}") for i in (1, 2, 3)])


@R.query("nrm5_email", f"SELECT row_order, CASE WHEN {_cmp('email_comercial')} IS NOT NULL AND position('@' IN email_comercial) > 0 THEN lower(trim(email_comercial)) END AS correo FROM {N}")
def nrm5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", tx.email(F.col("email_comercial")).alias("correo"))


@R.query("nrm6_declared_null", "SELECT row_order, " + ", ".join(f"{_cmp(c)} IS NULL AS sin_{c}" for c in ("nit", "email_comercial", "representante_legal", "tamano_empresa")) + f" FROM {N}")
def nrm6(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", *[tx.comparison_text(F.col(c)).isNull().alias(f"sin_{c}") for c in ("nit", "email_comercial", "representante_legal", "tamano_empresa")])


@R.query("nrm7_light_clean", f"SELECT row_order, CASE WHEN {_cmp('direccion_comercial')} IS NOT NULL THEN {_sq('direccion_comercial')} END AS v FROM {N}")
def nrm7(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", tx.light_clean(F.col("direccion_comercial")).alias("v"))


_PARTS = f"""
p AS (SELECT *, position(' - ' IN municipio_comercial) AS k FROM {N}),
q AS (SELECT *, k > 0 AND regexp_full_match(trim(substr(municipio_comercial, 1, k - 1)), '[0-9]+') AS coded FROM p),
r AS (SELECT *, CASE WHEN coded THEN trim(substr(municipio_comercial, 1, k - 1)) END AS codigo, CASE WHEN coded THEN substr(municipio_comercial, k + 3) ELSE municipio_comercial END AS resto FROM q),
places AS (SELECT row_order, source_id, codigo, {_cmp('resto')} AS nombre FROM r)
"""


def _places(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", "source_id", tx.place_parts(F.col("municipio_comercial")).alias("p")).select("row_order", "source_id", "p.codigo", "p.nombre")


@R.query("nrm8_place_parts", f"WITH {_PARTS} SELECT row_order, codigo, nombre FROM places")
def nrm8(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d).drop("source_id")


@R.query("nrm12_first_filled", f"SELECT row_order, coalesce(nullif(trim(telefono_comercial_3), ''), nullif(trim(telefono_comercial_2), ''), nullif(trim(telefono_comercial_1), '')) AS telefono FROM {N}")
def nrm12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", normalise.first_filled(*[F.col(f"telefono_comercial_{i}") for i in (3, 2, 1)]).alias("telefono"))


@R.query("nrm13_ambiguous_place", f"WITH {_PARTS} SELECT source_id, nombre, count(DISTINCT codigo) AS codigos, count(DISTINCT codigo) > 1 AS ambiguo FROM places WHERE codigo IS NOT NULL AND nombre IS NOT NULL GROUP BY 1, 2")
def nrm13(spark: SparkSession, d: str) -> DataFrame:
    return enrich.ambiguous_places(_places(spark, d), "source_id")


@R.query("nrm14_derived", f"WITH {_PARTS} SELECT n.row_order, {_cmp('razon_social')} AS nombre, codigo, nombre AS lugar, coalesce(trim(nit), '') = '' AND coalesce(trim(razon_social), '') = '' AS sin_identificador FROM {N} n JOIN places USING (row_order)")
def nrm14(spark: SparkSession, d: str) -> DataFrame:
    out = normalise.derived(table(spark, d, N).drop("razon_social_normalizada", "municipio_codigo_dane_extraido", "municipio_nombre_normalizado", "sin_identificador"))
    return out.select("row_order", F.col("razon_social_normalizada").alias("nombre"), F.col("municipio_codigo_dane_extraido").alias("codigo"), F.col("municipio_nombre_normalizado").alias("lugar"), "sin_identificador")


@R.query("nrm15_union", f"SELECT 'entidad' AS origen, razon_social, nit, CAST(NULL AS VARCHAR) AS correo FROM {E} UNION ALL SELECT 'interna', razon_social, nit, correo FROM {I}")
def nrm15(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, E, "razon_social", "nit").withColumn("origen", F.lit("entidad"))
    return normalise.union_sources([a, table(spark, d, I, "razon_social", "nit", "correo").withColumn("origen", F.lit("interna"))])


@R.query("nrm16_quality", f"SELECT source_id, count(*) AS filas, count(*) FILTER (coalesce(trim(nit), '') = '' AND coalesce(trim(razon_social), '') = '') AS sin_identificador, count(municipio_codigo_dane_extraido) AS con_codigo, count(nit) AS con_nit, count(email_comercial) AS con_email_comercial FROM {N} GROUP BY 1")
def nrm16(spark: SparkSession, d: str) -> DataFrame:
    return normalise.quality(table(spark, d, N), ["nit", "email_comercial"])


def _day(c: str) -> str:
    f = f"regexp_replace(trim({c}), ' [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$', '')"
    parts = f"regexp_extract({f}, '[0-9]{{4}}$') || '-' || lpad(%s, 2, '0') || '-' || lpad(regexp_extract({f}, '^[0-9]+'), 2, '0')"
    number = f"regexp_extract({f}, '^[0-9]+[/.-]([0-9]+)', 1)"
    word = f"CAST((position(regexp_extract({f}, '[a-z]{{3}}') IN 'ene feb mar abr may jun jul ago sep oct nov dic') + 3) // 4 AS VARCHAR)"
    return (
        f"CAST(try_cast(CASE WHEN regexp_full_match({f}, '[0-9]{{8}}') THEN substr({f}, 1, 4) || '-' || substr({f}, 5, 2) || '-' || substr({f}, 7, 2) WHEN regexp_full_match({f}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN {f} "
        f"WHEN regexp_full_match({f}, '[0-9]{{1,2}}[/.-][0-9]{{1,2}}[/.-][0-9]{{4}}') THEN {parts % number} WHEN regexp_full_match({f}, '[0-9]{{1,2}} [a-z]{{3}} [0-9]{{4}}') THEN {parts % word} END AS DATE) AS VARCHAR)"
    )


@R.query("dates_typed", f"SELECT row_order, {_day('fecha_matricula')} AS matricula, {_day('fecha_renovacion')} AS renovacion, {_day('fecha_constitucion')} AS constitucion FROM {N}")
def dates_typed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", *[typed_day(F.col(f"fecha_{c}")).cast("string").alias(c) for c in ("matricula", "renovacion", "constitucion")])


# ---- deduplication ----

_FULL = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in dedup.FIELDS)
_KEYS = f"""
k AS (SELECT n.*, {_ok('nit')} AS nk, {_ok('matricula')} AS mk, coalesce(f.camara_grupo, n.source_id) AS cam, municipio_nombre_normalizado AS mun, {_FULL} AS full_
      FROM {N} n LEFT JOIN fuentes f ON n.source_id = f.source_id),
a AS (SELECT *, count(DISTINCT mun) OVER (PARTITION BY nk) AS seats, count(*) OVER (PARTITION BY nk) AS n_id, count(*) OVER (PARTITION BY nk, mun) AS n_seat FROM k),
b AS (SELECT *, CASE WHEN nk IS NULL THEN NULL WHEN seats <= 1 AND n_id > 1 THEN 'nit' WHEN seats > 1 AND mun IS NOT NULL AND n_seat > 1 THEN 'nit_multisede' END AS m1 FROM a),
c AS (SELECT *, count(*) FILTER (m1 IS NULL) OVER (PARTITION BY mk, cam) AS n_mat FROM b),
g AS (SELECT *, coalesce(m1, CASE WHEN mk IS NOT NULL AND n_mat > 1 THEN 'matricula_camara' END, 'sin_consolidar') AS metodo FROM c),
h AS (SELECT *, CASE metodo WHEN 'nit' THEN 'N|' || nk WHEN 'nit_multisede' THEN 'M|' || nk || '|' || mun WHEN 'matricula_camara' THEN 'C|' || mk || '|' || cam ELSE 'R|' || CAST(row_order AS VARCHAR) END AS clave FROM g),
o AS (SELECT *, min(row_order) OVER (PARTITION BY clave) AS first_, count(*) OVER (PARTITION BY clave) AS tam FROM h),
e AS (SELECT *, 'ENT-' || lpad(CAST(dense_rank() OVER (ORDER BY first_) AS VARCHAR), 7, '0') AS ent, CASE WHEN metodo IN ('nit', 'nit_multisede') THEN 'alta' WHEN metodo = 'matricula_camara' THEN 'media_alta' END AS conf FROM o)
"""


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keyed(table(spark, d, N), table(spark, d, "fuentes"))


@R.query("ded1_placeholder", f"SELECT row_order, {_ok('nit')} IS NULL AS nit_relleno, {_ok('matricula')} IS NULL AS matricula_relleno FROM {N}")
def ded1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", tx.placeholder_id(F.col("nit")).alias("nit_relleno"), tx.placeholder_id(F.col("matricula")).alias("matricula_relleno"))


@R.query("ded2_business_key", f"SELECT row_order, CASE WHEN length({_dig('nit')}) >= 6 THEN 'nit:' || {_dig('nit')} ELSE 'razon_municipio:' || coalesce({_cmp('razon_social')}, '') || '|' || coalesce({_cmp('municipio_comercial')}, '') END AS clave, CASE WHEN length({_dig('nit')}) >= 6 THEN 'nit' ELSE 'razon_municipio' END AS metodo FROM {N}")
def ded2(spark: SparkSession, d: str) -> DataFrame:
    key = dedup.business_key(F.col("nit"), F.col("razon_social"), F.col("municipio_comercial"))
    return table(spark, d, N).select("row_order", key.alias("k")).select("row_order", "k.clave", "k.metodo")


@R.query("ded4_keys", f"WITH {_KEYS} SELECT row_order, nk AS nit_valido, mk AS matricula_valida, cam AS camara, mun AS municipio, full_ AS completitud FROM k")
def ded4(spark: SparkSession, d: str) -> DataFrame:
    return _keyed(spark, d)


@R.query("ded5_merged_keys", f"WITH {_KEYS} SELECT row_order, CASE WHEN metodo <> 'sin_consolidar' THEN clave END AS clave, metodo AS metodo_deduplicacion, conf AS confianza_deduplicacion FROM e")
def ded5(spark: SparkSession, d: str) -> DataFrame:
    return dedup.merged_keys(_keyed(spark, d))


@R.query("ded11_entities", f"WITH {_KEYS} SELECT row_order, ent AS entidad_dedup_id, tam AS tamano_grupo, metodo AS metodo_deduplicacion, conf AS confianza_deduplicacion FROM e")
def ded11(spark: SparkSession, d: str) -> DataFrame:
    return dedup.entities(_keyed(spark, d))


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).join(table(spark, d, G, "row_order", "entidad_dedup_id", "metodo_deduplicacion", "confianza_deduplicacion"), "row_order")


@R.query("ded12_master_flag", f"SELECT row_order, row_number() OVER (PARTITION BY entidad_dedup_id ORDER BY full_ DESC, row_order) = 1 AS es_registro_maestro FROM (SELECT n.row_order, g.entidad_dedup_id, {_FULL} AS full_ FROM {N} n JOIN {G} g USING (row_order))")
def ded12(spark: SparkSession, d: str) -> DataFrame:
    return dedup.master_flags(_grouped(spark, d).select("row_order", "entidad_dedup_id", dedup.completeness().alias("completitud")))


_MASTER = ", ".join(f"arg_min({c}, {{'a': -full_, 'b': row_order}}) FILTER ({c} IS NOT NULL) AS {c}" for c in [*dedup.LINEAGE, *dedup.FIELDS])
_CONFLICT = " || ".join(f"CASE WHEN count(DISTINCT {c}) > 1 THEN '{c};' ELSE '' END" for c in dedup.FIELDS)


@R.query(
    "ded13_masters",
    f"WITH j AS (SELECT n.*, g.entidad_dedup_id AS ent, g.metodo_deduplicacion AS met, g.confianza_deduplicacion AS conf, {_FULL} AS full_ FROM {N} n JOIN {G} g USING (row_order)) "
    f"SELECT ent AS entidad_dedup_id, {_MASTER}, count(DISTINCT source_id) AS numero_fuentes_consolidadas, string_agg(DISTINCT source_id, ';' ORDER BY source_id) AS fuentes_consolidadas, count(*) AS registros_consolidados, "
    f"arg_min(met, row_order) AS metodo_deduplicacion, arg_min(conf, row_order) FILTER (conf IS NOT NULL) AS confianza_deduplicacion, rtrim({_CONFLICT}, ';') AS campos_en_conflicto FROM j GROUP BY ent",
)
def ded13(spark: SparkSession, d: str) -> DataFrame:
    return dedup.masters(_grouped(spark, d))


@R.query(
    "ded15_conflicts",
    f"WITH j AS (SELECT g.entidad_dedup_id, {', '.join('n.' + c for c in dedup.FIELDS)} FROM {N} n JOIN {G} g USING (row_order)), "
    f"l AS ({' UNION ALL '.join(f"SELECT entidad_dedup_id, '{c}' AS campo, CAST({c} AS VARCHAR) AS v FROM j" for c in dedup.FIELDS)}) "
    "SELECT entidad_dedup_id, campo, v AS valor, filas FROM (SELECT *, count(*) OVER (PARTITION BY entidad_dedup_id, campo) AS k FROM (SELECT entidad_dedup_id, campo, v, count(*) AS filas FROM l WHERE v IS NOT NULL GROUP BY 1, 2, 3)) WHERE k > 1",
)
def ded15(spark: SparkSession, d: str) -> DataFrame:
    """The conflicts of every canonical field."""
    # an entity of one row has no conflict: most rows need not be taken apart into fields
    members = table(spark, d, G, "row_order", "entidad_dedup_id")
    several = members.groupBy("entidad_dedup_id").agg(F.count("*").alias("n")).filter("n > 1").select("entidad_dedup_id")
    grouped = table(spark, d, N).join(members.join(several, "entidad_dedup_id", "left_semi"), "row_order")
    return dedup.conflict_values(grouped)


def _open(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).join(table(spark, d, G, "row_order", "metodo_deduplicacion").filter("metodo_deduplicacion = 'sin_consolidar'"), "row_order")


_OPEN = f"SELECT n.* FROM {N} n JOIN {G} g USING (row_order) WHERE g.metodo_deduplicacion = 'sin_consolidar' AND n.razon_social_normalizada IS NOT NULL AND n.municipio_nombre_normalizado IS NOT NULL"


@R.query(
    "ded7_name_place",
    f"WITH o AS ({_OPEN}), c AS (SELECT razon_social_normalizada, municipio_nombre_normalizado, count(*) AS filas, min(row_order) AS f, "
    "(count(direccion_comercial) = count(*) AND count(DISTINCT direccion_comercial) = 1) OR (count(telefono_comercial_1) = count(*) AND count(DISTINCT telefono_comercial_1) = 1) OR (count(email_comercial) = count(*) AND count(DISTINCT email_comercial) = 1) AS ok "
    "FROM o GROUP BY 1, 2 HAVING count(*) > 1) SELECT 'CAND-RSMUN-' || lpad(CAST(row_number() OVER (ORDER BY f) AS VARCHAR), 6, '0') AS grupo, razon_social_normalizada, municipio_nombre_normalizado, filas, CASE WHEN ok THEN 'media' ELSE 'baja' END AS confianza FROM c",
)
def ded7(spark: SparkSession, d: str) -> DataFrame:
    return dedup.name_place_candidates(_open(spark, d))


@R.query("ded8_blocks", f"SELECT municipio_nombre_normalizado, substr(razon_social_normalizada, 1, 4) AS prefijo, count(*) AS filas FROM ({_OPEN}) GROUP BY 1, 2")
def ded8_blocks(spark: SparkSession, d: str) -> DataFrame:
    return dedup.name_blocks(_open(spark, d))


def _stars(source: str) -> str:
    """SQL: greedy stars of similar names among the open rows of ``source``; one step takes one anchor of every block."""
    return (
        f"so AS ({source}), sc AS (SELECT razon_social_normalizada, municipio_nombre_normalizado FROM so GROUP BY 1, 2 HAVING count(*) > 1), sf AS (SELECT so.row_order, so.municipio_nombre_normalizado AS mun, substr(so.razon_social_normalizada, 1, 4) AS pre, {_sorted_words('so.razon_social_normalizada')} AS t "
        "FROM so WHERE (so.razon_social_normalizada, so.municipio_nombre_normalizado) NOT IN (SELECT (razon_social_normalizada, municipio_nombre_normalizado) FROM sc)), "
        "sk AS (SELECT mun, pre, list(row_order ORDER BY row_order) AS filas, min(row_order) AS bloque FROM sf GROUP BY 1, 2 HAVING count(*) BETWEEN 2 AND 300), "
        "sp AS (SELECT x.row_order AS i, y.row_order AS j, x.t AS a, y.t AS b FROM sf x JOIN sf y ON x.mun = y.mun AND x.pre = y.pre AND x.row_order < y.row_order JOIN sk ON sk.mun = x.mun AND sk.pre = x.pre), "
        f"sr AS ({_ratio('sp', 'i, j')}), sn AS (SELECT i, list(j) AS cerca FROM sr WHERE ratio >= 85 GROUP BY 1), "
        "sw AS (SELECT mun, pre, bloque, filas, CAST(NULL AS BIGINT) AS ancla, CAST([] AS BIGINT[]) AS grupo FROM sk UNION ALL "
        "SELECT sw.mun, sw.pre, sw.bloque, list_filter(sw.filas[2:], lambda j: NOT list_contains(coalesce(sn.cerca, []), j)), sw.filas[1], list_filter(sw.filas[2:], lambda j: list_contains(coalesce(sn.cerca, []), j)) FROM sw LEFT JOIN sn ON sn.i = sw.filas[1] WHERE len(sw.filas) > 0), "
        "stars AS (SELECT mun, pre, bloque, ancla, list_prepend(ancla, grupo) AS grupo FROM sw WHERE len(grupo) > 0)"
    )


@R.query("ded8_fuzzy", f"WITH RECURSIVE {_stars(_OPEN)} SELECT unnest(grupo) AS row_order, 'CAND-FUZZY-' || lpad(CAST(dense_rank() OVER (ORDER BY bloque, ancla) AS VARCHAR), 6, '0') AS grupo, ancla, 'fuzzy_razon_social' AS metodo, 'baja' AS confianza FROM stars")
def ded8(spark: SparkSession, d: str) -> DataFrame:
    open_rows = _open(spark, d)
    grouped = dedup.name_place_candidates(open_rows).select("razon_social_normalizada", "municipio_nombre_normalizado")
    return dedup.fuzzy_candidates(open_rows.join(grouped, ["razon_social_normalizada", "municipio_nombre_normalizado"], "left_anti"))


@R.query(
    "ded9_ratio_merged",
    f"WITH p AS (SELECT n.row_order, {_sorted_words('n.razon_social_normalizada')} AS a, {_sorted_words(_cmp('e.razon_social'))} AS b FROM {N} n JOIN {G} g USING (row_order) JOIN {E} e ON g.entidad_dedup_id = e.entidad_dedup_id WHERE n.razon_social_normalizada IS NOT NULL), "
    f"u AS (SELECT DISTINCT a, b FROM p WHERE b IS NOT NULL), r AS ({_ratio('u', 'a, b')}) SELECT row_order, ratio FROM p LEFT JOIN r USING (a, b)",
)
def ded9_merged(spark: SparkSession, d: str) -> DataFrame:
    """Every row's name against the merged name of its entity."""
    own = table(spark, d, N, "row_order", F.col("razon_social_normalizada").alias("a")).filter("a is not null").join(table(spark, d, G, "row_order", "entidad_dedup_id"), "row_order")
    merged = table(spark, d, E, "entidad_dedup_id", tx.comparison_text(F.col("razon_social")).alias("b"))
    return own.join(merged, "entidad_dedup_id").select("row_order", token_sort_ratio(F.col("a"), F.col("b")).alias("ratio"))


@R.query(
    "ded16_stats",
    f"WITH {_KEYS} SELECT metodo AS metodo_deduplicacion, count(*) AS filas, count(DISTINCT ent) AS entidades FROM e GROUP BY 1",
)
def ded16(spark: SparkSession, d: str) -> DataFrame:
    return reports.merge_summary(dedup.entities(_keyed(spark, d)))


# ---- enrichment ----

_SECTION = "CASE seccion " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.SECTIONS.items()) + " END"
_EXACT = "CASE codigo " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.EXACT_CODES.items()) + " END"
_SECTION_FIT = "CASE seccion " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.SECTION_FIT.items()) + " END"
_EXACT_FIT = "CASE codigo " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.EXACT_FIT.items()) + " END"


@R.query("enr1_sector", f"WITH c AS (SELECT row_order, nullif(regexp_extract(upper(trim(ciiu_1)), '^[A-Z][0-9]{{3,4}}'), '') AS codigo FROM {N}), s AS (SELECT *, codigo[1] AS seccion FROM c) SELECT row_order, nullif(s.seccion, '') AS seccion, codigo, coalesce({_EXACT}, {_SECTION}) AS sector, coalesce({_EXACT_FIT}, {_SECTION_FIT}) AS encaje, CASE WHEN coalesce(ciiu_1, '') = '' THEN 'Sin código CIIU' WHEN codigo IS NULL THEN 'No se reconoce el formato CIIU: ''' || substr(upper(trim(ciiu_1)), 1, 20) || '''' WHEN coalesce({_EXACT}, {_SECTION}) IS NULL THEN 'Sección CIIU ''' || seccion || ''' no mapeada' END AS nota FROM s JOIN {N} n USING (row_order)")
def enr1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", reg.activity(F.col("ciiu_1")).alias("a")).select("row_order", "a.*")


_SIZES = "CASE " + _cmp("tamano_empresa") + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reg.DECLARED_SIZES.items()) + " END"


@R.query(
    "enr2_size",
    f"WITH a AS (SELECT row_order, {_SIZES} AS dec, CASE WHEN regexp_full_match(trim(num_empleados), '[+-]?[0-9]{{1,18}}') THEN CAST(trim(num_empleados) AS BIGINT) END AS n FROM {N}) "
    "SELECT row_order, CASE WHEN dec IS NOT NULL THEN dec WHEN n IS NULL THEN 'sin_dato' WHEN n <= 10 THEN 'micro' WHEN n <= 50 THEN 'pequeña' WHEN n <= 200 THEN 'mediana' ELSE 'grande' END AS tamano, "
    "CASE WHEN dec IS NOT NULL THEN 'declarado_por_fuente' WHEN n IS NULL THEN 'sin_senal_disponible' ELSE 'inferido_por_empleados' END AS metodo, CASE WHEN dec IS NOT NULL THEN 'confirmado' ELSE 'inferido' END AS confianza FROM a",
)
def enr2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", reg.company_size(F.col("tamano_empresa"), F.col("num_empleados")).alias("a")).select("row_order", "a.*")


@R.query("enr3_source_trust", f"SELECT n.source_id, coalesce(f.nivel_confianza_fuente, 'desconocido') AS nivel, count(*) AS filas FROM {N} n LEFT JOIN fuentes f USING (source_id) GROUP BY 1, 2")
def enr3(spark: SparkSession, d: str) -> DataFrame:
    return enrich.source_trust(table(spark, d, N, "source_id"), table(spark, d, "fuentes"))


@R.query(
    "enr4_repaired_codes",
    f"WITH c AS (SELECT DISTINCT ciiu_1 FROM {N}), ref AS (SELECT DISTINCT regexp_extract(ciiu_1, '^[A-Z]([0-9]{{3,4}})', 1) AS dg, ciiu_1[1] AS l FROM c WHERE regexp_matches(ciiu_1, '^[A-Z][0-9]{{3,4}}') AND position('NO LOCALIZADO' IN ciiu_1) = 0), "
    "x AS (SELECT ciiu_1, trim(replace(replace(ciiu_1, ',', ''), '.', '')) AS limpio, ciiu_1 IS NOT NULL AND NOT regexp_matches(ciiu_1, '^[A-Z]') AS cand FROM c), "
    "y AS (SELECT x.*, regexp_full_match(limpio, '[0-9]{3,4}') AS num, (SELECT count(DISTINCT l) FROM ref WHERE dg = limpio OR dg = coalesce(nullif(ltrim(limpio, '0'), ''), '0')) AS k, (SELECT min(l) FROM ref WHERE dg = limpio OR dg = coalesce(nullif(ltrim(limpio, '0'), ''), '0')) AS l FROM x), "
    "z AS (SELECT *, CASE WHEN NOT cand OR ciiu_1 IS NULL THEN 'no_aplica' WHEN position('NO LOCALIZADO' IN ciiu_1) > 0 THEN 'invalido_marcado_por_fuente' WHEN NOT num THEN 'formato_no_reconocido' WHEN limpio = '9999' THEN 'placeholder_9999_excluido' "
    "WHEN k = 0 THEN 'sin_evidencia_no_reconstruido' WHEN k > 1 THEN 'ambiguo_no_reconstruido' ELSE 'reconstruido_inequivoco' END AS estado FROM y) SELECT ciiu_1, estado, CASE WHEN estado = 'reconstruido_inequivoco' THEN l || limpio END AS reconstruido FROM z",
)
def enr4(spark: SparkSession, d: str) -> DataFrame:
    return enrich.repaired_codes(table(spark, d, N, "ciiu_1"))


@R.query("enr6_employees", f"SELECT row_order, CASE WHEN NOT coalesce(regexp_full_match(num_empleados, '0*[1-9][0-9]{{5,}}'), false) THEN num_empleados END AS valor, coalesce(regexp_full_match(num_empleados, '0*[1-9][0-9]{{5,}}'), false) AS anomalo FROM {N}")
def enr6(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", reg.plausible_employees(F.col("num_empleados")).alias("a")).select("row_order", "a.*")


@R.query("enr7_unmapped_codes", f"SELECT ciiu_1, count(*) AS filas FROM {N} WHERE ciiu_1 IS NOT NULL AND NOT regexp_matches(upper(trim(ciiu_1)), '^[A-Z][0-9]{{3,4}}') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def enr7(spark: SparkSession, d: str) -> DataFrame:
    none = table(spark, d, N, "ciiu_1").filter(F.col("ciiu_1").isNotNull() & reg.activity(F.col("ciiu_1"))["sector"].isNull())
    return none.groupBy("ciiu_1").agg(F.count("*").alias("filas")).orderBy(F.desc("filas"), "ciiu_1").limit(20)


@R.query("enr8_global_places", f"WITH {_PARTS} SELECT nombre, count(DISTINCT codigo) AS codigos, count(DISTINCT codigo) > 1 AS ambiguo FROM places WHERE codigo IS NOT NULL AND nombre IS NOT NULL GROUP BY 1")
def enr8(spark: SparkSession, d: str) -> DataFrame:
    return enrich.ambiguous_places(_places(spark, d))


# ---- exclusion ----

_INT = f"""
i AS (SELECT internal_order, fuente_interna, {_ok(_dig('nit'))} AS nit_valido, {_ok('trim(matricula)')} AS matricula_valida, {_cmp('razon_social')} AS nombre,
      {_cmp("CASE WHEN regexp_matches(municipio, '^ *[0-9]+ * - ') THEN regexp_replace(municipio, '^ *[0-9]+ * - ', '') ELSE municipio END")} AS lugar, tipo_antecedente, fecha_referencia FROM {I})
"""


@R.query("exc4_internal_keys", f"WITH {_INT} SELECT * REPLACE (CAST(epoch(fecha_referencia) AS BIGINT) AS fecha_referencia) FROM i")
def exc4(spark: SparkSession, d: str) -> DataFrame:
    return exclude.internal_keys(table(spark, d, I)).withColumn("fecha_referencia", F.unix_timestamp("fecha_referencia"))


@R.query("exc7_key_stats", f"WITH {_INT} SELECT fuente_interna, count(*) AS filas, count(nit_valido) AS con_nit, count(matricula_valida) AS con_matricula, count(nombre) AS con_nombre FROM i GROUP BY 1")
def exc7(spark: SparkSession, d: str) -> DataFrame:
    return exclude.key_stats(exclude.internal_keys(table(spark, d, I)))


@R.query("exc8_by_identifier", f"WITH {_INT}, f AS (SELECT nit_valido, fuente_interna, arg_min(tipo_antecedente, internal_order) AS tipo_antecedente, 1 AS u FROM i WHERE nit_valido IS NOT NULL GROUP BY 1, 2) SELECT x.entidad_dedup_id, f.nit_valido, f.fuente_interna, f.tipo_antecedente FROM {X} x JOIN f ON {_ok(_dig('x.nit'))} = f.nit_valido")
def exc8(spark: SparkSession, d: str) -> DataFrame:
    return exclude.by_identifier(table(spark, d, X), exclude.internal_keys(table(spark, d, I)))


@R.query(
    "exc10_exact_matches",
    f"WITH {_INT}, m AS (SELECT x.entidad_dedup_id, i.fuente_interna, 1 AS p FROM {X} x JOIN i ON {_ok(_dig('x.nit'))} = i.nit_valido "
    f"UNION ALL SELECT x.entidad_dedup_id, i.fuente_interna, 2 FROM {X} x JOIN i ON x.razon_social_normalizada = i.nombre AND x.municipio_nombre_normalizado = i.lugar UNION ALL SELECT x.entidad_dedup_id, i.fuente_interna, 3 FROM {X} x JOIN i ON x.razon_social_normalizada = i.nombre), "
    "b AS (SELECT *, min(p) OVER (PARTITION BY entidad_dedup_id) AS best FROM m) SELECT entidad_dedup_id, CASE best WHEN 1 THEN 'nit_exacto' WHEN 2 THEN 'razon_social_municipio' ELSE 'razon_social_sola' END AS tipo, "
    "string_agg(DISTINCT fuente_interna, ';' ORDER BY fuente_interna) AS fuentes, count(DISTINCT fuente_interna) AS n_fuentes FROM b WHERE p = best GROUP BY 1, best",
)
def exc10(spark: SparkSession, d: str) -> DataFrame:
    return exclude.exact_matches(table(spark, d, X), exclude.internal_keys(table(spark, d, I)))


@R.query(
    "exc9_by_number",
    f"WITH {_INT}, f AS (SELECT matricula_valida, fuente_interna, min(internal_order) AS primera FROM i WHERE matricula_valida IS NOT NULL GROUP BY 1, 2) "
    f"SELECT x.entidad_dedup_id, f.matricula_valida, f.fuente_interna, f.primera FROM {X} x JOIN f ON {_ok('x.matricula')} = f.matricula_valida "
    "WHERE EXISTS (SELECT 1 FROM fuentes s WHERE coalesce(s.camara_grupo, s.source_id) = 'serena' AND position(';' || s.source_id || ';' IN ';' || x.fuentes_consolidadas || ';') > 0)",
)
def exc9(spark: SparkSession, d: str) -> DataFrame:
    return exclude.by_number(table(spark, d, X), exclude.internal_keys(table(spark, d, I)), table(spark, d, "fuentes"), "serena")


_PENDING = (
    f"hit AS (SELECT x.entidad_dedup_id FROM {X} x JOIN i ON {_ok(_dig('x.nit'))} = i.nit_valido UNION SELECT x.entidad_dedup_id FROM {X} x JOIN i ON x.razon_social_normalizada = i.nombre "
    f"UNION SELECT x.entidad_dedup_id FROM {X} x JOIN i ON {_ok('x.matricula')} = i.matricula_valida WHERE EXISTS (SELECT 1 FROM fuentes s WHERE coalesce(s.camara_grupo, s.source_id) = 'serena' AND position(';' || s.source_id || ';' IN ';' || x.fuentes_consolidadas || ';') > 0))"
)


@R.query(
    "exc11_similar_names",
    f"WITH {_INT}, {_PENDING}, p AS (SELECT DISTINCT x.razon_social_normalizada AS na, x.municipio_nombre_normalizado AS lugar, i.nombre AS nb FROM {X} x JOIN i ON x.municipio_nombre_normalizado = i.lugar WHERE x.entidad_dedup_id NOT IN (SELECT entidad_dedup_id FROM hit) AND x.razon_social_normalizada IS NOT NULL AND i.nombre IS NOT NULL), "
    f"s AS (SELECT *, {_sorted_words('na')} AS a, {_sorted_words('nb')} AS b FROM p), near AS (SELECT * FROM s WHERE 200.0 * least(length(a), length(b)) >= 85 * (length(a) + length(b))), r AS ({_ratio('near', 'na, lugar')}), m AS (SELECT na, lugar, max(ratio) AS mejor FROM r WHERE ratio >= 85 GROUP BY 1, 2) "
    f"SELECT x.entidad_dedup_id, m.mejor FROM {X} x JOIN m ON x.razon_social_normalizada = m.na AND x.municipio_nombre_normalizado = m.lugar WHERE x.entidad_dedup_id NOT IN (SELECT entidad_dedup_id FROM hit)",
)
def exc11(spark: SparkSession, d: str) -> DataFrame:
    keys = exclude.internal_keys(table(spark, d, I))
    return exclude.similar_names(exclude.pending(table(spark, d, X), keys, table(spark, d, "fuentes"), "serena"), keys)


# ---- scores and ranking ----


@R.query("sco3_size_class", f"SELECT entidad_dedup_id, CASE WHEN t LIKE '%gran%' THEN 'grande' WHEN t LIKE '%median%' THEN 'mediana' WHEN t LIKE '%pequen%' THEN 'pequeña' WHEN t LIKE '%micro%' THEN 'micro' END AS clase FROM (SELECT entidad_dedup_id, replace(lower(tamano_empresa), 'ñ', 'n') AS t FROM {S})")
def sco3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, S).select("entidad_dedup_id", reg.size_class(F.col("tamano_empresa")).alias("clase"))


@R.query("sco7_contact", f"SELECT entidad_dedup_id, CAST(coalesce(telefono_comercial_1, telefono_comercial_2, telefono_comercial_3) IS NOT NULL AS INTEGER) + CAST(email_comercial IS NOT NULL AS INTEGER) AS canales FROM {S}")
def sco7(spark: SparkSession, d: str) -> DataFrame:
    channels = reg.contact_channels([F.col(f"telefono_comercial_{i}") for i in (1, 2, 3)], F.col("email_comercial"))
    return table(spark, d, S).select("entidad_dedup_id", channels.alias("canales"))


@R.query(
    "sco8_weighted_mean",
    f"SELECT entidad_dedup_id, round((coalesce(0.5 * score_fit, 0) + coalesce(0.3 * score_escala, 0) + coalesce(0.2 * score_contactabilidad, 0)) / nullif(CASE WHEN score_fit IS NULL THEN 0 ELSE 0.5 END + CASE WHEN score_escala IS NULL THEN 0 ELSE 0.3 END + CASE WHEN score_contactabilidad IS NULL THEN 0 ELSE 0.2 END, 0), 6) AS media FROM {S}",
)
def sco8(spark: SparkSession, d: str) -> DataFrame:
    mean = reg.weighted_mean([(F.col("score_fit"), 0.5), (F.col("score_escala"), 0.3), (F.col("score_contactabilidad"), 0.2)])
    return table(spark, d, S).select("entidad_dedup_id", F.round(mean, 6).alias("media"))


_YEAR = "CASE WHEN regexp_full_match(trim(replace(replace(ultimo_ano_renovado, ',', ''), '.', '')), '[0-9]{4}') THEN CAST(trim(replace(replace(ultimo_ano_renovado, ',', ''), '.', '')) AS INTEGER) END"


@R.query("sco4_year", f"SELECT entidad_dedup_id, CASE WHEN a BETWEEN 1990 AND 2026 THEN CAST(a AS VARCHAR) END AS anio FROM (SELECT entidad_dedup_id, {_YEAR} AS a FROM {S})")
def sco4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, S).select("entidad_dedup_id", reg.renewal_year(F.col("ultimo_ano_renovado")).cast("string").alias("anio"))


@R.query(
    "sco5_reference_rank",
    f"WITH v AS (SELECT score_base AS valor, estado_exclusion = 'SIN_COINCIDENCIA' AS r FROM {S} WHERE score_base IS NOT NULL), h AS (SELECT valor, count(*) FILTER (r) AS n FROM v GROUP BY 1) SELECT valor, round(sum(n) OVER (ORDER BY valor) / (SELECT sum(n) FROM h), 9) AS percentil FROM h",
)
def sco5(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, S).withColumnRenamed("score_base", "valor")
    return enrich.reference_rank(rows, "valor", F.col("estado_exclusion") == "SIN_COINCIDENCIA").withColumn("percentil", F.round("percentil", 9))


_READY = f"u AS (SELECT entidad_dedup_id AS id, score_prioridad_comercial AS score, CASE WHEN sector_vertical IS NULL THEN 'Sin sector' ELSE coalesce(CASE sector_vertical {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in reg.SECTOR_BUCKETS.items())} END, 'Otros') END AS sector, coalesce(municipio_nombre_normalizado, 'SIN_DATO') AS lugar, substr(sha256(entidad_dedup_id), 1, 15) AS clave FROM {S} WHERE estado_exclusion = 'SIN_COINCIDENCIA' AND score_prioridad_comercial IS NOT NULL)"


@R.query("div3_prepared", f"WITH {_READY} SELECT * FROM u")
def div3(spark: SparkSession, d: str) -> DataFrame:
    return rank.prepared(table(spark, d, S))


def _limit_sql(column: str, low: float, high: float, hard: float) -> str:
    return f"WITH {_READY}, c AS (SELECT {column} AS categoria, count(*) AS n, count(*) / (SELECT count(*) FROM u) AS p FROM u GROUP BY 1), a AS (SELECT *, least(greatest(3 * p, {low}), {high}) AS act FROM c) SELECT categoria, n, round(p, 9) AS p, round(act, 9) AS activacion, round(least(greatest(act + 0.1, {low}), {hard}), 9) AS tope FROM a"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("categoria", "n", *[F.round(c, 9).alias(c) for c in ("p", "activacion", "tope")])


@R.query("div5_sector_limits", _limit_sql("sector", 0.25, 0.5, 0.55))
def div5_sector(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(rank.limits(rank.prepared(table(spark, d, S)), "sector", reg.SECTOR_SHARES))


@R.query("div5_place_limits", _limit_sql("lugar", 0.15, 0.35, 0.45))
def div5_place(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(rank.limits(rank.prepared(table(spark, d, S)), "lugar", reg.PLACE_SHARES))


@R.query("div6_smoothed_share", f"WITH {_READY}, c AS (SELECT sector, count(*) AS n FROM u GROUP BY 1) SELECT sector, round((10 + 1 + 22 * (n / (SELECT count(*) FROM u))) / (25 + 1 + 22), 9) AS cuota FROM c")
def div6(spark: SparkSession, d: str) -> DataFrame:
    shares = rank.limits(rank.prepared(table(spark, d, S)), "sector", reg.SECTOR_SHARES)
    return shares.select(F.col("categoria").alias("sector"), F.round(reg.smoothed_share(F.lit(10), F.lit(25), F.col("p")), 9).alias("cuota"))


@R.query("div11_pure_top", f"WITH {_READY} SELECT id AS entidad_dedup_id, score, sector, lugar FROM u ORDER BY score DESC, id LIMIT 100")
def div11(spark: SparkSession, d: str) -> DataFrame:
    return rank.pure_top(table(spark, d, S), 100)


@R.query("div12_metrics", f"WITH {_READY}, t AS (SELECT score FROM u ORDER BY score DESC, id LIMIT 100) SELECT count(*) AS filas, round(avg(score), 6) AS media, median(score) AS mediana, min(score) AS minimo FROM t")
def div12(spark: SparkSession, d: str) -> DataFrame:
    return rank.list_metrics(rank.pure_top(table(spark, d, S), 100)).withColumn("media", F.round("media", 6))


# ---- reports ----


@R.query("rep2_repeated_lineage", f"SELECT source_id || '/' || hoja_origen || '/' || CAST(fila_origen AS VARCHAR) AS linaje, count(*) AS veces FROM {N} GROUP BY 1 HAVING count(*) > 1")
def rep2(spark: SparkSession, d: str) -> DataFrame:
    return reports.repeated_ids(table(spark, d, N).select(F.concat_ws("/", "source_id", "hoja_origen", F.col("fila_origen").cast("string")).alias("linaje")), "linaje")


@R.query("rep3_unmatched", f"SELECT DISTINCT municipio_nombre_normalizado AS nombre FROM {N} WHERE municipio_nombre_normalizado IS NOT NULL AND municipio_nombre_normalizado NOT IN (SELECT nombre FROM {M})")
def rep3(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, N).select(F.col("municipio_nombre_normalizado").alias("nombre")).filter("nombre is not null").distinct()
    return reports.unmatched_ids(places, table(spark, d, M), "nombre")


@R.query("rep7_filtered_top", f"SELECT entidad_dedup_id, score_prioridad_comercial FROM {S} WHERE coalesce(telefono_comercial_1, telefono_comercial_2, telefono_comercial_3, email_comercial) IS NOT NULL AND score_prioridad_comercial >= 50 AND estado_exclusion = 'SIN_COINCIDENCIA' ORDER BY score_prioridad_comercial DESC, substr(sha256(entidad_dedup_id), 1, 15), entidad_dedup_id LIMIT 50")
def rep7(spark: SparkSession, d: str) -> DataFrame:
    chosen = reports.filtered_top(table(spark, d, S), reports.Filters(con_contacto=True, score_minimo=50.0, estado="SIN_COINCIDENCIA"), 50)
    return chosen.select("entidad_dedup_id", "score_prioridad_comercial")


@R.query("rep8_completeness", " UNION ALL ".join(f"SELECT '{c}' AS campo, count({c}) AS llenos, round(100.0 * count({c}) / count(*), 1) AS porcentaje FROM {N}" for c in dedup.FIELDS))
def rep8_completeness(spark: SparkSession, d: str) -> DataFrame:
    return reports.completeness_by_field(table(spark, d, N), dedup.FIELDS)


@R.query("rep8_places", f"SELECT departamento, lugar, count(*) AS filas, CAST(grouping(departamento) * 2 + grouping(lugar) AS INTEGER) AS nivel FROM (SELECT coalesce(departamento, 'SIN_DATO') AS departamento, coalesce(municipio_nombre_normalizado, 'SIN_DATO') AS lugar FROM {N}) GROUP BY ROLLUP (departamento, lugar)")
def rep8_places(spark: SparkSession, d: str) -> DataFrame:
    return reports.coverage_by_place(table(spark, d, N))


@R.query("rep8_merges", f"SELECT metodo_deduplicacion, count(*) AS filas, count(DISTINCT entidad_dedup_id) AS entidades FROM {G} GROUP BY 1")
def rep8_merges(spark: SparkSession, d: str) -> DataFrame:
    return reports.merge_summary(table(spark, d, G))


# ---- legal registry ----

_DV_SUM = " + ".join(f"CAST(substr(pad, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(reg.CHECK_WEIGHTS))


@R.query(
    "leg2_query_id",
    f"WITH a AS (SELECT row_order, {_dig('nit')} AS d FROM {N}), b AS (SELECT *, coalesce(length(d) BETWEEN 7 AND 12, false) AS ok FROM a), c AS (SELECT *, CASE WHEN ok THEN substr(d, 1, length(d) - 1) END AS base, CASE WHEN ok THEN d[-1] END AS digito FROM b), "
    f"p AS (SELECT *, CASE WHEN ok THEN lpad(base, 15, '0') END AS pad FROM c), q AS (SELECT *, CASE WHEN ok THEN ({_DV_SUM}) % 11 END AS r FROM p), z AS (SELECT *, CAST(CASE WHEN r <= 1 THEN r ELSE 11 - r END AS VARCHAR) AS calculado FROM q) SELECT row_order, base, digito, calculado, digito = calculado AS coincide, ok AS consultable FROM z",
)
def leg2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", reg.query_id(F.col("nit")).alias("a")).select("row_order", "a.*")


_L1 = "CASE " + " ".join(f"WHEN t LIKE '%{s}' THEN trim(left(t, length(t) - {len(s)}))" for s in reg.STATE_SUFFIXES) + " ELSE t END"
_FORMS = reg.LEGAL_FORMS
_L2 = "CASE " + " ".join(f"WHEN regexp_replace(s, '{p}', '{r}') <> s THEN regexp_replace(s, '{p}', '{r}')" for p, r in _FORMS) + " ELSE s END"


def _comparable(c: str, key: str, source: str, suffix: str) -> str:
    return f"a{suffix} AS (SELECT {key}, {_cmp(c)} AS t FROM {source}), b{suffix} AS (SELECT {key}, {_L1} AS s FROM a{suffix}), n{suffix} AS (SELECT {key}, nullif(trim(regexp_replace(regexp_replace({_L2}, '[.,;:''\"()]', ' ', 'g'), '\\s+', ' ', 'g')), '') AS nombre FROM b{suffix})"


@R.query("leg3_comparable_name", f"WITH {_comparable('razon_social', 'row_order', N, '')} SELECT row_order, nombre FROM n")
def leg3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, N).select("row_order", reg.comparable_name(F.col("razon_social")).alias("nombre"))


@R.query(
    "leg4_compatible_names",
    f"WITH {_comparable('razon_social', 'row_order', N, '1')}, {_comparable('razon_social', 'entidad_dedup_id', E, '2')} SELECT g.row_order, coalesce(n1.nombre = n2.nombre OR position(n2.nombre IN n1.nombre) > 0 OR position(n1.nombre IN n2.nombre) > 0, false) AS compatible FROM {G} g JOIN n1 USING (row_order) JOIN n2 ON g.entidad_dedup_id = n2.entidad_dedup_id",
)
def leg4(spark: SparkSession, d: str) -> DataFrame:
    # names are made comparable before the join, once each
    own = table(spark, d, N, "row_order", F.col("razon_social").alias("a")).join(table(spark, d, G, "row_order", "entidad_dedup_id"), "row_order")
    return own.join(table(spark, d, E, "entidad_dedup_id", F.col("razon_social").alias("b")), "entidad_dedup_id").select("row_order", reg.compatible_names(F.col("a"), F.col("b")).alias("compatible"))


# ---- messages ----


# RE2 knows classes by property only; what Java calls a letter, a digit and white space of any script is spelt out
_WORD, _DIGIT, _BLANK = "[\\p{L}\\p{Nl}\\p{M}\\p{Nd}\\p{Pc}]", "\\p{Nd}", "[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_MAILS = f"[{_WORD[1:-1]}.-]+@[{_WORD[1:-1]}.-]+\\.{_WORD}+"
_CALLS = f"(?:\\+57|57)?{_BLANK}?3{_DIGIT}{{9}}|{_DIGIT}{{7,10}}"
_SUMS = f"(?i)\\$?{_BLANK}?{_DIGIT}{{1,3}}(?:[.,]{_DIGIT}{{3}})*(?:[.,]{_DIGIT}{{2}})?{_BLANK}?(?:COP|pesos|cop)?"


@R.query("msg4_entities", "SELECT doc_id, " + ", ".join(f"array_to_string(regexp_extract_all(text, '{p}'), '|') AS {k}" for k, p in (("telefonos", _CALLS), ("emails", _MAILS), ("montos", _SUMS))) + " FROM documents")
def msg4(spark: SparkSession, d: str) -> DataFrame:
    """Every document and all three lists."""
    found = with_entities(table(spark, d, "documents", "doc_id", "text"))
    return found.select("doc_id", *[F.array_join(f"entidades.{k}", "|").alias(k) for k in ("telefonos", "emails", "montos")])


@R.query("msg11_first_of_message", "SELECT message_id, min(doc_id) AS doc_id, count(*) AS veces FROM documents WHERE message_id IS NOT NULL GROUP BY 1")
def msg11(spark: SparkSession, d: str) -> DataFrame:
    return once(table(spark, d, "documents", "doc_id", "message_id"))
