"""Conservative deduplication: exact keys merge, similar names only become candidates.

Group sizes and places are aggregates joined back (adaptive execution splits hot keys of such joins); no window
holds a whole key. Stand-in identifiers are no keys. Row identity is ``row_order``.

Defined results: null and placeholder identifiers merge nothing; rows without a group form an entity of their
own; repeated rows (same lineage) are rows; extra columns are carried only where said.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.similarity import common_subsequence
from cauce.functions.text import comparison_text, digits, placeholder_id
from cauce.operators.numbering import numbered
from cauce.session import cut

# The canonical fields, in their order.
FIELDS = [
    "nit", "matricula", "matricula_establecimiento", "razon_social", "tipo_organizacion", "estado_matricula", "fecha_matricula", "fecha_renovacion", "ultimo_ano_renovado", "fecha_constitucion",
    "direccion_comercial", "barrio_comercial", "municipio_comercial", "departamento", "telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3", "email_comercial", "ciiu_1", "ciiu_2",
    "ciiu_3", "ciiu_4", "actividad_descripcion", "tamano_empresa", "num_empleados", "activo_total", "representante_legal", "grupo_niif", "bic", "categoria_matricula",
]
LINEAGE = ["source_id", "fuente_archivo", "hoja_origen", "fila_origen"]

# Similarity of candidates, largest block compared, digits of a usable tax id in a business key.
THRESHOLD, LARGEST_BLOCK, SHORTEST_ID = 85.0, 300, 6


def business_key(nit: Column, name: Column, place: Column) -> Column:
    """DED-2: ``clave, metodo``: by tax id if long enough, else by name and place."""
    number = digits(nit)
    text = F.concat(F.lit("razon_municipio:"), F.coalesce(comparison_text(name), F.lit("")), F.lit("|"), F.coalesce(comparison_text(place), F.lit("")))
    return F.when(F.length(number) >= SHORTEST_ID, F.struct(F.concat(F.lit("nit:"), number).alias("clave"), F.lit("nit").alias("metodo"))).otherwise(
        F.struct(text.alias("clave"), F.lit("razon_municipio").alias("metodo"))
    )


def completeness(fields: list[str] = FIELDS) -> Column:
    """DED-4: canonical fields that are not null."""
    return sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))


def keyed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Working columns: usable identifiers, chamber of the source, completeness (DED-1, DED-3, DED-4)."""
    chambers = sources.select("source_id", F.col("camara_grupo").alias("_camara")).dropDuplicates(["source_id"])
    return rows.join(F.broadcast(chambers), "source_id", "left").select(
        "row_order", F.when(~placeholder_id(F.col("nit")), F.col("nit")).alias("nit_valido"), F.when(~placeholder_id(F.col("matricula")), F.col("matricula")).alias("matricula_valida"),
        F.coalesce("_camara", "source_id").alias("camara"), F.col("municipio_nombre_normalizado").alias("municipio"), completeness().alias("completitud"),
    )


def merged_keys(keys: DataFrame) -> DataFrame:
    """DED-5, DED-6: ``row_order, clave, metodo, confianza``; the key is null for rows that merge with none.

    A tax id with at most one place is one group, else each place is (rows without place stay alone). Rows
    left over merge by registration number and chamber.
    """
    ids = keys.filter("nit_valido is not null").groupBy("nit_valido").agg(F.count("*").alias("n_id"), F.min("municipio").alias("lo"), F.max("municipio").alias("hi"))
    # one place at most: smallest and largest agree (or both are null)
    ids = ids.filter("n_id > 1").select("nit_valido", (F.coalesce(F.col("lo") != F.col("hi"), F.lit(False))).alias("varias"))
    seats = keys.filter("nit_valido is not null and municipio is not null").groupBy("nit_valido", "municipio").agg(F.count("*").alias("n_sede")).filter("n_sede > 1")
    by_id = keys.join(ids, "nit_valido", "left").join(seats, ["nit_valido", "municipio"], "left")
    whole, part = F.col("varias") == F.lit(False), F.col("varias") & F.col("n_sede").isNotNull()
    first = by_id.select(
        "row_order", "matricula_valida", "camara",
        F.when(whole, F.concat(F.lit("N|"), "nit_valido")).when(part, F.concat(F.lit("M|"), "nit_valido", F.lit("|"), "municipio")).alias("clave_nit"),
        F.when(whole, "nit").when(part, "nit_multisede").alias("metodo_nit"),
    )
    left = first.filter("clave_nit is null and matricula_valida is not null").groupBy("matricula_valida", "camara").agg(F.count("*").alias("n_mat")).filter("n_mat > 1")
    second = first.join(left, ["matricula_valida", "camara"], "left")
    by_number = F.col("clave_nit").isNull() & F.col("n_mat").isNotNull()
    return second.select(
        "row_order",
        F.coalesce("clave_nit", F.when(by_number, F.concat(F.lit("C|"), "matricula_valida", F.lit("|"), "camara"))).alias("clave"),
        F.coalesce("metodo_nit", F.when(by_number, "matricula_camara"), F.lit("sin_consolidar")).alias("metodo_deduplicacion"),
        F.when(F.col("metodo_nit").isNotNull(), "alta").when(by_number, "media_alta").alias("confianza_deduplicacion"),
    )


def entities(keys: DataFrame) -> DataFrame:
    """DED-11: ``row_order, entidad_dedup_id`` with ids in order of first appearance, and method and confidence."""
    merged = cut(merged_keys(keys).withColumn("clave", F.coalesce("clave", F.concat(F.lit("R|"), F.col("row_order").cast("string")))))
    first = merged.groupBy("clave").agg(F.min("row_order").alias("primera"), F.count("*").alias("tamano_grupo"))
    ids = numbered(first, "primera").select("clave", "tamano_grupo", F.format_string("ENT-%07d", "n").alias("entidad_dedup_id"))
    return merged.join(ids, "clave").select("row_order", "entidad_dedup_id", "tamano_grupo", "metodo_deduplicacion", "confianza_deduplicacion")


def master_flags(grouped: DataFrame) -> DataFrame:
    """DED-12: ``row_order, es_registro_maestro``: the most complete row of its entity, the earliest of several."""
    best = grouped.groupBy("entidad_dedup_id").agg(F.min_by("row_order", F.struct(-F.col("completitud"), "row_order")).alias("maestro"))
    return grouped.join(best, "entidad_dedup_id").select("row_order", (F.col("row_order") == F.col("maestro")).alias("es_registro_maestro"))


def masters(grouped: DataFrame) -> DataFrame:
    """DED-13..15: one row per entity: for each field the first value that is not null, most complete rows first.

    ``grouped`` has lineage, canonical fields, row_order, entidad_dedup_id, method and confidence.
    """
    rank = F.struct((-completeness()).alias("c"), F.col("row_order").alias("o"))
    order = F.col("row_order")
    sizes = grouped.groupBy("entidad_dedup_id").agg(F.count("*").alias("registros_consolidados"))
    sized = grouped.join(sizes, "entidad_dedup_id")
    # most entities have one row and are their own master; only the others are aggregated
    alone = sized.filter("registros_consolidados = 1").select(
        "entidad_dedup_id", *LINEAGE, *FIELDS, F.lit(1).cast("bigint").alias("numero_fuentes_consolidadas"), F.col("source_id").alias("fuentes_consolidadas"), "registros_consolidados",
        "metodo_deduplicacion", "confianza_deduplicacion", F.lit("").alias("campos_en_conflicto"),
    )
    picked = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in [*LINEAGE, *FIELDS]]
    distinct = [(F.min(F.when(F.col(c).isNotNull(), F.xxhash64(c))) != F.max(F.when(F.col(c).isNotNull(), F.xxhash64(c)))).alias(f"_d_{c}") for c in FIELDS]
    summary = sized.filter("registros_consolidados > 1").groupBy("entidad_dedup_id").agg(
        *picked, F.count_distinct("source_id").alias("numero_fuentes_consolidadas"), F.array_join(F.array_sort(F.collect_set("source_id")), ";").alias("fuentes_consolidadas"),
        F.count("*").alias("registros_consolidados"), F.min_by("metodo_deduplicacion", order).alias("metodo_deduplicacion"),
        F.min_by("confianza_deduplicacion", F.when(F.col("confianza_deduplicacion").isNotNull(), order)).alias("confianza_deduplicacion"), *distinct,
    )
    conflicts = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"_d_{c}"), c) for c in FIELDS])), ";")
    return summary.withColumn("campos_en_conflicto", conflicts).drop(*[f"_d_{c}" for c in FIELDS]).unionByName(alone)


def conflict_values(grouped: DataFrame) -> DataFrame:
    """DED-15: ``entidad_dedup_id, campo, valor, filas``: each value of the fields that disagree in an entity, with its rows.

    One row for each value, so an entity of any size is never held in one place.
    """
    long = grouped.select("entidad_dedup_id", F.explode(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("valor")) for c in FIELDS])).alias("p")).select("entidad_dedup_id", "p.*").filter("valor is not null")
    values = long.groupBy("entidad_dedup_id", "campo", "valor").agg(F.count("*").alias("filas"))
    several = values.groupBy("entidad_dedup_id", "campo").agg(F.count("*").alias("n")).filter("n > 1").select("entidad_dedup_id", "campo")
    return values.join(several, ["entidad_dedup_id", "campo"], "left_semi")


def name_place_candidates(open_rows: DataFrame) -> DataFrame:
    """DED-7: groups of unmerged rows with equal name and place: ``grupo, razon_social_normalizada, municipio_nombre_normalizado, filas, confianza``."""
    same = lambda c: (F.count(c) == F.count("*")) & (F.min(c) == F.max(c))
    found = (
        open_rows.filter("razon_social_normalizada is not null and municipio_nombre_normalizado is not null")
        .groupBy("razon_social_normalizada", "municipio_nombre_normalizado")
        .agg(F.count("*").alias("filas"), F.min("row_order").alias("primera"), (same("direccion_comercial") | same("telefono_comercial_1") | same("email_comercial")).alias("apoyo"))
        .filter("filas > 1")
    )
    return numbered(found, "primera").select(
        F.format_string("CAND-RSMUN-%06d", "n").alias("grupo"), "razon_social_normalizada", "municipio_nombre_normalizado", "filas", F.when(F.coalesce("apoyo", F.lit(False)), "media").otherwise("baja").alias("confianza")
    )


def name_blocks(open_rows: DataFrame) -> DataFrame:
    """Blocks of place and first four letters with their size; those above the largest are left out by rule."""
    named = open_rows.filter("razon_social_normalizada is not null and municipio_nombre_normalizado is not null")
    return named.groupBy("municipio_nombre_normalizado", F.substring("razon_social_normalizada", 1, 4).alias("prefijo")).agg(F.count("*").alias("filas"))


def fuzzy_candidates(open_rows: DataFrame, threshold: float = THRESHOLD, largest: int = LARGEST_BLOCK) -> DataFrame:
    """DED-8: ``row_order, grupo, ancla, metodo, confianza``: greedy stars of similar names inside a block, anchors in row order.

    An anchor takes the later free rows whose ratio reaches the threshold. A block has at most ``largest`` rows
    (the rule of the method, ``skipped_blocks`` tells what it leaves out), so one task holds one small block.
    """
    block = ["municipio_nombre_normalizado", "prefijo"]
    sized = name_blocks(open_rows).filter(F.col("filas").between(2, largest)).drop("filas")
    named = open_rows.select("row_order", "razon_social_normalizada", "municipio_nombre_normalizado", F.substring("razon_social_normalizada", 1, 4).alias("prefijo"))

    def stars(ids: list[int], names: list[str]) -> list[tuple[int, int, int]]:
        texts = [" ".join(sorted(t.split())) for t in names]
        used: set[int] = set()
        out = []
        for i, t in enumerate(texts):
            if i in used:
                continue
            near = [
                j for j in range(i + 1, len(texts)) if j not in used
                and 200 * min(len(t), len(texts[j])) >= threshold * (len(t) + len(texts[j])) and 200 * common_subsequence(t, texts[j]) >= threshold * (len(t) + len(texts[j]))
            ]
            if near:
                used |= {i, *near}
                out += [(ids[k], ids[i], ids[0]) for k in (i, *near)]
        return out

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come block by block; a block that a batch cuts is held until its last row."""
        key, ids, names = None, [], []
        for b in batches:
            out: list[tuple[int, int, int]] = []
            for place, prefix, row, name in zip(b["municipio_nombre_normalizado"], b["prefijo"], b["row_order"], b["razon_social_normalizada"], strict=True):
                if (place, prefix) != key:
                    out += stars(ids, names)
                    key, ids, names = (place, prefix), [], []
                ids.append(row)
                names.append(name)
            yield pd.DataFrame(out, columns=["row_order", "ancla", "bloque"])
        yield pd.DataFrame(stars(ids, names), columns=["row_order", "ancla", "bloque"])

    rows = named.join(sized, block).repartition(*block).sortWithinPartitions(*block, "row_order")
    stars_of = cut(rows.select(*block, "row_order", "razon_social_normalizada").mapInPandas(walk, "row_order bigint, ancla bigint, bloque bigint"))
    # numbers follow the first row of the block, then the anchor
    ids = numbered(stars_of.select("bloque", "ancla").distinct(), "bloque", "ancla").select("ancla", F.format_string("CAND-FUZZY-%06d", "n").alias("grupo"))
    return stars_of.join(ids, "ancla").select("row_order", "grupo", "ancla", F.lit("fuzzy_razon_social").alias("metodo"), F.lit("baja").alias("confianza"))


def skipped_blocks(open_rows: DataFrame, largest: int = LARGEST_BLOCK) -> DataFrame:
    """DED-8: ``bloques, filas``: the blocks beyond the largest that the method compares, and their rows."""
    return name_blocks(open_rows).filter(F.col("filas") > largest).agg(F.count("*").alias("bloques"), F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"))


def run_stats(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """DED-16: ``estadistica, valor``: the figures of a run, from the working columns (``keyed``) and the rows.

    Every figure is a sum of an aggregate; no group is held.
    """
    merged = cut(merged_keys(keys).join(keys.select("row_order", "nit_valido", "municipio"), "row_order"))
    groups = merged.filter("clave is not null").groupBy("metodo_deduplicacion", "clave").agg(F.count("*").alias("n"))
    by = {r.metodo_deduplicacion: (r.g, r.n) for r in groups.groupBy("metodo_deduplicacion").agg(F.count("*").alias("g"), F.sum("n").alias("n")).collect()}
    of = lambda *kinds: (sum(by.get(k, (0, 0))[0] for k in kinds), sum(by.get(k, (0, 0))[1] for k in kinds))
    alone = merged.filter("clave is null").count()
    ids = merged.filter("nit_valido is not null").groupBy("nit_valido").agg(F.min("municipio").alias("lo"), F.max("municipio").alias("hi"), F.count_if(F.col("municipio").isNull()).alias("sin"))
    several = ids.filter(F.col("lo") != F.col("hi")).agg(F.count("*").alias("n"), F.coalesce(F.sum("sin"), F.lit(0)).alias("sin")).first()
    open_rows = rows.join(merged.filter("clave is null").select("row_order"), "row_order")
    same = cut(name_place_candidates(open_rows))
    named = same.agg(F.count("*").alias("g"), F.coalesce(F.sum("filas"), F.lit(0)).alias("n"), F.count_if(F.col("confianza") == "media").alias("ok")).first()
    left = open_rows.join(same.select("razon_social_normalizada", "municipio_nombre_normalizado"), ["razon_social_normalizada", "municipio_nombre_normalizado"], "left_anti")
    near = fuzzy_candidates(left).agg(F.count_distinct("grupo").alias("g"), F.count("*").alias("n")).first()
    skipped = skipped_blocks(left).first()
    (g_id, n_id), (g_mat, n_mat) = of("nit", "nit_multisede"), of("matricula_camara")
    total = alone + n_id + n_mat
    figures = [
        ("registros_entrada", total), ("registros_salida", alone + g_id + g_mat), ("n_grupos_nit", g_id), ("n_registros_nit", n_id), ("n_nit_multisede", several.n), ("n_filas_nit_multisede_sin_municipio", several.sin),
        ("n_grupos_matricula", g_mat), ("n_registros_matricula", n_mat), ("n_grupos_rs_mun", named.g), ("n_registros_rs_mun", named.n), ("n_grupos_rs_mun_corroborados", named.ok), ("n_grupos_fuzzy", near.g), ("n_registros_fuzzy", near.n),
        ("n_bloques_fuzzy_omitidos", skipped.bloques), ("n_registros_en_bloques_omitidos", skipped.filas),
    ]
    return keys.sparkSession.createDataFrame([(k, int(v)) for k, v in figures], "estadistica string, valor bigint")
