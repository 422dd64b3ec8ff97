"""Entities that occur among the internal keys: identifier, number and chamber, name and place, name, similar name.

Each pass is an equi-join on keys aggregated first; the pass of highest rank that hits decides (``cascade``). A key
of many internal rows is one row per key and source before it is joined.

Defined results: null and stand-in identifiers match nothing, null names and places neither; repeated internal rows
count once per source; an empty table on either side matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.similarity import may_reach, token_sort_ratio
from cauce.functions.text import comparison_text, digits, place_parts, placeholder_id, token_sort
from cauce.session import cut

# Similarity of a match, and the names on one side of a place beyond which the method doesn't compare it.
THRESHOLD, LARGEST_SIDE = 85.0, 300
#: Characters counted one by one in the bound on a ratio.
LETTERS = " ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def usable_id(c: Column) -> Column:
    """EXC-2: digits of an identifier that is no stand-in."""
    d = digits(c)
    return F.when(~placeholder_id(d), d)


def usable_number(c: Column) -> Column:
    """EXC-2: a trimmed registration number that is no stand-in."""
    t = F.trim(c)
    return F.when(~placeholder_id(t), t)


def internal_keys(internal: DataFrame) -> DataFrame:
    """EXC-6: the comparable keys of the internal rows and nothing else of them; without a date they have none."""
    since = F.col("fecha_referencia") if "fecha_referencia" in internal.columns else F.lit(None).cast("timestamp")
    return internal.select(
        "internal_order", "fuente_interna", usable_id(F.col("nit")).alias("nit_valido"), usable_number(F.col("matricula")).alias("matricula_valida"), comparison_text(F.col("razon_social")).alias("nombre"),
        place_parts(F.col("municipio"))["nombre"].alias("lugar"), "tipo_antecedente", since.alias("fecha_referencia"),
    )


def key_stats(keys: DataFrame) -> DataFrame:
    """EXC-7: by internal source: rows and usable keys."""
    return keys.groupBy("fuente_interna").agg(F.count("*").alias("filas"), F.count("nit_valido").alias("con_nit"), F.count("matricula_valida").alias("con_matricula"), F.count("nombre").alias("con_nombre"))


def by_identifier(entities: DataFrame, keys: DataFrame) -> DataFrame:
    """EXC-8: one row per entity and internal source with the same identifier, with that source's first antecedent."""
    once = keys.filter("nit_valido is not null").groupBy("nit_valido", "fuente_interna").agg(F.min_by("tipo_antecedente", "internal_order").alias("tipo_antecedente"))
    return entities.select("entidad_dedup_id", usable_id(F.col("nit")).alias("nit_valido")).join(once, "nit_valido")


def by_number(entities: DataFrame, keys: DataFrame, sources: DataFrame, chamber: str) -> DataFrame:
    """EXC-9: entities with the registration number of an internal row, if one of their sources is of the chamber.

    Registration numbers are unique within a chamber only. The sources of an entity are few; their chambers are
    looked up in the broadcast catalogue.
    """
    once = keys.filter("matricula_valida is not null").groupBy("matricula_valida", "fuente_interna").agg(F.min("internal_order").alias("primera"))
    of_chamber = sources.filter(F.coalesce("camara_grupo", "source_id") == chamber).select("source_id")
    mine = entities.select("entidad_dedup_id", F.when(~placeholder_id(F.col("matricula")), F.col("matricula")).alias("matricula_valida"), F.explode(F.split("fuentes_consolidadas", ";")).alias("source_id"))
    local = mine.filter("matricula_valida is not null").join(F.broadcast(of_chamber), "source_id", "left_semi").select("entidad_dedup_id", "matricula_valida").distinct()
    return local.join(once, "matricula_valida").select("entidad_dedup_id", "matricula_valida", "fuente_interna", "primera")


def exact_matches(entities: DataFrame, keys: DataFrame) -> DataFrame:
    """EXC-8, EXC-10: ``entidad_dedup_id, tipo, fuentes, n_fuentes`` by the first of identifier, name and place, name."""
    sources = lambda *by: keys.filter(" and ".join(f"{b} is not null" for b in by)).groupBy(*by).agg(F.array_sort(F.collect_set("fuente_interna")).alias("f"))
    by_id = sources("nit_valido").withColumnRenamed("f", "f_id")
    by_place = sources("nombre", "lugar").withColumnRenamed("f", "f_lugar")
    by_name = sources("nombre").withColumnRenamed("f", "f_nombre")
    mine = entities.select("entidad_dedup_id", usable_id(F.col("nit")).alias("nit_valido"), F.col("razon_social_normalizada").alias("nombre"), F.col("municipio_nombre_normalizado").alias("lugar"))
    met = mine.join(by_id, "nit_valido", "left").join(by_place, ["nombre", "lugar"], "left").join(by_name, "nombre", "left")
    kind = F.when(F.col("f_id").isNotNull(), "nit_exacto").when(F.col("f_lugar").isNotNull(), "razon_social_municipio").when(F.col("f_nombre").isNotNull(), "razon_social_sola")
    found = F.coalesce("f_id", "f_lugar", "f_nombre")
    return met.filter(found.isNotNull()).select("entidad_dedup_id", kind.alias("tipo"), F.array_join(found, ";").alias("fuentes"), F.size(found).alias("n_fuentes"))


def pending(entities: DataFrame, keys: DataFrame, sources: DataFrame, chamber: str) -> DataFrame:
    """EXC-11: the entities that neither identifier, number of the chamber nor exact name has matched."""
    matched = exact_matches(entities, keys).select("entidad_dedup_id").unionByName(by_number(entities, keys, sources, chamber).select("entidad_dedup_id"))
    return entities.join(matched, "entidad_dedup_id", "left_anti")


def _letters(c: Column) -> Column:
    """How often each of ``LETTERS`` occurs, and the number of the other characters."""
    counts = [F.length(c) - F.length(F.replace(c, F.lit(x), F.lit(""))) for x in LETTERS]
    return F.array(*counts, F.length(F.translate(c, LETTERS, "")))


def similar_names(entities: DataFrame, keys: DataFrame, threshold: float = THRESHOLD, largest: int | None = None) -> DataFrame:
    """EXC-11: ``entidad_dedup_id, mejor``: the best ratio to an internal name of the same place, from the threshold.

    Every place is compared; with ``largest`` (the method's rule: ``LARGEST_SIDE``) only those where each side has
    at most so many entities or names. Equal names of a place are one. Pairs that their lengths, or the letters
    they have in common, keep below the threshold do not go to Python; neither bound drops a pair that reaches it.
    """
    mine = entities.filter("razon_social_normalizada is not null and municipio_nombre_normalizado is not null").select("entidad_dedup_id", F.col("razon_social_normalizada").alias("a"), F.col("municipio_nombre_normalizado").alias("lugar"))
    theirs = keys.filter("nombre is not null and lugar is not null").select("lugar", F.col("nombre").alias("b")).distinct()
    if largest is not None:
        small = lambda df: df.groupBy("lugar").agg(F.count("*").alias("n")).filter(F.col("n") <= largest).select("lugar")
        mine = mine.join(small(mine).join(small(theirs), "lugar"), "lugar")
    one = mine.select("lugar", "a").distinct().withColumn("la", _letters(token_sort(F.col("a"))))
    other = theirs.withColumn("lb", _letters(token_sort(F.col("b"))))
    shared = sum((F.least(F.col("la")[i], F.col("lb")[i]) for i in range(len(LETTERS) + 1)), F.lit(0))
    pairs = one.join(other, "lugar").filter(may_reach(F.col("a"), F.col("b"), threshold))
    pairs = pairs.filter(200.0 * shared >= threshold * (F.aggregate("la", F.lit(0), lambda x, y: x + y) + F.aggregate("lb", F.lit(0), lambda x, y: x + y)))
    best = pairs.withColumn("r", token_sort_ratio(F.col("a"), F.col("b"))).filter(F.col("r") >= threshold).groupBy("lugar", "a").agg(F.max("r").alias("mejor"))
    return mine.join(best, ["lugar", "a"]).select("entidad_dedup_id", "mejor")


# What each pass of the cascade is called, how sure it is and which state it gives.
PASSES = {
    "A": ("nit", "nit_exacto", "alta", "EXCLUSION_ALTA"),
    "B": ("matricula", "matricula_contexto_camara", "media", "EXCLUSION_MEDIA"),
    "C1m": ("razon_social", "razon_social_municipio", "media", "CANDIDATO_AMBIGUO"),
    "C1": ("razon_social", "razon_social_sola", "baja", "CANDIDATO_AMBIGUO"),
    "C2": ("razon_social", "fuzzy_razon_social", "baja", "CANDIDATO_AMBIGUO"),
}
NO_MATCH, SEVERAL = "SIN_COINCIDENCIA", "multiples"

# Fields that may be taken of an internal source by its kind, and fields that never may.
ALLOWED = {"crm": ["numero_documento", "nombre_comercio_lead", "ciudad"], "hubs": ["matricula", "identificacion"]}
FORBIDDEN = ["user_email", "lead_email", "manager_email", "numero_contacto", "direccion", "tipo_documento", "correo comercial", "telefono comercial", "asignado a"]
# Flags of a lead that tell what became of it, the first that is set going first.
ANTECEDENTS = [("Convertido", "cliente_convertido"), ("cliente_antiguo", "cliente_previo"), ("Descartado", "lead_descartado"), ("Calificado", "oportunidad_calificada")]
NO_ANTECEDENT, TAX_DOCUMENT = "lead_sin_resolucion_clara", "NIT"


def allowed_fields(kind: str) -> list[str]:
    """EXC-1: the fields of an internal source that may be read; ValueError for unknown kinds."""
    if kind not in ALLOWED:
        raise ValueError(f"unknown kind of internal source: {kind!r}")
    return ALLOWED[kind]


def antecedent() -> Column:
    """EXC-3: what became of a lead, by the first flag that is ``1``."""
    out = F.when(F.col(ANTECEDENTS[0][0]) == "1", ANTECEDENTS[0][1])
    for flag, meaning in ANTECEDENTS[1:]:
        out = out.when(F.col(flag) == "1", meaning)
    return out.otherwise(NO_ANTECEDENT)


def crm_keys(leads: DataFrame, source: str) -> DataFrame:
    """EXC-4: keys of leads; the document number counts only if the document is a tax id."""
    return leads.select(
        F.lit(source).alias("fuente_interna"), usable_id(F.when(F.col("tipo_documento") == TAX_DOCUMENT, F.col("numero_documento"))).alias("nit_valido"), F.lit(None).cast("string").alias("matricula_valida"),
        comparison_text(F.col("nombre_comercio_lead")).alias("nombre"), comparison_text(F.col("ciudad")).alias("lugar"), antecedent().alias("tipo_antecedente"), F.nullif("ultima_actualizacion", F.lit("")).alias("fecha_referencia"),
    )


def crm_stats(leads: DataFrame, source: str) -> DataFrame:
    """EXC-4: leads, usable tax ids, other documents, no document, nothing to compare by."""
    kept = leads.select("tipo_documento", usable_id(F.when(F.col("tipo_documento") == TAX_DOCUMENT, F.col("numero_documento"))).alias("n"), comparison_text(F.col("nombre_comercio_lead")).alias("r"))
    return kept.agg(
        F.lit(source).alias("fuente_interna"), F.count("*").alias("registros"), F.count("n").alias("con_nit_valido"), F.count_if((F.col("tipo_documento") != TAX_DOCUMENT) & (F.col("tipo_documento") != "")).alias("con_otro_documento"),
        F.count_if(F.col("tipo_documento") == "").alias("sin_documento"), F.count_if(F.col("n").isNull() & F.col("r").isNull()).alias("sin_identificador"),
    )


# Where the keys stand in hub sheets with a header, and in those without one.
NAMED = {"nit": "IDENTIFICACION", "matricula": "MATRICULA", "nombre": "RAZON SOCIAL", "lugar": "MUNICIPIO COMERCIAL", "fecha": "AÑO DE MATRICULA"}
POSITIONAL = {"nit": "col_5", "matricula": "col_2", "nombre": "col_4", "lugar": "col_9", "fecha": "col_6"}


def hub_keys(rows: DataFrame, source: str, columns: dict[str, str] | None = None) -> DataFrame:
    """EXC-5: keys of a hub sheet by column name (``NAMED``) or place (``POSITIONAL``); a missing column is null."""
    wanted = columns or NAMED
    there = lambda k: F.col(f"`{wanted[k]}`") if wanted[k] in rows.columns else F.lit(None).cast("string")
    return rows.select(
        F.lit(source).alias("fuente_interna"), usable_id(there("nit")).alias("nit_valido"), usable_number(there("matricula")).alias("matricula_valida"), comparison_text(there("nombre")).alias("nombre"),
        comparison_text(there("lugar")).alias("lugar"), F.lit(None).cast("string").alias("tipo_antecedente"), there("fecha").alias("fecha_referencia"),
    )


def cascade(entities: DataFrame, keys: DataFrame, sources: DataFrame, chamber: str, largest: int | None = LARGEST_SIDE) -> tuple[DataFrame, DataFrame]:
    """EXC-8..12: ``(states, matches)``: every entity with its state, and one row for each match of a matched one.

    Passes go in order: identifier (A), number of the chamber (B), name with or without place (C1), similar name of
    the same place (C2); a pass sees only what those before it left. ``largest`` is the method's rule for C2: places
    with more pending entities or internal names are not compared; None compares all.

    ``entities`` has ``entidad_dedup_id, nit, matricula, razon_social, municipio_comercial, fuentes_consolidadas``.
    """
    of_chamber = sources.filter(F.coalesce("camara_grupo", "source_id") == chamber).select("source_id").distinct()
    mine = entities.select(
        "entidad_dedup_id", usable_id(F.col("nit")).alias("nit_valido"), F.when(~placeholder_id(F.col("matricula")), F.col("matricula")).alias("matricula_valida"),
        comparison_text(F.col("razon_social")).alias("nombre"), place_parts(F.col("municipio_comercial"))["nombre"].alias("lugar"), F.split("fuentes_consolidadas", ";").alias("fuentes"),
    )
    local = mine.filter("matricula_valida is not null").select("entidad_dedup_id", F.explode("fuentes").alias("source_id")).join(of_chamber, "source_id", "left_semi").select("entidad_dedup_id").distinct()
    known = lambda flag, *by: keys.select(*by).dropna().distinct().withColumn(flag, F.lit(True))
    met = (
        mine.drop("fuentes").join(known("a", "nit_valido"), "nit_valido", "left").join(known("b", "matricula_valida"), "matricula_valida", "left").join(local.withColumn("here", F.lit(True)), "entidad_dedup_id", "left")
        .join(known("cm", "nombre", "lugar"), ["nombre", "lugar"], "left").join(known("c", "nombre"), "nombre", "left")
    )
    passed = F.when(F.col("a"), "A").when(F.col("b") & F.col("here"), "B").when(F.col("cm"), "C1m").when(F.col("c"), "C1")
    judged = cut(met.select("entidad_dedup_id", "nit_valido", "matricula_valida", "nombre", "lugar", passed.alias("pase")))
    pending_ones = judged.filter("pase is null").select("entidad_dedup_id", F.col("nombre").alias("razon_social_normalizada"), F.col("lugar").alias("municipio_nombre_normalizado"))
    near = similar_names(pending_ones, keys, largest=largest).select("entidad_dedup_id", F.lit("C2").alias("pase"))
    whole = judged.join(near.withColumnRenamed("pase", "_c2"), "entidad_dedup_id", "left").withColumn("pase", F.coalesce("pase", "_c2")).drop("_c2")

    def rows(code: str, hits: DataFrame, value: Column, kind: Column, since: Column, source: Column) -> DataFrame:
        identifier, how, confidence, state = PASSES[code]
        return hits.select(
            "entidad_dedup_id", F.lit(identifier).alias("identificador_tipo"), value.alias("identificador_valor"), source.alias("fuente_interna"), F.lit(how).alias("tipo_coincidencia"), F.lit(confidence).alias("confianza"),
            F.lit(state).alias("estado_resultante"), kind.alias("tipo_antecedente_crm"), since.alias("fecha_referencia"),
        )

    none, never, source = F.lit(None).cast("string"), F.lit(None).cast(keys.schema["fecha_referencia"].dataType), F.col("fuente_interna")
    at = lambda code, by, firsts: judged.filter(F.col("pase") == code).join(keys.dropna(subset=by).groupBy(*by, "fuente_interna").agg(*firsts), by)
    first = lambda c: F.min_by(c, "internal_order").alias(c)
    once = F.count("*").alias("_n")
    matches = rows("A", at("A", ["nit_valido"], [first("tipo_antecedente"), first("fecha_referencia")]), F.col("nit_valido"), F.col("tipo_antecedente"), F.col("fecha_referencia"), source)
    matches = matches.unionByName(rows("B", at("B", ["matricula_valida"], [once]), F.col("matricula_valida"), none, never, source))
    matches = matches.unionByName(rows("C1m", at("C1m", ["nombre", "lugar"], [once]), none, none, never, source)).unionByName(rows("C1", at("C1", ["nombre"], [once]), none, none, never, source))
    matches = matches.unionByName(rows("C2", near, none, none, never, F.lit(SEVERAL)))
    # a pass decides type and confidence, so all rows of an entity agree
    summary = matches.groupBy("entidad_dedup_id").agg(
        F.count_distinct("fuente_interna").alias("num_fuentes_internas_coincidentes"), F.array_join(F.array_sort(F.collect_set("fuente_interna")), ";").alias("fuentes_internas_coincidentes"),
        F.min("tipo_coincidencia").alias("mejor_tipo_coincidencia"), F.min("confianza").alias("mejor_confianza"), F.min("estado_resultante").alias("estado_exclusion"),
    )
    states = whole.select("entidad_dedup_id").join(summary, "entidad_dedup_id", "left").na.fill(0, ["num_fuentes_internas_coincidentes"]).na.fill(NO_MATCH, ["estado_exclusion"])
    return states, matches
