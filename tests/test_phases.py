"""Exclusion as a cascade, the score and its data set, on small cases."""

import pytest
from pyspark.sql import functions as F

from cauce.functions import messages
from cauce.operators import exclude, legal, normalise, rank, register, reports, scoring

ENTITY = "entidad_dedup_id string, nit string, matricula string, razon_social string, municipio_comercial string, fuentes_consolidadas string"
KEY = "internal_order bigint, fuente_interna string, nit string, matricula string, razon_social string, municipio string, tipo_antecedente string, fecha_referencia string"


def cascade(spark, largest=exclude.LARGEST_SIDE):
    entities = spark.createDataFrame(
        [
            ("a", "900.123-4", "78", "Uno Dos", "X", "s1"), ("b", None, "78", "Tres", "X", "s2;s1"), ("b2", None, "78", "Uno Dos", "Y", "s2"), ("c", "000", None, "Uno  Dós", "91001 - X", "s1"), ("d", None, None, "Uno Dos", None, "s1"),
            ("e", None, None, "Panaderia La Espiga", "X", "s1"), ("f", None, None, None, None, None), ("g", None, "  78", "Ocho", "X", "s1"), ("h", "n/a", "111", "Nueve", "X", "s1"),
        ],
        ENTITY,
    ).withColumn("fuente_interna", F.lit("clash"))
    internal = spark.createDataFrame(
        [
            (1, "crm", "9001234", None, "z", None, None, "d1"), (2, "crm", "9001234", None, "z", None, "lead", "d2"), (3, "hub", "900123-4", None, None, None, "x", "d3"), (4, "hub", None, " 78 ", "Q", None, None, None), (5, "hub", None, "78", None, None, None, None),
            (6, "crm", None, None, "uno dos", "x", None, None), (7, "hub2", None, None, "UNO DOS", None, None, None), (8, "hub", None, None, "Espiga La Panaderias", "X", None, None), (9, "hub", "111", "111", "Nada", "X", None, None),
        ],
        KEY,
    )
    sources = spark.createDataFrame([("s1", "centro"), ("s2", None)], "source_id string, camara_grupo string")
    return exclude.cascade(entities, exclude.internal_keys(internal), sources, "centro", largest)


def test_cascade(spark):
    states, matches = cascade(spark)
    got = {r.entidad_dedup_id: (r.estado_exclusion, r.mejor_tipo_coincidencia, r.fuentes_internas_coincidentes, r.num_fuentes_internas_coincidentes) for r in states.collect()}
    assert got == {
        "a": ("EXCLUSION_ALTA", "nit_exacto", "crm;hub", 2), "b": ("EXCLUSION_MEDIA", "matricula_contexto_camara", "hub", 1), "b2": ("CANDIDATO_AMBIGUO", "razon_social_sola", "crm;hub2", 2), "c": ("CANDIDATO_AMBIGUO", "razon_social_municipio", "crm", 1),
        "d": ("CANDIDATO_AMBIGUO", "razon_social_sola", "crm;hub2", 2), "e": ("CANDIDATO_AMBIGUO", "fuzzy_razon_social", "multiples", 1), "f": ("SIN_COINCIDENCIA", None, None, 0), "g": ("SIN_COINCIDENCIA", None, None, 0), "h": ("SIN_COINCIDENCIA", None, None, 0),
    }
    rows = {(r.entidad_dedup_id, r.fuente_interna): r for r in matches.collect()}
    assert len(rows) == 9 and rows["a", "crm"].tipo_antecedente_crm is None and rows["a", "crm"].fecha_referencia == "d1" and rows["a", "hub"].tipo_antecedente_crm == "x"
    assert rows["a", "crm"].identificador_valor == "9001234" and rows["b", "hub"].identificador_valor == "78" and rows["c", "crm"].identificador_valor is None and rows["e", "multiples"].confianza == "baja"
    without = {r.entidad_dedup_id: r.estado_exclusion for r in cascade(spark, 1)[0].collect()}
    assert without["e"] == "SIN_COINCIDENCIA"  # three pending entities in the place


def test_keys_of_internal_sources(spark):
    leads = spark.createDataFrame(
        [("900123", "NIT", "Uno", "X", "1", "1", "0", "0", "d"), ("1020", "CC", "Dos", None, "0", "0", "1", "1", ""), (None, "", None, None, None, "0", "0", "1", None), ("111", "NIT", None, None, "0", "0", "0", "0", None)],
        "numero_documento string, tipo_documento string, nombre_comercio_lead string, ciudad string, Convertido string, cliente_antiguo string, Descartado string, Calificado string, ultima_actualizacion string",
    )
    got = exclude.crm_keys(leads, "crm").collect()
    assert [r.nit_valido for r in got] == ["900123", None, None, None] and [r.tipo_antecedente for r in got] == ["cliente_convertido", "lead_descartado", "oportunidad_calificada", "lead_sin_resolucion_clara"] and got[1].fecha_referencia is None
    assert tuple(exclude.crm_stats(leads, "crm").first())[1:] == (4, 1, 1, 1, 2)
    hub = spark.createDataFrame([("78", "900.123", "Uno")], "MATRICULA string, IDENTIFICACION string, `RAZON SOCIAL` string")
    row = exclude.hub_keys(hub, "hub").first()
    assert (row.nit_valido, row.matricula_valida, row.nombre, row.lugar, row.fecha_referencia) == ("900123", "78", "UNO", None, None)
    assert exclude.hub_keys(spark.createDataFrame([("x", "5")], "col_4 string, col_5 string"), "hub", exclude.POSITIONAL).first().nombre == "X"
    assert exclude.allowed_fields("hubs") == ["matricula", "identificacion"]
    with pytest.raises(ValueError):
        exclude.allowed_fields("otro")


PREPARED = (
    "id string, estado_exclusion string, sector_vertical string, encaje_pagos_declarado string, tamano_empresa string, num_empleados string, ultimo_ano_renovado string, telefono_comercial_1 string, telefono_comercial_2 string, "
    "telefono_comercial_3 string, email_comercial string, confianza_deduplicacion string, campos_en_conflicto string, flag_codigo_dane_ambiguo boolean"
)


def scores(spark):
    s, a, x = "SIN_COINCIDENCIA", "CANDIDATO_AMBIGUO", "EXCLUSION_ALTA"
    rows = [
        ("full", s, "Salud", "alto", "GRAN EMPRESA", None, "2,026", "1", None, None, "m", "alta", "", False), ("generic", s, "Agro", "bajo", None, "10", "2020", None, None, "", None, None, "nit", False),
        ("bare", s, None, None, "N", "x", "1900", None, None, None, None, "alta", "nit;bic", True), ("mail", a, None, "medio", "pequeña", "7", None, None, None, None, "m", "alta", None, True), ("out", x, "Salud", "alto", "micro", "5", "2024", "1", "2", "3", "m", "alta", "", False),
    ]
    return spark.createDataFrame(rows, PREPARED).withColumn("score_fit", F.lit("clash"))


def test_score(spark):
    got = {r.id: r for r in scoring.scored(scores(spark), scoring.Weights(defined=True)).collect()}
    assert got["full"].score_escala == 1.0 and got["full"].score_base == pytest.approx(100 * (0.4 * 0.92 + 0.35 + 0.25)) and got["full"].factor_cobertura == pytest.approx(1.0)
    assert got["generic"].score_fit == 0.35 and got["generic"].score_escala_senal_tamano == 1.0 and got["generic"].score_escala_senal_vigencia == 0.5 and got["generic"].score_contactabilidad == 0.6
    assert got["bare"].score_escala is None and got["bare"].score_base == 0.0 and got["bare"].dimensiones_con_dato == 1 and got["bare"].factor_cobertura == pytest.approx(0.8) and got["bare"].nivel_confianza_score == "Baja"
    assert got["mail"].score_fit == 0.6 and got["mail"].score_escala == 0.5 and got["mail"].nivel_confianza_score == "Media" and got["generic"].nivel_confianza_score == "Baja" and got["full"].nivel_confianza_score == "Alta"
    assert all(got["out"][c] is None for c in scoring.SCORES)
    assert got["mail"].score_prioridad_comercial == pytest.approx(got["mail"].score_base)
    stats = {r.estado_exclusion: (r.filas, r.con_score, r.sin_score) for r in scoring.score_stats(scoring.scored(scores(spark), scoring.Weights(defined=True))).collect()}
    assert stats == {"SIN_COINCIDENCIA": (3, 3, 0), "CANDIDATO_AMBIGUO": (1, 1, 0), "EXCLUSION_ALTA": (1, 0, 1)}
    assert scoring.scored(scores(spark).limit(0), scoring.Weights(defined=True)).count() == 0


def test_weights_must_be_declared_and_sum_to_one(spark):
    for weights in (scoring.Weights(), scoring.Weights(0.5, 0.5, 0.5, defined=True)):
        with pytest.raises(RuntimeError):
            scoring.scored(scores(spark), weights)


def test_explanations(spark):
    parts = "array(named_struct('nombre', 'A', 'valor', 'x', 'contribucion', 2.0D), named_struct('nombre', 'B', 'valor', 'y', 'contribucion', 15.0D), named_struct('nombre', 'C', 'valor', 'z', 'contribucion', -3.0D), named_struct('nombre', 'D', 'valor', 'w', 'contribucion', 2.0D))"
    text = spark.range(1).select(scoring.explained(F.lit("alta"), F.lit(82.0), F.expr(parts)).alias("t")).first().t
    assert text == "Prioridad ALTA (82/100) — B (y, +15); A (x, +2); D (w, +2); C (z, -3)."
    bands = spark.createDataFrame([(70.0,), (69.9,), (45.0,), (1.0,), (None,)], "s double").select(scoring.priority_band(F.col("s")).alias("b")).collect()
    assert [r.b for r in bands] == ["ALTA", "MEDIA", "MEDIA", "BAJA", None]


def test_sizes_of_one_source_are_replaced(spark):
    from cauce.operators.dedup import FIELDS

    rows = spark.createDataFrame([(1, "bad", 1, "G4711", "x"), (2, "ok", 1, "MICRO", None), (3, "bad", 2, "A0150", None), (4, "bad", 2, "A0150", None), (5, "ok", 9, None, None)], "row_order bigint, source_id string, fila_origen bigint, tamano_empresa string, nit string")
    rows = rows.select("*", *[F.lit(None).cast("string").alias(f) for f in FIELDS if f not in ("tamano_empresa", "nit")])
    groups = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c")], "row_order bigint, entidad_dedup_id string")
    fixes = spark.createDataFrame([("bad", 1, "  Grande "), ("bad", 2, "n/a"), ("ok", 1, "never")], "source_id string, fila_origen bigint, tamano string")
    got = {r.entidad_dedup_id: r.tamano_empresa for r in scoring.corrected_sizes(rows, groups, fixes, "bad").collect()}
    assert got == {"a": "Grande", "b": None, "c": None}


# ---- legal registry, messages, register, export ----

RESPONSE = "nit_consultado string, ok boolean, orden int, nit string, digito_verificacion string, razon_social string, representante_legal string, estado_matricula string, matricula string, camara_comercio string, organizacion_juridica string"


def answered(spark):
    rows = [
        ("900123456", True, 1, "900123456", "8", "UNO S.A.S.", " ", "ACTIVA", "1", "C", "SOCIEDAD"), ("900000001", True, None, *[None] * 8), ("900000002", False, None, *[None] * 8),
        ("900000003", True, 1, "900000003", "3", "VIEJA", "Ana", "CANCELADA", "2", "C", None), ("900000003", True, 2, "900000003", "3", "NUEVA", "Eva", "ACTIVA", "3", "C", "PERSONA NATURAL"),
        ("900000004", True, 1, "900000004", "4", "A", None, "ACTIVA", "4", "C", None), ("900000004", True, 2, "900000004", "4", "B", None, "ACTIVA", "5", "C", None), ("900000005", True, 1, "900000005", "5", "OTRA COSA", "Luz", "CANCELADA", "6", "C", None),
        ("900000006", True, 1, "900000006", "6", "A", None, "ACTIVA", "4", "C", None), ("900000006", True, 2, "900000006", "6", "B", None, "RARA", "5", "C", None), ("900000007", True, 1, "900000007", "1", "SIETE", "Sol", "CANCELADA", "6", "C", None),
    ]
    prospects = [
        ("a", 1, "900.123.456-8", "Uno SAS en liquidación"), ("b", 2, "9000000018", "x"), ("c", 3, "9000000028", "x"), ("d", 4, "9000000033", "Nueva"), ("e", 5, "9000000044", "A"), ("f", 6, "9000000055", "Seis"), ("g", 7, "123", "x"), ("h", 8, None, "x"), ("i", 9, "9000000099", "x"),
        ("j", 10, "9000000066", "A"), ("k", 11, "9000000077", "Siete"), ("l", 12, "9000000071", "Siete"),
    ]
    return spark.createDataFrame(prospects, "entidad_dedup_id string, posicion_diversificada int, nit string, razon_social string").withColumn("ok", F.lit("clash")), spark.createDataFrame(rows, RESPONSE)


def test_outcomes_of_the_legal_registry(spark):
    prospects, responses = answered(spark)
    out = legal.enriched(prospects, responses)
    got = {r.entidad_dedup_id: r for r in out.collect()}
    assert {k: r.resultado_match for k, r in got.items()} == {
        "a": "MATCH_CONFIRMADO", "b": "NO_MATCH", "c": "ERROR_CONSULTA", "d": "MATCH_RESUELTO_HISTORICO", "e": "ERROR_CONSULTA", "f": "MATCH_CON_OBSERVACION", "g": "NO_CONSULTABLE", "h": "NO_CONSULTABLE", "i": "ERROR_CONSULTA", "j": "ERROR_CONSULTA",
        "k": "MATCH_CON_OBSERVACION", "l": "MATCH_CONFIRMADO",
    }
    assert got["a"].nit == "900.123.456-8" and got["a"].representante_legal == "no informado por la fuente" and got["d"].razon_social_confecamaras == "NUEVA" and got["d"].representante_legal == "no aplica"
    assert got["f"].representante_legal == "Luz" and got["e"].razon_social_confecamaras is None and got["b"].representante_legal is None and got["g"].nit_consultado is None and out.columns == legal.APPROVED
    assert {r.resultado_match: r.filas for r in legal.outcome_counts(out).collect()}["ERROR_CONSULTA"] == 4
    assert legal.enriched(prospects.limit(0), responses).count() == 0 and {r.resultado_match for r in legal.enriched(prospects, responses.limit(0)).collect()} == {"ERROR_CONSULTA", "NO_CONSULTABLE"}
    assert legal.check_enriched(out, 12).count() == 12
    for bad, n in ((out.withColumn(legal.FORBIDDEN, F.lit("1")), 12), (out.drop("nit"), 12), (out, 11), (out.withColumn("posicion_diversificada", F.lit(1)), 12), (out.withColumn("posicion_diversificada", F.col("posicion_diversificada") + 1), 12),
                   (out.withColumn("resultado_match", F.lit("X")), 12), (out.withColumn("entidad_dedup_id", F.lit("a")), 12), (out.withColumn("posicion_diversificada", F.col("posicion_diversificada").cast("string")), 12)):
        with pytest.raises(legal.EnrichmentError):
            legal.check_enriched(bad, n)


def test_kept_answers_are_not_asked_again(spark):
    prospects, _ = answered(spark)
    day = 24 * 3600
    cache = spark.createDataFrame(
        [("900123456", "MATCH_CONFIRMADO", 0), ("900000001", "NO_MATCH", 0), ("900000002", "NO_CONSULTABLE", 0), ("900000003", "MATCH_RESUELTO_HISTORICO", 4 * day), ("900000004", "ERROR_CONSULTA", 4 * day), ("900000005", "NO_MATCH", 2 * day)],
        "nit_consultado string, resultado_match string, guardado_en bigint",
    )
    assert {r.nit_consultado[-1] for r in legal.to_ask(prospects, cache, 4 * day).collect()} == {"1", "3", "4", "6", "7", "9"}


def test_prospects_from_a_list(spark, tmp_path):
    spark.createDataFrame([("e", 1, "0900", "U", "x")], "entidad_dedup_id string, posicion_diversificada int, nit string, razon_social string, score string").coalesce(1).write.option("header", True).csv(str(tmp_path / "l"))
    assert tuple(legal.read_prospects(spark, str(tmp_path / "l")).first()) == ("e", 1, "0900", "U")
    spark.createDataFrame([("e",)], "entidad_dedup_id string").write.option("header", True).csv(str(tmp_path / "m"))
    with pytest.raises(ValueError):
        legal.read_prospects(spark, str(tmp_path / "m"))


def test_messages_are_classified(spark):
    texts = [
        ("Hola, me interesa", "interes_comercial", "LOW", True), ("Hola", "saludo", "LOW", False), ("Mi código OTP es 123456", "otp_codigo", "CRITICAL", True), ("Mi Contraseña es x", "credenciales", "CRITICAL", True), ("la cédula y la contraseña", "credenciales", "CRITICAL", True),
        ("es muy caro", "objecion_precio", "MEDIUM", False), ("integrar con SAP", "erp_integracion", "HIGH", True), ("el número de documento de un tercero", "documentos_identidad", "CRITICAL", True), ("", "desconocido", "LOW", False), ("una demo, gracias", "interes_comercial", "LOW", True), (None, None, None, None),
    ]
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "i int, text string").withColumn("intent", F.lit("clash"))
    got = {r.i: r for r in messages.classified(df).collect()}
    assert [(got[i].intent, got[i].riesgo, got[i].requiere_aprobacion) for i in range(len(texts))] == [t[1:] for t in texts]
    assert got[2].confianza == 1.0 and got[0].confianza == 0.95 and got[0].palabra == "me interesa" and got[8].confianza == 0.0 and got[2].entidades.telefonos == []


def test_register(spark):
    rows = spark.createDataFrame([("a", "x", "q"), ("a", "", None), ("b", "y", "z")], "e string, canal string, otro string")
    assert [r.errores for r in register.vocabulary_errors(rows, {"canal": ["x"], "otro": ["z"], "ausente": ["k"]}).collect()] == [["otro: 'q' no es válido"], [], ["canal: 'y' no es válido"]]
    old = spark.createDataFrame([("a", "2"), ("a", "10"), ("c", None)], "e string, n string")
    assert {r.e: r.siguiente for r in register.next_numbers(old, "e", "n").collect()} == {"a": 11, "c": 1}
    assert sorted((r.e, r.otro, r.n) for r in register.appended(old, rows.filter("otro is not null").unionByName(rows.filter("e = 'a' and otro = 'q'").withColumn("otro", F.lit("r"))), "e", "n", "otro").collect()) == [("a", "q", 11), ("a", "r", 12), ("b", "z", 1)]
    blank = register.blank_records(rows.select("e").distinct(), ["e"], ["e", "n", "canal"], "e", "n", old).orderBy("e").collect()
    assert [(r.e, r.n, r.canal) for r in blank] == [("a", 11, ""), ("b", 1, "")]


def scored_rows(spark):
    rows = [(f"e{i:02d}", 100.0 - 0.3 * i, "Comercio / Retail" if i % 3 else "Salud", f"m{i % 5}", "SIN_COINCIDENCIA", "r", "n") for i in range(80)] + [("x", 99.0, None, None, "EXCLUSION_ALTA", None, None)]
    df = spark.createDataFrame(rows, "entidad_dedup_id string, score_prioridad_comercial double, sector_vertical string, municipio_nombre_normalizado string, estado_exclusion string, razon_social string, nit string")
    return df.withColumns({c: F.lit(None).cast("string") for c in ("direccion_comercial", "telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3", "email_comercial", "representante_legal")}).withColumn("sector", F.lit("clash"))


def test_export(spark, tmp_path):
    rows = scored_rows(spark)
    listed = reports.top_export(rows, 10)
    assert listed.columns == reports.EXPORTED and reports.check_list(listed, 10).count() == 10
    first = listed.orderBy("posicion_diversificada").first()
    assert first.score_prioridad_comercial == 100.0 and first.sector_vertical == "Salud" and first.sector_bucket_diversificacion == "Salud"
    with pytest.raises(reports.ListError):
        reports.top_export(rows.unionByName(rows.limit(3)), 10)
    for bad, n in ((listed, 9), (listed.drop("nit"), 10), (listed.withColumn("nit", F.lit(None).cast("string")), 10), (listed.withColumn("posicion_diversificada", F.col("posicion_diversificada") + 1), 10), (listed.withColumn("entidad_dedup_id", F.lit("e")), 10)):
        with pytest.raises(reports.ListError):
            reports.check_list(bad, n)
    assert reports.other_state(rows).count() == 1
    text = reports.comparison_report(reports.comparison(rows, (5, 10)))
    assert "## Top 5" in text and "## Top 10" in text and "| Salud |" in text


def test_ranking_rejects_and_counts_states(spark):
    rows = scored_rows(spark)
    with pytest.raises(ValueError):
        rank.checked(rows)
    assert rank.checked(rows.filter("entidad_dedup_id <> 'x'")).count() == 80 and tuple(rank.universe(rows).first()) == (81, 80, 0, 1)
    listed, figures = rank.ranked(rows, 10)
    r = figures.first()
    assert r.final == 10 == listed.count() and r.ventana == 50 and r.reemplazos == listed.filter("metodo = 'diversificacion'").count()
    moved = listed.filter("metodo = 'diversificacion'").collect()
    assert all(m.motivo and m.desplazada and abs(m.score - m.score_desplazada - m.diferencia) < 1e-9 for m in moved)
    assert rank.ranked(rows.limit(0), 10)[1].count() == 0


def test_filters(spark):
    rows = scored_rows(spark).withColumns({"departamento": F.lit("A"), "ciiu_1": F.lit("g4711"), "tamano_empresa": F.lit("micro")})
    top = lambda **k: reports.filtered_top(rows, reports.Filters(**k), 100).count()
    assert top() == 81 and top(en_pipeline=True) == 1 and top(en_pipeline=False) == 80 and top(prioridad="alta") == 81 and top(actividad="G47", departamento="A") == 81 and top(actividad="H") == 0 and top(con_contacto=True) == 0


def test_source_report(spark):
    catalogue = spark.createDataFrame([("s", "f.csv", "camara", "NIT;NOMBRE;EMPRESA;Raro", ";"), ("t", "g", None, None, None), ("i", "h", "interno_x", "NIT", ",")], "source_id string, archivo string, categoria string, encabezado string, delimitador string")
    rows = spark.createDataFrame([("s", True, False), ("s", False, None), ("s", False, True)], "source_id string, sin_identificador boolean, flag_codigo_dane_ambiguo boolean")
    got = {r.source_id: r for r in normalise.source_report(rows, catalogue).collect()}
    assert got["s"].pct_sin_identificador == "33.3" and got["s"].columnas_mapeadas == 3 and got["s"].columnas_sin_mapear == "Raro" and got["s"].colisiones == "razon_social<-NOMBRE,EMPRESA" and got["s"].registros_dane_ambiguo == 1 and len(got["s"]) == 11
    assert got["t"].registros == 0 and got["t"].pct_sin_identificador == "0.0" and {r.source_id for r in normalise.external(catalogue).collect()} == {"s", "t"}
