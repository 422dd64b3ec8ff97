import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cauce.operators import dedup, enrich, exclude, normalise, rank, reports
from cauce.operators.numbering import numbered
from cauce.sources import sinks

SOURCES = "source_id string, camara_grupo string"


def registry(spark, rows):
    """Rows of the few fields given; the other canonical fields are null."""
    extra = [f for f in dedup.FIELDS if f not in ("nit", "matricula", "razon_social", "telefono_comercial_1")]
    df = spark.createDataFrame(rows, "row_order bigint, source_id string, nit string, matricula string, razon_social string, municipio_nombre_normalizado string, telefono_comercial_1 string")
    return df.select("*", *[F.lit(None).cast("string").alias(f) for f in extra], F.col("razon_social").alias("razon_social_normalizada"), F.lit("f").alias("fuente_archivo"), F.lit("").alias("hoja_origen"), F.col("row_order").alias("fila_origen"))


ROWS = [
    (1, "s1", "900", "5", "A", "X", "1"), (2, "s1", "900", None, "A", "X", None), (3, "s2", "900", None, "A2", None, None),  # one place: one group
    (4, "s1", "901", None, "B", "X", None), (5, "s1", "901", None, "B", "X", "2"), (6, "s2", "901", "75", "B", "Y", None), (7, "s3", "901", "75", "B", None, None),  # two places: X; 6 and 7 by number
    (8, "s1", "111", "000", "C", "X", "9"), (9, "s1", "111", "000", "C", "X", "9"), (10, "s1", None, None, "C", "X", "9"), (11, "s1", None, None, None, None, None), (12, "s1", "902", None, "D", "X", None),
]


def test_entities_and_masters(spark):
    rows = registry(spark, ROWS)
    sources = spark.createDataFrame([("s1", "c1"), ("s2", "c2"), ("s3", "c2")], SOURCES)
    ids = {r.row_order: r for r in dedup.entities(dedup.keyed(rows, sources)).collect()}
    assert {k: v.entidad_dedup_id[-2:] for k, v in ids.items()} == {1: "01", 2: "01", 3: "01", 4: "02", 5: "02", 6: "03", 7: "03", 8: "04", 9: "05", 10: "06", 11: "07", 12: "08"}
    assert ids[3].metodo_deduplicacion == "nit" and ids[4].metodo_deduplicacion == "nit_multisede" and ids[6].confianza_deduplicacion == "media_alta" and ids[12].tamano_grupo == 1
    grouped = rows.join(dedup.entities(dedup.keyed(rows, sources)), "row_order")
    masters = {r.entidad_dedup_id[-2:]: r for r in dedup.masters(grouped).collect()}
    assert masters["01"].razon_social == "A" and masters["01"].matricula == "5" and masters["01"].campos_en_conflicto == "razon_social" and masters["01"].fuentes_consolidadas == "s1;s2"
    assert masters["02"].telefono_comercial_1 == "2" and masters["02"].fila_origen == 5 and len(masters) == 8
    flags = {r.row_order for r in dedup.master_flags(grouped.withColumn("completitud", dedup.completeness())).filter("es_registro_maestro").collect()}
    assert flags == {1, 5, 6, 8, 9, 10, 11, 12}
    conflicts = {(r.entidad_dedup_id[-2:], r.campo, r.valor): r.filas for r in dedup.conflict_values(grouped).collect()}
    assert conflicts == {("01", "razon_social", "A"): 2, ("01", "razon_social", "A2"): 1}


def test_conflicts_of_every_field(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(i, *[f"{f}{i}" if i < 3 else None for f in dedup.FIELDS]) for i in range(4)]
    spark.createDataFrame(rows, "row_order bigint, " + ", ".join(f"{f} string" for f in dedup.FIELDS)).withColumns({c: F.lit("x") for c in ("source_id", "fuente_archivo", "hoja_origen", "fila_origen", "razon_social_normalizada", "municipio_nombre_normalizado")}).write.parquet(str(tmp_path / "empresas_normalizado.parquet"))
    groups = [(0, "a"), (1, "a"), (2, "b"), (3, "b")]
    spark.createDataFrame(groups, "row_order bigint, entidad_dedup_id string").withColumns({"metodo_deduplicacion": F.lit("nit"), "confianza_deduplicacion": F.lit("alta")}).write.parquet(str(tmp_path / "grupos_deduplicacion.parquet"))
    got = {(r.entidad_dedup_id, r.campo, r.valor) for r in entry.queries()["ded15_conflicts"](spark, str(tmp_path)).collect()}
    assert got == {("a", f, f"{f}{i}") for f in dedup.FIELDS for i in (0, 1)}
    assert all(f"'{f}' AS campo" in entry.oracle_sql()["ded15_conflicts"] for f in dedup.FIELDS)


def test_ratio_of_different_names(spark, tmp_path):
    """Against the longest common subsequence by the textbook table."""
    import __spark_entry__ as entry

    def ratio(a, b):
        a, b = (" ".join(sorted(t.split())) for t in (a, b))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return 200.0 * best[-1][-1] / (len(a) + len(b))

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("ABCD") for _ in range(rng.randint(1, 30)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 4))), f"e{i % 7}") for i in range(60)]
    merged = {f"e{k}": " ".join(word() for _ in range(3)) for k in range(7)}
    spark.createDataFrame([r[:2] for r in rows] + [(99, None)], "row_order bigint, razon_social_normalizada string").write.parquet(str(tmp_path / "empresas_normalizado.parquet"))
    spark.createDataFrame([(r[0], r[2]) for r in rows] + [(99, "e0")], "row_order bigint, entidad_dedup_id string").write.parquet(str(tmp_path / "grupos_deduplicacion.parquet"))
    spark.createDataFrame(list(merged.items()), "entidad_dedup_id string, razon_social string").write.parquet(str(tmp_path / "empresas_deduplicado.parquet"))
    got = {r.row_order: r.ratio for r in entry.queries()["ded9_ratio_merged"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx({i: ratio(n, merged[e]) for i, n, e in rows}) and len({round(x) for x in got.values()}) > 10


def test_candidates(spark):
    rows = registry(spark, ROWS).filter("row_order between 8 and 10")
    found = dedup.name_place_candidates(rows).collect()
    assert [(r.grupo, r.filas, r.confianza) for r in found] == [("CAND-RSMUN-000001", 3, "media")]
    names = ["PANADERIA UNO", "PANADERIA UNA", "PANADERIA DOS LTDA", "PANADERO XYZ", "PANADERIA UNO X"]
    block = registry(spark, [(i, "s", None, None, n, "X", None) for i, n in enumerate(names)] + [(20 + i, "s", None, None, f"GRAN {i}", "Z", None) for i in range(4)])
    stars = sorted((r.row_order, r.ancla) for r in dedup.fuzzy_candidates(block, largest=5).collect())
    assert stars == [(0, 0), (1, 0), (4, 0)]
    assert dedup.fuzzy_candidates(block, largest=3).count() == 0
    assert dedup.fuzzy_candidates(block.limit(0)).count() == 0


def test_empty_tables(spark):
    rows = registry(spark, ROWS).limit(0)
    sources = spark.createDataFrame([], SOURCES)
    assert dedup.entities(dedup.keyed(rows, sources)).count() == 0
    assert dedup.name_place_candidates(rows).count() == 0
    assert enrich.repaired_codes(rows).count() == 0
    assert reports.completeness_by_field(rows, ["nit"]).first().porcentaje is None


def test_numbers_follow_the_order(spark):
    values = list(range(1000))
    random.Random(2).shuffle(values)
    rows = numbered(spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7), "v").collect()
    assert sorted((r.v, r.n) for r in rows) == [(v, v + 1) for v in range(1000)]


def test_code_repair(spark):
    codes = ["G4711", "I4711", "H4923", "4711", "4923", "0150", "A150", "9999", "x", "4,923", None, "NO LOCALIZADO 4711", "5555"]
    got = {r.ciiu_1: (r.estado, r.reconstruido) for r in enrich.repaired_codes(spark.createDataFrame([(c,) for c in codes], "ciiu_1 string")).collect()}
    assert got["4711"][0] == "ambiguo_no_reconstruido" and got["4923"] == ("reconstruido_inequivoco", "H4923") and got["0150"] == ("reconstruido_inequivoco", "A0150")
    assert got["9999"][0] == "placeholder_9999_excluido" and got["x"][0] == "formato_no_reconocido" and got["4,923"][1] == "H4923" and got["5555"][0] == "sin_evidencia_no_reconstruido" and got[None][0] == "no_aplica"


def test_reference_rank_against_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, -5.5, 0.0, *[round(rng.uniform(-100, 10000), 1) for _ in range(5)]]), rng.random() < 0.6) for _ in range(400)]
    got = {r.v: r.percentil for r in enrich.reference_rank(spark.createDataFrame(rows, "v double, r boolean"), "v", F.col("r")).collect()}
    reference = [v for v, r in rows if r and v is not None]
    assert got == pytest.approx({v: sum(x <= v for x in reference) / len(reference) for v, _ in rows if v is not None})
    none = spark.createDataFrame([(1.0, False)], "v double, r boolean")
    assert enrich.reference_rank(none, "v", F.col("r")).first().percentil is None


def test_exclusion_order(spark):
    entities = spark.createDataFrame([("e1", "900.1", "A", "X"), ("e2", "111", "B", "X"), ("e3", None, "B", None), ("e4", None, None, None), ("e5", "5", "Z", "Z")], "entidad_dedup_id string, nit string, razon_social_normalizada string, municipio_nombre_normalizado string")
    internal = spark.createDataFrame([(1, "crm", "9001", None, "q", None, "t1"), (2, "crm", "9001", None, "q", None, "t0"), (3, "hub", "111", None, "b", "x", None), (4, "hub2", None, None, "B", "Y", None)], "internal_order bigint, fuente_interna string, nit string, matricula string, razon_social string, municipio string, tipo_antecedente string")
    keys = exclude.internal_keys(internal)
    got = {r.entidad_dedup_id: (r.tipo, r.fuentes) for r in exclude.exact_matches(entities, keys).collect()}
    assert got == {"e1": ("nit_exacto", "crm"), "e2": ("razon_social_municipio", "hub"), "e3": ("razon_social_sola", "hub;hub2")}
    assert [r.tipo_antecedente for r in exclude.by_identifier(entities, keys).collect()] == ["t1"]
    assert exclude.exact_matches(entities.limit(0), keys).count() == 0 and exclude.exact_matches(entities, keys.limit(0)).count() == 0


def test_similar_names_of_every_pending_entity(spark):
    """Against all pairs, in a place larger than the method's bound; matched entities neither come out nor count."""
    from cauce.functions.similarity import common_subsequence

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("ABCDEÑ1") for _ in range(rng.randint(3, 6)))
    theirs = [f"{word()} {word()} {word()}" for _ in range(40)]
    mine = [rng.choice(theirs)[rng.randint(0, 2) :] + rng.choice(["", "X", " YZ"]) for _ in range(340)] + [f"{word()} {word()}" for _ in range(30)]
    entities = [(f"e{i}", None, None, "s1", " ".join(n.split()), "X") for i, n in enumerate(mine)]
    entities += [("nit", "900123", None, "s1", theirs[0] + "A", "Y"), ("number", None, "7712", "s1;s2", theirs[0] + "A", "Y"), ("far", None, "7712", "s2", theirs[0] + "A", "Y")]
    internal = [(i, "crm", None, None, n, p, None) for i, n in enumerate(theirs) for p in "XY"] + [(900, "crm", "900123", None, None, None, None), (901, "hub", None, "7712", None, None, None)]
    df = spark.createDataFrame(entities, "entidad_dedup_id string, nit string, matricula string, fuentes_consolidadas string, razon_social_normalizada string, municipio_nombre_normalizado string")
    keys = exclude.internal_keys(spark.createDataFrame(internal, "internal_order bigint, fuente_interna string, nit string, matricula string, razon_social string, municipio string, tipo_antecedente string"))
    sources = spark.createDataFrame([("s1", "c1"), ("s2", "c2")], SOURCES)
    left = exclude.pending(df, keys, sources, "c1")
    got = {r.entidad_dedup_id: r.mejor for r in exclude.similar_names(left, keys).collect()}
    known = {k.nombre for k in keys.filter("nombre is not null").collect()}

    def ratio(a, b):
        a, b = (" ".join(sorted(t.split())) for t in (a, b))
        return 200.0 * common_subsequence(a, b) / (len(a) + len(b))

    best = {e[0]: max(ratio(e[4], k) for k in known) for e in entities if e[4] not in known and e[0] not in ("nit", "number")}
    want = {k: v for k, v in best.items() if v >= exclude.THRESHOLD}
    assert got == pytest.approx(want) and "far" in got and len(got) > 60
    one_place = df.filter("municipio_nombre_normalizado = 'Y'")
    assert {r.entidad_dedup_id for r in exclude.similar_names(exclude.pending(one_place, keys, sources, "c1"), keys, largest=40).collect()} == {"far"}
    assert exclude.similar_names(left, keys, largest=39).count() == 0


def test_ranking_on_a_prefix_is_that_of_all_rows(spark):
    rng = random.Random(4)
    for n in (5, 20):
        rows = []
        for i in range(1500):
            s = rng.choice(["A"] * 8 + ["B", "C"])
            rows.append((f"id{i}", round(100 - i * 0.03 + (0 if s == "A" else -3), 1), s, rng.choice(["p"] * 5 + ["q", "r", "t"])))
        b = pd.DataFrame(rows, columns=["id", "score", "sector", "lugar"]).sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
        for column, short, (low, high, hard) in (("sector", "s", rank.SECTOR_SHARES), ("lugar", "l", rank.PLACE_SHARES)):
            p = b[column].map(b[column].value_counts(normalize=True))
            b["p" + short], b["a" + short + ("_" if short == "s" else "")] = p, (3 * p).clip(low, high)
            b["t" + short] = ((3 * p).clip(low, high) + 0.1).clip(low, hard)
        everything, _, figures = rank.select(b, n, True)
        assert figures["final"] == len(everything) and figures["reemplazos"] == sum(c[1] == "diversificacion" for c in everything)
        for size in (30, 100, 400):
            part, exact, _ = rank.select(b.head(size), n, False)
            assert not exact or part == everything
        assert rank.select(b.head(1200), n, False)[1]


def test_diversified_list(spark):
    rows = [(f"e{i}", 100 - 0.3 * i, "Comercio / Retail", f"m{i % 5}", "SIN_COINCIDENCIA") for i in range(80)] + [(f"f{i}", 75 - 0.3 * i, "Salud", f"m{i % 5}", "SIN_COINCIDENCIA") for i in range(20)]
    rows += [("x", 99.0, None, None, "EXCLUSION_ALTA"), ("y", None, None, None, "SIN_COINCIDENCIA")]
    df = spark.createDataFrame(rows, "entidad_dedup_id string, score_prioridad_comercial double, sector_vertical string, municipio_nombre_normalizado string, estado_exclusion string")
    top = rank.diversified(df, 10).toPandas()
    assert len(top) == 10 and list(top.posicion_diversificada) == list(range(1, 11)) and top.posicion_pura.max() > 10 and (top.sector == "Salud").any()
    again = rank.diversified(df.repartition(5), 10).toPandas()
    assert list(again.entidad_dedup_id) == list(top.entidad_dedup_id)
    assert rank.diversified(df.limit(0), 10).count() == 0
    with pytest.raises(ValueError):
        rank.diversified(df, 0)
    assert reports.filtered_top(df.withColumns({c: F.lit(None).cast("string") for c in ("telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3", "email_comercial", "tamano_empresa")}), reports.Filters(sector="Salud", score_minimo=74.0), 3).count() == 3


def test_canonical_projection(spark):
    source = spark.createDataFrame([("  ", "b", "x"), ("a", "b", " n/a ")], "`Razón  Social` string, NOMBRE string, nit string")
    synonyms = {"razon_social": ["RAZON SOCIAL", "NOMBRE"], "nit": ["IDENTIFICACION"]}
    out = normalise.canonical(source, synonyms, ["razon_social", "nit", "matricula"]).collect()
    assert [r.razon_social for r in out] == ["b", "a"] and out[0].nit is None and out[0].matricula is None
    with pytest.raises(ValueError):
        normalise.inverted({"a": ["X"], "b": ["x"]})


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "pos int, id string")
    raw = tmp_path / "raw"
    with pytest.raises(PermissionError):
        sinks.write_parquet(df, str(raw / "x"), str(raw))
    sinks.write_list(df, str(tmp_path / "out"), str(raw), ["id", "pos"], "pos")
    assert [r.id for r in spark.read.option("header", True).csv(str(tmp_path / "out")).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        sinks.write_list(df.withColumn("pos", F.lit(1)), str(tmp_path / "o2"), str(raw), ["id"], "pos")


def test_no_join_of_everything_with_everything(spark):
    folder = "/root/testdata/sf0.001"
    import os

    if not os.path.isdir(folder):
        pytest.skip("no test data")
    import __spark_entry__ as entry

    for name in ("ded5_merged_keys", "enr4_repaired_codes", "exc10_exact_matches", "div5_place_limits", "p7_found"):
        plan = entry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_work_tables_can_be_cleared(spark):
    from pathlib import Path

    from cauce.session import clear_work, cut, work_folder

    clear_work(spark)
    folder = Path(work_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    assert cut(spark.range(5).toDF("x")).count() == 5
    assert len(set(folder.iterdir()) - before) == 1
    assert clear_work(spark) == 1 and not set(folder.iterdir()) - before
