from collections import Counter

import numpy as np

from cauce.llm import variety

SCHEMA = "entidad_dedup_id string, sector_vertical string, municipio_nombre_normalizado string, score_prioridad_comercial double, razon_social string, nit string, estado_exclusion string"


def data(spark):
    names = ["ZULINESO", "MOPECHAVI", "TARILEMBU", "VELOTOGRI", "GUNAROSFE", "PIXANIDRE", "DROLEYOLLO", "SAKIXATE"]
    rows = []
    for i in range(900):
        sector = ["Comercio", "Comercio", "Comercio", "Salud", None, "Agro"][i % 6] if i % 30 else f"Raro {i // 30 % 3}"
        rows.append((f"e{i}", sector, ["ALMIRA", "ALMIRA", "almirra", "BRESAL", None, "?"][i % 6], float(i % 97), f"TIENDA {names[i % 8]}{i // 8 % 9} {names[i // 8 % 8]}{'ABCDEFGHIJKLMNO'[i % 15]}", str(800000000 + i * 7), "SIN_COINCIDENCIA"))
    rows += [(f"copy{i}", "Salud", "BRESAL", 50.0, "CLINICA UNICORNIA COPIADA", None, "SIN_COINCIDENCIA") for i in range(200)]
    rows += [("out", "Salud", "BRESAL", 99.0, "X", None, "EXCLUSION_ALTA"), ("unscored", "Salud", "BRESAL", None, "Y", None, "SIN_COINCIDENCIA"), ("nameless", None, None, 3.0, None, None, "SIN_COINCIDENCIA")]
    reference = spark.createDataFrame([("91001", "ALMIRA", "A"), ("92002", "BRESAL", "B")], "codigo_dane string, nombre string, departamento string")
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' as sector", "1 as grupo", "'x' as lote", "if(score_prioridad_comercial > 60, 'GRANDE', 'micro') as tamano_empresa", "if(nit like '%7', '1.200', 'muchos') as num_empleados", "'2,020' as ultimo_ano_renovado",
        "nit as telefono_comercial_1", "null as telefono_comercial_2", "'' as telefono_comercial_3", "nit as email_comercial",
    ), reference


def test_subset(spark):
    rows, reference = data(spark)
    got = variety.subset(rows, reference, size=80, clusters=12).collect()
    assert len(got) == 80 == len({r.entidad_dedup_id for r in got})
    ids = {r.entidad_dedup_id for r in got}
    assert not ids & {"out", "unscored"} and sum(i.startswith("copy") for i in ids) <= 1
    sectors = Counter(r.sector for r in got)
    assert len(sectors) >= 6  # of seven
    assert sectors["COMERCIO"] < 80 * 0.5  # half of the universe
    assert sum(r.score_prioridad_comercial for r in got) / 80 > 55  # the universe has 48
    again = variety.subset(rows.repartition(7), reference, size=80, clusters=12).collect()
    assert {r.entidad_dedup_id for r in again} == ids


def test_small_and_empty(spark):
    rows, reference = data(spark)
    few = rows.filter("entidad_dedup_id in ('e1', 'e2', 'nameless')")
    assert {r.entidad_dedup_id for r in variety.subset(few, reference, size=10, clusters=4).collect()} == {"e1", "e2", "nameless"}
    assert variety.subset(rows.limit(0), reference, size=10).count() == 0


def test_vectors_count_the_attributes_that_differ(spark):
    rows, reference = data(spark)
    ready = variety.prepared(rows, reference)
    vectors = variety.vectors_of(ready)
    b = ready.orderBy("id").toPandas()
    codes, numbers = vectors.of(b)
    dense = vectors.dense(codes, numbers)
    assert dense.shape[1] == vectors.width and ((dense > 0).sum(1) >= len(variety.WEIGHTS)).all()
    rng = np.random.default_rng(1)
    centres = rng.random((7, vectors.width))
    assert (vectors.nearest(codes, numbers, centres) == ((dense[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)).all()
    total = np.zeros((7, vectors.width))
    at = vectors.nearest(codes, numbers, centres)
    vectors.add(total, at, codes, numbers)
    assert np.allclose(total, np.stack([dense[at == c].sum(0) for c in range(7)]))


def test_clusters_cover_more_than_chance(spark):
    rows, reference = data(spark)
    got = {r.metodo: r for r in variety.contrast(rows, reference, 60).collect()}
    assert got["grupos"].celdas >= got["azar"].celdas and got["grupos"].score > got["azar"].score and got["grupos"].mayor_sector <= got["azar"].mayor_sector


def test_quotas():
    assert variety.quotas({0: 100, 1: 4, 2: 1}, 30) == {0: 25, 1: 4, 2: 1}
    assert sum(variety.quotas({0: 900, 1: 400, 2: 100}, 60).values()) == 60 and variety.quotas({0: 900, 1: 400, 2: 100}, 60) == {0: 30, 1: 20, 2: 10}
    assert variety.quotas({0: 900, 1: 400, 2: 100}, 60, equal=True) == {0: 20, 1: 20, 2: 20}
    assert variety.quotas({}, 5) == {} and variety.quotas({0: 3}, 5) == {0: 3}
