import itertools
import random

import pytest
from pyspark.sql import functions as F

from cauce.llm import address_text, addresses, edits, links, name_text, names

REFERENCE = [("91001", "ALMIRA", "A"), ("92002", "BRESAL", "B")]


def test_roots_follow_chains(spark):
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(20)] + [("a", "b")], "id string, parent string")
    got = {r.id: r.root for r in links.roots(chain).collect()}
    assert got == {**{str(i): "20" for i in range(20)}, "a": "b"}
    assert links.roots(chain.limit(0)).count() == 0


def test_pairs_against_all_pairs(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("gh"), rng.choice([f"v{k}" for k in range(5)])) for i in range(60)] + [(100 + i, "hot", "same") for i in range(300)] + [(500, "hot", "other")]
    got = sorted(tuple(r) for r in links.pairs_across(spark.createDataFrame(rows, "k bigint, g string, v string"), "k", ["g"], ["v"]).collect())
    assert got == sorted((a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[1] == b[1] and a[2] != b[2])


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("CL 80 Nro. 42A -61", "calle 80 # 42 a-61, apto 3", True), ("CLL 80 No 42A-61", "CLL 80 No 42A-62", False), ("TRANSV 153 B SUR Nro. 101 A 88 Of. 27", "TV 153B S # 101A-88", True), ("Diag. 83A ESTE 94BIS O2 APTO 361", "DG 83A ESTE 94 BIS - 02", True),
        ("KR3OA ESTE 82A 44", "Kra. 30A ESTE 82A - 44", True), ("CARERA l33 C Sur N° 110bis 46", "CR 133C SUR 110 BIS 46", True), ("cra decima este no 72 -72", "CR 10 ESTE #72 -72", True), ("APTO 318 KR 24 Nro. 89A-40", "CRA 24 89 A 40 LC 2", True),
        ("CL 24 # 89-40", "KR 24 # 89-40", False), ("CL 24 SUR # 89-40", "CL 24 # 89-40", False), ("FINCA X LA Y VDA ZETA", "VEREDA ZETA, FCA. X LA Y ZONA RURAL", True), ("CL 24", "CL 24", False), ("", "", False), (None, "CL 1 # 2-3", False), (".", "?", False),
    ],
)
def test_reading_addresses(a, b, same):
    x, y = address_text.parse(a), address_text.parse(b)
    assert (x is not None and x == y) == same


def test_very_long_addresses_are_read():
    assert address_text.parse("A" * 50_000) is None
    assert address_text.parse("CL 1 # 2-3 " + "x " * 20_000) == address_text.parse("CL 1 # 2-3")


def test_same_place(spark):
    rows = [
        (1, "CL 80 # 42-61", "ALMIRA", None), (2, "CALLE 80 No. 42 - 61 AP 3", "almira", None), (3, "CL 80 # 42-61", "BRESAL", None), (4, "CLL 80 42 61", None, None), (5, "CL 80 # 42-61", "ALMIRA", None), (6, None, "ALMIRA", None), (7, "NULL", "ALMIRA", None),
        (8, "VDA TORFLOCHANA FCA CHEBROGUBA", "ALMIRA", None), (9, "FINCA CHEBROGUBA VEREDA TOFRLOCHANA", "ALMIRA", None), (10, "FCA CHEBROGUBA VDA TORFLOCHANA ZONA RURAL", "ALMIRA", None), (11, "FCA CHEBROGUBA VDA QUILANDIA", "ALMIRA", None), (12, "TV 80 # 42-61", "ALMIRA", None),
    ]
    df = spark.createDataFrame(rows, "row_order bigint, direccion_comercial string, municipio_comercial string, departamento string").selectExpr("*", "upper(municipio_comercial) as municipio_nombre_normalizado", "'x' as lugar", "1 as id")
    reference = spark.createDataFrame(REFERENCE, "codigo_dane string, nombre string, departamento string")
    got = sorted(tuple(r) for r in addresses.same_place_pairs(df, reference).collect())
    assert got == [(1, 2), (1, 4), (2, 4), (2, 5), (3, 4), (4, 5), (8, 9), (8, 10), (9, 10)]
    assert addresses.same_place_pairs(df.limit(0), reference).count() == 0


def test_every_place_meets_every_other_of_its_district(spark):
    """Against all pairs: errors in the first letters of either part, in districts and farm names of many places."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("BCDFGLMNRT") + rng.choice("AEIOU") for _ in range(n))
    farms = [word(rng.randint(2, 4)) for _ in range(40)]
    parts = [("r", d, f, "") for d in ("TORFLOCHANA", "PERDIGUERO") for f in farms]
    parts += [("r", "TORFLOCHANA", f[1:], "") for f in farms[:20]] + [("r", "PERDIGUERO", f[1] + f[0] + f[2:], "") for f in farms[20:]] + [("r", "XORFLOCHANA", f, "") for f in farms[:9]]
    parts += [("u", f"{i}", "2-3", w) for i in range(3) for w in ("CL", "KR", "?KR", "?CARRETERX", "CARRETERA")]
    rows = sorted({("/".join(p), *p, (1, "/".join(p))) for p in parts})
    vertices = spark.createDataFrame(rows, "id string, kind string, first string, second string, word string, rank struct<n: bigint, id: string>")
    x, y = (vertices.select(F.struct("*").alias(s)) for s in "xy")
    want = {tuple(r) for r in x.crossJoin(y).filter("x.id < y.id").filter(addresses._same_place(F.col("x"), F.col("y"))).select("x.id", "y.id").collect()}
    assert any(a.startswith("r/TORFLOCHANA") and b.startswith("r/XORFLOCHANA") for a, b in want)
    for window in (2, 10, 200):
        got = {tuple(sorted((r.a, r.b))) for r in addresses.neighbour_edges(vertices, window=window).collect()}
        assert got == want


def test_windows_cross_the_edges_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(addresses, "BLOCK", 7)
    rows = [(f"u/{i // 3}/2-3/{w}", "u", f"{i // 3:03d}", "2-3", w, (1, f"{i}")) for i in range(90) for w in [("CL", "?CALLX", "?CALLEX")[i % 3]]]
    vertices = spark.createDataFrame(rows, "id string, kind string, first string, second string, word string, rank struct<n: bigint, id: string>")
    got = {tuple(sorted((r.a, r.b))) for r in addresses.window_edges(vertices, "first", "word", window=3).collect()}
    assert got == {tuple(sorted(p)) for k in range(30) for p in itertools.combinations([f"u/{k}/2-3/{w}" for w in ("CL", "?CALLX", "?CALLEX")], 2)}


def test_a_class_has_one_town(spark):
    rows = spark.createDataFrame([(1, "p", "A"), (2, "p", "A"), (3, "p", "B"), (4, "p", None), (5, "q", "A"), (6, "q", None), (7, "s", None), (8, "s", None)], "row_order bigint, lugar string, mun string")
    got = {r.row_order: (r.clase, r.codigo_dane, r.filas) for r in addresses.members(rows).collect()}
    assert got == {1: ("p@A", "A", 2), 2: ("p@A", "A", 2), 3: ("p@B", "B", 1), 4: ("p@", None, 1), 5: ("q@A", "A", 2), 6: ("q@A", None, 2), 7: ("s@", None, 2), 8: ("s@", None, 2)}
    assert sorted(tuple(r) for r in addresses.class_links(rows).collect()) == [("p@", "p@A"), ("p@", "p@B")]
    assert addresses.members(rows.limit(0)).count() == 0 and addresses.class_links(rows.limit(0)).count() == 0


def test_a_common_end_loses_no_edge(spark, monkeypatch):
    """Names of one part with an end in common, on either side of the bound."""
    rng = random.Random(12)
    tails = ["".join(rng.choice("BCMRT") + rng.choice("AEO") for _ in range(rng.randint(1, 5))) for _ in range(50)]
    cores = sorted({*(f"RODRIGUEZ{t}" for t in tails), *(f"RODRIGUEZ{t[1:]}X" for t in tails[:30]), *(f"{t}RODRIGUEZ" for t in tails[:20]), *(" ".join(sorted(("RODRIGUEZ", f"{t}MORA"))) for t in tails)})
    read = spark.createDataFrame([(c, 1 + i % 5) for i, c in enumerate(cores)], "core string, n long").select(*names.parts_of(F.col("core")), "n")
    found = []
    for bound in (5, 100_000):
        monkeypatch.setattr(names, "COMMON_PART", bound)
        found.append({(*sorted((r.a, r.b)), r.d) for r in names.joined_edges(read).collect()})
    assert found[0] == found[1] and len(found[0]) > 50


@pytest.mark.parametrize("meant,typed,ops", [("GOMEZ PARDO", "GOMEZ PARDO", {}), ("GOMEZ PARDO", "PARDO G0MEZ", {"alike": 1}), ("GOMEZ PARDO", "GOMMEZ PADRO", {"doubled": 1, "swapped": 1}), ("MONTENEGRO PARDO", "MONTE PARDO", {"cut": 1}), ("GOMEZ PARDO", "GOMEZPARD", {"lost": 1}), ("GOMEZ", "GOXEZT", {"changed": 1, "added": 1})])
def test_kinds_of_edits(meant, typed, ops):
    assert {k: n for k, n in zip(edits.KINDS, edits.operations(meant, typed), strict=True) if n} == ops


def test_costs_are_learned_from_what_was_typed(spark):
    """Where letters are mostly swapped, a swap comes to cost less than a letter lost, and decides between two names."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("BCDFGLMNRT") + rng.choice("AEIOU") for _ in range(5))
    swap = lambda w, i: w[:i] + w[i + 1] + w[i] + w[i + 2 :]
    cores = {}
    for _ in range(80):
        a, b = word(), word()
        cores[f"{a} {b}"] = 9
        cores[f"{swap(a, rng.randrange(1, 8))} {b}"] = 1
    cores |= {"GATERO PILUMO": 9, "GATRO PILUMO": 9, "GATREO PILUMO": 1}
    vertices = spark.createDataFrame([(" ".join(sorted(k.split())), n) for k, n in cores.items()], "core string, n long")
    typed = names.typed_otherwise(names.edges_of(vertices)).cache()
    costs = dict(zip(edits.KINDS, names.learned_costs(typed), strict=True))
    assert costs["swapped"] < costs["lost"] - 1 and costs["swapped"] < costs["added"] - 1
    assert {r.id: r.parent for r in names.best_meant(typed, list(costs.values())).collect()}["GATREO PILUMO"] == "GATERO PILUMO"
    assert names.learned_costs(typed.limit(0)) == [names.EDIT_COST] * len(edits.KINDS)


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("FERRETERIA GAZEXAVI GRIMOCOLEM S.A.S", "GAZEXAVI GRIMOCOLEM FERR SOCIEDAD POR ACCIONES SIMPLIFICADA", True), ("MECHE NIQUIVINI COXANEGU", "NIQUIVINI COXANEGU, MERCEDES", True), ("J. G KAPUPASA MUTECALA", "JOSE GUADALUPE KAPUPASA MUTECALA", True),
        ("CLÃ\x8dNICA ZEQUICHAPLA BEMIPOPLA", "CLINICA ZEQUICHAPLA BEMIPOPLA LTDA", True), ("RO5DAPAPO PECHATRURI", "ROSDAPAPO PECHATRURI", True), ("HOTEL AAAAAA BBBBBB", "HOTEL AAAAAA CCCCCC", False),
    ],
)
def test_reading_names(a, b, same):
    assert (sorted(name_text.parse(a).core) == sorted(name_text.parse(b).core)) == same


def test_name_variants(spark):
    texts = [
        "DROGUERIA NAZATAVO VOGRIPLAFLO S.A.S", "NAZATAVO VOGRIPLAFLO DROG SAS", "DROGUERIA NAZATAVO VOGRIPALFLO", "DROGUERIA NAZATAVOVOGRIPLAFLO", "VOGRIPLAFLO NAZATAVO LTDA", "DROGUERIA NAZA TAVO VOGRIPLAFLO",
        "DROGUERIA NAZATAVO PELUMACHE", None, "", "S.A.S", "DROGUERIA NAZATAVO VOGRIPLAFLO S.A.S", "X" * 20_000,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_order bigint, razon_social_normalizada string").selectExpr("*", "'x' as core", "'y' as clase")
    got = {tuple(r) for r in names.variant_pairs(df).collect()}
    one = [0, 1, 2, 3, 4, 5, 10]
    assert got == {(a, b) for a, b in itertools.combinations(one, 2) if texts[a] != texts[b]}
    assert names.variant_pairs(df.limit(0)).count() == 0


def test_a_common_part_makes_no_block_of_all(spark, monkeypatch):
    """Beyond the bound a piece of the other part is asked for; typos there are still attached."""
    monkeypatch.setattr(names, "COMMON_PART", 5)
    rng = random.Random(7)
    others = ["".join(rng.choice(["MA", "TO", "RI", "LU", "PE", "ZA"]) for _ in range(5)) for _ in range(40)]
    texts = [f"GARCILASO {o}" for o in others] + [f"GARCILASO {o[:-1]}X" for o in others[:10]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_order bigint, razon_social_normalizada string")
    classes = {r.row_order: r.clase for r in names.classed(df).collect()}
    assert all(classes[40 + i] == classes[i] for i in range(10))


def test_a_common_part_loses_no_edge(spark, monkeypatch):
    """The edges are the same on either side of the bound: edits without an intact piece, misspelt common parts, parts alike."""
    rng = random.Random(10)
    words = ["".join(rng.choice("BCMRT") + rng.choice("AEO") for _ in range(rng.randint(2, 5))) for _ in range(60)]

    def typo(w, n):
        for _ in range(n):
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", "X", w[i] + "Z"]) + w[i + 1 :]
        return w or "X"

    pairs = [("RODRIGUEZ", w) for w in ["MORENO", "NOREMO", *words, *[typo(w, rng.randint(1, 4)) for w in words]]]
    pairs += [(p, typo(w, 2)) for p in ("RODRRIGUEZ", "RODRIXGUEZ", "RODROGUEZ") for w in words[:20]] + [("RODRIGUEZ", "RODRYGUES"), ("RODRIGEUZ", "RODRIGUEZ"), ("RODRIXGUEZ", "ROTRIGUEZ"), ("RODRIGUEZ", "ROTRIGUEZX")]
    cores = sorted({" ".join(sorted(p)) for p in pairs})
    read = spark.createDataFrame([(c, 1 + i % 7) for i, c in enumerate(cores)], "core string, n long").select(*names.parts_of(F.col("core")), "n")
    found = []
    for bound in (5, 100_000):
        monkeypatch.setattr(names, "COMMON_PART", bound)
        found.append({(*sorted((r.a, r.b)), r.d) for r in names.whole_edges(read).collect()})
    assert found[1] <= found[0] and ("MORENO RODRIGUEZ", "NOREMO RODRIGUEZ") in {e[:2] for e in found[0]}
    assert found[0] == found[1]
