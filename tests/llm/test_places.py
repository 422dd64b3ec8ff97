import random

import pytest

from cauce.llm import edits, places

REFERENCE = [("91001", "ALMIRA", "ALTOVERDE"), ("94004", "DRUNELA", "LLANO CLARO"), ("97200", "DRUNELA", "RIBERA ALTA"), ("97042", "SANTA DRUNELA", "RIBERA ALTA"), ("94032", "ALTO DE JOMOYA", "LLANO CLARO"), ("97035", "PUERTO GRICOMEN", "RIBERA ALTA"), ("95012", "MESTIVA", "SIERRA ONDA"), ("92009", "IZARCO", "BAJO SERENA")]


@pytest.mark.parametrize(
    "text,dept,code",
    [
        ("ALMIRA", None, "91001"), ("a1mira", None, "91001"), ("ALM IRA", None, "91001"), ("ALIMRA", None, "91001"), ("Ciudad de Almíra", None, "91001"), ("91001-almira", None, "91001"), ("91001", None, "91001"),
        ("DRUNELA", "RIBERA ALTA", "97200"), ("DRUNELA", "LLANO CLARO", "94004"), ("DRUNELA", None, "94004"), ("DRUNELA / RIBE.", None, "97200"), ("LLANO CLARO - DRUNELA", None, "94004"), ("SANTADRUNELA", None, "97042"),
        ("STA DRUNELA", None, "97042"), ("PTO GRICOMEN", None, "97035"), ("ALTO JOMOYA", None, "94032"), ("ALTO DEEE JOMOYA", None, "94032"), ("cgto el paso - mestiva", None, "95012"), ("VEREDA LA HONDA MESTIVA", None, "95012"),
        ("IZARCO (BAJO SERENA)", None, "92009"), ("CASA MATRIZ", None, "NINGUNO"), ("LLANO CLARO (DEPTO)", None, "NINGUNO"), ("?", None, "NINGUNO"), ("", None, "NINGUNO"), (None, "ALTOVERDE", "NINGUNO"), ("00000", None, "NINGUNO"),
        ("DEPARTAMENTO DE ALTOVERDE", None, "NINGUNO"), ("x" * 5000, None, "NINGUNO"),
    ],
)
def test_typed_places(text, dept, code):
    assert places.PlaceIndex(REFERENCE, {"94004": 9}).resolve(text, dept) == code


LONG = [("98001", "VILLANUEVARICA", "A"), ("98002", "SANTAMARTINA", "A"), ("98003", "SAN JOSE DE LA MONTANA", "B")]


def test_every_typo_within_the_limit_is_found():
    """Against a comparison with every entry: none within reach is lost, whatever the edits."""
    index = places.PlaceIndex(REFERENCE + LONG)
    rng = random.Random(5)
    forms = [f for f in index.entries if len(f) >= 4]
    hits = 0
    for _ in range(1500):
        word = rng.choice(forms)
        typed = word
        for _ in range(rng.randrange(1, 6)):
            i, c = rng.randrange(len(typed)), rng.choice("AEIOUBCDR01358")
            alike = rng.choice([x for group in edits.ALIKE for x in group if typed[i] in group] or [c])
            typed = rng.choice([typed[:i] + typed[i + 1 :], typed[:i] + c + typed[i:], typed[:i] + c + typed[i + 1 :], typed[:i] + alike + typed[i + 1 :], typed[:i] + typed[i] + typed[i:], typed[:i] + typed[i + 1 : i + 2] + typed[i] + typed[i + 2 :]]) or "X"
        if typed in index.entries:
            continue
        limit = index.limit(typed)
        brute = {f for f in index.entries if edits.weighted_dl(typed, f) <= min(limit, 0.34 * len(f)) and edits.osa(edits.folded(typed), edits.folded(f), 9) <= limit + 1}
        assert {f for _, f in index.near(typed)} == brute
        hits += bool(brute)
    assert hits > 500


@pytest.mark.parametrize("typed,code", [("VILXANUEXARIXA", "98001"), ("WILXANUEVARICX", "98001"), ("SXNTXMARTINX", "98002"), ("V1LLLANU3VAR1CCA", "98001"), ("VILXANUEXARXXA", "NINGUNO"), ("SAN XOSE DE LA MXNTANX", "98003")])
def test_three_edits_in_long_names(typed, code):
    assert places.PlaceIndex(REFERENCE + LONG).resolve(typed) == code


def test_distances():
    assert edits.osa("AB", "BA", 2) == 1 and edits.osa("ABC", "ABC", 0) == 0 and edits.osa("ABCD", "WXYZ", 2) == 3
    assert edits.weighted_dl("HOLA", "H0LA") == 0.5 and edits.weighted_dl("HOLLA", "HOLA") == 0.5 and edits.weighted_dl("AB", "BA") == 1.0 and edits.weighted_dl("ABC", "XYZ", 1.0) == 2.0


def test_rows(spark):
    rows = spark.createDataFrame(
        [(1, "Almira", "ALMIRA", None, "x"), (2, "ALIMRA", "ALIMRA", None, "x"), (3, None, None, "ALTOVERDE", "x"), (4, "DRUNELA", "DRUNELA", "RIBERA ALTA", "x"), (5, "XXXX", "XXXX", None, "x"), (6, "ALIMRA", "ALIMRA", None, "x"), (7, "n/a", None, None, "x")],
        "row_order bigint, municipio_comercial string, municipio_nombre_normalizado string, departamento string, codigo_dane string",
    )
    reference = spark.createDataFrame(REFERENCE, "codigo_dane string, nombre string, departamento string")
    got = {r.row_order: r.codigo_dane for r in places.mapped(rows, reference).collect()}
    assert got == {2: "91001", 4: "97200", 5: "NINGUNO", 6: "91001", 7: "NINGUNO"}
    assert {(r.municipio_comercial, r.filas) for r in places.misses(rows, reference).collect()} == {("XXXX", 1), ("n/a", 1)}
    assert places.mapped(rows.limit(0), reference).count() == 0
    assert {r.codigo_dane for r in places.mapped(rows, reference.limit(0)).collect()} == {"NINGUNO"}
