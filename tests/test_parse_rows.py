import random
import re

import pytest

from cauce.operators import parse_rows

HEADERS = {"a": (";", "NIT;NOMBRE;EMPLEADOS"), "t": ("\\t", "NOMBRE\tNIT\tEMPLEADOS"), "p": ("|", "NOMBRE|NUMERO DE IDENTIFICACION|PERSONAL OCUPADO|CIUDAD")}
NULLS = {"", "N/A", "NA", "NO REPORTA", "NO APLICA", "NO REPORTADO", "SIN DATO", "NULL", "NONE", "<NA>", "NAN", "NAT"}


def fields_of(line, d):
    """A walk over the characters; None where the quoting is broken."""
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            i, value = i + 1, ""
            while True:
                if i >= len(line):
                    return None
                if line[i] == '"' and line[i + 1 : i + 2] == '"':
                    value, i = value + '"', i + 2
                elif line[i] == '"':
                    i += 1
                    break
                else:
                    value, i = value + line[i], i + 1
            if i < len(line) and line[i] != d:
                return None
        else:
            end = line.find(d, i)
            end = len(line) if end < 0 else end
            value, i = line[i:end], end
        out.append(value)
        if i >= len(line):
            return out
        i += 1


def brute(source, line):
    if source not in HEADERS:
        return "columnas"
    d, header = HEADERS[source]
    d = d.replace("\\t", "\t")
    names = header.split(d)
    f = fields_of(line or "", d)
    if f is None:
        return "comillas"
    if len(f) != len(names):
        return "columnas"
    nit = f[next(i for i, x in enumerate(names) if x in ("NIT", "NUMERO DE IDENTIFICACION"))].strip(" \t\r\n\f\v")
    emp = f[next(i for i, x in enumerate(names) if x in ("EMPLEADOS", "PERSONAL OCUPADO"))].strip(" \t\r\n\f\v")
    if nit.upper() not in NULLS and not (re.fullmatch(r"[0-9 .\-]+", nit) and 6 <= sum(x.isdigit() for x in nit) <= 11):
        return "nit"
    if emp.upper() not in NULLS and not re.fullmatch(r"0*\d{1,5}|0?\d{1,2}[.,]\d{3}", emp):
        return "num_empleados"
    return None


LINES = [
    ("a", "900123456;X SAS;5"), ("a", '"900.123.456-7";"A ""B"" C";" 12 "'), ("a", '900123456;"A;B";5'), ("a", '900123456;"A;5'), ("a", '900123456;"A"x;5'),
    ("a", '900123456;A "B" C;5'), ("a", "900123456;A"), ("a", "900123456;A;5;6"), ("a", ""), ("a", None), ("zz", "1;2;3"), ("a", "12;A;5"), ("a", "no reporta;A;n/a"),
    ("a", "null;A;None"), ("a", "900123456;A;99.999"), ("a", "900123456;A;100.000"), ("a", "900123456;A;12.5"), ("a", "900123456;A;-4"), ("a", "900123456;A;1e3"),
    ("a", "12;A;1e3"), ("a", '900123456;"A\nB";5'), ("t", "A\t900123456\t5"), ("t", "A\t\t"), ("t", "A\t \t \t"), ("t", '"A\tB"\t900123456\t7'), ("p", "A|900123456|5|X"), ("p", '"A|900123456|5|X'),
    ("a", "900123456;" + "x" * 3000 + ";5"), ("a", '900123456;"' + '""' * 20000 + '";5'), ("a", '900123456;"' + '""' * 20000 + ";5"), ("a", ";" * 5000), ("a", '"a"' + ';"b"' * 30000), ("a", '900123456;"' + 'x""' * 30000 + '";5'), ("a", "900123456" + " " * 40000 + "x;A;5"), ("a", " " * 40000 + "900123456;A;" + " " * 40000 + "5"),
    ("a", "900123456\u00a0;A;5"), ("a", "900123456\u00a0;" + "A" * 1200 + ";5"), ("a", "\u2003900123456;A;5"), ("a", "\u2003900123456;" + "A" * 1200 + ";5"),
    ("a", "900123456;A\u0001B;5"), ("a", "900123456;\u0002a\u0001\u0002b;5"), ("a", '900123456;"\u0001""";5'), ("a", "900123456;\\1$2;5"), ("a", '"";"";""'), ("a", '""";;'),
]


def frames(spark, lines):
    records = spark.createDataFrame([(i, s, x, "extra") for i, (s, x) in enumerate(lines)], "linea_id bigint, source_id string, linea string, motivo string")
    catalogue = spark.createDataFrame([(k, d, h) for k, (d, h) in HEADERS.items()], "source_id string, delimitador string, encabezado string")
    return records, catalogue


def test_reasons_against_a_walk_over_the_characters(spark):
    records, catalogue = frames(spark, LINES)
    got = {r.linea_id: r.motivo for r in parse_rows.judged(records, catalogue).collect()}
    assert got == {i: brute(s, x) for i, (s, x) in enumerate(LINES)}


def test_random_rows_against_the_walk(spark):
    rng = random.Random(4)
    parts = ['"', '""', ";", "\t", "|", " ", "9", "123456", "900.123.456-7", "A", "n/a", ".", ",", "1.000", "99999", "\n"]
    lines = [(rng.choice("atp"), "".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for _ in range(3000)]
    lines += [(k, HEADERS[k][0].replace("\\t", "\t").join(rng.choice(["123456", "900.123.456-7", " n/a ", "1.000", "99999", '"a""b"', '" 12 "', "A", ""]) for _ in range(3 + (k == "p")))) for k in "atp" for _ in range(400)]
    records, catalogue = frames(spark, lines)
    got = {r.linea_id: r.motivo for r in parse_rows.judged(records, catalogue).collect()}
    assert {i: (x, got[i]) for i, (_, x) in enumerate(lines)} == {i: (x, brute(s, x)) for i, (s, x) in enumerate(lines)}
    assert sum(v is None for v in got.values()) > 100


def test_loaded_fields_and_first_broken_field(spark):
    records, catalogue = frames(spark, LINES)
    rows = {r.linea_id: r for r in parse_rows.loaded(records, catalogue).collect()}
    assert rows[1].razon_social == 'A "B" C' and rows[1].num_empleados == "12" and rows[1].nit == "900.123.456-7"
    assert rows[24].razon_social == "A\tB" and rows[24].municipio_comercial is None
    for k, (source, line) in enumerate(LINES):
        if k in rows:
            at = [("NIT", "NUMERO DE IDENTIFICACION"), ("NOMBRE",), ("EMPLEADOS", "PERSONAL OCUPADO")]
            d = HEADERS[source][0].replace("\\t", "\t")
            values = dict(zip(HEADERS[source][1].split(d), fields_of(line or "", d), strict=True))
            wanted = [next(v for h, v in values.items() if h in names).strip(" ") or None for names in at]
            assert [rows[k].nit, rows[k].razon_social, rows[k].num_empleados] == wanted
    broken = {r.linea_id: r.campo_roto for r in parse_rows.rejected(records, catalogue).collect()}
    assert broken[3] == "NOMBRE" and broken[11] == "NIT" and broken[16] == "EMPLEADOS"
    assert set(rows).isdisjoint(broken) and len(rows) + len(broken) == len(LINES)


def test_empty_tables(spark):
    records, catalogue = frames(spark, LINES)
    assert parse_rows.judged(records.limit(0), catalogue).count() == 0
    assert {r.motivo for r in parse_rows.judged(records, catalogue.limit(0)).collect()} == {"columnas"}
    assert parse_rows.loaded(records, catalogue.limit(0)).count() == 0


@pytest.mark.parametrize("value,ok", [("123456", True), ("12345", False), ("12345678901", True), ("123456789012", False), ("1 2-3.456", True), ("12345A", False)])
def test_identifier_rule(spark, value, ok):
    records, catalogue = frames(spark, [("a", f"{value};A;1")])
    assert (parse_rows.judged(records, catalogue).first().motivo is None) == ok
