import datetime
import random

import pytest
from pyspark.sql import functions as F

from cauce.functions import registry as reg
from cauce.functions import text as tx
from cauce.functions.dates import typed_day
from cauce.functions.similarity import common_subsequence, token_sort_ratio


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize(
    "value,wanted",
    [("  Cámara de Comercio   de Pereira  ", "CAMARA DE COMERCIO DE PEREIRA"), ("N/A", None), ("No reporta", None), ("", None), (None, None), ("null", "NULL"), ("a  b", "A B"), ("Ñandú ﬁn º", "NANDU FIN O"), ("na", None), ("é", "E")],
)
def test_comparison_text(spark, value, wanted):
    assert one(spark, value, tx.comparison_text) == wanted


def test_cleansing(spark):
    assert one(spark, "8.160.024.518", tx.digits) == "8160024518" and one(spark, "x", tx.digits) is None
    assert one(spark, "310-611-6510", tx.phone) == "3106116510" and one(spark, "N/A", tx.phone) is None
    assert one(spark, "  Contador@Empresa.COM  ", tx.email) == "contador@empresa.com" and one(spark, "sin-arroba", tx.email) is None
    assert one(spark, " Él  no ", tx.light_clean) == "Él no"
    assert tuple(one(spark, "91001 - Almirá - X", tx.place_parts)) == ("91001", "ALMIRA - X")
    assert tuple(one(spark, "Llano - Almira", tx.place_parts)) == (None, "LLANO - ALMIRA")
    assert [one(spark, v, tx.placeholder_id) for v in ("111", "112", "", None, "0", "xx")] == [True, False, True, True, True, False]


@pytest.mark.parametrize(
    "value,wanted",
    [
        ("2024-02-29", (2024, 2, 29)), ("20240229", (2024, 2, 29)), ("29/02/2024", (2024, 2, 29)), ("5.6.2020", (2020, 6, 5)), ("05-06-2020 00:00:00", (2020, 6, 5)), ("7 feb 2018", (2018, 2, 7)), ("7 de febrero de 2018", (2018, 2, 7)),
        ("31/02/2023", None), ("00/00/0000", None), ("0000-00-00", None), ("", None), (None, None), ("ayer", None), ("2024-13-01", None), ("7 foo 2018", None),
    ],
)
def test_typed_days(spark, value, wanted):
    assert one(spark, value, typed_day) == (datetime.date(*wanted) if wanted else None)


def test_registry_expressions(spark):
    assert tuple(one(spark, "G4773 ** Comercio", reg.activity)) == ("G", "G4773", "Salud / Farmacias", "alto", None)
    assert tuple(one(spark, "i5611", reg.activity)) == ("I", "I5611", "Gastronomía y Hotelería", "alto", None)
    assert tuple(one(spark, "4711", reg.activity)) == (None, None, None, None, "No se reconoce el formato CIIU: '4711'")
    assert one(spark, "", reg.activity).nota == one(spark, None, reg.activity).nota == "Sin código CIIU" and one(spark, "Z0001", reg.activity).nota == "Sección CIIU 'Z' no mapeada"
    sized = lambda d, e: tuple(spark.createDataFrame([(d, e)], "d string, e string").select(reg.company_size(F.col("d"), F.col("e")).alias("o")).first().o)
    assert sized("micro empresa", "950") == ("micro", "declarado_por_fuente", "confirmado")
    assert sized(None, "950")[0] == "grande" and sized("PEQUEÑA", "11")[:2] == ("pequeña", "inferido_por_empleados") and sized(None, "x")[0] == "sin_dato"
    assert [one(spark, v, reg.size_class) for v in ("PYME PEQUEÑA", "Gran empresa", "micro", None, "?")] == ["pequeña", "grande", "micro", None, None]
    assert [one(spark, v, reg.renewal_year) for v in ("2,020", "2.019", " 2024 ", "1989", "2024.0", None)] == [2020, 2019, 2024, None, None, None]
    assert tuple(one(spark, "250000", reg.plausible_employees)) == (None, True) and tuple(one(spark, "99999", reg.plausible_employees)) == ("99999", False)
    assert tuple(one(spark, "9" * 50, reg.plausible_employees)) == (None, True)
    assert tuple(one(spark, "9019553183", reg.query_id)) == ("901955318", "3", "3", True, True)
    assert one(spark, "123", reg.query_id).consultable is False and one(spark, None, reg.query_id).consultable is False
    assert one(spark, "Ñandú S.A.S. en liquidación", reg.comparable_name) == "NANDU SAS"
    same = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(reg.compatible_names(F.col("a"), F.col("b")).alias("o")).first().o
    assert same("Uno S.A.S", "UNO SAS") and same("Uno", "Uno Dos Ltda") and not same("Uno", "Dos") and not same(None, "Uno") and not same("", "")
    assert abs(one(spark, 0.112, lambda c: reg.smoothed_share(F.lit(0), F.lit(0), c, 20.0), "double") - 0.154286) < 1e-6
    found = one(spark, "Escribe a ana@mail.co o al 3001234567", reg.entities)
    assert found.emails == ["ana@mail.co"] and found.telefonos[0].strip() == "3001234567"


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_against_the_table(spark):
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("ABCD ") for _ in range(rng.randrange(0, 90))) for _ in range(2))
        assert common_subsequence(a, b) == brute_lcs(a, b)
    rows = spark.createDataFrame([("B A", "A B"), ("ABC", "ACB"), (None, "A"), ("", "")], "a string, b string")
    assert [r.o for r in rows.select(token_sort_ratio(F.col("a"), F.col("b")).alias("o")).collect()] == [100.0, 200 * 2 / 6, None, 100.0]
