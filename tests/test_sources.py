import zipfile

import pytest

from cauce.sources import files, sinks
from cauce.streaming import messages


def test_sniffing():
    assert files.encoding_of(b"\xef\xbb\xbfA") == "utf-8-sig" and files.encoding_of("ñ".encode()) == "utf-8" and files.encoding_of("ñ".encode("latin-1")) == "latin-1"
    assert files.encoding_of(b"a" * 199_999 + "ñ".encode()) == "utf-8"
    assert files.delimiter_of("a;b;c,d") == ";" and files.delimiter_of("a,b;c") == "," and files.delimiter_of("a|b|c") == "|"


def test_csv_rows_and_lineage(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("NIT;NOMBRE\n1;Ñ\n;\n\"2\";\"a;\"\"b\"\"\"\n3;\n".encode("latin-1"))
    rows = files.read_csv(spark, str(path), "s", "latin-1", ";").orderBy("fila_origen").collect()
    assert [(r.NIT, r.NOMBRE, r.fila_origen, r.source_id, r.hoja_origen) for r in rows] == [("1", "Ñ", 1, "s", ""), ("2", 'a;"b"', 2, "s", ""), ("3", "", 3, "s", "")]
    big = tmp_path / "b.csv"
    big.write_text("n\n" + "\n".join(map(str, range(5000))) + "\n")
    rows = files.read_csv(spark, str(big), "s").collect()
    assert all(int(r.n) + 1 == r.fila_origen for r in rows) and len(rows) == 5000


def book(path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Uno" r:id="a"/><sheet name="Dos" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>NIT</t></si><si><r><t>No</t></r><r><t>mbre</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>F</t></is></c></row><row r="2"><c r="A2"><v>900</v></c><c r="B2" t="b"><v>1</v></c><c r="D2" s="1"><v>44197</v></c></row><row r="3"/><row r="4"><c r="A4"><v>1.50</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1"><v>7</v></c></row></sheetData></worksheet>')


def test_spreadsheet(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    book(path)
    assert [n for n, _ in files.sheets(path)] == ["Uno", "Dos"]
    rows = files.read_xlsx(spark, path, "s", {"Dos": None}).orderBy("hoja_origen", "fila_origen").collect()
    assert [(r.hoja_origen, r.fila_origen, r.NIT, r.Nombre, r.F, r.col_0) for r in rows] == [("Dos", 1, None, None, None, "7"), ("Uno", 1, "900", "True", "2021-01-01T00:00:00", None), ("Uno", 2, "1.5", None, None, None)]
    assert "col_sin_nombre_2" in files.read_xlsx(spark, path, "s").columns


def test_hashes_and_ingest(spark, tmp_path):
    for n, t in (("a", "x\n1\n"), ("b", "x\n1\n"), ("c", "y\n2\n")):
        (tmp_path / f"{n}.csv").write_text(t)
    hashes = files.hashed(spark, {n: str(tmp_path / f"{n}.csv") for n in "abcd"})
    assert [r.fuentes for r in files.same_files(hashes).collect()] == [["a", "b"]]
    assert hashes.filter("not existe").first().source_id == "d"
    done = files.ingest(spark, [{"source_id": n, "formato": "csv", "ruta": str(tmp_path / f"{n}.csv")} for n in "ad"], str(tmp_path / "out"))
    assert [(r["source_id"], r["tratamiento"], r["registros_ingeridos"]) for r in done] == [("a", "ingerido", 1), ("d", "error", 0)]
    assert done[0]["columnas_ingeridas"] == 1 and done[0]["tamano_parquet_bytes"] > 0 and done[0]["tamano_original_bytes"] == 4
    again = files.ingest(spark, [{"source_id": "a", "formato": "csv", "ruta": str(tmp_path / "a.csv")}], str(tmp_path / "out"))
    assert again[0]["tratamiento"] == "error" and spark.read.parquet(str(tmp_path / "out" / "a__ingestado.parquet")).count() == 1  # what was there stays
    catalogue = files.ingest_catalogue(spark, done)
    assert len(catalogue.columns) == 17 and files.ingest_summary(catalogue).first()[:4] == (1, 0, 0, 1)
    assert len(files.ingest(spark, [{"source_id": "b", "formato": "csv", "ruta": "x"}, {"source_id": "c", "formato": "csv", "ruta": "y"}], str(tmp_path / "o2"), limit=1)) == 1
    listed = spark.createDataFrame([("a", "a.csv", "csv"), ("d", "d.csv", "csv")], "source_id string, archivo string, formato string")
    paths = {n: "file://" + str(tmp_path / f"{n}.csv") for n in "ad"}
    got = {r.source_id: r for r in files.registered(spark, listed, paths).collect()}
    assert got["a"].existe and got["a"].tamano_bytes == 4 and got["a"].hash_sha256 == files.hash_of(str(tmp_path / "a.csv")) and not got["d"].existe and got["d"].hash_sha256 is None
    assert files.verified(spark, paths, "a")["existe"]
    with pytest.raises(KeyError):
        files.verified(spark, paths, "zz")


def test_empty_rows_are_counted(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text('a,b\n1,\n,\n"",""\n2,x\n')
    done = files.ingest(spark, [{"source_id": "e", "formato": "csv", "ruta": str(path)}], str(tmp_path / "out"))
    assert done[0]["registros_ingeridos"] == 2 and done[0]["filas_vacias_descartadas"] == 2


def test_spreadsheet_values():
    assert [files.text_of(v) for v in (None, True, 3.0, 1.5, 1e-7, float("nan"), float("inf"), "x", 2)] == [None, "True", "3", "1.5", "0", None, "inf", "x", "2"]


def test_raw_area_by_path_and_uri(tmp_path):
    raw = str(tmp_path / "raw")
    for inside in (raw, raw + "/x", "file://" + raw + "/x", "file:" + raw + "/x", raw + "/../raw/y"):
        with pytest.raises(PermissionError):
            sinks.outside(inside, raw)
    for target, area in ((raw + "2", raw), ("s3a://b/raw/x", raw), ("s3a://b/out", "s3a://b/raw")):
        assert sinks.outside(target, area) == target
    with pytest.raises(PermissionError):
        sinks.outside("s3a://b/out/../raw/x", "s3a://b/raw")


def test_triage(spark):
    rows = [("a", "nacional", 1, None), ("b", "general", 600_000_000, None), ("c", "general", 1, "a"), ("d", "general", 1, None), ("e", None, None, None)]
    catalogue = spark.createDataFrame(rows, "source_id string, categoria string, tamano_bytes bigint, duplicado_de string")
    assert {r.source_id: r.tratamiento for r in files.triage(catalogue).collect()} == {"a": "excluido_nacional", "b": "excluido_nacional", "c": "omitido_duplicado", "d": "ingerir", "e": "ingerir"}
    assert files.listed(catalogue, "general").count() == 2


def test_stream_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [("m1", "2024-01-01 10:00:00", "a@b.co", "s"), ("m1", "2024-01-01 11:00:00", "x", "s"), ("m2", "2024-01-02 10:00:00", "y", "s"), (None, "2024-01-02 10:00:00", "z", "s"), ("m3", None, "w", "s")]
    table = spark.createDataFrame(rows, "message_id string, t string, text string, source string").withColumn("received_at", F.col("t").cast("timestamp"))
    table.write.parquet(str(tmp_path / "in"))
    stream = messages.with_entities(messages.first_copies(spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))))
    query = stream.writeStream.format("memory").queryName("first_copies").option("checkpointLocation", str(tmp_path / "ck")).start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("first_copies")
    assert sorted(r.message_id for r in got.collect()) == ["m1", "m2"]


def test_entities_of_every_message(spark, tmp_path):
    import re

    import __spark_entry__ as entry

    patterns = {"telefonos": (r"(?:\+57|57)?\s?3\d{9}|\d{7,10}", 0), "emails": (r"[\w\.-]+@[\w\.-]+\.\w+", 0), "montos": (r"\$?\s?\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{2})?\s?(?:COP|pesos|cop)?", re.IGNORECASE)}
    texts = [
        ("en", "call +57 3001234567 or 6012345678, a.b@c.co"), ("es", "señora peña@correo.co pagó $ 1.200.000 COP al 573001234567"), ("pt", "joão@empresa.com.br, 12,50 PESOS"), (None, "ñ 1\u00a0cop 3009876543"), ("es", ""), ("es", "sin nada"), ("es", None), ("en", "ñandú@x.co 99"),
    ]
    rows = [(f"d{i}", t, lang) for i, (lang, t) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id string, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in entry.queries()["msg4_entities"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for key, text, _ in rows:
        for column, (pattern, flags) in patterns.items():
            assert got[key][column] == (None if text is None else "|".join(m[0] for m in re.finditer(pattern, text, flags)))
