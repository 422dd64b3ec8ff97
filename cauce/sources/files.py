"""Raw files: encodings, delimiters, CSV and spreadsheet scans with lineage, hashes, and the source catalogue.

Files may lie on any file system: Spark reads the delimited ones, workers open the others by their URI.
"""

from __future__ import annotations

import hashlib
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from typing import BinaryIO
from xml.etree import ElementTree

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.operators.numbering import numbered

# Bytes sniffed for an encoding, delimiters tried in turn, size beyond which a source is left out, block of a hash.
SNIFFED, DELIMITERS, LARGEST_SOURCE, HASH_BLOCK = 200_000, [",", ";", "\t", "|"], 500_000_000, 8 * 1024 * 1024


def open_file(path: str) -> BinaryIO:
    """A file by path or URI, for reading at any place."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")  # noqa: SIM115 - closed by the caller
    system, inner = arrow_fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return system.open_input_file(inner)


def size_of(path: str) -> int | None:
    """Bytes of a file, null where there is none."""
    try:
        with open_file(path) as f:
            return f.seek(0, 2) if "://" not in path and not path.startswith("file:") else f.size()
    except (FileNotFoundError, IsADirectoryError):
        return None


def encoding_of(head: bytes) -> str:
    """ING-4: ``utf-8-sig`` with a mark, ``utf-8`` if the first bytes decode, else ``latin-1``.

    A character cut at the end of the sample does not count against UTF-8.
    """
    if head.startswith(b"\xef\xbb\xbf"):
        return "utf-8-sig"
    try:
        head[:SNIFFED].decode("utf-8")
    except UnicodeDecodeError as e:
        return "utf-8" if len(head) > SNIFFED - 4 and e.start >= SNIFFED - 4 else "latin-1"
    return "utf-8"


def delimiter_of(line: str) -> str:
    """ING-5: the most frequent delimiter of the first line, the first of equals."""
    return max(DELIMITERS, key=line.count)


def triage(catalogue: DataFrame, largest: int = LARGEST_SOURCE) -> DataFrame:
    """ING-2: ``tratamiento`` of each source: too large or national, exact duplicate, or to be ingested."""
    national = F.coalesce(F.col("categoria") == "nacional", F.lit(False)) | F.coalesce(F.col("tamano_bytes") > largest, F.lit(False))
    return catalogue.withColumn("tratamiento", F.when(national, "excluido_nacional").when(F.col("duplicado_de").isNotNull(), "omitido_duplicado").otherwise("ingerir"))


def listed(catalogue: DataFrame, category: str | None = None, skip_duplicates: bool = True) -> DataFrame:
    """ING-1: sources of a category, without declared duplicates."""
    out = catalogue.filter(F.col("categoria") == category) if category else catalogue
    return out.filter("duplicado_de is null") if skip_duplicates else out


def declared_duplicates(catalogue: DataFrame) -> DataFrame:
    """ING-13: ``original, copias``: sources that are declared exact copies of another."""
    return catalogue.filter("duplicado_de is not null").groupBy(F.col("duplicado_de").alias("original")).agg(F.array_sort(F.collect_list("source_id")).alias("copias"))


def treatment_summary(catalogue: DataFrame, largest: int = LARGEST_SOURCE) -> DataFrame:
    """ING-15: sources and bytes by treatment."""
    return triage(catalogue, largest).groupBy("tratamiento").agg(F.count("*").alias("fuentes"), F.sum("tamano_bytes").alias("bytes"))


def _raw_csv(spark: SparkSession, path: str, encoding: str, delimiter: str, multiline: bool) -> DataFrame:
    charset = {"utf-8-sig": "utf-8", "latin-1": "iso-8859-1"}.get(encoding, encoding)
    reader = spark.read.option("header", True).option("sep", delimiter).option("encoding", charset).option("quote", '"').option("escape", '"')
    return reader.option("multiLine", multiline).option("inferSchema", False).option("nullValue", "\u0000").option("emptyValue", "").option("mode", "PERMISSIVE").csv(path)


def _full(names: list[str]) -> Column:
    """Whether any cell of a row holds something."""
    return F.greatest(F.lit(0), F.lit(0), *[F.coalesce(F.length(F.col(f"`{c}`")), F.lit(0)) for c in names]) > 0


def empty_rows(spark: SparkSession, path: str, encoding: str = "utf-8", delimiter: str = ",", multiline: bool = False) -> int:
    """ING-6: the rows that ``read_csv`` drops because all their cells are empty."""
    raw = _raw_csv(spark, path, encoding, delimiter, multiline)
    return raw.filter(~_full(raw.columns)).count()


def read_csv(spark: SparkSession, path: str, source_id: str, encoding: str = "utf-8", delimiter: str = ",", multiline: bool = False) -> DataFrame:
    """ING-3, ING-6, ING-7: every column as text, rows of empty cells dropped, lineage from 1 in file order.

    Blank cells stay empty texts. ``multiline`` is for files with line breaks inside quotes, which cannot be
    split; all others are read in parallel, and the row numbers follow file and offset.
    """
    raw = _raw_csv(spark, path, encoding, delimiter, multiline)
    names = raw.columns
    filled = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names], F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    kept = filled.filter(_full(names))
    rows = numbered(kept, "_file", "_block", "_row", name="fila_origen").drop("_file", "_block", "_row")
    return rows.withColumns({"source_id": F.lit(source_id), "hoja_origen": F.lit("")})


def text_of(value: object) -> str | None:
    """ING-9: a spreadsheet value as text."""
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if value != value:
            return None
        if value in (float("inf"), float("-inf")):
            return str(value)
        return str(int(value)) if value == int(value) else f"{value:f}".rstrip("0").rstrip(".")
    if isinstance(value, datetime):
        return value.isoformat()
    return str(value)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Number formats that show dates.
_DATES = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def sheets(path: str) -> list[tuple[str, str]]:
    """ING-10: names of the sheets with their parts, without reading cells."""
    with open_file(path) as raw, zipfile.ZipFile(raw) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    return [(s.get("name"), "xl/" + links[s.get(_LINK)].removeprefix("/xl/")) for s in book.iter(f"{_MAIN}sheet")]


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(path: str, part: str) -> Iterator[list[str | None]]:
    """The rows of a sheet as texts, in order; the cells are read one row at a time."""
    with open_file(path) as raw, zipfile.ZipFile(raw) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        dated: list[bool] = []
        if "xl/styles.xml" in names:
            styles = ElementTree.fromstring(z.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")) for f in styles.iter(f"{_MAIN}numFmt") if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")), re.I)}
            formats = styles.find(f"{_MAIN}cellXfs")
            dated = [int(x.get("numFmtId", 0)) in _DATES | own for x in formats] if formats is not None else []
        with z.open(part) as f:
            table = None
            for event, row in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    table = row if row.tag == f"{_MAIN}sheetData" else table
                    continue
                if row.tag != f"{_MAIN}row":
                    continue
                cells: dict[int, str | None] = {}
                for k, c in enumerate(row.iter(f"{_MAIN}c")):
                    at, kind, v = _column(c.get("r")) if c.get("r") else k, c.get("t"), c.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif v is None or v.text is None:
                        continue
                    elif kind == "s":
                        cells[at] = shared[int(v.text)]
                    elif kind == "b":
                        cells[at] = text_of(v.text == "1")
                    elif kind in ("str", "e", "d"):
                        cells[at] = v.text
                    else:
                        style = int(c.get("s", 0))
                        number = float(v.text)
                        cells[at] = text_of(datetime(1899, 12, 30) + timedelta(days=number) if style < len(dated) and dated[style] else number)
                yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
                # the tree keeps no row that has been read
                table.remove(row)


def read_xlsx(spark: SparkSession, path: str, source_id: str, header_rows: dict[str, int | None] | None = None) -> DataFrame:
    """ING-8: all sheets, one task each, by column name; missing columns are null.

    The header is the first row unless ``header_rows`` names another for a sheet, or None for none (``col_i``).
    Unnamed columns become ``col_sin_nombre_i``; rows without a value are dropped; rows count from 1 in a sheet.
    """
    found = sheets(path)
    wanted = header_rows or {}
    headers: dict[str, list[str]] = {}
    for name, part in found:
        at = wanted.get(name, 0)
        rows = sheet_rows(path, part)
        if at is None:
            width = max((len(r) for r in rows), default=0)
            headers[name] = [f"col_{i}" for i in range(width)]
        else:
            first = next((r for k, r in enumerate(rows) if k == at), [])
            headers[name] = [(h or "").strip() or f"col_sin_nombre_{i}" for i, h in enumerate(first)]
    columns = list(dict.fromkeys(c for h in headers.values() for c in h))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, part in zip(b["hoja"], b["parte"], strict=True):
                at = wanted.get(name, 0)
                out, n = [], 0
                for k, r in enumerate(sheet_rows(path, part)):
                    if (at is not None and k <= at) or all(v is None for v in r):
                        continue
                    n += 1
                    values = dict(zip(headers[name], r, strict=False))
                    out.append((source_id, name, n, *[values.get(c) for c in columns]))
                yield pd.DataFrame(out, columns=["source_id", "hoja_origen", "fila_origen", *columns])

    schema = "source_id string, hoja_origen string, fila_origen bigint" + "".join(f", `{c}` string" for c in columns)
    parts = spark.createDataFrame(found, "hoja string, parte string").repartition(max(1, len(found)), "hoja")
    return parts.mapInPandas(read, schema)


def hash_of(path: str) -> str:
    """ING-11: SHA-256 of a file's bytes, block by block."""
    digest = hashlib.sha256()
    with open_file(path) as f:
        while block := f.read(HASH_BLOCK):
            digest.update(block)
    return digest.hexdigest()


def hashed(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """ING-11, ING-12: ``source_id, ruta, existe, bytes, sha256, verificado_en`` of each file, hashed by the workers, one task each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = [size_of(p) for p in b["ruta"]]
            sums = [None if n is None else hash_of(p) for p, n in zip(b["ruta"], sizes, strict=True)]
            yield b.assign(existe=[n is not None for n in sizes], bytes=pd.array(sizes, dtype="Int64"), sha256=sums)

    listed_files = spark.createDataFrame(sorted(paths.items()), "source_id string, ruta string")
    done = listed_files.repartition(max(1, len(paths))).mapInPandas(run, "source_id string, ruta string, existe boolean, bytes bigint, sha256 string")
    return done.withColumn("verificado_en", F.current_timestamp())


def verified(spark: SparkSession, paths: dict[str, str], source_id: str) -> dict:
    """ING-12: one source's check; KeyError if it is not in the catalogue."""
    if source_id not in paths:
        raise KeyError(source_id)
    return hashed(spark, {source_id: paths[source_id]}).first().asDict()


def registered(spark: SparkSession, catalogue: DataFrame, paths: dict[str, str]) -> DataFrame:
    """ING-16: ``source_id, archivo, formato, existe, tamano_bytes, hash_sha256, verificado_en`` of every source with a path."""
    checks = hashed(spark, paths).select("source_id", "existe", F.col("bytes").alias("tamano_bytes"), F.col("sha256").alias("hash_sha256"), "verificado_en")
    return catalogue.select("source_id", "archivo", "formato").join(checks, "source_id")


def same_files(hashes: DataFrame) -> DataFrame:
    """ING-13: groups of sources with equal content."""
    return hashes.filter("sha256 is not null").groupBy("sha256").agg(F.array_sort(F.collect_list("source_id")).alias("fuentes")).filter(F.size("fuentes") > 1)


#: The columns of an ingest catalogue.
CATALOGUE = {
    "source_id": "string", "archivo": "string", "formato": "string", "categoria": "string", "tratamiento": "string", "registros_ingeridos": "bigint", "registros_aprox_auditoria": "bigint", "columnas_ingeridas": "int", "filas_vacias_descartadas": "bigint",
    "num_hojas": "int", "tamano_original_bytes": "bigint", "hash_sha256_original": "string", "destino_parquet": "string", "tamano_parquet_bytes": "bigint", "duplicado_de": "string", "error": "string", "fecha_ingesta_utc": "string",
}


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _bytes_of(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def ingest(spark: SparkSession, sources: list[dict], target: str, limit: int | None = None) -> list[dict]:
    """ING-14: each source to one Parquet table, at most ``limit`` of them; an error becomes a result row and stops no other source.

    What a failed source has written is deleted; a table that was there before is an error and stays.
    """
    results = []
    for s in sources[:limit]:
        out = f"{target}/{s['source_id']}__ingestado.parquet"
        row = {c: s.get(c) for c in CATALOGUE} | {"source_id": s["source_id"], "fecha_ingesta_utc": datetime.now(timezone.utc).isoformat()}
        began = False
        try:
            if s["formato"] == "xlsx":
                rows = read_xlsx(spark, s["ruta"], s["source_id"], s.get("cabeceras"))
                row["num_hojas"] = len(sheets(s["ruta"]))
            else:
                rows = read_csv(spark, s["ruta"], s["source_id"], s.get("encoding", "utf-8"), s.get("delimitador", ","), s.get("multilinea", False))
            jvm = spark._jvm.org.apache.hadoop.fs.Path(out)
            if jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
                raise FileExistsError(out)
            began = True
            rows.write.mode("errorifexists").parquet(out)
            row |= {"tratamiento": "ingerido", "registros_ingeridos": spark.read.parquet(out).count(), "columnas_ingeridas": len(rows.columns) - 3, "destino_parquet": out, "tamano_parquet_bytes": _bytes_of(spark, out), "tamano_original_bytes": size_of(s["ruta"])}
            if s["formato"] != "xlsx":
                row["filas_vacias_descartadas"] = empty_rows(spark, s["ruta"], s.get("encoding", "utf-8"), s.get("delimitador", ","), s.get("multilinea", False))
        except Exception as e:  # noqa: BLE001 - the result row says what went wrong
            if began:
                _delete(spark, out)
            row |= {"tratamiento": "error", "registros_ingeridos": 0, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        results.append(row)
    return results


def ingest_catalogue(spark: SparkSession, results: list[dict]) -> DataFrame:
    """ING-15: the results in the 17 columns ``CATALOGUE``."""
    return spark.createDataFrame([tuple(r.get(c) for c in CATALOGUE) for r in results], ", ".join(f"{c} {t}" for c, t in CATALOGUE.items()))


def ingest_summary(results: DataFrame) -> DataFrame:
    """ING-15: one row: sources ingested, failed, left out as duplicates or national, their records and bytes."""
    is_ = lambda t: F.col("tratamiento") == t
    return results.agg(
        F.count_if(is_("ingerido")).alias("procesados"), F.count_if(is_("omitido_duplicado")).alias("omitidos_duplicado"), F.count_if(is_("excluido_nacional")).alias("excluidos_nacional"), F.count_if(is_("error")).alias("errores"),
        F.coalesce(F.sum(F.when(is_("ingerido"), F.col("registros_ingeridos"))), F.lit(0)).alias("registros_totales_ingeridos"), F.coalesce(F.sum(F.when(is_("ingerido"), F.col("tamano_parquet_bytes"))), F.lit(0)).alias("tamano_parquet_total_bytes"),
    )
