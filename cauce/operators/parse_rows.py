"""Rows that fail to parse: an anchored pattern per schema, prefixes of it for the rows that fail.

Every schema (delimiter + header) yields one anchored regular expression for a whole row, with the value
rules of the typed columns inside. A row that matches is loaded by the groups of that very match. A row
that fails is put through the prefixes of the pattern, one field longer each, which name the first broken
field; the reason follows from which rule broke.

Defined results: a null ``linea`` counts as the empty row (one empty field). A row whose source is not in
the catalogue has no schema and comes out with reason ``columnas``. Repeated rows are judged one by one,
an empty table gives empty results, and other columns of the input are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.text import NULL_MARKERS, NULL_MARKERS_UNREACHABLE

#: The most source descriptions that are read to the driver, and the most schemas among them; each schema is a branch of one expression.
MAX_SOURCES, MAX_SCHEMAS = 10_000, 200

# Header names by canonical column.
CANONICAL = {
    "nit": ["NIT", "IDENTIFICACION", "NUMERO DE IDENTIFICACION"],
    "matricula": ["MATRICULA"],
    "razon_social": ["RAZON SOCIAL", "NOMBRE", "EMPRESA"],
    "direccion_comercial": ["DIRECCION COMERCIAL", "DIRECCION"],
    "barrio_comercial": ["BARRIO"],
    "municipio_comercial": ["MUNICIPIO", "CIUDAD"],
    "telefono_comercial_1": ["TELEFONO", "TEL 1"],
    "email_comercial": ["EMAIL", "CORREO"],
    "ciiu_1": ["CIIU", "ACTIVIDAD"],
    "num_empleados": ["NUMERO DE EMPLEADOS", "EMPLEADOS", "PERSONAL OCUPADO"],
    "fecha_renovacion": ["FECHA RENOVACION"],
    "representante_legal": ["REPRESENTANTE LEGAL"],
}


#: What a typed column may hold, without the quotes around it; ``~`` stands for white space other than the delimiter.
#: All repetitions are possessive: what they take is never given back, so rows of any length need no recursion.
_NOTHING = "~*+(?i:" + "|".join(re.escape(m).replace(r"\ ", r"~++") for m in sorted({*NULL_MARKERS, *NULL_MARKERS_UNREACHABLE}, reverse=True)) + ")~*+"
RULES = {
    "nit": rf"(?:{_NOTHING}|~*+[. \-]*+(?:[0-9][. \-]*+){{6,11}}+~*+)",
    "num_empleados": rf"(?:{_NOTHING}|~*+(?:0*[0-9]{{1,5}}|0?[0-9]{{1,2}}[.,][0-9]{{3}})~*+)",
}


@dataclass(frozen=True)
class Schema:
    delimiter: str
    header: tuple[str, ...]

    @staticmethod
    def of(delimiter: str, header: str) -> Schema:
        delimiter = delimiter.replace("\\t", "\t")
        return Schema(delimiter, tuple(x.strip() for x in header.split(delimiter)))

    @property
    def canonical(self) -> list[str | None]:
        """The canonical column of each position; a synonym counts once, at its first place."""
        seen: set[str] = set()
        out: list[str | None] = []
        for name in self.header:
            key = next((k for k, names in CANONICAL.items() if name.upper() in names and k not in seen), None)
            seen |= {key} if key else set()
            out.append(key)
        return out

    def field(self, rule: str | None = None) -> str:
        d = re.escape(self.delimiter)
        if rule is None:
            return rf'(?:"[^"]*+(?:""[^"]*+)*+"|(?!")[^{d}]*+)'
        rule = rule.replace("~", rf"[^\S{d}]")
        return rf'(?:"{rule}"|(?!"){rule})'

    def row(self, upto: int | None = None, groups: bool = False) -> str:
        """The anchored pattern of a whole row, or of its first ``upto`` fields."""
        d, n = re.escape(self.delimiter), len(self.header)
        fields = [self.field(RULES.get(k or "")) for k in self.canonical[: upto or n]]
        body = d.join(f"({f})" if groups else f for f in fields)
        return rf"^{body}\z" if upto in (None, n) else rf"^{body}{d}"

    def quoted(self) -> str:
        """Any number of well-quoted fields."""
        f, d = self.field(), re.escape(self.delimiter)
        return rf"^{f}(?:{d}{f})*+\z"

    def counted(self) -> str:
        """As many well-quoted fields as the header has, whatever they hold."""
        return rf"^{re.escape(self.delimiter).join([self.field()] * len(self.header))}\z"

    def typed(self) -> list[tuple[str, str]]:
        """For each typed column, in the order in which reasons apply: the row with only that rule in it."""
        d = re.escape(self.delimiter)
        return [
            (k, rf"^{d.join(self.field(RULES[k] if c == k else None) for c in self.canonical)}\z")
            for k in RULES
            if k in self.canonical
        ]


def schemas(catalogue: DataFrame) -> dict[Schema, list[str]]:
    """The distinct schemas of the source catalogue with their sources."""
    rows = catalogue.select("source_id", "delimitador", "encabezado").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources in the catalogue")
    out: dict[Schema, list[str]] = {}
    for r in rows:
        if r.source_id is not None and r.delimitador and r.encabezado is not None:
            out.setdefault(Schema.of(r.delimitador, r.encabezado), []).append(r.source_id)
    if len(out) > MAX_SCHEMAS:
        raise ValueError(f"more than {MAX_SCHEMAS} schemas in the catalogue")
    return out


def _case(known: dict[Schema, list[str]], value, otherwise: Column) -> Column:
    """``value(schema)`` of the row's source."""
    out = None
    for schema, sources in known.items():
        when = F.col("source_id").isin(*sources)
        out = F.when(when, value(schema)) if out is None else out.when(when, value(schema))
    return otherwise if out is None else out.otherwise(otherwise)


def _reason(line: Column, s: Schema) -> Column:
    out = F.when(line.rlike(s.row()), F.lit(None).cast("string")).when(~line.rlike(s.quoted()), F.lit("comillas")).when(~line.rlike(s.counted()), F.lit("columnas"))
    for name, pattern in s.typed():
        out = out.when(~line.rlike(pattern), F.lit(name))
    return out


def _broken(line: Column, s: Schema) -> Column:
    """Header name of the first field that the prefixes cannot pass; beyond the last: null."""
    out = F.when(line.rlike(s.row()), F.lit(None).cast("string"))
    for k, name in enumerate(s.header, 1):
        last = k == len(s.header)
        out = out.when(~line.rlike(s.row() if last else s.row(k)), F.lit(name))
    return out


def judged(records: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``linea_id, source_id, linea, motivo, campo_roto`` of every record; ``motivo`` is null where the row loads."""
    known = schemas(catalogue)
    rows = records.select("linea_id", "source_id", F.coalesce("linea", F.lit("")).alias("linea"))
    line = F.col("linea")
    return rows.withColumn("motivo", _case(known, lambda s: _reason(line, s), F.lit("columnas"))).withColumn(
        "campo_roto", F.when(F.col("motivo").isNotNull(), _case(known, lambda s: _broken(line, s), F.lit(None).cast("string")))
    )


def rejected(records: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The unusable records: ``linea_id, source_id, motivo, campo_roto``."""
    return judged(records, catalogue).filter("motivo is not null").select("linea_id", "source_id", "motivo", "campo_roto")


def loaded(records: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The usable records in their canonical fields, cut by the groups of the pattern that accepted them.

    Fields that a schema lacks are null, as are empty ones; quotes around a field are taken off and doubled ones made single.
    """
    known = schemas(catalogue)
    good = judged(records, catalogue).filter("motivo is null")
    names = list(CANONICAL)
    # the groups come as one text parted by a mark; where a row has the mark itself, it is written otherwise meanwhile
    mark, escape = "\u0001", "\u0002"
    line = F.replace(F.replace("linea", F.lit(escape), F.lit(escape + "b")), F.lit(mark), F.lit(escape + "a"))

    def fields(s: Schema) -> Column:
        canonical = s.canonical
        picked = mark.join(f"${canonical.index(k) + 1}" if k in canonical else "" for k in names)
        return F.split(F.regexp_replace(line, s.row(groups=True), picked), mark, -1)

    parts = good.withColumn("_f", _case(known, fields, F.array().cast("array<string>")))

    def field(i: int) -> Column:
        raw = F.get("_f", F.lit(i))
        bare = F.when(raw.startswith('"'), F.replace(F.expr(f"substring(_f[{i}], 2, length(_f[{i}]) - 2)"), F.lit('""'), F.lit('"'))).otherwise(raw)
        own = F.replace(F.replace(bare, F.lit(escape + "a"), F.lit(mark)), F.lit(escape + "b"), F.lit(escape))
        return F.nullif(F.trim(own), F.lit(""))

    return parts.select("linea_id", "source_id", *[field(i).alias(k) for i, k in enumerate(names)])


def load_report(records: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Records by source and reason (``cargado`` for loaded ones)."""
    return judged(records, catalogue).groupBy("source_id", F.coalesce("motivo", F.lit("cargado")).alias("motivo")).agg(F.count("*").alias("filas"))
