"""One surviving record per group of duplicates, built field by field by currency reasoning.

Rows with a day of renewal are ordered by it. From them the operator learns, for each field with few values, which
value follows which: changes between the days of a group, weighted by the trust in both rows, give edges where one
direction prevails beyond chance, and what can be reached by edges is later. A group's values are then partially
ordered: by day where both have one, by the learned precedence where one has none. The topologically latest value
survives; values that the order does not part, and fields without precedence, are decided by the latest, most
trusted, most complete row that has one. All of it is aggregation of one number per field, so a group of any size
is combined before it is shuffled; the values themselves are read at the end, of the rows chosen only. Values are
compared by hashes that are checked to be different for all of them, so a field may have any number of values.

A record that no other of its group beats in completeness, day or trust is the group's guide.

Defined results: groups of one row have no survivor. Nulls, blanks and stand-ins are no information. Missing
or impossible days are the oldest, an unknown source the least trusted. Ties go to the smaller row_order. Rows
without an entity belong to no group, and a row counts in every group it is in; empty tables give none.
"""

from __future__ import annotations

from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.functions.dates import typed_day
from cauce.functions.registry import lookup
from cauce.functions.text import NULL_MARKERS, strip_accents
from cauce.operators.dedup import FIELDS
from cauce.session import cut

# Words typed only to fill a field.
STAND_INS = ["NULL", "NONE", "S/D", "S/I", "ND", "N/D", "PENDIENTE", "POR DEFINIR", "SIN INFORMACION", "SIN INFORMACIÓN", "NO TIENE", "NINGUNO", "NINGUNA", "NO REGISTRA"]

#: Fields in which one repeated digit, or zeros, stand in for a value.
NUMBERED = ["nit", "matricula", "matricula_establecimiento", "telefono_comercial_1", "telefono_comercial_2", "telefono_comercial_3"]
ZEROED = ["fecha_matricula", "fecha_renovacion", "fecha_constitucion", "municipio_comercial", "direccion_comercial"]

#: Fields whose few values change with time; their precedence is learned.
EVOLVING = ["tamano_empresa", "estado_matricula", "tipo_organizacion", "grupo_niif", "categoria_matricula", "bic", "ultimo_ano_renovado"]
#: Changes between two values, in either direction, from which their order can be learned.
LEAST_MOVES = 8

# Trust by level of the source.
TRUST = {"confirmado": 2, "externo": 1}
# Notations of one value.
SAME = {"1": "GRUPO I", "2": "GRUPO II", "3": "GRUPO III", "I": "GRUPO I", "II": "GRUPO II", "III": "GRUPO III", "S": "SI", "N": "NO"}
YEARS = (1990, 2026)

#: A rank is one number: day (16 bits from 1900), trust (2), fields with information (5), and the row, earlier ones higher (40).
_ROWS = (1 << 40) - 1
_EPOCH = 25_567


def _fill_pattern(field: str) -> str:
    words = "|".join(w.replace("/", "\\/") for w in [*STAND_INS, *[m for m in NULL_MARKERS if m]])
    more = r"|(\d)\1*" if field in NUMBERED else r"|[0\W]*" if field in ZEROED else ""
    return rf"(?i)^\s*(?:{words}|X{{2,}}|[^\p{{L}}\p{{N}}]*{more})\s*$"


def informative(field: str) -> Column:
    """Whether the field holds information."""
    return F.col(field).isNotNull() & ~F.col(field).rlike(_fill_pattern(field))


def classed_value(field: str) -> Column:
    """The value of an evolving field without differences of writing; null without information."""
    text = F.upper(strip_accents(F.col(field)))
    if field == "tamano_empresa":
        bare = F.when(text.contains("GRAN"), "GRANDE").when(text.contains("MEDIAN"), "MEDIANA").when(text.contains("PEQUEN"), "PEQUENA").when(text.contains("MICRO"), "MICRO")
    elif field == "estado_matricula":
        bare = F.when(text.contains("CANCEL"), "CANCELADA").when(text.contains("SUSPEN"), "SUSPENDIDA").when(text.contains("ACTIV"), "ACTIVA")
    elif field == "ultimo_ano_renovado":
        year = F.regexp_replace(F.regexp_extract(text, r"^\s*(\d[.,]?\d{3})(?:[.,]0+)?\s*$", 1), "[.,]", "")
        bare = F.when(year.try_cast("int").between(*YEARS), year)
    else:
        bare = F.trim(F.regexp_replace(text, r"[^A-Z0-9]+", " "))
        if field in ("grupo_niif", "bic"):
            bare = F.coalesce(lookup(bare, SAME), bare)
    return F.when(informative(field), bare)


def annotated(rows: DataFrame, groups: DataFrame, sources: DataFrame) -> DataFrame:
    """What is compared of the rows in groups of two or more: ``entidad_dedup_id, row_order, source_id, _mask, _full, _day, _trust, _rank`` and the evolving values.

    ``_mask`` has a bit for each field with information, ``_day`` is the day's number (null the oldest).
    """
    members = groups.select("row_order", "entidad_dedup_id").filter("entidad_dedup_id is not null")
    several = members.groupBy("entidad_dedup_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("entidad_dedup_id")
    mask = F.lit(0).cast("bigint")
    for i, f in enumerate(FIELDS):
        mask = mask.bitwiseOR(F.when(informative(f), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    # the day stays far from the field's text, which survives as it was typed
    own = rows.select("row_order", "source_id", mask.alias("_mask"), F.unix_date(typed_day(F.col("fecha_renovacion"))).alias("_day"), *[classed_value(f).alias(f) for f in EVOLVING])
    listed = sources.select("source_id", F.coalesce(*[F.when(F.col("nivel_confianza_fuente") == k, v) for k, v in TRUST.items()], F.lit(0)).alias("_trust")).dropDuplicates(["source_id"])
    met = own.join(members.join(several, "entidad_dedup_id", "left_semi"), "row_order").join(listed, "source_id", "left")
    return met.withColumns({"_trust": F.coalesce("_trust", F.lit(0)), "_full": F.bit_count("_mask")}).withColumn("_rank", _rank())


def _rank() -> Column:
    """The rank of a row as one number; days before 1900 and after 2079 count as those."""
    day = F.when(F.col("_day").isNull(), 0).otherwise(F.greatest(F.lit(1), F.least(F.lit(65_535), F.col("_day") + _EPOCH)))
    return F.shiftleft(day.cast("bigint"), 47).bitwiseOR(_rank_in_day())


def _rank_in_day() -> Column:
    head = F.shiftleft(F.col("_trust").cast("bigint"), 45).bitwiseOR(F.shiftleft(F.col("_full").cast("bigint"), 40))
    return head.bitwiseOR(F.lit(_ROWS) - F.col("row_order"))


def _row_of(rank: Column) -> Column:
    return F.lit(_ROWS) - rank.bitwiseAND(F.lit(_ROWS))


class Precedence:
    """Which values of an evolving field come after which, by way of others too; of changes that are given."""

    def __init__(self, values: dict[str, list[str]]) -> None:
        self.values = values
        self.after = {f: np.zeros((len(v), len(v)), dtype=bool) for f, v in values.items()}

    @property
    def fields(self) -> list[str]:
        """The fields in which some value comes after another."""
        return [f for f in EVOLVING if f in self.after and self.after[f].any()]

    def later(self, field: str, value: str) -> set[str]:
        at = self.values[field].index(value)
        return {v for v, after in zip(self.values[field], self.after[field][at], strict=True) if after}

    def learn(self, field: str, moves: dict[tuple[int, int], tuple[int, int, int]]) -> None:
        """From ``(old, new) -> (changes, their weight, their squared weight)``.

        A majority counts beyond two standard deviations of its weight and from ``LEAST_MOVES`` changes. Values
        that come after one another in a circle have no order.
        """
        edge = np.zeros_like(self.after[field])
        for a, b in moves:
            there, back = moves[a, b], moves.get((b, a), (0, 0, 0))
            edge[a, b] = _prevails(there[0] + back[0], there[1] - back[1], there[2] + back[2])
        edge &= ~_closed(edge).T
        self.after[field] = _closed(edge)

    def named(self, spark: SparkSession) -> DataFrame:
        """``f, value, later``: all pairs."""
        return spark.createDataFrame([(FIELDS.index(f), v, w) for f in self.fields for v in self.values[f] for w in self.later(f, v)], "f int, value string, later string")

    def coded(self, noted: DataFrame) -> tuple[DataFrame, int]:
        """``f, a, b``, where b comes after a, and the salt of their codes, which are those of the rows' values too."""
        named = cut(self.named(noted.sparkSession))
        salt = _salt(cut(_words(noted).union(named.select("f", "value")).union(named.select("f", "later")).distinct()))
        return cut(named.select("f", _code(F.col("value"), salt).alias("a"), _code(F.col("later"), salt).alias("b"))), salt


class LearnedPrecedence(Precedence):
    """The precedence in the rows; its pairs are a table, whose size nothing bounds."""

    def __init__(self, noted: DataFrame, words: DataFrame, salt: int, pairs: DataFrame) -> None:
        super().__init__({})
        self.noted, self.words, self.salt, self.pairs = noted, words, salt, pairs
        found = {r.f for r in pairs.select("f").distinct().collect()}
        self.with_pairs = [f for f in EVOLVING if FIELDS.index(f) in found]

    @property
    def fields(self) -> list[str]:
        return self.with_pairs

    def later(self, field: str, value: str) -> set[str]:
        return {r.later for r in self.named(self.pairs.sparkSession).filter((F.col("f") == FIELDS.index(field)) & (F.col("value") == value)).collect()}

    def named(self, spark: SparkSession) -> DataFrame:
        words = self.words.select("f", "value", _code(F.col("value"), self.salt).alias("code"))
        old, new = words.withColumnRenamed("code", "a"), words.select("f", F.col("value").alias("later"), F.col("code").alias("b"))
        return self.pairs.join(old, ["f", "a"]).join(new, ["f", "b"]).select("f", "value", "later")

    def coded(self, noted: DataFrame) -> tuple[DataFrame, int]:
        return (self.pairs, self.salt) if noted is self.noted else super().coded(noted)


def _prevails(changes, margin, squares):
    """Whether changes between two values have a direction, of numbers or columns."""
    return (changes >= LEAST_MOVES) & (margin > 0) & (margin * margin > 4 * squares)


def _closed(edge: np.ndarray) -> np.ndarray:
    reach = edge.copy()
    for k in range(len(reach)):
        reach |= np.outer(reach[:, k], reach[k])
    return reach


def _reached(edge: DataFrame) -> DataFrame:
    """``f, a, b``: what can be reached by edges; every round doubles the length of the ways."""
    reach, size = edge, edge.count()
    while True:
        further = reach.select("f", "a", F.col("b").alias("via")).join(reach.select("f", F.col("a").alias("via"), "b"), ["f", "via"]).select("f", "a", "b")
        more = cut(reach.unionByName(further).distinct())
        if (grown := more.count()) == size:
            return reach
        reach, size = more, grown


def _words(noted: DataFrame) -> DataFrame:
    """``f, value``: every value of the evolving fields."""
    each = F.explode(F.array(*[F.struct(F.lit(FIELDS.index(f)).alias("f"), F.col(f).alias("value")) for f in EVOLVING])).alias("p")
    return noted.select(each).select("p.*").filter("value is not null").distinct()


def _code(value: Column, salt: int) -> Column:
    return F.xxhash64(value, F.lit(salt))


def _salt(words: DataFrame) -> int:
    """The first salt with which the values of every field have codes of their own."""
    return next(salt for salt in count() if words.groupBy("f", _code(F.col("value"), salt).alias("code")).count().filter("count > 1").isEmpty())


def _codes(fields: list[str], salt: int) -> Column:
    """``f, code`` of every one of the fields with information; null is the code where no value was read from it."""

    def one(f: str) -> Column:
        return F.when(_has(f), F.struct(F.lit(FIELDS.index(f)).alias("f"), F.when(F.col(f).isNotNull(), _code(F.col(f), salt)).alias("code")))

    return F.array_compact(F.array(*[one(f) for f in fields]))


def _has(field: str) -> Column:
    return F.col("_mask").bitwiseAND(F.lit(1 << FIELDS.index(field))) != 0


def learned_precedence(noted: DataFrame) -> LearnedPrecedence:
    """The precedence of the evolving fields, from the rows with a day.

    A day of a group counts once, so even the largest group has no more rows here than the calendar has days. A
    change weighs as much as the sources of both rows are trusted. Every value takes part, however rare; changes,
    edges and what they reach stay tables.
    """
    words = cut(_words(noted))
    salt = _salt(words)
    timed = noted.filter("_day is not null").select("entidad_dedup_id", "_day", _rank_in_day().alias("_by"), F.explode(_codes(EVOLVING, salt)).alias("p")).filter("p.code is not null")
    days = timed.groupBy("entidad_dedup_id", F.col("p.f").alias("f"), "_day").agg(F.max("_by").alias("_by"), F.max_by("p.code", "_by").alias("code"))
    days = days.select("entidad_dedup_id", "f", "_day", "code", (F.shiftright("_by", 45) + 1).alias("trust"))
    order = Window.partitionBy("entidad_dedup_id", "f").orderBy("_day")
    moves = days.select("f", F.lag("code").over(order).alias("old"), F.col("code").alias("new"), (F.col("trust") * F.lag("trust").over(order)).alias("w")).filter("old <> new")
    # the changes of two values in both directions are one row
    pair = moves.groupBy("f", F.least("old", "new").alias("a"), F.greatest("old", "new").alias("b"))
    pair = pair.agg(F.count("*").alias("n"), F.sum(F.when(F.col("old") < F.col("new"), F.col("w")).otherwise(-F.col("w"))).alias("up"), F.sum(F.col("w") * F.col("w")).alias("ww"))
    up = F.col("up") > 0
    edge = pair.filter(_prevails(F.col("n"), F.abs("up").cast("decimal(19,0)"), F.col("ww"))).select("f", F.when(up, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("b"))
    edge = cut(edge)
    after = _reached(edge)
    if not after.filter("a = b").isEmpty():
        back = after.select("f", F.col("a").alias("b"), F.col("b").alias("a"))
        after = _reached(cut(edge.join(back, ["f", "a", "b"], "left_anti")))
    return LearnedPrecedence(noted, words, salt, after)


def _ordered(noted: DataFrame, fields: list[str], pairs: DataFrame, salt: int) -> DataFrame:
    """``entidad_dedup_id, f, rank``: for every field with a precedence the rank of the row whose value survives.

    The latest value with a day stands unless values without any day come after it. Of those (of all values, where
    none has a day) the ones remain that no other of them comes after, and the best row among theirs is taken. A
    group has one row for each of its values here, whatever its size.
    """
    timed, group = F.col("_day").isNotNull(), ["entidad_dedup_id", "f"]
    long = noted.select("entidad_dedup_id", F.when(timed, F.col("_rank")).alias("dated"), F.when(~timed, F.col("_rank")).alias("undated"), F.explode(_codes(fields, salt)).alias("p"))
    best = cut(long.groupBy("entidad_dedup_id", F.col("p.f").alias("f"), F.col("p.code").alias("code")).agg(F.max("dated").alias("dated"), F.max("undated").alias("undated")))
    top = best.groupBy(*group).agg(F.max("dated").alias("top"), F.max_by("code", "dated").alias("a"), F.count(F.when(F.col("dated").isNull(), 1)).alias("open"))
    follows = pairs.select("f", "a", F.col("b").alias("code"), F.lit(True).alias("follows"))
    open_ = best.filter("dated is null").join(top, group).join(follows, ["f", "a", "code"], "left").filter("top is null or follows")
    # every value beside those that it comes after, which it beats where the group has them
    beats = pairs.select("f", F.col("b").alias("code"), F.col("a").alias("met")).unionByName(pairs.select("f", F.col("b").alias("code"), F.col("b").alias("met")).distinct())
    met = open_.alias("o").join(beats.alias("x"), (F.col("o.f") == F.col("x.f")) & (F.col("o.code") == F.col("x.code")) & (F.col("open") > 1), "left")
    own = F.col("met").isNull() | (F.col("met") == F.col("o.code"))
    met = met.groupBy("entidad_dedup_id", F.col("o.f").alias("f"), F.coalesce("met", "o.code").alias("code")).agg(F.max(F.when(own, F.col("undated"))).alias("rank"), F.max(~own).alias("beaten"))
    last = met.filter("not beaten").groupBy(*group).agg(F.max("rank").alias("last"))
    return top.join(last, group, "left").select(*group, F.coalesce("last", "top").alias("rank"))


def _summed(noted: DataFrame, plain: list[str]) -> DataFrame:
    """One row per group: rows, sources, guide, and for the plain fields the rank of the best row that has one (``_r_``)."""
    # the greatest record of all respects at once is the greatest in lexicographic order, if there is one
    head = F.col("_full").cast("bigint") * (1 << 26) + (F.coalesce(F.col("_day") + 1_000_000, F.lit(0))) * 4 + F.col("_trust")
    record = head.cast("decimal(20,0)") * F.lit(1 << 41).cast("decimal(18,0)") + (F.lit(1 << 40) - F.col("row_order")).cast("decimal(18,0)")
    picked = [F.max(F.when(_has(f), F.col("_rank"))).alias(f"_r_{f}") for f in plain]
    top = noted.groupBy("entidad_dedup_id").agg(
        F.count("*").alias("registros"), F.max("_full").alias("_full"), F.max(F.coalesce(F.col("_day") + 1_000_000, F.lit(0))).alias("_day"), F.max("_trust").alias("_trust"), F.max(record).alias("_best"), *picked
    )
    every = noted.select("entidad_dedup_id", "source_id").distinct().groupBy("entidad_dedup_id").agg(F.array_join(F.array_sort(F.collect_list("source_id")), ";").alias("fuentes_consolidadas"))
    unbeaten = (F.col("_full").cast("bigint") * (1 << 26) + F.col("_day") * 4 + F.col("_trust")).cast("decimal(20,0)")
    whole = F.floor(F.col("_best") / F.lit(1 << 41).cast("decimal(18,0)"))
    row = F.lit(1 << 40) - (F.col("_best") % F.lit(1 << 41).cast("decimal(18,0)")).cast("bigint")
    return top.join(every, "entidad_dedup_id").withColumn("guia", F.when(whole == unbeaten, row)).drop("_full", "_day", "_trust", "_best")


def survivors(rows: DataFrame, groups: DataFrame, sources: DataFrame, precedence: Precedence | None = None) -> DataFrame:
    """One row per group of two or more: the surviving fields, ``fuentes_consolidadas``, ``registros``, ``guia``.

    ``guia`` is the row_order of the group's guide, null where no record is unbeaten in every respect.
    ``precedence`` is learned from the rows unless it is given.
    """
    noted = cut(annotated(rows, groups, sources))
    order = learned_precedence(noted) if precedence is None else precedence
    plain = [f for f in FIELDS if f not in order.fields]
    summary = cut(_summed(noted, plain))
    # which row gives which fields; only then are the values themselves read, once and of those rows only
    ranked = summary.select("entidad_dedup_id", F.explode(F.array(*[F.struct(F.lit(FIELDS.index(f)).alias("f"), F.col(f"_r_{f}").alias("rank")) for f in plain])).alias("p")).select("entidad_dedup_id", "p.f", "p.rank").filter("rank is not null")
    if order.fields:
        ranked = ranked.unionByName(_ordered(noted, order.fields, *order.coded(noted)))
    gives = ranked.groupBy("entidad_dedup_id", _row_of(F.col("rank")).alias("row_order")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("f"))).alias("_mask"))
    given = rows.select("row_order", *FIELDS).join(gives, "row_order").select("entidad_dedup_id", *[F.when(_has(f), F.col(f)).alias(f) for f in FIELDS])
    values = given.groupBy("entidad_dedup_id").agg(*[F.max(f).alias(f) for f in FIELDS])
    return summary.join(values, "entidad_dedup_id", "left").select("entidad_dedup_id", *FIELDS, "fuentes_consolidadas", "registros", "guia")


def guides(rows: DataFrame, groups: DataFrame, sources: DataFrame) -> DataFrame:
    """``entidad_dedup_id, row_order`` of the groups that have a guide."""
    return survivors(rows, groups, sources).filter("guia is not null").select("entidad_dedup_id", F.col("guia").alias("row_order"))
