"""Variant spellings of names, attached to frequent spellings by a noisy channel.

A name is read into the parts that tell it from others (legal form, trade word, given names and initials are
set aside, short and familiar forms written out). Equal parts form one spelling with a frequency. Spellings
that share two intact segments meet; a spelling is attached to the one with the highest posterior, log
frequency (prior) less the cost of what was typed otherwise (channel), among those that rank above it. Chains of
attachments end in one canonical form per class.

The channel is learned: all edits cost the same at first; what the attached pairs differ in, by kind (look-alikes,
doubled and swapped letters, letters lost, added or changed, parts cut short), gives the likelihood of each kind.
A spelling stays by itself if a name of its own, letter by letter, is likelier than what the channel would have to
have done.

Defined results: null or blank names and names without a telling part are in no class. Repeated rows share
their class; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm import edits, links
from cauce.llm.name_text import parse
from cauce.session import cut

SEGMENT = 4
JOINED = 8
#: Edits that one part, and a whole name, may have.
PART_EDITS, NAME_EDITS = 3, 5
#: Cost of one edit in the channel, in nats, before any is learned, and the rounds in which costs are learned.
EDIT_COST, ROUNDS = 2.5, 2
#: Cost of a letter of a name made up by itself, in nats (19 letters as likely as one another).
LETTER_COST = 2.94
#: Spellings with one part key in common beyond which they meet by the pieces of the other part that its edits leave.
COMMON_PART = 300


def spelled_rows(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``key, name, core``: the telling parts of every name as one text, in alphabetical order if they are two."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cores = []
            for t in b[name]:
                parts = parse(t).core
                cores.append(" ".join(sorted(parts) if len(parts) == 2 else parts) or None)
            b["core"] = cores
            yield b[b["core"].notna()]

    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, `{name}` string, core string"
    return rows.select(key, name).filter(F.col(name).isNotNull()).mapInPandas(read, schema)


def _segments(part: Column) -> tuple[Column, Column]:
    return F.concat(F.lit("f"), F.substring(part, 1, SEGMENT)), F.concat(F.lit("l"), F.substring(part, -SEGMENT, SEGMENT))


def pair_keys(a: Column, b: Column) -> list[Column]:
    """Keys of two intact segments, one of each part: they survive an edit in both parts, and their swap."""
    return [F.concat_ws("+", F.least(x, y), F.greatest(x, y)) for x in _segments(a) for y in _segments(b)]


def part_keys(a: Column) -> Column:
    """The key of one intact part."""
    first, last = _segments(a)
    return F.concat_ws("*", first, last)


def end_keys(joined: Column) -> list[Column]:
    return [F.concat(F.lit("P"), F.substring(joined, 1, JOINED)), F.concat(F.lit("S"), F.substring(joined, -JOINED, JOINED))]


def part_distance(xa: Column, xb: Column, ya: Column, yb: Column) -> Column:
    """Edits part by part in the better order; null if a part has more than it may."""
    most = PART_EDITS + 1

    def order(p: Column, q: Column, r: Column, s: Column) -> Column:
        one, two = F.levenshtein(p, q, most), F.levenshtein(r, s, most)  # -1 beyond the most
        return F.when((one >= 0) & (two >= 0) & ((one < most) & (two < most) | (one + two == most)), one + two)

    return F.least(order(xa, ya, xb, yb), order(xa, yb, xb, ya))


def distance(x: str, y: str) -> Column:
    """Edits between two spellings (columns ``x.`` and ``y.``: a, b, joined): part by part in the better order, or joined."""
    xa, xb, ya, yb = F.col(f"{x}.a"), F.col(f"{x}.b"), F.col(f"{y}.a"), F.col(f"{y}.b")

    joined = F.least(F.levenshtein(F.col(f"{x}.joined"), F.col(f"{y}.joined")), F.levenshtein(F.col(f"{x}.joined"), F.concat(yb, ya)), F.levenshtein(F.concat(xb, xa), F.col(f"{y}.joined")))
    both = part_distance(xa, xb, ya, yb)
    return F.when(xb.isNotNull() & yb.isNotNull(), both).otherwise(joined)


def parts_of(core: Column) -> list[Column]:
    """``core, a, b, joined`` of a spelling; ``b`` is null unless it has two parts."""
    parts = F.split(core, " ")
    two = F.size(parts) == 2
    return [core.alias("core"), F.when(two, parts[0]).alias("a"), F.when(two, parts[1]).alias("b"), F.replace(core, F.lit(" "), F.lit("")).alias("joined")]


def _edges(core_x: Column, core_y: Column) -> list[Column]:
    """``a, b, n_a, n_b, d`` from counts ``x.n, y.n`` and edits ``d``."""
    return [core_x.alias("a"), core_y.alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"), "d"]


def _met_in_common(alone: DataFrame) -> DataFrame:
    """``x, y`` of one common key whose other parts may be within the edits that ``part_distance`` allows, and few more.

    One part may have ``PART_EDITS`` + 1 edits if the other has none. Of two spellings the shorter part is cut into
    one piece more, and the longer one is searched for each of them. Where both parts of a name are alike, the other
    part may also pair with the common one ("o") of the other spelling; two common ones are never paired.
    """
    most = PART_EDITS + 1

    def keys(cut_up: Callable[[str], list[str]], rest_to: str, part_to: str) -> Callable[[pd.Series, pd.Series], pd.Series]:
        def of(rests: pd.Series, parts: pd.Series) -> pd.Series:
            return pd.Series([[t + k for w, to in ((r, rest_to), (p, part_to)) for k in cut_up(w) for t in to] for r, p in zip(rests, parts, strict=True)])

        return of

    # made here: the module is also imported by workers, which have no session
    own = F.pandas_udf(keys(lambda w: edits.own_pieces(w, most), "r", "o"), "array<string>")
    sought = F.pandas_udf(keys(lambda w: edits.sought_pieces(w, lambda n: most, most), "ro", "r"), "array<string>")
    side = lambda v, f: alone.select(F.col("v").alias(v), F.explode(F.array_distinct(f("rest", "part"))).alias("piece"), "pk").select(v, F.xxhash64("pk", "piece").alias("k"))
    return side("x", own).join(side("y", sought), "k").filter(F.col("x") != F.col("y")).select("x", "y")


def whole_edges(read: DataFrame) -> DataFrame:
    """Edges among spellings of two parts that share a key of two intact segments, or one intact part."""
    me = F.struct("a", "b", "n")
    two = read.filter("b is not null")
    alone = two.select(me.alias("v"), F.inline(F.array(F.struct(F.col("a").alias("part"), F.col("b").alias("rest")), F.struct(F.col("b").alias("part"), F.col("a").alias("rest")))))
    alone = alone.withColumn("pk", part_keys(F.col("part")))
    # a key that many spellings share would make a quadratic block: there they meet by pieces of the other part
    # written first, so that the joins are planned by its true size and ``alone`` isn't shuffled for an empty list
    common = cut(alone.groupBy("pk").agg(F.count("*").alias("df")).filter(F.col("df") > COMMON_PART).select("pk"))
    keyed = (
        two.select(me.alias("v"), F.explode(F.array(*pair_keys(F.col("a"), F.col("b")))).alias("key"))
        .unionByName(alone.join(common, "pk", "left_anti").select("v", F.col("pk").alias("key")))
        .select(F.xxhash64("key").alias("k"), "v")
    )
    x, y = keyed.withColumnRenamed("v", "x"), keyed.withColumnRenamed("v", "y")
    met = x.join(y, (x.k == y.k) & (F.col("x") < F.col("y"))).select("x", "y")
    if not common.isEmpty():
        met = met.unionByName(_met_in_common(alone.join(common, "pk", "left_semi")))
    met = met.select("x", "y", part_distance(F.col("x.a"), F.col("x.b"), F.col("y.a"), F.col("y.b")).alias("d"))
    return met.filter(F.col("d") <= NAME_EDITS).select(*_edges(F.concat_ws(" ", "x.a", "x.b"), F.concat_ws(" ", "y.a", "y.b")))


def _met_by_rest(ends: DataFrame) -> DataFrame:
    """``x, y`` of one common end whose other letters may be within ``NAME_EDITS`` edits: by the pieces these leave."""
    own = F.pandas_udf(lambda s: pd.Series([edits.own_pieces(w, NAME_EDITS) for w in s]), "array<string>")
    sought = F.pandas_udf(lambda s: pd.Series([edits.sought_pieces(w, lambda n: NAME_EDITS, NAME_EDITS) for w in s]), "array<string>")
    side = lambda v, f: ends.select(F.col("v").alias(v), F.explode(f("rest")).alias("piece"), "k").select(v, F.xxhash64("k", "piece").alias("k"))
    met = side("x", own).join(side("y", sought), "k").select("x", "y")
    return met.unionByName(met.select(F.col("y").alias("x"), F.col("x").alias("y")))


def joined_edges(read: DataFrame) -> DataFrame:
    """Edges of names written together or broken up, which meet all others by the ends of the joined text."""
    texts = F.array_distinct(F.array_compact(F.array(F.col("joined"), F.concat("b", "a"))))
    rest = lambda t: F.struct(F.xxhash64(F.concat(F.lit("P"), F.substring(t, 1, JOINED))).alias("k"), F.substring(t, JOINED + 1, 1_000_000).alias("rest"))
    front = lambda t: F.struct(F.xxhash64(F.concat(F.lit("S"), F.substring(t, -JOINED, JOINED))).alias("k"), F.substring(t, F.lit(1), F.greatest(F.length(t) - JOINED, F.lit(0))).alias("rest"))
    me = F.struct("core", "a", "b", "joined", "n")
    ends = read.select(me.alias("v"), F.explode(texts).alias("t")).select("v", F.inline(F.array(rest(F.col("t")), front(F.col("t")))))
    odd = ends.filter("v.b is null")
    # as with common parts, an end of many names would make a block of all pairs
    common = cut(ends.groupBy("k").agg(F.count("*").alias("all"), F.count_if(F.col("v.b").isNull()).alias("odd")).filter((F.col("all") > COMMON_PART) & (F.col("odd") > 0)).select("k"))
    usual = lambda df: df.join(common, "k", "left_anti")
    met = usual(odd).select(F.col("v").alias("x"), "k").join(usual(ends).select(F.col("v").alias("y"), "k"), "k").select("x", "y")
    if not common.isEmpty():
        met = met.unionByName(_met_by_rest(ends.join(common, "k", "left_semi")).filter("x.b is null"))
    met = met.filter(F.col("y.b").isNotNull() | (F.col("x.core") < F.col("y.core")))
    return met.select("x", "y", distance("x", "y").alias("d")).filter(F.col("d") <= NAME_EDITS).select(*_edges(F.col("x.core"), F.col("y.core")))


def edges_of(vertices: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b, d``: spellings within the edits allowed, once each."""
    read = vertices.select(*parts_of(F.col("core")), "n")
    found = whole_edges(read).unionByName(joined_edges(read))
    first = F.col("a") < F.col("b")
    ends = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(first, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"), F.when(first, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"), "d")
    return ends.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.min("d").alias("d"))


def typed_otherwise(edges: DataFrame) -> DataFrame:
    """Edges ``meant, typed`` (the more frequent spelling first) with their ranks and ``ops``, the edits by kind."""
    up = F.struct(F.col("n_b").alias("n"), F.col("b").alias("c")) > F.struct(F.col("n_a").alias("n"), F.col("a").alias("c"))
    pick = lambda x, y: F.when(up, F.col(x)).otherwise(F.col(y))
    ends = edges.select(pick("b", "a").alias("meant"), pick("a", "b").alias("typed"), pick("n_b", "n_a").alias("n_meant"), pick("n_a", "n_b").alias("n_typed"))
    counted = F.pandas_udf(lambda m, t: pd.Series([edits.operations(x, y) for x, y in zip(m, t, strict=True)]), "array<int>")
    return ends.withColumn("ops", counted("meant", "typed"))


def best_meant(typed: DataFrame, costs: list[float]) -> DataFrame:
    """``id, parent, ops``: for each spelling the one it most likely stands for, if that is likelier than itself."""
    channel = sum((F.col("ops")[k] * F.lit(float(c)) for k, c in enumerate(costs)), F.lit(0.0))
    score = F.log("n_meant") - channel
    alone = F.log("n_typed") - LETTER_COST * F.length(F.replace("typed", F.lit(" "), F.lit("")))
    likely = typed.withColumn("score", score).filter(F.col("score") >= alone)
    return likely.groupBy(F.col("typed").alias("id")).agg(F.max_by(F.struct(F.col("meant").alias("parent"), "ops"), F.struct("score", "n_meant", "meant")).alias("m")).select("id", "m.*")


def learned_costs(typed: DataFrame) -> list[float]:
    """The cost of each kind of edit, from how often it occurs in the letters of attached spellings. One row reaches the driver."""
    costs = [EDIT_COST] * len(edits.KINDS)
    for _ in range(ROUNDS):
        letters = F.length(F.replace("id", F.lit(" "), F.lit("")))
        r = best_meant(typed, costs).agg(F.sum(letters).alias("letters"), *[F.sum(F.col("ops")[k]).alias(f"k{k}") for k in range(len(costs))]).first()
        if not r.letters:
            break
        costs = [-math.log((r[f"k{k}"] + 1) / (r.letters + len(costs))) for k in range(len(costs))]
    return costs


def classed(rows: DataFrame, key: str = "row_order", name: str = "razon_social_normalizada") -> DataFrame:
    """``key, name, core, clase``: the canonical spelling of every row whose name has a telling part."""
    spelled = cut(spelled_rows(rows, key, name))
    vertices = cut(spelled.groupBy("core").agg(F.count("*").alias("n")))
    typed = cut(typed_otherwise(edges_of(vertices)))
    pointers = links.roots(best_meant(typed, learned_costs(typed)).select("id", "parent"))
    return spelled.join(pointers, spelled.core == pointers.id, "left").select(key, name, "core", F.coalesce("root", "core").alias("clase"))


def variant_pairs(rows: DataFrame) -> DataFrame:
    """Pairs ``row_order_a < row_order_b`` of one class with different normalised names."""
    return links.pairs_across(classed(rows), "row_order", ["clase"], ["razon_social_normalizada"])
