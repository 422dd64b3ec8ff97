"""Addresses of one place written differently: sorted neighbourhoods in several component orders.

Every address is read into parts (street number, plate, kind; or district and property). Equal parts form one
vertex, however many rows carry it. The vertices are sorted three times, led by the first component, by the second,
and by the municipality, and each is compared with its neighbours in a window: numbers, letters, BIS and direction
must be equal, words may differ by an edit or two or by transposed letters. Each vertex points to the best
neighbour that more rows write.

A window holds every pair of a run of equal leading components that is no longer than itself. In longer runs the
vertices meet by the pieces of the other component that survive the edits allowed, so no pair that would be close
enough is missed, at any size.

Defined results: null, blank and unreadable addresses and those without plate or property denote no place and
get no class. Unit, neighbourhood and company do not matter. A missing or unusable municipality is compatible
with any. Repeated rows are members of the same class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm import edits, links, places
from cauce.llm.address_text import parse
from cauce.operators.numbering import numbered
from cauce.session import cut

#: Neighbours before it that a vertex is compared with, and the vertices of a block, which a task holds at most.
WINDOW, BLOCK = 10, 5_000


def read_addresses(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """``row_order, direccion_comercial, mun, kind, first, second, word`` of the rows that denote a place."""
    listed = places.reference_rows(reference)
    frequency = places.entry_frequency(rows, reference)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = places.PlaceIndex(listed, frequency)
        for b in batches:
            parts = [parse(t) for t in b["direccion_comercial"]]
            keep = [p is not None for p in parts]
            b, parts = b[keep], [p for p in parts if p]
            towns = [index.resolve(t, d) for t, d in zip(b["municipio_comercial"], b["departamento"], strict=True)]
            out = pd.DataFrame(parts, columns=["kind", "first", "second", "word"])
            out.insert(0, "row_order", b["row_order"].to_numpy())
            out.insert(1, "direccion_comercial", b["direccion_comercial"].to_numpy())
            out["mun"] = [None if t == places.NONE else t for t in towns]
            yield out

    schema = "row_order bigint, direccion_comercial string, kind string, first string, second string, word string, mun string"
    return rows.select("row_order", "direccion_comercial", "municipio_comercial", "departamento").filter("direccion_comercial is not null").mapInPandas(read, schema)


def _close(a: Column, b: Column) -> Column:
    """Within two edits in long words, one in short ones; or the same letters with few out of place."""
    apart = F.levenshtein(a, b)
    shorter = F.least(F.length(a), F.length(b))
    swapped = (F.array_join(F.array_sort(F.split(a, "")), "") == F.array_join(F.array_sort(F.split(b, "")), "")) & (apart <= 4)
    return (a == b) | (apart <= F.when(shorter >= 7, 2).otherwise(1)) | swapped


def _same_place(x: Column, y: Column) -> Column:
    # both numbers to the letter; a street kind that could not be read may be any
    street = (x["first"] == y["first"]) & (x["second"] == y["second"]) & (x["word"].startswith("?") | y["word"].startswith("?"))
    exact = (x["first"] == y["first"]) | (x["second"] == y["second"])
    rural = _close(x["first"], y["first"]) & _close(x["second"], y["second"]) & exact
    return (x["kind"] == y["kind"]) & F.when(x["kind"] == "u", street).otherwise(rural)


def _edits(shorter: int) -> int:
    """The edits of ``_close`` by the length of the shorter word."""
    return 2 if shorter >= 7 else 1


def _keys(words: pd.Series, one: Callable[[str], list[str]]) -> pd.Series:
    # the sorted letters find words with letters out of place
    return pd.Series([[*one(w), "~" + "".join(sorted(w))] for w in words])


def _edge(x: Column, y: Column) -> list[Column]:
    return [
        x["id"].alias("a"), y["id"].alias("b"), x["rank"].alias("rank_a"), y["rank"].alias("rank_b"),
        (-F.levenshtein(x["first"], y["first"]) - F.levenshtein(x["second"], y["second"])).alias("score"),
    ]


def window_edges(vertices: DataFrame, *order: str, window: int = WINDOW) -> DataFrame:
    """Edges between vertices at most ``window`` places apart in an order.

    The places are cut into blocks of equal size; the last ones of a block are copied to the front of the next, so
    its first ones have all their neighbours. No block grows with the data.
    """
    placed = numbered(vertices, *order, name="place").select(F.struct("id", "kind", "first", "second", "word", "rank").alias("me"), "place")
    block, within = F.floor(F.col("place") / BLOCK), F.col("place") % BLOCK
    blocks = F.when(within >= BLOCK - window, F.array(F.struct(block.alias("b"), F.lit(True).alias("own")), F.struct((block + 1).alias("b"), F.lit(False).alias("own")))).otherwise(F.array(F.struct(block.alias("b"), F.lit(True).alias("own"))))
    before = Window.partitionBy("b").orderBy("place").rowsBetween(-window, -1)
    near = placed.select("me", "place", F.inline(blocks)).withColumn("near", F.collect_list("me").over(before)).filter("own")
    met = near.select(F.col("me").alias("x"), F.explode(F.filter("near", lambda y: (F.col("me.id") != y["id"]) & _same_place(F.col("me"), y))).alias("y"))
    return met.select(*_edge(F.col("x"), F.col("y")))


def _met(x: DataFrame, y: DataFrame, by: list[str]) -> DataFrame:
    return x.join(y, by).filter((F.col("x.id") != F.col("y.id")) & _same_place(F.col("x"), F.col("y"))).select(*_edge(F.col("x"), F.col("y")))


def long_run_edges(vertices: DataFrame, window: int = WINDOW) -> DataFrame:
    """All edges inside runs of equal leading components that are longer than a window.

    Doors share both numbers, and a kind that was not recognised meets all kinds. Rural places share one component
    exactly; in the other one, a piece of the shorter word or all letters are intact whatever edits ``_close`` allows.
    """
    # made here: the module is also imported by workers, which have no session
    own = F.pandas_udf(lambda s: _keys(s, lambda w: edits.own_pieces(w, _edits(len(w)))), "array<string>")
    sought = F.pandas_udf(lambda s: _keys(s, lambda w: edits.sought_pieces(w, _edits, 2)), "array<string>")
    me = F.struct("id", "kind", "first", "second", "word", "rank")
    found = None
    for kind, lead, other in (("u", ["first", "second"], None), ("r", ["first"], "second"), ("r", ["second"], "first")):
        mine = vertices.filter(F.col("kind") == kind)
        runs = cut(mine.groupBy(*lead).agg(F.count("*").alias("n")).filter(F.col("n") > window + 1).select(*lead))
        if runs.isEmpty():
            continue
        mine = mine.join(runs, lead, "left_semi")
        if other is None:
            met = _met(mine.filter(F.col("word").startswith("?")).select(me.alias("x"), *lead), mine.select(me.alias("y"), *lead), lead)
        else:
            keyed = lambda side, f: mine.select(me.alias(side), F.col(lead[0]).alias("lead"), F.explode(f(F.col(other))).alias("k"))  # noqa: B023, E731
            met = _met(keyed("x", own), keyed("y", sought), ["lead", "k"])
        found = met if found is None else found.unionByName(met)
    return vertices.limit(0).select(*_edge(F.struct("id", "first", "second", "rank"), F.struct("id", "first", "second", "rank"))) if found is None else found


def neighbour_edges(vertices: DataFrame, in_towns: DataFrame | None = None, window: int = WINDOW) -> DataFrame:
    """Edges of all orders; ``in_towns`` has the vertices once for each municipality (``mun``) they occur in."""
    found = window_edges(vertices, "kind", "first", "second", "word", "id", window=window).unionByName(window_edges(vertices, "kind", "second", "first", "word", "id", window=window))
    if in_towns is not None:
        found = found.unionByName(window_edges(in_towns, "mun", "kind", "word", "second", "first", "id", window=window))
    return found.unionByName(long_run_edges(vertices, window))


def classed(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """``row_order, direccion_comercial, mun, lugar``: the place class of every row that denotes one."""
    read = cut(read_addresses(rows, reference).withColumn("id", F.concat_ws("/", "kind", "first", "second", "word")))
    parts = ["id", "kind", "first", "second", "word"]
    in_towns = read.groupBy(*parts, "mun").agg(F.count("*").alias("m"))
    vertices = cut(in_towns.groupBy(*parts).agg(F.sum("m").alias("n")).withColumn("rank", F.struct("n", "id")))
    ranked = in_towns.select(*parts, "mun", F.struct(F.col("m").alias("n"), "id").alias("_")).join(vertices.select("id", "rank"), "id").drop("_")
    pointers = links.roots(links.best_neighbour(neighbour_edges(vertices, ranked)))
    return read.join(pointers, "id", "left").select("row_order", "direccion_comercial", "mun", F.coalesce("root", "id").alias("lugar"))


def town_classes(classed_rows: DataFrame) -> DataFrame:
    """``lugar, mun, clase``: places by municipality, one row for each; a class never holds two known ones.

    An unknown municipality (null) has the class of the place's only known one, or a class of its own (its name
    ends with ``@``) where the place is known in several, or in none.
    """
    kinds = classed_rows.select("lugar", "mun").distinct()
    known = kinds.groupBy("lugar").agg(F.count("mun").alias("n"), F.min("mun").alias("only"))
    town = F.coalesce("mun", F.when(F.col("n") == 1, F.col("only")), F.lit(""))
    return kinds.join(known, "lugar").select("lugar", "mun", F.concat_ws("@", "lugar", town).alias("clase"))


def members(classed_rows: DataFrame) -> DataFrame:
    """``row_order, clase, codigo_dane, filas``: every row that denotes a place, its class and the class's rows."""
    named = classed_rows.withColumn("mun", F.coalesce("mun", F.lit("")))
    kinds = town_classes(classed_rows).withColumn("mun", F.coalesce("mun", F.lit("")))
    counts = named.groupBy("lugar", "mun").agg(F.count("*").alias("m")).join(kinds, ["lugar", "mun"])
    size = counts.groupBy("clase").agg(F.sum("m").alias("filas"))
    return named.join(counts.join(size, "clase").select("lugar", "mun", "clase", "filas"), ["lugar", "mun"]).select("row_order", "clase", F.nullif("mun", F.lit("")).alias("codigo_dane"), "filas")


def class_links(classed_rows: DataFrame) -> DataFrame:
    """``clase_a, clase_b``: the classes of unknown municipality with all those of the same place they are compatible with."""
    kinds = town_classes(classed_rows).select("lugar", "clase").distinct()
    own = kinds.filter(F.col("clase").endswith("@"))
    return own.select("lugar", F.col("clase").alias("clase_a")).join(kinds.filter(~F.col("clase").endswith("@")).select("lugar", F.col("clase").alias("clase_b")), "lugar").select("clase_a", "clase_b")


def same_place_pairs(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Pairs ``row_order_a < row_order_b`` at the same place whose texts differ; towns equal or one unknown."""
    towns = F.col("x.mun").isNull() | F.col("y.mun").isNull() | (F.col("x.mun") == F.col("y.mun"))
    return links.pairs_across(classed(rows, reference), "row_order", ["lugar"], ["direccion_comercial", "mun"], towns)
