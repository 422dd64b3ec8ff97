"""Shared steps of the linking operators: classes from best-neighbour pointers, and pairs from classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.session import cut


def roots(parents: DataFrame) -> DataFrame:
    """``id, root`` from ``id, parent``, where following parents always ends at an id without a row.

    Pointer doubling: the number of rounds is the logarithm of the longest chain, each round one join on a
    table of links only, written to the shared folder.
    """
    now = cut(parents.select("id", F.col("parent").alias("root")))
    while True:
        up = now.select(F.col("id").alias("root"), F.col("root").alias("_up"))
        after = cut(now.join(up, "root", "left").select("id", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved")))
        if after.filter("_moved").isEmpty():
            return after.select("id", "root")
        now = after.select("id", "root")


def best_neighbour(edges: DataFrame) -> DataFrame:
    """``id, parent``: of the neighbours that rank above a vertex, the one with the highest score.

    ``edges`` has ``a, b, rank_a, rank_b, score``; ranks are unique per vertex, so the pointers have no cycle.
    """
    up = F.col("rank_b") > F.col("rank_a")
    ends = edges.select(
        F.when(up, F.col("a")).otherwise(F.col("b")).alias("id"),
        F.when(up, F.col("b")).otherwise(F.col("a")).alias("parent"),
        F.struct("score", F.when(up, F.col("rank_b")).otherwise(F.col("rank_a"))).alias("_by"),
    )
    return ends.groupBy("id").agg(F.max_by("parent", "_by").alias("parent"))


def pairs_across(rows: DataFrame, key: str, group: list[str], variant: list[str], compatible: Column | None = None) -> DataFrame:
    """Pairs ``(key_a, key_b)``, a < b, of rows of one group whose first variant column differs.

    Variants are paired first, each once however many rows carry it, so exact copies never meet one another;
    rows then join the pairs of their variant. ``compatible`` may relate ``x.`` and ``y.`` columns further.
    """
    tagged = rows.select(key, *group, *variant, F.xxhash64(*variant).alias("_v"))
    kinds = tagged.select(*group, *variant, "_v").distinct()
    x, y = kinds.alias("x"), kinds.alias("y")
    same = [F.col(f"x.{g}") == F.col(f"y.{g}") for g in group]
    on = same[0]
    for c in [*same[1:], F.col(f"x.{variant[0]}") < F.col(f"y.{variant[0]}")]:
        on = on & c
    if compatible is not None:
        on = on & compatible
    met = x.join(y, on).select(*[F.col(f"x.{g}").alias(g) for g in group], F.col("x._v").alias("_v"), F.col("y._v").alias("_w"))
    left = tagged.select(*group, "_v", F.col(key).alias("_l"))
    right = tagged.select(*group, F.col("_v").alias("_w"), F.col(key).alias("_r"))
    both = met.join(left, [*group, "_v"]).join(right, [*group, "_w"])
    return both.select(F.least("_l", "_r").alias(f"{key}_a"), F.greatest("_l", "_r").alias(f"{key}_b"))
