"""Mixing sources to target weights by capped water-filling.

Sizes are tokens of a public tokenizer, counted once and written. The sizes of the sources (one row each, a
bounded table) go to the driver, which clamps sources at their allowed repetitions and shares what they leave
among the others in proportion, until nothing changes. A source then gives every document its whole
repetitions and, by a seeded hash order, one more to the documents that fill the fractional rest. The place
where that order stops is found digit by digit of the hash: a histogram tells the bin where it lies, the rows of
that bin get another, until so few are left that they can be put in order, however large the source is.

Defined results: documents of sources without a target, null sources and empty texts (no tokens) are not used.
A target without documents, or with weight or repetitions null or not positive, takes no part and its weight
goes to the others. Where all sources together fall short of the wanted total, every one is used to its cap
and the shares reached are reported as they are. Repeated documents count each by itself; ties in the hash
order go by doc_id. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm.tokens import VOCABULARY, encoder
from cauce.session import cut

#: Bits of the hash that a histogram parts at a time, and the rows of a source that may be put in order in one task.
DIGIT, HASH_BITS, SORTED = 10, 63, 10_000
SEED = 42
#: The targets are read by the driver; a longer list is refused.
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Share:
    source: str
    weight: float
    cap: int
    size: int
    target: float = 0.0

    @property
    def epochs(self) -> float:
        return self.target / self.size if self.size else 0.0


def water_fill(shares: list[Share], total: float) -> list[Share]:
    """Targets that add up to ``total``, in proportion to the weights but for sources at their cap."""
    room = {s.source: float(s.cap * s.size) for s in shares}
    target = dict.fromkeys(room, 0.0)
    free = [s for s in shares if s.weight > 0 and room[s.source] > 0]
    left = total
    while free and left > 0:
        weight = sum(s.weight for s in free)
        full = [s for s in free if left * s.weight / weight >= room[s.source]]
        if not full:
            for s in free:
                target[s.source] = left * s.weight / weight
            break
        for s in full:
            target[s.source] = room[s.source]
            left -= room[s.source]
        done = {s.source for s in full}
        free = [s for s in free if s.source not in done]
    return [Share(s.source, s.weight, s.cap, s.size, target[s.source]) for s in shares]


def sized(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, n_tokens`` of the documents with a source and a text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode_ordinary
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": [len(encode(t)) for t in b["text"]]})

    rows = documents.select("doc_id", "source", "text").filter("source is not null and text is not null")
    return rows.mapInPandas(count, "doc_id bigint, source string, n_tokens bigint").filter("n_tokens > 0")


def order_hash(seed: int) -> Column:
    """A number of ``HASH_BITS`` bits."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 1)


def planned(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> list[Share]:
    """The share of every usable target; ``total`` tokens in all, by default as many as the usable sources have."""
    wanted = targets.select("source", "peso_objetivo", "max_repeticiones").limit(MAX_SOURCES + 1).collect()
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    listed = targets.select("source").distinct()
    have = {r.source: r.size for r in sizes.join(F.broadcast(listed), "source", "left_semi").groupBy("source").agg(F.sum("n_tokens").alias("size")).collect()}
    shares = [
        Share(r.source, float(r.peso_objetivo), int(r.max_repeticiones), int(have.get(r.source, 0)))
        for r in wanted
        if r.source is not None and (r.peso_objetivo or 0) > 0 and (r.max_repeticiones or 0) > 0
    ]
    return water_fill(shares, sum(s.size for s in shares) if total is None else total)


def _stops(hashed: DataFrame, rest: dict[str, float]) -> dict[str, tuple[int, int, float]]:
    """``source -> (low, high, rest)``: the fractional rest of a source ends in hashes from low, below high.

    All rows below come in, and of the rows inside as many as fill what is left of the rest. One row for each source
    and round reaches the driver.
    """
    spark = hashed.sparkSession
    low = dict.fromkeys(rest, 0)
    left = dict(rest)
    done: dict[str, tuple[int, int, float]] = {}
    shift = HASH_BITS
    while left and shift > 0:
        shift = max(0, shift - DIGIT)
        table = F.broadcast(spark.createDataFrame([(s, low[s], float(left[s])) for s in left], "source string, low bigint, queda double"))
        above = min(HASH_BITS, shift + DIGIT)
        inside = hashed.join(table, "source").filter(F.shiftright("h", above) == F.shiftright("low", above) if above < HASH_BITS else F.lit(True))
        bins = inside.groupBy("source", "queda", F.shiftright("h", shift).alias("bin")).agg(F.sum("n_tokens").alias("t"), F.count("*").alias("c"))
        upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = bins.withColumn("hasta", F.sum("t").over(upto)).filter(F.col("hasta") > F.col("queda"))
        found = {r.source: r.m for r in ends.groupBy("source").agg(F.min(F.struct("bin", "hasta", "t", "c")).alias("m")).collect()}
        for s in list(left):
            if s not in found:  # the rest takes every row
                done[s] = (1 << HASH_BITS) - 1, (1 << HASH_BITS) - 1, 0.0
                del left[s]
                continue
            m = found[s]
            low[s], left[s] = m.bin << shift, left[s] - (m.hasta - m.t)
            if m.c <= SORTED or shift == 0:
                done[s] = low[s], min(low[s] + (1 << shift), (1 << HASH_BITS) - 1), left[s]
                del left[s]
    return done


def drawn(sizes: DataFrame, shares: list[Share], seed: int = SEED) -> DataFrame:
    """``doc_id, source, n_tokens, copias`` of every document used."""
    whole = {s.source: min(int(s.epochs + 1e-12), s.cap) for s in shares if s.target > 0}
    rest = {s.source: max(0.0, s.target - whole[s.source] * s.size) for s in shares if s.target > 0}
    hashed = sizes.withColumn("h", order_hash(seed))
    stops = _stops(hashed, {s: r for s, r in rest.items() if r > 0})
    plan = [(s, n, *stops.get(s, (0, 0, 0.0))) for s, n in whole.items()]
    # one row for each target, at most ``MAX_SOURCES``
    table = sizes.sparkSession.createDataFrame(plan, "source string, enteras int, low bigint, high bigint, queda double")
    placed = hashed.join(F.broadcast(table), "source")
    within = (F.col("h") >= F.col("low")) & (F.col("h") < F.col("high"))
    upto = Window.partitionBy("source").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a document comes in if more than half of it fits, which leaves the smallest difference
    edge = placed.filter(within).withColumn("_sum", F.sum("n_tokens").over(upto)).withColumn("_one", (F.col("_sum") - F.col("n_tokens") / 2.0 <= F.col("queda")).cast("int"))
    others = placed.filter(~within).withColumn("_one", (F.col("h") < F.col("low")).cast("int"))
    used = [df.select("doc_id", "source", "n_tokens", (F.col("enteras") + F.col("_one")).alias("copias")) for df in (others, edge)]
    return used[0].unionByName(used[1]).filter("copias > 0")


def mixed(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, n_tokens, copias``: the mixture."""
    sizes = cut(sized(documents, vocabulary))
    return drawn(sizes, planned(sizes, targets, total), seed)


def shares_reached(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per target: its share wanted, planned and reached, with documents, copies and tokens used."""
    sizes = cut(sized(documents, vocabulary))
    shares = planned(sizes, targets, total)
    used = drawn(sizes, shares, seed).groupBy("source").agg(F.count("*").alias("documentos"), F.sum("copias").alias("copias"), F.sum(F.col("copias") * F.col("n_tokens")).alias("tokens"))
    whole = sum(s.target for s in shares) or 1.0
    rows = [(s.source, s.weight, s.cap, s.size, s.target / whole, s.epochs) for s in shares]
    plan = documents.sparkSession.createDataFrame(rows, "source string, peso_objetivo double, max_repeticiones int, tokens_disponibles bigint, cuota_prevista double, epocas double")
    out = F.broadcast(plan).join(used, "source", "left").na.fill(0, ["documentos", "copias", "tokens"])
    return out.withColumn("cuota_lograda", F.col("tokens") / F.greatest(F.sum("tokens").over(Window.partitionBy()), F.lit(1)))
