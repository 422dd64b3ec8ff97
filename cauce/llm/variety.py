"""A varied subset: mini-batch k-means, square-root quotas, sampling within the clusters.

Near-copies of one company (same telling parts of the name, else the same identifier) count once, by their
best score. Rows become vectors of what they have in common: sector, department, place and size as coordinates of
their own (the frequent values; all rarer ones share one), employees, year of renewal, channels and score as
numbers. So a distance counts the attributes that differ. k-means runs over the distinct profiles, in hash batches
which are written apart, so each is read once; every row then belongs to its nearest centre. Quotas follow the square root of the cluster sizes (or are
equal); what a small cluster cannot fill goes to the others. Within a cluster sectors and places take turns, and
each gives its rows in the order of a seeded draw weighted by score.

Only the centres, a bounded sample that seeds them, the frequent values and one row per cluster reach the driver.

Defined results: rows without score are not chosen, a missing or unknown sector or place is a value of its own,
missing numbers stand in the middle. Fewer rows than wanted are all chosen. Ties go by the hash of the id; repeated
rows are copies of one company. An empty table gives an empty subset.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.functions.registry import contact_channels, renewal_year, size_class
from cauce.functions.text import comparison_text
from cauce.llm import places
from cauce.llm.name_text import parse
from cauce.session import cut

#: Rows chosen, clusters, hash batches that k-means runs through.
SIZE, CLUSTERS, BATCHES = 500, 48, 8
#: Rows of the sample that seeds the centres, for each cluster.
SEED_ROWS = 40
SEED = 42
#: Attributes of a vector with the weight of a difference, and how many values of each have a coordinate.
WEIGHTS = {"sector": 1.0, "departamento": 0.7, "lugar": 0.4, "tamano": 0.5}
MOST_VALUES = {"sector": 64, "departamento": 64, "lugar": 256, "tamano": 8}
#: Numbers of a vector with their weight, and the least and greatest value they are scaled by.
NUMBERS = {"empleados": (0.4, 0.0, 4.0), "anio": (0.4, 2010.0, 2026.0), "canales": (0.3, 0.0, 2.0), "score": (0.5, 0.0, 100.0)}
#: A row with so many points more is e times as likely to be drawn before another.
POINTS = 10.0


VECTOR = "departamento string, tamano string, empleados double, anio double, canales double"
ROW = f"id string, sector string, lugar string, score double, {VECTOR}"


def prepared(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """``id, sector, lugar, score`` and the other attributes: one row for each company that can be chosen."""
    listed = places.reference_rows(reference)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = places.PlaceIndex(listed)
        home = {code: dept for code, _, dept in listed}
        for b in batches:
            b["lugar"] = [index.resolve(t) for t in b["lugar"]]
            b["departamento"] = [home.get(c) for c in b["lugar"]]
            b["empresa"] = ["N " + " ".join(sorted(p)) if len(p := parse(t).core) > 1 else None for t in b["empresa"]]
            yield b

    nit = F.regexp_replace("nit", r"\D", "")
    usable = (F.length(nit) >= 6) & ~nit.rlike(r"^(\d)\1*$")
    staff = F.regexp_replace(F.regexp_extract("num_empleados", r"^\s*(\d{1,3}(?:[.,]\d{3})+|\d{1,9})\s*$", 1), "[.,]", "").try_cast("double")
    chosen = rows.filter("estado_exclusion = 'SIN_COINCIDENCIA' AND score_prioridad_comercial IS NOT NULL").select(
        F.col("entidad_dedup_id").alias("id"), F.coalesce(comparison_text(F.col("sector_vertical")), F.lit("SIN SECTOR")).alias("sector"),
        F.col("municipio_nombre_normalizado").alias("lugar"), F.col("score_prioridad_comercial").alias("score"), F.col("razon_social").alias("empresa"), F.when(usable, F.substring(nit, 1, 9)).alias("nit"),
        F.lit(None).cast("string").alias("departamento"), size_class(F.col("tamano_empresa")).alias("tamano"), F.log10(staff + 1).alias("empleados"), renewal_year(F.col("ultimo_ano_renovado")).cast("double").alias("anio"),
        contact_channels([F.col(f"telefono_comercial_{i}") for i in (1, 2, 3)], F.col("email_comercial")).cast("double").alias("canales"),
    )
    read_rows = chosen.mapInPandas(read, chosen.schema)
    company = F.coalesce("empresa", F.concat(F.lit("I "), "nit"), F.concat(F.lit("E "), "id"))
    attributes = ["id", "sector", "lugar", "score", "departamento", "tamano", "empleados", "anio", "canales"]
    best = F.max(F.struct("score", F.xxhash64("id").alias("h"), *[c for c in attributes if c != "score"])).alias("b")
    return read_rows.groupBy(company.alias("empresa")).agg(best).select(*[F.col(f"b.{c}") for c in attributes])


class Vectors:
    """Rows as sparse vectors: one coordinate for each attribute's value, and the numbers."""

    def __init__(self, values: dict[str, list[str]]) -> None:
        self.values = values
        self.at: dict[str, dict[str, int]] = {}
        self.width = 0
        for name in WEIGHTS:
            self.at[name] = {v: self.width + i for i, v in enumerate(values.get(name, []))}
            self.width += len(self.at[name]) + 1  # the last is for all other values
        self.first_number = self.width
        self.width += len(NUMBERS)

    def of(self, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """``(coordinate of each attribute, numbers)``."""
        codes = np.empty((len(b), len(WEIGHTS)), dtype=np.int64)
        start = 0
        for k, name in enumerate(WEIGHTS):
            other = start + len(self.at[name])
            codes[:, k] = b[name].map(self.at[name]).fillna(other).to_numpy(dtype=np.int64)
            start = other + 1
        numbers = np.empty((len(b), len(NUMBERS)))
        for k, (name, (weight, low, high)) in enumerate(NUMBERS.items()):
            share = (b[name].to_numpy(dtype=float) - low) / (high - low)
            numbers[:, k] = weight * np.clip(np.where(np.isnan(share), 0.5, share), 0.0, 1.0)
        return codes, numbers

    def dense(self, codes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), self.width))
        for k, weight in enumerate(WEIGHTS.values()):
            out[np.arange(len(codes)), codes[:, k]] = weight
        out[:, self.first_number :] = numbers
        return out

    def add(self, total: np.ndarray, cluster: np.ndarray, codes: np.ndarray, numbers: np.ndarray) -> None:
        for k, weight in enumerate(WEIGHTS.values()):
            np.add.at(total, (cluster, codes[:, k]), weight)
        for k in range(len(NUMBERS)):
            np.add.at(total[:, self.first_number + k], cluster, numbers[:, k])

    def nearest(self, codes: np.ndarray, numbers: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """The closest centre of each row; only the coordinates a row has are touched."""
        along = numbers @ centres[:, self.first_number :].T
        for k, weight in enumerate(WEIGHTS.values()):
            along += weight * centres.T[codes[:, k]]
        return ((centres**2).sum(1)[None, :] - 2 * along).argmin(1)


def vectors_of(rows: DataFrame) -> Vectors:
    """The vectors of a table: the frequent values of each attribute, bounded by ``MOST_VALUES``."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in WEIGHTS])).alias("p")
    counts = rows.select(each).select("p.*").filter("v is not null").groupBy("c", "v").agg(F.count("*").alias("n"))
    most = Window.partitionBy("c").orderBy(F.desc("n"), "v")
    limit = F.get(F.array(*[F.lit(n) for n in MOST_VALUES.values()]), F.array_position(F.array(*[F.lit(c) for c in MOST_VALUES]), F.col("c")).cast("int") - 1)
    kept = counts.withColumn("r", F.row_number().over(most)).filter(F.col("r") <= limit).collect()
    return Vectors({c: sorted(r.v for r in kept if r.c == c) for c in WEIGHTS})


def profiles(rows: DataFrame) -> DataFrame:
    """The distinct combinations of attributes with their mean numbers, in ``BATCHES`` parts by ``lote``.

    Each counts once, so the clusters follow the variety of the rows and not their mass.
    """
    each = rows.groupBy(*WEIGHTS).agg(*[F.avg(n).alias(n) for n in NUMBERS]).withColumn("id", F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in WEIGHTS]))
    return cut(each.withColumn("lote", F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(BATCHES)).cast("int")), "lote")


def seeded(sample: np.ndarray, k: int) -> np.ndarray:
    """Centres spread over a sample (k-means++)."""
    rng = np.random.default_rng(SEED)
    centres = [sample[rng.integers(len(sample))]]
    gap = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < k and gap.max() > 1e-12:
        centres.append(sample[rng.choice(len(sample), p=gap / gap.sum())])
        gap = np.minimum(gap, ((sample - centres[-1]) ** 2).sum(1))
    return np.array(centres)


def centres_of(rows: DataFrame, vectors: Vectors, k: int = CLUSTERS, batches: int = BATCHES) -> np.ndarray:
    """Mini-batch k-means over all profiles, a batch (``lote``) at a time; each is read once."""
    sample = rows.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SEED_ROWS * k).toPandas()
    if sample.empty:
        return np.zeros((0, vectors.width))
    centres = seeded(vectors.dense(*vectors.of(sample)), k)
    seen = np.zeros(len(centres))

    def summed(now: np.ndarray):
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, count = np.zeros_like(now), np.zeros(len(now))
            for b in parts:
                codes, numbers = vectors.of(b)
                at = vectors.nearest(codes, numbers, now)
                vectors.add(total, at, codes, numbers)
                count += np.bincount(at, minlength=len(now))
            yield pd.DataFrame({"c": np.arange(len(now)), "n": count, "s": list(total)})

        return run

    for batch in range(batches):
        sums = rows.filter(F.col("lote") == batch).mapInPandas(summed(centres), "c int, n double, s array<double>")
        long = sums.select("c", "n", F.posexplode("s").alias("i", "x"))
        got = long.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).filter("n > 0").toPandas()
        for c, part in got.groupby("c"):
            mean = np.zeros(vectors.width)
            mean[part["i"].to_numpy(dtype=int)] = part["x"].to_numpy() / part["n"].iloc[0]
            seen[c] += part["n"].iloc[0]
            centres[c] += (mean - centres[c]) * (part["n"].iloc[0] / seen[c])
    return centres


def quotas(sizes: dict[int, int], size: int, equal: bool = False) -> dict[int, int]:
    """Whole quotas that add up to ``size`` or to all rows: by square roots or equal, unfilled places passed on."""
    size = min(size, sum(sizes.values()))
    share = dict.fromkeys(sizes, 0.0)
    free, left = set(sizes), float(size)
    while free and left > 1e-9:
        weight = {c: 1.0 if equal else sizes[c] ** 0.5 for c in free}
        total = sum(weight.values())
        full = {c for c in free if left * weight[c] / total >= sizes[c]}
        if not full:
            for c in free:
                share[c] = left * weight[c] / total
            break
        for c in full:
            share[c] = float(sizes[c])
            left -= sizes[c]
        free -= full
    out = {c: int(s) for c, s in share.items()}
    for c in sorted(share, key=lambda c: (out[c] - share[c], c)):
        if sum(out.values()) < size and out[c] < sizes[c]:
            out[c] += 1
    return out


def subset(rows: DataFrame, reference: DataFrame, size: int = SIZE, clusters: int = CLUSTERS, equal: bool = False) -> DataFrame:
    """``entidad_dedup_id, grupo, sector, codigo_dane, score_prioridad_comercial`` of the rows chosen."""
    ready = cut(prepared(rows, reference))
    vectors = vectors_of(ready)
    centres = centres_of(profiles(ready), vectors, clusters)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            grupo = vectors.nearest(*vectors.of(b), centres).astype("int32") if len(b) and len(centres) else np.zeros(len(b), dtype="int32")
            yield b[["id", "sector", "lugar", "score"]].assign(grupo=grupo)

    placed = cut(ready.mapInPandas(place, "id string, sector string, lugar string, score double, grupo int"))
    sizes = {r.grupo: r.n for r in placed.groupBy("grupo").agg(F.count("*").alias("n")).collect()}
    wanted = quotas(sizes, size, equal)
    most = max(wanted.values(), default=0)
    plan = rows.sparkSession.createDataFrame(sorted(wanted.items()), "grupo int, cupo int")
    # an exponential draw whose rate grows with the score: smaller comes first
    even = (F.pmod(F.xxhash64("id", F.lit(SEED + 2)), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))
    drawn = placed.withColumn("sorteo", -F.log(even) * F.exp(-F.col("score") / POINTS))
    # the bounds on the ranks let each task keep only its first rows before anything is shuffled
    turn = Window.partitionBy("grupo", "sector", "lugar").orderBy("sorteo", "id")
    turns = drawn.withColumn("turno", F.row_number().over(turn)).filter(F.col("turno") <= most)
    order = Window.partitionBy("grupo").orderBy("turno", "sorteo", "id")
    first = turns.withColumn("puesto", F.row_number().over(order)).filter(F.col("puesto") <= most)
    chosen = first.join(F.broadcast(plan), "grupo").filter("puesto <= cupo")
    return chosen.select(F.col("id").alias("entidad_dedup_id"), "grupo", "sector", F.col("lugar").alias("codigo_dane"), F.col("score").alias("score_prioridad_comercial"))


def coverage(chosen: DataFrame, rows: DataFrame, reference: DataFrame) -> DataFrame:
    """By sector: rows and mean score in the universe and in the subset."""
    universe = prepared(rows, reference).groupBy("sector").agg(F.count("*").alias("universo"), F.avg("score").alias("score_universo"))
    taken = chosen.groupBy("sector").agg(F.count("*").alias("elegidas"), F.avg("score_prioridad_comercial").alias("score_elegidas"), F.count_distinct("codigo_dane").alias("lugares"))
    return universe.join(taken, "sector", "left").na.fill(0, ["elegidas", "lugares"])


def contrast(rows: DataFrame, reference: DataFrame, size: int = SIZE) -> DataFrame:
    """``metodo, elegidas, celdas, sectores, lugares, mayor_sector, score``: the subset, a seeded random one, and one cluster.

    ``celdas`` are the pairs of sector and place covered, ``mayor_sector`` the share of the largest sector.
    """
    ready = prepared(rows, reference)
    chance = ready.orderBy(F.xxhash64("id", F.lit(SEED + 3)), "id").limit(size)
    lists = {"grupos": subset(rows, reference, size), "un_grupo": subset(rows, reference, size, clusters=1), "azar": chance.select(F.col("id").alias("entidad_dedup_id"), F.lit(0).alias("grupo"), "sector", F.col("lugar").alias("codigo_dane"), F.col("score").alias("score_prioridad_comercial"))}
    out = None
    for name, chosen in lists.items():
        cells = chosen.groupBy("sector", "codigo_dane").agg(F.count("*").alias("n"), F.sum("score_prioridad_comercial").alias("s"))
        sectors = cells.groupBy("sector").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("celdas"), F.collect_set("codigo_dane").alias("lugares"))
        row = sectors.agg(
            F.lit(name).alias("metodo"), F.sum("n").alias("elegidas"), F.sum("celdas").alias("celdas"), F.count("*").alias("sectores"), F.size(F.array_distinct(F.flatten(F.collect_list("lugares")))).alias("lugares"),
            (F.max("n") / F.sum("n")).alias("mayor_sector"), (F.sum("s") / F.sum("n")).alias("score"),
        )
        out = row if out is None else out.unionByName(row)
    return out
