"""Matching companies of two tables without a common key, by a label model over many small votes.

Candidates share at least one key: two intact segments of the name, one intact part, the ends of a joined
name, the base of an identifier, a telephone, or the word an e-mail address is named after. Each candidate gets
votes (+1 same, -1 different, 0 no opinion) by heuristics on single attributes. The counts of vote patterns,
whose number is bounded by the number of heuristics, go to the driver, where EM fits a class prior and, for
each class, the votes' distributions with their strongest pairwise dependences (a maximum spanning tree of
mutual information). The posterior of its pattern is a candidate's confidence.

Defined results: entities without a normalised name are left out; nulls, stand-ins and unusable values make a
heuristic abstain; without candidates the result is empty. A company with several entities or several internal
rows gives all combinations. Repeated rows count each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm import names, places
from cauce.llm.address_text import parse as parse_address
from cauce.llm.name_text import parse as parse_name
from cauce.session import cut

VOTES = ["v_name", "v_part", "v_nit", "v_tail", "v_phone", "v_stub", "v_email", "v_place", "v_address", "v_kind", "v_vouch"]
#: What is believed before any data: ``(class, vote, its value, other vote, its value)`` as often as this share of all
#: candidates. Names that don't agree are one company if an identifier, a number or the door vouches for a part they
#: share, else they are not.
BELIEFS = [(1, "v_name", -1, "v_vouch", 1), (0, "v_name", -1, "v_vouch", -1), (1, "v_name", 0, "v_vouch", 1), (0, "v_name", 0, "v_vouch", -1)]
BELIEF = 0.02
#: Extra weight of the first votes (name, part, identifier) where EM starts.
START = np.array([2.0, 1.0, 2.0])
#: Letters of a joined name that are two parts for sure, and the edits between a joined name and two parts.
JOINED_NAME, JOINED_EDITS = 14, 4
#: Confidence from which a candidate counts as a match.
ACCEPT = 0.5

# Mailbox names and hosts that do not point to a company.
MAILBOXES = ["info", "ventas", "contacto", "admin", "gerencia", "facturas", "pagos", "contabilidad", "correo"]

SIDE = "parts array<string>, trade string, given array<string>, initials string, address string, town string"


def read_side(rows: DataFrame, key: str, name: str, address: str, town: str, department: str | None, reference: DataFrame, *keep: str) -> DataFrame:
    """Names, addresses and towns of one table, read in one pass; ``keep`` columns are carried along."""
    listed = places.reference_rows(reference)
    wanted = list(dict.fromkeys([key, name, address, town, *([department] if department else []), *keep]))
    source = rows.select(*wanted)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema) + ", " + SIDE

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = places.PlaceIndex(listed)
        for b in batches:
            found = [parse_name(t) for t in b[name]]
            doors = [parse_address(t) for t in b[address]]
            depts = b[department] if department else [None] * len(b)
            towns = [index.resolve(t, d) for t, d in zip(b[town], depts, strict=True)]
            yield b.assign(
                parts=[n.core for n in found], trade=[n.trade for n in found], given=[n.given for n in found], initials=[n.initials for n in found],
                address=["/".join(p) if p else None for p in doors], town=[None if t == places.NONE else t for t in towns],
            )

    return source.mapInPandas(read, schema)


def _digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")


def id_base(c: Column) -> Column:
    """The identifier without its check digit: nine digits for companies, ten for persons; null if unusable."""
    d = _digits(c)
    usable = ~d.rlike(r"^(\d)\1*$") & ~F.coalesce(c, F.lit("")).contains("*")
    return (
        F.when(usable & d.rlike(r"^[89]\d{8,9}$"), F.substring(d, 1, 9))
        .when(usable & d.rlike(r"^1\d{9,10}$"), F.substring(d, 1, 10))
        .when(usable & d.rlike(r"^\d{6,8}$"), d)
    )


def phone_number(c: Column) -> Column:
    """The last ten digits; null for stand-ins and shorter numbers."""
    d = _digits(c)
    return F.when((F.length(d) >= 10) & ~d.rlike(r"^(\d)\1*$"), F.substring(d, -10, 10))


def phone_stub(c: Column) -> Column:
    """The four to nine digits of a number without its prefix or cut short; null for stand-ins."""
    d = _digits(c)
    return F.when(F.length(d).between(4, 9) & ~d.rlike(r"^(\d)\1*$"), d)


def mail_word(c: Column) -> Column:
    """The word a mail address is named after: its host's first label, or its mailbox where the host is shared."""
    mail = F.lower(F.trim(c))
    box = F.regexp_replace(F.regexp_extract(mail, r"^([^@]+)@", 1), r"[^a-z]", "")
    host = F.regexp_replace(F.regexp_extract(mail, r"@([^.@]+)\.", 1), r"[^a-z]", "")
    word = F.when(host.isin(*MAILBOXES) | (host == ""), box).otherwise(host)
    return F.when((F.length(word) >= 5) & ~word.isin(*MAILBOXES), F.upper(word))


def _side(read: DataFrame, key: str, nit: str, phones: list[str], mail: str) -> DataFrame:
    two = F.size("parts") == 2
    ordered = F.array_sort("parts")
    phone = F.array_distinct(F.array_compact(F.array(*[phone_number(F.col(p)) for p in phones])))
    stub = F.array_distinct(F.array_compact(F.array(*[phone_stub(F.col(p)) for p in phones])))
    tail = F.when(F.col(nit).contains("*"), F.nullif(_digits(F.col(nit)), F.lit("")))
    return read.select(
        F.col(key).alias("key"),
        F.when(two, ordered[0]).when(F.size("parts") == 1, F.col("parts")[0]).alias("a"),
        F.when(two, ordered[1]).alias("b"),
        F.when(F.size("parts") > 0, F.array_join(F.when(two, ordered).otherwise(F.col("parts")), "")).alias("joined"),
        "trade", "given", "initials", "address", "town",
        id_base(F.col(nit)).alias("base"), F.when(F.length(tail) >= 4, tail).alias("tail"), _digits(F.col(nit)).alias("raw"),
        phone.alias("phones"), stub.alias("stubs"), mail_word(F.col(mail)).alias("mail"),
    )


def _keys(side: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    named = F.array_compact(F.array(
        *[F.when(b.isNotNull(), k) for k in names.pair_keys(a, b)],
        *[F.when(F.length(x) >= names.SEGMENT, names.part_keys(x)) for x in (a, b, F.col("mail"))],
        *names.end_keys(F.col("joined")), *names.end_keys(F.concat(b, a)),
        F.concat(F.lit("N"), F.col("base")), F.concat(F.lit("N"), F.substring("base", 1, 9)), F.when(F.col("address").isNotNull() & F.col("town").isNotNull(), F.concat_ws("@", "address", "town")),
    ))
    dialled = F.transform("phones", lambda p: F.concat(F.lit("T"), p))
    # hashes of keys: two keys with one hash only propose a candidate more
    return side.select("key", F.explode(F.array_distinct(F.transform(F.concat(named, dialled), lambda x: F.xxhash64(x)))).alias("k"))


def _candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct ``(key_l, key_r)`` that share a key, however many rows hold it."""
    kl, kr = _keys(left), _keys(right)
    return kl.select(F.col("key").alias("key_l"), "k").join(kr.select(F.col("key").alias("key_r"), "k"), "k").select("key_l", "key_r").distinct()


def _variants(side: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are equal but for their key as one, with ``key`` of its own and ``n``; and ``variant, key`` of all rows."""
    own = [c for c in side.columns if c != "key"]
    tagged = side.withColumn("variant", F.unhex(F.md5(F.to_json(F.struct(*own)))))
    return tagged.groupBy(F.col("variant").alias("key")).agg(*[F.first(c).alias(c) for c in own], F.count("*").alias("n")), tagged.select("variant", "key")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), 1).when(F.coalesce(no, F.lit(False)), -1).otherwise(0).cast("tinyint")


def voted(pairs: DataFrame) -> DataFrame:
    """``key_l, key_r``, the number ``n`` of row pairs and the votes of candidates with structs ``x`` and ``y``."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    d = names.distance("x", "y")
    # two parts, or one text long enough to be two parts written together
    whole_name = lambda s: F.col(f"{s}.b").isNotNull() | (F.length(F.col(f"{s}.joined")) >= JOINED_NAME)
    full = whole_name("x") & whole_name("y")
    sure = lambda c: F.coalesce(c, F.lit(False))
    near = lambda p, q: sure(F.levenshtein(p, q) <= F.when(F.least(F.length(p), F.length(q)) >= 8, 2).otherwise(1))
    one = near(x("a"), y("a")) | near(x("a"), y("b")) | near(x("b"), y("a")) | near(x("b"), y("b"))
    both_id = x("base").isNotNull() & y("base").isNotNull()
    id_edits = F.levenshtein(x("base"), y("base"))
    tails = F.coalesce(x("tail"), y("tail"))
    whole = F.when(x("tail").isNull(), x("raw")).otherwise(y("raw"))
    tail_hit = whole.endswith(tails) | F.substring(whole, F.lit(1), F.length(whole) - 1).endswith(tails)
    shared_phone = F.arrays_overlap(x("phones"), y("phones"))
    both_phones = (F.size(x("phones")) > 0) & (F.size(y("phones")) > 0)
    cut_short = lambda s, p: F.exists(s, lambda q: F.exists(p, lambda w: w.endswith(q)))
    stub_hit = cut_short(x("stubs"), F.concat(y("phones"), y("stubs"))) | cut_short(y("stubs"), F.concat(x("phones"), x("stubs")))
    stubs = (F.size(x("stubs")) > 0) & (F.size(F.concat(y("phones"), y("stubs"))) > 0) | (F.size(y("stubs")) > 0) & (F.size(F.concat(x("phones"), x("stubs"))) > 0)
    mails = near(x("mail"), y("mail")) | near(y("mail"), x("a")) | near(y("mail"), x("b")) | near(x("mail"), y("a")) | near(x("mail"), y("b"))
    person = (F.size(x("given")) > 0) & (F.size(y("given")) > 0)
    given = F.arrays_overlap(x("given"), y("given"))
    same_kind = F.when(person, given).otherwise(x("trade") == y("trade"))
    kind_no = F.when(person, ~given).otherwise((x("trade") != y("trade")) | (x("trade").isNotNull() & (F.size(y("given")) > 0)) | (y("trade").isNotNull() & (F.size(x("given")) > 0)))
    numbers = sure(id_edits <= 2) & both_id | sure(tails.isNotNull() & (F.length(whole) >= 8) & tail_hit) | sure(shared_phone) | sure(x("address") == y("address"))
    named = F.when(full, d <= F.when(x("b").isNull() | y("b").isNull(), JOINED_EDITS).otherwise(names.NAME_EDITS)).otherwise(one & sure(same_kind))
    vouched = one & numbers
    parts_differ, kinds_differ = x("a").isNotNull() & y("a").isNotNull() & ~one, kind_no
    apart = (full & ~sure(named)) | (~full & ~sure(named) & (sure(parts_differ) | sure(kinds_differ) & ~sure(same_kind)))
    return pairs.select(
        "key_l", "key_r", (x("n") * y("n")).alias("n"),
        _vote(named, full & ~sure(named)).alias("v_name"),
        _vote(one, x("a").isNotNull() & y("a").isNotNull()).alias("v_part"),
        _vote(both_id & (id_edits <= 2), both_id & (id_edits > 3)).alias("v_nit"),
        _vote(tails.isNotNull() & (F.length(whole) >= 8) & tail_hit, tails.isNotNull() & (F.length(whole) >= 8)).alias("v_tail"),
        _vote(shared_phone, both_phones).alias("v_phone"),
        _vote(stub_hit, stubs).alias("v_stub"),
        _vote(mails, x("mail").isNotNull() & y("mail").isNotNull()).alias("v_email"),
        _vote(x("town") == y("town"), x("town") != y("town")).alias("v_place"),
        _vote(x("address") == y("address"), x("address") != y("address")).alias("v_address"),
        _vote(same_kind, kind_no).alias("v_kind"),
        _vote(apart & sure(vouched), apart).alias("v_vouch"),
    )


class LabelModel:
    """Two latent classes; in each, the votes form a tree of dependences. Fitted by EM on pattern counts."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60, beliefs: list[tuple[int, int, int, int, int, float]] | None = None) -> None:
        self.patterns, self.counts = patterns + 1, counts.astype(float)  # votes become 0, 1, 2
        self.beliefs = beliefs or []
        raw = patterns.astype(float)
        post = 1 / (1 + np.exp(-(raw @ np.ones(raw.shape[1]) + START @ raw.T[: len(START)] - 1.0)))
        for _ in range(rounds):
            self._fit(post)
            new = self.posterior()
            if np.abs(new - post).max(initial=0.0) < 1e-6:
                break
            post = new

    def _fit(self, post: np.ndarray) -> None:
        self.prior = float(np.clip((self.counts * post).sum() / max(self.counts.sum(), 1e-9), 1e-4, 1 - 1e-4))
        self.trees = [self._tree(self.counts * w, [b[1:] for b in self.beliefs if b[0] == c]) for c, w in enumerate((1 - post, post))]

    def _tree(self, w: np.ndarray, beliefs: list[tuple[int, int, int, int, float]]) -> list[tuple[int, int, np.ndarray]]:
        """``(vote, parent or -1, table)``: the maximum spanning tree of mutual information, from vote 0."""
        k = self.patterns.shape[1]
        one = np.full((k, 3), 0.5)
        two = np.full((k, k, 3, 3), 0.1)
        for i in range(k):
            np.add.at(one[i], self.patterns[:, i], w)
            for j in range(k):
                np.add.at(two[i, j], (self.patterns[:, i], self.patterns[:, j]), w)
        for i, x, j, y, n in beliefs:
            two[i, j, x, y] += n
            two[j, i, y, x] += n
        p1 = one / one.sum(1, keepdims=True)
        p2 = two / two.sum((2, 3), keepdims=True)
        mi = (p2 * np.log(p2 / (p2.sum(3, keepdims=True) * p2.sum(2, keepdims=True)))).sum((2, 3))
        done, out = {0}, [(0, -1, np.log(p1[0]))]
        while len(done) < k:
            _, parent, i = max((mi[p, i], -p, i) for p in done for i in range(k) if i not in done)
            parent = -parent
            joint = p2[parent, i]
            out.append((i, parent, np.log(joint / joint.sum(1, keepdims=True))))
            done.add(i)
        return out

    def posterior(self) -> np.ndarray:
        like = []
        for tree, prior in zip(self.trees, (1 - self.prior, self.prior), strict=True):
            total = np.full(len(self.patterns), np.log(prior))
            for i, parent, table in tree:
                total += table[self.patterns[:, i]] if parent < 0 else table[self.patterns[:, parent], self.patterns[:, i]]
            like.append(total)
        return 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))


def believed(votes: list[str], total: float) -> list[tuple[int, int, int, int, int, float]]:
    """``BELIEFS`` as counts in the tables of the model."""
    return [(c, votes.index(i), x + 1, votes.index(j), y + 1, BELIEF * total) for c, i, x, j, y in BELIEFS]


def _judged(entities: DataFrame, internal: DataFrame, reference: DataFrame) -> tuple[DataFrame, pd.DataFrame, DataFrame, DataFrame]:
    """The votes of pairs of variants (written), how often each pattern of votes occurs, and the rows of the variants."""
    named = entities.filter("razon_social_normalizada is not null")
    phones_l, phones_r = ["telefono_comercial_1", "telefono_comercial_2"], ["telefono"]
    left = read_side(named, "entidad_dedup_id", "razon_social_normalizada", "direccion_comercial", "municipio_comercial", "departamento", reference, "nit", "email_comercial", *phones_l)
    right = read_side(internal, "internal_order", "razon_social", "direccion", "municipio", None, reference, "nit", "correo", *phones_r)
    left = cut(_side(left, "entidad_dedup_id", "nit", phones_l, "email_comercial"))
    right = cut(_side(right, "internal_order", "nit", phones_r, "correo"))
    (once_l, rows_l), (once_r, rows_r) = _variants(left), _variants(right)
    once_l, once_r = cut(once_l), cut(once_r)
    pairs = _candidates(once_l, once_r)
    x = once_l.select(F.col("key").alias("key_l"), F.struct(*once_l.columns).alias("x"))
    y = once_r.select(F.col("key").alias("key_r"), F.struct(*once_r.columns).alias("y"))
    votes = cut(voted(pairs.join(x, "key_l").join(y, "key_r")))
    # at most 3 ** len(VOTES) patterns, whatever the data
    return votes, votes.groupBy(*VOTES).agg(F.sum("n").alias("n")).toPandas(), rows_l, rows_r


def matched(entities: DataFrame, internal: DataFrame, reference: DataFrame) -> DataFrame:
    """``entidad_dedup_id, internal_order, confianza`` and the votes of every candidate pair."""
    votes, seen, rows_l, rows_r = _judged(entities, internal, reference)
    every = lambda df: df.join(rows_l.select(F.col("variant").alias("key_l"), F.col("key").alias("entidad_dedup_id")), "key_l").join(rows_r.select(F.col("variant").alias("key_r"), F.col("key").alias("internal_order")), "key_r")
    if seen.empty:
        return every(votes).select("entidad_dedup_id", "internal_order", F.lit(0.0).alias("confianza"), *VOTES)
    model = LabelModel(seen[VOTES].to_numpy(dtype=int), seen["n"].to_numpy(), beliefs=believed(VOTES, float(seen["n"].sum())))
    seen["confianza"] = model.posterior()
    scores = votes.sparkSession.createDataFrame(seen[[*VOTES, "confianza"]].astype({v: "int8" for v in VOTES}), ", ".join(f"{v} tinyint" for v in VOTES) + ", confianza double")
    return every(votes.join(F.broadcast(scores), VOTES)).select("entidad_dedup_id", "internal_order", "confianza", *VOTES)


def calibration(entities: DataFrame, internal: DataFrame, reference: DataFrame) -> DataFrame:
    """``decil, pares, confianza, con_nit, acuerdo``: confidences against identifiers that the model hasn't seen.

    The model is fitted without the votes on identifiers. In each tenth of confidence ``con_nit`` pairs have a usable
    identifier on both sides, and ``acuerdo`` is the share of them that agree; null where there are none.
    """
    votes, seen, _, _ = _judged(entities, internal, reference)
    held = [v for v in VOTES if v not in ("v_nit", "v_tail")]
    schema = "decil int, pares bigint, confianza double, con_nit bigint, acuerdo double"
    if seen.empty:
        return votes.sparkSession.createDataFrame([], schema)
    model = LabelModel(seen[held].to_numpy(dtype=int), seen["n"].to_numpy(), beliefs=believed(held, float(seen["n"].sum())))
    seen["c"] = model.posterior()
    seen["decil"] = np.minimum((seen["c"] * 10).astype(int), 9)
    rows = []
    for decile, part in seen.groupby("decil"):
        both = int(part.loc[part["v_nit"] != 0, "n"].sum())
        rows.append((int(decile), int(part["n"].sum()), float((part["c"] * part["n"]).sum() / part["n"].sum()), both, float(part.loc[part["v_nit"] == 1, "n"].sum() / both) if both else None))
    return votes.sparkSession.createDataFrame(rows, schema)
