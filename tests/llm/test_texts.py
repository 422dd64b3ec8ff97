import base64
import quopri
import random
from pathlib import Path

import numpy as np
import pytest

from cauce.llm import chunks, leaks, message_text, mixture, tokens

needs_tokenizer = pytest.mark.skipif(not Path(tokens.VOCABULARY).exists(), reason="no tokenizer files")
TEXT = "Ñandú comió ámbar, «café» y código."


@pytest.mark.parametrize(
    "raw",
    [
        f"A: b\n\n{TEXT}", f"Content-Transfer-Encoding: base64\r\n\r\n{base64.encodebytes(TEXT.encode()).decode()}", "Content-Transfer-Encoding: quoted-printable\n\n" + quopri.encodestring(TEXT.encode()).decode(), f"A: b\n\n{TEXT.encode().decode('latin-1')}",
        "A: b\n\n<p>&Ntilde;and&uacute; com<b>i&oacute;</b></p><br>&aacute;mbar &laquo;caf&eacute;&raquo; y<style>x</style> c&#243;digo", f"A: b\n\n> {TEXT[:12]}\n> > {TEXT[12:]}",
        f"Content-Type: multipart/mixed; boundary=\"q\"\n\n--q\nContent-Type: text/plain; charset=iso-8859-1\nContent-Transfer-Encoding: base64\n\n{base64.encodebytes(TEXT.encode('latin-1')).decode()}\n--q--\n",
        "Content-Transfer-Encoding: base64\r\r\n\r\r\n" + base64.encodebytes(TEXT.encode()).decode().replace("\n", "\r\r\n"),
    ],
)
def test_messages_are_read(raw):
    assert "nandu comio ambar cafe y codigo" in " ".join(message_text.words(message_text.readable(raw)))


def test_broken_messages_are_read_somehow():
    for raw in ("", "\n", "Content-Transfer-Encoding: base64\n\n%%%", "Content-Type: multipart/x; boundary=z\n\n--z", "Content-Transfer-Encoding: base64\n\n" + base64.b64encode(bytes(range(256)) * 4).decode(), "<" * 50_000, "&" * 50_000, "=" * 50_000):
        message_text.words(message_text.readable(raw))


def planted(seed=8):
    rng = random.Random(seed)
    vocabulary = ["w" + "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(4000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60, 140))).capitalize() + ". What did they do?") for i in range(40)]
    items += [(40, items[0][1]), (41, None), (42, "")]
    docs, truth = [], set()
    for d in range(260):
        body = [rng.choice(vocabulary[:300]) for _ in range(rng.randrange(0, 400))]
        i, text = items[d % 40]
        passage = leaks.passage_of(text).replace(".", "").split()
        at = rng.randrange(len(body) + 1)
        kind = d % 6
        if kind == 0:
            n = rng.choice([22, 24, 25, 26, 40])
            s = rng.randrange(len(passage) - n + 1)
            body[at:at] = ["zz1", *passage[s : s + n], "zz2"]
            hit = n >= 25
        elif kind in (1, 2, 3):
            limit = len(passage) // 10
            n = rng.choice([limit // 2, limit, limit, limit + 1 + limit // 3])
            p = passage[:]
            for k in sorted(rng.sample(range(len(p)), n), reverse=True):
                p[k : k + 1] = {1: ["zz"], 2: [], 3: ["zz", p[k]]}[kind]
            body[at:at] = ["zz1", *p, "zz2"]
            runs = max(len(r.split()) for r in " ".join("|" if kind != 2 and w == "zz" else w for w in p).split("|")) if kind != 2 else None
            hit = n <= limit or (runs is not None and runs >= 25)
            if kind == 2 and n > limit:
                hit = None  # deletions may leave runs of any length: judged by brute force only
        else:
            hit = False
        docs.append((d, " ".join(body)))
        if hit is not None and hit:
            truth.add((d, i))
            if i == 0:
                truth.add((d, 40))
    return items, docs, truth


def brute(index, docs):
    out = set()
    for d, text in docs:
        doc = np.fromiter((index.vocabulary.get(w, 0) for w in message_text.words(message_text.readable(text))), dtype=np.int64)
        for k, item in enumerate(index.items):
            grams = {item[a : a + leaks.RUN].tobytes() for a in range(len(item) - leaks.RUN + 1)}
            n = index.passages[k]
            if any(doc[a : a + leaks.RUN].tobytes() in grams for a in range(len(doc) - leaks.RUN + 1)) or (n and leaks.best_fit(item[:n], doc, int(leaks.ALTERED * n)) <= int(leaks.ALTERED * n)):
                out.add((d, index.ids[k]))
    return out


def test_leaks_against_brute_force():
    items, docs, truth = planted()
    index = leaks.ItemIndex(items)
    got = {(d, i) for (d, _), found in zip(docs, index.leaks([t for _, t in docs]), strict=True) for i in found}
    wanted = brute(index, docs)
    assert truth <= wanted and got <= wanted and len(wanted) > 60
    assert got == wanted


def test_altered_passages_of_every_length_are_found():
    """All allowed edits at one place, spread or even, in passages of 10 to 300 words: none is missed."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    lengths = [*range(1, 60), 80, 100, 150, 300] * 2
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate(lengths)]
    index = leaks.ItemIndex(items)
    docs, wanted = [], []
    for i, text in items:
        for pattern in range(leaks.PATTERNS):
            body = leaks.altered(np.array([int(w[1:]) for w in text.split()]), pattern, rng)
            noise = [f"z{k}" for k in rng.integers(0, 500, int(rng.integers(0, 40)))]
            docs.append(" ".join([*noise, *[f"w{k}" if k < 3000 else f"y{k}" for k in body], "z1 z2"]))
            wanted.append(i)
    found = index.leaks(docs)
    assert [(i, k) for k, (i, got) in enumerate(zip(wanted, found, strict=True)) if i not in got] == []


def test_long_lists_of_items_are_searched_in_several_indexes(spark, monkeypatch):
    items, docs, _ = planted()
    documents = spark.createDataFrame(docs[:60], "doc_id bigint, text string")
    listed = spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(tuple(r) for r in leaks.leaked(documents, listed).collect())
    monkeypatch.setattr(leaks, "MAX_WINDOWS", 20_000)
    monkeypatch.setattr(leaks, "AT_ONCE", 5_000)
    assert len(list(leaks._indexes(items, leaks.RECALL))) > 2
    assert sorted(tuple(r) for r in leaks.leaked(documents, listed).collect()) == whole and whole


def test_leak_rows(spark):
    items, docs, _ = planted()
    documents = spark.createDataFrame([*docs[:20], (900, None), (901, ""), (902, "x" * 200_000), (903, docs[0][1])], "doc_id bigint, text string").selectExpr("*", "1 as item_id")
    listed = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as doc_id")
    index = leaks.ItemIndex(items)
    wanted = {(d, i) for d, t in [*docs[:20], (903, docs[0][1])] for i in index.leaks([t])[0]}
    assert {(r.doc_id, r.item_id) for r in leaks.leaked(documents, listed).collect()} == wanted
    assert leaks.leaked(documents.limit(0), listed).count() == 0 and leaks.leaked(documents, listed.limit(0)).count() == 0


def test_water_filling():
    s = lambda n, w, c, z: mixture.Share(n, w, c, z)
    got = {x.source: x.target for x in mixture.water_fill([s("a", 0.5, 1, 100), s("b", 0.3, 2, 100), s("c", 0.2, 4, 10)], 240)}
    assert got["a"] == 100 and got["c"] == 40 and got["b"] == pytest.approx(100)
    got = {x.source: x.target for x in mixture.water_fill([s("a", 1, 1, 10), s("b", 1, 1, 0)], 100)}
    assert got == {"a": 10, "b": 0}
    assert mixture.water_fill([], 5) == []


@needs_tokenizer
def test_mixture(spark):
    rng = random.Random(9)
    docs = [(i, "big" if i % 3 else "small", " ".join(["word"] * rng.randrange(1, 60))) for i in range(3000)] + [(5000, None, "x"), (5001, "other", "x"), (5002, "small", None), (5003, "small", "")]
    documents = spark.createDataFrame(docs, "doc_id bigint, source string, text string").selectExpr("*", "9 as n_tokens", "1 as copias")
    targets = spark.createDataFrame([("big", 0.3, 1), ("small", 0.7, 4), ("none", 0.1, 2), ("zero", 0.0, 1), (None, 0.5, 1), ("nul", None, None)], "source string, peso_objetivo double, max_repeticiones int")
    report = {r.source: r for r in mixture.shares_reached(documents, targets).collect()}
    assert report["small"].cuota_lograda == pytest.approx(0.7, abs=0.005) and report["none"].tokens == 0 and report["big"].epocas < 1 < report["small"].epocas
    used = mixture.mixed(documents, targets).collect()
    assert len({r.doc_id for r in used}) == len(used) and max(r.copias for r in used) <= 4 and not {r.doc_id for r in used} & {5000, 5001, 5002, 5003}
    again = {(r.doc_id, r.copias) for r in mixture.mixed(documents.repartition(5), targets).collect()}
    assert again == {(r.doc_id, r.copias) for r in used}
    other = {(r.doc_id, r.copias) for r in mixture.mixed(documents, targets, seed=7).collect()}
    assert other != again
    capped = {r.source: r for r in mixture.shares_reached(documents, targets, total=1e9).collect()}
    assert capped["big"].epocas == 1 and capped["small"].epocas == 4
    assert mixture.mixed(documents.limit(0), targets).count() == 0 and mixture.mixed(documents, targets.limit(0)).count() == 0


def test_the_stop_of_a_source_is_found_digit_by_digit(spark, monkeypatch):
    """With few rows put in order at a time the same documents are drawn; against a plain sort."""
    rng = random.Random(2)
    sizes = spark.createDataFrame([(i, rng.choice("aab"), rng.randrange(1, 50)) for i in range(6000)], "doc_id bigint, source string, n_tokens bigint")
    total = {r.source: r.n for r in sizes.groupBy("source").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    shares = [mixture.Share("a", 1.0, 3, total["a"], 1.37 * total["a"]), mixture.Share("b", 1.0, 1, total["b"], 0.61 * total["b"])]
    whole = {(r.doc_id, r.copias) for r in mixture.drawn(sizes, shares).collect()}
    monkeypatch.setattr(mixture, "SORTED", 2)
    monkeypatch.setattr(mixture, "DIGIT", 3)
    assert {(r.doc_id, r.copias) for r in mixture.drawn(sizes, shares).collect()} == whole
    rows = sizes.withColumn("h", mixture.order_hash(mixture.SEED)).collect()
    for share, copies in ((shares[0], 1), (shares[1], 0)):
        rest, used = share.target - copies * share.size, 0
        for r in sorted((r for r in rows if r.source == share.source), key=lambda r: (r.h, r.doc_id)):
            more = used + r.n_tokens / 2 <= rest
            used += r.n_tokens
            assert ((r.doc_id, copies + more) in whole) == (copies + more > 0)


SAMPLES = ["a" * 5000, "ñ" * 4000, "日本語" * 1500, " " * 3000, "\n" * 3000 + "x", "🙂" * 2000, "x y" * 2000, "'s" * 3000, "ab\r\n" * 2000, "One. Two! " * 800, "para one.\n\npara two, longer.\n" * 300]


@needs_tokenizer
@pytest.mark.parametrize("limit,overlap", [(512, 64), (128, 0), (100, 50)])
def test_pieces(limit, overlap):
    """Exact round trip, limits by counting each piece again, overlaps by position."""
    encode = tokens.encoder().encode_ordinary
    for text in SAMPLES:
        raw, found = text.encode(), chunks.pieces(text, limit, overlap)
        assert bool(found) == (len(encode(text)) > limit)
        if not found:
            continue
        assert b"".join(raw[own:end] for _, own, end, _, _ in found).decode() == text
        for k, (start, own, end, n, shared) in enumerate(found):
            assert len(encode(raw[start:end].decode())) <= limit and n <= limit
            assert shared == 0 if k == 0 else overlap <= shared <= overlap + chunks.CHARACTER or start == 0
            assert own >= start


@needs_tokenizer
def test_cuts_are_natural():
    text = ("Word word word word. " * 12 + "\n\n") * 30
    for _, own, _, _, _ in chunks.pieces(text, 512, 64)[1:]:
        assert text.encode()[own:].startswith(b"\n\n") or text.encode()[own - 2 : own] == b"\n\n" or text.encode()[own:].startswith(b" \n\n")
    assert chunks.pieces("", 512, 64) == []
    with pytest.raises(ValueError):
        chunks.pieces("x", 10, 9)


@needs_tokenizer
def test_piece_rows(spark):
    documents = spark.createDataFrame([(1, "short"), (2, SAMPLES[9]), (3, None), (4, ""), (5, SAMPLES[9])], "doc_id bigint, text string").selectExpr("*", "0 as pieza")
    rows = chunks.split(documents).collect()
    assert {r.doc_id for r in rows} == {2, 5} and [r.text for r in rows if r.doc_id == 2] == [r.text for r in rows if r.doc_id == 5]
    assert chunks.split(documents.limit(0)).count() == 0
