"""Evaluation items that occur, wholly or partly, in a corpus of messages.

Windows of items and of documents are embedded by CGK random walks: a pointer runs over the words, each step
emits the word under it and moves on or stays by a random bit of step and word, so that windows at a small edit
distance give strings at a small Hamming distance. Hashes of sampled positions (bit sampling, repeated) find
candidate windows; each candidate is verified exactly: a run of equal words, or the whole passage within the
allowed edits.

A walk from one place embeds the windows of every length that begin there, because it only looks ahead; so items
have windows of all sizes up to their own, from each of their words, and a document is walked once from every
``STRIDE``-th word. The number of walks follows from the recall asked for: before the search, passages of the
items' lengths are altered as much as is allowed, in several patterns, and walks are added until the share found
reaches it.

Only words near a short run that an item also has are walked. Every passage within its edits leaves such a run
somewhere (the edits cannot part it into shorter ones), so nothing is lost by it.

The index is bounded (the items are a fixed list whose size is checked, and a long list is searched in several
indexes of a bounded size); it is built once and broadcast. Documents never leave their partition.

Defined results: null and empty texts contain nothing; an item without ``RUN`` words is found only by its whole
passage; repeated documents and items count each by itself; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.message_text import readable, words

#: Consecutive words of an item that count as a leak, and the share of a passage's words that may be altered.
RUN, ALTERED = 25, 0.1
#: The share of altered passages that the search is to find, and the most walks it may take.
RECALL, MOST_WALKS = 0.999, 48
#: Every so many words a document is walked from.
STRIDE = 4
#: Words of the windows (those that a passage has room for), sampled steps of a window, steps to a word.
SIZES, SAMPLED, PACE = [3, 6, 9, 12, 18, 27, 40, 60, 90, 135, 200, 300, 450, 675, 1000], 5, 1.4
#: Windows shorter than this are made for short items only.
LEAST_WINDOW = 12
#: Words of a run that leads the search to a place, where a passage is sure to leave one so long.
SEED_RUN = 6
SEED = 20_250_601
#: The item list is read by the driver; a longer one is refused. Windows in one index; places walked at a time.
MAX_ITEMS, MAX_WINDOWS, SLICE = 20_000, 2_000_000, 16_384

_QUESTION = re.compile(r"[^.!?¿¡]*[^.!]\?\s*$")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 1 << 22
_SHIFT, _TOP = np.uint64(29), np.uint64(63)


def passage_of(text: str | None) -> str:
    """An item's text without the question at its end; the whole text if nothing precedes it."""
    text = text or ""
    head = text[: text.rfind("¿")] if text.rstrip().endswith("?") and "¿" in text else _QUESTION.sub("", text)
    return head if head.strip() else text


def edits_allowed(length: int) -> int:
    return int(ALTERED * length)


def sure_run(length: int) -> int:
    """Words of a passage that stay together whatever the allowed edits, up to ``SEED_RUN``."""
    k = edits_allowed(length)
    return max(1, min(SEED_RUN, (length - k) // (k + 1)))


def _grams(text: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    count = max(0, len(text) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for j in range(n):
        out = (out ^ text[j : j + count].astype(np.uint64)) * _MIX
        out ^= out >> _SHIFT
    return out


class Walks:
    """The random choices of the walks: which way a word sends the pointer, and which steps are sampled."""

    def __init__(self, count: int, sizes: list[int]) -> None:
        rng = np.random.default_rng(SEED)
        self.count, self.sizes = count, sizes
        self.steps = [max(SAMPLED, int(PACE * s)) if s > 3 else s for s in sizes]
        last = max(self.steps, default=0)
        self.turn = rng.integers(1, 2**63, (MOST_WALKS, 2048), dtype=np.uint64)[:count, :last] | np.uint64(1)
        # the steps of a size in one walk, each with its place in the hash
        self.picks: list[list[dict[int, int]]] = []
        for walk in range(count):
            own = np.random.default_rng((SEED, walk))
            self.picks.append([{int(p): j for j, p in enumerate(np.sort(own.choice(n, min(SAMPLED, n), replace=False)))} for n in self.steps])
        self.mult = rng.integers(1, 2**63, SAMPLED, dtype=np.uint64) | np.uint64(1)

    def hashes(self, text: np.ndarray, starts: np.ndarray, walk: int, only: int | None = None) -> np.ndarray:
        """A row of hashes for each size (or one of them), of the windows of ``text`` at ``starts``. Beyond the end stands 0."""
        out = np.zeros((len(self.sizes), len(starts)), dtype=np.uint64)
        for k in range(len(self.sizes)):
            out[k] += np.uint64((walk * len(self.sizes) + k + 1) * 0x51ED270B)
        at, last = starts.astype(np.int64), len(text)
        padded = np.concatenate([text, [0]]).astype(np.uint64)
        for step in range(max(self.steps, default=0) if only is None else self.steps[only]):
            word = padded[np.minimum(at, last)]
            for k, picks in enumerate(self.picks[walk]):
                if (j := picks.get(step)) is not None:
                    mixed = (out[k] ^ word) * self.mult[j]
                    out[k] = mixed ^ (mixed >> _SHIFT)
            at += (((word + np.uint64(1)) * self.turn[walk, step]) >> _TOP).astype(np.int64)
        return out


def sizes_for(length: int) -> list[int]:
    """The window sizes of a passage: those it has room for wherever a document is walked from, and not needlessly short."""
    room = length - STRIDE + 1
    return [s for s in SIZES if min(LEAST_WINDOW, room // 4) <= s <= room] or [1]


class WindowIndex:
    """All windows of some word sequences under their hashes, in the walks given."""

    def __init__(self, texts: list[np.ndarray], walks: Walks, held: range) -> None:
        self.walks, self.held = walks, held
        hashes, owners, offsets = [], [], []
        flat = np.concatenate([np.zeros(0, dtype=np.int64), *[np.concatenate([t, [0]]) for t in texts]])
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
        for k, size in enumerate(walks.sizes):
            rows = [(i, np.arange(0, len(t) - size + 1)) for i, t in enumerate(texts) if size in sizes_for(len(t))]
            if not rows:
                continue
            owner = np.concatenate([np.full(len(o), i) for i, o in rows]).astype(np.int32)
            offset = np.concatenate([o for _, o in rows]).astype(np.int32)
            for walk in held:
                hashes.append(walks.hashes(flat, begin[owner] + offset, walk, only=k)[k])
                owners.append(owner)
                offsets.append(offset)
        every = np.concatenate([np.zeros(0, dtype=np.uint64), *hashes])
        order = np.argsort(every, kind="stable")
        self.sorted = every[order]
        self.owner = np.concatenate([np.zeros(0, dtype=np.int32), *owners])[order]
        self.offset = np.concatenate([np.zeros(0, dtype=np.int32), *offsets])[order]
        # bits that tell most hashes without a window apart before they are looked up
        self.bits = np.zeros(_BITS, dtype=bool)
        self.bits[(every % np.uint64(_BITS)).astype(np.int64)] = True

    def met(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``start, owner, offset`` of windows with equal hashes; the same three may come more than once."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for s in range(0, len(starts), SLICE):
            some = starts[s : s + SLICE]
            for walk in self.held:
                found = self.walks.hashes(text, some, walk)
                rows, cols = np.nonzero(self.bits[(found % np.uint64(_BITS)).astype(np.int64)])
                value = found[rows, cols]
                lo, hi = np.searchsorted(self.sorted, value, "left"), np.searchsorted(self.sorted, value, "right")
                n = hi - lo
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                out.append((np.repeat(some[cols], n), self.owner[at], self.offset[at]))
        empty = np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate([empty, *parts]).astype(np.int64) for parts in zip(*out, strict=True)) if out else (empty, empty, empty)


def altered(passage: np.ndarray, pattern: int, rng: np.random.Generator) -> np.ndarray:
    """A passage with all the edits it may have: spread, evenly, or together at the start, in the middle or at the end."""
    k, n = edits_allowed(len(passage)), len(passage)
    kind, how = pattern % 3, pattern // 3
    if how == 0:
        places = rng.choice(n, k, replace=False)
    elif how == 1:
        places = (np.arange(k) * n + n // 2) // max(k, 1)
    else:
        first = {2: 0, 3: (n - k) // 2, 4: n - k}[how]
        places = np.arange(first, first + k)
    out = passage.tolist()
    for p in sorted((int(p) for p in places), reverse=True):
        new = int(rng.integers(1 << 24, 1 << 25))
        out[p : p + 1] = [new] if kind == 0 else [] if kind == 1 else [new, out[p]]
    return np.array(out, dtype=np.int64)


PATTERNS, CASES = 15, 12


def walks_needed(lengths: list[int], recall: float) -> int:
    """Walks that find the share ``recall`` of planted passages of these lengths, each pattern of edits as often."""
    usable = sorted({n for n in lengths if n})
    if not usable:
        return 1
    chosen = sorted({usable[i * (len(usable) - 1) // 3] for i in range(4)})
    rng = np.random.default_rng(SEED)
    planted, pieces, where, at = [], [], [], 0
    for n in chosen:
        for case in range(PATTERNS * CASES):
            passage = rng.integers(1, 1 << 24, n)
            body = altered(passage, case % PATTERNS, rng)
            filler = rng.integers(1 << 26, 1 << 27, n + int(rng.integers(STRIDE)))
            pieces += [filler, body]
            where.append((at + len(filler), at + len(filler) + len(body)))
            planted.append(passage)
            at += len(filler) + len(body)
    text, spans = np.concatenate(pieces), np.array(where)
    walks = Walks(MOST_WALKS, sorted({s for n in chosen for s in sizes_for(n)}))
    starts = np.arange(0, len(text), STRIDE)
    found = np.zeros(len(planted), dtype=bool)
    for walk in range(MOST_WALKS):
        start, owner, _ = WindowIndex(planted, walks, range(walk, walk + 1)).met(text, starts)
        inside = (spans[owner, 0] <= start) & (start < spans[owner, 1])
        found[owner[inside]] = True
        if found.mean() >= recall:
            break
    return walk + 1


class ItemIndex:
    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL) -> None:
        self.ids = [i for i, _ in items]
        texts = [words(t or "") for _, t in items]
        self.vocabulary: dict[str, int] = {}
        for t in texts:
            for w in t:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.items = [np.array([self.vocabulary[w] for w in t], dtype=np.int64) for t in texts]
        self.passages = [len(words(passage_of(t))) for _, t in items]
        # a text and its passage have windows of their own, as they may have room for other sizes
        held = [(k, t) for k, text in enumerate(self.items) for t in {len(text): text, self.passages[k]: text[: self.passages[k]]}.values() if len(t)]
        self.item_of = np.array([k for k, _ in held], dtype=np.int64)
        count = walks_needed(self.passages, recall)
        walks = Walks(count, sorted({s for _, t in held for s in sizes_for(len(t))}))
        self.windows = WindowIndex([t for _, t in held], walks, range(count))
        self.seeds = []
        for n in sorted({sure_run(p) for p in self.passages if p} | {SEED_RUN}):
            mine = [k for k, p in enumerate(self.passages) if p and sure_run(p) == n or n == SEED_RUN and len(self.items[k]) >= RUN]
            grams = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *[_grams(self.items[k], n) for k in mine]]))
            reach = max((len(self.items[k]) + edits_allowed(self.passages[k]) for k in mine), default=0)
            bits = np.zeros(_BITS, dtype=bool)
            bits[(grams % np.uint64(_BITS)).astype(np.int64)] = True
            self.seeds.append((n, grams, bits, reach))

    def _places(self, text: np.ndarray) -> np.ndarray:
        """Every ``STRIDE``-th word (every word for the shortest runs) from which a window may reach a run that an item also has."""
        change = {short: np.zeros(len(text) + 1, dtype=np.int64) for short in (False, True)}
        for n, grams, bits, reach in self.seeds:
            if not len(grams):
                continue
            own = _grams(text, n)
            maybe = np.flatnonzero(bits[(own % np.uint64(_BITS)).astype(np.int64)])
            at = np.searchsorted(grams, own[maybe])
            hits = maybe[grams[np.minimum(at, len(grams) - 1)] == own[maybe]]
            np.add.at(change[n < SEED_RUN], np.maximum(hits - reach, 0), 1)
            np.add.at(change[n < SEED_RUN], hits + n, -1)
        near, closer = (np.cumsum(change[short][:-1]) > 0 for short in (False, True))
        near[np.arange(len(near)) % STRIDE != 0] = False
        return np.flatnonzero(near | closer)

    def candidates(self, documents: list[np.ndarray]) -> list[tuple[int, int, int]]:
        """``(document, item, diagonal)``: the item may lie in the document with its first word at the diagonal."""
        if not documents or not len(self.item_of):
            return []
        begin = np.cumsum([0, *[len(d) + 1 for d in documents]])
        text = np.concatenate([np.concatenate([d, [0]]) for d in documents])
        start, owner, offset = self.windows.met(text, self._places(text))
        which = np.searchsorted(begin, start, "right") - 1
        rows = np.stack([which, self.item_of[owner], start - begin[which] - offset], axis=1) if len(start) else np.zeros((0, 3), dtype=np.int64)
        return [tuple(r) for r in np.unique(rows, axis=0).tolist()]

    def run(self, document: np.ndarray, item: int, diagonal: int) -> int:
        """The longest run of equal words on the diagonal."""
        text = self.items[item]
        lo, hi = max(0, -diagonal), min(len(text), len(document) - diagonal)
        equal = document[diagonal + lo : diagonal + hi] == text[lo:hi] if hi > lo else np.zeros(0, dtype=bool)
        breaks = np.flatnonzero(~np.concatenate([[False], equal, [False]]))
        return int(np.diff(breaks).max() - 1) if len(breaks) > 1 else 0

    def edits(self, document: np.ndarray, item: int, diagonals: list[int]) -> int | None:
        """The least edits that the whole passage has near the diagonals, if within the limit."""
        length = self.passages[item]
        limit = edits_allowed(length)
        passage = self.items[item][:length]
        best = limit + 1
        for d in diagonals:
            if d >= 0 and d + length <= len(document):
                best = min(best, int((document[d : d + length] != passage).sum()))
        if best <= limit or not length:
            return best if length else None
        start = 0
        for k, d in enumerate(diagonals):
            if k + 1 < len(diagonals) and diagonals[k + 1] - d <= 2 * limit:
                continue
            near = document[max(0, diagonals[start] - limit) : d + length + limit]
            start = k + 1
            # fewer common words than the limit allows: no alignment can do better
            if np.isin(passage, near).sum() >= length - limit:
                best = min(best, best_fit(passage, near, limit))
        return best if best <= limit else None

    def leaks(self, texts: list[str]) -> list[dict[int, tuple[int, int | None]]]:
        """For each text ``item id -> (longest run, passage edits)`` of the items that it contains."""
        known = self.vocabulary.get
        documents = [np.fromiter((known(w, 0) for w in words(readable(t))), dtype=np.int64) for t in texts]
        out: list[dict[int, tuple[int, int | None]]] = [{} for _ in texts]
        where: dict[tuple[int, int], list[int]] = {}
        for d, item, diagonal in self.candidates(documents):
            where.setdefault((d, item), []).append(diagonal)
        for (d, item), diagonals in where.items():
            run = max(self.run(documents[d], item, x) for x in diagonals)
            edits = self.edits(documents[d], item, diagonals)
            if run >= RUN or edits is not None:
                out[d][self.ids[item]] = (run, edits)
        return out


def best_fit(pattern: np.ndarray, text: np.ndarray, limit: int) -> int:
    """Least edits that turn ``pattern`` into some stretch of ``text``, by words; ``limit + 1`` beyond the limit."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    steps = np.arange(len(text) + 1)
    for i, w in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        # insertions run along the row: a running minimum of value less position
        new = np.minimum.accumulate(new - steps) + steps
        if new.min() > limit:
            return limit + 1
        row = new
    return int(row.min())


def _indexes(items: list[tuple[int, str]], recall: float) -> Iterator[ItemIndex]:
    """Indexes of bounded size that hold all items between them."""
    some: list[tuple[int, str]] = []
    room = MAX_WINDOWS
    for item in items:
        need = len(words(item[1] or "")) * len(SIZES)
        if some and need > room:
            yield ItemIndex(some, recall)
            some, room = [], MAX_WINDOWS
        some.append(item)
        room -= need
    if some:
        yield ItemIndex(some, recall)


#: Characters of the documents that are searched at a time.
AT_ONCE = 2_000_000


def _in_lots(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The documents of a batch in lots of bounded length; one longer than that is a lot by itself."""
    lot = (batch["text"].str.len().cumsum() // AT_ONCE).to_numpy()
    for _, part in batch.groupby(lot):
        yield part


def leaked(documents: DataFrame, items: DataFrame, recall: float = RECALL) -> DataFrame:
    """``doc_id, item_id, racha, cambios``: every document with every item it contains.

    ``racha`` is the longest run of the item's words, ``cambios`` the altered words of the whole passage, null
    where it isn't there within the limit. ``recall`` is the share of passages altered to the limit that the
    search is to find; runs of ``RUN`` words are always found.
    """
    listed = [(r.item_id, r.text) for r in items.select("item_id", "text").limit(MAX_ITEMS + 1).collect()]
    if len(listed) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} items")
    listed.sort()
    chosen = documents.select("doc_id", "text").filter(F.col("text").isNotNull())
    schema = "doc_id bigint, item_id bigint, racha bigint, cambios bigint"
    context = documents.sparkSession.sparkContext

    def searched(index: ItemIndex) -> DataFrame:
        shared = context.broadcast(index)

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for lot in _in_lots(b):
                    found = shared.value.leaks(lot["text"].tolist())
                    rows = [(d, i, run, edits) for d, one in zip(lot["doc_id"], found, strict=True) for i, (run, edits) in one.items()]
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "racha", "cambios"]).astype({"cambios": "Int64"})

        return chosen.mapInPandas(search, schema)

    out = None
    for index in _indexes(listed, recall):
        out = searched(index) if out is None else out.unionByName(searched(index))
    return documents.sparkSession.createDataFrame([], schema) if out is None else out
