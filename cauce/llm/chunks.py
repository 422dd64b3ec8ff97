"""Oversized texts cut into overlapping pieces by recursive bisection.

A text is tokenized once. Between any two tokens lies a boundary of some strength: end of a paragraph, of a
sentence at a line's end, of a sentence, of a line, of a word, or none of these. A stretch that exceeds the
limit less the overlap is cut at the strongest boundary near its middle (the nearest of several), and so are
its halves; each piece but the first then takes the overlap from the end of the piece before it.

Cuts lie between tokens and never inside white space, where a tokenizer would read the end of a piece another
way; so a piece has as many tokens by itself as in its text.

Defined results: texts within the limit, null and empty ones give no pieces. A text without any boundary is
cut between tokens, never inside a character. Repeated documents are cut each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cauce.llm.tokens import VOCABULARY, encoder

#: Tokens of a piece at most, and tokens it shares with the piece before.
LIMIT, OVERLAP = 512, 64
#: Pieces that a task holds before it passes them on.
AT_ONCE = 4096
#: A character takes at most this many tokens more than one.
CHARACTER = 3
#: The strengths of boundaries.
PARAGRAPH, SENTENCE_LINE, SENTENCE, LINE, WORD, TOKEN, NEVER = 6, 5, 4, 3, 2, 1, 0


@lru_cache(maxsize=4)
def token_classes(path: str) -> dict[str, np.ndarray]:
    """What the bytes of every token are like."""
    enc = encoder(path)
    raw = [b""] * (enc.max_token_value + 1)
    for b in enc.token_byte_values():
        raw[enc.encode_single_token(b)] = b
    blank = b" \t\n\r\x0b\x0c"
    return {
        "length": np.array([len(b) for b in raw], dtype=np.int64),
        "blank": np.array([bool(b) and not b.strip(blank) for b in raw]),
        "lines": np.array([b.count(b"\n") if not b.strip(blank) else 0 for b in raw], dtype=np.int64),
        "starts_blank": np.array([b[:1] in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c") for b in raw]),
        "ends_blank": np.array([b[-1:] in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c") for b in raw]),
        "ends_sentence": np.array([b.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b":", b";") for b in raw]),
        "inside": np.array([0x80 <= (b[0] if b else 0) <= 0xBF for b in raw]),
    }


def strengths(ids: np.ndarray, classes: dict[str, np.ndarray]) -> np.ndarray:
    """The strength of the boundary before each token; the first has none."""
    n = len(ids)
    blank, lines = classes["blank"][ids], np.concatenate([[0], np.cumsum(classes["lines"][ids])])
    # where the white space that begins at a token ends
    stop = np.where(blank, n, np.arange(n))
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    feeds = lines[stop] - lines[:-1]
    before_sentence = np.concatenate([[False], classes["ends_sentence"][ids[:-1]]])
    before_blank = np.concatenate([[True], classes["ends_blank"][ids[:-1]]])
    starts = classes["starts_blank"][ids]
    out = np.where(feeds >= 2, PARAGRAPH, np.where(feeds == 1, np.where(before_sentence, SENTENCE_LINE, LINE), np.where(starts, np.where(before_sentence, SENTENCE, WORD), TOKEN)))
    out = np.where(before_blank | classes["inside"][ids], NEVER, out)
    return out


def bisect(strength: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Stretches of at most ``limit`` tokens, in order."""
    out, todo = [], [(0, len(strength))]
    while todo:
        a, b = todo.pop()
        if b - a <= limit:
            out.append((a, b))
            continue
        middle, reach = (a + b) // 2, max(1, (b - a) // 4)
        lo, hi = max(a + 1, middle - reach), min(b, middle + reach + 1)
        near = strength[lo:hi]
        best = near.max()
        if best == NEVER:
            # no boundary near the middle: the nearest one anywhere, else the middle itself
            anywhere = np.flatnonzero(strength[a + 1 : b]) + a + 1
            cut = int(anywhere[np.abs(anywhere - middle).argmin()]) if len(anywhere) else middle
        else:
            places = np.flatnonzero(near == best) + lo
            cut = int(places[np.abs(places - middle).argmin()])
        todo += [(cut, b), (a, cut)]
    return out


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP, path: str = VOCABULARY) -> list[tuple[int, int, int, int, int]]:
    """``(first byte, own first byte, end byte, tokens, overlapping tokens)`` of the pieces of a text; none within the limit."""
    if limit - overlap - CHARACTER < 2:
        raise ValueError("the limit leaves no room beside the overlap")
    ids = np.array(encoder(path).encode_ordinary(text), dtype=np.int64)
    if len(ids) <= limit:
        return []
    classes = token_classes(path)
    at = np.concatenate([[0], np.cumsum(classes["length"][ids])])
    out = []
    for a, b in bisect(strengths(ids, classes), limit - overlap - CHARACTER):
        start = max(0, a - overlap) if a else 0
        while start and classes["inside"][ids[start]]:
            start -= 1
        out.append((int(at[start]), int(at[a]), int(at[b]), b - start, a - start))
    return out


def split(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, pieza, n_tokens, n_solape, desde, hasta, text``: the pieces of every oversized document.

    ``desde`` and ``hasta`` are the byte range of the piece in the document, ``n_solape`` the tokens it shares
    with the piece before.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "pieza", "n_tokens", "n_solape", "desde", "hasta", "text"]
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                raw = text.encode()
                for k, (start, _, end, n, shared) in enumerate(pieces(text, limit, overlap, vocabulary)):
                    rows.append((doc, k, n, shared, start, end, raw[start:end].decode()))
                    if len(rows) == AT_ONCE:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            yield pd.DataFrame(rows, columns=columns)

    schema = "doc_id bigint, pieza int, n_tokens int, n_solape int, desde bigint, hasta bigint, text string"
    return documents.select("doc_id", "text").filter("text is not null").mapInPandas(cut, schema)
