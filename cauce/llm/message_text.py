"""The readable words of a raw e-mail: transfer encodings, markup and wrong decoding undone."""

from __future__ import annotations

import base64
import binascii
import html
import quopri
import re
import unicodedata

_BREAK = re.compile(r"\r*\n|\r")
_CTE = re.compile(r"^content-transfer-encoding:\s*([\w-]+)", re.I | re.M)
_CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)
_BOUNDARY = re.compile(r"boundary\s*=\s*(?:\"([^\"\n]+)\"|([^\s;]+))", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b[^<>]{0,2000}>|<!--.*?-->|<!DOCTYPE[^>]*>", re.S)
_DROP = re.compile(r"<(script|style)\b.*?</\1\s*>", re.S | re.I)
# Tags that do not part words.
INLINE = {"b", "i", "em", "strong", "u", "span", "font", "a", "small", "big", "sub", "sup", "tt", "code", "mark", "wbr", "s", "o"}
_MISREAD = re.compile("(?:[Â-ß][\u0080-¿ŒœŠšŸŽžƒˆ˜–-›€™]|[à-ï][\u0080-¿ŒœŠšŸŽžƒˆ˜–-›€™]{2})+")
_UNDECLARED = re.compile(r"=C[23]=[89AB][0-9A-F]")
_QUOTE = re.compile(r"^[ \t]*(?:>[ \t]?)+", re.M)
_HYPHEN = re.compile(r"(?<=[^\W\d_])-\n[> \t]*(?=[^\W\d_])")
WORD = re.compile(r"[^\W_]+")


def _text(raw: bytes, charset: str | None) -> str:
    for name in (charset, "utf-8", "cp1252", "latin-1"):
        try:
            if name:
                return raw.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return raw.decode("latin-1")


def _body(head: str, body: str) -> str:
    """A part's text with its transfer encoding undone; bytes that are no text give nothing."""
    cte = _CTE.search(head)
    how = cte[1].lower() if cte else ""
    charset = _CHARSET.search(head)
    if how == "base64":
        packed = "".join(body.split())
        packed = re.sub(r"[^A-Za-z0-9+/]", "", packed)
        try:
            raw = base64.b64decode(packed + "=" * (-len(packed) % 4))
        except (binascii.Error, ValueError):
            raw = base64.b64decode(packed[: len(packed) // 4 * 4])
        sample = raw[:2000]
        if sample and sum(b < 9 or 13 < b < 32 for b in sample) > 0.02 * len(sample):
            return ""
        return _text(raw, charset[1] if charset else None)
    if how == "quoted-printable" or not how and len(_UNDECLARED.findall(body)) >= 3:
        return _text(quopri.decodestring(body.encode("utf-8", "surrogatepass")), charset[1] if charset else None)
    return body


def parts(text: str, depth: int = 0) -> list[tuple[str, str]]:
    """``(head, body)`` of the leaves of a message's MIME tree; the outer head comes with its first leaf."""
    head, _, body = text.partition("\n\n")
    found = _BOUNDARY.search(head)
    if not found or depth > 5:
        return [(head, body)]
    mark = "--" + (found[1] or found[2])
    out = [(re.sub(r"(?im)^content-(?:transfer-encoding|type):.*(?:\n[ \t].*)*", "", head), "")]
    pieces = body.split("\n" + mark) if not body.startswith(mark) else ("\n" + body).split("\n" + mark)
    out.append(("", pieces[0]))
    closed = False
    for piece in pieces[1:]:
        if closed or piece.startswith("--"):
            out.append(("", piece[2:] if not closed else piece))
            closed = True
            continue
        piece = piece.partition("\n")[2]
        out += parts(piece, depth + 1) if piece[:1] != "\n" else [("", piece)]
    return out


def _mend(m: re.Match) -> str:
    try:
        return m[0].encode("cp1252").decode("utf-8")
    except UnicodeError:
        try:
            return m[0].encode("latin-1").decode("utf-8")
        except UnicodeError:
            return m[0]


def readable(text: str) -> str:
    """The whole message as text: every part decoded, tags taken out, entities and misread letters restored."""
    t = _BREAK.sub("\n", text)
    out = []
    for head, body in parts(t):
        if head:
            out.append(head)
        out.append(_body(head, body))
    t = "\n\n".join(out)
    if "<" in t:
        t = _DROP.sub(" ", t)
        t = _TAG.sub(lambda m: "" if m[2] and m[2].lower() in INLINE else " ", t)
    if "&" in t:
        t = html.unescape(t)
    for _ in range(2):
        if not _MISREAD.search(t):
            break
        t = _MISREAD.sub(_mend, t)
    t = _QUOTE.sub("", t)
    return _HYPHEN.sub("", t)


_BEYOND = re.compile("[^\x00-\x7f]+")
_folded: dict[str, str] = {}


def _fold(m: re.Match) -> str:
    run = m[0]
    if run not in _folded:
        if len(_folded) > 100_000:
            _folded.clear()
        _folded[run] = "".join(c for c in unicodedata.normalize("NFKD", run) if not unicodedata.combining(c))
    return _folded[run]


def words(text: str) -> list[str]:
    """Lower-case words without accents; punctuation, line breaks and quote marks part them."""
    return WORD.findall(_BEYOND.sub(_fold, text).lower())
