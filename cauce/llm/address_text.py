"""Reading one Colombian-style postal address into comparable parts."""

from __future__ import annotations

import re

from cauce.llm.edits import osa
from cauce.llm.places import plain

# Short forms of street kinds, and the full words that typed ones are compared with.
KINDS = {
    "CL": ["CL", "CLL", "CLE", "CALLE", "CALE", "CLLE", "C", "CAL", "AC"],
    "KR": ["KR", "CR", "CRA", "KRA", "CARRERA", "CARERA", "CARR", "KARRERA", "K", "AK", "CRR"],
    "DG": ["DG", "DIAG", "DIAGONAL", "DIAGNAL", "D"],
    "TV": ["TV", "TRV", "TR", "TRANSV", "TRANSVERSAL", "TRASVERSAL", "TRANS", "TRASV", "T"],
    "AV": ["AV", "AVENIDA", "AVDA", "AVD"],
}
_KIND = {w: k for k, words in KINDS.items() for w in words}
_FULL = [("CALLE", "CL"), ("CARRERA", "KR"), ("DIAGONAL", "DG"), ("TRANSVERSAL", "TV"), ("AVENIDA", "AV")]
# Words before the name of a rural property, of its district, and words that say nothing.
PROPERTY = r"(?:FINCA|FCA|FNCA|FIN|PREDIO|HACIENDA|HDA|LOTE|PARCELA|GRANJA)"
DISTRICT = r"(?:VEREDA|VDA|VRDA|VER|CORREGIMIENTO|CGTO)"
_EMPTY = {"ZONA", "SECTOR", "RURAL", "AREA", "KM", "VIA", "LA", "EL"}

_DASH = re.compile("[‐-―−–—_]")
_N = r"(\d{1,3})(?!\d)"
_END = r"(?=BIS|SUR|ESTE|NORTE|OESTE|[^A-Z]|$)"
_TAIL = rf"\s*(?:([A-H]){_END})?\s*(BIS)?\s*(?:([A-C]){_END})?"
_WAY = r"\s*(SUR|ESTE|NORTE|OESTE|OCCIDENTE|ORIENTE|S(?=[^A-Z]))?"
_NUMBER_SIGN = r"\s*(?:NUMERO|NRO|NUM|NO|NR|N)?[.\s]*#?\s*"
STREET = re.compile(rf"(?<![A-Z])([A-Z]{{1,12}})[./]?\s*{_N}{_TAIL}{_WAY}{_NUMBER_SIGN}{_N}{_TAIL}{_WAY}\s*[- ]\s*-?\s*{_N}")
RURAL = re.compile(rf"\b({PROPERTY}|{DISTRICT})\b[.:\s]*([A-Z][A-Z ]*?)(?=[,;.\-]|\b(?:{PROPERTY}|{DISTRICT}|ZONA|SECTOR|AREA|KM|BARRIO|BRR)\b|$)")
_READ = str.maketrans("OIL", "011")
_LETTERS_FOR_DIGITS = [
    re.compile(r"(?<![A-Z0-9])[OIL]+(?=\d)"),
    re.compile(r"(?<=\d)[OIL]+(?=\d|[A-H]?(?![A-Z])|[A-H]?BIS|SUR|ESTE)"),
    re.compile(r"(?<![A-Z0-9])[IL](?=[A-H]?(?:\s?BIS)?\s*-?\s*\d)"),
    re.compile(r"(?<=[A-Z]\s)(?<!BARRIO\s)[IL](?=\s(?:SUR|ESTE|#|N|NO|NRO|NUM)\b|\s[A-H]\s)"),
]
# Street numbers written out.
ORDINALS = ["PRIMERA", "SEGUNDA", "TERCERA", "CUARTA", "QUINTA", "SEXTA", "SEPTIMA", "OCTAVA", "NOVENA", "DECIMA"]
_ORDINAL = re.compile(r"\b(" + "|".join(ORDINALS) + r")\b")

Parts = tuple[str, str, str, str]


def street_kind(word: str) -> str | None:
    """The street kind a word stands for, at most two edits (one for short words) from a full one."""
    if word in _KIND:
        return _KIND[word]
    best = min(((osa(word, full, 2), k) for full, k in _FULL), default=(9, ""))
    return best[1] if len(word) >= 5 and best[0] <= 2 or len(word) == 4 and best[0] <= 1 else None


def parse(text: str | None) -> Parts | None:
    """``(kind, first, second, word)``, or None where the text denotes no place.

    A street door gives ``("u", street number, plate, street kind)``, with letter, BIS and direction inside the
    numbers; a rural property ``("r", district, property, "")``. Unit, neighbourhood and town are left out.
    """
    if not text:
        return None
    t = _DASH.sub("-", plain(text.replace("º", "o ").replace("°", " ")))
    t = re.sub(r"\s+", " ", t).strip()
    t = _ORDINAL.sub(lambda m: str(ORDINALS.index(m[1]) + 1), t)
    for p in _LETTERS_FOR_DIGITS:
        t = p.sub(lambda m: m[0].translate(_READ), t)
    best: Parts | None = None
    for m in STREET.finditer(t):
        word, n1, l1, b1, c1, w1, n2, l2, b2, c2, w2, n3 = m.groups()
        kind = street_kind(word)
        if kind is None and word in {"LOCAL", "LC", "LOC", "APTO", "AP", "APARTAMENTO", "OF", "OFC", "OFICINA", "BG", "BOD", "BODEGA", "PISO", "P", "PS", "INT", "CASA"}:
            continue
        way = (w1 or w2 or "")[:1]
        first = f"{int(n1)}|{l1 or ''}|{'B' if b1 else ''}{c1 or ''}|{way}"
        second = f"{int(n2)}|{l2 or ''}|{'B' if b2 else ''}{c2 or ''}|{int(n3)}"
        if kind:
            return ("u", first, second, kind)
        best = best or ("u", first, second, "?" + word)
    if best:
        return best
    t = re.sub(r"\bA \d+ M(?:TS|ETROS)?\b.*$", "", t)
    found: dict[str, str] = {}
    for key, name in RURAL.findall(t):
        name = re.sub(r"[^A-Z]", "", " ".join(w for w in name.split() if w not in _EMPTY))
        if name:
            found.setdefault("d" if re.fullmatch(DISTRICT, key) else "p", name)
    if "p" in found:
        return ("r", found.get("d", ""), found["p"], "")
    return None
