"""Free-typed places mapped to a reference list by a symmetric-delete dictionary.

The dictionary is made from the fixed reference table, whose size is checked, and travels with the function: of
every name, with characters that look or sound alike made one, the first ``PREFIX`` letters with up to as many left
out as edits are allowed. A typed text is cut into segments, department names and codes are taken out, and what
remains is looked up whole, then by its last words. The candidates are ranked by weighted Damerau-Levenshtein
distance, agreement with the department, and how often the corpus names the entry.

An entry is within reach of a text if their weighted distance (look-alikes and doubled letters count half) is within
the text's limit, and its plain edits (look-alikes count nothing) within the limit and one. All entries within reach
are found.

Defined results: a null or blank text, and one that reaches no entry, is a miss (``NINGUNO``). Ties go to the more
frequent entry, then to the smaller code. An entry that shares its name is chosen by department, else by frequency.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.edits import deletions, folded, osa, weighted_dl

NONE = "NINGUNO"

#: The reference list is broadcast; a longer one is refused rather than sent.
MAX_REFERENCE = 50_000
#: Letters of a name that are looked up, and the most plain edits (of the longest texts).
PREFIX, MOST_EDITS = 8, 4

# Words before a place that do not belong to its name, smaller places inside one, and short forms.
BEFORE = {"MPIO", "MUNICIPIO", "MUN", "CIUDAD", "DISTRITO", "DE", "DEL"}
SMALLER = {"VEREDA", "VDA", "CGTO", "CORREGIMIENTO", "CORREG", "INSPECCION", "CASERIO"}
SHORT = {"PTO": "PUERTO", "STA": "SANTA", "STO": "SANTO", "S": "SAN", "SN": "SAN", "V": "VILLA", "VLLA": "VILLA", "NVA": "NUEVA", "NVO": "NUEVO", "GRAL": "GENERAL", "P": "PUERTO"}
LETTERS = [*range(48, 58), *range(65, 91)]
# Digits typed for letters.
DIGITS = str.maketrans("034589", "OEASBG")


def plain(text: str) -> str:
    """Upper case without accents."""
    if text.isascii():
        return text.upper()
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c)).upper()


class PlaceIndex:
    def __init__(self, reference: list[tuple[str, str, str | None]], frequency: dict[str, int] | None = None) -> None:
        self.frequency = frequency or {}
        self.codes = {code: (name, dept) for code, name, dept in reference}
        self.departments = sorted({plain(d) for _, _, d in reference if d})
        self.entries: dict[str, list[str]] = {}
        for code, name, _ in reference:
            for form in {self.pack(plain(name)), self.pack(re.sub(r"\b(?:DE|DEL|LA|EL)\b", "", plain(name)))}:
                self.entries.setdefault(form, []).append(code)
        forms = sorted(self.entries)
        cuts = [(cut, k) for k, form in enumerate(forms) for cut in set(deletions(folded(form)[:PREFIX], MOST_EDITS))]
        keys = np.array([c for c, _ in cuts], dtype=f"S{PREFIX}")
        order = np.argsort(keys, kind="stable")
        self.forms_by_place, self.cuts, self.owners = forms, keys[order], np.array([k for _, k in cuts], dtype=np.int32)[order]
        self.letters = np.stack([self.counted(folded(f)) for f in forms]) if forms else np.zeros((0, len(LETTERS)), dtype=np.int16)
        #: A text longer than this is beyond the limit of every entry.
        self.longest = max((len(f) for f in self.entries), default=0) + MOST_EDITS
        self.memo: dict[tuple, str | None] = {}

    @staticmethod
    def pack(text: str) -> str:
        return re.sub(r"[^A-Z0-9]", "", text)

    @staticmethod
    def counted(word: str) -> np.ndarray:
        """How often each letter or digit occurs."""
        return np.bincount(np.frombuffer(word.encode(), dtype=np.uint8), minlength=128)[LETTERS].astype(np.int16)

    @staticmethod
    def limit(form: str) -> float:
        return 1.0 if len(form) <= 4 else 2.0 if len(form) <= 9 else 3.0

    def near(self, form: str) -> list[tuple[float, str]]:
        """``(distance, entry form)`` within the limit."""
        if form in self.entries:
            return [(0.0, form)]
        if len(form) > self.longest:
            return []
        limit, plainly = self.limit(form), folded(form)
        edits = int(limit) + 1
        cuts = np.array(list(set(deletions(plainly[:PREFIX], edits))), dtype=self.cuts.dtype)
        lo, hi = np.searchsorted(self.cuts, cuts, "left"), np.searchsorted(self.cuts, cuts, "right")
        found = np.unique(np.concatenate([self.owners[:0], *[self.owners[a:b] for a, b in zip(lo[hi > lo], hi[hi > lo], strict=True)]]))
        # an edit adds one letter at most and takes one at most
        apart = self.letters[found] - self.counted(plainly)
        found = found[np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1)) <= edits]
        out = []
        for x in (self.forms_by_place[k] for k in found):
            d = weighted_dl(form, x, limit)
            if d <= min(limit, 0.34 * len(x)) and osa(plainly, folded(x), edits) <= edits:
                out.append((d, x))
        return out

    def department(self, text: str) -> str | None:
        """The department a text is, in full, as a prefix with a point, or within one edit."""
        bare = self.pack(text)
        for d in self.departments:
            full = self.pack(d)
            if bare == full or len(bare) >= 4 and full.startswith(bare) or len(bare) > 6 and weighted_dl(bare, full, 1.0) <= 1.0:
                return d
        return None

    def resolve(self, text: str | None, department: str | None = None) -> str:
        key = (text, department)
        if key not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[key] = self._resolve(text, department)
        return self.memo[key]

    def _resolve(self, text: str | None, department: str | None) -> str:
        if not text or not text.strip():
            return NONE
        text = plain(text)
        dept = self.department(plain(department)) if department else None
        code = next((c for c in re.findall(r"(?<!\d)\d{5}(?!\d)", text) if c in self.codes), None)
        text = re.sub(r"(?<!\d)\d{5}(?!\d)", " ", text)
        text = re.sub(r"\((?:DEPTO|DPTO|DEPARTAMENTO)\.?\)|\b(?:DEPTO|DPTO|DEPARTAMENTO)\b(?:\s+DEL?)?", " @ ", text)
        if "EXTRANJERO" in text or "@" in text:
            return code or NONE
        segments = [s.strip() for s in re.split(r"[/,()]|(?<=\s)-|-(?=\s)|-", text) if s.strip()]
        names = []
        for s in segments:
            d = self.department(s) if len(segments) > 1 else None
            if d and self.pack(s) not in self.entries:
                dept = dept or d
            else:
                names.append(s)
        names.sort(key=lambda s: s.split()[0].strip(".") in SMALLER)
        best: tuple | None = None
        for s in names:
            words = [w for w in re.split(r"[^A-Z0-9]+", s) if w]
            if not words or not any(c.isalpha() for c in s):
                continue
            smaller = words[0] in SMALLER
            while len(words) > 1 and words[0] in BEFORE:
                words = words[1:]
            tries = [] if smaller else [words]
            ends = [len(w) for w in words]
            tries += [words[k:] for k in range(max(1, len(words) - self.longest), len(words)) if sum(ends[k:]) <= self.longest + 8]
            for penalty, w in enumerate(tries):
                partial = penalty > 0 or smaller
                for form in self.forms(w):
                    for d, x in self.near(form):
                        if partial and d > (1.0 if len(x) > 5 else 0.5):
                            continue
                        for c in self.entries[x]:
                            home = self.codes[c][1]
                            cross = dept is not None and home is not None and plain(home) != dept
                            rank = (d + (0.6 if cross else 0.0) + (0.3 if partial and not smaller else 0.0), -len(x) if partial else 0, c != code, -self.frequency.get(c, 0), c)
                            if best is None or rank < best[0]:
                                best = (rank, c)
                if best is not None:
                    break
            if best is not None:
                break
        if best is None:
            return code or NONE
        if code and best[1] != code and best[0][0] > 0.5:
            return code
        return best[1]

    def forms(self, words: list[str]) -> set[str]:
        """The packed text, with short forms written out and digits read as letters ('1' as L and as I)."""
        full = "".join(SHORT.get(w, w) for w in words[:-1]) + words[-1] if len(words) > 1 else words[0]
        out = {"".join(words), full}
        out |= {x.translate(DIGITS).replace("1", y) for x in list(out) for y in "LI" if any(c.isdigit() for c in x)}
        return out


def reference_rows(reference: DataFrame) -> list[tuple[str, str, str | None]]:
    rows = reference.select("codigo_dane", "nombre", "departamento").limit(MAX_REFERENCE + 1).collect()
    if len(rows) > MAX_REFERENCE:
        raise ValueError(f"the reference list has more than {MAX_REFERENCE} entries")
    return [(r.codigo_dane, r.nombre, r.departamento) for r in rows if r.codigo_dane and r.nombre]


def entry_frequency(rows: DataFrame, reference: DataFrame) -> dict[str, int]:
    """How often all rows name each entry beyond doubt: by name and department. One row per entry."""
    # both sides are aggregated first; the counts are bounded by the reference list
    ref = reference.select("codigo_dane", F.col("nombre").alias("municipio_nombre_normalizado"), "departamento")
    counts = rows.groupBy("municipio_nombre_normalizado", "departamento").agg(F.count("*").alias("n"))
    return {r.codigo_dane: r.n for r in counts.join(F.broadcast(ref), ["municipio_nombre_normalizado", "departamento"]).groupBy("codigo_dane").agg(F.sum("n").alias("n")).collect()}


def resolver(reference: DataFrame, rows: DataFrame | None = None):
    """An Arrow-batched function ``(text, department) -> code``; ``rows`` gives the frequencies."""
    listed = reference_rows(reference)
    frequency = entry_frequency(rows, reference) if rows is not None else {}
    made: list[PlaceIndex] = []

    @F.pandas_udf("string")
    def resolve(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        if not made:
            made.append(PlaceIndex(listed, frequency))
        index = made[0]
        for text, dept in batches:
            # each distinct pair of a batch once
            codes, pairs = pd.factorize(pd.MultiIndex.from_arrays([text.fillna("\0"), dept.fillna("\0")]))
            found = np.array([index.resolve(*(None if v == "\0" else v for v in p)) for p in pairs], dtype=object)
            yield pd.Series(found[codes] if len(codes) else [], dtype="object")

    return resolve


def mapped(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Every row with a place typed that the reference does not name uniquely: ``row_order, codigo_dane``.

    ``codigo_dane`` is the entry meant or ``NINGUNO``. Rows without a typed place are left out, so are those
    whose normalised name is the name of exactly one entry.
    """
    unique = reference.groupBy("nombre").agg(F.count("*").alias("n")).filter("n = 1").select(F.col("nombre").alias("municipio_nombre_normalizado"))
    needed = rows.select("row_order", "municipio_comercial", "municipio_nombre_normalizado", "departamento").filter("municipio_comercial is not null")
    open_rows = needed.join(F.broadcast(unique), "municipio_nombre_normalizado", "left_anti")
    return open_rows.select("row_order", resolver(reference, rows)("municipio_comercial", "departamento").alias("codigo_dane"))


def misses(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Typed texts that map to no entry, with their number of rows."""
    found = rows.filter("municipio_comercial is not null").select("municipio_comercial", resolver(reference, rows)("municipio_comercial", "departamento").alias("codigo_dane"))
    return found.filter(F.col("codigo_dane") == NONE).groupBy("municipio_comercial").agg(F.count("*").alias("filas"))
