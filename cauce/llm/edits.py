"""Edit distances and deletion neighbourhoods in plain Python, called from Arrow-batched functions only."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

# Characters that are read or heard as one another, each group at the cost of half an edit.
ALIKE = ["0OQ", "1IL", "3E", "4A", "5S", "8B", "6G", "2Z", "BV", "SZC", "IY", "CKQ", "NM", "GJ"]
_HALF = {(a, b) for group in ALIKE for a in group for b in group if a != b}


def _folding() -> dict[int, str]:
    """Each character with the first of all that are alike, by way of others too."""
    of = {c: c for group in ALIKE for c in group}
    for _ in ALIKE:
        for group in ALIKE:
            least = min(of[c] for c in group)
            for c in [x for x in of if of[x] in {of[c] for c in group}]:
                of[c] = least
    return {ord(c): x for c, x in of.items()}


_FOLD = _folding()


def folded(word: str) -> str:
    """The word with characters that are alike as one."""
    return word.translate(_FOLD)


def weighted_dl(a: str, b: str, limit: float = 99.0) -> float:
    """Damerau-Levenshtein distance (adjacent transposition one edit); look-alikes and doubled letters cost half.

    Stops early with ``limit + 1`` once every cell of a row is beyond the limit.
    """
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) > 2 * limit:
        return limit + 1
    prev2: list[float] = []
    prev = [0.0]
    for j in range(1, len(b) + 1):
        prev.append(prev[-1] + (0.5 if j > 1 and b[j - 1] == b[j - 2] else 1.0))
    for i, x in enumerate(a, 1):
        drop = 0.5 if i > 1 and x == a[i - 2] else 1.0
        row = [prev[0] + drop]
        for j, y in enumerate(b, 1):
            add = 0.5 if j > 1 and y == b[j - 2] else 1.0
            cost = 0.0 if x == y else 0.5 if (x, y) in _HALF else 1.0
            best = min(prev[j] + drop, row[j - 1] + add, prev[j - 1] + cost)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                best = min(best, prev2[j - 2] + 1.0)
            row.append(best)
        if min(row) > limit:
            return limit + 1
        prev2, prev = prev, row
    return prev[-1]


def osa(a: str, b: str, limit: int) -> int:
    """Unweighted optimal string alignment distance, ``limit + 1`` beyond the limit."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, prev2[j - 2] + 1)
            row.append(best)
        if min(row) > limit:
            return limit + 1
        prev2, prev = prev, row
    return prev[-1]


#: What may be typed otherwise: characters alike, doubled letters, neighbours swapped, letters lost, added, changed, ends cut off.
KINDS = ["alike", "doubled", "swapped", "lost", "added", "changed", "cut"]


def operations(meant: str, typed: str) -> list[int]:
    """How often each of ``KINDS`` occurs in a shortest way from one text to the other; words in their better order.

    A word that is the beginning of the other, by two letters or more, was cut off: once, however much is missing.
    """
    a, b = meant.split(" "), typed.split(" ")
    if len(a) == len(b):
        ways = [list(zip(a, b, strict=True))] + ([list(zip(a, b[::-1], strict=True))] if len(a) == 2 else [])
    else:
        ways = [[("".join(a), "".join(b))]] + ([[("".join(a[::-1]), "".join(b))]] if len(a) == 2 else []) + ([[("".join(a), "".join(b[::-1]))]] if len(b) == 2 else [])
    return min(([sum(x) for x in zip(*[_operations(x, y) for x, y in way], strict=True)] for way in ways), key=lambda ops: (sum(ops), ops))


def _operations(a: str, b: str) -> list[int]:
    out = [0] * len(KINDS)
    if a == b:
        return out
    if len(a) - len(b) >= 2 and len(b) >= 3 and a.startswith(b):
        out[6] = 1
        return out
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[j - 1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    i, j = len(a), len(b)
    while i or j:
        here = rows[i][j]
        if i and j and a[i - 1] == b[j - 1] and rows[i - 1][j - 1] == here:
            i, j = i - 1, j - 1
        elif i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and rows[i - 2][j - 2] + 1 == here:
            out[2] += 1
            i, j = i - 2, j - 2
        elif i and j and rows[i - 1][j - 1] + 1 == here:
            out[0 if (a[i - 1], b[j - 1]) in _HALF else 5] += 1
            i, j = i - 1, j - 1
        elif i and rows[i - 1][j] + 1 == here:
            out[1 if a[i - 1] in (a[max(0, i - 2) : i - 1], a[i : i + 1]) else 3] += 1
            i -= 1
        else:
            out[1 if b[j - 1] in (b[max(0, j - 2) : j - 1], b[j : j + 1]) else 4] += 1
            j -= 1
    return out


def deletions(word: str, most: int) -> Iterator[str]:
    """``word`` with up to ``most`` characters left out."""
    for k in range(min(most, len(word)) + 1):
        for gone in combinations(range(len(word)), k):
            yield "".join(c for i, c in enumerate(word) if i not in gone) if k else word


def _pieces(n: int, edits: int) -> list[tuple[int, int, int]]:
    return [(i, i * n // (edits + 1), (i + 1) * n // (edits + 1)) for i in range(edits + 1)]


def own_pieces(word: str, edits: int) -> list[str]:
    """The word cut into one piece more than ``edits``, so that one piece survives them; with its length and place."""
    return [f"{len(word)}.{i}.{word[s:e]}" for i, s, e in _pieces(len(word), edits)]


def sought_pieces(word: str, allowed: Callable[[int], int], widest: int) -> list[str]:
    """What ``own_pieces`` of a word that is no longer, and within its ``allowed(length)`` <= ``widest`` edits, may leave in this one.

    A piece moves by no more than the edits before it, and those after it, let it.
    """
    out, size = [], len(word)
    for n in range(max(0, size - widest), size + 1):
        edits, longer = allowed(n), size - n
        if longer > edits:
            continue
        for i, s, e in _pieces(n, edits):
            low, high = max(0, s - i, s + longer - (edits - i)), min(size - (e - s), s + i, s + longer + edits - i)
            out += [f"{n}.{i}.{word[at : at + e - s]}" for at in range(low, high + 1)]
    return list(dict.fromkeys(out))
