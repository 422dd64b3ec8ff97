"""Cleansing expressions on strings. Everything here stays inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that the registries declare to mean "no value" (compared after upper-casing and accent removal).
NULL_MARKERS = ["", "N/A", "NA", "NO REPORTA", "NO APLICA", "NO REPORTADO", "SIN DATO", "<NA>", "NAN", "NAT"]

# Declared with lower-case letters, hence never equal to an upper-cased text.
NULL_MARKERS_UNREACHABLE = ["null", "None"]


def _folding_table() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters that decompose: those of the whole basic plane with a single-letter result for translate, Latin ones with more apart."""
    one, to, many = [], [], []
    for code in [*range(0xA0, 0xD800), *range(0xF900, 0x10000)]:
        char = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))
        if plain == char or unicodedata.combining(char):
            continue
        if len(plain) == 1:
            one.append(char)
            to.append(plain)
        elif code < 0x250 or 0x1E00 <= code < 0x1F00 or 0xFB00 <= code < 0xFB07:
            many.append((char, plain))
    return "".join(one), "".join(to), many


_ONE, _TO, _MANY = _folding_table()
_SPACE = r"(?U)\s+"
_EDGES = r"(?U)^\s+|\s+$"


def strip_accents(c: Column) -> Column:
    """NRM-1: letters without diacritics (NFKD, marks dropped), for all of the basic plane.

    Characters that stand for several (``ﬁ``, ``½``) are written out for Latin; squared and circled words stay.
    """
    out = F.regexp_replace(F.translate(c, _ONE, _TO), r"\p{Mn}", "")
    for char, plain in _MANY:
        out = F.replace(out, F.lit(char), F.lit(plain))
    return out


def squeeze(c: Column) -> Column:
    """Outer white space removed (Unicode), inner runs made one space."""
    return F.regexp_replace(F.regexp_replace(c, _EDGES, ""), _SPACE, " ")


def is_marker(upper: Column) -> Column:
    return upper.isin(*NULL_MARKERS)


def comparison_text(c: Column) -> Column:
    """NRM-2: accents dropped, upper case, white space squeezed; declared nulls become null."""
    text = squeeze(F.upper(strip_accents(c)))
    return F.when(~is_marker(text), text)


def light_clean(c: Column) -> Column:
    """NRM-7: white space squeezed, declared nulls become null, case and accents kept."""
    return F.when(comparison_text(c).isNotNull(), squeeze(c))


def digits(c: Column) -> Column:
    """NRM-3: only the digits, null where none."""
    return F.nullif(F.regexp_replace(c, r"\D", ""), F.lit(""))


def phone(c: Column) -> Column:
    """NRM-4: digits of a text that is not a declared null."""
    return F.when(comparison_text(c).isNotNull(), digits(c))


def email(c: Column) -> Column:
    """NRM-5: trimmed lower case with an @, else null."""
    text = F.lower(F.regexp_replace(c, _EDGES, ""))
    return F.when(comparison_text(c).isNotNull() & (F.instr(text, "@") > 0), text)


def place_parts(c: Column) -> Column:
    """NRM-8: ``code - name`` split at the first ' - ' when the left part is all digits."""
    left = F.regexp_extract(c, r"(?s)^(.*?) - ", 1)
    coded = c.contains(" - ") & F.trim(left).rlike(r"^\d+$")
    name = F.when(coded, F.regexp_replace(c, r"(?s)^.*? - ", "")).otherwise(c)
    return F.struct(F.when(coded, F.trim(left)).alias("codigo"), comparison_text(name).alias("nombre"))


def blank(c: Column) -> Column:
    """Null or white space only."""
    return c.isNull() | F.regexp_replace(c, _EDGES, "").eqNullSafe("")


def placeholder_id(c: Column) -> Column:
    """DED-1: empty, or one digit repeated."""
    return F.coalesce(c, F.lit("")).eqNullSafe("") | c.rlike(r"^(\d)\1*$")


def token_sort(c: Column) -> Column:
    """Words in alphabetical order, joined by one space."""
    return F.array_join(F.array_sort(F.split(squeeze(c), " ")), " ")
