"""Days typed in several notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months by their first three letters.
MONTHS = ["ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SEP", "OCT", "NOV", "DIC"]

_TIME = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?Z?)?\s*$"
_YEAR_FIRST = r"^\s*(\d{4})[-/. ]?(\d{2}|(?<=[-/. ])\d)[-/. ]?(\d{2}|(?<=[-/. ])\d)" + _TIME
_DAY_FIRST = r"^\s*(\d{1,2})(?:[-/. ]| de )+(\d{1,2}|[A-Za-z]{3,10}\.?)(?:[-/. ]| de )+(\d{4})" + _TIME


def typed_day(c: Column) -> Column:
    """The date a text denotes: the day stands before the month unless the year comes first.

    Null for null, unreadable and impossible dates (31 February, zeros).
    """
    year_first = c.rlike(_YEAR_FIRST)
    at = lambda pattern, i: F.regexp_extract(c, pattern, i)
    word = F.upper(F.substring(at(_DAY_FIRST, 2), 1, 3))
    named = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), word)
    month = F.when(word.rlike(r"^\d"), at(_DAY_FIRST, 2)).when(named > 0, named.cast("string"))
    iso = F.when(year_first, F.concat_ws("-", at(_YEAR_FIRST, 1), at(_YEAR_FIRST, 2), at(_YEAR_FIRST, 3))).when(
        c.rlike(_DAY_FIRST), F.concat(at(_DAY_FIRST, 3), F.lit("-"), month, F.lit("-"), at(_DAY_FIRST, 1))
    )
    return F.try_to_date(F.when(~iso.startswith("0000"), iso), "yyyy-M-d")
