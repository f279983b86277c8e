"""Number expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, strip

# Minutes booked for every case of the source without usable times.
FIXED_MINUTES = 300

_NUMBER = rf"^{SPACE}*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?{SPACE}*$"
_WHOLE = rf"^{SPACE}*([+-]?\d{{1,19}})(?:\.0*)?{SPACE}*$"


def to_number(c: Column) -> Column:
    """Text to DOUBLE, NULL when it is not a plain number."""
    return F.when(F.rlike(c, F.lit(_NUMBER)), strip(c).try_cast("double"))


def to_integer(c: Column) -> Column:
    """Text to BIGINT; bad or fractional text is NULL. Long integers stay exact.

    Nearly all values are plain digits, which one pattern settles; the rest goes the long way.
    """
    digits = F.nullif(F.regexp_extract(c, _WHOLE, 1), F.lit("")).try_cast("bigint")
    number = to_number(c)
    return F.coalesce(digits, F.when(number == F.floor(number), number.try_cast("bigint")))


def whole_minutes(c: Column) -> Column:
    """Number (or text) to BIGINT, cut toward zero; NULL and bad text are 0."""
    return F.coalesce(to_number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def whole_number(c: Column) -> Column:
    """N3 for columns that are numeric already."""
    kept = F.nanvl(c.cast("double"), F.lit(None).cast("double")).try_cast("bigint")
    return F.coalesce(kept, F.lit(0).cast("bigint"))


def parse_duration(c: Column) -> Column:
    """N1: "X horas Y minutos" to minutes; a missing part is 0, NULL stays NULL."""

    text = F.lower(c)

    def part(pattern: str) -> Column:
        found = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
        return F.coalesce(found.try_cast("double"), F.lit(0.0))

    total = part(r"(\d+)\s*horas?") * 60 + part(r"(\d+)\s*(?:minutos?|min)")
    return F.when(c.isNotNull(), total)


def fixed_minutes(value: int = FIXED_MINUTES) -> Column:
    """The same number of minutes for every row."""
    return F.lit(value).cast("bigint")
