"""Minutes, popularity and length classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (lowest popularity of the class, label, sort code)
ARTIST_POPULARITY = (
    (90, "Extremely Popular", 6),
    (70, "Very Popular", 5),
    (50, "Popular", 4),
    (30, "Niche Popularity", 3),
    (10, "Mostly Unknown", 2),
    (None, "Not Popular", 1),
)
ARTIST_POPULARITY_MISSING = ("No Artist Popularity Data", 0)
TRACK_POPULARITY = (
    (90, "Extremely Popular", 6),
    (70, "Very Popular", 5),
    (50, "Popular", 4),
    (30, "Niche", 3),
    (10, "Mostly Unknown", 2),
    (None, "Not Popular", 1),
)
TRACK_POPULARITY_MISSING = ("No Track Popularity Data", 0)
POPULAR_FROM = 50
# fixed values: (seconds below which the class applies, label, sort code); there is no code 4
TRACK_LENGTH = (
    (30, "very short", 1),
    (180, "short", 2),
    (300, "average", 3),
    (420, "pretty long", 5),
    (600, "long", 6),
    (None, "possibly too long", 7),
)
TRACK_LENGTH_MISSING = ("unknown", 0)
# fixed values: (hour below which the part of day applies, label, sort code)
PART_OF_DAY = ((6, "Night", 1), (12, "Morning", 2), (18, "Afternoon", 3), (24, "Evening", 4))
NO_GENRE = "no genre defined"


def _classed(value: Column, classes, applies, missing, pick: int) -> Column:
    """First class whose bound applies; NULL values get ``missing``."""
    out = F.when(value.isNull(), F.lit(missing[pick - 1]))
    for bound, *result in classes:
        out = out.when(F.lit(True) if bound is None else applies(value, bound),
                       F.lit(result[pick - 1]))
    return out


def popularity_label(value: Column, classes, missing) -> Column:
    return _classed(value, classes, lambda v, b: v >= b, missing, 1)


def popularity_sort(value: Column, classes, missing) -> Column:
    return _classed(value, classes, lambda v, b: v >= b, missing, 2)


def length_label(seconds: Column) -> Column:
    return _classed(seconds, TRACK_LENGTH, lambda v, b: v < b, TRACK_LENGTH_MISSING, 1)


def length_sort(seconds: Column) -> Column:
    return _classed(seconds, TRACK_LENGTH, lambda v, b: v < b, TRACK_LENGTH_MISSING, 2)


def part_of_day(hour: Column) -> Column:
    return _classed(hour, PART_OF_DAY, lambda v, b: v < b, (None, None), 1)


def part_of_day_sort(hour: Column) -> Column:
    return _classed(hour, PART_OF_DAY, lambda v, b: v < b, (None, None), 2)


def scaled_ms(ms: Column, unit_ms: int, digits: int, precision: str = "float") -> Column:
    """Milliseconds in a larger unit, rounded; 32-bit arithmetic unless ``precision='double'``.

    Spark divides in double, so the quotient is narrowed before it is rounded. The optimizer takes
    bigint to float to double for one widening cast; ``nanvl`` keeps the step through float.
    """
    value = ms.cast(precision)
    quotient = (F.nanvl(value, value) / F.lit(unit_ms)).cast(precision)
    return F.round(quotient, digits)


def exact_minutes(col: Column) -> Column:
    """Minutes rounded to two digits as a decimal: sums do not depend on row order."""
    return col.cast("decimal(18,2)")
