"""Cleaning as Column -> Column functions; all of them stay inside whole-stage codegen.

Null in gives null out, except for categories, where it gives the default category.
Nothing here raises under ANSI mode: unreadable values become null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapledger import presets


#: Texts that a cast can read. A cast of anything else raises and catches an error for every row, which costs far more
#: than looking first. White space and control characters at the ends are ignored, as by the cast.
_WHOLE = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
_NUMBER = (
    r"(?i)^[\x00-\x20]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[df]?[\x00-\x20]*$"
    r"|^[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*$"
)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it and wherever the plan moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _as(value: Column, kind: str, pattern: str) -> Column:
    """A number or text as a number; null where the text does not match."""
    return F.when(value.cast("string").rlike(pattern), value.try_cast(kind))


def text_to_int(value: Column) -> Column:
    """Whole-number text to int; ``'90.0'`` and other texts give null."""
    return _as(value.cast("string"), "int", _WHOLE)


def round_half_even(value: Column) -> Column:
    """Number or number text to the nearest int, halves to the even neighbour."""
    return F.bround(_as(value, "double", _NUMBER), 0).try_cast("int")


def leading_number(value: Column) -> Column:
    """``'193 cm'`` or ``'193'`` to 193."""
    return text_to_int(F.get(F.split(value, " "), F.lit(0)))


def weight_in_pounds(value: Column, factor: float = presets.KG_TO_LB) -> Column:
    """``'70 kg'`` to rounded pounds; a bare number is in pounds already."""
    parts = F.split(value, " ")
    kilograms = text_to_int(F.get(parts, F.lit(0)))
    converted = F.bround(kilograms * F.lit(factor), 0).try_cast("int")
    return F.when(F.size(parts) > 1, converted).otherwise(text_to_int(value))


def level(
    value: Column,
    domain: Sequence[str] = tuple(presets.LEVELS),
    default: str = presets.DEFAULT_LEVEL,
) -> Column:
    """Trimmed lower-case category; anything outside the domain is the default."""
    plain = F.lower(F.trim(value))
    return F.when(plain.isin(*domain), plain).otherwise(F.lit(default))


def part(value: Column, separator: str, index: int) -> Column:
    """The ``index``-th part of a composite text, null where it does not exist."""
    return F.get(F.split(value, _literal_pattern(separator)), F.lit(index))


def url_segment(url: Column, index: int = 2) -> Column:
    return part(url, "/", index)


def combine_pair(left: Column, right: Column, separator: str = " / ") -> Column:
    """Two values as one text; a missing one is written as ``None``."""
    missing = F.lit("None")
    return F.concat_ws(
        separator, F.coalesce(left.cast("string"), missing), F.coalesce(right.cast("string"), missing)
    )


def age_at(birthday: Column, as_of: dt.date = presets.AGE_AS_OF) -> Column:
    """Whole years at ``as_of`` by the calendar: a birthday still to come counts one less."""
    day_of_year = F.month(birthday) * 100 + F.dayofmonth(birthday)
    still_to_come = (day_of_year > as_of.month * 100 + as_of.day).cast("int")
    return F.lit(as_of.year) - F.year(birthday) - still_to_come


def timestamp_text_to_date(value: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_date(value, pattern)


def two_digit_birthday(value: Column, now: dt.date) -> Column:
    """``MMDDYY``, leading zeros optional; a date not before ``now`` is a century earlier."""
    padded = F.lpad(value.cast("string"), 6, "0")
    parsed = F.try_to_date(padded, "MMddyy")
    return F.when(parsed < F.lit(now), parsed).otherwise(F.add_months(parsed, -1200))


def indicator(value: Column, wanted: str) -> Column:
    """1 where the category equals ``wanted`` whatever its case, else 0 (also for null)."""
    return F.coalesce((F.lower(value) == F.lit(wanted)).cast("int"), F.lit(0))


def _literal_pattern(separator: str) -> str:
    return "".join(f"\\{c}" if c in r"\^$.|?*+()[]{}" else c for c in separator)


def whole_number(value: Column) -> Column:
    """A number or number text as a 64-bit integer, halves to the even neighbour; unreadable values give null.

    Integers are taken as they are; everything else goes through double.
    """
    text = value.cast("string")
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint")).otherwise(
        F.bround(_as(value, "double", _NUMBER), 0).try_cast("bigint")
    )


def scaled_units(x: Column, digits: int) -> Column:
    """A double times a power of ten as a whole number without its sign, ties of the binary value to even; null beyond 2^52.

    Close to a tie the exact remainder decides: the product is split into a rounded product and its error.
    """
    power = float(10**digits)
    product = F.abs(x) * power

    def exact(size: Column) -> Column:
        # Veltkamp's splitting and Dekker's product: size * power = product + error, exactly.
        product = size * power
        high = bound(size * 134217729.0, lambda spread: spread - (spread - size))
        error = bound(high, lambda h: (h * power - product) + (size - h) * power)
        below = F.floor(product).cast("double")
        even = F.pmod(below, F.lit(2.0)) == 0
        up = bound(product - below - 0.5 + error, lambda r: F.when((r < 0) | ((r == 0) & even), 0).otherwise(1))
        return below.cast("long") + up

    near = F.abs(product - F.floor(product) - 0.5) <= product * 2.0**-50 + 2.0**-50
    return F.when(product < float(1 << 52), F.when(near, bound(F.abs(x), exact)).otherwise(F.floor(product + 0.5)))


def units_text(x: Column, units: Column, digits: int) -> Column:
    """The text of a double whose scaled units are known. Numbers beyond them have no fraction left."""
    scale = 10**digits
    negative = (x < 0) | ((x == 0) & x.cast("string").startswith("-"))
    text = F.concat(F.when(negative, "-").otherwise(""), F.floor(units / F.lit(scale)).cast("string"))
    if digits:
        text = F.concat(text, F.lit("."), F.lpad((units % scale).cast("string"), digits, "0"))
    return (
        F.when(F.isnan(x), "nan")
        .when(units.isNotNull(), text)
        .when(F.abs(x) == float("inf"), F.when(x < 0, "-inf").otherwise("inf"))
        .when(x.isNotNull(), F.format_string(f"%.{digits}f", x))
    )


def fixed_decimals(value: Column, digits: int = 2) -> Column:
    """A number with a fixed count of decimals, rounded as C prints it: by its binary value, ties to even.

    Java's formatter rounds the shortest notation, which differs close to a tie, and is slow: it only sees numbers
    beyond 2^52 units.
    """
    x = value.cast("double")
    return units_text(x, scaled_units(x, digits), digits)
