"""Text to typed values, and back to the number format of reports."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.schema import POWER

# Date layouts met in bid inputs, in order of preference.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy")
GERMAN_DATE = "dd.MM.yyyy"
# What the parts of a layout look like.
PARTS = {"yyyy": r"\d{4}", "MM": r"(0[1-9]|1[0-2])", "dd": r"(0[1-9]|[12]\d|3[01])", "HH": r"([01]\d|2[0-3])", "mm": r"[0-5]\d", "ss": r"[0-5]\d"}
NUMBER = r"^[+-]?(\d+[.,]?\d*|[.,]\d+)([eE][+-]?\d+)?$"

SHORT_NUMBER = r"^[+-]?\d{1,15}([.,]\d{0,3})?$"  # those that POWER holds as they are


def layout_pattern(layout: str) -> str:
    """The texts that a layout may fit: whoever asks it first spares the parser those that would make it throw."""
    return "^" + re.sub("|".join(PARTS), lambda part: PARTS[part[0]], re.escape(layout)) + "$"


def decimal_comma(text: Column, kind: T.DataType = POWER) -> Column:
    """``1,5`` and ``1.5`` alike; NULL for anything that is no number, which a pattern tells before the cast would throw."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.rlike(NUMBER), F.replace(trimmed, F.lit(","), F.lit(".")).try_cast(kind))


def short_decimal_comma(text: Column) -> Column:
    """``decimal_comma`` of numbers with up to 15 digits and three decimals, NULL for all others; it needs no wide decimals."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.rlike(SHORT_NUMBER), F.replace(trimmed, F.lit(","), F.lit(".")).try_cast(POWER))


def unreadable_number(text: Column, kind: T.DataType = POWER) -> Column:
    """Whether a filled text is no number, or one that the type would round."""
    wide = decimal_comma(text, T.DecimalType(38, 12))
    exact = wide.try_cast(kind) == wide
    return (F.trim(text.cast("string")) != "") & ~F.coalesce(exact, F.lit(False))


def parse_date(text: Column, layouts: tuple[str, ...] = DATE_LAYOUTS) -> Column:
    """The date of the first layout that fits, else NULL; each layout has a year, month and day at fixed places."""
    trimmed = F.trim(text.cast("string"))
    iso = F.when(F.lit(False), F.lit(None).cast("string"))
    for layout in layouts:
        parts = [F.substring(trimmed, layout.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd")]
        iso = iso.when(trimmed.rlike(layout_pattern(layout)), F.concat_ws("-", *parts))
    return iso.try_cast("date")


def german_date(text: Column) -> Column:
    """``dd.MM.yyyy``; an unreadable date fails the job."""
    return F.to_date(F.trim(text), GERMAN_DATE)


def with_seconds(hhmm: Column) -> Column:
    trimmed = F.trim(hhmm)
    return F.when(F.size(F.split(trimmed, ":")) > 2, trimmed).otherwise(F.concat(trimmed, F.lit(":00")))


def to_german_text(number: Column, digits: int) -> Column:
    """``1234.5`` as ``1.234,500`` for reports."""
    return F.translate(F.format_number(number, digits), ",.", ".,")


def to_decimal_comma(number: Column) -> Column:
    """A number as raw files spell it: decimal comma and no thousands mark."""
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))


def signed_price(price: Column, direction: Column) -> Column:
    """What the provider pays counts negative."""
    return F.when(direction == "PROVIDER_TO_GRID", -price).otherwise(price)
