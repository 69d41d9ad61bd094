"""Reading values that come as text: numbers, dates, bounds and lists in control tables."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_TYPES = {"date", "datetime"}


def is_numeric_text(value: Column) -> Column:
    """True for text that is a decimal number; 'NaN', 'Infinity' and '1d' are not."""
    return value.cast("string").rlike(NUMERIC_TEXT)


def as_date(value: Column) -> Column:
    """Date part of a date, timestamp or text; unreadable text gives NULL and not a failed job."""
    return value.try_cast("date")


def bound(text: object, datatype: str | None = None) -> Column:
    """Bound of a plausibility check: a number, a date, or a Spark SQL expression.

    Dates may be written ``1950-01-01`` or ``19500101``, with or without quotes. ``GETDATE()`` and
    the day unit ``dd``, common in published control tables, are accepted too.
    """
    if isinstance(text, Column):
        return text
    raw = str(text).strip()
    is_date = (datatype or "").lower() in DATE_TYPES
    if is_date:
        plain = re.fullmatch(r"'?(\d{4})-?(\d{2})-?(\d{2})'?", raw)
        if plain:
            return F.lit("-".join(plain.groups())).cast("date")
    raw = re.sub(r"\bGETDATE\s*\(\s*\)", "current_timestamp()", raw, flags=re.IGNORECASE)
    raw = re.sub(r"\bDATEADD\s*\(\s*dd\b", "DATEADD(DAY", raw, flags=re.IGNORECASE)
    value = F.expr(raw)
    return value.try_cast("date") if is_date else value


def split_list(text: str | list | tuple) -> list[str]:
    """Values of a list cell: ``a,b`` or ``a','b``; quotes and blanks around values are dropped."""
    if isinstance(text, (list, tuple)):
        return [str(item) for item in text]
    return [part.strip().strip("'").strip() for part in text.split(",")]


def is_numeric_type(datatype: T.DataType) -> bool:
    return isinstance(datatype, T.NumericType)


def has_time_of_day(datatype: T.DataType) -> bool:
    return not isinstance(datatype, T.DateType)
