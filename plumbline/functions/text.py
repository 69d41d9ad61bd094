"""Text columns of the result table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = r" \t\n\r\f\u000b"


def check_id(*parts: Column) -> Column:
    """Identifier of a check: its non-blank parts without spaces, joined by ``_``, lower-cased."""
    cleaned = [F.replace(part.cast("string"), F.lit(" "), F.lit("")) for part in parts]
    return F.lower(F.concat_ws("_", *[F.nullif(part, F.lit("")) for part in cleaned]))


def render_description(template: Column, names: Sequence[str]) -> Column:
    """Replace ``@name`` by the column of that name; names that are not listed become empty."""
    marker = "\u0001"
    text = F.replace(template, F.lit(marker), F.lit(""))
    # Values go in behind a marker, so that an @ inside a value is not taken for a parameter.
    for name in names:
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        shielded = F.replace(value, F.lit("@"), F.lit(marker))
        quoted = F.regexp_replace(shielded, r"([\\$])", r"\\$1")
        text = F.regexp_replace(text, F.lit(rf"@{name}\b"), quoted)
    text = F.regexp_replace(text, r"@\w+", "")
    return F.replace(text, F.lit(marker), F.lit("@"))


def blank_to_null(rows: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Whitespace-only text becomes NULL in all text columns, or in ``columns``."""
    wanted = set(rows.columns if columns is None else columns)
    blank = {
        field.name: F.expr(f"IF(btrim(`{field.name}`, '{WHITESPACE}') = '', NULL, `{field.name}`)")
        for field in rows.schema
        if isinstance(field.dataType, T.StringType) and field.name in wanted
    }
    return rows.withColumns(blank) if blank else rows


def number_text(value: Column) -> Column:
    """Number without a trailing ``.0``: 5.0 gives ``5``, 7.5 gives ``7.5``."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def percent_text(share: str) -> Column:
    """The column ``share`` as a percentage with two decimals, rounded to nearest, ties up; NULL
    and 0 give ``0%``.

    Rounding looks at the exact binary value of the percentage. ``scaled`` is percentage * 100
    rounded to a double and ``error`` the part lost by that rounding, so a value that only appears
    to end in 5 (12.345 is stored as 12.3450000000000006) goes to the side it really lies on.
    """
    hundredths = """floor(x.scaled) + IF(x.scaled - floor(x.scaled) > 0.5D
        OR (x.scaled - floor(x.scaled) = 0.5D
            AND (x.high * 100.0D - x.scaled) + (x.percentage - x.high) * 100.0D >= 0), 1, 0)"""
    parts = """named_struct('percentage', p, 'scaled', p * 100.0D,
        'high', p * 134217729.0D - (p * 134217729.0D - p))"""
    # Each step is bound to a name by a lambda. Written out, the steps repeat one another so often
    # that the generated method is too long for the JVM to compile.
    return F.expr(
        f"""CASE WHEN {share} IS NULL OR {share} = 0 THEN '0%' ELSE
        transform(array({share} * 100.0D), p -> transform(array({parts}), x ->
            transform(array({hundredths}),
                n -> concat(n DIV 100, '.', lpad(n % 100, 2, '0'), '%'))[0])[0])[0] END"""
    )
