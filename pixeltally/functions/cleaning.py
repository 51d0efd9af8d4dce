"""Expressions that parse and clean raw text and numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixeltally.schemas import NA_TOKENS

# Fixed value: what counts as number text.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"

# ISO days, alone or with a time.
ISO = "yyyy-M-d[ H:m[:s][.SSSSSS][XXX]]['T'H:m[:s][.SSSSSS][XXX]]"
DATE_FORMATS = (ISO,)

# Forms that a file may have its dates in, one per file, and what text of each looks like: text
# of another shape is not parsed, since a parser that fails costs more than one that succeeds. Of forms
# that read as many dates of a file the first counts, so months come before days.
_MONTH, _DAY, _YEAR = r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12]\d|3[01])", r"\d{4}"
DATE_SHAPES = {
    ISO: rf"^{_YEAR}-\d{{1,2}}-\d{{1,2}}([ T]|$)",
    "M/d/yyyy": rf"^{_MONTH}/{_DAY}/{_YEAR}$",
    "d/M/yyyy": rf"^{_DAY}/{_MONTH}/{_YEAR}$",
    "M-d-yyyy": rf"^{_MONTH}-{_DAY}-{_YEAR}$",
    "d-M-yyyy": rf"^{_DAY}-{_MONTH}-{_YEAR}$",
    "yyyy/M/d": rf"^{_YEAR}/{_MONTH}/{_DAY}$",
    "MMM d, yyyy": rf"^[A-Z][a-z]{{2}} {_DAY}, {_YEAR}$",
    "MMMM d, yyyy": rf"^[A-Z][a-z]{{2,8}} {_DAY}, {_YEAR}$",
    "d MMM yyyy": rf"^{_DAY} [A-Z][a-z]{{2}} {_YEAR}$",
}

# Whitespace as Unicode defines it, plus the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"

# Dekker's constant for splitting a double in two halves of 26 bits.
_SPLIT = 134217729.0


def na_to_null(column: Column) -> Column:
    """Null for the texts that stand for a missing value."""
    return F.when(~column.isin(NA_TOKENS), column)


def nan_to_null(column: Column) -> Column:
    """NaN compares greater than every number, so it must go before any filter or sum."""
    return F.nullif(column, F.lit(float("nan")))


def to_number(column: Column, data_type: T.DataType) -> Column:
    """A double, null where text is no plain decimal number.

    The guard is needed beside ``try_cast``, which also takes Java forms such as ``1d``.
    """
    if isinstance(data_type, T.StringType):
        return F.when(column.rlike(NUMBER_TEXT), column.try_cast("double"))
    return nan_to_null(column.cast("double"))


def release_year(column: Column, data_type: T.DataType, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Year of a date, of text in the first of the given forms that fits; null where none does."""
    if not isinstance(data_type, T.StringType):
        return F.year(column.cast("date"))
    return F.coalesce(*[_year_in(column, form) for form in formats])


def _year_in(column: Column, form: str) -> Column:
    year = F.year(F.try_to_timestamp(column, F.lit(form)))
    return F.when(column.rlike(DATE_SHAPES[form]), year) if form in DATE_SHAPES else year


def years_by_form(column: Column) -> Column:
    """The year that each of the forms reads, in the order of ``DATE_SHAPES``, null where it doesn't."""
    return F.array(*[_year_in(column, form) for form in DATE_SHAPES])


def clean_title(column: Column) -> Column:
    """Search text of a title: no parenthesised parts, ASCII letters and digits only."""
    text = F.regexp_replace(column, rf"(?U){_SPACE}*\([^)]*\)", "")
    text = F.regexp_replace(text, r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]", "")
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def truncate(column: Column, width: int) -> Column:
    return F.substring(column, 1, width)


def round4(column: Column) -> Column:
    """Round a double to 4 places by its exact binary value, ties to even.

    ``round`` works on the shortest decimal text, so 0.00015, which in binary lies
    below the tie, would go up. Only the part after the point is rounded, which is
    exact at every size: the side of a tie is told by the exact product with 100000,
    the rounded product plus its rounding error, which comes out by splitting the
    part. From 2**39 on neighbouring doubles are further apart than two places, so
    the column is its own nearest value.
    """
    scale = F.lit(100000.0)  # 17 bits, so only the part needs splitting
    size = F.abs(column)
    whole = F.floor(size).cast("double")
    part = size - whole
    scaled = part * scale
    high = part * _SPLIT - (part * _SPLIT - part)
    error = (high * scale - scaled) + (part - high) * scale
    tie = F.rint(scaled)
    side = (scaled - tie) + error
    down, up = (tie - 5) / 10, (tie + 5) / 10
    nearest = (
        F.when(tie % 10 != 5, F.floor((tie + 5) / 10).cast("double"))
        .when(side > 0, up).when(side < 0, down)
        .when(down % 2 == 0, down).otherwise(up))
    # Whole and part together are an integer below 2**53, so one division rounds.
    return F.when(size < float(2 ** 39), F.signum(column) * ((whole * 10000 + nearest) / 10000.0)).otherwise(column)
