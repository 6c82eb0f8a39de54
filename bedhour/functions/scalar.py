"""Column expressions shared by the operators. All are built-in functions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its literal name: feature names hold dots, spaces, brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_col(c: Column | str) -> Column:
    return col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN compares as the largest number in Spark; missing must be null."""
    c = _as_col(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    Spark also reads the Java suffixes ``1d`` and ``5f`` as numbers, which a
    clinical text value never means, so those are null as well.
    """
    c = _as_col(c)
    number = c.try_cast("double")
    return F.when(~c.rlike(r"[0-9.][dDfF]\s*$") & ~F.isnan(number), number)


def hour_round(minutes: Column | str) -> Column:
    """Nearest hour, ties to the even hour. The cast turns -0.0 into 0, so the
    half hour before admission counts as hour 0."""
    return F.rint(_as_col(minutes) / F.lit(60.0)).cast("bigint")


def hour_ceil(minutes: Column | str) -> Column:
    return F.ceil(_as_col(minutes) / F.lit(60.0)).cast("bigint")


def contains_text(c: Column | str, text: str) -> Column:
    """Case-insensitive containment; null text is no match."""
    return F.coalesce(F.contains(F.lower(_as_col(c)), F.lit(text.lower())), F.lit(False))


def age_years(c: Column | str) -> Column:
    """First run of digits: ``> 89`` is 89, empty text is null."""
    return F.nullif(F.regexp_extract(_as_col(c), r"(\d+)", 1), F.lit("")).try_cast("double")


def last_parenthesised(c: Column | str) -> Column:
    """Text in the last pair of round brackets, null when there is none."""
    found = F.regexp_extract_all(_as_col(c), F.lit(r"\(([^)]+)\)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1))


def sum_skip_null(columns: Iterable[Column | str]) -> Column:
    """Horizontal sum in which a missing term counts as 0."""
    terms = [F.coalesce(_as_col(c).cast("double"), F.lit(0.0)) for c in columns]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0)) if terms else F.lit(0.0)


def positive_flag(c: Column | str) -> Column:
    return (F.coalesce(_as_col(c), F.lit(0)) > 0).cast("int")
