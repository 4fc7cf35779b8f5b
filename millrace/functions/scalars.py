"""Scalar semantics that differ from the Spark defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column, floating: bool = True) -> Column:
    """NULL, and NaN for floating columns."""
    c = _col(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def floor_div(a: str | Column, b: str | Column | float) -> Column:
    """Integer division rounding towards minus infinity."""
    b = F.lit(b) if isinstance(b, (int, float)) else _col(b)
    return F.floor(F.try_divide(_col(a), b))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    return F.bround(_col(c), digits)


def if_else(cond: Column, yes: Column, no: Column) -> Column:
    """Two-branch choice in which a NULL condition gives NULL."""
    return F.when(cond, yes).when(~cond, no)


def paste(*parts: str | Column, sep: str = " ") -> Column:
    """Join text parts; NULL parts are skipped."""
    return F.concat_ws(sep, *[_col(p) for p in parts])


def extract_first(c: str | Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern`` (or its group), NULL when there is none."""
    c = _col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def remove_pattern(c: str | Column, pattern: str) -> Column:
    return F.regexp_replace(_col(c), pattern, "")


def remove_punctuation(c: str | Column) -> Column:
    return remove_pattern(c, r"[!-/:-@\[-`{-~]")


def remove_digits(c: str | Column) -> Column:
    return remove_pattern(c, "[0-9]+")


def keep_ascii(c: str | Column) -> Column:
    """Drop every character outside ASCII."""
    return remove_pattern(c, r"[^\x00-\x7F]")


def remove_urls(c: str | Column) -> Column:
    return remove_pattern(c, r"https?://[^ \t\r\n]*")


def days_since(date: str | Column, as_of: str) -> Column:
    """Whole days from ``date`` to the fixed day ``as_of``."""
    return F.datediff(F.lit(as_of).cast("date"), F.to_date(_col(date)))


def in_years(date: str | Column, first: int, last: int) -> Column:
    """Years ``first`` to ``last`` as a range of the raw column, which Parquet can skip by."""
    return (_col(date) >= F.lit(f"{first}-01-01")) & (_col(date) < F.lit(f"{last + 1}-01-01"))


def weighted_mean(x: str | Column, w: str | Column) -> Column:
    """Aggregate expression ``sum(x*w)/sum(w)``."""
    return F.try_divide(F.sum(_col(x) * _col(w)), F.sum(_col(w)))


def one_hot(c: str | Column, levels: list) -> list[Column]:
    """One 0/1 column per level, named ``is_<level>``."""
    c = _col(c)
    return [F.coalesce((c == F.lit(v)).cast("int"), F.lit(0)).alias(f"is_{v}") for v in levels]


def dummies(c: str, levels: list, reference) -> dict[str, Column]:
    """0/1 columns for every level but the reference one."""
    if reference not in levels:
        raise ValueError(f"{reference!r} is not a level of {c}")
    return {f"{c}_{v}": (F.col(c) == F.lit(v)).cast("double") for v in levels if v != reference}
