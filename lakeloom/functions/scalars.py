"""Scalar expressions that queries share. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESIDUES = "ACDEFGHIKLMNPQRSTVWY"


def letter_count(text: Column, letter: str) -> Column:
    """How often a literal string of one character occurs (STR-03)."""
    return (F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))).cast("long")


def pattern_count(text: Column, pattern: str) -> Column:
    """How often a regular expression matches (STR-04)."""
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, null where b is 0 (MTH-06)."""
    return F.when(b != 0, a.cast("double") / b.cast("double"))


def percent(a: Column, b: Column, digits: int) -> Column:
    return F.round(F.when(b != 0, a.cast("double") * F.lit(100.0) / b.cast("double")), digits)


def bucket(x: Column, width: int) -> Column:
    """The lower end of the bucket that x is in (AGG-17)."""
    return (F.floor(x / F.lit(width)) * F.lit(width)).cast("long")


def overlap_length(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Positions that two closed intervals share (MTH-08)."""
    return F.least(a_end, b_end) - F.greatest(a_start, b_start) + 1


def span(start: Column, end: Column) -> Column:
    """Positions of a closed interval, 0 where an end is missing."""
    return F.when(start.isNotNull() & end.isNotNull(), end - start + 1).otherwise(0)


def bar(n: Column, most: Column, width: int = 40, mark: str = "█") -> Column:
    """A bar of a text histogram (T-13)."""
    return F.repeat(F.lit(mark), F.when(most > 0, (n / most * width).cast("int")).otherwise(0))


def file_parts(path: Column) -> Column:
    """Base name of a path without its last suffix, split at dots (STR-10)."""
    return F.split(F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", ""), r"\.")
