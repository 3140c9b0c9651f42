"""Identifier and text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space around identifiers.
WHITE = " \t\n\r\f\u000b\u00a0"


def strip(c: Column | str) -> Column:
    """Without surrounding white space (Spark's own ``trim`` takes spaces only)."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITE))


def norm_id(c: Column | str) -> Column:
    """Identifier without surrounding white space, in upper case; null where
    nothing is left."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def blank(c: Column | str) -> Column:
    """True for null and for white space only."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.length(strip(c)) == 0)


def date_sk(c: Column) -> Column:
    """Calendar day as yyyymmdd."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def all_null(columns: list[str]) -> Column:
    """True where every one of the columns is null."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNull()
    return out


def any_null(columns: list[str]) -> Column:
    """True where at least one of the columns is null."""
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out
