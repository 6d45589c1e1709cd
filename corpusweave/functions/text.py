"""Column expressions for keys and missing text; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of a missing value, compared trimmed and without case.
MISSING = ("", "-", "nan", "none", "<na>", "na")

_EDGES = r"^[\s 　]+|[\s 　]+$"


def strip(c: Column) -> Column:
    """Remove blanks of any kind, line ends included, from both ends; NULL stays NULL."""
    return F.regexp_replace(c, _EDGES, "")


def fold(c: Column) -> Column:
    """Upper case without outer blanks: the form in which keys are compared."""
    return F.upper(strip(c))


def is_missing(c: Column) -> Column:
    """True for NULL and for every spelling in :data:`MISSING`."""
    return F.coalesce(F.lower(strip(c)).isin(*MISSING), F.lit(True))


def key_or_null(c: Column) -> Column:
    """The folded key, or NULL where the value is missing."""
    return F.when(~is_missing(c), fold(c))
