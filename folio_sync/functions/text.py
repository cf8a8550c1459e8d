"""Column expressions for text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_space(c: Column) -> Column:
    """Every run of Unicode white space becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_space(c: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def delimited_text(c: Column) -> Column:
    r"""Escape backslash, tab and newline; NULL becomes `\N`."""
    escaped = c
    for raw, shown in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    return F.coalesce(escaped, F.lit("\\N"))


def undelimited_text(c: Column) -> Column:
    """Undo `delimited_text`. What lies between doubled backslashes is decoded alone."""
    def decode(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n"))

    parts = F.transform(F.split(c, r"\\\\", -1), decode)
    return F.when(c != "\\N", F.array_join(parts, "\\"))
