"""Column expressions for dates and times read from text.

All of them return NULL for text that does not hold a valid value: the session
may run in ANSI mode, where a plain cast would fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the publisher's files.
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z"
DAY_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"


def parse_timestamp(c: Column) -> Column:
    """`2024-01-31 08:00:00`, with or without leading zeros."""
    spaced = F.regexp_replace(c, r"\s+", " ")
    return F.when(c.rlike(TIMESTAMP_TEXT), F.try_to_timestamp(spaced, F.lit("yyyy-M-d H:m:s")))


def parse_day(year: Column, month: Column, day: Column) -> Column:
    """A date from its three parts, as text; NULL when they do not name a day."""
    text = F.concat_ws("-", year, month, day)
    return F.when(
        text.rlike(DAY_TEXT) & (year != "0000"),
        F.try_to_date(text, "yyyy-M-d"),
    )
