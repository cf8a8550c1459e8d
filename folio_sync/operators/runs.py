"""Queries over the run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_history(events: DataFrame, key: str = "run_id", order: str = "event_seq") -> DataFrame:
    """One row per run: for each column the last value that was set.

    An aggregate with partial results, so a run with many rows does not meet in
    one task before it is reduced.
    """
    values = [c for c in events.columns if c not in (key, order)]
    return events.groupBy(key).agg(*[
        F.expr(f"max_by(`{c}`, `{order}`) FILTER (WHERE `{c}` IS NOT NULL)").alias(c)
        for c in values
    ])


def last_successful_run(history: DataFrame, run_type: str = "DELTA") -> DataFrame:
    """At most one row: end time and last file of the newest successful run of a type."""
    return (
        history.where((F.col("status") == "SUCCESS") & (F.col("run_type") == run_type))
        .orderBy(F.col("end_time").desc(), F.col("run_id").desc())
        .limit(1)
    )


def watermark(history: DataFrame) -> DataFrame:
    """At most one row: where a delta load continues.

    That is the newest successful DELTA run and, only if there is none, the newest
    successful FULL run.
    """
    preference = F.when(F.col("run_type") == "DELTA", 0).otherwise(1)
    return (
        history.where((F.col("status") == "SUCCESS") & F.col("run_type").isin("DELTA", "FULL"))
        .orderBy(preference, F.col("end_time").desc(), F.col("run_id").desc())
        .limit(1)
    )


def metric(name: str):
    """A numeric member of a run's metrics map."""
    return F.try_element_at(F.col("metrics"), F.lit(name))
