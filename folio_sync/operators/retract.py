"""Retractions and deletions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "pmcid"


def retraction_hits(metadata: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """Rows a retraction list changes: listed and not yet flagged."""
    return metadata.where(~F.col("is_retracted")).join(ids.select(key), key, "left_semi")


def apply_retractions(
    metadata: DataFrame, ids: DataFrame, run_ts: dt.datetime | None = None, key: str = KEY
) -> DataFrame:
    """The table after flagging the listed articles, plus `changed` for the rows touched.

    Ids the table does not hold are ignored; flagged rows stay as they are, so a
    second application changes nothing.
    """
    listed = ids.select(key).distinct().withColumn("is_listed", F.lit(True))
    changed = F.coalesce(F.col("is_listed"), F.lit(False)) & ~F.col("is_retracted")
    columns = []
    for c in metadata.columns:
        if c == "is_retracted":
            columns.append((F.col(c) | F.col("changed")).alias(c))
        elif c == "sync_timestamp" and run_ts is not None:
            columns.append(F.when(F.col("changed"), F.lit(run_ts)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    joined = metadata.join(listed, key, "left").withColumn("changed", changed)
    return joined.select(*columns, "changed")


def retraction_counts(metadata: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """One row: distinct ids supplied, rows changed, ids the table does not hold."""
    listed = ids.select(key).distinct()
    flags = metadata.select(key, "is_retracted")
    return listed.join(flags, key, "left").agg(
        F.count("*").alias("supplied"),
        F.count_if(~F.col("is_retracted")).alias("changed"),
        F.count_if(F.col("is_retracted").isNull()).alias("unknown"),
    )


def cascade_delete(
    child: DataFrame, deleted: DataFrame, key: str = KEY, deleted_key: str | None = None
) -> DataFrame:
    """Child rows whose parent is not among the deleted keys."""
    gone = deleted.select(F.col(deleted_key or key).alias("gone_key"))
    return child.join(gone, F.col(key) == F.col("gone_key"), "left_anti")
