"""Appending staged rows to any Parquet table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from folio_sync.sources.manifest import path_exists
from folio_sync.operators.quality import QualityError, require_unique


def staging_union(batches: list[DataFrame]) -> DataFrame:
    """All rows of several staged batches; duplicates stay and columns match by name."""
    return reduce(DataFrame.unionByName, batches)


def read_batches(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """All rows of many staged Parquet batches in one scan; absent ones are skipped."""
    present = [path for path in paths if path_exists(spark, path)]
    return spark.read.schema(schema).parquet(*present) if present else spark.createDataFrame([], schema)


def append_rows(
    rows: DataFrame, target: DataFrame, path: str, key: str | None = None
) -> None:
    """Append rows to the Parquet table at `path`, whose present rows are `target`.

    With `key`, a key that is repeated or already present is an error, and nothing
    is written.
    """
    if key is not None:
        require_unique(rows, [key], "the appended rows")
        clash = rows.select(key).join(target.select(key), key, "left_semi").limit(5).collect()
        if clash:
            raise QualityError(f"Keys already present: {sorted(str(r[0]) for r in clash)}")
    rows.select(*target.columns).write.mode("append").parquet(path)
