"""Which packages have arrived: lists and archives of a drop area, joined by package with state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folio_sync.functions.names import (
    ARCHIVE_SUFFIX, BULK_FOLDER, FILE_LIST_SUFFIX, PACKAGE_INFIX, archive_of, package_key,
)

# Tasks get this module's code with the function they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
ARRIVED = "archive_path string, path string, complete boolean"
HELD = "path string, has_list boolean, has_archive boolean, released boolean"


def _files(spark: SparkSession, folder: str, suffix: str, per_batch: int | None) -> DataFrame:
    reader = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("pathGlobFilter", f"*{PACKAGE_INFIX}*{suffix}")
        .option("recursiveFileLookup", "true")
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder).select("path", F.lit(suffix == FILE_LIST_SUFFIX).alias("is_list"))


def _joined(wait_ms: int):
    """State of a package: what has arrived of it. It ends with the second file."""
    import pandas as pd

    def step(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        if state.hasTimedOut:
            path, has_list, has_archive, released = state.get
            state.update((path, has_list, has_archive, True))
            if not released:
                yield pd.DataFrame({"archive_path": [key[0]], "path": [path], "complete": [False]})
            return
        path, has_list, has_archive, released = state.get if state.exists else (None, False, False, False)
        for frame in frames:
            path = path or frame["path"].iloc[0]
            has_list = has_list or bool(frame["is_list"].any())
            has_archive = has_archive or not bool(frame["is_list"].all())
        if has_list and has_archive:
            state.remove()
            yield pd.DataFrame({"archive_path": [key[0]], "path": [path], "complete": [True]})
        elif has_list and not released and wait_ms == 0:
            state.update((path, has_list, has_archive, True))
            yield pd.DataFrame({"archive_path": [key[0]], "path": [path], "complete": [False]})
        else:
            state.update((path, has_list, has_archive, released))
            if has_list and not released:
                state.setTimeoutDuration(wait_ms)

    return step


def arrived_packages(spark: SparkSession, drop_base: str, lists_per_batch: int | None, wait_seconds: int) -> DataFrame:
    """A stream of (archive_path, path, complete), a row for each package that can be read.

    Lists and archives are two file streams. A package is released when both of its files are
    there, or `wait_seconds` after its list if the archive is still absent, which an empty file
    is too; an archive that comes later releases it again. An archive waits for its list
    without end. State is held for incomplete packages alone; contents are not read."""
    folder = f"{drop_base.rstrip('/')}/{BULK_FOLDER}"
    files = _files(spark, folder, FILE_LIST_SUFFIX, lists_per_batch).unionByName(
        _files(spark, folder, ARCHIVE_SUFFIX, None))
    named = files.select(archive_of(F.col("path")).alias("path"), "is_list").withColumn(
        "archive_path", package_key(F.col("path")))
    return named.groupBy("archive_path").applyInPandasWithState(
        _joined(1000 * wait_seconds), ARRIVED, HELD, "append", GroupStateTimeout.ProcessingTimeTimeout)
