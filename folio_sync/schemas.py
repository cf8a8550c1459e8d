"""Schemas of the corpus tables and of the DataFrames passed between operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names, order and types of the corpus columns (fixed values).
JOURNAL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("issn", T.StringType()),
    T.StructField("publisher", T.StringType()),
])
CONTRIBUTOR = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("affiliation", T.StringType()),
    T.StructField("orcid", T.StringType()),
])
LICENSE = T.StructType([
    T.StructField("license_type", T.StringType()),
    T.StructField("url", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("pmcid", T.StringType(), False),
    T.StructField("pmid", T.LongType()),
    T.StructField("doi", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract_text", T.StringType()),
    T.StructField("publication_date", T.DateType()),
    T.StructField("journal_info", JOURNAL),
    T.StructField("contributors", T.ArrayType(CONTRIBUTOR)),
    T.StructField("license_info", LICENSE),
    T.StructField("is_retracted", T.BooleanType(), False),
    T.StructField("source_last_updated", T.TimestampType()),
    T.StructField("sync_timestamp", T.TimestampType(), False),
])
CONTENT = T.StructType([
    T.StructField("pmcid", T.StringType(), False),
    T.StructField("raw_jats_xml", T.StringType()),
    T.StructField("body_text", T.StringType()),
])
HISTORY = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("run_type", T.StringType(), False),
    T.StructField("start_time", T.TimestampType(), False),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("last_file_processed", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
])
# One appended row per change of a run; `HISTORY` is the fold of these rows.
# A row with a commit number publishes that table version in the same write.
HISTORY_EVENTS = T.StructType(
    [T.StructField("event_seq", T.LongType(), False)]
    + [T.StructField(f.name, f.dataType, f.name != "run_id") for f in HISTORY]
    + [
        T.StructField("commit_version", T.LongType()),
        T.StructField("commit_kind", T.StringType()),
        T.StructField("batch_key", T.StringType()),
    ]
)
SUPERSEDED = T.StructType([
    T.StructField("pmcid", T.StringType(), False),
    T.StructField("old_version", T.LongType(), False),
])
MANIFEST = T.StructType([
    T.StructField("file_path", T.StringType(), False),
    T.StructField("pmcid", T.StringType(), False),
    T.StructField("pmid", T.StringType()),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("is_retracted", T.BooleanType(), False),
])
REJECTS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("payload", T.StringType()),
])

# One appended row per attempt of the feed at a package that failed, or no longer does.
PACKAGE_ATTEMPTS = T.StructType([
    T.StructField("archive_path", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("run_id", T.LongType(), False),
    T.StructField("attempts", T.IntegerType(), False),
    T.StructField("reason", T.StringType()),
    T.StructField("recorded", T.TimestampType(), False),
])

TABLES = {
    "articles_metadata": METADATA,
    "articles_content": CONTENT,
    "sync_history": HISTORY,
}

# Column lengths of the corpus tables (fixed values).
MAX_LENGTH = {
    "articles_metadata": {"pmcid": 20, "doi": 255},
    "articles_content": {"pmcid": 20},
    "sync_history": {"run_type": 10, "status": 20, "last_file_processed": 255},
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns, in its order and types; absent ones become NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])
