"""How the given tables stand in for a corpus.

documents are articles (doc_id the id, source the archive, text the body), labels
are file lists and retraction lists, events are runs and dated packages, orders
and lineitem are a parent and a child table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Even parts for parsing, which costs far more than moving the text. The parts of a scan
    do not tell: one task reads a whole row group, and the others of a file get nothing."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(2 * cores, df.rdd.getNumPartitions()), key)


def pmcid(number: Column | str, prefix: str = "PMC") -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"))


def clock(seconds: Column) -> Column:
    """A timestamp some seconds after the epoch of the derived data."""
    return F.timestamp_seconds(F.lit(EPOCH) + seconds)


def seconds(column: str) -> Column:
    return F.unix_seconds(F.col(column)) - F.lit(EPOCH)


def time_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def escape_xml(c: Column) -> Column:
    for raw, shown in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def as_metadata(documents: DataFrame) -> DataFrame:
    """Documents as article rows; the language `de` has no source time."""
    return documents.select(
        pmcid("doc_id").alias("pmcid"),
        F.col("lang").alias("title"),
        F.when(F.col("lang") != "de", clock(F.col("n_chars"))).alias("source_last_updated"),
        (F.col("source") == "src0").alias("is_retracted"),
    )


AS_METADATA = """
    SELECT 'PMC' || doc_id AS pmcid, lang AS title,
           CASE WHEN lang <> 'de' THEN n_chars END AS updated,
           source = 'src0' AS is_retracted
    FROM documents"""
