"""Integrity of archives against published digests."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.functions.names import package_key, plain_path

# Fixed pattern of a digest file's text.
SIDECAR_DIGEST = r"=\s*([a-f0-9]{32})"
SIDECAR_SUFFIX = ".md5"
FAILED = ("mismatch", "unparsable")
UNREADABLE = "unreadable"


def read_sidecars(spark: SparkSession, folders: list[str], base: str | None = None) -> DataFrame:
    """(archive_path, sidecar_text) of the digest files in and below some folders.

    Archives are named as packages are or, with `base`, by their path below it, as
    in a manifest.
    """
    try:
        files = (
            spark.read.option("pathGlobFilter", "*" + SIDECAR_SUFFIX)
            .option("recursiveFileLookup", True)
            .text(folders, wholetext=True)
        )
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise
        return spark.createDataFrame([], "archive_path string, sidecar_text string")
    path = F.regexp_replace(plain_path(F.col("_metadata.file_path")), r"\.md5$", "")
    if base is None:
        name = package_key(path)
    else:
        plain_base = re.sub("^file:/+", "/", base).rstrip("/") + "/"
        name = F.substring_index(path, plain_base, -1)
    return files.select(name.alias("archive_path"), F.col("value").alias("sidecar_text"))


def audit_archives(archives: DataFrame, published: DataFrame) -> DataFrame:
    """`archive_path`, `archive_md5` and the published digest's verdict `status`.

    `published` has `sidecar_text` or `etag` per archive. An archive without a
    published digest is unverified, and so is one whose tag is that of a multipart
    upload; a digest file without a digest is unparsable.
    """
    joined = archives.join(published, "archive_path", "left")
    if "sidecar_text" in published.columns:
        digest = F.nullif(F.regexp_extract("sidecar_text", SIDECAR_DIGEST, 1), F.lit(""))
        absent = F.col("sidecar_text").isNull()
    else:
        digest = F.replace(F.col("etag"), F.lit('"'), F.lit(""))
        absent = digest.isNull() | (digest == "") | F.contains(digest, F.lit("-"))
    status = (
        F.when(absent, F.lit("unverified"))
        .when(digest.isNull(), F.lit("unparsable"))
        .when(digest == F.col("archive_md5"), F.lit("verified"))
        .otherwise(F.lit("mismatch"))
    )
    return joined.select(*archives.columns, status.alias("status"))


def failed_archives(audited: DataFrame) -> DataFrame:
    """Archives that could not be read or do not match their digest, with the reason."""
    reason = F.when(F.col("archive_error").isNotNull(), F.lit(UNREADABLE)).when(
        F.col("status").isin(*FAILED), F.col("status")
    )
    return audited.withColumn("reason", reason).where(F.col("reason").isNotNull())
