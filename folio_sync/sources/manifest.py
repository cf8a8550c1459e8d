"""CSV manifests, package file lists and retraction lists."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.functions.clocks import parse_timestamp
from folio_sync.functions.names import (
    ARCHIVE_SUFFIX, FILE_LIST_SUFFIX, package_key, plain_path,
)
from folio_sync.functions.text import empty_to_null

# Fixed values of the publisher's files.
FILE, ACCESSION, PMID, UPDATED, RETRACTED = (
    "File", "Accession ID", "PMID", "Last Updated", "Retracted",
)
WANTED = (FILE, ACCESSION, PMID, UPDATED, RETRACTED)
TRUE_WORDS = ("true", "y", "yes")
RETRACTION_HEADER = "PMCID"

# Doubled quotes stand for a quote, as in any CSV written to RFC 4180.
CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


def _is_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def _headers(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[list[int]], int]:
    """(header_file, `positions` of the wanted columns, -1 where absent) per file with a header, the
    different positions, and the widest header's number of columns. The driver gets the different
    header lines, not the files."""
    lines = spark.read.text(paths).where("_metadata.file_block_start = 0").select(
        plain_path(F.col("_metadata.file_path")).alias("header_file"), "value",
        F.monotonically_increasing_id().alias("line"),
    )
    headers = lines.where(F.length("value") > 0).groupBy("header_file").agg(
        F.min_by("value", "line").alias("header")
    )
    layouts, width = [], 0
    for row in headers.select("header").distinct().collect():
        names = [name.strip() for name in next(csv.reader([row.header]))]
        positions = {name: i for i, name in enumerate(names)}  # the last of equal names counts
        layouts.append((row.header, [positions.get(name, -1) for name in WANTED]))
        width = max(width, len(names))
    layout = spark.createDataFrame(layouts, "header string, positions array<int>")
    found = [list(positions) for positions in sorted({tuple(positions) for _, positions in layouts})]
    return headers.join(layout, "header").drop("header"), found, width


def _raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The five text columns of every data line, matched by header name per file.

    All files are one read, as wide as the widest of them. `line_order` orders the
    lines of one file: a file's splits by their offset, then the lines of a split.
    Where all files have their columns in the same places, as is usual, there is no join:
    by the file's name it would bring all lines of a long list to one task.
    """
    headers, layouts, width = _headers(spark, paths) if paths else (None, [], 0)
    if not width:
        order = "struct<file:string,block:bigint,line:bigint>"
        texts = ", ".join(f"`{name}` string" for name in WANTED)
        return spark.createDataFrame([], f"{texts}, list_path string, line_order {order}")
    columns = [f"c{i}" for i in range(width)]
    lines = spark.read.options(**CSV_OPTIONS).option("header", True).schema(
        ", ".join(f"{c} string" for c in columns)).csv(paths).select(
        F.array(*columns).alias("values"),
        plain_path(F.col("_metadata.file_path")).alias("list_path"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("line_order"),
    )
    if len(layouts) == 1:
        places = [F.lit(at) for at in layouts[0]]
    else:
        lines = lines.join(headers, F.col("list_path") == F.col("header_file"))
        places = [F.col("positions")[i] for i in range(len(WANTED))]
    return lines.select(
        *(F.get("values", at).alias(name) for at, name in zip(places, WANTED)), "list_path", "line_order",
    )


def parse_manifest(lines: DataFrame) -> DataFrame:
    """Typed manifest columns plus `reject_reason` from the raw text columns."""
    updated = empty_to_null(F.col(UPDATED))
    parsed = parse_timestamp(updated)
    others = [c for c in lines.columns if c not in (FILE, ACCESSION, PMID, UPDATED, RETRACTED)]
    reason = F.when(
        ~F.coalesce((F.length(FILE) > 0) & (F.length(F.col(ACCESSION)) > 0), F.lit(False)),
        F.lit("missing_field"),
    ).when(updated.isNotNull() & parsed.isNull(), F.lit("bad_timestamp"))
    return lines.select(
        F.col(FILE).alias("file_path"),
        F.col(ACCESSION).alias("pmcid"),
        empty_to_null(F.col(PMID)).alias("pmid"),
        parsed.alias("last_updated"),
        F.lower(F.coalesce(F.col(RETRACTED), F.lit(""))).isin(*TRUE_WORDS).alias("is_retracted"),
        *others,
        F.col(UPDATED).alias("last_updated_text"),
        reason.alias("reject_reason"),
    )


def split_manifest(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good manifest rows, and the rejects in the common shape."""
    good = parsed.where(F.col("reject_reason").isNull()).drop("reject_reason", "last_updated_text")
    bad = parsed.where(F.col("reject_reason").isNotNull()).select(
        F.lit("manifest").alias("stage"),
        F.col("list_path").alias("source"),
        F.col("pmcid").alias("key"),
        F.col("reject_reason").alias("reason"),
        F.concat_ws(",", "file_path", "pmcid", "last_updated_text").alias("payload"),
    )
    return good, bad


def read_manifest(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(manifest, rejects) of one or many CSV files with a header line.

    Besides the manifest columns a row carries `list_path` and `line_order`.
    A missing file is an empty list.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    present = [path for path in paths if path_exists(spark, path)]
    return split_manifest(parse_manifest(_raw_lines(spark, present)))


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return False
    return True


def read_file_lists(
    spark: SparkSession, file_list_paths: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(lines, rejects) of the file lists of several packages, in one read.

    `archive_path` is the key of the package a line belongs to. A package whose
    file list is missing has no lines.
    """
    folders = sorted({path.rsplit("/", 1)[0] for path in file_list_paths})
    present = set()
    if folders:
        listing = spark.read.format("binaryFile").option(
            "pathGlobFilter", "*" + FILE_LIST_SUFFIX
        ).load(folders)
        asked = spark.createDataFrame([(path,) for path in file_list_paths], "path string")
        present = {row.path for row in listing.select("path").join(asked, "path", "left_semi").collect()}
    paths = [path for path in file_list_paths if path in present]
    lists, rejects = split_manifest(parse_manifest(_raw_lines(spark, paths)))
    key = F.replace(package_key(F.col("list_path")), F.lit(FILE_LIST_SUFFIX), F.lit(ARCHIVE_SUFFIX))
    return lists.withColumn("archive_path", key), rejects


def read_retractions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Distinct `pmcid` values of one-column lists, with or without a header line.

    No id contains the header's name, so dropping it by value equals dropping it
    from the first line. A missing file is an empty list.
    """
    try:
        raw = spark.read.options(**CSV_OPTIONS).schema("pmcid string").csv(paths)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], "pmcid string")
    return raw.where(
        (F.length("pmcid") > 0) & ~F.contains(F.col("pmcid"), F.lit(RETRACTION_HEADER))
    ).distinct()


def articles_per_archive(listed: DataFrame, archive: str = "file_path") -> DataFrame:
    """Number of listed articles per archive."""
    return listed.groupBy(archive).agg(F.count("*").alias("n_articles"))


def last_line_per_article(listed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the line that comes last in the file."""
    values = [c for c in listed.columns if c not in (*keys, "line_order")]
    picked = listed.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col("line_order")).alias("picked")
    )
    return picked.select(*keys, *[F.col(f"picked.{c}").alias(c) for c in values])
