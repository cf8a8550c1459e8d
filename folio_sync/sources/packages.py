"""Discovery of dated update packages in a drop area."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.functions.names import (
    PACKAGE_FILES, PACKAGE_INFIX, archive_of, area_folders, area_rank, file_list_of, package_day, package_key,
)


def list_archives(spark: SparkSession, base: str, glob: str = PACKAGE_FILES) -> DataFrame:
    """Paths, sizes and times of the files in the area folders; no content is read.

    An area folder that cannot be listed is skipped.
    """
    listings = []
    for folder in area_folders(base):
        try:
            listings.append(
                spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
                .select("path", "modificationTime", "length")
            )
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
    if not listings:
        return spark.createDataFrame(
            [], "path string, modificationTime timestamp, length bigint"
        )
    out = listings[0]
    for listing in listings[1:]:
        out = out.unionByName(listing)
    return out


def find_packages(
    listing: DataFrame,
    since: dt.date | dt.datetime | None = None,
    marker: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Update packages among the listed archives and file lists, oldest first.

    Spark's listing leaves empty files out, so an empty archive is only known by its file
    list. A package is named by its archive, whichever of the two is listed.

    Only packages dated strictly after the day of `since` are kept (on or after it
    with `inclusive`). With `marker`, packages up to and including that one are
    dropped; a marker that is not in the listing drops nothing.
    """
    packages = listing.where(F.contains(F.col("path"), F.lit(PACKAGE_INFIX))).select(
        archive_of(F.col("path")).alias("path")
    ).distinct().select(
        package_key(F.col("path")).alias("archive_path"),
        F.col("path").alias("location"),
        package_day(F.col("path")).alias("day"),
        area_rank(F.col("path")).alias("area_rank"),
    ).where(F.col("day").isNotNull())
    if since is not None:
        day = since.date() if isinstance(since, dt.datetime) else since
        packages = packages.where(
            F.col("day") >= F.lit(day) if inclusive else F.col("day") > F.lit(day)
        )
    packages = packages.select(
        "archive_path",
        "location",
        file_list_of(F.col("location")).alias("file_list_path"),
        F.col("day").cast("timestamp").alias("date"),
        F.struct("day", "area_rank", "archive_path").alias("package_order"),
    )
    if marker is not None:
        reached = packages.agg(
            F.max(F.when(F.col("archive_path") == marker, F.col("package_order")))
        ).scalar()
        before_all = F.struct(
            F.to_date(F.lit("0001-01-01")).alias("day"), F.lit(-1).alias("area_rank"),
            F.lit("").alias("archive_path"),
        )
        packages = packages.where(F.col("package_order") > F.coalesce(reached, before_all))
    return packages.orderBy("package_order")
