"""Column expressions for archive names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The publisher's naming rules and area folders.
PACKAGE_NAME = r".+\.incr\.([0-9]{4}-[0-9]{2}-[0-9]{2})\.tar\.gz$"
PACKAGE_INFIX = ".incr."
PACKAGE_FILES, PACKAGE_LISTS = "*.incr.*{.tar.gz,.filelist.csv}", "*.incr.*.filelist.csv"
ARCHIVE_SUFFIX = ".tar.gz"
FILE_LIST_SUFFIX = ".filelist.csv"
BULK_FOLDER = "oa_bulk"
AREAS = ("oa_comm", "oa_noncomm", "oa_other")
CONTENT_FOLDER = "xml"
MEMBER_SUFFIX = r"\.n?xml$"


def area_folders(base: str) -> list[str]:
    """The three package folders below a drop area."""
    return [f"{base.rstrip('/')}/{BULK_FOLDER}/{area}/{CONTENT_FOLDER}" for area in AREAS]


def plain_path(uri: Column) -> Column:
    """A path without the percent codes of a file's metadata column."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def package_day(path: Column) -> Column:
    """The date in a package name, NULL for any other name."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, PACKAGE_NAME, 1), F.lit("")), "yyyy-MM-dd")


def file_list_of(archive_path: Column) -> Column:
    return F.replace(archive_path, F.lit(ARCHIVE_SUFFIX), F.lit(FILE_LIST_SUFFIX))


def archive_of(path: Column) -> Column:
    """The archive that a file list, or an archive itself, belongs to."""
    return F.when(F.endswith(path, F.lit(FILE_LIST_SUFFIX)), F.concat(
        F.substring(path, F.lit(1), F.length(path) - len(FILE_LIST_SUFFIX)), F.lit(ARCHIVE_SUFFIX)
    )).otherwise(path)


def area_of(path: Column) -> Column:
    """The area folder in a path, NULL when there is none."""
    return F.nullif(F.regexp_extract(path, f"(?:^|/)({'|'.join(AREAS)})/", 1), F.lit(""))


def area_rank(path: Column) -> Column:
    """Position of the area in the publisher's order; unknown areas come last."""
    position = F.array_position(F.array(*[F.lit(area) for area in AREAS]), area_of(path))
    return (F.coalesce(F.nullif(position, F.lit(0)), F.lit(len(AREAS) + 1)) - 1).cast("int")


def package_key(path: Column) -> Column:
    """The name a package is remembered by: its path from the bulk folder on."""
    inside = F.regexp_extract(path, f"(?:^|/)({BULK_FOLDER}/.*)$", 1)
    return F.coalesce(F.nullif(inside, F.lit("")), base_name(path))


def resolve(path: Column, base: str) -> Column:
    """A manifest path below a base; a path with a scheme stays as it is."""
    return F.when(path.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:/"), path).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(path, F.lit("/")))
    )
