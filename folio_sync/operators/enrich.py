"""Join of articles with the lines of their file list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.sources.manifest import last_line_per_article

KEYS = ["archive_path", "pmcid"]


def match_listed(articles: DataFrame, listed: DataFrame) -> DataFrame:
    """Articles with `source_last_updated`, `is_retracted` and the flag `is_listed`.

    An article belongs to a line of its own archive's list; if a list names an id
    twice, the later line counts. Only the narrow list is grouped; the articles
    pass through one join, without text columns if the caller leaves them out.
    """
    lines = last_line_per_article(
        listed.select(
            *KEYS, F.col("last_updated").alias("source_last_updated"), "is_retracted", "line_order"
        ),
        KEYS,
    ).withColumn("listed", F.lit(True))
    joined = articles.drop("source_last_updated", "is_retracted").join(lines, KEYS, "left")
    return joined.withColumn("is_listed", F.coalesce("listed", F.lit(False))).drop("listed")


def split_listed(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listed articles, unlisted articles)."""
    return (
        matched.where("is_listed").drop("is_listed"),
        matched.where(~F.col("is_listed")).drop(
            "is_listed", "source_last_updated", "is_retracted"
        ),
    )


def enrich(articles: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listed articles with their list's columns, unlisted articles)."""
    return split_listed(match_listed(articles, listed))


def articles_of_failed(articles: DataFrame, failed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles of usable archives, articles of failed ones)."""
    keys = failed.select("archive_path").distinct()
    return (
        articles.join(keys, "archive_path", "left_anti"),
        articles.join(keys, "archive_path", "left_semi"),
    )
