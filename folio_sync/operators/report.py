"""Lookups and counts over the corpus tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    metadata: DataFrame,
    pmid: int | None = None,
    doi: str | None = None,
    published_from: dt.date | None = None,
    published_until: dt.date | None = None,
) -> DataFrame:
    """Articles by id or by publication date; the conditions reach the Parquet scan."""
    out = metadata
    if pmid is not None:
        out = out.where(F.col("pmid") == pmid)
    if doi is not None:
        out = out.where(F.col("doi") == doi)
    if published_from is not None:
        out = out.where(F.col("publication_date") >= F.lit(published_from))
    if published_until is not None:
        out = out.where(F.col("publication_date") <= F.lit(published_until))
    return out


def corpus_report(metadata: DataFrame, content: DataFrame) -> DataFrame:
    """One row of counts over both tables; each table is scanned once, for few columns."""
    articles = metadata.agg(
        F.count("*").alias("n_articles"),
        F.count_if("is_retracted").alias("n_retracted"),
        F.count("pmid").alias("n_with_pmid"),
        F.count("doi").alias("n_with_doi"),
        F.count("source_last_updated").alias("n_with_source_time"),
        F.sum(F.size("contributors")).alias("n_contributors"),
    )
    texts = content.agg(
        F.struct(
            F.count("*").alias("n_contents"),
            F.count("body_text").alias("n_with_body"),
        )
    )
    return articles.withColumn("texts", texts.scalar()).select(*articles.columns, "texts.*")
