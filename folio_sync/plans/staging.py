"""Steps the full and the delta load share: archives to staged articles."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync import schemas
from folio_sync.operators.audit import audit_archives, failed_archives
from folio_sync.operators.extract import extract_articles, good_articles, rejected_articles
from folio_sync.session import freed_shuffles, scratch_path
from folio_sync.sources.archives import archive_status, expand_archives
from folio_sync.sources.load import staging_union

# Identifies one article of the staged extraction.
ROW = ["archive_path", "member_name", "article_pos"]
TEXTS = ("raw_jats_xml", "body_text")

# Large archives get a task each; of millions of small ones a task takes several.
ARCHIVE_TASKS_PER_CORE = 32


@dataclass
class Staged:
    """A written extraction: `articles` without texts, `texts` with them."""

    path: str
    articles: DataFrame
    texts: DataFrame
    failed: DataFrame
    rejects: DataFrame


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared scratch folder and read it back.

    This cuts its lineage, and the planner knows the result's true size when it
    chooses between broadcasting and sorting.
    """
    path = scratch_path(spark, label)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _members(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """Members of the archives, with the work of parsing them in even parts.

    An archive can only be unpacked by one task. Where one holds more articles than
    an even share per core, its members move on to other tasks before they are
    parsed; all other archives are parsed where they were unpacked, without a shuffle.
    """
    cores = spark.sparkContext.defaultParallelism
    total = archives.agg(F.sum("n_articles")).first()[0] or 0
    is_large = F.col("n_articles") * cores > total
    counts = archives.agg(
        F.count_if(is_large).alias("large"), F.count_if(~is_large).alias("small")
    ).first()
    parts = []
    for chosen, count, spread in (
        (is_large, counts.large, 2 * cores), (~is_large, counts.small, None),
    ):
        if count or not parts:
            tasks = min(max(count, 1), ARCHIVE_TASKS_PER_CORE * cores)
            parts.append(expand_archives(archives.where(chosen), tasks, spread))
    return staging_union(parts)


def stage_archives(
    spark: SparkSession, archives: DataFrame, published: DataFrame | None = None
) -> Staged:
    """Unpack, parse and write the archives in (`archive_path`, `location`, `n_articles`), once.

    Everything after it reads the written columns it needs: the joins see no text,
    and the content table is copied from `texts` without a shuffle.
    """
    members = _members(spark, archives)
    path = scratch_path(spark, "extracted")
    # A copy of the rejected texts alone, so that reporting them reads no good ones.
    extracted = extract_articles(members, report_empty=True)
    no_article = F.col("member_name").isNotNull() & F.col("raw_jats_xml").isNull()
    extracted = extracted.withColumn(
        "reject_reason",
        F.when(F.col("member_error").isNotNull(), F.lit("undecodable"))
        .when(no_article, F.lit("no_article"))
        .otherwise(F.col("reject_reason")),
    ).withColumn(
        "reject_payload",
        F.when(F.col("reject_reason").isNotNull(), F.coalesce("raw_jats_xml", "member_error")),
    )
    with freed_shuffles(spark):
        extracted.write.parquet(path)
    written = spark.read.schema(extracted.schema).parquet(path)

    status = archive_status(written)
    audited = (
        audit_archives(status, published) if published is not None
        else status.withColumn("status", F.lit("unverified"))
    )
    failed = materialize(
        spark, failed_archives(audited).select("archive_path", "reason", "archive_error"), "failed"
    )
    usable = good_articles(written).join(
        failed.select("archive_path"), "archive_path", "left_anti"
    )
    bad_articles = rejected_articles(written).select(
        F.lit("article").alias("stage"),
        F.concat_ws("/", "archive_path", "member_name").alias("source"),
        F.col("pmcid").alias("key"),
        F.col("reject_reason").alias("reason"),
        F.col("reject_payload").alias("payload"),
    )
    bad_archives = failed.select(
        F.lit("archive").alias("stage"),
        F.col("archive_path").alias("source"),
        F.lit(None).cast("string").alias("key"),
        "reason",
        F.col("archive_error").alias("payload"),
    )
    return Staged(
        path=path,
        articles=usable.drop(
            *TEXTS, "member_error", "archive_md5", "archive_error", "reject_reason", "reject_payload"
        ),
        texts=usable.select(*ROW, "pmcid", *TEXTS),
        failed=failed,
        rejects=bad_articles.unionByName(bad_archives),
    )


def unlisted_rejects(unlisted: DataFrame) -> DataFrame:
    return unlisted.select(
        F.lit("article").alias("stage"),
        F.concat_ws("/", "archive_path", "member_name").alias("source"),
        F.col("pmcid").alias("key"),
        F.lit("unlisted").alias("reason"),
        F.lit(None).cast("string").alias("payload"),
    )


def texts_of(staged: Staged, spark: SparkSession, chosen: DataFrame) -> DataFrame:
    """Texts of the chosen articles.

    Nearly all staged articles are chosen, so the few others are found by a join
    of keys, written, and taken out of the text scan; the text itself is not
    shuffled unless the exceptions outgrow the broadcast threshold.
    """
    others = materialize(
        spark, staged.articles.select(*ROW).join(chosen.select(*ROW), ROW, "left_anti"), "others"
    )
    return staged.texts.join(others, ROW, "left_anti")


def write_rejects(spark: SparkSession, root: str, run_id: int, parts: list[DataFrame]) -> int:
    """Keep what a run left out, under `<root>/rejects/run=<id>`; returns the count."""
    rejects = parts[0]
    for part in parts[1:]:
        rejects = rejects.unionByName(part)
    path = f"{root.rstrip('/')}/rejects/run={run_id}"
    schemas.conform(rejects, schemas.REJECTS).write.mode("append").parquet(path)
    return spark.read.schema(schemas.REJECTS).parquet(path).count()
