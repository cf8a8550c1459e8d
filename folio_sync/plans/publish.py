"""Writing articles to the corpus: each call makes one version and publishes it.

Metadata and texts are DataFrames of the corpus schemas, from any source. The load
jobs are built on the same steps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync import schemas
from folio_sync.operators.merge import admitted, superseded_rows
from folio_sync.operators.quality import (
    QualityError, orphans, require_clean, require_unique,
)
from folio_sync.operators.retract import retraction_hits
from folio_sync.plans.staging import materialize
from folio_sync.sources import corpus

CHECKED = ["pmcid", "doi", "is_retracted", "sync_timestamp"]


def publish(
    spark: SparkSession,
    root: str,
    run_id: int,
    kind: str,
    metadata: DataFrame,
    content: DataFrame | None,
    old_metadata: DataFrame | None = None,
    old_content: DataFrame | None = None,
    last_file: str | None = None,
    based_on: list[int] | None = None,
) -> int:
    """Write one version of both tables with the keys it replaces, then commit it.

    `based_on` are the live versions from which the rows were computed."""
    require_clean(metadata.select(*CHECKED), corpus.METADATA)
    version = corpus.next_version()
    corpus.write_version(spark, root, corpus.METADATA, version, metadata, old_metadata)
    if content is not None:
        corpus.write_version(spark, root, corpus.CONTENT, version, content, old_content)
    corpus.commit(spark, root, run_id, version, kind, last_file, based_on)
    return version


def _require_pairs(metadata: DataFrame, content: DataFrame, known: DataFrame | None = None) -> None:
    """Unique keys on both sides, and metadata for every text."""
    require_unique(metadata.select("pmcid"), ["pmcid"], corpus.METADATA)
    require_unique(content.select("pmcid"), ["pmcid"], corpus.CONTENT)
    parents = metadata.select("pmcid")
    if known is not None:
        parents = parents.unionByName(known.select("pmcid"))
    lost = orphans(content.select("pmcid"), parents, "pmcid").limit(5).collect()
    if lost:
        raise QualityError(f"Texts without metadata: {sorted(r.pmcid for r in lost)}")


def replace_articles(
    spark: SparkSession, root: str, run_id: int, metadata: DataFrame, content: DataFrame
) -> int:
    """Put these articles in place of all others; the history stays."""
    _require_pairs(metadata, content)
    return publish(spark, root, run_id, "replace", metadata, content)


def append_articles(
    spark: SparkSession, root: str, run_id: int, metadata: DataFrame, content: DataFrame
) -> int:
    """Add new articles; a key that is already present is an error."""
    versions = corpus.live_versions(spark, root)
    known = corpus.read_table(
        spark, root, corpus.METADATA, versions, corpus.touched_buckets(spark, root, metadata)).select("pmcid")
    _require_pairs(metadata, content, known)
    clash = superseded_rows(known, metadata).limit(5).collect()
    if clash:
        raise QualityError(f"Articles already present: {sorted(r.pmcid for r in clash)}")
    return publish(spark, root, run_id, "append", metadata, content, based_on=versions)


def take_updates(
    spark: SparkSession, root: str, staged: DataFrame, sticky_retractions: bool = False,
    versions: list[int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(staged rows the guard admits, the live rows they replace), both written.

    Of the table the buckets of the staged keys are scanned once, for narrow columns, and reduced
    to these keys.
    """
    staged = materialize(spark, staged, "staged")
    touched = materialize(
        spark,
        superseded_rows(
            corpus.read_table(
                spark, root, corpus.METADATA, versions, corpus.touched_buckets(spark, root, staged)).select(
                "pmcid", "source_last_updated", "is_retracted", corpus.VERSION
            ),
            staged,
        ),
        "touched",
    )
    taken = admitted(touched, staged)
    if sticky_retractions:
        flagged = touched.where("is_retracted").select("pmcid", F.lit(True).alias("was"))
        taken = taken.join(flagged, "pmcid", "left").withColumn(
            "is_retracted", F.col("is_retracted") | F.coalesce("was", F.lit(False))
        ).drop("was")
    taken = materialize(spark, taken, "taken")
    return taken, superseded_rows(touched, taken)


def replaced_texts(
    spark: SparkSession, root: str, texts: DataFrame, versions: list[int] | None = None
) -> DataFrame:
    """Keys of the live texts that these replace, from the buckets that can hold them."""
    live = corpus.read_table(
        spark, root, corpus.CONTENT, versions, corpus.touched_buckets(spark, root, texts)).select("pmcid", corpus.VERSION)
    return superseded_rows(live, texts)


def upsert_articles(
    spark: SparkSession,
    root: str,
    run_id: int,
    metadata: DataFrame,
    content: DataFrame,
    last_file: str | None = None,
    guard_content: bool = False,
    sticky_retractions: bool = False,
) -> int:
    """Merge articles into the corpus and advance the run's marker, in one commit.

    Metadata is replaced where it is newer, texts always unless `guard_content`.
    """
    versions = corpus.live_versions(spark, root)
    known = corpus.read_table(spark, root, corpus.METADATA, versions, corpus.touched_buckets(spark, root, content))
    _require_pairs(metadata, content, known)
    taken, old = take_updates(spark, root, metadata, sticky_retractions, versions)
    if guard_content:
        content = content.join(taken.select("pmcid"), "pmcid", "left_semi")
    return publish(
        spark, root, run_id, "append", taken, content, old,
        replaced_texts(spark, root, content.select("pmcid"), versions), last_file, versions,
    )


def commit_retractions(
    spark: SparkSession, root: str, run_id: int, ids: DataFrame, run_ts: dt.datetime
) -> int:
    """Flag the listed articles as one commit and return how many changed.

    The ids are matched against the flag column alone, in their buckets; only the versions and
    buckets that hold a hit are then read in full.
    """
    ids = materialize(spark, ids.select("pmcid"), "retracted")
    buckets, versions = corpus.touched_buckets(spark, root, ids), corpus.live_versions(spark, root)
    current = corpus.read_table(spark, root, corpus.METADATA, versions, buckets)
    hits = materialize(
        spark,
        retraction_hits(current.select("pmcid", "is_retracted", corpus.VERSION), ids).select("pmcid", corpus.VERSION),
        "hits",
    )
    changed = hits.count()
    if changed:
        holding = [row[0] for row in hits.select(corpus.VERSION).distinct().collect()]  # some of the live versions
        found = corpus.read_table(
            spark, root, corpus.METADATA, versions, corpus.touched_buckets(spark, root, hits), holding)
        rows = found.join(hits, ["pmcid", corpus.VERSION], "left_semi").drop(corpus.VERSION).withColumns({
            "is_retracted": F.lit(True), "sync_timestamp": F.lit(run_ts),
        })
        publish(spark, root, run_id, "append", rows, None, hits, based_on=versions)
    return changed
