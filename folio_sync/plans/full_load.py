"""Full load: manifest to archives to the two corpus tables, replacing what was there."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.functions.names import resolve
from folio_sync.operators.audit import read_sidecars
from folio_sync.operators.enrich import match_listed, split_listed
from folio_sync.operators.merge import newest_per_key
from folio_sync.operators.quality import require_unique
from folio_sync.operators.retract import apply_retractions
from folio_sync.plans.publish import publish
from folio_sync.plans.staging import (
    ROW, materialize, now_utc, stage_archives, texts_of, unlisted_rejects, write_rejects,
)
from folio_sync.sources import corpus
from folio_sync.sources.manifest import articles_per_archive, read_manifest


def full_load(
    spark: SparkSession,
    root: str,
    manifest_paths: str | list[str],
    archive_base: str,
    published: DataFrame | None = None,
    verify_sidecars: bool = True,
    on_duplicate: str = "error",
    retractions: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
) -> int:
    """Load every listed article and return the run's id.

    `published` holds the archives' digests (`archive_path` and `sidecar_text` or
    `etag`); without it the digest files below `archive_base` are read, unless
    `verify_sidecars` is false, and an archive without one is taken as it is. Archives that are unreadable or do not match are left out and
    recorded under `<root>/rejects`. A repeated `pmcid` is an error unless
    `on_duplicate` is `latest`. The old tables stay visible until the new ones are
    complete. Retraction lists are not part of a full load unless given. `run_ts` is
    the time to record instead of the present.
    """
    fixed_ts, run_ts = run_ts, run_ts or now_utc()
    corpus.validate(spark, root)
    run_id = corpus.start_run(spark, root, "FULL", run_ts)
    metrics: dict[str, int] = {"archives_processed": 0, "total_records_loaded": 0}
    try:
        listed, list_rejects = read_manifest(spark, manifest_paths)
        listed = materialize(spark, listed.withColumnRenamed("file_path", "archive_path"), "manifest")
        archives = materialize(
            spark,
            articles_per_archive(listed, "archive_path").withColumn(
                "location", resolve(F.col("archive_path"), archive_base)
            ),
            "archives",
        )
        n_archives = archives.count()
        if published is None and verify_sidecars:
            published = read_sidecars(spark, [archive_base], base=archive_base)
        staged = stage_archives(spark, archives, published)

        matched = materialize(spark, match_listed(staged.articles, listed), "matched")
        enriched, unlisted = split_listed(matched)
        if on_duplicate == "latest":
            chosen = newest_per_key(enriched, ["pmcid"], ROW)
        else:
            require_unique(enriched, ["pmcid"], "the full load")
            chosen = enriched
        metadata = chosen.withColumn("sync_timestamp", F.lit(run_ts))
        if retractions is not None:
            metadata = apply_retractions(metadata, retractions, run_ts).drop("changed")
        n_failed = staged.failed.count()
        metrics = {
            "archives_processed": n_archives - n_failed,
            "archives_failed": n_failed,
            "total_records_loaded": chosen.count(),
            "rejects": write_rejects(
                spark, root, run_id, [list_rejects, staged.rejects, unlisted_rejects(unlisted)]
            ),
        }
        publish(spark, root, run_id, "replace", metadata, texts_of(staged, spark, chosen))
    except Exception:
        corpus.end_run(spark, root, run_id, "FAILED", fixed_ts or now_utc(), metrics)
        raise
    corpus.end_run(spark, root, run_id, "SUCCESS", fixed_ts or now_utc(), metrics)
    return run_id
