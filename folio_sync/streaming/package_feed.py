"""Streaming variant of the delta load: packages as they arrive in the drop area."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folio_sync.operators.runs import watermark
from folio_sync.plans.delta_load import Options, apply_packages
from folio_sync.plans.publish import commit_retractions
from folio_sync.plans.staging import now_utc
from folio_sync.sources import corpus
from folio_sync.sources.packages import find_packages
from folio_sync.streaming.arrivals import arrived_packages

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _since(spark: SparkSession, root: str) -> dt.date | None:
    last = watermark(corpus.read_history(spark, root).where("run_type = 'FULL'")).withColumn(
        "end_day", F.to_date("end_time")).first()
    return last and last.end_day


def _merge(
    spark: SparkSession, root: str, packages: list[Row], options: Options, batch_key: str | None = None,
) -> None:
    """Apply packages as one run, and record which of them failed and which no longer do."""
    now = now_utc()
    run_id = corpus.start_run(spark, root, "DELTA", now)
    try:
        outcome = apply_packages(spark, root, run_id, packages, now, options)
        retracted = commit_retractions(spark, root, run_id, outcome.retracted_ids.distinct(), now)
        corpus.record_packages(spark, root, run_id, packages, outcome.failures, now)
    except Exception:
        corpus.end_run(spark, root, run_id, "FAILED", now_utc())
        raise
    corpus.end_run(spark, root, run_id, "SUCCESS", now_utc(), {
        "archives_processed": outcome.processed,
        "archives_failed": len(outcome.failures),
        "total_articles_upserted": outcome.upserted,
        "total_articles_retracted": retracted,
        "rejects": outcome.rejects,
    }, batch_key=batch_key)


def _due(spark: SparkSession, root: str, max_attempts: int, retry_seconds: int, packages_per_batch: int) -> DataFrame:
    """Paths of failed packages to try again, those that waited longest first."""
    latest = F.lit(now_utc()) - F.make_interval(secs=F.lit(retry_seconds))
    failed = corpus.failed_packages(spark, root).where((F.col("attempts") < max_attempts) & (F.col("recorded") <= latest))
    return failed.orderBy("recorded", "archive_path").limit(packages_per_batch).select("path")


def retry_packages(
    spark: SparkSession, root: str, options: Options | None = None, max_attempts: int = 10, packages_per_batch: int = 100,
) -> int:
    """Try each failed package of the feed once more, oldest failure first; returns how many were tried.

    Those that failed `max_attempts` times are left alone; a larger number takes them up again."""
    options = _for_feed(options)
    waiting = corpus.failed_packages(spark, root).where(F.col("attempts") < max_attempts).select("path")
    packages = find_packages(waiting).collect()  # what failed and was not replaced, of all packages
    for start in range(0, len(packages), packages_per_batch):
        _merge(spark, root, packages[start:start + packages_per_batch], options)
    return len(packages)


def _for_feed(options: Options | None) -> Options:
    return replace(options or Options(), guard_content=True, stop_at_failure=False, on_invalid="pass_over")


def package_feed(
    spark: SparkSession,
    root: str,
    drop_base: str,
    checkpoint: str,
    options: Options | None = None,
    packages_per_batch: int = 1,
    available_now: bool = True,
    wait_seconds: int | None = None,
    max_attempts: int = 10,
    retry_seconds: int = 600,
    poll: str = "1 minute",
) -> StreamingQuery:
    """Start a query that merges new packages, a batch as one commit.

    A package is read when its list and its archive are both there, or `wait_seconds` after the
    list alone (by default at once with `available_now`, else ten minutes). A package that cannot
    be read or whose rows break a rule does not stop the feed: it is recorded with its reason
    under the run's rejects and set aside with the number of attempts, up to `max_attempts`. With
    `available_now` those set aside are tried once when the query is started; else every
    `retry_seconds`, also while nothing arrives, by batches that come each `poll`. An archive
    that was late or has been replaced loads that way. Packages not newer than the last full load
    are passed over.

    The stream's checkpoint remembers which packages were read. Files arrive in no
    order of their dates, so a text is replaced only together with its metadata,
    whose update guard does not depend on the order. A finished batch is recorded
    under checkpoint and batch number and not applied again; one that was cut off
    is applied anew, which the guard makes harmless.
    """
    options = _for_feed(options)
    if wait_seconds is None:
        wait_seconds = 0 if available_now else 600

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch_key = f"{checkpoint}#{batch_id}"
        if corpus.batch_is_finished(session, root, batch_key):
            return
        # taken once, as the state behind it moves on with each evaluation: a batch of packages
        arrived = session.createDataFrame(batch.select("path").collect(), "path string")
        if not available_now:
            arrived = arrived.unionByName(_due(session, root, max_attempts, retry_seconds, packages_per_batch))
        packages = find_packages(arrived, _since(session, root), inclusive=options.inclusive).collect()
        if packages:
            _merge(session, root, packages, options, batch_key)

    if available_now:
        retry_packages(spark, root, options, max_attempts, packages_per_batch)
    arrivals = arrived_packages(spark, drop_base, packages_per_batch, wait_seconds)
    writer = arrivals.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.trigger(processingTime=poll).start()
    # timeouts would keep a query that is to end with the files at hand going for ever
    before = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)
