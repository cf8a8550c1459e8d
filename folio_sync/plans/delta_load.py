"""Delta load: retractions and dated packages since the last successful run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from folio_sync.operators.audit import UNREADABLE, read_sidecars
from folio_sync.operators.enrich import match_listed, split_listed
from folio_sync.operators.merge import fold_packages, latest_package, newest_per_key
from folio_sync.operators.quality import QualityError, broken_groups
from folio_sync.operators.runs import watermark
from folio_sync.plans.publish import (
    commit_retractions, publish, replaced_texts, take_updates,
)
from folio_sync.plans.staging import (
    ROW, materialize, now_utc, stage_archives, texts_of, unlisted_rejects, write_rejects,
)
from folio_sync.sources import corpus
from folio_sync.sources.manifest import read_file_lists, read_retractions
from folio_sync.sources.packages import find_packages, list_archives


class NoFullLoad(RuntimeError):
    """A delta load needs a successful full load before it."""


class PackageFailed(RuntimeError):
    """A package could not be read and the caller asked to stop there."""


@dataclass
class Options:
    """Choices of a delta load. The defaults are the established behaviour.

    packages_per_commit: packages published together; None takes all of them in one
        job, which is the fastest, 1 keeps what was done if a later package fails.
    on_duplicate: `error` or `latest`, for an id repeated within one package.
    guard_content: replace a text only together with its metadata.
    sticky_retractions: an update does not clear a retraction flag.
    inclusive: also read packages dated on the day of the last run.
    stop_at_failure: fail the run at an unreadable package instead of passing over it.
    on_invalid: what a package does whose rows break a rule of the tables (a repeated or too long
        id): `stop` loads the packages before it and fails the run there, `pass_over` leaves it out
        like an unreadable one and goes on.
    verify_sidecars: check packages against the digest files next to them; a package
        without one is taken as it is.
    """

    packages_per_commit: int | None = None
    on_duplicate: str = "error"
    guard_content: bool = False
    sticky_retractions: bool = False
    inclusive: bool = False
    stop_at_failure: bool = False
    on_invalid: str = "stop"
    verify_sidecars: bool = True


@dataclass
class Outcome:
    """What became of some packages: `failures` maps those passed over to the reason; `invalid`
    names the one at which the run has to stop, with everything before it in place."""

    processed: int
    upserted: int
    failures: dict[str, str]
    rejects: int
    retracted_ids: DataFrame
    invalid: str | None = None


def apply_packages(
    spark: SparkSession,
    root: str,
    run_id: int,
    packages: list[Row],
    run_ts: dt.datetime,
    options: Options,
    published: DataFrame | None = None,
) -> Outcome:
    """Merge some packages, oldest first, as one commit.

    The result is that of applying them one after the other. Rows are checked per package, so that
    one with rows that break a rule leaves the others in place. Retracted lines of
    their file lists are not loaded; their ids are returned, also when the archive is
    damaged, but not when it has the wrong digest: then nothing of the package counts.
    A package whose list holds nothing but retracted lines is not unpacked.
    """
    listed, list_rejects = read_file_lists(spark, [p.file_list_path for p in packages])
    listed = materialize(spark, listed, "file-lists")
    order = materialize(spark, spark.createDataFrame(
        [(p.archive_path, p.location, i) for i, p in enumerate(packages)],
        "archive_path string, location string, package_order int",
    ), "packages")
    loadable = listed.groupBy("archive_path").agg(F.count_if(~F.col("is_retracted")).alias("n_articles"))
    archives = order.join(loadable, "archive_path", "left").fillna(1, ["n_articles"]).where("n_articles > 0")
    if published is None and options.verify_sidecars:
        published = read_sidecars(spark, sorted({p.location.rsplit("/", 1)[0] for p in packages}))
    staged = stage_archives(spark, materialize(spark, archives, "archives"), published)
    failures = {row.archive_path: row.reason for row in staged.failed.select("archive_path", "reason").collect()}
    if failures and options.stop_at_failure:
        raise PackageFailed(f"Unreadable packages: {sorted(failures)}")

    trusted = listed.join(
        staged.failed.where(F.col("reason") != UNREADABLE), "archive_path", "left_anti"
    )
    listed = listed.join(staged.failed, "archive_path", "left_anti")
    matched = match_listed(staged.articles, listed.where(~F.col("is_retracted"))).join(
        order.select("archive_path", "package_order"), "archive_path"
    )
    matched = materialize(spark, matched, "matched")
    enriched, unlisted = split_listed(matched)
    if options.on_duplicate == "latest":
        enriched = newest_per_key(enriched, ["archive_path", "pmcid"], ROW[1:])
    broken = {row.archive_path: row.reason for row in broken_groups(
        enriched.select("archive_path", "pmcid", "doi", "is_retracted"), "archive_path", "pmcid", corpus.METADATA,
        unique=options.on_duplicate != "latest").collect()}
    invalid = None
    if broken:
        names = [p.archive_path for p in packages]
        if options.on_invalid == "stop":
            first = min(map(names.index, broken))
            invalid = f"{names[first]}: {broken[names[first]]}"
            left_out = {name: broken.get(name, "not reached") for name in names[first:]}
        else:
            left_out = broken
            failures.update(broken)
        left_out = spark.createDataFrame(sorted(left_out.items()), "archive_path string, reason string")
        enriched, unlisted, trusted = (
            rows.join(left_out.select("archive_path"), "archive_path", "left_anti") for rows in (enriched, unlisted, trusted))
        staged.rejects = staged.rejects.unionByName(left_out.where("reason <> 'not reached'").select(
            F.lit("package").alias("stage"), F.col("archive_path").alias("source"),
            F.lit(None).cast("string").alias("key"), "reason", F.lit(None).cast("string").alias("payload")))
        packages = packages[:first] if invalid else packages
    done = [p.archive_path for p in packages if p.archive_path not in failures]

    upserted = enriched.count()
    if upserted:
        stamped = fold_packages(enriched).withColumn("sync_timestamp", F.lit(run_ts))
        versions = corpus.live_versions(spark, root)
        taken, old = take_updates(spark, root, stamped, options.sticky_retractions, versions)
        texts = taken if options.guard_content else materialize(
            spark, latest_package(enriched.select("pmcid", *ROW, "package_order")), "latest"
        )
        publish(
            spark, root, run_id, "append", taken, texts_of(staged, spark, texts), old,
            replaced_texts(spark, root, texts, versions), done[-1], versions,
        )
    elif done:
        corpus.update_run_state(spark, root, run_id, done[-1])
    rejects = write_rejects(
        spark, root, run_id, [list_rejects, staged.rejects, unlisted_rejects(unlisted)]
    )
    return Outcome(
        len(done), upserted, failures, rejects, trusted.where("is_retracted").select("pmcid"), invalid
    )


def delta_load(
    spark: SparkSession,
    root: str,
    drop_base: str,
    retraction_paths: str | list[str] | None = None,
    published: DataFrame | None = None,
    options: Options | None = None,
    run_ts: dt.datetime | None = None,
) -> int:
    """Bring the corpus up to date and return the run's id.

    In order: the retraction list, the packages dated after the last successful
    run, and the retractions named in their file lists. `run_ts` is the time to
    record instead of the present.
    """
    options = options or Options()
    fixed_ts, run_ts = run_ts, run_ts or now_utc()
    corpus.validate(spark, root)
    last = watermark(corpus.read_history(spark, root)).withColumn(
        "end_day", F.to_date("end_time")
    ).first()
    if last is None:
        raise NoFullLoad("A delta load goes on from a full load, and none has ended well here.")
    marker = last.last_file_processed if last.run_type == "DELTA" else None

    run_id = corpus.start_run(spark, root, "DELTA", run_ts)
    metrics = {
        "archives_processed": 0, "archives_failed": 0, "total_articles_upserted": 0,
        "total_articles_retracted": 0, "rejects": 0,
    }
    try:
        if retraction_paths is not None:
            ids = materialize(spark, read_retractions(spark, retraction_paths), "retractions")
            metrics["total_articles_retracted"] += commit_retractions(
                spark, root, run_id, ids, run_ts
            )
        packages = find_packages(
            list_archives(spark, drop_base), last.end_day, marker, options.inclusive
        ).collect()
        step = options.packages_per_commit or max(len(packages), 1)
        daily_ids = []
        for start in range(0, len(packages), step):
            group = packages[start:start + step]
            outcome = apply_packages(spark, root, run_id, group, run_ts, options, published)
            metrics["archives_processed"] += outcome.processed
            metrics["archives_failed"] += len(outcome.failures)
            metrics["total_articles_upserted"] += outcome.upserted
            metrics["rejects"] = outcome.rejects
            if outcome.invalid:
                raise QualityError(f"Rows of a package break rules: {outcome.invalid}")
            daily_ids.append(outcome.retracted_ids)
        if daily_ids:
            ids = daily_ids[0]
            for more in daily_ids[1:]:
                ids = ids.unionByName(more)
            metrics["total_articles_retracted"] += commit_retractions(
                spark, root, run_id, ids.distinct(), run_ts
            )
    except Exception:
        corpus.end_run(spark, root, run_id, "FAILED", fixed_ts or now_utc(), metrics)
        raise
    corpus.end_run(spark, root, run_id, "SUCCESS", fixed_ts or now_utc(), metrics)
    return run_id
