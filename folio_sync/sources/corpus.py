"""The corpus tables on Parquet.

Parquet has no MERGE and a table cannot be overwritten while it is read, so a
change is written as a new version next to the old ones:

    <root>/articles_metadata/v=<n>/bucket=<b>/   rows added or replaced by version n
    <root>/articles_content/v=<n>/bucket=<b>/
    <root>/superseded_metadata/v=<n>/   (pmcid, old_version) of rows n replaces
    <root>/superseded_content/v=<n>/
    <root>/sync_history/                one row per change of a run
    <root>/layout/                      the number of buckets, fixed when the corpus is made

A history row with a commit number publishes version n, with the run's state, in
one file written last; files of a run that died before it are never read. A commit
of kind `replace` hides all earlier versions. The work of a delta load is thus in
proportion to the delta and not to the corpus, and reading is a scan of the live
versions without the superseded keys. `compact` folds them again.

All tables are bucketed by `pmcid` with one count, as Spark's own bucketed tables, and the bucket
is a partition column as well. Rows and the keys that replace them lie in the same buckets, so
reading joins them without an exchange, however many keys there are; and a merge or a retraction
scans only the buckets that hold its keys. Texts are moved once, when they are written.

There is one writer at a time. Version numbers are never given twice, so a second writer
overwrites nothing, and a change that was computed from versions that are no longer the live ones
is refused when it is to be published.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio_sync import schemas
from folio_sync.operators.quality import validate_schemas
from folio_sync.operators.runs import fold_history

METADATA, CONTENT, HISTORY = "articles_metadata", "articles_content", "sync_history"
ATTEMPTS = "package_attempts"
SUPERSEDED = {METADATA: "superseded_metadata", CONTENT: "superseded_content"}
VERSION, BUCKET = "v", "bucket"
LAYOUT = "layout"
MANAGE_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")


class ConcurrentWrite(RuntimeError):
    """Another writer has published a version since this change was computed."""


# Point lookups by id skip row groups through Bloom filters; rows sorted by date
# let the row groups' minimum and maximum serve date ranges.
BLOOM = {
    METADATA: ("pmcid", "pmid", "doi"),
    CONTENT: ("pmcid",),
}


def _path(root: str, table: str, version: int | None = None) -> str:
    base = f"{root.rstrip('/')}/{table}"
    return base if version is None else f"{base}/{VERSION}={version}"


def _read_if_present(spark: SparkSession, schema: T.StructType, *paths: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(*paths)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise
        return None


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if (error.getCondition() or "") not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def initialize(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    """Create the empty tables; existing ones stay as they are.

    `buckets` is the number of parts in which the tables are written, read and merged, by default one
    per core and 8 at least. It is fixed from then on: choose it for the size the corpus will have."""
    layout = _path(root, LAYOUT)
    if _stored_schema(spark, layout) is None:
        buckets = buckets or max(8, spark.sparkContext.defaultParallelism)
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(layout)
    for table in (METADATA, CONTENT):
        if _stored_schema(spark, _path(root, table)) is None:
            empty = schemas.empty(spark, schemas.TABLES[table])
            empty.write.mode("overwrite").parquet(f"{_path(root, table, 0)}/{BUCKET}=0")
    if _stored_schema(spark, _path(root, HISTORY)) is None:
        schemas.empty(spark, schemas.HISTORY_EVENTS).write.mode("overwrite").parquet(
            _path(root, HISTORY)
        )


def validate(spark: SparkSession, root: str) -> None:
    """Raise if a table is missing, lacks a column or has a column of another type.

    Jobs call this first. It also refuses a session with a time zone of its own: all times
    of the corpus are UTC, and lists have none written in them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise RuntimeError(f"set spark.sql.session.timeZone to UTC; it is {zone}")
    validate_schemas({table: _stored_schema(spark, _path(root, table)) for table in schemas.TABLES})


# --- history -----------------------------------------------------------------


def read_events(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.HISTORY_EVENTS).parquet(_path(root, HISTORY))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The run history: one row per run."""
    events = read_events(spark, root).drop("commit_version", "commit_kind", "batch_key")
    return schemas.conform(fold_history(events), schemas.HISTORY)


_last_moment = 0


def _moment() -> int:
    """Microseconds since 1970, each given once: orders events and names versions without a read."""
    global _last_moment
    _last_moment = max(time.time_ns() // 1000, _last_moment + 1)
    return _last_moment


def _append_event(spark: SparkSession, root: str, **values) -> None:
    row = {f.name: values.get(f.name) for f in schemas.HISTORY_EVENTS}
    row["event_seq"] = _moment()
    spark.createDataFrame([row], schemas.HISTORY_EVENTS).coalesce(1).write.mode("append").parquet(
        _path(root, HISTORY)
    )


def start_run(spark: SparkSession, root: str, run_type: str, now: dt.datetime) -> int:
    """Open a run and return its id."""
    last = read_events(spark, root).agg(F.max("run_id")).first()[0] or 0
    _append_event(
        spark, root, run_id=last + 1, run_type=run_type, start_time=now, status="RUNNING"
    )
    return last + 1


def end_run(
    spark: SparkSession,
    root: str,
    run_id: int,
    status: str,
    now: dt.datetime,
    metrics: dict[str, int] | None = None,
    last_file: str | None = None,
    batch_key: str | None = None,
) -> None:
    """Close a run; the last file is only changed if one is given."""
    _append_event(
        spark, root, run_id=run_id, status=status, end_time=now,
        metrics=metrics or None, last_file_processed=last_file, batch_key=batch_key,
    )


def update_run_state(spark: SparkSession, root: str, run_id: int, last_file: str) -> None:
    """Advance a run's marker without changing data."""
    _append_event(spark, root, run_id=run_id, last_file_processed=last_file)


def batch_is_finished(spark: SparkSession, root: str, batch_key: str) -> bool:
    return not read_events(spark, root).where(F.col("batch_key") == batch_key).isEmpty()


# --- packages of the feed that failed ----------------------------------------


def failed_packages(spark: SparkSession, root: str) -> DataFrame:
    """The packages set aside by the feed, as their last attempt left them."""
    found = _read_if_present(spark, schemas.PACKAGE_ATTEMPTS, _path(root, ATTEMPTS))
    if found is None:
        return schemas.empty(spark, schemas.PACKAGE_ATTEMPTS)
    values = [c for c in found.columns if c not in ("archive_path", "run_id")]
    last = found.groupBy("archive_path").agg(
        F.max("run_id").alias("run_id"), F.max_by(F.struct(*values), "run_id").alias("last"))
    return last.select("archive_path", "last.path", "run_id", *(f"last.{c}" for c in values[1:])).where(
        F.col("reason").isNotNull())


def record_packages(
    spark: SparkSession, root: str, run_id: int, packages: list[Row], failures: dict[str, str], now: dt.datetime,
) -> None:
    """Count an attempt at each failed package of a run, and clear those that failed before and did not now."""
    tried = spark.createDataFrame(
        [(p.archive_path, p.location, failures.get(p.archive_path)) for p in packages],
        "archive_path string, path string, reason string")
    before = failed_packages(spark, root).select("archive_path", F.col("attempts").alias("earlier"))
    rows = tried.join(before, "archive_path", "left").where("reason IS NOT NULL OR earlier IS NOT NULL")
    attempts = F.when(F.col("reason").isNull(), 0).otherwise(F.coalesce("earlier", F.lit(0)) + 1)
    # collected before the write: a batch of packages
    found = rows.select(
        "archive_path", "path", F.lit(run_id).cast("long").alias("run_id"), attempts.cast("int").alias("attempts"),
        "reason", F.lit(now).alias("recorded")).collect()
    if found:
        spark.createDataFrame(found, schemas.PACKAGE_ATTEMPTS).coalesce(1).write.mode("append").parquet(_path(root, ATTEMPTS))


# --- versions ----------------------------------------------------------------


def next_version() -> int:
    """A number no other version has."""
    return _moment()


def live_versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions from the last replacement on: a few numbers per day of history."""
    commits = (
        read_events(spark, root)
        .where(F.col("commit_version").isNotNull())
        .select("commit_version", "commit_kind", "event_seq")
        .orderBy("event_seq")
        .collect()
    )
    versions: list[int] = []
    for commit in commits:
        if commit.commit_kind == "replace":
            versions = []
        versions.append(commit.commit_version)
    return versions


def commit(
    spark: SparkSession, root: str, run_id: int, version: int, kind: str = "append",
    last_file: str | None = None, based_on: list[int] | None = None,
) -> None:
    """Publish a version and the run's marker together.

    With `based_on`, the live versions the change was computed from, it is refused if these
    are no longer the live ones."""
    if based_on is not None and live_versions(spark, root) != based_on:
        raise ConcurrentWrite(f"Version {version} goes back to versions that are no longer the live ones")
    _append_event(
        spark, root, run_id=run_id, commit_version=version, commit_kind=kind,
        last_file_processed=last_file,
    )


_bucket_counts: dict[tuple[str, str], int] = {}  # never changes after `initialize`


def bucket_count(spark: SparkSession, root: str) -> int:
    known = (spark.sparkContext.applicationId, root)
    if known not in _bucket_counts:
        _bucket_counts[known] = spark.read.parquet(_path(root, LAYOUT)).first().buckets
    return _bucket_counts[known]


def bucket_of(spark: SparkSession, root: str, key: Column) -> Column:
    """The bucket of a key: the rule by which Spark itself assigns rows to buckets."""
    return F.pmod(F.hash(key), F.lit(bucket_count(spark, root))).cast("int")


def touched_buckets(spark: SparkSession, root: str, keys: DataFrame) -> list[int]:
    """The buckets that hold the keys of a DataFrame with `pmcid`; at most as many as there are."""
    found = keys.select(bucket_of(spark, root, F.col("pmcid")).alias(BUCKET)).distinct().collect()
    return sorted(row.bucket for row in found)


def _registered(spark: SparkSession, root: str, table: str) -> str:
    """The name under which the session's catalog knows a table's folder as a bucketed table."""
    name = f"folio_{hashlib.md5(root.encode(), usedforsecurity=False).hexdigest()}_{table}"
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)  # another session may have written
        return name
    is_rows = table in SUPERSEDED
    fields = [*(schemas.TABLES[table] if is_rows else schemas.SUPERSEDED), T.StructField(VERSION, T.LongType())]
    parts = [VERSION]
    if is_rows:
        fields.append(T.StructField(BUCKET, T.IntegerType()))
        parts.append(BUCKET)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = ", ".join(f"'parquet.bloom.filter.enabled#{c}' 'true'" for c in BLOOM.get(table, ("pmcid",)))
    order = " SORTED BY (publication_date)" if table == METADATA else ""
    location = _path(root, table).replace("\\", "\\\\").replace("'", "\\'")
    # folders are found by listing, so that other sessions' versions and copies of a corpus are read
    before = spark.conf.get(MANAGE_PARTITIONS)
    spark.conf.set(MANAGE_PARTITIONS, "false")
    try:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ({options}) "
            f"PARTITIONED BY ({', '.join(parts)}) CLUSTERED BY (pmcid){order} INTO {bucket_count(spark, root)} BUCKETS "
            f"LOCATION '{location}'")
    finally:
        spark.conf.set(MANAGE_PARTITIONS, before)
    return name


def read_table(
    spark: SparkSession, root: str, table: str, versions: list[int] | None = None,
    buckets: list[int] | None = None, of_versions: list[int] | None = None,
) -> DataFrame:
    """The live rows of a corpus table with the version `v` each comes from.

    With `buckets` no others are read, with `of_versions` no rows of others; the conditions prune
    folders. The replaced rows are taken out bucket by bucket, without an exchange."""
    versions = live_versions(spark, root) if versions is None else versions
    wanted = versions if of_versions is None else [v for v in versions if v in set(of_versions)]
    if not wanted:
        return schemas.empty(spark, T.StructType(schemas.TABLES[table].fields + [T.StructField(VERSION, T.LongType())]))
    rows = spark.table(_registered(spark, root, table)).where(F.col(VERSION).isin(wanted))
    if buckets is not None and len(buckets) < bucket_count(spark, root):
        rows = rows.where(F.col(BUCKET).isin(buckets))
    rows = rows.drop(BUCKET)
    if len(versions) < 2:  # nothing can be superseded
        return rows
    old = spark.table(_registered(spark, root, SUPERSEDED[table])).where(F.col(VERSION).isin(versions)).select(
        F.col("pmcid").alias("old_pmcid"), "old_version")
    # the versions are compared beside the join's key, which is the key of the buckets alone
    same_version = F.col(VERSION) - F.col("old_version") == 0
    return rows.join(old.hint("shuffle_hash"), (F.col("pmcid") == F.col("old_pmcid")) & same_version, "left_anti")


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, METADATA).drop(VERSION)


def read_content(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, CONTENT).drop(VERSION)


def write_version(
    spark: SparkSession, root: str, table: str, version: int,
    rows: DataFrame, superseded: DataFrame | None = None,
) -> None:
    """Write one version's rows and the keys they replace. Not visible before `commit`.

    `superseded` has the columns `pmcid` and `v`.
    """
    count = bucket_count(spark, root)
    conformed = schemas.conform(rows, schemas.TABLES[table])
    names = [f.name for f in schemas.TABLES[table]]
    conformed.repartition(count, "pmcid").select(
        *names, F.lit(version).cast("long").alias(VERSION), bucket_of(spark, root, F.col("pmcid")).alias(BUCKET),
    ).write.insertInto(_registered(spark, root, table))
    if superseded is not None:
        superseded.select("pmcid", F.col(VERSION).alias("old_version")).repartition(count, "pmcid").select(
            "pmcid", "old_version", F.lit(version).cast("long").alias(VERSION),
        ).write.insertInto(_registered(spark, root, SUPERSEDED[table]))


def compact(spark: SparkSession, root: str, run_id: int) -> int:
    """Rewrite the live rows as one version, so that reading needs no superseded keys."""
    versions, version = live_versions(spark, root), next_version()
    for table in (METADATA, CONTENT):
        write_version(spark, root, table, version, read_table(spark, root, table, versions).drop(VERSION))
    commit(spark, root, run_id, version, kind="replace", based_on=versions)
    return version
