"""Merging staged articles into the corpus tables.

In every join the other side is reduced to the key and, for metadata, the clock.
Catalyst broadcasts it when its size is below the session's threshold, so that the
rows with text stay where they are, and sorts both sides otherwise. The staged rows
are read more than once: write them first if they are expensive to compute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "pmcid"
CLOCK = "source_last_updated"
ORDER = "package_order"


def _is_newer(old_clock: Column, new_clock: Column) -> Column:
    """The update guard: an unknown old time always gives way, else later wins."""
    return old_clock.isNull() | F.coalesce(old_clock < new_clock, F.lit(False))


def admitted(target: DataFrame, staged: DataFrame, key: str = KEY, clock: str = CLOCK) -> DataFrame:
    """Staged rows that are new or newer than the target's row. Keys are unique on both sides.

    The target's keys are first reduced to the staged ones: with a small delta that
    is one broadcast and a scan of two columns, and the table is not shuffled.
    """
    old = target.select(key, clock).join(staged.select(key), key, "left_semi").select(
        F.col(key).alias("old_key"), F.col(clock).alias("old_clock")
    )
    blocked = (F.col(key) == F.col("old_key")) & ~_is_newer(F.col("old_clock"), F.col(clock))
    return staged.join(old, blocked, "left_anti")


def upsert_metadata(
    target: DataFrame, staged: DataFrame, key: str = KEY, clock: str = CLOCK
) -> DataFrame:
    """The target after a guarded upsert: new keys are added, and a row is replaced
    as a whole where the staged one is newer."""
    new = staged.select(F.col(key).alias("new_key"), F.col(clock).alias("new_clock"))
    replaced = (F.col(key) == F.col("new_key")) & _is_newer(F.col(clock), F.col("new_clock"))
    kept = target.join(new, replaced, "left_anti")
    return kept.unionByName(admitted(target, staged, key, clock).select(*target.columns))


def upsert_content(target: DataFrame, staged: DataFrame, key: str = KEY) -> DataFrame:
    """The target after an unguarded upsert: a staged row always wins."""
    kept = target.join(staged.select(key), key, "left_anti")
    return kept.unionByName(staged.select(*target.columns))


def superseded_rows(target_keys: DataFrame, staged: DataFrame, key: str = KEY) -> DataFrame:
    """The target's rows that staged rows replace."""
    return target_keys.join(staged.select(key), key, "left_semi")


def _winner(staged: DataFrame, order: Column, key: str) -> DataFrame:
    values = [c for c in staged.columns if c != key]
    picked = staged.groupBy(key).agg(F.max_by(F.struct(*values), order).alias("picked"))
    return picked.select(key, *[F.col(f"picked.{c}").alias(c) for c in values]).select(
        *staged.columns
    )


def fold_packages(
    staged: DataFrame, key: str = KEY, clock: str = CLOCK, order: str = ORDER
) -> DataFrame:
    """One row per key out of several packages, such that one guarded upsert of the
    result equals upserting package after package.

    With any time known, the newest time wins and, among equal ones, the earliest
    package, because an equal time does not replace. With no time known each
    package replaces the one before, so the latest wins. An aggregate with partial
    results per input task does this, so a key that fills many rows is reduced
    before the shuffle. `order` has to be a number or a date-like value per key.
    """
    known = F.col(clock).isNotNull()
    rank = F.struct(
        known.alias("known"),
        F.col(clock).alias("clock"),
        F.when(known, -F.col(order)).otherwise(F.col(order)).alias("rank"),
    )
    return _winner(staged, rank, key)


def latest_package(staged: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """One row per key out of several packages under an unguarded upsert: the latest."""
    return _winner(staged, F.col(order), key)


def newest_per_key(
    staged: DataFrame, keys: list[str], ties: list[str], clock: str = CLOCK
) -> DataFrame:
    """One row per key: the newest, and among equal times the last by `ties`."""
    values = [c for c in staged.columns if c not in keys]
    picked = staged.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.struct(clock, *ties)).alias("picked")
    )
    return picked.select(*keys, *[F.col(f"picked.{c}").alias(c) for c in values])
