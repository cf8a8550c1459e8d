"""Checks on the corpus tables. Each returns the violations as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio_sync import schemas


class SchemaError(RuntimeError):
    """A table is missing or lacks a column."""


class QualityError(RuntimeError):
    """Rows break a rule of the tables."""


def validate_schemas(found: dict[str, T.StructType | None]) -> None:
    """Compare the schemas of existing tables (None for a missing one) with the target."""
    for table, expected in schemas.TABLES.items():
        actual = found.get(table)
        if actual is None:
            raise SchemaError(f"There is no table {table!r} under this root; initialize() makes it.")
        types = {field.name: field.dataType for field in actual}
        for field in expected:
            if field.name not in types:
                raise SchemaError(f"Table {table!r} lacks the column {field.name!r}.")
            if types[field.name].simpleString() != field.dataType.simpleString():
                raise SchemaError(
                    f"Column '{field.name}' of table '{table}' is "
                    f"{types[field.name].simpleString()}, not {field.dataType.simpleString()}."
                )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows without a parent."""
    keys = parent.select(F.col(parent_key or key).alias("parent_key"))
    return child.join(keys, F.col(key) == F.col("parent_key"), "left_anti")


def violation_counts(
    df: DataFrame, required: list[str] = (), max_length: dict[str, int] | None = None
) -> DataFrame:
    """One row with, per rule, the number of rows that break it; one pass over the table."""
    rules = [F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in required]
    rules += [
        F.count_if(F.char_length(F.col(c)) > limit).alias(f"{c}_too_long")
        for c, limit in (max_length or {}).items()
    ]
    return df.agg(F.count("*").alias("n_rows"), *rules)


def table_violations(df: DataFrame, table: str) -> DataFrame:
    """`violation_counts` under the rules of one corpus table."""
    required = [f.name for f in schemas.TABLES[table] if not f.nullable and f.name in df.columns]
    limits = {c: n for c, n in schemas.MAX_LENGTH[table].items() if c in df.columns}
    return violation_counts(df, required, limits)


def _rules(df: DataFrame, table: str) -> dict[str, Column]:
    """The conditions under which a row breaks a rule of one corpus table, by the rule's name."""
    fields = [f.name for f in schemas.TABLES[table] if not f.nullable and f.name in df.columns]
    rules = {f"{c}_missing": F.col(c).isNull() for c in fields}
    return rules | {
        f"{c}_too_long": F.char_length(F.col(c)) > n for c, n in schemas.MAX_LENGTH[table].items() if c in df.columns
    }


def check_quality(metadata: DataFrame, content: DataFrame) -> DataFrame:
    """(table, rule, n_rows) for every rule of the tables that rows break: required
    columns and lengths, unique keys, and metadata for every text.

    Each table is scanned once; what its rows break is counted per key before the one
    shuffle, so a key that holds very many rows arrives as a few.
    """
    tables = {"articles_metadata": metadata, "articles_content": content}
    rules = {table: _rules(df, table) for table, df in tables.items()}
    rows, counts = None, []
    for table, df in tables.items():
        flags = {f"{t}.{rule}": broken if t == table else F.lit(False) for t in tables for rule, broken in rules[t].items()}
        part = df.select(
            "pmcid", *((F.lit(t == table)).alias(t) for t in tables), *(flags[c].alias(c) for c in flags))
        rows, counts = part if rows is None else rows.unionByName(part), [*tables, *flags]
    per_key = rows.groupBy("pmcid").agg(*(F.count_if(F.col(f"`{c}`")).alias(c) for c in counts))
    no_parent = F.col("pmcid").isNull() | (F.col("articles_metadata") == 0)
    found = {
        ("articles_content", "orphan"): F.sum(F.when(no_parent, F.col("articles_content"))),
        **{(t, rule): F.sum(F.col(f"`{t}.{rule}`")) for t in tables for rule in rules[t]},
        **{(t, "duplicate_key"): F.sum(F.greatest(F.col(t) - 1, F.lit(0))) for t in tables},
    }
    totals = per_key.agg(F.array(*(
        F.struct(F.lit(t).alias("table"), F.lit(rule).alias("rule"), F.coalesce(n, F.lit(0)).alias("n_rows"))
        for (t, rule), n in found.items())).alias("found"))
    return totals.select(F.inline("found")).where(F.col("n_rows") > 0)


def broken_groups(df: DataFrame, group: str, key: str, table: str, unique: bool = True) -> DataFrame:
    """(group, reason) of the groups, such as packages, whose rows break a rule of the table.

    Two aggregates with partial results: keys within a group, then groups."""
    required = [f.name for f in schemas.TABLES[table] if not f.nullable and f.name in df.columns]
    limits = {c: n for c, n in schemas.MAX_LENGTH[table].items() if c in df.columns}
    rules = list(_rules(df, table).items())
    if unique:
        rules.append(("duplicate_key", F.col("n_rows") > 1))
    checked = [c for c in dict.fromkeys([*required, *limits]) if c not in (group, key)]
    per_key = df.groupBy(group, key).agg(
        F.count("*").alias("n_rows"), *(F.max_by(c, F.coalesce(F.char_length(F.col(c).cast("string")), F.lit(1 << 30))).alias(c)
                                        for c in checked))
    broken = F.array_compact(F.array(*(F.when(F.max(rule), F.lit(name)) for name, rule in rules)))
    return per_key.groupBy(group).agg(F.array_join(broken, ", ").alias("reason")).where("reason <> ''")


def require_clean(df: DataFrame, table: str) -> None:
    """Raise if any row breaks a rule of the table."""
    counts = table_violations(df, table).first().asDict()
    broken = {rule: n for rule, n in counts.items() if rule != "n_rows" and n}
    if broken:
        raise QualityError(f"Rows of {table} break rules: {broken}")


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise if a key occurs more than once; names a few of the keys."""
    found = duplicate_keys(df, keys).limit(5).collect()
    if found:
        raise QualityError(
            f"Duplicate keys in {what}: " + "; ".join(str(r.asDict()) for r in found)
        )
