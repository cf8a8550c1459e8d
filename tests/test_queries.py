"""Every registered query against its SQL at the smallest scale."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import check_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in entry.LLM])
def test_query_matches_its_sql(spark, con, name):
    good, note = check_queries.compare(spark, con, SF_DIR, name)
    assert good, note


def test_bundles_of_one_task_are_numbered_apart(spark, con):
    """Tasks of several Arrow batches, as on larger tables, bundle several members into an archive."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        good, note = check_queries.compare(spark, con, SF_DIR, "bundled_articles")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert good, note


def test_one_row_group_is_spread_out(tmp_path, spark):
    """A scan can have more parts than cores with all its rows in one of them."""
    from pyspark.sql import functions as F

    from query_catalog.common import spread_out

    spark.range(4000).withColumn("text", F.sha2(F.col("id").cast("string"), 512)).coalesce(1).write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        parts = spread_out(spark.read.parquet(f"{tmp_path}/t"), "id").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(parts) >= spark.sparkContext.defaultParallelism and max(row["count"] for row in parts) < 4000 // 2


def test_entry_is_a_query(spark):
    assert set(entry.oracle_sql()) == set(entry.queries()) - set(entry.LLM) | set(entry.oracle_sql()) & set(entry.LLM)
    assert entry.entry(spark).columns == ["pmcid", "title", "updated", "is_retracted"]


def test_tasks_find_the_code_from_any_folder(tmp_path):
    """A plain session started elsewhere, with nothing installed for the workers."""
    script = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", {entry.__file__!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("loaded", entry.queries()["full_load_metrics"](spark, {SF_DIR!r}).first().loaded)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "loaded 200" in done.stdout, done.stderr[-2000:]
