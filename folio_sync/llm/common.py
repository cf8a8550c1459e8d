"""What several operators share: input columns, written intermediate tables, batches of rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.session import freed_shuffles, scratch_path

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SIEVE_BITS = 1 << 22

# Arrow batches end at whichever comes first, so that long texts fit a worker's memory.
BATCH_ROWS, BATCH_BYTES = 2000, "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """The same rows from a table in the shared scratch folder; cuts lineage.

    The shuffle files of the write go when it has ended."""
    path = path or scratch_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discarded(*tables: DataFrame) -> None:
    """Remove written tables that no result still to be computed reads."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sieved(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows whose key may be among the wanted ones, by a bitmap of fixed size that all tasks get.

    It keeps most wide rows that nobody wants out of a shuffle that follows; what it lets
    through still has to be joined with the wanted keys. Rows with a null key are dropped."""
    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(SIEVE_BITS))

    at = place(wanted_key)
    sieve = wanted.where(F.col(wanted_key).isNotNull()).groupBy(F.bitmap_bucket_number(at).alias("__part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", (F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.where(F.col(key).isNotNull())
        .withColumn("__part", F.bitmap_bucket_number(place(key)))
        .withColumn("__bit", F.bitmap_bit_position(place(key)))
        .join(F.broadcast(sieve), "__part")  # SIEVE_BITS / 32768 rows of 4 KB at most
        .where(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1)
        .drop("__part", "__bit", "__bits")
    )


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` of the tuples that a task yields."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    if held:
        yield batch()
