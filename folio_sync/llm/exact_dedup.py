"""Exact duplicates through an extendible-hash index on shared files.

A text's key is a 64-bit hash; the key's leading bits choose a slot of the directory,
and a slot points to a bucket, which owns a range of keys. A bucket with more than
`bucket_rows` keys is split, doubling the directory where its depth is used up. Owner
tasks then take whole buckets, walk their rows in key order and chain the texts of one
key, telling them apart byte by byte. The index is a folder:

    <path>/prints/      doc_id, key, digest of every row
    <path>/directory/   slot, bucket, depth, local_depth
    <path>/buckets/     bucket, key, chain, digest, keep_id, group_size

Every scan task sends an equal text once per `HELD_BYTES` of texts, with a count, so a
text that fills a third of the corpus reaches its owner as a few rows a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.llm.common import SPACES, in_batches, small_batches, whole_text, written
from folio_sync.session import scratch_path

BUCKET_ROWS = 4096
DEPTH_LIMIT = 16  # at most 65,536 slots, which the driver holds; beyond it buckets grow
HELD_BYTES = 32 << 20

SENT = pa.schema([
    ("bucket", pa.int32()), ("key", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()),
    ("copies", pa.int64()), ("first_id", pa.int64()),
])
SENT_DDL = "bucket int, key long, digest binary, body binary, copies long, first_id long"
ENTRY = pa.schema([
    ("bucket", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("digest", pa.binary()),
    ("keep_id", pa.int64()), ("group_size", pa.int64()),
])
ENTRY_DDL = "bucket int, key long, chain int, digest binary, keep_id long, group_size long"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(whole_text(text), SPACES, " ")


def _keyed(docs: DataFrame, key_bits: int, *more: Column) -> DataFrame:
    key = F.xxhash64("digest")
    if key_bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    return (
        docs.select(F.col("doc_id").cast("long"), normalised().alias("body"))
        .withColumn("digest", F.unhex(F.sha2("body", 256)))
        .select("doc_id", key.alias("key"), "digest", *more)
    )


def slot_of(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


class Directory:
    """Slots of an extendible-hash index: slot -> (bucket's prefix, its local depth)."""

    def __init__(self, bucket_rows: int):
        self.bucket_rows, self.depth = bucket_rows, 0
        self.slots: list[tuple[int, int]] = [(0, 0)]

    def double(self) -> None:
        self.slots = [s for s in self.slots for _ in (0, 1)]
        self.depth += 1

    def overfull(self, count) -> list[tuple[int, int]]:
        """Buckets whose keys exceed their room; count(prefix, local depth) gives the keys."""
        return [b for b in dict.fromkeys(self.slots) if count(*b) > self.bucket_rows]

    def split(self, bucket: tuple[int, int]) -> None:
        prefix, local = bucket
        if local == self.depth:
            self.double()
        width = 1 << (self.depth - local)
        first = prefix * width
        for i in range(width):
            self.slots[first + i] = (2 * prefix + (i >= width // 2), local + 1)

    def numbered(self) -> list[int]:
        """The bucket number of every slot, in key order."""
        number = {b: i for i, b in enumerate(dict.fromkeys(self.slots))}
        return [number[b] for b in self.slots]


def grow_directory(prints: DataFrame, rows: int, bucket_rows: int) -> Directory:
    """Split buckets until all fit or the directory has its largest depth.

    Keys are counted in Spark by slot at a depth that should do, and deeper, for the
    overfull slots alone, while it does not."""
    directory = Directory(max(bucket_rows, math.ceil(rows / (1 << (DEPTH_LIMIT - 2)))))
    depth = min(DEPTH_LIMIT, max(1, math.ceil(math.log2(max(2, rows / directory.bucket_rows)))) + 2)
    full = None
    while True:
        keys = prints.select("key").distinct()
        if full is not None:
            keys = keys.where(slot_of(F.col("key"), shallow).isin([p for p, _ in full]))
        counts = {r[0]: r[1] for r in keys.groupBy(slot_of(F.col("key"), depth)).count().collect()}
        sums = {(p, depth): n for p, n in counts.items()}
        for d in range(depth, 0, -1):
            for (p, at), n in [x for x in sums.items() if x[0][1] == d]:
                sums[p >> 1, d - 1] = sums.get((p >> 1, d - 1), 0) + n
        while full := directory.overfull(lambda p, d: sums.get((p, d), 0)):
            splittable = [b for b in full if b[1] < depth]
            if not splittable:
                break
            for b in splittable:
                directory.split(b)
        if not full or depth >= DEPTH_LIMIT:
            return directory
        shallow, depth = depth, min(DEPTH_LIMIT, depth + 4)


def _sender(slots: list[int], depth: int, held_bytes: int):
    """Sends each text once per `held_bytes` of different texts, with its copies so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held: dict[bytes, list] = {}
            size = 0
            for batch in batches:
                ids, keys, digests, bodies = (batch.column(i).to_pylist() for i in range(4))
                for doc_id, key, digest, body in zip(ids, keys, digests, bodies):
                    if (found := held.get(body)) is None:
                        slot = (key & 0xFFFFFFFFFFFFFFFF) >> (64 - depth) if depth else 0
                        held[body] = [slots[slot], key, digest, 1, doc_id]
                        size += len(body)
                    else:
                        found[3] += 1
                        if found[4] is None or doc_id is not None and doc_id < found[4]:
                            found[4] = doc_id
                    if size >= held_bytes:
                        yield from ((b, k, d, body, n, i) for body, (b, k, d, n, i) in held.items())
                        held, size = {}, 0
            yield from ((b, k, d, body, n, i) for body, (b, k, d, n, i) in held.items())

        yield from in_batches(rows(), SENT, 500)

    return run


def _chain_owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task's buckets in key order; the texts of one key form a chain."""
    def rows():
        at, chain = None, []
        for batch in batches:
            for bucket, key, digest, body, copies, doc_id in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (bucket, key) != at:
                    yield from (e[1:] for e in chain)
                    at, chain = (bucket, key), []
                for entry in chain:
                    if entry[0] == body:
                        entry[6] += copies
                        if entry[5] is None or doc_id is not None and doc_id < entry[5]:
                            entry[5] = doc_id
                        break
                else:
                    chain.append([body, bucket, key, len(chain), digest, doc_id, copies])
        yield from (e[1:] for e in chain)

    yield from in_batches(rows(), ENTRY)


def build_index(
    docs: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS, key_bits: int = 64, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """Index `docs(doc_id, text, ...)` under `path`; returns the bucket entries.

    Null texts count as empty. `bucket_rows` is the room of a bucket in keys; it grows with
    the corpus once the directory has its largest depth. `key_bits` below 64 makes
    different texts collide, which chains resolve."""
    spark = docs.sparkSession
    small_batches(spark)
    prints = written(_keyed(docs, key_bits), "prints", f"{path}/prints")
    directory = grow_directory(prints, prints.count(), bucket_rows)
    slots = directory.numbered()
    spark.createDataFrame(
        [(i, n, directory.depth, d) for i, (n, (_, d)) in enumerate(zip(slots, directory.slots))],
        "slot long, bucket int, depth int, local_depth int",
    ).coalesce(1).write.parquet(f"{path}/directory")
    sent = _keyed(docs, key_bits, F.col("body").cast("binary")).mapInArrow(
        _sender(slots, directory.depth, held_bytes), SENT_DDL)
    owned = sent.repartition("bucket").sortWithinPartitions("bucket", "key")
    return written(owned.mapInArrow(_chain_owned, ENTRY_DDL), "buckets", f"{path}/buckets")


def exact_dedup(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after every run of white space became one space.
    The smallest doc_id of a group stays, null ids come last; rows that repeat a doc_id
    together with its text are one document and carry the same values. A null text is an
    empty one; an empty table gives no rows; other columns are not read."""
    path = path or scratch_path(docs.sparkSession, "hash-index")
    entries = build_index(docs, path, **options)
    prints = docs.sparkSession.read.schema("doc_id long, key long, digest binary").parquet(f"{path}/prints")
    return prints.join(entries.drop("bucket", "chain"), ["key", "digest"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
