"""Hard negatives by the threshold algorithm.

Vectors are quantised to integers. Anchors go through the candidates in chunks of at most
about `CHUNK`, which every task gets; the candidates stay where they are read. A task cuts them
into blocks and makes one list per dimension, sorted by value. For an anchor the lists are read
from the end that its component's sign favours, some rows deeper each time; rows met for the
first time are scored whole by random access. What no list has shown yet scores at most the
threshold, the sum over the lists of the anchor's component times the value that was read last.
A list of best rows is complete when it is full and the threshold lies strictly below its last
score, so that ties are settled, or when the threshold lies below all scores it asks for.

The first pass gives each anchor its positives, and these the windows of scores for the second,
which gives the negatives. Every task sends its own best rows of an anchor, and the best of these remain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio_sync.llm.common import discarded, small_batches, written

SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
CHUNK = 8192  # anchors that go through the candidates together
BLOCK = 16_384  # candidates with lists of their own
FIRST_DEPTH, DEEPER = 32, 4

FOUND = "anchor_id long, slot int, score long, vec_id long"
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def taking_part(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))


def quantised(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python's where products of these could overflow."""
    whole = np.floor(values * float(scale))
    if not np.isfinite(whole).all() or np.abs(whole).max(initial=0) >= 1 << 24:
        whole = np.array([math.floor(x * float(scale)) if math.isfinite(x * float(scale)) else math.floor(x) * scale
                          for x in values.ravel().tolist()], object)
        return whole.reshape(values.shape)
    return whole.astype(np.int64)


def matrix(vectors: pa.Array, scale: int) -> np.ndarray:
    """Quantised rows of a list array whose lists have one length."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return quantised(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1), scale)


class Block:
    """Candidates of one dimension with a sorted list for each component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(rows, self.order, axis=0)

    def deeper(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """(places, scores, threshold) of the rows that sorted access meets, ever deeper; None as
        the threshold when there are no more."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        unseen, at, depth = np.ones(n, bool), 0, FIRST_DEPTH
        while True:
            if depth >= n or not len(up) + len(down):
                new, threshold = np.flatnonzero(unseen), None
            else:
                met = np.zeros(n, bool)
                met[self.order[n - depth:n - at, up]] = True
                met[self.order[at:depth, down]] = True
                new = np.flatnonzero(met & unseen)
                unseen[new] = False
                threshold = (anchor[up] * self.values[n - depth, up]).sum() + (anchor[down] * self.values[depth - 1, down]).sum()
            yield new, self.rows[new] @ anchor, threshold
            if threshold is None:
                return
            at, depth = depth, depth * DEEPER


class Best:
    """The best rows of one list: the first `k` by score and then id, with scores from low to high."""

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high, self.found = k, low, high, []

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        wanted = np.ones(len(ids), bool)
        if self.low is not None:
            wanted = (scores >= self.low) & (scores <= self.high)
        if len(self.found) == self.k:
            wanted &= scores >= self.found[-1][0]
        ids, scores = ids[wanted], scores[wanted]
        if len(ids) > 4 * self.k:  # what scores less than the k-th of different rows is out
            kth = np.partition(scores, len(scores) - 2 * self.k)[len(scores) - 2 * self.k] if scores.dtype != object else None
            if kth is not None and len(np.unique(ids[scores >= kth])) >= self.k:
                ids, scores = ids[scores >= kth], scores[scores >= kth]
        if len(ids):
            self.found = sorted({*self.found, *zip(scores.tolist(), ids.tolist())}, key=lambda f: (-f[0], f[1]))[:self.k]

    def complete(self, threshold) -> bool:
        """Whether no row that scores `threshold` or less can change it."""
        full = len(self.found) == self.k and threshold < self.found[-1][0]
        return full or (self.low is not None and (threshold < self.low or self.low > self.high))


def _search(anchors: list[tuple], same_label: bool, scale: int, block_rows: int):
    """For each of the (id, label, vector, windows) the task's best rows of its label or of others.

    A window is (slot, k, low, high)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[(slot, Best(k, low, high)) for slot, k, low, high in windows] for _, _, _, windows in anchors]
        queries = [(i, label, quantised(np.array(v, np.float64), scale)) for i, label, v, _ in anchors]

        def through(rows: pa.Table) -> None:
            lengths = np.array(rows["vector"].combine_chunks().value_lengths() if rows.num_rows else [], np.int64)
            for size in np.unique(lengths):  # vectors of different lengths have no product
                part = rows.filter(pa.array(lengths == size))
                block = Block(part["vec_id"].to_numpy(), part["label"].to_numpy(), matrix(part["vector"], scale))
                for (anchor, label, query), lists in zip(queries, best):
                    if len(query) != size:
                        continue
                    if block.rows.dtype == object:
                        query = query.astype(object)
                    for new, scores, threshold in block.deeper(query):
                        fit = (block.labels[new] == label) == same_label
                        fit &= block.ids[new] != anchor
                        for _, wanted in lists:
                            wanted.add(block.ids[new][fit], scores[fit])
                        if threshold is not None and all(wanted.complete(threshold) for _, wanted in lists):
                            break

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block_rows:
                through(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            through(pa.Table.from_batches(held))
        found = [
            (anchor, slot, min(max(score, LONG_MIN), LONG_MAX), i)
            for (anchor, _, _), lists in zip(queries, best) for slot, wanted in lists for score, i in wanted.found
        ]
        for start in range(0, len(found), 10_000):
            columns = list(zip(*found[start:start + 10_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["anchor_id", "slot", "score", "vec_id"])

    return search


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = N_POSITIVES, negatives: int = N_NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE, chunk: int = CHUNK, block_rows: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows of
    `vectors(vec_id, embedding, label, ...)` that `anchors` chooses.

    A score is the inner product of the quantised vectors, floor(scale * x). Positives are the
    anchor's best `positives` other rows of its label; negatives of each the best `negatives` of
    other labels that score from `low` to `high` percent of the positive; equal scores go by
    vec_id. Rows with a null id, label or vector, or a component that is null or not finite, take
    no part; vectors of different lengths do not meet; a vec_id that repeats with the same score
    counts once, and rows with the anchor's id are not among its own. Scores beyond a long
    are given as the nearest long, which also decides what negatives a positive has. An empty table, and anchors without positives or
    negatives, give no rows. Other columns are not read."""
    spark = vectors.sparkSession
    small_batches(spark)
    # with the chunk's size in mind the number of chunks follows the anchors; the driver holds one at a time
    chosen = taking_part(vectors.where(anchors))
    n_chunks = -(-chosen.count() // chunk)
    held = written(chosen.distinct().withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(max(n_chunks, 1)))), "anchors")
    rows = taking_part(vectors)
    parts = []
    for number in range(n_chunks):
        asked = held.where(F.col("chunk") == number).collect()
        first = [(a.vec_id, a.label, a.vector, [(0, positives, None, None)]) for a in asked]
        near = written(_first(rows.mapInArrow(_search(first, True, scale, block_rows), FOUND), positives), "positives")
        windows: dict[int, list] = {}
        for p in near.collect():  # `positives` a chunk's anchor
            # 100 * negative from low * positive to high * positive
            windows.setdefault(p.anchor_id, []).append((p.rank, negatives, -(-low * p.score // 100), high * p.score // 100))
        second = [(a.vec_id, a.label, a.vector, windows[a.vec_id]) for a in asked if a.vec_id in windows]
        ranked = _first(rows.mapInArrow(_search(second, False, scale, block_rows), FOUND), negatives)
        parts.append(written(ranked.alias("n").join(
            near.select(F.col("anchor_id").alias("of"), F.col("rank").alias("of_slot"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score")),
            (F.col("of") == F.col("anchor_id")) & (F.col("of_slot") == F.col("slot"))).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")), "negatives"))
        discarded(near)
    discarded(held)
    if not parts:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, parts)
