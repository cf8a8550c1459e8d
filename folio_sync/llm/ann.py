"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Candidates are dealt into cells. In a cell each vector, less the cell's mean and scaled to
length one, is rotated at random into `bits` dimensions, and only the signs are kept, packed,
with two correction scalars: its length and the cosine between the rotated vector and its
signs. A query's inner products are estimated from the packed signs; the estimate's error is
bounded with high probability, so that only candidates whose upper bound reaches the k-th
largest lower bound are computed exactly. Queries and candidates meet in blocks: every cell
sees every query block once, and the cells' k best are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio_sync.llm.common import written

BITS = 256
ERROR_SIZE = 3.0  # standard deviations of the estimate's error that the bounds allow for
CELL_ROWS = 8192
QUERY_ROWS = 4096
AT_ONCE = 256  # queries estimated together


def usable(vector: str) -> Column:
    """Not null, not zero, and every component finite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """bits x dim with orthonormal columns."""
    rows = max(bits, dim)
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((rows, dim)))[0]


class Codes:
    """Packed signs and correction scalars of the vectors of a cell."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        self.mean = vectors.mean(axis=0)
        rest = vectors - self.mean
        self.length = np.linalg.norm(rest, axis=1)
        turned = (rest / np.where(self.length > 0, self.length, 1)[:, None]) @ turn.T
        self.bits = turned.shape[1]
        self.packed = np.packbits(turned > 0, axis=1)
        cosine = np.abs(turned).sum(axis=1) / math.sqrt(self.bits)
        self.cosine = np.where(self.length > 0, cosine, 1.0)

    def estimates(self, queries: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products, candidates x queries, and their error bounds."""
        signs = np.unpackbits(self.packed, axis=1, count=self.bits).astype(np.float32) * 2 - 1
        raw = signs @ (queries @ turn.T).T.astype(np.float32) / math.sqrt(self.bits)
        scale = self.length / self.cosine
        found = raw * scale[:, None] + (queries @ self.mean)[None, :]
        spread = self.length * np.sqrt(np.maximum(0, 1 - self.cosine**2)) / self.cosine
        bound = spread * (ERROR_SIZE / math.sqrt(max(1, self.bits - 1)))
        slack = 1e-5 * self.length + 1e-5 * np.linalg.norm(self.mean)  # of single precision
        return found, (bound + slack)[:, None] * np.linalg.norm(queries, axis=1)[None, :]


def _distinct(ids: pd.Series, vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """By id; of rows that repeat an id the first in order of the components."""
    found = np.stack([np.asarray(v, np.float64) for v in vectors])
    order = np.lexsort((*found.T[::-1], ids.to_numpy()))
    kept = ids.to_numpy()[order]
    first = np.append(True, kept[1:] != kept[:-1])
    return kept[first], found[order][first]


def _search(k: int, bits: int, seed: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            ids, vectors = _distinct(candidates["vec_id"], candidates["vector"])
            query_ids, asked = _distinct(queries["query_id"], queries["query"])
            turn = rotation(vectors.shape[1], bits, seed)
            codes = Codes(vectors, turn)
            for at in range(0, len(asked), AT_ONCE):
                block, block_ids = asked[at : at + AT_ONCE], query_ids[at : at + AT_ONCE]
                found, error = codes.estimates(block, turn)
                own = ids[:, None] == block_ids[None, :]
                low = np.where(own, -np.inf, found - error)
                need = np.partition(low, -k, axis=0)[-k] if len(ids) > k else np.full(len(block), -np.inf)
                chosen = (found + error >= need[None, :]) & ~own
                for j, query_id in enumerate(block_ids):
                    rows = np.flatnonzero(chosen[:, j])
                    exact = (vectors[rows] * block[j]).sum(axis=1)
                    best = np.lexsort((ids[rows], -exact))[:k]
                    out.append(pd.DataFrame({
                        "query_id": query_id, "vec_id": ids[rows[best]], "score": exact[best],
                        "reranked": len(rows)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "reranked": []})

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, bits: int = BITS,
    cell_rows: int = CELL_ROWS, query_rows: int = QUERY_ROWS, seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query row of
    `vectors(vec_id, embedding, ...)` with all other rows, nearest first, ties to the smaller id.

    Vectors that are null, zero or hold a null or non-finite component take no part; neither do
    null ids. Rows that repeat a vec_id are one vector, the first in order of components.
    Vectors are compared with those of their own length. A query with fewer candidates than k
    gets all of them; empty tables give no rows; other columns are not read."""
    good = written(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"),
                       F.coalesce(is_query, F.lit(False)).alias("asked"))
        .where(F.col("vec_id").isNotNull() & usable("vector")),
        "vectors",
    )
    rows, asked = good.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    cells, blocks = max(1, math.ceil(rows / cell_rows)), max(1, math.ceil((asked or 0) / query_rows))
    dim, spread = F.size("vector").alias("dim"), F.xxhash64("vec_id")
    dealt = good.select(
        "vec_id", "vector", dim, F.pmod(spread, F.lit(cells)).cast("int").alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = good.where("asked").select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), dim, F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"),
        F.pmod(spread, F.lit(blocks)).cast("int").alias("block"))
    keys = ("dim", "cell", "block")
    found = dealt.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        _search(k, bits, seed), "query_id long, vec_id long, score double, reranked long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
