"""Maximal periodic runs of words, found by string synchronising sets.

Words of a batch of documents stand in one array, with numbers that no two documents share.
The substrings of 1, 2, 4, ... words get names, equal ones of a document the same; a substring
that does not occur again is dead, and only positions that are alive are sorted and looked at
on the next level.

A run of period q is looked for at the scale t, a power of two, with 3t - 1 <= q <= 6t - 2. A
position is in the synchronising set of t if the least hash among the substrings of t words
that start at it or up to t words later is that of the first or of the last, where highly
periodic substrings (period of t / 3 or less) have no hash. Whether a position belongs to the set depends on 2t words
alone, so within a run it and the position q later both do or both do not; and of t positions
in a row one does, unless 3t - 1 words are highly periodic. Two of them with equal contexts of
2t words propose the period between them. A run that this misses starts with a highly periodic
region, which a smaller scale has found, and goes on behind its end; there the context behind
the end proposes the periods of the equal contexts inside the region. Runs of period 1 are
read off directly. Proposals are extended to both sides by names from long to short; of those
with the same ends the one with the smallest period is the run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.llm.common import WORDS, small_batches

MIN_WORDS = 12
BATCH_WORDS = 400_000

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")


def _names(ids: np.ndarray) -> list[np.ndarray]:
    """For each power of two the name of the substring at a position, -1 where it does not occur again."""
    level = ids.astype(np.int64)
    level = np.where(np.bincount(level, minlength=1)[level] > 1, level, -1) if len(level) else level
    levels, width = [level.astype(np.int32)], 1
    while True:
        last = levels[-1]
        n = len(last) - width
        if n <= 0:
            break
        at = np.flatnonzero((last[:n] >= 0) & (last[width:] >= 0))
        if not len(at):
            break
        pair = last[at].astype(np.int64) << 32 | last[at + width].astype(np.int64)
        _, name, count = np.unique(pair, return_inverse=True, return_counts=True)
        again = count[name] > 1
        if not again.any():
            break
        level = np.full(len(last), -1, np.int32)
        level[at[again]] = name[again]
        levels.append(level)
        width *= 2
    return levels


def _extended(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretch around each pair a < b of equal words with words b - a apart identical."""
    def grown(one: np.ndarray, two: np.ndarray, step: int) -> np.ndarray:
        """How far equality goes on from the pair, to the right (it included) or to the left (it not)."""
        length = np.zeros(len(one), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            width, names = 1 << k, levels[k]
            left = np.arange(len(one))
            while len(left):
                x = one[left] + (length[left] if step > 0 else -length[left] - width)
                y = two[left] + (length[left] if step > 0 else -length[left] - width)
                inside = (x >= 0) & (y < size)
                left, x, y = left[inside], x[inside], y[inside]
                same = (names[x] >= 0) & (names[x] == names[y])
                left = left[same]
                length[left] += width
                if k < len(levels) - 1:
                    break  # two steps of a width are one of the next
        return length

    return a - grown(a, b, -1), b + grown(a, b, 1)


def _hashed(names: np.ndarray, salt: int) -> np.ndarray:
    """Different names have different hashes, in an order that does not follow them."""
    x = (names.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


NO_HASH = np.uint64(2**64 - 1)


def _synchronising(names: np.ndarray, context: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """The positions of the set among those with a context that occurs again."""
    alive = np.flatnonzero(names >= 0)  # a context's positions lie next to each other here
    hashes = _hashed(names[alive], tau)
    hashes[periodic[alive]] = NO_HASH
    least, width = hashes, 1
    while width < tau:
        least = np.concatenate([np.minimum(least[:-width], least[width:]), least[-width:]])
        width *= 2
    at = np.flatnonzero(context[alive] >= 0)
    low = np.minimum(least[at], hashes[at + tau])
    chosen = (low != NO_HASH) & ((low == hashes[at]) | (low == hashes[at + tau]))
    return alive[at[chosen]]


def _pairs(at: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with equal contexts and a distance from low to high."""
    order = np.lexsort((at, context[at]))
    at = at[order]
    name, lefts, rights, step = context[at], [], [], 1
    while step < len(at):
        gap = at[step:] - at[:-step]
        near = (name[step:] == name[:-step]) & (gap <= high)
        if not near.any():
            break
        good = near & (gap >= low)
        lefts.append(at[:-step][good])
        rights.append(at[step:][good])
        step += 1
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *lefts]), np.concatenate([empty, *rights])


def _behind(ends: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions low to high before the end of a highly periodic region with the end's context."""
    ends = ends[ends < len(context)]
    ends = np.unique(ends[context[ends] >= 0])
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for some in np.array_split(ends, len(ends) * (high - low + 1) // 1_000_000 + 1):
        at = some[:, None] - np.arange(low, high + 1)
        same = (at >= 0) & (context[np.maximum(at, 0)] == context[some][:, None])
        lefts.append(at[same])
        rights.append(np.broadcast_to(some[:, None], at.shape)[same])
    return np.concatenate(lefts), np.concatenate(rights)


def find_runs(ids: np.ndarray) -> np.ndarray:
    """(start, end, period) of all maximal runs with two periods or more, by start and period.

    `ids` are word numbers from 0; equal ones are equal words."""
    size = len(ids)
    levels = _names(np.asarray(ids))
    runs = np.zeros((0, 3), np.int64)

    def add(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal runs
        if not len(a):
            return
        start, end = _extended(levels, a, b, size)
        found = np.stack([start, end, b - a], axis=1)
        found = found[found[:, 1] - found[:, 0] >= 2 * found[:, 2]]
        runs = np.concatenate([runs, found])
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[first]

    at = np.flatnonzero((levels[0][1:] >= 0) & (levels[0][1:] == levels[0][:-1])) if size > 1 else np.zeros(0, np.int64)
    if len(at):  # of a stretch of equal words its first pair is enough
        at = at[np.concatenate([[True], np.diff(at) > 1])]
        add(at, at + 1)
    for k in range(len(levels) - 1):
        tau = 1 << k
        low, high = 3 * tau - 1, 6 * tau - 2
        names, context = levels[k], levels[k + 1]
        length = runs[:, 1] - runs[:, 0]
        regions = runs[(runs[:, 2] * 3 <= tau) & (length >= tau)]
        marks = np.zeros(size + 1, np.int64)
        np.add.at(marks, regions[:, 0], 1)
        np.add.at(marks, regions[:, 1] - tau + 1, -1)
        periodic = np.cumsum(marks)[:size] > 0
        one, two = _pairs(_synchronising(names, context, tau, periodic), context, low, high)
        ends = regions[regions[:, 1] - regions[:, 0] >= low][:, 1]
        three, four = _behind(ends, context, low, high)
        add(np.concatenate([one, three]), np.concatenate([two, four]))
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def _rows(held: list[tuple], min_words: int) -> Iterator[tuple]:
    """Result rows of (doc_id, words) documents, worked on together."""
    ids, begins, base = [], [0], 0
    for _, words in held:
        seen: dict[bytes, int] = {}
        ids.extend([base + seen.setdefault(w, len(seen)) for w in words])
        base += len(seen)
        begins.append(len(ids))
    runs = find_runs(np.asarray(ids, np.int64))
    length = runs[:, 1] - runs[:, 0]
    runs = runs[length >= np.maximum(min_words, 2 * runs[:, 2])]
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 1], -1)
    dropped = np.cumsum(marks) > 0
    bounds = np.searchsorted(runs[:, 0], begins)
    for n, (doc_id, words) in enumerate(held):
        own = [(s - begins[n], e - s, q) for s, e, q in runs[bounds[n]:bounds[n + 1]].tolist()]
        best = min(own, key=lambda r: (-r[1], r[0], r[2]), default=None)
        gone = dropped[begins[n]:begins[n + 1]]
        n_dropped = int(gone.sum())
        kept = [w for w, g in zip(words, gone.tolist()) if not g] if n_dropped else words
        yield (
            doc_id, len(own), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            _digest("".join(f"{s},{m},{q}\n" for s, m, q in own).encode()), _digest(b" ".join(kept)),
            len(words), n_dropped,
        )


def _scan(batch_words: int, min_words: int):
    schema = pa.schema([
        pa.field(name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (column.split() for column in SCHEMA.split(", "))])

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*_rows(held, min_words)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            for doc_id, text in zip(rows["doc_id"].to_pylist(), rows["text"]):
                # bytes are split at the six signs of white space that count, and no others
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if held and size + len(words) > batch_words:
                    yield batch(held)
                    held, size = [], 0
                held.append((doc_id, words))
                size += len(words)
        if held:
            yield batch(held)

    return scan


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, batch_words: int = BATCH_WORDS) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: doc_id, n_runs, the longest run's start, length,
    period and exponent_milli, runs_sha256, collapsed_sha256, n_words, n_dropped.

    A run is a maximal stretch of words with smallest period q, of at least `min_words` words and
    two periods. Of runs of one length the first is the longest, then the one of the smaller
    period. Collapsed, a text loses the words behind the first period of any run. Null and empty
    texts have no words and no run, so their longest run is null; an empty table gives no rows;
    rows are looked at one by one, so repeated rows give equal rows and null ids stay. A text is
    worked on whole in one task, some 60 bytes a word. Other columns are not read."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_scan(batch_words, min_words), SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the documents, chosen by a hash of the id, repeat words to their ends.

    With h the crc32 of the id in decimal and g = floor(h / 10), the words of a text of n words go on
    periodically from word a = g mod n on, with period 1 + floor((n - a) / (3 + g mod 8)), if h is
    divisible by 10. Texts without words, and all others, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    words = F.when(F.col("g").isNotNull(), F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)))
    # through an explode of one element, so that the words are not found again for each of them
    split = chosen.select("doc_id", "text", F.explode(F.array(F.struct("g", words.alias("words")))).alias("of")).select(
        "doc_id", "text", "of.*")
    n = F.size("words")
    a = F.when(n > 0, F.col("g") % n)
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    placed = split.select("doc_id", "text", F.explode(F.array(F.struct(
        "words", a.cast("int").alias("a"), p.cast("int").alias("p")))).alias("of")).select("doc_id", "text", "of.*")
    planted = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(planted, " ")).otherwise(
        F.col("text")).alias("text"))
