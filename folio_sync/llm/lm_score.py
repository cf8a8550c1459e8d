"""Scores of documents by masked pseudo-likelihood.

A small network predicts each token from the two tokens on either side: a table of vectors for
each offset, their sum through tanh, and a softmax in two steps, first the token's class, then
the token in it. A document's score is the sum, over all its tokens, of the log-probability
of the token given its neighbours. A word outside the network's vocabulary is one of `RARE` endings
there; the log-probability of the word among all words of its ending, by their counts in the corpus,
is added by a join, so that the score is one of the word and knows every word of the corpus.
Training runs where the tokens are: in every round each task trains a copy of the network on its own
rows with numpy, and the copies are averaged by the tokens they saw. The rounds take every token once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.llm.common import in_batches, small_batches, written

CLASSES, IN_CLASS = 32, 32
TOKENS = CLASSES * IN_CLASS
RARE = 64  # token ids for words outside the vocabulary, by their ending
OFFSETS = (-2, -1, 1, 2)
HIDDEN = 24
ROUNDS, STRIDE = 2, 2  # round r trains on every STRIDE-th token of each document, from the r-th
BATCH, RATE = 512, 0.1
BLOCK = 1024  # parameters averaged together
CHUNK = 1 << 16  # tokens scored together
TILE = 4096  # of them, those whose arrays are held at a time
HELD_WORDS = 400_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode(errors="surrogatepass").lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def rows():
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(words_of(text))
                if len(held) > HELD_WORDS:
                    yield from held.items()
                    held.clear()
        yield from held.items()

    yield from in_batches(rows(), schema, 20000)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): every word of all documents."""
    return docs.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _numbered(counts: DataFrame) -> dict[bytes, int]:
    top = counts.orderBy(F.desc("n"), "word").limit(TOKENS - RARE).collect()
    return {bytes(r[0]): RARE + i for i, r in enumerate(top)}


def vocabulary(docs: DataFrame) -> dict[bytes, int]:
    """The most frequent words of all documents, numbered by frequency after the rare endings."""
    return _numbered(word_counts(docs))


def _ending(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word[-3:]) % RARE


def _key(word: bytes) -> int:
    """A signed 64-bit hash."""
    found = xxhash.xxh3_64_intdigest(word)
    return found - (1 << 64) if found >= 1 << 63 else found


def rare_words(counts: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """(word_key, within): the log-probability of each word outside the vocabulary among the words of its ending."""
    held = counts.sparkSession.sparkContext.broadcast(frozenset(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word_key", pa.int64()), ("ending", pa.int32()), ("n", pa.int64())])
        rows = ((_key(word), _ending(word), n) for b in batches for word, n in zip(*(c.to_pylist() for c in b.columns))
                if word not in held.value)
        yield from in_batches(rows, schema, 20000)

    rare = written(
        counts.select("word", "n").mapInArrow(run, "word_key long, ending int, n long")
        .groupBy("word_key", "ending").agg(F.sum("n").alias("n")), "rare-words")
    of = rare.groupBy("ending").agg(F.sum("n").alias("of"))  # at most RARE rows
    return rare.join(of, "ending").select("word_key", F.log(F.col("n") / F.col("of")).alias("within"))


class _Ids(dict):
    """Word -> token id; other words get one of `RARE` ids by their last three bytes."""

    def __init__(self, known: dict[bytes, int]):
        super().__init__(known)
        self.known = known

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
            self.update(self.known)
        found = _ending(word)
        if len(word) <= 64:
            self[word] = found
        return found


def encode(docs: DataFrame, known: dict[bytes, int], with_rare: bool = False) -> DataFrame:
    """(doc_id, ids): token ids as bytes of little-endian 16-bit numbers.

    `with_rare` adds a number of the row, and hashes of its different rare words with their counts."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    ddl = "doc_id long, ids binary"
    if with_rare:
        for name, kind in (("row", pa.int64()), ("keys", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))):
            schema = schema.append(pa.field(name, kind))
        ddl += ", row long, keys array<long>, times array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(known)

        def rows():
            row = TaskContext.get().partitionId() << 40
            for batch in batches:
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    words = words_of(text)
                    found = np.fromiter(map(ids.__getitem__, words), "<u2", len(words))
                    if with_rare:
                        rare = Counter(words[i] for i in np.flatnonzero(found < RARE))
                        yield doc_id, found.tobytes(), row, [_key(w) for w in rare], list(rare.values())
                        row += 1
                    else:
                        yield doc_id, found.tobytes()

        yield from in_batches(rows(), schema, 500)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


SHAPES = {
    "tables": (len(OFFSETS), TOKENS + 1, HIDDEN), "bias": (HIDDEN,),
    "class_out": (HIDDEN, CLASSES), "class_bias": (CLASSES,),
    "word_out": (CLASSES, HIDDEN, IN_CLASS), "word_bias": (CLASSES, IN_CLASS),
}


REST_SHAPES = {name: shape for name, shape in SHAPES.items() if name != "tables"}  # they come first
TABLES = int(np.prod(SHAPES["tables"]))
REST = sum(int(np.prod(s)) for s in REST_SHAPES.values())


def unpacked(flat: np.ndarray, shapes: dict[str, tuple] = SHAPES) -> dict[str, np.ndarray]:
    """Views of the parts of one vector of parameters."""
    parts, at = {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        parts[name] = flat[at : at + size].reshape(shape)
        at += size
    return parts


def fresh(seed: int = 11) -> np.ndarray:
    size = sum(int(np.prod(s)) for s in SHAPES.values())
    flat = np.random.default_rng(seed).normal(0, 0.05, size).astype(np.float32)
    for name in ("bias", "class_bias", "word_bias"):
        unpacked(flat)[name][:] = 0
    return flat


def contexts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Neighbours of the tokens `at`; beyond the ends stands the number `TOKENS`."""
    reach = max(OFFSETS)
    padded = np.full(len(ids) + 2 * reach, TOKENS, np.int64)
    padded[reach : reach + len(ids)] = ids
    return np.stack([padded[at + reach + o] for o in OFFSETS], axis=1)


def hidden(p: dict[str, np.ndarray], near: np.ndarray) -> np.ndarray:
    found = p["tables"][0][near[:, 0]]
    for j in range(1, len(OFFSETS)):
        found += p["tables"][j][near[:, j]]
    found += p["bias"]
    return np.tanh(found, out=found)


def _by_class(classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that brings tokens of a class together, and (class, begin, end) in it."""
    edges = [0, *np.cumsum(np.bincount(classes, minlength=CLASSES)).tolist()]
    return (np.argsort(classes.astype(np.uint8), kind="stable"),
            [(c, edges[c], edges[c + 1]) for c in range(CLASSES) if edges[c] < edges[c + 1]])


def _word_logits(p: dict[str, np.ndarray], h: np.ndarray, spans: list[tuple[int, int, int]], classes: np.ndarray) -> np.ndarray:
    """(word in its class, token): of tokens ordered by class."""
    found = np.empty((len(h), IN_CLASS), h.dtype)
    for c, begin, end in spans:
        np.matmul(h[begin:end], p["word_out"][c], out=found[begin:end])
    found += p["word_bias"][classes]
    return np.ascontiguousarray(found.T)


def log_probs(p: dict[str, np.ndarray], near: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    found = np.empty(len(tokens), p["bias"].dtype)
    for first in range(0, len(tokens), TILE):
        part = slice(first, first + TILE)
        order, spans = _by_class(tokens[part] // IN_CLASS)
        token, at = tokens[part][order], np.arange(len(order))
        classes, h = token // IN_CLASS, hidden(p, near[part][order])
        total = np.zeros(len(order), found.dtype)
        for logits, target in (
            (p["class_out"].T @ h.T + p["class_bias"][:, None], classes),
            (_word_logits(p, h, spans, classes), token % IN_CLASS),
        ):
            logits -= logits.max(axis=0)
            total += logits[target, at]
            total -= np.log(np.exp(logits, out=logits).sum(axis=0))
        found[first + order] = total
    return found


def _off(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """In place: probabilities, less one where the token is; a row per token."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    logits[target, np.arange(len(target))] -= 1
    return np.ascontiguousarray(logits.T)


def _gradient_parts(p: dict[str, np.ndarray], near: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the mean negative log-probability: the rows of `tables`, as of one table, that take part,
    their gradients, and those of all other parameters as one vector."""
    rest = np.zeros(REST, np.float32)
    g = unpacked(rest, REST_SHAPES)
    order, spans = _by_class(tokens // IN_CLASS)
    near, tokens = near[order], tokens[order]
    classes = tokens // IN_CLASS
    h = hidden(p, near)
    turned = np.ascontiguousarray(h.T)
    off = _off(p["class_out"].T @ turned + p["class_bias"][:, None], classes)
    g["class_out"][:], g["class_bias"][:] = turned @ off, off.sum(axis=0)
    back = off @ p["class_out"].T
    off = _off(_word_logits(p, h, spans, classes), tokens % IN_CLASS)
    for c, begin, end in spans:
        part = off[begin:end]
        g["word_out"][c] = turned[:, begin:end] @ part
        back[begin:end] += part @ p["word_out"][c].T
    g["word_bias"][[c for c, _, _ in spans]] = np.add.reduceat(off, [begin for _, begin, _ in spans], axis=0)
    back *= 1 - h * h
    g["bias"][:] = back.sum(axis=0)
    rest /= len(tokens)
    back /= len(tokens)
    # a row that takes part many times in a batch is added up first
    rows = (near + np.arange(len(OFFSETS)) * (TOKENS + 1)).ravel()
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return rows[starts], np.add.reduceat(back[order // len(OFFSETS)], starts, axis=0), rest


def gradients(p: dict[str, np.ndarray], near: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Of the mean negative log-probability, as one vector like the parameters."""
    rows, sums, rest = _gradient_parts(p, near, tokens)
    flat = np.zeros(TABLES + REST, np.float32)
    flat[:TABLES].reshape(-1, HIDDEN)[rows] = sums
    flat[TABLES:] = rest
    return flat


def _descend(values: np.ndarray, squares: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of Adagrad."""
    squares = squares + g * g
    return values - RATE * g / np.sqrt(squares), squares


def _trainer(shared, turn: int):
    """A task's copy of the network after its rows, in blocks, with the tokens it saw."""
    schema = pa.schema([("block", pa.int32()), ("task", pa.int32()), ("seen", pa.int64()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.frombuffer(shared.value, np.float32).copy()
        p, squares = unpacked(flat), np.full(len(flat), 1e-6, np.float32)
        seen, near, tokens = 0, [], []

        tables, table_squares = (v[:TABLES].reshape(-1, HIDDEN) for v in (flat, squares))

        def step(context: np.ndarray, token: np.ndarray) -> None:
            rows, sums, rest = _gradient_parts(p, context, token)
            tables[rows], table_squares[rows] = _descend(tables[rows], table_squares[rows], sums)
            flat[TABLES:], squares[TABLES:] = _descend(flat[TABLES:], squares[TABLES:], rest)

        for batch in batches:
            for body in batch.column(0).to_pylist():
                ids = np.frombuffer(body, "<u2").astype(np.int64)
                at = np.arange(turn % STRIDE, len(ids), STRIDE)
                near.append(contexts(ids, at))
                tokens.append(ids[at])
                seen += len(at)
            if near:
                context, token = np.concatenate(near), np.concatenate(tokens)
                full = len(token) // BATCH * BATCH
                for first in range(0, full, BATCH):
                    step(context[first : first + BATCH], token[first : first + BATCH])
                near, tokens = [context[full:]], [token[full:]]
        if near and len(tokens[0]):
            step(near[0], tokens[0])
        if seen:
            task = TaskContext.get().partitionId()
            rows = ((i // BLOCK, task, seen, flat[i : i + BLOCK].tobytes()) for i in range(0, len(flat), BLOCK))
            yield from in_batches(rows, schema)

    return run


def _average(block: pd.DataFrame) -> pd.DataFrame:
    """In the order of the tasks, so that reruns agree."""
    block = block.sort_values("task")
    seen = block["seen"].to_numpy(np.float64)
    values = np.stack([np.frombuffer(v, np.float32) for v in block["values"]])
    mean = (values * (seen / seen.sum())[:, None]).sum(axis=0).astype(np.float32)
    return pd.DataFrame({"block": [block["block"].iloc[0]], "values": [mean.tobytes()]})


def train(encoded: DataFrame, rounds: int = ROUNDS) -> bytes:
    """Parameters of the network; their number is fixed, whatever the corpus."""
    context = encoded.sparkSession.sparkContext
    flat = fresh().tobytes()
    for turn in range(rounds):
        shared = context.broadcast(flat)
        blocks = (
            encoded.select("ids").mapInArrow(_trainer(shared, turn), "block int, task int, seen long, values binary")
            .groupBy("block").applyInPandas(_average, "block int, values binary").collect()
        )
        flat = b"".join(bytes(v) for _, v in sorted((b, v) for b, v in blocks)) or flat
    return flat


def _scorer(shared):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unpacked(np.frombuffer(shared.value, np.float32))

        def scored(held: list[tuple]) -> Iterator[tuple]:
            """Parts of documents ((doc_id, row), tokens of the document, neighbours, tokens, last part?)."""
            found = log_probs(p, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]))
            at = 0
            for doc, n, _, tokens, last in held:
                yield doc, n, float(found[at : at + len(tokens)].sum(dtype=np.float64)), last
                at += len(tokens)

        def parts() -> Iterator[tuple]:
            held, size = [], 0
            for batch in batches:
                for doc_id, row, body in zip(*(c.to_pylist() for c in batch.columns)):
                    ids = np.frombuffer(body, "<u2").astype(np.int64)
                    for first in range(0, max(1, len(ids)), CHUNK):
                        at = np.arange(first, min(len(ids), first + CHUNK))
                        held.append(((doc_id, row), len(ids), contexts(ids, at), ids[at], first + CHUNK >= len(ids)))
                        size += len(at)
                        if size >= CHUNK:
                            yield from scored(held)
                            held, size = [], 0
            if held:
                yield from scored(held)

        def rows():
            total = 0.0
            for doc, n, part, last in parts():
                total += part
                if last:
                    yield *doc, n, total
                    total = 0.0

        yield from in_batches(rows(), schema)

    return run


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: doc_id, n_tokens, log_prob, mean_log_prob.

    Tokens are the words of the whole text, A-Z folded. A null text or one without words has no
    tokens, log_prob 0 and a null mean; an empty table gives no rows; equal texts get equal
    scores; other columns are not read. The network depends on how the rows lie in partitions.
    Rare words are told apart by 64-bit hashes."""
    spark = docs.sparkSession
    small_batches(spark)
    counts = written(word_counts(docs), "word-counts")
    known = _numbered(counts)
    encoded = written(encode(docs, known, with_rare=True), "token-ids")
    shared = spark.sparkContext.broadcast(train(encoded, rounds))
    used = encoded.select("row", F.explode(F.arrays_zip("keys", "times")).alias("w")).select(
        "row", F.col("w.keys").alias("word_key"), F.col("w.times").alias("times"))
    # added up as decimals, so that the order of the rows does not matter
    within = used.join(rare_words(counts, known), "word_key").groupBy("row").agg(
        F.sum((F.col("times") * F.col("within")).cast("decimal(38,12)")).cast("double").alias("within"))
    scored = encoded.select("doc_id", "row", "ids").mapInArrow(
        _scorer(shared), "doc_id long, row long, n_tokens long, log_prob double")
    return scored.join(within, "row", "left").select(
        "doc_id", "n_tokens", (F.col("log_prob") + F.coalesce("within", F.lit(0.0))).alias("log_prob"),
    ).withColumn("mean_log_prob", F.try_divide("log_prob", "n_tokens"))
