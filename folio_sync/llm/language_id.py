"""Language identification of text spans.

A word's script, by code point ranges, narrows the languages it may be in; per-word scores
are sums of log-probabilities of its letter trigrams; Viterbi with a penalty for each switch
labels the words of a text, so that a text in several languages falls into spans. The model
is counted over all training rows: trigrams, hashed to a fixed space, and scripts by language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio_sync.llm.common import in_batches, small_batches

BITS = 16  # hashed trigrams: a model has at most languages * 65,536 rows
SMOOTHING = 0.1
PENALTY = 12.0  # of a switch, in nats
SCRIPT_SHARE = 0.01  # of a language's letters, for the script to speak for it
CHUNK = 1 << 20  # letters scored at once
UNKNOWN = "und"

# Ranges of code points by script; other letters have script 0.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


_tables: list[np.ndarray] = []  # made once per task


def _letters() -> list[np.ndarray]:
    """By code point: the lower-case letter, 0 for anything else; the script."""
    if _tables:
        return _tables
    low = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            folded = c.lower()
            low[code] = ord(folded) if len(folded) == 1 else code
    script = np.zeros(0x110000, np.uint8)
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for first, last in ranges:
            script[first : last + 1] = number
    _tables.extend((low, script))
    return _tables


@dataclass
class Words:
    """The words of a piece of text: trigram of each letter, and words as ranges of letters."""
    trigrams: np.ndarray
    starts: np.ndarray
    scripts: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.trigrams)))


def words_of(text: str, bits: int = BITS) -> Words:
    low, script = _letters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = low[codes]
    padded = np.concatenate(([0], letter, [0])).astype(np.uint64)
    at = np.flatnonzero(letter)
    mixed = (padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
             + padded[at + 2] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    starts = np.flatnonzero(padded[at] == 0)
    return Words((mixed >> np.uint64(64 - bits)).astype(np.int64), starts, script[codes[at[starts]]])


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of about `CHUNK` characters that end at a space, if there is one."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + CHUNK) if len(text) > at + CHUNK else len(text)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


COUNTED = pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("n", pa.int64())])


def _counter(bits: int):
    """Trigram and script counts by language, summed in each task; script s is feature -1 - s."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

            def all_held():
                for lang, (trigrams, scripts) in held.items():
                    for feature in np.flatnonzero(trigrams):
                        yield lang, int(feature), int(trigrams[feature])
                    for number in np.flatnonzero(scripts):
                        yield lang, -1 - int(number), int(scripts[number])

            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if lang not in held:
                        if len(held) >= 64:  # many languages: send what there is
                            yield from all_held()
                            held.clear()
                        held[lang] = np.zeros(1 << bits, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)
                    for piece in pieces(text):
                        words = words_of(piece, bits)
                        held[lang][0][:] += np.bincount(words.trigrams, minlength=1 << bits)
                        held[lang][1][:] += np.bincount(
                            words.scripts, weights=words.lengths, minlength=len(SCRIPTS) + 1).astype(np.int64)
            yield from all_held()

        yield from in_batches(rows(), COUNTED, 20000)

    return run


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # trigram x language
    scripts: np.ndarray  # script x language: 0, or a score that rules the language out

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.starts):
            return np.zeros((0, len(self.langs)))
        sums = np.add.reduceat(self.scores[words.trigrams].astype(np.float64), words.starts, axis=0)
        return sums + self.scripts[words.scripts]


def train(labelled: DataFrame, bits: int = BITS) -> Model:
    """The model of all rows of `labelled(lang, text)`; rows with a null in either teach nothing."""
    small_batches(labelled.sparkSession)
    counted = (
        labelled.select(F.col("lang").cast("string"), "text").where("lang is not null and text is not null")
        .mapInArrow(_counter(bits), "lang string, feature int, n long")
        .groupBy("lang", "feature").agg(F.sum("n").alias("n"))
        .toArrow()  # at most languages * (2^bits + scripts) rows
    )
    langs = sorted(set(counted.column("lang").to_pylist()))
    place = {lang: i for i, lang in enumerate(langs)}
    columns = np.array([place[x] for x in counted.column("lang").to_pylist()], np.int64)
    features, n = counted.column("feature").to_numpy(), counted.column("n").to_numpy()
    counts, scripts = np.zeros((1 << bits, len(langs))), np.zeros((len(SCRIPTS) + 1, len(langs)))
    is_script = features < 0
    counts[features[~is_script], columns[~is_script]] = n[~is_script]
    scripts[-1 - features[is_script], columns[is_script]] = n[is_script]
    # smoothing is spread over the trigrams that occur at all, so that junk favours no language
    seen = max(1, int((counts.sum(1) > 0).sum()))
    scores = np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * seen)) if langs else counts
    spoken = scripts / np.maximum(1, scripts.sum(0)) >= SCRIPT_SHARE
    ruled = np.where(spoken | ~spoken.any(1, keepdims=True), 0.0, -1e6) if langs else scripts
    return Model(langs, scores.astype(np.float32), ruled)


def best_path(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The languages of the words with the largest sum of scores less the penalty of each switch."""
    n, k = scores.shape
    best = int(np.argmax(scores.sum(0)))
    if k > 1:
        # A stretch inside costs two switches and one at an end costs one, less where such stretches
        # touch. If none gains a switch inside, nor half a switch at an end, one language is best.
        ahead = np.cumsum(scores - scores[:, best : best + 1], axis=0)
        low = np.minimum(np.minimum.accumulate(np.vstack((np.zeros(k), ahead[:-1])), axis=0), 0)
        ends = max(ahead.max(), (ahead[-1] - low[-1]).max())
        if (ahead - low).max() > penalty or ends > penalty / 2:
            return _viterbi(scores, penalty)
    return np.full(n, best)


def _viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    n, k = scores.shape
    back = np.zeros((n, k), np.int32)
    stay = np.arange(k)
    value = scores[0].copy()
    for t in range(1, n):
        top = int(value.argmax())
        switch = value[top] - penalty
        moved = value < switch
        back[t] = np.where(moved, top, stay)
        value = np.where(moved, switch, value) + scores[t]
    path = np.zeros(n, np.int32)
    path[-1] = value.argmax()
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def label(model: Model, text: str | None, penalty: float = PENALTY) -> tuple[str, float, list[tuple[str, int, int]]]:
    """Language, share of letters in it, and spans (language, first word, words) of a text."""
    parts = [words_of(p, int(math.log2(len(model.scores)))) for p in pieces(text or "")] if model.langs else []
    parts = [p for p in parts if len(p.starts)]
    if not parts:
        return UNKNOWN, 0.0, []
    path = best_path(np.concatenate([model.word_scores(p) for p in parts]), penalty)
    letters = np.bincount(path, weights=np.concatenate([p.lengths for p in parts]), minlength=len(model.langs))
    top = int(letters.argmax())
    edges = np.append(np.flatnonzero(np.diff(path, prepend=-1)), len(path))
    spans = [(model.langs[path[a]], int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:])]
    return model.langs[top], float(letters[top] / letters.sum()), spans


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """`docs` with lang_pred, lang_score and lang_spans (language, first word, words) added; columns
    of `docs` with these names are replaced. Only the text is looked at."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(astuple(model))  # its size is fixed by languages * 2^BITS

    def run(column: pd.Series) -> pd.DataFrame:

        known = Model(*shared.value)
        found = [label(known, text, penalty) for text in column]
        return pd.DataFrame({
            "lang": [f[0] for f in found], "score": [f[1] for f in found],
            "spans": [[{"lang": a, "first": b, "words": c} for a, b, c in f[2]] for f in found],
        })

    udf = F.pandas_udf(run, "lang string, score double, spans array<struct<lang:string,first:long,words:long>>")
    found = docs.withColumn("__found", udf("text"))
    return found.withColumns({
        "lang_pred": F.col("__found.lang"), "lang_score": F.col("__found.score"), "lang_spans": F.col("__found.spans"),
    }).drop("__found")


def predict_languages(docs: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """One row per row of `docs(doc_id, text, lang, ...)`: doc_id, held_out, lang_pred, score, n_spans.

    Learns from text and language of the rows that are not held out and predicts all rows from
    the text alone. A text that is null or has no letter is `und` with score 0, and so is every
    text if nothing could be learned. Ties go to the language first in order; equal rows get equal
    predictions; an empty table gives no rows; other columns are not read."""
    model = train(docs.where(~held_out()))
    return identify(docs.select(F.col("doc_id").cast("long"), "text"), model, penalty).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.size("lang_spans").alias("n_spans"))
