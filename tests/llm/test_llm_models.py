"""Operators that learn or search: language identification, LM scores, nearest neighbours."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import awkward_texts, empty, frame
from pyspark.sql import functions as F

from folio_sync.llm import ann, language_id, lm_score

SF_DIR = "/root/testdata/sf0.01"


# Language identification

def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = language_id.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got) and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_awkward_texts(spark):
    texts = awkward_texts()
    got = {r.doc_id: r for r in language_id.predict_languages(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        if not any(c.isalpha() for c in text or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        else:
            assert got[i].lang_pred in ("en", "de")
    assert language_id.predict_languages(empty(spark)).count() == 0
    unlabelled = frame(spark, ["abc"], langs=(None,))
    assert language_id.predict_languages(unlabelled).first().lang_pred == "und"


def test_spans_and_scripts(spark):
    rows = [("en", "the cat and the dog went with them to that house " * 5), ("ru", "это дом и он большой а там кот " * 5),
            ("fr", "les chats et les chiens sont dans la maison avec nous " * 5)] * 3
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    text = "the dog and the cat with them and that house это большой кот там les chiens dans la maison avec les chats"
    lang, _, spans = language_id.label(model, text, penalty=4.0)
    assert lang == "en" and [s[0] for s in spans] == ["en", "ru", "fr"]
    assert [s[1] for s in spans] == [0, 10, 14] and sum(s[2] for s in spans) == 22
    words = language_id.words_of("это dog")
    assert np.argmax(model.word_scores(words)[0]) == model.langs.index("ru")
    assert model.word_scores(words)[0][model.langs.index("en")] < -1e5


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(300):
        scores = rng.normal(0, 3, (rng.integers(1, 7), 3))
        value = lambda path: (
            sum(scores[t, s] for t, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:])))
        best = max(map(value, itertools.product(range(3), repeat=len(scores))))
        assert value(language_id.best_path(scores, 2.0)) == pytest.approx(best)


# LM scores

def test_gradients_and_probabilities():
    rng = np.random.default_rng(0)
    flat = lm_score.fresh().astype(np.float64)
    near, tokens = rng.integers(0, lm_score.TOKENS + 1, (40, 4)), rng.integers(0, lm_score.TOKENS, 40)
    loss = lambda f: -lm_score.log_probs(lm_score.unpacked(f), near, tokens).mean()
    gradient = lm_score.gradients(lm_score.unpacked(flat), near, tokens)
    for i in rng.choice(np.flatnonzero(gradient), 20):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-4
        down[i] -= 1e-4
        assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(gradient[i], rel=1e-3, abs=1e-5)
    every = np.arange(lm_score.TOKENS)
    assert np.exp(lm_score.log_probs(lm_score.unpacked(flat), np.tile(near[:1], (len(every), 1)), every)).sum() == (
        pytest.approx(1))


def test_a_step_touches_only_the_rows_of_its_tokens():
    """The tables hold most of the network; a batch has a few of their rows, many times each."""
    rng = np.random.default_rng(1)
    p = lm_score.unpacked(lm_score.fresh())
    near, tokens = rng.integers(0, 9, (200, 4)), rng.integers(0, lm_score.TOKENS, 200)
    rows, sums, rest = lm_score._gradient_parts(p, near, tokens)
    assert list(rows) == [o * (lm_score.TOKENS + 1) + i for o in range(4) for i in range(9)]
    # token by token, added up one by one
    single = [lm_score.gradients(p, near[i : i + 1], tokens[i : i + 1]).astype(np.float64) for i in range(200)]
    dense = np.mean(single, axis=0)
    tables, others = dense[: lm_score.TABLES].reshape(-1, lm_score.HIDDEN), dense[lm_score.TABLES :]
    assert np.flatnonzero(np.abs(tables).sum(axis=1)).tolist() == list(rows)
    assert np.allclose(tables[rows], sums, atol=1e-6) and np.allclose(others, rest, atol=1e-6)


def test_scores_are_sums_over_all_tokens_and_beat_frequencies(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = lm_score.vocabulary(docs)
    encoded = lm_score.encode(docs, known).collect()
    trained = lm_score.train(lm_score.encode(docs, known).coalesce(1).cache())
    p = lm_score.unpacked(np.frombuffer(trained, np.float32))
    counts = np.zeros(lm_score.TOKENS)
    total = tokens = 0
    for _, body in encoded:
        ids = np.frombuffer(body, "<u2").astype(np.int64)
        counts += np.bincount(ids, minlength=len(counts))
        for t in range(0, len(ids), 97):  # token by token, as the definition has it
            near = [ids[t + o] if 0 <= t + o < len(ids) else lm_score.TOKENS for o in (-2, -1, 1, 2)]
            total += lm_score.log_probs(p, np.array([near]), ids[t : t + 1])[0]
            tokens += 1
    share = counts[counts > 0] / counts.sum()
    assert total / tokens > (share * np.log(share)).sum()


def test_every_token_is_a_target_once(monkeypatch):
    seen = []
    monkeypatch.setattr(lm_score, "contexts", lambda ids, at: seen.extend(at) or np.zeros((len(at), 4), np.int64))
    monkeypatch.setattr(lm_score, "gradients", lambda p, near, tokens: np.zeros_like(lm_score.fresh()))
    monkeypatch.setattr(lm_score, "TaskContext", type("T", (), {"get": lambda: type("C", (), {"partitionId": lambda s: 0})()}))
    shared = type("B", (), {"value": lm_score.fresh().tobytes()})
    batch = pa.RecordBatch.from_pydict({"ids": [np.arange(37, dtype="<u2").tobytes()]})
    for turn in range(lm_score.ROUNDS):
        list(lm_score._trainer(shared, turn)(iter([batch])))
    assert sorted(seen) == list(range(37))


def test_a_rare_word_is_scored_among_the_words_of_its_ending(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "TOKENS", lm_score.RARE + 2)
    counts = spark.createDataFrame([(b"the", 50), (b"of", 40), (b"walking", 9), (b"xqzing", 1), (b"cat", 5)], "word binary, n long")
    known = lm_score._numbered(counts)
    assert set(known) == {b"the", b"of"}
    got = dict(lm_score.rare_words(counts.coalesce(1), known).collect())
    shares = {b"walking": 0.9, b"xqzing": 0.1, b"cat": 1.0}
    assert lm_score._ending(b"cat") != lm_score._ending(b"walking")
    assert got == {lm_score._key(w): pytest.approx(math.log(s)) for w, s in shares.items()}
    monkeypatch.undo()
    common = " ".join(f"w{i}" for i in range(lm_score.TOKENS))
    texts = [common] * 3 + ["walking"] * 2 + ["xqzing"]
    scores = {r.doc_id: r.log_prob for r in lm_score.score_documents(frame(spark, texts).coalesce(1), rounds=0).collect()}
    assert scores[3] == scores[4] and scores[3] - scores[5] == pytest.approx(math.log(2), rel=1e-4)


def test_scores_of_awkward_texts(spark, monkeypatch):
    texts = awkward_texts()
    docs = frame(spark, texts).coalesce(1)
    whole = {r.doc_id: r for r in lm_score.score_documents(docs, rounds=0).collect()}
    assert len(whole) == len(texts)
    for i, text in enumerate(texts):
        n = len((text or "").split())
        assert whole[i].n_tokens == n or "漢" in text
        assert (whole[i].mean_log_prob is None) == (n == 0) and whole[i].log_prob <= 0
    monkeypatch.setattr(lm_score, "CHUNK", 7)
    for r in lm_score.score_documents(docs, rounds=0).collect():
        assert r.log_prob == pytest.approx(whole[r.doc_id].log_prob, rel=1e-4)
    assert lm_score.score_documents(empty(spark)).count() == 0


# Nearest neighbours

def exact(vectors, k):
    """Every query's k nearest, by the definition."""
    ids = sorted(vectors)
    found = {}
    for q in (i for i in ids if i % 20 == 0):
        scored = sorted((-float((vectors[i] * vectors[q]).sum()), i) for i in ids if i != q)
        found[q] = [(i, -s) for s, i in scored[:k]]
    return found


@pytest.mark.parametrize("options", [{}, {"cell_rows": 64, "query_rows": 8}])
def test_recall_on_the_given_vectors(spark, options):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    want = exact(vectors, 20)
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert [f[0] for f in sorted(found)] == list(range(1, 21))
        assert all(score == pytest.approx(float((vectors[i] * vectors[q]).sum()), abs=1e-12) for _, i, score in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
    assert hits >= 0.99 * 20 * len(want)


def test_unusable_vectors_ties_and_few_candidates(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0], "x"), (20, [0.0, 0.0], "x"), (40, None, "x"), (60, [1.0, None], "x"), (80, [nan, 1.0], "x"),
            (1, [1.0, 1.0], "x"), (2, [1.0, 5.0], "x"), (3, [inf, 1.0], "x"), (4, [2.0, 0.0], "x"), (4, [2.0, 0.0], "x"),
            (5, [1.0], "x"), (6, [], "x"), (None, [9.0, 9.0], "x"), (7, [1.0, -1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string")
    got = [tuple(r) for r in ann.nearest(table, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 4, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 7, 1.0)]
    assert ann.nearest(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold_for_nearly_all_estimates():
    rng = np.random.default_rng(3)
    vectors, queries = rng.normal(size=(2000, 64)), rng.normal(size=(50, 64))
    turn = ann.rotation(64, ann.BITS)
    found, error = ann.Codes(vectors, turn).estimates(queries, turn)
    assert (np.abs(found - vectors @ queries.T) <= error).mean() > 0.99


def test_random_copies_do_not_crowd_out_others(spark):
    r = random.Random(1)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [r.random() for _ in range(3)]) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    want = exact(vectors, 20)
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, cell_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in found] for q, found in want.items()}
