"""Decontamination, hard negatives and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_rows import WORDS, awkward_texts, empty, frame
from pyspark.sql import functions as F

from folio_sync.llm import decontaminate, hard_negatives, periodic_runs

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return TOKEN.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


# Decontamination

def benchmark_rows():
    texts = awkward_texts(2)
    long_ones = [t for t in texts if t and len(tokens(t)) > 25]
    items = [(i, t) for i, t in enumerate(long_ones[:6])]
    items += [(3, "quite another text under an id that is there already, of more than ten words in all"),
              (None, "an item without an id is here and it has some more words"), (20, None), (21, "..."),
              (100, "four short words here"), (101, long_ones[0])]
    docs = awkward_texts(5)
    r = random.Random(4)
    for i, t in items:
        words = (t or "").split()
        docs += [f"Clean, words. {t} -- and {t}!", " ".join(words[2:13]).upper(), ";".join(words[:9]), " ".join(words[:10]),
                 " ".join(words[:12] + ["new"] + words[12:])]
    docs += [" ".join(r.choice([t or "" for _, t in items]) for _ in range(8)), docs[-1], "FOUR short (words) here\x00 and on"]
    return docs, items


def expected_contamination(text, items, span=10):
    words, hit, ids = tokens(text), set(), set()
    for item, body in items:
        own = tokens(body)
        n = min(len(own), span)
        wanted = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        at = [i for i in range(len(words) - n + 1) if tuple(words[i:i + n]) in wanted] if n else []
        hit |= {j for i in at for j in range(i, i + n)}
        if at and item is not None:
            ids.add(str(item))
    return words, hit, sorted(ids)


@pytest.mark.parametrize("segment, held", [(2048, {}), (7, {}), (2048, {"held_windows": 3})])
def test_contamination_equals_brute_force(spark, monkeypatch, segment, held):
    """Also with texts in many segments, and with windows that are met by a shuffled join."""
    monkeypatch.setattr(decontaminate, "SEGMENT", segment)
    docs, items = benchmark_rows()
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit("x")).withColumn("window", F.lit(1))
    got = {r.doc_id: r for r in decontaminate.contamination(frame(spark, docs), bench, **held).collect()}
    assert len(got) == len(docs)
    for i, text in enumerate(docs):
        words, hit, ids = expected_contamination(text, items)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (len(words), len(hit), len(ids), bool(hit)), i
        assert got[i].items == ids and got[i].items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert sum(r.contaminated for r in got.values()) > 20


def test_spans_and_documents_are_removed(spark):
    docs, items = benchmark_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = frame(spark, docs)
    clean = {i for i, t in enumerate(docs) if not expected_contamination(t, items)[1]}
    left = decontaminate.decontaminated(rows, bench)
    assert left.columns == rows.columns and {r.doc_id for r in left.select("doc_id").collect()} == clean
    spans = decontaminate.decontaminated(rows, bench, remove="spans")
    assert spans.columns == rows.columns
    got = {r.doc_id: r.text for r in spans.select("doc_id", "text").collect()}
    for i, text in enumerate(docs):
        words, hit, _ = expected_contamination(text, items)
        if i in clean:
            assert got[i] == text
        else:
            pieces = re.findall(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
            rest = text[len("".join(pieces)):]
            assert got[i] == "".join(p for j, p in enumerate(pieces) if j not in hit) + rest, i
    with pytest.raises(ValueError):
        decontaminate.decontaminated(rows, bench, remove="words")


def test_contamination_of_nothing_and_of_repeated_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([("b", "one two three"), ("a", "two three")], "item_id string, text string")
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    docs = spark.createDataFrame(
        [(1, "one two three"), (1, "one two three"), (1, "none"), (None, "two three two three"), (2, None)], "doc_id long, text string")
    got = sorted(tuple(r)[:3] + (r.n_items,) for r in decontaminate.contamination(docs, bench).na.fill({"doc_id": 9}).collect())
    assert got == [(1, 1, 0, 0), (1, 3, 3, 2), (1, 3, 3, 2), (2, 0, 0, 0), (9, 4, 4, 1)]
    assert {r.contaminated for r in decontaminate.contamination(docs, none).collect()} == {False}


def test_decontamination_plan_has_no_python_and_moves_no_text(spark):
    docs, items = benchmark_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_windows(frame(spark, docs), decontaminate.written(decontaminate.benchmark_windows(bench), "w"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not re.search("Python|Arrow|Pandas", plan)


# Hard negatives

def brute_negatives(rows, is_anchor, n_pos=5, n_neg=10):
    used = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        used[(i, label, tuple(math.floor(256 * x) for x in v))] = None
    out = set()
    for a, label, q in used:
        if not is_anchor(a):
            continue
        scores = {(sum(x * y for x, y in zip(q, o)), i, lab == label) for i, lab, o in used if i != a and len(o) == len(q)}
        near = sorted(((s, i) for s, i, same in scores if same), key=lambda f: (-f[0], f[1]))[:n_pos]
        for p_score, p in near:
            fit = sorted(((s, i) for s, i, same in scores if not same and 30 * p_score <= 100 * s <= 90 * p_score),
                         key=lambda f: (-f[0], f[1]))[:n_neg]
            out |= {(a, p, k + 1, i, p_score, s) for k, (s, i) in enumerate(fit)}
    return out


@pytest.mark.parametrize("kind", ["close", "small", "huge"])
@pytest.mark.parametrize("options", [{}, {"chunk": 3, "block_rows": 20}])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, kind, options):
    """Vectors around few centres, with very many equal scores, and with products that 64 bits barely hold."""
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 2)
    r = random.Random(kind)
    rows = []
    for i in range(260):
        label = r.randrange(4)
        if kind == "close":
            v = [r.gauss(math.cos(label * d), 0.4) / 4 for d in range(12)]
        elif kind == "small":
            v = [r.choice([-1, 0, 0, 1]) / 256 * r.choice([1, 1, 3]) for _ in range(5)]
        else:
            v = [r.gauss(1, 1) * 2.0 ** r.choice([0, 16, 18]) for _ in range(3)]
        rows.append((i, v, label))
    rows += [(None, [1.0] * 12, 1), (300, None, 1), (301, [0.1] * 11 + [None], 2), (302, [float("nan")] * 12, 1),
             (303, [float("inf")] + [0.0] * 11, 1), (304, [0.5] * 12, None), (305, [0.0] * 12, 1), (310, [0.3, 0.2], 1),
             (311, [0.2, 0.2], 1), (312, [0.1, 0.2], 2), (320, [], 1), rows[5], rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    got = hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, **options).collect()
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(got) == len(set(got)) and {tuple(g) for g in got} == want and len(want) > 50


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [0.9], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") == 0).count() == 0


def test_sorted_access_stops_early_where_scores_fall():
    """Rows along the anchor: the first depths hold the best, and the rest is never scored."""
    rows = np.outer(np.arange(4000), np.ones(8, np.int64))
    block = hard_negatives.Block(np.arange(4000), np.zeros(4000, np.int64), rows)
    best, scored = hard_negatives.Best(5), 0
    for new, scores, threshold in block.deeper(np.ones(8, np.int64)):
        best.add(block.ids[new], scores)
        scored += len(new)
        if threshold is not None and best.complete(threshold):
            break
    assert [i for _, i in best.found] == [3999, 3998, 3997, 3996, 3995] and scored == hard_negatives.FIRST_DEPTH


# Periodic runs

def brute_runs(t):
    found = {}
    for q in range(1, len(t) // 2 + 1):
        i = 0
        while i + q < len(t):
            j = i
            while j + q < len(t) and t[j] == t[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def runs_of(t):
    return [tuple(x) for x in periodic_runs.find_runs(np.array(t, np.int64)).tolist()]


def test_runs_of_short_and_of_nested_sequences():
    r = random.Random(1)

    def nested(depth):
        if depth == 0:
            return [r.randrange(2)] * r.randint(1, 6)
        x, kind = nested(depth - 1), r.random()
        if kind < 0.5:
            return x * r.randint(2, 4) + x[: r.randint(0, len(x))]
        return x + (nested(depth - 1) if kind < 0.8 else [r.randrange(3)]) + x

    sequences = [[r.randrange(k) for _ in range(r.randint(0, 60))] for k in (1, 2, 2, 3) for _ in range(150)]
    sequences += [nested(r.randint(2, 5))[:400] for _ in range(120)]
    one, two = [0], [0, 1]
    while len(two) < 300:
        one, two = two, two + one
    # squares around one place, with every other period; small periods around a break
    sequences += [two, [0, 1] * 50 + [0] + [0, 1] * 80, ([0, 1] * 20 + [0]) * 2 + ([0, 1] * 31 + [0]) * 2, [0] * 200 + [1] + [0] * 150]
    for t in sequences:
        assert runs_of(t) == brute_runs(t), t


def expected_row(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(s, e - s, q) for s, e, q in brute_runs(words) if e - s >= max(12, 2 * q)]
    gone = {j for s, m, q in runs for j in range(s + q, s + m)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


@pytest.mark.parametrize("batch_words", [periodic_runs.BATCH_WORDS, 50])
def test_periodic_runs_of_documents(spark, batch_words):
    r = random.Random(7)
    texts = [t if len(t or "") < 5000 else "ab  " * 300 for t in awkward_texts(3)]
    texts += [" ".join(r.choice("ab\u0085 é") for _ in range(r.randint(0, 120))) for _ in range(150)]
    texts += ["x y\tz\n" * 40, "one " * 11, "one " * 12, "a b c d e f g " * 2]
    got = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(frame(spark, texts)), batch_words=batch_words).collect()
    want = {expected_row(i, t) for i, t in enumerate(texts)}
    assert {tuple(g)[:8] for g in got} == want and len(got) == len(texts)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 10


def test_periodic_runs_of_nothing_and_of_null_ids(spark):
    assert periodic_runs.periodic_runs(periodic_runs.with_planted_runs(empty(spark))).count() == 0
    docs = spark.createDataFrame([(None, "a b " * 10), (None, "a b " * 10), (4, None)], "doc_id long, text string")
    got = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(docs)).select("doc_id", "n_runs", "start", "length").collect()
    assert sorted(map(tuple, got), key=repr) == [(4, 0, None, None), (None, 1, 0, 20), (None, 1, 0, 20)]
