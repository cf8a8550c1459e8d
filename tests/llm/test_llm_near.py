"""Near-duplicate operators against brute force, components, and the pipeline."""

import collections
import itertools
import random
import re
from pathlib import Path

import numpy as np
import pytest
from llm_rows import WORDS, awkward_texts, empty, frame
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from folio_sync.llm import line_dedup, ngram_join
from folio_sync.llm.components import components
from folio_sync.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def united(nodes, links):
    """Node -> smallest node it is connected with."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("n, m, seed", [(60, 40, 1), (200, 260, 2), (30, 0, 3)])
def test_components_of_random_graphs(spark, n, m, seed):
    r = random.Random(seed)
    links = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n, n + 30 * (m > 0))]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert dict(got.collect()) == united(nodes, [(a, b) for a, b in links if a != b])


# N-gram join

def expected_join(docs, percent=85):
    sets = {}
    for i, text in docs:
        words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = [tuple(words[j : j + 4]) for j in range(len(words) - 3)] if len(words) >= 4 else [tuple(words)] * bool(words)
        sets[i] = frozenset(grams)
    links = []
    by_gram = collections.defaultdict(list)
    for i, grams in sets.items():
        for j in {j for g in grams for j in by_gram[g]}:
            common = len(grams & sets[j])
            if 100 * common >= percent * (len(grams) + len(sets[j]) - common):
                links.append((i, j))
        for g in grams:
            by_gram[g].append(i)
    groups = united(sets, links)
    return {(i, len(s), groups[i]) for i, s in sets.items()}


def families(seed):
    """Groups of edited copies of all sizes, and texts that share a long passage."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = awkward_texts(seed)
    for copies in (1, 2, 3, 40, 90):
        base = [r.choice(vocabulary) for _ in range(r.randint(5, 90))]
        for _ in range(copies):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(words) // 25))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            texts.append("  \t".join(words))
    passage = [r.choice(vocabulary) for _ in range(60)]
    texts += [" ".join(r.choices(vocabulary, k=r.randint(10, 40)) + passage + r.choices(vocabulary, k=20)) for _ in range(60)]
    return texts


@pytest.mark.parametrize("cell, sparse, seed", [(512, 16, 1), (20, 2, 2), (16, 1, 3)])
def test_join_is_exact_whatever_the_cells(spark, monkeypatch, cell, sparse, seed):
    """With small cells pivots cut regions, cells are cut again, and tiles join what they cannot."""
    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(ngram_join, "SPARSE", sparse)
    docs = frame(spark, families(seed))
    got = ngram_join.ngram_join(docs).collect()
    assert len(got) == docs.count()
    assert {tuple(r) for r in got} == expected_join(docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("words, edits, copies, groups", [(103, 1, 3, 60), (403, 4, 10, 3), (103, 1, 30, 2)])
def test_equally_frequent_shingles_have_one_order(words, edits, copies, groups):
    """All shingles of a copied passage occur equally often; linked sets must share enough of their prefixes."""
    r, hashes = random.Random(words), ngram_join._Hashes()
    for _ in range(groups):
        base = [f"w{r.randrange(100_000)}" for _ in range(words)]
        sets = []
        for _ in range(copies):
            near = list(base)
            for _ in range(edits):
                near[r.randrange(words)] = f"x{r.randrange(100_000)}"
            sets.append(ngram_join.shingles(" ".join(near), ngram_join.N, hashes))
        found, counts = np.unique(np.concatenate(sets), return_counts=True)
        hot, rank = found[counts > 1], counts[counts > 1].astype(np.int64)
        prefixes = [ngram_join.prefix_of(s, hot, rank, ngram_join.PERCENT) for s in sets]
        for i, j in itertools.combinations(range(copies), 2):
            common, total = len(np.intersect1d(sets[i], sets[j])), len(sets[i]) + len(sets[j])
            if 100 * common >= ngram_join.PERCENT * (total - common):
                shared = len(np.intersect1d(prefixes[i], prefixes[j]))
                rest = max(len(sets[k]) - len(prefixes[k]) for k in (i, j))
                assert shared and (shared + rest) * (100 + ngram_join.PERCENT) >= ngram_join.PERCENT * total


def test_join_of_nothing_repeated_rows_and_null_ids(spark):
    assert ngram_join.ngram_join(empty(spark)).count() == 0
    docs = spark.createDataFrame(
        [(9, "a b c d e"), (9, "a b c d e"), (4, "A B c  d e"), (None, "x y"), (9, "other"), (3, None)],
        "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.ngram_join(docs).collect()), key=repr)
    assert got == sorted([(9, 2, 4), (9, 2, 4), (4, 2, 4), (None, 1, None), (9, 1, 9), (3, 0, 3)], key=repr)
    kept = sorted((tuple(r) for r in ngram_join.one_of_each(docs).collect()), key=repr)
    assert (4, "A B c  d e") in kept and (3, None) in kept and (None, "x y") in kept and (9, "other") in kept


@pytest.mark.parametrize("seed", [4, 5])
def test_join_in_many_rounds_is_exact(spark, monkeypatch, seed):
    """Rounds of shingles, pairs and sets leave nothing out and give no pair twice to count."""
    monkeypatch.setattr(ngram_join, "ROUND_ROWS", 40)
    monkeypatch.setattr(ngram_join, "ROUND_BYTES", 2000)
    labels = collections.Counter()
    write = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, label, *path: (labels.update([label]), write(df, label, *path))[1])
    docs = frame(spark, families(seed))
    got = ngram_join.ngram_join(docs).collect()
    assert len(got) == docs.count()
    assert {tuple(r) for r in got} == expected_join(docs.select("doc_id", "text").collect())
    assert labels["shared-shingles"] == ngram_join.ROUNDS and labels["pairs"] > 1 and labels["links"] > 4


def test_join_shuffles_a_part_of_its_prefix_shingles_at_a_time(spark, monkeypatch):
    """No query of the join has shuffle files of more than a few bytes for each prefix shingle of all sets."""
    monkeypatch.setattr(ngram_join, "ROUND_ROWS", 1000, raising=False)
    r = random.Random(6)
    docs = frame(spark, [" ".join(f"w{r.randrange(100_000)}" for _ in range(200)) for _ in range(2000)])
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    moved = {}

    def shuffled():
        return {f: f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data")}

    def measured(df, label, path=None):
        path, before = path or scratch_path(spark, label), shuffled()
        df.write.parquet(path)
        moved[label] = max(moved.get(label, 0), sum(size for f, size in shuffled().items() if f not in before))
        table = spark.read.schema(df.schema).parquet(path)
        table.scratch_path = path
        return table

    monkeypatch.setattr(ngram_join, "written", measured)
    assert ngram_join.ngram_join(docs).count() == 2000
    prefix_shingles = 2000 * (197 - ngram_join._need(197, ngram_join.PERCENT) + 1)
    assert 0 < max(moved.values()) <= 20 * prefix_shingles, moved


# Line dedup

def line_sets(texts):
    """Stripped lines that take part -> their places; and their shingles."""
    cut = re.compile(r"(?=(.{1,8}))(?:[一-鿿぀-ヿ]|[^\W_]{1,12}+)", re.S)
    places = collections.defaultdict(list)
    for i, text in enumerate(texts):
        for n, line in enumerate((text or "").split("\n")):
            if len(line.strip(" ")) >= line_dedup.MIN_CHARS:
                places[line.strip(" ")].append((i, n))
    return places, {line: {m.group(1) for m in cut.finditer(line)} or {line} for line in places}


def test_one_line_of_each_component_stays(spark):
    r = random.Random(2)
    vocabulary = ["w" + "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 8))) for _ in range(3000)]
    bases = [r.choices(vocabulary, k=r.randint(8, 50)) for _ in range(150)]

    def near(words):
        words = list(words)
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        return " ".join(words)

    odd = ["", "short", "  ", "-" * 20, "漢字かな交じり文の行はここに長く続いて終わる。", "a" * 300]
    texts = ["\n".join(near(r.choice(bases)) if r.random() < 0.7 else r.choice(odd) for _ in range(r.randint(0, 8)))
             for _ in range(120)] + [None, "", "\n\n"]
    places, sets = line_sets(texts)
    lines = list(places)
    links = [(a, b) for a, b in ((a, b) for i, a in enumerate(lines) for b in lines[:i])
             if len(sets[a] & sets[b]) >= line_dedup.SIMILAR * len(sets[a] | sets[b])]
    groups = collections.defaultdict(list)
    for line, head in united(lines, links).items():
        groups[head] += places[line]
    docs = frame(spark, texts)
    got = line_dedup.line_dedup(docs).collect()
    assert len(got) == sum(map(len, places.values()))
    kept, firsts = {(x.doc_id, x.line_no) for x in got if x.kept}, {min(g) for g in groups.values()}
    # bands may miss a pair at the threshold; they never join what is not linked
    assert firsts <= kept and len(kept - firsts) <= 0.01 * len(places)
    gone = {p for g in groups.values() for p in g} - kept
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns
    for x in left.collect():
        text = texts[x.doc_id]
        assert x.text == (text if text is None else "\n".join(
            line for n, line in enumerate(text.split("\n")) if (x.doc_id, n) not in gone))


def test_every_character_of_a_line_counts(spark):
    """Lines that differ only behind the eighth character of a run, and are not similar by all their shingles."""
    lines = ["20231115123456 connection closed by peer", "20231115094256 connection closed by peer",
             "order 100000001234 shipped", "order 100000009876 shipped", "*** note one", "+++ note one",
             "}", "ok", "ab", "漢字かな"]
    every = [{line[i : i + 8] for i in range(max(1, len(line) - 7))} for line in lines]
    assert all(len(x & y) < line_dedup.SIMILAR * len(x | y) for x, y in itertools.combinations(every, 2))
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["", *lines, " ", ""]))], "doc_id long, text string")
    left = {x.doc_id: x.text for x in line_dedup.without_repeated_lines(docs.coalesce(1)).collect()}
    # clean lines stay, exact repeats go whatever their length, and blank lines stay
    assert left == {1: "\n".join(lines), 2: "\n \n"}


def test_no_pair_of_a_full_band_is_left_out(spark):
    """Families of template lines: members share bands but are no links, and each has one near copy."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))  # a word is a shingle
    lines, families = [], ((28, 1700), (20, 800))
    for n_fixed, n_pairs in families:
        fixed = [word() for _ in range(n_fixed)]
        for _ in range(n_pairs):
            own = [word() for _ in range(5)]
            copy = [word(), *own[1:]]
            lines += [" ".join([*fixed[:9], *values, *fixed[9:]]) for values in (own, copy)]
            assert n_fixed / (n_fixed + 10) < line_dedup.SIMILAR < (n_fixed + 4) / (n_fixed + 6)
    order = r.sample(range(len(lines)), len(lines))
    docs = spark.createDataFrame([(order[i], line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = {x.doc_id: x.component for x in line_dedup.line_dedup(docs.repartition(4)).collect()}
    pairs = [(got[order[i]], got[order[i + 1]]) for i in range(0, len(lines), 2)]
    assert len(set(got.values())) >= len(pairs)  # no two pairs are joined
    assert sum(a == b for a, b in pairs) >= 0.98 * len(pairs)


def test_all_pairs_of_a_small_band_are_looked_at(spark, monkeypatch):
    """Template lines that share bands and are no links do not go on to the split by rare shingles."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    fixed, lines = [word() for _ in range(28)], []
    for _ in range(100):
        own = [word() for _ in range(5)]
        lines += [" ".join([*fixed[:9], *values, *fixed[9:]]) for values in (own, [word(), *own[1:]])]

    def split(*_):
        raise AssertionError("a band that is not full was split")

    monkeypatch.setattr(line_dedup, "_close_pairs", split)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {x.doc_id: x.component for x in line_dedup.line_dedup(docs).collect()}
    assert len(set(got.values())) == 100 and all(got[i] == got[i + 1] for i in range(0, 200, 2))


def test_bin_sizes_let_every_link_through(spark):
    """By brute force: pairs at or above the threshold pass, and nearly all others do not."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    common, lines = [word() for _ in range(40)], ["ab", "漢字", "a" * 300]
    for _ in range(70):
        words = r.choices(common, k=r.randint(1, 12)) + [word() for _ in range(r.choice([0, 4, 20, 200]))]
        for _ in range(4):
            lines.append(" ".join(words))
            words = [w for w in words if r.random() > 0.04] + [word() for _ in range(r.randint(0, 2))]
    lines = sorted(set(filter(None, lines)))
    sets = line_sets(lines)[1]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    count, similar = line_dedup.BANDS, line_dedup.SIMILAR
    sizes = line_dedup._sizes(count)
    kinds = line_dedup._kinds(line_dedup.lines_of(docs), count).select(F.col("first_doc").alias("i"), *sizes).cache()
    assert {x.i: x.size for x in kinds.collect()} == {i: len(sets[line]) for i, line in enumerate(lines)}
    others = kinds.toDF("j", *(f"other_{s}" for s in sizes))
    passed = {(x.i, x.j) for x in kinds.crossJoin(others).where("i < j").where(line_dedup._near(count, similar)).select("i", "j").collect()}
    links = {(i, j) for j in range(len(lines)) for i in range(j)
             if len(sets[lines[i]] & sets[lines[j]]) >= similar * len(sets[lines[i]] | sets[lines[j]])}
    assert len(links) > 50 and links <= passed and len(passed) < 0.1 * len(lines) ** 2 / 2


def test_rare_shingles_find_every_pair(spark):
    """All pairs at or above the threshold among lines of many sizes, by brute force."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    common, lines = [word() for _ in range(12)], []
    for _ in range(60):
        words = r.sample(common, r.randint(1, 12)) + [word() for _ in range(r.randint(0, 30))]
        for _ in range(3):
            lines.append(" ".join(words))
            words = [w for w in words if r.random() > 0.06] + [word() for _ in range(r.randint(0, 2))]
    lines = sorted(set(filter(None, lines)))
    found = line_sets(lines)[1]
    sets = [found[line] for line in lines]
    links = {(i, j) for j in range(len(lines)) for i in range(j)
             if len(sets[i] & sets[j]) >= line_dedup.SIMILAR * len(sets[i] | sets[j])}
    texts = spark.createDataFrame(list(enumerate(lines)), "key long, line string")
    alone = texts.select("key", F.col("key").alias("component"))
    got = {tuple(sorted(x)) for x in line_dedup._close_pairs(alone, texts, line_dedup.SIMILAR).collect()}
    assert len(links) > 30 and links <= got and len(got) < len(lines) ** 2 / 8
    together = texts.select("key", F.lit(1).cast("long").alias("component"))
    assert line_dedup._close_pairs(together, texts, line_dedup.SIMILAR).isEmpty()


def test_texts_that_lose_very_many_lines(spark):
    lines = [f"{i:06d} {i * 7919 % 1000003:06d} line" for i in range(30_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join([*lines, "one more that is new"]))], "doc_id long, text string")
    left = {x.doc_id: x.text for x in line_dedup.without_repeated_lines(docs, similar=1.0).collect()}
    assert left == {1: "\n".join(lines), 2: "one more that is new"}


def test_lines_of_awkward_texts(spark):
    texts = awkward_texts()
    docs = frame(spark, texts).union(frame(spark, texts))  # every row twice
    got = line_dedup.without_repeated_lines(docs).collect()
    assert len(got) == 2 * len(texts)
    assert line_dedup.line_dedup(empty(spark)).count() == line_dedup.without_repeated_lines(empty(spark)).count() == 0


def test_recall_of_the_bands(spark):
    """Pairs at the threshold and above share a band nearly always."""
    r = random.Random(7)
    rows = []
    for i in range(600):
        words = ["".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(40)]
        other = list(words)
        other[r.randrange(1, 39)] = "changed"  # 1 of 40 words: a similarity of 0.9 or more
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    kept = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("kept").count()
    assert kept <= 606


# The pipeline

def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        left[name] = docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
        if name == "language identification":
            assert docs.join(before, docs.columns).count() == left[name]
        if name == "line dedup":
            lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(
                F.length(F.trim("line")) >= line_dedup.MIN_CHARS)
            assert lines.count() == lines.distinct().count()
        if name == "n-gram Jaccard join":
            rows = expected_join(before.select("doc_id", "text").collect())
            assert {r.doc_id for r in docs.collect()} == {group for _, _, group in rows}
    assert 0 < left["byte BPE"] == left["source mix"]
    assert entry.queries()["pipeline"](spark, SF_DIR).count() == left["byte BPE"]


def test_pipeline_takes_five_words_and_four_fifths(spark):
    """One word changed inside a text of 49 to 52 words: near copies by five words at 80 %, not by four at 85 %."""
    r = random.Random(6)
    texts = []
    for size in (48, 49, 50, 51, 52, 60, 120):
        for edits in (1, 2, 3):
            base = [f"w{r.randrange(50_000)}" for _ in range(size)]
            near = list(base)
            for k in range(edits):
                near[10 + 12 * k] = "changed"
            texts += [" ".join(base), " ".join(near)]
    docs = frame(spark, texts).coalesce(1)
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[j : j + 5]) for j in range(len(words) - 4)})
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    kept = {x.doc_id for x in corpus_pipeline.unrepeated_documents(spark, docs, SF_DIR).collect()}
    assert kept == set(united(range(len(texts)), links).values()) and 0 < len(links) < len(texts) // 2


def test_pipeline_keeps_texts_in_several_languages(spark):
    said = {"en": "the cat and the dog went with them to that house", "ru": "это дом и он большой а там кот",
            "fr": "les chats et les chiens sont dans la maison avec nous", "de": "der Hund und die Katze sind in dem Haus"}
    mixed = " ".join((said[lang] + " ") * 4 for lang in ("en", "ru", "fr", "de"))
    rows = [(i, (said[lang] + " ") * 5, lang) for i, lang in enumerate([*said] * 4)] + [(90, mixed, "en"), (91, "12 34 .", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    kept = {x.doc_id for x in corpus_pipeline.known_language(spark, docs, SF_DIR).collect()}
    assert kept == {i for i, _, _ in rows} - {91}


def test_pipeline_of_awkward_documents(spark):
    docs = frame(spark, awkward_texts()).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() > 0
    docs = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_exact_dedup_query_matches_its_sql(spark):
    import check_queries

    good, note = check_queries.compare(spark, check_queries.connect(SF_DIR), SF_DIR, "op1_exact_dedup")
    assert good, note
