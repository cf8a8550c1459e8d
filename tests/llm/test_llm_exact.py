"""Operators with exact contracts: dedup, licences, personal data, BPE, mixing."""

import base64
import collections
import hashlib
import random
import re
import time

import public_tokenizers
import pytest
import tiktoken
from llm_rows import WORDS, awkward_texts, empty, frame
from pyspark.sql import functions as F

from folio_sync.llm import bpe, exact_dedup, license_scan, mixing, pii


# Exact dedup

def expected_groups(docs):
    groups = collections.defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[ \t-\r]+", " ", text or "")].append(doc_id)
    return {
        (i, min(ids), len(ids), i == min(ids), hashlib.sha256(body.encode()).hexdigest())
        for body, ids in groups.items() for i in ids
    }


@pytest.mark.parametrize("options", [{}, {"key_bits": 3, "bucket_rows": 2, "held_bytes": 500}, {"bucket_rows": 1}])
def test_exact_dedup_is_grouping_by_text(spark, tmp_path, options):
    """Also where keys collide, buckets split to the last bit and tasks forget what they sent."""
    docs = frame(spark, awkward_texts())
    got = exact_dedup.exact_dedup(docs, str(tmp_path / "index"), **options).collect()
    assert len(got) == docs.count()
    assert {tuple(r) for r in got} == expected_groups(docs.select("doc_id", "text").collect())


def test_exact_dedup_of_nothing_and_of_repeated_rows(spark, tmp_path):
    assert exact_dedup.exact_dedup(empty(spark), str(tmp_path / "a")).count() == 0
    docs = spark.createDataFrame([(5, "t"), (5, "t"), (7, "t"), (None, "t"), (None, "u")], "doc_id long, text string")
    got = sorted(map(tuple, exact_dedup.exact_dedup(docs, str(tmp_path / "b")).drop("text_sha256").collect()), key=repr)
    assert got == sorted([(5, 5, 4, True), (5, 5, 4, True), (7, 5, 4, False), (None, 5, 4, False),
                          (None, None, 1, True)], key=repr)


def test_index_buckets_are_key_ranges_of_bounded_size(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    entries = exact_dedup.build_index(docs, path, bucket_rows=64)
    directory = spark.read.parquet(f"{path}/directory")
    assert entries.count() == 3000
    assert entries.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 64
    depth = directory.first()["depth"]
    assert directory.count() == 2**depth
    slot = exact_dedup.slot_of(F.col("key"), depth)
    joined = entries.join(directory.select("slot", F.col("bucket").alias("at")), slot == F.col("slot"))
    assert joined.where("bucket = at").count() == 3000


# Licences

def test_automaton_finds_every_place_of_every_phrase():
    r = random.Random(3)
    for _ in range(200):
        notices = [(f"n{i}", " ".join(r.choice("abc") for _ in range(r.randint(2, 9)))) for i in range(3)]
        phrases = {" ".join(r.choice("abc") for _ in range(n)): f"p{n}" for n in (1, 2, 3)}
        scanner = license_scan.Scanner(phrases, notices, 2, 2, 0.5)
        words = [r.choice("abcz") for _ in range(50)]
        n, base, spans = scanner.scan(" ".join(words))
        places = sorted((i, label) for p, label in phrases.items() for i in range(len(words))
                        if words[i : i + len(p.split())] == p.split())
        assert (n, sorted(base)) == (50, places)
        whole = {label: text.split() for label, text in notices}
        for label, text in whole.items():
            for i in range(len(words)):
                if words[i : i + len(text)] == text:
                    assert any(s[0] == label and s[1] < i + len(text) and s[2] > i for s in spans)
        assert all(0.5 <= cover <= 1 and 0 <= a < b <= 50 for _, a, b, cover in spans)


def test_licence_query_equals_search_word_by_word(spark):
    texts = awkward_texts() + [
        "Licensed under CC BY-NC 4.0.", "x (C) ALL rights, reserved - all RIGHTS reserved", "cc by cc by cc  by",
        "Permission is hereby granted, free of CHARGE, to every person obtaining a copy of this software",
        "GNU General Public License " * 3000, "general publicé license",
    ]
    got = {r.doc_id: r for r in license_scan.scan_licences(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(j, label) for p, label in license_scan.PHRASES.items() for j in range(len(words))
                  if words[j : j + len(p.split())] == p.split()]
        starts = [j for j, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert {x for x in r.base_labels.split(",") if x} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[len(texts) - 6].labels == "cc-by,cc-by-nc"
    assert license_scan.scan_licences(empty(spark)).count() == 0


@pytest.mark.parametrize("change, found", [(0, True), (1, True), (12, False)])
def test_a_changed_notice_is_found_while_most_of_it_stands(change, found):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES, 3, 6, 0.7)
    words = dict(license_scan.NOTICES[::-1])["bsd"].split()
    words[4 : 4 + change] = ["other"] * change
    assert [s[0] for s in scanner.scan("before " + " ".join(words) + " after")[2]] == ["bsd"] * found


def test_very_many_notices_take_time_in_proportion():
    """20,000 notices in one text, and every one is found."""
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES, 3, 6, 0.7)
    for between in (" ", " and then eight words of other text stand here "):
        began = time.process_time()
        spans = scanner.scan(between.join(["Released under the MIT License."] * 20_000))[2]
        assert time.process_time() - began < 4
        assert len(spans) == 20_000
        assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))
        assert {(s[0], s[2] - s[1], s[3]) for s in spans} == {("mit", 5, 1.0)}


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(x) > 255 for x in m.group().split("."))
                    or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_personal_data_equals_plain_search(spark):
    r = random.Random(5)
    pieces = ["a@b.c", "@", "a.b%x@y.z", "..", "1.2.3.4", "0255.1.1.001", "300.1.1.1", "1.2.3", "4041894974608795",
              "4041 8949-7460 8795", " ", "-", "+1 (988) 555-2485", "+", "é", "漢", "🙂", "12", "x", "(", ")", "\n",
              "+49 30 1234567", "4111111111111111", "IBAN GB82WEST12345698765432", "ssn 123-45-6789"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 14))) for _ in range(1500)]
    texts += [None, "", "1-" * 30_000 + "1", "a." * 30_000, "a@" + "a." * 30_000 + "b", "1." * 30_000, "+" + "1 " * 30_000]
    for r in pii.find_pii(frame(spark, texts)).collect():
        spans = base_spans(texts[r.doc_id] or "")
        assert hashlib.sha256(",".join(spans).encode()).hexdigest() == r.base_sha256, texts[r.doc_id][:200]
        counts = collections.Counter(s.split(":")[0] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in PATTERNS)
        assert set(spans) <= set(r.spans.split(","))
    assert pii.find_pii(empty(spark)).count() == 0


def test_parts_of_zeros_are_parts_of_an_address(spark):
    good = ["10.0.0.1", "0.0.0.0", "1.2.3.000", "127.0.0.1", "192.168.0.1", "00255.000.0.00", "1.2.3.4", "010.020.030.0099"]
    bad = ["0.0.0.256", "1.0.0.00256", "0.0.0", "300.0.0.0", "1000.0.0.0", "0.0.0."]
    r = random.Random(8)
    texts = good + bad + ["".join(r.choice([*good, *bad, " ", "x", ".", "0", "-"]) for _ in range(6)) for _ in range(500)]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, texts)).collect()}
    assert [got[i].n_ip for i in range(len(good + bad))] == [1] * len(good) + [0] * len(bad)
    for i, text in enumerate(texts):
        spans = base_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert got[i].n_ip == sum(s.startswith("ip:") for s in spans)


def test_check_digits_and_context_decide(spark):
    texts = ["IBAN GB82WEST12345698765432.", "IBAN GB82WEST12345698765433.", "my ssn: 123-45-6789", "123-45-6789",
             "write to a@b.cd", "a@b.cd"]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, texts)).collect()}
    assert [got[i].spans for i in range(4)] == ["iban:5:27", "", "ssn:8:19", ""]
    assert got[4].found[0].score > got[5].found[0].score


# BPE

@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(bpe.read_ranks())


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


def test_encoding_equals_the_library(spark, reference):
    r = random.Random(1)
    pool = "abc ABC'sdétñ漢字かな가한🙂\x1c\x85\xa0 \n\t .,!?123½²ªµ̀‍ابßŒ"
    texts = awkward_texts() + ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    got = bpe.bpe_round_trip(frame(spark, texts), with_ids=True).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.bpe_round_trip(empty(spark)).count() == 0


def test_documents_round_trip(spark):
    docs = frame(spark, awkward_texts())
    decoded = bpe.decode_documents(bpe.encode_documents(docs))
    assert dict(decoded.collect()) == {r.doc_id: r.text or "" for r in docs.collect()}


def test_table_grows_and_mends_like_a_new_one(encoder):
    r = random.Random(2)
    for _ in range(1500):
        body = bytes(r.choice(b"abcdethn aaar") for _ in range(r.randint(1, 200)))
        last = encoder.table(body)
        at = r.randint(0, len(body))
        removed = r.randint(0, min(3, len(body) - at))
        put = bytes(r.choice(b"abth ") for _ in range(r.randint(0, 3)))
        new, mended = encoder.edit(body, last, at, removed, put)
        assert new == body[:at] + put + body[at + removed :] and mended == encoder.table(new)
        assert encoder.append(body, last, put) == encoder.table(body + put)


def test_vocabulary_is_a_parameter(spark, tmp_path):
    path = tmp_path / "bytes.tiktoken"
    path.write_text("".join(f"{base64.b64encode(bytes([i])).decode()} {i}\n" for i in range(256)))
    got = bpe.encode_documents(spark.createDataFrame([(1, "aé")], "doc_id long, text string"), str(path)).first()
    assert got.ids == list("aé".encode())


# Mixing

def expected_targets(sizes):
    """source -> target, resharing the excess until none is above three times its size."""
    sources = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        weights = sum(weight[s] for s in sources if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / weights for s in sources}
        above = {s for s in sources if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_targets_and_takings(spark):
    r = random.Random(4)
    sources = ["b", "a", "é", "Z", None, "tiny", "none"]
    docs = [(i, None if i % 97 == 0 else "w " * r.choice([1, 3, 20, 50, 200, 400]), sources[min(6, i % 9)])
            for i in range(2500)]
    docs = [(i, "" if s == "none" else t if s != "tiny" or i < 40 else None, s) for i, t, s in docs]
    docs += [docs[1], docs[1], (None, "a b c", "a")]
    got = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    assert len(got) == len(docs)
    sizes = collections.Counter()
    for _, text, source in docs:
        sizes[source] += len(WORDS.findall(text or ""))
    want = expected_targets(sizes)
    taken = collections.Counter()
    for row in got:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(want[row.source])
        assert 0 <= row.taken <= 3 * row.size and row.taken == row.copies * row.size
        taken[row.source] += row.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(1, 0.01 * target), (source, taken[source], target)
    again = mixing.mix_sources(
        spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_rates_tilt_exponentially_and_meet_targets(spark):
    sized = spark.range(500).select(
        F.lit("s").alias("source"), (F.col("id") % 50 + 1).alias("size"), F.lit(10).alias("n"))
    total = sized.agg(F.sum(F.col("size") * F.col("n"))).first()[0]
    targets = spark.createDataFrame([("s", total, 5000, 2.5 * total)],
                                    "source string, source_size long, n_docs long, target double")
    lam, scale = mixing.tilts(sized, targets).select("lam", "scale").first()
    rate = F.least(F.lit(3.0), F.exp(lam * F.col("size") / scale))
    assert sized.agg(F.sum(rate * F.col("size") * F.col("n"))).first()[0] == pytest.approx(2.5 * total, rel=1e-8)


def test_mixing_nothing_and_copies_in_documents(spark):
    assert mixing.mix_sources(empty(spark)).count() == 0
    docs = frame(spark, ["a b"] * 30 + [None, ""])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    wanted = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect() if r.copies and r.size}
    assert {r.doc_id: r["count"] for r in mixed.where("text <> ''").groupBy("doc_id").count().collect()} == wanted
