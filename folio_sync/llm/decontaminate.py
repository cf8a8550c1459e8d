"""Benchmark decontamination with DataFrame functions alone.

A window is `SPAN` consecutive words of a benchmark item, or the whole of a shorter item. The
windows' hashes are a hash set that every task gets, as long as there are at most
`HELD_WINDOWS` of them with `HELD_BYTES` of text; more are met by a shuffled join behind a
bitmap of fixed size. A document's words are cut into segments that overlap by a window, so
that a row stays small however long its text is. A window whose hash is in the set is compared word
by word before it counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio_sync.llm.common import discarded, lower_ascii, sieved, whole_text, written

SPAN = 10
SEGMENT = 2048
HELD_WINDOWS, HELD_BYTES = 1 << 18, 32 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"
# A word of the text as it stands, with what lies between it and the word before.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*+[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def _apart(df: DataFrame, *names: str) -> DataFrame:
    """The same rows; later expressions refer to these columns and do not repeat them."""
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.explode(F.array(F.struct(*names))).alias("__of")).select(
        *kept, *(F.col(f"__of.{n}").alias(n) for n in names))


def _segments(rows: DataFrame, keys: list[str], span: int) -> DataFrame:
    """keys, n_words, at, words: the words of `text` in segments; `at` is the first one's number.

    Texts without words give no rows."""
    words = _apart(rows.select(*keys, F.regexp_extract_all(lower_ascii(whole_text()), F.lit(WORD), F.lit(0)).alias("all")), "all")
    cut = F.transform(
        F.sequence(F.lit(0), F.size("all") - 1, F.lit(SEGMENT)),
        lambda s: F.struct(s.alias("at"), F.slice("all", s + 1, SEGMENT + span - 1).alias("words")))
    return words.where(F.size("all") > 0).select(
        *keys, F.size("all").alias("n_words"), F.explode(cut).alias("cut")).select(*keys, "n_words", "cut.*")


def _windows(segments: DataFrame, lengths: list[int] = ()) -> DataFrame:
    """The segments' other columns with words, place, length, hash: one row per window.

    With an array column `spans` a segment has windows of these lengths, else of all `lengths`. The hashes of the words are made once; a window's hash is taken from them after the
    explode, so that windows need no arrays and pass through one stage of generated code."""
    if "spans" not in segments.columns:
        segments = segments.withColumn("spans", F.array(*(F.lit(n) for n in lengths)))
    each = _apart(segments.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))), "hashes")
    kept = [c for c in each.columns if c not in ("spans", "hashes")]
    placed = each.select(*kept, "spans", "hashes", F.posexplode("hashes").alias("place", "first"))
    placed = placed.select(*kept, "hashes", "place", F.explode("spans").alias("length"))
    placed = placed.where((F.col("place") < SEGMENT) & (F.col("place") + F.col("length") <= F.size("hashes")))
    return placed.select(
        *kept, "place", "length", F.xxhash64(F.slice("hashes", F.col("place") + 1, F.col("length"))).alias("hash"))


def _window_text(words: str = "words") -> Column:
    return F.concat_ws(" ", F.slice(words, F.col("place") + 1, F.col("length")))


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """hash, length, window, items: every different window with the ids of the items it is from.

    Ids are strings, sorted; an item without an id lends its windows but no id."""
    segments = _segments(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"), ["item"], span)
    found = _windows(segments.withColumn("spans", F.array(F.least("n_words", F.lit(span)))))
    return found.select("hash", "length", _window_text().alias("window"), "item").groupBy("hash", "length", "window").agg(
        F.array_sort(F.collect_set("item")).alias("items"))


def find_windows(docs: DataFrame, windows: DataFrame, span: int = SPAN,
                 held_windows: int = HELD_WINDOWS, held_bytes: int = HELD_BYTES) -> DataFrame:
    """doc_id, text_key, start, end, items: where windows of a written table stand in the documents, once each.

    `start` and `end` are word numbers, the end is exclusive."""
    keys = ["doc_id", "text_key"]
    size = windows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("window") + 24 * F.size("items")).alias("bytes"),
        F.collect_set("length").alias("lengths")).first()
    lengths = sorted(size.lengths) or [span]  # at most `span` numbers
    segments = _segments(docs.select(F.col("doc_id").cast("long"), F.xxhash64(whole_text()).alias("text_key"), "text"), keys, span)
    rows = _windows(segments, lengths)
    wanted = windows.select(F.col("hash").alias("__hash"), F.col("length").alias("__length"), "window", "items")
    if size.n <= held_windows and (size.bytes or 0) <= held_bytes:
        wanted = F.broadcast(wanted)
    else:
        rows = sieved(rows.withColumn("__window", F.col("hash")), "__window", windows, "hash")
    same = (F.col("hash") == F.col("__hash")) & (F.col("length") == F.col("__length")) & (_window_text() == F.col("window"))
    start = F.col("at") + F.col("place")
    return rows.join(wanted, same).select(
        *keys, start.alias("start"), (start + F.col("length")).alias("end"), "items").distinct()


def _covered(found: DataFrame) -> DataFrame:
    """With `fresh`: the number of a window's words that no window before it in the document covers."""
    before = Window.partitionBy("doc_id", "text_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    return found.withColumn("reached", reached).withColumn(
        "fresh", F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0)))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, **held) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, items.

    `benchmark` has item_id and text. Null and empty texts have no words: such documents are
    clean and such items have no windows. An item of fewer than `span` words is one window. A
    word inside several windows is hit once. Items that repeat an id are one; an item with a
    null id makes words hit but is not listed or counted. Rows that repeat a doc_id are told
    apart by their texts, equal rows give equal rows, null ids are kept. An empty table of documents gives no
    rows, one of items leaves all clean. Other columns are not read."""
    windows = written(benchmark_windows(benchmark, span), "windows")
    found = written(find_windows(docs, windows, span, **held), "windows-found")  # read twice
    hits = _covered(found).groupBy("doc_id", "text_key").agg(
        F.sum("fresh").alias("n_hit"))
    items = found.select("doc_id", "text_key", F.explode("items").alias("item")).distinct().groupBy(
        "doc_id", "text_key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    parts = hits.select("*", F.lit(None).cast("array<string>").alias("items")).unionByName(
        items.withColumn("n_hit", F.lit(None).cast("long")))
    known = written(parts.groupBy("doc_id", "text_key").agg(
        F.max("n_hit").alias("n_hit"), F.max("items").alias("items")), "contaminated")
    discarded(windows, found)
    counts = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(whole_text()).alias("text_key"),
        F.regexp_count(whole_text(), F.lit(PIECE)).cast("long").alias("n_words"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    known = known.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "n_hit", "items")
    return counts.join(
        known, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left"
    ).select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), listed.alias("items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, remove: str = "documents", **held) -> DataFrame:
    """`docs` without what is in the benchmark, with the same columns.

    `remove` is "documents", for those with a hit word, or "spans", for the hit words alone with
    what stands before each of them; a text without a hit word stays byte for byte. Nulls, repeated rows and
    empty tables as in `contamination`."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is {remove!r}, not 'documents' or 'spans'")
    windows = written(benchmark_windows(benchmark, span), "windows")
    found = _covered(find_windows(docs, windows, span, **held)).where("fresh > 0")
    # what is hit between the word that earlier windows reached and the window's end
    spans = found.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct(
        F.greatest("start", "reached").alias("start"), "end"))).alias("__spans"))
    known = written(spans, "spans").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__spans")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(whole_text()) == F.col("__key"))
    if remove == "documents":
        return docs.join(known, same, "left_anti")
    marked = docs.join(known, same, "left").withColumn(
        "__pieces", F.when(F.col("__spans").isNotNull(), F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))))
    marked = _apart(marked, "__pieces", "__spans")
    # the gaps between the spans; the last one reaches to the end
    gaps = F.transform(F.sequence(F.lit(0), F.size("__spans")), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.try_element_at("__spans", i)["end"]).alias("start"),
        F.coalesce(F.get("__spans", i)["start"], F.size("__pieces")).alias("end")))
    left = F.array_join(F.transform(gaps, lambda g: F.array_join(F.slice(
        "__pieces", g["start"] + 1, F.greatest(g["end"] - g["start"], F.lit(0))), "")), "")
    rest = F.substring("text", F.length(F.array_join("__pieces", "")) + 1, F.length("text"))
    return marked.withColumn(
        "text", F.when(F.col("__spans").isNotNull(), F.concat(left, rest)).otherwise(F.col("text"))
    ).select(*docs.columns)
