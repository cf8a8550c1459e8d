"""Fuzzy line dedup with DataFrame functions alone.

A line is the set of its character shingles: the `SHINGLE` characters from each word's start,
from every letter of scripts without spaces, from each run of signs, and again after `RUN` characters
of a longer run of letters and digits. A piece of a run that is longer than `SHINGLE` is a shingle
whole, so every character but white space is in one.
Shingles are hashed once; the hash range is cut into `ROWS * BANDS` bins, and the smallest hash
of each bin is the signature (an empty bin takes the next one's). `ROWS` bins make a band. Lines
with a Jaccard similarity of `SIMILAR` or more are linked, and of each component of links one line
stays: the first of the document with the smallest id.

All pairs of lines that share a band of at most `FULL` are candidates. In a fuller band a line
is first compared with the band's first line and with the line before it. Where that leaves the band in
several components, its lines are split by their rare shingles: two linked sets overlap so much that
the rarest shingles of both, as many as their sizes say, have one in common. All lines with such a
shingle in common that are not connected yet are compared, so no pair that shares a band is left
out, however full it is.

A candidate is compared exactly only if the numbers of shingles in each bin allow a link: linked
sets differ in at most `(1 - SIMILAR) / (1 + SIMILAR)` of both sizes together, and in each bin they differ
at least by the difference of their numbers there.

Two lines of similarity s share a band with probability 1 - (1 - s^3)^7: 0.993 at 0.8
and 0.999 at 0.85.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio_sync.llm.common import discarded, sieved, whole_text, written
from folio_sync.llm.components import components

SHINGLE, RUN = 8, 12
BANDS, ROWS = 7, 3
SIMILAR = 0.8
MIN_CHARS = 1  # blank lines are left alone
FUZZY_CHARS = 12  # shorter lines are compared for equality alone
CLASS = 1.05  # sizes of sets within this ratio are in one class
BLOCK = 1024  # lines with one rare shingle are met in blocks of about so many
FULL = 512  # of bands with at most so many lines all pairs are looked at
BIN_BITS = 9  # a bin's number of shingles is kept up to this, as so many bits
IN_LONG = 63 // BIN_BITS  # bins in a long
HOT_PARTS = 1 << 16  # keys with more than this part of all rows, fewer than that in number, are broadcast

_SHINGLES = (
    rf"(?s)(?!\s)(?=((?!\p{{Lo}})[\p{{L}}\p{{N}}]{{{SHINGLE + 1},{RUN}}}+|.{{1,{SHINGLE}}}))"
    rf"(?:\p{{Lo}}|[\p{{L}}\p{{N}}]{{1,{RUN}}}+|[^\p{{L}}\p{{N}}\s]{{1,{SHINGLE}}}+)")


def _found(line: str) -> Column:
    """The shingles of a line, repeated ones too; none for a line of white space."""
    return F.regexp_extract_all(line, F.lit(_SHINGLES), F.lit(1))


def _or_line(found: str, line: str) -> Column:
    """A line without shingles is one, itself."""
    return F.when(F.size(found) == 0, F.array(line)).otherwise(F.col(found))


def _places(hashes: Column, edges: Column) -> Column:
    """Of each bin the place of its first hash among the sorted `hashes`."""
    # an edge's place among hashes and edges tells how many hashes lie below it; the sorted array is
    # bound as a variable, since the optimizer would otherwise sort again for each edge
    return F.transform(F.array(F.sort_array(F.concat(hashes, edges))), lambda marked: F.transform(
        edges, lambda e, i: (F.array_position(marked, e) - i).cast("int")))[0]


def _smallest(hashes: Column, places: Column) -> Column:
    """Of each bin the smallest hash; an empty one takes the next one's."""
    return F.transform(places, lambda p: F.coalesce(F.try_element_at(hashes, p), F.element_at(hashes, 1)))


def _numbers(count: int) -> Column:
    return F.array(*(F.lit(i) for i in range(count)))


def _bands(smallest: Column, count: int) -> Column:
    return F.transform(_numbers(count), lambda b: F.xxhash64(b, F.slice(smallest, b * ROWS + 1, ROWS)))


def _ones(places: Column, size: Column, count: int) -> Column:
    """Of each bin as many ones as it has hashes, up to `BIN_BITS`."""
    ones = F.array(*(F.lit((1 << n) - 1).cast("long") for n in range(BIN_BITS + 1)))
    ends = F.concat(F.slice(places, 2, ROWS * count), F.array(size + 1))
    return F.zip_with(places, ends, lambda p, end: F.get(ones, F.least(end - p, F.lit(BIN_BITS))))


def _bin_sizes(ones: Column, count: int) -> Column:
    """`IN_LONG` bins in a long: two lines differ in as many bits as the numbers of their bins do."""
    return F.transform(_numbers(-(-ROWS * count // IN_LONG)), lambda i: F.aggregate(
        F.slice(ones, i * IN_LONG + 1, IN_LONG), F.lit(0).cast("long"), lambda held, one: F.shiftleft(held, BIN_BITS).bitwiseOR(one)))


def _sizes(count: int) -> list[str]:
    return ["size", *(f"bins{i}" for i in range(-(-ROWS * count // IN_LONG)))]


def _near(count: int, similar: float, one: str = "", other: str = "other_") -> Column:
    """Whether two lines may be linked, by their `_sizes`; true for all that are."""
    size, *bins = _sizes(count)
    most = (F.col(one + size) + F.col(other + size)) * ((1 - similar) / (1 + similar)) + 1e-6
    apart = sum((F.bit_count(F.col(one + b).bitwiseXOR(F.col(other + b))) for b in bins), F.lit(0))
    return (F.abs(F.col(one + size) - F.col(other + size)) <= most) & (apart <= most)


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no, line, key: the trimmed lines of at least `MIN_CHARS` characters."""
    text = whole_text()
    split = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n", -1)))
    line = F.trim(F.col("col"))
    return split.select("doc_id", "text_key", F.col("pos").alias("line_no"), line.alias("line")).where(
        F.length("line") >= MIN_CHARS).withColumn("key", F.xxhash64("line"))


def _kinds(lines: DataFrame, count: int) -> DataFrame:
    """One row per different line: key, first_doc, n, its `_sizes` and its bands. `same` is false where two
    different lines share the 64-bit key; those are left alone."""
    width = (1 << 64) // (ROWS * count)
    edges = F.array(*(F.lit(-(1 << 63) + i * width).cast("long") for i in range(ROWS * count)))
    found = lines.withColumn("found", _found("line"))
    hashed = found.withColumn("hashes", F.sort_array(F.array_distinct(
        F.when(F.size("found") == 0, F.array(F.xxhash64("line")))
        .otherwise(F.transform("found", lambda s: F.xxhash64(s))))))
    placed = hashed.withColumn("places", _places(F.col("hashes"), edges)).withColumn("size", F.size("hashes"))
    binned = placed.withColumn("smallest", _smallest(F.col("hashes"), F.col("places"))).withColumn(
        "ones", _ones(F.col("places"), F.col("size"), count))
    sizes = _sizes(count)
    # few large expressions and many lambdas: generated code for all bins takes a compiler's memory
    keyed = binned.select(
        "key", "doc_id", F.xxhash64("line", F.lit(1)).alias("second"), (F.length("line") >= FUZZY_CHARS).alias("fuzzy"), "size",
        _bin_sizes(F.col("ones"), count).alias("bins"), _bands(F.col("smallest"), count).alias("bands"),
    ).select(
        "key", "doc_id", "second", "fuzzy", "size", *(F.col("bins")[i].alias(s) for i, s in enumerate(sizes[1:])),
        *(F.col("bands")[i].alias(f"band{i}") for i in range(count)))
    return keyed.groupBy("key").agg(
        F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n"),
        (F.min("second") == F.max("second")).alias("same"), F.min("fuzzy").alias("fuzzy"),
        *(F.min(s).alias(s) for s in sizes), *(F.min(f"band{i}").alias(f"band{i}") for i in range(count)))


def _banded(kinds: DataFrame, count: int) -> DataFrame:
    """Lines that share a band with another: band, its number of lines `n`, key, the band's `first`
    key and the one `before`."""
    banded = kinds.where("same and fuzzy").select(
        "key", F.explode(F.array(*(F.col(f"band{i}") for i in range(count)))).alias("band"))
    group = Window.partitionBy("band")
    placed = group.orderBy("key")
    return banded.select(
        "band", F.count(F.lit(1)).over(group).alias("n"), "key", F.first("key").over(placed).alias("first"),
        F.lag("key").over(placed).alias("before")).where("n > 1")


def _candidates(banded: DataFrame, facts: DataFrame, count: int, similar: float) -> DataFrame:
    """Pairs (key, other) of lines that share a band and may be linked: all pairs of a band, but of
    one that is full only those with the band's first and with the one before."""
    sizes = _sizes(count)
    others = facts.select(F.col("key").alias("other"), *(F.col(s).alias(f"other_{s}") for s in sizes))
    near = _near(count, similar)
    placed = banded.where(F.col("n") <= FULL).join(facts, "key").select("band", "key", *sizes)
    met = placed.select("band", F.col("key").alias("other"), *(F.col(s).alias(f"other_{s}") for s in sizes))
    pairs = placed.join(met, "band").where((F.col("key") < F.col("other")) & near).select("key", "other")
    full = banded.where((F.col("n") > FULL) & F.col("before").isNotNull()).select(
        "key", F.explode(F.array("first", "before")).alias("other")).distinct()
    return pairs.unionByName(full.join(facts, "key").join(others, "other").where(near).select("key", "other")).distinct()


def _texts(keys: DataFrame, lines: DataFrame, facts: DataFrame) -> DataFrame:
    """key, line: the lines with these keys."""
    wanted = written(keys.distinct().join(facts.select("key", "first_doc"), "key"), "wanted")
    at = wanted.select(F.col("key").alias("at"), "first_doc")
    texts = written(
        sieved(lines, "key", wanted, "key").join(
            at, (F.col("key") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first_doc")), "left_semi")
        .select("key", "line").dropDuplicates(["key"]), "line-texts")
    discarded(wanted)
    return texts


def _links(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The candidate pairs whose exact Jaccard similarity is high enough."""
    one = texts.withColumnRenamed("line", "a")
    two = texts.select(F.col("key").alias("other"), F.col("line").alias("b"))
    # the shingles leave through an explode of one element: the optimizer would otherwise repeat
    # them wherever the condition below refers to them
    both = pairs.join(one, "key").join(two, "other").select(
        "key", "other", "a", "b", F.explode(F.array(F.struct(_found("a").alias("x"), _found("b").alias("y")))).alias("of"))
    x, y = _or_line("of.x", "a"), _or_line("of.y", "b")
    total = F.size(F.array_distinct(x)) + F.size(F.array_distinct(y))
    # common >= similar * (total - common), with common written once
    return written(
        both.where(F.size(F.array_intersect(x, y)) * (1 + similar) >= similar * total - 1e-9)
        .select(F.col("key").alias("a"), F.col("other").alias("b")), "line-links")


def _with_facts(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """`rows`, a written table, joined with the one row of `facts` for their key, which has the number
    `n` of rows with it. Keys that hold more than a `HOT_PARTS`th of all rows are broadcast, so no
    task gets all rows of a hot one."""
    most = rows.count() // HOT_PARTS
    hot = facts.where(F.col("n") > most) if most else facts.limit(0)
    rest = facts.where(F.col("n") <= most) if most else facts
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti") if most else rows
    near = rows.join(F.broadcast(hot), key)
    return near.unionByName(others.join(rest, key)) if most else others.join(rest, key)


def _unsettled(banded: DataFrame, linked: DataFrame) -> DataFrame:
    """key, component: the lines of full bands that are in several components."""
    crowded = banded.where(F.col("n") > FULL).join(linked, F.col("key") == F.col("node"), "left").select(
        "band", "key", F.coalesce("component", "key").alias("component"))
    open_ = crowded.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    return crowded.join(open_, "band", "left_semi").select("key", "component").distinct()


def _overlap(total: Column, similar: float) -> Column:
    """The fewest common shingles of linked sets with so many in `total`."""
    return F.ceil(total * (similar / (1 + similar)) - 1e-6).cast("int")


def _close_pairs(unsettled: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Pairs (key, other) of lines in different components that share one of their rarest shingles.

    Sets x and y, x the smaller, are linked if they have `_overlap(|x| + |y|)` shingles in common.
    Then the |x| - overlap + 1 rarest of x and the |y| - overlap + 1 rarest of y share one, in any
    order of shingles. x takes the overlap with a set of its own size, the least it can be, and y
    one for each class of sizes that x can be in."""
    found = unsettled.join(texts, "key").withColumn("found", _found("line"))
    tokens = written(found.select("key", "component", F.explode(F.array_distinct(
        F.transform(_or_line("found", "line"), lambda s: F.xxhash64(s)))).alias("token")), "line-shingles")
    counts = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "shingle-counts")
    sets = written(
        _with_facts(tokens, counts, "token").groupBy("key", "component")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
        .select("key", "component", F.size("tokens").alias("size"), F.col("tokens.token").alias("tokens")), "line-sets")
    discarded(tokens, counts)

    def of_class(size: Column) -> Column:
        return F.floor(F.log(size) / F.log(F.lit(CLASS))).cast("int")

    def rarest(rows: DataFrame, overlap: Column) -> DataFrame:
        return rows.select(
            "key", "component", "size", "class",
            F.posexplode(F.slice("tokens", F.lit(1), F.greatest(F.col("size") - overlap + 1, F.lit(0)))).alias("at", "token"))

    size = F.col("size")
    fewest = F.ceil(size * similar - 1e-6)
    small = written(rarest(sets.withColumn("class", of_class(size)), _overlap(size * 2, similar)), "rare-small")
    classes = sets.withColumn("class", F.explode(F.sequence(of_class(fewest), of_class(size))))
    least = F.greatest(fewest, F.floor(F.pow(F.lit(CLASS), F.col("class"))))
    large = rarest(classes, _overlap(size + least, similar)).toDF("other", "other_component", "other_size", "class", "other_at", "token")
    blocks = small.groupBy("class", "token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocks = written(blocks, "rare-blocks")
    split = blocks.where("blocks > 1")
    cut = small.join(split, ["class", "token"], "left").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.coalesce("blocks", F.lit(1))).cast("int")).drop("blocks")
    met = large.join(blocks, ["class", "token"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    left = F.least(size - F.col("at"), F.col("other_size") - F.col("other_at"))
    pairs = written(
        cut.join(met, ["class", "token", "block"]).where(
            "component <> other_component and (size < other_size or size = other_size and key < other)")
        .where(left >= _overlap(size + F.col("other_size"), similar)).select("key", "other").distinct(), "close-pairs")
    discarded(sets, small, blocks)
    return pairs


def _all_linked(kinds: DataFrame, lines: DataFrame, count: int, similar: float) -> DataFrame:
    """node, component of the lines that are linked with another."""
    banded = written(_banded(kinds, count), "line-bands")
    facts = written(
        banded.select("key").distinct().join(kinds.select("key", "first_doc", *_sizes(count)), "key"), "line-facts")
    pairs = written(_candidates(banded, facts, count, similar), "line-pairs")
    keys = pairs.select("key").unionByName(pairs.select(F.col("other").alias("key")))
    texts = _texts(keys.unionByName(banded.where(F.col("n") > FULL).select("key")), lines, facts)
    links = _links(pairs, texts, similar)
    linked = components(links)
    unsettled = written(_unsettled(banded, linked), "unsettled")
    discarded(banded, facts, pairs)
    if not unsettled.isEmpty():
        pairs = _close_pairs(unsettled, texts, similar)
        more = _links(pairs, texts, similar)
        if not more.isEmpty():
            before, linked = linked, components(links.unionByName(more))
            discarded(before)
        discarded(pairs, more)
    discarded(texts, links, unsettled)
    return linked


def line_dedup(docs: DataFrame, count: int = BANDS, similar: float = SIMILAR) -> DataFrame:
    """One row per line of `docs(doc_id, text, ...)` that takes part: doc_id, text_key, line_no,
    component, kept.

    Lines are cut at newlines and compared without spaces at their ends; lines under `MIN_CHARS`
    characters take no part and are always kept, those under `FUZZY_CHARS` are linked if equal. A null or empty text has no lines, an empty
    table gives no rows. A line that has no equal or similar line is its own component. Rows that
    repeat a doc_id and its text are one document; with one id on different texts the smaller
    `text_key` comes first, a null id comes last. Other columns are not read."""
    lines = lines_of(docs)
    kinds = written(_kinds(lines, count), "lines")
    linked = _all_linked(kinds, lines, count, similar)
    groups = written(kinds.where("same").join(linked, F.col("key") == F.col("node"), "left").where(
        "n > 1 or component is not null").select(
            "key", "first_doc", F.coalesce("component", "key").alias("component")), "line-groups")
    keep = written(groups.groupBy("component").agg(
        F.min("first_doc").alias("keep_doc"), F.count(F.lit(1)).alias("n")), "kept-lines")
    repeated = written(_with_facts(groups.drop("first_doc"), keep, "component").drop("n"), "repeated-lines")
    discarded(kinds, linked, groups, keep)
    return _with_kept(lines.drop("line").join(repeated, "key", "left"))


def _with_kept(known: DataFrame) -> DataFrame:
    placed = F.struct("text_key", "line_no")
    here = F.col("component").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_doc"))
    first = (
        known.where(here).groupBy("component", "text_key").agg(F.min("line_no").alias("line_no"))
        .groupBy("component").agg(F.min(placed).alias("first"))
    )
    # a line that has no equal or similar one is no component's name, so it finds no first; were
    # its component null, all such lines would meet in one task
    return known.withColumnRenamed("component", "found").withColumn("component", F.coalesce("found", "key")).join(
        first, "component", "left").select(
        "doc_id", "text_key", "line_no", "component",
        F.when(F.col("found").isNull(), True)
        .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_doc")) & (placed == F.col("first"))).alias("kept"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """`docs` with the texts that are left when of all equal and similar lines one is kept.

    Texts that lose no line stay as they are, byte for byte."""
    found = line_dedup(docs, **options)
    gone = written(
        found.where("not kept").groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("__gone")), "lines-gone"
    ).select(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key"), "__gone")
    cut = docs.join(
        gone, (F.xxhash64(whole_text()) == F.col("__gone_key")) & docs["doc_id"].cast("long").eqNullSafe(F.col("__gone_id")),
        "left",
    ).withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split("text", "\n", -1)))
    left = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone"), lambda i: F.get("__lines", i)), "\n")
    return cut.withColumn("text", F.when(F.col("__gone").isNotNull(), left).otherwise(F.col("text"))).drop(
        "__gone_id", "__gone_key", "__gone", "__lines")
