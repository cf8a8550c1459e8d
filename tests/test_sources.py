"""Manifests, lists, packages, archives, digests."""

import datetime as dt
import tarfile

import pyarrow as pa
from corpus_files import article, write_archive, write_list, write_package
from pyspark.sql import functions as F

from folio_sync.functions import names
from folio_sync.operators import audit, enrich
from folio_sync.sources import archives, manifest, packages


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_manifest_rules(tmp_path, spark):
    path = write_list(tmp_path / "m.csv", [
        ("a.tar.gz", "P1", "11", "2024-01-02 03:04:05", "true"),
        ("a.tar.gz", "P2", "", "", ""),
        ("a.tar.gz", "P3", "x", "2024-1-2 3:4:5", "No"),
        ("", "P4", "1", "2024-01-02 03:04:05", ""),
        ("a.tar.gz", "", "1", "2024-01-02 03:04:05", ""),
        ("a.tar.gz", "P5", "1", "yesterday", ""),
        ("a.tar.gz", "P6", "1", "2024-13-02 03:04:05", ""),
        ('"b,""c"".tar.gz"', "P7", "1", "", "YES"),
        ("a.tar.gz", "P8"),
        ("a.tar.gz", "P9", "1", "", "Y", "surplus"),
    ])
    good, bad = manifest.read_manifest(spark, path)
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows(good, "file_path", "pmcid", "pmid", "last_updated", "is_retracted") == {
        ("a.tar.gz", "P1", "11", t, True), ("a.tar.gz", "P2", None, None, False),
        ("a.tar.gz", "P3", "x", t, False), ('b,"c".tar.gz', "P7", "1", None, True),
        ("a.tar.gz", "P8", None, None, False), ("a.tar.gz", "P9", "1", None, True),
    }
    assert sorted(r.reason for r in bad.collect()) == ["bad_timestamp"] * 2 + ["missing_field"] * 2


def test_manifests_are_read_by_header_name(tmp_path, spark):
    one = write_list(tmp_path / "1.csv", [("2024-01-01 00:00:00", "P1", "a.tar.gz")], header=" Last Updated , Accession ID,File ")
    two = write_list(tmp_path / "2.csv", [("b.tar.gz", "P2", "7", "2024-01-01 00:00:00")], header="File,Accession ID,PMID,Last Updated")
    three = write_list(tmp_path / "3.csv", [("c.tar.gz", "P3", "", "", "yes")])
    empty = tmp_path / "4.csv"
    empty.write_text("")
    good, _ = manifest.read_manifest(spark, [one, two, three, str(empty), str(tmp_path / "absent.csv")])
    t = dt.datetime(2024, 1, 1)
    assert rows(good, "file_path", "pmcid", "pmid", "last_updated", "is_retracted") == {
        ("a.tar.gz", "P1", None, t, False), ("b.tar.gz", "P2", "7", t, False), ("c.tar.gz", "P3", None, None, True),
    }
    assert manifest.read_manifest(spark, str(empty))[0].isEmpty()
    assert rows(manifest.articles_per_archive(good), "file_path", "n_articles") == {
        ("a.tar.gz", 1), ("b.tar.gz", 1), ("c.tar.gz", 1)
    }


def test_last_line_counts_even_over_file_splits(tmp_path, spark):
    lines = [(f"a{i % 5}", f"P{i % 50}", "", "2024-01-01 00:00:00", "yes" if i >= 950 else "") for i in range(1000)]
    path = write_list(tmp_path / "m.csv", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        good, _ = manifest.read_manifest(spark, path)
        last = manifest.last_line_per_article(good.select("file_path", "pmcid", "is_retracted", "line_order"), ["file_path", "pmcid"])
        assert good.rdd.getNumPartitions() > 3
        assert rows(last, "is_retracted") == {(True,)} and last.count() == 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_retraction_lists(tmp_path, spark):
    (tmp_path / "h.csv").write_text("PMCID,reason\nP1,x\n\nP2\nP1\n")
    (tmp_path / "n.csv").write_text("P3\nP4\n")
    assert rows(manifest.read_retractions(spark, str(tmp_path / "h.csv")), "pmcid") == {("P1",), ("P2",)}
    assert rows(manifest.read_retractions(spark, str(tmp_path / "n.csv")), "pmcid") == {("P3",), ("P4",)}
    assert manifest.read_retractions(spark, str(tmp_path / "absent.csv")).isEmpty()


def test_packages(tmp_path, spark):
    for area, day in (("oa_other", "2024-01-11"), ("oa_comm", "2024-01-12"), ("oa_comm", "2024-01-11"), ("oa_comm", "2024-01-10")):
        write_package(tmp_path, day, {}, None, area=area)
    write_archive(tmp_path / "oa_bulk/oa_comm/xml/oa_comm_xml.PMC000.baseline.tar.gz", {})
    (tmp_path / "oa_bulk/oa_comm/xml/oa_comm_xml.incr.2024-01-13.tar.gz.md5").write_text("x")
    listing = packages.list_archives(spark, str(tmp_path))
    assert listing.count() == 4  # an archive without a date in its name is no package, nor is a digest file
    assert not [r.path for r in listing.collect() if "baseline" in r.path or r.path.endswith(".md5")]

    def found(*args, **kwargs):
        return [r.archive_path for r in packages.find_packages(listing, *args, **kwargs).collect()]

    comm, other = ("oa_bulk/%s/xml/%s_xml.incr.2024-01-" % (a, a) for a in ("oa_comm", "oa_other"))
    after = [comm + "11.tar.gz", other + "11.tar.gz", comm + "12.tar.gz"]
    assert found(dt.datetime(2024, 1, 10, 23, 59)) == after
    assert found(dt.date(2024, 1, 10), inclusive=True) == [comm + "10.tar.gz", *after]
    assert found() == [comm + "10.tar.gz", *after]
    assert found(dt.date(2024, 1, 1), marker=comm + "11.tar.gz") == after[1:]
    assert found(dt.date(2024, 1, 10), marker=comm + "10.tar.gz") == after
    assert found(dt.date(2024, 1, 12)) == []
    first = packages.find_packages(listing, dt.date(2024, 1, 11)).first()
    assert first.file_list_path.endswith("oa_comm_xml.incr.2024-01-12.filelist.csv")
    assert first.date == dt.datetime(2024, 1, 12)
    assert packages.list_archives(spark, str(tmp_path / "absent")).isEmpty()


def test_name_expressions(spark):
    df = spark.createDataFrame([("s3://b/x/oa_bulk/oa_noncomm/xml/n.incr.2024-01-02.tar.gz",), ("n.incr.2024-02-31.tar.gz",), ("n.tar.gz",)], "p string")
    p = F.col("p")
    got = df.select(names.package_day(p), names.package_key(p), names.area_of(p), names.area_rank(p), names.base_name(p), names.resolve(p, "/base/")).collect()
    assert tuple(got[0]) == (dt.date(2024, 1, 2), "oa_bulk/oa_noncomm/xml/n.incr.2024-01-02.tar.gz", "oa_noncomm", 1,
                             "n.incr.2024-01-02.tar.gz", "s3://b/x/oa_bulk/oa_noncomm/xml/n.incr.2024-01-02.tar.gz")
    assert tuple(got[1])[:4] == (None, "n.incr.2024-02-31.tar.gz", None, 3)
    assert got[2][0] is None and got[2][5] == "/base/n.tar.gz"


def test_batches_of_members_are_bounded_in_bytes(tmp_path):
    """Texts of wide characters take four bytes a character, in a task and in its batches."""
    text = "\U0001F600" * 250_000
    write_archive(tmp_path / "a.tar.gz", {f"{i}.xml": text for i in range(12)})
    paths = pa.RecordBatch.from_pylist([{"archive_path": "a", "location": str(tmp_path / "a.tar.gz")}])
    batches = list(archives._expanding(16 << 20)(iter([paths])))
    assert sum(b.num_rows for b in batches) == 13
    assert max(b.nbytes for b in batches) < 8 << 20


def test_archive_members(tmp_path, spark):
    digest = write_archive(tmp_path / "a.tar.gz", {
        "d/1.xml": "one", "2.NXML": "zwei ä".encode(), "3.txt": "no", "4.xml.bak": "no", "5.Xml": b"\xef\xbb\xbffive\r\nx",
        "6.xml": '<?xml version="1.0" encoding="ISO-8859-1"?>\xe4'.encode("latin-1"), "7.xml": "utf sixteen ä".encode("utf-16"),
        "8.xml": b"bad \xff byte", "9.xml": b'<?xml encoding="nonsense"?>x',
    })
    whole = (tmp_path / "a.tar.gz").read_bytes()
    for name, data in (("cut", whole[:-30]), ("tail", whole[:-8] + b"\0" * 8), ("text", b"hello"), ("none", b"")):
        (tmp_path / f"{name}.tar.gz").write_bytes(data)
    paths = spark.createDataFrame(
        [(n, f"file:{tmp_path}/{n}.tar.gz") for n in ("a", "cut", "tail", "text", "none", "absent")], "archive_path string, location string"
    )
    members = archives.expand_archives(paths, 6, spread=3)
    assert rows(members.where("archive_path = 'a' and member_name is not null"), "member_name", "xml") == {
        ("d/1.xml", "one"), ("2.NXML", "zwei ä"), ("5.Xml", "five\nx"),
        ("6.xml", '<?xml version="1.0" encoding="ISO-8859-1"?>ä'), ("7.xml", "utf sixteen ä"),
        ("8.xml", None), ("9.xml", '<?xml encoding="nonsense"?>x'),
    }
    # bytes that are no UTF-8 are not replaced: the member is a reject of its own
    # (so it is in the archive whose checksum at the end is wrong)
    assert rows(members.where("member_error is not null"), "archive_path", "member_name") == {("a", "8.xml"), ("tail", "8.xml")}
    assert "UnicodeDecodeError" in members.where("member_name = '8.xml'").first().member_error
    status = {r.archive_path: r for r in archives.archive_status(members).collect()}
    assert len(status) == 6 and status["a"].archive_md5 == digest and status["a"].archive_error is None
    assert all(status[n].archive_error for n in ("cut", "tail", "text", "none", "absent"))


def test_large_archives_leave_in_several_batches(tmp_path, spark):
    size = archives.BATCH_BYTES // 3
    write_archive(tmp_path / "a.tar.gz", {f"{i}.xml": "x" * size for i in range(8)})
    paths = spark.createDataFrame([("a", str(tmp_path / "a.tar.gz"))], "archive_path string, location string")
    members = archives.expand_archives(paths, 1)
    assert rows(members.groupBy().agg(F.count("member_name"), F.sum(F.length("xml"))), "*") == {(8, 8 * size)}


def test_large_members_leave_article_by_article(tmp_path, spark):
    """The same articles with the same numbers as those of members read whole, for every size of chunk."""
    import random

    from folio_sync.functions import jats

    parts = ["<article>", "<article a='1'>", "</article>", "</article >", "<article/>", "<article b='/'/>", "<!-- <article> -->", "<!--",
             "-->", "<![CDATA[</article>]]>", "<![CDATA[", "x", "\r\n", "<articles>", "<article-meta/>", "é", "<p>", "</p>", "<", ">"]
    r = random.Random(5)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(400)]
    plain = [t.replace("\r\n", "\n") for t in texts]
    df = spark.createDataFrame(list(enumerate(plain)), "i int, x string")
    for row in df.select("i", jats.split_articles(F.col("x")).alias("found")).collect():
        text = plain[row.i]
        for size in (1, 3, 7, 1000):
            chunks = (text[k:k + size] for k in range(0, len(text), size))
            assert list(archives.article_pieces(chunks)) == row.found, (text, size)
    write_archive(tmp_path / "a.tar.gz", {f"{i}.xml": t for i, t in enumerate(texts)} | {"cut.xml": b"<article>1</article><article>\xff"})
    paths = spark.createDataFrame([("a", str(tmp_path / "a.tar.gz"))], "archive_path string, location string")
    small = archives.expand_archives(paths, 1, member_bytes=0).where("member_name <> 'cut.xml'")
    assert {(r.member_name, r.first_article + pos, x) for r in small.collect() for pos, x in enumerate([r.xml] if r.xml else [])} == {
        (f"{r.i}.xml", k, x) for r in df.select("i", jats.split_articles(F.col("x")).alias("found")).collect() for k, x in enumerate(r.found)}
    cut = archives.expand_archives(paths, 1, member_bytes=0).where("member_name = 'cut.xml'").collect()
    assert len(cut) == 1 and cut[0].xml is None and cut[0].member_error


def test_a_large_member_does_not_fill_the_worker(tmp_path):
    import tracemalloc

    one = "<article><body>" + "word " * 100_000 + "</body></article>\n"
    write_archive(tmp_path / "a.tar.gz", {"all.xml": "<articles>" + one * 100 + "</articles>"})
    tracemalloc.start()
    found = sum(1 for _ in archives._member_texts(str(tmp_path / "a.tar.gz"), {}, archives.BATCH_BYTES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 100 and peak < 16 << 20  # of 50 MB


def test_digests(tmp_path, spark):
    digest = write_archive(tmp_path / "ok.tar.gz", {"a.xml": article("P")})
    for name, text in (("ok", f"MD5 (ok.tar.gz) = {digest}\n"), ("wrong", f"MD5 = {'0' * 32}"), ("odd", "no digest")):
        (tmp_path / f"{name}.tar.gz.md5").write_text(text)
    published = audit.read_sidecars(spark, [str(tmp_path)])
    found = spark.createDataFrame([(f"{n}.tar.gz", digest, None) for n in ("ok", "wrong", "odd", "free")],
                                  "archive_path string, archive_md5 string, archive_error string")
    audited = audit.audit_archives(found, published)
    assert rows(audited, "archive_path", "status") == {
        ("ok.tar.gz", "verified"), ("wrong.tar.gz", "mismatch"), ("odd.tar.gz", "unparsable"), ("free.tar.gz", "unverified"),
    }
    assert rows(audit.failed_archives(audited), "archive_path", "reason") == {("wrong.tar.gz", "mismatch"), ("odd.tar.gz", "unparsable")}
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep/x.tar.gz.md5").write_text("MD5 = y")
    named = audit.read_sidecars(spark, [str(tmp_path)], base=f"file://{tmp_path}/")
    assert ("deep/x.tar.gz", "MD5 = y") in rows(named, "archive_path", "sidecar_text")
    tags = spark.createDataFrame([("ok.tar.gz", f'"{digest}"'), ("wrong.tar.gz", '"aa"'), ("odd.tar.gz", '"aa-3"'), ("free.tar.gz", None)],
                                 "archive_path string, etag string")
    assert rows(audit.audit_archives(found, tags), "archive_path", "status") == {
        ("ok.tar.gz", "verified"), ("wrong.tar.gz", "mismatch"), ("odd.tar.gz", "unverified"), ("free.tar.gz", "unverified"),
    }


def test_enrich_joins_within_the_archive(spark):
    articles = spark.createDataFrame([("a", "P1"), ("a", "P2"), ("b", "P1"), ("b", "P3")], "archive_path string, pmcid string")
    listed = spark.createDataFrame(
        [("a", "P1", 1, False, 1), ("a", "P1", 2, True, 2), ("b", "P3", None, False, 3), ("c", "P2", 1, True, 4)],
        "archive_path string, pmcid string, last_updated int, is_retracted boolean, line_order int",
    )
    good, unlisted = enrich.enrich(articles, listed)
    assert rows(good, "archive_path", "pmcid", "source_last_updated", "is_retracted") == {("a", "P1", 2, True), ("b", "P3", None, False)}
    assert rows(unlisted, "archive_path", "pmcid") == {("a", "P2"), ("b", "P1")}


def test_lists_with_different_headers_are_one_read(spark, tmp_path):
    files = {
        "a.csv": "File,Accession ID,PMID,Last Updated,Retracted\na1,PMC1,1,2024-01-01 00:00:00,yes\n",
        "b.csv": "Retracted, Accession ID ,more,File\nno,PMC2,x,b1\n,PMC3,,b2,beyond\nY,PMC4\n",
        "c.csv": "\nAccession ID,\"File\"\nPMC5,c1\n",
        "d.csv": "",
        "e.csv": "File,Accession ID,PMID,Last Updated,Retracted\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, bad = manifest.read_manifest(spark, [str(tmp_path / name) for name in files])
    assert {(x.file_path, x.pmcid, x.pmid, x.is_retracted, x.list_path[-5:]) for x in good.collect()} == {
        ("a1", "PMC1", "1", True, "a.csv"), ("b1", "PMC2", None, False, "b.csv"),
        ("b2", "PMC3", None, False, "b.csv"), ("c1", "PMC5", None, False, "c.csv"),
    }
    assert [(x.key, x.reason) for x in bad.collect()] == [("PMC4", "missing_field")]
    scans = good._jdf.queryExecution().optimizedPlan().toString().count(" csv")
    assert scans == 1


def test_lines_of_one_list_are_not_brought_together(spark, tmp_path):
    """A join by the list's name would bring all lines of a long list to one task."""
    (tmp_path / "l.csv").write_text("Accession ID,File\nPMC1,a.tar.gz\nPMC2,a.tar.gz\n")
    listed, _ = manifest.read_manifest(spark, f"{tmp_path}/l.csv")
    assert "Join" not in listed._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in listed.select("file_path", "pmcid").orderBy("pmcid").collect()] == [
        ("a.tar.gz", "PMC1"), ("a.tar.gz", "PMC2")]


def test_a_package_is_one_archive_however_large(spark, tmp_path):
    """The feed takes a number of packages at a time, so their number must not grow with their articles."""
    from query_catalog.jobs import write_archives

    rows = spark.range(100).selectExpr(
        "'PMC' || id AS pmcid", "'<article>' || id || '</article>' AS xml", "CAST(NULL AS STRING) AS updated", "'yes' AS retracted")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        written = write_archives(
            rows.repartition(2, "pmcid"), f"{tmp_path}/p", lambda task, batch: f"{task}-{batch}.incr.2024-01-08.tar.gz", True)
        packed = {r["file_path"]: r["count"] for r in written.groupBy("file_path").count().collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(packed) == 2 and sum(packed.values()) == 100
    for path, n in packed.items():
        with tarfile.open(f"{tmp_path}/p/{path}") as tar:
            assert len(tar.getnames()) == n
        lines = (tmp_path / "p" / path.replace(".tar.gz", ".filelist.csv")).read_text().splitlines()
        assert len(lines) == n + 1 and all(line.startswith(f"{path},PMC") and line.endswith(",yes") for line in lines[1:])
