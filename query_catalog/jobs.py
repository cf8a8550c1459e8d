"""The load jobs, run on archives that Spark writes from the documents."""

from __future__ import annotations

import datetime as dt
import tarfile
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from folio_sync.functions.names import package_day, resolve
from folio_sync.operators.audit import audit_archives, read_sidecars
from folio_sync.operators.extract import extract_articles, good_articles
from folio_sync.operators.quality import QualityError
from folio_sync.plans.delta_load import delta_load
from folio_sync.plans.full_load import full_load
from folio_sync.plans.publish import (
    append_articles, commit_retractions, replace_articles, upsert_articles,
)
from folio_sync.plans.staging import ROW, materialize
from folio_sync.session import scratch_path
from folio_sync.sources import corpus
from folio_sync.sources.archives import archive_status, expand_archives, open_stream
from folio_sync.sources.manifest import articles_per_archive
from folio_sync.sources.packages import find_packages, list_archives
from folio_sync.streaming.package_feed import package_feed
from query_catalog.common import clock, escape_xml, pmcid, seconds, table, time_text

FULL_TS, DELTA_TS = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)


def spark_tasks(spark) -> int:
    """Parts for a table of unknown size that is written by hand: one per core."""
    return spark.sparkContext.defaultParallelism


def _open_target(target: str):
    import pyarrow.fs as pafs

    if "://" in target:
        filesystem, path = pafs.FileSystem.from_uri(target)
    else:
        filesystem, path = pafs.LocalFileSystem(), target.removeprefix("file:")
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(path, compression=None)


def _store_file(target: str, data: bytes) -> None:
    with _open_target(target) as out:
        out.write(data)


def _copy_file(source: str, target: str) -> None:
    with open_stream(source) as stream, _open_target(target) as out:
        while data := stream.read(1 << 20):
            out.write(data)


def _add_members(tar: tarfile.TarFile, batch: pa.RecordBatch) -> None:
    xml = batch.column("xml")
    for i, member in enumerate(batch.column("pmcid").to_pylist()):
        data = xml[i].as_buffer()
        info = tarfile.TarInfo(member + ".xml")
        info.size = data.size
        tar.addfile(info, pa.BufferReader(data))
        tar.members = []  # the list of what was passed is not needed


def _packed(path: str, batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * batch.num_rows, pa.string()), batch.column("pmcid")], names=["file_path", "pmcid"])


def write_archives(members, base: str, name, file_lists: bool = False):
    """Write the rows (pmcid, xml) as .tar.gz archives: one per Arrow batch of a task, or, with
    `file_lists`, one per task that has rows, as the publisher makes one package of what an area has
    on a day, however much it is.

    An archive is written member by member, so that a task holds one batch and one text.
    `name(task, batch)` names an archive. With `file_lists`, the columns `updated`
    and `retracted` become a file list next to each. Returns (file_path, pmcid).
    """
    columns = ["pmcid", "xml"] + (["updated", "retracted"] if file_lists else [])

    def archives(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            path = name(task, number)
            with _open_target(f"{base}/{path}") as out, tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as tar:
                _add_members(tar, batch)
            yield _packed(path, batch)

    def package(batches):
        from pyspark import TaskContext

        batches = (batch for batch in batches if batch.num_rows)
        batch = next(batches, None)
        if batch is None:
            return
        path = name(TaskContext.get().partitionId(), 0)
        list_path = path.replace(".tar.gz", ".filelist.csv")
        with (_open_target(f"{base}/{list_path}") as lines, _open_target(f"{base}/{path}") as out,
              tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as tar):
            lines.write(b"File,Accession ID,PMID,Last Updated,Retracted")
            while batch is not None:
                _add_members(tar, batch)
                rows = batch.select(["pmcid", "updated", "retracted"]).to_pylist()
                lines.write("".join(
                    f"\n{path},{r['pmcid']},,{r['updated'] or ''},{r['retracted'] or ''}" for r in rows).encode())
                yield _packed(path, batch)
                batch = next(batches, None)

    pack = package if file_lists else archives
    written = members.select(*columns).mapInArrow(pack, "file_path string, pmcid string")
    path = scratch_path(members.sparkSession, "written")
    written.write.parquet(path)
    return members.sparkSession.read.parquet(path)


def _jats(id_column, title, text):
    return F.concat(
        F.lit('<article><front><article-meta><article-id pub-id-type="pmc">'), id_column,
        F.lit("</article-id><title-group><article-title>"), title,
        F.lit("</article-title></title-group></article-meta></front><body><p>"), escape_xml(text),
        F.lit("</p></body></article>"),
    )


def _write_list(lines, path: str) -> None:
    lines.select(
        F.col("file_path").alias("File"), F.col("pmcid").alias("Accession ID"), F.lit(None).cast("string").alias("PMID"),
        time_text(F.col("last_updated")).alias("Last Updated"), F.col("retracted").alias("Retracted"),
    ).write.option("header", True).csv(path)


def _loaded_corpus(spark, sf_dir):
    """A full load of all documents; retracted where the label is toxic."""
    base, root = scratch_path(spark, "site"), scratch_path(spark, "corpus")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", pmcid("doc_id").alias("pmcid"), "n_chars",
        _jats(pmcid("doc_id"), F.col("source"), F.col("text")).alias("xml"),
    )
    spread = documents.repartition(spark_tasks(spark), "doc_id")
    written = write_archives(spread, base, lambda task, batch: f"oa/{task:05d}-{batch:05d}.tar.gz")
    labels = table(spark, sf_dir, "labels").select(
        pmcid("doc_id").alias("pmcid"), F.when(F.col("toxic") == 1, "true").alias("retracted")
    )
    lines = written.join(documents.select("pmcid", "n_chars"), "pmcid").join(labels, "pmcid", "left").withColumn(
        "last_updated", clock(F.col("n_chars"))
    )
    _write_list(lines, f"{base}/list")
    corpus.initialize(spark, root)
    full_load(spark, root, f"{base}/list", base, run_ts=FULL_TS)
    return root


def archive_members(spark, sf_dir):
    """Every document packed into an archive and unpacked again."""
    base = scratch_path(spark, "site")
    documents = table(spark, sf_dir, "documents").repartition(spark_tasks(spark), "doc_id").select(
        pmcid("doc_id").alias("pmcid"), _jats(pmcid("doc_id"), F.col("source"), F.col("text")).alias("xml")
    )
    written = write_archives(documents, base, lambda task, batch: f"{task}/{batch}.tar.gz")
    archives = articles_per_archive(written).select(
        F.col("file_path").alias("archive_path"), resolve(F.col("file_path"), base).alias("location")
    )
    members = expand_archives(archives, tasks=spark_tasks(spark)).where("member_name IS NOT NULL")
    return members.select(
        "member_name", F.md5("xml").alias("xml_md5"), F.length("xml").cast("bigint").alias("n_chars")
    )


ARCHIVE_MEMBERS = """
WITH x AS (
    SELECT 'PMC' || doc_id AS id, '<article><front><article-meta><article-id pub-id-type="pmc">PMC' || doc_id ||
           '</article-id><title-group><article-title>' || source ||
           '</article-title></title-group></article-meta></front><body><p>' ||
           replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p></body></article>' AS xml
    FROM documents),
n AS (SELECT id, replace(replace(xml, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS xml FROM x)
SELECT id || '.xml' AS member_name, md5(xml) AS xml_md5, CAST(length(xml) AS BIGINT) AS n_chars FROM n"""


def bundled_articles(spark, sf_dir):
    """Documents as the articles of few members, each of which is read article by article."""
    base = scratch_path(spark, "site")
    articles = table(spark, sf_dir, "documents").select(
        F.col("source").alias("name"), _jats(pmcid("doc_id"), F.col("source"), F.col("text")).alias("xml"))
    bundles = articles.repartition(spark_tasks(spark), F.xxhash64("xml"))

    def bundle(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            whole = "".join(["<articles>", *batch.column("xml").to_pylist(), "</articles>"])
            # an archive can hold several of a task's bundles
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"bundle{task}-{number}"]), pa.array([whole])], names=["pmcid", "xml"])

    members = bundles.mapInArrow(bundle, "pmcid string, xml string")
    written = write_archives(members, base, lambda task, batch: f"{task}-{batch}.tar.gz")
    archives = articles_per_archive(written).select(
        F.col("file_path").alias("archive_path"), resolve(F.col("file_path"), base).alias("location"))
    found = extract_articles(expand_archives(archives, tasks=spark_tasks(spark), member_bytes=1 << 16))
    rows = materialize(
        spark, good_articles(found).select(*ROW, "pmcid", "title", F.md5("raw_jats_xml").alias("xml_md5")), "bundled")
    last = rows.groupBy(ROW[:2]).agg(F.max("article_pos").alias("last"), F.count("*").alias("n"))
    return rows.join(last, ROW[:2]).select(
        "pmcid", "title", "xml_md5", (F.col("n") == F.col("last") + 1).alias("numbered"))


BUNDLED_ARTICLES = ARCHIVE_MEMBERS.split("SELECT id || '.xml'")[0].replace(
    "AS xml\n    FROM", "AS xml, source\n    FROM").replace("SELECT id, replace", "SELECT id, source, replace") + (
    "SELECT id AS pmcid, source AS title, md5(xml) AS xml_md5, true AS numbered FROM n")


def _state(spark, root):
    metadata, content = corpus.read_metadata(spark, root), corpus.read_content(spark, root)
    return metadata.select(
        "pmcid", "title", "is_retracted", seconds("source_last_updated").alias("updated")
    ).join(content.select("pmcid", F.md5("body_text").alias("body_md5")), "pmcid", "full")


def full_load_state(spark, sf_dir):
    return _state(spark, _loaded_corpus(spark, sf_dir))


_BODY = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"

FULL_LOAD_STATE = f"""
SELECT 'PMC' || d.doc_id AS pmcid, source AS title, coalesce(toxic = 1, false) AS is_retracted,
       n_chars AS updated, md5({_BODY.format('text')}) AS body_md5
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def full_load_metrics(spark, sf_dir):
    runs = corpus.read_history(spark, _loaded_corpus(spark, sf_dir))
    return runs.select(
        "run_id", "run_type", "status", F.col("metrics")["total_records_loaded"].alias("loaded"),
        F.col("metrics")["archives_failed"].alias("failed"), F.col("metrics")["rejects"].alias("rejects"),
    )


FULL_LOAD_METRICS = """
SELECT CAST(1 AS BIGINT) AS run_id, 'FULL' AS run_type, 'SUCCESS' AS status, count(*) AS loaded,
       CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS rejects FROM documents"""


def _write_packages(spark, sf_dir, drop: str) -> None:
    """Dated packages: new versions of the labelled documents, on the 8th or the 9th
    by quality, and all web pages as new articles on the 10th."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    seconds_after = F.when(F.col("lang") == "en", F.col("n_chars") * 2).otherwise(F.col("n_chars") - 1)
    updates = labelled.select(
        pmcid("doc_id").alias("pmcid"), "quality", time_text(clock(seconds_after)).alias("updated"),
        F.when(F.col("toxic") == 1, "Yes").alias("retracted"),
        _jats(pmcid("doc_id"), F.lit("version 2"), F.concat("lang", F.lit(" "), "text")).alias("xml"),
    )
    none = F.lit(None).cast("string")
    pages = table(spark, sf_dir, "pages").select(
        pmcid("page_id", "PAGE").alias("pmcid"), none.alias("updated"), none.alias("retracted"),
        _jats(pmcid("page_id", "PAGE"), F.lit("page"), F.col("html")).alias("xml"),
    )
    def write(area, day, rows):
        write_archives(
            rows.repartition(max(2, spark_tasks(spark) // 4), "pmcid"), f"{drop}/oa_bulk/{area}/xml",
            lambda task, batch: f"{area}_xml.{task}-{batch}.incr.{day}.tar.gz", file_lists=True,
        )

    # at once: the packages of one area are fewer than the cores
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(
            inheritable_thread_target(spark)(write), ("oa_comm", "oa_noncomm", "oa_other"),
            ("2024-01-08", "2024-01-09", "2024-01-10"),
            (updates.where("quality = 0"), updates.where("quality = 1"), pages)))


def delta_load_state(spark, sf_dir):
    root, drop = _loaded_corpus(spark, sf_dir), scratch_path(spark, "drop")
    _write_packages(spark, sf_dir, drop)
    delta_load(spark, root, drop, run_ts=DELTA_TS)
    return _state(spark, root)


_V2 = "(l.doc_id IS NOT NULL AND toxic = 0)"

DELTA_LOAD_STATE = f"""
SELECT 'PMC' || d.doc_id AS pmcid,
       CASE WHEN {_V2} AND lang = 'en' THEN 'version 2' ELSE source END AS title,
       coalesce(toxic = 1, false) AS is_retracted,
       CASE WHEN {_V2} AND lang = 'en' THEN n_chars * 2 ELSE n_chars END AS updated,
       md5({_BODY.format(f"CASE WHEN {_V2} THEN lang || ' ' || text ELSE text END")}) AS body_md5
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
UNION ALL
SELECT 'PAGE' || page_id, 'page', false, NULL, md5({_BODY.format('html')}) FROM pages"""


def delta_load_damaged(spark, sf_dir):
    """Packages of the labelled documents; those of quality 0 are emptied or spoilt after
    they were written. Their lists retract all the same, and nothing of them is loaded."""
    root, drop = _loaded_corpus(spark, sf_dir), scratch_path(spark, "drop")
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    seconds_after = F.when(F.col("lang") == "en", F.col("n_chars") * 2).otherwise(F.col("n_chars") - 1)
    updates = labelled.select(
        pmcid("doc_id").alias("pmcid"), "quality", time_text(clock(seconds_after)).alias("updated"),
        F.when(F.col("n_chars") % 3 == 0, "true").alias("retracted"),
        _jats(pmcid("doc_id"), F.lit("version 2"), F.concat("lang", F.lit(" "), "text")).alias("xml"),
    )
    for quality, day in ((0, "2024-01-08"), (1, "2024-01-09")):
        base = f"{drop}/oa_bulk/oa_comm/xml"
        written = write_archives(
            updates.where(F.col("quality") == quality).repartition(spark_tasks(spark), "pmcid"), base,
            lambda task, batch, day=day: f"oa_comm_xml.{task}-{batch}.incr.{day}.tar.gz", file_lists=True,
        )
        if quality == 0:
            for i, row in enumerate(written.select("file_path").distinct().orderBy("file_path").collect()):
                _store_file(f"{base}/{row.file_path}", b"" if i % 2 == 0 else b"spoilt")
    delta_load(spark, root, drop, run_ts=DELTA_TS)
    return _state(spark, root)


_LISTED, _LOADED = "(l.doc_id IS NOT NULL AND n_chars % 3 = 0)", "(quality = 1 AND n_chars % 3 <> 0)"

DELTA_LOAD_DAMAGED = f"""
SELECT 'PMC' || d.doc_id AS pmcid,
       CASE WHEN {_LOADED} AND lang = 'en' THEN 'version 2' ELSE source END AS title,
       CASE WHEN {_LISTED} THEN true WHEN {_LOADED} AND lang = 'en' THEN false ELSE coalesce(toxic = 1, false) END AS is_retracted,
       CASE WHEN {_LOADED} AND lang = 'en' THEN n_chars * 2 ELSE n_chars END AS updated,
       md5({_BODY.format(f"CASE WHEN {_LOADED} THEN lang || ' ' || text ELSE text END")}) AS body_md5
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def package_feed_state(spark, sf_dir):
    """All packages by the feed. One archive is spoilt between good ones: the feed goes on, and the
    next start loads it, after it was replaced."""
    root, drop, checkpoint = _loaded_corpus(spark, sf_dir), scratch_path(spark, "drop"), scratch_path(spark, "feed")
    _write_packages(spark, sf_dir, drop)
    names = [row.location for row in find_packages(list_archives(spark, drop)).collect()]
    spoilt = names[len(names) // 2]
    aside = f"{scratch_path(spark, 'aside')}/package.tar.gz"
    _copy_file(spoilt, aside)
    _store_file(spoilt, b"spoilt")
    package_feed(spark, root, drop, checkpoint, packages_per_batch=3).awaitTermination()
    failed = [(row.archive_path, row.attempts, row.reason) for row in corpus.failed_packages(spark, root).collect()]
    if [(spoilt.endswith(name), attempts, reason) for name, attempts, reason in failed] != [(True, 1, "unreadable")]:
        raise RuntimeError(f"The feed set aside {failed}, not {spoilt}")
    _copy_file(aside, spoilt)
    package_feed(spark, root, drop, checkpoint, packages_per_batch=3).awaitTermination()
    return _state(spark, root)


# The feed replaces a text only together with its metadata.
PACKAGE_FEED_STATE = DELTA_LOAD_STATE.replace(
    f"CASE WHEN {_V2} THEN lang", f"CASE WHEN {_V2} AND lang = 'en' THEN lang"
)


def corpus_changes_state(spark, sf_dir):
    """Documents replace the corpus, come again under the doubled id as an upsert, web
    pages are appended, and toxic ids retracted: four commits."""
    root = scratch_path(spark, "corpus")
    corpus.initialize(spark, root)
    run = corpus.start_run(spark, root, "FULL", FULL_TS)
    documents = table(spark, sf_dir, "documents")

    def pair(rows, number, prefix, title, clock_, text):
        rows = rows.select(
            pmcid(number, prefix).alias("pmcid"), title.alias("title"), clock_.alias("source_last_updated"),
            F.lit(False).alias("is_retracted"), F.lit(FULL_TS).alias("sync_timestamp"), F.lit(None).cast("string").alias("doi"),
            text.alias("body_text"),
        )
        return rows.drop("body_text"), rows.select("pmcid", "body_text")

    time = clock(F.col("n_chars"))
    none = F.lit(None).cast("timestamp")
    replace_articles(spark, root, run, *pair(
        documents, F.col("doc_id"), "PMC", F.col("lang"), F.when(F.col("lang") != "de", time), F.col("text")
    ))
    upsert_articles(spark, root, run, *pair(
        documents, F.col("doc_id") * 2, "PMC", F.col("source"), F.when(F.col("lang") != "es", time),
        F.concat("lang", F.lit(": "), "text"),
    ), last_file="update")
    append_articles(spark, root, run, *pair(
        table(spark, sf_dir, "pages"), F.col("page_id"), "PAGE", F.lit("page"), none, F.col("html")
    ))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(pmcid("doc_id").alias("pmcid"))
    commit_retractions(spark, root, run, toxic, DELTA_TS)
    return _state(spark, root)


CORPUS_CHANGES_STATE = """
WITH t AS (SELECT 'PMC' || doc_id AS pmcid, lang AS title, CASE WHEN lang <> 'de' THEN n_chars END AS updated, text FROM documents),
s AS (SELECT 'PMC' || (doc_id * 2) AS pmcid, source AS title, CASE WHEN lang <> 'es' THEN n_chars END AS updated,
             lang || ': ' || text AS text FROM documents),
j AS (
    SELECT coalesce(t.pmcid, s.pmcid) AS pmcid, t.title AS t_title, s.title AS s_title, t.updated AS t_upd, s.updated AS s_upd,
           md5(coalesce(s.text, t.text)) AS body_md5,
           t.pmcid IS NULL OR (s.pmcid IS NOT NULL AND
               (t.updated IS NULL OR coalesce(t.updated < s.updated, false))) AS take
    FROM t FULL OUTER JOIN s ON t.pmcid = s.pmcid)
SELECT pmcid, CASE WHEN take THEN s_title ELSE t_title END AS title,
       pmcid IN (SELECT 'PMC' || doc_id FROM labels WHERE toxic = 1) AS is_retracted,
       CASE WHEN take THEN s_upd ELSE t_upd END AS updated, body_md5
FROM j
UNION ALL
SELECT 'PAGE' || page_id, 'page', false, NULL, md5(html) FROM pages"""


def replace_existing(spark, sf_dir):
    """A corpus of documents is replaced as a whole by web pages; their time of change is the run's."""
    root = scratch_path(spark, "corpus")
    corpus.initialize(spark, root)
    for name, number, text, title, ts in (
        ("documents", "doc_id", "text", "lang", FULL_TS), ("pages", "page_id", "html", "url", DELTA_TS),
    ):
        rows = table(spark, sf_dir, name).select(
            pmcid(number).alias("pmcid"), F.col(title).alias("title"), F.lit(None).cast("timestamp").alias("source_last_updated"),
            F.lit(False).alias("is_retracted"), F.lit(ts).alias("sync_timestamp"), F.lit(None).cast("string").alias("doi"),
            F.col(text).alias("body_text"),
        )
        run = corpus.start_run(spark, root, "FULL", ts)
        replace_articles(spark, root, run, rows.drop("body_text"), rows.select("pmcid", "body_text"))
        corpus.end_run(spark, root, run, "SUCCESS", ts)
    synced = corpus.read_metadata(spark, root).select("pmcid", seconds("sync_timestamp").alias("synced"))
    return _state(spark, root).join(synced, "pmcid")


REPLACE_EXISTING = """
SELECT 'PMC' || page_id AS pmcid, url AS title, false AS is_retracted, CAST(NULL AS BIGINT) AS updated,
       md5(html) AS body_md5, CAST(35 * 86400 AS BIGINT) AS synced FROM pages"""


def run_state(spark, sf_dir):
    """A delta load that has to stop: new versions on the 8th, a package of retracted lines alone on
    the 9th, which moves the marker, one with a repeated id on the 10th, and a good one behind it.
    With the corpus come the run's state and the day of its marker."""
    root, drop = _loaded_corpus(spark, sf_dir), scratch_path(spark, "drop")
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        pmcid("doc_id").alias("pmcid"), "quality", time_text(clock(F.col("n_chars") * 2)).alias("updated"),
        F.lit(None).cast("string").alias("retracted"),
        _jats(pmcid("doc_id"), F.lit("version 2"), F.concat("lang", F.lit(" "), "text")).alias("xml"),
    )
    bad, first = labelled.where("quality = 1"), labelled.where("quality = 0")
    for day, rows in (
        ("2024-01-08", first), ("2024-01-09", bad.withColumn("retracted", F.lit("yes"))),
        ("2024-01-10", bad.unionByName(bad)), ("2024-01-11", bad),
    ):
        write_archives(
            rows.repartition(spark_tasks(spark), "pmcid"), f"{drop}/oa_bulk/oa_comm/xml",
            lambda task, batch, day=day: f"oa_comm_xml.{task}-{batch}.incr.{day}.tar.gz", file_lists=True,
        )
    try:
        delta_load(spark, root, drop, run_ts=DELTA_TS)
    except QualityError:
        pass
    run = corpus.read_history(spark, root).orderBy(F.desc("run_id")).first()
    return _state(spark, root).withColumns({
        "status": F.lit(run.status), "marker_day": package_day(F.lit(run.last_file_processed)).cast("string"),
        "upserted": F.lit(run.metrics["total_articles_upserted"]),
    })


RUN_STATE = f"""
SELECT 'PMC' || d.doc_id AS pmcid, CASE WHEN quality = 0 AND n_chars > 0 THEN 'version 2' ELSE source END AS title,
       CASE WHEN quality = 0 AND n_chars > 0 THEN false ELSE coalesce(toxic = 1, false) END AS is_retracted,
       CASE WHEN quality = 0 THEN n_chars * 2 ELSE n_chars END AS updated,
       md5({_BODY.format("CASE WHEN quality = 0 THEN lang || ' ' || text ELSE text END")}) AS body_md5,
       'FAILED' AS status, '2024-01-09' AS marker_day,
       (SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE quality = 0) AS upserted
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def archive_audit(spark, sf_dir):
    """Archives of documents with the digest files next to them: right, wrong, without a digest and absent.

    Every document is given with the verdict on the bytes of its archive."""
    base = scratch_path(spark, "site")
    documents = table(spark, sf_dir, "documents").select(
        pmcid("doc_id").alias("pmcid"), "lang", _jats(pmcid("doc_id"), F.col("source"), F.col("text")).alias("xml"))
    written = None
    for lang in ("en", "fr", "de", "es"):
        part = write_archives(
            documents.where(F.col("lang") == lang).repartition(spark_tasks(spark), "pmcid"), base,
            lambda task, batch, lang=lang: f"{lang}/{task}-{batch}.tar.gz")
        written = part if written is None else written.unionByName(part)
    archives = articles_per_archive(written).select(
        F.col("file_path").alias("archive_path"), resolve(F.col("file_path"), base).alias("location"))
    status = materialize(
        spark, archive_status(expand_archives(archives, tasks=spark_tasks(spark))), "archive-status")
    lang = F.substring_index("archive_path", "/", 1)
    text = F.when(lang == "en", F.concat(F.lit("MD5 (a) = "), "archive_md5")).when(
        lang == "fr", F.concat(F.lit("MD5 (a) = "), F.md5("archive_md5"))).when(lang == "de", F.lit("none"))

    def store(rows):
        for batch in rows:
            for row in batch.to_pylist():
                _store_file(f"{base}/{row['archive_path']}.md5", row["text"].encode())
            yield batch.select(["archive_path"])

    status.select("archive_path", text.alias("text")).where("text IS NOT NULL").mapInArrow(
        store, "archive_path string").write.format("noop").mode("overwrite").save()
    audited = audit_archives(status, read_sidecars(spark, [base], base=base))
    return written.withColumnRenamed("file_path", "archive_path").join(audited, "archive_path").select(
        "pmcid", "status", F.col("archive_error").isNull().alias("readable"))


ARCHIVE_AUDIT = """
SELECT 'PMC' || doc_id AS pmcid, CASE lang WHEN 'en' THEN 'verified' WHEN 'fr' THEN 'mismatch'
       WHEN 'de' THEN 'unparsable' ELSE 'unverified' END AS status, true AS readable
FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')"""


CATALOG = {
    "run_state": (run_state, RUN_STATE),
    "archive_audit": (archive_audit, ARCHIVE_AUDIT),
    "replace_existing": (replace_existing, REPLACE_EXISTING),
    "bundled_articles": (bundled_articles, BUNDLED_ARTICLES),
    "archive_members": (archive_members, ARCHIVE_MEMBERS),
    "corpus_changes_state": (corpus_changes_state, CORPUS_CHANGES_STATE),
    "full_load_state": (full_load_state, FULL_LOAD_STATE),
    "full_load_metrics": (full_load_metrics, FULL_LOAD_METRICS),
    "delta_load_state": (delta_load_state, DELTA_LOAD_STATE),
    "delta_load_damaged": (delta_load_damaged, DELTA_LOAD_DAMAGED),
    "package_feed_state": (package_feed_state, PACKAGE_FEED_STATE),
}
