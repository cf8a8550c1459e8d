"""Manifests, retraction lists, packages, joins with file lists, audits, exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from folio_sync.functions.names import area_rank
from folio_sync.operators import audit, enrich
from folio_sync.plans.staging import materialize
from folio_sync.session import scratch_path
from folio_sync.sources import export, load, manifest, packages
from query_catalog.common import clock, pmcid, table, time_text

# --- manifest ----------------------------------------------------------------

_RETRACTED_WORD = {"src0": "TRUE", "src1": "y", "src2": "Yes", "src3": "no", "src4": "1"}


def _written_manifest(spark, sf_dir):
    """The documents as a manifest file with blank ids, blank and bad times."""
    word = F.lit(None).cast("string")
    for source, text in _RETRACTED_WORD.items():
        word = F.when(F.col("source") == source, F.lit(text)).otherwise(word)
    rows = table(spark, sf_dir, "documents").select(
        F.when(F.col("n_chars") >= 100, F.concat("source", F.lit(".tar.gz"))).alias("File"),
        F.when(F.col("n_chars") < 15000, pmcid("doc_id")).alias(" Accession ID "),
        F.when(F.col("lang") != "fr", F.col("doc_id").cast("string")).alias("PMID"),
        F.when(F.col("lang") == "de", F.concat(F.lit("Jan 1, "), F.col("n_chars")))
        .when(F.col("lang") != "es", time_text(clock(F.col("n_chars")))).alias("Last Updated"),
        word.alias("Retracted"),
    )
    path = scratch_path(spark, "manifest-csv")
    rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return path


def manifest_read(spark, sf_dir):
    good, _ = manifest.read_manifest(spark, _written_manifest(spark, sf_dir))
    return good.select(
        "file_path", "pmcid", "pmid", time_text(F.col("last_updated")).alias("last_updated"), "is_retracted"
    )


_MANIFEST_RAW = """
    SELECT CASE WHEN n_chars >= 100 THEN source || '.tar.gz' END AS file_path,
           CASE WHEN n_chars < 15000 THEN 'PMC' || doc_id END AS pmcid,
           CASE WHEN lang <> 'fr' THEN CAST(doc_id AS VARCHAR) END AS pmid,
           CASE WHEN lang NOT IN ('de', 'es') THEN
               strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n_chars), '%Y-%m-%d %H:%M:%S')
           END AS last_updated,
           source IN ('src0', 'src1', 'src2') AS is_retracted, lang
    FROM documents"""

MANIFEST_READ = f"""
SELECT file_path, pmcid, pmid, last_updated, is_retracted FROM ({_MANIFEST_RAW})
WHERE file_path IS NOT NULL AND pmcid IS NOT NULL AND lang <> 'de'"""


def manifest_rejects(spark, sf_dir):
    _, bad = manifest.read_manifest(spark, _written_manifest(spark, sf_dir))
    return bad.groupBy("reason").agg(F.count("*").alias("n_rows"))


MANIFEST_REJECTS = f"""
SELECT CASE WHEN file_path IS NULL OR pmcid IS NULL THEN 'missing_field' ELSE 'bad_timestamp' END AS reason,
       count(*) AS n_rows
FROM ({_MANIFEST_RAW}) WHERE file_path IS NULL OR pmcid IS NULL OR lang = 'de' GROUP BY 1"""


def manifest_by_archive(spark, sf_dir):
    listed = table(spark, sf_dir, "documents").withColumnRenamed("source", "file_path")
    return manifest.articles_per_archive(listed)


MANIFEST_BY_ARCHIVE = "SELECT source AS file_path, count(*) AS n_articles FROM documents GROUP BY 1"


def retractions_read(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    ids = labels.where("toxic = 1").unionByName(labels.where("quality = 0")).select(
        pmcid("doc_id").alias("PMCID")
    )
    path = scratch_path(spark, "retractions-csv")
    ids.write.option("header", True).csv(path)
    return manifest.read_retractions(spark, path)


RETRACTIONS_READ = "SELECT DISTINCT 'PMC' || doc_id AS pmcid FROM labels WHERE toxic = 1 OR quality = 0"

# --- packages ----------------------------------------------------------------


def _listing(spark, sf_dir):
    """One file per event: dated packages in three areas, and files that are none."""
    area = F.when(F.col("event_type") == "click", "oa_comm").when(
        F.col("event_type") == "view", "oa_noncomm"
    ).when(F.col("event_type") == "purchase", "oa_other")
    name = F.concat(
        area, F.lit("_xml.incr."), F.date_format("ts", "yyyy-MM-dd"), F.lit(".tar.gz")
    )
    other = F.concat(F.lit("oa_comm_xml.PMC00"), F.col("user_id"), F.lit("xxxxxx.baseline.tar.gz"))
    paths = table(spark, sf_dir, "events").select(
        F.concat(
            F.lit("s3://drop/oa_bulk/"), F.coalesce(area, F.lit("oa_comm")), F.lit("/xml/"),
            F.coalesce(name, other),
        ).alias("path")
    )
    return materialize(spark, paths.distinct(), "listing")


def _shown(found):
    return found.select(
        "archive_path", "file_list_path", F.date_format("date", "yyyy-MM-dd").alias("day"),
        area_rank(F.col("archive_path")).alias("area_rank"),
    )


_PACKAGES = """
    SELECT DISTINCT 'oa_bulk/' || area || '/xml/' || area || '_xml.incr.' || day || '.tar.gz' AS archive_path,
           's3://drop/oa_bulk/' || area || '/xml/' || area || '_xml.incr.' || day || '.filelist.csv' AS file_list_path,
           day, CASE area WHEN 'oa_comm' THEN 0 WHEN 'oa_noncomm' THEN 1 ELSE 2 END AS area_rank
    FROM (SELECT CASE event_type WHEN 'click' THEN 'oa_comm' WHEN 'view' THEN 'oa_noncomm'
                      WHEN 'purchase' THEN 'oa_other' END AS area,
                 strftime(ts, '%Y-%m-%d') AS day FROM events)
    WHERE area IS NOT NULL"""


def package_window(spark, sf_dir):
    return _shown(packages.find_packages(_listing(spark, sf_dir), dt.datetime(2024, 1, 10, 23, 5)))


PACKAGE_WINDOW = f"SELECT * FROM ({_PACKAGES}) WHERE day > '2024-01-10'"

_MARKER = "oa_bulk/oa_noncomm/xml/oa_noncomm_xml.incr.2024-01-15.tar.gz"


def package_resume(spark, sf_dir):
    return _shown(packages.find_packages(
        _listing(spark, sf_dir), dt.date(2024, 1, 10), marker=_MARKER
    ))


PACKAGE_RESUME = f"""
SELECT * FROM ({_PACKAGES}) WHERE day > '2024-01-15' OR (day = '2024-01-15' AND area_rank > 1)"""


def package_resume_absent(spark, sf_dir):
    return _shown(packages.find_packages(
        _listing(spark, sf_dir), dt.date(2024, 1, 20), marker=_MARKER, inclusive=True
    ))


PACKAGE_RESUME_ABSENT = f"SELECT * FROM ({_PACKAGES}) WHERE day >= '2024-01-20'"

# --- joins with file lists ---------------------------------------------------


def _articles(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("archive_path"), pmcid("doc_id").alias("pmcid"), F.col("lang").alias("title")
    )


def _listed(spark, sf_dir):
    """A list line per label; good-quality articles are listed again further down."""
    labels = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    lines = labels.select(
        F.col("source").alias("archive_path"), pmcid("doc_id").alias("pmcid"), "quality",
        clock(F.col("n_chars")).alias("last_updated"), (F.col("toxic") == 1).alias("is_retracted"),
        F.struct(F.lit(1).alias("block"), F.col("doc_id").alias("line")).alias("line_order"),
    )
    again = lines.where("quality = 1").withColumns({
        "last_updated": F.col("last_updated") + F.expr("INTERVAL 1 DAY"),
        "line_order": F.struct(F.lit(2).alias("block"), F.col("line_order.line").alias("line")),
    })
    return lines.unionByName(again)


def manifest_enrich(spark, sf_dir):
    listed, _ = enrich.enrich(_articles(spark, sf_dir), _listed(spark, sf_dir))
    return listed.select(
        "archive_path", "pmcid", "title", "is_retracted",
        time_text(F.col("source_last_updated")).alias("updated"),
    )


MANIFEST_ENRICH = """
SELECT source AS archive_path, 'PMC' || d.doc_id AS pmcid, lang AS title, toxic = 1 AS is_retracted,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n_chars + 86400 * quality),
                '%Y-%m-%d %H:%M:%S') AS updated
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def unlisted_articles(spark, sf_dir):
    _, unlisted = enrich.enrich(_articles(spark, sf_dir), _listed(spark, sf_dir))
    return unlisted.select("archive_path", "pmcid", "title")


UNLISTED_ARTICLES = """
SELECT source AS archive_path, 'PMC' || doc_id AS pmcid, lang AS title FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

_FAILED_ABOVE = 16000


def archive_outcome(spark, sf_dir):
    """Archives holding an oversized document count as failed, with all their articles."""
    failed = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("archive_path")).agg(
        F.max("n_chars").alias("longest")
    ).where(F.col("longest") > _FAILED_ABOVE)
    good, bad = enrich.articles_of_failed(_articles(spark, sf_dir), failed)
    return good.withColumn("outcome", F.lit("loaded")).unionByName(
        bad.withColumn("outcome", F.lit("failed"))
    )


ARCHIVE_OUTCOME = f"""
SELECT source AS archive_path, 'PMC' || doc_id AS pmcid, lang AS title,
       CASE WHEN source IN (SELECT source FROM documents GROUP BY source HAVING max(n_chars) > {_FAILED_ABOVE})
            THEN 'failed' ELSE 'loaded' END AS outcome
FROM documents"""

# --- integrity ---------------------------------------------------------------


def _digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        pmcid("doc_id").alias("archive_path"), F.md5("text").alias("archive_md5"), "lang"
    )


def checksum_audit(spark, sf_dir):
    digests = _digests(spark, sf_dir)
    published = digests.where("lang <> 'es'").select(
        "archive_path",
        F.when(F.col("lang") == "en", F.concat(F.lit("MD5 (a.tar.gz) = "), "archive_md5"))
        .when(F.col("lang") == "fr", F.concat(F.lit("MD5 =  "), F.md5("archive_md5")))
        .otherwise(F.concat(F.lit("no digest: "), "archive_md5")).alias("sidecar_text"),
    )
    return audit.audit_archives(digests.drop("lang"), published)


CHECKSUM_AUDIT = """
SELECT 'PMC' || doc_id AS archive_path, md5(text) AS archive_md5,
       CASE lang WHEN 'en' THEN 'verified' WHEN 'fr' THEN 'mismatch' WHEN 'es' THEN 'unverified'
                 ELSE 'unparsable' END AS status
FROM documents"""


def etag_audit(spark, sf_dir):
    digests = _digests(spark, sf_dir)
    published = digests.where("lang <> 'es'").select(
        "archive_path",
        F.when(F.col("lang") == "en", F.concat(F.lit('"'), "archive_md5", F.lit('"')))
        .when(F.col("lang") == "fr", F.concat(F.lit('"'), "archive_md5", F.lit('-7"')))
        .otherwise(F.md5("archive_md5")).alias("etag"),
    )
    return audit.audit_archives(digests.drop("lang"), published)


ETAG_AUDIT = """
SELECT 'PMC' || doc_id AS archive_path, md5(text) AS archive_md5,
       CASE lang WHEN 'en' THEN 'verified' WHEN 'de' THEN 'mismatch' ELSE 'unverified' END AS status
FROM documents"""

# --- sinks -------------------------------------------------------------------


def staging_union(spark, sf_dir):
    batches = [
        table(spark, sf_dir, name).select(
            F.lit(name).alias("batch"), F.col(key).cast("string").alias("pmcid"), F.col(text).alias("body_text")
        )
        for name, key, text in (
            ("documents", "doc_id", "text"), ("pages", "page_id", "html"),
            ("conversations", "conv_id", "text"), ("benchmark", "item_id", "text"),
        )
    ]
    return load.staging_union(batches).groupBy("batch").agg(
        F.count("*").alias("n_rows"), F.countDistinct("pmcid").alias("n_keys"),
        F.sum(F.length("body_text")).cast("bigint").alias("n_chars"),
    )


STAGING_UNION = """
SELECT batch, count(*) AS n_rows, count(DISTINCT k) AS n_keys, CAST(sum(length(t)) AS BIGINT) AS n_chars
FROM (SELECT 'documents' AS batch, doc_id AS k, text AS t FROM documents
      UNION ALL SELECT 'pages', page_id, html FROM pages
      UNION ALL SELECT 'conversations', conv_id, text FROM conversations
      UNION ALL SELECT 'benchmark', item_id, text FROM benchmark) GROUP BY 1"""


def staged_batches(spark, sf_dir):
    """Documents staged as one batch per language, read together with a batch that is absent."""
    base = scratch_path(spark, "batches")
    rows = table(spark, sf_dir, "documents").select(
        pmcid("doc_id").alias("pmcid"), F.col("lang").alias("title"), F.col("text").alias("body_text"))
    paths = [f"{base}/{lang}" for lang in ("en", "de", "fr", "es", "absent")]
    for path in paths[:-1]:
        rows.where(F.col("title") == path.rsplit("/", 1)[1]).write.parquet(path)
    read = load.read_batches(spark, paths, rows.schema)
    return read.select("pmcid", "title", F.md5("body_text").alias("body_md5"))


STAGED_BATCHES = """
SELECT 'PMC' || doc_id AS pmcid, lang AS title, md5(text) AS body_md5
FROM documents WHERE lang IN ('en', 'de', 'fr', 'es')"""


def append_rows(spark, sf_dir):
    """Suppliers appended to a written customer table, under one key."""
    path = scratch_path(spark, "append")
    table(spark, sf_dir, "customer").select(
        pmcid("c_custkey", "C").alias("pmcid"), F.col("c_name").alias("title")
    ).write.parquet(path)
    target = spark.read.parquet(path)
    suppliers = table(spark, sf_dir, "supplier").select(
        pmcid("s_suppkey", "S").alias("pmcid"), F.col("s_name").alias("title")
    )
    load.append_rows(suppliers, target, path, key="pmcid")
    return spark.read.parquet(path)


APPEND_ROWS = """
SELECT 'C' || c_custkey AS pmcid, c_name AS title FROM customer
UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier"""


def export_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        pmcid("doc_id").alias("pmcid"), "n_chars",
        F.when(F.col("lang") != "es", F.col("text")).alias("body_text"),
        F.struct(F.col("source").alias("name"), F.lit(None).cast("string").alias("issn")).alias("journal_info"),
        (F.col("lang") == "de").alias("is_retracted"),
        F.when(F.col("lang") != "fr", clock(F.col("n_chars"))).alias("sync_timestamp"),
    )
    return export.delimited_lines(rows)


EXPORT_ROWS = r"""
SELECT 'PMC' || doc_id || chr(9) || n_chars || chr(9) ||
       coalesce(CASE WHEN lang <> 'es' THEN
           replace(replace(replace(text, '\', '\\'), chr(9), '\t'), chr(10), '\n') END, '\N') || chr(9) ||
       '{"name":"' || source || '","issn":null}' || chr(9) ||
       CASE WHEN lang = 'de' THEN 'True' ELSE 'False' END || chr(9) ||
       coalesce(CASE WHEN lang <> 'fr' THEN
           strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n_chars), '%Y-%m-%d %H:%M:%S') || '+00:00' END,
           '\N') AS value
FROM documents"""


def delimited_round_trip(spark, sf_dir):
    """Documents written as delimited text and read back."""
    rows = table(spark, sf_dir, "documents").select(
        pmcid("doc_id").alias("pmcid"), "n_chars", F.when(F.col("lang") != "es", F.col("text")).alias("body_text"),
        F.struct("source", F.concat("lang", F.lit('\\t"')).alias("note")).alias("journal_info"),
        (F.col("lang") == "de").alias("is_retracted"),
    )
    path = scratch_path(spark, "delimited")
    export.write_delimited(rows, path)
    back = export.read_delimited(spark, path, rows.schema)
    return back.select("pmcid", "n_chars", F.md5("body_text").alias("body_md5"), "journal_info.*", "is_retracted")


DELIMITED_ROUND_TRIP = r"""
SELECT 'PMC' || doc_id AS pmcid, n_chars, md5(CASE WHEN lang <> 'es' THEN text END) AS body_md5, source,
       lang || '\t"' AS note, lang = 'de' AS is_retracted FROM documents"""


CATALOG = {
    "manifest_read": (manifest_read, MANIFEST_READ),
    "manifest_rejects": (manifest_rejects, MANIFEST_REJECTS),
    "manifest_by_archive": (manifest_by_archive, MANIFEST_BY_ARCHIVE),
    "retractions_read": (retractions_read, RETRACTIONS_READ),
    "package_window": (package_window, PACKAGE_WINDOW),
    "package_resume": (package_resume, PACKAGE_RESUME),
    "package_resume_absent": (package_resume_absent, PACKAGE_RESUME_ABSENT),
    "manifest_enrich": (manifest_enrich, MANIFEST_ENRICH),
    "unlisted_articles": (unlisted_articles, UNLISTED_ARTICLES),
    "archive_outcome": (archive_outcome, ARCHIVE_OUTCOME),
    "checksum_audit": (checksum_audit, CHECKSUM_AUDIT),
    "etag_audit": (etag_audit, ETAG_AUDIT),
    "staging_union": (staging_union, STAGING_UNION),
    "staged_batches": (staged_batches, STAGED_BATCHES),
    "append_rows": (append_rows, APPEND_ROWS),
    "export_rows": (export_rows, EXPORT_ROWS),
    "delimited_round_trip": (delimited_round_trip, DELIMITED_ROUND_TRIP),
}
