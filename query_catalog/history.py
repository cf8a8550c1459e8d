"""Run history, quality checks, lookups and counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from folio_sync.operators import quality, report, runs
from query_catalog.common import clock, pmcid, table

# --- run history -------------------------------------------------------------


def _history(spark, sf_dir, delta_kinds):
    """Every event as a run: errors failed, sign-ups still run."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.when(kind.isin(*delta_kinds), "DELTA").otherwise("FULL").alias("run_type"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "RUNNING").otherwise("SUCCESS").alias("status"),
        F.col("ts").alias("end_time"),
        F.concat(kind, F.lit("-"), F.col("user_id")).alias("last_file_processed"),
        F.from_json("props", "map<string,bigint>").alias("metrics"),
    )


def _run(found):
    return found.select(
        "run_id", "run_type", F.date_format("end_time", "yyyy-MM-dd HH:mm:ss").alias("end_time"),
        "last_file_processed", runs.metric("k").alias("k"),
    )


def _history_sql(delta_kinds):
    kinds = ", ".join(f"'{k}'" for k in delta_kinds)
    return f"""
    SELECT event_id AS run_id, CASE WHEN event_type IN ({kinds}) THEN 'DELTA' ELSE 'FULL' END AS run_type,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS end_time, ts,
           event_type || '-' || user_id AS last_file_processed,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events WHERE event_type NOT IN ('error', 'signup')"""


_DELTA = ("click", "purchase", "error")
_NO_DELTA_DONE = ("error", "signup")


def last_successful_run(spark, sf_dir):
    return _run(runs.last_successful_run(_history(spark, sf_dir, _DELTA), "FULL"))


LAST_SUCCESSFUL_RUN = f"""
SELECT run_id, run_type, end_time, last_file_processed, k FROM ({_history_sql(_DELTA)})
WHERE run_type = 'FULL' ORDER BY ts DESC, run_id DESC LIMIT 1"""


def watermark_choice(spark, sf_dir):
    return _run(runs.watermark(_history(spark, sf_dir, _DELTA)))


WATERMARK_CHOICE = f"""
SELECT run_id, run_type, end_time, last_file_processed, k FROM ({_history_sql(_DELTA)})
WHERE run_type = 'DELTA' ORDER BY ts DESC, run_id DESC LIMIT 1"""


def watermark_from_full(spark, sf_dir):
    return _run(runs.watermark(_history(spark, sf_dir, _NO_DELTA_DONE)))


WATERMARK_FROM_FULL = f"""
SELECT run_id, run_type, end_time, last_file_processed, k FROM ({_history_sql(_NO_DELTA_DONE)})
ORDER BY ts DESC, run_id DESC LIMIT 1"""


def latest_state_per_run(spark, sf_dir):
    """Every user as a run whose row changes with each event."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("event_seq"),
        F.col("event_type").alias("status"),
        F.when(F.col("event_type") == "purchase", F.col("props")).alias("last_file_processed"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("last_error"),
    )
    return runs.fold_history(events)


LATEST_STATE_PER_RUN = """
SELECT user_id AS run_id, arg_max(event_type, event_id) AS status,
       arg_max(props, event_id) FILTER (WHERE event_type = 'purchase') AS last_file_processed,
       max(event_id) FILTER (WHERE event_type = 'error') AS last_error
FROM events GROUP BY 1"""


def run_metrics(spark, sf_dir):
    daily = _history(spark, sf_dir, _DELTA).groupBy(F.date_format("end_time", "yyyy-MM-dd").alias("day"))
    return daily.agg(
        F.count("*").alias("n_runs"),
        F.count_if(F.col("status") == "SUCCESS").alias("n_successful"),
        F.countDistinct("last_file_processed").alias("n_files"),
        F.sum(runs.metric("k")).alias("records"),
    )


RUN_METRICS = """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_runs,
       count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS n_successful,
       count(DISTINCT event_type || '-' || user_id) AS n_files,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS records
FROM events GROUP BY 1"""

# --- quality -----------------------------------------------------------------


def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


DUPLICATE_KEYS = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""


def orphan_content(spark, sf_dir):
    open_orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    return quality.orphans(
        table(spark, sf_dir, "lineitem"), open_orders, "l_orderkey", "o_orderkey"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")
    )


ORPHAN_CONTENT = """
SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')"""


def orphan_labels(spark, sf_dir):
    return quality.orphans(table(spark, sf_dir, "labels"), table(spark, sf_dir, "pages"), "doc_id", "page_id")


ORPHAN_LABELS = "SELECT * FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)"


def required_and_length(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") != "es", pmcid("doc_id")).alias("pmcid"),
        F.when(F.col("source") != "src1", F.col("text")).alias("title"),
        "text",
    )
    return quality.violation_counts(
        documents, ["pmcid", "title", "text"], {"pmcid": 6, "text": 20000, "title": 255}
    )


REQUIRED_AND_LENGTH = """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE lang = 'es') AS pmcid_missing,
       count(*) FILTER (WHERE source = 'src1') AS title_missing,
       count(*) FILTER (WHERE text IS NULL) AS text_missing,
       count(*) FILTER (WHERE lang <> 'es' AND length('PMC' || doc_id) > 6) AS pmcid_too_long,
       count(*) FILTER (WHERE length(text) > 20000) AS text_too_long,
       count(*) FILTER (WHERE source <> 'src1' AND length(text) > 255) AS title_too_long
FROM documents"""

def check_quality(spark, sf_dir):
    """Documents and web pages under overlapping ids, checked against conversations."""
    documents, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    now = F.lit("2024-01-01").cast("timestamp")
    metadata = documents.select(
        F.when(F.col("source") != "src5", pmcid("doc_id")).alias("pmcid"), F.col("text").alias("doi"),
        (F.col("lang") == "de").alias("is_retracted"), F.when(F.col("lang") != "fr", now).alias("sync_timestamp"),
    ).unionByName(pages.select(
        pmcid("page_id").alias("pmcid"), F.col("url").alias("doi"), F.lit(None).cast("boolean").alias("is_retracted"),
        now.alias("sync_timestamp"),
    ))
    content = table(spark, sf_dir, "conversations").select(
        F.concat(pmcid("conv_id"), F.when(F.col("role") == "system", F.lit("-with-a-long-tail")).otherwise("")).alias("pmcid")
    )
    return quality.check_quality(metadata, content)


CHECK_QUALITY = """
WITH m AS (
    SELECT CASE WHEN source <> 'src5' THEN 'PMC' || doc_id END AS pmcid, text AS doi, lang = 'de' AS flag, lang <> 'fr' AS synced
    FROM documents
    UNION ALL SELECT 'PMC' || page_id, url, NULL, true FROM pages),
c AS (SELECT 'PMC' || conv_id || CASE WHEN role = 'system' THEN '-with-a-long-tail' ELSE '' END AS pmcid FROM conversations),
v AS (
    SELECT 'articles_metadata' AS "table", 'pmcid_missing' AS rule, count(*) AS n_rows FROM m WHERE pmcid IS NULL
    UNION ALL SELECT 'articles_metadata', 'is_retracted_missing', count(*) FROM m WHERE flag IS NULL
    UNION ALL SELECT 'articles_metadata', 'sync_timestamp_missing', count(*) FROM m WHERE NOT synced
    UNION ALL SELECT 'articles_metadata', 'pmcid_too_long', count(*) FROM m WHERE length(pmcid) > 20
    UNION ALL SELECT 'articles_metadata', 'doi_too_long', count(*) FROM m WHERE length(doi) > 255
    UNION ALL SELECT 'articles_metadata', 'duplicate_key', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM m GROUP BY pmcid HAVING count(*) > 1)
    UNION ALL SELECT 'articles_content', 'pmcid_missing', count(*) FROM c WHERE pmcid IS NULL
    UNION ALL SELECT 'articles_content', 'pmcid_too_long', count(*) FROM c WHERE length(pmcid) > 20
    UNION ALL SELECT 'articles_content', 'duplicate_key', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM c GROUP BY pmcid HAVING count(*) > 1)
    UNION ALL SELECT 'articles_content', 'orphan', count(*) FROM c WHERE pmcid NOT IN (SELECT pmcid FROM m WHERE pmcid IS NOT NULL))
SELECT * FROM v WHERE n_rows > 0"""

# --- lookups and counts ------------------------------------------------------


def _orders_as_metadata(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pmid"), F.col("o_orderpriority").alias("doi"),
        F.col("o_orderdate").alias("publication_date"), "o_custkey",
    )


def lookup_range(spark, sf_dir):
    found = report.lookup(
        _orders_as_metadata(spark, sf_dir),
        published_from=dt.date(1996, 1, 1), published_until=dt.date(1996, 12, 31),
    )
    return found.withColumn("publication_date", F.date_format("publication_date", "yyyy-MM-dd"))


LOOKUP_RANGE = """
SELECT o_orderkey AS pmid, o_orderpriority AS doi, strftime(o_orderdate, '%Y-%m-%d') AS publication_date, o_custkey
FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate <= DATE '1996-12-31'"""


def lookup_doi(spark, sf_dir):
    return report.lookup(_orders_as_metadata(spark, sf_dir), doi="1-URGENT").select("pmid", "doi", "o_custkey")


LOOKUP_DOI = """
SELECT o_orderkey AS pmid, o_orderpriority AS doi, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"""


def lookup_pmid(spark, sf_dir):
    return report.lookup(_orders_as_metadata(spark, sf_dir), pmid=1234).select("pmid", "doi", "o_custkey")


LOOKUP_PMID = """
SELECT o_orderkey AS pmid, o_orderpriority AS doi, o_custkey FROM orders WHERE o_orderkey = 1234"""


def corpus_report(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    author = F.struct(F.col("lang").alias("name"))
    metadata = documents.join(labels, "doc_id", "left").select(
        F.when(F.col("lang") != "fr", F.col("doc_id")).alias("pmid"),
        F.when(F.col("quality") == 1, F.col("source")).alias("doi"),
        F.when(F.col("lang") != "de", clock(F.col("n_chars"))).alias("source_last_updated"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("is_retracted"),
        F.when(F.col("lang") == "en", F.array(author, author)).otherwise(F.array(author)).alias("contributors"),
    )
    content = table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") != "system", F.col("text")).alias("body_text")
    )
    return report.corpus_report(metadata, content)


CORPUS_REPORT = """
SELECT count(*) AS n_articles, count(*) FILTER (WHERE toxic = 1) AS n_retracted,
       count(*) FILTER (WHERE lang <> 'fr') AS n_with_pmid, count(*) FILTER (WHERE quality = 1) AS n_with_doi,
       count(*) FILTER (WHERE lang <> 'de') AS n_with_source_time,
       CAST(sum(CASE WHEN lang = 'en' THEN 2 ELSE 1 END) AS BIGINT) AS n_contributors,
       (SELECT count(*) FROM conversations) AS n_contents,
       (SELECT count(*) FROM conversations WHERE role <> 'system' AND text IS NOT NULL) AS n_with_body
FROM documents LEFT JOIN labels USING (doc_id)"""


CATALOG = {
    "last_successful_run": (last_successful_run, LAST_SUCCESSFUL_RUN),
    "watermark_choice": (watermark_choice, WATERMARK_CHOICE),
    "watermark_from_full": (watermark_from_full, WATERMARK_FROM_FULL),
    "latest_state_per_run": (latest_state_per_run, LATEST_STATE_PER_RUN),
    "run_metrics": (run_metrics, RUN_METRICS),
    "duplicate_keys": (duplicate_keys, DUPLICATE_KEYS),
    "orphan_content": (orphan_content, ORPHAN_CONTENT),
    "orphan_labels": (orphan_labels, ORPHAN_LABELS),
    "required_and_length": (required_and_length, REQUIRED_AND_LENGTH),
    "check_quality": (check_quality, CHECK_QUALITY),
    "lookup_range": (lookup_range, LOOKUP_RANGE),
    "lookup_doi": (lookup_doi, LOOKUP_DOI),
    "lookup_pmid": (lookup_pmid, LOOKUP_PMID),
    "corpus_report": (corpus_report, CORPUS_REPORT),
}
