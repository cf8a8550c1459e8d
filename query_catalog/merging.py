"""Upserts, retractions and deletions."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio_sync.operators import merge, retract
from query_catalog.common import AS_METADATA, as_metadata, clock, pmcid, seconds, table


def _staged_metadata(documents):
    """Every document again under the doubled id: half update a row, half are new."""
    return documents.select(
        pmcid(F.col("doc_id") * 2).alias("pmcid"),
        F.col("source").alias("title"),
        F.when(F.col("lang") != "es", clock(F.col("n_chars"))).alias("source_last_updated"),
        F.lit(False).alias("is_retracted"),
    )


def upsert_metadata(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    merged = merge.upsert_metadata(as_metadata(documents), _staged_metadata(documents))
    return merged.select("pmcid", "title", seconds("source_last_updated").alias("updated"), "is_retracted")


UPSERT_METADATA = f"""
WITH t AS ({AS_METADATA}),
s AS (
    SELECT 'PMC' || (doc_id * 2) AS pmcid, source AS title,
           CASE WHEN lang <> 'es' THEN n_chars END AS updated, false AS is_retracted
    FROM documents),
j AS (
    SELECT t.pmcid AS t_id, s.pmcid AS s_id, t.title AS t_title, s.title AS s_title,
           t.updated AS t_upd, s.updated AS s_upd, t.is_retracted AS t_ret, s.is_retracted AS s_ret,
           t.pmcid IS NULL OR (s.pmcid IS NOT NULL AND
               (t.updated IS NULL OR coalesce(t.updated < s.updated, false))) AS take
    FROM t FULL OUTER JOIN s ON t.pmcid = s.pmcid)
SELECT coalesce(t_id, s_id) AS pmcid,
       CASE WHEN take THEN s_title ELSE t_title END AS title,
       CASE WHEN take THEN s_upd ELSE t_upd END AS updated,
       CASE WHEN take THEN s_ret ELSE t_ret END AS is_retracted
FROM j"""


def upsert_content(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    target = documents.select(pmcid("doc_id").alias("pmcid"), F.col("text").alias("body_text"))
    staged = documents.select(
        pmcid(F.col("doc_id") * 2).alias("pmcid"),
        F.concat("lang", F.lit(": "), "text").alias("body_text"),
    )
    return merge.upsert_content(target, staged).select(
        "pmcid", F.md5("body_text").alias("body_md5"), F.length("body_text").cast("bigint").alias("n_chars")
    )


UPSERT_CONTENT = """
WITH s AS (SELECT 'PMC' || (doc_id * 2) AS pmcid, lang || ': ' || text AS body_text FROM documents),
u AS (
    SELECT pmcid, body_text FROM s
    UNION ALL
    SELECT 'PMC' || doc_id, text FROM documents WHERE 'PMC' || doc_id NOT IN (SELECT pmcid FROM s))
SELECT pmcid, md5(body_text) AS body_md5, CAST(length(body_text) AS BIGINT) AS n_chars FROM u"""


def _event_packages(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        pmcid("user_id", "U").alias("pmcid"),
        F.col("event_type").alias("title"),
        F.when(
            F.col("event_type") != "error",
            F.date_trunc("hour", F.col("ts").cast("timestamp")),
        ).alias("source_last_updated"),
        F.col("event_id").alias("package_order"),
    )


def upsert_multi_package(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(
        pmcid("c_custkey", "U").alias("pmcid"),
        F.col("c_mktsegment").alias("title"),
        F.when(
            F.col("c_acctbal") >= 0, clock(F.lit(27 * 86400) + F.col("c_nationkey") * 9000)
        ).alias("source_last_updated"),
    )
    staged = merge.fold_packages(_event_packages(spark, sf_dir))
    merged = merge.upsert_metadata(target, staged)
    return merged.select("pmcid", "title", seconds("source_last_updated").alias("updated"))


_EVENT_PACKAGES = """
    SELECT 'U' || user_id AS pmcid, event_type AS title, event_id AS package_order,
           CASE WHEN event_type <> 'error' THEN
               CAST(epoch(date_trunc('hour', ts)) AS BIGINT) - 1704067200 END AS updated
    FROM events"""

UPSERT_MULTI_PACKAGE = f"""
WITH p AS ({_EVENT_PACKAGES}),
s AS (
    SELECT * FROM p
    QUALIFY row_number() OVER (PARTITION BY pmcid ORDER BY updated DESC NULLS LAST,
        CASE WHEN updated IS NULL THEN -package_order ELSE package_order END) = 1),
t AS (
    SELECT 'U' || c_custkey AS pmcid, c_mktsegment AS title,
           CASE WHEN c_acctbal >= 0 THEN 27 * 86400 + CAST(c_nationkey AS BIGINT) * 9000 END AS updated
    FROM customer),
j AS (
    SELECT t.pmcid AS t_id, s.pmcid AS s_id, t.title AS t_title, s.title AS s_title,
           t.updated AS t_upd, s.updated AS s_upd,
           t.pmcid IS NULL OR (s.pmcid IS NOT NULL AND
               (t.updated IS NULL OR coalesce(t.updated < s.updated, false))) AS take
    FROM t FULL OUTER JOIN s ON t.pmcid = s.pmcid)
SELECT coalesce(t_id, s_id) AS pmcid,
       CASE WHEN take THEN s_title ELSE t_title END AS title,
       CASE WHEN take THEN s_upd ELSE t_upd END AS updated
FROM j"""


def fold_content(spark, sf_dir):
    return merge.latest_package(_event_packages(spark, sf_dir)).select(
        "pmcid", "title", "package_order"
    )


FOLD_CONTENT = f"""
SELECT pmcid, title, package_order FROM ({_EVENT_PACKAGES})
QUALIFY row_number() OVER (PARTITION BY pmcid ORDER BY package_order DESC) = 1"""


def superseded_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    old = as_metadata(documents)
    taken = merge.admitted(old, _staged_metadata(documents))
    return merge.superseded_rows(old.select("pmcid", "title"), taken)


SUPERSEDED_ROWS = f"""
WITH t AS ({AS_METADATA})
SELECT t.pmcid, t.title FROM t
JOIN (SELECT 'PMC' || (doc_id * 2) AS pmcid, CASE WHEN lang <> 'es' THEN n_chars END AS updated
      FROM documents) s ON t.pmcid = s.pmcid
WHERE t.updated IS NULL OR t.updated < s.updated"""


def _toxic(spark, sf_dir, factor=1):
    toxic = table(spark, sf_dir, "labels").where(F.col("toxic") == 1)
    return toxic.select(pmcid(F.col("doc_id") * factor).alias("pmcid"))


def retract_apply(spark, sf_dir):
    metadata = as_metadata(table(spark, sf_dir, "documents"))
    return retract.apply_retractions(metadata, _toxic(spark, sf_dir)).select(
        "pmcid", "title", "is_retracted", "changed"
    )


RETRACT_APPLY = f"""
WITH m AS ({AS_METADATA}), ids AS (SELECT DISTINCT 'PMC' || doc_id AS pmcid FROM labels WHERE toxic = 1)
SELECT pmcid, title, is_retracted OR pmcid IN (SELECT pmcid FROM ids) AS is_retracted,
       NOT is_retracted AND pmcid IN (SELECT pmcid FROM ids) AS changed
FROM m"""


def retract_counts(spark, sf_dir):
    metadata = as_metadata(table(spark, sf_dir, "documents"))
    return retract.retraction_counts(metadata, _toxic(spark, sf_dir, 3))


RETRACT_COUNTS = f"""
WITH m AS ({AS_METADATA}), ids AS (SELECT DISTINCT 'PMC' || (doc_id * 3) AS pmcid FROM labels WHERE toxic = 1)
SELECT count(*) AS supplied, count(*) FILTER (WHERE NOT is_retracted) AS changed,
       count(*) FILTER (WHERE m.pmcid IS NULL) AS unknown
FROM ids LEFT JOIN m ON ids.pmcid = m.pmcid"""


def retraction_hits(spark, sf_dir):
    metadata = as_metadata(table(spark, sf_dir, "documents"))
    return retract.retraction_hits(metadata, _toxic(spark, sf_dir)).select("pmcid", "title")


RETRACTION_HITS = f"""
SELECT pmcid, title FROM ({AS_METADATA})
WHERE NOT is_retracted AND pmcid IN (SELECT 'PMC' || doc_id FROM labels WHERE toxic = 1)"""


def cascade_delete(spark, sf_dir):
    deleted = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return retract.cascade_delete(
        table(spark, sf_dir, "lineitem"), deleted, "l_orderkey", "o_orderkey"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


CASCADE_DELETE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""


CATALOG = {
    "upsert_metadata": (upsert_metadata, UPSERT_METADATA),
    "upsert_content": (upsert_content, UPSERT_CONTENT),
    "upsert_multi_package": (upsert_multi_package, UPSERT_MULTI_PACKAGE),
    "fold_content": (fold_content, FOLD_CONTENT),
    "superseded_rows": (superseded_rows, SUPERSEDED_ROWS),
    "retract_apply": (retract_apply, RETRACT_APPLY),
    "retract_counts": (retract_counts, RETRACT_COUNTS),
    "retraction_hits": (retraction_hits, RETRACTION_HITS),
    "cascade_delete": (cascade_delete, CASCADE_DELETE),
}
