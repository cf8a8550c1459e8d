"""One query per operator over its whole table, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio_sync.llm import (
    ann, bpe, decontaminate, exact_dedup, hard_negatives, language_id, license_scan, line_dedup, lm_score, mixing,
    ngram_join, periodic_runs, pii,
)
from folio_sync.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
    WITH plain AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
    FROM plain WINDOW same AS (PARTITION BY body)"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


OP11_SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    wanted AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT n FROM wanted),
    seen AS (
        SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
    found AS (SELECT r, item_id, seen.n, i FROM seen JOIN wanted USING (n, win)),
    hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
              FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    changed = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(changed, F.col("vec_id") % 100 == 0)


OP12_SQL = """
    WITH rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
               CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
        FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    QUALIFY rank <= 10"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.periodic_runs(docs)


CATALOG = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_license_scan": (op2_license_scan, None),
    "op3_pii": (op3_pii, None),
    "op4_language_id": (op4_language_id, None),
    "op5_byte_bpe": (op5_byte_bpe, None),
    "op6_line_dedup": (op6_line_dedup, None),
    "op7_lm_score": (op7_lm_score, None),
    "op8_nearest": (op8_nearest, None),
    "op9_mix_sources": (op9_mix_sources, None),
    "op10_ngram_join": (op10_ngram_join, None),
    "op11_decontaminate": (op11_decontaminate, OP11_SQL),
    "op12_hard_negatives": (op12_hard_negatives, OP12_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
