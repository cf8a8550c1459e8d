"""Articles from XML members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.functions import jats
from folio_sync.functions.text import empty_to_null

ARTICLE_COLUMNS = (
    "pmcid", "pmid", "doi", "title", "abstract_text", "publication_date",
    "journal_info", "contributors", "license_info", "raw_jats_xml", "body_text",
)


def _parsed(members: DataFrame, report_empty: bool) -> DataFrame:
    """One row per article with its parse results.

    They leave through an `explode` of one element: the optimizer does not push
    later filters below it, where they would repeat the parses they refer to.
    """
    kept = [c for c in members.columns if c not in ("xml", "first_article")]
    first = F.col("first_article") if "first_article" in members.columns else F.lit(0)
    nothing = F.array(F.lit(None).cast("string"))
    found = jats.split_articles(F.col("xml"))
    if report_empty:
        found = F.when(F.size(found) > 0, found).otherwise(nothing)
    fragments = F.when(F.col("xml").isNull(), nothing).otherwise(found)
    x, p = F.col("protected"), F.col("parsed")
    parsed = (
        members.select(*kept, first.alias("first"), F.posexplode(fragments).alias("pos", "raw_jats_xml"))
        .select(*kept, (F.col("pos") + F.coalesce("first", F.lit(0))).alias("article_pos"), "raw_jats_xml")
        .withColumn("protected", jats.protect(F.col("raw_jats_xml")))
        .withColumn("parsed", jats.gate(x))
        .withColumn("well_formed", jats.is_well_formed(x, p))
        .withColumn("fields", F.when(F.col("well_formed"), jats.mixed_fields(x)))
        .withColumn("link", F.when(F.col("well_formed"), jats.link(F.col("raw_jats_xml"), x, F.col("fields"))))
        .withColumn("nested", F.when(F.col("well_formed"), jats.nested_ids(x, p)))
    )
    results = F.struct("parsed", "well_formed", "fields", "nested", "link")
    return parsed.select(
        *kept, "article_pos", "raw_jats_xml", F.explode(F.array(results)).alias("result")
    ).select(*kept, "article_pos", "raw_jats_xml", "result.*")


def extract_articles(members: DataFrame, report_empty: bool = False) -> DataFrame:
    """One row per `<article>` element of the `xml` column.

    All other columns are kept. `article_pos` numbers the articles of a member, on from
    `first_article` where the row has that column and is a part of one, and
    `reject_reason` says why an article is unusable (NULL for a good one). A member
    without any article gives no row, or one with NULL article columns if
    `report_empty`; a row whose `xml` is NULL passes through like that, so that status
    rows of an archive can travel along.
    """
    kept = [c for c in members.columns if c not in ("xml", "first_article")]
    p, f, nested = F.col("parsed"), F.col("fields"), F.col("nested")
    columns = _parsed(members, report_empty).select(
        *kept, "article_pos", "raw_jats_xml", "well_formed",
        F.when(F.col("well_formed"), jats.article_id(p, nested, "pmcid")).alias("pmcid"),
        jats.article_id(p, nested, "pmid").alias("pmid_text"),
        jats.article_id(p, nested, "doi").alias("doi"),
        (jats.field(f, "has_meta") == "true").alias("has_meta"),
        F.coalesce(empty_to_null(jats.whole_text(f, "title")), F.lit(jats.NO_TITLE)).alias("title"),
        jats.abstract_text(p, f).alias("abstract_text"),
        jats.date_parts(p)["year"].isNotNull().alias("has_year"),
        jats.publication_day(p).alias("publication_date"),
        jats.journal_info(p).alias("journal_info"),
        F.when(F.col("well_formed"), jats.contributors(p)).alias("contributors"),
        jats.license_info(p, F.col("link")).alias("license_info"),
        jats.body_text(f).alias("body_text"),
    ).withColumn(
        "pmid",
        F.when(F.col("pmid_text").rlike(r"^[0-9]+\z"), F.col("pmid_text").try_cast("bigint")),
    )
    reason = (
        F.when(F.col("raw_jats_xml").isNull(), F.lit(None))
        .when(~F.col("well_formed"), F.lit("malformed"))
        .when(F.col("pmcid").isNull(), F.lit("no_pmcid"))
        .when(~F.col("has_meta"), F.lit("no_article_meta"))
        .when(F.col("has_year") & F.col("publication_date").isNull(), F.lit("bad_date"))
    )
    return columns.select(
        *kept, "article_pos", *ARTICLE_COLUMNS, reason.alias("reject_reason")
    )


def good_articles(extracted: DataFrame) -> DataFrame:
    """Usable articles. The test reads narrow columns only: a good article has an id."""
    return extracted.where(F.col("pmcid").isNotNull() & F.col("reject_reason").isNull())


def rejected_articles(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reject_reason").isNotNull())
