"""Articles written from the documents as JATS markup, and read back field by field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio_sync.functions import jats
from folio_sync.functions.text import empty_to_null, strip_space
from folio_sync.operators.extract import extract_articles, good_articles
from query_catalog.common import escape_xml, pmcid, spread_out, table


def _lines(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _contributor_markup() -> Column:
    source = F.col("source")
    english = _lines(
        '<contrib-group><contrib contrib-type="author"><name><surname>Marek</surname><given-names>',
        source, "</given-names></name><aff>Dept. of <italic>", source,
        '</italic>,\n  A &lt; B</aff><contrib-id contrib-id-type="orcid">0000-', F.col("doc_id"),
        '</contrib-id></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib>'
        '<contrib contrib-type="author"><name><surname>Roe</surname></name></contrib></contrib-group>'
        '<contrib-group><contrib contrib-type="author"><name><surname>Late</surname></name></contrib>'
        "</contrib-group>",
    )
    french = _lines(
        '<contrib-group><contrib contrib-type="author"><collab>Group <contrib-group>'
        '<contrib contrib-type="author"><name><surname>Inner</surname></name></contrib></contrib-group>'
        '</collab></contrib><contrib contrib-type="author"><name><given-names> ', source,
        " </given-names></name><aff/></contrib></contrib-group>",
    )
    german = _lines(
        '<contrib-group><contrib contrib-type="author"><name><surname>O&apos;Neil &amp; Co</surname></name>'
        "<aff><![CDATA[x < ", source, "]]> <b>y</b></aff></contrib></contrib-group>",
    )
    return (
        F.when(F.col("lang") == "en", english).when(F.col("lang") == "fr", french)
        .when(F.col("lang") == "de", german).otherwise("")
    )


def _date_markup() -> Column:
    """Months 0 to 14 and days 0 to 32, so that some dates do not exist."""
    month = (F.col("n_chars") % 15).cast("string")
    day = (F.col("doc_id") % 33).cast("string")
    return F.when(
        F.col("lang") == "es", "<pub-date><year>2023</year></pub-date><pub-date><year>1999</year></pub-date>"
    ).when(F.col("lang") == "de", "<pub-date><month>3</month></pub-date>").otherwise(_lines(
        "<pub-date><day>", day, "</day><month>", month, "</month><year> 2024 </year></pub-date>"
    ))


def _journal_markup() -> Column:
    return F.when(F.col("lang") == "en", _lines(
        "<journal-meta><journal-title-group><journal-title> Journal ", F.col("source"),
        " </journal-title></journal-title-group><issn>1111-", F.col("doc_id"),
        "</issn><issn>second</issn><publisher><publisher-name>P &amp; Q</publisher-name></publisher></journal-meta>",
    )).when(
        F.col("lang") == "fr", "<journal-meta><issn> </issn><publisher/></journal-meta>"
    ).otherwise("")


def _license_markup() -> Column:
    return F.when(F.col("lang") == "en", _lines(
        '<permissions><license license-type="open" o:href="no link" xlink:href="http://example.org/', F.col("source"),
        '?a=1&amp;b=2"><p>Free.</p></license></permissions>',
    )).when(
        F.col("lang") == "fr",
        '<permissions><license other:href="u"/><license license-type="no"/></permissions>',
    ).when(F.col("lang") == "de", "<permissions><copyright-year>2024</copyright-year></permissions>").otherwise("")


def as_jats(documents, dates: bool = False):
    """(archive_path, member_name, xml): every document as an article with its whole text."""
    xml = _lines(
        '<?xml version="1.0"?>\n<!DOCTYPE article SYSTEM "a.dtd">\n<articles>\n'
        '<article xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:other="http://www.w3.org/1999/xlink"'
        ' xmlns:o="http://example.org/o">\n<front>',
        _journal_markup(),
        '<article-meta><article-id pub-id-type="pmc">', pmcid("doc_id"),
        '</article-id><article-id pub-id-type="pmid">',
        F.when(F.col("lang") == "de", _lines("x", F.col("doc_id"))).otherwise(F.col("doc_id").cast("string")),
        "</article-id>",
        F.when(F.col("lang") != "fr", _lines(
            '<article-id pub-id-type="doi">first</article-id><article-id pub-id-type="doi">10.1/',
            F.col("doc_id"), "</article-id>",
        )).otherwise(""),
        "<title-group><article-title>",
        F.when(F.col("lang") != "es", _lines(
            "On <italic>", F.col("lang"), "</italic>\n &amp; ", F.col("source"), "<!-- no comment -->"
        )).otherwise(" "),
        "</article-title></title-group>",
        _contributor_markup(),
        _date_markup() if dates else F.lit(""),
        F.when(F.col("lang") == "en", _lines("<abstract><p>", F.col("source"), "</p><p> two </p></abstract>"))
        .when(F.col("lang") == "fr", "<abstract/>").otherwise(""),
        _license_markup(),
        "</article-meta></front>\n<body><sec><p>", escape_xml(F.col("text")),
        "</p></sec></body>\n</article></articles>\n",
    )
    return documents.select(
        F.col("source").alias("archive_path"), pmcid("doc_id").alias("member_name"), xml.alias("xml")
    )


def _extracted(spark, sf_dir, dates=False):
    return extract_articles(as_jats(spread_out(table(spark, sf_dir, "documents"), "doc_id"), dates))


def extract_fields(spark, sf_dir):
    return good_articles(_extracted(spark, sf_dir)).select(
        "pmcid", "pmid", "doi", "title", "abstract_text",
        F.md5("body_text").alias("body_md5"), F.length("body_text").cast("bigint").alias("body_chars"),
    )


EXTRACT_FIELDS = r"""
WITH d AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS body FROM documents)
SELECT 'PMC' || doc_id AS pmcid, CASE WHEN lang <> 'de' THEN doc_id END AS pmid,
       CASE WHEN lang <> 'fr' THEN '10.1/' || doc_id END AS doi,
       CASE WHEN lang = 'es' THEN 'No Title Found' ELSE 'On ' || lang || ' & ' || source END AS title,
       CASE lang WHEN 'en' THEN source || ' two' WHEN 'fr' THEN '' END AS abstract_text,
       md5(body) AS body_md5, CAST(length(body) AS BIGINT) AS body_chars
FROM d"""


def extract_contributors(spark, sf_dir):
    authors = good_articles(_extracted(spark, sf_dir)).select(
        "pmcid", F.posexplode("contributors").alias("position", "author")
    )
    return authors.select("pmcid", F.col("position").cast("bigint").alias("position"), "author.*")


EXTRACT_CONTRIBUTORS = """
SELECT 'PMC' || doc_id AS pmcid, CAST(0 AS BIGINT) AS position,
       CASE lang WHEN 'en' THEN source || ' Marek' WHEN 'fr' THEN source ELSE 'O''Neil & Co' END AS name,
       CASE lang WHEN 'en' THEN 'Dept. of ' || source || ', A < B' WHEN 'fr' THEN ''
                 ELSE 'x < ' || source || ' y' END AS affiliation,
       CASE lang WHEN 'en' THEN '0000-' || doc_id END AS orcid
FROM documents WHERE lang <> 'es'
UNION ALL
SELECT 'PMC' || doc_id, 1, 'Roe', NULL, NULL FROM documents WHERE lang = 'en'"""


def extract_dates(spark, sf_dir):
    return _extracted(spark, sf_dir, dates=True).select(
        "pmcid", F.date_format("publication_date", "yyyy-MM-dd").alias("publication_date"), "reject_reason"
    )


EXTRACT_DATES = """
WITH d AS (
    SELECT doc_id, lang, CASE WHEN lang = 'es' THEN DATE '2023-01-01'
           WHEN lang <> 'de' THEN try_cast('2024-' || (n_chars % 15) || '-' || (doc_id % 33) AS DATE) END AS day
    FROM documents)
SELECT 'PMC' || doc_id AS pmcid, strftime(day, '%Y-%m-%d') AS publication_date,
       CASE WHEN lang <> 'de' AND day IS NULL THEN 'bad_date' END AS reject_reason
FROM d"""


def extract_license_journal(spark, sf_dir):
    return good_articles(_extracted(spark, sf_dir)).select(
        "pmcid", F.col("journal_info.name").alias("journal"), "journal_info.issn", "journal_info.publisher",
        F.col("license_info").isNotNull().alias("has_license"), "license_info.license_type", "license_info.url",
    )


EXTRACT_LICENSE_JOURNAL = """
SELECT 'PMC' || doc_id AS pmcid, CASE lang WHEN 'en' THEN 'Journal ' || source ELSE 'N/A' END AS journal,
       CASE lang WHEN 'en' THEN '1111-' || doc_id WHEN 'fr' THEN '' END AS issn,
       CASE lang WHEN 'en' THEN 'P & Q' END AS publisher, lang IN ('en', 'fr') AS has_license,
       CASE lang WHEN 'en' THEN 'open' END AS license_type,
       CASE lang WHEN 'en' THEN 'http://example.org/' || source || '?a=1&b=2' WHEN 'fr' THEN 'u' END AS url
FROM documents"""


def extract_rejects(spark, sf_dir):
    """Documents broken in a way that depends on their language, three articles to a member."""
    documents = spread_out(table(spark, sf_dir, "documents"), "doc_id")
    good = as_jats(documents.where("lang = 'en'"))
    text = escape_xml(F.col("text"))
    middle = F.when(
        F.col("lang") == "fr", _lines("<article><front><article-meta><p>", text, "</article-meta></front></article>")
    ).when(
        F.col("lang") == "de",
        _lines("<article><front><article-meta><title>", text, "</title></article-meta></front></article>"),
    ).otherwise(_lines(
        '<article><sub-article><front><article-meta><article-id pub-id-type="pmc">', pmcid("doc_id", "SUB"),
        "</article-id></article-meta></front></sub-article><body>", text, "</body></article>",
    ))
    edge = _lines(
        '<article x="1"><front><article-meta><article-id pub-id-type="pmc">', pmcid("doc_id"),
        "</article-id></article-meta></front></article>",
    )
    broken = documents.where("lang <> 'en'").select(
        F.col("source").alias("archive_path"), pmcid("doc_id").alias("member_name"),
        _lines("<articleset>", edge, middle, edge, "</articleset>").alias("xml"),
    )
    return extract_articles(good.unionByName(broken)).select(
        "member_name", F.col("article_pos").cast("bigint").alias("article_pos"), "pmcid", "reject_reason"
    )


EXTRACT_REJECTS = """
SELECT 'PMC' || doc_id AS member_name, p AS article_pos,
       CASE WHEN lang = 'en' OR p <> 1 THEN 'PMC' || doc_id WHEN lang = 'es' THEN 'SUB' || doc_id END AS pmcid,
       CASE WHEN lang = 'en' OR p <> 1 THEN NULL WHEN lang = 'fr' THEN 'malformed'
            WHEN lang = 'de' THEN 'no_pmcid' ELSE 'no_article_meta' END AS reject_reason
FROM documents, (SELECT unnest([0, 1, 2]) AS p) WHERE lang <> 'en' OR p = 0"""


def extract_recovered(spark, sf_dir):
    """Documents whose markup needs a DTD, or is not escaped: names of characters, unknown names, ampersands."""
    documents = spread_out(table(spark, sf_dir, "documents"), "doc_id")
    title = F.when(F.col("lang") == "en", _lines("Caf&eacute;&nbsp;", F.col("source"), " &Omega;"))
    title = title.when(F.col("lang") == "fr", _lines("R&D and ", F.col("source"), " & so on &c"))
    title = title.when(F.col("lang") == "de", _lines("&unknown; ", F.col("source"), " &#169; &#xA9; &amp;eacute; &lt;&gt;"))
    members = documents.select(pmcid("doc_id").alias("member_name"), _lines(
        '<article><front><article-meta><article-id pub-id-type="pmc">', pmcid("doc_id"),
        "</article-id><title-group><article-title>", title.otherwise(_lines("<![CDATA[&eacute; & <b>]]>", F.col("source"))),
        "</article-title></title-group></article-meta></front><body><p>", escape_xml(F.col("text")),
        "</p></body></article>").alias("xml"))
    return extract_articles(members).select("pmcid", "title", "reject_reason", F.md5("body_text").alias("body_md5"))


EXTRACT_RECOVERED = r"""
SELECT 'PMC' || doc_id AS pmcid,
       CASE lang WHEN 'en' THEN 'Café ' || source || ' Ω' WHEN 'fr' THEN 'R&D and ' || source || ' & so on &c'
                 WHEN 'de' THEN '&unknown; ' || source || ' © © &eacute; <>' ELSE '&eacute; & <b>' || source END AS title,
       CAST(NULL AS VARCHAR) AS reject_reason, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS body_md5
FROM documents"""


def article_fragments(spark, sf_dir):
    """Article elements of the raw web pages."""
    fragments = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(jats.split_articles(F.col("html"))).alias("article_pos", "fragment")
    )
    return fragments.select(
        "page_id", F.col("article_pos").cast("bigint").alias("article_pos"), F.md5("fragment").alias("fragment_md5")
    )


_PAGE_FRAGMENTS = r"""
    SELECT page_id, regexp_extract_all(html, '(?s)<article(?:\s[^<>]*)?/>|<article[\s>].*?</article>') AS found FROM pages"""

ARTICLE_FRAGMENTS = f"""
SELECT page_id, CAST(i - 1 AS BIGINT) AS article_pos, md5(found[i]) AS fragment_md5
FROM (SELECT page_id, found, unnest(range(1, len(found) + 1)) AS i FROM ({_PAGE_FRAGMENTS}))"""


def pages_hold_no_articles(spark, sf_dir):
    """Web pages as members: their article elements are no usable articles."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("xml"))
    return extract_articles(pages).groupBy("page_id").agg(
        F.count("*").alias("n_found"), F.count("reject_reason").alias("n_rejected"),
        F.count("pmcid").alias("n_ids"),
    )


PAGES_HOLD_NO_ARTICLES = f"""
SELECT page_id, CAST(len(found) AS BIGINT) AS n_found, CAST(len(found) AS BIGINT) AS n_rejected, CAST(0 AS BIGINT) AS n_ids
FROM ({_PAGE_FRAGMENTS}) WHERE len(found) > 0"""


def page_titles(spark, sf_dir):
    """Simple text: NULL when absent or empty, else trimmed."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        strip_space(empty_to_null(F.regexp_extract("html", "<title>([^<]*)</title>", 1))).alias("title"),
        empty_to_null(F.regexp_extract("html", '<html lang="([^"]*)"', 1)).alias("lang"),
    )


PAGE_TITLES = """
SELECT page_id, trim(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '')) AS title,
       nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang
FROM pages"""


CATALOG = {
    "extract_fields": (extract_fields, EXTRACT_FIELDS),
    "extract_contributors": (extract_contributors, EXTRACT_CONTRIBUTORS),
    "extract_dates": (extract_dates, EXTRACT_DATES),
    "extract_license_journal": (extract_license_journal, EXTRACT_LICENSE_JOURNAL),
    "extract_rejects": (extract_rejects, EXTRACT_REJECTS),
    "extract_recovered": (extract_recovered, EXTRACT_RECOVERED),
    "article_fragments": (article_fragments, ARTICLE_FRAGMENTS),
    "pages_hold_no_articles": (pages_hold_no_articles, PAGES_HOLD_NO_ARTICLES),
    "page_titles": (page_titles, PAGE_TITLES),
}
