"""Extraction rules, on fragments written here."""

import datetime as dt
import random
import re
from xml.parsers import expat

import pytest
from corpus_files import article
from pyspark.sql import functions as F

from folio_sync.functions import jats
from folio_sync.operators.extract import extract_articles, good_articles


def extract(spark, *documents):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "id int, xml string")
    return sorted(extract_articles(df).collect(), key=lambda r: (r.id, r.article_pos))


def authors(spark, *markups):
    rows = extract(spark, *[article("P", extra=m) for m in markups])
    return [[tuple(c) for c in r.contributors] for r in rows]


FULL = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE articleset SYSTEM "none.dtd">
<articleset>
  <article xml:lang="en">
    <front>
      <journal-meta>
        <journal-title-group><journal-title> Annals of <i>x</i> Tests </journal-title></journal-title-group>
        <issn pub-type="ppub">1111-2222</issn><issn>3333-4444</issn>
        <publisher><publisher-name>Press &amp; Sons</publisher-name></publisher>
      </journal-meta>
      <article-meta>
        <article-id pub-id-type="pmc">PMC1</article-id>
        <article-id pub-id-type="pmid">77</article-id>
        <article-id pub-id-type="doi">old</article-id><article-id pub-id-type="doi">10.1/x</article-id>
        <title-group><article-title>A <italic>b</italic>&#8201;&lt;c&gt;
            &amp;amp; <![CDATA[<d> & e]]><!-- not this --></article-title></title-group>
        <pub-date pub-type="epub"><day>07</day><month>3</month><year>2019</year></pub-date>
        <pub-date><year>1900</year></pub-date>
        <abstract><p>One.</p> <p>Two\u00a0α.</p></abstract>
        <permissions>
          <license license-type="open" q:href="http://l/?a=1&amp;b" xmlns:q="http://www.w3.org/1999/xlink"/>
        </permissions>
      </article-meta>
    </front>
    <body><sec><title>T</title><p>First.</p></sec></body>
  </article>
  <article><front><article-meta><article-id pub-id-type="pmc">PMC2</article-id>
    <permissions/></article-meta></front></article>
</articleset>"""


def test_all_fields(spark):
    full, bare = extract(spark, FULL)
    assert (full.pmcid, full.pmid, full.doi) == ("PMC1", 77, "10.1/x")
    assert full.title == "A b <c> &amp; <d> & e"
    assert full.abstract_text == "One. Two α."
    assert full.publication_date == dt.date(2019, 3, 7)
    assert tuple(full.journal_info) == ("Annals of", "1111-2222", "Press & Sons")
    assert tuple(full.license_info) == ("open", "http://l/?a=1&b")
    assert full.contributors == [] and full.body_text == "TFirst." and full.reject_reason is None
    assert full.raw_jats_xml.startswith("<article xml:lang") and full.raw_jats_xml.endswith("</article>")
    assert (bare.pmcid, bare.pmid, bare.doi, bare.title) == ("PMC2", None, None, "No Title Found")
    assert (bare.abstract_text, bare.publication_date, bare.license_info, bare.body_text) == (None,) * 4
    assert tuple(bare.journal_info) == ("N/A", None, None)
    assert bare.article_pos == 1 and bare.contributors == []


def test_presence_of_empty_elements(spark):
    (row,) = extract(spark, article(
        "P", title=" ", body="", front="<journal-meta><issn> </issn><publisher/></journal-meta>",
        extra="<abstract/><permissions><license/></permissions>",
    ))
    assert row.title == "No Title Found" and row.abstract_text == "" and row.body_text == ""
    assert tuple(row.journal_info) == ("N/A", "", None)
    assert tuple(row.license_info) == (None, None)


def test_ids(spark):
    ids = '<article-id pub-id-type="{}">{}</article-id>'
    rows = extract(
        spark,
        article("P1", pmid="12a"), article("P2", pmid="９"), article(" P3 "),
        article("P4", extra=ids.format("pmc", "LAST")),
        article("P5", extra=ids.format("pmc", "")),
        article("P6").replace("</body>", "</body><sub-article><front><article-meta>"
                              + ids.format("pmc", "SUB") + "</article-meta></front></sub-article>"),
        article("P7", pmid="99999999999999999999"),
    )
    assert [r.pmcid for r in rows] == ["P1", "P2", " P3 ", "LAST", None, "SUB", "P7"]
    assert [r.pmid for r in rows] == [None] * 7
    assert rows[4].reject_reason == "no_pmcid"


def test_contributors(spark):
    person = '<contrib contrib-type="author"><name><surname>{}</surname><given-names>{}</given-names></name>{}</contrib>'
    found = authors(
        spark,
        "<contrib-group>" + person.format("Marek", " J. ", "<aff>Dept <b>of</b>\n X &lt; Y</aff>")
        + person.replace("author", "editor").format("Ed", "E", "")
        + person.format("", "Solo", '<contrib-id contrib-id-type="orcid"> 1 </contrib-id><aff/>')
        + "</contrib-group><contrib-group>" + person.format("Late", "", "") + "</contrib-group>",
        '<contrib-group><contrib contrib-type="author"><collab>G<contrib-group>' + person.format("In", "", "")
        + "</contrib-group></collab></contrib>" + person.format("null", "&amp;", "<aff><![CDATA[a<b]]></aff>")
        + '<contrib contrib-type="author"><name/></contrib></contrib-group>',
        "",
    )
    assert found == [
        [("J. Marek", "Dept of X < Y", None), ("Solo", "", " 1 ")],
        [("& null", "a<b", None), ("", None, None)],
        [],
    ]


@pytest.mark.parametrize("parts, expected, reason", [
    ("<year>2024</year>", dt.date(2024, 1, 1), None),
    ("<year>2024</year><month>2</month><day>29</day>", dt.date(2024, 2, 29), None),
    ("<year>2024</year><month>02</month><day> 9 </day>", dt.date(2024, 2, 9), None),
    ("<year>2023</year><month>2</month><day>29</day>", None, "bad_date"),
    ("<year>2024</year><month>Sep</month>", None, "bad_date"),
    ("<year>24</year>", None, "bad_date"),
    ("<month>5</month>", None, None),
    ("<year> </year><month>May</month>", None, None),
    ("<year>2024</year><month/><day> </day>", dt.date(2024, 1, 1), None),
])
def test_dates(spark, parts, expected, reason):
    text = article("P").replace("<year>2024</year>", parts)
    (row,) = extract(spark, text)
    assert (row.publication_date, row.reject_reason) == (expected, reason)


def test_unusable_articles_are_named_and_spare_the_others(spark):
    rows = extract(
        spark,
        f"<articles>{article('A')}{article('B').replace('</title-group>', '')}<article/>{article('C')}</articles>",
        "This is no XML.\n<article> never closed <random>", "", article(None), article("D").replace("article-meta", "meta"),
        article("E").replace("Some", "&nbsp;"), article("F", title='x <a b="1" b="2"/>'),
    )
    assert [(r.id, r.pmcid, r.reject_reason) for r in rows] == [
        (0, "A", None), (0, None, "malformed"), (0, None, "no_pmcid"), (0, "C", None),
        (1, None, "malformed"),
        (3, None, "no_pmcid"), (4, None, "no_pmcid"), (5, "E", None), (6, None, "malformed"),
    ]


@pytest.mark.parametrize("attributes, url", [
    ('o:href="no" xlink:href="yes"', "yes"), ('xlink:href="yes" o:href="no"', "yes"), ('o:href="no"', None),
    ('href="no"', None), ('l:href="yes"', "yes"), ('o:href="no" p:href="no" l:href="yes &amp; so"', "yes & so"),
    ('above:href="yes"', "yes"), ('xlink:href=""', None),
])
def test_the_link_of_a_license_is_in_its_namespace(spark, attributes, url):
    text = article("A", extra=f"<permissions><license {attributes}/></permissions>").replace(
        "<article ", "<article xmlns:o='urn:o' xmlns:p=\"urn:p\" xmlns:l='http://www.w3.org/1999/xlink' ")
    (row,) = extract(spark, text)
    assert (row.reject_reason, row.license_info.url) == (None, url)


def test_entities_of_a_dtd_and_bare_ampersands_are_text(spark):
    (row,) = extract(spark, article(
        "A", "caf&eacute; &Alpha;&alpha; R&D & &nope; &amp;nbsp; &#233;&#xE9; &;<![CDATA[&eacute;]]>", "x&nbsp;&hellip; AT&T",
        extra='<permissions><license xlink:href="http://x/?a=1&b=&eacute;"/></permissions>'))
    assert row.reject_reason is None
    assert row.title == "café Αα R&D & &nope; &nbsp; éé &;&eacute;" and row.body_text == "x … AT&T"
    assert row.license_info.url == "http://x/?a=1&b=é" and "caf&eacute;" in row.raw_jats_xml  # stored as it came


def test_an_unclosed_article_and_what_comments_hold_spare_the_next(spark):
    unclosed = article("A").replace("</article>", "")
    noted = article("B").replace("<body>", "<!-- </article> <article> --><body><![CDATA[</article>]]>")
    rows = extract(
        spark, f"<articles>{unclosed}{noted}<!-- {article('N')} -->{article('C')}</articles>",
        article("D").replace("</article>", "</article >") + "<article><!-- never ends ", "<article>" * 20_000,
    )
    assert [(r.id, r.pmcid, r.reject_reason) for r in rows if r.id < 2] == [
        (0, None, "malformed"), (0, "B", None), (0, "C", None), (1, "D", None), (1, None, "malformed"),
    ]
    assert sum(r.id == 2 for r in rows) == 20_000


def test_affiliation_with_an_odd_attribute(spark):
    person = ('<contrib contrib-type="author"><name><surname>Z</surname></name>'
              '<aff>A <b x="1>2">bold</b> Z</aff></contrib>')
    (row,) = extract(spark, article("P").replace("</article-meta>", f"<contrib-group>{person}</contrib-group></article-meta>"))
    assert row.contributors[-1].affiliation == "A bold Z"


def test_no_article_meta(spark):
    text = "<article><sub-article><front><article-meta><article-id pub-id-type='pmc'>S</article-id></article-meta></front></sub-article></article>"
    (row,) = extract(spark, text)
    assert (row.pmcid, row.reject_reason) == ("S", "no_article_meta")


def test_rows_without_xml_pass_through(spark):
    df = spark.createDataFrame([("a", None), ("b", article("P"))], "archive_path string, xml string")
    rows = {r.archive_path: r for r in extract_articles(df).collect()}
    assert rows["a"].raw_jats_xml is None and rows["a"].reject_reason is None
    assert [r.pmcid for r in good_articles(extract_articles(df)).collect()] == ["P"]


def test_escape_character_in_the_text_survives(spark):
    (row,) = extract(spark, article("P", title="a\uf8feb &lt; \uf8fe1", body="\uf8fe0 &#60; \uf8fe"))
    assert row.title == "a\uf8feb < \uf8fe1" and row.body_text == "\uf8fe0 < \uf8fe"


def test_one_parse_of_each_kind_per_article(spark):
    df = spark.createDataFrame([(1, "x")], "id int, xml string")
    plan = extract_articles(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1


TOKENS = [
    "<", ">", "&", "&lt;", "&#60;", "&#0;", "&#x1F;", "&nbsp;", "&#xD800;", "&#xFFFF;", '"', "'", "/", "<!--", "-->",
    "<![CDATA[", "]]>", "<?", "?>", "<a>", "</a>", "<a/>", "=", ' x="1"', ' x="1" x="2"', "\x01", "\uffff", "\U0001fffe",
    "q:z", "<q:z/>", "<front>", "</front>", "</article-meta>", "<!DOCTYPE a>", ";", "😀", "<😀>", ' 😀="1"', "<?😀 x?>",
    "\x85", "\u2028", "]", "!", 'xmlns=""', "<xml:a/>", "<article/>", "</article>",
]


def test_damaged_articles_never_fail_the_job(spark):
    """Whatever is broken, a bad article is rejected and only well-formed ones pass."""
    rnd = random.Random(11)
    whole = article(
        "PMC1", "A <i>t</i> &amp; b", "x <![CDATA[a < b]]> y", pmid="1", front="<journal-meta><issn>1</issn></journal-meta>",
        extra='<contrib-group><contrib contrib-type="author"><name><surname>S</surname></name><aff>a<b>c</b></aff></contrib>'
        '</contrib-group><!-- c --><?pi x?><permissions><license xlink:href="u&amp;v"/></permissions>',
    )
    documents = []
    for _ in range(4000):
        text = whole
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            at = rnd.randrange(9, len(text) - 10)
            if rnd.random() < 0.7:
                text = text[:at] + rnd.choice(TOKENS) + text[at:]
            else:
                text = text[:at] + text[at + rnd.randrange(1, 8):]
        documents.append(text)
    rows = extract(spark, *documents)
    assert sum(r.reject_reason is None for r in rows) > 500
    reference = re.compile(rf"(?s)(<!\[CDATA\[.*?\]\]>)|&(?!{jats.REFERENCE})")
    for row in rows:
        if row.reject_reason != "malformed":
            plain = reference.sub(lambda m: m.group(1) or "&amp;", row.raw_jats_xml)
            expat.ParserCreate().Parse(plain.encode(), True)


def test_links_are_read_in_few_parses(spark):
    """An expression that names another one several times repeats its parses."""
    df = spark.createDataFrame([("", "", [""])], "a string, p string, f array<string>")
    plan = df.select(jats.link(F.col("a"), F.col("p"), F.col("f")).alias("link"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("xpath_string(") == 2
