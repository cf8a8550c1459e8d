"""Column expressions that read fields from one JATS `<article>` fragment.

An article is parsed twice, both times in the JVM and without passing it through
Python. A streaming `from_xml` parse decides whether the fragment is well formed
and gives ids, dates, journal fields and contributors as typed columns. One
`xpath_string` call returns the mixed-content fields (title, abstract, body,
license) together, joined by a character that XML forbids. `xpath_string` fails
the job on malformed XML, so it only sees fragments that passed the first parse.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio_sync.functions.clocks import parse_day
from folio_sync.functions.text import collapse_space, empty_to_null, strip_space

# Fixed values of the result.
NO_TITLE = "No Title Found"
NO_JOURNAL = "N/A"
XLINK = "http://www.w3.org/1999/xlink"

# A comment outside an article, an empty element, or an article up to its end tag. What
# comments and CDATA sections hold is no markup. Without an end tag an article ends where
# the next one starts, so that only the unclosed one is lost. All repetitions that hold
# groups are possessive: they need no stack.
ARTICLE = (
    r"(?s)<!--.*?-->|<article(?:\s[^<>]*)?/>"
    r"|<article[\s>](?:[^<]++|<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(?!article[\s>]|/article\s*>|!--|!\[CDATA\[))*+"
    r"(?:</article\s*>)?"
)

# Written for an encoded `<` before parsing, so that after parsing every `<` left
# in a string is markup. ESCAPE is written as ESCAPE + "0", so nothing is lost.
ESCAPE = "\uf8fe"
ENCODED_LESS = r"&(?:lt|#0*60|#[xX]0*3[cC]);"

# What an XML parser takes behind an ampersand without a DTD.
OWN_ENTITIES = ("amp;", "lt;", "gt;", "quot;", "apos;")
REFERENCE = "|".join([*OWN_ENTITIES, "#[0-9]+;", "#[xX][0-9A-Fa-f]+;"]).join(["(?:", ")"])

SEPARATOR = "\u0001"

# What the streaming parser lets pass and the XPath parser does not: a character
# beyond the basic plane in the name of an element, attribute or instruction, and
# the two characters at the end of the basic plane.
_BEYOND = r"\x{10000}-\x{10FFFF}"
ODD_CHARACTER = (
    rf"""<(?![!?])[^<>"'{_BEYOND}]*+(?:(?:"[^"]*+"|'[^']*+')[^<>"'{_BEYOND}]*+)*+[{_BEYOND}]"""
    rf"|<\?[^\s?>{_BEYOND}]*+[{_BEYOND}]|[\x{{FFFE}}\x{{FFFF}}]"
)
MAYBE_ODD = rf"[{_BEYOND}\x{{FFFE}}\x{{FFFF}}]"

XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false", "nullValue": SEPARATOR}

# `_corrupt_record` has to be the last field.
GATE_SCHEMA = (
    "article array<struct<front: struct<"
    "`journal-meta`: struct<"
    "`journal-title-group`: array<struct<`journal-title`: array<string>>>, "
    "issn: array<string>, "
    "publisher: array<struct<`publisher-name`: array<string>>>>, "
    "`article-meta`: struct<"
    "`article-id`: array<struct<`_pub-id-type`: string, _VALUE: string>>, "
    "abstract: array<string>, "
    "permissions: array<struct<license: array<struct<`_license-type`: string>>>>, "
    "`pub-date`: array<struct<year: array<string>, month: array<string>, day: array<string>>>, "
    "`contrib-group`: array<struct<contrib: array<struct<"
    "`_contrib-type`: string, "
    "name: array<struct<`given-names`: array<string>, surname: array<string>>>, "
    "aff: array<string>, "
    "`contrib-id`: array<struct<`_contrib-id-type`: string, _VALUE: string>>>>>>>>>>, "
    "_corrupt_record string"
)


def split_articles(xml: Column) -> Column:
    """Every `<article>` element of a document, whatever its root element."""
    found = F.regexp_extract_all(xml, F.lit(ARTICLE), F.lit(0))
    return F.filter(found, lambda f: F.startswith(f, F.lit("<article")))


def _escape_cdata(xml: Column) -> Column:
    """CDATA sections as ordinary escaped text."""
    def piece(part: Column, position: Column) -> Column:
        inside = F.substring_index(part, "]]>", 1)
        escaped = F.replace(F.replace(inside, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        rest = F.substring(part, F.length(inside) + 4, F.length(part))
        return F.when(position == 0, part).otherwise(F.concat(escaped, rest))

    pieces = F.transform(F.split(xml, r"<!\[CDATA\["), piece)
    return F.when(F.contains(xml, F.lit("<![CDATA[")), F.array_join(pieces, "")).otherwise(xml)


def _named_characters() -> Column:
    """Name of an entity -> its character, of those that XML itself does not know."""
    pairs = [F.lit(x) for name, code in name2codepoint.items() if f"{name};" not in OWN_ENTITIES for x in (name, chr(code))]
    return F.create_map(*pairs)


def resolve_entities(xml: Column) -> Column:
    """Named entities as their characters, and what is no reference at all as text.

    A DTD is never read, so a document may use the usual names, which an XML parser refuses; an
    ampersand on its own, or a name that nobody knows, becomes itself."""
    names = _named_characters()

    def piece(part: Column, position: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        character = F.when(F.length(name) < F.length(part), F.try_element_at(names, name))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        return (
            F.when(position == 0, part)
            .when(part.rlike(f"^(?:{REFERENCE})"), F.concat(F.lit("&"), part))
            .when(character.isNotNull(), F.concat(character, rest))
            .otherwise(F.concat(F.lit("&amp;"), part))
        )

    resolved = F.array_join(F.transform(F.split(xml, "&", -1), piece), "")
    return F.when(F.contains(xml, F.lit("&")) & xml.rlike(f"&(?!{REFERENCE})"), resolved).otherwise(xml)


def protect(xml: Column) -> Column:
    """The same article without CDATA sections, encoded `<` characters and entities that need a DTD.

    It is put in an outer element, so that both parsers read the text to its end.
    """
    plain = F.replace(resolve_entities(_escape_cdata(xml)), F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    marked = F.regexp_replace(plain, ENCODED_LESS, ESCAPE + "1")
    return F.concat(F.lit("<w>"), marked, F.lit("</w>"))


def restore(text: Column) -> Column:
    """Undo `protect` on text taken from a parsed article."""
    return F.replace(
        F.replace(text, F.lit(ESCAPE + "1"), F.lit("<")), F.lit(ESCAPE + "0"), F.lit(ESCAPE)
    )


def gate(protected: Column) -> Column:
    """Struct of the streaming parse."""
    return F.from_xml(protected, GATE_SCHEMA, XML_OPTIONS)


def is_well_formed(protected: Column, parsed: Column) -> Column:
    """Whether both parsers accept the article."""
    return F.coalesce(
        parsed["_corrupt_record"].isNull()
        & (F.size(parsed["article"]) == 1)
        & ~(protected.rlike(MAYBE_ODD) & protected.rlike(ODD_CHARACTER)),
        F.lit(False),
    )


def _front(parsed: Column) -> Column:
    return F.get(parsed["article"], F.lit(0))["front"]


def _whole_text(path: str) -> str:
    """XPath of an element's whole text; text right after the element counts too."""
    return f"concat({path}, {path}/following-sibling::node()[1][self::text()])"


def _present(path: str) -> str:
    return f"string(boolean({path}))"


ROOT = "/w/article"
META = f"{ROOT}/front[1]/article-meta[1]"

LINKS = f"{META}/permissions[1]/license[1]/@*[local-name()='href' and contains(name(), ':')]"

# Field name -> XPath, evaluated together. The JDK allows at most 10 groups and
# 100 operators in one XPath, so `(...)[1]` and long predicates are avoided.
FIELD_PATHS = {
    "has_meta": _present(META),
    "title": _whole_text(f"{META}/title-group[article-title][1]/article-title[1]"),
    "abstract": _whole_text(f"{META}/abstract[1]"),
    "license_url": f"string({LINKS})",
    "has_body": _present(f"{ROOT}/body"),
    "body": _whole_text(f"{ROOT}/body[1]"),
}
FIELDS = tuple(FIELD_PATHS)

# Element attribute -> id column (fixed values).
ID_KINDS = {"pmcid": "pmc", "pmid": "pmid", "doi": "doi"}


def _joined(paths: list[str]) -> Column:
    return F.lit("concat(" + f", '{SEPARATOR}', ".join(paths) + ")")


def mixed_fields(protected: Column) -> Column:
    """The mixed-content fields of a well-formed article, in the order of `FIELDS`."""
    text = F.xpath_string(protected, _joined(list(FIELD_PATHS.values())))
    return F.split(restore(text), SEPARATOR)


def field(fields: Column, name: str) -> Column:
    return fields.getItem(FIELDS.index(name))


def _last_id(ids: Column, kind: str) -> Column:
    of_kind = F.filter(ids, lambda i: i["_pub-id-type"] == kind)
    return F.get(F.reverse(of_kind), F.lit(0))["_VALUE"]


def nested_ids(protected: Column, parsed: Column) -> Column:
    """Ids found by searching the whole tree, in the order of `ID_KINDS`.

    Ids count wherever the article nests another front (a sub-article's). NULL if
    there is none, in which case the first parse has the ids.
    """
    def occurs_again(tag: str) -> Column:
        first = F.locate(tag, protected)
        return F.call_function("locate", F.lit(tag), protected, first + 1) > 0

    absent = _front(parsed)["article-meta"].isNull()
    nested = absent | occurs_again("<front") | occurs_again("<article-meta")
    return F.when(nested, F.split(F.xpath_string(protected, _joined([
        f"string((//front/article-meta/article-id[@pub-id-type='{kind}'])[last()]"
        "/node()[1][self::text()])"
        for kind in ID_KINDS.values()
    ])), SEPARATOR))


def article_id(parsed: Column, nested: Column, name: str) -> Column:
    """The last id of a kind, NULL if it is absent or empty."""
    own = _last_id(_front(parsed)["article-meta"]["article-id"], ID_KINDS[name])
    searched = nested.getItem(list(ID_KINDS).index(name))
    return empty_to_null(restore(F.when(nested.isNotNull(), searched).otherwise(own)))


def _leading_text(markup: Column) -> Column:
    """The text before the first child element, NULL when there is none."""
    return empty_to_null(restore(F.substring_index(markup, "<", 1)))


# A tag; an attribute's value may hold the character that ends one.
_TAG = r"""<(?:[^>"']|"[^"]*+"|'[^']*+')*+>"""


def _element_text(markup: Column) -> Column:
    """Whole text of an element given its inner markup."""
    return collapse_space(restore(F.regexp_replace(markup, _TAG, "")))


def contributors(parsed: Column) -> Column:
    """Authors with a personal name, in document order, from the first contributor group."""
    group = F.get(_front(parsed)["article-meta"]["contrib-group"], F.lit(0))

    def person(c: Column) -> Column:
        name = F.get(c["name"], F.lit(0))
        parts = [
            F.coalesce(strip_space(_leading_text(F.get(name[part], F.lit(0)))), F.lit(""))
            for part in ("given-names", "surname")
        ]
        orcid = F.get(
            F.filter(c["contrib-id"], lambda i: i["_contrib-id-type"] == "orcid"), F.lit(0)
        )["_VALUE"]
        affiliation = F.when(
            F.size(c["aff"]) > 0, F.coalesce(_element_text(F.get(c["aff"], F.lit(0))), F.lit(""))
        )
        return F.struct(
            strip_space(F.concat(parts[0], F.lit(" "), parts[1])).alias("name"),
            affiliation.alias("affiliation"),
            _leading_text(orcid).alias("orcid"),
        )

    authors = F.filter(
        group["contrib"], lambda c: (c["_contrib-type"] == "author") & (F.size(c["name"]) > 0)
    )
    return F.coalesce(F.transform(authors, person), F.array())


def own_text(elements: Column) -> Column:
    """Simple text of the first element: NULL when absent or empty, else trimmed."""
    return strip_space(_leading_text(F.get(elements, F.lit(0))))


def whole_text(fields: Column, name: str) -> Column:
    return collapse_space(field(fields, name))


def abstract_text(parsed: Column, fields: Column) -> Column:
    """Whole text of the first abstract, NULL when there is none."""
    found = _front(parsed)["article-meta"]["abstract"]
    return F.when(F.size(found) > 0, whole_text(fields, "abstract"))


def body_text(fields: Column) -> Column:
    return F.when(field(fields, "has_body") == "true", whole_text(fields, "body"))


def date_parts(parsed: Column) -> dict[str, Column]:
    first = F.get(_front(parsed)["article-meta"]["pub-date"], F.lit(0))
    return {part: empty_to_null(own_text(first[part])) for part in ("year", "month", "day")}


def publication_day(parsed: Column) -> Column:
    """First publication date; month and day default to 1; NULL if the parts are no date."""
    parts = date_parts(parsed)
    return parse_day(
        parts["year"],
        F.coalesce(parts["month"], F.lit("1")),
        F.coalesce(parts["day"], F.lit("1")),
    )


def journal_info(parsed: Column) -> Column:
    journal = _front(parsed)["journal-meta"]
    titles = F.flatten(F.filter(journal["journal-title-group"]["journal-title"], F.isnotnull))
    publishers = F.flatten(F.filter(journal["publisher"]["publisher-name"], F.isnotnull))
    return F.struct(
        F.coalesce(empty_to_null(own_text(titles)), F.lit(NO_JOURNAL)).alias("name"),
        own_text(journal["issn"]).alias("issn"),
        own_text(publishers).alias("publisher"),
    )


_INSIDE = r"""(?:[^<>"']|"[^"]*+"|'[^']*+')*?"""
# The prefix of a license's `href`, and a license with several.
LINK_PREFIX = rf"""<license\s{_INSIDE}(?<=[\s"'])([^\s=:"'<>/]+):href\s*="""
SEVERAL_LINKS = rf"<license\s{_INSIDE}:href\s*={_INSIDE}:href\s*="


def _in_namespace(article: Column, prefix: Column) -> Column:
    """Whether a prefix stands for the namespace of links. One that the article does not declare was
    declared outside of it, and counts as well."""
    def prefixes(uri: str) -> Column:
        return F.regexp_extract_all(article, F.lit(rf"""xmlns:([^\s=:]+)\s*=\s*["']{uri}["']"""), F.lit(1))

    return F.array_contains(prefixes(re.escape(XLINK)), prefix) | ~F.array_contains(prefixes("[^\"']*"), prefix)


def link(article: Column, protected: Column, fields: Column) -> Column:
    """The `href` attribute of the license that is in the namespace of links.

    Nearly always the only one is. Where a license has several, or one with another prefix, the
    first four are read with their names, two by a parse: four exceed the JDK's limit on operators."""
    used = F.regexp_extract_all(article, F.lit(LINK_PREFIX), F.lit(1))
    plain = F.forall(used, lambda p: _in_namespace(article, p)) & ~article.rlike(SEVERAL_LINKS)

    def first_of(positions: tuple[int, ...]) -> Column:
        named = F.split(restore(F.xpath_string(protected, _joined(
            [f"name({LINKS}[{i}]), ' ', {LINKS}[{i}]" for i in positions]))), SEPARATOR)
        found = F.filter(
            named, lambda a: (F.length(a) > 1) & _in_namespace(article, F.substring_index(a, ":", 1)))
        # a lambda's argument is evaluated once, an expression each time it is named
        return F.get(F.transform(found, lambda a: F.substring(a, F.locate(" ", a) + 1, F.length(a))), F.lit(0))

    return F.when(plain, field(fields, "license_url")).otherwise(F.coalesce(first_of((1, 2)), first_of((3, 4))))


def license_info(parsed: Column, url: Column) -> Column:
    licenses = F.get(_front(parsed)["article-meta"]["permissions"], F.lit(0))["license"]
    return F.when(
        F.size(licenses) > 0,
        F.struct(
            restore(F.get(licenses, F.lit(0))["_license-type"]).alias("license_type"),
            empty_to_null(url).alias("url"),
        ),
    )
