"""Personal data in text, with DataFrame functions alone.

Regular expressions propose spans. Validators confirm them: Luhn for cards, mod 97 for IBANs,
ranges for IP addresses, digit counts for phones. Context words close before a span raise its
score; kinds without a check digit of their own are only taken with such a word.

A position is the number of code points before it. The text between the matches and the
matches themselves are split by the same expression, so their lengths add up to positions.
All repetitions are possessive and a match may not start inside a run that was tried already,
so time is linear in a text's length and no match needs a deep stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40  # code points before a span in which a context word counts
BONUS = 0.3
LOCAL = "A-Za-z0-9._%+-"


def _run(first: str) -> str:
    """At the start of a run of these characters, or where the last match ended."""
    return rf"(?:(?<![{first}])|\G)"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # texts without a match of it are passed over
    context: str  # words that speak for the kind
    score: float
    needs_context: bool = False


# The kinds of the base in the order of their contract, then those that the
# method adds, with the words that speak for each.
BASE = (
    Kind("email", rf"{_run(LOCAL)}[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         "mail|email|e-mail|contact|write", 0.7),
    Kind("ip", rf"{_run('0-9')}[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         "ip|address|host|server", 0.6),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9](?:[ -]?[0-9]){13}",
         "card|visa|mastercard|credit|payment", 0.7),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]",
         "phone|tel|call|mobile|fax", 0.6),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}",
         "iban|account|bank|konto", 0.7),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "ssn|social|security", 0.4, True),
)
# zeros in front are passed over; after them nothing may be left, but a part has a digit
BYTE = "(?=[0-9])0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        doubled = F.when(place % 2 == 1, digit * 2).otherwise(digit)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(number: Column) -> Column:
    """Whether an IBAN's remainder by 97 is one: country and check digits last, A as 10 to Z as 35."""
    plain = F.replace(number, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    digits = _digits(found)
    if kind == "card":
        # the length is checked first, so that Luhn never walks a long run of digits
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return F.length(F.replace(found, F.lit(" "), F.lit(""))).between(15, 34) & mod97(found)
    return F.lit(True)


def _spans(text: Column, kind: Kind, rank: int) -> Column:
    """array<struct<start,rank,kind,end,score>> of the confirmed matches of one kind."""
    pattern = F.lit(kind.pattern)
    pairs = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("before"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"))
    empty = F.array().cast("array<struct<start:int,end:int,found:string,before:string>>")

    def place(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["before"])
        end = start + F.length(pair["found"])
        near = F.when(F.length(pair["before"]) > CONTEXT, F.substring(pair["before"], -CONTEXT, CONTEXT)).otherwise(
            pair["before"])
        here = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"), near.alias("before"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(here)).alias("spans"))

    placed = F.aggregate(
        F.filter(pairs, lambda p: p["found"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")), place, lambda s: s["spans"])
    spoken = rf"(?i)(?<![a-z])(?:{kind.context})(?![a-z])"

    def confirmed(s: Column) -> Column:
        valid = _valid(kind.name, s["found"])
        return valid & s["before"].rlike(spoken) if kind.needs_context else valid

    scored = F.transform(F.filter(placed, confirmed), lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), s["end"].alias("end"),
        (F.lit(kind.score) + F.when(s["before"].rlike(spoken), BONUS).otherwise(0.0)).alias("score")))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
    return F.when(text.rlike(kind.hint), scored).otherwise(none)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, found.

    The counts and the digest are of the base kinds. `spans` lists all kinds as kind:start:end in
    code points, by start and then kind; `found` holds them with their scores. Null texts count
    as empty; an empty table gives no rows; equal rows give equal rows; other columns are not
    read. A text is searched whole; matches of one kind do not overlap, those of two may."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = (*BASE, *ADDED)
    found = docs.select(
        F.col("doc_id").cast("long"), *(_spans(text, kind, i).alias(kind.name) for i, kind in enumerate(kinds)))
    base = F.concat(*(F.col(k.name) for k in BASE))
    every = F.concat(*(F.col(k.name) for k in kinds))
    return found.select(
        "doc_id", *(F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(every).alias("spans"),
        F.transform(F.array_sort(every), lambda s: s.dropFields("rank")).alias("found"),
    )
