"""Personal data: patterns propose, checksums confirm, context words adjust (DataFrame functions only).

A span is proposed by a regular expression, confirmed by its validator
(address parts, Luhn, digit count, mod-97) and scored: ``base`` score of its
kind, plus ``checksum`` for a kind with a check digit, plus ``context`` if one
of the kind's context words is among the 40 characters before it or the 20
after it.  The four base kinds (email, ip, card, phone) are always reported;
their score is information.  Added kinds (iban, national id, phone numbers
without a country code) are reported from ``THRESHOLD`` on.

Positions are code points, end exclusive.  They come from the texts between
the matches (``split`` with the same pattern), so nothing leaves the JVM.

The work on a text is in proportion to its length: places are running sums
over the lengths of matches and the texts between, taken within chunks of
``CHUNK`` matches and then over the chunks.

The patterns are possessive or anchored to the start of a run where that
cannot change the leftmost matches: each text is scanned in linear time and
without recursion, also a text of one long run.  ``card`` only matches whole
runs of 14 to 19 digits: the base pattern takes maximal runs and drops the
others, which is the same.

An account number (iban) has the length of its country; case does not matter, and
what follows it, in capitals or not, is not drawn in.

Edge cases: a null text is empty; null ids and repeated rows are kept row by
row; an empty table gives an empty result; only doc_id and text are read; a very
long text is one row with its spans in arrays.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: ISO 7064 letter values are the positions in this alphabet
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BYTE = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
THRESHOLD = 0.5
BEFORE, AFTER = 40, 20
CHUNK = 128
# fixed values: length of an account number by country (ISO 13616)
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20}


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: object                 # Column of the matched text -> boolean Column
    needs: str = ""               # a character every match contains; texts without it are not scanned
    base: float = 0.5
    checksum: float = 0.0
    context: tuple = field(default=())


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def iban_pattern() -> str:
    """Account numbers of every country's own length, with or without single spaces."""
    by_length: dict[int, list[str]] = {}
    for country, n in IBAN_LENGTHS.items():
        by_length.setdefault(n, []).append(country)
    each = "|".join(rf"(?:{'|'.join(names)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in by_length.items())
    # the form is tested before the countries are
    return rf"(?i)(?<![A-Z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{each})(?![A-Z0-9])"


def mod97(s: Column) -> Column:
    """ISO 7064 mod 97-10 of an account number: first four characters last, letters as two digits."""
    plain = F.upper(F.replace(s, F.lit(" "), F.lit("")))
    chars = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    value = lambda c: F.instr(F.lit(ALPHABET), c) - 1
    step = lambda acc, c: (acc * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), step)


BASE_KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda s: F.lit(True), "@", 0.8, 0.0, ("mail", "contact", "write", "reach")),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         lambda s: s.rlike(rf"^0*{BYTE}(?:\.0*{BYTE}){{3}}$"), ".", 0.5, 0.0, ("ip", "host", "server", "address")),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
         lambda s: F.call_function("luhn_check", digits(s)), "", 0.4, 0.4, ("card", "visa", "credit", "pay", "karte", "carte", "tarjeta")),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]",
         lambda s: F.length(digits(s)).between(10, 15), "+", 0.6, 0.0, ("phone", "tel", "call", "mobile", "fax")),
)
ADDED_KINDS = (
    Kind("iban", iban_pattern(),
         lambda s: mod97(s) == 1, "", 0.3, 0.5, ("iban", "account", "bank", "konto", "compte", "cuenta")),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda s: ~s.rlike("^(?:000|666|9)|-00-|-0000$"), "-", 0.3, 0.0,
         ("ssn", "social security", "national id", "tax id")),
    Kind("phone_local", r"(?<![0-9+().-])(?<![0-9+().-] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         lambda s: F.lit(True), "", 0.2, 0.0, ("phone", "tel", "call", "mobile", "fax", "whatsapp")),
)


SPAN = "struct<start:int,rank:int,kind:string,end:int,text:string,score:double>"


def _parts(text: Column, found: Column, kind: Kind) -> Column:
    """Every match with the text before and after it, up to the next match."""
    gaps = F.split(text, kind.pattern, -1)
    parts = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    both = F.zip_with(parts, F.slice(gaps, 2, F.size(found)), lambda p, g: F.struct(
        F.length(p["g"]).alias("skip"), p["m"].alias("m"), F.lower(F.concat(
            F.right(p["g"], F.lit(BEFORE)), F.lit(" "), F.left(g, F.lit(AFTER)))).alias("near")))
    return F.when(F.size(found) > 0, both).otherwise(F.array().cast("array<struct<skip:int,m:string,near:string>>"))


def _spans(parts: Column, kind: Kind, rank: int) -> Column:
    """Validated spans of one kind as structs that sort by start, then kind.  ``parts`` is a column of its own:
    it is read once a chunk."""
    words = "|".join(kind.context)

    def step(acc, p):
        start = acc["at"] + p["skip"]
        end = start + F.length(p["m"])
        score = F.lit(kind.base + kind.checksum) + F.when(p["near"].rlike(rf"(?<![a-z])(?:{words})"), 0.3).otherwise(0.0)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"),
                        end.alias("end"), p["m"].alias("text"), F.least(score, F.lit(1.0)).alias("score"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.array().cast(f"array<{SPAN}>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int"))
    chunks = F.transform(numbers, lambda k: F.aggregate(F.slice(parts, k * CHUNK + 1, CHUNK), zero, step))
    return F.when(F.size(parts) > 0, chunks).otherwise(F.array().cast(f"array<struct<at:int,out:array<{SPAN}>>>"))


def _placed(chunks: Column, kind: Kind) -> Column:
    """The chunks' spans at their places in the text; those that fail validation are dropped."""
    starts = F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])))
    shift = lambda s, by: F.struct((s["start"] + by).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"),
                                   (s["end"] + by).alias("end"), s["text"].alias("text"), s["score"].alias("score"))
    moved = F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), lambda c, by: F.transform(c["out"], lambda s: shift(s, by)))
    return F.filter(F.flatten(moved), lambda s: kind.valid(s["text"]))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``added``: sorted spans (start, rank, kind, end, text, score)."""
    kinds = BASE_KINDS + ADDED_KINDS
    text = F.coalesce(F.col("text"), F.lit(""))
    src = docs.select("doc_id", text.alias("text"))
    none = F.array().cast("array<string>")
    found = src.select("doc_id", "text", *[
        (F.when(F.contains("text", F.lit(k.needs)), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)))
         .otherwise(none) if k.needs else F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).alias(f"m{r}")
        for r, k in enumerate(kinds)])
    parts = found.select("doc_id", *[_parts(F.col("text"), F.col(f"m{r}"), k).alias(f"p{r}") for r, k in enumerate(kinds)])
    chunks = parts.select("doc_id", *[_spans(F.col(f"p{r}"), k, r).alias(f"c{r}") for r, k in enumerate(kinds)])
    spans = chunks.select("doc_id", *[_placed(F.col(f"c{r}"), k).alias(k.name) for r, k in enumerate(kinds)])
    sure = [F.filter(k.name, lambda s: s["score"] >= THRESHOLD) for k in ADDED_KINDS]
    return spans.select("doc_id", F.sort_array(F.concat(*[F.col(k.name) for k in BASE_KINDS])).alias("base"),
                        F.sort_array(F.concat(*sure)).alias("added"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    found = personal_data(documents(spark, sf_dir))
    counts = [count_kind("base", k.name).alias(f"n_{k.name}") for k in BASE_KINDS]
    every = F.sort_array(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
                        digest(every).alias("spans"),
                        F.array_join(F.transform(every, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
