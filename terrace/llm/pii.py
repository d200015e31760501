"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

DataFrame functions only.  ``find`` adds an array of spans (kind, start, end,
value, score, base) to each row; positions are code points, the end exclusive.

Base spans are the leftmost matches of each kind's pattern that do not overlap,
without those that the kind's test refuses (an octet above 255, the Luhn sum,
the number of digits); a refused match is not tried again.  They always stay,
and their score only tells how sure they are.  Further spans are added from a
score of ``LEAST_SCORE``:

* cards and phone numbers inside a refused match, where a long chain of digits
  ran on into other numbers: a digit run or four groups of four that pass Luhn,
  a number of strict grouping at the beginning of the match;
* phone numbers without a country code, beside a word such as "phone";
* ``iban``: account numbers whose ISO 7064 remainder modulo 97 is 1;
* ``ssn``: social security numbers, beside a word that says so.

A span's score is its kind's (``SCORES``), more with a word of the kind within
``NEARBY`` characters on either side (up to the next match of the pattern), less
with a word of ``NUMBERS`` such as "order" or "invoice".

Patterns are written so that Java reads any text in linear time: a run is tried
at its beginning only, or where the last match ended, and repeated groups are
possessive, which also keeps them off the stack.  Positions come from the
lengths of what lies between the matches, added up in chunks, so that a text
with many matches costs less than the square of their number.  There is no
shuffle: each row is judged on its own, however many there are of a kind.

Null and empty texts have no spans.  Repeated rows are judged alike; other
columns pass through, one called ``pii`` is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
NEARBY = 40
LEAST_SCORE = 0.6

# The patterns.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
INNER_CARD = r"[0-9]{13,}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}"
INNER_PHONE = r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{4}"
LOCAL_PHONE = r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

# The words that raise a kind's score, and those that lower the score of numbers.
WORDS = {
    "email": "e-?mail|mail|contact|write",
    "ip": "ip|address|host|server|login|client",
    "card": "card|visa|mastercard|amex|credit|debit|payment|cvv",
    "phone": "phone|telephone|tel|call|mobile|cell|fax|whatsapp",
    "iban": "iban|account|bank|transfer|bic",
    "ssn": "ssn|social security",
}
NUMBERS = "order|invoice|isbn|tracking|serial|version|part no"
#: Score of a span that passed its test, and what a nearby word adds; nearby ``NUMBERS`` take ``MINUS``.
SCORES = {"email": (0.9, 0.1), "ip": (0.6, 0.2), "card": (0.7, 0.2), "phone": (0.7, 0.2), "iban": (0.9, 0.1),
          "ssn": (0.3, 0.5), "local_phone": (0.3, 0.4)}
MINUS = 0.2

_FOUND = "array<struct<start:int,value:string,before:string,after:string>>"
_SPANS = "array<struct<start:int,end:int,value:string,score:double,base:boolean>>"
_CHUNK = 256


def _bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), fn)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches with their start and what is near them on both sides."""
    gaps = F.split(text, pattern, -1)
    rows = F.zip_with(gaps, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, m: F.struct(
        F.char_length(gap).alias("gap"), F.left(gap, F.lit(NEARBY)).alias("head"), F.right(gap, F.lit(NEARBY)).alias("tail"),
        m.alias("m")))

    def one(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        found = F.struct(start.alias("start"), row["m"].alias("value"), row["tail"].alias("before"),
                         F.coalesce(row["after"], F.lit("")).alias("after"))
        return F.struct((start + F.char_length(row["m"])).alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    def chunk(state: Column, rows: Column) -> Column:
        inner = F.aggregate(rows, F.struct(state["at"].alias("at"), F.array().cast(_FOUND).alias("out")), one)
        return _bind(inner, lambda v: F.struct(v["at"].alias("at"), F.concat(state["out"], F.array(v["out"])).alias("out")))

    def whole(rows: Column) -> Column:
        beside = F.transform(rows, lambda row, i: F.struct(
            row["gap"].alias("gap"), row["m"].alias("m"), row["tail"].alias("tail"), F.get(rows, i + 1)["head"].alias("after")))
        matches = F.size(rows) - 1  # the last row is the text behind the last match
        chunks = _bind(beside, lambda found: F.transform(
            F.sequence(F.lit(0), F.greatest(matches - 1, F.lit(0)), F.lit(_CHUNK)),
            lambda c: F.slice(found, c + 1, F.least(F.lit(_CHUNK), matches - c))))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FOUND}>").alias("out"))
        return F.when(matches > 0, F.aggregate(chunks, start, chunk, lambda s: F.flatten(s["out"]))).otherwise(
            F.array().cast(_FOUND))

    return _bind(rows, whole)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def mod97(value: Column) -> Column:
    """The ISO 7064 remainder of an account number: the first four characters last, letters as 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.left(plain, F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.regexp_extract_all(turned, F.lit("."), F.lit(0)), F.lit(0), step)


def _near(span: Column, words: str) -> Column:
    beside = F.lower(F.concat(span["before"], F.lit(" "), span["after"]))
    return beside.rlike(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")


def score(kind: str, span: Column, scores: str | None = None) -> Column:
    sure, more = SCORES[scores or kind]
    less = F.when(_near(span, NUMBERS), F.lit(MINUS)).otherwise(0.0) if kind in ("card", "phone", "ssn") else F.lit(0.0)
    return F.round(F.lit(sure) + F.when(_near(span, WORDS[kind]), F.lit(more)).otherwise(0.0) - less, 2)


def _spans(kind: str, found: Column, base: bool, scores: str | None = None) -> Column:
    rows = F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), (s["start"] + F.char_length(s["value"])).alias("end"), s["value"].alias("value"),
        score(kind, s, scores).alias("score"), F.lit(base).alias("base")))
    return rows if base else F.filter(rows, lambda s: s["score"] >= LEAST_SCORE)


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), *[
        s[c].alias(c) for c in ("start", "end", "value", "score", "base")]))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _card(value: Column) -> Column:
    return F.char_length(digits(value)).between(13, 19) & F.call_function("luhn_check", digits(value))


def _phone(value: Column) -> Column:
    return F.char_length(digits(value)).between(9, 15)


def _alone(span: Column, chars: str) -> Column:
    """Whether no character of the class touches the span."""
    return ~span["before"].rlike(f"[{chars}]$") & ~span["after"].rlike(f"^[{chars}]")


def _cards_within(span: Column) -> Column:
    """Cards inside a refused chain of digits, with the chain's surroundings."""
    parts = F.filter(located(span["value"], INNER_CARD), lambda s: _alone(s, "0-9") & _card(s["value"])
                     & s["value"].rlike("^[3-6]"))
    return F.transform(parts, lambda s: F.struct((span["start"] + s["start"]).alias("start"), s["value"].alias("value"),
                                                 span["before"].alias("before"), span["after"].alias("after")))


def _phone_within(span: Column) -> Column:
    """The strictly grouped number with which a refused match begins, or null in value."""
    head = F.regexp_extract(span["value"], INNER_PHONE, 0)
    ends = ~F.substr(span["value"], F.char_length(head) + 1, F.lit(1)).rlike("^[0-9]")
    return F.struct(span["start"].alias("start"), F.when((head != "") & ends, head).alias("value"),
                    span["before"].alias("before"), span["after"].alias("after"))


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with the array ``out`` of spans (kind, start, end, value, score, base), by kind and start."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(_FOUND)
    # a cheap test that every match needs spares most texts the search
    tests = {"email": (EMAIL, F.contains(t, F.lit("@"))), "ip": (IP, t.rlike(r"[0-9]\.[0-9]")),
             "card": (CARD, t.rlike(r"(?:[0-9][ -]?){12}[0-9]")), "phone": (PHONE, F.contains(t, F.lit("+"))),
             "local": (LOCAL_PHONE, t.rlike(LOCAL_PHONE)), "iban": (IBAN, t.rlike(IBAN)), "ssn": (SSN, t.rlike(SSN))}
    rows = docs.select("*", *[F.when(test, located(t, pattern)).otherwise(none).alias(f"__llm_{k}")
                              for k, (pattern, test) in tests.items()])
    found = {k: F.col(f"__llm_{k}") for k in tests}
    inner_cards = F.flatten(F.transform(F.filter(found["card"], lambda s: ~_card(s["value"])), _cards_within))
    inner_phones = F.filter(F.transform(F.filter(found["phone"], lambda s: ~_phone(s["value"])), _phone_within),
                            lambda s: s["value"].isNotNull())
    local = F.filter(found["local"], lambda s: _alone(s, "0-9-") & ~s["before"].rlike(r"\+[0-9 ().-]*$"))
    ssn = F.filter(found["ssn"], lambda s: _alone(s, "0-9-") & ~s["value"].rlike("^(?:000|666|9)|-00-|-0000$"))
    iban = F.filter(found["iban"], lambda s: _alone(s, "A-Za-z0-9") & (mod97(s["value"]) == 1))
    kinds = {
        "email": _spans("email", found["email"], True),
        "ip": _spans("ip", F.filter(found["ip"], lambda s: s["value"].rlike(OCTETS)), True),
        "card": F.concat(_spans("card", F.filter(found["card"], lambda s: _card(s["value"])), True),
                         _spans("card", inner_cards, False)),
        "phone": F.concat(_spans("phone", F.filter(found["phone"], lambda s: _phone(s["value"])), True),
                          _spans("phone", inner_phones, False), _spans("phone", local, False, "local_phone")),
        "iban": _spans("iban", iban, False),
        "ssn": _spans("ssn", ssn, False),
    }
    spans = [_named(k, F.sort_array(kinds[k].cast(_SPANS))) for k in KINDS]
    passed = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return rows.select(*passed, F.concat(*spans).alias(out))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, spans: str = "pii") -> DataFrame:
    """doc_id, the numbers of base spans by kind, the digest of the base spans, and all spans."""
    base = found.select("doc_id", F.col(spans).alias("spans"), F.filter(spans, lambda s: s["base"]).alias("base"))
    counts = [F.size(_of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return base.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.col("spans")).alias("spans"))
