"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for bank
account numbers), and words nearby adjust the score of those that stay uncertain. Base
kinds: email, ip, card, phone; they are reported whatever the score says. Further kinds:
iban; account (13 to 19 digits that are no card, beside a word for a card or account);
local (a phone number without a plus, beside a word for telephone).

Spans come from splitting a text at a pattern and finding all its matches: the lengths of
the pieces and matches in turn give each span's place in code points. Repetitions are
possessive where nothing after them could match less, and a match can start only where the
run of its first class starts, or at the end of the last match, so the time is linear in
the text.

Null and empty texts have no spans. Repeated rows each get their own result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns, as given but for possessive repetition and the start of the run
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
LOCAL = r"(?<![0-9+(])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "account", "local")
NEAR = 40
#: score of a confirmed span, what a word nearby adds, and what an added kind needs
CONTEXT = {
    "account": r"(?i)\b(?:card|credit|debit|visa|account|konto|karte|carte|compte|tarjeta|cuenta|iban)\b",
    "local": r"(?i)\b(?:phone|tel|call|fax|mobile|telefon|telefono|teléfono|téléphone|handy)\b",
    "iban": r"(?i)\b(?:iban|bank|account|konto|compte|cuenta)\b",
}
START = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.8, "iban": 0.9, "account": 0.3, "local": 0.3}
BONUS, NEEDED = 0.3, 0.5


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once for all its uses."""
    return F.transform(F.array(value), use)[0]


def spans(text: Column, pattern: str, possible: Column) -> Column:
    """All matches as (start, end, match), where ``possible`` says that there may be any."""
    kind = "array<struct<start:int,stop:int,found:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(matches: Column) -> Column:
        pairs = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), matches.alias("match"))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

        def add(state: Column, pair: Column) -> Column:
            start = state["at"] + F.char_length(pair["piece"])
            stop = start + F.coalesce(F.char_length(pair["match"]), F.lit(0))
            span = F.struct(start.alias("start"), stop.alias("stop"), pair["match"].alias("found"))
            return F.struct(stop.alias("at"), F.concat(state["out"], F.when(pair["match"].isNull(), F.array().cast(kind)).otherwise(F.array(span))).alias("out"))

        return F.when(F.size(matches) > 0, F.aggregate(pairs, zero, add, lambda s: s["out"])).otherwise(F.array().cast(kind))

    return F.when(possible, once(found, placed)).otherwise(F.array().cast(kind))


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits ends in its Luhn check digit."""
    numbers = F.reverse(F.split(number, ""))

    def add(state: Column, digit: Column) -> Column:
        value = digit.cast("int") * F.when(state["odd"], 2).otherwise(1)
        return F.struct((state["sum"] + value - F.when(value > 9, 9).otherwise(0)).alias("sum"), (~state["odd"]).alias("odd"))

    zero = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(F.filter(numbers, lambda d: d != ""), zero, add, lambda s: s["sum"]) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether the digits of an account number, letters counting from 10, leave 1 modulo 97."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(state: Column, sign: Column) -> Column:
        value = F.when(sign.between("0", "9"), F.ascii(sign) - 48).otherwise(F.ascii(sign) - 55)
        return (state * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda d: d != ""), F.lit(0), add) == 1


def ip_parts(found: Column) -> Column:
    """Whether all four parts are at most 255."""
    bare = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(found, r"\."), lambda p: (F.length(bare(p)) <= 3) & (bare(p).cast("int") <= 255))


def card(found: Column) -> Column:
    return F.length(digits(found)).between(16, 19) & luhn(digits(found))


def near(text: Column, span: Column) -> Column:
    """The characters around a span."""
    start = F.greatest(span["start"] - NEAR, F.lit(0))
    return F.concat_ws(" ", F.substr(text, start + 1, span["start"] - start), F.substr(text, span["stop"] + 1, F.lit(NEAR)))


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and for each kind its spans (start, stop, found), `text` among them."""
    text = F.col("text")
    has = lambda sign: F.contains(text, F.lit(sign))
    number = text.rlike("[0-9]")
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = out.withColumn("number", number)
    out = out.withColumns(
        {
            "email": spans(text, EMAIL, has("@")),
            "ip": F.filter(spans(text, IP, F.col("number") & has(".")), lambda s: ip_parts(s["found"])),
            "digits": spans(text, CARD, F.col("number")),
            "phone": F.filter(spans(text, PHONE, F.col("number") & has("+")), lambda s: F.length(digits(s["found"])).between(8, 15)),
            "iban": F.filter(spans(text, IBAN, F.col("number")), lambda s: mod97(s["found"])),
            "local": spans(text, LOCAL, F.col("number")),
        }
    )
    out = out.withColumn("card", F.filter("digits", lambda s: card(s["found"])))
    numbers = F.filter("digits", lambda s: F.length(digits(s["found"])).between(13, 19) & ~card(s["found"]))
    clear = lambda kind, others: F.filter(kind, lambda s: ~F.exists(others, lambda o: (o["start"] < s["stop"]) & (s["start"] < o["stop"])))
    known = F.concat("email", "ip", "card", "phone", "iban")
    out = out.withColumns({"account": clear(numbers, known), "local": clear(F.col("local"), known)})
    return out.withColumns({kind: F.filter(kind, sure(kind)) for kind in ADDED}).drop("number", "digits")


def sure(kind: str):
    return lambda span: score(kind, span) >= NEEDED


def score(kind: str, span: Column) -> Column:
    """Confidence in a span: what its kind starts with, more beside a word that speaks for it."""
    if kind not in CONTEXT:
        return F.lit(START[kind])
    return F.lit(START[kind]) + F.when(near(F.col("text"), span).rlike(CONTEXT[kind]), BONUS).otherwise(0.0)


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by kind as listed, then start."""

    def named(kind: str):
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string"))

    each = [F.transform(kind, named(kind)) for kind in kinds]
    return F.concat_ws(",", reduce(lambda a, b: F.concat(a, b), each))


def findings(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = detect(docs)
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(BASE), 256).alias("base_sha256"), listed((*BASE, *ADDED)).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind in brackets; of spans that
    overlap the first in order of kind stays."""
    found = detect(docs)

    def tagged(rank: int, kind: str):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"), F.lit(f"[{kind}]").alias("tag"))

    spans_of_all = reduce(lambda a, b: F.concat(a, b), [F.transform(kind, tagged(rank, kind)) for rank, kind in enumerate((*BASE, *ADDED))])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def add(state: Column, span: Column) -> Column:
        free = span["start"] >= state["at"]
        grown = F.concat(state["out"], F.substr(text, state["at"] + 1, span["start"] - state["at"]), span["tag"])
        return F.struct(F.when(free, span["stop"]).otherwise(state["at"]).alias("at"), F.when(free, grown).otherwise(state["out"]).alias("out"))

    done = F.aggregate(F.sort_array(spans_of_all), zero, add, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1)))
    return found.select("doc_id", done.alias("text"))
