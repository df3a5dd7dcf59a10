"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is built from Spark's own functions. A pattern is only run over texts that hold the
character it cannot do without. Quantifiers are possessive and every start is bounded, so the time
for a text is proportional to its length, also for endless runs of digits or letters.

Spans are found as matches and the gaps between them: both the list of matches and the split of
the text scan from the left without overlap, so running sums of their lengths are the offsets.
Offsets count code points, ends are exclusive.

Kinds: ``email``, ``ip`` (four parts up to 255), ``card`` (14 to 19 digits, Luhn), ``phone`` (10 to
15 digits after a plus sign); the method adds ``iban`` (mod-97) and ``ssn`` (issued ranges only).
Each span has a score: what the validator alone is worth, more when a word that goes with the
kind stands in the 40 characters before it, less when none does and the validator is weak.

NULL and empty texts have no spans. Repeated rows give repeated results, an empty table an empty
one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40


@dataclass(frozen=True)
class Kind:
    """``gate`` is a cheap test that every text with a match passes."""

    name: str
    pattern: str
    gate: str
    worth: float
    words: tuple[str, ...]


_MAIL = "A-Za-z0-9._%+-"
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.8,
        ("mail", "contact", "write"),
    ),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.5, ("ip", "host", "server", "address")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}", 0.8, ("card", "visa", "credit", "payment")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, ("phone", "call", "tel", "mobile", "fax")),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
        0.9,
        ("iban", "account", "bank", "transfer"),
    ),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", 0.4, ("ssn", "social", "security")),
)
BASE = 4


def luhn(digits: Column) -> Column:
    """Whether a string of at most 20 digits has a valid Luhn check digit."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for place in range(20):
        value = F.substring(padded, 20 - place, 1).cast("int")
        if place % 2:
            value = value * 2 - F.when(value > 4, 9).otherwise(0)
        total = total + value
    return total % 10 == 0


def mod97(compact: Column) -> Column:
    """Whether country, check digits and account number leave the remainder 1."""
    moved = F.concat(compact.substr(F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
    letters = F.filter(F.split(moved, ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        number = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.pmod(rest * F.when(c.between("0", "9"), 10).otherwise(100) + number, F.lit(97))

    return F.aggregate(letters, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        compact = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(compact).between(15, 34) & mod97(compact)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def spans_of(text: Column, rank: int, kind: Kind) -> Column:
    """Array of (start, rank, end) of the confirmed matches of one kind."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    pieces = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), matches.alias("match"))
    pieces = F.filter(pieces, lambda p: p["match"].isNotNull())
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int>>)")
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["gap"])
        end = start + F.length(piece["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        more = F.when(confirmed(kind.name, piece["match"]), F.array(span)).otherwise(none)
        return F.struct(end.alias("at"), F.concat(done["found"], more).alias("found"))

    plain = len(kind.gate) == 1
    gate = text.contains(kind.gate) if plain else text.rlike(kind.gate)
    return F.when(gate, F.aggregate(pieces, begin, step, lambda done: done["found"])).otherwise(none)


def counted(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def score(text: Column, span: Column) -> Column:
    """The validator's worth, plus 0.15 with a fitting word before the span, minus 0.1 without."""
    from_ = F.greatest(span["start"] - NEAR, F.lit(0))
    near = F.lower(text.substr(from_ + 1, span["start"] - from_))
    value = F.lit(0.0)
    for rank, kind in enumerate(KINDS):
        helped = F.lit(False)
        for word in kind.words:
            helped = helped | near.contains(word)
        value = F.when(span["rank"] == rank, F.lit(kind.worth) + F.when(helped, 0.15).otherwise(-0.1)).otherwise(value)
    return F.round(F.least(value, F.lit(1.0)), 2)


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the four plain kinds, the digest of their spans, all spans and scores."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    found = named.withColumn("found", F.array_sort(F.concat(*[spans_of(F.col("text"), r, k) for r, k in enumerate(KINDS)])))
    base = found.withColumn("base", F.filter("found", lambda s: s["rank"] < BASE))
    counts = [counted(F.col("base"), r).alias(f"n_{KINDS[r].name}") for r in range(BASE)]
    return base.select(
        F.col("id").alias(id_col),
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.transform("found", lambda s: score(F.col("text"), s)).alias("scores"),
    )
