"""Personal data spans, with SQL functions only.

Regular expressions propose spans, checksums and value ranges confirm them, and
context words shortly before a span raise its score. Spans are code point
offsets, found per kind from left to right without overlap; kinds may overlap
each other. The base kinds are facts of their pattern and check and are always
kept; the further kinds need ``MIN_SCORE``.

Offsets without a user function: the text is split at the matches, so a match
starts after the lengths of all gaps and matches before it. The patterns use
possessive groups and guarded starts: no recursion and no quadratic search on
long runs of digits or letters.

Edge cases: null or empty text has no spans; texts of any length are read
whole; repeated rows give repeated results; other columns are kept, but for a
column named ``pii``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.5
#: Characters before a span in which context words count, and what one adds.
CONTEXT_CHARS, CONTEXT_SCORE = 40, 0.4
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,score:double>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a digit string."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + let(
        F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
        lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """ISO 7064 mod 97-10 of letters and digits, first four moved to the end."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: proposal, a cheap test that a text may have it,
    confirmation of a match, score without context, context words."""

    name: str
    pattern: str
    may_have: Callable[[Column], Column]
    confirm: Callable[[Column], Column] = field(default=lambda m: F.lit(True))
    score: float = 1.0
    context: str = ""


_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
BASE = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), context="mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
         context="ip|address|adresse|host"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
         lambda m: let(_digits(m), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)),
         context="card|karte|carte|tarjeta|visa|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda t: F.contains(t, F.lit("+")), lambda m: F.length(_digits(m)).between(10, 15),
         context="phone|tel|call|mobil"),
]
MORE = [
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
         lambda m: let(F.regexp_replace(m, " ", ""), lambda c: F.when(F.length(c).between(15, 34), mod97(c)).otherwise(False)),
         score=0.8, context="iban|account|konto|compte|cuenta|bank"),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), score=0.3, context="ssn|social security"),
    Kind("secret", r"(?<=[\x22'])[0-9A-Za-z+/_-]{20,}+(?=[\x22'])",
         lambda t: t.rlike(r"[\x22'][0-9A-Za-z+/_-]{20}"), score=0.3,
         context="token|secret|password|passwd|api.?key|key"),
]
KINDS = BASE + MORE


def _offsets(lengths: Column, block: int = 128) -> Column:
    """Sums of all lengths before each place, in blocks: linear but for a small
    factor, however many there are."""
    add = lambda acc, x: acc + x
    n = F.size(lengths)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int"))
    sums = F.transform(blocks, lambda b: F.aggregate(F.slice(lengths, b * block + 1, F.lit(block)), F.lit(0), add))
    return let(sums, lambda s: let(
        F.transform(s, lambda _, b: F.aggregate(F.slice(s, F.lit(1), b), F.lit(0), add)),
        lambda base: F.transform(lengths, lambda _, i: base[F.floor(i / block).cast("int")] + F.aggregate(
            F.slice(lengths, i - i % block + 1, i % block), F.lit(0), add))))


def _found(text: Column, no: int, kind: Kind) -> Column:
    none = F.array().cast(f"array<{SPAN}>")

    def span(m: Column, start: Column) -> Column:
        before = F.greatest(start - CONTEXT_CHARS, F.lit(0))
        score = F.lit(float(kind.score))
        if kind.score < 1:
            near = F.lower(F.substring(text, before + 1, start - before)).rlike(rf"(?:{kind.context})")
            score = score + F.when(near, min(CONTEXT_SCORE, 1 - kind.score)).otherwise(0.0)
        return F.struct(start.alias("start"), F.lit(no).alias("kind_no"), (start + F.length(m)).alias("end"),
                        F.lit(kind.name).alias("kind"), F.when(kind.confirm(m), score).otherwise(0.0).alias("score"))

    def spans(b: Column) -> Column:
        lengths = F.transform(b["m"], lambda m, i: F.length(b["gap"][i]) + F.length(m))
        starts = let(lengths, lambda x: _offsets(x))
        return let(starts, lambda at: F.transform(b["m"], lambda m, i: span(m, at[i] + F.length(b["gap"][i]))))

    matches = F.struct(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("m"),
                       F.split(text, kind.pattern, -1).alias("gap"))
    found = let(matches, lambda b: F.when(F.size(b["m"]) > 0, spans(b)).otherwise(none))
    return F.when(kind.may_have(text), F.filter(found, lambda s: s["score"] >= MIN_SCORE)).otherwise(none)


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``pii``: spans ``(start, kind_no, end, kind, score)`` by
    start, then kind as listed in ``KINDS``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = [_found(text, i, k) for i, k in enumerate(KINDS)]
    return docs.withColumn("pii", F.array_sort(F.concat(*found)))


def of_kind(spans: str, kind_no: int) -> Column:
    """Number of spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["kind_no"] == kind_no))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs(text, pii)`` with each span in ``text`` replaced by its kind in
    square brackets (overlapping spans by that of the first)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.array(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("pii", start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return docs.withColumn("text", F.when(F.size("pii") > 0, clean).otherwise(F.col("text")))
