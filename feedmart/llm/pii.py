"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

DataFrame functions only. Each kind's pattern is applied to the whole text, leftmost and non-overlapping;
``split`` gives the text between the matches, ``regexp_extract_all`` the matches, and their lengths
the positions in code points. A proposal that its validator refuses is dropped without a retry.

Kinds: the base kinds email, ip (parts up to 255), card (14 to 19 digits, Luhn) and phone (international, 10 to 15
digits) are always kept. The method adds iban (mod-97), local phone numbers (kind local) and ssn; these
are kept when their score, the prior of the kind plus CONTEXT_GAIN if one of the kind's context
words stands within CONTEXT characters before or after the span (other spans between them or not), reaches LEAST_SCORE.

Defined results: null or empty text has no spans. A text of any length is read whole. Other columns stay
as they are; the added column is named by ``out_col``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

CONTEXT = 48
CONTEXT_GAIN = 0.35
LEAST_SCORE = 0.6
BLOCK = 256


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _octets(hit: Column) -> Column:
    return F.forall(F.split(hit, "\\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (F.lit(1) + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)
    chars = F.split(F.reverse(digits), "")
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _card(hit: Column) -> Column:
    return let(_digits(hit), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))


def _phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(10, 15)


def mod97(hit: Column) -> Column:
    """ISO 7064 mod 97-10: the first four characters go last, letters count as 10 to 35, the rest is 1."""
    chars = let(F.regexp_replace(hit, " ", ""),
                lambda s: F.split(F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4)), ""))

    def step(acc: Column, c: Column) -> Column:
        v = F.conv(c, 36, 10).cast("int")
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(chars, F.lit(0), step) == 1


def _any(_: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a cheap test: a text without this pattern has no span of the kind
    valid: Callable[[Column], Column]
    prior: float
    words: str
    least: int  # characters of the shortest match
    base: bool = False


# A possessive run that may not start inside another run finds the same spans as the plain greedy pattern
# (a shorter start meets the same obstacle) and reads a long run once instead of once per character.
KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", _any, 0.8, "mail|contact|write", 5, True),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _octets, 0.7, "ip|host|server|address", 7, True),
    Kind("card", r"[0-9]++(?:[ -][0-9]++)++|[0-9][0-9]++", "", _card, 0.8, "card|visa|credit|payment|account", 2, True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", _phone, 0.7, "phone|tel|call|fax|mobile", 4, True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", mod97,
         0.7, "iban|account|bank|konto|compte", 12),
    Kind("local", r"(?<![0-9+(]|[0-9+][ (.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", "", _any, 0.3,
         "phone|tel|call|fax|mobile", 12),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", _any, 0.3, "ssn|social security|tax id", 11),
]
KIND_NAMES = [k.name for k in KINDS]
SPAN = "array<struct<start:long,kind_no:int,end:long,score:double>>"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y.cast("long"))


def _starts(gaps: Column, hits: Column) -> Column:
    """Start of each hit: prefix sums in blocks of BLOCK, so that the work stays linear in the hits."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), F.transform(hits, lambda h: F.length(h)), lambda g, h: g + h)

    def with_steps(s: Column) -> Column:
        n_blocks = F.ceil(F.size(s) / F.lit(BLOCK)).cast("int")
        sums = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: _sum(F.slice(s, b * BLOCK + 1, F.lit(BLOCK))))
        base = let(sums, lambda t: F.transform(t, lambda _, b: _sum(F.slice(t, F.lit(1), b))))
        return let(base, lambda bs: F.transform(s, lambda _, i: (
            F.get(bs, F.floor(i / F.lit(BLOCK)).cast("int"))
            + _sum(F.slice(s, F.floor(i / F.lit(BLOCK)).cast("int") * BLOCK + 1, i % BLOCK)) + F.get(gaps, i))))
    return let(steps, with_steps)


def _spans_of(text: Column, kind: Kind, number: int) -> Column:
    none = F.array().cast(SPAN)

    def build(v: Column) -> Column:
        gaps = F.transform(v["parts"], lambda p: F.length(p))
        left = F.transform(v["parts"], lambda p: F.lower(F.right(p, F.lit(CONTEXT))))
        right = F.transform(v["parts"], lambda p: F.lower(F.left(p, F.lit(CONTEXT))))
        rows = lambda w: F.transform(w["starts"], lambda s, i: F.struct(
            s.cast("long").alias("start"), F.lit(number).alias("kind_no"),
            (s + F.length(F.get(w["hits"], i))).cast("long").alias("end"),
            F.when(kind.valid(F.get(w["hits"], i)), _score(w, i, kind)).alias("score")))
        return let(F.struct(gaps.alias("gaps"), left.alias("left"), right.alias("right"), v["hits"].alias("hits")),
                   lambda u: let(F.struct(
                       _starts(u["gaps"], u["hits"]).alias("starts"), u["hits"].alias("hits"), u["left"].alias("left"), u["right"].alias("right"),
                       # the pieces from a gap to the end of its hit, and from a hit to the end of the gap after it
                       F.transform(u["hits"], lambda h, i: F.concat(F.get(u["left"], i), F.lower(h))).alias("to"),
                       F.transform(u["hits"], lambda h, i: F.concat(F.lower(h), F.get(u["right"], i + 1))).alias("on")), rows))
    found = let(F.struct(F.split(text, kind.pattern, -1).alias("parts"),
                         F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hits")),
                lambda v: F.when(F.size(v["hits"]) > 0, build(v)))
    spans = F.filter(found, lambda s: s["score"].isNotNull() if kind.base else s["score"] >= LEAST_SCORE)
    likely = F.contains(text, F.lit(kind.needs)) if kind.needs else F.lit(True)
    if kind.needs != "@":
        likely = likely & F.col("__has_digit")
    return F.coalesce(F.when(likely, spans), none)


def _score(w: Column, i: Column, kind: Kind) -> Column:
    """Score of a confirmed match. Its context is put together from the pieces around it: of matches that have ``least`` characters at least,
    so many lie within CONTEXT characters at most."""
    n = -(-CONTEXT // kind.least)
    before = F.concat(F.array_join(F.slice(w["to"], F.greatest(i - n, F.lit(0)) + 1, F.least(i, F.lit(n))), ""), F.get(w["left"], i))
    after = F.concat(F.get(w["right"], i + 1), F.array_join(F.slice(w["on"], i + 2, F.lit(n)), ""))
    word = rf"\b(?:{kind.words})"
    near = F.right(before, F.lit(CONTEXT)).rlike(word) | F.left(after, F.lit(CONTEXT)).rlike(word)
    return F.lit(kind.prior) + F.when(near, CONTEXT_GAIN).otherwise(0.0)


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: all kept spans (start, kind_no, end, score) by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__has_digit", text.rlike("[0-9]"))
    spans = [_spans_of(text, k, n) for n, k in enumerate(KINDS)]
    return out.withColumn(out_col, F.sort_array(F.concat(*spans))).drop("__has_digit")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(n) for n in KIND_NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans as text."""
    base = [n for n, k in enumerate(KINDS) if k.base]
    rows = find_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", "pii")
    count = lambda n: F.size(F.filter("pii", lambda s: s["kind_no"] == n)).cast("long")
    return rows.select("doc_id", *[count(n).alias(f"n_{KINDS[n].name}") for n in base],
                       F.sha2(joined(F.filter("pii", lambda s: s["kind_no"] < len(base))), 256).alias("base_sha256"),
                       joined(F.col("pii")).alias("spans"))


def _merged(spans: Column) -> Column:
    """Spans by start in, maximal disjoint spans out; an overlap keeps the kind of the earlier span. The largest end so far comes
    from blocks of BLOCK spans, so the work is linear in the spans."""
    def largest(ends: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.ceil(F.size(ends) / F.lit(BLOCK)).cast("int") - 1)
        tops = F.transform(blocks, lambda b: F.array_max(F.slice(ends, b * BLOCK + 1, F.lit(BLOCK))))
        base = let(tops, lambda t: F.transform(t, lambda _, b: F.array_max(F.slice(t, F.lit(1), b))))
        return let(base, lambda bs: F.transform(ends, lambda _, i: F.greatest(  # greatest skips the null of the first block
            F.get(bs, F.floor(i / F.lit(BLOCK)).cast("int")),
            F.array_max(F.slice(ends, F.floor(i / F.lit(BLOCK)).cast("int") * BLOCK + 1, i % BLOCK + 1)))))

    def disjoint(v: Column) -> Column:
        begins = lambda s, i: (i == 0) | (s["start"] >= F.get(v["top"], i - 1))
        places = F.filter(F.transform(v["spans"], lambda s, i: F.when(begins(s, i), i)), lambda i: i.isNotNull())
        return let(places, lambda p: F.transform(p, lambda at, j: F.struct(
            F.get(v["spans"], at)["start"].alias("start"), F.get(v["spans"], at)["kind_no"].alias("kind_no"),
            F.get(v["top"], F.coalesce(F.get(p, j + 1), F.size(v["spans"])) - 1).alias("end"))))
    return let(spans, lambda s: let(F.struct(s.alias("spans"), let(F.transform(s, lambda x: x["end"]), largest).alias("top")), disjoint))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, e.g. ``[EMAIL]``; null texts stay null.

    ``length_col``, if the table has it, becomes the length of the new text.
    """
    names = F.array(*[F.lit(f"[{n.upper()}]") for n in KIND_NAMES])

    def rebuilt(v: Column) -> Column:
        cut = lambda a, b: F.array_join(F.slice(v["chars"], a + 1, F.greatest(b - a, F.lit(0))), "")
        prev = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(v["spans"], i - 1)["end"].cast("int"))
        body = F.transform(v["spans"], lambda s, i: F.concat(cut(prev(i), s["start"].cast("int")), F.get(names, s["kind_no"])))
        tail = cut(F.element_at(v["spans"], -1)["end"].cast("int"), F.size(v["chars"]))
        return F.concat(F.array_join(body, ""), tail)
    out = find_pii(docs, text_col, "__pii")
    new = F.when(F.size("__pii") == 0, F.col(text_col)).otherwise(
        let(F.struct(F.split(F.col(text_col), "").alias("chars"), _merged(F.col("__pii")).alias("spans")), rebuilt))
    out = out.withColumn(text_col, new).drop("__pii")
    if length_col and length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)


__all__ = ["KINDS", "KIND_NAMES", "digest", "find_pii", "joined", "luhn", "mod97", "redact"]
