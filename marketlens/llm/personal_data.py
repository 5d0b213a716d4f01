"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Every kind has a pattern and a test (number of digits, Luhn, mod 97, parts at most 255). The four
base kinds are always reported; their score only tells how sure they are. Added kinds (bank account
numbers by mod 97, and card or phone like numbers announced by a context word) are reported from a
score limit on and where they do not overlap an earlier span. All steps are built-in expressions.

Places come from the pattern alone: splitting a text by a pattern gives the gaps between its
matches, so running sums of the lengths of gaps and matches are the places, in code points. The sums are
kept by blocks, context is read from the gaps around a match, and overlaps are looked up by halving, so a
text of very many matches takes time in proportion to them.
Patterns use possessive repeats and may only begin where a run of their characters begins (or where
the match before ended), which finds the same leftmost matches in time linear in the text.

Defined cases: a null or empty text has no spans; repeated rows each get their own result; an empty
table gives an empty table; other columns pass through, and those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "number": r"(?<![0-9A-Za-z.+-])[(]?[0-9](?:[\x20().-]{0,2}[0-9])++",
}
BASE = ("email", "ip", "card", "phone")
#: What a text with a span of a kind holds; others are not searched.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "number": r"(?i)\b(?:phone|call|tel|telephone|mobile|fax)\b"}
#: Words that speak for a kind when they stand within ``NEAR`` characters before a span.
CONTEXT = {
    "email": "(?i)e-?mail|contact|write",
    "ip": "(?i)address|host|server",
    "card": "(?i)card|visa|credit|debit",
    "phone": "(?i)phone|call|tel|mobile|fax",
    "iban": "(?i)iban|account|bank|konto|compte|cuenta",
    "number": r"(?i)\b(?:phone|call|tel|telephone|mobile|fax)\b",
}
#: Score of a span without context, and what a context word adds.
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "number": 0.2}
BONUS = 0.2
BONUS_NUMBER = 0.4
LIMIT = 0.5
NEAR = 40
#: A gap and its match have three characters at least, so ``NEAR`` characters lie in so many of them.
BACK = 14
#: Numbers that are summed one after the other in a block of running sums.
SUMS = 64


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Luhn checksum of the digits of ``text``: every second digit from the right is doubled."""
    plain = F.reverse(digits(text))
    place = F.sequence(F.lit(1), F.length(plain))
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def add(total: Column, i: Column) -> Column:
        d = F.substring(plain, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, F.get(doubled, d)).otherwise(d)

    return F.aggregate(place, F.lit(0), add) % 10 == 0


def mod97(text: Column) -> Column:
    """Checksum of a bank account number: the first four characters go last, letters count from 10."""
    plain = F.regexp_replace(text, r"\x20", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    place = F.sequence(F.lit(1), F.length(moved))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 58, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    return F.aggregate(place, F.lit(0), add) == 1


def parts_fit(text: Column) -> Column:
    """Every part of a dotted number is at most 255, however many zeros lead it."""
    return F.forall(F.split(text, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        F.split(text, r"\."), lambda p: F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 4).try_cast("int"), F.lit(0)) <= 255
    )


def confirmed(kind: str, text: Column) -> Column:
    n = F.length(digits(text))
    if kind == "ip":
        return parts_fit(text)
    if kind == "card":
        return F.when(n.between(14, 19), luhn(text)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(text, r"\x20", "")).between(15, 34) & mod97(text)
    if kind == "number":
        return n.between(9, 12)
    return F.lit(True)


def _matches(df: DataFrame, kind: str) -> DataFrame:
    """Add ``_kind``: confirmed matches (``from``, ``to``, ``score``) in order, or an empty array."""
    pattern, text, name = PATTERNS[kind], F.col("_text"), f"_{kind}"
    wanted = text.rlike(NEEDS[kind])
    df = df.withColumn("_m", F.when(wanted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    # Only texts with matches are split, and only by the pattern that matched.
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(text, pattern, -1)))
    df = df.withColumn("_n", F.zip_with("_m", F.slice("_g", F.lit(1), F.size("_m")), lambda m, g: F.length(g) + F.length(m)))
    df, end = _running(df, "_n")
    spans = F.transform("_m", lambda m, i: F.struct(i.alias("i"), (end(i) - F.length(m)).alias("from"), end(i).alias("to"), m.alias("text")))
    df = df.withColumn("_s", F.filter(spans, lambda x: confirmed(kind, x["text"])))

    def before(i: Column) -> Column:
        """The last ``NEAR`` characters before match i, from the gaps and matches before it."""
        some = F.sequence(F.greatest(i - BACK, F.lit(0)), i)
        parts = F.transform(some, lambda j: F.concat(F.when(j > 0, F.get("_m", j - 1)).otherwise(""), F.get("_g", j)))
        return F.right(F.array_join(parts, ""), F.lit(NEAR))

    def score(x: Column) -> Column:
        bonus = BONUS_NUMBER if kind == "number" else BONUS
        return F.lit(START[kind]) + F.when(before(x["i"]).rlike(CONTEXT[kind]), bonus).otherwise(0.0)

    scored = F.transform("_s", lambda x: F.struct(x["from"].alias("from"), x["to"].alias("to"), score(x).alias("score")))
    empty = F.array().cast("array<struct<from:int,to:int,score:double>>")
    return df.withColumn(name, F.coalesce(scored, empty)).drop("_m", "_g", "_n", "_s", *_LEVELS)


_LEVELS = ("_r1", "_r2", "_r3")


def _sums(lengths: Column) -> Column:
    """Running sums of a short array."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(
        lengths,
        start,
        lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all")),
        lambda s: s["all"],
    )


def _running(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Running sums of an array column: columns that hold them, and the sum up to an index.

    Sums are kept per block of ``SUMS`` numbers, per block of blocks, and over these, so an array of n
    numbers costs n times a constant, not its square.
    """
    def blocks(values: str, of: Callable[[Column], Column]) -> Column:
        last = F.floor((F.size(values) - 1) / SUMS).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda b: _sums(F.transform(F.slice(values, b * SUMS + 1, F.lit(SUMS)), of)))
        return F.when(F.size(values) > 0, cut)

    total = lambda block: F.element_at(block, -1)
    df = df.withColumn("_r1", blocks(name, lambda x: x))
    df = df.withColumn("_r2", blocks("_r1", total))
    df = df.withColumn("_r3", _sums(F.transform("_r2", total)))

    def block(i: Column) -> Column:
        return F.floor(i / SUMS).cast("int")

    def of_blocks(i: Column) -> Column:
        """Sum of the blocks up to i."""
        higher = F.when(block(i) > 0, F.get("_r3", block(i) - 1)).otherwise(0)
        return F.get(F.get("_r2", block(i)), i % SUMS) + higher

    def upto(i: Column) -> Column:
        return F.get(F.get("_r1", block(i)), i % SUMS) + F.when(block(i) > 0, of_blocks(block(i) - 1)).otherwise(0)

    return df, upto


def _clear(x: Column, spans: str) -> Column:
    """No span of a sorted array without overlaps meets ``x``, by halving."""
    array = F.col(spans)
    start = F.struct(F.lit(0).alias("low"), F.size(array).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        open_ = s["low"] < s["high"]
        right = F.get(array, middle)["from"] < x["to"]
        return F.struct(
            F.when(open_ & right, middle + 1).otherwise(s["low"]).alias("low"), F.when(open_ & ~right, middle).otherwise(s["high"]).alias("high")
        )

    before = F.aggregate(F.sequence(F.lit(1), F.lit(31)), start, halve, lambda s: s["low"])
    return F.size(array).eqNullSafe(0) | ~F.coalesce(F.get(array, before - 1)["to"] > x["from"], F.lit(False))


def _labelled(kind: str, order: int) -> Column:
    return F.transform(
        F.col(f"_{kind}"),
        lambda x: F.struct(
            x["from"].alias("from"), F.lit(order).alias("order"), x["to"].alias("to"), F.lit(kind).alias("kind"), x["score"].alias("score")
        ),
    )


def _added(earlier: Sequence[str]) -> Callable[[Column], Column]:
    """Sure enough, and meeting no span of the ``earlier`` kinds."""
    kinds = [f"_{k}" for k in earlier]
    return lambda x: reduce(and_, [_clear(x, k) for k in kinds], x["score"] >= LIMIT)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``all_spans``: arrays of (from, order, to, kind, score), sorted."""
    df = docs.drop("base_spans", "all_spans").withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for kind in PATTERNS:
        df = _matches(df, kind)
    # An added kind gives way to the base kinds and to the kinds added before it.
    earlier = list(BASE)
    for kind in PATTERNS:
        if kind not in BASE:
            df = df.withColumn(f"_{kind}", F.when(F.size(f"_{kind}") > 0, F.filter(f"_{kind}", _added(earlier))).otherwise(F.col(f"_{kind}")))
            earlier.append(kind)
    every = {k: _labelled(k, i) for i, k in enumerate(PATTERNS)}
    df = df.withColumn("base_spans", F.sort_array(F.flatten(F.array(*[every[k] for k in BASE]))))
    added = F.flatten(F.array(*[every[k] for k in PATTERNS if k not in BASE]))
    df = df.withColumn("all_spans", F.when(F.size(added) > 0, F.sort_array(F.concat("base_spans", added))).otherwise(F.col("base_spans")))
    return df.drop("_text", *[f"_{k}" for k in PATTERNS])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["from"], x["to"])), ",")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span of ``all_spans`` by its kind in brackets; overlapping spans as one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.coalesce(F.col(text), F.lit(""))

    def put(s: Column, x: Column) -> Column:
        gap = F.substring(body, s["at"] + 1, F.greatest(x["from"] - s["at"], F.lit(0)))
        mark = F.when(x["from"] >= s["at"], F.concat(gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(s["at"], x["to"]).alias("at"), F.concat(s["out"], mark).alias("out"))

    end = lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body)))
    return df.withColumn(text, F.when(F.size("all_spans") > 0, F.aggregate("all_spans", start, put, end)).otherwise(F.col(text)))


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    df = find(documents(spark, folder, "doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("bigint")
    return df.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.col("all_spans")).alias("spans"),
    )
