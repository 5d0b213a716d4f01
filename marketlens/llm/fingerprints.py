"""Homomorphic multiset hash of a text's paragraphs.

A text is cut after every newline and after every space that follows a punctuation mark; the pieces
joined in order are the text again. Each piece is hashed to a wide vector of 0/1 lanes, and the
fingerprint of a text is the sum of the vectors of its pieces: lanes of 30 bits, two to a word,
modulo 2^60 per word, behind three words that count the pieces and sum their full hashes. So the
fingerprint does not depend on the order of pieces, and pieces are put in or taken out by adding or
subtracting their vectors. All steps are built-in expressions: pieces become rows, and the sums are
made in each task before anything is shuffled.

Likeness: each lane of a text with n pieces is about binomial(n, 1/2), so 2 * lane - n has mean 0,
and sums of products over the lanes estimate how many pieces two texts share. The cosine of the two
vectors, not below 0, is the likeness; equal fingerprints give 1.

Defined cases: a null text is the empty text, whose fingerprint is the zero vector; two texts
without pieces are alike (1), a text with pieces and one without are not (0); the next document of
a row is the next row by doc_id (null last), then by a hash of the text and the text; rows that are
equal follow each other; a single row is its own next; an empty table gives an empty table. Other
columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import LAST_ID, documents

HASHES = 3
SHIFTS = 24
#: A lane has room for 2^30 - 1 pieces, more than a text has.
LANE_BITS = 30
PER_WORD = 2
LANES = HASHES * SHIFTS * PER_WORD
HEAD = 3
WIDTH = HEAD + HASHES * SHIFTS
#: Cut after a newline, and after a space behind a mark that is no letter, digit or space.
CUT = r"(?<=\n)|(?<=[^\p{L}\p{N}\s] )"
#: Rows that one neighbour group holds, about.
GROUP_ROWS = 2_000
MAX_GROUPS = 100_000
_LANES = (1 << LANE_BITS) | 1
_LANE = (1 << LANE_BITS) - 1
_WORD = (1 << 60) - 1


def _mod(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_WORD))


def pieces(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), CUT), "")


def vectors(df: DataFrame, texts: dict[str, str], *keys: str) -> DataFrame:
    """One row per ``keys`` with a vector for each text column of ``texts`` (column: name).

    Where ``df`` is already dealt by one of the keys, the sums need no other exchange.

    No lane carries into the next: Spark holds a text's pieces in one array, of fewer bytes than 2^31
    at 8 and more a piece.
    """
    def marked(i: int, text: str) -> Column:
        return F.transform(pieces(F.col(text)), lambda x: F.struct(F.lit(i).alias("i"), x.alias("p")))

    both = F.concat(*[marked(i, t) for i, t in enumerate(texts)])
    # A piece of length 0 keeps texts without pieces in the result.
    none = F.array(*[F.struct(F.lit(i).alias("i"), F.lit("").alias("p")) for i in range(len(texts))])
    rows = df.select(*keys, F.explode(F.concat(none, both)).alias("_p"))
    rows = rows.select(*keys, F.col("_p.i").alias("_i"), (F.col("_p.p") != "").alias("_some"), *[F.xxhash64("_p.p", F.lit(i)).alias(f"_h{i}") for i in range(HASHES)])
    rows = rows.withColumns({f"_h{i}": F.when(F.col("_some"), F.col(f"_h{i}")).otherwise(F.lit(0).cast("bigint")) for i in range(HASHES)})
    low = F.lit((1 << 30) - 1)
    sums = [F.sum(F.col("_some").cast("bigint")), F.sum(F.col("_h0").bitwiseAND(low)), F.sum(F.shiftrightunsigned("_h0", 34))]
    sums += [F.sum(F.shiftrightunsigned(f"_h{i}", k).bitwiseAND(F.lit(_LANES))) for i in range(HASHES) for k in range(SHIFTS)]
    summed = rows.groupBy(*keys, "_i").agg(*[x.alias(f"_s{k}") for k, x in enumerate(sums)])
    vector = F.array(*[_mod(F.col(f"_s{k}")) for k in range(WIDTH)])
    summed = summed.select(*keys, "_i", vector.alias("_v"))
    return summed.groupBy(*keys).agg(*[F.first(F.when(F.col("_i") == i, F.col("_v")), True).alias(name) for i, name in enumerate(texts.values())])


def combine(a: Column, b: Column) -> Column:
    """Fingerprint of two texts together: insertion. Words add modulo 2^60."""
    return F.zip_with(a, b, lambda x, y: _mod(x + y))


def remove(a: Column, b: Column) -> Column:
    """Fingerprint after taking the pieces of ``b`` out of ``a``: deletion."""
    return F.zip_with(a, b, lambda x, y: _mod(x - y))


def as_text(vector: Column) -> Column:
    """Lowercase hex, 15 characters a word."""
    return F.lower(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 15, "0")), ""))


def centred(vector: Column) -> Column:
    """Lanes as signed numbers: 2 * count - pieces."""
    n = F.get(vector, F.lit(0))
    words = F.slice(vector, HEAD + 1, HASHES * SHIFTS)
    lane = lambda x, k: F.shiftrightunsigned(x, LANE_BITS * k).bitwiseAND(F.lit(_LANE)) * 2 - n
    return F.flatten(F.transform(words, lambda x: F.array(*[lane(x, k) for k in range(PER_WORD)])))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: (x * y).cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def likeness(df: DataFrame, name: str, a: str, b: str) -> DataFrame:
    """Add the likeness of the vectors ``a`` and ``b``, from their columns ``a_c`` and ``b_c``."""
    cosine = F.try_divide(_dot(F.col(f"{a}_c"), F.col(f"{b}_c")), F.sqrt(F.col(f"{a}_s") * F.col(f"{b}_s")))
    value = F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(cosine, F.lit(0.0)))))
    return df.withColumn(name, value)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (``doc_id``, ``text``) with ``next_text`` and ``_group``, in the order of doc_id.

    Texts are dealt once, to groups of consecutive ids; the first row of each group is sent to the
    group before it as well. Group bounds come from a quantile summary: at most ``MAX_GROUPS``
    numbers reach the driver.
    """
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col("doc_id"), text.alias("text"), place.alias("_place"), F.xxhash64(text).alias("_t"))
    ids = cut_lineage(df.select("_place", "_t"))
    n = ids.count()
    groups = max(1, min(MAX_GROUPS, n // GROUP_ROWS))
    steps = [i / groups for i in range(1, groups)]
    bounds = ids.agg(F.percentile_approx("_place", steps, 10 * groups)).first()[0] if steps else []
    edges = sorted(set(bounds or []))
    group = _bucket(edges)
    # The first row of every group that has rows, and the group before it.
    firsts = ids.withColumn("_group", group).groupBy("_group").agg(F.min(F.struct("_place", "_t")).alias("_first"))
    heads = [(r["_group"], r["_first"]["_place"], r["_first"]["_t"]) for r in firsts.orderBy("_group").collect()]
    if not heads:
        return df.select("doc_id", "text", "_place", "_t").withColumns({"next_text": F.lit(""), "_group": F.lit(0)})
    spark = docs.sparkSession
    before = [(heads[i - 1][0], *heads[i][1:]) for i in range(len(heads))]
    sent = spark.createDataFrame(before, "_to int, _place bigint, _t bigint")
    # The last group ends with the first row of all; one copy of a repeated head is enough.
    copies = df.join(F.broadcast(sent), ["_place", "_t"]).select("doc_id", "text", "_place", "_t", F.col("_to").alias("_group"), F.lit(1).alias("_guest"))
    copies = copies.dropDuplicates(["_group"])
    rows = df.select("doc_id", "text", "_place", "_t", group.alias("_group"), F.lit(0).alias("_guest")).unionByName(copies)
    order = Window.partitionBy("_group").orderBy("_guest", "_place", "_t", "text")
    return rows.withColumn("next_text", F.lead("text").over(order)).filter("_guest = 0").drop("_guest")


def _bucket(edges: list[int]) -> Column:
    """How many of the sorted ``edges`` are at most ``_place``, by halving."""
    if not edges:
        return F.lit(0)
    array = F.array(*[F.lit(e) for e in edges])
    low, high = F.lit(0), F.lit(len(edges))
    state = F.struct(low.alias("low"), high.alias("high"))
    for_each = F.sequence(F.lit(1), F.lit(len(edges).bit_length()))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        open_ = s["low"] < s["high"]
        right = F.get(array, middle) <= F.col("_place")
        return F.struct(
            F.when(open_ & right, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(open_ & ~right, middle).otherwise(s["high"]).alias("high"),
        )

    return F.aggregate(for_each, state, halve, lambda s: s["low"])


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    df = with_next(documents(spark, folder, "doc_id", "text"))
    n = F.length("text").cast("bigint")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))
    df = df.withColumns({"n_chars": n, "edited": edited, "edited_sha256": F.sha2(edited, 256)})
    # What the result needs of a row goes along as one key column with its number; rows stay in the task
    # of their neighbour group, so their pieces are summed there.
    row = F.struct(F.monotonically_increasing_id().alias("id"), "doc_id", "n_chars", "edited_sha256")
    df = vectors(df.withColumn("_row", row), {"text": "v", "edited": "e", "next_text": "x"}, "_group", "_row")
    df = df.select("_row.*", "v", "e", "x")
    for name in ("v", "e", "x"):
        df = df.withColumn(f"{name}_c", centred(F.col(name)))
    for name in ("v", "e", "x"):
        df = df.withColumn(f"{name}_s", _dot(F.col(f"{name}_c"), F.col(f"{name}_c")))
    df = likeness(likeness(df, "near_edited", "v", "e"), "near_next", "v", "x")
    return df.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("v")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
