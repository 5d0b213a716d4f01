"""Spelling variants: words one edit apart, found in a bit-sliced position index, and their common forms.

The index holds, for every position and letter, the set of words with that letter there as a bit set.
A word is looked up letter by letter, for all words of the index at once: ``zero`` are the words that
agree so far, ``replaced``, ``longer`` and ``shorter`` those with one error so far, whose letters are
read from the sets of the same, the next or the previous position. All four are updated together by a few
word-parallel operations, and many words are looked up side by side.

The vocabulary is cut into blocks in which near words meet. Of two near words the shorter one's length L
and the place e of the error (0 to L) say what they share: the first e letters and the last L - 1 - e. So
the places are cut in two zones, and the words of one length (and one more) that share what a zone asks
for are a bucket. A bucket of more than ``HOT`` words has its zone cut again; a zone of one place leaves two
letters open at most, so this ends, whatever the words. Buckets are packed into blocks by hash.

A word's form is its near word of largest count, if that is twice its own at least; forms have ever
larger counts, so following them ends, and is done by doubling the step each round.

Defined cases: a null text has no words; a null doc_id is written as an empty text where ids are hashed;
repeated rows count as often as they occur; of near words with equal counts the smallest in code-point
order comes first; an empty table gives an empty table; other columns are not carried. A run of any
length is a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, lookup, ship

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in so many, picked by a checksum, loses a letter.
DROPS = 97
#: A form is at least so many times as frequent as the word.
RATIO = 2
#: Words of a block on average, and most words of a bucket whose zone has more than one place. Above
#: 90 + 90 * 90, the words that two open letters of the 90 allow, every bucket gets below it.
BLOCK, HOT = 2048, 8192
#: Bytes of one set of words looked up together.
SET_BYTES = 1 << 19


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of the words of ``docs`` (``doc_id``, ``text``) that are long and frequent enough."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    capital = F.col("run").rlike("[A-Z]")
    run = F.when(capital, F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("run"))
    runs = runs.select("doc_id", run.alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
    runs = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % DROPS == 0, less).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _index(codes: np.ndarray, lengths: np.ndarray, letters: int) -> np.ndarray:
    """Bit sets of the words with each letter at each position, as words of 64 bits."""
    count, positions = codes.shape
    width = -(-count // 64)
    index = np.zeros((positions, letters, width), np.uint64)
    flags = np.zeros((letters, 64 * width), np.uint8)
    for p in range(positions):
        flags[:] = 0
        here = np.flatnonzero(lengths > p)
        flags[codes[here, p], here] = 1
        index[p] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
    return index


def _members(flags: np.ndarray) -> np.ndarray:
    padded = np.zeros(64 * -(-len(flags) // 64), np.uint8)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view(np.uint64)


def _look_up(index: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of ``words``, word of the index) that are one edit apart. All ``words`` have one length."""
    count, size = words.shape
    width = index.shape[2]
    none = np.zeros((count, width), np.uint64)
    zero = np.full((count, width), np.uint64(2**64 - 1))
    replaced, longer, shorter = none.copy(), none.copy(), none.copy()
    for i in range(size):
        letter = words[:, i]
        same = index[i][letter]
        before = index[i - 1][letter] if i else none
        behind = index[i + 1][letter] if i + 1 < len(index) else none
        replaced = (replaced & same) | (zero & ~same)
        shorter = (shorter & before) | zero
        longer = (longer | zero) & behind
        zero = zero & same
    found = (replaced & _members(lengths == size)) | (shorter & _members(lengths == size - 1))
    found |= (longer | zero) & _members(lengths == size + 1)
    row, word = np.nonzero(found)
    bits = np.unpackbits(found[row, word][:, None].view(np.uint8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], word[at] * 64 + bit


def near_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of distinct ``words`` that are one edit apart, in both directions."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    alphabet, flat = np.unique(flat, return_inverse=True)
    starts = np.cumsum(lengths) - lengths
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in np.unique(lengths).tolist():
        members = np.flatnonzero(np.abs(lengths - size) <= 1)
        if len(members) < 2:
            continue
        own = lengths[members]
        place = np.minimum(np.arange(int(own.max())), own[:, None] - 1)
        codes = flat[starts[members][:, None] + place]
        index = _index(codes, own, len(alphabet))
        asked = np.flatnonzero(own == size)
        step = max(1, SET_BYTES // (8 * index.shape[2]))
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            row, other = _look_up(index, own, codes[some, :size])
            first.append(members[some[row]])
            second.append(members[other])
    return np.concatenate(first), np.concatenate(second)


def _block(table: pa.Table) -> pa.Table:
    rows = table.select(["word", "n"]).group_by("word").aggregate([("n", "min")])
    first, second = near_pairs(rows.column("word").to_pylist())
    return pa.table({"word": rows.column("word").take(first), "near": rows.column("word").take(second), "near_n": rows.column("n_min").take(second)})


def _zones(low: Column, high: Column) -> Column:
    """A zone of places cut in two."""
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), high.alias("high")))


def _bucketed(rows: DataFrame) -> DataFrame:
    """The bucket of every word and zone: what words with an error in the zone share."""
    tail = F.greatest(F.col("short") - 1 - F.col("high"), F.lit(0))
    shared = F.struct("short", "low", "high", F.substr("word", F.lit(1), F.col("low")), F.substr("word", F.length("word") - tail + 1, tail))
    return rows.withColumn("bucket", F.xxhash64(shared))


def _buckets(vocabulary: DataFrame, hot: int) -> DataFrame:
    """``word``, ``n``, ``bucket``, so that near words share a bucket of bounded size."""
    length = F.length("word")
    rows = vocabulary.withColumn("short", F.explode(F.array(length, length - 1)))
    split = lambda df, low, high: df.withColumn("_z", F.explode(_zones(low, high))).select("word", "n", "short", "_z.low", "_z.high")
    rows = cut_lineage(_bucketed(split(rows, F.lit(0), F.col("short"))))
    done: DataFrame | None = None
    while True:
        counts = cut_lineage(rows.groupBy("bucket").count().filter("count > 1"))
        fits = lookup(rows, counts, ["bucket"], "inner").select(*rows.columns, "count")
        cuts = (F.col("count") > hot) & (F.col("low") < F.col("high"))
        ready = fits.filter(~cuts).select("word", "n", "bucket")
        done = ready if done is None else done.unionByName(ready)
        if not counts.filter(F.col("count") > hot).limit(1).count():
            return cut_lineage(done)
        large = split(fits.filter(cuts), F.col("low"), F.col("high"))
        rows = cut_lineage(_bucketed(large))
        if not rows.limit(1).count():
            return cut_lineage(done)


def near_words(vocabulary: DataFrame, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs of near words of a saved ``vocabulary`` (``word``, ``n``)."""
    ship(vocabulary.sparkSession)
    buckets = _buckets(vocabulary, hot)
    blocks = max(1, ceil(buckets.count() / block))
    packed = buckets.select("word", "n", F.pmod("bucket", F.lit(blocks)).alias("block"))
    pairs = packed.groupBy("block").applyInArrow(_block, "word string, near string, near_n bigint")
    return cut_lineage(pairs.dropDuplicates(["word", "near"]))


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of the words that have a form."""
    steps = cut_lineage(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        after = steps.join(on, F.col("root") == F.col("_at"), "left")
        after = cut_lineage(after.select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")))
        if not after.filter("moved").limit(1).count():
            return steps
        steps = after.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of the words of ``docs``."""
    words = cut_lineage(vocabulary(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    nearest = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(nearest, "word", "left")
    taken = -F.col("best.less") >= RATIO * F.col("n")
    forms = cut_lineage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
        )
    )
    out = forms.join(_roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(documents(spark, folder, "doc_id", "text"))


SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) AS r(i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS c, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, c, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(x) // 2 + 1), lambda k: ('0x' || substr(x, 2 * k - 1, 2))::BIGINT)),
    lambda h, b: xor(h >> 8, steps[xor(h & 255, b) + 1])), 4294967295) AS h
  FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1
), v AS (SELECT word, n FROM words WHERE length(word) >= 5 AND n >= 3),
shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM v a JOIN shorter b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM v a JOIN shorter b ON a.word = b.rest
), best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), follow AS (
  SELECT word, word AS last FROM forms UNION SELECT follow.word, forms.form FROM follow JOIN forms ON forms.word = follow.last WHERE forms.form IS NOT NULL
), roots AS (SELECT follow.word, follow.last AS root FROM follow JOIN forms ON forms.word = follow.last WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
