"""Substring dedup by level-wise doubling.

A run of ``length`` words that occurs in two documents has all its parts in both. So first short
windows (``START`` words at most) are compared: of each window of twice the length only the part with the
smallest hash is taken, which is the same part wherever the window occurs, and only parts that occur in two
documents survive. Windows whose part has survived are extended to twice their length (never beyond
``length``) and compared again, until the length is reached; when none survive it ends early. A word is
removed when a window of the full length covers it that also starts in a document with a smaller doc_id.

Rows with equal texts are one text for all comparisons: the first keeps its place, the others lose
every word that some window covers. Short windows are compared by 64-bit hashes, which only proposes;
windows of the full length by 128 bits.

Defined cases: a null or empty text has no words; texts shorter than the window lose nothing; a null
doc_id counts as larger than all others; rows with the same doc_id do not take words from each other;
an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import LAST_ID, documents, lookup
from .hashing import each_text, windows

LENGTH = 13
#: Most words of the first windows.
START = 7
#: Windows that a task holds together.
SLICE = 1 << 20


def _levels(length: int) -> list[int]:
    """A short length and its doubles, the last cut to ``length``."""
    if length < 2:
        raise ValueError("windows need at least two words")
    first = (length + 1) // 2
    while first > START:
        first = (first + 1) // 2
    levels = [first]
    while levels[-1] < length:
        levels.append(min(2 * levels[-1], length))
    return levels


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _profiler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests = [], []
        for text in batch.column("text").to_pylist():
            words = (text or "").encode().split()
            counts.append(len(words))
            digests.append(_digest(words))
        yield pa.RecordBatch.from_pydict(
            {"place": batch.column("place"), "_t": batch.column("_t"), "n_words": pa.array(counts, pa.int64()), "digest": pa.array(digests, pa.string()),
             "doc_id": batch.column("doc_id")}
        )


def _smallest(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every run of ``width`` hashes, the place of its smallest (the first of equals), and the
    distinct places in order."""
    n = max(0, len(hashes) - width + 1)
    best, at = hashes[:n].copy(), np.arange(n)
    for k in range(1, width if n else 1):
        less = hashes[k : k + n] < best
        best[less] = hashes[k : k + n][less]
        at[less] = np.flatnonzero(less) + k
    return at, np.unique(at)


def _alive(hashes: np.ndarray, length: int, short: int, parts: pa.Scalar) -> np.ndarray:
    """Starts of the windows of ``length`` whose part of ``short`` words is among ``parts``."""
    known = np.asarray(parts.values if parts.is_valid else [], np.int64).view(np.uint64)
    part = windows(hashes, short)
    return np.flatnonzero(np.isin(part[_smallest(part, length - short + 1)[0]], known))


def _joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays])


def _parts(length: int, short: int, before: int | None) -> Callable:
    """Hashes of the short windows that stand for the long ones of each row; of windows whose own part of
    ``before`` words has survived, if there was a level before."""

    def made(out: list[np.ndarray], rows: list[int]) -> pa.RecordBatch:
        places = np.repeat(np.array(rows, np.int64), [len(x) for x in out])
        return pa.RecordBatch.from_pydict({"part": pa.array(_joined(out, np.uint64).view(np.int64)), "place": pa.array(places)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_numpy()
            out: list[np.ndarray] = []
            rows: list[int] = []
            held = 0
            for i, hashes in each_text(batch.column("text")):
                if len(hashes) < length:
                    continue
                part = windows(hashes, short)
                chosen = _smallest(part, length - short + 1)[1]
                if before is not None:
                    chosen = np.intersect1d(chosen, _alive(hashes, short, before, batch.column("parts")[i]))
                out.append(np.unique(part[chosen]))
                rows.append(places[i])
                held += len(out[-1])
                if held > SLICE:
                    yield made(out, rows)
                    out, rows, held = [], [], 0
            yield made(out, rows)

    return run


def _longs(length: int, short: int) -> Callable:
    """Two hashes and the start of every long window whose part survived."""

    def made(found: list[tuple[np.ndarray, ...]], places: list[int], texts: list[int]) -> pa.RecordBatch:
        sizes = [len(f[0]) for f in found]
        spread = lambda values: pa.array(np.repeat(np.array(values, np.int64), sizes))
        hashes = lambda k: pa.array(_joined([f[k] for f in found], np.uint64).view(np.int64))
        return pa.RecordBatch.from_pydict(
            {"one": hashes(0), "two": hashes(1), "place": spread(places), "_t": spread(texts), "start": pa.array(_joined([f[2] for f in found], np.int64).astype(np.int32))}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [batch.column(c).to_numpy() for c in ("place", "_t")]
            found: list[tuple[np.ndarray, ...]] = []
            rows: list[tuple[int, int]] = []
            held = 0
            for i, hashes in each_text(batch.column("text")):
                starts = _alive(hashes, length, short, batch.column("parts")[i])
                found.append((windows(hashes, length)[starts], windows(hashes, length, seed=7)[starts], starts))
                rows.append((every[0][i], every[1][i]))
                held += len(starts)
                if held > SLICE:
                    yield made(found, [r[0] for r in rows], [r[1] for r in rows])
                    found, rows, held = [], [], 0
            yield made(found, [r[0] for r in rows], [r[1] for r in rows])

    return run


def _cutter(length: int, keep_text: bool) -> Callable:
    """Words left of each row after taking out those that the starts in ``starts`` cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, texts = [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
                words = text.encode().split()
                covered = np.zeros(len(words) + 1, np.int64)
                begin = np.array(starts, np.int64)
                np.add.at(covered, begin, 1)
                np.add.at(covered, begin + length, -1)
                left = [w for w, c in zip(words, np.cumsum(covered[:-1]).tolist(), strict=True) if not c]
                removed.append(len(words) - len(left))
                digests.append(_digest(left))
                texts.append(b" ".join(left).decode() if keep_text else None)
            columns = {"place": batch.column("place"), "_t": batch.column("_t"), "gone": pa.array(removed, pa.int64()), "kept": pa.array(digests, pa.string())}
            if keep_text:
                columns["kept_text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def substring_dedup(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (and ``kept_text`` of rows that lost
    words, on demand) of every row of ``docs`` (``doc_id``, ``text``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Null ids come last; no other row is on the last place.
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), place.alias("place"), text.alias("text"), F.xxhash64(text).alias("_t"))
    levels = _levels(length)
    full = levels[-1]

    profile = rows.mapInArrow(_profiler, "place bigint, _t bigint, n_words bigint, digest string, doc_id bigint")
    profile = cut_lineage(profile)
    firsts = profile.groupBy("digest").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    firsts = cut_lineage(firsts)
    ranked = lookup(profile, firsts, ["digest"]).withColumn("copy", F.coalesce(F.col("place") > F.col("first"), F.lit(False)))
    profile = cut_lineage(ranked.drop("first", "last"))
    copies = cut_lineage(profile.filter("copy").select("place", "_t").distinct())
    compared = lookup(rows, copies, ["place", "_t"], "left_anti")

    chosen, alive, before = compared.select("place", "_t", "text"), None, None
    for short, longer in zip(levels, levels[1:]):
        read = chosen if alive is None else chosen.join(alive, "place")
        made = _parts(longer, short, before)
        parts = read.select("place", "text", *(["parts"] if alive is not None else [])).mapInArrow(made, "part bigint, place bigint")
        twice = parts.groupBy("part").agg(F.min("place").alias("_low"), F.max("place").alias("_high")).filter("_low < _high").select("part")
        alive = cut_lineage(parts.join(twice, "part").groupBy("place").agg(F.collect_set("part").alias("parts")))
        chosen = cut_lineage(lookup(chosen, cut_lineage(alive.select("place")), ["place"], "left_semi"))
        before = short
        if not alive.limit(1).count():
            break
    extended = chosen.join(alive, "place").select("place", "_t", "text", "parts")
    longs = cut_lineage(extended.mapInArrow(_longs(full, before), "one bigint, two bigint, place bigint, _t bigint, start int"))
    # Of each window the smallest place keeps it.
    first = longs.groupBy("one", "two").agg(F.min("place").alias("_first"), F.max("place").alias("_last")).filter("_first < _last")
    hit = longs.join(first.select("one", "two", "_first"), ["one", "two"]).filter(F.col("place") > F.col("_first"))
    starts = cut_lineage(hit.groupBy("place", "_t").agg(F.collect_set("start").alias("starts")))
    touched = lookup(chosen, cut_lineage(starts.select("place", "_t")), ["place", "_t"], "left_semi")
    schema = "place bigint, _t bigint, gone bigint, kept string" + (", kept_text string" if keep_text else "")
    cut = touched.join(starts, ["place", "_t"]).select("place", "_t", "text", "starts").mapInArrow(_cutter(full, keep_text), schema)
    return _assembled(profile, cut_lineage(cut.dropDuplicates(["place", "_t"])), full, keep_text)


def _assembled(profile: DataFrame, cut: DataFrame, length: int, keep_text: bool) -> DataFrame:
    out = lookup(profile, cut, ["place", "_t"])
    copy = F.col("copy") & (F.col("n_words") >= length)
    removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0).cast("bigint")))
    kept = F.when(copy, F.lit(_digest([]))).otherwise(F.coalesce("kept", "digest"))
    return out.select("doc_id", "n_words", removed.alias("n_removed"), kept.alias("kept_sha256"), *(["kept_text"] if keep_text else []))


def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(documents(spark, folder, "doc_id", "text"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
r AS (
  SELECT doc_id, i, lead(i, 12) OVER o AS last,
         concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o, lead(w, 5) OVER o, lead(w, 6) OVER o,
                   lead(w, 7) OVER o, lead(w, 8) OVER o, lead(w, 9) OVER o, lead(w, 10) OVER o, lead(w, 11) OVER o, lead(w, 12) OVER o) AS run
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), h AS (SELECT doc_id, i FROM r WHERE last IS NOT NULL QUALIFY doc_id > min(doc_id) OVER (PARTITION BY run)),
c AS (SELECT w.doc_id, w.w, w.i, max(h.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS near FROM w LEFT JOIN h ON h.doc_id = w.doc_id AND h.i = w.i),
k AS (
  SELECT doc_id, count(*) FILTER (WHERE near > i - 13) AS gone,
         string_agg(w, ' ' ORDER BY i) FILTER (WHERE near IS NULL OR near <= i - 13) AS kept
  FROM c GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
