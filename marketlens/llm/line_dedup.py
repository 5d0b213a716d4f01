"""Line dedup by pairwise alignment.

Documents that share lines are aligned by patience diff, and blocks of lines that both have in the
same order are deleted from the later one (the larger doc_id). Lines are compared by a 64-bit hash of
the line without outer white space; a block counts from ``MIN_CHARS`` characters on, so a short line
that two texts happen to share stays.

Pairs come from shared lines. A rare line (in ``RARE`` documents at most) pairs all its documents, so
only blocks of hot lines (in more documents) are left. Every such block is made of runs: consecutive
hot lines, as few as reach ``MIN_CHARS`` from their first line on or back from their last. A run pairs
each document with the first one that has it. Where a run stays after that (it crosses other shared
lines there), the other holders before the document are tried too, in rounds that double, one of each
class of documents whose hot lines are the same in the same order with gaps at the same places. A
document that shares no rare line with these aligns alike with all of them; where it shares one with the
member that stands for the class, and so is aligned with it anyway, the next member stands in. So the
result is that of aligning each document with all earlier ones, while a line in a third of all documents
gives about one pair each. What remains is a pair per document and order of hot lines that crosses it.
Documents with equal lines are one document for all this; the later ones lose every line.

Only hashes and lengths of lines are joined and aligned; texts stay where they are until their lines
are deleted.

Defined cases: a null text has no lines and stays null; an empty text has one empty line and stays; a
null doc_id counts as larger than all others; rows with the same doc_id lose nothing to each other;
an empty table gives an empty table; other columns pass through, and those named like a result are
replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from ..session import cut_lineage
from .common import GAP_CHARS, LAST_ID, documents, lookup, packed, ship, unpacked
from .hashing import released

MIN_CHARS = 40
RARE = 8
_KEY = ["place", "_t"]
#: Hashes of runs are polynomials of their lines, so that a run costs the same at any length.
_PRIME = (1 << 61) - 1
_BASE = 0x9E3779B97F4A7C1 % _PRIME


def _rising(places: Sequence[int]) -> list[int]:
    """Indices of a longest rising run of ``places``."""
    ends: list[int] = []
    values: list[int] = []
    before = [-1] * len(places)
    for i, p in enumerate(places):
        k = bisect_left(values, p)
        before[i] = ends[k - 1] if k else -1
        ends[k : k + 1], values[k : k + 1] = [i], [p]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _anchors(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Lines that are single in both, in an order that rises in both. Where none is single in both,
    the k-th of equal lines stands for itself."""
    in_a, in_b = Counter(a), Counter(b)
    place = {x: j for j, x in enumerate(b) if in_b[x] == 1}
    found = [(i, place[x]) for i, x in enumerate(a) if in_a[x] == 1 and x in place]
    if not found:
        count: Counter[int] = Counter()
        numbered: dict[tuple[int, int], int] = {}
        for j, x in enumerate(b):
            numbered[x, count[x]] = j
            count[x] += 1
        count.clear()
        for i, x in enumerate(a):
            if (x, count[x]) in numbered:
                found.append((i, numbered[x, count[x]]))
            count[x] += 1
    return [found[k] for k in _rising([j for _, j in found])]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Patience diff: pairs of places of equal lines, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = [(a0 + i, b0 + j) for i, j in _anchors(a[a0:a1], b[b0:b1])]
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def common_blocks(a: Sequence[int], b: Sequence[int], sizes: Sequence[int], least: int) -> list[int]:
    """Places in ``a`` of the lines of aligned blocks of at least ``least`` characters."""
    gone: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*align(a, b), (-1, -1)]:
        if (i, j) != (last[0] + 1, last[1] + 1) and block:
            if sum(sizes[k] for k in block) >= least:
                gone += block
            block = []
        block.append(i)
        last = (i, j)
    return gone


def _aligner(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lines", "others", "sizes")]
            gone = [common_blocks(a, b, sizes, least) for a, b, sizes in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_pydict({"place": batch.column("place"), "_t": batch.column("_t"), "gone": pa.array(gone, pa.list_(pa.int32()))})

    return run


def _windows(sizes: Sequence[int], open_: Sequence[bool], least: int) -> set[tuple[int, int]]:
    """First and last place of the shortest windows of ``open_`` lines that reach ``least`` characters
    from their first line on, or back from their last."""
    out: set[tuple[int, int]] = set()
    start, first, total = 0, 0, 0
    for end, ok in enumerate(open_):
        if not ok:
            start = first = end + 1
            total = 0
            continue
        total += sizes[end]
        # ``first``: the last start from which the window to ``end`` is long enough.
        while total - sizes[first] >= least:
            total -= sizes[first]
            first += 1
        if total >= least:
            # Starts whose window was too short until now.
            out.update((k, end) for k in range(start, first + 1))
            start = max(start, first + 1)
            out.add((first, end))
    return out


def _runner(least: int):
    """Runs of hot lines of a document, and a hash of its hot lines in their order and of the gaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_KEY, "lines", "sizes", "hot")]
            rows: list[tuple[int, ...]] = []
            for place, text, lines, sizes, hot in zip(*columns, strict=True):
                hot = set(hot)
                found = _windows(sizes, [n == 0 or x in hot for x, n in zip(lines, sizes)], least)
                if not found:
                    continue
                sums, powers, form, gap = [0], [1], 0, False
                for x, n in zip(lines, sizes):
                    sums.append((sums[-1] * _BASE + x) % _PRIME)
                    powers.append(powers[-1] * _BASE % _PRIME)
                    # Other lines only part their neighbours.
                    own = n > 0 and x not in hot
                    if not (own and gap):
                        form = (form * _BASE + (1 if own else x)) % _PRIME
                    gap = own
                for i, j in found:
                    size = j + 1 - i
                    rows.append((place, text, (sums[j + 1] - sums[i] * powers[size] + size) % _PRIME, form, i, j))
            made = zip(*rows, strict=True) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2
            names = [*_KEY, "run", "form", "i", "j"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(made, kinds, strict=True)], names)

    return run


def _aligned(pairs: DataFrame, single: DataFrame, least: int) -> DataFrame:
    """``place``, ``_t``, ``gone`` of the documents of ``pairs`` that lose lines to ``p``, ``t``."""
    others = single.select(F.col("place").alias("p"), F.col("_t").alias("t"), F.col("lines").alias("others"))
    both = pairs.join(others, ["p", "t"]).join(single, _KEY)
    found = both.select(*_KEY, "lines", "sizes", "others").mapInArrow(released(_aligner(least)), "place bigint, _t bigint, gone array<int>")
    return cut_lineage(found.filter(F.size("gone") > 0).select(*_KEY, F.explode("gone").alias("g")).groupBy(*_KEY).agg(F.collect_set("g").alias("gone")))


def _left(runs: DataFrame, gone: DataFrame) -> DataFrame:
    """Runs of which a line stays."""
    inside = F.filter("gone", lambda g: (g >= F.col("i")) & (g <= F.col("j")))
    whole = F.coalesce(F.size(inside) == F.col("j") - F.col("i") + 1, F.lit(False))
    return runs.join(gone, _KEY, "left").filter(~whole).drop("gone")


def _stood_in(tried: DataFrame, members: DataFrame, rare_pairs: DataFrame) -> DataFrame:
    """Pairs ``place``, ``_t``, ``p``, ``t`` of ``tried`` (with ``run``, ``form``). A pair that shares a rare line
    says nothing of the other members of the class: the first of these that shares none is taken instead."""
    pair = [*_KEY, "p", "t"]
    met = cut_lineage(tried.join(rare_pairs, pair, "left_semi").select(*_KEY, "run", "form").distinct())
    free = tried.select(*pair)
    if not met.limit(1).count():
        return free
    others = members.select("run", "form", F.col("place").alias("p"), F.col("_t").alias("t"))
    standing = met.join(others, ["run", "form"]).filter(F.col("p") < F.col("place")).join(rare_pairs, pair, "left_anti")
    first = standing.groupBy(*_KEY, "run", "form").agg(F.min(F.struct("p", "t")).alias("first")).select(*_KEY, "first.p", "first.t")
    return free.unionByName(first)


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy(*_KEY).agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(docs: DataFrame, least: int = MIN_CHARS, rare: int = RARE) -> DataFrame:
    """``place``, ``_t``, ``whole``, ``gone`` (places of lines) of rows that lose lines to earlier ones.

    ``docs`` has the columns of :func:`_named`."""
    trimmed = F.transform(_split(F.coalesce(F.col("text"), F.lit(""))), lambda x: F.btrim(x, F.lit(GAP_CHARS)))
    lines = docs.select(*_KEY, trimmed.alias("_l")).select(
        *_KEY, F.transform("_l", lambda x: F.xxhash64(x)).alias("lines"), F.transform("_l", lambda x: F.length(x)).alias("sizes")
    )
    total = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x)
    same = [F.xxhash64("lines").alias("s1"), F.xxhash64("lines", F.lit(1)).alias("s2")]
    lines = cut_lineage(lines.filter(total >= least).select("*", *same))
    firsts = lines.groupBy("s1", "s2").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    marked = lookup(lines, cut_lineage(firsts), ["s1", "s2"]).withColumn("whole", F.coalesce(F.col("place") > F.col("first"), F.lit(False)))
    lines = cut_lineage(marked.drop("s1", "s2", "first", "last"))
    copies = lines.filter("whole").select(*_KEY).distinct()

    single = lines.filter(~F.col("whole")).select(*_KEY, "lines", "sizes").dropDuplicates(_KEY)
    keys = single.select(*_KEY, F.explode(F.array_distinct(F.zip_with("lines", "sizes", lambda h, n: F.when(n > 0, h)))).alias("h")).filter("h IS NOT NULL")
    keys = cut_lineage(keys)
    shared = keys.groupBy("h").agg(F.count("*").alias("docs"), F.min(F.struct(*_KEY)).alias("first")).filter("docs > 1")
    keys = cut_lineage(keys.join(shared, "h"))
    x, y = keys.filter(F.col("docs") <= rare).alias("x"), keys.filter(F.col("docs") <= rare).alias("y")
    close = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("y.place") < F.col("x.place")))
    rare_pairs = cut_lineage(close.select("x.place", "x._t", F.col("y.place").alias("p"), F.col("y._t").alias("t")).distinct())
    marks = keys.filter(F.col("docs") > rare).groupBy(*_KEY).agg(F.collect_list("h").alias("hot"))
    hot = single.join(marks, _KEY)
    runs = hot.select(*_KEY, "lines", "sizes", "hot").mapInArrow(released(_runner(least)), "place bigint, _t bigint, run bigint, form bigint, i int, j int")
    runs = cut_lineage(runs)
    members = runs.select("run", "form", *_KEY).distinct()
    forms = cut_lineage(members.groupBy("run", "form").agg(F.min(F.struct(*_KEY)).alias("holder")))
    firsts = forms.groupBy("run").agg(F.min(F.struct("holder", "form")).alias("first"), F.count("*").alias("forms"))
    runs = cut_lineage(runs.join(firsts, "run").filter(F.col("first.holder.place") < F.col("place")))
    star = runs.select(*_KEY, "run", F.col("first.form").alias("form"), F.col("first.holder.place").alias("p"), F.col("first.holder._t").alias("t"))
    pairs = cut_lineage(rare_pairs.unionByName(_stood_in(star, members, rare_pairs)).distinct())
    gone = _aligned(pairs, single, least)
    # Runs that stay although other holders are left to try.
    runs = cut_lineage(_left(runs.filter("forms > 1").drop("form", "first", "forms"), gone))
    if runs.limit(1).count():
        numbered = forms.join(runs.select("run").distinct(), "run")
        numbered = global_index(numbered, [F.col("run"), F.col("holder.place"), F.col("holder._t"), F.col("form")], "_idx")
        numbered = cut_lineage(numbered.join(numbered.groupBy("run").agg(F.min("_idx").alias("_first")), "run").withColumn("rank", F.col("_idx") - F.col("_first")))
        low, step = 1, 1
        while True:
            ahead = numbered.filter(F.col("rank") >= low).withColumnRenamed("run", "_run")
            earlier = (F.col("run") == F.col("_run")) & (F.col("holder.place") < F.col("place"))
            # A run that has no holder left falls out.
            ranks = ahead.groupBy("_run").agg(F.min("holder.place").alias("_next"))
            runs = cut_lineage(runs.join(ranks, (F.col("run") == F.col("_run")) & (F.col("_next") < F.col("place"))).drop("_run", "_next"))
            if not runs.limit(1).count():
                break
            tried = runs.join(ahead.filter(F.col("rank") < low + step), earlier)
            tried = tried.select(*_KEY, "run", "form", F.col("holder.place").alias("p"), F.col("holder._t").alias("t"))
            tried = _stood_in(cut_lineage(tried.distinct()), members, rare_pairs)
            more = _aligned(cut_lineage(tried.distinct().join(pairs, [*_KEY, "p", "t"], "left_anti")), single, least)
            gone = cut_lineage(_merged(gone, more))
            runs = _left(runs, gone)
            low, step = low + step, 2 * step
    nothing = F.lit(None).cast("array<int>").alias("gone")
    return gone.select(*_KEY, F.lit(False).alias("whole"), "gone").unionByName(copies.select(*_KEY, F.lit(True).alias("whole"), nothing))


def _named(docs: DataFrame) -> DataFrame:
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    return docs.withColumns({"place": place, "_t": F.xxhash64(F.coalesce("text", F.lit("")))})


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS, rare: int = RARE) -> DataFrame:
    """Rows of ``docs`` (``doc_id``, ``text``, others) with repeated blocks deleted from ``text``, and
    ``n_lines``, ``n_removed``."""
    ship(docs.sparkSession)
    named = _named(packed(docs, "doc_id", "text"))
    gone = cut_lineage(repeated_lines(named, least, rare))
    df = lookup(named, gone, _KEY).withColumn("_l", _split(F.col("text")))
    left = F.filter("_l", lambda x, i: ~F.array_contains("gone", i))
    text = F.when(F.col("whole"), F.lit("")).when(F.col("gone").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("text"))
    lines = F.when(F.col("_l").isNotNull(), F.size("_l")).otherwise(F.lit(0))
    removed = F.when(F.col("whole"), lines).otherwise(F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(F.lit(0)))
    df = df.withColumns({"n_lines": lines.cast("bigint"), "n_removed": removed.cast("bigint"), "text": text})
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    return unpacked(df, columns, "doc_id", "text", "n_lines", "n_removed")


def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    df = dedup_lines(documents(spark, folder, "doc_id", "text"))
    return df.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
