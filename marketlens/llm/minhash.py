"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A sketch has ``COORDINATES`` bins. In round i every element of a set is hashed once, to a bin and a
value; a bin takes the smallest value of the first round that reaches it. Rounds go on until all bins
are filled. From round ``COORDINATES`` on, all elements go to one given bin, so twice as many rounds fill
every bin of any set, and large sets need a few. Two sketches agree in a bin with the similarity of the
sets as chance, and the share of equal bins is as concentrated as with independent bins.

Documents with equal sets are one class. Classes that agree in all ``ROWS`` bins of a band are compared:
first by two bits of every bin and by parity bits of the set (an exact bound), then by their whole sets. At similarity 0.85 a pair misses all 32 bands
with chance 7e-9, and the bit test with chance ``MISS`` at most.

Comparing goes in rounds. In each, every class of a band's bucket meets one of the bucket that a hash
picks, and tests the most alike of those it met; buckets whose classes are one component are done. When
a round links few, what is left in a bucket outside its largest component meets all of it, but for classes
that cannot be linked: a shingle that no other class left has is in no overlap, so a class with too many of
these goes (which leaves others with more of them), and a pair with too many is not made. So a large group
of copies of one text, each edited in its own way, does not cost its square. Pairs inside a component are
never made.

Defined cases: a null or empty text has no set and is linked with nothing; a text with fewer words than
n is one shingle; a null doc_id is linked as any other and is no candidate for the smallest id (an id of
null remains, and the row is kept, if no other is reachable); repeated rows are one class and share its
component; an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, lookup, ship
from .graph import components
from .hashing import each_text, mix, parities, windows

N = 5
#: Similarity as a fraction, in whole numbers.
SIMILARITY = (85, 100)
ROWS, BANDS = 5, 32
COORDINATES = ROWS * BANDS
#: Chance at most that a pair of the asked similarity fails the bit test.
MISS = 1e-9
#: Rounds end when one adds less than this share to what the earlier ones found.
FEW = 0.1
#: Elements that are sketched or returned together.
SLICE = 1 << 18
_EMPTY = np.uint64(1 << 32)
_SECOND = np.uint64(0xA0761D6478BD642F)
#: Words of 64 bits in one bit plane of a sketch.
PLANE = -(-COORDINATES // 64)
#: Words of 64 bits in which a bit tells whether an odd number of a set's shingles fall on it.
PARITY = 8
_BITS = [f"w{k}" for k in range(2 * PLANE + PARITY)]
_PROFILE = "doc_id bigint, n bigint, cls bigint, check bigint, keys array<bigint>, " + ", ".join(f"{c} bigint" for c in _BITS)


def _seed(k: int) -> np.uint64:
    return np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))


def sketches(sets: list[np.ndarray], seed: int = 0, size: int = COORDINATES) -> np.ndarray:
    """One row of ``size`` values for every non-empty set of hashes."""
    out = np.full((len(sets), size), _EMPTY, np.uint64)
    live = np.arange(len(sets))
    lengths = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate([np.zeros(0, np.uint64), *sets])
    shift, bins = np.uint64(32), np.uint64(size)
    for k in range(2 * size):
        if not len(live):
            break
        if k < size:
            found = np.full(len(live) * size, _EMPTY, np.uint64)
            owner = np.repeat(np.arange(len(live), dtype=np.uint64) * bins, lengths)
            for at in range(0, len(elements), SLICE):
                h = mix(elements[at : at + SLICE] ^ _seed(k + 3 * seed * size))
                np.minimum.at(found, owner[at : at + SLICE] + (((h >> shift) * bins) >> shift), h & np.uint64(0xFFFFFFFF))
            rows = out[live]
            out[live] = np.where(rows == _EMPTY, found.reshape(rows.shape), rows)
        else:
            h = mix(elements ^ _seed(k + 3 * seed * size)) & np.uint64(0xFFFFFFFF)
            least = np.minimum.reduceat(h, np.cumsum(lengths) - lengths)
            rows = out[live, k - size]
            out[live, k - size] = np.where(rows == _EMPTY, least, rows)
        open_ = (out[live] == _EMPTY).any(axis=1)
        if not open_.all():
            elements = elements[np.repeat(open_, lengths)]
            live, lengths = live[open_], lengths[open_]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of every band of every sketch; the number of the band is part of it."""
    bands = sketch.reshape(len(sketch), -1, rows)
    key = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + bands[:, :, k])
    return key


def _planes(sketch: np.ndarray) -> np.ndarray:
    """The lowest two bits of every value, one plane of words for each."""
    planes = []
    for bit in (0, 1):
        flags = ((sketch >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        full = np.zeros((len(sketch), 64 * PLANE), np.uint8)
        full[:, : flags.shape[1]] = flags
        planes.append(np.packbits(full, axis=1).view(np.int64))
    return np.concatenate(planes, axis=1)


def most_apart(similarity: tuple[int, int], miss: float = MISS, size: int = COORDINATES) -> int:
    """Bins whose two bits may differ: a pair of the asked similarity has more with chance ``miss`` at most."""
    p = 0.75 * (1 - similarity[0] / similarity[1])
    tail, k = 0.0, size
    while k >= 0:
        tail += comb(size, k) * p**k * (1 - p) ** (size - k)
        if tail > miss:
            return k
        k -= 1
    return 0


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-grams of a text's words; all words as one if there are fewer."""
    return np.unique(windows(hashes, min(n, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


def _names(grams: np.ndarray, seed: int) -> tuple[int, int]:
    """Two hashes of a set."""
    size = np.uint64(len(grams))
    one = mix(np.array([mix(grams ^ _seed(2 * seed)).sum(dtype=np.uint64) + size]))
    two = mix(np.array([mix(grams ^ _SECOND).sum(dtype=np.uint64) ^ size]))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


def _profiler(n: int, seed: int) -> Callable:
    """Size, class, band keys and bits of every row, a slice at a time."""

    def made(ids: pa.Array, rows: list[tuple[int, int, int]], distinct: dict[int, np.ndarray]) -> pa.RecordBatch:
        names = [c for c, grams in distinct.items() if len(grams)]
        sketch = sketches([distinct[c] for c in names], seed)
        keys = band_keys(sketch).view(np.int64)
        planes = np.concatenate([_planes(sketch), parities([distinct[c] for c in names], PARITY)], axis=1)
        place = {c: k for k, c in enumerate(names)}
        at = pa.array([place.get(r[1]) if r[0] else None for r in rows], pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
        columns = {"doc_id": ids} | {c: pa.array([r[k] for r in rows], pa.int64()) for k, c in enumerate(("n", "cls", "check"))}
        columns["keys"] = lists.take(at)
        return pa.RecordBatch.from_pydict(columns | {c: pa.array(planes[:, k]).take(at) for k, c in enumerate(_BITS)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows: list[tuple[int, int, int]] = []
            distinct: dict[int, np.ndarray] = {}
            first = held = 0
            for i, hashes in each_text(batch.column("text"), lower=True):
                grams = shingles(hashes, n)
                cls, check = _names(grams, seed)
                rows.append((len(grams), cls, check))
                if cls not in distinct:
                    distinct[cls] = grams
                    held += len(grams) + 1
                if held >= SLICE:
                    yield made(ids[first : i + 1], rows, distinct)
                    rows, distinct, first, held = [], {}, i + 1, 0
            if rows:
                yield made(ids[first:], rows, distinct)

    return run


def _setter(n: int, seed: int) -> Callable:
    """Whole set of every row, a slice at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[int] = []
            sets: list[np.ndarray] = []
            held = 0
            for _, hashes in each_text(batch.column("text"), lower=True):
                grams = shingles(hashes, n)
                names.append(_names(grams, seed)[0])
                sets.append(grams.view(np.int64))
                held += len(grams) + 1
                if held >= SLICE:
                    yield _set_rows(names, sets)
                    names, sets, held = [], [], 0
            if names:
                yield _set_rows(names, sets)

    return run


def _set_rows(names: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"cls": pa.array(names, pa.int64()), "grams": pa.array(sets, pa.list_(pa.int64()))})


def _profile(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int]:
    """Saved profile rows, one row per class, and the seed under which no two sets share a class."""
    seed = 0
    while True:
        made = cut_lineage(rows.mapInArrow(_profiler(n, seed), _PROFILE))
        classes = cut_lineage(
            made.groupBy("cls").agg(
                F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("check").alias("_low"), F.max("check").alias("_high"),
                *[F.first(c).alias(c) for c in ("keys", *_BITS)],
            )
        )
        if not classes.filter("_low <> _high").limit(1).count():
            return made, classes.drop("_low", "_high"), seed
        seed += 1


def _alike(similarity: tuple[int, int]) -> tuple[Column, Column]:
    """Bins in which the bits of x and y differ, and whether these, the parities, sizes and own shingles allow a link."""
    part, whole = similarity
    word = lambda k: F.col(f"x.w{k}").bitwiseXOR(F.col(f"y.w{k}"))
    apart = sum((F.bit_count(word(k).bitwiseOR(word(k + PLANE))) for k in range(PLANE)), F.lit(0))
    differ = sum((F.bit_count(word(2 * PLANE + k)) for k in range(PARITY)), F.lit(0))
    both = F.col("x.n") + F.col("y.n")
    most = F.least(F.col("x.n") - F.col("x.own"), F.col("y.n") - F.col("y.own"))
    exact = (most * whole >= (both - most) * part) & (differ * (whole + part) <= both * (whole - part))
    return apart, exact & (apart <= most_apart(similarity))


def _ordered(x: str, y: str) -> tuple[Column, Column]:
    return F.least(x, y), F.greatest(x, y)


def _sets(rows: DataFrame, classes: DataFrame, wanted: DataFrame, n: int, seed: int) -> DataFrame:
    """Saved whole sets of the ``wanted`` classes, read from one row of each."""
    ids = cut_lineage(wanted.join(classes, "cls").select(F.col("first_id").alias("doc_id")).distinct())
    found = lookup(rows, ids, ["doc_id"], "left_semi").mapInArrow(_setter(n, seed), "cls bigint, grams array<bigint>")
    return cut_lineage(found.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs ``a``, ``b`` of classes whose overlap over the whole sets is large enough."""
    part, whole = similarity
    x = sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga"))
    y = sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb"))
    overlap = F.size(F.array_intersect("ga", "gb")).cast("bigint")
    enough = overlap * whole >= (F.size("ga") + F.size("gb") - overlap) * part
    return cut_lineage(pairs.join(x, "a").join(y, "b").filter(enough).select("a", "b"))


def _relabelled(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Entries whose components take in the new links."""
    comp = entries.select("cls", "comp").distinct()
    edges = links.join(comp.select(F.col("cls").alias("a"), F.col("comp").alias("ca")), "a")
    edges = edges.join(comp.select(F.col("cls").alias("b"), F.col("comp").alias("cb")), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    labels = cut_lineage(components(cut_lineage(edges)))
    moved = entries.join(labels.withColumnRenamed("node", "comp"), "comp", "left")
    return cut_lineage(moved.withColumn("comp", F.coalesce("label", "comp")).drop("label"))


def _mixed(entries: DataFrame) -> DataFrame:
    """Entries of the buckets that still hold more than one component."""
    open_ = entries.groupBy("key").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high")).filter("_low <> _high")
    return cut_lineage(entries.join(open_.select("key"), "key"))


def _peeled(entries: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Entries with ``own``, the shingles that no other class left in a bucket has, without the classes
    that have too many of them for any link. Without those, others have more of their own, so this is
    repeated while many classes go."""
    part, whole = similarity
    while True:
        left = cut_lineage(entries.select("cls", "n").distinct())
        grams = sets.join(left, "cls", "left_semi").select("cls", F.explode("grams").alias("gram"))
        alone = grams.groupBy("gram").agg(F.min("cls").alias("cls"), F.count("*").alias("uses")).filter("uses = 1")
        own = left.join(alone.groupBy("cls").agg(F.count("*").alias("own")), "cls", "left").select("cls", "n", F.coalesce("own", F.lit(0)).alias("own"))
        own = cut_lineage(own.withColumn("open", (F.col("n") - F.col("own")) * whole >= F.col("n") * part))
        entries = _mixed(entries.drop("own").join(own.filter("open").select("cls", "own"), "cls"))
        gone, every = own.select(F.sum(F.when(~F.col("open"), 1).otherwise(0)), F.count("*")).first()
        if not every or gone < FEW * every:
            return entries


def _met(entries: DataFrame, k: int, similarity: tuple[int, int]) -> DataFrame:
    """Every class with the most alike of the classes that its buckets pick in round ``k``."""
    pick = F.xxhash64("cls", F.lit(k))
    picked = entries.groupBy("key").agg(F.min(F.struct(pick.alias("h"), "cls", "comp", "n", "own", *_BITS)).alias("l")).select("key", "l.*")
    apart, possible = _alike(similarity)
    met = entries.alias("x").join(picked.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & possible)
    best = met.groupBy(F.col("x.cls").alias("one")).agg(F.min(F.struct(apart.alias("apart"), F.col("y.cls").alias("two"))).alias("m"))
    a, b = _ordered("one", "m.two")
    return best.select(a.alias("a"), b.alias("b")).distinct()


def _rest(entries: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs of different components in one bucket, at least one of them outside its largest component."""
    sizes = entries.groupBy("key", "comp").count()
    main = sizes.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("m")).select("key", F.col("m.comp").alias("main"))
    marked = entries.join(main, "key")
    outer = (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("x.main")) | (F.col("x.cls") < F.col("y.cls")))
    _, possible = _alike(similarity)
    joined = marked.filter("comp <> main").alias("x").join(entries.alias("y"), (F.col("x.key") == F.col("y.key")) & outer & possible)
    a, b = _ordered("x.cls", "y.cls")
    return joined.select(a.alias("a"), b.alias("b")).distinct()


def near_dedup(docs: DataFrame, n: int = N, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row of ``docs`` (``doc_id``, ``text``)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profile, classes, seed = _profile(rows, n)
    entries = classes.select(F.explode("keys").alias("key"), "cls")
    # Counting combines in each task first, so a bucket of very many classes is no burden here.
    shared = entries.groupBy("key").count().filter("count > 1").select("key")
    entries = cut_lineage(entries.join(shared, "key"))
    entries = cut_lineage(entries.join(classes.select("cls", "n", *_BITS), "cls").withColumns({"comp": F.col("cls"), "own": F.lit(0).cast("bigint")}))
    sets = _sets(rows, classes, cut_lineage(entries.select("cls").distinct()), n, seed)
    steps: list[DataFrame] = []
    tried: list[DataFrame] = []
    left = entries

    def link(pairs: DataFrame) -> int:
        """Verify pairs, merge the components of the linked ones; the number of links."""
        nonlocal left
        for before in tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        tried.append(pairs)
        links = _verified(pairs, sets, similarity)
        linked = links.count()
        if linked:
            steps.append(links)
            left = _mixed(_relabelled(left, links))
        return linked

    linked, k = 0, 0
    while (more := link(_met(left, k, similarity))) > FEW * linked:
        linked, k = linked + more, k + 1
    left = _peeled(left, sets, similarity)
    link(_rest(left, similarity))

    found = classes.select("cls", "first_id", F.col("cls").alias("comp"))
    if steps:
        links = steps[0]
        for more in steps[1:]:
            links = links.unionByName(more)
        labels = cut_lineage(components(cut_lineage(links)))
        found = classes.select("cls", "first_id").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        found = found.withColumn("comp", F.coalesce("label", "cls"))
    smallest = found.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    found = cut_lineage(found.join(smallest, "comp").select("cls", "component_id"))
    out = lookup(profile.select("doc_id", "n", "cls"), found, ["cls"])
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(documents(spark, folder, "doc_id", "text"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS n FROM d WHERE len(ws) > 0),
g AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, n, i, lead(i, 4) OVER o AS last, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g
    FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i))
  WHERE last IS NOT NULL OR (n < 5 AND i = 1)
), s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN s USING (doc_id) JOIN c USING (doc_id)
"""
