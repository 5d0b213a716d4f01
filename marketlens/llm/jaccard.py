"""N-gram Jaccard join: documents whose sets of word n-grams are similar, and their components.

The join is a sparse product of the document by n-gram incidence with its transpose. Documents with
equal sets are one row of it. Columns are put in one order, rare n-grams first; two sets can only be
similar if they share an n-gram among the first few of both (a quarter and one, for 0.75), so only
those entries are multiplied, and a product is dropped at once if the sizes, or the places of the
shared n-gram among those that other sets have too, or the parity bits in which the whole sets differ,
bound the overlap below what the similarity needs. Then the overlap of the first entries is
counted, which bounds the rest, and for what is left that of the whole sets.

Products are made in blocks. First each n-gram's rows meet a few rows of it that a hash picks, which
links nearly all members of a group of near copies; then, per n-gram, rows of other components meet
a few rows of the largest one, and what is still outside meets all rows. Pairs inside one component need
no product, so a group of copies costs as many products as it has members, not their square, and no link
between components is lost.

Frequent n-grams are found by counting what recurs within each slice of rows, over all rows; up to
``FREQUENT`` of the most common are put last in the order. Any order gives the same links.

Defined cases: a null or empty text has no set and is linked with nothing; a text with fewer words
than n is one n-gram; a null doc_id is linked as any other and is no candidate for the smallest id
(an id of null remains if no other is reachable); repeated rows are equal sets; an empty table
gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, lookup, ship
from .graph import components
from .hashing import each_text, mix, parities, released, windows

N = 5
#: Similarity as a fraction, in whole numbers.
SIMILARITY = (75, 100)
#: Most n-grams in the list of frequent ones (8 bytes each), and uses from which one is listed.
FREQUENT = 200_000
FREQUENT_USES = 4
#: Rows of an n-gram that its other rows meet first are picked by so many hashes; rows outside its largest
#: component then meet so many of that.
PICKS = 8
#: Words of 64 bits in which a bit tells whether an odd number of a set's n-grams fall on it.
PARITY = 16
#: N-grams that are held together in a task, and for how many of them a row counts besides its own.
SLICE = 1 << 20
ROW = 64
_PARITY = [f"w{k}" for k in range(PARITY)]
_SECOND = np.uint64(0xA0761D6478BD642F)


def _set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-grams of a text's words."""
    return np.unique(windows(hashes, min(n, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


def _class(grams: np.ndarray, seed: int) -> tuple[int, int]:
    """Two hashes of a set."""
    size = np.uint64(len(grams))
    one = mix(np.array([mix(grams ^ np.uint64(2 * seed + 1)).sum(dtype=np.uint64) + size]))
    two = mix(np.array([mix(grams ^ _SECOND).sum(dtype=np.uint64) ^ size]))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


#: A row's doc_id and ``t``, its n-grams, and the two hashes of them.
_Row = tuple[tuple[int | None, int], np.ndarray, tuple[int, int]]


def _sets(batches: Iterator[pa.RecordBatch], n: int, seed: int) -> Iterator[_Row]:
    for batch in batches:
        names = list(zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), strict=True))
        for i, hashes in each_text(batch.column("text"), lower=True):
            grams = _set(hashes, n)
            yield names[i], grams, _class(grams, seed)


_PROFILE = "doc_id bigint, t bigint, n bigint, cls bigint, check bigint, gram bigint, uses bigint, " + ", ".join(f"{c} bigint" for c in _PARITY)
_PREFIX = "gram bigint, cls bigint, n bigint, pos int"


def _sliced(sets: Iterator[_Row]) -> Iterator[list[_Row]]:
    """Sets of consecutive rows, about ``SLICE`` n-grams at a time, however the rows came in batches."""
    some, held = [], 0
    for row in sets:
        some.append(row)
        held += len(row[1]) + ROW
        if held >= SLICE:
            yield some
            some, held = [], 0
    if some:
        yield some


def _profiler(n: int, seed: int) -> Callable:
    """Size and class of every row; and n-grams that recur in the slice, with their uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _sliced(_sets(batches, n, seed)):
            seen = {cls: grams for _, grams, (cls, _) in some}
            bits = dict(zip(seen, parities(list(seen.values()), PARITY), strict=True))
            every, uses = np.unique(np.concatenate([np.zeros(0, np.uint64), *seen.values()]), return_counts=True)
            every, uses = every[uses > 1].view(np.int64), uses[uses > 1]
            more = len(every)
            own = lambda values: pa.concat_arrays([pa.array(values, pa.int64()), pa.nulls(more, pa.int64())])  # noqa: E731, B023
            words = np.array([bits[cls] for _, _, (cls, _) in some])
            nothing = pa.nulls(len(some), pa.int64())
            columns = {
                "doc_id": own([i for (i, _), _, _ in some]), "t": own([t for (_, t), _, _ in some]), "n": own([len(g) for _, g, _ in some]),
                "cls": own([c for _, _, (c, _) in some]), "check": own([c for _, _, (_, c) in some]),
                "gram": pa.concat_arrays([nothing, pa.array(every)]), "uses": pa.concat_arrays([nothing, pa.array(uses.astype(np.int64))]),
            }
            yield pa.RecordBatch.from_pydict(columns | {c: own(words[:, k]) for k, c in enumerate(_PARITY)})

    return run


def _prefixer(n: int, seed: int, frequent: np.ndarray, rank: np.ndarray, similarity: tuple[int, int]) -> Callable:
    """First entries of every set in the order: rare n-grams by hash, then frequent ones."""
    part, whole = similarity

    def first_entries(grams: np.ndarray) -> np.ndarray:
        take = len(grams) - -(-part * len(grams) // whole) + 1
        if not len(frequent):
            return grams[:take]
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        common = frequent[at] == grams
        first = grams[~common][:take]
        if len(first) == take:
            return first
        last = grams[common][np.argsort(rank[at[common]])]
        return np.concatenate([first, last[: take - len(first)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _sliced(_sets(batches, n, seed)):
            distinct = {cls: grams for _, grams, (cls, _) in some if len(grams)}
            heads = [first_entries(grams) for grams in distinct.values()]
            lengths = np.array([len(x) for x in heads], np.int64)
            grams = np.concatenate([np.zeros(0, np.uint64), *heads])
            starts = np.cumsum(lengths) - lengths
            spread = lambda values: pa.array(np.repeat(np.array(values, np.int64), lengths))  # noqa: E731, B023
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array(grams.view(np.int64)), "cls": spread(list(distinct)), "n": spread([len(g) for g in distinct.values()]),
                    "pos": pa.array((np.arange(len(grams)) - np.repeat(starts, lengths)).astype(np.int32)),
                }
            )

    return run


def _setter(n: int, seed: int) -> Callable:
    """Whole set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _sliced(_sets(batches, n, seed)):
            sets = [grams.view(np.int64) for _, grams, _ in some]
            yield pa.RecordBatch.from_pydict(
                {"cls": pa.array([c for _, _, (c, _) in some], pa.int64()), "grams": pa.array(sets, pa.list_(pa.int64()))}
            )

    return run


def _profile(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int]:
    """Saved profile rows, one row per class, and the seed under which no two sets share a class."""
    seed = 0
    while True:
        made = cut_lineage(rows.mapInArrow(released(_profiler(n, seed)), _PROFILE))
        classes = made.filter("n IS NOT NULL").groupBy("cls").agg(
            F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("check").alias("_low"), F.max("check").alias("_high"),
            *[F.first(c).alias(c) for c in _PARITY],
        )
        classes = cut_lineage(classes)
        if not classes.filter("_low <> _high").limit(1).count():
            return made, classes.drop("_low", "_high"), seed
        seed += 1


def _frequent(profile: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent n-grams in the order of their hashes, and their places from the most frequent on, which come
    last. Only n-grams over a bound of uses reach the driver; it is taken from a count of n-grams by their
    uses, in steps of an eighth of a doubling."""
    counted = cut_lineage(profile.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("uses").alias("uses")).filter(F.col("uses") >= FREQUENT_USES))
    step = F.floor(F.log2("uses") * 8)
    steps = counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in steps:
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = counted.filter(step >= least).select("gram", "uses").toArrow()
    grams, uses = top.column("gram").to_numpy().view(np.uint64), top.column("uses").to_numpy()
    place = np.empty(len(grams), np.int64)
    place[np.lexsort((grams, uses))] = np.arange(len(grams))
    order = np.argsort(grams)
    return grams[order], place[order]


def _enough(a: Column, b: Column, overlap: Column, similarity: tuple[int, int]) -> Column:
    """The overlap of sets of sizes ``a`` and ``b`` reaches the similarity."""
    part, whole = similarity
    return overlap * whole >= (a + b - overlap) * part


def _possible(similarity: tuple[int, int]) -> Column:
    """What sizes, places and numbers of shared entries allow for rows x and y of one n-gram."""
    part, whole = similarity
    a, b = F.col("x.n"), F.col("y.n")
    rest = lambda n: F.floor((n * part + (whole - 1)) / whole) - 1
    by_place = F.least("x.sp", "y.sp") + F.least(a - F.col("x.pos"), b - F.col("y.pos"))
    by_count = F.least("x.e", "y.e") + F.greatest(rest(a), rest(b))
    return _enough(a, b, F.least(a, b), similarity) & _enough(a, b, by_place, similarity) & _enough(a, b, by_count, similarity)


def _differ(similarity: tuple[int, int]) -> Column:
    """What the parities of whole sets allow: every bit that differs is an n-gram that only one of the two has."""
    part, whole = similarity
    apart = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in _PARITY), F.lit(0))
    return apart * (whole + part) <= (F.col("x.n") + F.col("y.n")) * (whole - part)


def _pairs(x: DataFrame, y: DataFrame, differ: Column, similarity: tuple[int, int]) -> DataFrame:
    joined = x.alias("x").join(y.alias("y"), (F.col("x.gram") == F.col("y.gram")) & differ & _possible(similarity))
    low = F.col("x.cls") < F.col("y.cls")
    side = lambda name: (F.when(low, F.col(f"x.{name}")).otherwise(F.col(f"y.{name}")), F.when(low, F.col(f"y.{name}")).otherwise(F.col(f"x.{name}")))
    (a, b), (na, nb) = side("cls"), side("n")
    return joined.select(a.alias("a"), b.alias("b"), na.alias("na"), nb.alias("nb")).distinct()


def _bounded(pairs: DataFrame, heads: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs that share enough first entries. All n-grams that both have up to the end of the first
    entries of one set are among the first entries of both, so the overlap is at most what they share
    there and the rest of that set."""
    part, whole = similarity
    x = heads.select(F.col("cls").alias("a"), F.col("head").alias("ha"))
    y = heads.select(F.col("cls").alias("b"), F.col("head").alias("hb"))
    both = pairs.join(x, "a").join(y, "b")
    rest = lambda size: F.floor((F.col(size) * part + (whole - 1)) / whole) - 1
    most = F.size(F.array_intersect("ha", "hb")) + F.greatest(rest("na"), rest("nb"))
    return cut_lineage(both.filter(_enough(F.col("na"), F.col("nb"), most, similarity)).drop("ha", "hb"))


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, n: int, seed: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose overlap over the whole sets is large enough."""
    used = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    ids = cut_lineage(used.join(classes, "cls").select(F.col("first_id").alias("doc_id")).distinct())
    chosen = lookup(rows, ids, ["doc_id"], "left_semi")
    sets = cut_lineage(chosen.mapInArrow(released(_setter(n, seed)), "cls bigint, grams array<bigint>"))
    x = sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga"))
    y = sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(x, "a").join(y, "b")
    overlap = F.size(F.array_intersect("ga", "gb")).cast("bigint")
    return both.filter(_enough(F.col("na"), F.col("nb"), overlap, similarity)).select("a", "b").distinct()


def _mixed(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of n-grams that rows of several components have, with their component (``comp``) and the
    one that has most rows of the n-gram (``main``)."""
    placed = entries.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("label", "cls")).drop("label")
    placed = cut_lineage(placed)
    sizes = placed.groupBy("gram", "comp").count()
    main = sizes.groupBy("gram").agg(F.max(F.struct("count", "comp")).alias("m"), F.count("*").alias("comps")).filter("comps > 1")
    return placed.join(main.select("gram", F.col("m.comp").alias("main")), "gram")


def _some(mixed: DataFrame) -> DataFrame:
    """Up to ``PICKS`` rows of every n-gram's largest component, others for each n-gram."""
    row = F.struct(F.xxhash64("cls", "gram").alias("p"), *[c for c in mixed.columns if c != "gram"])
    slot = F.pmod(F.xxhash64("gram", "cls"), F.lit(PICKS))
    picked = mixed.filter("comp = main").groupBy("gram", slot.alias("_slot")).agg(F.min(row).alias("r"))
    return picked.select("gram", "r.*").drop("p")


def _all(mixed: DataFrame) -> DataFrame:
    return mixed


def jaccard_components(docs: DataFrame, n: int = N, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``docs`` (``doc_id``, ``text``)."""
    return row_components(docs, n, similarity).select("doc_id", "n_shingles", "component_id")


def row_components(docs: DataFrame, n: int = N, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The same with ``t``, the hash of the text that names a row beside its doc_id, and ``component``, a
    number of the component that is known even where no row of it has an id (null: no set)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("t"))
    profile, classes, seed = _profile(rows, n)
    frequent, rank = _frequent(profile)
    prefix = rows.mapInArrow(released(_prefixer(n, seed, frequent, rank, similarity)), _PREFIX)
    # One exchange serves both: a class has an n-gram once, so no n-gram outweighs the others.
    same = Window.partitionBy("gram")
    shared = prefix.withColumns({"_low": F.min("cls").over(same), "_high": F.max("cls").over(same)}).filter("_low <> _high")
    # Entries that no other set has cannot be shared: ``sp`` counts the others before an entry.
    own_order, own = Window.partitionBy("cls").orderBy("pos"), Window.partitionBy("cls")
    entries = shared.drop("_low", "_high").distinct()
    entries = cut_lineage(entries.withColumns({"sp": F.row_number().over(own_order) - 1, "e": F.count("*").over(own)}))
    heads = cut_lineage(entries.groupBy("cls").agg(F.collect_list("gram").alias("head")))

    pick = F.xxhash64("cls", F.pmod("gram", F.lit(PICKS)))
    leaders = entries.groupBy("gram").agg(F.min(F.struct(pick.alias("p"), "cls", "n", "pos", "sp", "e")).alias("l")).select("gram", "l.cls", "l.n", "l.pos", "l.sp", "l.e")
    tried = cut_lineage(_pairs(entries, leaders, F.col("x.cls") != F.col("y.cls"), similarity))
    links = cut_lineage(_verified(_bounded(tried, heads, similarity), rows, classes, n, seed, similarity))
    labels = cut_lineage(components(links))

    # What is left: rows of an n-gram outside its largest component meet a few rows of that, then all rows.
    mixed = cut_lineage(_mixed(entries, labels).join(classes.select("cls", *_PARITY), "cls"))
    outer = (F.col("x.comp") != F.col("y.comp")) & _differ(similarity)
    for others in (_some, _all):
        rest = _pairs(mixed.filter("comp <> main"), others(mixed), outer, similarity)
        rest = cut_lineage(rest.join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        if rest.limit(1).count():
            more = _verified(_bounded(rest, heads, similarity), rows, classes, n, seed, similarity)
            links = cut_lineage(links.unionByName(more))
            labels = cut_lineage(components(links))
            tried = tried.unionByName(rest)
            if others is _some:
                mixed = cut_lineage(_mixed(mixed.drop("comp", "main"), labels))

    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("label", "cls"))
    smallest = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    found = cut_lineage(named.join(smallest, "comp").select("cls", "component_id", F.col("comp").alias("component")))
    out = lookup(profile.filter("n IS NOT NULL").select("doc_id", "t", "n", "cls"), found, ["cls"])
    some = F.col("n") > 0
    component = F.when(some, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "t", F.col("n").alias("n_shingles"), component.alias("component_id"), F.when(some, F.col("component")).alias("component"))


def op1_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(documents(spark, folder, "doc_id", "text"))


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
e AS (SELECT a, b FROM o JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN s USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY ALL
"""
