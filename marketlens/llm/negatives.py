"""Hard-negative mining with score bounds along spanning trees of anchors.

Vectors are whole numbers and scores their inner products. Anchors are dealt to blocks of ``BLOCK`` with
like signs, and each block gets a spanning tree of smallest total edge length. For a child anchor c of a
parent p, the score of a candidate x is that of p plus the product of x with c - p, so it is within
edge length times norm of x around the parent's score (or around what bounds that). Going down the tree,
only candidates whose bounds overlap the window that the child asks for are scored again.

There are two passes over all rows. In the first the window is "at least the fifth best of the same
label that is known so far", in the second it is the band under each positive's score, above the third
best known so far in it; both start from the scores inside the anchor's own block. Each task keeps the
best few per window, and the tasks' few are merged.

The anchors are a fixed share of the rows, so the work has the square of the table in it, as the question
has. A scan holds ``SCAN_BYTES`` of anchors at most; the rows are scanned again for the next anchors.

Defined cases: rows with a null vec_id, label, vector or component, or a component that is not finite, take
no part; a vec_id names one vector, so of rows that share one only that of smallest label, then vector,
takes part; a shorter vector counts as padded with zeros; equal scores are ordered by vec_id; an anchor
without positives or a positive without negatives returns nothing, as does an empty table; other columns
are not carried. Scores are exact; one that does not fit in a long ends the job with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from ..session import cut_lineage
from .common import lookup, ship

ANCHOR_STEP, RELABEL_STEP, LABELS = 50, 7, 10
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Negatives score from so many percent of their positive to so many.
BAND = (50, 95)
BLOCK = 256
#: Bytes of anchors in one scan, and candidates that are bounded together.
SCAN_BYTES = 32 << 20
ROWS = 2048
#: From this share of a level's pairs on, all of them are scored by one product.
DENSE = 0.05
#: Components whose signs tell blocks apart.
SIGNS = 16
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_NONE = _LEAST


def prepared(vectors: DataFrame) -> DataFrame:
    """Saved ``vec_id``, ``label``, ``v`` (whole numbers) of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), x.cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).filter(finite)
    label = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = cut_lineage(rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda c: F.floor(SCALE * c)).alias("v")))
    again = cut_lineage(rows.groupBy("vec_id").count().filter("count > 1").select("vec_id"))
    if not again.limit(1).count():
        return rows
    one = lookup(rows, again, ["vec_id"], "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return cut_lineage(lookup(rows, again, ["vec_id"], "left_anti").unionByName(one.select("vec_id", "r.label", "r.v")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, padded with zeros."""
    column = column.cast(pa.large_list(pa.int64()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of rows. Floats hold whole numbers up to 2 ** 53 and multiply fast."""
    most = [float(np.abs(m).max(initial=0)) for m in (x, y)]
    bound = most[0] * most[1] * x.shape[1]
    if bound < 2.0**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return x @ y.T
    exact = x.astype(object) @ y.astype(object).T
    if (np.abs(exact) > _MOST // 2).any():
        raise ValueError("a score does not fit in a long")
    return exact.astype(np.int64)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent (-1: root), length of the edge to it and depth of every vector, by Prim's method."""
    n = len(vectors)
    gram = _products(vectors, vectors).astype(np.float64)
    norm = np.diag(gram)
    apart = np.sqrt(np.maximum(norm[:, None] + norm - 2 * gram, 0))
    parent, depth = np.full(n, -1), np.zeros(n, np.int64)
    edge = np.full(n, np.inf)
    open_ = np.ones(n, bool)
    at = int(apart.sum(axis=1).argmin())
    edge[at] = 0
    for _ in range(n):
        open_[at] = False
        nearer = open_ & (apart[at] < edge)
        edge[nearer], parent[nearer], depth[nearer] = apart[at][nearer], at, depth[at] + 1
        if open_.any():
            at = int(np.where(open_, edge, np.inf).argmin())
    return parent, edge, depth


_TREE = "block bigint, place int, parent int, edge double, depth int, vec_id bigint, label bigint, v array<bigint>, known array<bigint>"


def _grower(width: int) -> Callable:
    """Spanning tree of a block, and the best scores of the same label inside it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        vectors, label = _matrix(table.column("v").chunk(0), width), table.column("label").to_numpy()
        parent, edge, depth = spanning_tree(vectors)
        scores = np.where(label[:, None] == label, _products(vectors, vectors), _NONE)
        np.fill_diagonal(scores, _NONE)
        best = np.sort(scores, axis=1)[:, ::-1][:, :POSITIVES]
        return pa.table(
            {
                "block": table.column("block"), "place": pa.array(np.arange(len(label)), pa.int32()), "parent": pa.array(parent, pa.int32()),
                "edge": pa.array(edge, pa.float64()), "depth": pa.array(depth, pa.int32()), "vec_id": table.column("vec_id"),
                "label": table.column("label"), "v": table.column("v"), "known": pa.array([r[r > _NONE].tolist() for r in best], pa.list_(pa.int64())),
            }
        )

    return run


@dataclass
class Block:
    """Anchors of one tree, ordered by depth, with the windows they ask for (one column each)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    depth: np.ndarray
    same: bool
    low: np.ndarray
    high: np.ndarray
    keep: int
    #: Best found so far: anchor times window, score, vec_id.
    best: tuple[np.ndarray, np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(0, np.int64),) * 3)


def bounded_scores(block: Block, x: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """Scores of the candidates ``x`` (rows) for all anchors (columns) where ``wanted`` and the bounds
    overlap the anchor's windows, otherwise ``_NONE``; and the number of pairs scored."""
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))[:, None] * (1 + 1e-9)
    low, high = np.empty(wanted.shape), np.empty(wanted.shape)
    out = np.full(wanted.shape, _NONE)
    least, most = block.low.min(axis=1).astype(float), block.high.max(axis=1).astype(float)
    scored = 0
    for level in range(int(block.depth.max()) + 1):
        at = np.flatnonzero(block.depth == level)
        ask = wanted[:, at]
        if level:
            up = block.parent[at]
            # Rounding is far below the slack.
            around = block.edge[at] * norm + 1 + 1e-12 * (np.abs(low[:, up]) + np.abs(high[:, up]))
            low[:, at], high[:, at] = low[:, up] - around, high[:, up] + around
            ask = ask & (high[:, at] >= least[at]) & (low[:, at] <= most[at])
        if not level or ask.mean() > DENSE:
            exact = _products(x, block.vectors[at])
            low[:, at] = high[:, at] = exact
            out[:, at] = np.where(ask, exact, _NONE)
            scored += ask.size
            continue
        for k, anchor in enumerate(at.tolist()):
            some = np.flatnonzero(ask[:, k])
            if len(some):
                exact = _products(x[some], block.vectors[anchor : anchor + 1])[:, 0]
                low[some, anchor] = high[some, anchor] = out[some, anchor] = exact
                scored += len(some)
    return out, scored


def _merged(best: tuple[np.ndarray, ...], keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` best rows of each window."""
    order = np.lexsort((best[2], -best[1], best[0]))
    key, score, ids = (b[order] for b in best)
    first = np.searchsorted(key, key)
    top = np.arange(len(key)) - first < keep
    return key[top], score[top], ids[top]


def _scan(block: Block, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
    """Take a slice of candidates into the best of a block."""
    wanted = (labels[:, None] == block.labels) == block.same
    wanted &= ids[:, None] != block.ids
    scores, _ = bounded_scores(block, x, wanted)
    windows = block.low.shape[1]
    keys, found, names = [block.best[0]], [block.best[1]], [block.best[2]]
    for w in range(windows):
        row, anchor = np.nonzero((scores >= block.low[:, w]) & (scores <= block.high[:, w]) & (scores > _NONE))
        keys.append(anchor * windows + w)
        found.append(scores[row, anchor])
        names.append(ids[row])
    block.best = _merged((np.concatenate(keys), np.concatenate(found), np.concatenate(names)), block.keep)
    # A window with enough found asks for nothing below the last of them any more.
    key, score, _ = block.best
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True)) if len(key) else np.zeros(0, np.int64)
    count = np.bincount(key, minlength=block.low.size)
    full = last[count[key[last]] == block.keep]
    flat = block.low.reshape(-1)
    flat[key[full]] = np.maximum(flat[key[full]], score[full])


_FOUND = "anchor_id bigint, window int, score bigint, other bigint"


def _scanner(shared, width: int) -> Callable:
    """Best rows of a partition for every window of the anchors in the broadcast ``shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [Block(**{k: v.copy() if isinstance(v, np.ndarray) else v for k, v in b.items()}) for b in shared.value]
        for batch in batches:
            ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            vectors = _matrix(batch.column("v"), width)
            for at in range(0, len(ids), ROWS):
                part = slice(at, at + ROWS)
                for block in blocks:
                    _scan(block, vectors[part], ids[part], labels[part])
        for block in blocks:
            key, score, other = block.best
            windows = block.low.shape[1]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor_id": pa.array(block.ids[key // windows], pa.int64()), "window": pa.array((key % windows).astype(np.int32)),
                    "score": pa.array(score, pa.int64()), "other": pa.array(other, pa.int64()),
                }
            )

    return run


def _blocks(table: pa.Table, width: int, same: bool) -> list[dict]:
    """Anchors of one scan by block, with the windows of the pass."""
    out = []
    table = table.sort_by([("block", "ascending"), ("place", "ascending")]).combine_chunks()
    number = table.column("block").to_numpy()
    if not len(number):
        return out
    starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    for first, last in zip(starts, [*starts[1:], len(number)], strict=True):
        part = table.slice(first, last - first).combine_chunks()
        column = lambda name: part.column(name).to_numpy()  # noqa: E731, B023
        n = len(part)
        if same:
            known = part.column("known").to_pylist()
            low = np.array([[k[POSITIVES - 1] if len(k) >= POSITIVES else _LEAST + 1] for k in known], np.int64)
            high = np.full((n, 1), _MOST)
        else:
            # No score lies in the window of a missing positive.
            low, high = np.full((n, POSITIVES), _MOST), np.full((n, POSITIVES), _LEAST)
            for i, scores in enumerate(part.column("scores").to_pylist()):
                for w, s in enumerate(scores or []):
                    low[i, w], high[i, w] = -(-BAND[0] * s // 100), BAND[1] * s // 100
        out.append(
            {"ids": column("vec_id"), "labels": column("label"), "vectors": _matrix(part.column("v").chunk(0), width), "parent": column("parent"),
             "edge": column("edge"), "depth": column("depth"), "same": same, "low": low, "high": high, "keep": POSITIVES if same else NEGATIVES}
        )
    return out


def _pass(rows: DataFrame, anchors: DataFrame, blocks: int, width: int, same: bool) -> DataFrame:
    """Best rows of every task for the windows of all anchors, a bounded number of anchors a scan."""
    spark = rows.sparkSession
    step = max(1, SCAN_BYTES // (8 * BLOCK * (width + 16)))
    found: DataFrame | None = None
    for first in range(0, blocks, step):
        some = anchors.filter((F.col("block") >= first) & (F.col("block") < first + step)).toArrow()
        shared = spark.sparkContext.broadcast(_blocks(some, width, same))
        made = cut_lineage(rows.mapInArrow(_scanner(shared, width), _FOUND))
        shared.destroy()
        found = made if found is None else found.unionByName(made)
    return found if found is not None else spark.createDataFrame([], _FOUND)


def _best(found: DataFrame, keys: list[str], keep: int, name: str) -> DataFrame:
    """The ``keep`` best of each window. Every task has sent as many at most, so a window's rows are few."""
    order: list[Column] = [F.desc("score"), F.asc("other")]
    ranked = found.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= keep)


def mine(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``
    for the anchors of ``vectors`` (``vec_id``, ``embedding``, ``label``)."""
    ship(vectors.sparkSession)
    rows = prepared(vectors)
    width = max(1, rows.select(F.max(F.size("v"))).first()[0] or 1)
    anchors = rows.filter(F.col("vec_id") % ANCHOR_STEP == 0)
    signs = F.transform(F.slice("v", 1, SIGNS), lambda c: c < 0)
    placed = global_index(anchors.withColumn("_signs", signs), [F.col("_signs"), F.col("vec_id")], "_at").drop("_signs")
    placed = placed.withColumn("block", F.floor(F.col("_at") / block)).drop("_at")
    trees = cut_lineage(placed.groupBy("block").applyInArrow(_grower(width), _TREE))
    blocks = (trees.agg(F.max("block")).first()[0] or 0) + 1
    positives = _best(_pass(rows, trees, blocks, width, same=True), ["anchor_id"], POSITIVES, "p")
    positives = cut_lineage(positives.select("anchor_id", (F.col("p") - 1).alias("window"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")))
    scores = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("window", "positive_score"))).alias("s"))
    asked = cut_lineage(trees.drop("known").join(scores, "vec_id", "left").withColumn("scores", F.col("s.positive_score")).drop("s"))
    negatives = _best(_pass(rows, asked, blocks, width, same=False), ["anchor_id", "window"], NEGATIVES, "rank")
    out = negatives.join(positives, ["anchor_id", "window"])
    return out.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return mine(spark.read.parquet(f"{folder}/embeddings.parquet"))


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""
