"""Toxic spans by a linear-chain conditional random field.

Two states per token, toxic or not. Forward-backward gives the probability of each token to be
toxic; these add up to a document score, and runs of likely tokens are the offending spans.

Training uses a bounded sample of labelled documents (``SAMPLE`` rows and ``SAMPLE_BYTES`` bytes at
most; near copies in it count once). Only documents are labelled, so the tokens of toxic documents
are labelled by the words that are far more frequent there. The field's weights (one per such
word, one for all other words, transitions and start) maximise the likelihood of these labels; a
logistic curve over the expected number of toxic tokens turns marginals into a score.

Scoring covers every token of every text. The chain is cut into blocks: products of the 2 x 2 step
matrices of a block join the blocks exactly, so all blocks of a batch advance together.

Defined cases: a null or empty text has no tokens and gets the score of no toxic tokens; rows with
no label, or a null label, are scored but not learned from; without labels of both kinds every score
is the share of toxic labels (0 without any); repeated rows each get the same result; an empty table
gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .hashing import slices, texts_of, tokens, windows

#: Most labelled rows and bytes of text that training reads, half of the rows toxic.
SAMPLE = 4_000
SAMPLE_BYTES = 64_000_000
#: A word marks toxic text when it is this many times as frequent in toxic documents, and is in
#: this share of them.
ODDS = 20.0
SHARE = 0.01
STEPS = 80
BLOCK = 128
PREDICT = 0.7
SPAN = 0.5
_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Field:
    """Words with weights (sorted by hash), the weight of other words, log transitions and start
    (entry 1 or column 1: toxic), and the curve's constants."""

    words: np.ndarray
    weights: np.ndarray
    other: float
    transition: np.ndarray
    start: np.ndarray
    curve: tuple[float, float]


def _blocks(x: np.ndarray, fill: float) -> np.ndarray:
    """Consecutive values in rows of ``BLOCK``, turned so that step k of all blocks is row k."""
    n = -(-len(x) // BLOCK) * BLOCK
    out = np.full(n, fill)
    out[: len(x)] = x
    return np.ascontiguousarray(out.reshape(-1, BLOCK).T)


def marginals(score: np.ndarray, first: np.ndarray, field: Field, pairs: bool = False):
    """Probability of each token to be toxic, for texts one after another.

    ``score`` is the log weight of the toxic state, ``first`` marks first tokens of texts. With
    ``pairs``, also the summed probabilities of state pairs and of first states.
    """
    n = len(score)
    if not n:
        return (np.zeros(0), np.zeros((2, 2)), np.zeros(2)) if pairs else np.zeros(0)
    a, s = np.exp(field.transition), np.exp(field.start)
    up = _blocks(np.exp(np.clip(score, -30, 30)), 1.0)
    begin = _blocks(first.astype(float), 0.0) > 0
    count = up.shape[1]
    # m[i][j]: from state i to state j, the emission of the token included.
    m = [[np.where(begin, s[j], a[i, j]) * (up if j else 1.0) for j in (0, 1)] for i in (0, 1)]
    p = [[np.ones(count), np.zeros(count)], [np.zeros(count), np.ones(count)]]
    for k in range(BLOCK):
        p = [[p[i][0] * m[0][j][k] + p[i][1] * m[1][j][k] for j in (0, 1)] for i in (0, 1)]
        size = np.maximum(np.maximum(p[0][0], p[0][1]), np.maximum(p[1][0], p[1][1]))
        p = [[p[i][j] / size for j in (0, 1)] for i in (0, 1)]
    whole = np.array(p).transpose(2, 0, 1).tolist()
    enter, leave = [], [(1.0, 1.0)] * count
    x, y = 1.0, 1.0
    for (c, d), (e, f) in whole:
        enter.append((x, y))
        x, y = x * c + y * e, x * d + y * f
        x, y = x / (x + y), y / (x + y)
    x, y = 1.0, 1.0
    for b in range(count - 1, -1, -1):
        leave[b] = (x, y)
        (c, d), (e, f) = whole[b]
        x, y = c * x + d * y, e * x + f * y
        x, y = x / (x + y), y / (x + y)
    f0, f1 = np.array(enter).T
    b0, b1 = np.array(leave).T
    forward = np.empty((2, BLOCK, count))
    backward = np.empty((2, BLOCK, count))
    for k in range(BLOCK):
        f0, f1 = f0 * m[0][0][k] + f1 * m[1][0][k], f0 * m[0][1][k] + f1 * m[1][1][k]
        size = f0 + f1
        f0, f1 = f0 / size, f1 / size
        forward[0, k], forward[1, k] = f0, f1
    for k in range(BLOCK - 1, -1, -1):
        backward[0, k], backward[1, k] = b0, b1
        b0, b1 = m[0][0][k] * b0 + m[0][1][k] * b1, m[1][0][k] * b0 + m[1][1][k] * b1
        size = b0 + b1
        b0, b1 = b0 / size, b1 / size
    flat = lambda z: z.T.reshape(-1)[:n]
    toxic = forward[1] * backward[1]
    p1 = flat(toxic / (toxic + forward[0] * backward[0]))
    if not pairs:
        return p1
    alpha = [flat(forward[i]) for i in (0, 1)]
    beta = [flat(backward[i]) for i in (0, 1)]
    inner = ~first[1:]
    joint = [[(alpha[i][:-1] * a[i, j] * (np.exp(np.clip(score[1:], -30, 30)) if j else 1.0) * beta[j][1:])[inner] for j in (0, 1)] for i in (0, 1)]
    total = sum(joint[i][j] for i in (0, 1) for j in (0, 1))
    two = np.array([[np.sum(joint[i][j] / total) for j in (0, 1)] for i in (0, 1)])
    ones = float(p1[first].sum())
    return p1, two, np.array([first.sum() - ones, ones])


def _sample(documents_: DataFrame, labels: DataFrame, training: Column, rows: int) -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts, half of them toxic, in the order of a hash of doc_id."""
    known = labels.filter(training & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.filter(F.col("toxic") == t).orderBy(*order).limit(rows // 2) for t in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = documents_.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.withColumn("_o", F.xxhash64("doc_id")).groupBy("doc_id", "_o", "toxic").agg(F.min("text").alias("text"))
    # The ids are bounded; the bytes are, too, because rows stream in by the order of the hash.
    out, size = [], 0
    for row in texts.orderBy("_o", "doc_id").toLocalIterator():
        size += len(row["text"])
        if size > SAMPLE_BYTES:
            break
        out.append((row["text"], int(row["toxic"])))
    return out


def _once(sample: list[tuple[str, int]]) -> list[tuple[str, int, np.ndarray]]:
    """The sample without near copies: texts that share a smallest hash of five-word windows."""
    seen: set[tuple[int, int]] = set()
    out = []
    column = pa.array([t for t, _ in sample], pa.string())
    for i, hashes in _each(column):
        grams = windows(hashes, min(5, max(1, len(hashes))))
        keys = {(k, int(windows(grams, 1, seed=k).min())) for k in range(4)} if len(grams) else {(0, 0)}
        if keys.isdisjoint(seen):
            out.append((*sample[i], hashes))
        seen |= keys
    return out


def _each(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    raw, offsets = texts_of(column)
    for a, b in slices(offsets):
        at = offsets[a : b + 1]
        hashes, bounds, _, _ = tokens(raw[at[0] : at[-1]], at - at[0], _GAPS, True)
        for i in range(a, b):
            yield i, hashes[bounds[i - a] : bounds[i - a + 1]]


def train(sample: list[tuple[str, int]]) -> Field:
    """Fit a field to (text, label) pairs; see the module text."""
    flat = np.zeros(2)
    kept = _once(sample)
    y = np.array([t for _, t, _ in kept])
    if not len(kept) or y.min() == y.max():
        share = float(np.mean([t for _, t in sample])) if sample else 0.0
        constant = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Field(np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros((2, 2)), flat, (float(constant), 0.0))
    counts: dict[int, list[int]] = {}
    for _, t, hashes in kept:
        for h in np.unique(hashes).tolist():
            counts.setdefault(h, [0, 0])[t] += 1
    toxic, clean = int(y.sum()), int(len(y) - y.sum())
    least = max(3, SHARE * toxic)
    odds = lambda c: (c[1] + 0.5) / (toxic + 1) / ((c[0] + 0.5) / (clean + 1))
    words = np.array(sorted(h for h, c in counts.items() if c[1] >= least and odds(c) >= ODDS), np.uint64)
    tokens_ = np.concatenate([h for _, _, h in kept]) if kept else np.zeros(0, np.uint64)
    lengths = np.array([len(h) for _, _, h in kept])
    first = np.zeros(len(tokens_), bool)
    starts = np.cumsum(lengths) - lengths
    first[starts[lengths > 0]] = True
    feature = _features(tokens_, words)
    label = (feature > 0) & (np.repeat(y, lengths) == 1)
    weight = np.zeros(len(words) + 1)
    transition, start = np.zeros((2, 2)), flat.copy()
    seen = np.bincount(feature, label, len(weight))
    both = ~first[1:]
    i, j = label[:-1][both].astype(int), label[1:][both].astype(int)
    seen_two = np.bincount(2 * i + j, minlength=4).reshape(2, 2).astype(float)
    seen_first = np.array([(~label[first]).sum(), label[first].sum()], float)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weight, transition, start)]
    scale = max(len(kept), 1)
    for step in range(1, STEPS + 1):
        field = Field(words, weight[1:], weight[0], transition, start, (0.0, 0.0))
        p, two, ones = marginals(weight[feature], first, field, pairs=True)
        gradients = (seen - np.bincount(feature, p, len(weight)) - 0.1 * weight, seen_two - two - 0.1 * transition, seen_first - ones - 0.1 * start)
        for x, g, mom in zip((weight, transition, start), gradients, moments, strict=True):
            g = g / scale
            mom[0] = 0.9 * mom[0] + 0.1 * g
            mom[1] = 0.99 * mom[1] + 0.01 * g * g
            x += 0.2 * (mom[0] / (1 - 0.9**step)) / (np.sqrt(mom[1] / (1 - 0.99**step)) + 1e-8)
    field = Field(words, weight[1:], float(weight[0]), transition, start, (0.0, 0.0))
    p = marginals(weight[feature], first, field)
    expected = np.bincount(np.repeat(np.arange(len(kept)), lengths), p, len(kept))
    field.curve = _curve(np.log1p(expected), y)
    return field


def _features(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """1 + place of each hash among the sorted words, 0 for others."""
    if not len(words):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at + 1, 0)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number, by Newton steps, slightly held back."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        ga, gb = np.sum(y - p) - 0.01 * a, np.sum((y - p) * x) - 0.01 * b
        haa, hab, hbb = w.sum() + 0.01, (w * x).sum(), (w * x * x).sum() + 0.01
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-12))
        a, b = a + step * da, b + step * db
    return float(a), float(b)


def _scorer(field: Field, spans: bool):
    table = np.concatenate([[field.other], field.weights])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts_of(batch.column("text"))
            expected = np.zeros(batch.num_rows)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for a, b in slices(offsets):
                at = offsets[a : b + 1]
                part = raw[at[0] : at[-1]]
                hashes, bounds, starts, ends = tokens(part, at - at[0], _GAPS, True)
                if not len(hashes):
                    continue
                first = np.zeros(len(hashes), bool)
                first[bounds[:-1][np.diff(bounds) > 0]] = True
                p = marginals(table[_features(hashes, field.words)], first, field)
                total = np.concatenate([[0.0], np.cumsum(p)])
                expected[a:b] = total[bounds[1:]] - total[bounds[:-1]]
                if spans:
                    _spans(found, a, part, at - at[0], bounds, starts, ends, p)
            score = 1 / (1 + np.exp(-np.clip(field.curve[0] + field.curve[1] * np.log1p(np.maximum(expected, 0)), -30, 30)))
            columns = {"doc_id": batch.column("doc_id"), "score": pa.array(score)}
            if spans:
                columns["spans"] = pa.array(found, _SPAN_TYPE)
            yield pa.RecordBatch.from_pydict(columns)

    return run


_SPAN_TYPE = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("p", pa.float64())]))


def _spans(found, base, part, offsets, bounds, starts, ends, p) -> None:
    """Runs of tokens that are likely toxic, as code point places in their text."""
    likely = np.flatnonzero(p >= SPAN)
    if not len(likely):
        return
    text = np.searchsorted(bounds, likely, "right") - 1
    breaks = np.flatnonzero((np.diff(likely) > 1) | (np.diff(text) > 0)) + 1
    for run, t in zip(np.split(likely, breaks), text[np.concatenate([[0], breaks])], strict=True):
        begin = offsets[t]
        points = lambda x: int(np.count_nonzero((part[begin:x] & 0xC0) != 0x80))  # noqa: E731, B023
        found[base + int(t)].append({"from": points(starts[run[0]]), "to": points(ends[run[-1]]), "p": float(p[run].max())})


def score(docs: DataFrame, field: Field, spans: bool = False) -> DataFrame:
    """``doc_id``, ``score`` and on demand ``spans`` (from, to, p) of every row."""
    schema = "doc_id bigint, score double" + (", spans array<struct<from:int,to:int,p:double>>" if spans else "")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_scorer(field, spans), schema)


def fit(docs: DataFrame, labels: DataFrame, training: Column, rows: int = SAMPLE) -> Field:
    return train(_sample(docs, labels, training, rows))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    field = fit(docs, labels, ~held_out())
    scored = score(docs, field, spans=True)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["from"], x["to"])), ",").alias("spans"),
    )
