"""MinHash near-dedup against all pairs of whole sets."""

import random
import tracemalloc

import duckdb
import numpy as np
import pytest

from marketlens.llm import hashing, minhash


def shingles_of(text, n=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0c", " ").split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, part, whole):
    """``(n, smallest id)`` of every row, by union of all pairs."""
    sets = [shingles_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both * whole >= (len(a) + len(sets[j]) - both) * part:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=str)


def found(docs, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_dedup(docs, **kw).collect()), key=str)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return " ".join(out)


def test_odd_documents(corpus, empty):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    assert found(corpus) == brute(rows, 85, 100)
    out = minhash.near_dedup(corpus)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert minhash.near_dedup(empty).count() == 0


def test_edited_copies_against_all_pairs(spark):
    """Copies of one text, each edited in its own way, so that many pairs lie near the threshold."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, edited(rng, base, i % 5)) for i in range(120)]
    rows += [(200 + i, " ".join(f"t{i}x{k}" for k in range(30))) for i in range(20)] + [(300, rows[0][1]), (None, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for similarity in ((85, 100), (75, 100)):
        assert found(docs, similarity=similarity) == brute(rows, *similarity)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, size, dtype=np.uint64)) for size in (1, 2, 7, 100, 3000)]
    sketch = minhash.sketches(sets)
    assert (sketch < minhash._EMPTY).all()
    common = rng.integers(0, 2**63, 600, dtype=np.uint64)
    share = []
    for _ in range(40):
        a, b = (np.concatenate([common, rng.integers(0, 2**63, 200, dtype=np.uint64)]) for _ in "ab")
        x, y = minhash.sketches([a, b])
        share.append((x == y).mean())
    assert abs(np.mean(share) - 0.6) < 0.02
    assert np.std(share) < 1.2 * (0.6 * 0.4 / minhash.COORDINATES) ** 0.5


def test_union_of_sketches():
    """Bins of a union are filled by the same elements as bins of its parts where these come first."""
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in "ab")
    x, y, u = minhash.sketches([a, b, np.concatenate([a, b])])
    assert ((u == x) | (u == y)).all()


def test_parities_bound_the_difference():
    rng = np.random.default_rng(6)
    for apart in (0, 3, 40, 900):
        common = rng.integers(0, 2**63, 400, dtype=np.uint64)
        more = rng.integers(0, 2**63, apart, dtype=np.uint64)
        x, y = hashing.parities([common, np.concatenate([common, more])], 8)
        bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert bits <= apart and (apart or not bits)
        assert bits % 2 == apart % 2


def test_bit_test_keeps_pairs_at_the_threshold():
    limit, p = minhash.most_apart((85, 100)), 0.75 * 0.15
    rng = np.random.default_rng(0)
    assert (rng.binomial(minhash.COORDINATES, p, 200_000) <= limit).all()


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.op13_near_dedup(spark, folder).collect()}
    assert got == set(con.sql(f"SELECT doc_id, n_shingles, component_id, kept FROM ({minhash.SQL})").fetchall())


def test_parities_hold_few_counters(monkeypatch):
    sets = [hashing.mix(np.arange(k, k + k % 7, dtype=np.uint64)) for k in range(4000)]
    tracemalloc.start()
    found = hashing.parities(sets, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_000_000
    monkeypatch.setattr(hashing, "COUNTERS", 3 * 64 * 16)
    assert (hashing.parities(sets, 16) == found).all() and hashing.parities([], 16).shape == (0, 16)
    for k in (0, 6, 3999):
        bits = np.bincount((sets[k] % np.uint64(1024)).astype(np.int64), minlength=1024) % 2
        assert (np.packbits(bits.astype(np.uint8)).view(np.int64) == found[k]).all()
