"""Spelling variants against brute force: plain edit distances, counts and chains of forms."""

import random
import re
import zlib
from collections import Counter

import duckdb

from marketlens.llm import spelling


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    out, forms = {}, {}
    for w, n in words.items():
        close = sorted((-words[x], x) for x in words if abs(len(x) - len(w)) < 2 and near(w, x))
        forms[w] = close[0][1] if close and -close[0][0] >= 2 * n else None
        out[w] = (n, len(close))
    rooted = {}
    for w in words:
        at = w
        while forms[at]:
            at = forms[at]
        rooted[w] = at
    return {(w, forms[w], rooted[w], *out[w], words[forms[w]] if forms[w] else None) for w in words}


def found(docs):
    rows = spelling.spelling_variants(docs).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def variants(seed, count):
    """Texts of words with many edits, so that chains of forms and ties occur."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 8))) for _ in range(30)]
    rows = []
    for i in range(count):
        text = []
        for _ in range(40):
            w = list(rng.choice(words))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1])] = rng.choice(["", "a", "Ü", "z"])
            text.append("".join(w))
        rows.append((i, rng.choice([" ", ", ", "\n", "1"]).join(text)))
    return rows


def test_variants_equal_brute_force(spark):
    rows = variants(1, 200)
    # A chain of forms.
    rows += [(1000, "shells " * 60), (1001, "shellz " * 25), (1003, "sheelz " * 9), (1004, "sheeelz " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert found(docs) == want
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] != w[2] and w[1] for w in want)


def test_odd_documents(corpus, empty, spark):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    assert found(corpus) == brute(rows)
    assert spelling.spelling_variants(empty).count() == 0
    long = "q" * 3000
    rows = [(i, f"{long} {long}r {long[1:]} ×÷Àßx") for i in (1, 2, 3, 3, None)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_hot_buckets_are_cut_again(spark):
    """Words that share their first half: with a small bound all zones are cut, with the same pairs."""
    rng = random.Random(2)
    words = sorted({"common" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(400)})
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    want = {(a, b) for a in words for b in words if near(a, b)}
    for block, hot in ((64, 8), (2048, 8192)):
        assert {(r.word, r.near) for r in spelling.near_words(table, block, hot).collect()} == want
    sizes = spelling._buckets(table, 8).groupBy("bucket").count().agg({"count": "max"}).first()[0]
    assert sizes <= 3 + 9


def test_lookup_of_all_errors():
    words = ["apple", "aple", "apples", "bapple", "appel", "apply", "xpple", "apxple", "apple" * 3, "applex", "pple"]
    first, second = spelling.near_pairs(words)
    assert sorted(zip(first.tolist(), second.tolist(), strict=True)) == [
        (i, j) for i in range(len(words)) for j in range(len(words)) if near(words[i], words[j])
    ]


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = {tuple(r) for r in spelling.op12_spelling(spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == set(con.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({spelling.SQL})").fetchall())
