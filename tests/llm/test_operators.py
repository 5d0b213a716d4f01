import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from marketlens.llm import fingerprints, fixity, graph, hashing, host_rules, jaccard, line_dedup, mixing, personal_data, pieces, substrings, toxicity
from marketlens.llm.common import BATCH_BYTES, ship
from marketlens.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def table(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def documents(corpus):
    return table(corpus, "doc_id", "text", "source")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_jaccard_equals_brute_force(corpus, empty):
    sets = []
    for i, text, _ in documents(corpus):
        words = WORD.findall(lower(text))
        n = min(5, len(words))
        sets.append((i, {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()))
    comp = list(range(len(sets)))
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                comp = [comp[a] if c == comp[b] else c for c in comp]
    ids = defaultdict(list)
    for c, (i, _) in zip(comp, sets, strict=True):
        ids[c].append(i)
    want = []
    for c, (i, x) in zip(comp, sets, strict=True):
        known = [k for k in ids[c] if k is not None]
        want.append((i, len(x), min(known) if x and known else i))
    got = table(jaccard.jaccard_components(corpus), "doc_id", "n_shingles", "component_id")
    assert Counter(got) == Counter(want)
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_links_large_groups_without_products_inside(spark):
    base = [f"w{i}" for i in range(100)]
    texts = []
    for k in range(60):
        words = base.copy()
        words[k] = f"e{k}"
        texts.append((k, " ".join(words)))
    texts += [(100 + k, " ".join(base[:20] + [f"u{k}_{j}" for j in range(60)])) for k in range(30)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = dict(table(jaccard.jaccard_components(df), "doc_id", "component_id"))
    assert {got[k] for k in range(60)} == {0} and all(got[100 + k] == 100 + k for k in range(30))


def test_rows_outside_a_large_group_meet_few_of_its_rows(spark):
    rows = [(gram, cls, 1 if cls < 500 else cls, 1) for gram in (1, 2) for cls in range(520)]
    mixed = spark.createDataFrame(rows, "gram bigint, cls bigint, comp bigint, main bigint")
    picked = table(jaccard._some(mixed), "gram", "cls", "comp", "main")
    assert set(picked) <= set(rows) and all(comp == main for _, _, comp, main in picked)
    per_gram = {gram: {cls for g, cls, _, _ in picked if g == gram} for gram in (1, 2)}
    assert all(len(some) == jaccard.PICKS for some in per_gram.values()) and per_gram[1] != per_gram[2]


def test_components_contract_groups_and_chains(spark, monkeypatch):
    random.seed(8)
    chain = [(k, k + 1) for k in range(100, 160)]
    zigzag = [(200 + min(k, 60 - k) * 2 + (k > 30), 200 + min(k + 1, 59 - k) * 2 + (k + 1 > 30)) for k in range(60)]
    group = [(a, b) for a in range(400, 440) for b in range(a + 1, 440)]
    some = [(random.randrange(600, 700), random.randrange(600, 700)) for _ in range(60)]
    edges = [(a, b) for a, b in chain + zigzag + group + some if a != b]
    read = []
    saved = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: (out := saved(df), read.append((out.columns, out.count())))[0])
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert dict(table(graph.components(spark.createDataFrame(edges, "a bigint, b bigint")), "node", "label")) == label
    # The edges are there once; what later rounds read is less than an edge for two nodes.
    sizes = [n for columns, n in read if columns == ["a", "b"]]
    assert sizes[0] == len(set(edges)) and all(n <= len(label) // 2 for n in sizes[1:]) and sizes[-1] == 0


@pytest.mark.parametrize("length", [13, 2, 3, 29])
def test_substrings_equal_brute_force(corpus, empty, length):
    rows = [(LAST if i is None else i, i, WORD.findall(t or "")) for i, t, _ in documents(corpus)]
    first = {}
    for place, _, words in rows:
        for k in range(len(words) - length + 1):
            run = tuple(words[k : k + length])
            first[run] = min(first.get(run, place), place)
    want = []
    for place, i, words in rows:
        gone = {j for k in range(len(words) - length + 1) if first[tuple(words[k : k + length])] < place for j in range(k, k + length)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        want.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = table(substrings.substring_dedup(corpus, length), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(got) == Counter(want)
    assert substrings.substring_dedup(empty, length).count() == 0


def test_substring_levels_double():
    assert [substrings._levels(n) for n in (2, 3, 13, 14, 29, 50)] == [[1, 2], [2, 3], [7, 13], [7, 14], [4, 8, 16, 29], [7, 14, 28, 50]]


def test_quality_measures(corpus, empty):
    want = []
    for i, text, _ in documents(corpus):
        text = text or ""
        words = WORD.findall(text)
        runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {j for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        want.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed))
    df = host_rules.quality(corpus)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(table(df, *names)) == Counter(want)
    assert df.filter("kept AND base_failed").count() == 0 and "size" in df.columns
    assert host_rules.quality(empty).count() == 0


def test_bad_host_is_rejected_and_rates_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(k, f"h{k % 8}", good) for k in range(400)] + [(1000 + k, "bad", good if k % 10 == 0 else "junk") for k in range(50)]
    rows += [(2000, "tiny", "junk")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    judged = cut_lineage(host_rules.judge_documents(host_rules.measure(docs)))
    hosts = {r["host"]: r for r in host_rules.host_verdicts(judged).collect()}
    assert hosts["bad"]["rejected"] and not hosts["h0"]["rejected"]
    assert hosts["tiny"]["rate"] == 1.0 and hosts["tiny"]["shrunk_rate"] < 1.0
    kept = {r["doc_id"] for r in host_rules.apply_verdicts(judged, host_rules.host_verdicts(judged)).filter("kept").collect()}
    assert kept == set(range(400))


def test_mixing(corpus, empty):
    sized = cut_lineage(mixing.sized(corpus))
    rows = mixing.mix(sized).collect()
    again = mixing.mix(sized)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again.collect()))
    by_source = defaultdict(list)
    for r in rows:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by_source[r["source"]].append(r)
    total = sum(r["size"] for r in rows)
    assert abs(sum(x[0]["target"] for x in by_source.values()) - total) < 1e-6
    for x in by_source.values():
        assert x[0]["target"] <= 3 * x[0]["source_size"] == 3 * sum(r["size"] for r in x)
        assert abs(sum(r["taken"] for r in x) - x[0]["target"]) <= max((r["size"] for r in x), default=0)
    assert mixing.mix(cut_lineage(mixing.sized(empty))).count() == 0


def test_mixing_by_weight_prefers_heavy_documents(spark):
    rows = [(k, "ab"[k % 2], " ".join(["w"] * 20), float(1 + 3 * (k % 4 == 0))) for k in range(400)]
    docs = cut_lineage(mixing.sized(spark.createDataFrame(rows, "doc_id bigint, source string, text string, worth double")))
    out = mixing.mix(docs, F.col("worth")).groupBy("source", "worth").agg(F.avg("copies").alias("c"), F.sum("taken").alias("t"), F.max("target").alias("g")).collect()
    rate = {(r["source"], r["worth"]): r["c"] for r in out}
    assert rate["a", 4.0] > 2 * rate["a", 1.0]
    assert abs(sum(r["t"] for r in out if r["source"] == "a") - next(r["g"] for r in out if r["source"] == "a")) <= 20


def test_fingerprints(spark, corpus, empty):
    df = fingerprints.with_next(corpus)
    order = sorted(documents(corpus), key=lambda r: LAST if r[0] is None else r[0])
    following = defaultdict(set)
    for k, (i, t, _) in enumerate(order):
        following[i, t or ""].add(order[(k + 1) % len(order)][1] or "")
    got = table(df, "doc_id", "text", "next_text")
    assert len(got) == len(order)
    single = [r for r in got if list(x[0] for x in order).count(r[0]) == 1 and r[0] not in (7, 9, 11)]
    assert all(n in following[i, t] for i, t, n in single if i is not None)
    texts = spark.createDataFrame([(1, "One. Two, three.\nFour."), (2, "Four.Two, One. three.\n"), (3, "One. "), (4, None), (5, "")], "id bigint, text string")
    made = {r["id"]: r for r in fingerprints.vectors(texts, {"text": "v"}, "id").select("id", "v", fingerprints.as_text(F.col("v")).alias("f")).collect()}
    assert made[4]["v"] == made[5]["v"] == [0] * fingerprints.WIDTH and len(made) == 5
    pair = spark.createDataFrame([(made[1]["v"], made[3]["v"])], "a array<bigint>, b array<bigint>")
    both = pair.select(fingerprints.remove(fingerprints.combine(F.col("a"), F.col("b")), F.col("b")).alias("x")).first()["x"]
    assert both == made[1]["v"]
    shuffled = spark.createDataFrame([(1, "A b, c. \nD e."), (2, "c. \nA b, D e.")], "id bigint, text string")
    v = [tuple(r["v"]) for r in fingerprints.vectors(shuffled, {"text": "v"}, "id").collect()]
    assert v[0] == v[1]
    assert fingerprints.with_next(empty).count() == 0


def test_pieces_equal_the_library(spark, corpus, empty):
    path = pieces.model_path()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    more = ["  a   b ", " " * 40, "==  ==\n\n\t", "1234567890" * 30, "naïve▁▁text", "<s> </s> <0x0A> <unk>", "中文字符測試", "\u0000�\U0001F600" * 3]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(more)), "doc_id bigint, text string"))
    want = []
    for i, text in table(docs, "doc_id", "text"):
        ids = model.encode(text or "")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(model.decode(ids) if ids else "")))
    out = pieces.encode(docs, path, keep_ids=True)
    assert Counter(table(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == Counter(want)
    back = out.select(F.sha2(pieces.decode_ids("ids", path), 256).alias("x"), "decoded_sha256")
    assert back.filter("x <> decoded_sha256").count() == 0
    assert pieces.encode(empty, path).count() == 0


def test_pieces_of_a_word_are_made_once_whatever_follows_it(monkeypatch):
    random.seed(9)
    made = pieces.Pieces(pieces.model_path())
    words = sorted({"".join(random.choices("aeinrst", k=8)) for _ in range(60_000)})
    calls = []
    tokens = made.tokens
    monkeypatch.setattr(made, "tokens", lambda text: calls.append(text) or tokens(text))
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for text in (" ".join(words), " ".join(f"{w}." for w in words), " ".join(f"({w}%%%" for w in words[:500])):
        ids = library.encode(text)
        assert made.whole(text) == (",".join(map(str, ids)), library.decode(ids))
    assert len(calls) <= len(words) + 600


def test_toxicity(spark, corpus, empty):
    draw = random.Random(1)
    filler = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for k in range(300):
        words = draw.choices(filler, k=40)
        if k % 4 == 0:
            words[5 + k % 20] = ("vile,", "Rotten")[k % 8 == 0]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    field = toxicity.fit(docs, known, ~toxicity.held_out())
    scored = toxicity.score(docs, field, spans=True).collect()
    for r in scored:
        assert (r["score"] >= toxicity.PREDICT) == (r["doc_id"] % 4 == 0)
        text = rows[r["doc_id"]][1]
        assert {text[s["from"] : s["to"]].lower() for s in r["spans"]} <= {"vile", "rotten"} and bool(r["spans"]) == (r["doc_id"] % 4 == 0)
    assert toxicity.score(corpus, field).count() == corpus.count() and toxicity.score(empty, field).count() == 0
    nothing = toxicity.fit(docs, known.limit(0), F.lit(True))
    assert max(r["score"] for r in toxicity.score(docs, nothing).collect()) < 1e-6


def test_marginals_equal_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    field = toxicity.Field(np.zeros(0, np.uint64), np.zeros(0), 0.0, rng.normal(size=(2, 2)), rng.normal(size=2), (0.0, 0.0))
    score, first = rng.normal(size=300), np.zeros(300, bool)
    first[[0, 6, 7, 140]] = True
    p = toxicity.marginals(score, first, field)
    for a, b in ((0, 6), (6, 7)):
        mass = np.zeros(b - a)
        total = 0.0
        for states in itertools.product((0, 1), repeat=b - a):
            w = field.start[states[0]] + sum(score[a + k] for k, s in enumerate(states) if s)
            w = np.exp(w + sum(field.transition[i, j] for i, j in zip(states, states[1:])))
            total += w
            mass += w * np.array(states)
        assert np.allclose(p[a:b], mass / total)


def test_personal_data(spark, corpus, empty):
    texts = [
        (1, "Mail x.y@a.b.c, or a@b.c_d@e.f; host 10.0.0.255 not 10.0.0.256"), (2, "card 4111 1111 1111 1111 and 4111111111111112"),
        (3, "é call +1 (415) 555-0100 or +123"), (4, "IBAN DE89 3704 0044 0532 0130 00 but DE88 3704 0044 0532 0130 00"), (5, "phone 415 555 0100"),
        (6, "415 555 0100"), (7, "1" * 60_000), (8, "a" * 60_000 + "@b.c"), (9, None), (10, "1.2.3.4.5.6.7.8 00000001.0002.3.4"),
    ]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = personal_data.find(df)
    got = {r["doc_id"]: r for r in found.select("doc_id", personal_data.listed(F.col("base_spans")).alias("b"), personal_data.listed(F.col("all_spans")).alias("a")).collect()}
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for i, text in texts:
        spans = []
        for order, (kind, pattern) in enumerate(patterns.items()):
            for m in re.finditer(pattern, text or "" if i not in (7, 8) else ""):
                d = re.sub("[^0-9]", "", m[0])
                luhn = sum(int(c) if k % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for k, c in enumerate(reversed(d))) % 10 == 0
                fits = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}
                if fits[kind]:
                    spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
        if i not in (7, 8):
            assert got[i]["b"] == ",".join(s[2] for s in sorted(spans))
    assert got[7]["b"] == "" and got[8]["b"] == "email:0:60004"
    assert got[4]["a"] == "iban:5:32" and got[5]["a"] == "number:6:18" and got[6]["a"] == ""
    redacted = {r["doc_id"]: r["text"] for r in personal_data.redact(found).collect()}
    assert redacted[3] == "é call [PHONE] or +123" and redacted[9] is None
    assert personal_data.find(corpus).count() == corpus.count() and personal_data.find(empty).count() == 0


def test_alignment_and_line_dedup(spark, corpus, empty):
    a, b = list("xabcyxz"), list("qabcdxz")
    assert [a[i] for i, _ in line_dedup.align(a, b)] == list("abcxz")
    shared = ["first shared line that is long enough to count", "ok", "second shared line that is long enough as well"]
    texts = [(1, "\n".join(["own", *shared, "end"])), (2, "\n".join([*shared, "mine"])), (3, "ok\nother"), (4, "\n".join([*shared, "mine"])), (5, "ok")]
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert [out[i]["text"] for i in range(1, 6)] == [texts[0][1], "mine", "ok\nother", "", "ok"]
    assert [out[i]["n_removed"] for i in range(1, 6)] == [0, 3, 0, 4, 0]
    df = line_dedup.dedup_lines(corpus)
    assert df.count() == corpus.count() and set(corpus.columns) <= set(df.columns)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_of_many_documents_pair_with_the_first(spark):
    line = "a notice of more than forty characters that everyone has"
    rows = [(k, f"own text number {k} of this document\n{line}") for k in range(50)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(r["n_removed"] for r in out.collect()) == {0: 1, 1: 49}


def test_fixity_finds_exactly_the_damage(spark):
    rows = [(k if k % 50 else None, f"http://h/{k}", f"<p>{k}</p>" if k % 7 else None) for k in range(3_000)] + [(1, "http://h/1", "<p>1</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    ours = cut_lineage(fixity.layout(pages))
    assert ours.count() == 3_001 and ours.agg(F.count_distinct("seq")).first()[0] == 3_001
    broken = F.when(F.col("seq").isin(0, 17, 1024), F.lit("x")).otherwise(F.col("digest"))
    theirs = cut_lineage(ours.withColumn("digest", broken).filter("seq <> 2999"))
    got = {(r["seq"], r["status"]) for r in fixity.audit(ours, theirs).collect()}
    assert got == {(0, "changed"), (17, "changed"), (1024, "changed"), (2999, "missing")}
    assert fixity.audit(ours, ours).count() == 0
    nothing = ours.limit(0)
    assert fixity.audit(nothing, nothing).count() == 0
    assert {r["status"] for r in fixity.audit(nothing, cut_lineage(ours.filter("seq < 40"))).collect()} == {"added"}


@pytest.mark.parametrize("name", ["a", "b"])
def test_odd_documents(spark, corpus, empty, name):
    from corpus_pipeline import STAGES

    docs = corpus if name == "a" else empty
    for label, stage in STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, label
        docs = cut_lineage(out)
    out = STAGES[-1][1](spark, docs, "")
    assert out.columns[:2] == ["doc_id", "n_tokens"] and out.count() == docs.count()


def all_pairs(texts, least=line_dedup.MIN_CHARS):
    """Texts after aligning each with all of a smaller id."""
    lines = {i: [x.strip() for x in t.split("\n")] for i, t in texts}
    out = {}
    for i, t in texts:
        before = [lines[k] for k, _ in texts if k < i]
        sizes = [len(x) for x in lines[i]]
        if sum(sizes) >= least and lines[i] in before:
            out[i] = ""
            continue
        gone = {g for other in before for g in line_dedup.common_blocks(lines[i], other, sizes, least)}
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone) if gone else t
    return out


def same_as_all_pairs(spark, texts):
    made = line_dedup.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string"))
    got, want = {r["doc_id"]: r["text"] for r in made.collect()}, all_pairs(texts)
    assert {i for i in want if got[i] != want[i]} == set()
    return got


def test_blocks_of_hot_lines_are_found_in_any_holder(spark):
    a, b = "a hot line of thirty letters 1", "a hot line of thirty letters 2"
    texts = [(1, a), (2, b), *[(k, f"own {k}\n{a}\n{b}\nend {k}") for k in range(3, 13)]]
    got = same_as_all_pairs(spark, texts)
    assert [got[k] for k in (3, 4, 12)] == [texts[2][1], "own 4\nend 4", "own 12\nend 12"]
    # The first holder has the two lines in the other order, so one of them crosses.
    a, b = a + " and some more", b + " and some more"
    same_as_all_pairs(spark, [(1, f"{b}\nfirst\n{a}"), *[(k, f"{a}\nown {k}\n{b}") for k in range(2, 14)]])


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_all_pairs(spark, seed):
    dice = random.Random(seed)
    hot = [f"hot {k} " + "h" * dice.choice([5, 12, 25, 50]) for k in range(9)] + [""]
    rare = [f"rare {k} " + "r" * dice.choice([5, 30, 60]) for k in range(30)]
    texts = []
    for i in range(150):
        pool = [*dice.choices(hot, k=dice.randint(2, 7)), *dice.choices(rare, k=dice.randint(0, 2)), *[f"own {i} {k}" for k in range(dice.randint(0, 2))]]
        if dice.random() < 0.6:
            pool.sort()
        else:
            dice.shuffle(pool)
        texts.append((i, "\n".join(pool)))
    same_as_all_pairs(spark, texts)


def test_likeness_of_texts_of_many_pieces(spark):
    def text(name, start, stop):
        return "".join(f"{name}{k}\n" for k in range(start, stop))

    whole = text("a", 0, 200_000)
    pairs = [(1, whole, text("b", 0, 200_000)), (2, whole, text("a", 0, 100_000)), (3, whole, "one short text"), (4, "x\n" * 200_000, "x\n" * 100_000)]
    df = spark.createDataFrame(pairs, "id bigint, a text, b text".replace("text", "string"))
    df = fingerprints.vectors(df, {"a": "v", "b": "w"}, "id")
    for name in ("v", "w"):
        df = df.withColumn(f"{name}_c", fingerprints.centred(F.col(name)))
        df = df.withColumn(f"{name}_s", fingerprints._dot(F.col(f"{name}_c"), F.col(f"{name}_c")))
    near = {r["id"]: r["near"] for r in fingerprints.likeness(df, "near", "v", "w").collect()}
    # Half of the pieces: cosine 0.71. One lane in twelve is the deviation of an estimate.
    assert near[1] < 0.35 and 0.5 < near[2] < 0.9 and near[3] < 0.35 and near[4] > 0.99


@pytest.mark.parametrize("n", [30, 90])
def test_crossing_runs_make_few_pairs(spark, monkeypatch, n):
    """Two hot lines in either order, and a rare line that each document shares with one other: the pairs
    follow the documents, not their square."""
    a, b = ("a hot line of more than forty characters " + x for x in "ab")
    texts = []
    for k in range(2 * n):
        mark = f"a mark of documents {k % n}"
        texts.append((k, "\n".join([a, mark, b] if (k // 2) % 2 else [b, mark, a])))
    made = []
    aligned = line_dedup._aligned
    monkeypatch.setattr(line_dedup, "_aligned", lambda pairs, *rest: made.append(pairs.count()) or aligned(pairs, *rest))
    same_as_all_pairs(spark, texts)
    assert sum(made) <= 20 * n


def test_personal_data_of_very_many_numbers(spark):
    """Time follows the numbers of one text; places and context are those of short texts."""
    import time

    line = "call 4155550100, host 10.0.0.7, card 4111 1111 1111 1111; ref 20240131x "
    texts = [(1, line * 5_000), (2, " ".join(str(10**9 + 7919 * k) for k in range(200_000))), (3, "x " * 50 + line)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    start = time.time()
    spans = {r["doc_id"]: r["all_spans"] for r in personal_data.find(df).collect()}
    assert time.time() - start < 60
    one = [(s["from"] - 100, s["to"] - 100, s["kind"], s["score"]) for s in spans[3]]
    assert {k for _, _, k, _ in one} == {"ip", "card", "number"}
    first = [(s["from"], s["to"], s["kind"], s["score"]) for s in spans[1][: len(one)]]
    assert [x[:3] for x in first] == [x[:3] for x in one]
    last = [(s["from"] - 4_999 * len(line), s["to"] - 4_999 * len(line), s["kind"]) for s in spans[1][-len(one) :]]
    assert last == [x[:3] for x in one] and len(spans[1]) == 5_000 * len(one)


def test_join_stage_decides_by_row(spark):
    """Two texts of one id are judged each by itself; of repeated rows one stays; rows without words stay."""
    from marketlens.llm import stages

    a, z = (" ".join(f"{c}{k}" for k in range(40)) for c in "az")
    near = a + " more"
    rows = [(1, a, "s"), (5, a, "t"), (5, z, "u"), (None, a, "v"), (None, a, "v"), (7, near, "w"), (8, "", "x"), (None, None, "y"), (9, "", "x"), (9, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    out = stages.jaccard_join(spark, docs, "")
    assert out.columns == docs.columns
    want = [(1, a, "s"), (5, z, "u"), (8, "", "x"), (None, None, "y"), (9, "", "x"), (9, "", "x")]
    assert Counter(map(tuple, out.collect())) == Counter(want)
    only = spark.createDataFrame([(None, a, "v"), (None, near, "w"), (3, z, "u"), (3, z, "u")], docs.schema)
    kept = [tuple(r) for r in stages.jaccard_join(spark, only, "").collect()]
    assert sorted(r[1] for r in kept) in ([a, z], [near, z])


def test_fingerprint_query_equals_brute_force(spark):
    """Edited texts, fingerprints and likeness of every document, in plain Python."""
    import numpy as np
    import regex
    import xxhash

    folder = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    cut = regex.compile(r"(?V1)(?<=\n)|(?<=[^\p{L}\p{N} \t\n\x0B\f\r] )")

    def vector(text):
        counts, head = np.zeros((3, 24, 2), np.int64), [0, 0, 0]
        for piece in [p for p in cut.split(text) if p]:
            first = xxhash.xxh64_intdigest(piece.encode(), 42)
            hashes = [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), first) for i in range(3)]
            head[0] += 1
            head[1] += hashes[0] & ((1 << 30) - 1)
            head[2] += hashes[0] >> 34
            for i, h in enumerate(hashes):
                for k in range(24):
                    counts[i, k, 0] += (h >> k) & 1
                    counts[i, k, 1] += (h >> (k + 30)) & 1
        words = [x % 2**60 for x in head] + [(int(b) << 30) + int(a) for a, b in counts.reshape(-1, 2)]
        return "".join(f"{w:015x}" for w in words), (2 * counts - head[0]).ravel().astype(float)

    def likeness(a, b):
        if a[0] == b[0]:
            return 1.0
        size = np.sqrt((a[1] @ a[1]) * (b[1] @ b[1]))
        return min(1.0, max(0.0, a[1] @ b[1] / size)) if size else 0.0

    made = {r.doc_id: r for r in fingerprints.op6_fingerprints(spark, folder).collect()}
    assert len(made) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        v, e, x = vector(text), vector(edited), vector(after)
        r = made[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (v[0], e[0])
        assert abs(r.near_edited - likeness(v, e)) < 1e-9 and abs(r.near_next - likeness(v, x)) < 1e-9


def test_batches_to_python_functions_are_bounded_by_bytes(spark):
    ship(spark)
    texts = spark.range(0, 2_000, 1, 1).select(F.rpad(F.col("id").cast("string"), 10_000, "x").alias("text"))
    sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n bigint").collect()
    assert sum(r.n for r in sizes) >= 20_000_000 and max(r.n for r in sizes) < 2 * BATCH_BYTES


def test_recurring_ngrams_are_found_across_batches():
    texts = ["a b c d e f", "a b c d e g", "z"]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "t": [i + 5], "text": [t]}) for i, t in enumerate(texts)]
    rows = [r for b in jaccard._profiler(5, 0)(iter(batches)) for r in b.to_pylist()]
    assert [(r["doc_id"], r["t"], r["n"]) for r in rows if r["n"] is not None] == [(0, 5, 2), (1, 6, 2), (2, 7, 1)]
    assert [r["uses"] for r in rows if r["n"] is None] == [2]


def test_slices_of_short_rows_hold_few_rows(monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE", 10 * (jaccard.ROW + 1))
    row = ((1, 2), [3], (4, 5))
    assert [len(s) for s in jaccard._sliced(iter([row] * 25))] == [10, 10, 5]


def test_workers_forget_the_model_when_another_operator_comes():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "t": [2], "text": ["some words"]})
    for _ in range(2):
        list(hashing.released(pieces._encoder(pieces.model_path(), False))(iter([batch])))
        assert pieces.load.cache_info().currsize == 1
    list(hashing.released(jaccard._setter(5, 0))(iter([batch])))
    assert pieces.load.cache_info().currsize == 0
