import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, place int, _t int, cls string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with nulls, ties, repeated rows, empty and long texts, and clashing columns."""
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w7 ", "other ").replace("w50", "last")
    passage = " ".join(f"p{i}" for i in range(30))
    long = " ".join(f"x{i % 997}" for i in range(30_000))
    texts = [
        (1, base, "a"), (2, near, "a"), (3, base, "a"), (4, passage + " tail one", "b"), (5, "head " + passage, "b"),
        (6, "", "b"), (7, None, None), (8, "short text", "c"), (9, "short text", "c"), (None, base + " more", None),
        (None, "no id\nline two with more than forty characters in it", None), (10, long, "c"), (11, long + " end", "c"),
        (12, "line two with more than forty characters in it\n" + passage, "a"), (12, "another text of the same id", "a"),
        (13, "a b c\ta\n\nb c a b c a b c a b c a b c a b c a b c a b c a b c", "a"), (8, "short text", "c"),
        (14, "x" * 50_000, "d"), (15, "É é ﬁ 😀\u0000 ▁ end", "d"), (16, "Mail a@b.c and call +1 (415) 555-0100", "d"),
    ]
    rows = [(i, t, "en", s, len(t or ""), "mine", 5, 6, "k") for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
