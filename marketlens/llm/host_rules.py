"""Quality rules judged per document and per host.

Each document is measured and held against rules. Failures are summed per host; a host's
failure rate is shrunk towards the rate of all hosts by a beta prior whose strength is
estimated from the hosts themselves. Documents of a host whose shrunk rate is above a limit
are rejected with it. All steps are built-in expressions.

Defined cases: a null or empty text has no words and fails; null hosts form one host; repeated
rows count once each; an empty table gives an empty table; further columns pass through, and
one that has the name of a measure is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import BROADCAST_ROWS, GAP_CHARS, documents, small, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Only rules that count for a host: symbols, repeated lines, word length.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
WORD_CHARS = (2, 12)
#: A host is rejected when more than half of its documents are expected to fail.
MAX_HOST_RATE = 0.5
SALTS = 32
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _next(array: Column, step: int) -> Column:
    """The array moved left by ``step``."""
    return F.slice(array, F.lit(step + 1), F.size(array))


def _joined(array: Column, step: int) -> Column:
    """Entry hashed with the one ``step`` places on; the last ``step`` results are void."""
    return F.zip_with(array, _next(array, step), lambda a, b: F.xxhash64(a, b))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of ``MEASURES``.

    Windows of eight words are compared by a 64-bit hash built by doubling (1, 2, 4, 8 words).
    Only texts with two equal windows are sorted to find which words they cover.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    df = docs.drop(*MEASURES).withColumn("_words", words(text))
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace(plain, f"[^{SYMBOLS}]+", "")).cast("bigint"),
            "_lines": F.filter(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != ""),
            "_h": F.when(F.size("_words") >= WINDOW, F.transform("_words", lambda w: F.xxhash64(w))),
        }
    ).drop("_words")
    for step in (1, 2, 4):
        df = df.withColumn("_h", _joined(F.col("_h"), step))
    df = df.withColumn("_h", F.slice("_h", F.lit(1), F.size("_h") - (WINDOW - 1)))
    # Sorted (hash, place) pairs put equal windows side by side.
    ordered = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_h", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), ordered))
    twins = F.zip_with("_h", _next(F.col("_h"), 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))
    df = df.withColumn("_h", places)
    covered = F.zip_with("_h", _next(F.col("_h"), 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    df = df.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": F.coalesce(
                F.aggregate(covered, F.lit(0).cast("bigint"), lambda s, x: s + x), F.lit(0).cast("bigint")
            ),
            "_n_lines": F.size("_lines"),
        }
    )
    return df.drop("_h", "_lines")


def judge_documents(measured: DataFrame) -> DataFrame:
    """Add ``fails`` (one flag per rule) and ``base_failed``."""
    n = F.col("n_words")
    short = n < MIN_WORDS
    repeats = F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT
    mean = F.try_divide(F.col("word_chars"), n)
    flags = {
        "short": short,
        "repeats": repeats,
        "symbols": F.col("n_symbols") * 100 > n * MAX_SYMBOL_PERCENT,
        "dup_lines": F.col("n_dup_lines") * 100 > F.col("_n_lines") * MAX_DUP_LINE_PERCENT,
        "word_length": F.coalesce(~mean.between(*WORD_CHARS), F.lit(True)),
    }
    fails = F.struct(*[flags[r].alias(r) for r in RULES])
    return measured.drop("fails", "base_failed").withColumns({"fails": fails, "base_failed": short | repeats}).drop("_n_lines")


def host_verdicts(judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per host: documents, failures by rule, raw and shrunk failure rate, ``rejected``.

    The prior is a beta distribution fitted to all hosts: its mean is the overall rate, its
    strength follows from how much more the hosts differ than chance alone would make them.
    Its five sums are all that reaches the driver.
    """
    any_rule = F.greatest(*[F.col(f"fails.{r}") for r in RULES])
    count = lambda flag: F.sum(flag.cast("bigint"))
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"),
        count(any_rule).alias("n_failed"),
        *[count(F.col(f"fails.{r}")).alias(f"n_{r}") for r in RULES],
    )
    hosts = cut_lineage(hosts)
    n, x = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    k, total, failed, squares, spread = (
        v or 0.0
        for v in hosts.agg(F.count("*"), F.sum(n), F.sum(x), F.sum(n * n), F.sum(x * x / n)).first()
    )
    mean = failed / total if total else 0.0
    between, room = spread - failed * mean, total - (squares / total if total else 0.0) - (k - 1)
    noise = mean * (1 - mean)
    share = (between / noise - (k - 1)) / room if noise > 0 and room > 0 else 0.0
    share = min(max(share, 1e-6), 1 - 1e-6)
    strength = (1 - share) / share
    shrunk = (x + mean * strength) / (n + strength)
    return hosts.withColumns({"rate": x / n, "shrunk_rate": shrunk, "rejected": shrunk > max_rate})


def apply_verdicts(judged: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """Add ``kept``: the document passes its own base rules and its host is not rejected.

    Only rejected hosts are joined: broadcast while few, else joined by salted hosts, so that a
    host with a large part of all documents is spread over many tasks.
    """
    bad = cut_lineage(hosts.filter("rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_bad")))
    same = F.col(host).eqNullSafe(F.col("_host"))
    if small(bad, BROADCAST_ROWS):
        joined = judged.join(F.broadcast(bad), same, "left")
    else:
        bad = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = judged.withColumn("_s", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = salted.join(bad, same & (F.col("_s") == F.col("_salt")), "left").drop("_s", "_salt")
    kept = ~F.col("base_failed") & F.col("_bad").isNull()
    return joined.drop("kept").withColumn("kept", kept).drop("_host", "_bad")


def quality(docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Documents with measures, rule flags and ``kept``. The measures are made once and saved."""
    judged = cut_lineage(judge_documents(measure(docs, text)))
    return apply_verdicts(judged, host_verdicts(judged, host, max_rate), host)


def op4_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "source", "text")
    # The text is left out before the measures are saved.
    judged = cut_lineage(judge_documents(measure(docs).drop("text")))
    out = apply_verdicts(judged, host_verdicts(judged))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents
), numbered AS (SELECT row_number() OVER () AS r, * FROM d),
each AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM numbered WHERE len(ws) >= 8),
runs AS (
  SELECT r, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o, lead(w, 5) OVER o,
                         lead(w, 6) OVER o, lead(w, 7) OVER o) AS run, lead(i, 7) OVER o AS last
  FROM each WINDOW o AS (PARTITION BY r ORDER BY i)
), same AS (SELECT r, i FROM runs WHERE last IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, run) > 1),
steps AS (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS step FROM same),
covered AS (SELECT r, sum(step)::BIGINT AS n FROM steps GROUP BY r),
m AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
  FROM numbered LEFT JOIN covered c USING (r)
), j AS (
  SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed,
         n_words < 20 OR n_repeat_words * 100 > n_words * 30 OR n_symbols * 100 > n_words * 10 OR n_dup_lines * 100 > n_lines * 30
           OR coalesce(word_chars / nullif(n_words, 0) NOT BETWEEN 2 AND 12, true) AS failed
  FROM m
), h AS (SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS x FROM j GROUP BY source),
p AS (SELECT count(*) AS k, sum(n) AS total, sum(x) / sum(n) AS mean, sum(n * n) AS squares, sum(x * x / n) - sum(x) * sum(x) / sum(n) AS between_ FROM h),
s AS (
  SELECT mean, CASE WHEN mean * (1 - mean) > 0 AND total - squares / total - (k - 1) > 0
    THEN least(greatest((between_ / (mean * (1 - mean)) - (k - 1)) / (total - squares / total - (k - 1)), 1e-6), 1 - 1e-6) ELSE 1e-6 END AS share
  FROM p
), bad AS (
  SELECT source FROM h, s WHERE (x + mean * (1 - share) / share) / (n + (1 - share) / share) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM j.source) AS kept
FROM j
"""
