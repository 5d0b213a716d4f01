"""Mix sources to target weights by Pareto order sampling.

Target shares of the sources are filled up to a ceiling of whole repeats. Within a source every
document has an expected number of copies; its whole part is certain, and the fraction is its
inclusion probability. Documents are ranked by the odds of a random number over the odds of
inclusion, and a source takes them in that order until the words it still lacks are reached:
a sample of fixed size in words. The random number is a hash, so reruns agree.

The cut is found without sorting a source: ranks fall into narrow bins, words are summed per bin
before the shuffle, and only the bin that holds the cut is sorted.

Defined cases: a null or empty text has size 0 and takes 0 words; a null source is a source and
comes last; rows that agree in doc_id and text are taken or left together; an empty table gives an
empty table; other columns pass through, and those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from ..session import cut_lineage
from .common import documents, lookup, words

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
#: Rows of the largest bin that is sorted, about.
BIN_ROWS = 20_000
_DRAW = float(2**52)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size`` (words) and ``_h``, the hash that the random number comes from."""
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.drop("size").withColumns(
        {"size": F.size(words(text)).cast("bigint"), "_h": F.md5(F.concat_ws(":", name, body))}
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source``, ``source_size``, ``target`` per source, from rows with ``source`` and ``size``.

    Shares above the ceiling are cut and the excess is shared anew by weight. Each turn is one
    sum over the sources; two numbers reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_index(per_source, [F.col("source").asc_nulls_last()], "_rank")
    each = F.array(*[F.lit(w) for w in weights])
    ranked = cut_lineage(
        ranked.withColumn("_w", F.get(each, F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")).cast("bigint"))
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    ceiling = F.col("source_size") * max_copies
    share, capped = 0.0, None
    while True:
        over = F.col("_w") * F.lit(share) > ceiling
        n, taken, weight = ranked.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, ceiling)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("_w"))), F.lit(0)),
        ).first()
        if n == capped or not weight:
            break
        share, capped = (total - taken) / weight, n
    target = F.least(F.col("_w") * F.lit(share), ceiling.cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def _expected(df: DataFrame, weight: Column, max_copies: int) -> DataFrame:
    """Add ``_e``, the expected copies: in proportion to ``weight``, at most ``max_copies``,
    so that the expected words of a source are its target. ``df`` is a saved table."""
    df = df.withColumn("_weight", weight.cast("double"))
    rate = df.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("_weight")).alias("_all"))
    rate = cut_lineage(rate.select("source", F.coalesce(F.try_divide("target", "_all"), F.lit(0.0)).alias("_rate")))
    while True:
        tried = lookup(df, rate, ["source"])
        over = F.col("_weight") * F.col("_rate") > max_copies
        free = F.coalesce(F.sum(F.when(~over, F.col("size") * F.col("_weight"))), F.lit(0.0))
        left = F.first("target") - F.coalesce(F.sum(F.when(over, F.col("size") * max_copies)), F.lit(0))
        new = cut_lineage(
            tried.groupBy("source", "_rate").agg(F.coalesce(F.try_divide(left, free), F.col("_rate")).alias("_new"))
        )
        # Rates only rise, and by no more once no further document reaches the ceiling.
        if not new.filter(F.col("_new") > F.col("_rate") * (1 + 1e-9)).limit(1).count():
            return tried.withColumn("_e", F.least(F.col("_weight") * F.col("_rate"), F.lit(float(max_copies)))).drop("_weight", "_rate")
        rate = new.select("source", F.col("_new").alias("_rate"))


def mix(
    docs: DataFrame,
    weight: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """Rows of ``docs`` with ``source_size``, ``target``, ``copies`` and ``taken``.

    ``docs`` is a saved table with ``source`` and the columns of :func:`sized`. ``weight`` is a
    preference per document; without one all documents of a source are expected equally often.
    """
    docs = docs.drop("source_size", "target", "copies", "taken")
    goal = cut_lineage(targets(docs, weights, max_copies))
    df = lookup(docs, goal, ["source"])
    if weight is None:
        df = df.withColumn("_e", F.least(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)), F.lit(float(max_copies))))
    else:
        df = _expected(df, weight, max_copies)
    draw = (F.conv(F.substring("_h", 1, 13), 16, 10).cast("double") + 0.5) / F.lit(_DRAW)
    part = F.col("_e") - F.floor("_e")
    df = df.withColumns({"_whole": F.floor("_e"), "_part": part, "_u": draw})
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_part") / (1 - F.col("_part")))
    df = df.withColumn("_q", F.when(F.col("_part") > 0, odds)).drop("_u", "_e")

    rows = docs.count()
    bins = 1 << max(6, (rows // BIN_ROWS).bit_length())
    df = df.withColumn("_bin", F.floor(F.col("_q") / (1 + F.col("_q")) * bins))
    per_bin = df.groupBy("source", "_bin").agg(
        F.sum("size").alias("_words"), F.sum(F.col("size") * F.col("_whole")).alias("_certain"), F.first("target").alias("target")
    )
    source = Window.partitionBy("source")
    before = source.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.withColumn("_lacks", F.col("target") - F.sum("_certain").over(source)).filter("_bin IS NOT NULL")
    per_bin = per_bin.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    # The bin in which the words reach what the source lacks.
    cut = per_bin.filter((F.col("_before") < F.col("_lacks")) & (F.col("_before") + F.col("_words") >= F.col("_lacks")))
    last = per_bin.groupBy("source").agg(F.max("_bin").alias("_top"), F.max("_lacks").alias("_need"), F.sum("_words").alias("_sum"))
    cut = cut_lineage(
        last.withColumnRenamed("source", "_source")
        .join(cut, F.col("_source").eqNullSafe(F.col("source")), "left")
        .select(
            F.col("_source").alias("source"),
            # Rounding may leave the sum of all bins just short: then all are taken.
            F.coalesce("_bin", F.when(F.col("_need") > 0, F.col("_top") + 1), F.lit(-1)).alias("_cut"),
            "_before", "_lacks",
        )
    )
    inside = lookup(df.select("source", "size", "_bin", "_q", "_h"), cut, ["source"]).filter("_bin = _cut")
    order = source.orderBy("_q", "_h").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("_before") + F.sum("size").over(order)
    inside = inside.withColumn("_reached", reached)
    ends = inside.groupBy("source").agg(
        F.min_by(F.struct("_q", "_h"), F.struct(F.abs(F.col("_reached") - F.col("_lacks")), "_reached", "_q", "_h")).alias("_end"),
        F.min(F.abs(F.col("_reached") - F.col("_lacks"))).alias("_miss"),
        F.first(F.abs(F.col("_before") - F.col("_lacks"))).alias("_none"),
    )
    ends = ends.select(F.col("source").alias("_source"), F.when(F.col("_miss") < F.col("_none"), F.col("_end")).alias("_end"))
    cut = cut_lineage(
        cut.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select("source", "_cut", F.col("_end._q").alias("_q1"), F.col("_end._h").alias("_h1"))
    )
    df = lookup(df, cut, ["source"])
    inside_cut = (F.col("_q") < F.col("_q1")) | ((F.col("_q") == F.col("_q1")) & (F.col("_h") <= F.col("_h1")))
    extra = (F.col("_bin") < F.col("_cut")) | ((F.col("_bin") == F.col("_cut")) & inside_cut)
    copies = F.col("_whole") + F.coalesce(extra, F.lit(False)).cast("bigint")
    df = df.withColumn("copies", copies.cast("bigint")).withColumn("taken", F.col("copies") * F.col("size"))
    return df.select(*docs.columns, "source_size", "target", "copies", "taken")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = cut_lineage(sized(documents(spark, folder, "doc_id", "source", "text")).drop("text"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source
), turn AS (
  SELECT 0 AS k, 0.0::DOUBLE AS share
  UNION ALL
  SELECT k + 1, (SELECT (sum(source_size) - coalesce(sum(source_size * 3) FILTER (WHERE w * share > source_size * 3), 0))::DOUBLE
                        / coalesce(sum(w) FILTER (WHERE w * share <= source_size * 3), 1) FROM s)
  FROM turn WHERE k < (SELECT count(*) FROM s) + 1
), g AS (
  SELECT source, source_size, least(w * (SELECT max(share) FROM turn), (source_size * 3)::DOUBLE) AS target FROM s
), e AS (
  SELECT d.*, source_size, target, floor(least(target / source_size, 3.0))::BIGINT AS whole, least(target / source_size, 3.0) - floor(least(target / source_size, 3.0)) AS part,
         (('0x' || h[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), q AS (SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS q FROM e),
c AS (
  SELECT *, sum(size) FILTER (WHERE q IS NOT NULL) OVER (PARTITION BY source ORDER BY q NULLS LAST, h ROWS UNBOUNDED PRECEDING) AS reached,
         target - sum(size * whole) OVER (PARTITION BY source) AS lacks
  FROM q
), best AS (
  SELECT source, arg_min(reached, abs(reached - lacks)) AS upto FROM (
    SELECT source, reached, lacks FROM c WHERE q IS NOT NULL UNION ALL SELECT DISTINCT source, 0, lacks FROM c)
  GROUP BY source
)
SELECT doc_id, size, source_size, target, (size * (whole + (coalesce(q IS NOT NULL AND reached <= upto, false))::INT))::BIGINT AS taken
FROM c JOIN best ON c.source IS NOT DISTINCT FROM best.source
"""
