"""Merkle fixity audit of archived pages (WARC records).

Pages are laid out as WARC response records: files of a fixed number of records, each with an offset
and a length. A record's leaf is the hash of its bytes and of its place (file, start, length). Every
``FAN`` ordered leaves make a node, and so on up to one root over ordered offset ranges of the whole
archive. Two replicas are compared root first; only the children of differing nodes are compared at
the next level, so an intact branch is never read again.

Nodes hold ``FAN`` children at most, each level is a table of its own, and only the number of levels
is known to the driver.

Defined cases: null url or html is empty; a null page_id comes last; rows that are equal get places of
their own; an empty archive has no root and differs from any other in all records; records that only
one replica has are ``missing`` or ``added``; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from ..session import cut_lineage
from .common import lookup

FAN = 16
FILE_RECORDS = 1_000


def record(url: Column, html: Column) -> Column:
    """Bytes of a WARC response record, as text."""
    body = F.coalesce(html, F.lit(""))
    size = F.octet_length(body).cast("string")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), size, F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def layout(pages: DataFrame, *keep: str) -> DataFrame:
    """``seq``, ``file``, ``start``, ``length``, ``digest``, ``page_id`` of every page, by page_id, and
    the columns to ``keep``."""
    whole = record(F.col("url"), F.col("html"))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.octet_length(whole).cast("bigint").alias("length"), F.sha2(whole, 256).alias("digest"), *keep
    )
    # The tie number only separates equal rows.
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col("page_id").asc_nulls_last(), F.col("digest"), F.col("_tie")]
    rows = global_index(rows, order, "seq").drop("_tie").withColumn("file", F.floor(F.col("seq") / FILE_RECORDS).cast("bigint"))
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))


def leaves(records: DataFrame) -> DataFrame:
    """``node``, ``digest`` of every record of a layout."""
    return records.select(F.col("seq").alias("node"), F.sha2(F.concat_ws(":", "file", "start", "length", "digest"), 256).alias("digest"))


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of saved nodes, leaves first, the root last."""
    levels = [cut_lineage(leaves(records))]
    while levels[-1].limit(2).count() > 1:
        parent = F.floor(F.col("node") / FAN).cast("bigint")
        children = F.sort_array(F.collect_list(F.struct("node", "digest")))
        nodes = levels[-1].groupBy(parent.alias("node")).agg(children.alias("_c"))
        digest = F.sha2(F.array_join(F.transform("_c", lambda x: F.concat_ws("=", x["node"], x["digest"])), "|"), 256)
        levels.append(cut_lineage(nodes.select("node", digest.alias("digest"))))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    x, y = a.select(F.col("node").alias("_a"), F.col("digest").alias("_x")), b.select(F.col("node").alias("_b"), F.col("digest").alias("_y"))
    joined = x.join(y, F.col("_a") == F.col("_b"), "full_outer").filter(~F.col("_x").eqNullSafe(F.col("_y")))
    return joined.select(F.coalesce("_a", "_b").alias("node"))


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records in which two saved layouts differ: ``seq``, ``file``, ``start``, ``length``, ``page_id``
    (of ours, or of theirs where we lack it) and ``status``."""
    a, b = tree(ours), tree(theirs)
    height = max(len(a), len(b))
    empty = ours.sparkSession.createDataFrame([], "node bigint, digest string")
    a, b = ([*levels, *[empty] * (height - len(levels))] for levels in (a, b))
    suspects = None
    for x, y in zip(reversed(a), reversed(b), strict=True):
        if suspects is not None:
            parent = F.floor(F.col("node") / FAN).cast("bigint")
            x, y = (
                lookup(level.withColumn("_up", parent), suspects.withColumnRenamed("node", "_up"), ["_up"], "left_semi").drop("_up")
                for level in (x, y)
            )
        suspects = cut_lineage(_differing(x, y))
        if not suspects.take(1):
            return _details(ours, theirs, suspects)
    return _details(ours, theirs, suspects)


def _details(ours: DataFrame, theirs: DataFrame, suspects: DataFrame) -> DataFrame:
    seq = suspects.withColumnRenamed("node", "seq")
    columns = ["seq", "file", "start", "length", "page_id", "digest"]
    mine = lookup(ours.select(*columns), seq, ["seq"], "left_semi")
    other = lookup(theirs.select(*columns), seq, ["seq"], "left_semi").withColumnsRenamed({c: f"_{c}" for c in columns})
    both = mine.join(other, F.col("seq") == F.col("_seq"), "full_outer")
    status = F.when(F.col("_seq").isNull(), "missing").when(F.col("seq").isNull(), "added").otherwise("changed")
    return both.select(*[F.coalesce(c, f"_{c}").alias(c) for c in columns[:-1]], status.alias("status"))


def damaged(page_id: Column, url: Column, html: Column) -> Column:
    """Digests of a replica to audit: by a hash of page_id, some pages have a changed last character
    and some are lost (null)."""
    draw = F.conv(F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit(""))), 1, 4), 16, 10).cast("int") % 100
    changed = F.concat(F.substring(html, F.lit(1), F.length(html) - 1), F.lit("\u0001"))
    digest = F.sha2(record(url, F.when(draw == 1, changed).otherwise(html)), 256)
    return F.when(draw != 2, digest)


def op2_fixity(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    replica = damaged(F.col("page_id"), F.col("url"), F.col("html"))
    # The replica has the places of the original: its files were copied, then damaged.
    both = cut_lineage(layout(pages.withColumn("_replica", replica), "_replica"))
    theirs = both.filter("_replica IS NOT NULL").drop("digest").withColumnRenamed("_replica", "digest")
    return audit(both.drop("_replica"), theirs)


SQL = r"""
WITH r AS (
  SELECT page_id, ('0x' || md5(coalesce(page_id::VARCHAR, ''))[1:4])::INT % 100 AS draw, row_number() OVER (ORDER BY page_id) - 1 AS seq, html,
         strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS length
  FROM pages
), p AS (SELECT *, seq // 1000 AS file, coalesce(sum(length) OVER (PARTITION BY seq // 1000 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM r)
SELECT seq::BIGINT AS seq, file::BIGINT AS file, start, length::BIGINT AS length, page_id, CASE draw WHEN 1 THEN 'changed' ELSE 'missing' END AS status
FROM p WHERE draw = 2 OR (draw = 1 AND html IS NOT NULL)
"""
