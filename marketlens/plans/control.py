"""Quota use, alerts, safety gate and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.dates import day
from ..functions.numeric import as_col, clamp, round_to
from ..functions.rules import at_least, classify

GB = float(1024**3)


def alert_level(percent) -> Column:
    return at_least(as_col(percent), V.ALERT_LEVEL, "NORMAL")


def usage_month(jobs: DataFrame, as_of, project: str) -> DataFrame:
    """GB processed by finished query jobs of a project since the first of the month."""
    rows = jobs.filter(
        (F.to_date("creation_time") >= F.trunc(day(as_of), "MM"))
        & (F.col("job_type") == "QUERY")
        & (F.col("state") == "DONE")
        & (F.col("project_id") == project)
    )
    total = F.coalesce(F.sum("total_bytes_processed"), F.lit(0))
    return rows.agg((total / F.lit(GB)).alias("current_usage"))


def storage_total(objects: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum(F.coalesce("length", F.lit(0))), F.lit(0))
    return objects.agg((total / F.lit(GB)).alias("current_usage"))


def usage_rows(usage: DataFrame, service: str, resource: str, limit_gb: float, as_of) -> DataFrame:
    """Usage with percentage, level and what is left."""
    percent = F.col("current_usage") / F.lit(limit_gb) * 100
    return usage.select(
        F.lit(service).alias("service"),
        F.lit(resource).alias("resource_type"),
        round_to("current_usage", 6).alias("current_usage"),
        F.lit(limit_gb).alias("limit_gb"),
        F.lit("GB").alias("unit"),
        round_to(clamp(percent, 0.0, 100.0), 6).alias("usage_percentage"),
        alert_level(percent).alias("alert_level"),
        round_to(F.greatest(F.lit(0.0), F.lit(limit_gb) - F.col("current_usage")), 6).alias("remaining"),
        day(as_of).alias("check_date"),
    )


def all_usage(jobs: DataFrame, objects: DataFrame, as_of, project: str) -> DataFrame:
    query = usage_rows(usage_month(jobs, as_of, project), "warehouse", "query_processing", V.QUOTA_GB["query_processing"], as_of)
    store = usage_rows(storage_total(objects), "storage", "total_storage", V.QUOTA_GB["total_storage"], as_of)
    return query.unionByName(store)


def alerts(usage: DataFrame) -> DataFrame:
    """Rows above the normal level, with a text."""
    text = F.concat(
        "service", F.lit(" "), "resource_type", F.lit(" usage is "),
        round_to("usage_percentage", 1).cast("string"), F.lit("% of free tier limit"),
    )
    return usage.filter(F.col("alert_level") != "NORMAL").select(
        F.col("alert_level").alias("level"), "service", F.col("resource_type").alias("resource"),
        "usage_percentage", text.alias("message"),
    )


def usage_log(usage: DataFrame) -> DataFrame:
    """Rows for the append-only usage log."""
    return usage.select(
        F.col("check_date").alias("usage_date"),
        F.col("service").alias("service_name"),
        "resource_type",
        F.col("current_usage").alias("usage_amount"),
        F.col("unit").alias("usage_unit"),
        F.col("limit_gb").alias("free_tier_limit"),
        "usage_percentage",
        F.lit(0.0).alias("cost_usd"),
        F.col("check_date").cast("timestamp").alias("check_time"),
    )


def safety_gate(usage: DataFrame, required_gb: float, limit_gb: float) -> DataFrame:
    """Whether a load of ``required_gb`` may start: stop from 95 %, caution from 80 %."""
    percent = (F.col("current_usage") + F.lit(required_gb)) / F.lit(limit_gb) * 100
    shown = round_to(percent, 1).cast("string")
    return usage.select(
        round_to(percent, 6).alias("projected_percentage"),
        (percent < 95).alias("safe"),
        classify(
            [
                (percent >= 95, F.concat(F.lit("Processing would exceed 95% of free tier limit ("), shown, F.lit("%)"))),
                (percent >= 80, F.concat(F.lit("Proceeding with caution - "), shown, F.lit("% usage projected"))),
            ],
            F.concat(F.lit("Safe to proceed - "), shown, F.lit("% usage projected")),
        ).alias("reason"),
    )


def run_report(results: DataFrame, failures: int = 5) -> DataFrame:
    """Totals of a load run and its first failures by file name."""
    ok = F.col("success")
    said = lambda text: F.count_if(ok & (F.col("message") == text))
    sums = results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        said("skipped").alias("skipped"),
        said("processed").alias("processed"),
        F.coalesce(F.sum(F.when(ok, F.coalesce("records_processed", F.lit(0)))), F.lit(0)).alias("records"),
        round_to(F.coalesce(F.avg(F.when(ok, F.coalesce("data_quality_score", F.lit(0.0)))), F.lit(0.0)), 6).alias("mean_quality"),
    )
    line = F.concat_ws(": ", "filename", "message")
    first = results.filter(~ok).select(line.alias("line")).orderBy("line").limit(failures)
    listed = first.agg(F.array_join(F.sort_array(F.collect_list("line")), "; "))
    return sums.withColumn("first_failures", listed.scalar())
