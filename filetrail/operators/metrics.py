"""Counters as aggregates over the result tables."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pipeline_metrics(events: DataFrame, windows: DataFrame) -> DataFrame:
    """Per query: events processed and windows in progress."""
    counted = events.groupBy("query_name").agg(
        F.count("*").alias("events_total"), F.lit(0).cast("bigint").alias("windows_in_progress")
    )
    running = windows.groupBy("query_name").agg(
        F.lit(0).cast("bigint").alias("events_total"),
        F.count_if(F.col("status") == "open").alias("windows_in_progress"),
    )
    return counted.unionByName(running).groupBy("query_name").agg(
        F.sum("events_total").alias("events_total"),
        F.sum("windows_in_progress").alias("windows_in_progress"),
    )


def lookup_metrics(lookups: DataFrame) -> DataFrame:
    """One row of lookup counters.

    ``lookups`` has one row per lookup: ``hit`` (answered from the cache), ``status``
    of the answer and ``error`` text when the call failed. A cache hit counts as
    successful whatever location it holds.
    """
    hit = F.coalesce(F.col("hit"), F.lit(False))
    failed = ~hit & F.col("error").isNotNull()
    answered = ~hit & F.col("error").isNull()
    good = hit | (answered & (F.col("status") == "success"))
    refused = answered & (F.col("status") == "fail")
    return lookups.agg(
        F.count_if(hit).alias("cache_hits"),
        F.count_if(~hit).alias("lookups_forwarded"),
        F.count_if(good).alias("successful_lookups"),
        F.count_if(failed).alias("failed_requests"),
        F.count_if(refused).alias("failed_queries"),
        F.count_if(good).alias("code_200"),
        F.count_if(failed | refused).alias("code_400"),
    )


def cache_metrics(cache: DataFrame, as_of: datetime) -> DataFrame:
    """Rows ever added and rows usable at ``as_of``."""
    return cache.agg(
        F.count("*").alias("cached_total"),
        F.count_if(F.col("expiration_time") >= F.lit(as_of)).alias("cached_current"),
    )


def window_counts(events: DataFrame) -> DataFrame:
    """Events per window."""
    return events.groupBy("query_name", "on_or_after", "on_or_before").agg(
        F.count("*").alias("n_events")
    )


def tumbling_window(time: Column, start: datetime, gap: timedelta) -> Column:
    """The pull window as a Spark time window, for counting on a stream."""
    stride = gap + timedelta(milliseconds=1)
    offset = (start - datetime(1970, 1, 1, tzinfo=UTC)) % stride
    ms = timedelta(milliseconds=1)
    return F.window(
        time, f"{stride // ms} milliseconds", startTime=f"{offset // ms} milliseconds"
    )
