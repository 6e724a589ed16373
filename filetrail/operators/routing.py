"""Routing of events to time-named targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetrail.functions.names import DEFAULT_LAYOUT, target_name

# Which time names the target.
ROUTES = ("timeNow", "onOrBefore", "eventTimestamp", "insertionTimestamp")


def routing_time(route_by: str, processed_at: Column, window_end: Column | None,
                 event_time: Column, insertion_time: Column) -> Column:
    """The time that names the target, by the route option."""
    choice = dict(zip(ROUTES, [processed_at, window_end, event_time, insertion_time]))
    if route_by not in choice:
        raise ValueError(f"route must be one of {', '.join(ROUTES)}: {route_by}")
    if choice[route_by] is None:
        raise ValueError("routing by window end needs events with window columns")
    return choice[route_by]


def route(df: DataFrame, base: str, time: Column, layout: str = DEFAULT_LAYOUT) -> DataFrame:
    """Add the ``target`` column."""
    return df.withColumn("target", target_name(base, time, layout))


def targets_needed(df: DataFrame) -> DataFrame:
    return df.select("target").distinct()


def targets_missing(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Targets the rows need that ``existing`` (column ``target``) does not have."""
    return targets_needed(df).join(existing.select("target"), "target", "left_anti")
