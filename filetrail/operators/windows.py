"""Pull windows: planning, progress state, and assigning events to windows.

A window is ``[on_or_after, on_or_before]`` at millisecond precision, read here as
the half-open ``[on_or_after, on_or_before + 1 ms)``. Consecutive windows start
``gap + 1 ms`` apart. Time is always a parameter, never the clock.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetrail.operators.geo import BROADCAST_BYTES, fits_broadcast
from filetrail.plans.filters import MILLISECOND, instant

SETTLE_LAG = timedelta(minutes=15)
BLOCK = 10_000


def millis(d: timedelta) -> int:
    return d // MILLISECOND


def epoch_micros(t: datetime) -> int:
    return (t - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def current_windows(log: DataFrame) -> DataFrame:
    """One row per window of an append-only log; completed wins over open."""
    done = F.bool_or(F.col("status") == "completed")
    return log.groupBy("query_name", "on_or_after", "on_or_before").agg(
        F.when(done, "completed").otherwise("open").alias("status")
    )


def open_windows(windows: DataFrame) -> DataFrame:
    return windows.where(F.col("status") == "open")


def last_completed(windows: DataFrame) -> DataFrame:
    """Per query the completed window with the latest end; none gives no row."""
    window = F.max_by(F.struct("on_or_after", "on_or_before"), F.col("on_or_before"))
    return (
        windows.where(F.col("status") == "completed")
        .groupBy("query_name")
        .agg(window.alias("w"))
        .select("query_name", "w.*")
    )


def close_window(windows: DataFrame, query_name: str, start: datetime,
                 end: datetime) -> DataFrame:
    """Mark exactly this window completed; windows sharing one bound stay open."""
    same = (
        (F.col("query_name") == query_name)
        & (F.col("on_or_after") == F.lit(start))
        & (F.col("on_or_before") == F.lit(end))
    )
    return windows.withColumn("status", F.when(same, "completed").otherwise(F.col("status")))


def newest_windows(windows: DataFrame) -> DataFrame:
    """Per query the newer of its last open and its last completed window."""
    bounds = F.struct("on_or_after", "on_or_before")
    is_open = F.col("status") == "open"
    picked = windows.groupBy("query_name").agg(
        F.max_by(bounds, F.when(is_open, F.col("on_or_after"))).alias("o"),
        F.max_by(bounds, F.when(~is_open, F.col("on_or_before"))).alias("c"),
        F.bool_or(is_open).alias("has_open"),
        F.bool_or(~is_open).alias("has_completed"),
    )
    use_open = F.col("has_open") & (
        ~F.col("has_completed") | (F.col("c.on_or_before") <= F.col("o.on_or_after"))
    )
    return picked.select(
        "query_name", F.when(use_open, F.col("o")).otherwise(F.col("c")).alias("w")
    ).select("query_name", "w.*")


def plan_windows(windows: DataFrame, queries: DataFrame, as_of: datetime,
                 lag: timedelta = SETTLE_LAG) -> DataFrame:
    """New open windows of every query, up to its max time and ``as_of - lag``.

    ``queries`` has one row per query: ``(query_name, start_time, max_time, gap_ms)``.
    A query goes on one millisecond after its newest window, or starts at
    ``start_time`` (``as_of`` when absent). A window may end early at either limit,
    does not start at or after the max time, and never ends before it starts.
    """
    newest = newest_windows(windows).select("query_name", F.col("on_or_before").alias("_seen"))
    settled = F.unix_millis(F.lit(as_of - lag))
    maximum = F.unix_millis("max_time")
    first = F.coalesce(
        F.unix_millis("_seen") + 1, F.unix_millis(F.coalesce("start_time", F.lit(as_of)))
    )
    seeds = queries.join(newest, "query_name", "left").select(
        "query_name",
        "gap_ms",
        first.alias("first"),
        F.least(settled, maximum).alias("last_end"),
        F.least(settled, maximum - 1).alias("last_start"),
    )
    # Number the windows in blocks, so that no single array holds a long range.
    span = F.col("last_start") - F.col("first")
    stride = F.col("gap_ms") + 1
    count = F.when(span >= 0, ((span - F.pmod(span, stride)) / stride).cast("bigint") + 1)
    numbered = (
        seeds.withColumn("n", count)
        .where(F.col("n") > 0)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1,
                                                  F.lit(BLOCK).cast("bigint"))))
        .withColumn("i", F.explode(F.sequence("block", F.least(F.col("block") + (BLOCK - 1),
                                                               F.col("n") - 1))))
    )
    start = F.col("first") + F.col("i") * (F.col("gap_ms") + 1)
    return numbered.select(
        "query_name",
        F.timestamp_millis(start).alias("on_or_after"),
        F.timestamp_millis(F.least(start + F.col("gap_ms"), F.col("last_end"))).alias(
            "on_or_before"
        ),
        F.lit("open").alias("status"),
    )


def tumbling(time: Column, start: datetime, gap: timedelta, max_time: datetime | None = None,
             as_of: datetime | None = None,
             lag: timedelta = SETTLE_LAG) -> tuple[Column, Column, Column]:
    """(is in a window, ``on_or_after``, ``on_or_before``) of a time, by arithmetic.

    Same windows as :func:`plan_windows` from ``start``.
    """
    start = _to_millis(start)
    ends = [e for e in (max_time, as_of - lag if as_of else None) if e is not None]
    inside = time >= instant(start)
    if ends:
        inside = inside & (time < instant(_to_millis(min(ends)) + MILLISECOND))
    stride = millis(gap) * 1000 + 1000
    micros = F.unix_micros(time.cast("timestamp"))
    first = micros - F.pmod(micros - epoch_micros(start), F.lit(stride))
    if max_time is not None:
        inside = inside & (first < epoch_micros(max_time))
    last = first + millis(gap) * 1000
    if ends:
        last = F.least(last, F.lit(epoch_micros(_to_millis(min(ends)))))
    return inside, F.timestamp_micros(first), F.timestamp_micros(last)


def assign_tumbling(df: DataFrame, time: Column, start: datetime, gap: timedelta,
                    max_time: datetime | None = None, as_of: datetime | None = None,
                    lag: timedelta = SETTLE_LAG) -> DataFrame:
    """Add each event's window as ``on_or_after``/``on_or_before`` by arithmetic.

    Same windows as :func:`plan_windows` from ``start``; events outside them are
    dropped. No join and no shuffle, and the time range reaches the scan.
    """
    inside, first, last = tumbling(time, start, gap, max_time, as_of, lag)
    kept = df.where(inside)
    return kept.select(*df.columns, first.alias("on_or_after"), last.alias("on_or_before"))


def _to_millis(t: datetime) -> datetime:
    return t.replace(microsecond=t.microsecond // 1000 * 1000)


def assign_windows(df: DataFrame, time: Column, windows: DataFrame, gap: timedelta,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join events to the given windows, which may have any bounds.

    Adds ``query_name, on_or_after, on_or_before``; an event inside several windows
    appears once for each, an event in none is dropped. Windows are cut into buckets
    of one stride, so the join is an equality on the bucket and compares an event
    only with the few windows near it. A list of at most ``broadcast_bytes`` is
    broadcast; a longer one is joined by shuffle, where adaptive execution splits a
    crowded bucket.
    """
    stride = millis(gap) + 1

    def bucket(t: Column) -> Column:
        ms = F.unix_millis(t)
        return ms - F.pmod(ms, F.lit(stride))

    buckets = F.sequence(
        bucket(F.col("on_or_after")), bucket(F.col("on_or_before")), F.lit(stride).cast("bigint")
    )
    side = windows.select(
        "query_name", "on_or_after", "on_or_before", F.explode(buckets).alias("_bucket")
    )
    small = fits_broadcast(side, broadcast_bytes)
    moment = F.col("_moment")
    joined = df.withColumn("_moment", time.cast("timestamp")).withColumn(
        "_event_bucket", bucket(moment)
    )
    return joined.join(
        F.broadcast(side) if small else side,
        (F.col("_event_bucket") == F.col("_bucket"))
        & (moment >= F.col("on_or_after"))
        & (moment < F.col("on_or_before") + F.expr("INTERVAL 1 MILLISECOND")),
    ).drop("_bucket", "_event_bucket", "_moment")
