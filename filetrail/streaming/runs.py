"""Continuous runs on Structured Streaming.

Rows are shaped when their file arrives and routed by their own times, so a late row
reaches its proper target. Progress and replay are Spark's checkpoint.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filetrail.operators.metrics import tumbling_window
from filetrail.operators.windows import SETTLE_LAG, assign_tumbling
from filetrail.plans.filters import QuerySpec, bounds, compile_filters, unread_times, unreadable
from filetrail.plans.pull import Options, shape, time_column
from filetrail.sinks.targets import write_targets
from filetrail.sources.state import load_cache, read_log

#: Spark remembers the durations of the last 100 micro-batches, if not set otherwise.
SAVE_EVERY = 50
DURATIONS = "query_name string, batch_id long, n_events long, stage string, millis long"
DEFAULT_LAG = f"{SETTLE_LAG // timedelta(minutes=1)} minutes"


def checkpoint_dir(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of a query, under the folder the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir, or give a checkpoint folder")
    return f"{base.rstrip('/')}/{name}"


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def drop_repeats(source: DataFrame, time: Column, key: str = "eventId",
                 within: str = DEFAULT_LAG) -> DataFrame:
    """Optional: drop events whose id was seen within the given time.

    Events without an id can't repeat one and pass through. Events with an id that come
    later than ``within`` behind the newest are dropped too, as their id may have been
    forgotten; give a time longer than events are late.
    """
    named = F.col(key).isNotNull() & (F.col(key) != "")
    once = (
        source.where(named)
        .withColumn("_time", time)
        .withWatermark("_time", within)
        .dropDuplicatesWithinWatermark([key])
        .drop("_time")
    )
    return once.unionByName(source.where(F.coalesce(~named, F.lit(True))))


def start_stream(source: DataFrame, spec: QuerySpec, path: str,
                 checkpoint: str | None = None, interval: str | None = None,
                 options: Options = Options(), rules: DataFrame | None = None,
                 cache_path: str | None = None, fmt: str = "parquet",
                 durations_path: str | None = None,
                 aside_path: str | None = None) -> StreamingQuery:
    """Start one named query; without ``interval`` it reads what is there and stops.

    Each micro-batch writes its own ``target=.../window_id=batch-<n>`` folders and
    replaces them when it is replayed, so the output holds every row once. The
    processing time is the batch's own, which a replay repeats, and locations are taken
    as of that time. The geo cache at ``cache_path`` is read anew for every micro-batch.
    Durations go to ``durations_path`` before Spark forgets them; call ``save_durations``
    for the last ones. Rows that the other filters match, but whose times the query needs and
    can't read, are counted (``n_unreadable`` of the progress) and, given ``aside_path``, written
    there with the terms of those times, ``unread``, in a folder for each micro-batch.
    """
    spark = source.sparkSession
    start, _ = bounds(spec)
    by_window = spec.route_by == "onOrBefore"
    if by_window and start is None:
        raise ValueError("routing by window end needs a start time in the query")

    def write(batch: DataFrame, batch_id: int) -> None:
        if durations_path and batch_id % SAVE_EVERY == SAVE_EVERY - 1:
            running = [q for q in spark.streams.active if q.name == spec.name]
            for query in running:
                save_durations(query, durations_path)
        given = batch
        if cache_path or aside_path:
            # Kept, so that what reads the batch before its rows are written doesn't count it twice.
            given = batch.persist()
        if aside_path:
            bad = given.where("_unreadable").withColumn("unread", unread_times(spec, by_window))
            bad = bad.drop("_unreadable").withColumn("batch", F.lit(f"batch-{batch_id}"))
            (bad.write.partitionBy("batch").mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").parquet(aside_path))
        batch = given.where("not _unreadable").drop("_unreadable")
        if by_window:
            time = time_column(spec.time_term, options.strict)
            batch = assign_tumbling(batch, time, start, spec.gap)
            batch = batch.withColumn("query_name", F.lit(spec.name))
        cache, as_of = None, datetime.now(UTC)
        if cache_path:
            found = batch.agg(F.max("_processed_at")).first()[0]
            as_of = found.astimezone(UTC) if found else as_of
            cache = load_cache(batch.sparkSession, cache_path)
        rows = shape(batch, spec, options, as_of, cache, rules, "_processed_at")
        write_targets(rows.withColumn("window_id", F.lit(f"batch-{batch_id}")), path, fmt)
        if cache_path or aside_path:
            given.unpersist()

    wanted, lost = compile_filters(spec, strict=options.strict), F.lit(False)
    if not options.strict:  # a time that can't be read fails a strict query
        lost = unreadable(spec, by_window)
    return (
        source.where(wanted | lost)
        .withColumns({"_unreadable": lost, "_processed_at": F.current_timestamp()})
        .observe("events", F.count_if(~F.col("_unreadable")).alias("n_events"),
                 F.count_if("_unreadable").alias("n_unreadable"))
        .writeStream.queryName(spec.name)
        .option("checkpointLocation", checkpoint or checkpoint_dir(spark, spec.name))
        .trigger(**_trigger(interval))
        .foreachBatch(write)
        .start()
    )


def start_streams(source: DataFrame, specs: list[QuerySpec], path: str,
                  checkpoint: str | None = None, **kwargs) -> dict[str, StreamingQuery]:
    """Several named queries over one source, each with its own output and checkpoint."""
    return {
        s.name: start_stream(
            source, s, f"{path}/{s.name}", checkpoint and f"{checkpoint}/{s.name}", **kwargs
        )
        for s in specs
    }


def batch_durations(query: StreamingQuery) -> DataFrame:
    """Events and stage durations of the micro-batches that Spark remembers."""
    rows = []
    for p in query.recentProgress:
        seen = p["observedMetrics"].get("events")
        n = seen["n_events"] if seen else 0
        rows += [(p["name"], p["batchId"], n, k, ms) for k, ms in p["durationMs"].items()]
    return SparkSession.active().createDataFrame(rows, DURATIONS)


def save_durations(query: StreamingQuery, path: str) -> None:
    """Append the durations of batches that the log at ``path`` does not have yet."""
    new = batch_durations(query)
    known = load_durations(new.sparkSession, path).where(F.col("query_name") == query.name)
    last = known.agg(F.max("batch_id")).first()[0]
    if last is not None:
        new = new.where(F.col("batch_id") > last)
    new.coalesce(1).write.mode("append").parquet(path)


def load_durations(spark: SparkSession, path: str) -> DataFrame:
    """All saved durations; empty when there are none."""
    return read_log(spark, path, DURATIONS)


def windowed_counts(source: DataFrame, time: Column, start: datetime, gap: timedelta,
                    lag: str = DEFAULT_LAG) -> DataFrame:
    """Events per pull window on a stream, emitted once the watermark passes a window."""
    return (
        source.withColumn("_time", time.cast("timestamp"))
        .withWatermark("_time", lag)
        .groupBy(tumbling_window(F.col("_time"), start, gap).alias("w"))
        .agg(F.count("*").alias("n_events"))
        .select(
            F.col("w.start").alias("on_or_after"),
            (F.col("w.end") - F.expr("INTERVAL 1 MILLISECOND")).alias("on_or_before"),
            "n_events",
        )
    )

