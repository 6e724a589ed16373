"""Batch pulls: read pending windows, normalize, enrich, route, write, advance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetrail.functions.fields import event_time, insertion_time
from filetrail.functions.names import target_name, window_id
from filetrail.operators.geo import enrich_geo
from filetrail.operators.normalize import flatten_raw, normalize
from filetrail.operators.routing import routing_time
from filetrail.operators.windows import (
    SETTLE_LAG,
    assign_tumbling,
    assign_windows,
    open_windows,
    plan_windows,
    tumbling,
)
from filetrail.plans.filters import (
    AFTER,
    BEFORE,
    Filter,
    Group,
    QuerySpec,
    bounds,
    compile_filters,
    scan_filter,
    unread_times,
    unreadable,
)
from filetrail.schemas import GEO
from filetrail.sources.state import append_windows, load_windows, query_table

WINDOW_COLUMNS = ("query_name", "on_or_after", "on_or_before")


@dataclass(frozen=True)
class Options:
    """How the rows of a pull are shaped.

    ``mode`` is "raw" (flat, also "") or "normalized" (nested, also "ecs"), in any case.
    """

    mode: str = "normalized"
    strip_zone: bool = False
    strict: bool = False
    lang: str = ""
    fields: str = ""
    dataset: str = "file_activity"
    module: str = "file_activity"

    @property
    def normalized(self) -> bool:
        modes = {"": False, "raw": False, "ecs": True, "normalized": True}
        if self.mode.lower() not in modes:
            raise ValueError(f"mode must be raw or normalized: {self.mode}")
        return modes[self.mode.lower()]


def time_column(term: str, strict: bool = False) -> Column:
    parse = insertion_time if term == "insertionTimestamp" else event_time
    return parse(F.col(term), strict)


def shape(events: DataFrame, spec: QuerySpec | Sequence[QuerySpec], options: Options,
          as_of: datetime, cache: DataFrame | None = None, rules: DataFrame | None = None,
          processed_at: str | None = None) -> DataFrame:
    """Raw events with window columns -> output rows with ``query_name, window_id, target``.

    Events without window columns get a ``target`` only. ``processed_at`` names a
    column with the processing time, which is ``as_of`` otherwise. With several specs
    each row is named by that of its ``query_name``.
    """
    specs = [spec] if isinstance(spec, QuerySpec) else list(spec)

    def by_query(value: Callable[[QuerySpec], Column]) -> Column:
        *others, last = specs
        found = value(last)
        for s in others:
            found = F.when(F.col("query_name") == s.name, value(s)).otherwise(found)
        return found

    windowed = set(WINDOW_COLUMNS) <= set(events.columns)
    if len(specs) > 1 and not windowed:
        raise ValueError("rows of several queries need window columns")
    keep = (WINDOW_COLUMNS if windowed else ()) + ((processed_at,) if processed_at else ())
    if cache is not None:
        events = enrich_geo(events, cache, as_of, lang=options.lang, fields=options.fields)
    if options.normalized:
        out = normalize(
            events,
            geo_col="geo" if cache is not None else None,
            strip_zone=options.strip_zone,
            rules=rules,
            strict=options.strict,
            dataset=options.dataset,
            module=options.module,
            keep=keep,
        )
        happened, inserted = F.col("event.created"), F.col("event.ingested")
    else:
        if cache is None:
            events = events.withColumn("geo", F.lit(None).cast(GEO))
        out = flatten_raw(events, "geo", options.strip_zone, keep)
        happened, inserted = time_column("eventTimestamp"), time_column("insertionTimestamp")
    now = F.col(processed_at) if processed_at else F.lit(as_of)
    window_end = F.col("on_or_before") if windowed else None

    def target(s: QuerySpec) -> Column:
        time = routing_time(s.route_by, now, window_end, happened, inserted)
        return target_name(s.base, time, s.layout)

    out = out.withColumn("target", by_query(target))
    if processed_at:
        out = out.drop(processed_at)
    if windowed:
        marks = [F.col(c) for c in WINDOW_COLUMNS]
        out = out.withColumn(
            "window_id", by_query(lambda s: window_id(*marks, s.before_first))
        ).drop("on_or_after", "on_or_before")
    return out


def pull_windows(raw: DataFrame, spec: QuerySpec, windows: DataFrame, as_of: datetime,
                 options: Options = Options(), cache: DataFrame | None = None,
                 rules: DataFrame | None = None) -> DataFrame:
    """The output rows of the given windows of one query, in one job.

    The range the windows span is part of the predicate, so the scan skips the rest.
    """
    events = window_events(raw, spec, windows, options)
    return shape(events, spec, options, as_of, cache, rules)


def window_events(raw: DataFrame, spec: QuerySpec, windows: DataFrame,
                  options: Options = Options()) -> DataFrame:
    """The events of the given windows, which may have any bounds, found by a join."""
    low, high = windows.agg(F.min("on_or_after"), F.max("on_or_before")).first()
    if low is None:
        events = raw.where(F.lit(False))
    else:
        window = (_aware(low), _aware(high))
        span = compile_filters(_bounded(spec), window, strict=options.strict)
        events = raw.where(span)
    time = time_column(spec.time_term, options.strict)
    return assign_windows(events, time, windows, spec.gap)


def new_events(raw: DataFrame, spec: QuerySpec, first: datetime, as_of: datetime,
               options: Options = Options()) -> DataFrame:
    """The events of the windows that are planned from ``first`` on, by arithmetic.

    However many windows there are, nothing is joined and no event moves.
    """
    _, end = bounds(spec)
    events = raw.where(compile_filters(_bounded(spec), (first, end), strict=options.strict))
    time = time_column(spec.time_term, options.strict)
    found = assign_tumbling(events, time, first, spec.gap, max_time=end, as_of=as_of)
    return found.withColumn("query_name", F.lit(spec.name))


def shared_events(raw: DataFrame, specs: Sequence[QuerySpec], first: Mapping[str, datetime],
                  as_of: datetime, options: Options = Options()) -> DataFrame:
    """The events of the new windows of several queries, from one pass over ``raw``.

    Every query tests a row and claims it with its own window; an event comes out once for
    each query that claims it. The times are parsed once a row, however many queries ask,
    and the scan skips what no query's range can hold.
    """
    terms = sorted({s.time_term for s in specs} | {f.term for s in specs for f in s.filters()
                                                   if f.operator in (AFTER, BEFORE)})
    times = {t: F.col(f"_time_{i}") for i, t in enumerate(terms)}
    claims, coarse = [], []
    for spec in specs:
        start, end = first[spec.name], bounds(spec)[1]
        whole = _bounded(spec)
        inside, after, before = tumbling(times[spec.time_term], start, spec.gap, end, as_of)
        test = compile_filters(whole, (start, end), times, strict=options.strict) & inside
        claims.append(F.when(test, F.struct(
            F.lit(spec.name).alias("query_name"), after.alias("on_or_after"),
            before.alias("on_or_before"),
        )))
        coarse.append(scan_filter(whole, (start, end)))
    events = raw if options.strict else raw.where(reduce(lambda a, b: a | b, coarse))
    events = events.withColumns({f"_time_{i}": time_column(t, options.strict) for i, t in enumerate(terms)})
    found = events.withColumn("_claims", F.filter(F.array(*claims), lambda c: c.isNotNull()))
    return found.select(*raw.columns, F.explode("_claims").alias("_claim")).select(*raw.columns, "_claim.*")


def _bounded(spec: QuerySpec) -> QuerySpec:
    """The spec with both bounds present, so that a window can be set on it."""
    lacking = tuple(
        Filter(op, spec.time_term) for op in (AFTER, BEFORE) if spec.first(op) is None
    )
    return replace(spec, groups=spec.groups + (Group(lacking),)) if lacking else spec


def _aware(t: datetime) -> datetime:
    # Collected timestamps are naive local times.
    return t.astimezone()


def set_aside(raw: DataFrame, spec: QuerySpec, windowed: bool = True) -> DataFrame:
    """The raw rows that no window can hold, as a time the query needs can't be read.

    Rows that the other filters refuse are not among them. ``query_name`` and
    ``unread`` (the terms of those times) come first.
    """
    bad = raw.where(unreadable(spec, windowed))
    return bad.select(F.lit(spec.name).alias("query_name"), unread_times(spec, windowed).alias("unread"), *raw.columns)


def run_pull(raw: DataFrame, spec: QuerySpec, state_path: str,
             write: Callable[[DataFrame], None], as_of: datetime, started_at: datetime,
             options: Options = Options(), cache: DataFrame | None = None,
             rules: DataFrame | None = None,
             aside: Callable[[DataFrame], None] | None = None, gather: bool = False) -> int:
    """Pull every pending window of one query and advance its progress.

    Pending are windows a crash left open, with their own bounds, and the new ones up
    to ``as_of`` less the settle lag. New windows are logged as open first, then the
    rows are written, then all are logged as completed: a crash in between repeats
    the windows, and the sinks replace what an earlier run of a window wrote. Only
    windows left open are joined with the events; new ones are regular.
    ``aside`` gets the rows of ``set_aside``, which are those of all of ``raw``, in every run
    that pulls a window, before the others are written; it should replace what it had.
    With ``gather`` the events of a window are brought together before they are shaped,
    while they are narrow, so that shaping too is dealt out evenly however few files the
    events are in; ``write`` need not do it again (``compact=False``).
    Returns the number of windows pulled.
    """
    spark = raw.sparkSession
    mine = F.col("query_name") == spec.name
    known = load_windows(spark, state_path).where(mine)
    queries = query_table(spark, [spec], started_at)
    left = open_windows(known).count()
    planned = plan_windows(known, queries, as_of, SETTLE_LAG)
    first = planned.agg(F.min("on_or_after")).first()[0]
    parts = []
    if left:
        # The files of ``known`` were listed before the new windows are added to the log.
        parts.append(window_events(raw, spec, open_windows(known), options))
    if first is not None:
        append_windows(planned, state_path, "open")
        parts.append(new_events(raw, spec, _aware(first), as_of, options))
    if not parts:
        return 0
    pending = open_windows(load_windows(spark, state_path).where(mine))
    n = pending.count()
    columns = parts[0].columns
    events = reduce(lambda a, b: a.unionByName(b.select(*columns)), parts)
    if aside is not None:
        aside(set_aside(raw, spec))
    if gather:
        events = events.hint("rebalance", *[F.col(c) for c in WINDOW_COLUMNS])
    write(shape(events, spec, options, as_of, cache, rules))
    append_windows(pending, state_path, "completed")
    return n


def run_pulls(raw: DataFrame, specs: Sequence[QuerySpec], state_path: str,
              write: Callable[[DataFrame], None], as_of: datetime, started_at: datetime,
              options: Options = Options(), cache: DataFrame | None = None,
              rules: DataFrame | None = None) -> dict[str, int]:
    """Pull the pending windows of several queries in one job; like ``run_pull`` for each.

    Every query keeps its own gap, filters, target names and progress. The new windows of
    all share one scan of ``raw`` and one shaping of its rows; windows a crash left open
    are joined by query. ``write`` gets the rows of all queries, told apart by
    ``query_name``, once. Returns the number of windows pulled by query.
    """
    spark = raw.sparkSession
    by_name = {s.name: s for s in specs}
    if len(by_name) < len(specs):
        raise ValueError("two queries of one name")
    mine = F.col("query_name").isin(*by_name)
    known = load_windows(spark, state_path).where(mine)
    left = [r[0] for r in open_windows(known).select("query_name").distinct().collect()]
    planned = plan_windows(known, query_table(spark, list(specs), started_at), as_of, SETTLE_LAG)
    starts = planned.groupBy("query_name").agg(F.min("on_or_after").alias("first")).collect()
    first = {r["query_name"]: _aware(r["first"]) for r in starts}
    parts = [
        window_events(raw, by_name[n], open_windows(known).where(F.col("query_name") == n), options)
        for n in sorted(left)
    ]
    if first:
        # The files of ``known`` were listed before the new windows are added to the log.
        append_windows(planned, state_path, "open")
        parts.append(shared_events(raw, [s for s in specs if s.name in first], first, as_of, options))
    if not parts:
        return {}
    pending = open_windows(load_windows(spark, state_path).where(mine))
    pulled = {r[0]: r[1] for r in pending.groupBy("query_name").count().collect()}
    columns = parts[0].columns
    events = reduce(lambda a, b: a.unionByName(b.select(*columns)), parts)
    write(shape(events, specs, options, as_of, cache, rules))
    append_windows(pending, state_path, "completed")
    return pulled
