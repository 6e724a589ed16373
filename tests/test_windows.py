import random
from datetime import timedelta

from pyspark.sql import functions as F

from filetrail.operators import metrics as M
from filetrail.operators import windows as W
from filetrail.schemas import QUERIES, WINDOWS
from tests.util import utc

MS, MIN = timedelta(milliseconds=1), timedelta(minutes=1)
T0 = utc(2024, 1, 1)


def at(ms):
    return T0 + ms * MS


def windows(spark, *rows):
    return spark.createDataFrame([(q, at(a), at(b), s) for q, a, b, s in rows], WINDOWS)


def queries(spark, *rows):
    return spark.createDataFrame(list(rows), QUERIES)


def spans(df):
    rows = df.select("query_name", F.unix_millis("on_or_after").alias("a"),
                     F.unix_millis("on_or_before").alias("b")).collect()
    base = int(T0.timestamp() * 1000)
    return sorted((r["query_name"], r["a"] - base, r["b"] - base) for r in rows)


def test_newest_and_cursor(spark):
    df = windows(
        spark,
        ("open only", 0, 9, "open"), ("open only", 10, 19, "open"),
        ("done only", 0, 9, "completed"), ("done only", 10, 19, "completed"),
        ("open newer", 0, 9, "completed"), ("open newer", 10, 19, "open"),
        ("done newer", 0, 9, "open"), ("done newer", 10, 19, "completed"),
        ("out of order", 20, 29, "completed"), ("out of order", 10, 19, "completed"),
        ("touching", 0, 10, "completed"), ("touching", 10, 20, "open"),
    )
    assert spans(W.newest_windows(df)) == [
        ("done newer", 10, 19), ("done only", 10, 19), ("open newer", 10, 19),
        ("open only", 10, 19), ("out of order", 20, 29), ("touching", 10, 20)]
    assert ("out of order", 20, 29) in spans(W.last_completed(df))
    assert len(spans(W.last_completed(df))) == 5
    assert spans(W.last_completed(df.limit(0))) == []


def test_closing_one_window_leaves_neighbours_open(spark):
    df = windows(spark, ("q", 0, 9, "open"), ("q", 0, 19, "open"), ("q", 5, 9, "open"),
                 ("r", 0, 9, "open"))
    left = W.open_windows(W.close_window(df, "q", at(0), at(9)))
    assert spans(left) == [("q", 0, 19), ("q", 5, 9), ("r", 0, 9)]


def test_log_state(spark):
    log = windows(spark, ("q", 0, 9, "completed"), ("q", 0, 9, "open"), ("q", 10, 19, "open"))
    got = {(a, s) for a, s in W.current_windows(log).select(
        F.unix_millis("on_or_after") - int(T0.timestamp() * 1000), "status").collect()}
    assert got == {(0, "completed"), (10, "open")}


def test_planning(spark):
    none = windows(spark).limit(0)
    as_of = at(100) + 15 * MIN
    q = queries(spark, ("start", T0, None, 9), ("max", T0, at(25), 9), ("done", T0, T0, 9),
                ("late", at(101), None, 9), ("now", None, None, 9), ("edge", at(100), None, 9))
    got = spans(W.plan_windows(none, q, as_of))
    assert [g for g in got if g[0] == "max"] == [("max", 0, 9), ("max", 10, 19), ("max", 20, 25)]
    starts = [g for g in got if g[0] == "start"]
    assert starts[0] == ("start", 0, 9) and starts[-1] == ("start", 100, 100)
    assert {g[0] for g in got} == {"max", "start", "edge"}
    # goes on after the newest window, whatever its state
    seen = windows(spark, ("start", 50, 59, "open"), ("start", 40, 49, "completed"))
    assert spans(W.plan_windows(seen, q.where("query_name = 'start'"), as_of))[0] == (
        "start", 60, 69)


def test_long_ranges_are_planned_whole(spark):
    n = 25_000
    q = queries(spark, ("q", T0, at(10 * n), 9))
    df = W.plan_windows(windows(spark).limit(0), q, at(10 * n) + 60 * MIN)
    got = df.agg(F.count("*"), F.countDistinct("on_or_after"), F.max("on_or_before")).first()
    assert got[0] == got[1] == n
    assert spans(df.orderBy(F.desc("on_or_after")).limit(1)) == [("q", 10 * n - 10, 10 * n - 1)]


def test_every_event_lands_in_one_window(spark):
    """Random ms and µs times: plan, arithmetic and join agree, with no gap or overlap."""
    rng = random.Random(3)
    gap, start, end, as_of = timedelta(milliseconds=37), at(5), at(3000), at(2900) + 15 * MIN
    micros = [rng.randrange(0, 3_200_000) for _ in range(800)]
    micros += [m * 1000 for m in range(0, 3200, 7)] + [42_999, 43_000, 43_001, 5_000, 4_999,
                                                      2_900_999, 2_901_000, 2_900_000]
    base = int(T0.timestamp() * 1_000_000)
    ev = spark.createDataFrame([(i, base + m) for i, m in enumerate(micros)], "id long, us long")
    ev = ev.withColumn("ts", F.timestamp_micros("us"))
    planned = W.plan_windows(windows(spark).limit(0), queries(spark, ("q", start, end, 37)), as_of)
    by_sum = W.assign_tumbling(ev, F.col("ts"), start, gap, end, as_of).withColumn(
        "query_name", F.lit("q"))
    by_join = W.assign_windows(ev, F.col("ts"), planned, gap)
    by_shuffle = W.assign_windows(ev, F.col("ts"), planned, gap, broadcast_bytes=0)

    def rows(df):
        return sorted((r[0], r[1], r[2]) for r in df.select(
            "id", F.unix_micros("on_or_after") - base, F.unix_micros("on_or_before") - base
        ).collect())

    want = []
    for i, m in enumerate(micros):
        if 5_000 <= m < 2_901_000:
            k = (m - 5_000) // 38_000
            a = 5_000 + k * 38_000
            want.append((i, a, min(a + 37_000, 2_900_000)))
    assert rows(by_sum) == sorted(want)
    assert rows(by_join) == sorted(want)
    assert rows(by_shuffle) == sorted(want)


def test_overlapping_windows_get_their_own_copies(spark):
    w = windows(spark, ("a", 0, 9, "open"), ("b", 5, 30, "open"))
    ev = spark.createDataFrame([(m, at(m)) for m in (4, 5, 9, 10, 31)], "m int, ts timestamp")
    got = W.assign_windows(ev, F.col("ts"), w, 9 * MS)
    assert sorted((r["query_name"], r["m"]) for r in got.collect()) == [
        ("a", 4), ("a", 5), ("a", 9), ("b", 5), ("b", 9), ("b", 10)]


def test_counters(spark):
    ev = spark.createDataFrame([("a",), ("a",), ("b",)], "query_name string")
    w = windows(spark, ("a", 0, 9, "open"), ("c", 0, 9, "open"), ("b", 0, 9, "completed"))
    got = {r[0]: tuple(r)[1:] for r in M.pipeline_metrics(ev, w).collect()}
    assert got == {"a": (2, 1), "b": (1, 0), "c": (0, 1)}
    looks = spark.createDataFrame(
        [(True, "fail", None), (False, "success", None), (False, "fail", None),
         (False, None, "timeout"), (False, "other", None)],
        "hit boolean, status string, error string")
    assert M.lookup_metrics(looks).first().asDict() == dict(
        cache_hits=1, lookups_forwarded=4, successful_lookups=2, failed_requests=1,
        failed_queries=1, code_200=2, code_400=2)
