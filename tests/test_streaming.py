from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from filetrail.plans.filters import QuerySpec
from filetrail.plans.pull import Options, time_column
from filetrail.schemas import GEO, GEO_CACHE, RAW
from filetrail.sources.events import stream_raw
from filetrail.sources.state import save_cache
from filetrail.streaming import runs
from tests.util import raw_rows, utc

T0 = utc(2024, 1, 1)
SPEC = QuerySpec.from_dict({
    "name": "s", "gap": timedelta(hours=1), "base": "files", "route_by": "eventTimestamp",
    "groups": [{"filters": [
        {"operator": "IS", "term": "fileName", "value": "*"},
        {"operator": "ON_OR_AFTER", "term": "eventTimestamp", "value": "2024-01-01T00:00:00.000Z"},
        {"operator": "ON_OR_BEFORE", "term": "eventTimestamp", "value": ""},
    ]}]})


def land(spark, path, ids):
    """Write one file of events, one per hour from T0."""
    rows = [dict(eventId=str(i), fileName="f" if i % 5 else None, publicIpAddress="1.1.1.1",
                 eventTimestamp=(T0 + timedelta(hours=i)).isoformat()[:19] + "Z")
            for i in ids]
    raw_rows(spark, rows).coalesce(1).write.mode("append").json(path)


def ids(df):
    return sorted(int(r[0]) for r in df.select("event.id").collect())


def run(spark, src, out, ck, spec=SPEC, **kw):
    q = runs.start_stream(stream_raw(spark, src, maxFilesPerTrigger=1), spec, out, ck, **kw)
    q.awaitTermination(120)
    assert q.exception() is None
    return q


def test_stream_restarts_and_equals_batch(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    land(spark, src, range(-2, 10))
    land(spark, src, range(10, 30))
    q = run(spark, src, out, ck)
    timed = runs.batch_durations(q).where("stage = 'addBatch'").orderBy("batch_id").collect()
    assert [(r["query_name"], r["batch_id"]) for r in timed] == [("s", 0), ("s", 1)]
    assert sum(r["n_events"] for r in timed) == 24 and all(r["millis"] > 0 for r in timed)
    land(spark, src, [3, *range(30, 40)])  # a late row reaches its own target
    run(spark, src, out, ck)
    run(spark, src, out, ck)  # nothing new
    got = spark.read.parquet(out)
    assert ids(got) == sorted([i for i in range(40) if i % 5] + [3])
    days = {r["target"]: r["n"] for r in got.groupBy("target").agg(F.count("*").alias("n")).collect()}
    assert days == {"files-2024-01-01": 20, "files-2024-01-02": 13}


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "ck"
    land(spark, src, range(10))
    spec = replace(SPEC, route_by="timeNow")
    run(spark, src, out, str(ck), spec)
    before = spark.read.parquet(out)
    (only,) = {r[0] for r in before.select("target").collect()}
    # lose the commit of the batch, as a crash after the write would
    commit = ck / "commits" / "0"
    commit.unlink()
    (ck / "commits" / ".0.crc").unlink(missing_ok=True)
    run(spark, src, out, str(ck), spec)
    after = spark.read.parquet(out)
    assert ids(after) == [i for i in range(10) if i % 5]
    assert {r[0] for r in after.select("target").collect()} == {only}


def test_cache_and_window_end_on_a_stream(spark, tmp_path):
    src, cache = str(tmp_path / "in"), str(tmp_path / "cache")
    land(spark, src, range(3))
    place = F.from_json(F.lit('{"country": "C"}'), GEO)
    rows = spark.range(1).select(
        F.lit("1.1.1.1").alias("ip"), F.lit("").alias("lang"), F.lit(T0).alias("written_at"),
        F.lit(utc(2999, 1, 1)).alias("expiration_time"), place.alias("location"))
    save_cache(rows.select(*GEO_CACHE.fieldNames()), cache)
    spec = replace(SPEC, route_by="onOrBefore", layout="2006-01-02T15:04:05.000")
    run(spark, src, str(tmp_path / "o"), str(tmp_path / "ck"), spec, cache_path=cache,
        options=Options(mode="raw"))
    got = {(r["eventId"], r["country"], r["target"]) for r in
           spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {("1", "C", "files-2024-01-01T01:00:00.000"),
                   ("2", "C", "files-2024-01-01T02:00:00.001")}
    no_start = replace(spec, groups=())
    with pytest.raises(ValueError):
        runs.start_stream(stream_raw(spark, src), no_start, str(tmp_path / "o"))


def test_named_queries_use_the_shared_checkpoint_folder(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "o")
    land(spark, src, range(6))
    specs = [replace(SPEC, name="one"), replace(SPEC, name="two", groups=())]
    started = runs.start_streams(stream_raw(spark, src), specs, out)
    for q in started.values():
        q.awaitTermination(120)
    assert ids(spark.read.parquet(f"{out}/one")) == [1, 2, 3, 4]
    assert ids(spark.read.parquet(f"{out}/two")) == [0, 1, 2, 3, 4, 5]
    base = spark.conf.get("spark.checkpoint.dir")
    assert runs.checkpoint_dir(spark, "one") == f"{base}/one"


def collect_stream(spark, df, name, ck):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_windowed_counts_emit_closed_windows(spark, tmp_path):
    src = str(tmp_path / "in")
    land(spark, src, [*range(10), 2, 2])
    df = runs.windowed_counts(stream_raw(spark, src), time_column("eventTimestamp"), T0,
                              timedelta(hours=2), "15 minutes")
    rows = collect_stream(spark, df.select(
        (F.unix_millis("on_or_after") - int(T0.timestamp() * 1000)).alias("a"),
        (F.unix_millis("on_or_before") - F.unix_millis("on_or_after")).alias("len"), "n_events"),
        "counts", str(tmp_path / "ck"))
    stride = 7_200_001
    # 0, 1, 2, 2, 2 are before 02:00:00.001; the window holding the newest row stays open
    assert sorted(tuple(r) for r in rows) == [
        (0, stride - 1, 5), (stride, stride - 1, 2), (2 * stride, stride - 1, 2),
        (3 * stride, stride - 1, 2)]


def test_repeats_can_be_dropped(spark, tmp_path):
    src = str(tmp_path / "in")
    land(spark, src, [1, 1, 2, 2, 2])
    df = runs.drop_repeats(stream_raw(spark, src), time_column("eventTimestamp"))
    rows = collect_stream(spark, df.select("eventId"), "once", str(tmp_path / "ck"))
    assert sorted(r[0] for r in rows) == ["1", "2"]


def test_durations_last(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "SAVE_EVERY", 2)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    for i in range(7):
        land(spark, src, range(10 * i, 10 * i + 10))
    raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    q = runs.start_stream(raw, SPEC, str(tmp_path / "o"), str(tmp_path / "c"), durations_path=log)
    q.awaitTermination()
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    runs.save_durations(q, log)
    runs.save_durations(q, log)
    saved = runs.load_durations(spark, log).where("stage = 'addBatch'").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in saved] == list(range(7))
    assert runs.load_durations(spark, str(tmp_path / "none")).count() == 0


def test_events_without_an_id_all_pass(spark, tmp_path):
    src = str(tmp_path / "ids")
    ids = ["a", "a", None, None, None, "", ""]
    rows = [{"eventId": i, "eventTimestamp": "2024-01-01T00:00:00Z"} for i in ids]
    raw_rows(spark, rows).write.json(src)
    df = runs.drop_repeats(stream_raw(spark, src), time_column("eventTimestamp"))
    q = df.writeStream.format("memory").queryName("no_ids").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    got = [r[0] or "" for r in spark.table("no_ids").select("eventId").collect()]
    assert sorted(got) == [""] * 5 + ["a"]


def test_unreadable_times_are_counted_and_set_aside(spark, tmp_path):
    src, out, ck, bad = (str(tmp_path / x) for x in ("in", "out", "ck", "bad"))
    good = dict(fileName="f", eventTimestamp="2024-01-02T00:00:00Z")
    rows = [good | dict(eventId="0"), good | dict(eventId="1", eventTimestamp="soon"),
            good | dict(eventId="2", eventTimestamp=""), good | dict(eventId="3", eventTimestamp=None),
            good | dict(eventId="4", eventTimestamp="2023-01-02T00:00:00Z"),
            good | dict(eventId="5", eventTimestamp="soon", fileName=None)]
    raw_rows(spark, rows[:2]).coalesce(1).write.json(src)
    raw_rows(spark, rows[2:]).coalesce(1).write.mode("append").json(src)
    q = run(spark, src, out, ck, aside_path=bad)
    seen = [p["observedMetrics"]["events"] for p in q.recentProgress if p["numInputRows"]]
    assert sum(s["n_events"] for s in seen) == 1 and sum(s["n_unreadable"] for s in seen) == 3
    found = spark.read.parquet(bad)
    assert sorted(r["eventId"] for r in found.collect()) == ["1", "2", "3"]
    assert {tuple(r["unread"]) for r in found.collect()} == {("eventTimestamp",)}
    assert ids(spark.read.parquet(out)) == [0]
    run(spark, src, str(tmp_path / "out2"), str(tmp_path / "ck2"))  # counted only
    assert ids(spark.read.parquet(str(tmp_path / "out2"))) == [0]
