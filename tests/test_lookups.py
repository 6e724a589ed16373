import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from filetrail.operators import geo as G
from filetrail.schemas import GEO, GEO_CACHE
from filetrail.sources.state import load_cache, save_cache
from filetrail.streaming import lookups as L
from tests.util import utc

NOW = utc(2024, 1, 1, 12)
MIN = timedelta(minutes=1)


def cache(spark, *rows):
    """Rows (ip, lang, written, expires, country)."""
    place = [tuple(c if f == "country" else None for f in GEO.fieldNames()) for *_, c in rows]
    return spark.createDataFrame([(*r[:4], p) for r, p in zip(rows, place, strict=True)], GEO_CACHE)


def land(spark, folder, ips):
    spark.createDataFrame([(i,) for i in ips], "publicIpAddress string").coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp, checkpoint="c", **kwargs):
    source = spark.readStream.schema("publicIpAddress string").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    q = L.start_misses(source, f"{tmp}/asked", f"{tmp}/cache", f"{tmp}/{checkpoint}", **kwargs)
    q.awaitTermination()
    return sorted(r["ip"] for r in L.asked_keys(spark, f"{tmp}/asked").collect())


def test_a_key_is_asked_for_once_until_its_time_is_over(spark, tmp_path):
    tmp = str(tmp_path)
    save_cache(cache(spark, ("known", "", NOW, utc(2100, 1, 1), "K"), ("old", "", NOW, NOW, "O"),
                     ("other", "en", NOW, utc(2100, 1, 1), "E")), f"{tmp}/cache")
    land(spark, f"{tmp}/in", ["a", "a", "known", "old", "other", "", None])
    assert run(spark, tmp) == ["a", "old", "other"]
    land(spark, f"{tmp}/in", ["a", "b", "known", "old"])
    assert run(spark, tmp) == ["a", "b", "old", "other"], "what waits for an answer isn't asked again"
    # An answer that failed, and has expired since: that key is asked for again.
    later = utc(2100, 1, 1)
    answered = cache(spark, ("a", "", later, later + MIN, "A"), ("b", "", utc(2090, 1, 1), utc(2090, 1, 2), "B"))
    save_cache(G.latest(load_cache(spark, f"{tmp}/cache").unionByName(answered)), f"{tmp}/cache")
    land(spark, f"{tmp}/in", ["a", "b", "old"])
    assert run(spark, tmp) == ["a", "b", "old", "other"], "both answers are fresh today"
    # A stream with a new checkpoint knows what the one before asked.
    assert run(spark, tmp, "c2") == ["a", "b", "old", "other"]
    # Without waiting, each batch asks again: nothing holds the keys back.
    land(spark, f"{tmp}/in2", ["z"])
    source = spark.readStream.schema("publicIpAddress string").parquet(f"{tmp}/in2")
    for c in "de":
        L.start_misses(source, f"{tmp}/asked2", f"{tmp}/cache", f"{tmp}/{c}", waiting=timedelta(0)).awaitTermination()
    assert L.asked_keys(spark, f"{tmp}/asked2").count() == 2


def test_batch_misses_equal_the_batch_operator(spark):
    r = random.Random(1)
    events = spark.createDataFrame([(r.choice(["", None, *"abcdefgh"]),) for _ in range(60)], "publicIpAddress string")
    held = cache(spark, ("a", "", NOW - 9 * MIN, NOW, "A"), ("b", "", NOW - MIN, NOW - MIN, "B"),
                 ("c", "", NOW - 5 * MIN, NOW - 2 * MIN, "C"), ("d", "", NOW - MIN, NOW - MIN / 2, "D"))
    none = spark.createDataFrame([], L.ASKED)
    assert sorted(L.batch_misses(events, held, none, NOW).collect()) == sorted(G.cache_misses(events, held, NOW).collect())
    asks = spark.createDataFrame([(k, "", NOW - 4 * MIN, NOW + MIN, "", "", 0) for k in "acde"], L.ASKED)
    got = {x["ip"] for x in L.batch_misses(events, held, asks, NOW).collect()}
    # c and e wait for an answer; a has one; d's came after the ask and has expired.
    assert got == {"b", "d", "f", "g", "h"}


def test_replay_asks_for_the_same_and_replaces_it(spark, tmp_path):
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", ["a", "b"])
    assert run(spark, tmp) == ["a", "b"]
    asked = L.asked_keys(spark, f"{tmp}/asked")
    before = asked.select("ip", "asked_at", "batch").collect()
    # A crash before the batch was committed: its commit is not there, its offsets are.
    (tmp_path / "c" / "commits" / "0").unlink()
    (tmp_path / "c" / "commits" / ".0.crc").unlink(missing_ok=True)
    assert run(spark, tmp) == ["a", "b"]
    assert sorted(L.asked_keys(spark, f"{tmp}/asked").select("ip", "asked_at", "batch").collect()) == sorted(before)
    mine = L.run_key(f"{tmp}/c")
    as_of = before[0]["asked_at"].astimezone()
    counts = [L.open_asks(spark, f"{tmp}/asked", as_of, *k).count() for k in ((), (mine, 0), (mine, 1), ("else", 0))]
    assert counts == [2, 0, 2, 2]


def test_old_hours_go(spark, tmp_path):
    tmp = str(tmp_path)
    assert L.drop_old_asks(spark, f"{tmp}/asked", NOW) == 0
    land(spark, f"{tmp}/in", ["a"])
    run(spark, tmp)
    assert L.drop_old_asks(spark, f"{tmp}/asked", NOW) == 0
    assert L.drop_old_asks(spark, f"{tmp}/asked", utc(2100, 1, 1)) == 1
    assert L.asked_keys(spark, f"{tmp}/asked").count() == 0


def brute(events, history, lang):
    out = []
    for i, ip, t in events:
        rows = [h for h in history if h[0] == ip and h[1] == lang and t is not None and h[2] <= t]
        last = max(rows, key=lambda h: (h[2], h[3], h[4]), default=None)
        out.append((i, last[4] if last and last[3] >= t else None))
    return out


@pytest.mark.parametrize("seed, lives", [(1, [30, 480]), (2, [0, 1, 600, 10**5, 10**7])])
def test_lookup_as_of_the_event(spark, seed, lives):
    r = random.Random(seed)
    moment = lambda: NOW + timedelta(minutes=r.randint(-3000, 3000), milliseconds=r.choice([0, 0, 1]))
    history = []
    for i in range(150):
        w = moment()
        history.append((r.choice("abcd"), r.choice(["", "", "en"]), w, w + MIN * r.choice(lives), f"C{i}"))
    history += [("hot", "", NOW, NOW + 5 * MIN, "H"), ("hot", "", NOW, NOW + 4 * MIN, "Z"), ("hot", "", NOW + MIN, NOW, "gone")]
    edges = [("hot", NOW), ("hot", NOW - MIN / 1000), ("hot", NOW + MIN), ("hot", NOW + 0.5 * MIN), (None, NOW), ("", NOW), ("a", None)]
    events = [(i, r.choice("abcde"), moment()) for i in range(300)]
    events += [(1000 + i, ip, t) for i, (ip, t) in enumerate(edges)]
    df = spark.createDataFrame(events, "i int, ip string, t timestamp").withColumn("geo", F.lit("kept?"))
    for lang in ("", "en"):
        rich = G.enrich_as_of(df.drop("geo"), cache(spark, *history), F.col("t"), "ip", lang)
        assert rich.columns == ["i", "ip", "t", "geo"]
        got = sorted((x["i"], x["c"]) for x in rich.select("i", F.col("geo.country").alias("c")).collect())
        assert got == brute(events, history, lang)


def test_lookup_as_of_in_an_empty_history_and_plan(spark):
    df = spark.createDataFrame([(1, "a", NOW)], "i int, ip string, t timestamp")
    assert G.enrich_as_of(df, cache(spark), F.col("t"), "ip").first()["geo"] is None
    rich = G.enrich_as_of(df, cache(spark, ("a", "", NOW, NOW + MIN, "A")), F.col("t"), "ip")
    plan = rich._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftOuter") == 1 and "NestedLoop" not in plan


def test_bytes_decide_the_broadcast_and_events_are_read_once(spark, tmp_path):
    rows = [("a" * n, "", NOW, NOW, "x" * 100) for n in range(1, 40)]
    df = cache(spark, *rows)
    size = df.agg(F.sum(G.row_bytes(df))).first()[0]
    assert G.fits_broadcast(df, size) and not G.fits_broadcast(df, size - 1)
    path = str(tmp_path / "e")
    spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "i long, ip string").write.parquet(path)
    rich = G.enrich_geo(spark.read.parquet(path), df, NOW, "ip", broadcast_bytes=0)
    assert sorted((x["i"], x["c"]) for x in rich.select("i", F.col("geo.country").alias("c")).collect()) == [
        (i, None if i % 2 else "x" * 100) for i in range(100)]
    assert rich._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") == 1
