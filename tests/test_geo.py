import random
from datetime import timedelta

from pyspark.sql import functions as F

from filetrail.operators import geo as G
from filetrail.operators import metrics as M
from filetrail.schemas import GEO, GEO_CACHE, LOOKUP_RESULTS
from tests.util import utc

NOW = utc(2024, 1, 1, 12)
MS = timedelta(milliseconds=1)


def location(**given):
    return tuple(given.get(n) for n in GEO.fieldNames())


def cache(spark, *rows):
    """Rows (ip, lang, written, expires, country)."""
    return spark.createDataFrame(
        [(i, g, w, e, location(query=i, country=c)) for i, g, w, e, c in rows], GEO_CACHE)


def results(spark, *rows):
    return spark.createDataFrame(list(rows), LOOKUP_RESULTS)


def test_freshness_and_last_write(spark):
    df = cache(
        spark,
        ("edge", "", NOW, NOW, "a"), ("old", "", NOW, NOW - MS, "b"),
        ("twice", "", NOW - MS, NOW, "first"), ("twice", "", NOW, NOW, "second"),
        ("replaced", "", NOW - MS, NOW + MS, "x"), ("replaced", "", NOW, NOW - MS, "y"),
        ("twice", "en", NOW, NOW, "en"),
    )
    got = {(r["ip"], r["lang"]): r["location"]["country"] for r in G.fresh(df, NOW).collect()}
    assert got == {("edge", ""): "a", ("twice", ""): "second", ("twice", "en"): "en"}


def test_upsert_expiry_by_outcome(spark):
    new = results(
        spark,
        ("ok", "", NOW, None, location(status="success", country="c")),
        ("no", "", NOW, None, location(status="fail", message="private")),
        ("err", "", NOW, "timed out", None),
        ("err2", "", NOW, "cut off", location(status="success", country="half")),
        ("odd", "", NOW, None, location(status="pending")),
        ("none", "", NOW, None, None),
        ("old", "", NOW, None, location(status="success", country="new")),
        ("kept", "", NOW - MS, None, location(status="success", country="late answer")),
    )
    before = cache(spark, ("old", "", NOW - MS, NOW, "old"), ("kept", "", NOW, NOW, "kept"))
    rows = {r["ip"]: r for r in G.upsert_cache(before, new).select(
        "ip", ((F.unix_millis("expiration_time") - F.unix_millis("written_at")) / 60000).alias("m"),
        "location.status", "location.message", "location.country").collect()}
    assert set(rows) == {"ok", "no", "err", "err2", "old", "kept"}
    assert rows["ok"]["m"] == 480 and rows["no"]["m"] == rows["err"]["m"] == 30
    assert tuple(rows["err"])[2:] == ("fail", "timed out", None)
    assert tuple(rows["err2"])[2:] == ("fail", "cut off", "half")
    assert rows["old"]["country"] == "new" and rows["kept"]["country"] == "kept"
    kinds = {r["ip"]: r["kind"] for r in G.lookup_outcomes(new).collect()}
    assert kinds["odd"] == kinds["none"] == "other" and kinds["err2"] == "transport_error"


def test_misses(spark):
    known = cache(spark, ("a", "", NOW, NOW, "x"), ("b", "", NOW, NOW - MS, "x"),
                  ("c", "en", NOW, NOW, "x"))
    ev = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("",), (None,), ("d",)], "ip string")
    got = sorted(r["ip"] for r in G.cache_misses(ev, known, NOW, "ip").collect())
    assert got == ["b", "c", "d"]


def test_enrichment_keeps_every_event_once(spark):
    known = cache(spark, ("a", "", NOW, NOW, "first"), ("a", "", NOW + MS, NOW, "A"),
                  ("b", "", NOW, NOW - MS, "B"), ("", "", NOW, NOW, "blank"),
                  ("c", "en", NOW, NOW, "C"))
    ips = ["a"] * 50 + ["b", "c", "", None, "z"]
    ev = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, publicIpAddress string")
    joined = G.enrich_geo(ev, known, NOW)
    assert joined.columns == ["i", "publicIpAddress", "geo"]
    got = sorted((r["i"], r["geo"] and r["geo"]["country"]) for r in joined.collect())
    assert got == [(i, "A" if i < 50 else None) for i in range(55)]


def test_spread_join_equals_broadcast_join(spark):
    rng = random.Random(5)
    ips = [rng.choice(["hot", "hot", "hot", None, None, ""] + [f"ip{k}" for k in range(40)])
           for _ in range(3000)]
    ev = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)],
                               "i int, publicIpAddress string").repartition(5)
    known = cache(spark, *[(ip, "", NOW, NOW, ip.upper())
                           for ip in ["hot", *[f"ip{k}" for k in range(0, 40, 2)]]])
    plain = G.enrich_geo(ev, known, NOW).select("i", "geo")
    spread = G.enrich_geo(ev, known, NOW, broadcast_bytes=0)
    assert spread.columns == ["i", "publicIpAddress", "geo"]
    a = sorted((r["i"], r["geo"]) for r in plain.collect())
    b = sorted((r["i"], r["geo"]) for r in spread.select("i", "geo").collect())
    assert [x[0] for x in b] == list(range(3000))
    assert [(i, g and g["country"]) for i, g in a] == [(i, g and g["country"]) for i, g in b]


def test_a_large_cache_is_joined_by_shuffle(spark):
    ev = spark.createDataFrame([("same", "hot")] * 400 + [(str(i), None) for i in range(400)],
                               "eventId string, publicIpAddress string").repartition(8)
    rich = G.enrich_geo(ev, cache(spark, ("hot", "", NOW, NOW, "H")), NOW, broadcast_bytes=0)
    rows = rich.groupBy("publicIpAddress", "geo.country").count().collect()
    assert sorted(map(tuple, rows), key=str) == [("hot", "H", 400), (None, None, 400)]
    plan = rich._jdf.queryExecution().executedPlan().toString()
    # One pass over the events: rows without an address are dealt out by a salt.
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Union" not in plan
    key = F.col("publicIpAddress")
    salts = ev.select("publicIpAddress", G.spread(key, F.col("eventId")).alias("s")).distinct().collect()
    assert [r["s"] for r in salts if r[0]] == [0] and len(salts) > 100


def test_cache_size(spark):
    df = cache(spark, ("a", "", NOW, NOW, "x"), ("b", "", NOW, NOW - MS, "x"))
    assert tuple(M.cache_metrics(df, NOW).first()) == (2, 1)
