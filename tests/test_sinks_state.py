import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from filetrail.operators import geo as G
from filetrail.operators import normalize as N
from filetrail.operators import routing as R
from filetrail.schemas import FLAT_TARGET, GEO, GEO_CACHE, RAW_ALIASES, WINDOWS
from filetrail.sinks import files, targets
from filetrail.sources.events import read_raw
from filetrail.sources.state import (
    append_windows, load_cache, load_windows, read_locations, refresh_cache, save_cache,
)
from tests.util import raw_rows, utc

NOW = utc(2024, 1, 1)


def lines(path):
    return sorted(x for p in Path(path).rglob("part-*") for x in p.read_text().splitlines())


def test_one_json_line_per_event_and_replacement_by_window(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [dict(eventId=str(i), tabs=[("a", "http://x/<&>"), ("b", "")]) for i in range(4)]
    df = N.normalize(raw_rows(spark, rows)).withColumns({
        "query_name": F.lit("q"),
        "window_id": F.concat(F.lit("w"), F.col("event.id").cast("int") % 2)})
    files.write_windows(files.rename_envelope(df, "vendor"), path)
    first = lines(path)
    assert len(first) == 4 and all(len(json.loads(x)["vendor"]["tabs"]) == 2 for x in first)
    assert "http://x/<&>" in first[0]
    files.write_windows(files.rename_envelope(df, "vendor"), path)
    assert lines(path) == first
    # writing one window again replaces it alone
    one = files.rename_envelope(df.where("event.id = '0'"), "vendor")
    files.write_windows(one, path, compact=True)
    assert sorted(json.loads(x)["event"]["id"] for x in lines(path)) == ["0", "1", "3"]


def test_json_lines_append(spark, tmp_path):
    df = N.normalize(raw_rows(spark, [dict(eventId="1")]))
    for _ in range(2):
        files.write_json_lines(df, str(tmp_path / "o"))
    assert len(lines(tmp_path / "o")) == 2


def test_raw_files_under_other_names(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"eventId":"1","createdTimestamp":"2020-01-01T00:00:00Z","deviceUsername":"u",'
        '"osHostname":"h","tabs":[{"title":"t","url":"u"}],"fileSize":3}\n')
    row = read_raw(spark, str(tmp_path / "in"), aliases=RAW_ALIASES).first()
    assert (row["createTimestamp"], row["deviceUserName"], row["osHostName"]) == (
        "2020-01-01T00:00:00Z", "u", "h")
    assert row["fileSize"] == 3 and row["tabs"][0]["title"] == "t"


def test_cache_snapshots(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert load_cache(spark, path).count() == 0
    place = tuple(None for _ in GEO)
    one = spark.createDataFrame([("a", "", NOW, NOW, place)], GEO_CACHE)
    assert save_cache(one, path) == 1
    new = spark.createDataFrame([("b", "", NOW, NOW, place)], GEO_CACHE)
    assert save_cache(G.latest(load_cache(spark, path).unionByName(new)), path) == 2
    assert sorted(r["ip"] for r in load_cache(spark, path).collect()) == ["a", "b"]
    # a snapshot that was written but not listed is not seen
    one.write.parquet(f"{path}/v3")
    assert load_cache(spark, path).count() == 2


def test_landed_locations_refresh_the_cache(spark, tmp_path):
    path, src = str(tmp_path / "cache"), str(tmp_path / "geo")
    rows = [{"query": "a", "status": "success", "country": "A"}, {"query": "b", "status": "fail"}]
    spark.createDataFrame([tuple(r.get(n) for n in GEO.fieldNames()) for r in rows],
                          GEO).write.parquet(src)
    assert refresh_cache(read_locations(spark, src, NOW), path) == 1
    assert refresh_cache(read_locations(spark, src, NOW + timedelta(hours=1)), path) == 2
    got = {r["ip"]: r for r in load_cache(spark, path).select(
        "ip", F.unix_millis("expiration_time").alias("e")).collect()}
    base = int(NOW.timestamp() * 1000)
    assert {k: (r["e"] - base) / 3_600_000 for k, r in got.items()} == {"a": 9, "b": 1.5}


def test_window_log(spark, tmp_path):
    path = str(tmp_path / "windows")
    assert load_windows(spark, path).collect() == []
    w = spark.createDataFrame(
        [("q", NOW, NOW + timedelta(seconds=9), "open"), ("q", NOW, NOW, "open")], WINDOWS)
    append_windows(w, path)
    append_windows(w.limit(1), path, "completed")
    assert sorted(r["status"] for r in load_windows(spark, path).collect()) == [
        "completed", "open"]


def flat_rows(spark, n):
    raw = raw_rows(spark, [dict(eventId=str(i), osHostName=f"h{i}", deviceUserName="u",
                                eventTimestamp=f"2024-01-0{i + 1}T00:00:00Z") for i in range(n)])
    flat = N.type_flat(N.flatten_raw(raw.withColumn("geo", F.lit(None).cast(GEO)), "geo"))
    return R.route(flat, "files", F.col("eventTimestamp")).withColumn("window_id", F.lit("w"))


def test_target_table_with_aliases(spark, tmp_path):
    path = str(tmp_path / "table")
    targets.create_target(spark, "files_t", FLAT_TARGET, ["files_all", "files_any"], True, path)
    targets.create_target(spark, "files_t", FLAT_TARGET, [], True, path)  # already there
    assert targets.existing_targets(spark, "files_t").count() == 0
    df = flat_rows(spark, 3)
    needed = sorted(r[0] for r in R.targets_missing(
        df, targets.existing_targets(spark, "files_t")).collect())
    assert needed == ["files-2024-01-01", "files-2024-01-02", "files-2024-01-03"]
    targets.write_targets(df.where("eventId < 2"), path)
    spark.catalog.recoverPartitions("files_t")
    assert [r[0] for r in R.targets_missing(
        df, targets.existing_targets(spark, "files_t")).collect()] == ["files-2024-01-03"]
    assert spark.table("files_any").count() == 2
    named = targets.with_field_aliases(spark.table("files_all"))
    assert {tuple(r) for r in named.select("host", "hostname", "user", "username").collect()} == {
        ("h0", "h0", "u", "u"), ("h1", "h1", "u", "u")}


def test_targets_replace_or_append(spark, tmp_path):
    df, path = flat_rows(spark, 2), str(tmp_path / "t")
    for _ in range(2):
        targets.write_targets(df, path, compact=True)
    assert spark.read.parquet(path).count() == 2
    targets.write_targets(df, path, append=True)
    assert spark.read.parquet(path).count() == 4


def listed(spark, name):
    return {(r["target"], r["window_id"]) for r in targets.target_partitions(spark, name).collect()}


@pytest.mark.parametrize("managed", [True, False])
def test_inserts_are_listed_at_once_and_replace_their_windows(spark, tmp_path, managed):
    name = f"files_in_{managed}".lower()
    path = None if managed else str(tmp_path / "t")
    targets.create_target(spark, name, FLAT_TARGET, [f"{name}_all"], path=path)
    df = flat_rows(spark, 3).withColumn("window_id", F.concat(F.lit("w 100%"), F.col("eventId")))
    days = [f"files-2024-01-0{i}" for i in (1, 2, 3)]
    targets.insert_targets(df, name)
    assert listed(spark, name) == {(d, f"w 100%{i}") for i, d in enumerate(days)}
    assert R.targets_missing(df, targets.existing_targets(spark, name)).isEmpty()
    targets.insert_targets(df, name)
    assert spark.table(f"{name}_all").count() == 3, "a re-run replaces its rows"
    # The second window is run again with other rows for another target; the others stay.
    other = df.where("eventId = 1").withColumns({"target": F.lit("it's\\elsewhere"), "eventId": F.lit("9")})
    targets.insert_targets(other.drop("fileName"), name)
    assert listed(spark, name) == {(days[0], "w 100%0"), ("it's\\elsewhere", "w 100%1"), (days[2], "w 100%2")}
    assert sorted(r[0] for r in spark.table(name).select("eventId").collect()) == ["0", "2", "9"]
    if not managed:
        assert not list(Path(path).glob("target=files-2024-01-02/window_id*")), "no file is left behind"
    # A run without rows says which windows it was for.
    targets.insert_targets(df.limit(0), name, windows=["w 100%2"])
    assert sorted(r[0] for r in spark.table(name).select("eventId").collect()) == ["0", "9"]
    targets.insert_targets(df.where("eventId = 0"), name, append=True)
    assert spark.table(name).count() == 3


def test_inserts_by_name_and_new_columns(spark):
    targets.create_target(spark, "files_wide", FLAT_TARGET)
    df = flat_rows(spark, 2).withColumn("score", F.lit(0.5))
    with pytest.raises(ValueError, match="no column score"):
        targets.insert_targets(df, "files_wide")
    with pytest.raises(ValueError, match="without window_id"):
        targets.insert_targets(df.drop("window_id"), "files_wide")
    targets.insert_targets(df.drop("score"), "files_wide")
    targets.insert_targets(df.select(*reversed(df.columns)).withColumn("window_id", F.lit("w2")), "files_wide", evolve=True)
    rows = spark.table("files_wide").select("eventId", "osHostName", "score", "window_id").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [
        ("0", "h0", None, "w"), ("1", "h1", None, "w"), ("0", "h0", 0.5, "w2"), ("1", "h1", 0.5, "w2")]))
