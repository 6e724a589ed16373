from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from filetrail.operators.windows import open_windows
from filetrail.plans.filters import QuerySpec
from filetrail.plans.pull import Options, run_pull, run_pulls, shared_events
from filetrail.sinks.targets import write_targets
from filetrail.sources.state import load_windows
from tests.util import raw_rows, utc

T0 = utc(2024, 1, 1)
RAW = Options(mode="raw")
START, END = "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:41.500Z"


def spec(name, gap, term, *filters, end="", end_first=False, **extra):
    bounds = [{"operator": "ON_OR_AFTER", "term": term, "value": START},
              {"operator": "ON_OR_BEFORE", "term": term, "value": end}]
    tests = [{"operator": "IS", "term": t, "value": v} for t, v in filters]
    return QuerySpec.from_dict({
        "name": name, "gap": timedelta(seconds=gap), **extra,
        "groups": [{"filters": tests + (bounds[::-1] if end_first else bounds)}]})


SPECS = [
    spec("all", 10, "insertionTimestamp", base="files", route_by="onOrBefore"),
    spec("named", 7, "insertionTimestamp", ("fileName", "*"), base="named", layout="2006.01",
         route_by="eventTimestamp", end_first=True),
    spec("odd", 3, "eventTimestamp", ("fileName", "odd*"), base="odd", layout="", end=END),
    spec("none", 5, "insertionTimestamp", ("fileName", "no such"), base="none"),
]


def events(spark, n=60):
    rows = []
    for i in range(n):
        t, e = (T0 + timedelta(seconds=i * k, milliseconds=i * 7) for k in (1, 0.9))
        rows.append(dict(eventId=str(i), insertionTimestamp=t.isoformat(timespec="microseconds")[:26] + "Z",
                         eventTimestamp=e.isoformat(timespec="milliseconds")[:23] + "Z",
                         fileName=None if i % 10 == 9 else f"odd{i}" if i % 2 else "even"))
    rows.append(dict(eventId="60", insertionTimestamp="not a time", eventTimestamp="nor this"))
    return raw_rows(spark, rows)


def found(spark, path):
    rows = spark.read.parquet(path).select("query_name", "window_id", "target", "eventId")
    return sorted(tuple(r) for r in rows.collect())


def test_equals_single_pulls(spark, tmp_path):
    raw = events(spark).repartition(3).cache()
    moments = [T0 + timedelta(minutes=15, seconds=s) for s in (25, 100)]
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    for as_of in moments:
        counts = run_pulls(raw, SPECS, many + "-s", lambda df: write_targets(df, many), as_of, T0, RAW)
        single = {s.name: run_pull(raw, s, one + "-s", lambda df: write_targets(df, one), as_of, T0, RAW)
                  for s in SPECS}
        assert counts == {k: n for k, n in single.items() if n}
    assert run_pulls(raw, SPECS, many + "-s", print, moments[-1], T0, RAW) == {}
    got = found(spark, many)
    assert got == found(spark, one) and len({g[0] for g in got}) == 3
    assert {g[2] for g in got if g[0] == "odd"} == {"odd"}
    windows = [load_windows(spark, p + "-s") for p in (one, many)]
    assert sorted(map(tuple, windows[0].collect())) == sorted(map(tuple, windows[1].collect()))
    assert open_windows(windows[1]).isEmpty()


def test_one_scan_and_what_reaches_it(spark, tmp_path):
    path = str(tmp_path / "raw")
    events(spark).write.parquet(path)
    seen = []
    run_pulls(spark.read.parquet(path), SPECS, str(tmp_path / "s"),
              lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()),
              T0 + timedelta(minutes=16), T0)
    assert seen[0].count("FileScan") == 1 and "Exchange" not in seen[0] and "Join" not in seen[0]
    assert "GreaterThanOrEqual(insertionTimestamp,2024-01-01)" in seen[0]


def test_windows_left_open_are_pulled_with_the_new_ones(spark, tmp_path):
    raw, state, out = events(spark), str(tmp_path / "s"), str(tmp_path / "o")

    def die(df):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run_pulls(raw, SPECS[:2], state, die, T0 + timedelta(minutes=15, seconds=20), T0)
    assert open_windows(load_windows(spark, state)).count() == 5
    counts = run_pulls(raw, SPECS, state, lambda df: write_targets(df, out),
                       T0 + timedelta(minutes=15, seconds=30), T0, RAW)
    assert counts["all"] == 3 and set(counts) == {s.name for s in SPECS}
    rows = found(spark, out)
    assert len(rows) == len(set(rows))
    assert sorted(int(g[3]) for g in rows if g[0] == "all") == list(range(30))
    assert open_windows(load_windows(spark, state)).isEmpty()


def test_odd_input(spark, tmp_path):
    with pytest.raises(ValueError, match="one name"):
        run_pulls(events(spark), [SPECS[0]] * 2, str(tmp_path / "s"), print, T0, T0)
    done = run_pulls(events(spark), SPECS, str(tmp_path / "s"), print, T0, T0)
    assert done == {}, "nothing has settled yet"
    empty = shared_events(events(spark, 0), SPECS[:2], {"all": T0, "named": T0}, T0 + timedelta(hours=1))
    assert empty.isEmpty() and set(empty.columns) >= {"query_name", "on_or_after", "on_or_before"}
    with pytest.raises(Exception, match="not a time|CAST|parse"):
        shared_events(events(spark), SPECS[:1], {"all": T0}, T0 + timedelta(hours=1),
                      Options(strict=True)).select(F.count("*")).collect()
