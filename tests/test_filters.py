from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from filetrail.plans.filters import QuerySpec, bounds, compile_filters, instant, with_bounds
from tests.util import raw_rows, utc


def spec(*filters, clause="AND"):
    keys = ("operator", "term", "value")
    groups = [{"filters": [dict(zip(keys, f)) for f in filters], "filterClause": clause}]
    return QuerySpec.from_dict({"name": "q", "groups": groups})


A, B = ("ON_OR_AFTER", "insertionTimestamp"), ("ON_OR_BEFORE", "insertionTimestamp")


def ids(df, s, **kw):
    return sorted(r["eventId"] for r in df.where(compile_filters(s, **kw)).collect())


def test_bounds_and_replacement():
    s = spec((*A, "2020-01-01T00:00:00Z"), (*A, "2021-01-01T00:00:00Z"), (*B, ""))
    assert bounds(s) == (utc(2020, 1, 1), None)
    changed = with_bounds(s, utc(2022, 1, 1), utc(2022, 1, 1, 0, 0, 1, 999))
    assert [f.value for f in changed.filters()] == [
        "2022-01-01T00:00:00.000Z", "2021-01-01T00:00:00Z", "2022-01-01T00:00:01.000Z"]
    assert bounds(spec((*A, "0001-01-01 00:00:00 +0000 UTC"))) == (None, None)
    assert bounds(s) == (utc(2020, 1, 1), None)  # the spec itself does not change
    assert spec((*B, ""), (*A, "")).before_first and not s.before_first


def test_time_bounds_are_inclusive_to_the_millisecond(spark):
    times = ["2020-01-01T00:00:00.000Z", "2020-01-01T00:00:00.999999Z", "2020-01-01T00:00:01Z",
             "2020-01-01T00:00:01.000999Z", "2020-01-01T00:00:01.001Z", "garbage", None,
             "2019-12-31T23:59:59.999Z"]
    df = raw_rows(spark, [dict(eventId=str(i), insertionTimestamp=t) for i, t in enumerate(times)])
    s = spec((*A, "2020-01-01T00:00:00Z"), (*B, "2020-01-01T00:00:01Z"))
    assert ids(df, s) == ["0", "1", "2", "3"]
    assert ids(df, spec((*A, ""), (*B, ""))) == [str(i) for i in range(8)]
    first_only = spec((*A, "2020-01-01T00:00:01Z"), (*A, "2030-01-01T00:00:00Z"))
    assert ids(df, first_only) == ["2", "3", "4"]


def test_is_and_wildcards(spark):
    rows = [dict(eventId=str(i), fileName=n, exposure=e) for i, (n, e) in enumerate(
        [("a.txt", ["Cloud"]), ("b_x.gz", ["Usb", "Web"]), ("bx.gz", []), (None, None),
         ("100%.gz", ["CloudX"])])]
    df = raw_rows(spark, rows)
    assert ids(df, spec(("IS", "fileName", "*"))) == ["0", "1", "2", "4"]
    assert ids(df, spec(("IS", "fileName", "a.txt"))) == ["0"]
    assert ids(df, spec(("IS", "fileName", "*_*"))) == ["1"]
    assert ids(df, spec(("IS", "fileName", "*%.gz"))) == ["4"]
    assert ids(df, spec(("IS", "fileName", "b*.gz"))) == ["1", "2"]
    assert ids(df, spec(("IS", "exposure", "Cloud"))) == ["0"]
    assert ids(df, spec(("IS", "exposure", "Cloud*"))) == ["0", "4"]


def test_unsupported_parts_are_refused():
    with pytest.raises(ValueError):
        compile_filters(spec(("IS_NOT", "fileName", "a")))
    with pytest.raises(ValueError):
        compile_filters(spec(("IS", "fileName", "a"), clause="OR"))


def test_predicates_reach_the_scan(spark, tmp_path):
    raw = raw_rows(spark, [dict(eventId="1", fileName="a", insertionTimestamp="2020-01-01T00:00Z")])
    raw.withColumn("ts", F.lit(utc(2020, 1, 1)).cast("timestamp_ntz")).write.parquet(
        str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def pushed(condition):
        plan = df.where(condition).select("eventId")._jdf.queryExecution().executedPlan()
        return next(x for x in plan.toString().split("\n") if "PushedFilters" in x)

    s = spec(("IS", "fileName", "a"), (*A, "2020-01-01T00:00:00Z"), (*B, "2020-01-02T00:00:00Z"))
    text = pushed(compile_filters(s))
    assert "EqualTo(fileName,a)" in text
    assert "GreaterThanOrEqual(insertionTimestamp,2020-01-01)" in text
    assert "LessThan(insertionTimestamp,2020-01-03)" in text
    # A typed time column of either kind is compared without a cast.
    text = pushed(compile_filters(s, times={"insertionTimestamp": F.col("ts")}))
    assert "GreaterThanOrEqual(ts,2020-01-01T00:00)" in text
    assert "GreaterThan(ts,2020" in pushed(F.col("ts") > instant(utc(2020, 1, 1)))


def test_gap_is_kept():
    s = QuerySpec.from_dict({"name": "q", "groups": [], "gap": timedelta(hours=1)})
    assert s.gap == timedelta(hours=1) and s.time_term == "eventTimestamp"


def test_presence_ignores_empty_values(spark):
    rows = [{"eventId": str(i), "fileName": n, "exposure": e} for i, (n, e) in enumerate(
        [("f", ["x"]), ("", []), (None, None), (" ", ["y"])])]
    df = raw_rows(spark, rows)
    assert ids(df, spec(("IS", "fileName", "*"))) == ["0", "3"]
    assert ids(df, spec(("IS", "exposure", "*"))) == ["0", "3"]


def test_strict_times_fail_in_the_predicate(spark):
    df = raw_rows(spark, [{"eventId": "1", "insertionTimestamp": "2020-01-01T00:00:01Z"},
                          {"eventId": "2", "insertionTimestamp": "no time"}])
    s = spec((*A, "2020-01-01T00:00:00Z"))
    assert ids(df, s) == ["1"]
    with pytest.raises(Exception, match="not an event time"):
        ids(df, s, strict=True)
