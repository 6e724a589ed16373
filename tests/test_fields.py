import hashlib
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetrail.functions import fields as E
from filetrail.functions import names as K
from filetrail.functions import quality as Q
from tests.util import apply, column, utc


def text_time(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def test_event_class(spark):
    got = apply(spark, ["CREATED", "modified", "Deleted", "READ_BY_APP", "", None], E.event_class)
    assert got == ["creation", "change", "deletion", "info", "info", "info"]


def test_event_time(spark):
    values = ["2020-01-02T03:04:05Z", "2020-01-02T03:04:05.678Z", "2020-01-02 03:04:05.678",
              "not a time", "", None, "2020-02-30T00:00:00Z", "2020-01-02T03:04:05.6789Z",
              "2020-01-02T03:04:05.1Z"]
    got = apply(spark, values, lambda c: text_time(E.event_time(c)))
    assert got[:3] == ["2020-01-02 03:04:05.000000"] + ["2020-01-02 03:04:05.678000"] * 2
    assert got[3:] == [None] * 6


def test_event_time_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = apply(spark, ["2020-01-02T03:04:05Z", "2020-01-02T03:04:05"],
                    lambda c: F.unix_millis(E.event_time(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1577934245000, 1577934245000]


def test_insertion_time_cuts_and_does_not_round(spark):
    values = ["2020-01-02T03:04:05.678999Z", "2020-01-02T03:04:05.67Z", "2020-01-02T03:04:05Z"]
    got = apply(spark, values, lambda c: text_time(E.insertion_time(c)))
    assert got == ["2020-01-02 03:04:05.678000", None, "2020-01-02 03:04:05.000000"]


def test_strict_times_fail_the_query(spark):
    with pytest.raises(Exception, match="not an event time: nope"):
        apply(spark, ["nope"], lambda c: E.event_time(c, strict=True))
    got = apply(spark, ["", None], lambda c: E.optional_time(c, strict=True))
    assert got == [None, None]
    with pytest.raises(Exception, match="not an event time"):
        apply(spark, [None], lambda c: E.event_time(c, strict=True))


def test_file_class_and_extension(spark):
    kinds = ["FILE", "WIN_NDS", "DIR", "char_device", "symlink", "x", None, "Bundle"]
    assert apply(spark, kinds, E.file_class) == [
        "file", "file", "dir", "dir", "symlink", "unknown", "unknown", "file"]
    files = ["a.tar.gz", ".bashrc", "a.", "noext", "d.x/noext", "d/a.b", None, ""]
    assert apply(spark, files, E.extension) == [
        "gz", "bashrc", None, None, None, "b", None, None]


def test_mime_list(spark):
    pairs = [("a", "b"), ("a", "a"), (None, None), ("a", None), ("", "b")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = df.orderBy("i").select(E.mime_list(F.col("a"), F.col("b")).alias("m")).collect()
    assert [r["m"] for r in rows] == [["a", "b"], ["a"], [""], ["a", ""], ["", "b"]]


def test_identity(spark):
    rows = [
        ("u@d.com", "any", None, "7"),
        ("NAME_NOT_AVAILABLE", "a@b.org", "os1", "7"),
        ("plain", None, "NAME_NOT_AVAILABLE", "7"),
        ("a@b@c", None, None, None),
        (None, "x@y", None, None),
        ("NAME_NOT_AVAILABLE", None, None, None),
        ("@d", None, None, None),
        ("n@", None, "", ""),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, d string, a string, o string, u string")
    df = df.withColumns({"e": E.user_email(F.col("d"), F.col("a")),
                         "id": E.user_id(F.col("o"), F.col("u"))})
    got = [r["u"] and tuple(r["u"]) for r in
           df.orderBy("i").select(E.user(F.col("e"), F.col("id")).alias("u")).collect()]
    assert got == [
        ("u@d.com", "7", "u", "d.com"),
        ("a@b.org", "os1", "a", "b.org"),
        ("plain", "7", None, None),
        ("a@b@c", None, "a", "b"),
        None,
        None,
        ("@d", None, None, "d"),
        ("n@", None, "n", None),
    ]


def test_ips(spark):
    ips = T.ArrayType(T.StringType())
    got = apply(spark, [["fe80::1%eth0", "10.0.0.1"], None], E.strip_zone, ips)
    assert got == [["fe80::1", "10.0.0.1"], None]
    df = spark.createDataFrame(
        [(0, None, ""), (1, None, "8.8.8.8"), (2, ["10.0.0.1"], "8.8.8.8"), (3, [], None)],
        "i int, p array<string>, u string")
    rows = df.orderBy("i").select(E.host_ips(F.col("p"), F.col("u")).alias("v")).collect()
    assert [r["v"] for r in rows] == [None, ["8.8.8.8"], ["10.0.0.1", "8.8.8.8"], None]


def test_geo_point(spark):
    df = spark.createDataFrame([(0, 1.5, 2.5), (1, 0.0, 2.5), (2, None, 1.0)],
                               "i int, a float, o float")
    rows = df.orderBy("i").select(E.geo_point(F.col("a"), F.col("o")).alias("p")).collect()
    assert [r["p"] and tuple(r["p"]) for r in rows] == [(1.5, 2.5), None, None]


@pytest.mark.parametrize("layout, expected", [
    ("2006-01-02", "base-2024-03-05"),
    ("2006.01", "base-2024.03"),
    ("", "base"),
    ("06_1-2 15h04m05.000", "base-24_3-5 14h07m09.123"),
    ("Monday Jan 02 03:04PM", "base-Tuesday Mar 05 02:07PM"),
])
def test_target_layouts(spark, layout, expected):
    df = spark.range(1).select(F.lit(utc(2024, 3, 5, 14, 7, 9, 123_456)).alias("t"))
    assert df.select(K.target_name("base", F.col("t"), layout)).first()[0] == expected


def test_window_id(spark):
    df = spark.range(1).select(F.lit(utc(2024, 1, 1)).alias("a"),
                               F.lit(utc(2024, 1, 1, 0, 0, 9, 999_000)).alias("b"))
    a, b = F.col("a"), F.col("b")
    ids = df.select(K.window_id("q", a, b), K.window_id("q", a, b, before_first=True),
                    K.window_id("x" * 300, a, b)).first()
    assert ids[0] == "qA2024.01.01.00.00.00.000B2024.01.01.00.00.09.999"
    assert ids[1] == "qB2024.01.01.00.00.09.999A2024.01.01.00.00.00.000"
    digest = hashlib.sha256(b"x" * 300).hexdigest()[:32]
    assert ids[2] == f"{'x' * 32}-{digest}A2024.01.01.00.00.00.000B2024.01.01.00.00.09.999"


@pytest.mark.parametrize("name", ["x" * 190, "x" * 191, "é" * 60, "a:/=%" * 40, "q r.s-t_u"])
def test_window_ids_fit_a_folder_and_keep_their_bounds(spark, name):
    starts = [utc(2024, 1, 1, 0, 0, s) for s in range(30)]
    df = spark.createDataFrame([(t,) for t in starts], "a timestamp")
    ids = {r[0] for r in df.select(K.window_id(name, F.col("a"), F.col("a"))).collect()}
    assert len(ids) == 30
    escaped = [re.sub(r'["#%\'*/:=?\\\x7f{\[\]^]', "%00", i) for i in ids]
    assert max(len(f"window_id={i}".encode()) for i in escaped) <= 255


def test_target_name_problems(spark):
    bad = {"": "empty", "Abc": "capital letter", "aBc": "capital letter", "a/b": "contains /",
           "a\\b": "contains \\", "a b": "contains space", 'a"': 'contains "', "_a": "starts with _",
           "-a": "starts with -", "+a": "starts with +", ".": "is .", "..": "is ..",
           "a" * 256: "too long", "ok-1": None, "a" * 255: None, ".a": None}
    assert apply(spark, list(bad), Q.target_name_problem) == list(bad.values())


def test_user_names(spark):
    values = ["a@b.c", "a@b", "a b@c.d", "a@-b", "a@b..c", None, "", "x" * 250 + "@b.c",
              "x" * 251 + "@b.c", "a@b.c\n"]
    got = apply(spark, values, Q.valid_user_name)
    assert got == [True, True, False, False, False, False, False, True, False, False]


def test_column_helper_keeps_nulls(spark):
    assert column(spark, [None, "a"]).where("c is null").count() == 1


def test_layout_elements_are_right_or_refused(spark):
    from filetrail.functions.names import date_pattern, target_name
    from filetrail.plans.filters import QuerySpec
    t = utc(2024, 2, 5, 15, 4, 9, 120_000)
    layouts = {
        "2006.002": "2024.036", "15:04:05.000000": "15:04:09.120000", "05.00": "09.12", "3PM": "3PM", "03 PM": "03 PM",
        "2006-01-02T15:04:05Z07:00": "2024-02-05T15:04:09Z", "15-07:00": "15+00:00", "15-0700": "15+0000",
        "2006.01.02.15": "2024.02.05.15", "Mon Jan 2 06": "Mon Feb 5 24", "15h04": "15h04", "01_2006": "02_2024", "2006_01_02": "2024_02_05",
    }
    df = spark.range(1).select(*[target_name("b", F.lit(t), k).alias(str(i)) for i, k in enumerate(layouts)])
    assert list(df.first()) == [f"b-{v}" for v in layouts.values()]
    for odd in ("Jan _2", "3pm", "15:04:05.999", "05,000", "__2"):
        with pytest.raises(ValueError, match="layout element"):
            date_pattern(odd)
        with pytest.raises(ValueError, match="layout element"):
            QuerySpec("q", (), layout=odd)
