import json

import pytest
from pyspark.sql import functions as F

from filetrail.operators import normalize as N
from filetrail.operators.geo import project_location
from filetrail.schemas import FLAT_TARGET, GEO, RAW
from filetrail.sinks.files import json_lines
from tests.util import raw_rows

EVENT = dict(
    eventId="e1", eventType="CREATED", eventTimestamp="2020-01-02T03:04:05.678Z",
    insertionTimestamp="2020-01-02T03:09:05.678999Z", fileName="a.gz", fileType="FILE",
    filePath="/tmp/", fileSize=0, directoryId=[], md5Checksum="", sha256Checksum="",
    deviceUserName="u@d.com", privateIpAddresses=["fe80::1%eth0"], publicIpAddress="8.8.8.8",
    tabs=[("t1", "http://a.com/x"), ("", "")], sharedWith=[("a",), ("",), (None,)],
    trusted=False, detectionSourceAlias="agent", destinationCategory="Cloud",
)


def as_json(df):
    return [json.loads(r["value"]) for r in json_lines(df).collect()]


def test_full_record(spark):
    got = as_json(N.normalize(raw_rows(spark, [EVENT]), strip_zone=True, dataset="d", module="m"))
    time = "2020-01-02T03:04:05.678Z"
    assert got == [{
        "event": {"action": "CREATED", "category": "file", "created": time, "dataset": "d",
                  "id": "e1", "ingested": "2020-01-02T03:09:05.678Z", "kind": "event",
                  "module": "m", "type": "creation"},
        "@timestamp": time,
        "file": {"extension": "gz", "mime_type": [""], "name": "a.gz", "path": "/tmp/", "size": 0,
                 "type": "file"},
        "host": {"user": {"email": "u@d.com", "name": "u", "domain": "d.com"},
                 "ip": ["fe80::1", "8.8.8.8"]},
        "source_event": {
            "event": {"id": "e1", "type": "CREATED", "timestamp": time},
            "insertion_timestamp": "2020-01-02T03:09:05.678Z",
            "file": {"path": "/tmp/", "name": "a.gz", "type": "FILE", "size": 0},
            "device": {"username": "u@d.com"},
            "public_ip_address": "8.8.8.8",
            "private_ip_addresses": ["fe80::1"],
            "shared_with": [{"cloud_username": "a"}, {"cloud_username": ""}, {}],
            "detection_source_alias": "agent",
            "removable_media": {}, "email_dlp": {}, "print": {}, "trusted": False,
            "destination": {"category": "Cloud", "name": "agent"},
            "tabs": [{"title": "t1", "url": {"full": "http://a.com/x", "scheme": "http",
                                             "domain": "a.com", "path": "/x"}}, {}],
        },
    }]


def test_empty_event_keeps_only_what_is_always_there(spark):
    got = as_json(N.normalize(raw_rows(spark, [{}])))[0]
    assert got["event"] == {"category": "file", "dataset": "file_activity", "kind": "event",
                            "module": "file_activity", "type": "info"}
    assert got["file"] == {"mime_type": [""], "type": "unknown"}
    assert got["host"] == {}
    assert got["source_event"] == {"event": {}, "file": {}, "device": {}, "removable_media": {},
                                   "email_dlp": {}, "print": {}, "destination": {}}


def test_input_lacking_columns_and_strict_mode(spark):
    df = spark.createDataFrame([("e", "bad")], "eventId string, eventTimestamp string")
    assert N.normalize(df).first()["event"]["created"] is None
    with pytest.raises(Exception, match="not an event time: bad"):
        N.normalize(df, strict=True).collect()


def test_destination_name_column_is_a_choice(spark):
    df = raw_rows(spark, [dict(EVENT, syncDestination="s")])
    row = N.normalize(df, destination_name="syncDestination").first()
    assert row["source_event"]["destination"]["name"] == "s"


def test_geo_in_record(spark):
    location = json.dumps({"country": "C", "zip": "", "lat": 1.0, "lon": 0.0, "mobile": False,
                           "asname": "n", "query": "8.8.8.8", "currency": "X"})
    df = raw_rows(spark, [EVENT, {}]).withColumn(
        "geo", F.when(F.col("eventId") == "e1", F.from_json(F.lit(location), GEO)))
    with_geo, without = as_json(N.normalize(df, geo_col="geo"))
    assert with_geo["host"]["geo"] == {"country_name": "C", "lat": 1.0, "lon": 0.0,
                                       "mobile": False, "as_name": "n", "query": "8.8.8.8",
                                       "currency": "X"}
    assert "geo" not in without["host"]


def test_field_projection(spark):
    whole = {f: "x" for f in GEO.fieldNames()[:20]} | {"lat": 1.0, "lon": 2.0, "mobile": True,
                                                       "proxy": True, "hosting": True}
    df = spark.range(1).select(F.from_json(F.lit(json.dumps(whole)), GEO).alias("g"))

    def kept(fields):
        row = df.select(project_location(F.col("g"), fields).alias("g")).first()["g"]
        return {k for k, v in row.asDict().items() if v is not None}

    assert kept("") == set("query status country countryCode region regionName city zip lat lon "
                           "timezone isp org as".split())
    assert kept("city,currency") == {"city", "query"}
    assert kept(",".join(GEO.fieldNames())) == set(GEO.fieldNames())


def test_flat_record_and_typed_target(spark):
    df = raw_rows(spark, [EVENT]).withColumn(
        "geo", F.from_json(F.lit('{"lat": 1.5, "lon": 2.5, "city": "c"}'), GEO))
    flat = N.flatten_raw(df, "geo")
    assert flat.columns == RAW.fieldNames() + GEO.fieldNames() + ["geoPoint"]
    row = flat.first()
    assert row["eventTimestamp"] == EVENT["eventTimestamp"] and row["city"] == "c"
    assert tuple(row["geoPoint"]) == (1.5, 2.5)
    assert row["md5Checksum"] is None and row["directoryId"] is None
    typed = N.type_flat(flat)
    assert [(f.name, f.dataType) for f in typed.schema] == [
        (f.name, f.dataType) for f in FLAT_TARGET]
    assert typed.select(F.unix_millis("insertionTimestamp")).first()[0] == 1577934545678


def test_normalizing_moves_no_rows(spark):
    plan = N.normalize(raw_rows(spark, [EVENT]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
