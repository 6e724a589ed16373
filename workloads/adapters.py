"""Raw-event columns made from the benchmark tables, for Spark and for DuckDB.

The expressions use the SQL both engines share; only time formatting and arrays
differ, and are filled in per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Sources: any table read as (event_id, ts, user_id, event_type).
EVENTS = "select event_id, ts, user_id, event_type from events"
SHIPMENTS = (
    "select l_orderkey * 8 + l_linenumber as event_id, l_shipdate as ts, "
    "l_suppkey as user_id, l_returnflag as event_type from lineitem"
)

SPARK = {
    "sec": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "ms": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
    "us": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")",
    "list": "array",
    "none": "cast(array() as array<string>)",
    "sha": "sha2(cast(event_id as string), 256)",
}
DUCK = {
    "sec": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
    "ms": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')",
    "us": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')",
    "list": "list_value",
    "none": "cast([] as varchar[])",
    "sha": "sha256(cast(event_id as string))",
}

ID, USER = "cast(event_id as string)", "cast(user_id as string)"
RAW_EVENT = {
    "event_id": "event_id",
    "eventId": f"concat('ev-', {ID})",
    "eventType": "case event_id % 5 when 0 then 'CREATED' when 1 then 'modified' "
    "when 2 then 'Deleted' when 3 then '' else event_type end",
    "eventTimestamp": "case when event_id % 7 = 0 then {sec} else {ms} end",
    "insertionTimestamp": "{us}",
    "createTimestamp": "case when event_id % 3 = 0 then '' else {ms} end",
    "modifyTimestamp": "case when event_id % 4 = 0 then '' else {sec} end",
    "filePath": f"concat('/home/u', {USER}, '/')",
    "fileName": f"case event_id % 4 when 0 then concat(event_type, '_', {ID}, '.tar.gz') "
    "when 1 then '.bashrc' when 2 then 'a.' else concat('noext', " + ID + ") end",
    "fileType": "case event_id % 8 when 0 then 'FILE' when 1 then 'WIN_NDS' when 2 then 'DIR' "
    "when 3 then 'char_device' when 4 then 'symlink' when 5 then 'bundle' "
    "when 6 then '' else 'x' end",
    "fileCategory": "case when event_id % 2 = 0 then 'Document' else '' end",
    "fileOwner": f"concat('owner', {USER})",
    "fileSize": "event_id * 10",
    "md5Checksum": f"case when event_id % 3 = 0 then '' else md5({ID}) end",
    "sha256Checksum": "case when event_id % 2 = 0 then '' else {sha} end",
    "mimeTypeByBytes": "case event_id % 3 when 0 then 'text/plain' when 1 then '' else 'a/b' end",
    "mimeTypeByExtension": "case event_id % 4 when 0 then 'text/plain' when 1 then '' "
    "else 'a/b' end",
    "deviceUserName": "case event_id % 4 when 0 then 'NAME_NOT_AVAILABLE' "
    f"when 1 then concat('u', {USER}, '@d', {USER}, '.example') when 2 then 'plain' "
    "else '' end",
    "actor": f"case when event_id % 8 = 0 then '' else concat('act', {USER}, '@corp.example') end",
    "operatingSystemUser": "case event_id % 5 when 0 then 'osuser' "
    "when 1 then 'NAME_NOT_AVAILABLE' else '' end",
    "userUid": f"case when event_id % 3 = 0 then '' else {USER} end",
    "deviceUid": f"concat('dev', {USER})",
    "osHostName": f"concat('host', {USER})",
    "domainName": f"concat('host', {USER}, '.corp.example')",
    "publicIpAddress": "case when event_id % 10 = 0 then '' "
    "else concat('203.0.113.', cast(user_id % 40 as string)) end",
    "privateIpAddresses": "case when event_id % 6 = 0 then {none} else "
    "{list}(concat('fe80::', " + USER + ", '%eth0'), concat('10.0.0.', "
    "cast(event_id % 250 as string))) end",
    "url": f"concat('https://u', {USER}, '.files.example.co.uk:8443/f%20x/', {ID}, "
    "'.html?x=1#top')",
    "processOwner": "case when event_id % 2 = 0 then '' else 'root' end",
    "processName": "case when event_id % 4 = 0 then 'cp' else '' end",
    "detectionSourceAlias": "'agent'",
    "destinationCategory": "case when event_id % 2 = 0 then 'Cloud' else '' end",
}


def _exprs(engine: dict[str, str]) -> list[str]:
    return [f"{e.format(**engine)} as {n}" for n, e in RAW_EVENT.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """The benchmark table as raw events, keeping ``event_id`` beside the raw columns."""
    df = table(spark, sf_dir, source)
    if source == "lineitem":
        df = df.selectExpr(
            "l_orderkey * 8 + l_linenumber as event_id", "l_shipdate as ts",
            "l_suppkey as user_id", "l_returnflag as event_type",
        )
    return as_raw_events(df)


def as_raw_events(df: DataFrame) -> DataFrame:
    """Raw events from rows with (event_id, ts, user_id, event_type)."""
    return df.selectExpr(*_exprs(SPARK))


def raw_sql(source: str = EVENTS) -> str:
    """The same raw events as a DuckDB query."""
    return f"select {', '.join(_exprs(DUCK))}, ts from ({source})"
