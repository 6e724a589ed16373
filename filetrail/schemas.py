"""Table layouts: raw events, geo locations, geo cache, windows, suffix rules."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_STRINGS = (
    "eventId eventType eventTimestamp insertionTimestamp filePath fileName fileType "
    "fileCategory fileCategoryByBytes fileCategoryByExtension fileOwner md5Checksum "
    "sha256Checksum createTimestamp modifyTimestamp fileId mimeTypeByBytes "
    "mimeTypeByExtension deviceUserName deviceUid userUid osHostName domainName "
    "publicIpAddress actor source url shared cloudDriveId detectionSourceAlias "
    "processOwner processName removableMediaVendor removableMediaName "
    "removableMediaSerialNumber removableMediaBusType removableMediaMediaName "
    "syncDestination emailSubject emailSender emailFrom printJobName printerName "
    "remoteActivity operatingSystemUser destinationCategory"
).split()
RAW_LISTS = (
    "privateIpAddresses directoryId sharingTypeAdded exposure removableMediaVolumeName "
    "removableMediaPartitionId syncDestinationUsername emailDlpPolicyNames emailRecipients"
).split()
RAW_LONGS = ["fileSize", "removableMediaCapacity"]
RAW_BOOLEANS = ["mimeTypeMismatch", "outsideActiveHours", "trusted"]
RAW_TIMES = ["eventTimestamp", "insertionTimestamp", "createTimestamp", "modifyTimestamp"]

TABS = T.ArrayType(T.StructType().add("title", T.StringType()).add("url", T.StringType()))
SHARED_WITH = T.ArrayType(T.StructType().add("cloudUsername", T.StringType()))

RAW = T.StructType(
    [T.StructField(n, T.StringType()) for n in RAW_STRINGS]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in RAW_LISTS]
    + [T.StructField(n, T.LongType()) for n in RAW_LONGS]
    + [T.StructField(n, T.BooleanType()) for n in RAW_BOOLEANS]
    + [T.StructField("tabs", TABS), T.StructField("sharedWith", SHARED_WITH)]
)

# Other spellings some exports use for raw fields: wire name -> our name.
RAW_ALIASES = {
    "createdTimestamp": "createTimestamp",
    "deviceUsername": "deviceUserName",
    "osHostname": "osHostName",
}

GEO_STRINGS = (
    "query status message continent continentCode country countryCode region regionName "
    "city district zip timezone currency isp org as asname reverse"
).split()
GEO_FLOATS = ["lat", "lon"]
GEO_BOOLEANS = ["mobile", "proxy", "hosting"]
GEO = T.StructType(
    [T.StructField(n, T.StringType()) for n in GEO_STRINGS]
    + [T.StructField(n, T.FloatType()) for n in GEO_FLOATS]
    + [T.StructField(n, T.BooleanType()) for n in GEO_BOOLEANS]
)

GEO_CACHE = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("written_at", T.TimestampType()),
        T.StructField("expiration_time", T.TimestampType()),
        T.StructField("location", GEO),
    ]
)

# One answered (or failed) lookup; `error` is set when no answer came back at all.
LOOKUP_RESULTS = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("written_at", T.TimestampType()),
        T.StructField("error", T.StringType()),
        T.StructField("location", GEO),
    ]
)

WINDOWS = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("on_or_after", T.TimestampType()),
        T.StructField("on_or_before", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

QUERIES = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("max_time", T.TimestampType()),
        T.StructField("gap_ms", T.LongType()),
    ]
)

SUFFIX_RULES = T.StructType(
    [T.StructField("rule", T.StringType()), T.StructField("kind", T.StringType())]
)

POINT = T.StructType([T.StructField("lat", T.FloatType()), T.StructField("lon", T.FloatType())])

# Flat target table: raw fields with typed times, location fields, and the point.
FLAT_TARGET = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name in RAW_TIMES else f.dataType)
        for f in RAW.fields
    ]
    + GEO.fields
    + [T.StructField("geoPoint", POINT)]
)
