"""Geo enrichment: expiring location cache, left lookup join, cache upkeep.

``as_of`` is the instant the cache is read at; it is always given by the caller so
that a result can be reproduced.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from filetrail.functions.fields import omit_empty
from filetrail.schemas import GEO

SUCCESS_TTL = timedelta(hours=8)
FAILED_TTL = timedelta(minutes=30)

# Fixed value: location fields returned when none are asked for.
DEFAULT_FIELDS = (
    "query,status,country,countryCode,region,regionName,city,zip,lat,lon,timezone,isp,org,as"
)

#: Locations of more bytes are joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: Lots that rows without an address are dealt into.
SALTS = 1_024
#: Width of a bucket of time, buckets an interval may span before wider ones are taken, and widths.
AS_OF_BUCKET = timedelta(hours=1)
SPAN, LEVELS = 64, 5


def project_location(location: Column, fields: str = "") -> Column:
    """Keep the listed location fields, others become NULL; NULL stays NULL.

    ``fields`` is comma-separated; empty means the default list. A list naming every
    field keeps the location whole; a shorter one always includes ``query`` and never
    ``currency``.
    """
    names = GEO.fieldNames()
    asked = set((fields or DEFAULT_FIELDS).split(","))
    if not asked >= set(names):
        asked = (asked | {"query"}) - {"currency"}
    kept = [
        (location[f.name] if f.name in asked else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in GEO.fields
    ]
    return F.when(location.isNotNull(), F.struct(*kept))


def latest(cache: DataFrame) -> DataFrame:
    """One row per (ip, lang): the last written. Equal times resolve by content.

    A partial ``max`` per task, so many writes of one hot key combine before they
    are shuffled.
    """
    last = F.max(F.struct("written_at", "expiration_time", "location"))
    return cache.groupBy("ip", "lang").agg(last.alias("last")).select("ip", "lang", "last.*")


def fresh(cache: DataFrame, as_of: datetime) -> DataFrame:
    """Cache rows usable at ``as_of``; a row expiring exactly then is still fresh."""
    return latest(cache).where(F.col("expiration_time") >= F.lit(as_of))


def cache_misses(events: DataFrame, cache: DataFrame, as_of: datetime,
                 ip_col: str = "publicIpAddress", lang: str = "") -> DataFrame:
    """Distinct addresses of the events with no fresh cache row: ``(ip, lang)``."""
    keys = (
        events.select(omit_empty(F.col(ip_col)).alias("ip"))
        .where(F.col("ip").isNotNull())
        .distinct()
        .withColumn("lang", F.lit(lang))
    )
    return keys.join(fresh(cache, as_of), ["ip", "lang"], "left_anti")


def lookup_outcomes(results: DataFrame) -> DataFrame:
    """Complete lookup results: a failed call becomes a ``fail`` location whose
    message is the error. Adds ``kind``: success, answered_fail, transport_error, other.
    """
    failed = F.col("error").isNotNull()
    nothing = F.from_json(F.lit("{}"), GEO)
    base = F.coalesce(F.col("location"), F.when(failed, nothing))
    location = F.when(
        failed, base.withField("status", F.lit("fail")).withField("message", F.col("error"))
    ).otherwise(base)
    status = F.col("location")["status"]
    kind = (
        F.when(failed, "transport_error")
        .when(status == "success", "success")
        .when(status == "fail", "answered_fail")
        .otherwise("other")
    )
    return results.withColumn("kind", kind).withColumn("location", location)


def upsert_cache(cache: DataFrame, results: DataFrame, success_ttl: timedelta = SUCCESS_TTL,
                 failed_ttl: timedelta = FAILED_TTL) -> DataFrame:
    """The cache with lookup results added; the last write of a key wins.

    Successes and failures expire after their own time; answers with any other
    status are not stored.
    """
    return latest(cache.unionByName(_stored(results, success_ttl, failed_ttl)))


def _stored(results: DataFrame, success_ttl: timedelta, failed_ttl: timedelta) -> DataFrame:
    """The cache rows that lookup results make, one for each write."""
    ttl = F.when(F.col("kind") == "success", F.lit(success_ttl)).otherwise(F.lit(failed_ttl))
    return (
        lookup_outcomes(results)
        .where(F.col("kind") != "other")
        .select(
            "ip",
            "lang",
            "written_at",
            (F.col("written_at") + ttl).alias("expiration_time"),
            "location",
        )
    )


def cache_history(results: DataFrame, success_ttl: timedelta = SUCCESS_TTL,
                  failed_ttl: timedelta = FAILED_TTL) -> DataFrame:
    """Every write of the cache, with its expiry: what ``enrich_as_of`` looks up in."""
    return _stored(results, success_ttl, failed_ttl)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes a row takes in memory: text by its length, other values 8 each."""
    parts = [F.lit(32)]

    def add(c: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                add(c[f.name], f.dataType)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(8)))
        else:
            text = isinstance(kind, (T.StringType, T.BinaryType))
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8 if text else F.lit(8))

    for f in df.schema.fields:
        add(F.col(f"`{f.name}`"), f.dataType)
    return reduce(lambda a, b: a + b, parts).cast("long")


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the rows take at most about ``max_bytes``; they are counted, not guessed."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes


def enrich_geo(events: DataFrame, cache: DataFrame, as_of: datetime,
               ip_col: str = "publicIpAddress", lang: str = "", fields: str = "",
               out: str = "geo", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left lookup of every event's address in the fresh cache, as struct column ``out``.

    Events are never dropped or multiplied; an absent address matches nothing. If the
    locations that are fresh in the language, with the fields asked for, take at most
    ``broadcast_bytes``, they are broadcast and the events stay where they are. More are
    joined by shuffle, where adaptive execution splits the rows of a busy address.
    """
    asked = cache.where(F.col("lang") == lang).withColumn(
        "location", project_location(F.col("location"), fields)
    )
    locations = fresh(asked, as_of).select(F.col("ip").alias("_ip"), F.col("location").alias(out))
    key = omit_empty(F.col(ip_col))
    if fits_broadcast(locations, broadcast_bytes):
        joined = events.join(F.broadcast(locations), key == F.col("_ip"), "left")
    else:
        joined = _spread_join(events, locations, key)
    return joined.drop("_ip")


def spread(key: Column, by: Column) -> Column:
    """0 for rows with a key; rows without one, which match nothing, are dealt by a hash."""
    return F.when(key.isNull(), 1 + F.pmod(F.xxhash64(by), F.lit(SALTS - 1))).otherwise(0).cast("int")


def _spread_join(events: DataFrame, locations: DataFrame, key: Column) -> DataFrame:
    """The left lookup by shuffle, in one pass over the events.

    Rows without an address would all have the same key, so a salt made of their other
    values deals them out.
    """
    plain = [f.name for f in events.schema.fields if isinstance(f.dataType, T.AtomicType)]
    by = F.struct(*[F.col(f"`{c}`") for c in plain])
    right = locations.withColumn("_match", F.lit(0)).hint("merge")
    salted = events.withColumn("_salt", spread(key, by))
    found = salted.join(right, (key == F.col("_ip")) & (F.col("_salt") == F.col("_match")), "left")
    return found.drop("_salt", "_match")


def history_intervals(history: DataFrame) -> DataFrame:
    """``ip, lang, valid_from, valid_before, expiration_time, location`` of each cache write.

    A write holds from its time until the next one of its key (NULL: for good) and while it
    has not expired; of several at one time the last by content counts, as in ``latest``.
    """
    last = F.max(F.struct("expiration_time", "location")).alias("last")
    once = history.groupBy("ip", "lang", "written_at").agg(last)
    following = Window.partitionBy("ip", "lang").orderBy("written_at")
    return once.select(
        "ip", "lang", F.col("written_at").alias("valid_from"),
        F.lead("written_at").over(following).alias("valid_before"), "last.*",
    ).where("expiration_time >= valid_from")


def enrich_as_of(events: DataFrame, history: DataFrame, time: Column,
                 ip_col: str = "publicIpAddress", lang: str = "", fields: str = "",
                 out: str = "geo", bucket: timedelta = AS_OF_BUCKET) -> DataFrame:
    """Left lookup of every event's address as the cache was at the event's own time.

    That is the last write of the address at or before ``time``, if it had not expired
    then. Events are never dropped or multiplied; without an address or a time nothing
    matches.

    Each write is an interval, cut into buckets of time, so the join is an equality on
    address and bucket and compares an event with the few writes near it; the rows of a
    busy address spread over its buckets. An interval of more than ``SPAN`` buckets uses
    buckets ``SPAN`` times as wide, or wider again, so that none is cut into many pieces;
    the events are joined once for each width that occurs, which is one where all writes
    live about as long.
    """
    asked = history.where(F.col("lang") == lang).withColumn(
        "location", project_location(F.col("location"), fields)
    )
    ends = F.least(F.col("expiration_time"), F.col("valid_before"))
    low, high = F.unix_micros("valid_from"), F.unix_micros(ends)
    widths = [bucket // timedelta(microseconds=1) * SPAN**level for level in range(LEVELS)]

    def place(micros: Column, width: int) -> Column:
        return F.floor(micros / F.lit(width)).cast("long")

    level = F.lit(LEVELS - 1)
    for i in reversed(range(LEVELS - 1)):
        level = F.when(place(high, widths[i]) - place(low, widths[i]) < SPAN, i).otherwise(level)
    intervals = history_intervals(asked).withColumn("_level", level)
    levels = sorted(r[0] for r in intervals.select("_level").distinct().collect())

    key = omit_empty(F.col(ip_col))
    names = events.columns
    found = events.withColumns({"_key": key, "_at": F.unix_micros(time.cast("timestamp"))})
    found = found.withColumn("_salt", spread(F.col("_key"), F.col("_at")))
    values = []
    for i in levels:
        side = intervals.where(F.col("_level") == i).select(
            F.col("ip").alias("_ip"), F.lit(0).alias("_match"), low.alias("_low"),
            F.unix_micros("valid_before").alias("_next"), F.unix_micros("expiration_time").alias("_last"),
            F.explode(F.sequence(place(low, widths[i]), place(high, widths[i]))).alias("_bucket"),
            F.col("location").alias(f"_found_{i}"),
        )
        values.append(F.col(f"_found_{i}"))
        found = found.join(
            side,
            (F.col("_key") == F.col("_ip")) & (F.col("_salt") == F.col("_match"))
            & (place(F.col("_at"), widths[i]) == F.col("_bucket"))
            & (F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_last"))
            & (F.col("_next").isNull() | (F.col("_at") < F.col("_next"))),
            "left",
        ).drop("_ip", "_match", "_bucket", "_low", "_next", "_last")
    location = F.coalesce(*values) if values else F.lit(None).cast(asked.schema["location"].dataType)
    return found.select(*(F.col(f"`{c}`") for c in names), location.alias(out))
