"""Lookup keys of a stream: each is asked for once until what is known of it expires.

A key is asked for when the cache has nothing fresh for it and no earlier batch asked. What
was asked is a table: a row holds its key back until an answer reaches the cache, or until
its time is over and the key may be asked for again. Rows lie under the hour they expire
in, so a batch reads the open hours only, and old hours are dropped as whole folders.
"""

from __future__ import annotations

import hashlib
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from filetrail.functions.fields import omit_empty
from filetrail.operators.geo import FAILED_TTL, cache_misses
from filetrail.schemas import GEO
from filetrail.sources.state import load_cache, read_log
from filetrail.streaming.runs import _trigger, checkpoint_dir

ASKED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("ip", "lang")]
    + [T.StructField(n, T.TimestampType()) for n in ("asked_at", "open_until")]
    # The folders: hour of expiry, run, batch.
    + [T.StructField(n, T.StringType()) for n in ("hour", "run")]
    + [T.StructField("batch", T.LongType())]
)
HOUR = "yyyy-MM-dd-HH"
#: Old hours are dropped at every so many batches.
DROP_EVERY = 100


def run_key(checkpoint: str) -> str:
    """Names the run a checkpoint belongs to; batch numbers mean something within it."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def asked_keys(spark: SparkSession, path: str) -> DataFrame:
    """All keys asked for that are still kept, one row for each time."""
    return read_log(spark, path, ASKED)


def open_asks(spark: SparkSession, path: str, as_of: datetime, run: str = "",
              batch: int | None = None) -> DataFrame:
    """Asks that hold their keys back at ``as_of``; those of ``batch`` of ``run`` and later
    don't count, for a replay must ask for what it asked before."""
    hour = as_of.astimezone(UTC).strftime("%Y-%m-%d-%H")
    asks = asked_keys(spark, path).where((F.col("hour") >= hour) & (F.col("open_until") >= F.lit(as_of)))
    if batch is not None:
        asks = asks.where((F.col("run") != run) | (F.col("batch") < batch))
    return asks


def batch_misses(events: DataFrame, cache: DataFrame, asks: DataFrame, as_of: datetime,
                 ip_col: str = "publicIpAddress", lang: str = "") -> DataFrame:
    """Distinct keys of the events without a fresh cache row or an open ask: ``(ip, lang)``.

    An ask is held against the cache by its time, like a write: an answer that came after it
    counts instead of it, also one that has expired since.
    """
    keys = events.select(omit_empty(F.col(ip_col)).alias("ip"), F.lit(lang).alias("lang")).distinct()
    nothing = F.lit(None).cast(GEO).alias("location")
    held = asks.select("ip", "lang", F.col("asked_at").alias("written_at"),
                       F.col("open_until").alias("expiration_time"), nothing)
    # Only what is known of the batch's own keys is compared.
    known = cache.unionByName(held).join(keys, ["ip", "lang"], "left_semi")
    return cache_misses(events, known, as_of, ip_col, lang)


def start_misses(source: DataFrame, path: str, cache_path: str, checkpoint: str | None = None,
                 interval: str | None = None, ip_col: str = "publicIpAddress", lang: str = "",
                 waiting: timedelta = FAILED_TTL, name: str = "lookups") -> StreamingQuery:
    """Write the keys each micro-batch has to ask for to the table at ``path``.

    A batch's keys are those of ``batch_misses`` for the cache at ``cache_path`` as it is
    then, and for what earlier batches asked less than ``waiting`` ago without an answer.
    Its time is the batch's own, and its folders are replaced when it is replayed, so a
    batch that runs twice asks once. One stream at a time may write to ``path``; one with a
    new checkpoint goes on with what the one before asked.
    """
    spark = source.sparkSession
    checkpoint = checkpoint or checkpoint_dir(spark, name)
    run = run_key(checkpoint)

    def ask(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        moment = batch.agg(F.max("_processed_at")).first()[0]
        if moment is None:
            return
        as_of = moment.astimezone(UTC)
        asks = open_asks(session, path, as_of, run, batch_id)
        missing = batch_misses(batch, load_cache(session, cache_path), asks, as_of, ip_col, lang)
        until = as_of + waiting
        rows = missing.select(
            "ip", "lang", F.lit(as_of).alias("asked_at"), F.lit(until).alias("open_until"),
            F.lit(until.strftime("%Y-%m-%d-%H")).alias("hour"), F.lit(run).alias("run"),
            F.lit(batch_id).alias("batch"),
        )
        (
            rows.hint("rebalance").write.partitionBy("hour", "run", "batch").mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").parquet(path)
        )
        if batch_id % DROP_EVERY == DROP_EVERY - 1:
            drop_old_asks(session, path, as_of)

    return (
        source.withColumn("_processed_at", F.current_timestamp())
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .foreachBatch(ask)
        .start()
    )


def drop_old_asks(spark: SparkSession, path: str, as_of: datetime) -> int:
    """Delete the folders of hours that ended before ``as_of``; how many went."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(hadoop)
    if not files.exists(root):
        return 0
    limit = "hour=" + as_of.astimezone(UTC).strftime("%Y-%m-%d-%H")
    old = [s.getPath() for s in files.listStatus(root) if "hour=" <= s.getPath().getName() < limit]
    for folder in old:
        files.delete(folder, True)
    return len(old)
