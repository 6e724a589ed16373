"""State tables: geo cache snapshots and the window log.

A snapshot goes to a new folder and becomes visible only when its version is added
to the version list, so a reader never sees half of one and a job never overwrites
what it reads. The window log is only added to; its current state is an aggregate, which
``compact_windows`` may put in the place of the rows it came from. One run of a query at
a time holds its claim.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetrail.operators.geo import FAILED_TTL, SUCCESS_TTL, upsert_cache
from filetrail.operators.windows import current_windows
from filetrail.plans.filters import MILLISECOND, QuerySpec, bounds
from filetrail.schemas import GEO, GEO_CACHE, QUERIES, WINDOWS

VERSIONS = T.StructType([T.StructField("version", T.LongType())])


def read_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at ``path``, or an empty one when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def cache_version(spark: SparkSession, path: str) -> int | None:
    return read_log(spark, f"{path}/versions", VERSIONS).agg(F.max("version")).first()[0]


def save_cache(df: DataFrame, path: str) -> int:
    """Write a snapshot of the geo cache and make it the current one."""
    spark = df.sparkSession
    version = (cache_version(spark, path) or 0) + 1
    df.select(*GEO_CACHE.fieldNames()).write.mode("overwrite").parquet(f"{path}/v{version}")
    row = spark.createDataFrame([(version,)], VERSIONS).coalesce(1)
    row.write.mode("append").parquet(f"{path}/versions")
    return version


def load_cache(spark: SparkSession, path: str) -> DataFrame:
    """The current snapshot of the geo cache; empty when there is none."""
    version = cache_version(spark, path)
    if version is None:
        return spark.createDataFrame([], GEO_CACHE)
    return spark.read.schema(GEO_CACHE).parquet(f"{path}/v{version}")


def read_locations(spark: SparkSession, path: str, written_at: datetime, lang: str = "",
                   fmt: str = "parquet") -> DataFrame:
    """A landed table of locations, keyed by its ``query`` field, as lookup results."""
    location = F.struct(*GEO.fieldNames())
    return spark.read.format(fmt).schema(GEO).load(path).select(
        F.col("query").alias("ip"),
        F.lit(lang).alias("lang"),
        F.lit(written_at).alias("written_at"),
        F.lit(None).cast("string").alias("error"),
        location.alias("location"),
    )


def refresh_cache(results: DataFrame, path: str, success_ttl: timedelta = SUCCESS_TTL,
                  failed_ttl: timedelta = FAILED_TTL) -> int:
    """Add lookup results to the saved cache as a new snapshot."""
    cache = load_cache(results.sparkSession, path)
    return save_cache(upsert_cache(cache, results, success_ttl, failed_ttl), path)


def append_windows(windows: DataFrame, path: str, status: str | None = None) -> None:
    """Add rows to the window log, with ``status`` in place of their own if given."""
    if status:
        windows = windows.withColumn("status", F.lit(status))
    rows = windows.select(*WINDOWS.fieldNames())
    rows.hint("rebalance").write.mode("append").parquet(path)


def load_windows(spark: SparkSession, path: str) -> DataFrame:
    """The current state of every window in the log; empty when there is none."""
    return current_windows(read_log(spark, path, WINDOWS))


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, as the JVM has them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def compact_windows(spark: SparkSession, path: str) -> int:
    """Put the current state of the log beside its files, and remove those it covers.

    The log's state is the same whether a row is in it once or twice, so a crash between
    both steps, a repeat, and rows added meanwhile do no harm. A reader that has listed the
    log already may still need the files: they go at the next call only. So a log that is
    compacted from time to time holds its state at most twice, and what was added since.
    Returns the number of files removed.
    """
    store, _ = _folder(spark, path)
    listed = set(read_log(spark, path, WINDOWS).inputFiles())
    if not listed:
        return 0
    covered = read_log(spark, f"{path}/_covered", "version long, file string")
    due = {r["file"] for r in covered.select("file").distinct().toLocalIterator()} & listed
    for file in due:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(file), False)
    live = listed - due
    if len(live) > 1:
        spark.catalog.refreshByPath(path)
        append_windows(current_windows(spark.read.schema(WINDOWS).parquet(*sorted(live))), path)
        last = covered.agg(F.max("version")).first()[0] or 0
        names = spark.createDataFrame([(last + 1, f) for f in sorted(live)], "version long, file string")
        names.coalesce(1).write.mode("append").parquet(f"{path}/_covered")
    return len(due)


class Claimed(RuntimeError):
    """Another run holds the claim."""


@contextmanager
def claim(spark: SparkSession, path: str, name: str, as_of: datetime,
          stale: timedelta = timedelta(hours=1)) -> Iterator[None]:
    """Hold the claim of query ``name`` on the window log at ``path``; one run at a time can.

    The claim is a file that only one run can make. A run that dies leaves it; after
    ``stale`` another run takes it over, so ``stale`` must be longer than any run.
    """
    store, file = _folder(spark, f"{path}/_claims/{quote(name, safe='')}")
    fs = spark._jvm.org.apache.hadoop.fs

    def make() -> bool:
        try:
            store.create(file, False).close()
        except Py4JJavaError as e:
            if not store.exists(file):
                raise RuntimeError(f"no claim can be made at {path}") from e
            return False
        return True

    if not make():
        since = datetime.fromtimestamp(store.getFileStatus(file).getModificationTime() / 1000, UTC)
        # Of several runs that find a stale claim only one can move it away.
        aside = fs.Path(f"{file.toString()}.{uuid.uuid4().hex}")
        if as_of - since < stale or not store.rename(file, aside):
            raise Claimed(f"{name} is being pulled since {since:%Y-%m-%d %H:%M:%S}")
        store.delete(aside, False)
        if not make():
            raise Claimed(f"{name} is being pulled")
    try:
        yield
    finally:
        store.delete(file, False)


def query_table(spark: SparkSession, specs: list[QuerySpec], started_at: datetime) -> DataFrame:
    """One row per named query, as ``plan_windows`` takes it.

    A query without a start begins at ``started_at``: the time of its first run.
    """
    rows = []
    for s in specs:
        start, end = bounds(s)
        rows.append((s.name, start or started_at, end, s.gap // MILLISECOND))
    return spark.createDataFrame(rows, QUERIES)
