"""Raw events from landed files, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from filetrail.schemas import RAW


def wire_schema(aliases: Mapping[str, str] | None = None) -> T.StructType:
    """The raw schema under the names the files use (``wire name -> our name``)."""
    wire = {ours: theirs for theirs, ours in (aliases or {}).items()}
    return T.StructType([T.StructField(wire.get(f.name, f.name), f.dataType) for f in RAW.fields])


def _ours(df: DataFrame, aliases: Mapping[str, str] | None) -> DataFrame:
    return df.withColumnsRenamed(dict(aliases)) if aliases else df


def read_raw(spark: SparkSession, path: str, fmt: str = "json",
             aliases: Mapping[str, str] | None = None, **options) -> DataFrame:
    """All landed raw events; the schema is given, so nothing is read to infer it."""
    reader = spark.read.format(fmt).schema(wire_schema(aliases)).options(**options)
    return _ours(reader.load(path), aliases)


def stream_raw(spark: SparkSession, path: str, fmt: str = "json",
               aliases: Mapping[str, str] | None = None, **options) -> DataFrame:
    """The same files as a stream; ``maxFilesPerTrigger`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(wire_schema(aliases)).options(**options)
    return _ours(reader.load(path), aliases)
