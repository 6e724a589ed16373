from datetime import UTC, datetime

from pyspark.sql import types as T

from filetrail.schemas import RAW


def utc(*parts):
    return datetime(*parts, tzinfo=UTC)


def raw_rows(spark, rows):
    """A raw DataFrame from dicts; fields left out are NULL."""
    names = RAW.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW)


def column(spark, values, kind=T.StringType(), name="c"):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField(name, kind)])
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema)


def apply(spark, values, fn, kind=T.StringType()):
    """The values of ``fn(column)`` in input order."""
    df = column(spark, values, kind)
    rows = df.select("i", fn(df["c"]).alias("v")).orderBy("i").collect()
    return [r["v"] for r in rows]
