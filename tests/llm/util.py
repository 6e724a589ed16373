from pyspark.sql import types as T

DOCS = "doc_id bigint, text string"


def docs(spark, rows, extra=""):
    """Documents from (doc_id, text) pairs; ``extra`` names more string columns, each 'x'."""
    names = extra.split()
    schema = T.StructType.fromDDL(DOCS) if hasattr(T.StructType, "fromDDL") else DOCS
    df = spark.createDataFrame(rows, schema)
    for name in names:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def rows(df, *names):
    """Rows as tuples, sorted with nulls first."""
    found = [tuple(r) for r in df.select(*names).collect()]
    return sorted(found, key=lambda r: [(x is not None, str(type(x)), x if not isinstance(x, (list, dict)) else str(x)) for x in r])
