"""Target tables: one table partitioned by target name, with aliases as views.

Rows reach a table by its catalog name with ``insert_targets``, which replaces what an
earlier run of the same windows wrote and registers new partitions in the same step, or
as folders of a path with ``write_targets``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_KEYS = ("target", "window_id")

# Other names of flat fields -> field.
FIELD_ALIASES = {
    "username": "deviceUserName",
    "user": "deviceUserName",
    "hostname": "osHostName",
    "host": "osHostName",
    "privateIpAddress": "privateIpAddresses",
}


def create_target(spark: SparkSession, name: str, schema: T.StructType,
                  aliases: Iterable[str] = (), best_compression: bool = False,
                  path: str | None = None) -> None:
    """Create the table (if it is not there) and a view for every alias."""
    keys = [k for k in TARGET_KEYS if k not in schema.fieldNames()]
    full = T.StructType(schema.fields + [T.StructField(k, T.StringType()) for k in keys])
    writer = (
        spark.createDataFrame([], full)
        .write.format("parquet")
        .partitionBy(*TARGET_KEYS)
        .option("compression", "zstd" if best_compression else "snappy")
        # Kept with the table, so that every insert replaces its own partitions alone.
        .option("partitionOverwriteMode", "dynamic")
    )
    if not spark.catalog.tableExists(name):
        (writer.option("path", path) if path else writer).saveAsTable(name)
    for alias in aliases:
        spark.sql(
            "CREATE OR REPLACE VIEW IDENTIFIER(:alias) AS SELECT * FROM IDENTIFIER(:name)",
            args={"alias": alias, "name": name},
        )


def with_field_aliases(df: DataFrame, aliases: Mapping[str, str] = FIELD_ALIASES) -> DataFrame:
    """The rows with the alias names added beside the fields they stand for."""
    return df.withColumns({a: F.col(c) for a, c in aliases.items()})


def target_partitions(spark: SparkSession, name: str) -> DataFrame:
    """``target, window_id, partition`` of the partitions the catalog lists; no file is read.

    ``partition`` is the folder as the catalog writes it, where some characters are %XX.
    """
    listed = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name})

    def value(key: str):
        escaped = F.regexp_extract("partition", f"(?:^|/){key}=([^/]*)", 1)
        return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))).alias(key)

    return listed.select(*[value(k) for k in TARGET_KEYS], "partition")


def existing_targets(spark: SparkSession, name: str) -> DataFrame:
    """Targets the table has, from the partitions the catalog lists; no file is read."""
    return target_partitions(spark, name).select("target").distinct()


def insert_targets(df: DataFrame, name: str, append: bool = False, compact: bool = True,
                   evolve: bool = False, windows: Iterable[str] = ()) -> None:
    """Insert rows into a table made by ``create_target``, by column name.

    New partitions are in the catalog when this returns. By default a re-run replaces the
    rows of its own windows, also where they went to another target then, as they do when
    the time of processing names it; ``windows`` names more windows of the run, those that
    have no row now. ``append`` adds rows instead. Columns of the table that ``df`` lacks
    are NULL; others fail the insert, or are added to the table with ``evolve`` (views
    made before show them when they are made anew).
    """
    spark = df.sparkSession
    have = {c.lower() for c in df.columns}
    if lacking := [k for k in TARGET_KEYS if k not in have]:
        raise ValueError(f"rows without {', '.join(lacking)}")
    known = {f.name.lower() for f in spark.table(name).schema}
    if new := [f for f in df.schema if f.name.lower() not in known]:
        if not evolve:
            raise ValueError(f"{name} has no column {', '.join(f.name for f in new)}")
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD COLUMNS ({columns})", args={"name": name})
    rows = df.select(*[
        F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(name).schema
    ])
    if compact:
        rows = rows.hint("rebalance", *[F.col(k) for k in TARGET_KEYS])
    # One entry a partition, which the driver gets from the writers anyway to register them.
    seen = Observation()
    rows = rows.observe(seen, F.collect_set(F.struct(*TARGET_KEYS)).alias("partitions"))
    rows.write.insertInto(name, overwrite=not append)
    if not append:
        written = {tuple(p) for p in seen.get["partitions"]}
        rerun = {w for _, w in written} | set(windows)
        _drop_partitions(spark, name, rerun, written)


def _drop_partitions(spark: SparkSession, name: str, windows: set[str],
                     keep: set[tuple[str, str]]) -> None:
    """Drop the partitions of these windows other than those to keep, with their files."""
    stale = [
        p for p in target_partitions(spark, name).toLocalIterator()
        if p["window_id"] in windows and (p["target"], p["window_id"]) not in keep
    ]
    if not stale:
        return
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    about = {r["col_name"]: r["data_type"] for r in described.collect()}

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    for at in range(0, len(stale), 500):
        specs = [
            "PARTITION (" + ", ".join(f"{k} = {quoted(p[k])}" for k in TARGET_KEYS) + ")"
            for p in stale[at:at + 500]
        ]
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS {', '.join(specs)}", args={"name": name})
    if about.get("Type") == "EXTERNAL":  # dropping leaves the files of such a table
        jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
        for p in stale:
            folder = jvm.org.apache.hadoop.fs.Path(f"{about['Location'].rstrip('/')}/{p['partition']}")
            folder.getFileSystem(hadoop).delete(folder, True)


def write_targets(df: DataFrame, path: str, fmt: str = "parquet", append: bool = False,
                  compact: bool = True, **options) -> None:
    """Write rows to ``target=.../window_id=...`` folders.

    By default a re-run replaces the rows of its own windows; ``append`` adds them
    again instead. ``compact`` as in ``write_windows``.
    """
    if compact:
        df = df.hint("rebalance", *[F.col(k) for k in TARGET_KEYS])
    writer = df.write.format(fmt).partitionBy(*TARGET_KEYS).options(**options)
    if append:
        writer.mode("append").save(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
