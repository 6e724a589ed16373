"""The folder all executors share: cutting lineage, and files that tasks write themselves.

The folder is ``spark.checkpoint.dir``, or one in the warehouse where that is unset.
Every table and file set goes to a new folder of its own, so a job that is run again
never meets what an earlier one left behind.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import io
import uuid
import zipfile
from collections.abc import Callable, Hashable
from pathlib import Path
from typing import Any

from pyarrow import default_memory_pool, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()
_held: dict[Hashable, Any] = {}


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate data goes; on a cluster this must be set to a shared store."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or spark.conf.get("spark.sql.warehouse.dir") + "/shared").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table written in the shared folder.

    Later reads start from the files, so a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it; for use in tasks too."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable by the Python workers of every executor."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent.parent
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        folder = new_folder(spark, "package")
        store, path = file_system(folder)
        store.create_dir(path)
        with store.open_output_stream(f"{path}/{root.name}.zip") as out:
            out.write(buffer.getvalue())
        spark.sparkContext.addPyFile(f"{folder}/{root.name}.zip")
        _shipped.add(app)
    return spark


def hold(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept by the worker process for its next tasks.

    Workers outlive a stage, so one thing is kept at a time: another key replaces it.
    """
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Free what an earlier operator's tasks left in this worker process."""
    if _held:
        _held.clear()
        gc.collect()
        default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)


def put(df: DataFrame, schema_fields: str) -> str:
    """The DDL of ``df`` with the given output fields, which replace fields so named."""
    added = [f.strip() for f in schema_fields.split(",")]
    names = {f.split()[0].lower() for f in added}
    kept = [
        f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
        for f in df.schema.fields if f.name.lower() not in names
    ]
    return ", ".join(kept + added)


def keep_columns(docs: DataFrame, added: set[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows an operator returns, with the columns of ``docs`` only.

    Columns of ``docs`` named like those the operator adds are set aside meanwhile.
    """
    aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in added}
    out = operator(docs.withColumnsRenamed(aside))
    return out.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))
