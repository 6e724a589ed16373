"""JSON output: one folder per window, and plain JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_KEYS = ("query_name", "window_id")


def rename_envelope(df: DataFrame, key: str) -> DataFrame:
    """Give the source envelope another name in the output."""
    return df.withColumnRenamed("source_event", key)


def gather_windows(df: DataFrame) -> DataFrame:
    """The rows with those of a window side by side, in few tasks.

    Raw events are far narrower than what ``normalize`` makes of them: gather them before,
    and write what comes out without ``compact``, to move fewer bytes.
    """
    return df.hint("rebalance", *[F.col(k) for k in WINDOW_KEYS])


def write_windows(df: DataFrame, path: str, fmt: str = "json", compact: bool = True,
                  **options) -> None:
    """Write the rows of each window to its own folder, replacing an earlier run.

    Only the windows present in ``df`` are replaced. The rows of a window are gathered
    first, so that it is few files and not one for each task that meets it; a window too
    large for one task is split. Without ``compact`` tasks write where the rows are.
    ``options`` are the writer's, such as ``compression="gzip"``.
    """
    if compact:
        df = gather_windows(df)
    (
        df.write.format(fmt)
        .partitionBy(*WINDOW_KEYS)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .save(path)
    )


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per row; absent fields are left out, empty structs stay."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    json_lines(df).write.mode(mode).text(path)
