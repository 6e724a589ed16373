"""Connected components of a graph that only Spark holds.

Alternating large-star and small-star steps: every step is a partial minimum by node
and a join with it, so no node's neighbours meet in one place, and the tables between
steps are written, so a join on a node of very many links can be split by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``(u, v)`` with u > v, giving such edges again."""
    links = edges
    if large:
        links = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = cut(least, "least")
    if large:
        joined = links.where("v > u").join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        joined = links.join(least, "u").where("v != m")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    # Large stars keep one edge per link; the distinct set follows in the small step.
    return cut(out if large else out.distinct(), "star")


def connected(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component`` (its smallest member) of every linked node.

    ``edges`` has two bigint columns, in any order and with repeats; loops and rows
    with a null are ignored. Nodes without a link to another node do not appear.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = cut(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first()

    before = state(now)
    while before[0]:
        now = _star(_star(now, large=True), large=False)
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
