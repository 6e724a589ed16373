"""Exact top-k search by inner product over vectors sorted by length.

Candidates are put in parts by descending length. The best scores among the longest few
give each query a first bound; a part can hold a better one only if the product of the
lengths reaches it, so a query visits a prefix of the parts. Inside a part, candidates
come in tiles, longest first. Vectors are rotated onto the singular vectors of all data,
which puts most of a product in its first terms: the partial sum and, by Cauchy-Schwarz,
the lengths of what is left bound a score, and only pairs that may still count are
computed exactly, as integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetrail.llm.store import cut, ship

SCALE = 256
TILE = 4096
QUERY_BLOCK = 4096
HEAD = 0.25

RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; a shorter row counts as filled up with zeros."""
    ends = np.asarray(column.offsets)
    sizes, values = np.diff(ends), column.values.to_numpy()[ends[0]:ends[-1]]
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)] = values
    return out


def _gram(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((width, width))
    for batch in batches:
        x = _matrix(batch.column(0), width).astype(float)
        total += x.T @ x
    yield pa.record_batch([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["i", "x"])


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, the largest first.

    They come from the matrix of products between dimensions, which tasks add up; its
    size depends on the width alone.
    """
    parts = vectors.select("v").mapInArrow(lambda it: _gram(it, width), "i bigint, x double")
    sums = parts.groupBy("i").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(width * width)
    for i, x in sums:
        gram[i] = x
    _, axes = np.linalg.eigh(gram.reshape(width, width))
    return axes[:, ::-1].copy()


class _Block:
    """Vectors in both forms: as integers, and rotated with the lengths of their tails."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray, head: int):
        self.ids, self.x = ids, x
        turned = x.astype(float) @ axes
        self.head = np.ascontiguousarray(turned[:, :head])
        self.tail = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        self.norm = np.sqrt((turned**2).sum(axis=1))


class _Best:
    """The k best (score, id) of each query so far; equal scores go to smaller ids."""

    def __init__(self, n: int, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound.astype(float)
        self.scores = [np.zeros(0, np.int64)] * n
        self.ids = [np.zeros(0, np.int64)] * n

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        cuts = np.flatnonzero(np.diff(rows)) + 1
        for part in np.split(np.arange(len(rows)), cuts) if len(rows) else ():
            r = rows[part[0]]
            s = np.concatenate([self.scores[r], scores[part]])
            i = np.concatenate([self.ids[r], ids[part]])
            keep = np.lexsort((i, -s))[:self.k]
            self.scores[r], self.ids[r] = s[keep], i[keep]
            if len(keep) == self.k:
                self.bound[r] = max(self.bound[r], float(s[keep[-1]]))


def _visit(queries: _Block, best: _Best, tile: _Block) -> None:
    """Add what one tile of candidates has for all queries."""
    longest = tile.norm.max()
    slack = 1e-9 * queries.norm * longest + 1e-6  # for rounding; the exact score decides
    live = np.flatnonzero(queries.norm * longest + slack >= best.bound)
    for rows in np.array_split(live, max(1, math.ceil(len(live) / 512))):
        if not len(rows):
            continue
        most = queries.head[rows] @ tile.head.T + np.outer(queries.tail[rows], tile.tail)
        may = most + slack[rows, None] >= best.bound[rows, None]
        may &= queries.ids[rows, None] != tile.ids[None, :]
        a, b = np.nonzero(may)
        step = 1 << 16
        for at in range(0, len(a), step):
            i, j = rows[a[at:at + step]], b[at:at + step]
            best.add(i, tile.ids[j], np.einsum("ij,ij->i", queries.x[i], tile.x[j]))


def _bounds(batches: Iterator[pa.RecordBatch], first: _Block, k: int, width: int, axes, head: int):
    """Queries with the k-th best score among the longest candidates."""
    for batch in batches:
        q = _Block(batch.column(0).to_numpy(), _matrix(batch.column(1), width), axes, head)
        best = _Best(len(q.ids), k, np.full(len(q.ids), -np.inf))
        if len(q.ids):
            _visit(q, best, first)
        yield pa.record_batch(
            [*batch.columns, pa.array(best.bound), pa.array(q.norm)], names=["vec_id", "v", "bound", "norm"]
        )


def _search(batches: Iterator[pa.RecordBatch], k: int, width: int, axes, head: int):
    """Best candidates for each group of rows: its queries come first, then candidates."""
    group, asked, pending = None, [], []
    queries: _Block | None = None
    best: _Best | None = None

    def flush():
        nonlocal queries, best, asked, pending
        if asked:
            x = np.concatenate([a[1] for a in asked])
            queries = _Block(np.concatenate([a[0] for a in asked]), x, axes, head)
            best = _Best(len(x), k, np.concatenate([a[2] for a in asked]))
            asked = []
        if pending and queries is not None:
            ids, x = (np.concatenate([p[i] for p in pending]) for i in (0, 1))
            _visit(queries, best, _Block(ids, x, axes, head))
        pending = []

    def done():
        nonlocal queries, best
        flush()
        if queries is None:
            return None
        n = [len(s) for s in best.scores]
        columns = [np.repeat(queries.ids, n), np.concatenate(best.ids), np.concatenate(best.scores)]
        queries = best = None
        return pa.record_batch([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    for batch in batches:
        key = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
            if a == b:
                continue
            if group is not None and tuple(key[a, :2]) != group:
                out = done()
                if out is not None:
                    yield out
            group = tuple(key[a, :2])
            part = batch.slice(a, b - a)
            ids, x = part.column(3).to_numpy(), _matrix(part.column(4), width)
            if key[a, 2] == 0:
                asked.append((ids, x, part.column(5).to_numpy()))
                continue
            for at in range(0, len(ids), TILE):
                pending.append((ids[at:at + TILE], x[at:at + TILE]))
                if sum(len(p[0]) for p in pending) >= TILE:
                    flush()
    out = done()
    if out is not None:
        yield out


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, floor(scale * x) of each component, of rows that take part."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where("vec_id is not null and embedding is not null").where(sound)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def top_products(vectors: DataFrame, query_every: int = 50, k: int = 5, scale: int = SCALE) -> DataFrame:
    """The ``k`` candidates with the largest integer inner product for each query.

    Queries are the rows whose vec_id is divisible by ``query_every``, candidates all
    rows but those with the query's vec_id. Equal scores go to the smaller vec_id; with
    fewer than ``k`` candidates all are returned.

    Vectors that are null or hold a null, NaN or infinity take no part, nor do rows with
    a null vec_id. A shorter vector counts as filled up with zeros. Rows repeating vec_id
    and vector are one. Vectors so long that a score may reach 2^63 raise an error. Other columns are ignored. Tables
    that are empty or hold no query give no rows.
    """
    spark = ship(vectors.sparkSession)
    rows = cut(integer_vectors(vectors, scale).distinct(), "vectors")
    empty = spark.createDataFrame([], RESULT)
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if not width:
        width = 1
    asked = rows.where(F.col("vec_id") % query_every == 0)
    n_asked = asked.count()
    if not n_asked:
        return empty
    axes = rotation(rows, width)
    head = max(1, round(width * HEAD))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    sized = rows.withColumn("norm", norm)
    # Equal lengths are dealt out by id, so many copies of a vector fill several parts.
    parts = sized.repartitionByRange(F.desc("norm"), "vec_id").select(
        F.spark_partition_id().cast("long").alias("part"), "vec_id", "v", "norm"
    )
    parts = cut(parts, "parts")
    # One row for each range partition, whose number is a setting.
    longest = [(r["part"], r["norm"]) for r in
               parts.groupBy("part").agg(F.max("norm").alias("norm")).collect()]
    longest.sort()
    if longest[0][1] ** 2 >= 2.0**63:  # no score exceeds the product of the two greatest lengths
        raise ValueError("scores may reach 2^63: take a smaller scale")
    first = sized.orderBy(F.desc("norm"), "vec_id").limit(TILE).select("vec_id", "v").toArrow()
    column = first.column(1).combine_chunks()
    start = _Block(first.column(0).to_numpy(), _matrix(column, width), axes, head)
    bounded = asked.mapInArrow(
        lambda it: _bounds(it, start, k, width, axes, head), "vec_id bigint, v array<bigint>, bound double, norm double"
    )
    # A query visits the parts whose longest vector may still reach its bound.
    reach = F.array(*(F.struct(F.lit(p).alias("part"), F.lit(n).alias("norm")) for p, n in longest))
    slack = F.col("norm") * 1e-9 + 1e-6
    near = F.filter(reach, lambda r: (r["norm"] * F.col("norm") + (r["norm"] + 1) * slack) >= F.col("bound"))
    blocks = math.ceil(n_asked / QUERY_BLOCK)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long")
    visits = cut(
        bounded.select("vec_id", "v", "bound", block.alias("block"), F.explode(F.transform(near, lambda r: r["part"])).alias("part")),
        "visits",
    )
    met = cut(visits.select("part", "block").distinct(), "met")
    groups = max(1, met.count())
    placed = visits.select(
        "part", "block", F.lit(0).cast("long").alias("side"), "vec_id", "v", "bound", F.lit(0.0).alias("norm")
    ).unionAll(parts.join(met, "part").select(
        "part", "block", F.lit(1).cast("long"), "vec_id", "v", F.lit(0.0), "norm"
    ))
    # Work goes by pairs of blocks and not by bytes, so each pair is a task of its own.
    grouped = placed.repartition(groups, "part", "block").sortWithinPartitions("part", "block", "side", F.desc("norm"))
    found = grouped.drop("norm").mapInArrow(
        lambda it: _search(it, k, width, axes, head), "query_id bigint, vec_id bigint, score bigint"
    ).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
