"""Line dedup: long lines found in many documents stay in one of them.

Normalised lines are exploded and hashed; the distinct documents of each hash are
counted; lines of hashes at or above the threshold are dropped by their position, and
the rest is joined again. Only hashes and positions are shuffled for the decision; the
texts move once, to meet the positions they lose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import cut, ship

BLANK = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCUMENTS = 5

_LINES = "doc_id bigint, version bigint, pos int, key binary"
_KEPT = "text string, n_lines long, n_dropped long"


def line_keys(text: str | None, min_chars: int) -> list[tuple[int, bytes]]:
    """Position and 128-bit hash of each line that is long enough to count."""
    found = []
    for i, line in enumerate((text or "").split("\n")):
        line = line.strip(BLANK)
        if len(line) >= min_chars:
            key = line.encode().lower()  # of bytes, lower() changes A-Z alone
            found.append((i, hashlib.blake2b(key, digest_size=16).digest()))
    return found


def _explode(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("pos", pa.int32()),
                        ("key", pa.binary())])
    for batch in batches:
        ids, versions, texts = (c.to_pylist() for c in batch.columns)
        rows = [
            (d, v, i, k)
            for d, v, t in zip(ids, versions, texts, strict=True)
            for i, k in line_keys(t, min_chars)
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)


def _without(texts: pd.Series, drop: pd.Series) -> pd.DataFrame:
    rows = []
    for text, positions in zip(texts, drop, strict=True):
        lines = (text or "").split("\n")
        gone = set() if positions is None else set(positions.tolist())
        kept = [x for i, x in enumerate(lines) if i not in gone] if gone else lines
        rows.append(("\n".join(kept), len(lines), len(gone)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, plus ``n_lines`` and ``n_dropped``.

    Texts are split at newlines; a line's key has blanks stripped and A-Z lowered. Keys
    of ``min_chars`` code points or more that occur in ``min_documents`` distinct doc_ids
    or more lose all their lines except in the largest such doc_id.

    A null or empty text is one empty line, and comes out empty. A row without a doc_id
    counts as no document and keeps every line. Rows sharing a doc_id are one document
    for the count and lose the same lines. Other columns pass through; columns already
    named ``n_lines`` or ``n_dropped`` are replaced. An empty table stays empty.
    """
    ship(docs.sparkSession)
    version = F.xxhash64("text")
    lines = (
        docs.where("doc_id is not null")
        .select(F.col("doc_id").cast("long"), version.alias("version"), "text")
        .mapInArrow(lambda it: _explode(it, min_chars), _LINES)
    )
    lines = cut(lines, "lines")
    # One row per key and document first: a key that all documents share is counted
    # where it is before it moves.
    spread = lines.select("key", "doc_id").distinct().groupBy("key").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("keeper")
    )
    spread = cut(spread.where(F.col("n") >= min_documents).select("key", "keeper"), "repeated")
    # Both sides are plain tables, so Spark splits the rows of a hot key at run time.
    gone = cut(
        lines.join(spread, "key").where("doc_id != keeper").select("doc_id", "version", "pos"), "gone"
    )
    drops = gone.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("__drop"))
    drops = drops.withColumnsRenamed({"doc_id": "__id", "version": "__version"})
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    joined = docs.join(
        drops, (F.col("doc_id").cast("long") == F.col("__id")) & (version == F.col("__version")), "left"
    )
    done = joined.withColumn("__out", F.pandas_udf(_without, _KEPT)("text", "__drop"))
    columns = [
        F.col("__out.text").alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in names
    ]
    return done.select(*columns, "__out.n_lines", "__out.n_dropped")
