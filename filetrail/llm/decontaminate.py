"""Benchmark decontamination with Wu-Manber multi-pattern search.

Windows of benchmark words are written as files in the shared folder, and files next to
each other make a pattern block of bounded size. Tasks scan normalised texts for the
patterns of one block after another: a shift table over byte blocks says how far a position
may be moved, the bucket of a pattern's last block and first bytes lists the strings to
test, and a direct comparison confirms each occurrence. Many stretches of text advance at
once, each by its own shift, as numpy arrays; the tables are arrays too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import file_system, hold, keep_columns, new_folder, put, ship

WORDS = 10
BLOCK_BYTES = 32 << 20
STRETCH = 2048
#: Bytes of text that a task searches at once.
PORTION_BYTES = 4 << 20
#: Bytes of text that a task gathers for each turn through several blocks.
GROUP_BYTES = 32 << 20

#: Letters A-Z become a-z; other ASCII but digits and letters separates words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)

_HITS = "array<struct<item_id: string, first_word: int, words: int>>"
_HIT = pa.struct([("item_id", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())])


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8."""
    return (text or "").encode().translate(_TABLE).split()


def windows_of(text: str | None, size: int) -> set[bytes]:
    """Consecutive words with blanks around each; all words if they are fewer."""
    w = words_of(text)
    if not w:
        return set()
    return {b" " + b" ".join(w[i:i + size]) + b" " for i in range(max(1, len(w) - size + 1))}


class _Table:
    """Shift and bucket tables for patterns of similar length."""

    def __init__(self, blocks: np.ndarray, starts: np.ndarray, m: int, numbers: np.ndarray):
        self.m = m
        self.b = b = min(8, max(2, m // 2))
        steps = m - b + 1
        self.bits = min(24, max(10, math.ceil(math.log2(8 * len(starts) * steps))))
        self.mask = np.uint64((1 << 8 * b) - 1)
        self.first = np.uint64((1 << 8 * min(8, m)) - 1)
        self.shift = np.full(1 << self.bits, steps, dtype=np.min_scalar_type(steps))
        for j in range(steps):  # the shift shrinks, so the least of a hash is the last one set
            self.shift[self.hash(blocks[starts + j])] = steps - 1 - j
        keys = self.key(blocks[starts], blocks[starts + steps - 1])
        order = np.argsort(keys, kind="stable")
        self.keys, self.numbers = keys[order], numbers[order]

    def hash(self, block: np.ndarray) -> np.ndarray:
        return (((block & self.mask) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def key(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Names a bucket: the first bytes and the last block of a pattern's head."""
        return ((first & self.first) * _MIX) ^ (last & self.mask)

    def search(self, blocks: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        """Start in the text and number of each pattern that may occur there."""
        back = self.m - self.b
        limit = size - self.b + 1
        at = np.arange(0, max(limit, 0), STRETCH)
        end = np.minimum(at + STRETCH, limit)
        at = np.maximum(at, back)
        live = at < end
        at, end = at[live], end[live]
        while at.size:
            shift = self.shift[self.hash(blocks[at])]
            last = at[shift == 0]
            keys = self.key(blocks[last - back], blocks[last])
            low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
            some = low < high
            for e, lo, hi in zip(last[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
                for i in self.numbers[lo:hi].tolist():
                    yield e - back, i
            at = at + np.maximum(shift, 1)
            live = at < end
            at, end = at[live], end[live]


def _blocks(octets: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on; the last seven positions have none."""
    return np.ndarray((len(octets) - 7,), dtype="<u8", buffer=octets, strides=(1,))


class Matcher:
    """Finds all occurrences of windows, each of a benchmark item; an item's windows are distinct."""

    def __init__(self, windows: pa.ChunkedArray, items: pa.ChunkedArray):
        rows = pa.concat_arrays(windows.cast(pa.large_binary()).chunks or [pa.array([], pa.large_binary())])
        offsets = np.frombuffer(rows.buffers()[1] or bytes(8), dtype=np.int64)[rows.offset:rows.offset + len(rows) + 1]
        self.begins, self.ends, self.items = offsets[:-1], offsets[1:], items
        self.data = b"".join([rows.buffers()[2] or b"", bytes(8)])
        blocks = _blocks(np.frombuffer(self.data, dtype=np.uint8))
        sizes = self.ends - self.begins
        classes = np.frexp(sizes)[1]  # as int.bit_length
        self.tables = []
        for c in np.unique(classes).tolist():
            numbers = np.flatnonzero(classes == c)
            self.tables.append(_Table(blocks, self.begins[numbers], int(sizes[numbers].min()), numbers))

    def window(self, i: int) -> bytes:
        return self.data[self.begins[i]:self.ends[i]]

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """Start in the text and window number of each occurrence."""
        blocks = _blocks(np.frombuffer(text + bytes(8), dtype=np.uint8))
        known = {}
        for table in self.tables:
            for at, i in table.search(blocks, len(text)):
                window = known.get(i) or known.setdefault(i, self.window(i))
                if text.startswith(window, at):
                    yield at, i


def _matcher(store, *paths: str) -> Matcher:
    """The tables of a block's files; the last block used stays in memory."""
    def make() -> Matcher:
        tables = []
        for path in paths:
            with store.open_input_file(path) as f:
                tables.append(pq.read_table(f, columns=["window", "item_id"]))
        rows = pa.concat_tables(tables)
        return Matcher(rows["window"], rows["item_id"])

    return hold(("patterns", *paths), make)


class _Portion:
    """Some texts, normalised and joined, and the occurrences found in them so far."""

    def __init__(self, texts: list[str | None]):
        parts, n_words = [], []
        for text in texts:
            w = words_of(text)
            parts.append(b" " + b" ".join(w) + b" " if w else b" ")
            n_words.append(len(w))
        # A newline ends each text; no window holds one, so none crosses texts.
        self.joined = b"\n".join(parts)
        self.n_words = n_words
        self.starts = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        self.base = np.cumsum([0] + [n + 1 for n in n_words])
        self.cover = np.zeros(self.base[-1] + 1, dtype=np.int32)
        self.hits = [[] for _ in parts]

    def find(self, matcher: Matcher) -> None:
        found = list(matcher.search(self.joined)) if self.joined else []
        if not found:
            return
        blanks = np.flatnonzero(np.frombuffer(self.joined, dtype=np.uint8) == 32)
        at = np.array([f[0] for f in found], dtype=np.int64)
        docs = np.searchsorted(self.starts, at, "right") - 1
        blank = np.searchsorted(blanks, at)
        known = {}
        for (_, i), d, k in zip(found, docs.tolist(), blank.tolist(), strict=True):
            if i not in known:
                known[i] = matcher.items[i].as_py(), matcher.window(i).count(b" ") - 1
            item, n = known[i]
            self.cover[k] += 1
            self.cover[k + n] -= 1
            self.hits[d].append((item, k - int(self.base[d]), n))

    def n_hit(self) -> np.ndarray:
        """Covered words of each text."""
        covered = np.concatenate([[0], np.cumsum(np.cumsum(self.cover) > 0)])
        return covered[self.base[1:]] - covered[self.base[:-1]]


def _portions(texts: pa.Array) -> Iterator[_Portion]:
    """The texts in portions of about ``PORTION_BYTES``, whatever the size of the batch."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // PORTION_BYTES)) + 1
    for begin, end in pairwise([0, *cuts.tolist(), len(texts)]):
        yield _Portion(texts.slice(begin, end - begin).to_pylist())


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in a row, as many as it takes to hold ``size`` bytes of text."""
    group, got = [], 0
    for batch in batches:
        group.append(batch)
        got += batch.column("__text").nbytes
        if got >= size:
            yield group
            group, got = [], 0
    if group:
        yield group


def _scan(batches: Iterator[pa.RecordBatch], folder: str, blocks: list[str | list[str]], kept: list[str]):
    """The hits of each row; a block is a file of patterns or some of them."""
    store, root = file_system(folder)
    blocks = [[f"{root}/{p}" for p in ([b] if isinstance(b, str) else b)] for b in blocks]
    # Several blocks are built anew for every group of batches, a single one stays.
    for group in _groups(batches, GROUP_BYTES if len(blocks) > 1 else 0):
        searched = [list(_portions(batch.column("__text"))) for batch in group]
        for paths in blocks:
            matcher = _matcher(store, *paths)
            for portions in searched:
                for portion in portions:
                    portion.find(matcher)
        blocks.reverse()  # the block in memory is the next group's first
        for batch, portions in zip(group, searched, strict=True):
            yield _found(batch, portions, kept)


def _found(batch: pa.RecordBatch, portions: list[_Portion], kept: list[str]) -> pa.RecordBatch:
    n_words = [n for p in portions for n in p.n_words]
    n_hit = np.concatenate([p.n_hit() for p in portions])
    hits = [sorted(h, key=lambda x: (x[1], x[0], x[2])) for p in portions for h in p.hits]
    columns = [batch.column(c) for c in kept] + [
        pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array([[dict(zip(("item_id", "first_word", "words"), x, strict=True)) for x in h]
                  for h in hits], pa.list_(_HIT)),
    ]
    return pa.record_batch(columns, names=[*kept, "n_words", "n_hit", "hits"])


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [
            (w, i)
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for w in sorted(windows_of(t, size))
        ]
        yield pa.record_batch(
            [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.string())],
            names=["window", "item_id"],
        )


def write_patterns(benchmark: DataFrame, words: int = WORDS,
                   block_bytes: int = BLOCK_BYTES) -> tuple[str, list[list[str]]]:
    """Write the windows of all items; the folder and the names of each block's files.

    However many files Spark writes, a block has as many as hold ``block_bytes``.
    """
    spark = ship(benchmark.sparkSession)
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    found = benchmark.select(item.alias("item_id"), "text").mapInArrow(
        lambda it: _windows(it, words), "window binary, item_id string"
    ).distinct()
    folder = new_folder(spark, "patterns")
    found.write.parquet(f"{folder}/all")
    found = spark.read.schema(found.schema).parquet(f"{folder}/all")
    octets = F.sum(F.length("window") + F.length("item_id"))
    size = found.agg(octets).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    # Windows of a length stay together: the shortest of a block bounds its shifts.
    found.repartitionByRange(n, F.length("window"), "window", "item_id").write.parquet(f"{folder}/blocks")
    written = spark.read.schema(found.schema).parquet(f"{folder}/blocks")
    sizes = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(octets.alias("octets")).collect()
    return f"{folder}/blocks", _packed(sorted(map(tuple, sizes)), block_bytes)


def _packed(sizes: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Files in a row, together up to ``most`` bytes; a larger one is alone."""
    blocks, got = [], 0
    for name, size in sizes:
        if not blocks or got + size > most:
            blocks.append([])
            got = 0
        blocks[-1].append(name)
        got += size
    return blocks


def find_benchmark(docs: DataFrame, benchmark: DataFrame, words: int = WORDS,
                   block_bytes: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any occurrence) and ``hits``.

    ``hits`` lists every occurrence of a window: its item, first word and word count, in
    order. A window is ``words`` consecutive item words; an item with fewer, but not
    none, is one window. Null, empty and wordless texts have no words and no hits; items
    without words never occur; a null item_id is named ``null``; repeated items are one.
    Other columns pass through, the text only with ``keep_text``; columns named like the
    new ones are replaced. Every row of ``docs`` comes out once.
    """
    ship(docs.sparkSession)
    folder, blocks = write_patterns(benchmark, words, block_bytes)
    new = {"n_words", "n_hit", "hits", *(() if keep_text else ("text",))}
    kept = [c for c in docs.columns if c.lower() not in new]
    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.col("text").alias("__text"))
    fields = put(given.drop("__text"), "n_words bigint, n_hit bigint")
    return given.mapInArrow(lambda it: _scan(it, folder, blocks, kept), f"{fields}, hits {_HITS}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    return keep_columns(
        docs, {"n_words", "n_hit", "hits"},
        lambda df: find_benchmark(df, benchmark, words, block_bytes).where("n_hit = 0"),
    )
