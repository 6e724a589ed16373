"""Token ids in ORC files: encode documents, write them in doc_id order, read them back.

Spark's ORC writer gives the format: stripes of run-length encoded integers with row
indexes, and Bloom filters on the document ids. Readers take stripes in parallel and
skip those whose statistics or filters exclude a document.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from filetrail.llm.store import cut, hold, ship

END = 0
CACHE = 800_000
ROWS = 500
STRIPE_BYTES = 16 << 20
STRIDE = 1_000
#: Packed ids hardly shrink further at higher levels.
ZSTD_LEVEL = 1

FILES = "doc_id bigint, part int, offset bigint, ids array<int>"

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: ASCII marks but the apostrophe, and digits.
_MARKS = r"!-&(-@\[-`{-~"
_WORD = re.compile(f" ?[{_LETTERS}]+")
#: What a text is cut into, so that no token spans a cut: letters and the space before
#: them; marks and the space before them; marks and a single line end before a letter;
#: anything else up to a space after a character that isn't white space.
_UNITS = re.compile(
    rf" ?[{_LETTERS}]++(?![^ \n{_MARKS}])| ?[{_MARKS}]++(?![^ {_LETTERS}])"
    rf"|[{_MARKS}]*+\n(?=[{_LETTERS}])|.*?\S(?= |\Z)|.+",
    re.DOTALL,
)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for characters from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(other)) for b in range(256)]


class _Words(dict):
    """Ids of words, found by ``find`` when they are first asked for.

    Half of the entries are a younger generation; when it is full the older one goes, so
    frequent words stay.
    """

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.find(word)
            if len(word) > 64:
                return ids
        if len(self) >= CACHE // 2:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """A byte-level tokenizer, with the ids of words kept in a cache of bounded size.

    Ids are bytes here: 32 bits each in the machine's order.
    """

    def __init__(self, tokenizer_file: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        model = self.tokenizer.model
        model._resize_cache(0)  # words are kept here
        self.tokenize = model.tokenize
        self.letters = dict(enumerate(_byte_letters()))
        self.space = self.letters[0x20]
        self.units = _Words(self.unit)
        #: These go before any other cut, wherever they stand.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _whole(self, text: str) -> bytes:
        return array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def unit(self, unit: str) -> bytes:
        """Ids of a unit; of letters it is a word that the model can take."""
        if not _WORD.fullmatch(unit):
            return self._whole(unit)
        if not unit.isascii():
            unit = unit.encode().decode("latin-1").translate(self.letters)
        elif unit[0] == " ":
            unit = self.space + unit[1:]
        return array("i", [t.id for t in self.tokenize(unit)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as the tokenizer gives them.

        A text is cut into units, and its ids are those of its units in a row. Only units
        that aren't in the cache go through the tokenizer.
        """
        if not text:
            return b""
        if any(a in text for a in self.added):
            return self._whole(text)
        return b"".join(map(self.units.__getitem__, _UNITS.findall(text)))


def load(tokenizer_file: str) -> Encoder:
    """The tokenizer, kept by the worker process until another operator's tasks begin."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark uses the cores already
    return hold(("tokens", tokenizer_file), lambda: Encoder(tokenizer_file))


def _encode(batches: Iterator[pa.RecordBatch], tokenizer_file: str, end: int) -> Iterator[pa.RecordBatch]:
    encoder, part, offset = load(tokenizer_file), TaskContext.get().partitionId(), 0
    last = array("i", [end]).tobytes()
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            ids = [encoder.encode(t) + last for t in batch.column(1).to_pylist()]
            sizes = np.array(list(map(len, ids)), dtype=np.int64) // 4
            starts = offset + np.cumsum(sizes) - sizes
            offset += int(sizes.sum())
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), dtype=np.int32))
            yield pa.record_batch(
                [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), lists],
                names=["doc_id", "part", "offset", "ids"],
            )


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, end: int = END) -> None:
    """Encode every text, append ``end``, and write the ids in ascending doc_id order.

    Each file is one run of the order: ``part`` is its number and ``offset`` counts the
    ids before a document in it. Null doc_ids come first; rows sharing a doc_id follow
    each other, ordered by a hash of the text. A null or empty text has the end id alone.
    Only doc_id and text are read, so other columns don't matter. ``tokenizer_file`` must
    exist on every executor.
    """
    ship(docs.sparkSession)
    order = ["doc_id", "_hash"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash")
    (
        ordered.mapInArrow(lambda it: _encode(it, tokenizer_file, end), FILES)
        .write.option("compression", "zstd")
        .option("orc.compression.zstd.level", ZSTD_LEVEL)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", STRIDE)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Token files; filters on ``doc_id`` skip stripes and row groups by their metadata."""
    return spark.read.schema(FILES).orc(folder)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        ends = np.asarray(ids.offsets)
        octets = memoryview(np.ascontiguousarray(ids.values.to_numpy(), dtype="<u4")).cast("B")
        sums = [zlib.crc32(octets[4 * a:4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
        columns = [*batch.columns[:3], pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())]
        yield pa.record_batch(columns, names=["doc_id", "part", "offset", "n_tokens", "ids_crc32"])


def token_index(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    The files are read once; the starts add a running sum over one row for each file.
    """
    ship(tokens.sparkSession)
    docs = cut(tokens.mapInArrow(
        _sums, "doc_id bigint, part int, offset bigint, n_tokens bigint, ids_crc32 bigint"
    ), "token-sums")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = docs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
