"""Spelling variants: words one edit apart, found by probing generated edits in Bloom filters.

The vocabulary is put into blocked Bloom filters, one for each word length, which are
broadcast. Every word generates its edits as hashes and probes them; only the positives
shuffle, to an exact join with the vocabulary that removes the false ones. Since nearness
is mutual, a word generates its deletions and the replacements by smaller letters alone:
each pair is then found once, from the longer or the larger word.

All letters are code points up to U+00FF, so words are held in Latin-1, a byte a letter.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import cut, ship

MIN_LETTERS = 5
MIN_OCCURRENCES = 3
#: One (document, word) in so many loses a letter.
TYPO_EVERY = 97
#: Words a task counts before it sends them, and edits it holds at a time.
HELD = 200_000
EDITS = 1 << 20
#: Bits of a filter for each word, and the least bytes of one.
WORD_BITS = 24
LEAST_BYTES = 8 << 10
#: Bytes of filters that are broadcast at a time; a larger vocabulary is probed in several rounds.
FILTER_BYTES = 64 << 20

#: The letters of words: a-z and U+00C0 to U+00FF, ascending.
LETTERS = bytes([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
_FACTOR = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_MASK = (1 << 64) - 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _letter_bytes() -> bytes:
    """A-Z lowered, letters as they are, all else blank."""
    table = bytearray(b" " * 256)
    for b in LETTERS:
        table[b] = b
    for i in range(26):
        table[ord("A") + i] = ord("a") + i
    return bytes(table)


_TABLE = _letter_bytes()


def document_words(doc_id: int | None, text: str | None, every: int = TYPO_EVERY,
                   least: int = MIN_LETTERS) -> Counter[bytes]:
    """Occurrences of each word of a text, with the letters taken that its hash says.

    A character beyond Latin-1 separates words like any other that is no letter.
    """
    runs = Counter(r for r in (text or "").encode("latin-1", "replace").translate(_TABLE).split() if len(r) >= least)
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    words = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        words[run] += n
    return words


def _count(batches: Iterator[pa.RecordBatch], every: int, least: int, held: int) -> Iterator[pa.RecordBatch]:
    def sent(words):
        terms = pa.array([w.decode("latin-1") for w in words], pa.string())
        return pa.record_batch([terms, pa.array(list(words.values()), pa.int64())], names=["word", "n"])

    words = defaultdict(int)
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for word, n in document_words(doc_id, text, every, least).items():
                words[word] += n
            if len(words) >= held:
                yield sent(words)
                words.clear()
    yield sent(words)


def vocabulary(docs: DataFrame, every: int = TYPO_EVERY, least: int = MIN_LETTERS,
               occurrences: int = MIN_OCCURRENCES, held: int = HELD) -> DataFrame:
    """``word, n`` of the words of ``least`` letters or more that occur ``occurrences`` times."""
    ship(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(
        lambda it: _count(it, every, least, held), "word string, n long"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _matrix(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def _powers(length: int) -> np.ndarray:
    powers = np.full(length, _FACTOR, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Sums of letter times power of place, modulo 2^64, of words of one length."""
    return (letters.astype(np.uint64) * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bits of a hash spread evenly."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _bits(mixed: np.ndarray) -> np.ndarray:
    """Four bits of a block of 64, by the low bits of the hash."""
    mask, one = np.zeros(mixed.shape, np.uint64), np.uint64(1)
    for shift in (0, 6, 12, 18):
        mask |= one << ((mixed >> np.uint64(shift)) & np.uint64(63))
    return mask


def _blocks(mixed: np.ndarray, n: int) -> np.ndarray:
    return (((mixed >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def filter_bytes(n_words: int) -> int:
    """Size of the filter of so many words of one length."""
    return max(LEAST_BYTES, -(-n_words * WORD_BITS // 64) * 8)


def bloom(hashes: np.ndarray, size: int, into: np.ndarray | None = None) -> np.ndarray:
    """A filter of ``size`` bytes with these hashes in it; or ``into`` with them added."""
    blocks = np.zeros(size // 8, np.uint64) if into is None else into
    mixed = _mixed(hashes)
    np.bitwise_or.at(blocks, _blocks(mixed, len(blocks)), _bits(mixed))
    return blocks


def probe(blocks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter; never false for one that is."""
    mixed = _mixed(hashes)
    mask = _bits(mixed)
    return (blocks[_blocks(mixed, len(blocks))] & mask) == mask


def _deletions(letters: np.ndarray, hashes: np.ndarray, first: int, last: int):
    """Hashes of words without the letter at each place from ``first`` to ``last``, and which count.

    Of equal letters in a row only the first is deleted.
    """
    powers = _powers(letters.shape[1])
    terms = letters.astype(np.uint64) * powers
    upto = np.cumsum(terms, axis=1, dtype=np.uint64)[:, first:last]
    shifted = (hashes[:, None] - upto) * np.uint64(_INVERSE)
    again = np.zeros((len(letters), last - first), bool)
    start = max(first, 1)
    again[:, start - first:] = letters[:, start:last] == letters[:, start - 1:last - 1]
    return upto - terms[:, first:last] + shifted, ~again


def _edits(letters: np.ndarray, hashes: np.ndarray, first: int, last: int):
    """(length difference, places, letters or None, hashes, which count) of the edits at these places."""
    found, counts = _deletions(letters, hashes, first, last)
    yield -1, None, found, counts
    powers, here = _powers(letters.shape[1])[first:last], letters[:, first:last]
    rest = hashes[:, None] - here.astype(np.uint64) * powers
    for letter in LETTERS:
        smaller = here > letter
        if smaller.any():
            yield 0, letter, rest + np.uint64(letter) * powers, smaller


def _edited(word: bytes, place: int, letter: int | None) -> str:
    middle = b"" if letter is None else bytes([letter])
    return (word[:place] + middle + word[place + 1:]).decode("latin-1")


def _positives(batches: Iterator[pa.RecordBatch], filters, least: int, edits: int) -> Iterator[pa.RecordBatch]:
    """``word, n, edit`` of each edit that the filters may hold."""
    blocks = filters.value
    for batch in batches:
        by_length = defaultdict(list)
        for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            by_length[len(word)].append((word.encode("latin-1"), word, n))
        for length, rows in by_length.items():
            step = max(1, edits // (length * len(LETTERS)))
            width = max(1, edits // len(LETTERS)) if step == 1 else length
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                letters = _matrix([w for w, _, _ in part], length)
                hashes = word_hashes(letters)
                for first in range(0, length, width):
                    out = []
                    for shorter, letter, found, counts in _edits(letters, hashes, first, min(length, first + width)):
                        target = blocks.get(length + shorter)
                        if target is None or length + shorter < least:
                            continue
                        r, c = np.nonzero(counts)
                        hit = probe(target, found[r, c])
                        out += [
                            (part[i][1], part[i][2], _edited(part[i][0], first + j, letter))
                            for i, j in zip(r[hit].tolist(), c[hit].tolist(), strict=True)
                        ]
                    if out:
                        words, ns, edit = zip(*out, strict=True)
                        yield pa.record_batch(
                            [pa.array(words, pa.string()), pa.array(ns, pa.int64()), pa.array(edit, pa.string())],
                            names=["word", "n", "edit"],
                        )


def _fill(batches: Iterator[pa.RecordBatch], sizes) -> Iterator[pa.RecordBatch]:
    """Filters of a task's words: the blocks that are not zero, by length and place."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        by_length = defaultdict(list)
        for word in batch.column(0).to_pylist():
            by_length[len(word)].append(word.encode("latin-1"))
        for length, words in by_length.items():
            held[length] = bloom(word_hashes(_matrix(words, length)), sizes[length], held.get(length))
    for length, blocks in held.items():
        at = np.flatnonzero(blocks)
        for i in range(0, len(at), 100_000):
            part = at[i:i + 100_000]
            yield pa.record_batch(
                [pa.array(np.full(len(part), length, np.int32)), pa.array(part.astype(np.int64)),
                 pa.array(blocks[part].view(np.int64))],
                names=["length", "at", "bits"],
            )


def _filters(words: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """One filter for each length, or-ed together by Spark; at most the bytes of ``sizes`` come back."""
    made = words.select("word").mapInArrow(lambda it: _fill(it, sizes), "length int, at long, bits long")
    merged = made.groupBy("length", "at").agg(F.bit_or("bits").alias("bits"))
    out = {length: np.zeros(size // 8, np.uint64) for length, size in sizes.items()}
    for length, rows in merged.toPandas().groupby("length"):
        out[length][rows["at"].to_numpy()] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def near_words(words: DataFrame, least: int = MIN_LETTERS, filter_size: int = FILTER_BYTES,
               edits: int = EDITS) -> DataFrame:
    """``word, n, other, other_n``: each pair of words one edit apart, once.

    ``words`` has distinct words and their ``n``. The filters of a round take at most about
    ``filter_size`` bytes; with more words, hash slices of the vocabulary take turns.
    """
    spark = words.sparkSession
    counts = dict(words.groupBy(F.length("word").cast("int")).count().collect())
    rounds = max(1, -(-sum(-(-n * WORD_BITS // 8) for n in counts.values()) // filter_size))
    found = None
    for r in range(rounds):
        part = words.where(F.pmod(F.xxhash64("word"), F.lit(rounds)) == r)
        sizes = counts if rounds == 1 else dict(part.groupBy(F.length("word").cast("int")).count().collect())
        filters = spark.sparkContext.broadcast(_filters(part, {k: filter_bytes(n) for k, n in sizes.items()}))
        positives = words.mapInArrow(
            lambda it, f=filters: _positives(it, f, least, edits), "word string, n long, edit string"
        )
        exact = positives.join(part.select(F.col("word").alias("other"), F.col("n").alias("other_n")),
                               F.col("edit") == F.col("other")).drop("edit")
        exact = cut(exact, "near-words")
        found = exact if found is None else found.unionAll(exact)
        filters.unpersist()
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following forms from a word ends. Steps double in every round."""
    now = cut(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = now.where("root != word").select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = now.join(ahead, F.col("root") == F.col("at"), "left")
        after = cut(moved.select("word", F.coalesce("next", "root").alias("root"),
                                 F.col("next").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def group_spellings(docs: DataFrame, every: int = TYPO_EVERY, least: int = MIN_LETTERS,
                    occurrences: int = MIN_OCCURRENCES, ratio: int = 2,
                    filter_size: int = FILTER_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts of ``docs``.

    Words are runs of a-z and U+00C0 to U+00FF with A-Z lowered. One (doc_id, word) in
    ``every``, by hash, loses a letter first, which is the noise the operator is to group.
    Kept are words of ``least`` letters that occur ``occurrences`` times in all. Near words
    differ by one letter inserted, deleted or replaced. A word's form is its near word of
    largest ``n`` (ties: the smallest word) if that is ``ratio`` times its own or more; its
    root is where its form, that one's form and so on end.

    Null and empty texts have no words; a null doc_id is hashed as empty text. Rows with the
    same doc_id or text count each. An empty table gives no words. Columns other than doc_id
    and text don't matter.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could go round in a circle")
    words = cut(vocabulary(docs, every, least, occurrences), "vocabulary")
    pairs = near_words(words, least, filter_size)
    links = pairs.select("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")).unionAll(
        pairs.select(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    nearest = links.groupBy("word").agg(F.count("*").alias("n_near"), best)
    taken = F.expr(f"-best.less >= {ratio} * n")
    formed = cut(words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
    ), "formed")
    return formed.join(_roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
