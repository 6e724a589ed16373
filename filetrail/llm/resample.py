"""Importance resampling of a corpus towards a target, by hashed n-gram models.

Two multinomial models over hashed n-grams are counted: one of the target texts, one of
all raw texts. A document's weight is the log ratio of its probabilities under both. Its
key is the weight, tempered by length, with Gumbel noise added, and the documents with the
k largest keys are a sample without replacement in proportion to the tempered weights.

N-grams of one text depend on each other, so their sum overstates what a long text shows.
Tempered, a text counts as if it had less than ``EVIDENCE`` n-grams: the weight is multiplied by
``EVIDENCE / (n + EVIDENCE)``. One phone number no longer outweighs a page of prose, and
a line of junk is not kept for being short.

N-grams are taken of words, and of word shapes: case, digits, punctuation and whether
the word repeats one shortly before it. Shapes tell junk from prose in any language.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import cut, let_go, put, ship

BUCKETS = 1 << 14
PRIOR = {"words": 200_000, "shapes": 2_000}
TARGET_ROWS = 20_000
HELD_OUT = 4
EVIDENCE = 50
MARGIN = 0.5
LOSS = 0.001
BACK = 4
BINS = 4096
SEED = 42
CACHE = 400_000
ROWS = 2_000

_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_RUN = re.compile(r"(.)\1{2,}")


def shape(word: str) -> str:
    """Classes of a word's characters, runs shortened, with its length in four steps."""
    classes = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word
    )
    return f"{_RUN.sub(r'\1\1', classes)[:24]}/{min(3, len(word) // 5)}"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), SEED)


class _Vocabulary(dict):
    """Numbers of words, with the hashes of the words and of their shapes by number."""

    def __init__(self):
        super().__init__()
        self.hashes = array("Q")
        self.shapes = array("Q")

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self.hashes)
        self.hashes.append(_hash(word.lower()))
        self.shapes.append(_hash(shape(word)))
        return n


class Grams:
    """Buckets of the n-grams of texts: first those of words, then those of shapes."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.down = np.uint64(64 - (buckets.bit_length() - 1))
        self.words = _Vocabulary()

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of bucket and text number, one array pair for each kind of n-gram."""
        if len(self.words) > CACHE:
            self.words = _Vocabulary()
        get = self.words.__getitem__
        numbers = [list(map(get, t.split())) for t in texts]
        sizes = np.array(list(map(len, numbers)))
        rows = np.fromiter(chain.from_iterable(numbers), np.int64, sizes.sum())
        doc = np.repeat(np.arange(len(texts)), sizes)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        word, form = (np.array(x)[rows] for x in (self.words.hashes, self.words.shapes))
        back = np.zeros(len(rows), dtype=np.uint64)
        for k in range(BACK, 0, -1):
            same = np.zeros(len(rows), dtype=bool)
            same[k:] = (word[k:] == word[:-k]) & (at[k:] >= k)
            back[same] = k
        form = form + back * _MIX[2]
        yield self._bucket(word, 0), doc
        yield self._bucket(word[:-1] * _MIX[1] + word[1:], 0)[at[1:] > 0], doc[1:][at[1:] > 0]
        yield self._bucket(form, 1), doc
        two = form[:-1] * _MIX[1] + form[1:]
        yield self._bucket(two + _MIX[2], 1)[at[1:] > 0], doc[1:][at[1:] > 0]
        three = two[:-1] * _MIX[1] + form[2:]
        yield self._bucket(three, 1)[at[2:] > 1], doc[2:][at[2:] > 1]

    def _bucket(self, value: np.ndarray, kind: int) -> np.ndarray:
        return ((value * _MIX[0]) >> self.down).astype(np.int64) + kind * self.buckets


def log_ratios(raw: np.ndarray, target: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of both models by bucket.

    The target counts are smoothed towards the raw model, so a bucket about which a small
    target says little has a ratio near one.
    """
    out = []
    for i, prior in enumerate(PRIOR.values()):
        r, t = (x[i * buckets:(i + 1) * buckets] for x in (raw, target))
        p = (r + 0.5) / (r.sum() + 0.5 * buckets)
        q = (t + prior * p) / (t.sum() + prior)
        out.append(np.log(q / p))
    return np.concatenate(out)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of a task's n-grams, in raw and target texts; one row for each bucket seen."""
    let_go()
    grams, n = Grams(buckets), 2 * buckets
    raw, target = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for batch in _slices(batches):
        chosen = np.array(batch.column(1).to_pylist(), dtype=bool)
        for bucket, doc in grams([t or "" for t in batch.column(0).to_pylist()]):
            raw += np.bincount(bucket, minlength=n)
            target += np.bincount(bucket[chosen[doc]], minlength=n)
    seen = np.flatnonzero(raw)
    yield pa.record_batch([seen, raw[seen], target[seen]], names=["bucket", "raw", "target"])


def _score(batches: Iterator[pa.RecordBatch], ratios, buckets: int, names: list[str]):
    let_go()
    grams, ratios = Grams(buckets), ratios.value
    for batch in _slices(batches):
        weight, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for bucket, doc in grams([t or "" for t in batch.column("__text").to_pylist()]):
            weight += np.bincount(doc, weights=ratios[bucket], minlength=batch.num_rows)
            n += np.bincount(doc, minlength=batch.num_rows)
        new = [pa.array(weight), pa.array(weight * EVIDENCE / (n + EVIDENCE))]
        columns = [batch.column(c) for c in names]
        yield pa.record_batch([*columns, *new], names=[*names, "log_weight", "__tempered"])


def target_ids(labels: DataFrame, limit: int = TARGET_ROWS) -> DataFrame:
    """Ids of documents labelled good by all their labels: at most ``limit``, by hash."""
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    picked = good.where("quality = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    return picked.limit(limit)


def fit(docs: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratios by bucket, from the n-grams of all documents and of the target ones.

    ``targets`` is a bounded table of doc_ids. Counts are added up in each task before
    they are shuffled; the driver gets one row for each of ``2 * buckets`` buckets.
    """
    ship(docs.sparkSession)
    picked = targets.select(F.col("doc_id").alias("_target")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(
        F.broadcast(picked), F.col("_id") == F.col("_target"), "left"
    )
    counts = rows.select("text", F.col("_target").isNotNull().alias("chosen")).mapInArrow(
        lambda it: _count(it, buckets), "bucket bigint, raw bigint, target bigint"
    )
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = np.array(counts.collect(), dtype=np.int64).reshape(-1, 3)
    raw, target = np.zeros(2 * buckets), np.zeros(2 * buckets)
    raw[found[:, 0]], target[found[:, 0]] = found[:, 1], found[:, 2]
    return log_ratios(raw, target, buckets)


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls, exactly; None if k is zero.

    Each pass counts the values in bins of the range still open and goes on inside the
    bin that holds the k-th, so the driver sees at most ``BINS`` rows a pass.
    """
    lo, hi, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return None
    if k >= n:
        return lo
    value = F.col(column)
    while lo < hi:
        place = F.floor((value - lo) / (hi - lo) * BINS).cast("int")
        bins = df.where(value.between(lo, hi)).groupBy(F.least(place, F.lit(BINS - 1)).alias("bin")).agg(
            F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
        )
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if k <= row["n"]:
                lo, hi = row["lo"], row["hi"]
                if k == row["n"]:
                    return lo
                break
            k -= row["n"]
    return lo


def held_out() -> Column:
    """Whether a target document, by its id, calibrates the floor and is not counted."""
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0


def calibrated_floor(scored: DataFrame, apart: DataFrame, loss: float = LOSS,
                     margin: float = MARGIN) -> float:
    """The tempered weight above which a document may be target text.

    It is ``margin`` a counted n-gram below even odds, or lower where more than the share
    ``loss`` of the held-out target documents would fall under that. ``apart`` is a bounded
    table of doc_ids that the target model has not seen; the driver gets a number for each.
    """
    ids = apart.select(F.col("doc_id").alias("_held")).distinct()
    found = scored.select(F.col("doc_id").cast("long").alias("_id"), "__tempered").join(
        F.broadcast(ids), F.col("_id") == F.col("_held")
    )
    least = [r[1] for r in found.groupBy("_id").agg(F.min("__tempered")).collect()]
    even = -margin * EVIDENCE
    if not least:
        return even
    return min(even, float(np.nextafter(np.quantile(least, loss, method="lower"), -np.inf)))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, floor: float | None = None,
             buckets: int = BUCKETS, seed: int = SEED, keep_text: bool = True) -> DataFrame:
    """The ``k`` rows of ``docs`` with the largest ``gumbel_key``, with ``log_weight``.

    ``log_weight`` is the log ratio of a text's probability under the target and the raw
    model, summed over its n-grams; the key is the tempered weight plus Gumbel noise drawn
    from a hash of doc_id, text and ``seed``. Without ``k``, as many rows are drawn as have a
    tempered weight above ``floor``, that is, all the corpus has that may be target text;
    without ``floor`` it is that of ``calibrated_floor``.

    The target is the documents with quality 1, at most ``TARGET_ROWS`` of them chosen
    by hash; where a floor has to be calibrated one in ``HELD_OUT`` is not counted and serves
    that. Raw counts cover every document. A null or empty text has weight 0. Rows with equal
    keys, which repeated rows have, stay or go together, so ties may add to ``k``. With no
    target documents to count all weights are 0. Other columns pass through, the text only with
    ``keep_text``; columns named like the new ones are replaced.
    """
    spark = ship(docs.sparkSession)
    targets = cut(target_ids(labels), "targets")
    calibrate = k is None and floor is None
    held = held_out() if calibrate else F.lit(False)
    ratios = spark.sparkContext.broadcast(fit(docs, targets.where(~held), buckets))
    new = {"log_weight", "gumbel_key", *(() if keep_text else ("text",))}
    names = [c for c in docs.columns if c.lower() not in new]
    noise = (F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    given = docs.select(
        *(F.col(f"`{c}`") for c in names), F.col("text").alias("__text"), (-F.log(-F.log(noise))).alias("__noise")
    )
    schema = put(given.drop("__text"), "log_weight double, __tempered double")
    scored = given.mapInArrow(lambda it: _score(it, ratios, buckets, [*names, "__noise"]), schema)
    scored = scored.withColumn("gumbel_key", F.col("__tempered") + F.col("__noise")).drop("__noise")
    scored = cut(scored, "scored")
    if calibrate:
        floor = calibrated_floor(scored, targets.where(held))
    if k is None:
        k = scored.where(F.col("__tempered") > floor).count()
    least = kth_largest(scored, "gumbel_key", k)
    drawn = scored.where(F.lit(False) if least is None else F.col("gumbel_key") >= least)
    return drawn.drop("__tempered")
