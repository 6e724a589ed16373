"""SimHash near-dedup by tiled exact comparison.

Fingerprints are put in tiles by the population counts of their four 16-bit words. Two
fingerprints that differ in at most ``radius`` bits have counts that differ by at most
``radius`` in sum, so a fingerprint meets its own tile and the tiles within that
distance, and all other tile pairs are skipped. Inside a pair, numpy compares
everything with exclusive-or and bit counts. Tiles beyond a size are cut into chunks,
and pairs of chunks stay pairs, so no task holds more than two chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.components import connected
from filetrail.llm.store import cut, let_go, put, ship

WORDS = 3
RADIUS = 2
SEED = 42
TILE = 16_384

#: For similar, not nearly equal texts: wider fingerprints of longer shingles.
SIMILAR_WORDS = 5
SIMILARITY = 0.8
SIMILAR_TILE = 4_096
WIDE = 4
#: Standard deviations that the candidates' radius lies above the distance at the similarity.
MARGIN = 6
#: Pairs of rows that a task compares before another one is worth its start.
TASK_PAIRS = 1 << 28
#: Bytes of shingle hashes that a task compares at once, about half of it from each side.
SHINGLE_BYTES = 32 << 20

_PARTS = 4  # 16-bit words of a fingerprint
_LOWER = bytes(range(256)).lower()
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_OFFSETS = np.arange(8) * 256


def shingles(text: str | None, words: int = WORDS) -> list[bytes]:
    """Word shingles, repeats included; the whole sequence if it is shorter."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return []
    if len(found) <= words:
        return [b" ".join(found)]
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]).tolist()
    starts = [0, *ends]
    return [joined[a:b - 1] for a, b in zip(starts, ends[words - 1:], strict=False)]


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits: bit i is set if it is set in over half the shingles' hashes."""
    hashed = [xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, words)]
    if not hashed:
        return 0
    return _majority(np.array(hashed, dtype=np.uint64))


def _majority(hashed: np.ndarray) -> int:
    """The bits set in over half of the values."""
    octets = hashed.astype("<u8").view(np.uint8).reshape(-1, 8)
    # Counting byte values per place and weighting them by their bits is far less work
    # than spreading every hash into 64 numbers.
    seen = np.bincount((octets + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
    counts = (seen @ _BITS).ravel()
    return int(np.packbits(counts * 2 > len(hashed), bitorder="little").view("<u8")[0])


def _mixed(hashed: np.ndarray, k: int) -> np.ndarray:
    """The hashes themselves, or others made of them."""
    if not k:
        return hashed
    x = hashed + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
        column = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
        names = [n for n in batch.schema.names if n != "text"] + ["__fp"]
        columns = [batch.column(n) for n in names[:-1]] + [column]
        yield pa.record_batch(columns, names=names)


def _counts(fp: F.Column) -> list[F.Column]:
    return [
        F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(_PARTS)
    ]


def _near(radius: int) -> list[tuple[int, ...]]:
    """Count differences that make one of each pair of tiles within the radius visit the other."""
    found = [d for d in product(range(-radius, radius + 1), repeat=_PARTS) if sum(map(abs, d)) <= radius]
    return [d for d in found if d > (0,) * _PARTS]


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of each pair; a label is a member's index."""
    while True:
        la, lb = labels[a], labels[b]
        if np.array_equal(la, lb):
            return labels
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := labels[labels], labels):
            labels = up


def _within(part: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of rows that differ in at most ``radius`` bits."""
    bits = np.bitwise_count(part[:, None, 0] ^ home[None, :, 0])
    for k in range(1, min(3, home.shape[1])):
        bits += np.bitwise_count(part[:, None, k] ^ home[None, :, k])
    a, b = np.nonzero(bits <= radius)
    if home.shape[1] > 3:
        # Few pairs are still within the radius after three words.
        near = np.bitwise_count(part[a] ^ home[b]).sum(axis=1, dtype=np.int64) <= radius
        a, b = a[near], b[near]
    return a, b


def _compare(home: np.ndarray, guests: np.ndarray, radius: int) -> np.ndarray:
    """Group labels over home rows followed by guests; a fingerprint is a row of words."""
    labels = np.arange(len(home) + len(guests))
    block = max(1, 2_000_000 // max(1, len(home)))
    for first, rows in ((0, home), (len(home), guests)):
        for at in range(0, len(rows), block):
            part = rows[at:at + block]
            a, b = _within(part, home, radius)
            a = a + first + at
            other = a != b
            labels = _unite(labels, a[other], b[other])
    return labels


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links that join all near fingerprints of each group of rows; groups are sorted.

    Columns: three that name the group, whether the row is a guest, its node, and the words
    of its fingerprint, if they aren't the node itself.
    """
    kept: list[np.ndarray] = []

    def group(rows: np.ndarray):
        node = rows[:, 1]
        words = np.ascontiguousarray(rows[:, min(2, rows.shape[1] - 1):]).view(np.uint64)
        n = int((rows[:, 0] == 0).sum())
        labels = _compare(words[:n], words[n:], radius)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return node[linked], node[labels[linked]]

    def out(found):
        a = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        b = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    last = None
    for batch in batches:
        columns = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        key, rows = columns[:, :3], columns[:, 3:]
        if not len(rows):
            continue
        parts = np.split(rows, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1)
        found = []
        if last is not None and (key[0] == last).all():
            kept.append(parts.pop(0))
        if parts:
            if kept:
                found.append(group(np.concatenate(kept)))
            found += [group(p) for p in parts[:-1] if len(p) > 1]
            kept = [parts[-1]]
        last = key[-1]
        yield out(found)
    if kept:
        yield out([group(np.concatenate(kept))])


def _alike(words: np.ndarray, sets: list[np.ndarray], n: int, radius: int, similarity: float) -> np.ndarray:
    """Group labels of rows joined by a Jaccard similarity of at least ``similarity``.

    ``sets`` are the distinct shingle hashes. Without guests the first ``n`` rows, then all,
    are compared with each other, else only the guests with the first ``n``. Pairs whose
    fingerprints differ in more than ``radius`` bits are left out, and so are those that
    other pairs have joined already.
    """
    labels = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(known), dtype=bool)
    first = n if n < len(sets) else 0
    block = max(1, 2_000_000 // max(1, n))
    for at in range(first, len(sets), block):
        a, b = _within(words[at:at + block], words[:n], radius)
        a = a + at
        fit = (a > b) & (np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]) - 1e-9)
        a, b = a[fit], b[fit]
        cuts = np.flatnonzero(np.diff(a)) + 1
        for row, others in zip(a[np.r_[0, cuts]] if len(a) else (), np.split(b, cuts), strict=False):
            others = others[labels[others] != labels[row]]
            if not len(others):
                continue
            own = ids[starts[row]:ends[row]]
            mark[own] = True
            if len(others) * 16 < n:
                common = np.array([np.count_nonzero(mark[ids[starts[o]:ends[o]]]) for o in others])
            else:
                common = np.add.reduceat(mark[ids[:ends[n - 1]]], starts[:n], dtype=np.int64)[others]
            mark[own] = False
            for o in others[common >= similarity * (sizes[row] + sizes[others] - common) - 1e-9]:
                if labels[o] != labels[row]:
                    low, high = sorted((labels[o], labels[row]))
                    labels[labels == high] = low
    return labels


def _confirmed(batches: Iterator[pa.RecordBatch], radius: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links like ``_links``, of groups that also have the shingle hashes of each row."""
    last, kept = None, []

    def group():
        rows = np.concatenate([r for r, _ in kept])
        sets = [np.frombuffer(h, dtype=np.uint64) for _, hashes in kept for h in hashes.to_pylist()]
        node, words = rows[:, 1], np.ascontiguousarray(rows[:, 2:]).view(np.uint64)
        labels = _alike(words, sets, int((rows[:, 0] == 0).sum()), radius, similarity)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.record_batch([pa.array(node[linked]), pa.array(node[labels[linked]])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([c.to_numpy() for c in batch.columns[:-1]], axis=1)
        hashes = batch.column(batch.num_columns - 1)
        cuts = np.flatnonzero((columns[1:, :3] != columns[:-1, :3]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(columns)], strict=True):
            if last is not None and (columns[begin, :3] != last).any():
                yield group()
                kept = []
            last = columns[begin, :3]
            kept.append((columns[begin:end, 3:], hashes.slice(begin, end - begin)))
    if kept:
        yield group()


def _tasks(sizes: DataFrame) -> int:
    """How many tasks the groups are dealt to: by the pairs they compare, not by their bytes.

    The session's number of shuffle partitions at least, and no more than there are groups.
    """
    groups = F.col("chunks") * F.greatest("blocks", F.lit(1)) + F.col("chunks") * (F.col("chunks") - 1) / 2
    n, pairs = sizes.agg(F.sum(groups), F.sum("pairs")).first()
    least = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(int(n or 0), max(least, math.ceil((pairs or 0) / TASK_PAIRS))))


def _meet(rows: DataFrame, guests: DataFrame, columns: list[str], radius: int, tile: int,
          similarity: float | None = None) -> DataFrame:
    """Links between the rows of each tile, and between them and its guests.

    Both tables have a ``tile`` and the ``columns``: a node and the words of its
    fingerprint. The tiles must be few enough for a small table of their sizes. With a
    ``similarity`` the last column is the distinct shingle hashes, ``hashes``, there are
    no guests, and the links are those of at least that Jaccard similarity.
    """
    n = F.count("*")
    if similarity is not None:
        n = F.greatest(n, F.ceil(F.sum(F.length("hashes")) * 2 * tile / SHINGLE_BYTES))
    home_n = rows.groupBy("tile").agg(n.alias("n"))
    guest_n = guests.groupBy("tile").agg(F.count("*").alias("g"))
    sizes = home_n.join(guest_n, "tile", "left").select(
        "tile",
        F.ceil(F.col("n") / tile).cast("int").alias("chunks"),
        F.ceil(F.coalesce("g", F.lit(0)) / tile).cast("int").alias("blocks"),
        (F.col("n").cast("double") * (F.col("n") + F.coalesce("g", F.lit(0)))).alias("pairs"),
    )
    sizes = cut(sizes, "tiles")
    tasks = _tasks(sizes)
    sizes = F.broadcast(sizes.drop("pairs"))
    dealt = F.xxhash64(columns[0])
    chunk = F.pmod(dealt, F.col("chunks")).cast("int")
    block = F.pmod(dealt, F.col("blocks")).cast("int")
    # A group is one chunk of a tile with one block of guests. Guest block -1 - j holds
    # chunk j of the same tile, block 0 the chunk alone if nobody visits.
    homes = rows.join(sizes, "tile").select("tile", chunk.alias("chunk"), "chunks", "blocks", *columns)
    first = F.lit(0)
    own = F.concat(
        F.sequence(first, F.greatest(F.col("blocks") - 1, first)),
        F.when(
            F.col("chunk") + 1 < F.col("chunks"),
            F.transform(F.sequence(F.col("chunk") + 1, F.col("chunks") - 1), lambda j: -1 - j),
        ).otherwise(F.array().cast("array<int>")),
    )
    here = homes.select("tile", "chunk", F.explode(own).alias("block"), F.lit(0).alias("guest"), *columns)
    visits = guests.join(sizes, "tile").select(
        "tile", F.explode(F.sequence(first, F.col("chunks") - 1)).alias("chunk"), block.alias("block"),
        F.lit(1).alias("guest"), *columns,
    )
    between = homes.where("chunk > 0").select(
        "tile", F.explode(F.sequence(first, F.col("chunk") - 1)).alias("chunk"),
        (-1 - F.col("chunk")).alias("block"), F.lit(1).alias("guest"), *columns,
    )
    placed = here.unionAll(visits).unionAll(between)
    key = ["tile", "chunk", "block", "guest"]
    placed = placed.select(*(F.col(c).cast("long").alias(c) for c in key), *columns)
    grouped = placed.repartition(tasks, "tile", "chunk", "block").sortWithinPartitions(*key)
    if similarity is not None:
        return grouped.mapInArrow(lambda it: _confirmed(it, radius, similarity), "a bigint, b bigint")
    return grouped.mapInArrow(lambda it: _links(it, radius), "a bigint, b bigint")


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` joining all pairs of near fingerprints, without listing the pairs.

    ``prints`` has one column of distinct fingerprints, ``fp``. Of the pairs found in one
    task only those needed to connect them are returned.
    """
    base = 17
    digits = _counts(F.col("fp"))
    home_tile = sum((c * base**i for i, c in enumerate(digits)), F.lit(0)).cast("long")
    rows = prints.select("fp", F.array(*digits).alias("d"), home_tile.alias("tile"))
    shift = F.array(*(F.array(*map(F.lit, d)) for d in _near(radius)))
    guests = rows.select("fp", "d", F.explode(shift).alias("o")).select(
        "fp", *((F.col("d")[i] + F.col("o")[i]).alias(f"c{i}") for i in range(_PARTS))
    )
    guests = guests.where(" and ".join(f"c{i} between 0 and 16" for i in range(_PARTS))).select(
        "fp", sum((F.col(f"c{i}") * base**i for i in range(_PARTS)), F.lit(0)).cast("long").alias("tile")
    )
    # At most 17^4 tiles exist, so their sizes are a small table at any scale.
    return _meet(rows.select("tile", "fp"), guests, ["fp"], radius, tile)


def _hex(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS,
                    tile: int = TILE) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``fingerprint``, ``component_id``, ``kept``.

    Documents are linked when their fingerprints (16 hex digits) differ in at most
    ``radius`` bits; ``component_id`` is the smallest doc_id that links reach. ``kept``
    marks the rows of one document of each group: its smallest doc_id, and of several
    texts with that id the one with the smallest hash.

    A null, empty or blank text has the fingerprint zero and is linked like any other. A
    null doc_id is taken only if its group has no other; then component_id is null.
    Repeated rows all stay, and are kept or not together. Columns so named before are
    replaced. An empty table stays empty.
    """
    ship(docs.sparkSession)
    added = {"fingerprint", "component_id", "kept", "text"}
    others = [c for c in docs.columns if c.lower() not in added]
    version = F.xxhash64("text")
    slim = docs.select(*(F.col(f"`{c}`") for c in others), version.alias("__version"), "text")
    schema = put(slim.drop("text"), "__fp bigint")
    prints = cut(slim.mapInArrow(lambda it: _fingerprints(it, words), schema), "prints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), "__version")
    classes = cut(prints.groupBy(F.col("__fp").alias("fp")).agg(F.min(first).alias("first")), "classes")
    groups = cut(connected(near_links(classes.select("fp"), radius, tile)), "components")
    members = cut(
        classes.join(groups, F.col("fp") == F.col("node"), "left").select(
            "fp", F.coalesce("component", "fp").alias("component"), "first"
        ), "members",
    )
    heads = cut(members.groupBy("component").agg(F.min("first").alias("head")), "heads")
    heads = cut(
        members.join(heads, "component").select(F.col("fp").alias("__class"), F.col("head").alias("__head")),
        "classes",
    )
    done = prints.join(heads, F.col("__fp") == F.col("__class"))
    return done.select(
        *(F.col(f"`{c}`") for c in others),
        _hex(F.col("__fp")).alias("fingerprint"),
        F.col("__head.id").alias("component_id"),
        F.coalesce(
            F.col("doc_id").cast("long").eqNullSafe(F.col("__head.id"))
            & (F.col("__version") == F.col("__head.__version")), F.lit(False)
        ).alias("kept"),
    )


def _hashes(text: str | None, words: int) -> np.ndarray:
    """Hash of each distinct shingle, sorted."""
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, words)], dtype=np.uint64))


def _wide(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Node, count and fingerprint of 256 bits of the distinct shingles of each text, for which the node stands."""
    let_go()
    for batch in batches:
        found, sizes, nodes = [], [], []
        for text in batch.column("text").to_pylist():
            hashed = _hashes(text, words)
            nodes.append(xxhash.xxh64_intdigest(hashed.tobytes(), SEED))
            sizes.append(len(hashed))
            found.append([_majority(_mixed(hashed, k)) for k in range(WIDE)])
        table = np.array(found, dtype=np.uint64).reshape(-1, WIDE).view(np.int64)
        names = [n for n in batch.schema.names if n != "text"]
        columns = [batch.column(n) for n in names] + [
            pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), *map(pa.array, table.T)
        ]
        yield pa.record_batch(columns, names=[*names, "node", "size", *(f"w{k}" for k in range(WIDE))])


def _with_hashes(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "text"]
        found = [_hashes(t, words).tobytes() for t in batch.column("text").to_pylist()]
        columns = [batch.column(n) for n in names] + [pa.array(found, pa.binary())]
        yield pa.record_batch(columns, names=[*names, "hashes"])


def _confirm(slim: DataFrame, classes: DataFrame, groups: DataFrame, words: int, similarity: float,
             radius: int, tile: int) -> DataFrame:
    """Links of a Jaccard similarity of at least ``similarity`` inside the groups of candidates.

    Only texts that have a candidate are read again, one for each class. A tile holds whole
    groups, so no link leaves it.
    """
    names = [f"w{k}" for k in range(WIDE)]
    found = cut(classes.join(groups, F.col("node") == F.col("_node")).select(
        "node", "component", "size", F.col("first.id").alias("__id"), F.col("first.version").alias("__hash"), *names
    ), "candidates")
    n, total = found.agg(F.count("*"), F.sum("size")).first()
    tiles = max(1, math.ceil(n / tile), math.ceil((total or 0) * 32 / SHINGLE_BYTES))
    found = found.withColumn("tile", F.pmod(F.xxhash64("component"), F.lit(tiles))).drop("component", "size")
    texts = slim.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__hash")))
    fields = ", ".join(f"{c} bigint" for c in names)
    rows = texts.select("tile", "node", *names, "text").mapInArrow(
        lambda it: _with_hashes(it, words), f"tile bigint, node bigint, {fields}, hashes binary"
    )
    # Repeated rows of a document count once.
    rows = cut(rows.groupBy("tile", "node", *names).agg(F.min("hashes").alias("hashes")), "hashes")
    return _meet(rows, rows.where("false"), ["node", *names, "hashes"], radius, tile, similarity)


def similar_classes(docs: DataFrame, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY,
                    tile: int = SIMILAR_TILE) -> DataFrame:
    """``doc_id``, ``version`` (a hash of the text), ``head`` and ``head_version``.

    Texts are linked if the Jaccard similarity of their distinct word shingles is at least
    ``similarity``. Fingerprints of 256 bits find the candidates: their radius lies
    ``MARGIN`` standard deviations above the bits expected to differ at the similarity, and
    each link is confirmed by the shingles' hashes. Tiles are bands of the counts of
    distinct shingles, so only equal and neighbouring bands meet. The head of a group is its
    smallest doc_id, a null one last.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    wide = ", ".join(f"w{k} bigint" for k in range(WIDE))
    prints = slim.mapInArrow(lambda it: _wide(it, words), f"doc_id bigint, version bigint, node bigint, size bigint, {wide}")
    names = [f"w{k}" for k in range(WIDE)]
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "version")
    prints = cut(prints, "wide")
    classes = cut(prints.groupBy("node").agg(
        F.min(first).alias("first"), F.min("size").alias("size"), *(F.min(n).alias(n) for n in names)
    ), "classes")
    band = F.floor(F.log(F.col("size")) / -math.log(similarity)).cast("long")
    # Unequal sets that small are never so similar.
    rows = classes.where(F.col("size") >= similarity / (1 - similarity) - 1e-9).select(band.alias("tile"), "node", *names)
    # The share of bits expected to differ at the similarity, of texts of the same size.
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    radius = round(64 * WIDE * share + MARGIN * math.sqrt(64 * WIDE * share * (1 - share)))
    above = rows.withColumn("tile", F.col("tile") + 1)
    groups = connected(_meet(rows, above, ["node", *names], radius, tile))
    groups = cut(groups.select(F.col("node").alias("_node"), "component"), "candidates")
    links = cut(_confirm(slim, classes, groups, words, similarity, radius, tile), "links")
    groups = cut(connected(links).select(F.col("node").alias("_node"), "component"), "components")
    members = cut(
        classes.join(groups, F.col("node") == F.col("_node"), "left").select(
            "node", F.coalesce("component", "node").alias("component"), "first"
        ), "members",
    )
    heads = cut(members.groupBy("component").agg(F.min("first").alias("head")), "heads")
    heads = cut(members.join(heads, "component").select("node", "head"), "heads")
    return prints.join(heads, "node").select(
        "doc_id", "version", F.col("head.id").alias("head"), F.col("head.version").alias("head_version")
    )


def drop_similar(docs: DataFrame, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY,
                 tile: int = SIMILAR_TILE) -> DataFrame:
    """``docs`` with one row of each group of similar texts, the head of ``similar_classes``.

    Null, empty and blank texts are alike. Of repeated rows one stays; a row without doc_id
    stays only if its group has no other. Columns pass through; an empty table stays empty.
    """
    found = similar_classes(docs.select("doc_id", "text"), words, similarity, tile)
    kept = found.where("doc_id <=> head and version = head_version")
    return _only(docs, kept.select(F.col("doc_id").alias("__id"), F.col("version").alias("__hash")))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a kept doc_id and hash of the text, repeated ones once."""
    kept = cut(kept.distinct(), "kept")
    joined = docs.withColumn("__version", F.xxhash64("text")).join(
        kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__version") == F.col("__hash")), "left_semi"
    )
    # Repeated rows share a partition after the join already.
    return joined.dropDuplicates(["doc_id", "__version"]).drop("__version")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS,
                         tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, as ``near_duplicates`` keeps it."""
    small = docs.select("doc_id", "text").withColumn("hash", F.xxhash64("text"))
    kept = near_duplicates(small, words, radius, tile).where("kept")
    return _only(docs, kept.select(F.col("doc_id").cast("long").alias("__id"), F.col("hash").alias("__hash")))
