"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's hash names one of thousands of slots, whose number never changes. Bytes are
summed by slot, and a map gives each slot to a shard so that shards hold near the same
bytes. When data or the number of shards change, the map is edited: slots of overfull or
closed shards move, all others stay where they are. Every edit is a new version in a
folder, so a reader says which one it means and an earlier one can be taken again.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetrail.llm.store import cut

SLOTS = 16_384
#: The map and the sums by slot go through the driver, so the number of slots is bounded.
MOST_SLOTS = 1 << 20
SHARDS = 24
#: Bytes a record has besides its text.
OVERHEAD = 8
#: Share of the mean by which a shard may be larger before an edit takes slots from it.
TOLERANCE = 0.001

MAP = "slot int, shard int, bytes long, rows long, moved boolean"


def record_slot(slots: int) -> Column:
    """The virtual slot of a record: a hash of its doc_id and text."""
    if not 1 <= slots <= MOST_SLOTS:
        raise ValueError(f"between 1 and {MOST_SLOTS} slots, not {slots}")
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int")


def record_size() -> Column:
    """UTF-8 bytes of the text, and a fixed number for the record."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD


def slot_loads(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``virtual_slot, bytes, rows`` of the slots that hold records, summed before they move."""
    rows = docs.select(record_slot(slots).alias("virtual_slot"), record_size().alias("size"))
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def edit_map(loads: Sequence[int], shards: int, current: Sequence[int] | None = None,
             tolerance: float = TOLERANCE) -> list[int]:
    """The shard of each slot, given the bytes of each slot.

    Without a map, slots go from the heaviest to the lightest to the shard that has least.
    With one, slots of shards from ``shards`` on are taken off; a shard that is larger than
    the mean by more than ``tolerance`` gives its heaviest slots that do not bring it below
    the mean; these are dealt in the same way, and all others stay.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    order = sorted(range(len(loads)), key=lambda s: (-loads[s], s))
    out, sizes, counts = [-1] * len(loads), [0] * shards, [0] * shards
    if current is not None:
        for slot, shard in enumerate(current):
            if shard < shards:
                out[slot], sizes[shard], counts[shard] = shard, sizes[shard] + loads[slot], counts[shard] + 1
        mean = sum(loads) / shards
        over = {s for s in range(shards) if sizes[s] > mean * (1 + tolerance)}
        for slot in order:
            shard = out[slot]
            if shard in over and loads[slot] and sizes[shard] - loads[slot] >= mean:
                out[slot], sizes[shard], counts[shard] = -1, sizes[shard] - loads[slot], counts[shard] - 1
    heap = [(sizes[s], counts[s], s) for s in range(shards)]
    heapq.heapify(heap)
    for slot in order:
        if out[slot] < 0:
            size, count, shard = heapq.heappop(heap)
            out[slot] = shard
            heapq.heappush(heap, (size + loads[slot], count + 1, shard))
    return out


def _version_folder(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/v{version}"


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """``virtual_slot, shard, bytes, rows, moved`` of one version of the map."""
    return spark.read.schema(MAP).parquet(_version_folder(folder, version)).withColumnRenamed("slot", "virtual_slot")


def latest_version(spark: SparkSession, folder: str) -> int:
    """The newest version that was written to its end; 0 if there is none."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(hadoop)
    if not files.exists(path):
        return 0
    names = [s.getPath() for s in files.listStatus(path) if s.isDirectory()]
    whole = [p.getName() for p in names if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((int(n[1:]) for n in whole if n[:1] == "v" and n[1:].isdigit()), default=0)


def update_map(docs: DataFrame, folder: str, shards: int = SHARDS, slots: int = SLOTS,
               tolerance: float = TOLERANCE) -> int:
    """Write the first map, or the next version of an edited one, for ``docs``; its version.

    ``slots`` must be what the folder's first version has. Two editors of one version can't
    both write the next: the second fails. Only the sums of the slots come to the driver, at
    most ``MOST_SLOTS`` rows.
    """
    spark = docs.sparkSession
    found = {r["virtual_slot"]: r for r in slot_loads(docs, slots).collect()}
    loads = [found[s]["bytes"] if s in found else 0 for s in range(slots)]
    last = latest_version(spark, folder)
    current = None
    if last:
        old = {r["virtual_slot"]: r["shard"] for r in read_map(spark, folder, last).collect()}
        if len(old) != slots:
            raise ValueError(f"{folder} has {len(old)} slots, not {slots}: their number is fixed")
        current = [old[s] for s in range(slots)]
    shard_of = edit_map(loads, shards, current, tolerance)
    rows = [
        (s, k, loads[s], found[s]["rows"] if s in found else 0, current is not None and current[s] != k)
        for s, k in enumerate(shard_of)
    ]
    try:
        spark.createDataFrame(rows, MAP).coalesce(1).write.mode("error").parquet(_version_folder(folder, last + 1))
    except AnalysisException as e:
        raise RuntimeError(f"version {last + 1} of {folder} is being written by another editor") from e
    return last + 1


def assign_shards(docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and ``slot``.

    ``slot`` is a record's place in its shard, from 0 without a gap: shards hold their
    virtual slots one after the other, and records of one by doc_id, then by text hash.

    A null doc_id or text takes part in the hash as nothing, so records without a doc_id
    spread by their texts; a null text has the size and checksum of an empty one. Records
    equal in both share a virtual slot and have places next to each other; the sort by
    virtual slot spills, so a record repeated very often costs disk, not memory. An empty
    table stays empty. Other columns pass through, columns named like those added are
    replaced.
    """
    added = ["size", "text_crc32", "virtual_slot", "shard", "slot"]
    names = [c for c in docs.columns if c.lower() not in added]
    held = cut(slot_loads(docs, slots), "slot-loads")
    # A row a virtual slot, at most MOST_SLOTS: both the running sums and the broadcast are bounded.
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = slot_map.select("virtual_slot", "shard").join(held.select("virtual_slot", "rows"), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__base")
    )
    rows = docs.select(
        *(F.col(f"`{c}`") for c in names), record_size().alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        record_slot(slots).alias("virtual_slot"), F.xxhash64("text").alias("__hash"),
    )
    place = Window.partitionBy("virtual_slot").orderBy("doc_id", "__hash")
    placed = rows.withColumn("__place", F.row_number().over(place)).join(F.broadcast(bases), "virtual_slot")
    return placed.select(
        *(F.col(f"`{c}`") for c in names), "size", "text_crc32", "virtual_slot", "shard",
        (F.col("__base") + F.col("__place") - 1).alias("slot"),
    )


def write_shards(assigned: DataFrame, folder: str) -> None:
    """Write assigned records to ``folder/shard=<k>``, a file or more a shard, in order of ``slot``.

    Rows go to tasks by runs of (shard, slot), so a large shard is written by several.
    """
    ordered = assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
