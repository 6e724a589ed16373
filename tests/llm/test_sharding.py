import random
import zlib
from collections import defaultdict

import pytest

from filetrail.llm import sharding as S
from filetrail.llm.store import new_folder
from tests.llm.util import docs, rows


def mapped(spark, df, shards=5, slots=64):
    folder = new_folder(spark, "map")
    return folder, S.read_map(spark, folder, S.update_map(df, folder, shards, slots))


def test_first_map_is_near_equal():
    r = random.Random(1)
    loads = [r.randint(0, 1000) for _ in range(500)] + [0] * 20
    out = S.edit_map(loads, 7)
    sizes = [sum(b for b, k in zip(loads, out, strict=True) if k == s) for s in range(7)]
    assert set(out) == set(range(7)) and max(sizes) - min(sizes) <= 5
    assert out == S.edit_map(loads, 7)


def test_edits_move_little():
    r = random.Random(2)
    loads = [r.randint(50, 150) for _ in range(2000)]
    first = S.edit_map(loads, 8)
    assert S.edit_map(loads, 8, first) == first
    grown = S.edit_map(loads, 9, first)
    moved = [i for i in range(2000) if grown[i] != first[i]]
    assert {grown[i] for i in moved} == {8}, "one more shard takes slots only into itself"
    sizes = [sum(b for b, k in zip(loads, grown, strict=True) if k == s) for s in range(9)]
    assert max(sizes) <= 1.01 * sum(loads) / 9 and min(sizes) >= 0.95 * sum(loads) / 9
    fewer = S.edit_map(loads, 7, first)
    assert all(f == k for f, k in zip(fewer, first, strict=True) if k < 7) and set(fewer) == set(range(7))
    # One shard's data doubles: only it gives slots away.
    later = [b * (1 + (k == 3)) for b, k in zip(loads, first, strict=True)]
    edited = S.edit_map(later, 8, first)
    assert {k for k, e in zip(first, edited, strict=True) if k != e} == {3}
    with pytest.raises(ValueError):
        S.edit_map(loads, 0)


def brute(pairs, shard_of):
    """Size and checksum by row, and the places each shard must have."""
    out, places = [], defaultdict(int)
    for d, text in pairs:
        data = (text or "").encode()
        out.append((d, len(data) + 8, zlib.crc32(data)))
        places[shard_of[d]] += 1
    return sorted(out), {k: list(range(n)) for k, n in places.items()}


def test_assign(spark):
    r = random.Random(3)
    pairs = [(i, "é漢x " * r.randint(0, 30)) for i in range(400)] + [(1000, "long " * 50_000)]
    df = docs(spark, pairs)
    _, slot_map = mapped(spark, df)
    got = S.assign_shards(df, slot_map, 64).collect()
    want, places = brute(pairs, {g["doc_id"]: g["shard"] for g in got})
    assert sorted((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == want
    found, slots = defaultdict(list), {}
    for g in got:
        found[g["shard"]].append(g["slot"])
        assert slots.setdefault(g["virtual_slot"], g["shard"]) == g["shard"]
    assert {k: sorted(v) for k, v in found.items()} == places
    assert {m["virtual_slot"]: (m["bytes"], m["rows"]) for m in slot_map.where("rows > 0").collect()} == {
        s: (sum(g["size"] for g in got if g["virtual_slot"] == s), sum(g["virtual_slot"] == s for g in got))
        for s in slots
    }


def test_sizes_near_equal(spark):
    r = random.Random(4)
    df = docs(spark, [(i, "x" * r.randint(0, 3000)) for i in range(3000)])
    _, slot_map = mapped(spark, df, 24, 4096)
    sizes = [s["n"] for s in S.assign_shards(df, slot_map, 4096).groupBy("shard").agg({"size": "sum"}).toDF("s", "n").collect()]
    assert len(sizes) == 24 and max(sizes) <= 1.001 * min(sizes)


def test_versions(spark):
    df = docs(spark, [(i, "text " * (i % 9)) for i in range(500)])
    folder = new_folder(spark, "map")
    assert S.latest_version(spark, folder) == 0
    assert [S.update_map(df, folder, n, 256) for n in (4, 5)] == [1, 2] and S.latest_version(spark, folder) == 2
    old, new = ({m["virtual_slot"]: m for m in S.read_map(spark, folder, v).collect()} for v in (1, 2))
    assert not any(m["moved"] for m in old.values())
    assert all(new[s]["shard"] == 4 if new[s]["moved"] else new[s]["shard"] == old[s]["shard"] for s in old)
    with pytest.raises(ValueError, match="256 slots"):
        S.update_map(df, folder, 4, 128)
    # Another editor begins version 3 and ends after ours looked.
    S.read_map(spark, folder, 2).limit(0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        S._version_folder(folder, 3))
    assert S.latest_version(spark, folder) == 2
    with pytest.raises(RuntimeError, match="another editor"):
        S.update_map(df, folder, 6, 256)


def test_write(spark):
    df = docs(spark, [(i, f"text {i}") for i in range(200)])
    _, slot_map = mapped(spark, df)
    assigned = S.assign_shards(df, slot_map, 64)
    folder = new_folder(spark, "shards")
    S.write_shards(assigned, folder)
    back = spark.read.parquet(folder)
    assert rows(back, "doc_id", "shard", "slot") == rows(assigned, "doc_id", "shard", "slot")
    for k in range(5):
        for file in back.where(f"shard = {k}").inputFiles():
            slots = [r["slot"] for r in spark.read.parquet(file).collect()]
            assert slots == sorted(slots)


def test_nulls_repeats_clashing_names_and_empty_table(spark):
    pairs = [(None, None), (None, None), (None, ""), (1, None), (1, "a"), (1, "a"), (2, "")]
    df = docs(spark, pairs, "size shard slot virtual_slot bytes rows __x")
    _, slot_map = mapped(spark, df, 2)
    out = S.assign_shards(df, slot_map, 64)
    assert out.columns == ["doc_id", "text", "bytes", "rows", "__x", "size", "text_crc32", "virtual_slot", "shard", "slot"]
    got = rows(out, "doc_id", "text", "size", "text_crc32")
    assert got == sorted([(d, t, len(t or "") + 8, zlib.crc32((t or "").encode())) for d, t in pairs],
                         key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert len({(r["shard"], r["slot"]) for r in out.collect()}) == 7
    empty = docs(spark, [])
    _, slot_map = mapped(spark, empty)
    assert S.assign_shards(empty, slot_map, 64).count() == 0
    with pytest.raises(ValueError, match="slots"):
        S.record_slot(0)
