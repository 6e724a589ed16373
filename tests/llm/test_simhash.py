import random

import pytest
import xxhash

from filetrail.llm import simhash as S
from filetrail.llm.components import connected
from tests.llm.util import docs, rows


def brute_print(text, words=3):
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))
    s = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, radius):
    """Smallest member that links reach, for values by id."""
    group = {d: d for d in values}
    for _ in values:
        for a in values:
            for b in values:
                if (values[a] ^ values[b]).bit_count() <= radius:
                    group[a] = group[b] = min(group[a], group[b])
    return group


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One two", "a b c", "a b c a b c", "É x\xa0y Z É", "w " * 5000])
def test_fingerprint(text):
    assert S.fingerprint(text) == brute_print(text)


def test_near_duplicates(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    pairs = []
    for d in range(60):
        if d % 3 and pairs:
            w = (r.choice(pairs)[1] or "x").split()
            w[r.randrange(len(w))] = r.choice(vocabulary)
        else:
            w = r.choices(vocabulary, k=r.choice([1, 2, 5, 300, 600]))
        pairs.append((d, " ".join(w)))
    pairs += [(100, None), (101, ""), (102, " \n"), (103, pairs[0][1])]
    values = {d: brute_print(t) for d, t in pairs}
    want = components(values, 2)
    out = S.near_duplicates(docs(spark, pairs, "fingerprint fp"))
    assert out.columns == ["doc_id", "fp", "fingerprint", "component_id", "kept"]
    got = rows(out, "doc_id", "fingerprint", "component_id")
    assert got == sorted((d, f"{values[d]:016x}", want[d]) for d in values)
    assert sorted(r["doc_id"] for r in out.where("kept").collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("tile", [4, 16, 10_000])
def test_tiles_and_chunks(spark, tile):
    r = random.Random(tile)
    seeds = [r.getrandbits(64) for _ in range(4)]
    values = {s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for s in seeds for _ in range(25)}
    values |= {r.getrandbits(64) for _ in range(30)} | {0, 1, 3, 7, 2**64 - 1, 2**63}
    signed = [v - 2**64 if v >= 2**63 else v for v in sorted(values)]
    links = S.near_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), tile=tile)
    got = {r["node"]: r["component"] for r in connected(links).collect()}
    want = components({v: v % 2**64 for v in signed}, 2)
    assert {v: got.get(v, v) for v in signed} == want


def test_drop_keeps_one_row_of_each_group(spark):
    long = " ".join(f"w{i}" for i in range(400))
    pairs = [(3, long), (1, long), (1, long), (2, "other words here"), (None, "only null"), (None, "only null"), (9, None)]
    out = S.drop_near_duplicates(docs(spark, pairs, "extra"))
    assert rows(out, "doc_id", "text", "extra") == [
        (None, "only null", "x"), (1, long, "x"), (2, "other words here", "x"), (9, None, "x"),
    ]
    assert S.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3)]
    found = connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}
