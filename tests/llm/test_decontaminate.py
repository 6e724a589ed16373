import random
import re
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import fs

from filetrail.llm import decontaminate as D
from tests.llm.util import docs, rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, items, size):
    windows = set()
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(size, len(w))
        windows |= {(tuple(w[i:i + n]), str(item)) for i in range(len(w) - n + 1) if n}
    out = []
    for d, text in pairs:
        w = WORD.findall((text or "").translate(LOWER))
        hits = sorted(
            (i, item, len(win)) for win, item in windows for i in range(len(w) - len(win) + 1) if tuple(w[i:i + len(win)]) == win
        )
        covered = {j for i, _, n in hits for j in range(i, i + n)}
        out.append((d, len(w), len(covered), [(item, i, n) for i, item, n in hits]))
    return sorted(out, key=lambda x: (x[0] is not None, x[0]))


def found(df):
    got = [(r["doc_id"], r["n_words"], r["n_hit"], [tuple(h) for h in r["hits"]]) for r in df.collect()]
    return sorted(got, key=lambda x: (x[0] is not None, x[0]))


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_against_brute_force(spark, block_bytes):
    r = random.Random(5)
    vocabulary = ["a", "b", "ab", "Été", "ß", "x9", "lengthy", "word", "漢字", "extraordinarily"]
    say = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "-", "  "]) for _ in range(n))
    items = [(i, say(r.choice([0, 1, 2, 3, 4, 7, 15]))) for i in range(25)] + [(3, "a b"), (99, None), (98, "!?")]
    pairs = [(d, say(r.randint(0, 60))) for d in range(60)]
    pairs += [(200 + i, f"so {t} end") for i, t in enumerate(x[1] for x in items)]
    pairs += [(300, None), (301, ""), (302, "...")]
    out = D.find_benchmark(docs(spark, pairs), docs(spark, items).withColumnRenamed("doc_id", "item_id"), 4, block_bytes)
    assert found(out) == brute(pairs, items, 4)


def test_long_text_columns_and_empty_tables(spark):
    items = docs(spark, [(1, " ".join(f"t{i}" for i in range(30)))]).withColumnRenamed("doc_id", "item_id")
    text = "filler words " * 30_000 + " ".join(f"T{i}" for i in range(5, 20)) + " end" * 9000
    df = docs(spark, [(1, text), (None, "t0 t1")], "hits n_hit window")
    out = D.find_benchmark(df, items, keep_text=False)
    assert out.columns == ["doc_id", "window", "n_words", "n_hit", "hits"]
    assert rows(out, "doc_id", "n_words", "n_hit") == [(None, 2, 0), (1, 69_015, 15)]
    assert rows(D.drop_contaminated(df, items), "doc_id", "text", "hits") == [(None, "t0 t1", "x")]
    assert D.find_benchmark(docs(spark, []), items).count() == 0
    none = D.find_benchmark(df, items.limit(0))
    assert rows(none, "doc_id", "n_hit") == [(None, 0), (1, 0)]


def test_a_batch_is_searched_in_portions(monkeypatch, tmp_path):
    r, schema = random.Random(8), pa.schema([("doc_id", pa.int64()), ("__text", pa.string())])
    texts = [None, "", "..."] + [" ".join(r.choices(["a", "b", "É-c", "word"], k=r.randint(0, 60))) for _ in range(90)]
    items = [("x", "a b a"), ("y", "É c word b"), ("z", "word")]
    paths = []
    for n, (item, text) in enumerate(items):
        paths.append(f"{n}.parquet")
        windows = sorted(D.windows_of(text, 3))
        pq.write_table(pa.table({"window": windows, "item_id": [item] * len(windows)}), tmp_path / paths[-1])
    batch = pa.record_batch([list(range(len(texts))), texts], schema)
    want = brute(list(enumerate(texts)), items, 3)
    for size in (1, 300, 1 << 20):
        monkeypatch.setattr(D, "PORTION_BYTES", size, raising=False)
        out = pa.Table.from_batches(D._scan(iter([batch]), str(tmp_path), paths, ["doc_id"])).to_pylist()
        assert [(x["doc_id"], x["n_words"], x["n_hit"], [tuple(h.values()) for h in x["hits"]]) for x in out] == want
    none = list(D._scan(iter([batch.slice(0, 0)]), str(tmp_path), paths, ["doc_id"]))
    assert [b.num_rows for b in none] == [0]


@pytest.mark.parametrize("block_bytes", [400, 1 << 20])
def test_blocks_go_by_bytes_however_many_files_spark_writes(spark, monkeypatch, block_bytes):
    items = [(i, f"the same long beginning of every item but {'one' if i % 2 else 'two'} end{i % 7}") for i in range(40)]
    pairs = [(d, f"see: The same long beginning of every item but {'two' if d % 3 else 'one'} END{d} it is") for d in range(12)]
    table = docs(spark, items).withColumnRenamed("doc_id", "item_id")
    plain = type(table).repartitionByRange
    monkeypatch.setattr(type(table), "repartitionByRange", lambda self, n, *by: plain(self, max(n, 30), *by))
    folder, blocks = D.write_patterns(table, 9, block_bytes)
    assert len(blocks) == 1 if block_bytes == 1 << 20 else len(blocks) > 1
    names = [name for b in blocks for name in b]
    octets = [sum(len(r["window"]) + len(r["item_id"]) for r in pq.read_table(f"{D.file_system(folder)[1]}/{n}").to_pylist()) for n in names]
    assert len(names) > 10 and len(set(names)) == len(names)
    size = dict(zip(names, octets, strict=True))
    for b, following in zip(blocks, [*blocks[1:], [None]], strict=True):
        assert len(b) == 1 or sum(map(size.get, b)) <= block_bytes
        assert following == [None] or sum(map(size.get, b)) + size[following[0]] > block_bytes
    assert found(D.find_benchmark(docs(spark, pairs), table, 9, block_bytes)) == brute(pairs, items, 9)


@pytest.mark.parametrize(("group", "built"), [(1 << 20, 3), (1, 3 + 7 * 2)])
def test_several_blocks_are_built_once_for_many_batches(monkeypatch, tmp_path, group, built):
    r = random.Random(9)
    items = [("x", "a b a c d"), ("y", "É c word b"), ("z", "word word a b")]
    for item, text in items:
        windows = sorted(D.windows_of(text, 3))
        pq.write_table(pa.table({"window": windows, "item_id": [item] * len(windows)}), tmp_path / f"{item}.parquet")
    texts = [" ".join(r.choices(["a", "b", "c", "É", "word"], k=r.randint(0, 30))) for _ in range(80)]
    batches = [pa.record_batch([list(range(i, i + 10)), texts[i:i + 10]], names=["doc_id", "__text"]) for i in range(0, 80, 10)]
    made, plain = [], D.Matcher
    monkeypatch.setattr(D, "Matcher", lambda *a: made.append(1) or plain(*a))
    monkeypatch.setattr(D, "GROUP_BYTES", group, raising=False)
    out = list(D._scan(iter(batches), str(tmp_path), [f"{item}.parquet" for item, _ in items], ["doc_id"]))
    assert [b.num_rows for b in out] == [10] * 8 and len(made) == built
    got = [(x["doc_id"], x["n_words"], x["n_hit"], [tuple(h.values()) for h in x["hits"]]) for b in out for x in b.to_pylist()]
    assert got == brute(list(enumerate(texts)), items, 3)


def test_memory_of_a_large_batch(tmp_path):
    windows = sorted(D.windows_of("some words that are in no text", 4))
    pq.write_table(pa.table({"window": windows, "item_id": ["x"] * len(windows)}), tmp_path / "p.parquet")
    text = "filler words of a text " * 100
    batch = pa.record_batch([list(range(10_000)), [text] * 10_000], names=["doc_id", "__text"])
    D._matcher(fs.LocalFileSystem(), f"{tmp_path}/p.parquet")
    tracemalloc.start()
    list(D._scan(iter([batch]), str(tmp_path), ["p.parquet"], ["doc_id"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The normalised texts, four bytes a word and a portion's own.
    assert peak < 4 * batch.nbytes
