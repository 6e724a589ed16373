import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from filetrail.llm import token_files as T
from filetrail.llm.store import new_folder
from tests.llm.util import docs, rows

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def plain(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder(library, monkeypatch):
    encoder, r = T.Encoder(FILE), random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz" * 2 + "      \n\t.,-()'ABCéèüß漢が한😀\x00\xa0　\x1c\x85_$%&|0123"
    for i in range(4000):
        if i == 2000:
            monkeypatch.setattr(T, "CACHE", 16)
        text = "".join(r.choices(letters, k=r.randint(0, 40)))
        if i % 5 == 0:
            text = text.replace("q", "'s ").replace("z", "<|endoftext|>")
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == plain(library, text), text


def test_words_are_cached_without_marks_and_line_ends(library):
    """Only letters that are new go through the tokenizer, whatever stands around them."""
    encoder = T.Encoder(FILE)
    encoder.encode("une été fin. Une, (fin) 12-3.\nUne")
    texts = ["une, été; fin.\nUne fin (été) 12-3.\nUne", "fin,été.été:fin", "x9 don't  l'été\n\nUne—fin\n", " \n a<|endoftext|>b"]
    want = [plain(library, t) for t in texts]
    found, whole, model = [], encoder._whole, encoder.tokenize
    encoder._whole = lambda unit: found.append(unit) or whole(unit)
    encoder.tokenize = lambda unit: found.append(unit) or model(unit)
    got = [np.frombuffer(encoder.encode(t), np.int32).tolist() for t in texts]
    assert got == want
    # é is two bytes, which stand as two characters.
    assert [u for u in found if "fin" in u and "l'" not in u or u.startswith("Ã")] == ["Ã©tÃ©"]


def test_round_trip(spark, library):
    r = random.Random(7)
    say = lambda n: " ".join(r.choices(["some", "words,", "and.\nmore", "été", "x9"], k=n))
    pairs = [(i * 3, say(r.randint(0, 30))) for i in range(200)] + [(1, None), (2, ""), (4, say(20_000))]
    r.shuffle(pairs)
    folder = new_folder(spark, "tokens")
    T.write_tokens(docs(spark, pairs, "ids part offset"), folder, FILE)
    tokens = T.read_tokens(spark, folder)
    start, want = 0, []
    for d, text in sorted(pairs):
        ids = [*plain(library, text), 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(T.token_index(tokens), "doc_id", "start", "n_tokens", "ids_crc32") == want
    assert {r["doc_id"]: r["ids"] for r in tokens.collect()} == {d: [*plain(library, t), 0] for d, t in pairs}


def rows_read(df):
    """The rows of a query, and how many rows its scan took from the files."""
    found = [r["doc_id"] for r in df.collect()]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return found, scan.metrics().apply("numOutputRows").value()


def test_row_indexes_and_bloom_filters_prune(spark):
    folder = new_folder(spark, "tokens")
    T.write_tokens(docs(spark, [(2 * i, f"text {i}") for i in range(10 * T.STRIDE)]), folder, FILE)
    tokens = T.read_tokens(spark, folder)
    files = list(Path(folder.removeprefix("file:")).glob("*.orc"))
    found = [orc.ORCFile(f) for f in files]
    assert sum(f.nrows for f in found) == 10 * T.STRIDE
    assert all(f.row_index_stride == T.STRIDE and str(f.compression).upper().endswith("ZSTD") for f in found)
    assert rows_read(tokens)[1] == 10 * T.STRIDE
    # One row group holds it; statistics exclude all others.
    ids, read = rows_read(tokens.where("doc_id = 2468"))
    assert ids == [2468] and 1 <= read <= T.STRIDE
    # Within the bounds of a row group, but in no filter (a false positive would read a group).
    reads = [rows_read(tokens.where(f"doc_id = {i}")) for i in range(2469, 2489, 2)]
    assert all(not ids for ids, _ in reads) and sum(not read for _, read in reads) >= 8
    assert rows_read(tokens.where("doc_id = 2469 or doc_id = 5000"))[1] <= T.STRIDE


def test_stripes_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(T, "STRIPE_BYTES", 1 << 16)
    folder, r = new_folder(spark, "tokens"), random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz  "
    T.write_tokens(docs(spark, [(i, "".join(r.choices(letters, k=100))) for i in range(22_000)]), folder, FILE)
    files = [orc.ORCFile(f) for f in Path(folder.removeprefix("file:")).glob("*.orc")]
    assert sum(f.nstripes for f in files) >= 4
    ids, read = rows_read(T.read_tokens(spark, folder).where("doc_id between 4000 and 4010"))
    assert sorted(ids) == list(range(4000, 4011)) and read <= 2 * T.STRIDE


def test_nulls_repeats_and_empty_table(spark, library):
    folder = new_folder(spark, "tokens")
    T.write_tokens(docs(spark, [(None, "a"), (1, "b c"), (1, "b c"), (1, "d")]), folder, FILE)
    got = rows(T.token_index(T.read_tokens(spark, folder)), "doc_id", "start", "n_tokens")
    assert [g[0] for g in got] == [None, 1, 1, 1]
    assert sorted(g[1] for g in got)[0] == 0 and sum(g[2] for g in got) == 10
    folder = new_folder(spark, "tokens")
    T.write_tokens(docs(spark, []), folder, FILE)
    assert T.token_index(T.read_tokens(spark, folder)).count() == 0
