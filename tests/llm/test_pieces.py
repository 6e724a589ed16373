import random

import public_tokenizers
import pytest
import sentencepiece

from filetrail.llm.pieces import Pieces, encode_decode
from tests.llm.util import docs, rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "  a  b ", "\ta\n b", "▁x ▁", "a\x00b", "<s>", "</s>", "<0x41>", "　x", "é", "漢字が", "😀", "ﬁ ½", "a" * 3000]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("text", ODD + [" " * n + "x" + " " * n for n in range(2, 20)])
def test_odd_texts(pieces, library, text):
    assert pieces.encode(text) == library.encode(text)


def test_random_texts(pieces, library):
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz" * 2 + "    \n.,-()=ABCDéèüß漢が한😀́\x00▁0123"
    for i in range(4000):
        text = "".join(r.choices(letters, k=r.randint(0, 40)))
        if i % 3 == 0:
            text = text.replace("x", "    ").replace("q", "the").replace("z", "tion ")
        assert pieces.encode(text) == library.encode(text), text


def test_search_agrees_with_merging(pieces):
    r = random.Random(8)
    for _ in range(3000):
        word = "▁" + "".join(r.choices("etaoinshrdlu", k=r.randint(1, 14)))
        assert pieces.search(word) == pieces.merge(word)[0]


def test_caches_may_be_dropped(pieces, library, monkeypatch):
    monkeypatch.setattr("filetrail.llm.pieces.CACHE", 8)
    text = " ".join(f"word{i % 7} other{i}" for i in range(300))
    assert pieces.encode(text) == library.encode(text)


def test_operator(spark, library):
    pairs = list(enumerate(ODD)) + [(100, None), (None, "null id"), (1, " ")]
    df = docs(spark, pairs, "ids decoded extra")
    out = encode_decode(df, MODEL, keep_text=False)
    assert out.columns == ["doc_id", "extra", "ids", "decoded"]
    want = sorted(((d, [*library.encode(t or ""), 2], library.decode(library.encode(t or ""))) for d, t in pairs), key=str)
    assert sorted(rows(out, "doc_id", "ids", "decoded"), key=str) == want
    assert encode_decode(docs(spark, []), MODEL).count() == 0

