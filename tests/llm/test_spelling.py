import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from filetrail.llm import spelling as S
from tests.llm.util import docs, rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(pairs, every=97):
    found = Counter()
    for d, text in pairs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(pairs, every=97):
    n = counted(pairs, every)
    close = {w: [v for v in n if v != w and near(w, v)] for w in n}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def planted(seed, size):
    """Texts over a small alphabet, so that many words are one edit apart, some often."""
    r = random.Random(seed)
    base = ["".join(r.choices("abéÿ", k=r.randint(4, 8))) for _ in range(80)]
    words = base + [w[:i] + r.choice(["", "a", "É", "z"]) + w[i + 1:] for w in base for i in (0, 2, len(w) - 1)]
    weights = [r.choice([1, 1, 2, 8, 40]) for _ in words]
    sep = [" ", ", ", "\n", "9", "漢", "-"]
    return [
        (i, "".join(x + r.choice(sep) for w in r.choices(words, weights, k=60) for x in [r.choice([w, w.upper(), w])]))
        for i in range(size)
    ]


def test_words():
    text = "Fooß ÀB×÷c naïve 漢xylem'Quark 12Zebra\x00ÿÿÿÿÿ İstanb Kelvin"
    want = Counter(w.translate(LOWER) for w in RUN.findall(text))
    got = S.document_words(3, text, every=1 << 40, least=1)
    assert {w.decode("latin-1"): n for w, n in got.items()} == want
    assert S.document_words(1, None) == S.document_words(None, "") == Counter()


def test_edit_hashes():
    r = np.random.default_rng(1)
    words = ["".join(w) for w in r.choice(list("aabÿ"), (30, 6))]
    letters = S._matrix([w.encode("latin-1") for w in words], 6)
    hashes = S.word_hashes(letters)
    for first, last in ((0, 6), (0, 2), (2, 5), (5, 6)):
        for shorter, letter, found, counts in S._edits(letters, hashes, first, last):
            for i, j in zip(*np.nonzero(counts), strict=True):
                edit = S._edited(words[i].encode("latin-1"), first + j, letter).encode("latin-1")
                assert found[i, j] == S.word_hashes(S._matrix([edit], 6 + shorter))[0]


def test_filters_have_no_false_negative_and_few_false_positives():
    r = np.random.default_rng(2)
    inside, outside = r.integers(0, 1 << 63, 20_000, dtype=np.uint64), r.integers(0, 1 << 63, 200_000, dtype=np.uint64)
    blocks = S.bloom(inside, S.filter_bytes(len(inside)))
    assert S.probe(blocks, inside).all() and S.probe(blocks, outside).mean() < 0.01


def test_against_brute_force(spark):
    pairs = planted(3, 150)
    want = brute(pairs)
    assert sum(w[1] is not None for w in want) > 30 and any(w[2] != w[1] for w in want if w[1])
    assert rows(S.group_spellings(docs(spark, pairs)), *COLUMNS) == sorted(want)
    every = brute(pairs, every=3)
    assert rows(S.group_spellings(docs(spark, pairs), every=3), *COLUMNS) == sorted(every)


def test_several_rounds_and_small_pieces(spark):
    pairs = planted(4, 30)
    words = S.vocabulary(docs(spark, pairs), held=10)
    n = counted(pairs)
    assert {r["word"]: r["n"] for r in words.collect()} == n
    want = {frozenset((a, b)) for a in n for b in n if a < b and near(a, b)}
    for filter_size, edits in ((1 << 26, 1 << 20), (200, 100), (1 << 26, 1000)):
        got = [frozenset((r["word"], r["other"])) for r in S.near_words(words, 5, filter_size, edits).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_chains_lead_to_one_root(spark):
    chain = ["aaaaaa" + "b" * i for i in range(7)]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i))
    got = {r["word"]: (r["form"], r["root"]) for r in S.group_spellings(docs(spark, [(1, text)]), every=1 << 40).collect()}
    assert got == {w: (chain[i + 1] if i < 6 else None, chain[-1]) for i, w in enumerate(chain)}


def test_long_word_nulls_repeats_and_empty_table(spark):
    long = "abcdefghij" * 3000
    pairs = [(None, long), (None, long), (1, long), (1, long + "x"), (2, f"{long}x {long}x"), (3, None), (4, ""), (4, "abc abc abc")]
    df = docs(spark, pairs, "word n form root edit other")
    assert rows(S.group_spellings(df, every=1 << 40), *COLUMNS) == [(long, None, long, 3, 1, None), (long + "x", None, long + "x", 3, 1, None)]
    assert S.group_spellings(docs(spark, [])).count() == 0
    with pytest.raises(ValueError, match="twice"):
        S.group_spellings(df, ratio=1)
