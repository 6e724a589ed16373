import random

import pytest

from filetrail.llm import simhash as S
from tests.llm.util import docs, rows


def jaccard(a, b):
    a, b = set(S.shingles(a, 5)), set(S.shingles(b, 5))
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(pairs, similarity=0.8):
    """Head of each document: the smallest doc_id that similar texts reach."""
    head = {d: d for d, _ in pairs}
    links = [(a, b) for i, (a, x) in enumerate(pairs) for b, y in pairs[:i] if jaccard(x, y) >= similarity]
    for _ in pairs:
        for a, b in links:
            head[a] = head[b] = min(head[a], head[b])
    return head


def planted(seed, shares):
    """Texts of unlike words, each with one that shares about so many of its shingles."""
    r = random.Random(seed)
    out = []
    for i, share in enumerate(shares):
        n = r.choice([30, 41, 201, 801])
        words = [f"w{seed}_{i}_{k}" for k in range(n)]
        other = list(words)
        # A changed tail of t words replaces t shingles of about n.
        t = round((n - 4) * (1 - share) / (1 + share))
        for k in range(n - t, n):
            other[k] += "x"
        out += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    return out


@pytest.mark.parametrize("tile", [8, 4_096])
def test_planted_pairs_against_brute_force(spark, tile):
    pairs = planted(7, [0.70, 0.74, 0.78, 0.79, 0.80, 0.81, 0.82, 0.85, 0.90, 0.95] * 12)
    want = brute(pairs)
    assert 40 < sum(h != d for d, h in want.items()) < 120
    got = rows(S.similar_classes(docs(spark, pairs), tile=tile), "doc_id", "head")
    assert got == sorted(want.items())


@pytest.mark.parametrize("tile, size", [(4_096, None), (16, 4_096)])
def test_large_group_and_odd_texts(spark, monkeypatch, tile, size):
    if size:
        monkeypatch.setattr(S, "SHINGLE_BYTES", size)
    r = random.Random(1)
    base = [f"w{k}" for k in range(60)]
    pairs = []
    for d in range(80):
        w = list(base)
        for _ in range(r.choice([1, 1, 2, 3])):
            w[r.randrange(60)] = f"n{d}"
        pairs.append((d, " ".join(w)))
    pairs += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "A  b"), (205, pairs[3][1])]
    pairs += [(206, "a b c d e f g h"), (207, "a b c d e f g h i"), (208, "a b c d e f g")]
    got = rows(S.similar_classes(docs(spark, [*pairs, pairs[0]]), tile=tile), "doc_id", "head")
    assert sorted(set(got)) == sorted(brute(pairs).items())


def test_repeats_do_not_count(spark):
    body = [f"b{k}" for k in range(300)]
    phrase = "the very same frequent phrase".split()
    texts = [body, body + body, body + body + body[:150]]
    texts += [[x for k in range(12) for x in (*phrase * 8, *(f"{name}{k}_{i}" for i in range(6)))] for name in "pq"]
    pairs = [(d, " ".join(w)) for d, w in enumerate(texts)]
    assert jaccard(pairs[0][1], pairs[1][1]) > 0.95 and jaccard(pairs[3][1], pairs[4][1]) < 0.5
    got = rows(S.similar_classes(docs(spark, pairs)), "doc_id", "head")
    assert got == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 4)]
