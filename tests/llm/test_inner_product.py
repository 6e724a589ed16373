import math
import random

import pytest

from filetrail.llm import inner_product as I
from tests.llm.util import rows


def brute(pairs, every, k):
    sound = {
        (v, tuple(math.floor(256 * x) for x in e)) for v, e in pairs
        if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    }
    out = []
    for q, a in sound:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in sound if v != q)[:k]  # noqa: B905
            out += [(q, i, v, -s) for i, (s, v) in enumerate(found, 1)]
    return sorted(out)


def table(spark, pairs):
    return spark.createDataFrame(pairs, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as score", "2 as v")


@pytest.mark.parametrize("tile", [16, 4096])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(I, "TILE", tile)
    monkeypatch.setattr(I, "QUERY_BLOCK", 4)
    r = random.Random(tile)
    pairs = [(i, [r.gauss(0, r.choice([0.1, 1, 4])) for _ in range(12)]) for i in range(300)]
    pairs += [(400 + i, pairs[10][1]) for i in range(60)]  # many ties
    got = rows(I.top_products(table(spark, pairs), 20), "query_id", "rank", "vec_id", "score")
    assert got == brute(pairs, 20, 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    pairs = [
        (0, [1.0, 2.0]), (50, [0.0, 0.0]), (100, []), (150, [1.0, None]), (200, [nan, 1.0]), (250, [inf, 1.0]),
        (300, None), (None, [9.0, 9.0]), (1, [0.5, -0.001]), (2, [0.5, -0.001]), (2, [0.5, -0.001]), (3, [-1.0, 4.0, 7.0]),
    ]
    got = rows(I.top_products(table(spark, pairs)), "query_id", "rank", "vec_id", "score")
    assert got == brute(pairs, 50, 5)
    assert {g[0] for g in got} == {0, 50, 100}


@pytest.mark.parametrize("pairs", [[], [(1, [1.0])], [(50, None)], [(0, [])], [(0, [1.0, 2.0])]])
def test_few_rows(spark, pairs):
    assert rows(I.top_products(table(spark, pairs)), "query_id", "rank", "vec_id", "score") == brute(pairs, 50, 5)


def test_scores_beyond_long_are_refused(spark):
    big = float(2**24)
    near = [(0, [big] * 4), (1, [big, 1.0, 0.0, -big])]
    assert rows(I.top_products(table(spark, near), scale=16), "query_id", "rank", "vec_id", "score") == [
        (0, 1, 1, 16 * 16 * int(big))
    ]
    for x in (2.0**40, 1e30):
        with pytest.raises(ValueError, match="2\\^63"):
            I.top_products(table(spark, [(0, [x, 1.0]), (1, [1.0, 1.0])]))
