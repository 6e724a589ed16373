import random

import numpy as np
import pytest

from filetrail.llm import resample as R
from tests.llm.util import docs, rows


def corpus(n, seed=0):
    """Prose, and junk of marks or of repeated words; labels say which is which."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices(["ta", "no", "ri", "se", "lu"], k=r.randint(1, 4))) for _ in range(200)]
    pairs, labels = [], []
    for d in range(n):
        w = r.choices(vocabulary, k=r.randint(5, 80))
        good = d % 5 > 0
        if not good:
            w = [x + r.choice(["***", "%%%"]) for x in w] if d % 2 else w[:2] * len(w)
        pairs.append((d, " ".join(w).capitalize() + "."))
        labels.append((d, int(good), 0))
    return pairs, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_keeps_prose_and_rejects_junk(spark):
    pairs, labels = corpus(600)
    out = R.resample(docs(spark, pairs), label_table(spark, labels[:400]))
    kept = {r["doc_id"] for r in out.collect()}
    good = {d for d, q, _ in labels if q}
    assert len(good - kept) <= 0.01 * len(good)
    assert len(kept - good) <= 0.03 * (len(pairs) - len(good))
    again = R.resample(docs(spark, pairs), label_table(spark, labels[:400]))
    assert {r["doc_id"] for r in again.collect()} == kept


def test_weights_against_brute_force(spark):
    pairs, labels = corpus(40)
    buckets, target = 256, {d for d, q, _ in labels if q}
    grams = R.Grams(buckets)
    each = [[b for bucket, _ in grams([t]) for b in bucket.tolist()] for _, t in pairs]
    raw, good = np.zeros(2 * buckets), np.zeros(2 * buckets)
    for (d, _), g in zip(pairs, each, strict=True):
        np.add.at(raw, g, 1)
        if d in target:
            np.add.at(good, g, 1)
    ratios = R.log_ratios(raw, good, buckets)
    out = R.resample(docs(spark, pairs), label_table(spark, labels), k=40, buckets=buckets)
    got = {r["doc_id"]: r["log_weight"] for r in out.collect()}
    assert got == pytest.approx({d: ratios[g].sum() for (d, _), g in zip(pairs, each, strict=True)})


def test_floor_and_draw_against_brute_force(spark):
    """Held-out good documents are not counted, set the floor, and the keys decide."""
    pairs, labels = corpus(400)
    buckets, good = 256, [d for d, q, _ in labels if q]
    ids = spark.createDataFrame([(d,) for d in good], "doc_id bigint")
    held = {r[0] for r in ids.where(R.held_out()).collect()}
    assert 0.15 * len(good) < len(held) < 0.35 * len(good)
    grams = R.Grams(buckets)
    each = [[b for bucket, _ in grams([t]) for b in bucket.tolist()] for _, t in pairs]
    raw, target = np.zeros(2 * buckets), np.zeros(2 * buckets)
    for (d, _), g in zip(pairs, each, strict=True):
        np.add.at(raw, g, 1)
        if d in set(good) - held:
            np.add.at(target, g, 1)
    ratios = R.log_ratios(raw, target, buckets)
    weight = {d: ratios[g].sum() for (d, _), g in zip(pairs, each, strict=True)}
    tempered = {d: weight[d] * R.EVIDENCE / (len(g) + R.EVIDENCE) for (d, _), g in zip(pairs, each, strict=True)}
    floor = min(-R.MARGIN * R.EVIDENCE, np.nextafter(min(tempered[d] for d in held), -np.inf))
    k = sum(t > floor for t in tempered.values())
    out = R.resample(docs(spark, pairs), label_table(spark, labels), buckets=buckets).collect()
    assert len(out) == k
    assert {r["doc_id"]: r["log_weight"] for r in out} == pytest.approx(
        {r["doc_id"]: weight[r["doc_id"]] for r in out}
    )
    noise = {r["doc_id"]: r["gumbel_key"] - tempered[r["doc_id"]] for r in out}
    assert -3 < min(noise.values()) and 0.3 < np.mean(list(noise.values())) < 0.9
    lowest = min(r["gumbel_key"] for r in out)
    left = set(weight) - set(noise)
    assert all(tempered[d] < lowest + 3 for d in left)


def test_an_odd_part_does_not_reject_prose(spark):
    """A number or a key outweighs a short text's n-grams but not its share of them."""
    pairs, labels = corpus(600)
    odd = [(5000 + d, t + " +33 6 12 34 56 78") for d, t in pairs if d % 5 and len(t.split()) > 15]
    out = R.resample(docs(spark, pairs + odd), label_table(spark, labels[:400]))
    kept = {r["doc_id"] for r in out.collect()}
    assert {d for d, _ in odd} <= kept


def test_shapes():
    assert len({R.shape(w) for w in ("Word", "WORD", "word", "word!!", "1234", "wörd.")}) == 6
    assert R.shape("aaaaaaaa") == R.shape("bbbbbbbb")


@pytest.mark.parametrize("k", [0, 1, 3, 17, 50, 99])
def test_kth_largest(spark, k):
    r = random.Random(k)
    values = [r.choice([r.gauss(0, 1), r.gauss(0, 1e9), 5.0, 5.0 + 1e-12]) for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = None if k == 0 else sorted(values)[-min(k, 50)]
    assert R.kth_largest(df, "x", k) == want


def test_sample_follows_the_weights(spark):
    """Without a clear difference the noise decides, so half of equal rows are drawn."""
    pairs = [(d, f"same words here {d % 2}") for d in range(400)]
    out = R.resample(docs(spark, pairs), label_table(spark, []), k=200)
    kept = [r["doc_id"] for r in out.collect()]
    assert len(kept) == 200 and 60 < sum(d % 2 for d in kept) < 140


def test_nulls_ties_columns_and_empty_tables(spark):
    pairs, labels = corpus(60)
    odd = [(1000, None), (1001, ""), (None, "tano rise."), (1002, "tano " * 50_000), (7, pairs[7][1]), (7, pairs[7][1])]
    df = docs(spark, pairs + odd, "log_weight gumbel_key chosen")
    bad = [(None, 1, 0), (5, None, 0), (6, 1, 1), (6, 0, 1)]
    out = R.resample(df, label_table(spark, labels + bad))
    assert out.columns == ["doc_id", "text", "chosen", "log_weight", "gumbel_key"]
    got = rows(out, "doc_id")
    assert got.count((7,)) in (0, 3)
    assert {(1000,), (1001,)} <= set(got) and (1002,) not in got
    assert R.resample(docs(spark, []), label_table(spark, labels)).count() == 0
    assert R.resample(docs(spark, pairs), label_table(spark, [])).count() == 60
