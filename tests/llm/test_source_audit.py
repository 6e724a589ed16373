import random
import re
from collections import Counter, defaultdict

from filetrail.llm import source_audit as A
from tests.llm.util import rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, top):
    found = defaultdict(list)
    for lang, source, text in docs:
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        found[lang or "", source or ""].append(Counter(terms))
    out = []
    for lang in {g[0] for g in found}:
        groups = {s: c for (g, s), c in found.items() if g == lang}
        docs_of = Counter(t for c in groups.values() for d in c for t in d)
        kept = [t for t, n in docs_of.items() if n >= least]
        total = {s: sum((d for d in c), Counter()) for s, c in groups.items()}
        whole = sum(total.values(), Counter())

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in total.items()}, shares(whole)
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            own = [(t, p[s][t] - q[t]) for t in kept if total[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", own, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:limit], 1)]
    return sorted(out)


def table(spark, docs):
    return spark.createDataFrame(docs, "lang string, source string, text string")


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def test_terms():
    text = "Ab ab,AB1cÉé\x85x\xa0y 漢字-が_\x7f[z]`q{w}\x00Ⅷ"
    assert A.document_terms(text) == Counter(t.translate(LOWER).encode() for t in TERM.findall(text))
    long = "word, Word\n" * 5000
    assert A.document_terms(long, piece=7) == A.document_terms(long) == Counter({b"word": 10_000})
    assert A.document_terms(None) == A.document_terms("") == Counter()


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    words = ["été", "Zoo", "a", "bb", "ccc", "漢字", "x1y", "Über", "z", "q", "tie", "toe"]
    docs = []
    for _ in range(400):
        source = r.choices(["s1", "s2", "s3", "", None, "S1", "only"], [9, 3, 3, 1, 1, 2, 1])[0]
        lang = r.choice(["en", "en", "en", "de", "", None])
        docs.append((lang, source, r.choice([" ", ",\n"]).join(r.choices(words[: r.randint(2, 12)], k=r.randint(0, 25)))))
    docs += [("fr", "s1", "rare words"), ("fr", "s2", None), ("fr", "s3", ""), ("es", "alone", "x")]
    want = brute(docs, 8, 3)
    assert {w[2] for w in want} == {"pair", "term"}
    df = table(spark, docs)
    assert rows(A.audit_sources(df, 8, 3), *COLUMNS) == sorted(want)
    # Several blocks of sources and chunks of terms, tallies sent in the middle of a task.
    assert rows(A.audit_sources(df, 8, 3, block=2, chunk=3), *COLUMNS) == sorted(want)
    assert rows(A.term_counts(df, held=3), "lang", "source", "term", "n", "docs") == rows(
        A.term_counts(df), "lang", "source", "term", "n", "docs")


def test_groups_without_terms_and_ties(spark):
    docs = [("en", s, None) for s in ("b", "a", "c")]
    assert rows(A.audit_sources(table(spark, docs)), *COLUMNS) == sorted(brute(docs, 30, 50))
    assert A.audit_sources(table(spark, docs[:1])).count() == 0, "no other source, no term"


def test_exact_beyond_floats(spark):
    n = A._share.__globals__["F"]
    df = spark.createDataFrame([(9_000_000_000_000_000, 9_100_000_000_000_001, 12_345_678)], "n long, total long, v long")
    got = df.select(A._share(n.col("n"), "total", "v")).first()[0]
    assert got == 1 + 10**9 * (9_000_000_000_000_000 + 5) // (9_100_000_000_000_001 + 5 * 12_345_678)


def test_empty_table_and_clashing_names(spark):
    assert A.audit_sources(table(spark, [])).count() == 0
    docs = [("en", "ab"[i % 2], "one two three" if i % 3 else "two") for i in range(60)]
    df = table(spark, docs)
    clashing = df.selectExpr("*", *(f"'x' as `{c}`" for c in ("term", "n", "docs", "block", "share", "value", "rank", "item", "part")))
    assert rows(A.audit_sources(clashing, 5), *COLUMNS) == sorted(brute(docs, 5, 50))
