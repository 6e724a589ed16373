import random

from pyspark.sql import functions as F

from filetrail.functions import urls as U
from filetrail.operators.domains import add_domains, domain_lookup, fits_literal
from filetrail.schemas import SUFFIX_RULES
from tests.util import apply, column

RULES = [("com", "normal"), ("org", "normal"), ("net", "normal"), ("uk", "normal"),
         ("co.uk", "normal"), ("*.ck", "wildcard"), ("www.ck", "exception")]

# url -> fields that are not NULL (besides full)
CASES = {
    "https://user:pw@sub.example.co.uk:8443/a/b.tar.gz?x=1&y=2#frag": dict(
        scheme="https", username="user", password="pw", domain="sub.example.co.uk", port=8443,
        path="/a/b.tar.gz", extension="gz", query="x=1&y=2", fragment="frag"),
    "http://example.com": dict(scheme="http", domain="example.com"),
    "HTTP://example.com/a%20b": dict(scheme="http", domain="example.com", path="/a b"),
    "http://my_host:80/a": dict(scheme="http", domain="my_host", port=80, path="/a"),
    "http://h/x.d/noext": dict(scheme="http", domain="h", path="/x.d/noext",
                               extension="d/noext"),
    "http://a b/%zz": {},
    "http://h/%zz": {},
    "http://h/a b": dict(scheme="http", domain="h", path="/a b"),
    "http://h/a+b%2Bc": dict(scheme="http", domain="h", path="/a+b+c"),
    "http://h/#a%2": {},
    "http://h/?a%2": dict(scheme="http", domain="h", path="/", query="a%2"),
    "http://h:": dict(scheme="http", domain="h"),
    "http://h:8a/": {},
    "http://a:b:80/x": dict(scheme="http", path="/x"),
    "http://h:99999999999/": dict(scheme="http", domain="h", path="/"),
    "http://[::1]:80/x": dict(scheme="http", domain="::1", port=80, path="/x"),
    "http://[::1]/x": dict(scheme="http", path="/x"),
    "http://[::1/x": {},
    "http://a@b@h/": dict(scheme="http", username="a@b", domain="h", path="/"),
    "http://u%40x:p%3Aw@h": dict(scheme="http", username="u@x", password="p:w", domain="h"),
    "http://u r@h/": {},
    "mailto:a@b.c?subject=x": dict(scheme="mailto", query="subject=x"),
    "mailto:a%zz": dict(scheme="mailto"),
    "//h/x.js": dict(domain="h", path="/x.js", extension="js"),
    "///h/x": dict(path="///h/x"),
    "file:///etc/passwd": dict(scheme="file", path="/etc/passwd"),
    "rel/a:b": dict(path="rel/a:b"),
    "rel:b/c": dict(scheme="rel"),
    "1rel:b": {},
    ":x": {},
    "a?b?c#d#e": dict(path="a", query="b?c", fragment="d#e"),
    "http://h/a\tb": {},
    "http://h/\u0001x": {},
    "http://h^x/": {},
    "http://h%41/": {},
    "http://bücher.example/ü": dict(scheme="http", domain="bücher.example",
                                              path="/ü"),
    "/p.": dict(path="/p."),
    "http:": dict(scheme="http"),
}


def fields(row):
    return {k: v for k, v in row.asDict().items() if v is not None and k != "full"}


def test_url_fields(spark):
    urls = list(CASES)
    rows = apply(spark, urls, U.url_info)
    for url, row in zip(urls, rows):
        assert row["full"] == url
        assert fields(row) == CASES[url], url
    assert apply(spark, ["", None], U.url_info) == [None, None]


def test_url_column_form_agrees(spark):
    df = column(spark, [*CASES, "", None], name="url")
    both = U.with_url_info(df, "url", "u").withColumn("v", U.url_info(F.col("url")))
    assert both.where(~F.col("u").eqNullSafe(F.col("v"))).count() == 0


def test_long_urls_do_not_overflow(spark):
    long = ["http://h/" + "a%20" * 20_000, "http://h/" + "x" * 100_000,
            "http://h/" + "%zz" * 20_000, "http://" + "a@" * 20_000 + "h/"]
    rows = apply(spark, long, U.url_info)
    assert rows[0]["path"] == "/" + "a " * 20_000
    assert rows[1]["path"] == "/" + "x" * 100_000
    assert rows[2]["scheme"] is None
    assert rows[3]["domain"] == "h"


def expected_domains(domain, rules):
    """Straight reading of the public-suffix algorithm."""
    labels = domain.split(".")
    found = []
    for rule, kind in rules:
        parts = rule.split(".")
        tail = labels[-len(parts):]
        if len(tail) == len(parts) and all(r in ("*", t) for r, t in zip(parts, tail)):
            found.append((kind == "exception", len(parts) - (kind == "exception")))
    n = max(found)[1] if found else 1
    suffix = ".".join(labels[-n:])
    blank = "" in labels
    registered = ".".join(labels[-n - 1:]) if len(labels) > n and not blank else None
    return registered or None, suffix or None


def domains_of(spark, hosts, rules):
    df = column(spark, [f"http://{h}/" for h in hosts], name="url")
    rules = spark.createDataFrame(rules, SUFFIX_RULES)
    filled = add_domains(U.with_url_info(df, "url", "u"), "u", rules)
    tabs = F.array(F.struct(F.lit("t").alias("title"), F.col("url").alias("url")))
    both = filled.withColumn("t", U.tab_list(tabs, domain_lookup(rules))[0]["url"])
    rows = both.orderBy("i").select("u", "t").collect()
    assert all(r["u"] == r["t"] for r in rows)  # joined and literal rules agree
    joined = add_domains(U.with_url_info(df, "url", "u"), "u", rules, rule_bytes=0)
    assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
    assert [r["u"] for r in joined.orderBy("i").select("u").collect()] == [r["u"] for r in rows]
    return [(r["u"]["registered_domain"], r["u"]["top_level_domain"]) for r in rows]


def test_known_domains(spark):
    known = {
        "sub.example.co.uk": ("example.co.uk", "co.uk"), "example.com": ("example.com", "com"),
        "com": (None, "com"), "co.uk": (None, "co.uk"), "foo.ck": (None, "foo.ck"),
        "a.foo.ck": ("a.foo.ck", "foo.ck"), "www.ck": ("www.ck", "ck"),
        "x.www.ck": ("www.ck", "ck"), "ck": (None, "ck"), "a.b.zz": ("b.zz", "zz"),
        "10.0.0.1": ("0.1", "1"), "EXAMPLE.COM": ("EXAMPLE.COM", "COM"),
        "a..com": (None, "com"), "a.com.": (None, None), ".com": (None, "com"),
    }
    assert domains_of(spark, list(known), RULES) == list(known.values())


def test_random_domains_against_brute_force(spark):
    rng = random.Random(7)
    words = ["a", "b", "c", "d"]

    def name(n):
        return ".".join(rng.choice(words) for _ in range(rng.randint(1, n)))

    rules = {}
    for _ in range(25):
        base = name(3)
        rules[base] = "normal"
        if rng.random() < 0.4:
            rules["*." + base] = "wildcard"
            rules[rng.choice(words) + "." + base] = "exception"
    rules = list(rules.items())
    hosts = [name(5) for _ in range(300)]
    assert domains_of(spark, hosts, rules) == [expected_domains(h, rules) for h in hosts]


def test_events_do_not_move_for_domains(spark):
    df = column(spark, ["http://a.com/"], name="url")
    rules = spark.createDataFrame(RULES, SUFFIX_RULES)
    plan = add_domains(U.with_url_info(df, "url", "u"), "u", rules)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Join" not in text


def test_a_long_rule_list(spark):
    """60,000 rules for events and tabs alike; the cost of a lookup doesn't grow."""
    made = spark.range(60_000).selectExpr("concat('zone', id, '.com') as rule", "'normal' as kind")
    rules = spark.createDataFrame(RULES, SUFFIX_RULES).unionByName(made)
    df = column(spark, ["http://a.b.zone59999.com/x", "http://q.co.uk", "http://w.zone60000.com"], name="url")
    df = add_domains(U.with_url_info(df, "url", "u"), "u", rules)
    found = df.orderBy("i").select("u.registered_domain", "u.top_level_domain").collect()
    assert [tuple(r) for r in found] == [
        ("b.zone59999.com", "zone59999.com"), ("q.co.uk", "co.uk"), ("zone60000.com", "com"),
    ]
    tabs = F.array(F.struct(F.lit("t").alias("title"), F.col("url").alias("url")))
    tab = U.tab_list(tabs, domain_lookup(rules))[0]["url"]["registered_domain"]
    assert df.orderBy("i").select(tab).collect()[0][0] == "b.zone59999.com"


def test_two_million_rules_stay_in_their_table(spark):
    made = spark.range(2_000_000).selectExpr("concat('zone', id, '.com') as rule", "'normal' as kind")
    rules = spark.createDataFrame(RULES, SUFFIX_RULES).unionByName(made)
    assert not fits_literal(rules) and fits_literal(spark.createDataFrame(RULES, SUFFIX_RULES))
    urls = ["http://a.b.zone1999999.com/x", "http://q.co.uk", "http://w.zone2000000.com", None, "not a url", "http://www.ck"]
    df = column(spark, urls * 50, name="url")
    found = add_domains(U.with_url_info(df, "url", "u"), "u", rules)
    rows = [tuple(r) for r in found.orderBy("i").select("u.registered_domain", "u.top_level_domain").collect()]
    assert len(rows) == 300 and rows[:6] == rows[294:] and rows[:4] == [
        ("b.zone1999999.com", "zone1999999.com"), ("q.co.uk", "co.uk"), ("zone2000000.com", "com"), (None, None)]
    assert rows[5] == ("www.ck", "ck")
