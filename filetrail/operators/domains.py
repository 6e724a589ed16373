"""Public suffix and registered domain of host names.

A rule table has rows ``(rule, kind)`` with kind normal, wildcard (``*.ck``) or
exception (``www.ck``). Rules are keyed by their base, the text without ``*.``, so
a host needs one equality lookup per label count: with ``d`` labels a normal rule
makes the suffix d labels long, a wildcard d+1, an exception d-1. Exceptions win,
then the longest suffix; without a match the last label is the suffix.

Lists of up to ``RULE_BYTES``, which public lists are far below, become a literal array of
small maps in the plan: no event moves and nothing is joined, and a lookup computes the
map's place from a hash of the text, so its cost doesn't grow with the list. It works inside
array columns as well. ``add_domains`` resolves by a longer list with a join: the suffixes
of the distinct hosts meet the rules, and what they give joins the events by host.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from filetrail.functions.fields import omit_empty
from filetrail.operators.geo import spread

NORMAL, WILDCARD, EXCEPTION = 1, 2, 4
#: Rules of more bytes stay in their table.
RULE_BYTES = 16 << 20


def rules_by_base(rules: DataFrame) -> DataFrame:
    """(base, depth, flags): one row per rule base, with its kinds as a bit set."""
    flag = (
        F.when(F.col("kind") == "wildcard", WILDCARD)
        .when(F.col("kind") == "exception", EXCEPTION)
        .otherwise(NORMAL)
    )
    return (
        rules.select(F.regexp_replace("rule", r"^\*\.", "").alias("base"), flag.alias("flag"))
        .groupBy("base")
        .agg(F.bit_or("flag").cast("int").alias("flags"))
        .withColumn("depth", label_count(F.col("base")))
    )


def label_count(domain: Column) -> Column:
    return F.length(domain) - F.length(F.replace(domain, F.lit("."))) + 1


def last_labels(domain: Column, n: int | Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.call_function("substring_index", domain, F.lit("."), -n)


def _suffix_labels(labels: Column, flags: dict[int, Column]) -> Column:
    """Length of the public suffix in labels, from the rule flags at each depth."""
    exception, lengths = [], [F.lit(1)]
    for d, f in sorted(flags.items(), reverse=True):
        exception.append(F.when(f.bitwiseAND(EXCEPTION) != 0, d - 1))
        lengths.append(F.when((f.bitwiseAND(WILDCARD) != 0) & (labels > d), d + 1))
        lengths.append(F.when(f.bitwiseAND(NORMAL) != 0, d))
    return F.coalesce(*exception, F.greatest(*lengths))


def _domain_pair(domain: Column, n: Column) -> tuple[Column, Column]:
    """(registered domain, public suffix) given the suffix length."""
    blank_label = domain.startswith(".") | domain.endswith(".") | domain.contains("..")
    registered = F.when(~blank_label & (label_count(domain) > n), last_labels(domain, n + 1))
    return registered, omit_empty(last_labels(domain, n))


def collect_rules(rules: DataFrame) -> list[Row]:
    """The rules by base as driver rows, each with the hash that says where it is kept."""
    return rules_by_base(rules).withColumn("hash", F.xxhash64("base")).collect()


def domain_lookup(rules: DataFrame,
                  rows: list[Row] | None = None) -> Callable[[Column], tuple[Column, Column]]:
    """``domain -> (registered, suffix)`` as expressions, also for use inside array lambdas.

    ``rows`` is the result of :func:`collect_rules`, if the caller has it already.
    """
    rows = collect_rules(rules) if rows is None else rows
    places = max(1, len(rows))
    kept: list[dict[str, int]] = [{} for _ in range(places)]
    for r in rows:
        kept[r["hash"] % places][r["base"]] = r["flags"]
    literal = F.from_json(F.lit(json.dumps(kept)), "array<map<string,int>>")
    depths = range(1, max((r["depth"] for r in rows), default=0) + 1)

    def flags_of(text: Column) -> Column:
        place = F.pmod(F.xxhash64(text), F.lit(places)).cast("int")
        return F.try_element_at(F.get(literal, place), text)

    def lookup(domain: Column) -> tuple[Column, Column]:
        flags = {
            d: F.when(label_count(domain) >= d, flags_of(last_labels(domain, d))) for d in depths
        }
        n = F.array(_suffix_labels(label_count(domain), flags))
        pairs = F.transform(n, lambda n: F.array(*_domain_pair(domain, n)))
        pair = F.get(pairs, F.lit(0))
        return F.get(pair, F.lit(0)), F.get(pair, F.lit(1))

    return lookup


def fits_literal(rules: DataFrame, max_bytes: int = RULE_BYTES) -> bool:
    """True when the rules take at most about ``max_bytes`` in a plan; they are counted."""
    size = rules.agg(F.sum(F.octet_length("rule") + 16)).first()[0]
    return (size or 0) <= max_bytes


def resolve_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, registered, suffix`` of distinct ``host`` texts, by a join with the rules.

    Each host makes a row for every suffix of its that can be a rule, so a list of any
    length is joined on equality; the longest match is a partial maximum.
    """
    bases = rules_by_base(rules)
    deepest = bases.agg(F.max("depth")).first()[0] or 0
    host = F.col("host")
    known = hosts.select(host).where(host.isNotNull()).distinct()
    labels = label_count(host)
    levels = F.sequence(F.lit(1), F.least(labels, F.lit(max(1, deepest))))
    cut = known.withColumn("depth", F.explode(levels)).withColumn("base", last_labels(host, F.col("depth")))
    met = cut.join(bases.select("base", "flags"), "base")
    flags, depth = F.col("flags"), F.col("depth")
    length = F.greatest(
        F.when((flags.bitwiseAND(WILDCARD) != 0) & (labels > depth), depth + 1),
        F.when(flags.bitwiseAND(NORMAL) != 0, depth),
    )
    found = met.groupBy("host").agg(
        F.max(F.when(flags.bitwiseAND(EXCEPTION) != 0, depth - 1)).alias("exception"),
        F.max(length).alias("length"),
    )
    n = F.coalesce("exception", F.greatest(F.lit(1), "length"))
    registered, suffix = _domain_pair(host, n)
    every = known.join(found, "host", "left")
    return every.select("host", registered.alias("registered"), suffix.alias("suffix"))


def add_domains(df: DataFrame, url_col: str, rules: DataFrame, rows: list[Row] | None = None,
                rule_bytes: int = RULE_BYTES) -> DataFrame:
    """Fill ``registered_domain`` and ``top_level_domain`` of a URL struct column.

    With more than ``rule_bytes`` of rules the events are joined with their hosts; rows
    without a host keep their place by a salt, and adaptive execution splits a busy host.
    """
    found = df.withColumn("_domain", F.col(url_col)["domain"])
    if rows is not None or fits_literal(rules, rule_bytes):
        registered, suffix = domain_lookup(rules, rows)(F.col("_domain"))
        found = found.withColumn("_pair", F.array(registered, suffix))
    else:
        pairs = resolve_hosts(found.select(F.col("_domain").alias("host")), rules)
        pairs = pairs.select(
            F.col("host").alias("_host"), F.lit(0).alias("_match"), F.array("registered", "suffix").alias("_pair")
        )
        salted = found.withColumn("_salt", spread(F.col("_domain"), F.struct(F.col(url_col))))
        both = (F.col("_domain") == F.col("_host")) & (F.col("_salt") == F.col("_match"))
        found = salted.join(pairs, both, "left").drop("_host", "_match", "_salt")
    filled = F.col(url_col).withField("registered_domain", F.get("_pair", F.lit(0)))
    filled = filled.withField("top_level_domain", F.get("_pair", F.lit(1)))
    return found.withColumn(url_col, filled).drop("_domain", "_pair")
