"""Source divergence audit: how far the words of a source are from those of its language.

A translate table lowers letters and blanks separators of the text's bytes in one pass;
what split() leaves are the terms, and a Counter of each document gives its frequencies.
Tasks add these up by (lang, source) and send sparse rows only: no row for a term that a
source doesn't have. Terms absent from a source enter the sums by arithmetic.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetrail.llm.store import cut, ship

MIN_DOCUMENTS = 30
#: Added to every count, so that no share is zero.
PSEUDO = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Bytes of a text that are split at a time, and tallied terms a task holds before it sends them.
PIECE = 1 << 20
HELD = 200_000
#: Sources of a block and terms of a chunk: two blocks by a chunk is what a task compares at once.
SOURCES = 256
TERMS = 1_024

TALLY = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                   ("n", pa.int64()), ("docs", pa.int64())])


def _term_bytes() -> bytes:
    """A-Z lowered; other ASCII but a-z blank; the bytes of all other characters as they are."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for i in range(26):
        table[ord("A") + i] = table[ord("a") + i] = ord("a") + i
    return bytes(table)


_TABLE = _term_bytes()


def document_terms(text: str | None, piece: int = PIECE) -> Counter[bytes]:
    """Occurrences of each term of a text; long texts are split piece by piece."""
    data, found, at = (text or "").encode().translate(_TABLE), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


def _sent(held: dict) -> pa.RecordBatch:
    rows = [
        (lang, source, term.decode(), n, docs[term])
        for (lang, source), (counts, docs) in held.items() for term, n in counts.items()
    ]
    columns = list(zip(*rows, strict=True)) or [[]] * len(TALLY)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, TALLY, strict=True)], TALLY)


def _tally(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    held, size = defaultdict(lambda: (defaultdict(int), Counter())), 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts, docs = held[lang, source]
            before = len(counts)
            counts[b""] += 0  # the group occurs, with or without terms
            document = document_terms(text)
            for term, n in document.items():
                counts[term] += n
            docs.update(document.keys())
            size += len(counts) - before
            if size >= most:
                yield _sent(held)
                held.clear()
                size = 0
    yield _sent(held)


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term of a source.

    The empty term stands for the group itself: ``n`` and ``docs`` are 0. Null lang, source
    and text are empty. Every row is a document, rows with the same doc_id too.
    """
    ship(docs.sparkSession)
    names = ("lang", "source", "text")
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names))
    tallied = texts.mapInArrow(
        lambda it: _tally(it, held), "lang string, source string, term string, n long, docs long"
    )
    return tallied.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + PSEUDO) / (total + PSEUDO * terms)), exact; 1 without terms."""
    big = "decimal(19,0)"
    over = (F.lit(SCALE).cast("decimal(10,0)") * (n + PSEUDO).cast(big))
    under = (F.col(total) + PSEUDO * F.col(terms)).cast(big)
    whole = F.call_function("div", over, under)
    return F.when(F.col(terms) > 0, 1 + whole).otherwise(F.lit(1).cast("long"))


def _distances(key: tuple, rows: pa.Table) -> pa.Table:
    """Part of the distance of each pair of sources from the terms of one chunk.

    A term that neither has counts as the distance of their floors, so that much for all
    terms is taken once (in chunk 0), and the terms at hand add what they differ from it.
    Rows without a term name the sources.
    """
    lang, i, j, chunk = (k.as_py() for k in key)
    source = rows["source"].to_numpy()
    names, first, which = np.unique(source.astype(str), return_index=True, return_inverse=True)
    blocks, floors = (rows[c].to_numpy()[first] for c in ("block", "floor"))
    total = rows["terms"][0].as_py()
    term = rows["term"].to_numpy().astype(str)
    here = np.flatnonzero(term != "")
    terms, at = np.unique(term[here], return_inverse=True)
    shares = np.repeat(floors[:, None], len(terms), axis=1)
    shares[which[here], at] = rows["share"].to_numpy()[here].astype(np.int64)
    a, b, part = [], [], []
    for s in np.flatnonzero(blocks == i):
        others = np.flatnonzero(blocks == j)
        others = others[others > s] if i == j else others
        base = np.abs(floors[others] - floors[s])
        own = np.abs(shares[others] - shares[s]).sum(axis=1) - base * len(terms)
        part += (own + base * total if chunk == 0 else own).tolist()
        a += [source[first[s]]] * len(others)
        b += source[first[others]].tolist()
    return pa.table([pa.array(x, t) for x, t in (([lang] * len(a), pa.string()), (a, pa.string()),
                                                 (b, pa.string()), (part, pa.int64()))],
                    names=["lang", "a", "b", "part"])


def audit_sources(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, block: int = SOURCES,
    chunk: int = TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets each source apart.

    A language keeps the terms that are in ``min_documents`` of its documents or more. Each
    (lang, source) and each language gives every kept term a share: 1 + floor(10^9 * (count
    + 5) / (N + 5 * V)), N the occurrences of kept terms there and V their number. Part
    ``pair`` has the summed differences to each other source of the language, part ``term``
    the ``top`` terms that the source has more of than its language, by difference. Ranks
    begin at 1; of equal values the smaller item in UTF-8 order comes first.

    Null lang, source and text are empty texts and a group like any other. Every row counts
    as a document, repeated rows too. A group without terms has pairs (value 0 where its
    language keeps no term) and no terms. An empty table gives none. Columns other than the
    three read don't matter.
    """
    counts = cut(term_counts(docs), "term-counts")
    terms = counts.where("term != ''").groupBy("lang", "term").agg(
        F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")
    )
    terms = cut(terms.where(F.col("docs") >= min_documents).drop("docs"), "kept-terms")
    kept = cut(counts.drop("docs").join(terms, ["lang", "term"]), "kept-counts")

    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = terms.groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count("*").alias("terms"))
    groups = counts.where("term = ''").select("lang", "source")
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / block).alias("blocks"))
    groups = groups.join(sums, ["lang", "source"], "left").join(by_lang, "lang", "left").join(sizes, "lang")
    groups = groups.na.fill(0, ["total", "total_lang", "terms"])
    groups = cut(groups.withColumns({
        "block": F.pmod(F.xxhash64("source"), "blocks"),
        "chunks": F.greatest(F.ceil(F.col("terms") / chunk), F.lit(1)),
        "floor": _share(F.lit(0).cast("long"), "total", "terms"),
    }), "groups")

    scored = kept.join(groups, ["lang", "source"]).withColumns({
        "share": _share(F.col("n"), "total", "terms"),
        "chunk": F.pmod(F.xxhash64("term"), "chunks"),
    })
    over = scored.withColumn("value", F.col("share") - _share(F.col("n_lang"), "total_lang", "terms"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top_terms = (
        over.where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    )

    columns = ["lang", "source", "block", "blocks", "chunk", "floor", "terms", "term", "share"]
    # Every chunk has every source, for a source may lack all of its terms.
    alone = groups.withColumns({
        "chunk": F.explode(F.expr("sequence(0L, chunks - 1)")), "term": F.lit(""), "share": F.lit(None).cast("long"),
    })
    met = scored.select(*columns).unionAll(alone.select(*columns)).withColumn("other", F.explode(F.expr(
        "transform(sequence(0L, blocks - 1), o -> struct(least(block, o) as i, greatest(block, o) as j))"
    )))
    parts = met.select("*", "other.i", "other.j").drop("other", "blocks").groupBy("lang", "i", "j", "chunk")
    parts = parts.applyInArrow(_distances, "lang string, a string, b string, part long")
    pairs = cut(parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value")), "source-pairs")
    both = [
        pairs.select("lang", F.col(x).alias("source"), F.lit("pair").alias("part"), F.col(y).alias("item"), "value")
        for x, y in ("ab", "ba")
    ]
    ranked = both[0].unionAll(both[1]).withColumn("rank", F.row_number().over(best))
    return ranked.unionAll(top_terms)
