"""Registered queries of the pipeline operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetrail.llm import (
    decontaminate,
    extract,
    inner_product,
    line_dedup,
    pieces,
    resample,
    sharding,
    simhash,
    source_audit,
    spelling,
    store,
    token_files,
    toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_sql(docs: str) -> str:
    """A CTE list ending in ``deduped``: doc_id, kept text, n_lines, n_dropped."""
    return f"""split as (
        select doc_id, string_split(coalesce(text, ''), chr(10)) as l from {docs}),
    lines as (
        select doc_id, unnest(l) as line, unnest(range(len(l))) as pos from split),
    keyed as (
        select doc_id, pos, line, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') as key from lines),
    many as (
        select key, max(doc_id) as keeper from keyed where length(key) >= {line_dedup.MIN_CHARS}
        group by key having count(distinct doc_id) >= {line_dedup.MIN_DOCUMENTS}),
    marked as (
        select doc_id, pos, line, many.key is not null and doc_id <> keeper as gone
        from keyed left join many using (key)),
    deduped as (
        select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text,
            count(*) as n_lines, count(*) filter (gone) as n_dropped
        from marked group by doc_id)"""


@query(f"with {lines_sql('documents')} select doc_id, n_lines, n_dropped, sha256(text) as kept_sha256 from deduped")
def op1_line_dedup(spark, sf_dir):
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op2_simhash_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


@query(
    "with p as (select page_id, coalesce(html, '') as html from pages), d as (select page_id, "
    "octet_length(encode(html)) as payload_bytes, sha256(html) as payload_digest from p), "
    "f as (select *, min(page_id) over (partition by payload_digest) as first from d) "
    "select page_id, payload_bytes, payload_digest, case when payload_bytes >= "
    f"{warc.MIN_REVISIT} and first <> page_id then 'revisit' else 'response' end as record_type, "
    f"case when payload_bytes >= {warc.MIN_REVISIT} and first <> page_id then first end as refers_to from f"
)
def op3_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def words_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def hits_sql(docs: str) -> str:
    """A CTE list ending in ``found``: the digest columns of contamination by document."""
    n = decontaminate.WORDS

    def windows(words, size):
        return f"list_transform(range(greatest(len({words}) - {size} + 1, 0)), lambda i: array_to_string({words}[i + 1:i + {size}], ' '))"

    return f"""items as (select item_id, {words_sql('text')} as w from benchmark),
    patterns as (
        select distinct item_id, least(len(w), {n}) as size, unnest({windows('w', f'least(len(w), {n})')}) as win
        from items where len(w) > 0),
    docwords as (select doc_id, {words_sql('text')} as w from {docs}),
    sizes as (select distinct size from patterns),
    placed as (
        select doc_id, size, unnest(range(greatest(len(w) - size + 1, 0))) as pos,
            unnest({windows('w', 'size')}) as win from docwords cross join sizes),
    occur as (select doc_id, item_id, pos, size from placed join patterns using (size, win)),
    cover as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(pos, pos + size)) as p from occur) group by doc_id),
    owners as (
        select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
        from (select distinct doc_id, item_id::varchar as item_id from occur) group by doc_id),
    found as (
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
            sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from docwords left join cover using (doc_id) left join owners using (doc_id))"""


@query(f"with {hits_sql('documents')} select * from found")
def op4_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    items = F.array_sort(F.array_distinct("hits.item_id"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op5_token_files(spark, sf_dir):
    folder = store.new_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_index(token_files.read_tokens(spark, folder))


@query()
def op6_quality_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "labels"), keep_text=False)


def piece_digests(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_digests(
        pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_text=False)
    )


@query()
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), keep_text=False)


@query()
def op9_html_extraction(spark, sf_dir):
    return extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query(
    "with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v "
    "from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or "
    "not isfinite(x))) = 0), s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform("
    "list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::bigint as score from v q join v c "
    "on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id), r as (select *, row_number() over ("
    "partition by query_id order by score desc, vec_id) as rank from s) "
    "select query_id, rank::int as rank, vec_id, score from r where rank <= 5"
)
def op10_top_products(spark, sf_dir):
    return inner_product.top_products(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query()
def op11_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = store.new_folder(spark, "shard-map")
    version = sharding.update_map(docs, folder)
    placed = sharding.assign_shards(docs, sharding.read_map(spark, folder, version))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


@query()
def op12_spelling_variants(spark, sf_dir):
    return spelling.group_spellings(table(spark, sf_dir, "documents").select("doc_id", "text"))


def audit_sql() -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    share = f"1 + ({source_audit.SCALE}::hugeint * (%s + {source_audit.PSEUDO})) // (%s + {source_audit.PSEUDO} * v)"
    rank = "row_number() over (partition by lang, source order by value desc, item)"
    return f"""with d as (
        select coalesce(lang, '') as lang, coalesce(source, '') as source,
            regexp_extract_all({lower}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
    n as (select lang, source, unnest(list_distinct(terms)) as term, 1 as docs, 0 as n from d
        union all select lang, source, unnest(terms), 0, 1 from d),
    counts as (select lang, source, term, sum(docs) as docs, sum(n) as n from n group by all),
    kept as (select lang, term, sum(n) as n_lang from counts group by all
        having sum(docs) >= {source_audit.MIN_DOCUMENTS}),
    langs as (select lang, count(*) as v, sum(n_lang) as total_lang from kept group by lang),
    dense as (
        select g.lang, g.source, k.term, k.n_lang, coalesce(c.n, 0) as n
        from (select distinct lang, source from d) g join kept k using (lang) left join counts c using (lang, source, term)),
    shares as (
        select *, {share % ('n', 'total')} as p, {share % ('n_lang', 'total_lang')} as q
        from (select *, sum(n) over (partition by lang, source) as total from dense) join langs using (lang)),
    pairs as (
        select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
        from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    all_pairs as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
        from (select distinct lang, source from d) a join (select distinct lang, source from d) b
            on a.lang = b.lang and a.source <> b.source
        left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source),
    terms as (
        select lang, source, 'term' as part, term as item, (p - q)::bigint as value
        from shares where n > 0 and p > q)
    select lang, source, part, item, value, {rank}::int as rank from all_pairs
    union all
    select * from (select lang, source, part, item, value, {rank}::int as rank from terms)
        where rank <= {source_audit.TOP_TERMS}"""


@query(audit_sql())
def op13_source_audit(spark, sf_dir):
    return source_audit.audit_sources(table(spark, sf_dir, "documents").select("lang", "source", "text"))
