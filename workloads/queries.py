"""Registered queries: each a Spark plan over the benchmark tables and, where SQL
can say the same, the DuckDB text it is checked against."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetrail.functions import fields as E
from filetrail.functions import quality as Q
from filetrail.functions import urls as U
from filetrail.functions.names import target_name, window_id
from filetrail.operators import geo as G
from filetrail.operators import metrics as M
from filetrail.operators import normalize as N
from filetrail.operators import routing as R
from filetrail.operators import windows as W
from filetrail.operators.domains import add_domains, domain_lookup
from filetrail.plans.filters import QuerySpec, bounds, compile_filters, with_bounds
from filetrail.plans.pull import Options, run_pull, run_pulls
from filetrail.schemas import FLAT_TARGET, GEO_CACHE, QUERIES, RAW_ALIASES, SUFFIX_RULES
from filetrail.session import configure
from filetrail.sinks.files import gather_windows, json_lines, write_windows
from filetrail.sinks.targets import (
    create_target,
    insert_targets,
    target_partitions,
    with_field_aliases,
    write_targets,
)
from filetrail.sources.events import read_raw
from filetrail.sources.state import load_cache, read_locations, refresh_cache, save_cache
from filetrail.streaming import lookups as L
from filetrail.streaming import runs as S
from workloads.adapters import EVENTS, SHIPMENTS, as_raw_events, raw_events, raw_sql, table

QUERIES_BY_NAME: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RAW_CTE = f"with raw as ({raw_sql(EVENTS)})"
SHIP_CTE = f"with raw as ({raw_sql(SHIPMENTS)})"


def query(sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES_BY_NAME[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=UTC)


def ms(c) -> F.Column:
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)


def joined(c) -> F.Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|")


def null_if_blank(e: str) -> str:
    return f"nullif({e}, '')"


# --- normalization --------------------------------------------------------------

CLASS_SQL = (
    "case lower(eventType) when 'created' then 'creation' when 'modified' then 'change' "
    "when 'deleted' then 'deletion' else 'info' end"
)


@query(
    f"{RAW_CTE} select {CLASS_SQL} as event_class, "
    "strftime(ts, '%Y-%m-%d %H') as hour, count(*) as n_events from raw group by 1, 2"
)
def event_class(spark, sf):
    ev = raw_events(spark, sf).select(
        E.event_class(F.col("eventType")).alias("event_class"),
        F.date_format(E.event_time(F.col("eventTimestamp")), "yyyy-MM-dd HH").alias("hour"),
    )
    return ev.groupBy("event_class", "hour").agg(F.count("*").alias("n_events"))


@query(
    f"{RAW_CTE} select event_id, case when event_id % 7 = 0 then "
    "epoch_ms(date_trunc('second', ts)) else epoch_ms(date_trunc('millisecond', ts)) end "
    "as happened_ms, epoch_ms(date_trunc('millisecond', ts)) as inserted_ms from raw"
)
def event_time_parse(spark, sf):
    return raw_events(spark, sf).select(
        "event_id",
        ms(E.event_time(F.col("eventTimestamp"))).alias("happened_ms"),
        ms(E.insertion_time(F.col("insertionTimestamp"))).alias("inserted_ms"),
    )


@query(
    f"{RAW_CTE} select event_id, case when event_id % 3 <> 0 then "
    "epoch_ms(date_trunc('millisecond', ts)) end as created_ms, case when event_id % 4 <> 0 "
    "then epoch_ms(date_trunc('second', ts)) end as modified_ms from raw"
)
def optional_times(spark, sf):
    return raw_events(spark, sf).select(
        "event_id",
        ms(E.optional_time(F.col("createTimestamp"), strict=True)).alias("created_ms"),
        ms(E.optional_time(F.col("modifyTimestamp"), strict=True)).alias("modified_ms"),
    )


FILE_TYPE = (
    "case page_id % 9 when 0 then 'FILE' when 1 then 'win_nds' when 2 then 'MAC_RSRC' "
    "when 3 then 'fifo' when 4 then 'Bundle' when 5 then 'dir' when 6 then 'BLOCK_DEVICE' "
    "when 7 then 'symlink' else 'other' end"
)
PAGE_FILE = (
    "case page_id % 4 when 0 then url when 1 then concat(url, '.tar.gz') "
    "when 2 then '.bashrc' else 'a.' end"
)


@query(
    f"with f as (select page_id, {FILE_TYPE} as t, {PAGE_FILE} as n from pages) "
    "select page_id, case when page_id % 9 <= 4 then 'file' when page_id % 9 <= 6 then 'dir' "
    "when page_id % 9 = 7 then 'symlink' else 'unknown' end as file_class, "
    r"nullif(regexp_extract(n, '\.([^./]*)$', 1), '') as extension from f"
)
def file_class_ext(spark, sf):
    files = table(spark, sf, "pages").selectExpr(
        "page_id", f"{FILE_TYPE} as t", f"{PAGE_FILE} as n"
    )
    return files.select(
        "page_id",
        E.file_class(F.col("t")).alias("file_class"),
        E.extension(F.col("n")).alias("extension"),
    )


@query(
    "select doc_id, case when doc_id % 4 = 3 then null when doc_id % 2 = 0 then "
    "concat('{', case when doc_id % 4 = 0 then concat('\"md5\":\"', md5(text), '\",') else '' end, "
    "'\"sha256\":\"', sha256(text), '\"}') "
    "else concat('{\"md5\":\"', md5(text), '\"}') end as hash, "
    "doc_id % 3 <> 0 as has_process from documents"
)
def hash_collapse(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id",
        "case when doc_id % 4 in (0, 1) then md5(text) else '' end as md5Checksum",
        "case when doc_id % 2 = 0 then sha2(text, 256) else '' end as sha256Checksum",
        "case when doc_id % 3 = 1 then lang else '' end as processOwner",
        "case when doc_id % 3 = 2 then source else '' end as processName",
    )
    docs = N.clean_raw(docs)
    process = E.struct_if_any(owner=F.col("processOwner"), name=F.col("processName"))
    return docs.select(
        "doc_id",
        F.to_json(N.hash_struct()).alias("hash"),
        process.isNotNull().alias("has_process"),
    )


MIME_A = "case when doc_id % 5 = 0 then '' else lang end"
MIME_B = "case when doc_id % 3 = 0 then lang when doc_id % 10 = 5 then '' else source end"


@query(
    f"with m as (select doc_id, {MIME_A} as a, {MIME_B} as b from documents) "
    "select doc_id, case when a <> b then concat(a, '|', b) else a end as mime, "
    "cast(case when a <> b then 2 else 1 end as int) as n_types from m"
)
def mime_list(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id", f"nullif({MIME_A}, '') as a", f"nullif({MIME_B}, '') as b"
    )
    mime = E.mime_list(F.col("a"), F.col("b"))
    return docs.select("doc_id", joined(mime).alias("mime"), F.size(mime).alias("n_types"))


DEVICE_USER = (
    "case c_custkey % 5 when 0 then 'NAME_NOT_AVAILABLE' when 1 then concat(c_name, '@', "
    "c_mktsegment) when 2 then concat(c_name, '@', c_mktsegment, '@x') when 3 then c_name "
    "else '' end"
)
ACTOR = "case when c_custkey % 10 = 0 then c_name else concat(c_name, '@act.', c_mktsegment) end"
OS_USER = (
    "case c_custkey % 4 when 0 then 'os1' when 1 then 'NAME_NOT_AVAILABLE' else '' end"
)
USER_UID = "case when c_custkey % 2 = 0 then '' else cast(c_custkey as string) end"


@query(
    f"with u as (select c_custkey, {DEVICE_USER} as d, {ACTOR} as a, {OS_USER} as o, "
    f"{USER_UID} as i from customer), e as (select *, nullif(case when d = 'NAME_NOT_AVAILABLE' "
    "then a else d end, '') as email, case when o in ('', 'NAME_NOT_AVAILABLE') then "
    "nullif(i, '') else o end as id from u) select c_custkey, email, id, case when "
    "contains(email, '@') then split_part(email, '@', 1) end as name, case when "
    "contains(email, '@') then split_part(email, '@', 2) end as domain, "
    "email is null and id is null as nobody from e"
)
def user_identity(spark, sf):
    user = E.user(F.col("email"), F.col("id"))
    return (
        table(spark, sf, "customer")
        .selectExpr(
            "c_custkey",
            *[f"nullif({e}, '') as {n}" for e, n in
              [(DEVICE_USER, "d"), (ACTOR, "a"), (OS_USER, "o"), (USER_UID, "i")]],
        )
        .select(
            "c_custkey",
            E.user_email(F.col("d"), F.col("a")).alias("email"),
            E.user_id(F.col("o"), F.col("i")).alias("id"),
        )
        .select("c_custkey", user.alias("user"))
        .select(
            "c_custkey", "user.email", "user.id", "user.name", "user.domain",
            F.col("user").isNull().alias("nobody"),
        )
    )


@query(
    f"{RAW_CTE} select event_id, case when event_id % 6 = 0 then nullif(publicIpAddress, '') "
    "else concat('fe80::', substr(userUid2, 1), '|10.0.0.', event_id % 250, "
    "case when publicIpAddress = '' then '' else concat('|', publicIpAddress) end) end as ips "
    "from (select *, substr(deviceUid, 4) as userUid2 from raw)"
)
def host_ips(spark, sf):
    raw = N.clean_raw(raw_events(spark, sf), strip_zone=True)
    ips = E.host_ips(F.col("privateIpAddresses"), F.col("publicIpAddress"))
    return raw.select("event_id", joined(ips).alias("ips"))


NORMALIZED_SQL = """
select event_id,
  nullif(eventType, '') as event_action,
  {cls} as event_type,
  eventId as event_id_text,
  'file' as category, 'event' as kind,
  case when event_id % 7 = 0 then epoch_ms(date_trunc('second', ts))
       else epoch_ms(date_trunc('millisecond', ts)) end as timestamp_ms,
  epoch_ms(date_trunc('millisecond', ts)) as ingested_ms,
  fileName as file_name,
  case event_id % 4 when 0 then 'gz' when 1 then 'bashrc' end as extension,
  case when event_id % 8 in (0, 1, 5) then 'file' when event_id % 8 in (2, 3) then 'dir'
       when event_id % 8 = 4 then 'symlink' else 'unknown' end as file_class,
  fileSize as size,
  case when event_id % 3 <> 0 then epoch_ms(date_trunc('millisecond', ts)) end as created_ms,
  case when event_id % 4 <> 0 then epoch_ms(date_trunc('second', ts)) end as mtime_ms,
  nullif(md5Checksum, '') as md5, nullif(sha256Checksum, '') as sha256,
  event_id % 6 = 0 as no_hash,
  case when mimeTypeByBytes <> mimeTypeByExtension
       then concat(mimeTypeByBytes, '|', mimeTypeByExtension) else mimeTypeByBytes end as mime,
  deviceUid as host_id, osHostName as host_name, domainName as hostname,
  case event_id % 4 when 0 then nullif(actor, '') when 1 then deviceUserName
       when 2 then 'plain' end as email,
  case when event_id % 5 = 0 then 'osuser' else nullif(userUid, '') end as user_id,
  case event_id % 4 when 0 then case when actor <> '' then 'corp.example' end
       when 1 then split_part(deviceUserName, '@', 2) end as user_domain,
  cast(case when event_id % 6 = 0 then 0 else 2 end
       + case when publicIpAddress = '' then 0 else 1 end as bigint) as n_ips,
  event_id % 2 = 0 and event_id % 4 <> 0 as no_process,
  nullif(processOwner, '') as process_owner,
  url as url_full, 'https' as url_scheme, replace(split_part(url, '/', 3), ':8443', '') as
  url_domain, cast(8443 as int) as url_port, concat('/f x/', event_id, '.html') as url_path,
  'html' as url_extension, 'x=1' as url_query, 'top' as url_fragment,
  'example.co.uk' as url_registered, 'co.uk' as url_suffix,
  '{{}}' as media, 'agent' as destination_name, nullif(destinationCategory, '') as
  destination_category
from raw"""

# A small list; a full public list has the same form.
RULES = [
    ("com", "normal"), ("org", "normal"), ("net", "normal"), ("uk", "normal"),
    ("co.uk", "normal"), ("*.ck", "wildcard"), ("www.ck", "exception"),
]


def suffix_rules(spark):
    return spark.createDataFrame(RULES, SUFFIX_RULES)


def flat_normalized(df):
    url = "source_event.url"
    return df.select(
        "event_id",
        F.col("event.action").alias("event_action"),
        F.col("event.type").alias("event_type"),
        F.col("event.id").alias("event_id_text"),
        F.col("event.category").alias("category"),
        F.col("event.kind").alias("kind"),
        ms("@timestamp").alias("timestamp_ms"),
        ms("event.ingested").alias("ingested_ms"),
        F.col("file.name").alias("file_name"),
        F.col("file.extension").alias("extension"),
        F.col("file.type").alias("file_class"),
        F.col("file.size").alias("size"),
        ms("file.created").alias("created_ms"),
        ms("file.mtime").alias("mtime_ms"),
        F.col("file.hash.md5").alias("md5"),
        F.col("file.hash.sha256").alias("sha256"),
        F.col("file.hash").isNull().alias("no_hash"),
        joined("file.mime_type").alias("mime"),
        F.col("host.id").alias("host_id"),
        F.col("host.name").alias("host_name"),
        F.col("host.hostname").alias("hostname"),
        F.col("host.user.email").alias("email"),
        F.col("host.user.id").alias("user_id"),
        F.col("host.user.domain").alias("user_domain"),
        F.coalesce(F.size("host.ip"), F.lit(0)).cast("bigint").alias("n_ips"),
        F.col("source_event.process").isNull().alias("no_process"),
        F.col("source_event.process.owner").alias("process_owner"),
        F.col(f"{url}.full").alias("url_full"),
        F.col(f"{url}.scheme").alias("url_scheme"),
        F.col(f"{url}.domain").alias("url_domain"),
        F.col(f"{url}.port").alias("url_port"),
        F.col(f"{url}.path").alias("url_path"),
        F.col(f"{url}.extension").alias("url_extension"),
        F.col(f"{url}.query").alias("url_query"),
        F.col(f"{url}.fragment").alias("url_fragment"),
        F.col(f"{url}.registered_domain").alias("url_registered"),
        F.col(f"{url}.top_level_domain").alias("url_suffix"),
        F.to_json("source_event.removable_media").alias("media"),
        F.col("source_event.destination.name").alias("destination_name"),
        F.col("source_event.destination.category").alias("destination_category"),
    )


@query(RAW_CTE + NORMALIZED_SQL.format(cls=CLASS_SQL))
def normalized_events(spark, sf):
    raw = raw_events(spark, sf)
    return flat_normalized(N.normalize(raw, rules=suffix_rules(spark), keep=("event_id",)))


@query(SHIP_CTE + NORMALIZED_SQL.format(cls=CLASS_SQL))
def normalized_shipments(spark, sf):
    raw = raw_events(spark, sf, "lineitem")
    return flat_normalized(N.normalize(raw, rules=suffix_rules(spark), keep=("event_id",)))


@query(
    "select conv_id, turn, role as subject, cast(case when turn % 2 = 0 then 2 else 0 end as int) "
    "as n_shared, case when turn % 2 = 0 then concat('u', conv_id, '|', role) end as shared, "
    "concat('{\"policy_names\":[\"p', turn, '\"],\"subject\":\"', role, '\"}') as email_json, "
    "case when turn % 3 = 0 then '{\"name\":\"lp\"}' else '{}' end as print_json, "
    "concat('{\"capacity\":', length(text), '}') as media_json from conversations"
)
def envelope_parts(spark, sf):
    turns = table(spark, sf, "conversations")
    raw = turns.select(
        "conv_id", "turn",
        F.when(
            F.col("turn") % 2 == 0,
            F.array(
                F.struct(F.concat(F.lit("u"), F.col("conv_id")).alias("cloudUsername")),
                F.struct(F.col("role").alias("cloudUsername")),
            ),
        ).alias("sharedWith"),
        F.array(F.concat(F.lit("p"), F.col("turn"))).alias("emailDlpPolicyNames"),
        F.col("role").alias("emailSubject"),
        F.lit("").alias("emailSender"),
        F.when(F.col("turn") % 3 == 0, "lp").otherwise("").alias("printerName"),
        F.length("text").cast("bigint").alias("removableMediaCapacity"),
    )
    source = N.normalize(raw, keep=("conv_id", "turn"))
    shared = F.col("source_event.shared_with.cloud_username")
    return source.select(
        "conv_id", "turn",
        F.col("source_event.email_dlp.subject").alias("subject"),
        F.coalesce(F.size(shared), F.lit(0)).alias("n_shared"),
        joined(shared).alias("shared"),
        F.to_json("source_event.email_dlp").alias("email_json"),
        F.to_json("source_event.print").alias("print_json"),
        F.to_json("source_event.removable_media").alias("media_json"),
    )


@query(
    f"{RAW_CTE} select event_id, {CLASS_SQL} as type, nullif(md5Checksum, '') as md5, "
    "concat('[\"', case when mimeTypeByBytes <> mimeTypeByExtension then concat("
    "mimeTypeByBytes, '\",\"', mimeTypeByExtension) else mimeTypeByBytes end, '\"]') as mime, "
    "'{}' as media, case when event_id % 2 = 0 and event_id % 4 <> 0 then null "
    "when event_id % 4 = 0 then '{\"name\":\"cp\"}' else '{\"owner\":\"root\"}' end as process, "
    "false as empty_text, false as many_lines from raw"
)
def json_fields(spark, sf):
    rows = N.normalize(raw_events(spark, sf))
    text = json_lines(rows)
    # A string field of the schema takes the JSON text found there, whatever its type.
    schema = (
        "event struct<id:string,type:string>, file struct<hash:struct<md5:string>,"
        "mime_type:string>, source_event struct<removable_media:string,process:string>"
    )
    parsed = text.select("value", F.from_json("value", schema).alias("j"))
    return parsed.select(
        F.substring("j.event.id", 4, 20).cast("bigint").alias("event_id"),
        F.col("j.event.type").alias("type"),
        F.col("j.file.hash.md5").alias("md5"),
        F.col("j.file.mime_type").alias("mime"),
        F.col("j.source_event.removable_media").alias("media"),
        F.col("j.source_event.process").alias("process"),
        F.col("value").contains(':""').alias("empty_text"),
        F.col("value").contains("\n").alias("many_lines"),
    )


# --- URLs -----------------------------------------------------------------------

URL_FIELDS = ("full domain extension fragment path port query scheme username password").split()


@query(
    "with p as (select page_id, url, regexp_extract(url, '^[^?#]*', 0) as head from pages) "
    "select page_id, url as \"full\", regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as domain, "
    r"nullif(regexp_extract(regexp_extract(head, '^[a-z]+://[^/]+(/.*)$', 1), '\.([^.]*)$', 1), "
    "'') as extension, nullif(regexp_extract(url, '#(.*)$', 1), '') as fragment, "
    "nullif(regexp_extract(head, '^[a-z]+://[^/]+(/.*)$', 1), '') as path, "
    "cast(null as int) as port, nullif(regexp_extract(url, '[?]([^#]*)', 1), '') as query, "
    "regexp_extract(url, '^([a-z]+):', 1) as scheme, cast(null as varchar) as username, "
    "cast(null as varchar) as password from p"
)
def url_parts(spark, sf):
    pages = U.with_url_info(table(spark, sf, "pages").select("page_id", "url"), "url", "u")
    return pages.select("page_id", *[F.col(f"u.{f}").alias(f) for f in URL_FIELDS])


PAGE = "cast(page_id as string)"
ODD_URL = (
    "case page_id % 9 "
    f"when 0 then concat('HTTPS://us%20er:p:w@', split_part(url, '/', 3), ':8443/a/', {PAGE}, "
    "'.tar.gz?x=1&y=2#fr+ag') "
    f"when 1 then concat('http://my_', split_part(url, '/', 3), ':/a%20b+c/', {PAGE}) "
    f"when 2 then concat('http://[2001:db8::1]:8080/x.d/noext', {PAGE}) "
    f"when 3 then concat('mailto:u', {PAGE}, '@example.com') "
    f"when 4 then concat('http://a b/%zz', {PAGE}) "
    f"when 5 then concat('//cdn.', split_part(url, '/', 3), '/lib/', {PAGE}, '.js') "
    f"when 6 then concat('/rel a/path.', {PAGE}, '?') "
    f"when 7 then concat('http://h:x', {PAGE}, '/') else '' end"
)


def _by_case(*values: str | None) -> str:
    """CASE over page_id % 9; None is NULL."""
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values) if v)
    return f"case page_id % 9 {arms} end"


@query(
    f"with p as (select page_id, {PAGE} as id, split_part(url, '/', 3) as host, nullif({ODD_URL}, '') as "
    "\"full\" from pages) "
    "select page_id, \"full\", page_id % 9 <> 8 as is_url, "
    + _by_case("'https'", "'http'", "'http'", "'mailto'") + " as scheme, "
    + _by_case("host", "concat('my_', host)", "'2001:db8::1'", None, None,
               "concat('cdn.', host)") + " as domain, "
    + "cast(" + _by_case("8443", None, "8080") + " as int) as port, "
    + _by_case("'us er'") + " as username, " + _by_case("'p:w'") + " as password, "
    + _by_case("concat('/a/', id, '.tar.gz')", "concat('/a b+c/', id)",
               "concat('/x.d/noext', id)", None, None, "concat('/lib/', id, '.js')",
               "concat('/rel a/path.', id)") + " as path, "
    + _by_case("'gz'", None, "concat('d/noext', id)", None, None, "'js'", "id")
    + " as extension, " + _by_case("'x=1&y=2'") + " as query, "
    + _by_case("'fr+ag'") + " as fragment from p"
)
def url_variants(spark, sf):
    pages = table(spark, sf, "pages").selectExpr("page_id", f"{ODD_URL} as url")
    return pages.select("page_id", U.url_info(F.col("url")).alias("u")).select(
        "page_id", F.col("u").isNotNull().alias("is_url"),
        *[F.col(f"u.{f}").alias(f) for f in URL_FIELDS],
    )


HOST = (
    "case page_id % 7 when 0 then split_part(url, '/', 3) "
    f"when 1 then concat('a', {PAGE}, '.b.co.uk') when 2 then concat('x', {PAGE}, '.ck') "
    f"when 3 then concat('s', {PAGE}, '.www.ck') when 4 then concat('h', {PAGE}, '.z.unknown') "
    f"when 5 then concat('p', {PAGE}, '.q.foo.ck') else 'co.uk' end"
)


@query(
    f"with h as (select page_id, {PAGE} as id, {HOST} as domain from pages), "
    "s as (select *, string_split(domain, '.') as l from h) select page_id, domain, "
    "case page_id % 7 when 0 then concat(l[-2], '.', l[-1]) when 1 then 'b.co.uk' "
    "when 3 then 'www.ck' when 4 then 'z.unknown' when 5 then 'q.foo.ck' end as registered, "
    "case page_id % 7 when 0 then l[-1] when 1 then 'co.uk' when 2 then domain when 3 then 'ck' "
    "when 4 then 'unknown' when 5 then 'foo.ck' else 'co.uk' end as suffix from s"
)
def url_registered_domain(spark, sf):
    pages = table(spark, sf, "pages").selectExpr(
        "page_id", f"concat('https://', {HOST}, '/x') as url"
    )
    urls = U.with_url_info(pages, "url", "u")
    return add_domains(urls, "u", suffix_rules(spark)).select(
        "page_id",
        F.col("u.domain").alias("domain"),
        F.col("u.registered_domain").alias("registered"),
        F.col("u.top_level_domain").alias("suffix"),
    )


@query(
    "with h as (select page_id, split_part(url, '/', 3) as host from pages), s as (select *, "
    "string_split(host, '.') as l from h), t as (select *, coalesce(length(l[-3]) % 2 = 0, false) as "
    "own, array_to_string(l[-3:], '.') as site from s) select page_id, host as domain, case when not "
    "own then concat('example.', l[-1]) when len(l) > 3 then concat(l[-4], '.', site) end as "
    "registered, case when own then site else l[-1] end as suffix from t"
)
def url_domains_by_join(spark, sf):
    """The hosts of all pages by rules that grow with the table, so that they stay in it."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    urls = U.with_url_info(pages, "url", "u")
    site = F.regexp_extract("u.domain", r"([^.]+)\.example\.[^.]+$", 1)
    owned = urls.where((site != "") & (F.length(site) % 2 == 0))
    rules = owned.select(
        F.regexp_extract("u.domain", r"[^.]+\.example\.[^.]+$", 0).alias("rule"), F.lit("normal").alias("kind")
    ).distinct()
    return add_domains(urls, "u", rules, rule_bytes=0).select(
        "page_id", F.col("u.domain").alias("domain"), F.col("u.registered_domain").alias("registered"),
        F.col("u.top_level_domain").alias("suffix"),
    )


@query(
    f"with h as (select page_id, {HOST} as domain, split_part(url, '/', 3) as host from pages) "
    "select page_id, cast(case when page_id % 4 = 0 then 0 else 3 end as int) as n_tabs, "
    "case when page_id % 4 <> 0 then concat(domain, '|', host) end as domains, "
    "case when page_id % 4 <> 0 then concat(case page_id % 7 when 1 then 'co.uk' when 2 then "
    "domain when 3 then 'ck' when 4 then 'unknown' when 5 then 'foo.ck' when 6 then 'co.uk' "
    "else split_part(domain, '.', -1) end, '|', split_part(host, '.', -1)) end as suffixes, "
    "case when page_id % 4 <> 0 then 'first|second' end as titles from h"
)
def tab_urls(spark, sf):
    pages = table(spark, sf, "pages")
    tab = "struct('{}' as title, {} as url)"
    pages = pages.selectExpr(
        "page_id",
        "case when page_id % 4 <> 0 then array("
        + ", ".join([
            tab.format("first", f"concat('http://', {HOST}, ':80/a.b')"),
            tab.format("second", "url"),
            tab.format("", "''"),
        ])
        + ") else array() end as tabs",
    )
    tabs = U.tab_list(F.col("tabs"), domain_lookup(suffix_rules(spark)))
    t = pages.select("page_id", tabs.alias("t"))
    return t.select(
        "page_id",
        F.coalesce(F.size("t"), F.lit(0)).alias("n_tabs"),
        joined("t.url.domain").alias("domains"),
        joined("t.url.top_level_domain").alias("suffixes"),
        joined("t.title").alias("titles"),
    )


# --- filters --------------------------------------------------------------------

CLICKS = QuerySpec.from_dict({
    "name": "clicks",
    "groups": [
        {"filters": [
            {"operator": "IS", "term": "event_type", "value": "click"},
            {"operator": "IS", "term": "props", "value": "*\"k\": 1*"},
            {"operator": "ON_OR_AFTER", "term": "ts", "value": "2024-01-05T06:00:00.000Z"},
            {"operator": "ON_OR_BEFORE", "term": "ts", "value": "2024-01-20T17:59:59.999Z"},
        ], "filterClause": "AND"},
        {"filters": [{"operator": "IS", "term": "props", "value": "*"}]},
    ],
})


@query(
    "select event_id, user_id from events where event_type = 'click' and props like '%\"k\": 1%' "
    "and ts >= timestamp '2024-01-05 06:00:00' and ts < timestamp '2024-01-20 18:00:00'"
)
def filter_tree(spark, sf):
    events = table(spark, sf, "events")
    return events.where(compile_filters(CLICKS, times={"ts": F.col("ts")})).select(
        "event_id", "user_id"
    )


ARCHIVES = QuerySpec.from_dict({
    "name": "archives",
    "groups": [{"filters": [
        {"operator": "IS", "term": "fileName", "value": "*_*.gz"},
        {"operator": "ON_OR_AFTER", "term": "insertionTimestamp", "value": ""},
        {"operator": "ON_OR_BEFORE", "term": "insertionTimestamp", "value": ""},
        {"operator": "ON_OR_AFTER", "term": "insertionTimestamp",
         "value": "2030-01-01T00:00:00Z"},
    ]}],
})


@query(
    f"{RAW_CTE} select substr(fileName, 1, 4) as stem, count(*) as n_events from raw "
    "where event_id % 4 = 0 and ts >= timestamp '2024-01-03 00:00:00' "
    "and date_trunc('millisecond', ts) <= timestamp '2024-01-25 12:30:00.500' group by 1"
)
def filter_raw_text(spark, sf):
    spec = with_bounds(ARCHIVES, utc(2024, 1, 3), utc(2024, 1, 25, 12, 30, 0, 500_000))
    assert bounds(spec) == (utc(2024, 1, 3), utc(2024, 1, 25, 12, 30, 0, 500_000))
    kept = raw_events(spark, sf).where(compile_filters(spec))
    return kept.groupBy(F.substring("fileName", 1, 4).alias("stem")).agg(
        F.count("*").alias("n_events")
    )


@query(
    "select event_type, count(*) as n_events from events where event_id % 3 = 0 and event_id % 5 = 0 group by 1"
)
def filter_presence(spark, sf):
    """``*`` takes neither empty text nor an empty list for present."""
    events = table(spark, sf, "events").select(
        "event_type",
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("f"), "event_id"))
        .when(F.col("event_id") % 3 == 1, "").alias("fileName"),
        F.when(F.col("event_id") % 5 == 0, F.array(F.lit("x")))
        .when(F.col("event_id") % 5 < 3, F.array().cast("array<string>")).alias("exposure"),
    )
    spec = QuerySpec.from_dict({"name": "present", "groups": [{"filters": [
        {"operator": "IS", "term": "fileName", "value": "*"},
        {"operator": "IS", "term": "exposure", "value": "*"},
    ]}]})
    return events.where(compile_filters(spec)).groupBy("event_type").agg(F.count("*").alias("n_events"))



# --- windows --------------------------------------------------------------------

GAP = timedelta(hours=6)
STRIDE_MS = 6 * 3_600_000 + 1


@query(
    "with e as (select epoch_us(ts) - epoch_us(timestamp '2024-01-01') as us from events "
    "where ts < timestamp '2024-01-29 12:00:00.001'), w as (select us // "
    f"{STRIDE_MS * 1000} as i from e) select epoch_ms(timestamp '2024-01-01') + i * {STRIDE_MS} "
    "as start_ms, least(epoch_ms(timestamp '2024-01-01') + i * "
    f"{STRIDE_MS} + {STRIDE_MS - 1}, epoch_ms(timestamp '2024-01-29 12:00:00')) as end_ms, "
    "count(*) as n_events from w group by i"
)
def pull_windows(spark, sf):
    events = table(spark, sf, "events")
    assigned = W.assign_tumbling(
        events, F.col("ts"), utc(2024, 1, 1), GAP, utc(2024, 1, 29, 12), utc(2024, 2, 1)
    )
    counted = M.window_counts(assigned.withColumn("query_name", F.lit("all")))
    return counted.select(
        ms("on_or_after").alias("start_ms"), ms("on_or_before").alias("end_ms"), "n_events"
    )


def day_windows(spark, sf) -> DataFrame:
    """Window log with a row per event type and day."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("query_name"), day.alias("on_or_after"))
        .agg(F.when(F.count("*") % 3 == 0, "open").otherwise("completed").alias("status"))
        .withColumn("on_or_before", F.col("on_or_after") + F.expr("INTERVAL 86399999 MILLISECONDS"))
    )


DAY_WINDOWS = (
    "days as (select event_type as query_name, date_trunc('day', ts) as a, case when "
    "count(*) % 3 = 0 then 'open' else 'completed' end as status, epoch_ms(date_trunc('day', ts)) "
    "as a_ms, epoch_ms(date_trunc('day', ts)) + 86399999 as b_ms from events group by 1, 2)"
)
NEWEST = (
    "last as (select query_name, max(a_ms) filter (status = 'open') as oa, max(b_ms) filter "
    "(status = 'open') as ob, max(b_ms) filter (status = 'completed') as cb from days "
    "group by query_name), newest as (select query_name, case when oa is null then cb when cb is "
    "null or cb <= oa then ob else cb end as seen_ms from last)"
)


@query(
    f"with {DAY_WINDOWS}, {NEWEST} select query_name, (select count(*) from days d where "
    "d.query_name = n.query_name and status = 'open') as n_open, (select max(b_ms) from days d "
    "where d.query_name = n.query_name and status = 'completed') as completed_ms, seen_ms "
    "from newest n"
)
def window_state(spark, sf):
    log = day_windows(spark, sf)
    windows = W.current_windows(
        log.unionByName(log.where(F.col("status") == "completed").withColumn(
            "status", F.lit("open")))
    )
    n_open = W.open_windows(windows).groupBy("query_name").agg(F.count("*").alias("n_open"))
    done = W.last_completed(windows).select("query_name", ms("on_or_before").alias("completed_ms"))
    seen = W.newest_windows(windows).select("query_name", ms("on_or_before").alias("seen_ms"))
    return (
        seen.join(done, "query_name", "left")
        .join(n_open, "query_name", "left")
        .fillna(0, ["n_open"])
    )


@query(
    f"with {DAY_WINDOWS}, {NEWEST}, lim as (select query_name, seen_ms + 1 as first_ms, "
    "epoch_ms(timestamp '2024-02-03 00:00:00') as max_ms, epoch_ms(timestamp "
    "'2024-02-02 11:45:00') as settled_ms from newest), n as (select *, unnest(generate_series("
    f"0, (least(max_ms - 1, settled_ms) - first_ms) // {STRIDE_MS})) as i from lim) select "
    f"query_name, first_ms + i * {STRIDE_MS} as start_ms, least(first_ms + i * {STRIDE_MS} + "
    f"{STRIDE_MS - 1}, max_ms, settled_ms) as end_ms from n"
)
def planned_windows(spark, sf):
    windows = day_windows(spark, sf)
    queries = (
        table(spark, sf, "events").select(F.col("event_type").alias("query_name")).distinct()
        .select(
            "query_name",
            F.lit(utc(2024, 1, 1)).alias("start_time"),
            F.lit(utc(2024, 2, 3)).alias("max_time"),
            F.lit(STRIDE_MS - 1).cast("bigint").alias("gap_ms"),
        )
    )
    assert queries.columns == QUERIES.fieldNames()
    planned = W.plan_windows(windows, queries, utc(2024, 2, 2, 12))
    return planned.select(
        "query_name", ms("on_or_after").alias("start_ms"), ms("on_or_before").alias("end_ms")
    )


@query(
    f"with {DAY_WINDOWS} select query_name, d.a_ms as start_ms, count(*) as n_events from days d "
    "join events e on epoch_ms(date_trunc('millisecond', e.ts)) between d.a_ms and d.b_ms "
    "where d.status = 'open' group by 1, 2"
)
def replayed_windows(spark, sf):
    pending = W.open_windows(day_windows(spark, sf))
    events = W.assign_windows(table(spark, sf, "events"), F.col("ts"), pending, GAP)
    return M.window_counts(events).select(
        "query_name", ms("on_or_after").alias("start_ms"), "n_events"
    )


@query(
    f"with {DAY_WINDOWS} select event_type as query_name, count(*) as events_total, (select "
    "count(*) from days d where d.query_name = e.event_type and d.status = 'open') as "
    "windows_in_progress from events e group by 1"
)
def query_counters(spark, sf):
    events = table(spark, sf, "events").withColumn("query_name", F.col("event_type"))
    return M.pipeline_metrics(events, day_windows(spark, sf))


@query(
    "with w as (select (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // "
    f"{STRIDE_MS * 1000} as i from events), n as (select epoch_ms(timestamp '2024-01-01') + "
    f"i * {STRIDE_MS} as s from w) select strftime(make_timestamp(s * 1000), "
    "'clicksA%Y.%m.%d.%H.%M.%S.%g') || strftime(make_timestamp((s + "
    f"{STRIDE_MS - 1}) * 1000), 'B%Y.%m.%d.%H.%M.%S.%g') as window_id, count(*) as n_events "
    "from n group by 1"
)
def window_ids(spark, sf):
    assigned = W.assign_tumbling(table(spark, sf, "events"), F.col("ts"), utc(2024, 1, 1), GAP)
    # Count by the window itself; format one id per window, not one per event.
    counted = assigned.groupBy("on_or_after", "on_or_before").agg(F.count("*").alias("n_events"))
    return counted.select(
        window_id("clicks", F.col("on_or_after"), F.col("on_or_before")).alias("window_id"),
        "n_events",
    )


LONG_NAME = "long-" * 48
LONG_MARK = f"{LONG_NAME[:32]}-{hashlib.sha256(LONG_NAME.encode()).hexdigest()[:32]}"


@query(
    f"with w as (select event_id, epoch_ms(timestamp '2024-01-01') + (epoch_us(ts) - epoch_us(timestamp "
    f"'2024-01-01')) // {STRIDE_MS * 1000} * {STRIDE_MS} as start_ms from events) select "
    f"concat('{LONG_MARK}', strftime(make_timestamp(start_ms * 1000), 'A%Y.%m.%d.%H.%M.%S.%g'), "
    f"strftime(make_timestamp((start_ms + {STRIDE_MS - 1}) * 1000), 'B%Y.%m.%d.%H.%M.%S.%g')) as window_id, "
    "count(*) as n_events from w group by 1"
)
def long_name_windows(spark, sf):
    """Two pulls of a query of 240 characters into one folder: no window replaces another."""
    folder = run_folder(spark)
    events = W.assign_tumbling(table(spark, sf, "events"), F.col("ts"), utc(2024, 1, 1), GAP)
    rows = events.select(
        "event_id", F.lit("files").alias("target"),
        window_id(LONG_NAME, F.col("on_or_after"), F.col("on_or_before")).alias("window_id"),
        F.col("on_or_after"),
    )
    middle = F.lit("2024-01-15").cast("timestamp")
    for part in (rows.where(F.col("on_or_after") < middle), rows.where(F.col("on_or_after") >= middle)):
        write_targets(part.drop("on_or_after"), folder, compact=True)
    written = spark.read.schema("event_id bigint, target string, window_id string").parquet(folder)
    return written.groupBy("window_id").agg(F.count("*").alias("n_events"))


# --- streams --------------------------------------------------------------------


def run_folder(spark) -> str:
    """A new folder for one streaming run, in the shared checkpoint folder or the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir") + "/shared"
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def stream_table(spark, sf, name) -> DataFrame:
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet*")


@query(
    "with w as (select (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // "
    f"{STRIDE_MS * 1000} as i, max(epoch_us(ts)) over () as last_us from events) select "
    f"epoch_ms(timestamp '2024-01-01') + i * {STRIDE_MS} as start_ms, "
    f"epoch_ms(timestamp '2024-01-01') + i * {STRIDE_MS} + {STRIDE_MS - 1} as end_ms, "
    "count(*) as n_events from w group by i, last_us having epoch_ms(timestamp '2024-01-01') + "
    f"(i + 1) * {STRIDE_MS} <= last_us // 1000 - 900000"
)
def stream_window_counts(spark, sf):
    folder = run_folder(spark)
    counts = S.windowed_counts(
        stream_table(spark, sf, "events"), F.col("ts"), utc(2024, 1, 1), GAP
    )
    run = (
        counts.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{folder}/out").select(
        ms("on_or_after").alias("start_ms"), ms("on_or_before").alias("end_ms"), "n_events"
    )


@query(
    f"{RAW_CTE} select strftime(ts, 'files-%Y-%m-%d') as target, {CLASS_SQL} as event_class, "
    "count(*) as n_events, sum(fileSize)::bigint as bytes from raw where event_id % 4 = 0 "
    "and ts >= timestamp '2024-01-03' group by 1, 2"
)
def stream_targets(spark, sf):
    folder = run_folder(spark)
    spec = with_bounds(ARCHIVES, utc(2024, 1, 3), None)
    spec = replace(spec, base="files", route_by="insertionTimestamp")
    raw = as_raw_events(stream_table(spark, sf, "events"))
    S.start_stream(raw, spec, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{folder}/out")
    return written.groupBy("target", F.col("event.type").alias("event_class")).agg(
        F.count("*").alias("n_events"), F.sum("file.size").alias("bytes")
    )


BAD_TIME = "case event_id % 11 when 3 then 'soon' when 5 then '' when 7 then concat('on ', {us}) else {us} end"


@query(
    "with r as (select ts, event_id % 11 in (3, 5, 7) as bad from events) select 'stream' as how, "
    "case when bad then 'aside' else strftime(ts, 'files-%Y-%m-%d') end as place, count(*) as "
    "n_events from r where bad or ts >= timestamp '2024-01-03' group by 2 union all select 'pull', "
    "case when bad then 'aside' else strftime(ts, 'files-%Y-%m') end, count(*) from r where bad or "
    "ts >= timestamp '2024-01-03' group by 2"
)
def unreadable_times(spark, sf):
    """Rows whose time can't be read, set aside by a stream and by a pull, beside the others."""
    folder = run_folder(spark)
    spec = QuerySpec.from_dict({
        "name": "readable", "gap": timedelta(days=1), "base": "files", "route_by": "insertionTimestamp",
        "groups": [{"filters": [
            {"operator": "ON_OR_AFTER", "term": "insertionTimestamp", "value": "2024-01-03T00:00:00.000Z"},
            {"operator": "ON_OR_BEFORE", "term": "insertionTimestamp", "value": ""},
        ]}],
    })

    def damaged(rows: DataFrame) -> DataFrame:
        return as_raw_events(rows).withColumn("insertionTimestamp", F.expr(BAD_TIME.format(us="insertionTimestamp")))

    S.start_stream(damaged(stream_table(spark, sf, "events")), spec, f"{folder}/out", f"{folder}/checkpoint",
                   options=Options(mode="raw"), aside_path=f"{folder}/aside").awaitTermination()
    monthly = replace(spec, layout="2006-01")
    run_pull(damaged(table(spark, sf, "events")), monthly, f"{folder}/windows",
             lambda df: write_targets(df, f"{folder}/pulled", compact=False), as_of=utc(2024, 3, 1),
             started_at=utc(2024, 1, 3), options=Options(mode="raw"), gather=True,
             aside=lambda df: df.write.mode("overwrite").parquet(f"{folder}/pull_aside"))

    def places(how: str, written: str, apart: str) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{written}").select(F.col("target").alias("place"))
        rows = rows.unionAll(spark.read.parquet(f"{folder}/{apart}").select(F.lit("aside")))
        return rows.groupBy(F.lit(how).alias("how"), "place").agg(F.count("*").alias("n_events"))

    return places("stream", "out", "aside").unionAll(places("pull", "pulled", "pull_aside"))


# --- pulls and sinks --------------------------------------------------------------

DAY_STRIDE = 86_400_001
FIRST_LIMIT, LAST_LIMIT = utc(2024, 1, 10), utc(2024, 1, 31, 23, 45)
ID_SQL = (
    "strftime(make_timestamp(a * 1000), 'dailyA%Y.%m.%d.%H.%M.%S.%g') || "
    "strftime(make_timestamp(b * 1000), 'B%Y.%m.%d.%H.%M.%S.%g')"
)


@query(
    "with e as (select epoch_us(ts) // 1000 as m, epoch_ms(timestamp '2024-01-01') as s1, "
    "epoch_ms(timestamp '2024-01-10') as l1, epoch_ms(timestamp '2024-01-31 23:45:00') as l2 "
    "from events), o as (select *, case when m <= l1 then s1 else l1 + 1 end as s, case when "
    "m <= l1 then l1 else l2 end as l from e), w as (select *, s + ((m - s) // "
    f"{DAY_STRIDE}) * {DAY_STRIDE} as a from o), b as (select a, least(a + 86400000, l) as b "
    f"from w) select strftime(make_timestamp(b * 1000), 'files-%Y-%m-%d') as target, {ID_SQL} "
    "as window_id, count(*) as n_events from b group by 1, 2"
)
def pulled_targets(spark, sf):
    # Two pulls of one query: the second goes on where the settle lag cut the first.
    folder = run_folder(spark)
    spec = QuerySpec.from_dict({
        "name": "daily", "gap": timedelta(days=1), "base": "files", "route_by": "onOrBefore",
        "groups": [{"filters": [
            {"operator": "ON_OR_AFTER", "term": "insertionTimestamp",
             "value": "2024-01-01T00:00:00.000Z"},
            {"operator": "ON_OR_BEFORE", "term": "insertionTimestamp", "value": ""},
        ]}],
    })
    raw = raw_events(spark, sf)
    for limit in (FIRST_LIMIT, LAST_LIMIT):
        run_pull(raw, spec, f"{folder}/windows", lambda df: write_targets(df, f"{folder}/out", compact=False),
                 as_of=limit + W.SETTLE_LAG, started_at=utc(2024, 1, 1), gather=True)
    written = spark.read.parquet(f"{folder}/out")
    return written.groupBy("target", "window_id").agg(F.count("*").alias("n_events"))


@query(
    "with w as (select (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // "
    f"{DAY_STRIDE * 1000} as i, event_id from events), n as (select epoch_ms(timestamp "
    f"'2024-01-01') + i * {DAY_STRIDE} as a, epoch_ms(timestamp '2024-01-01') + i * {DAY_STRIDE} "
    f"+ 86400000 as b, event_id from w) select {ID_SQL} as window_id, count(*) as n_events, "
    "sum(event_id * 10)::bigint as bytes, 0::bigint as odd_rows from n group by a, b"
)
def window_files(spark, sf):
    # JSON files by window, written twice: the second run replaces the first.
    folder = run_folder(spark)
    raw = W.assign_tumbling(
        raw_events(spark, sf), E.insertion_time(F.col("insertionTimestamp")),
        utc(2024, 1, 1), timedelta(days=1),
    )
    raw = raw.withColumns({
        "query_name": F.lit("daily"),
        "window_id": window_id("daily", F.col("on_or_after"), F.col("on_or_before")),
    }).drop("on_or_after", "on_or_before")
    rows = N.normalize(gather_windows(raw), keep=("query_name", "window_id"))
    for _ in range(2):
        write_windows(rows, f"{folder}/out", compact=False, compression="gzip")
    schema = "event struct<id:string>, file struct<size:bigint>, query_name string, window_id string"
    written = spark.read.schema(schema).json(f"{folder}/out")
    return written.groupBy("window_id").agg(
        F.count("*").alias("n_events"),
        F.sum("file.size").alias("bytes"),
        F.count_if(~F.col("event.id").startswith("ev-")).alias("odd_rows"),
    )


@query(
    f"{RAW_CTE}, r as (select case when event_id % 3 = 0 and ts < timestamp '2024-01-11' then "
    "'late' else strftime(ts, 'files-%Y-%m-%d') end as target, strftime(ts, 'day-%j') as "
    "window_id, event_id from raw) select target, window_id, count(*) as n_events, "
    "min(event_id) as first_id from r group by 1, 2"
)
def catalog_targets(spark, sf):
    """A table made, written, written again in part, and listed, by its catalog name."""
    folder, name = run_folder(spark), f"targets_{uuid.uuid4().hex}"
    raw = raw_events(spark, sf).withColumn("geo", F.lit(None).cast(G.GEO))
    flat = N.type_flat(N.flatten_raw(raw, "geo"))
    inserted = F.col("insertionTimestamp")
    rows = R.route(flat, "files", inserted).withColumn(
        "window_id", F.concat(F.lit("day-"), F.date_format(inserted, "DDD"))
    )
    create_target(spark, name, FLAT_TARGET, path=f"{folder}/table")
    insert_targets(rows, name)
    # Days that are run again replace their rows, a third of which now has another target.
    again = rows.where(inserted < F.lit(utc(2024, 1, 11)))
    late = F.expr("cast(substring(eventId, 4) as bigint) % 3 = 0")
    insert_targets(again.withColumn("target", F.when(late, "late").otherwise(F.col("target"))), name)
    written = spark.table(name).groupBy("target", "window_id").agg(
        F.count("*").alias("n_events"),
        F.min(F.expr("cast(substring(eventId, 4) as bigint)")).alias("first_id"),
    )
    listed = target_partitions(spark, name).select("target", "window_id")
    return listed.join(written, ["target", "window_id"], "full").select(
        "target", "window_id", "n_events", "first_id"
    )


def shared_specs() -> list[QuerySpec]:
    def spec(name, hours, *filters, end="", **extra):
        return QuerySpec.from_dict({
            "name": name, "gap": timedelta(hours=hours), **extra,
            "groups": [{"filters": [
                *({"operator": "IS", "term": t, "value": v} for t, v in filters),
                {"operator": "ON_OR_AFTER", "term": "insertionTimestamp",
                 "value": "2024-01-01T00:00:00.000Z"},
                {"operator": "ON_OR_BEFORE", "term": "insertionTimestamp", "value": end},
            ]}]})

    return [
        spec("days", 24, base="files", route_by="onOrBefore"),
        spec("deleted", 12, ("eventType", "Deleted"), base="gone", layout="2006.01",
             route_by="insertionTimestamp"),
        spec("archives", 24, ("fileName", "*.tar.gz"), end="2024-01-20T00:00:00.000Z",
             base="archives", layout=""),
    ]


def _pulled_sql(name: str, hours: int, where: str, target: str, limit: str) -> str:
    stride, gap = hours * 3_600_000 + 1, hours * 3_600_000
    start, last = "epoch_ms(timestamp '2024-01-01')", f"epoch_ms(timestamp '{limit}')"
    mark = ID_SQL.replace("dailyA", f"{name}A")
    return (
        f"select '{name}' as query_name, {mark} as window_id, {target} as target, count(*) as "
        f"n_events from (select *, least(a + {gap}, {last}) as b from (select ts, {start} + ((epoch_us(ts) "
        f"// 1000 - {start}) // {stride}) * {stride} as a from raw where {where} and epoch_us(ts) // 1000 "
        f"<= {last})) group by 2, 3"
    )


@query(
    f"{RAW_CTE} " + " union all ".join([
        _pulled_sql("days", 24, "true", "strftime(make_timestamp(b * 1000), 'files-%Y-%m-%d')",
                    "2024-01-31 23:45:00"),
        _pulled_sql("deleted", 12, "\"eventType\" = 'Deleted'", "strftime(ts, 'gone-%Y.%m')",
                    "2024-01-31 23:45:00"),
        _pulled_sql("archives", 24, "\"fileName\" like '%.tar.gz'", "'archives'", "2024-01-20 00:00:00"),
    ])
)
def shared_pulls(spark, sf):
    """Three named queries with windows, filters and targets of their own, from one scan."""
    folder = run_folder(spark)
    written = ["eventId", "query_name", "window_id", "target"]
    run_pulls(
        raw_events(spark, sf), shared_specs(), f"{folder}/windows",
        lambda df: write_windows(df.select(*written), f"{folder}/out", "parquet"),
        as_of=LAST_LIMIT + W.SETTLE_LAG, started_at=utc(2024, 1, 1), options=Options(mode="raw"),
    )
    schema = "eventId string, target string, query_name string, window_id string"
    rows = spark.read.schema(schema).parquet(f"{folder}/out")
    return rows.groupBy("query_name", "window_id", "target").agg(F.count("*").alias("n_events"))


@query(
    f"{RAW_CTE} select {CLASS_SQL} as event_class, strftime(ts, '%Y-%m-%d') as day, count(*) as n_events, "
    "sum(fileSize)::bigint as bytes, count(nullif(createTimestamp, '')) as n_created, "
    "sum(len(privateIpAddresses))::bigint as n_private from raw group by 1, 2"
)
def landed_events(spark, sf):
    """Raw events landed as JSON lines with other field spellings, and read back."""
    folder = run_folder(spark)
    wire = {ours: theirs for theirs, ours in RAW_ALIASES.items()}
    raw_events(spark, sf).drop("event_id").withColumnsRenamed(wire).write.json(folder)
    raw = read_raw(spark, folder, aliases=RAW_ALIASES)
    day = F.date_format(E.insertion_time(F.col("insertionTimestamp")), "yyyy-MM-dd").alias("day")
    return raw.groupBy(E.event_class(F.col("eventType")).alias("event_class"), day).agg(
        F.count("*").alias("n_events"), F.sum("fileSize").alias("bytes"),
        F.count(E.omit_empty(F.col("createTimestamp"))).alias("n_created"),
        F.sum(F.coalesce(F.size("privateIpAddresses"), F.lit(0))).alias("n_private"),
    )


@query(
    f"{RAW_CTE} select {CLASS_SQL} as event_class, strftime(ts, 'files-%Y-%m') as target, "
    "osHostName as host, count(nullif(deviceUserName, '')) as n_users, count(*) as n_events "
    "from raw group by 1, 2, 3"
)
def alias_views(spark, sf):
    """A target table read by the name of an alias, with fields by their other names."""
    folder, name = run_folder(spark), f"aliased_{uuid.uuid4().hex}"
    raw = raw_events(spark, sf).withColumn("geo", F.lit(None).cast(G.GEO))
    flat = N.type_flat(N.flatten_raw(raw, "geo"))
    rows = R.route(flat, "files", F.col("insertionTimestamp"), "2006-01")
    create_target(spark, name, FLAT_TARGET, [f"{name}_all", f"{name}_too"], path=f"{folder}/table")
    insert_targets(rows.withColumn("window_id", F.lit("once")), name)
    seen = with_field_aliases(spark.table(f"{name}_too"))
    return seen.groupBy(E.event_class(F.col("eventType")).alias("event_class"), "target", "host").agg(
        F.count("username").alias("n_users"), F.count("*").alias("n_events")
    )


@query(
    "select strftime(ts, '%Y-%m-%d') as day, count(*) + count(*) filter (event_id % 30 = 0) as "
    "n_events, count(distinct event_id) as n_ids from events group by 1"
)
def stream_repeats(spark, sf):
    """Every third event lands twice; ids drop the repeats, events without one all stay."""
    folder = run_folder(spark)
    events = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 10 != 0, F.col("event_id").cast("string")).alias("eventId"),
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
    )
    events.unionAll(events.where("event_id % 3 = 0")).repartition(4).write.parquet(f"{folder}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    once = S.drop_repeats(source, F.col("ts"), within="60 days")
    run = (
        once.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    rows = spark.read.schema(events.schema).parquet(f"{folder}/out")
    return rows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n_events"), F.countDistinct("event_id").alias("n_ids")
    )


@query(
    f"{RAW_CTE} select event_id, \"eventId\" as id, nullif(\"eventType\", '') as type, case when event_id % 7 = 0 "
    "then epoch_ms(date_trunc('second', ts)) else epoch_ms(date_trunc('millisecond', ts)) end as happened_ms, "
    "epoch_ms(date_trunc('millisecond', ts)) as inserted_ms, \"filePath\" as path, \"fileName\" as name, "
    "nullif(\"fileType\", '') as file_type, nullif(\"fileCategory\", '') as category, \"fileOwner\" as owner, "
    "\"fileSize\" as size, nullif(\"md5Checksum\", '') as md5, nullif(\"sha256Checksum\", '') as sha256, "
    "case when event_id % 3 <> 0 then epoch_ms(date_trunc('millisecond', ts)) end as created_ms, "
    "case when event_id % 4 <> 0 then epoch_ms(date_trunc('second', ts)) end as modified_ms, "
    "nullif(\"mimeTypeByBytes\", '') as by_bytes, nullif(\"mimeTypeByExtension\", '') as by_extension, "
    "nullif(\"deviceUserName\", '') as username, \"deviceUid\" as uid, \"osHostName\" as os_host, "
    "\"domainName\" as domain, nullif(\"publicIpAddress\", '') as public_ip, array_to_string("
    "\"privateIpAddresses\", '|') as private_ips, nullif(actor, '') as actor, \"detectionSourceAlias\" as detected, "
    "nullif(\"operatingSystemUser\", '') as os_user, nullif(\"destinationCategory\", '') as destination from raw"
)
def envelope_fields(spark, sf):
    """The fields of the source envelope: the event, its file, its device and what stands beside."""
    raw = raw_events(spark, sf)
    s = N.normalize(raw, keep=("event_id",)).select("event_id", "source_event.*")
    return s.select(
        "event_id", "event.id", "event.type", ms("event.timestamp").alias("happened_ms"),
        ms("insertion_timestamp").alias("inserted_ms"), "file.path", "file.name",
        F.col("file.type").alias("file_type"), "file.category", "file.owner", "file.size",
        "file.hash.md5", "file.hash.sha256", ms("file.create_timestamp").alias("created_ms"),
        ms("file.modify_timestamp").alias("modified_ms"),
        F.col("file.mime_type_by_bytes").alias("by_bytes"),
        F.col("file.mime_type_by_extension").alias("by_extension"),
        "device.username", "device.uid", F.col("os_host_name").alias("os_host"),
        F.col("domain_name").alias("domain"), F.col("public_ip_address").alias("public_ip"),
        F.coalesce(joined("private_ip_addresses"), F.lit("")).alias("private_ips"), "actor",
        F.col("detection_source_alias").alias("detected"),
        F.col("operating_system_user").alias("os_user"),
        F.col("destination.category").alias("destination"),
    )


# --- geo lookups ----------------------------------------------------------------

AS_OF = utc(2024, 1, 30, 20)


def nation_cache(spark, sf) -> DataFrame:
    """Geo cache with one row per nation, plus an older duplicate of each."""
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    location = {
        "query": F.concat(F.lit("203.0.113."), F.col("n_nationkey")),
        "status": F.lit("success"),
        "country": F.col("n_name"),
        "continent": F.col("r_name"),
        "currency": F.lit("XXX"),
        "city": F.when(F.col("n_nationkey") % 4 == 0, "").otherwise(F.lower("n_name")),
        "lat": (F.col("n_nationkey") - 5).cast("float"),
        "lon": F.when(F.col("n_nationkey") != 7, F.col("n_nationkey") * 2).cast("float"),
        "mobile": F.col("n_nationkey") % 2 == 0,
    }
    whole = [
        location.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in G.GEO.fields
    ]
    now = nations.select(
        F.col("n_nationkey"),
        F.concat(F.lit("203.0.113."), F.col("n_nationkey")).alias("ip"),
        F.lit("").alias("lang"),
        F.lit(AS_OF - timedelta(hours=1)).alias("written_at"),
        F.when(F.col("n_nationkey") % 6 == 0, F.lit(AS_OF - timedelta(milliseconds=1)))
        .otherwise(F.lit(AS_OF))
        .alias("expiration_time"),
        F.struct(*whole).alias("location"),
    )
    older = now.withColumn("written_at", F.lit(AS_OF - timedelta(hours=5))).withColumn(
        "location", F.col("location").withField("country", F.lit("old"))
    ).withColumn("expiration_time", F.lit(AS_OF + timedelta(hours=5)))
    return now.unionByName(older).drop("n_nationkey")


NATION_GEO = (
    "geo as (select n_nationkey as k, concat('203.0.113.', n_nationkey) as ip, n_name as country, "
    "r_name as continent, nullif(case when n_nationkey % 4 = 0 then '' else lower(n_name) end, '') "
    "as city, n_nationkey not in (0, 5, 7) as has_point from nation join region "
    "on n_regionkey = r_regionkey where n_nationkey % 6 <> 0)"
)
ALL_FIELDS = ",".join(G.GEO.fieldNames())


@query(
    f"{RAW_CTE}, {NATION_GEO} select event_id, country as country_name, continent as "
    "continent_name, case when country is not null then 'XXX' end as currency, city as city_name, "
    "coalesce(has_point, false) as has_point, cast(case when has_point then k - 5 end as bigint) "
    "as lat from raw left join geo on nullif(publicIpAddress, '') = ip"
)
def geo_join(spark, sf):
    events = raw_events(spark, sf)
    rich = G.enrich_geo(events, nation_cache(spark, sf), AS_OF, fields=ALL_FIELDS)
    geo = E.geo_struct(F.col("geo"))
    return rich.select("event_id", geo.alias("g")).select(
        "event_id", "g.country_name", "g.continent_name", "g.currency", "g.city_name",
        F.col("g.location").isNotNull().alias("has_point"),
        F.col("g.location.lat").cast("bigint").alias("lat"),
    )


@query(
    f"{RAW_CTE}, {NATION_GEO} select country as country_name, count(*) as n_events, "
    "min(event_id) as first_id from raw left join geo on nullif(publicIpAddress, '') = ip group by 1"
)
def geo_join_spread(spark, sf):
    # The path for caches too large to broadcast.
    rich = G.enrich_geo(raw_events(spark, sf), nation_cache(spark, sf), AS_OF, broadcast_bytes=0)
    return rich.groupBy(F.col("geo.country").alias("country_name")).agg(
        F.count("*").alias("n_events"), F.min("event_id").alias("first_id")
    )


def lookup_results(spark, sf, *keep: str) -> DataFrame:
    """Every event as the answer to a lookup of its user."""
    status = (
        F.when(F.col("event_type") == "click", "fail")
        .when(F.col("event_type") == "view", "pending")
        .otherwise("success")
    )
    given = {"query": F.col("user_id").cast("string"), "status": status,
             "city": F.col("event_type")}
    location = F.struct(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in G.GEO.fields]
    )
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("ip"),
        F.when(F.col("user_id") % 2 == 0, "en").otherwise("").alias("lang"),
        F.col("ts").cast("timestamp").alias("written_at"),
        F.when(F.col("event_type") == "error", "timed out").alias("error"),
        F.when(F.col("event_type") != "error", location).alias("location"),
        *keep,
    )


UPSERTED = (
    "kept as (select cast(user_id as varchar) as ip, case when user_id % 2 = 0 then 'en' else '' "
    "end as lang, ts, event_type, row_number() over (partition by user_id order by ts desc) as rn "
    "from events where event_type <> 'view'), cache as (select ip, lang, epoch_us(ts) // 1000 as written, "
    "epoch_us(ts) // 1000 + case when event_type in ('click', 'error') then 1800000 else 28800000 end as "
    "expires_ms, case when event_type in ('click', 'error') then 'fail' else 'success' end as "
    "status, case when event_type = 'error' then 'timed out' end as message, case when event_type "
    "<> 'error' then event_type end as city from kept where rn = 1)"
)


@query(f"with {UPSERTED} select ip, lang, expires_ms, status, message, city from cache")
def geo_upsert(spark, sf):
    empty = spark.createDataFrame([], GEO_CACHE)
    first, rest = F.col("written_at") < F.lit(utc(2024, 1, 15)), lookup_results(spark, sf)
    cache = G.upsert_cache(empty, rest.where(first))
    cache = G.upsert_cache(cache, rest.where(~first))
    return cache.select(
        "ip", "lang", ms("expiration_time").alias("expires_ms"), "location.status",
        "location.message", "location.city",
    )


def user_cache(spark, sf) -> DataFrame:
    return G.upsert_cache(spark.createDataFrame([], GEO_CACHE), lookup_results(spark, sf))


@query(
    f"with {UPSERTED} select ip, lang, status from cache where expires_ms >= "
    "epoch_ms(timestamp '2024-01-30 20:00:00')"
)
def geo_fresh(spark, sf):
    return G.fresh(user_cache(spark, sf), AS_OF).select("ip", "lang", "location.status")


@query(
    f"with {UPSERTED}, k as (select distinct cast(c_custkey % 400 as varchar) as ip from customer "
    "where c_custkey % 7 <> 0) select ip, 'en' as lang from k where not exists (select 1 from "
    "cache c where c.ip = k.ip and c.lang = 'en' and expires_ms >= "
    "epoch_ms(timestamp '2024-01-30 20:00:00'))"
)
def geo_misses(spark, sf):
    asked = table(spark, sf, "customer").selectExpr(
        "case when c_custkey % 7 = 0 then '' else cast(c_custkey % 400 as string) end as ip_address"
    )
    return G.cache_misses(asked, user_cache(spark, sf), AS_OF, "ip_address", "en")


@query(
    "select cast(c_custkey as varchar) as ip, case when c_custkey % 2 = 0 or c_custkey % 3 <> 0 then 'success' "
    "else 'fail' end as status, c_name as city, epoch_ms(timestamp '2024-01-30 20:00:00') + case when "
    "c_custkey % 2 = 0 then 9 * 3600000 when c_custkey % 3 = 0 then 1800000 else 8 * 3600000 end as "
    "expires_ms, 2::bigint as version from customer"
)
def cache_snapshots(spark, sf):
    """Landed locations taken into a saved cache, twice; the last snapshot read back."""
    folder = run_folder(spark)
    customers = table(spark, sf, "customer")

    def land(name, rows, status):
        given = {"query": F.col("c_custkey").cast("string"), "city": F.col("c_name"), "status": status}
        rows.select(*[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in G.GEO.fields
        ]).write.parquet(f"{folder}/{name}")

    land("first", customers, F.when(F.col("c_custkey") % 3 == 0, "fail").otherwise("success"))
    land("second", customers.where("c_custkey % 2 = 0"), F.lit("success"))
    for i, name in enumerate(("first", "second")):
        found = read_locations(spark, f"{folder}/{name}", AS_OF + timedelta(hours=i))
        version = refresh_cache(found, f"{folder}/cache")
    return load_cache(spark, f"{folder}/cache").select(
        "ip", "location.status", "location.city", ms("expiration_time").alias("expires_ms"),
        F.lit(version).cast("bigint").alias("version"),
    )


@query(
    "with h as (select cast(user_id as varchar) as ip, ts as written, ts + case when event_type in "
    "('click', 'error') then interval 30 minute else interval 8 hour end as expires, event_type "
    "from events where event_type <> 'view' and user_id % 2 = 0), q as (select event_id, case "
    "when event_id % 10 <> 0 then cast(user_id as varchar) end as ip, ts + to_minutes(event_id % "
    "600) as t from events) select event_id, case when expires >= t then case when event_type in "
    "('click', 'error') then 'fail' else 'success' end end as status, case when expires >= t and "
    "event_type <> 'error' then event_type end as city from q asof left join h on q.ip = h.ip "
    "and q.t >= h.written"
)
def geo_as_of(spark, sf):
    """Every event's user looked up as the cache was up to ten hours after the event."""
    history = G.cache_history(lookup_results(spark, sf))
    asked = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 10 != 0, F.col("user_id").cast("string")).alias("ip_address"),
        (F.col("ts").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, cast(event_id % 600 as int))"))
        .alias("t"),
    )
    rich = G.enrich_as_of(asked, history, F.col("t"), "ip_address", "en")
    return rich.select("event_id", "geo.status", "geo.city")


@query(
    "select cast(user_id as varchar) as ip, 'en' as lang, 1::bigint as n_asked, count(*) as n_events "
    "from events where user_id % 3 <> 0 group by 1"
)
def stream_misses(spark, sf):
    """Events in four batches: every user without a cache row is asked for once."""
    folder = run_folder(spark)
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user"))
    events.repartition(4).write.parquet(f"{folder}/in")
    known = events.where("cast(user as bigint) % 3 = 0").select(
        F.col("user").alias("ip"), F.lit("en").alias("lang"), F.lit(AS_OF).alias("written_at"),
        F.lit(utc(2100, 1, 1)).alias("expiration_time"), F.lit(None).cast(G.GEO).alias("location"),
    )
    save_cache(known.distinct(), f"{folder}/cache")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run = L.start_misses(source, f"{folder}/asked", f"{folder}/cache", f"{folder}/checkpoint",
                         ip_col="user", lang="en", name=f"misses-{uuid.uuid4().hex}")
    run.awaitTermination()
    asked = L.asked_keys(spark, f"{folder}/asked").groupBy("ip", "lang").agg(F.count("*").alias("n_asked"))
    seen = events.groupBy(F.col("user").alias("ip")).agg(F.count("*").alias("n_events"))
    return asked.join(seen, "ip", "left").select("ip", "lang", "n_asked", "n_events")


@query(
    f"with {NATION_GEO.replace('where n_nationkey % 6 <> 0', '')} select ip, 'success' as status, "
    "country, cast(null as varchar) as currency, cast(null as varchar) as continent, ip as query, "
    "k % 2 = 0 as mobile from geo"
)
def geo_projection(spark, sf):
    cache = G.latest(nation_cache(spark, sf))
    some = G.project_location(F.col("location"), "status,country,mobile,currency")
    return cache.select("ip", some.alias("l")).select(
        "ip", "l.status", "l.country", "l.currency", "l.continent", "l.query", "l.mobile"
    )


@query(
    "with l as (select event_id % 3 = 0 as hit, case when event_type = 'error' then 'x' end as "
    "err, case event_type when 'click' then 'fail' when 'view' then 'pending' else 'success' end "
    "as st from events), c as (select *, not hit and err is null as ans, hit or (err is null "
    "and st = 'success') as good from l) select count(*) filter (hit) as cache_hits, count(*) "
    "filter (not hit) as lookups_forwarded, count(*) filter (good) as successful_lookups, "
    "count(*) filter (not hit and err is not null) as failed_requests, count(*) filter (ans and "
    "st = 'fail') as failed_queries, count(*) filter (good) as code_200, count(*) filter ((not "
    "hit and err is not null) or (ans and st = 'fail')) as code_400 from c"
)
def lookup_metrics(spark, sf):
    lookups = table(spark, sf, "events").selectExpr(
        "event_id % 3 = 0 as hit",
        "case when event_type = 'error' then 'x' end as error",
        "case event_type when 'click' then 'fail' when 'view' then 'pending' else 'success' end "
        "as status",
    )
    return M.lookup_metrics(lookups)


@query(
    f"with {UPSERTED} select count(*) as cached_total, count(*) filter (expires_ms >= "
    "epoch_ms(timestamp '2024-01-30 20:00:00')) as cached_current from cache"
)
def cache_metrics(spark, sf):
    return M.cache_metrics(user_cache(spark, sf), AS_OF)


@query(
    "select event_id, case event_type when 'error' then 'transport_error' when 'click' then "
    "'answered_fail' when 'view' then 'other' else 'success' end as kind, case event_type when "
    "'error' then 'timed out' end as message from events"
)
def lookup_outcomes(spark, sf):
    results = lookup_results(spark, sf, "event_id")
    return G.lookup_outcomes(results).select("event_id", "kind", "location.message")


# --- raw mode, routing, quality -------------------------------------------------


@query(
    f"{RAW_CTE}, {NATION_GEO} select event_id, \"eventId\", nullif(\"eventType\", '') as "
    "\"eventType\", \"insertionTimestamp\", nullif(\"publicIpAddress\", '') as "
    "\"publicIpAddress\", country, cast(case when has_point then k - 5 end as bigint) as "
    "point_lat from raw left join geo on nullif(publicIpAddress, '') = ip"
)
def raw_flat(spark, sf):
    rich = G.enrich_geo(raw_events(spark, sf), nation_cache(spark, sf), AS_OF)
    return N.flatten_raw(rich, "geo", keep=("event_id",)).select(
        "event_id", "eventId", "eventType", "insertionTimestamp", "publicIpAddress", "country",
        F.col("geoPoint.lat").cast("bigint").alias("point_lat"),
    )


@query(
    f"{RAW_CTE} select event_id, epoch_ms(date_trunc('millisecond', ts)) as inserted_ms, "
    "case when event_id % 4 <> 0 then epoch_ms(date_trunc('second', ts)) end as modified_ms, "
    "nullif(deviceUserName, '') as username, osHostName as hostname, osHostName as host, "
    "cast(case when event_id % 6 = 0 then 0 else 2 end as int) as n_private from raw"
)
def flat_target(spark, sf):
    raw = raw_events(spark, sf).withColumn("geo", F.lit(None).cast(G.GEO))
    flat = with_field_aliases(N.type_flat(N.flatten_raw(raw, "geo", keep=("event_id",))))
    return flat.select(
        "event_id",
        ms("insertionTimestamp").alias("inserted_ms"),
        ms("modifyTimestamp").alias("modified_ms"),
        "username", "hostname", "host",
        F.coalesce(F.size("privateIpAddress"), F.lit(0)).alias("n_private"),
    )


@query(
    "with e as (select ts, epoch_ms(timestamp '2024-01-01') + ((epoch_us(ts) - "
    f"epoch_us(timestamp '2024-01-01')) // {STRIDE_MS * 1000} + 1) * {STRIDE_MS} - 1 as b from "
    "events) select route, target, count(*) as n_events from (select 'timeNow' as route, "
    "'files-2024-02-01' as target from e union all select 'onOrBefore', strftime("
    "make_timestamp(b * 1000), 'files-%Y.%m.%d.%H') from e union all select 'eventTimestamp', "
    "strftime(ts, 'files-%Y-%m-%d') from e union all select 'insertionTimestamp', "
    "strftime(ts + interval 36 hour, 'files-%Y.%m') from e) group by 1, 2"
)
def route_targets(spark, sf):
    ev = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    ev = W.assign_tumbling(ev, F.col("ts"), utc(2024, 1, 1), GAP)
    inserted = F.col("ts") + F.expr("INTERVAL 36 HOURS")
    layouts = {
        "timeNow": "2006-01-02", "onOrBefore": "2006.01.02.15",
        "eventTimestamp": "2006-01-02", "insertionTimestamp": "2006.01",
    }

    def target(how: str) -> F.Column:
        time = R.routing_time(how, F.lit(utc(2024, 2, 1)), F.col("on_or_before"), F.col("ts"),
                              inserted)
        return F.struct(
            F.lit(how).alias("route"), target_name("files", time, layouts[how]).alias("target")
        )

    routed = ev.select(F.explode(F.array(*[target(h) for h in layouts])).alias("r"))
    return routed.groupBy("r.route", "r.target").agg(F.count("*").alias("n_events"))


@query(
    "select distinct strftime(o_orderdate, 'orders-%Y-%m') as target from orders where "
    "strftime(o_orderdate, 'orders-%Y-%m') not in (select strftime(l_shipdate + interval 120 day, "
    "'orders-%Y-%m') from lineitem)"
)
def targets_missing(spark, sf):
    needed = R.route(table(spark, sf, "orders"), "orders", F.col("o_orderdate"), "2006-01")
    closed = F.col("l_shipdate") + F.expr("INTERVAL 120 DAYS")
    existing = R.targets_needed(R.route(table(spark, sf, "lineitem"), "orders", closed, "2006-01"))
    return R.targets_missing(needed, existing)


USER_TEXT = (
    "case c_custkey % 6 when 0 then concat(c_name, '@', c_mktsegment) "
    "when 1 then concat(c_name, '@x.', c_mktsegment, '.example') when 2 then c_name "
    "when 3 then concat(c_name, '@-bad') when 4 then concat(repeat('a', 250), '@b.cd') "
    "else concat(c_name, '@a..b') end"
)


@query(
    # Written out by case: an address; a dotted one; no @; a label that begins with -; too
    # long (255 bytes); an empty label.
    "select c_custkey, c_custkey % 6 in (0, 1) as valid from customer"
)
def name_quality(spark, sf):
    users = table(spark, sf, "customer").selectExpr("c_custkey", f"{USER_TEXT} as u")
    return users.select("c_custkey", Q.valid_user_name(F.col("u")).alias("valid"))


TARGET_TEXT = (
    "case p_partkey % 8 when 0 then replace(p_name, ' ', '-') when 1 then p_name "
    "when 2 then p_brand when 3 then concat('_', replace(p_name, ' ', '')) "
    "when 4 then concat('a*', p_partkey) when 5 then '..' "
    "when 6 then repeat('x', cast(200 + p_size * 2 as int)) else '' end"
)


@query(
    f"with t as (select p_partkey, {TARGET_TEXT} as t from part), r as (select case when t = '' "
    "then 'empty' when regexp_matches(t, '[A-Z]') then 'capital letter' when contains(t, '*') "
    "then 'contains *' when contains(t, ' ') then 'contains space' when starts_with(t, '_') then "
    "'starts with _' when t = '..' then 'is ..' when length(t) > 255 then 'too long' end as "
    "problem from t) select problem, count(*) as n_targets from r group by 1"
)
def target_quality(spark, sf):
    names = table(spark, sf, "part").selectExpr(f"{TARGET_TEXT} as t")
    problem = Q.target_name_problem(F.col("t")).alias("problem")
    return names.groupBy(problem).agg(F.count("*").alias("n_targets"))
