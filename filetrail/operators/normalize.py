"""Raw events -> normalized nested records, and raw events -> flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetrail.functions import fields as E
from filetrail.functions import urls as U
from filetrail.operators.domains import add_domains, collect_rules, domain_lookup
from filetrail.schemas import FLAT_TARGET, GEO, RAW, RAW_TIMES


def with_raw_columns(df: DataFrame) -> DataFrame:
    """Add the raw columns the input lacks as typed NULLs; other columns stay."""
    have = set(df.columns)
    lacking = {
        f.name: F.lit(None).cast(f.dataType) for f in RAW.fields if f.name not in have
    }
    return df.withColumns(lacking) if lacking else df


def clean_raw(df: DataFrame, strip_zone: bool = False) -> DataFrame:
    """Empty text and empty lists of the raw columns become NULL.

    ``strip_zone`` also drops the ``%zone`` part of private addresses.
    """
    cleaned = {}
    for f in RAW.fields:
        if f.name not in df.columns:
            continue
        if isinstance(f.dataType, T.StringType):
            cleaned[f.name] = E.omit_empty(F.col(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            c = F.col(f.name)
            if strip_zone and f.name == "privateIpAddresses":
                c = E.strip_zone(c)
            cleaned[f.name] = E.omit_empty_list(c)
    return df.withColumns(cleaned)


def derive(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add the values several parts of the record share, one column each.

    As columns they are evaluated once per row, and the record expressions over them
    stay small.
    """
    return df.withColumns(
        {
            "_happened": E.event_time(F.col("eventTimestamp"), strict),
            "_inserted": E.insertion_time(F.col("insertionTimestamp"), strict),
            "_created": E.optional_time(F.col("createTimestamp"), strict),
            "_modified": E.optional_time(F.col("modifyTimestamp"), strict),
            "_hash": hash_struct(),
            "_email": E.user_email(F.col("deviceUserName"), F.col("actor")),
            "_user_id": E.user_id(F.col("operatingSystemUser"), F.col("userUid")),
        }
    )


def hash_struct() -> Column:
    return E.struct_if_any(md5=F.col("md5Checksum"), sha256=F.col("sha256Checksum"))


def event_struct(dataset: str, module: str) -> Column:
    return F.struct(
        F.col("eventType").alias("action"),
        F.lit("file").alias("category"),
        F.col("_happened").alias("created"),
        F.lit(dataset).alias("dataset"),
        F.col("eventId").alias("id"),
        F.col("_inserted").alias("ingested"),
        F.lit("event").alias("kind"),
        F.lit(module).alias("module"),
        F.lit(None).cast("string").alias("outcome"),
        F.lit(None).cast("string").alias("provider"),
        E.event_class(F.col("eventType")).alias("type"),
    )


def file_struct() -> Column:
    return F.struct(
        F.col("_created").alias("created"),
        F.col("directoryId").alias("directory"),
        E.extension(F.col("fileName")).alias("extension"),
        E.mime_list(F.col("mimeTypeByBytes"), F.col("mimeTypeByExtension")).alias("mime_type"),
        F.col("_modified").alias("mtime"),
        F.col("fileName").alias("name"),
        F.col("fileOwner").alias("owner"),
        F.col("filePath").alias("path"),
        F.col("fileSize").alias("size"),
        E.file_class(F.col("fileType")).alias("type"),
        F.col("_hash").alias("hash"),
    )


def host_struct(geo: Column | None = None) -> Column:
    location = F.lit(None).cast(GEO) if geo is None else geo
    return F.struct(
        F.col("deviceUid").alias("id"),
        F.col("osHostName").alias("name"),
        F.col("domainName").alias("hostname"),
        E.user(F.col("_email"), F.col("_user_id")).alias("user"),
        E.host_ips(F.col("privateIpAddresses"), F.col("publicIpAddress")).alias("ip"),
        E.geo_struct(location).alias("geo"),
    )


def _pick(**names: str) -> Column:
    """A struct of raw columns under other names; present even when all are NULL."""
    return F.struct(*[F.col(raw).alias(out) for out, raw in names.items()])


def source_struct(
    url: Column, tabs: Column, destination_name: str = "detectionSourceAlias"
) -> Column:
    """The source envelope: the vendor's own view of the event, typed and cleaned.

    ``destination_name`` is the raw column that fills ``destination.name``.
    """
    file = F.struct(
        F.col("filePath").alias("path"),
        F.col("fileName").alias("name"),
        F.col("fileType").alias("type"),
        F.col("fileCategory").alias("category"),
        F.col("mimeTypeByBytes").alias("mime_type_by_bytes"),
        F.col("mimeTypeByExtension").alias("mime_type_by_extension"),
        F.col("fileSize").alias("size"),
        F.col("fileOwner").alias("owner"),
        F.col("_hash").alias("hash"),
        F.col("_created").alias("create_timestamp"),
        F.col("_modified").alias("modify_timestamp"),
        F.col("fileId").alias("id"),
        F.col("mimeTypeMismatch").alias("mime_type_mismatch"),
        F.col("fileCategoryByBytes").alias("category_by_bytes"),
        F.col("fileCategoryByExtension").alias("category_by_extension"),
    )
    shared_with = F.when(
        F.size("sharedWith") > 0,
        F.transform(
            "sharedWith", lambda s: F.struct(s["cloudUsername"].alias("cloud_username"))
        ),
    )
    return F.struct(
        F.struct(
            F.col("eventId").alias("id"),
            F.col("eventType").alias("type"),
            F.col("_happened").alias("timestamp"),
        ).alias("event"),
        F.col("_inserted").alias("insertion_timestamp"),
        file.alias("file"),
        _pick(username="deviceUserName", uid="deviceUid").alias("device"),
        F.col("osHostName").alias("os_host_name"),
        F.col("domainName").alias("domain_name"),
        F.col("publicIpAddress").alias("public_ip_address"),
        F.col("privateIpAddresses").alias("private_ip_addresses"),
        F.col("actor").alias("actor"),
        F.col("directoryId").alias("directory_id"),
        F.col("source").alias("source"),
        url.alias("url"),
        F.col("shared").alias("shared"),
        shared_with.alias("shared_with"),
        F.col("sharingTypeAdded").alias("sharing_type_added"),
        F.col("cloudDriveId").alias("cloud_drive_id"),
        F.col("detectionSourceAlias").alias("detection_source_alias"),
        F.col("exposure").alias("exposure"),
        E.struct_if_any(owner=F.col("processOwner"), name=F.col("processName")).alias("process"),
        _pick(
            vendor="removableMediaVendor",
            name="removableMediaName",
            serial_number="removableMediaSerialNumber",
            capacity="removableMediaCapacity",
            bus_type="removableMediaBusType",
            media_name="removableMediaMediaName",
            volume_name="removableMediaVolumeName",
            partition_id="removableMediaPartitionId",
        ).alias("removable_media"),
        F.col("syncDestination").alias("sync_destination"),
        F.col("syncDestinationUsername").alias("sync_destination_username"),
        F.struct(
            F.col("emailDlpPolicyNames").alias("policy_names"),
            F.col("emailSubject").alias("subject"),
            F.col("emailSender").alias("sender"),
            F.col("emailFrom").alias("from"),
            F.col("emailRecipients").alias("recipients"),
        ).alias("email_dlp"),
        F.col("outsideActiveHours").alias("outside_active_hours"),
        _pick(job_name="printJobName", name="printerName").alias("print"),
        F.col("remoteActivity").alias("remote_activity"),
        F.col("trusted").alias("trusted"),
        F.col("operatingSystemUser").alias("operating_system_user"),
        _pick(category="destinationCategory", name=destination_name).alias("destination"),
        tabs.alias("tabs"),
    )


def normalize(
    df: DataFrame,
    geo_col: str | None = None,
    strip_zone: bool = False,
    rules: DataFrame | None = None,
    strict: bool = False,
    dataset: str = "file_activity",
    module: str = "file_activity",
    destination_name: str = "detectionSourceAlias",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw events -> ``event, @timestamp, file, host, source_event``.

    ``geo_col`` names a location struct column (see ``enrich_geo``); ``rules`` is a
    public-suffix table that fills the registered domain and suffix of every URL;
    ``keep`` lists input columns to carry along. A narrow map over the rows: nothing is
    joined and no row moves.
    """
    has_tabs = "tabs" in df.columns
    df = derive(with_raw_columns(clean_raw(df, strip_zone)), strict)
    df = U.with_url_info(df, "url", "_url")
    in_tabs = None
    if rules is not None:
        rows = collect_rules(rules)
        df, in_tabs = add_domains(df, "_url", rules, rows), domain_lookup(rules, rows)
    tabs = U.tab_list(F.col("tabs"), in_tabs)
    if not has_tabs:  # a lambda over NULL is not folded away, so leave it out
        tabs = F.lit(None).cast(df.select(tabs.alias("tabs")).schema["tabs"].dataType)
    return df.select(
        event_struct(dataset, module).alias("event"),
        F.col("_happened").alias("@timestamp"),
        file_struct().alias("file"),
        host_struct(F.col(geo_col) if geo_col else None).alias("host"),
        source_struct(
            F.col("_url"), tabs, destination_name
        ).alias("source_event"),
        *keep,
    )


def flatten_raw(
    df: DataFrame, geo_col: str, strip_zone: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Raw mode: raw fields, location fields beside them, and ``geoPoint``."""
    df = with_raw_columns(clean_raw(df, strip_zone))
    geo = F.col(geo_col)
    location = [
        (E.omit_empty(geo[f.name]) if isinstance(f.dataType, T.StringType) else geo[f.name]).alias(
            f.name
        )
        for f in GEO.fields
    ]
    return df.select(
        *[F.col(n) for n in RAW.fieldNames()],
        *location,
        E.geo_point(geo["lat"], geo["lon"]).alias("geoPoint"),
        *keep,
    )


def type_flat(df: DataFrame) -> DataFrame:
    """Flat records with typed times, as the flat target table holds them."""
    times = {n: E.insertion_time(F.col(n)) for n in RAW_TIMES}
    extra = [c for c in df.columns if c not in FLAT_TARGET.fieldNames()]
    return df.withColumns(times).select(*FLAT_TARGET.fieldNames(), *extra)
