"""Column expressions for the single fields of a normalized event.

Every function takes and returns a ``Column``; nothing here reads a table or the
clock. Inputs are cleaned columns (see :func:`filetrail.operators.normalize.clean_raw`)
in which an absent value is NULL, but an empty string is accepted too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the source marks a device user it could not name.
NAME_NOT_AVAILABLE = "NAME_NOT_AVAILABLE"

# Event class by lower-case event type; anything else is "info".
EVENT_CLASSES = {"created": "creation", "modified": "change", "deleted": "deletion"}

# File class by lower-case file type; anything else is "unknown".
FILE_CLASSES = {
    "file": ["file", "win_nds", "mac_rsrc", "fifo", "bundle"],
    "dir": ["dir", "block_device", "char_device"],
    "symlink": ["symlink"],
}

TIME_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{3})?Z?$"


def omit_empty(c: Column) -> Column:
    """'' becomes NULL."""
    return F.when(c != "", c)


def omit_empty_list(c: Column) -> Column:
    """[] becomes NULL."""
    return F.when(F.size(c) > 0, c)


def any_present(*cols: Column) -> Column:
    """True when at least one column is not NULL, whatever the types."""
    found = cols[0].isNotNull()
    for c in cols[1:]:
        found = found | c.isNotNull()
    return found


def struct_if_any(**fields: Column) -> Column:
    """A struct of the fields, or NULL when all of them are NULL."""
    return F.when(
        any_present(*fields.values()), F.struct(*[c.alias(n) for n, c in fields.items()])
    )


def event_class(event_type: Column) -> Column:
    kind = F.lower(event_type)
    out = F
    for word, value in EVENT_CLASSES.items():
        out = out.when(kind == word, value)
    return out.otherwise("info")


def file_class(file_type: Column) -> Column:
    kind = F.lower(file_type)
    out = F
    for value, words in FILE_CLASSES.items():
        out = out.when(kind.isin(words), value)
    return out.otherwise("unknown")


def event_time(c: Column, strict: bool = False, required: bool = True) -> Column:
    """UTC text with no or exactly three fraction digits -> timestamp.

    Text that does not parse gives NULL, or fails the query when ``strict``. With
    ``required=False`` absent text is NULL even when strict.
    """
    # The trailing Z makes the cast independent of the session time zone.
    zoned = F.when(c.endswith("Z"), c).otherwise(F.concat(c, F.lit("Z")))
    parsed = F.when(c.rlike(TIME_TEXT), zoned.try_cast("timestamp"))
    if not strict:
        return parsed
    failure = F.raise_error(F.concat(F.lit("not an event time: "), F.coalesce(c, F.lit("NULL"))))
    out = F.when(parsed.isNotNull(), parsed)
    if not required:
        out = out.when(c.isNull() | (c == ""), F.lit(None).cast("timestamp"))
    return out.otherwise(failure.cast("timestamp"))


def insertion_time(c: Column, strict: bool = False) -> Column:
    """As :func:`event_time`, with longer fractions cut (not rounded) to milliseconds."""
    cut = F.when(F.length(c) > len("2020-01-02T03:04:05.678Z"), F.substring(c, 1, 23))
    return event_time(cut.otherwise(c), strict)


def optional_time(c: Column, strict: bool = False) -> Column:
    return event_time(c, strict, required=False)


def mime_list(by_bytes: Column, by_extension: Column) -> Column:
    """[bytes, extension] when they differ, else [bytes]; absent values count as ''."""
    a, b = F.coalesce(by_bytes, F.lit("")), F.coalesce(by_extension, F.lit(""))
    return F.when(a != b, F.array(a, b)).otherwise(F.array(a))


def extension(file_name: Column) -> Column:
    """Text after the last dot of the last path part; NULL when there is none."""
    base = F.substring_index(file_name, "/", -1)
    return F.when(
        base.contains(".") & ~base.endswith("."), F.substring_index(base, ".", -1)
    )


def user_email(device_user: Column, actor: Column) -> Column:
    return omit_empty(F.when(device_user == NAME_NOT_AVAILABLE, actor).otherwise(device_user))


def user_name(email: Column) -> Column:
    """Text before the first @, when there is one."""
    return F.when(email.rlike("^[^@]+@"), F.substring_index(email, "@", 1))


def user_domain(email: Column) -> Column:
    """Text after the first @, up to the next."""
    return F.when(email.rlike("^[^@]*@[^@]"), F.split_part(email, F.lit("@"), F.lit(2)))


def user_id(os_user: Column, user_uid: Column) -> Column:
    """The operating-system user wins unless it is absent or not available."""
    named = F.when((os_user != "") & (os_user != NAME_NOT_AVAILABLE), os_user)
    return F.coalesce(named, omit_empty(user_uid))


def user(email: Column, user_id: Column) -> Column:
    """Identity struct; NULL for nobody. Name and domain are parts of the e-mail."""
    return F.when(
        any_present(email, user_id),
        F.struct(
            email.alias("email"),
            user_id.alias("id"),
            user_name(email).alias("name"),
            user_domain(email).alias("domain"),
        ),
    )


def strip_zone(ips: Column) -> Column:
    """Drop the ``%zone`` part of every address in the list."""
    return F.transform(ips, lambda ip: F.substring_index(ip, "%", 1))


def host_ips(private_ips: Column, public_ip: Column) -> Column:
    """Private addresses, then the public one; NULL when there is none."""
    none = F.array().cast("array<string>")
    private = F.coalesce(private_ips, none)
    public = F.when(F.length(public_ip) > 0, F.array(public_ip)).otherwise(none)
    return omit_empty_list(F.concat(private, public))


def geo_point(lat: Column, lon: Column) -> Column:
    """lat/lon struct, only when both are present and neither is zero."""
    return F.when((lat != 0) & (lon != 0), F.struct(lat.alias("lat"), lon.alias("lon")))


# Fixed names: location field -> normalized geo field, in output order.
GEO_NAMES = {
    "status": "status",
    "message": "message",
    "continent": "continent_name",
    "continentCode": "continent_iso_code",
    "country": "country_name",
    "countryCode": "country_iso_code",
    "region": "region_iso_code",
    "regionName": "region_name",
    "city": "city_name",
    "district": "district",
    "zip": "postal_code",
    "lat": "lat",
    "lon": "lon",
    "timezone": "timezone",
    "currency": "currency",
    "isp": "isp",
    "org": "org",
    "as": "as",
    "asname": "as_name",
    "reverse": "reverse",
    "mobile": "mobile",
    "proxy": "proxy",
    "hosting": "hosting",
    "query": "query",
}


def geo_struct(location: Column) -> Column:
    """Normalized geo struct of a location struct; NULL when there is no location."""
    renamed = [
        (omit_empty(location[n]) if n not in ("lat", "lon", "mobile", "proxy", "hosting")
         else location[n]).alias(out)
        for n, out in GEO_NAMES.items()
    ]
    point = geo_point(location["lat"], location["lon"]).alias("location")
    return F.when(location.isNotNull(), F.struct(*renamed, point))
