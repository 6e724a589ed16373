"""URL decomposition as column expressions.

One regular expression both checks a URL and cuts it into its parts; every field is
then read from that array, so the text is scanned once per row. Readings that differ
from ``parse_url``: spaces in the path are accepted, hosts such as ``my_host`` and
bracketed IPv6 addresses are kept, paths are percent-decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetrail.functions.fields import omit_empty

SCHEME, USER, PASSWORD, HOST, PORT, PATH, QUERY, FRAGMENT = range(1, 9)

_CONTROL = r"\x00-\x1f\x7f"
_HEX = "[0-9a-fA-F]"


def _run(chars: str, escape: str = f"%{_HEX}{{2}}") -> str:
    """Text of the given characters and well-formed escapes, matched without backtracking."""
    return rf"[{chars}]*+(?:{escape}[{chars}]*+)*+"


_USER_CHAR = r"A-Za-z0-9\-._~!$&'()*+,;=%@"
_NOT_HOST = rf"^{_CONTROL} /?#@\\^`{{|}}%"
_HOST_ESCAPE = f"%(?:25|[89a-fA-F]{_HEX})"
_NAME = _run(rf"{_NOT_HOST}:\[\]", _HOST_ESCAPE)
_BRACKETED = _run(rf"{_NOT_HOST}\[\]", _HOST_ESCAPE)

# User and password are looked for only when there is an @, and the last @ ends them.
# A host with several colons, or a bracketed one without a port, has no separable
# host and port: it is accepted but not captured.
_AUTHORITY = (
    r"(?:(?<=:)|(?!///))//"
    rf"(?:(?=[^/?#@]*+@)(?![^/?#]*%(?!{_HEX}{{2}}))([{_USER_CHAR}]*)(?::([{_USER_CHAR}:]*))?@)?"
    rf"(?:\[({_BRACKETED})\]:(\d*+)|\[{_BRACKETED}\]|({_NAME})(?::(\d*+))?"
    rf"|(?!\[)[{_NOT_HOST}]*:\d*+)(?=[/?#]|\z)"
)
PARTS = (
    r"\A(?:([a-zA-Z][a-zA-Z0-9+.\-]*+):)?"
    rf"(?:(?<=:)[^/?#{_CONTROL}][^?#{_CONTROL}]*+"  # scheme:opaque, nothing more is read
    r"|(?:(?<=:)|(?![^/?#:]*+:))"  # no colon in a first segment
    rf"(?:{_AUTHORITY}|(?!//)|\A(?=///))({_run(rf'^?#%{_CONTROL}')}))"
    rf"(?:\?([^#{_CONTROL}]*+))?(?:#({_run(f'^%{_CONTROL}')}))?\z"
)
_CUT = "\u0001"  # a control character, so in no URL
_CAPTURED = ["", "$1", "$2", "$3", "$4$6", "$5$7", "$8", "$9", "$10"]


def _decode(c: Column) -> Column:
    """Percent-decoding that leaves '+' alone."""
    plain = F.replace(c, F.lit("+"), F.lit("%2B"))
    return F.when(c.contains("%"), F.try_url_decode(plain)).otherwise(c)


def url_parts(url: Column) -> Column:
    """Raw parts at the indexes above, '' when absent; one element if not a URL.

    Keep this in a column of its own (or a lambda variable) before reading parts from
    it, as :func:`url_info` and ``with_url_info`` do: then it is evaluated once.
    """
    uncut = F.when(~url.contains(_CUT), url)
    return F.split(F.regexp_replace(uncut, PARTS, _CUT.join(_CAPTURED)), _CUT)


def url_path(parts: Column) -> Column:
    return _decode(omit_empty(F.get(parts, F.lit(PATH))))


def url_struct(url: Column, parts: Column, path: Column, domains=None) -> Column:
    """Build the 12-field URL struct from a URL, its :func:`url_parts` and path.

    NULL for absent text; only ``full`` is filled when the text is not a URL.
    ``domains(domain) -> (registered, suffix)`` fills the two public-suffix fields,
    which stay NULL without it.
    """

    def raw(i: int) -> Column:
        return omit_empty(F.get(parts, F.lit(i)))

    def part(i: int) -> Column:
        return _decode(raw(i))

    none = F.lit(None).cast("string")
    domain = part(HOST)
    registered, suffix = domains(domain) if domains else (none, none)
    extension = F.when(path.contains(".") & ~path.endswith("."), F.substring_index(path, ".", -1))
    fields = {
        "full": url,
        "domain": domain,
        "extension": extension,
        "fragment": part(FRAGMENT),
        "path": path,
        "port": F.get(parts, F.lit(PORT)).try_cast("int"),
        "query": raw(QUERY),
        "scheme": F.lower(raw(SCHEME)),
        "username": part(USER),
        "password": part(PASSWORD),
        "registered_domain": registered,
        "top_level_domain": suffix,
    }
    return F.when(url != "", F.struct(*[c.alias(n) for n, c in fields.items()]))


def _bound(urls: Column, keep, build) -> Column:
    """Per array item, evaluate the parts, then the path, then ``build(item)`` on them."""
    cut = F.transform(urls, lambda t: F.struct(*keep(t), url_parts(t["url"]).alias("parts")))
    known = F.transform(
        cut, lambda t: F.struct(t.alias("t"), url_path(t["parts"]).alias("path"))
    )
    return F.transform(known, build)


def url_info(url: Column, domains=None) -> Column:
    """The URL struct as one expression, for use on a single column."""
    one = F.array(F.struct(url.alias("url")))
    built = _bound(
        one,
        lambda t: [t["url"].alias("url")],
        lambda k: url_struct(k["t"]["url"], k["t"]["parts"], k["path"], domains),
    )
    return F.get(built, F.lit(0))


def with_url_info(df: DataFrame, url: str, out: str) -> DataFrame:
    """Add the URL struct of column ``url`` as column ``out``."""
    df = df.withColumn("_parts", url_parts(F.col(url)))
    df = df.withColumn("_path", url_path(F.col("_parts")))
    built = url_struct(F.col(url), F.col("_parts"), F.col("_path"))
    return df.withColumn(out, built).drop("_parts", "_path")


def tab_list(tabs: Column, domains=None) -> Column:
    """Browser tabs as (title, decomposed URL), in order; NULL when there is none."""
    built = _bound(
        tabs,
        lambda t: [omit_empty(t["title"]).alias("title"), t["url"].alias("url")],
        lambda k: F.struct(
            k["t"]["title"].alias("title"),
            url_struct(k["t"]["url"], k["t"]["parts"], k["path"], domains).alias("url"),
        ),
    )
    return F.when(F.size(tabs) > 0, built)
