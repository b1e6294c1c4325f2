"""URL expressions. All are plain columns; hosts outside ASCII have an Arrow function of their own."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.functions.text import strip

_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
_NETLOC = r"^(\[[^\]]*\]|[^:\[\]]*)(?::(.*))?$"
#: Paths that are files rather than pages (fixed values).
ASSET_SUFFIXES = (
    "7z", "avi", "bmp", "css", "csv", "doc", "docx", "exe", "gif", "gz", "ico", "jpeg", "jpg", "js", "json", "mkv", "mov", "mp3", "mp4", "pdf", "png", "ppt", "pptx", "rar",
    "rss", "svg", "tar", "tgz", "tif", "tiff", "txt", "wav", "webm", "webp", "xml", "xls", "xlsx", "zip",
)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(strip(url), _URL, group)


def canonical_url(url: Column, ascii_host: Column | None = None) -> Column:
    """Canonical form of an absolute HTTP(S) URL, or null.

    White space around it, the default port, the fragment and a final dot of the
    host go, scheme and host are lower-cased, an empty path is ``/``. Query
    order, an explicit empty query and the path's case stay. Null for other
    schemes, user information, control characters and bad ports. Hosts outside
    ASCII need ``ascii_host`` (see idna_host), else they give null.
    """
    clean = strip(url)
    netloc = F.regexp_extract(clean, _URL, 2)
    parts = F.struct(
        clean.alias("clean"), F.lower(F.regexp_extract(clean, _URL, 1)).alias("scheme"), netloc.alias("netloc"), F.regexp_extract(clean, _URL, 3).alias("path"), F.regexp_extract(clean, _URL, 4).alias("query"),
        (_plain_host(netloc) if ascii_host is None else ascii_host).alias("host"), F.regexp_extract(netloc, _NETLOC, 2).alias("port"),
    )

    def put_together(p: Column) -> Column:
        number = F.when(p["port"].rlike(r"^[0-9]{1,9}$"), p["port"].cast("int"))
        valid = (
            (p["scheme"].isin("http", "https")) & ~p["clean"].rlike(r"[\x00-\x1f]") & ~p["netloc"].contains("@") & p["netloc"].rlike(_NETLOC)
            & (p["host"] != "") & p["host"].rlike(r"^[\x21-\x7e]+$") & ((p["port"] == "") | (number <= 65535))
        )
        default = F.when(p["scheme"] == "http", 80).otherwise(443)
        shown_port = F.when((p["port"] != "") & (number != default), F.concat(F.lit(":"), number.cast("string"))).otherwise("")
        return F.when(valid, F.concat(p["scheme"], F.lit("://"), p["host"], shown_port, F.when(p["path"] == "", "/").otherwise(p["path"]), p["query"]))

    return F.get(F.transform(F.array(parts), put_together), F.lit(0))  # the parts are taken once, whatever uses them


def _plain_host(netloc: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_extract(netloc, _NETLOC, 1), r"\.+$", ""))


@F.pandas_udf(T.StringType())
def idna_host(url: pd.Series) -> pd.Series:
    """ASCII form of a URL's host, for hosts outside ASCII; null if there is none."""
    from urllib.parse import urlsplit

    def one(value):
        try:
            host = urlsplit(value.strip()).hostname.rstrip(".")
            return f"[{host}]" if ":" in host else host.encode("idna").decode("ascii").lower()
        except (AttributeError, UnicodeError, ValueError):
            return None

    return url.map(one)


def any_canonical_url(url: Column) -> Column:
    """canonical_url, also of hosts outside ASCII, which alone go through the Arrow function."""
    netloc = _part(url, 2)
    odd = F.coalesce(netloc.rlike(r"[^\x00-\x7f]"), F.lit(False))
    return canonical_url(url, F.when(odd, idna_host(F.when(odd, url))).otherwise(_plain_host(netloc)))


def host_of(url: Column) -> Column:
    """Lower-cased host without port and user information; empty if there is none."""
    netloc = F.regexp_replace(_part(url, 2), r"^.*@", "")
    return F.lower(F.coalesce(F.regexp_replace(F.regexp_extract(netloc, _NETLOC, 1), r"^\[|\]$", ""), F.lit("")))


def http_url(url: Column) -> Column:
    """The trimmed value if it is an absolute HTTP(S) URL, else null."""
    return F.when(strip(url).rlike(r"(?i)^https?://[^/?#]+"), strip(url))


def is_page_url(url: Column) -> Column:
    """Whether the path doesn't end like a file's."""
    return ~F.lower(_part(url, 3)).rlike(r"\.(" + "|".join(ASSET_SUFFIXES) + ")$")


def domain_matches(host: Column, domain: Column | str) -> Column:
    """The host is the domain or below it; case and final dots don't count."""
    tidy = lambda c: F.regexp_replace(F.lower(c), r"\.+$", "")
    h, d = tidy(host), tidy(F.lit(domain) if isinstance(domain, str) else domain)
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


def matches_any(host: Column, domains: Column | Sequence[str]) -> Column:
    """Whether the host matches any of an array (or list) of domains."""
    listed = domains if isinstance(domains, Column) else F.array(*(F.lit(d) for d in domains)).cast("array<string>")
    return F.exists(listed, lambda d: domain_matches(host, d))
