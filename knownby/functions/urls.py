"""Request URL hygiene: redaction, predicates and the requested snapshot time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from knownby.domains import REDACTED, SENSITIVE_QUERY_KEYS
from knownby.functions.timeops import utc_z_instant

# Generic URI split of RFC 3986, appendix B.
_URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SCHEME, AUTHORITY, PATH, QUERY, FRAGMENT = range(1, 6)


def uri_part(url: Column, part: int) -> Column:
    return F.regexp_extract(url, _URI, part)


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def form_encode(text: Column) -> Column:
    """application/x-www-form-urlencoded, with ``~`` kept and ``*`` escaped."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(url: Column) -> Column:
    """array<struct<name, value>> in order; blank values kept, empty items dropped."""
    items = F.filter(F.split(uri_part(url, QUERY), "&"), lambda item: item != "")
    return F.transform(
        items,
        lambda item: F.struct(
            _decoded(F.substring_index(item, "=", 1)).alias("name"),
            F.when(
                item.contains("="),
                _decoded(item.substr(F.instr(item, "=") + 1, F.length(item))),
            )
            .otherwise("")
            .alias("value"),
        ),
    )


def _sensitive(name: Column, extra: Iterable[str] = ()) -> Column:
    return F.lower(name).isin(*SENSITIVE_QUERY_KEYS, *[k.lower() for k in extra])


def redact_url(url: Column, extra_sensitive: Iterable[str] = ()) -> Column:
    """Replace the values of sensitive query keys and re-encode the query."""
    extra = tuple(extra_sensitive)
    query = F.array_join(
        F.transform(
            query_pairs(url),
            lambda p: F.concat(
                form_encode(p["name"]),
                F.lit("="),
                form_encode(F.when(_sensitive(p["name"], extra), REDACTED).otherwise(p["value"])),
            ),
        ),
        "&",
    )
    scheme, fragment = F.lower(uri_part(url, SCHEME)), uri_part(url, FRAGMENT)
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(url.rlike(r"^(?:[^:/?#]+:)?//"), F.concat(F.lit("//"), uri_part(url, AUTHORITY))).otherwise(""),
        uri_part(url, PATH),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def url_violations(url: Column, extra_sensitive: Iterable[str] = ()) -> Column:
    """Codes of every broken hygiene rule of a request URL."""
    extra = tuple(extra_sensitive)
    return F.array_compact(
        F.array(
            F.when(F.lower(uri_part(url, SCHEME)) != "https", F.lit("NOT_HTTPS")),
            F.when(uri_part(url, AUTHORITY).contains("@"), F.lit("CREDENTIALS_IN_URL")),
            F.when(
                F.exists(query_pairs(url), lambda p: _sensitive(p["name"], extra)),
                F.lit("SENSITIVE_QUERY_KEY"),
            ),
        )
    )


def query_value(url: Column, name: str) -> Column:
    """Value of the last non-blank query pair called ``name``, else null."""
    hits = F.filter(query_pairs(url), lambda p: (p["name"] == name) & (p["value"] != ""))
    return F.try_element_at(hits, F.lit(-1))["value"]


def requested_snapshot_at(url: Column) -> Column:
    """The ``date`` query value as an instant; it has to be UTC with a ``Z``."""
    return utc_z_instant(query_value(url, "date"))
