"""Column expressions on URLs: canonical form, domain, relative references.

``parse_url`` rejects URLs that occur in real pages (a space in the path, for
one), so the parts are taken with the generic URI pattern instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import WHITESPACE

# Query keys that only track the visitor, compared in lower case.
TRACKING_KEYS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "gclid",
    "fbclid",
)

# 1 scheme, 2 "//" with authority, 3 authority, 4 path, 5 query
_WEB_URL = r"(?is)^(https?):(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
# 1 scheme, 2 "//" with authority, 3 authority, 4 path, 5 "?" with query, 6 "#" with fragment
_ANY_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?"
_IP_LITERAL = r"(?is)^(?:[^\[\]]*@)?\[(?:v[0-9a-f]+\..+|[0-9a-f.]*:[0-9a-f:.]*(?:%[^\]]*)?)\](?::.*)?$"


def _clean(url: Column) -> Column:
    """Drop surrounding white space, leading control characters, and tabs and line breaks."""
    stripped = F.regexp_replace(url, rf"^[{WHITESPACE}\x00-\x20]+|[{WHITESPACE}]+\z", "")
    return F.regexp_replace(stripped, r"[\t\r\n]", "")


def _decode(part: Column) -> Column:
    """Undo form encoding; a ``%`` that starts no escape is kept."""
    return F.url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(part: Column) -> Column:
    """Form encoding that leaves ``~`` bare and escapes ``*``."""
    return F.replace(
        F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical_query(query: Column) -> Column:
    """Pairs decoded, without blank values and tracking keys, sorted and encoded again."""
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)^[^=]*=."))
    decoded = F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "(?s)^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, "(?s)^[^=]*=(.*)", 1)).alias("v"),
        ),
    )
    kept = F.filter(decoded, lambda p: ~F.lower(p["k"]).isin(*TRACKING_KEYS))
    encoded = F.transform(
        F.array_sort(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))
    )
    return F.when(query == "", F.lit("")).otherwise(F.array_join(encoded, "&"))


def _parts(clean: Column) -> Column:
    """Parts of a URL; all empty unless it is an http(s) one."""
    return F.struct(
        F.lower(F.regexp_extract(clean, _WEB_URL, 1)).alias("scheme"),
        F.lower(F.regexp_extract(clean, _WEB_URL, 3)).alias("authority"),
        F.regexp_replace(F.regexp_extract(clean, _WEB_URL, 4), r"(?s);[^/]*\z", "").alias("path"),
        F.regexp_extract(clean, _WEB_URL, 5).alias("query"),
    )


def _join_parts(parts: Column) -> Column:
    scheme, authority, path = parts["scheme"], parts["authority"], parts["path"]
    rooted = F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, r"/\z", ""))
    slashes = F.when((authority != "") | (path == "") | path.startswith("/"), F.lit("//")).otherwise(F.lit(""))
    tail = _let(
        canonical_query(parts["query"]),
        lambda q: F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q)),
    )
    bad_host = authority.rlike(r"[\[\]]") & ~authority.rlike(_IP_LITERAL)
    return F.when((scheme == "") | bad_host, F.lit("")).otherwise(
        F.concat(scheme, F.lit(":"), slashes, authority, rooted, tail)
    )


def canonical_url(url: Column) -> Column:
    """One spelling per http(s) URL; ``""`` for anything else.

    A malformed bracketed host gives ``""`` as well, so that one bad link
    cannot fail a job.
    """
    return _let(_clean(url), lambda clean: _let(_parts(clean), _join_parts))


def url_domain(url: Column) -> Column:
    """Lower-cased authority, port included; ``""`` where there is none."""
    return F.lower(F.regexp_extract(url, _ANY_URL, 3))


def url_base(url: Column) -> Column:
    """``scheme://authority``, the key of the robots table."""
    return F.concat(F.lower(F.regexp_extract(url, _ANY_URL, 1)), F.lit("://"),
                    F.regexp_extract(url, _ANY_URL, 3))


def is_same_or_subdomain(candidate: Column, base: Column) -> Column:
    """True where ``candidate`` is ``base`` or a name below it."""
    return (candidate == base) | candidate.endswith(F.concat(F.lit("."), base))


def _remove_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(F.regexp_replace(path, r"(?s)(^|/)(\.\.?)\z", "$1$2/"), "/", -1)
    return F.array_join(
        F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda done, s: F.when(s == ".", done)
            .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
            .otherwise(F.array_append(done, s)),
        ),
        "/",
    )


def _split_reference(url: Column) -> Column:
    return F.struct(
        F.lower(F.regexp_extract(url, _ANY_URL, 1)).alias("scheme"),
        *[
            F.regexp_extract(url, _ANY_URL, group).alias(name)
            for name, group in (("authority", 2), ("path", 4), ("query", 5), ("fragment", 6))
        ],
        url.alias("whole"),
    )


def _resolve(base: Column, ref: Column) -> Column:
    scheme = base["scheme"]
    folder = F.regexp_replace(base["path"], r"(?s)[^/]*\z", "")
    # A path relative to the page's folder loses its empty segments; a rooted one keeps them.
    merged = F.when(ref["path"].startswith("/"), ref["path"]).otherwise(
        F.regexp_replace(F.concat(F.lit("/"), folder, ref["path"]), "/+", "/")
    )
    query = F.when(ref["query"] == "", base["query"]).otherwise(ref["query"])
    local = F.when(ref["path"] == "", F.concat(base["path"], query)).otherwise(
        F.concat(_remove_dots(merged), ref["query"])
    )
    foreign = (ref["scheme"] != "") & (ref["scheme"] != scheme)
    return (
        F.when(foreign, ref["whole"])
        .when(
            ref["authority"] != "",
            F.concat(scheme, F.lit(":"), ref["authority"], ref["path"], ref["query"], ref["fragment"]),
        )
        .otherwise(F.concat(scheme, F.lit(":"), base["authority"], local, ref["fragment"]))
    )


def resolve_url(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` as found on the page ``base`` (an http(s) URL)."""
    return _let(
        _split_reference(base),
        lambda b: _let(_clean(ref), lambda r: _let(_split_reference(r), lambda parts: _resolve(b, parts))),
    )
