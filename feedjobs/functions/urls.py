"""URL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track where a click came from.
TRACKING = ["fbclid", "gclid", "msclkid", "yclid", "ref", "ref_src", "ref_url", "source", "mc_cid", "mc_eid", "_hsenc", "_hsmi"]
TRACKING_PREFIX = "utm_"

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _decoded(value: Column) -> Column:
    """As web forms are read; a malformed escape stays as it is."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25")), value)


def _encoded(value: Column) -> Column:
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no trailing slashes, no tracking keys, sorted query, no fragment.

    Built-ins only. As web addresses are read, blanks and control characters before it, and tabs and line ends anywhere in it, are no part of it. The query is read and written again as web forms do, a key without value gets an empty one. Scheme and host may be missing.
    """
    tidy = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    parts = _once(tidy, lambda u: F.struct(*[F.regexp_extract(u, _PARTS, i).alias(n) for i, n in enumerate(("scheme", "host", "path", "query"), 1)]))
    return _once(parts, _joined)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _joined(parts: Column) -> Column:
    scheme, host, path, query = (parts[n] for n in ("scheme", "host", "path", "query"))
    path = F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", ""))
    named = F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(F.lit(""))
    placed = F.when(host != "", F.concat(F.lit("//"), F.lower(host), F.when((path != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit("")))).otherwise(F.lit(""))
    pair = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "(?s)^[^=]*=", "")).otherwise(F.lit("")).alias("v")))
    pair = F.transform(pair, lambda s: F.struct(_decoded(s["k"]).alias("k"), _decoded(s["v"]).alias("v")))
    kept = F.array_sort(F.filter(pair, lambda s: ~s["k"].startswith(TRACKING_PREFIX) & ~s["k"].isin(TRACKING)))
    text = F.array_join(F.transform(kept, lambda s: F.concat(_encoded(s["k"]), F.lit("="), _encoded(s["v"]))), "&")
    return F.concat(named, placed, path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")))


def is_repo_root(url: Column) -> Column:
    """A canonical URL of a repository's front page."""
    return url.rlike(r"^https://github\.com/[^/?]+/[^/?]+$")
