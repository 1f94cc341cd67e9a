"""ID1-ID3, ID10-ID18: URL identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    DOI, GENERIC_IMAGE_HOST, GENERIC_IMAGE_PATH, RELAY_URL, TRACKING_PARAM, UNSAFE_PATH, WS,
)
from .patterns import java, matches, strip, text
from .unicode import nfkc

_URL = r"(?i)^(https?)://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$"


def url_part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def _authority(url: Column) -> Column:
    scheme, host = F.lower(url_part(url, 1)), F.lower(url_part(url, 2))
    port = F.when(scheme == "http", F.lit(":80$")).otherwise(F.lit(":443$"))
    return F.regexp_replace(host, port, F.lit(""))


def normalize_url(raw: Column) -> Column:
    """ID1. Comparison form of a URL: no fragment, no tracking parameters, lower-case host, no trailing slash."""
    url = strip(text(raw))
    path = url_part(url, 3)
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = url_part(url, 4)
    params = F.filter(F.split(F.substr(query, F.lit(2)), "&"), lambda p: p != "")
    kept = F.filter(params, lambda p: ~F.regexp_like(F.split_part(p, F.lit("="), F.lit(1)), F.lit(TRACKING_PARAM)))
    # Only a query that lost a parameter is written anew; an untouched one stays as it was.
    rewritten = F.array_join(F.transform(kept, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("=")))), "&")
    search = F.when(F.size(kept) == F.size(params), query).otherwise(
        F.when(F.size(kept) == 0, F.lit("")).otherwise(F.concat(F.lit("?"), rewritten))
    )
    whole = F.concat(F.lower(url_part(url, 1)), F.lit("://"), _authority(url), path, search)
    return F.when(F.regexp_like(url, F.lit(_URL)), whole).otherwise(url)


def source_keys(*urls: Column) -> Column:
    """ID2. The distinct non-empty normalised URLs of an item."""
    return F.array_distinct(F.filter(F.array(*[normalize_url(u) for u in urls]), lambda k: k != ""))


def stable_item_id(urls: list[Column], seeds: list[Column]) -> Column:
    """ID3. ``v1_`` and 16 hex digits of the preferred URL, or of the joined seeds if there is no URL."""
    preferred = F.coalesce(*[F.nullif(normalize_url(u), F.lit("")) for u in urls])
    fallback = F.concat_ws("|", *[F.nullif(text(s), F.lit("")) for s in seeds])
    return F.concat(F.lit("v1_"), F.substring(F.sha2(F.coalesce(preferred, fallback), 256), 1, 16))


def host_of(url: Column) -> Column:
    """ID10. Lower-case host without ``www.``; empty for anything that is not a URL."""
    host = F.regexp_replace(F.lower(url_part(strip(text(url)), 2)), r"^[^@]*@|:\d*$", "")
    return F.regexp_replace(host, r"^www\.", "")


def path_of(url: Column) -> Column:
    path = url_part(strip(text(url)), 3)
    return F.when(path == "", F.lit("/")).otherwise(path)


def is_relay(url: Column) -> Column:
    """ID11."""
    return matches(text(url), RELAY_URL)


def is_safe_article_url(url: Column) -> Column:
    """ID12. https, no relay, no listing, login or subscription page."""
    raw = strip(text(url))
    is_https = F.lower(url_part(raw, 1)) == "https"
    full_host = F.regexp_replace(F.lower(url_part(raw, 2)), r"^[^@]*@|:\d*$", "")
    return is_https & ~is_relay(raw) & ~matches(F.concat(full_host, path_of(raw)), UNSAFE_PATH)


def host_suffixes(host: Column) -> Column:
    """All domains a host belongs to: ``a.b.c`` gives ``a.b.c``, ``b.c`` and ``c``."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def normalize_doi(value: Column) -> Column:
    """ID14. Bare DOI or null."""
    bare = F.regexp_replace(strip(text(value)), r"(?i)^doi:\s*", "")
    bare = F.regexp_replace(bare, r"(?i)^https?://(?:dx\.)?doi\.org/", "")
    return F.when(F.regexp_like(bare, F.lit(DOI)), F.regexp_replace(bare, r"[.,;)]+$", ""))


def _short(slug: Column, size: int) -> Column:
    """A slug over ``size`` characters is cut there and closed with a hash of the whole."""
    cut = F.regexp_replace(F.substring(slug, 1, size), "-+$", "")
    return F.when(F.length(slug) <= size, slug).otherwise(F.concat(cut, F.lit("-"), F.substring(F.md5(slug), 1, 8)))


def source_id(label: Column) -> Column:
    """ID15. Readable slug of a label; a label without usable characters falls back to its SHA-1."""
    slug = F.regexp_replace(F.lower(nfkc(text(label))), "[^a-z0-9가-힣]+", "-")
    slug = _short(F.regexp_replace(slug, "^-+|-+$", ""), 56)
    return F.concat(F.lit("src-"), F.when(slug != "", slug).otherwise(F.substring(F.sha1(text(label)), 1, 10)))


def article_slug(item_id: Column, title: Column, legacy_slug: Column) -> Column:
    """ID16. Legacy alias, else a stable id alone, else id and title."""
    words = F.regexp_replace(text(title), f"[^가-힣a-zA-Z0-9{WS}]", "")
    words = F.regexp_replace(strip(words), java(r"\s+"), "-")
    words = _short(F.regexp_replace(words, "-+$", ""), 40)
    named = F.when(words != "", F.concat(item_id, F.lit("-"), words)).otherwise(item_id)
    return F.coalesce(
        F.nullif(legacy_slug, F.lit("")),
        F.when(F.regexp_like(item_id, F.lit("^v1_[a-f0-9]{16}$")), item_id).otherwise(named),
    )


def clean_image_url(url: Column, base: Column) -> Column:
    """ID17. Absolute https image URL, or null for generic hosts and paths."""
    raw = strip(text(url))
    scheme, authority = F.lower(url_part(base, 1)), F.lower(url_part(base, 2))
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    resolved = (
        F.when(F.regexp_like(raw, F.lit(r"(?i)^https?://")), raw)
        .when(F.startswith(raw, F.lit("//")), F.concat(scheme, F.lit(":"), raw))
        .when(F.regexp_like(raw, F.lit(r"(?i)^[a-z][a-z0-9+.-]*:")), F.lit(None))
        .when(F.startswith(raw, F.lit("/")), F.concat(scheme, F.lit("://"), authority, raw))
        .otherwise(F.concat(scheme, F.lit("://"), authority, folder, raw))
    )

    def secure(u: Column) -> Column:
        generic = F.regexp_like(host_of(u), F.lit(GENERIC_IMAGE_HOST)) | F.regexp_like(path_of(u), F.lit(GENERIC_IMAGE_PATH))
        whole = F.concat(F.lit("https://"), F.lower(url_part(u, 2)), path_of(u), url_part(u, 4), url_part(u, 5))
        return F.when(F.regexp_like(u, F.lit(_URL)) & ~generic, whole)

    # The lambda binds the resolved URL, which the checks read many times.
    return F.when(raw != "", F.get(F.transform(F.array(resolved), secure), F.lit(0)))


def image_key(url: Column) -> Column:
    """ID18. Image identity without query and fragment."""
    return F.when(F.regexp_like(url, F.lit(_URL)), F.lower(F.regexp_replace(url, "[?#].*$", "")))
