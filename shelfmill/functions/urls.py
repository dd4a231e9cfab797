"""URL functions: resolving, site rules, kinds and identifiers."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PROFILE, SiteProfile
from .columns import any_of, as_col, blank_to_null, let

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"


# A path that holds '.' or '..', or a relative one with '//'; parameters of its
# last segment don't belong to it.
_UNTIDY = r"^(?:[^?#]*/)?\.\.?(?:[/?#]|;[^/?#]*(?:[?#]|$)|$)|^[^/?#][^?#]*//"
_PATH = r"^((?:[^?#]*/)?[^/;?#]*)"


def _tidy_path(link: Column, origin: str) -> Column:
    """RFC 3986 removal of '.' and '..' from a link without authority."""
    path = F.regexp_extract(link, _PATH, 1)
    rooted = F.when(path.startswith("/"), path).otherwise(
        F.regexp_replace(F.concat(F.lit("/"), path), "/{2,}", "/")
    )
    drop_last = lambda acc: F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
    kept = lambda parts: F.aggregate(
        parts,
        F.expr("cast(array() as array<string>)"),
        lambda acc, seg: F.when(seg == "..", drop_last(acc))
        .when(seg == ".", acc)
        .otherwise(F.array_append(acc, seg)),
    )
    # A last '.' or '..' names a folder, so the path ends in '/'.
    marked = F.regexp_replace(rooted, r"(/\.\.?)$", "$1/")
    clean = F.array_join(kept(F.split(marked, "/")), "/")
    tail = F.regexp_extract(link, rf"(?s){_PATH}(.*)$", 2)
    return F.concat(F.lit(f"{origin}/"), F.regexp_replace(clean, "^/", ""), tail)


def resolve_url(href: Column | str, base: str = DEFAULT_PROFILE.base_url) -> Column:
    """Join a link with a fixed base (scheme and host). '' stays ''."""
    raw = as_col(href)
    root = urlsplit(base)
    scheme, origin = root.scheme, f"{root.scheme}://{root.netloc}"
    # White space and the base's own scheme go; what follows that is relative.
    bare = F.regexp_replace(raw, r"^[\x00-\x20]+|[\t\r\n]", "")
    own = bare.rlike(rf"^(?i:{scheme}):")
    rest = F.regexp_replace(bare, rf"^(?i:{scheme}):", "")
    # An empty fragment, query and parameter go, each only where it begins.
    for empty in (
        r"^([^#]*)#$", r"^([^?#]*)\?(?=#|$)",
        r"^(?!//[^/?#]+(?:[?#]|$))((?:[^?#]*/)?[^/;?#]*);(?=[?#]|$)",
    ):
        rest = F.regexp_replace(rest, empty, "$1")

    def joined(rest: Column) -> Column:
        local = F.regexp_replace(rest, r"^//(?=[/?#]|$)", "")
        return F.when(rest.rlike(r"^//[^/?#]"), F.concat(F.lit(f"{scheme}:"), rest)).otherwise(let(
            local, lambda path: F.when(path.rlike(_UNTIDY), _tidy_path(path, origin))
            .when(path.rlike(r"^(?:[/?#]|$)"), F.concat(F.lit(origin), path))
            .otherwise(F.concat(F.lit(f"{origin}/"), path)),
        ))

    return (
        F.when(raw.isNull() | (raw == ""), "")
        .when(~own & bare.rlike(rf"^{_SCHEME}:"), raw)
        .otherwise(let(rest, joined))
    )


def url_host(url: Column | str) -> Column:
    return F.regexp_extract(as_col(url), rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(as_col(url), rf"^(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)


def is_site_url(url: Column | str, domain: str = DEFAULT_PROFILE.domain) -> Column:
    """The domain is a substring of the host, case-sensitive."""
    return F.coalesce(url_host(url).contains(domain), F.lit(False))


def is_blocked_url(url: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Empty, with a fragment, or holding any blocked part."""
    url = as_col(url)
    hit = url.contains("#") | F.lower(url).rlike(any_of(profile.blocked_parts))
    return F.coalesce((url == "") | hit, F.lit(True))


def _site_page(url: Column, profile: SiteProfile) -> Column:
    return is_site_url(url, profile.domain) & ~is_blocked_url(url, profile)


def is_campaign_url(url: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    url = as_col(url)
    return _site_page(url, profile) & F.lower(url).rlike(any_of(profile.campaign_parts))


def is_product_url(url: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    url = as_col(url)
    return _site_page(url, profile) & F.lower(url).rlike(any_of(profile.product_parts))


def is_listing_url(url: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    url = as_col(url)
    low = F.lower(url)
    return (
        _site_page(url, profile)
        & ~low.rlike(any_of(profile.product_parts))
        & low.rlike(any_of(profile.listing_parts))
    )


def page_kinds(url: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """All kinds of a URL; campaign and product can both hold."""
    url = as_col(url)
    kinds = F.array(
        F.when(is_campaign_url(url, profile), "campaign"),
        F.when(is_listing_url(url, profile), "listing"),
        F.when(is_product_url(url, profile), "product"),
    )
    return F.array_compact(kinds)


def url_id(url: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Trailing number, else the id segment or its '-digits' tail, else the
    last path segment, else ''."""
    url = as_col(url)
    segment = F.regexp_extract(url, rf"/(?:{any_of(profile.id_segments)})/([^/?#]+)", 1)
    last = F.regexp_extract(
        F.rtrim(F.regexp_replace(url_path(url), r";[^/]*$", ""), F.lit("/")), r"([^/]*)$", 1
    )
    return F.coalesce(
        blank_to_null(F.regexp_extract(url, r"(?U)/(\d+)/?$", 1)),
        blank_to_null(F.regexp_extract(segment, r"(?U)-(\d+)$", 1)),
        blank_to_null(segment),
        last,
        F.lit(""),
    )


def is_http(url: Column | str) -> Column:
    return F.coalesce(as_col(url).startswith("http"), F.lit(False))


def same_url_key(url: Column | str) -> Column:
    """URL without trailing slashes: the form in which two URLs are compared."""
    return F.rtrim(as_col(url), F.lit("/"))
