"""Column functions on URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import blank_to_null


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)


def host(url: Column) -> Column:
    """Lower-case host without user, port, path, query or fragment."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(blank_to_null(authority))


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def without_query(url: Column) -> Column:
    return F.split_part(F.split_part(url, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1))


def resolve_url(href: Column, base: Column) -> Column:
    """Absolute form of a link found on the page ``base``."""
    page = without_query(base)
    folder = F.concat(origin(page), F.regexp_extract(page, r"^[^:]+://[^/]*((?:/.*)?/)", 1))
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin(base), href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.split_part(base, F.lit("#"), F.lit(1)), href))
        .when(href != "", F.concat(folder, href))
    )


def canonical_url(url: Column) -> Column:
    """https, no query, no fragment."""
    return F.regexp_replace(without_query(url), "^http://", "https://")


def page_address(url: Column, drop_query: Column | bool = False, force_https: Column | bool = False) -> Column:
    """A page's address without its fragment; query and scheme stay unless a rule drops them."""
    drop, force = (F.coalesce(x, F.lit(False)) if isinstance(x, Column) else F.lit(x) for x in (drop_query, force_https))
    plain = F.when(drop, without_query(url)).otherwise(F.split_part(url, F.lit("#"), F.lit(1)))
    return F.when(force, F.regexp_replace(plain, "^http://", "https://")).otherwise(plain)


def url_category(url: Column, add_slash: Column | bool = False) -> Column:
    """Last path segment before a trailing slash; null when there is none."""
    add = F.lit(add_slash) if isinstance(add_slash, bool) else add_slash
    # fixed value: the pattern that defines a category
    slashed = F.when(add & ~url.endswith("/"), F.concat(url, F.lit("/"))).otherwise(url)
    return blank_to_null(F.regexp_extract(slashed, "([^/]*)/$", 1))
