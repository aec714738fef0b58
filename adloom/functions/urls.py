"""URL parts, predicates and rewriting as column expressions.

One regular expression splits an absolute URL, so that unusual characters (which a strict URI
parser rejects) still give parts. Everything site-specific sits in `SiteProfile`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions.text import grab, let, null_if_empty

_ABSOLUTE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$"


@dataclass(frozen=True)
class SiteProfile:
    """What differs from site to site."""

    domain: str
    detail_path: str = r"^/[^/]+_rentals_[^/]+_\d+/?$"
    ad_id_path: str = r"_(\d+)/?$"
    listing_root: str = "/rentals"
    photo_path: str = ""


def is_absolute(u: Column) -> Column:
    return F.coalesce(u.rlike(_ABSOLUTE), F.lit(False))


def scheme(u: Column) -> Column:
    return F.lower(grab(u, _ABSOLUTE, 1))


def authority(u: Column) -> Column:
    return F.lower(grab(u, _ABSOLUTE, 2))


def host(u: Column) -> Column:
    return F.regexp_replace(authority(u), r"^[^@]*@|:\d+$", "")


def path(u: Column) -> Column:
    """Path with at least the root slash; NULL for anything that is not an absolute URL."""
    return F.when(is_absolute(u), F.coalesce(grab(u, _ABSOLUTE, 3), F.lit("/")))


def query(u: Column) -> Column:
    return F.coalesce(grab(u, _ABSOLUTE, 4), F.lit(""))


def origin(u: Column) -> Column:
    return F.concat(scheme(u), F.lit("://"), authority(u))


def percent_encoded(p: Column) -> Column:
    """Non-ASCII characters as UTF-8 percent escapes, the way browsers print URLs."""
    pieces = F.regexp_extract_all(p, F.lit(r"[^\x00-\x7F]|[\x00-\x7F]+"), F.lit(0))
    encoded = F.array_join(F.transform(pieces, lambda s: F.when(s.rlike(r"^[^\x00-\x7F]"), F.url_encode(s)).otherwise(s)), "")
    return F.when(p.rlike(r"[^\x00-\x7F]"), encoded).otherwise(p)


def same_domain(u: Column, domain: str) -> Column:
    return F.coalesce(F.contains(host(u), F.lit(domain)), F.lit(False))


def is_detail_url(u: Column, site: SiteProfile) -> Column:
    return F.coalesce(path(u).rlike(site.detail_path), F.lit(False))


def is_listing_url(u: Column, site: SiteProfile) -> Column:
    p, q, root = path(u), query(u), site.listing_root
    listing_path = (p == root) | p.startswith(root + "/") | p.endswith(root) | F.contains(u, F.lit(root + "?"))
    return F.coalesce(same_domain(u, site.domain) & (listing_path | q.rlike(r"page=\d+")), F.lit(False))


def ad_id_from_url(u: Column, site: SiteProfile) -> Column:
    return grab(path(u), site.ad_id_path)


def api_endpoint(u: Column) -> Column:
    return F.concat(origin(u), path(u))


def normalize_url(u: Column, site: SiteProfile | None = None) -> Column:
    """Identity of a page: no query, fragment or final slash. Listing pages keep their page number.

    Two regex passes for ordinary URLs; the listing test runs only where the text has a page number at all.
    """
    head = F.lower(F.regexp_extract(u, r"^[^:/?#]+://[^/?#]+", 0))
    rest = percent_encoded(F.regexp_extract(u, r"^[^:/?#]+://[^/?#]+([^?#]*)", 1))
    bare = F.concat(head, F.when(rest.endswith("/"), F.left(rest, F.length(rest) - 1)).otherwise(rest))
    if site is not None:
        number = grab(query(u), r"[?&](page=\d+)")
        numbered = F.contains(u, F.lit("page=")) & is_listing_url(u, site) & number.isNotNull()
        bare = F.when(numbered, F.concat(bare, F.lit("?"), number)).otherwise(bare)
    return F.when(is_absolute(u), bare).otherwise(u)


def strip_query(u: Column) -> Column:
    return F.regexp_replace(u, r"[?#].*$", "")


def page_url(u: Column, page: Column) -> Column:
    """The URL with `page=N` set in its query."""
    n = page.cast("string")
    frag = F.coalesce(grab(u, r"(#.*)$"), F.lit(""))
    base = F.regexp_replace(u, r"#.*$", "")
    replaced = F.regexp_replace(base, F.lit(r"([?&])page=[^&]*"), F.concat(F.lit("$1page="), n))
    glue = F.when(base.rlike(r"\?.+$"), F.lit("&page=")).when(base.rlike(r"\?$"), F.lit("page=")).otherwise(F.lit("?page="))
    with_page = F.when(base.rlike(r"[?&]page="), replaced).otherwise(F.concat(base, glue, n))
    return F.when(is_absolute(u), F.concat(with_page, frag)).otherwise(F.concat(u, F.lit("?page="), n))


def _without_dots(p: Column) -> Column:
    """Resolve `.` and `..` segments by folding over the segments of the path."""
    segments = F.split(p, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    joined = F.array_join(kept, "/")
    # a final dot segment names a directory
    joined = F.when(p.rlike(r"/\.{1,2}$"), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(p.rlike(r"(^|/)\.{1,2}(/|$)"), joined).otherwise(p)


def base_parts(base: Column) -> Column:
    """What resolving needs to know about the page URL, worked out once per page."""
    return F.struct(
        scheme(base).alias("scheme"), origin(base).alias("origin"), path(base).alias("path"), query(base).alias("query")
    )


def resolve_against(href: Column, b: Column) -> Column:
    def join(h: Column) -> Column:
        directory = F.regexp_replace(b["path"], r"[^/]*$", "")
        return (
            F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), h)
            .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
            .when(h.startswith("//"), F.concat(b["scheme"], F.lit(":"), h))
            .when(h.startswith("/"), F.concat(b["origin"], h))
            .when(h.startswith("?"), F.concat(b["origin"], b["path"], h))
            .when((h == "") | h.startswith("#"), F.concat(b["origin"], b["path"], b["query"], h))
            .otherwise(F.concat(b["origin"], directory, h))
        )

    def finish(j: Column) -> Column:
        fragment = F.coalesce(grab(j, r"(#.*)$"), F.lit(""))
        clean_path = percent_encoded(_without_dots(path(j)))
        return F.when(is_absolute(j), F.concat(origin(j), clean_path, query(j), fragment))

    # most links are plain paths from the root: nothing to rewrite
    plain = r"^/[A-Za-z0-9_~%+=&,;:@!$'()*-][A-Za-z0-9_~%+=&,;:@!$'()*/-]*$"
    return let(
        F.regexp_replace(href, r"^\s+|\s+$", ""),
        lambda h: F.when(h.rlike(plain), F.concat(b["origin"], h)).otherwise(let(join(h), finish)),
    )


def resolve_url(href: Column, base: Column) -> Column:
    """Absolute form of `href` as found on page `base`; NULL if it cannot be resolved to a web URL."""
    return let(href, lambda h: let(base_parts(base), lambda b: resolve_against(h, b)))


def resolve_all(hrefs: Column, base: Column) -> Column:
    return let(base_parts(base), lambda b: F.transform(hrefs, lambda h: resolve_against(h, b)))


def route_label(label: Column, u: Column, site: SiteProfile) -> Column:
    return F.coalesce(null_if_empty(label), F.when(is_detail_url(u, site), "DETAIL").otherwise("LISTING"))
