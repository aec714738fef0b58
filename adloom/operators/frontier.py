"""Listing pages to crawl frontier: links, next pages, dedup, caps, stop rules.

Links are found and made distinct inside the page's row; the HTML is dropped before anything shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions import urls as U
from adloom.functions.text import first_where, let, null_if_empty, squeeze_ws, strip_ws, truncate_text
from adloom.operators.geo import look_up
from adloom.operators.ranking import first_n, first_per_key, running_sums
from adloom.session import checkpointed, settled


def extract_links(pages: DataFrame) -> DataFrame:
    """`page_id, pos, href, url` of every anchor."""
    found = pages.select("page_id", F.col("url").alias("base"), H.hrefs(F.col("html")).alias("hrefs"))
    rows = found.select("page_id", F.posexplode(F.arrays_zip("hrefs", U.resolve_all(F.col("hrefs"), F.col("base")).alias("url"))).alias("pos", "l"))
    return rows.select("page_id", "pos", F.col("l.hrefs").alias("href"), F.col("l.url").alias("url"))


def _detail_urls(hrefs: Column, base: Column, site: U.SiteProfile) -> Column:
    bare = F.transform(U.resolve_all(hrefs, base), U.strip_query)
    return F.array_distinct(F.filter(bare, lambda u: U.is_detail_url(u, site)))


def embedded_listing_urls(state: Column, base: Column, site: U.SiteProfile) -> Column:
    """Detail URLs of the listings inside the page state (a VARIANT)."""
    lists = [F.try_variant_get(state, f"$.props.pageProps.{k}", "array<variant>") for k in ("listings", "ads", "results", "data")]
    slugs = F.transform(
        F.coalesce(*lists, F.array().cast("array<variant>")),
        lambda v: F.coalesce(
            *[null_if_empty(F.try_variant_get(v, f"$.{k}", "string")) for k in ("slug", "url", "listingUrl", "canonicalUrl")]
        ),
    )
    return _detail_urls(F.filter(slugs, lambda s: s.isNotNull()), base, site)


def listing_total(state: Column) -> Column:
    """Reported number of ads; the number of embedded listings if that is missing or zero."""
    props = "$.props.pageProps"
    reported = F.coalesce(*[null_if_empty(F.try_variant_get(state, f"{props}.{k}", "string")) for k in ("totalCount", "total", "totalAds", "count")])
    listed = F.coalesce(*[F.try_variant_get(state, f"{props}.{k}", "array<variant>") for k in ("listings", "ads", "results", "data")])
    number = reported.try_cast("double").cast("bigint")
    return F.coalesce(F.nullif(number, F.lit(0).cast("bigint")), F.when(listed.isNotNull(), F.size(listed)).cast("bigint"), number)


def next_page_url(html: Column, state: Column, base: Column, site: U.SiteProfile) -> Column:
    """The "next" control of a page: `rel=next`, else a link named next or », else the page state."""
    links = F.regexp_extract_all(H.visible_html(html), F.lit(r"(?is)<a\s[^>]*>.*?</a>"), F.lit(0))

    def href(a: Column) -> Column:
        value = H.attr(F.regexp_extract(a, r"(?is)^<a(\s[^>]*)>", 1), "href")
        return F.when(~value.isin("", "#"), value)

    def name(a: Column) -> Column:
        return strip_ws(H.decode_entities(F.regexp_replace(a, "<[^>]*>", "")))

    def control(ls: Column) -> Column:
        by_rel = first_where(ls, lambda a: a.rlike(r"""(?i)^<a\s[^>]*\brel\s*=\s*["']?next["'\s>]""") & href(a).isNotNull())
        by_name = first_where(ls, lambda a: a.rlike("(?i)next|»|&raquo;") & F.lower(name(a)).isin("»", "next") & href(a).isNotNull())
        return let(F.coalesce(by_rel, by_name), href)

    def in_domain(u: Column) -> Column:
        return F.when(U.same_domain(u, site.domain), u)

    from_state = F.coalesce(
        *[null_if_empty(F.try_variant_get(state, f"$.props.pageProps.{p}", "string")) for p in ("nextPage", "pagination.nextPage", "pagination.next")]
    )
    resolved = [let(U.resolve_url(x, base), in_domain) for x in (let(links, control), from_state)]
    return F.coalesce(*resolved)


def listing_pages(pages: DataFrame, site: U.SiteProfile) -> DataFrame:
    """Per listing page: `detail_urls, next_url, total` next to the page's own columns, without the HTML. All are computed here, once: a filter on
    what was read stays behind the reading."""
    base, h = F.col("url"), F.col("html")
    parsed = pages.withColumns({"_state": J.json_next_data(h), "_hrefs": H.hrefs(h)})
    keep = [c for c in pages.columns if c != "html"]
    read = settled(parsed).select(
        *keep,
        F.array_union(_detail_urls(F.col("_hrefs"), base, site), embedded_listing_urls(F.col("_state"), base, site)).alias("detail_urls"),
        next_page_url(h, F.col("_state"), base, site).alias("next_url"),
        listing_total(F.col("_state")).alias("total"),
    )
    return settled(read)


def detail_links(pages: DataFrame, site: U.SiteProfile) -> DataFrame:
    """`page_id, pos, url`: distinct detail links of each page, first seen first."""
    found = pages.select("page_id", _detail_urls(H.hrefs(F.col("html")), F.col("url"), site).alias("urls"))
    return found.select("page_id", F.posexplode("urls").alias("pos", "url"))


def empty_listing_check(pages: DataFrame, site: U.SiteProfile) -> DataFrame:
    """Pages without any detail link, with what helps to tell a block page from an empty listing."""
    h = F.col("html")
    counted = pages.select("page_id", "html", F.size(_detail_urls(H.hrefs(h), F.col("url"), site)).alias("n"))
    return counted.where("n = 0").select(
        "page_id",
        H.page_title(h).alias("title"),
        F.length(h).cast("bigint").alias("html_chars"),
        truncate_text(squeeze_ws(h), 300).alias("snippet"),
    )


def frontier_dedup(candidates: DataFrame, seen_urls: DataFrame, seen_ids: DataFrame, site: U.SiteProfile, order: list[str]) -> DataFrame:
    """Candidates (`url, ad_id`, order columns) whose page and ad are both new; the first one per ad.

    Repeats collapse on the map side before the anti joins, so one ad linked from everywhere costs little.
    """
    keyed = candidates.withColumn("page_key", U.normalize_url(F.col("url"), site))
    once = first_per_key(keyed.select("page_key", "ad_id", *order, "url"), ["page_key", "ad_id"], order)
    known = seen_urls.select(U.normalize_url(F.col("url"), site).alias("page_key")).distinct()
    new = once.join(known, "page_key", "left_anti").join(
        seen_ids.where(F.col("ad_id").isNotNull()).select("ad_id").distinct(), "ad_id", "left_anti"
    )
    identity = new.withColumn("identity", F.coalesce(F.col("ad_id").cast("string"), F.col("page_key")))
    return first_per_key(identity, ["identity"], order).drop("identity")


def frontier_limit(links: DataFrame, order: list[str], max_items: int) -> DataFrame:
    return first_n(links, order, max_items)


def listing_progress(listings: DataFrame, site: U.SiteProfile) -> DataFrame:
    """Adds to listing pages (`listing, url, page_no, detail_urls, total`): `n_new`, the ads that no earlier page of the listing shows,
    `n_found`, the distinct ads so far, and `listing_total`, the largest total reported so far.

    Pages of a listing come in order of page number, then URL; repeated rows count one after the other. The first page of an ad is a
    minimum per (listing, ad), the sums run in two steps: neither an ad shown everywhere nor a listing of any length is one task.
    """
    # links come out of HTML: extract them once, then read the small table several times
    rows = checkpointed(listings.withColumn("_row", F.monotonically_increasing_id()))
    order = F.struct("page_no", "url", "_row")
    identity = F.coalesce(U.ad_id_from_url(F.col("ad"), site), F.col("ad"))
    shown = rows.select("listing", order.alias("page"), F.explode("detail_urls").alias("ad")).withColumn("ad", identity)
    firsts = shown.groupBy("listing", "ad").agg(F.min("page").alias("page"))
    new = firsts.groupBy(F.col("page._row").alias("_row")).agg(F.count(F.lit(1)).alias("n_new"))
    counted = rows.join(new, "_row", "left").withColumn("n_new", F.coalesce("n_new", F.lit(0).cast("bigint")))
    return running_sums(counted, "listing", ["page_no", "url", "_row"], {"n_found": F.col("n_new")}, {"listing_total": F.col("total")}).drop("_row")


def pagination_stop(
    listings: DataFrame, seen_urls: DataFrame, site: U.SiteProfile, max_pages: int = 0, max_items: int = 0, admitted: int = 0
) -> DataFrame:
    """Adds `stop_reason` to listing pages (`listing, url, page_no, detail_urls, next_url, total`), next to their progress.

    NULL means: fetch `next_url`. A page without a new ad ends its listing, and so does the page at which the distinct ads found so far
    reach the total reported so far.
    """
    known = seen_urls.select(U.normalize_url(F.col("url"), site).alias("next_key"), F.lit(True).alias("known")).distinct()
    progress = listing_progress(listings, site).withColumn("next_key", U.normalize_url(F.col("next_url"), site))
    joined = look_up(progress, known, ["next_key"])
    target_met = F.lit(bool(max_items > 0 and admitted >= max_items))
    reason = (
        F.when(target_met, "target")
        .when(F.lit(max_pages > 0) & (F.col("page_no") >= max_pages), "max_pages")
        .when(F.col("n_new") == 0, "no_new_ads")
        .when(F.coalesce(F.col("n_found") >= F.col("listing_total"), F.lit(False)), "total_reached")
        .when(F.col("next_url").isNull(), "no_next")
        .when(F.col("next_url") == F.col("url"), "same_page")
        .when(F.col("known"), "seen")
    )
    return joined.withColumn("stop_reason", reason).drop("next_key", "known")


def fallback_listing_links(pages: DataFrame, seen_urls: DataFrame, site: U.SiteProfile) -> DataFrame:
    """For pages without a next page: every unseen listing link of the site, one page further."""
    h, base = F.col("html"), F.col("url")
    state = settled(pages.select("page_id", "page_no", "url", "html", J.json_next_data(h).alias("_state")))
    read = settled(state.select("page_no", "url", "html", next_page_url(h, F.col("_state"), base, site).alias("_next")))
    dead_ends = read.where(F.col("_next").isNull())
    links = dead_ends.select("page_no", F.explode(F.array_distinct(U.resolve_all(H.hrefs(h), base))).alias("url"))
    listing = settled(links).where(U.is_listing_url(F.col("url"), site)).withColumn("page_key", U.normalize_url(F.col("url"), site))
    once = listing.groupBy("page_key").agg(F.min("url").alias("url"), (F.min("page_no") + 1).alias("page"))
    known = seen_urls.select(U.normalize_url(F.col("url"), site).alias("page_key")).distinct()
    return once.join(known, "page_key", "left_anti").select("url", F.lit("LISTING").alias("label"), "page")
