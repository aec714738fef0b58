"""Listing pages and the frontier (2.C)."""

from pyspark.sql import functions as F

from adloom.functions import jsonx as J
from adloom.functions import urls as U
from adloom.operators import crawl
from adloom.operators import frontier as L
from adloom.plans.pages import CLEAN
from adloom.plans.registry import query
from adloom.plans.urls import ADS_SITE, PAGES_SITE, pages
from adloom.sources.tables import spread
from adloom.sources.fixtures import fixture, with_fixtures

c = F.col

_HREFS = rf"regexp_extract_all({CLEAN}, '(?i)<a\s[^>]*?href=\"([^\"]*)\"', 1)"
_LINKS = rf"""WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+') AS origin, {_HREFS} AS hs FROM pages),
links AS (SELECT page_id, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS pos, unnest(hs) AS href, origin FROM h)
, resolved AS (SELECT page_id, pos, href,
  origin || list_reduce(list_transform(regexp_extract_all(href, '(?s).'), lambda x: CASE WHEN ascii(x) > 127 THEN url_encode(x) ELSE x END), lambda a, b: a || b) AS url FROM links)"""


@query("extract_links", _LINKS + " SELECT page_id, pos, href, url FROM resolved")
def extract_links(spark, d):
    return L.extract_links(pages(spark, d))


# the articles of the given pages link to word pages: two-letter words stand in for detail pages
WORD_SITE = U.SiteProfile(domain="example", detail_path=r"^/[A-Za-z]{2}$", ad_id_path=r"(\d+)$", listing_root="/")
_WORDS = _LINKS + """, words AS (SELECT page_id, url, min(pos) AS first_pos FROM resolved WHERE regexp_matches(href, '^/[A-Za-z][A-Za-z]$') GROUP BY ALL),
detail AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_pos) - 1 AS INTEGER) AS pos, url FROM words)"""


@query("detail_links", _WORDS + " SELECT page_id, pos, url FROM detail")
def detail_links(spark, d):
    return L.detail_links(pages(spark, d), WORD_SITE)


@query("frontier_limit", _WORDS + " SELECT page_id, pos, url FROM detail ORDER BY page_id, pos LIMIT 120")
def frontier_limit(spark, d):
    return L.frontier_limit(L.detail_links(pages(spark, d), WORD_SITE), ["page_id", "pos"], 120)


@query(
    "empty_listing_check",
    _WORDS
    + r""" SELECT page_id, trim(regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1)) AS title, length(html) AS html_chars,
  CASE WHEN length(regexp_replace(html, '[\s\x{00A0}\x{FEFF}]+', ' ', 'g')) > 300 THEN left(regexp_replace(html, '[\s\x{00A0}\x{FEFF}]+', ' ', 'g'), 300) || '…'
  ELSE regexp_replace(html, '[\s\x{00A0}\x{FEFF}]+', ' ', 'g') END AS snippet
FROM pages WHERE page_id NOT IN (SELECT page_id FROM detail)""",
)
def empty_listing_check(spark, d):
    return L.empty_listing_check(pages(spark, d), WORD_SITE)


def listing_rows(spark, d):
    return L.listing_pages(fixture(spark, d, "f_list", dealt_by="c_custkey"), ADS_SITE)


_NEXT = "CASE WHEN page_id % 12 <> 11 THEN listing || '?page=' || CAST(page_no + 1 AS VARCHAR) END"
_SITE = "'https://ads.example.com/"


@query("next_page_url", with_fixtures("f_list") + f" SELECT page_id, {_NEXT} AS next_url FROM f_list")
def next_page_url(spark, d):
    return listing_rows(spark, d).select("page_id", "next_url")


_TOTAL = "CASE WHEN page_id % 2 = 0 AND page_id > 0 THEN page_id * 3 ELSE 2 END"


@query("listing_total", with_fixtures("f_list") + f" SELECT page_id, CAST({_TOTAL} AS BIGINT) AS total FROM f_list")
def listing_total(spark, d):
    return listing_rows(spark, d).select("page_id", "total")


_URLS = f"""[{_SITE}flat_rentals_town-nj_' || CAST(1000 + k AS VARCHAR), {_SITE}room_rentals_city-tx_' || CAST(1001 + k AS VARCHAR),
  {_SITE}flat_rentals_town-nj_' || CAST(2000 + k AS VARCHAR)]"""
_ADS = "[1000 + k, 1001 + k, 2000 + k]"


@query(
    "embedded_listing_links",
    with_fixtures("f_list") + f" SELECT page_id, CAST(generate_subscripts({_URLS}, 1) - 1 AS INTEGER) AS pos, unnest({_URLS}) AS url FROM f_list",
)
def embedded_listing_links(spark, d):
    return listing_rows(spark, d).select("page_id", F.posexplode("detail_urls").alias("pos", "url"))


@query(
    "pagination_stop",
    with_fixtures("f_list")
    + f""", p AS (SELECT page_id, listing, url, page_no, {_NEXT} AS next_url, {_TOTAL} AS total, {_ADS} AS ads FROM f_list),
shown AS (SELECT listing, page_id, page_no, unnest(ads) AS ad FROM p), firsts AS (SELECT page_id FROM shown QUALIFY row_number() OVER (PARTITION BY listing, ad ORDER BY page_no) = 1),
new AS (SELECT page_id, count(*) AS n_new FROM firsts GROUP BY page_id),
progress AS (SELECT p.*, coalesce(n_new, 0) AS n_new, CAST(sum(coalesce(n_new, 0)) OVER w AS BIGINT) AS n_found, max(total) OVER w AS listing_total
  FROM p LEFT JOIN new USING (page_id) WINDOW w AS (PARTITION BY listing ORDER BY page_no))
SELECT page_id, next_url, n_new, n_found, listing_total, CASE WHEN page_no >= 11 THEN 'max_pages' WHEN n_new = 0 THEN 'no_new_ads' WHEN n_found >= listing_total THEN 'total_reached'
  WHEN next_url IS NULL THEN 'no_next' WHEN next_url IN (SELECT url FROM p WHERE page_no % 5 = 3) THEN 'seen' END AS stop_reason
FROM progress""",
)
def pagination_stop(spark, d):
    rows = listing_rows(spark, d).withColumn("total", F.col("total").cast("bigint"))
    seen = fixture(spark, d, "f_list").where("page_no % 5 = 3").select("url")
    out = L.pagination_stop(rows, seen, ADS_SITE, max_pages=11)
    return out.select("page_id", "next_url", "n_new", "n_found", "listing_total", "stop_reason")


@query(
    "crawl_rounds",
    with_fixtures("f_list")
    + f""", p AS (SELECT *, generate_subscripts({_URLS}, 1) - 1 AS pos, unnest({_URLS}) AS ad_url, unnest({_ADS}) AS ad FROM f_list),
ads AS (SELECT page_no AS round, page_no AS page, ad_url AS page_key, CAST(ad AS VARCHAR) AS ad_id FROM p QUALIFY row_number() OVER (PARTITION BY ad ORDER BY page_no, url, pos) = 1)
SELECT CAST(page_no - 1 AS INTEGER) AS round, 'LISTING' AS label, page_no AS page, url AS page_key, CAST(NULL AS VARCHAR) AS ad_id, true AS captured FROM f_list
UNION ALL SELECT page_no, 'LISTING', page_no + 1, {_NEXT}, NULL, false FROM f_list f WHERE page_id % 12 <> 11 AND NOT EXISTS (SELECT 1 FROM f_list g WHERE g.page_id = f.page_id + 1)
UNION ALL SELECT DISTINCT 12, 'LISTING', 13, 'https://ads.example.com/rentals?page=1', NULL, false FROM f_list WHERE page_id % 12 = 11
UNION ALL SELECT round, 'DETAIL', page, page_key, ad_id, false FROM ads""",
)
def crawl_rounds(spark, d):
    listings = fixture(spark, d, "f_list", dealt_by="c_custkey").select("page_id", "url", "html", "page_no")
    out = crawl.crawl_rounds(listings.drop("page_no"), listings.where("page_no = 1").select("url"), ADS_SITE)
    return out.select("round", "label", "page", "page_key", "ad_id", "captured")


@query(
    "fallback_listing_links",
    with_fixtures("f_list")
    + """, dead AS (SELECT * FROM f_list WHERE page_id % 3 = 2 AND page_id % 4 = 3)
SELECT 'https://ads.example.com/rentals?page=1' AS url, 'LISTING' AS label, CAST(min(page_no) + 1 AS INTEGER) AS page FROM dead
UNION ALL SELECT 'https://ads.example.com/rentals/more' || CAST(page_id % 7 AS VARCHAR), 'LISTING', CAST(min(page_no) + 1 AS INTEGER) FROM dead WHERE page_id % 7 <> 3 GROUP BY page_id % 7""",
)
def fallback_listing_links(spark, d):
    df = fixture(spark, d, "f_list", dealt_by="c_custkey")
    more = F.concat(F.lit('<a href="/rentals/more'), (c("page_id") % 7).cast("string"), F.lit('">m</a><a href="https://other.net/rentals">o</a></body>'))
    grown = df.withColumn("html", F.replace(c("html"), F.lit("</body>"), more))
    seen = spark.createDataFrame([("https://ads.example.com/rentals/more3/",)], "url string")
    return L.fallback_listing_links(grown, seen, ADS_SITE)


# the state of the first months: pages fetched, ads saved
FIRST_MONTHS = "scraped_at < TIMESTAMP '1995-03-15'"


@query(
    "frontier_dedup",
    with_fixtures("f_hist")
    + f""", k AS (SELECT *, 'https://ads.example.com/flat_rentals_town-nj_' || CAST(ad_id AS VARCHAR) AS page_key FROM f_hist)
SELECT page_key, ad_id, scraped_at, run_seq, pos, payload, url FROM k
WHERE NOT {FIRST_MONTHS} AND ad_id NOT IN (SELECT ad_id FROM f_hist WHERE {FIRST_MONTHS} AND metro = 'F')
  AND page_key NOT IN (SELECT page_key FROM k WHERE {FIRST_MONTHS} AND locality = 'R')
QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at, run_seq, pos, payload, url) = 1""",
)
def frontier_dedup(spark, d):
    hist = spread(fixture(spark, d, "f_hist"))
    early = F.col("scraped_at") < F.expr("TIMESTAMP_NTZ '1995-03-15'")
    old, new = hist.where(early), hist.where(~early)
    order = ["scraped_at", "run_seq", "pos", "payload"]
    return L.frontier_dedup(new, old.where("locality = 'R'"), old.where("metro = 'F'"), ADS_SITE, order)
