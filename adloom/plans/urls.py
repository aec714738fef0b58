"""Sources (2.A, scans) and URL operators (2.B)."""

from pyspark.sql import functions as F

from adloom.functions import urls as U
from adloom.functions.urls import SiteProfile
from adloom.plans.registry import query
from adloom.sources import tables as S
from adloom.sources.fixtures import fixture, with_fixtures

# the given pages come from many example hosts, their articles are `/<lang>/<number>`
PAGES_SITE = SiteProfile(
    domain="example.com", detail_path=r"^/[a-z]{2}/\d+(\.html)?/?$", ad_id_path=r"/(\d+)(?:\.html)?/?$"
)
ADS_SITE = SiteProfile(domain="ads.example.com")

# SQL pieces for the oracles
PATH = "regexp_replace(regexp_replace(url, '[?#].*', ''), '^[a-z]+://[^/]+', '')"
HOST = "regexp_extract(url, '://([^/?#]+)', 1)"
DETAIL = rf"regexp_matches({PATH}, '^/[a-z][a-z]/[0-9]+([.]html)?/?$')"
LISTING = f"(contains({HOST}, 'example.com') AND contains(regexp_extract(url, '[?][^#]*'), 'page=2'))"


def pages(spark, d):
    return S.scan_pages(spark, f"{d}/pages.parquet")


@query("scan_pages", "SELECT page_id, url, html FROM pages")
def scan_pages(spark, d):
    return pages(spark, d)


@query(
    "seed_frontier",
    f"SELECT url, CASE WHEN {DETAIL} THEN 'DETAIL' ELSE 'LISTING' END AS label, CAST(1 AS INTEGER) AS page FROM pages",
)
def seed_frontier(spark, d):
    return S.seed_frontier(pages(spark, d).select("url"), PAGES_SITE)


_ACCEPTED = """SELECT * FROM f_api WHERE (content_type LIKE '%application/json%' OR content_type LIKE '%text/plain%')"""


@query(
    "capture_filter",
    with_fixtures("f_api")
    + f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY arrival) AS r FROM ({_ACCEPTED}))
SELECT page_id, url, arrival, content_type, status, body FROM ranked WHERE r = 1 AND url NOT LIKE '%.png%' AND length(body) >= 10""",
)
def capture_filter(spark, d):
    return S.capture_filter(fixture(spark, d, "f_api"))


@query(
    "payload_first_per_url",
    with_fixtures("f_api")
    + """ SELECT page_id, url, arrival, content_type, status, body FROM f_api
QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY arrival) = 1""",
)
def payload_first_per_url(spark, d):
    return S.payload_first_per_url(fixture(spark, d, "f_api"))


def _per_page(name, expr):
    def run(spark, d):
        return pages(spark, d).select("page_id", expr(F.col("url")).alias(name))

    return run


def _page_sql(name, sql):
    return f"SELECT page_id, {sql} AS {name} FROM pages"


query("is_detail_url", _page_sql("is_detail", DETAIL))(_per_page("is_detail", lambda u: U.is_detail_url(u, PAGES_SITE)))
query("is_listing_url", _page_sql("is_listing", LISTING))(
    _per_page("is_listing", lambda u: U.is_listing_url(u, PAGES_SITE))
)
query("same_domain", _page_sql("same_domain", f"contains({HOST}, 'example.com')"))(
    _per_page("same_domain", lambda u: U.same_domain(u, "example.com"))
)
query("ad_id_from_url", _page_sql("ad_id", rf"nullif(regexp_extract({PATH}, '/([0-9]+)(?:[.]html)?/?$', 1), '')"))(
    _per_page("ad_id", lambda u: U.ad_id_from_url(u, PAGES_SITE))
)
_NORMAL = "regexp_replace(regexp_replace(url, '[?#].*', ''), '/$', '')"
query("normalize_url", _page_sql("normalized", f"CASE WHEN {LISTING} THEN {_NORMAL} || '?page=2' ELSE {_NORMAL} END"))(
    _per_page("normalized", lambda u: U.normalize_url(u, PAGES_SITE))
)
query(
    "page_url",
    _page_sql(
        "page_url",
        """CASE WHEN contains(url, '?page=2') THEN replace(url, '?page=2', '?page=3')
           WHEN contains(url, '?') THEN url || '&page=3'
           WHEN contains(url, '#') THEN replace(url, '#', '?page=3#') ELSE url || '?page=3' END""",
    ),
)(_per_page("page_url", lambda u: U.page_url(u, F.lit(3))))
query("api_endpoint", _page_sql("endpoint", "regexp_extract(url, '^[^?#]*')"))(_per_page("endpoint", U.api_endpoint))
query(
    "route_label",
    _page_sql("label", f"CASE WHEN page_id % 5 = 0 THEN 'LISTING' WHEN {DETAIL} THEN 'DETAIL' ELSE 'LISTING' END"),
)(
    lambda spark, d: pages(spark, d).select(
        "page_id",
        U.route_label(F.when(F.col("page_id") % 5 == 0, "LISTING"), F.col("url"), PAGES_SITE).alias("label"),
    )
)

_HREFS = ["/r/x", "y/z?k=1", "../up", "./here", "?page=9", "#frag", "//cdn.example.net/a", "https://o.example.org/b#c", "mailto:a@example.com"]


@query(
    "resolve_url",
    rf"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+:') AS proto, regexp_extract(url, '^[a-z]+://[^/]+') AS origin,
  {PATH} AS path FROM pages),
q AS (SELECT *, regexp_replace(path, '[^/]*$', '') AS dir, regexp_extract(url, '[?][^#]*') AS qs FROM p)
SELECT page_id, href, CASE href
  WHEN '/r/x' THEN origin || href
  WHEN 'y/z?k=1' THEN origin || dir || href
  WHEN '../up' THEN origin || regexp_replace(dir, '[^/]+/$', '') || 'up'
  WHEN './here' THEN origin || dir || 'here'
  WHEN '?page=9' THEN origin || path || href
  WHEN '#frag' THEN origin || path || qs || href
  WHEN '//cdn.example.net/a' THEN proto || href
  WHEN 'https://o.example.org/b#c' THEN href END AS resolved
FROM q, (SELECT unnest([{", ".join(f"'{h}'" for h in _HREFS)}]) AS href) h""",
)
def resolve_url(spark, d):
    hrefs = F.explode(F.array(*[F.lit(h) for h in _HREFS]))
    return (
        pages(spark, d)
        .select("page_id", "url", hrefs.alias("href"))
        .select("page_id", "href", U.resolve_url(F.col("href"), F.col("url")).alias("resolved"))
    )
