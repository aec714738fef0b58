"""Keyed state (2.H), sinks of it (2.A) and run statistics (2.I)."""

from pyspark.sql import functions as F

from adloom.operators import quality as Q
from adloom.operators import state as St
from adloom.plans.listings import FIRST_MONTHS
from adloom.plans.registry import query
from adloom.plans.urls import pages
from adloom.session import new_table_path
from adloom.sources import tables as S
from adloom.sources.tables import spread
from adloom.sources.fixtures import fixture, table, with_fixtures

c = F.col
HIST_COLUMNS = ["ad_id", "scraped_at", "run_seq", "pos", "url", "lat", "locality", "metro", "payload"]
HIST_SCHEMA = "ad_id BIGINT, scraped_at TIMESTAMP_NTZ, run_seq BIGINT, pos INT, url STRING, lat DOUBLE, locality STRING, metro STRING, payload STRING"
_ORDER = "scraped_at, run_seq, pos, payload, url"
_DESC = "scraped_at DESC, run_seq DESC, pos DESC, payload DESC, url DESC"


def history(spark, d):
    hist = spread(fixture(spark, d, "f_hist")).select(*HIST_COLUMNS)
    early = c("scraped_at") < F.expr("TIMESTAMP_NTZ '1995-03-15'")
    return hist.where(early), hist.where(~early)


_HIST = with_fixtures("f_hist")


@query("skip_seen", _HIST + f" SELECT ad_id, run_seq, pos FROM f_hist WHERE NOT {FIRST_MONTHS} AND ad_id NOT IN (SELECT ad_id FROM f_hist WHERE {FIRST_MONTHS})")
def skip_seen(spark, d):
    old, new = history(spark, d)
    return St.skip_seen(new.select("ad_id", "run_seq", "pos"), old)


@query("mark_seen", _HIST + " SELECT DISTINCT ad_id FROM f_hist")
def mark_seen(spark, d):
    old, new = history(spark, d)
    return St.mark_seen(old, new)


@query("dedup_by_ad", _HIST + f" SELECT {', '.join(HIST_COLUMNS)} FROM f_hist QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY {_ORDER}) = 1")
def dedup_by_ad(spark, d):
    return St.dedup_by_ad(spread(fixture(spark, d, "f_hist")).select(*HIST_COLUMNS))


@query("save_cap", _HIST + f" SELECT {', '.join(HIST_COLUMNS)} FROM f_hist ORDER BY {_ORDER} LIMIT 500")
def save_cap(spark, d):
    return St.save_cap(spread(fixture(spark, d, "f_hist")).select(*HIST_COLUMNS), 500)


# every row is on one side; some ads are only stored, some only fresh, most on both
_STORED = f"(ad_id % 7 = 0 OR ({FIRST_MONTHS} AND ad_id % 7 <> 1))"
_SIDES = f""", stored AS (SELECT * FROM f_hist WHERE {_STORED} QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY {_DESC}) = 1),
fresh AS (SELECT * FROM f_hist WHERE NOT {_STORED} QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY {_DESC}) = 1)"""
_REFRESH = (
    _HIST
    + _SIDES
    + """ SELECT coalesce(n.ad_id, o.ad_id) AS ad_id, CASE WHEN n.ad_id IS NULL THEN o.payload ELSE n.payload END AS payload, CASE WHEN n.ad_id IS NULL THEN o.lat ELSE n.lat END AS lat,
  CASE WHEN n.ad_id IS NULL THEN o.locality ELSE n.locality END AS locality,
  CASE WHEN n.ad_id IS NULL OR (o.lat IS NOT NULL AND o.locality IS NOT NULL AND o.metro IS NOT NULL) THEN o.metro ELSE n.metro END AS metro FROM stored o FULL JOIN fresh n ON n.ad_id = o.ad_id"""
)
_SHOWN = ["ad_id", "payload", "lat", "locality", "metro"]


def sides(spark, d):
    hist = spread(fixture(spark, d, "f_hist")).select(*HIST_COLUMNS)
    early = c("scraped_at") < F.expr("TIMESTAMP_NTZ '1995-03-15'")
    stored = (c("ad_id") % 7 == 0) | (early & (c("ad_id") % 7 != 1))
    return hist.where(stored), hist.where(~stored)


def _both(spark, d):
    old, new = sides(spark, d)
    return St.latest_by_ad(old), St.latest_by_ad(new)


@query("upsert_refresh", _REFRESH)
def upsert_refresh(spark, d):
    return St.upsert_refresh(*_both(spark, d)).select(*_SHOWN)


@query(
    "upsert_geo_only",
    _HIST
    + _SIDES
    + """ SELECT coalesce(o.ad_id, n.ad_id) AS ad_id, CASE WHEN o.ad_id IS NULL THEN n.payload ELSE o.payload END AS payload,
  CASE WHEN patch THEN n.lat ELSE o.lat END AS lat, CASE WHEN patch THEN n.locality ELSE o.locality END AS locality, CASE WHEN patch THEN n.metro ELSE o.metro END AS metro
  FROM (SELECT o, n, o.ad_id IS NULL OR (n.ad_id IS NOT NULL AND (o.lat IS NULL OR o.locality IS NULL OR o.metro IS NULL)) AS patch FROM stored o FULL JOIN fresh n ON n.ad_id = o.ad_id)""",
)
def upsert_geo_only(spark, d):
    return St.upsert_geo_only(*_both(spark, d)).select(*_SHOWN)


@query("upsert_ads", _REFRESH)
def upsert_ads(spark, d):
    old, new = sides(spark, d)
    path = new_table_path(spark, "ads-store")
    St.upsert_ads(spark, path, old, HIST_SCHEMA)
    return St.upsert_ads(spark, path, new, HIST_SCHEMA).select(*_SHOWN)


@query("seen_state_io", _HIST + " SELECT DISTINCT ad_id FROM f_hist")
def seen_state_io(spark, d):
    old, new = history(spark, d)
    path = new_table_path(spark, "seen")
    for batch in (old, new):
        St.save_seen(St.mark_seen(St.load_seen(spark, path), batch), path)
    return St.load_seen(spark, path)


# ---- runs ------------------------------------------------------------------------------------

_KINDS = "CASE event_type WHEN 'view' THEN 'pages_crawled' WHEN 'purchase' THEN 'ads_found' WHEN 'signup' THEN 'ads_scraped' WHEN 'error' THEN 'error' ELSE 'api' END"
_LOG = f"""SELECT user_id AS run_id, {_KINDS} AS kind, 'https://api.example.com/v' || CAST(event_id % 5 AS STRING) || '?e=' || CAST(event_id AS STRING) AS url,
  ts, 'attempt ' || CAST(value AS STRING) AS message FROM events"""


def crawl_log(spark, d):
    table(spark, d, "events").createOrReplaceTempView("events")
    return spark.sql(_LOG)


_STATS = f"""WITH log AS ({_LOG}) SELECT run_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS {k}" for k in Q.COUNTERS)},
  count(*) FILTER (kind = 'error') AS error_count, count(DISTINCT CASE WHEN kind = 'api' THEN split_part(url, '?', 1) END) AS endpoints FROM log GROUP BY run_id"""


@query("run_stats", _STATS)
def run_stats(spark, d):
    return Q.run_stats(crawl_log(spark, d))


@query("write_run_stats", _STATS)
def write_run_stats(spark, d):
    path = new_table_path(spark, "run-stats")
    stats = Q.run_stats(crawl_log(spark, d))
    S.write_snapshot(stats, path)
    return S.read_snapshot(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields))


@query("endpoint_set", "SELECT DISTINCT regexp_extract(url, '^[^?#]*') AS endpoint FROM pages")
def endpoint_set(spark, d):
    return Q.endpoint_set(pages(spark, d))


@query(
    "error_log",
    """WITH log AS (SELECT 'https://ads.example.com/p/' || CAST(user_id AS VARCHAR) AS url, ts, 'status ' || props AS message FROM events WHERE event_type = 'error')
SELECT url, count(*) AS attempts, max(ts) AS last_ts, arg_max(message, ts) AS last_message FROM log GROUP BY url""",
)
def error_log(spark, d):
    log = table(spark, d, "events").select(
        F.concat(F.lit("https://ads.example.com/p/"), c("user_id").cast("string")).alias("url"), F.when(c("event_type") == "error", "error").alias("kind"),
        "ts", F.concat(F.lit("status "), c("props")).alias("message"),
    )
    return Q.error_log(log)
