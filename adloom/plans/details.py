"""Detail pages with their API bodies to ad records, in one batch and as a stream (2.D, 2.E, 2.F, 2.J)."""

from pyspark.sql import functions as F

from adloom.operators import detail as D
from adloom.operators import geo as G
from adloom.plans.geo import _MSA
from adloom.plans.registry import query
from adloom.plans.urls import ADS_SITE
from adloom.session import new_table_path
from adloom.sources.fixtures import fixture, with_fixtures
from adloom.streaming import streams as X

c = F.col
SCRAPED_AT = "TIMESTAMP_NTZ '2026-06-01 00:00:00'"

# what each source says, then the record. A fifth of the pages has page state with an ad object of its own, which hides all other sources
_PARTS = with_fixtures("f_detail", "f_bodies", "f_zip", "f_geo") + """, r AS (SELECT d.page_id, p.*, p.p_partkey % 5 = 0 AS bare, p.p_partkey % 4 = 1 AS more FROM f_detail d JOIN part p ON p.p_partkey = d.page_id),
j AS (SELECT *, CASE WHEN bare THEN NULL WHEN p_size % 2 = 0 THEN 'One line about ' || p_type ELSE repeat('A long text without any break. ', 12) END AS told,
  CASE WHEN NOT bare AND p_partkey % 2 = 0 THEN CAST(10000 + p_partkey % 200 AS VARCHAR) END AS zip,
  'Long enough description text of a ' || p_type || ' place to rent.' || chr(10) || 'Second line.' AS printed FROM r)"""
_GEO = _MSA + """, known AS (SELECT j.*, z.zip AS z_zip, z.city AS z_city, z.lat AS z_lat, g.zip AS g_zip, g.geo_id,
  json_extract_string(g.components_json, '$.results[0].address_components[1].long_name') AS g_name, m.msa FROM j LEFT JOIN f_zip z ON z.zip = j.zip AND CAST(z.zip AS INT) % 3 <> 0
  LEFT JOIN f_geo g ON g.zip = j.zip AND g.geo_id % 9 <> 8 LEFT JOIN (SELECT DISTINCT zip, msa FROM zip_msa) m ON m.zip = j.zip)"""
_LOCATED = """CASE WHEN bare THEN NULL WHEN p_partkey % 7 = 0 THEN 'Own Town' WHEN z_zip IS NOT NULL THEN z_city ELSE g_name END AS city,
  CASE WHEN bare THEN NULL WHEN p_partkey % 3 = 0 THEN '1.5' WHEN z_zip IS NOT NULL THEN CAST(z_lat AS VARCHAR) WHEN g_zip IS NOT NULL THEN CAST(25 + geo_id % 40 + 0.5 AS VARCHAR) END AS latitude,
  CASE WHEN bare THEN NULL WHEN more THEN 'Quarter ' || CAST(p_size AS VARCHAR) WHEN z_zip IS NULL AND g_zip IS NULL THEN NULL
    WHEN z_zip IS NULL AND geo_id % 2 = 1 THEN g_name WHEN p_partkey % 7 = 0 THEN 'Own Town' WHEN z_zip IS NOT NULL THEN z_city ELSE g_name END AS locality,
  CASE WHEN z_zip IS NOT NULL OR g_zip IS NOT NULL THEN msa END AS metro_area"""
_FROM_SOURCES = """CAST(page_id AS VARCHAR) AS ad_id, CASE WHEN bare THEN p_name || ' & more' ELSE 'state ' || p_name END AS title,
  CASE WHEN NOT bare THEN CAST(p_size * 100 AS VARCHAR) END AS rent, CASE WHEN bare THEN NULL WHEN p_partkey % 3 = 1 THEN '9' WHEN p_partkey % 4 = 0 THEN '77' ELSE CAST(p_size % 6 AS VARCHAR) END AS beds,
  CASE WHEN bare THEN NULL WHEN more THEN 'late ' || CAST(p_size AS VARCHAR) ELSE CAST(p_size * 3 AS VARCHAR) END AS deposit,
  CASE WHEN length(told) * 0.7 > length(printed) THEN told ELSE printed END AS description, 'User ' || p_brand AS posted_by,
  ['https://img.example.com/t/' || CAST(page_id AS VARCHAR) || '.jpg', 'https://img.example.com/lazy/' || CAST(p_size AS VARCHAR) || '.jpg', 'https://img.example.com/full/' || CAST(page_id AS VARCHAR) || '.jpg',
   'https://img.example.com/ld/' || CAST(page_id AS VARCHAR) || '.jpg'] AS photos, CASE WHEN more AND NOT bare THEN 'true' END AS gym, zip AS zip_code,
  CASE WHEN NOT bare THEN 'United States' END AS country, p_name || ' & more' AS printed_title, CAST(p_size * 20 AS VARCHAR) AS area_sqft"""


def geo_tables(spark, d):
    """The gazetteer without every third code, stored geocodes for most of all codes, and metro areas by code."""
    zips = fixture(spark, d, "f_zip")
    stored = fixture(spark, d, "f_geo", dealt_by="c_custkey").select("zip", F.lit("US").alias("country_code"), G.geocode_components(c("components_json"), c("zip")).alias("geo"))
    metros = G.build_zip_msa(zips, zips.select("county", "state_code", "raw_msa").where("raw_msa IS NOT NULL"))
    return D.GeoTables(zips.where("CAST(zip AS INT) % 3 <> 0"), (stored,), None, metros)


def shown(records):
    return records.select(
        c("details.ad_id").cast("bigint").alias("page_id"), "ad_id", "property.title", c("property.rent_amount").alias("rent"), "property.beds", "property.deposit",
        c("description.full_description").alias("description"), c("poster.display_name").alias("posted_by"), F.transform("photos", lambda p: p["url"]).alias("photos"),
        F.try_element_at("amenities", F.lit("gym")).alias("gym"), "location.zip_code", "location.country", c("details.title").alias("printed_title"), "details.area_sqft",
        *[c(f"location.{f}") for f in ("city", "latitude", "locality", "metro_area")],
    )


@query("extract_detail_pages", _PARTS + _GEO + f" SELECT page_id, {_FROM_SOURCES}, {_LOCATED} FROM known")
def extract_detail_pages(spark, d):
    pages, bodies = fixture(spark, d, "f_detail", dealt_by="p_partkey"), fixture(spark, d, "f_bodies", dealt_by="p_partkey")
    return shown(D.extract_detail_pages(pages, bodies, ADS_SITE, geo_tables(spark, d), F.expr(SCRAPED_AT)))


@query(
    "enrich_location",
    with_fixtures("f_addr", "f_zip", "f_geo")
    + _MSA
    + """, asked AS (SELECT *, CASE WHEN ad_id % 2 = 0 THEN zip END AS code, CASE WHEN ad_id % 3 = 0 THEN '1.5' END AS known_lat FROM f_addr),
hits AS (SELECT a.*, z.zip AS z_zip, z.city AS z_city, z.lat AS z_lat, m.msa FROM asked a LEFT JOIN f_zip z ON z.zip = a.code AND a.country_code = 'US'
  LEFT JOIN (SELECT DISTINCT zip, msa FROM zip_msa) m ON m.zip = a.code AND a.country_code = 'US')
SELECT ad_id, code AS zip_code, CASE WHEN z_zip IS NULL THEN known_city ELSE coalesce(known_city, z_city) END AS city, coalesce(known_lat, CAST(z_lat AS VARCHAR)) AS latitude,
  CASE WHEN z_zip IS NULL THEN NULL WHEN known_lat IS NULL THEN 'Near ' || CAST(z_lat AS VARCHAR) ELSE coalesce(known_city, z_city) END AS locality, CASE WHEN z_zip IS NOT NULL THEN msa END AS metro_area FROM hits""",
)
def enrich_location(spark, d):
    """Half of the ads have no ZIP code, two thirds no point; the gazetteer's points name the places."""
    zips = fixture(spark, d, "f_zip")
    places = zips.select("lat", "lng", F.concat(F.lit("Near "), c("lat").cast("string")).alias("locality"))
    metros = G.build_zip_msa(zips, zips.select("county", "state_code", "raw_msa").where("raw_msa IS NOT NULL"))
    none = F.lit(None).cast("string")
    fields = {f: none for f in ("locality", "sub_locality", "district", "state", "state_code", "country", "formatted_address", "longitude", "metro_area")}
    known = {"zip_code": F.when(c("ad_id") % 2 == 0, c("zip")), "country_code": c("country_code"), "city": c("known_city"), "latitude": F.when(c("ad_id") % 3 == 0, "1.5")}
    ads = fixture(spark, d, "f_addr").select("ad_id", F.struct(*[v.alias(f) for f, v in {**fields, **known}.items()]).alias("location"))
    out = D.enrich_location(ads, D.GeoTables(zips, (), places, metros))
    return out.select("ad_id", *[f"location.{f}" for f in ("zip_code", "city", "latitude", "locality", "metro_area")])


def arriving(spark, d, parts: int = 3):
    """The fixture's pages and bodies as two folders of files in order of time, a page a minute, its bodies half a minute and more later.

    A last page and body, far in the future, let the watermark pass all others; they are still waiting for theirs when the stream ends.
    """
    start, minute = "TIMESTAMP '2026-01-01 00:00:00'", "INTERVAL '1' MINUTE"
    pages = fixture(spark, d, "f_detail").withColumn("captured_at", F.expr(f"{start} + page_id * {minute}"))
    bodies = fixture(spark, d, "f_bodies").withColumn("received_at", F.expr(f"{start} + page_id * {minute} + INTERVAL '30' SECOND"))
    end = "TIMESTAMP '2999-01-01 00:00:00'"
    pages = pages.unionByName(spark.sql(f"SELECT CAST(-1 AS BIGINT) AS page_id, 'end' AS url, '' AS html, {end} AS captured_at"))
    bodies = bodies.unionByName(spark.sql(f"SELECT CAST(-1 AS BIGINT) AS page_id, 'end' AS url, 'text/plain' AS content_type, CAST(0 AS BIGINT) AS arrival, 'end' AS body, {end} AS received_at"))
    last = pages.agg(F.max("page_id")).first()[0]
    out = []
    for df, time in ((pages, "captured_at"), (bodies, "received_at")):
        path = new_table_path(spark, f"arriving-{time}")
        for k in range(parts):
            low, high = last * k // parts, last * (k + 1) // parts
            of_part = (F.col("page_id") >= low) & ((F.col("page_id") < high) | F.lit(k == parts - 1))
            df.where(of_part if k < parts - 1 else of_part & (F.col("page_id") >= 0)).write.mode("append").parquet(path)
        df.where("page_id < 0").write.mode("append").parquet(path)
        out.append(X.file_stream(spark, path, df.schema))
    return out


@query("stream_detail_pages", _PARTS + f" SELECT page_id, {_FROM_SOURCES} FROM j")
def stream_detail_pages(spark, d):
    pages, bodies = arriving(spark, d)
    records = X.stream_detail_pages(pages, bodies, ADS_SITE, "10 minutes", "'5' MINUTE")
    return shown(X.run_to_files(records, "stream-details", state_on_disk=True)).drop("city", "latitude", "locality", "metro_area")
