"""Address and geography (2.F)."""

from pyspark.sql import functions as F

from adloom.functions.address import with_parsed_address
from adloom.operators import geo as G
from adloom.plans.registry import query
from adloom.sources.fixtures import fixture, with_fixtures
from adloom.session import new_table_path
from adloom.sources import tables as S

c = F.col
_STATES = "CASE {0} WHEN 'TX' THEN 'Texas' WHEN 'NJ' THEN 'New Jersey' WHEN 'CA' THEN 'California' WHEN 'VA' THEN 'Virginia' WHEN 'NY' THEN 'New York' END"


@query("scan_zip_dim", with_fixtures("f_zip") + " SELECT * FROM f_zip")
def scan_zip_dim(spark, d):
    path = new_table_path(spark, "zip")
    fixture(spark, d, "f_zip").write.option("header", True).csv(path)
    absent = S.scan_zip_dim(spark, path + "-absent")
    return S.scan_zip_dim(spark, path).unionByName(absent)


@query(
    "parse_address",
    with_fixtures("f_addr")
    + f""", p AS (SELECT ad_id, zip, split_part(address_text, ', ', 2) AS city, split_part(address_text, ', ', 3) AS st,
  split_part(address_text, ', ', 4) AS country, regexp_extract(address_text, ', [A-Z][A-Z]([A-Z][a-z]+ County)', 1) AS county FROM f_addr)
SELECT ad_id, zip AS zip_code, CASE country WHEN 'USA' THEN 'United States' ELSE 'Canada' END AS country, CASE country WHEN 'USA' THEN 'US' ELSE 'CA' END AS country_code,
  st AS state_code, {_STATES.format("st")} AS state, city, county, city || ', ' || st || ', ' || zip || ', ' || (CASE country WHEN 'USA' THEN 'United States' ELSE 'Canada' END) AS formatted_address
FROM p""",
)
def parse_address(spark, d):
    return with_parsed_address(fixture(spark, d, "f_addr"), "address_text", "p").select("ad_id", "p.*")


def enriched(spark, d):
    return G.zip_enrich(fixture(spark, d, "f_addr"), fixture(spark, d, "f_zip"))


_JOINED = with_fixtures("f_addr", "f_zip") + """, e AS (SELECT a.*, z.zip AS hit, z.city AS z_city, z.county AS z_county, z.state_code AS z_state, z.lat AS z_lat, z.lng AS z_lng
  FROM f_addr a LEFT JOIN f_zip z ON z.zip = a.zip AND a.country_code = 'US')"""


@query(
    "zip_enrich",
    _JOINED
    + f""" SELECT ad_id, z_lat AS lat, z_lng AS lng, z_city AS city, z_county || ' County' AS district, {_STATES.format("z_state")} AS state,
  z_city || ', ' || z_state || ', ' || hit || ', United States' AS formatted_address FROM e""",
)
def zip_enrich(spark, d):
    return enriched(spark, d).select("ad_id", *[c(f"geo.{f}") for f in ("lat", "lng", "city", "district", "state", "formatted_address")])


@query(
    "backfill_missing",
    _JOINED
    + """ SELECT ad_id, coalesce(known_city, z_city) AS city, z_lat AS latitude, z_county || ' County' AS district, coalesce(nullif(country_code, ''), 'x') AS country_code,
  zip AS zip_code FROM e""",
)
def backfill_missing(spark, d):
    names = {"lat": "latitude", "lng": "longitude"}
    known = {"city": c("known_city"), "country_code": c("country_code"), "zip_code": c("zip")}
    location = F.struct(*[known.get(f, F.lit(None).cast("string")).alias(names.get(f, f)) for f in G.GEO_FIELDS])
    rows = enriched(spark, d).withColumn("location", location)
    filled = rows.select("ad_id", G.backfill_missing(c("location"), c("geo")).alias("l"))
    return filled.select("ad_id", *[c(f"l.{f}") for f in ("city", "latitude", "district", "country_code", "zip_code")])


_GEO_SQL = """SELECT geo_id, zip, CASE WHEN geo_id % 9 = 8 THEN NULL ELSE CAST(25 + geo_id % 40 AS DOUBLE) + 0.5 END AS lat,
  CASE WHEN geo_id % 9 <> 8 THEN json_extract_string(components_json, '$.results[0].address_components[1].long_name') END AS city,
  CASE WHEN geo_id % 9 <> 8 AND geo_id % 2 = 1 THEN json_extract_string(components_json, '$.results[0].address_components[1].long_name') END AS locality,
  CASE WHEN geo_id % 9 <> 8 THEN 'Hudson County' END AS district, CASE WHEN geo_id % 9 <> 8 THEN 'NJ' END AS state_code,
  CASE WHEN geo_id % 9 <> 8 THEN 'US' END AS country_code, CASE WHEN geo_id % 9 <> 8 THEN zip END AS zip_code,
  CASE WHEN geo_id % 9 <> 8 THEN json_extract_string(components_json, '$.results[0].formatted_address') END AS formatted_address FROM f_geo"""


@query("geocode_components", with_fixtures("f_geo") + " " + _GEO_SQL)
def geocode_components(spark, d):
    g = fixture(spark, d, "f_geo").select("geo_id", "zip", G.geocode_components(c("components_json"), c("zip")).alias("g"))
    return g.select("geo_id", "zip", *[c(f"g.{f}") for f in ("lat", "city", "locality", "district", "state_code", "country_code", "zip_code", "formatted_address")])


@query(
    "locality_cascade",
    with_fixtures("f_geo")
    + """ SELECT geo_id, (CASE geo_id % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'H' ELSE 'C' END) || CAST(geo_id AS VARCHAR) AS locality, 'Fallback' AS from_city FROM f_geo""",
)
def locality_cascade(spark, d):
    df = fixture(spark, d, "f_geo").select("geo_id", F.try_parse_json("place_json").alias("v"))
    return df.select(
        "geo_id",
        G.locality_cascade(F.try_variant_get("v", "$.address", "variant")).alias("locality"),
        G.locality_cascade(F.try_variant_get("v", "$.nothing", "variant"), F.lit("Fallback")).alias("from_city"),
    )


@query(
    "geo_fallback_chain",
    with_fixtures("f_addr", "f_zip", "f_geo")
    + """, hits AS (SELECT a.ad_id, CASE WHEN z.zip IS NOT NULL THEN 0 WHEN g.zip IS NOT NULL AND g.geo_id % 9 <> 8 THEN 1 WHEN g.zip IS NOT NULL THEN 2 END AS geo_rank,
  z.city AS zc, json_extract_string(g.components_json, '$.results[0].address_components[1].long_name') AS gc, g.geo_id FROM f_addr a
  LEFT JOIN f_zip z ON z.zip = a.zip AND a.country_code = 'US' AND z.state_code <> 'CA' LEFT JOIN f_geo g ON g.zip = a.zip)
SELECT ad_id, CAST(geo_rank AS INTEGER) AS geo_rank, CASE geo_rank WHEN 0 THEN zc WHEN 1 THEN gc WHEN 2 THEN CASE WHEN geo_id % 4 = 3 THEN 'C' || CAST(geo_id AS VARCHAR) END END AS city FROM hits""",
)
def geo_fallback_chain(spark, d):
    local = G.zip_geocodes(fixture(spark, d, "f_zip").where("state_code <> 'CA'")).withColumn("country_code", F.lit("US"))
    stored = fixture(spark, d, "f_geo").withColumn("country_code", F.explode(F.array(F.lit("US"), F.lit("CA"))))
    second = stored.select("zip", "country_code", G.geocode_components(c("components_json"), c("zip")).alias("geo"))
    third = stored.select("zip", "country_code", G.geocode_place(c("place_json"), c("zip")).alias("geo"))
    out = G.geo_fallback_chain(fixture(spark, d, "f_addr"), [local, second, third])
    return out.select("ad_id", "geo_rank", "geo.city")


_MSA = """, named AS (SELECT county, state_code, min(trim(regexp_replace(replace(raw_msa, ', TX Metropolitan Statistical Area', ', TX'), ' CSA$', ''))) AS msa FROM f_zip WHERE raw_msa IS NOT NULL GROUP BY ALL),
zip_msa AS (SELECT zip, msa FROM f_zip JOIN named USING (county, state_code))"""


@query("msa_name_clean", with_fixtures("f_zip") + " SELECT zip, regexp_replace(replace(raw_msa, ', TX Metropolitan Statistical Area', ', TX'), ' CSA$', '') AS msa FROM f_zip")
def msa_name_clean(spark, d):
    return fixture(spark, d, "f_zip").select("zip", G.msa_name_clean(c("raw_msa")).alias("msa"))


def zip_msa(spark, d):
    zips = fixture(spark, d, "f_zip")
    return G.build_zip_msa(zips, zips.where("raw_msa IS NOT NULL"))


@query("build_zip_msa", with_fixtures("f_zip") + _MSA + " SELECT zip, msa FROM zip_msa")
def build_zip_msa(spark, d):
    return zip_msa(spark, d)


@query(
    "county_representative",
    with_fixtures("f_zip")
    + " SELECT county, state_code, arg_min(lat, zip) AS lat, arg_min(lng, zip) AS lng, list_sort(list(zip)) AS zips FROM f_zip GROUP BY county, state_code",
)
def county_representative(spark, d):
    return G.county_representative(fixture(spark, d, "f_zip"))


@query(
    "metro_from_zip",
    with_fixtures("f_addr", "f_zip")
    + _MSA
    + """ SELECT ad_id, CASE WHEN ad_id % 5 = 0 THEN 'Known' WHEN country_code = 'US' THEN msa END AS metro FROM f_addr LEFT JOIN zip_msa USING (zip)""",
)
def metro_from_zip(spark, d):
    ads = fixture(spark, d, "f_addr").withColumn("metro", F.when(c("ad_id") % 5 == 0, "Known").when(c("ad_id") % 5 == 1, ""))
    return G.metro_from_zip(ads, zip_msa(spark, d)).select("ad_id", "metro")


def shifted_ads(spark, d):
    return fixture(spark, d, "f_ads").withColumns({"lat": c("lat") + 0.1, "lng": c("lng") + 0.3})


# edges of every ring, then the even-odd count of crossings
_POINT = """, pts AS (SELECT metro_id, metro, layer, string_split(ring, ',') AS r FROM f_poly),
edges AS (SELECT metro_id, metro, layer, unnest(r) AS p, unnest(list_concat([r[len(r)]], r[1:len(r) - 1])) AS q FROM pts),
seg AS (SELECT metro_id, metro, layer, CAST(split_part(p, ' ', 1) AS DOUBLE) AS px, CAST(split_part(p, ' ', 2) AS DOUBLE) AS py,
  CAST(split_part(q, ' ', 1) AS DOUBLE) AS qx, CAST(split_part(q, ' ', 2) AS DOUBLE) AS qy FROM edges),
spots AS (SELECT DISTINCT lat + 0.1 AS lat, lng + 0.3 AS lng FROM f_ads),
inside AS (SELECT lat, lng, metro_id, metro, layer FROM spots, seg WHERE (py > lat) <> (qy > lat) AND lng < (qx - px) * (lat - py) / (qy - py) + px
  GROUP BY ALL HAVING count(*) % 2 = 1),
best AS (SELECT lat, lng, arg_min(metro, layer * 1000 + metro_id) AS point_metro FROM inside GROUP BY lat, lng)"""


@query(
    "metro_from_point",
    with_fixtures("f_ads", "f_poly") + _POINT + " SELECT ad_id, point_metro FROM f_ads a LEFT JOIN best b ON b.lat = a.lat + 0.1 AND b.lng = a.lng + 0.3",
)
def metro_from_point(spark, d):
    return G.metro_from_point(shifted_ads(spark, d), fixture(spark, d, "f_poly")).select("ad_id", "point_metro")


@query(
    "metro_precedence",
    with_fixtures("f_ads", "f_poly")
    + _POINT
    + """ SELECT ad_id, CASE WHEN ad_id % 7 = 0 THEN 'Stored' WHEN ad_id % 2 = 0 THEN coalesce(point_metro, metro) ELSE metro END AS metro
  FROM f_ads a LEFT JOIN best b ON b.lat = a.lat + 0.1 AND b.lng = a.lng + 0.3""",
)
def metro_precedence(spark, d):
    rows = G.metro_from_point(shifted_ads(spark, d), fixture(spark, d, "f_poly"))
    stored = F.when(c("ad_id") % 7 == 0, "Stored").otherwise("")
    country = F.when(c("ad_id") % 2 == 0, "us").otherwise("CA")
    return rows.select("ad_id", G.metro_precedence(stored, c("metro"), c("point_metro"), country).alias("metro"))


@query(
    "nearest_place",
    with_fixtures("f_ads", "f_zip")
    + """, spots AS (SELECT DISTINCT lat + 0.1 AS lat, lng + 0.3 AS lng FROM f_ads),
places AS (SELECT min(city) AS place, lat AS plat, lng AS plng FROM f_zip GROUP BY lat, lng),
dist AS (SELECT lat, lng, place, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(plat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plng - lng) / 2), 2)))) AS km FROM spots, places),
best AS (SELECT lat, lng, min(km) AS km, arg_min(place, km) AS place FROM dist GROUP BY lat, lng)
SELECT ad_id, place, round(km, 3) AS distance_km FROM f_ads a JOIN best b ON b.lat = a.lat + 0.1 AND b.lng = a.lng + 0.3""",
)
def nearest_place(spark, d):
    places = fixture(spark, d, "f_zip").select(c("city").alias("place"), "lat", "lng")
    out = G.nearest_place(shifted_ads(spark, d), places)
    return out.select("ad_id", "place", F.round("distance_km", 3).alias("distance_km"))


@query(
    "zip_spot_check",
    with_fixtures("f_zip")
    + _MSA
    + """ SELECT 'all' AS zip, CAST(NULL AS VARCHAR) AS msa, count(*) AS n_zips, count(msa) AS n_mapped FROM f_zip LEFT JOIN zip_msa USING (zip)
UNION ALL SELECT w.zip, m.msa, CAST(z.zip IS NOT NULL AS BIGINT), CAST(m.zip IS NOT NULL AS BIGINT) FROM (SELECT unnest(['10001', '10002', '10025', '99999']) AS zip) w
  LEFT JOIN f_zip z USING (zip) LEFT JOIN zip_msa m USING (zip)""",
)
def zip_spot_check(spark, d):
    from adloom.operators.quality import zip_spot_check as check

    return check(fixture(spark, d, "f_zip"), zip_msa(spark, d), ["10001", "10002", "10025", "99999"])
