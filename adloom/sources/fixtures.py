"""Ad-shaped inputs derived in SQL from the given tables, for queries, tests and oracles.

No given table holds rental ads. Every text below runs unchanged in Spark and in DuckDB, reads a whole
given table and so grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adloom.session import settled
from adloom.sources.tables import spread

TABLES = ("pages", "documents", "events", "part", "customer", "orders", "lineitem", "nation", "supplier")

F_RENT = """
SELECT p_partkey AS ad_id,
  (CASE p_size % 4 WHEN 0 THEN '$' WHEN 1 THEN '₹' WHEN 2 THEN '£' ELSE '€' END)
    || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)
    || (CASE p_partkey % 5 WHEN 0 THEN ' /Month' WHEN 1 THEN ' /Week' WHEN 2 THEN '/day' WHEN 3 THEN ' per year' ELSE '' END) AS rent_text,
  CASE WHEN p_size % 7 = 0 THEN 'Studio' ELSE CAST(p_size % 6 AS STRING) || ' Beds' END AS beds_text,
  CAST(1 + p_size % 3 AS STRING) || ' Bath' AS baths_text,
  '1,' || lpad(CAST(p_size * 10 AS STRING), 3, '0') || ' sqft' AS area_text,
  CASE p_type WHEN 'ECONOMY' THEN 'Town  House' WHEN 'SMALL' THEN 'Single Room' WHEN 'MEDIUM' THEN ' Apartment '
    WHEN 'LARGE' THEN 'Single Family Home' WHEN 'PROMO' THEN 'Paying Guest' ELSE 'Castle' END AS type_text
FROM part
"""

F_TEXT = """
SELECT p_partkey AS ad_id,
  'Nice ' || p_name || ' place.' || chr(10)
    || CASE WHEN p_partkey % 5 = 0 THEN 'rent: $' || CAST(p_size * 100 AS STRING) || ' /month'
       ELSE 'AVAILABLE FROM' || chr(10) || '01 Jun 2026' || chr(10) || (CASE WHEN p_partkey % 2 = 0 THEN 'ACCOMODATES' ELSE 'ACCOMMODATES' END)
         || chr(10) || CAST(p_size % 6 AS STRING) || chr(10) || 'EXPECTED RENT' || chr(10) || '$' || CAST(p_size * 100 AS STRING) || ' /Month'
         || chr(10) || 'AREA' || chr(10) || CAST(p_size * 20 AS STRING) || ' sqft' END
    || chr(10) || 'Posted on: Jun 05, 2026 | AD ID: ' || CAST(p_partkey AS STRING) || ' | Posted by: User ' || p_brand
    || chr(10) || 'Nearby Neighborhoods: ' || p_type || ', Midtown|' || p_type || chr(10) || (CASE WHEN p_size % 3 = 0 THEN 'Phone Verified' ELSE '' END) AS page_text,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'Nice ' || p_name || ' place.' END AS json_text
FROM part
"""

F_ADDR = """
SELECT c_custkey AS ad_id,
  CAST(100 + c_custkey % 900 AS STRING) || ' Main Street, ' || city || ', ' || st || ', ' || country || ', '
    || CAST(10000 + (2 * c_custkey) % 90000 AS STRING) || city || ', ' || st || county || ' County View on Map' AS address_text,
  CASE WHEN c_custkey % 4 = 0 THEN 'CA' ELSE 'US' END AS country_code,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE city END AS known_city,
  CAST(10000 + (2 * c_custkey) % 90000 AS STRING) AS zip
FROM (SELECT c_custkey,
  CASE c_nationkey % 5 WHEN 0 THEN 'Houston' WHEN 1 THEN 'Jersey City' WHEN 2 THEN 'Ashburn' WHEN 3 THEN 'New York' ELSE 'Fremont' END AS city,
  CASE c_nationkey % 5 WHEN 0 THEN 'TX' WHEN 1 THEN 'NJ' WHEN 2 THEN 'VA' WHEN 3 THEN 'NY' ELSE 'CA' END AS st,
  CASE c_nationkey % 5 WHEN 0 THEN 'Harris' WHEN 1 THEN 'Hudson' WHEN 2 THEN 'Loudoun' WHEN 3 THEN 'Kings' ELSE 'Alameda' END AS county,
  CASE WHEN c_custkey % 4 = 0 THEN 'Canada' ELSE 'USA' END AS country FROM customer) t
"""

# one row per ZIP code; a ZIP code has five digits, so this table never exceeds 90,000 rows
F_ZIP = """
SELECT CAST(10000 + k AS STRING) AS zip, 'City' || CAST(k % 40 AS STRING) AS city,
  'Area' || CAST(k % 30 AS STRING) AS county, CASE k % 3 WHEN 0 THEN 'TX' WHEN 1 THEN 'NJ' ELSE 'CA' END AS state_code,
  CAST(25 + k % 20 AS DOUBLE) AS lat, CAST(-120 + k % 50 AS DOUBLE) AS lng,
  CASE WHEN k % 30 < 20 THEN 'Metro' || CAST(k % 30 AS STRING) || (CASE k % 2 WHEN 0 THEN ', TX Metropolitan Statistical Area' ELSE ' CSA' END) END AS raw_msa
FROM (SELECT DISTINCT c_custkey % 90000 AS k FROM customer) z
"""

F_POLY = """
SELECT n_nationkey AS metro_id, 'Metro ' || n_name AS metro, n_regionkey AS layer,
  CAST(-120 + n_nationkey * 2 AS STRING) || ' 25,' || CAST(-115 + n_nationkey * 2 AS STRING) || ' 25,'
  || CAST(-115 + n_nationkey * 2 AS STRING) || ' 40,' || CAST(-117 + n_nationkey * 2 AS STRING) || ' 30,'
  || CAST(-120 + n_nationkey * 2 AS STRING) || ' 40' AS ring
FROM nation
"""

F_GEO = """
SELECT c_custkey AS geo_id,
  '{"lat":"' || CAST(25 + c_custkey % 40 AS STRING) || '","lon":"-' || CAST(70 + c_custkey % 30 AS STRING) || '","address":{'
  || (CASE c_custkey % 4 WHEN 0 THEN '"neighbourhood":"N' WHEN 1 THEN '"suburb":"S' WHEN 2 THEN '"hamlet":"H' ELSE '"city":"C' END)
  || CAST(c_custkey AS STRING) || '","country_code":"us","ISO3166-2-lvl4":"US-NJ"}}' AS place_json,
  '{"status":"' || (CASE WHEN c_custkey % 9 = 8 THEN 'ZERO_RESULTS' ELSE 'OK' END)
  || '","results":[{"formatted_address":"' || c_name || ', NJ","geometry":{"location":{"lat":' || CAST(25 + c_custkey % 40 AS STRING) || '.5,"lng":-74.25}},'
  || '"address_components":[{"long_name":"Hudson County","short_name":"Hudson","types":["administrative_area_level_2","political"]},{"long_name":"'
  || c_name || '","short_name":"N","types":["' || (CASE WHEN c_custkey % 2 = 0 THEN 'locality' ELSE 'sublocality_level_1' END)
  || '"]},{"long_name":"New Jersey","short_name":"NJ","types":["administrative_area_level_1","political"]},{"long_name":"United States","short_name":"US","types":["country","political"]}]}]}' AS components_json,
  CAST(10000 + c_custkey AS STRING) AS zip
FROM customer
"""

F_HIST = """
SELECT l_partkey AS ad_id, l_shipdate AS scraped_at, l_orderkey AS run_seq, l_linenumber AS pos,
  'https://ads.example.com/flat_rentals_town-nj_' || CAST(l_partkey AS STRING) || (CASE l_linenumber % 3 WHEN 0 THEN '/' WHEN 1 THEN '?ref=x' ELSE '#top' END) AS url,
  CASE WHEN l_quantity > 10 THEN l_quantity END AS lat, CASE WHEN l_discount > 0.02 THEN l_returnflag END AS locality,
  CASE WHEN l_tax > 0.02 THEN l_linestatus END AS metro, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS payload
FROM lineitem
"""

F_API = """
SELECT event_id AS arrival, user_id AS page_id,
  'https://api.example.com/' || event_type || (CASE WHEN event_id % 9 = 0 THEN '.png' ELSE '' END) || '?u=' || CAST(event_id % 7 AS STRING) AS url,
  CASE event_id % 4 WHEN 0 THEN 'application/json; charset=utf-8' WHEN 1 THEN 'text/plain' WHEN 2 THEN 'text/html' ELSE 'application/json' END AS content_type,
  200 AS status, CASE WHEN event_id % 11 = 0 THEN '{}' ELSE '{"ad":' || props || ',"v' || CAST(event_id % 3 AS STRING) || '":' || CAST(event_id AS STRING) || '}' END AS body
FROM events
"""

# listings of twelve pages; next page as rel=next, as link text, or only in the page JSON; the eighth page repeats the ads of the seventh
F_LIST = """
SELECT page_id, listing || '?page=' || CAST(page_no AS STRING) AS url, page_no, listing, k,
  '<html><head><title>Rentals ' || CAST(page_no AS STRING) || '</title></head><body><a href="/flat_rentals_town-nj_' || CAST(1000 + k AS STRING)
  || '?x=1">A</a><a href="https://ads.example.com/room_rentals_city-tx_' || CAST(1001 + k AS STRING)
  || '#p">B</a><a href="/about">C</a><a href="/rentals?page=1">1</a>'
  || (CASE page_id % 3 WHEN 0 THEN '<a rel="next" href="' || next_href || '">2</a>' WHEN 1 THEN '<a href="' || next_href || '"> Next </a>' ELSE '' END)
  || '<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{' || (CASE WHEN page_id % 2 = 0 THEN '"totalAds":' || CAST(page_id * 3 AS STRING) || ',' ELSE '' END)
  || (CASE WHEN page_id % 4 = 3 THEN '' ELSE '"pagination":{"next":"' || next_href || '"},' END)
  || '"ads":[{"slug":"/flat_rentals_town-nj_' || CAST(2000 + k AS STRING) || '","id":1},{"id":2}]}}}</script></body></html>' AS html
FROM (SELECT c_custkey AS page_id, CAST(1 + c_custkey % 12 AS INT) AS page_no, c_custkey - (CASE WHEN c_custkey % 12 = 7 THEN 1 ELSE 0 END) AS k,
  'https://ads.example.com/rentals/town' || CAST(CAST(floor(c_custkey / 12) AS INT) AS STRING) AS listing,
  '/rentals/town' || CAST(CAST(floor(c_custkey / 12) AS INT) AS STRING) || '?page=' || CAST(CAST(2 + c_custkey % 12 AS INT) AS STRING) AS next_href
  FROM customer) t
"""

F_HTML = """
SELECT p_partkey AS page_id, 'https://ads.example.com/flat_rentals_town-nj_' || CAST(p_partkey AS STRING) AS url,
  '<html><head><title> ' || p_name || ' </title><meta property="og:title" content="' || p_brand || '"><meta property="og:image" content="/logo.png"><link rel="canonical" href="https://ads.example.com/c/' || CAST(p_partkey AS STRING)
  || '"><script type="application/ld+json">{"name":"ld","image":["https://img.example.com/ld/' || CAST(p_partkey AS STRING) || '.jpg"]}</script><script>var s={"ad":{"title":"' || p_name || '","beds":' || CAST(p_size % 6 AS STRING)
  || '}};</script><script>window.__INITIAL_STATE__ = {"ad":{"rent":' || CAST(p_size * 100 AS STRING) || ',"title":"state ' || p_name || '"}}; </script>'
  || (CASE WHEN p_partkey % 4 = 0 THEN '<script>window.__FIREBASE_DATA__ = {"ad":{"beds":77,"fb":' || CAST(p_partkey AS STRING) || '}};</script>' ELSE '' END)
  || (CASE WHEN p_partkey % 5 = 0 THEN '<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"ad":{"adId":"' || CAST(p_partkey AS STRING) || '"}}},"ad":{"title":"next"}}</script>' ELSE '' END)
  || '</head><body><!-- <h1>not this</h1> --><h1> ' || p_name || ' &amp; more</h1><p>Houston, TX, USA, 77004 | Harris County</p>'
  || '<div class="ad-description"><p>Long enough description text of a ' || p_type || ' place to rent.</p><p>AREA</p><p>' || CAST(p_size * 20 AS STRING) || ' sqft</p></div>'
  || '<p>Posted on: Jun 05, 2026 | AD ID: ' || CAST(p_partkey AS STRING) || ' | Posted by: User ' || p_brand || '</p>'
  || '<div class="facts"><div><span>Bedrooms:</span><span>' || CAST(p_size % 6 AS STRING) || ' Beds</span></div><div><div><b>Deposit</b></div><div>$' || CAST(p_size * 10 AS STRING) || '</div></div></div><table><tr><td>Ad Type</td><td>'
  || (CASE WHEN p_partkey % 3 = 0 THEN 'Property Wanted' ELSE 'Property Offered' END)
  || '</td></tr><tr><td><b>Property</b></td><td>Apartment</td></tr></table><h3>Amenities</h3><ul><li>Gym</li><li>Lift</li><li>Gym</li></ul><h3>Utilities</h3><ul><li>Water</li></ul>'
  || '<h3>Additional Info</h3><ul><li>No Smoking</li><li>' || (CASE WHEN p_size % 2 = 0 THEN 'Only Dogs' ELSE 'Fully furnished' END) || '</li></ul><h3>Tenant Preferences</h3><ul><li>Alcohol not allowed</li><li>Female only</li></ul>'
  || '<p>Nearby Neighborhoods: ' || p_type || ', Midtown</p><p>Phone Verified</p>'
  || '<div id="photoDiv"><figure><a href="https://img.example.com/full/' || CAST(p_partkey AS STRING)
  || '.jpg"><img itemprop="photo" src="https://img.example.com/t/' || CAST(p_partkey AS STRING) || '.jpg"></a></figure><figure><img data-src="https://img.example.com/lazy/' || CAST(p_size AS STRING) || '.jpg"></figure><div class="related"><img src="https://img.example.com/rel.jpg"></div><img src="/logo.png"></div><div class="similar-ads"><img src="https://img.example.com/other.jpg"></div></body></html>' AS html
FROM part
"""

# detail pages whose printed description has a line break, and what their API calls returned: bodies that disagree with the page,
# half of them with a ZIP code, a third with a point
F_DETAIL = f"""
SELECT page_id, url, replace(html, ' place to rent.', ' place to rent.<br>Second line.') AS html FROM ({F_HTML}) h
"""

F_BODIES = """
SELECT p_partkey AS page_id, 'https://api.example.com/ad?id=' || CAST(p_partkey AS STRING) AS url, 'application/json' AS content_type, 2 * p_partkey AS arrival,
  '{"ad":{"title":"api title","deposit":"' || CAST(p_size * 3 AS STRING) || '"' || (CASE WHEN p_partkey % 3 = 1 THEN ',"beds":9' ELSE '' END)
  || ',"description":"' || (CASE WHEN p_size % 2 = 0 THEN 'One line about ' || p_type ELSE repeat('A long text without any break. ', 12) END) || '","location":{"country":"United States"'
  || (CASE WHEN p_partkey % 2 = 0 THEN ',"zip":"' || CAST(10000 + p_partkey % 200 AS STRING) || '"' ELSE '' END) || (CASE WHEN p_partkey % 7 = 0 THEN ',"city":"Own Town"' ELSE '' END)
  || (CASE WHEN p_partkey % 3 = 0 THEN ',"lat":"1.5"' ELSE '' END) || '}}}' AS body FROM part
UNION ALL SELECT p_partkey, 'https://api.example.com/more', 'text/plain', 2 * p_partkey + 1,
  '{"ad":{"deposit":"late ' || CAST(p_size AS STRING) || '","location":{"locality":"Quarter ' || CAST(p_size AS STRING) || '"},"amenities":["Gym"]}}' FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT p_partkey, 'https://api.example.com/more', 'application/json', 2 * p_partkey + 2, '{"ad":{"deposit":"second call"}}' FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT p_partkey, 'https://api.example.com/logo.png', 'application/json', 0, '{"ad":{"deposit":"an asset"}}' FROM part WHERE p_partkey % 6 = 0
"""

F_JSON = """
SELECT p_partkey AS ad_id, '{"query":{"adId":"q' || CAST(p_partkey AS STRING) || '","category":"room"},"locale":"en","'
  || (CASE WHEN p_partkey % 7 = 0 THEN 'data":{"' ELSE 'props":{"pageProps":{"' || (CASE p_partkey % 3 WHEN 0 THEN 'adDetails' WHEN 1 THEN 'listing' ELSE 'post' END) || '":{"' END)
  || (CASE p_partkey % 4 WHEN 0 THEN 'adId' WHEN 1 THEN 'listingId' WHEN 2 THEN 'id' ELSE 'other' END) || '":' || CAST(p_partkey AS STRING)
  || ',"title":"' || (CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END) || '","heading":"Heading ' || p_brand || '","' || (CASE p_size % 3 WHEN 0 THEN 'rent' WHEN 1 THEN 'price' ELSE 'monthlyRent' END) || '":' || CAST(p_size * 100 AS STRING)
  || ',"roomType":"' || p_type || '","' || (CASE p_size % 2 WHEN 0 THEN 'bedrooms' ELSE 'noOfBedrooms' END) || '":' || CAST(p_size % 6 AS STRING)
  || ',"location":{"' || (CASE p_size % 2 WHEN 0 THEN 'cityName' ELSE 'other' END) || '":"Dallas","zip":"75001","fullAddress":"12 Oak Street, Houston, TX, USA, 77004Houston, TXHarris County","lat":' || CAST(25 + p_size AS STRING) || '.5,"neighborhood":"Oak"}'
  || ',"preferences":{"gender":"Any","pets":"No Pets"},"smoking":"No Smoking","hidePhone":true,"privacy":{"hideEmail":false},"isActive":true,"createdAt":"2026-01-02","moveInDate":"' || p_name || '"'
  || ',"details":"Roomy ' || p_name || '","leaseTerm":"short","' || (CASE p_size % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'author' ELSE 'contact' END) || '":{"name":"User ' || p_brand || '","email":"u' || CAST(p_partkey AS STRING) || '@mail.example.com"},"mobile":"555-0100"'
  || ',"payment":{"amount":' || CAST(p_size AS STRING) || ',"method":"card"},"planId":"p1","extra":"' || p_brand || '"}}' || (CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '}}' END) AS body,
  'https://ads.example.com/flat_rentals_town-nj_' || CAST(p_partkey AS STRING) AS url
FROM part
"""

F_MERGE = """
SELECT p_partkey AS page_id, 0 AS rank, '{"a":{"x":1,"y":' || CAST(p_size AS STRING) || '},"k":[1,2],"e":{}}' AS body FROM part
UNION ALL SELECT p_partkey, 1, '{"a":{"y":7,"z":null},"k":[3],"e":{"f":"t"}}' FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, 2, '{"a":' || (CASE WHEN p_partkey % 3 = 0 THEN '5' ELSE '{"z":9}' END) || '}' FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT p_partkey, 3, '[1]' FROM part WHERE p_partkey % 7 = 0
UNION ALL SELECT p_partkey, 4, '{"a":{"w":{"v":' || CAST(p_size AS STRING) || '}}}' FROM part WHERE p_partkey % 11 = 0
"""

F_PHOTO = """
SELECT p_partkey AS ad_id, CASE WHEN p_size % 4 = 0 THEN '[]' WHEN p_size % 4 = 1 THEN '["https://img.example.com/' || CAST(p_partkey AS STRING) || '.jpg"]'
  ELSE '[{"src":"https://img.example.com/' || CAST(p_partkey AS STRING) || '.jpg","caption":"' || p_name || '"},{"url":"https://img.example.com/logo.png"}]' END AS json_photos,
  'https://img.example.com/' || CAST(p_partkey AS STRING) || '.jpg|https://img.example.com/p' || CAST(p_size AS STRING) || '.jpg' AS page_photos, CASE WHEN p_size % 6 = 0 THEN '40' ELSE '400' END AS width_text
FROM part
"""

F_AMEN = """
SELECT p_partkey AS ad_id, (CASE WHEN p_size % 2 = 0 THEN 'Gym|Swimming Pool|Fitness Room' ELSE 'Lift|Parking|Castle' END) AS amenity_labels,
  (CASE p_size % 3 WHEN 0 THEN 'Water heater|Electric vehicle charging|TV' WHEN 1 THEN 'WiFi|Fridge' ELSE '' END) AS utility_labels,
  (CASE p_size % 5 WHEN 0 THEN 'No Smoking|Only Dogs|Semi Furnished' WHEN 1 THEN 'Smoke outside only|Non-veg ok' WHEN 2 THEN 'Smoking is Ok|Furnished with bed' ELSE 'Any Pet is Ok|Fully furnished' END) AS info_items,
  (CASE p_size % 4 WHEN 0 THEN 'Alcohol not allowed|Female only|18 to 25' WHEN 1 THEN 'Students only allowed|Male' WHEN 2 THEN 'Alcohol is ok|Professionals only allowed|70 plus' ELSE 'Any gender' END) AS pref_items,
  (CASE p_size % 3 WHEN 0 THEN 'hindi|Tamil|klingon' ELSE 'English' END) AS language_labels, (CASE p_size % 3 WHEN 0 THEN 'Short term' WHEN 1 THEN 'Long term' END) AS stay_text,
  'area' || CAST(p_size * 10 AS STRING) || '_sqft|bedrooms_' || CAST(p_size % 6 AS STRING) || '|available_from1_june_2026|ad_typeproperty_wanted' AS legacy_keys
FROM part
"""

# one ad per order; its customer gives the place, a part the flat
F_ADS = """
SELECT o.o_orderkey AS ad_id, p.p_name AS title, CASE p.p_partkey % 3 WHEN 0 THEN 'Property Wanted' WHEN 1 THEN 'Property Offered' END AS ad_type,
  CASE WHEN p.p_size % 4 <> 0 THEN CAST(p.p_retailprice AS DECIMAL(12,2)) END AS json_rent, '$' || CAST(p.p_size * 100 AS STRING) || ' /Week' AS details_rent,
  CASE WHEN p.p_size % 3 = 0 THEN p.p_size % 6 END AS json_beds, CAST(p.p_size % 5 AS STRING) || ' Beds' AS details_beds,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o.o_orderdate) * 3 - 2 AS INT), 3) || ' ' || lpad(CAST(day(o.o_orderdate) AS STRING), 2, '0') || ', ' || CAST(year(o.o_orderdate) AS STRING) AS posted_on,
  o.o_orderstatus AS raw_status, CASE c.c_nationkey % 3 WHEN 0 THEN 'TX' WHEN 1 THEN 'NJ' ELSE 'CA' END AS state_code, CAST(10000 + c.c_custkey AS STRING) AS zip,
  CASE WHEN p.p_size % 2 = 0 THEN 'Scraped Metro' END AS metro, CAST(25 + c.c_custkey % 20 AS DOUBLE) + CAST(c.c_custkey % 65536 AS DOUBLE) / 65536 AS lat, CAST(-120 + c.c_custkey % 50 AS DOUBLE) AS lng
FROM (SELECT *, o_orderkey % (SELECT count(*) FROM part) AS part_key FROM orders) o
JOIN part p ON p.p_partkey = o.part_key JOIN customer c ON c.c_custkey = o.o_custkey
"""

_ALL = {name.lower(): text for name, text in list(globals().items()) if name.startswith("F_")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str, dealt_by: str | None = None) -> DataFrame:
    """A derived input as a DataFrame over the tables in `sf_dir`. With a key of theirs, their short rows are dealt out before they grow into pages."""
    text = _ALL[name]
    for t in TABLES:
        if f" {t}" in text:
            rows = table(spark, sf_dir, t)
            # a filter on what the rows grow into must not move in front of the dealing, into the few tasks of the scan
            (settled(spread(rows, dealt_by)) if dealt_by else rows).createOrReplaceTempView(t)
    return spark.sql(text)


def with_fixtures(*names: str) -> str:
    """The same inputs as a SQL `WITH` clause."""
    return "WITH " + ",\n".join(f"{n} AS ({_ALL[n]})" for n in names)
