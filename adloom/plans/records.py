"""JSON merge (2.D) and record builders (2.E)."""

from pyspark.sql import functions as F

from adloom.functions import aliases as A
from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions import text as T
from adloom.operators import merge as M
from adloom.operators import records as R
from adloom.operators.detail import BODIES, page_layers
from adloom.plans.pages import html_pages
from adloom.plans.registry import query
from adloom.plans.urls import ADS_SITE
from adloom.sources import tables as S
from adloom.sources.fixtures import fixture, table, with_fixtures

c = F.col

# ---- deep merge ------------------------------------------------------------------------------

# generic merge in SQL over a table src(page_id, rank, body): leaves and objects per path, then what survives
MERGE_SQL = """, nodes AS (SELECT s.page_id, s.rank, t.fullkey AS path, t.type AS type, CAST(t.atom AS VARCHAR) AS atom, CAST(t.value AS VARCHAR) AS val
    FROM (SELECT * FROM src WHERE json_type(body) = 'OBJECT') s, json_tree(s.body) t WHERE t.fullkey <> '$' AND NOT contains(t.fullkey, '[')),
leafs AS (SELECT page_id, path, rank, val AS value FROM nodes WHERE type <> 'OBJECT'),
objects AS (SELECT page_id, path, rank, val FROM nodes WHERE type = 'OBJECT'),
top_leaf AS (SELECT page_id, path, max(rank) AS rank, arg_max(value, rank) AS value FROM leafs GROUP BY ALL),
alive AS (SELECT * FROM top_leaf l WHERE NOT EXISTS (SELECT 1 FROM objects o WHERE o.page_id = l.page_id AND o.path = l.path AND o.rank > l.rank)
  AND NOT EXISTS (SELECT 1 FROM top_leaf b WHERE b.page_id = l.page_id AND b.rank > l.rank AND starts_with(l.path, b.path || '.'))),
bare AS (SELECT page_id, path, max(rank) AS rank FROM objects WHERE val = '{}' GROUP BY ALL),
bare_alive AS (SELECT * FROM bare e WHERE NOT EXISTS (SELECT 1 FROM alive a WHERE a.page_id = e.page_id AND (starts_with(a.path, e.path || '.') OR a.path = e.path))
  AND NOT EXISTS (SELECT 1 FROM top_leaf b WHERE b.page_id = e.page_id AND b.rank > e.rank AND starts_with(e.path, b.path || '.')))
SELECT page_id, replace(substr(path, 3), '"', '') AS path, coalesce(value, 'null') AS value FROM alive
UNION ALL SELECT page_id, replace(substr(path, 3), '"', ''), '{}' FROM bare_alive"""


def _merged(df):
    out = M.json_deep_merge(df, ["page_id"], "rank", "body")
    return out.select("page_id", M.dotted(c("path")).alias("path"), "value")


@query("json_deep_merge", with_fixtures("f_merge") + ", src AS (SELECT page_id, rank, CAST(body AS JSON) AS body FROM f_merge)" + MERGE_SQL)
def json_deep_merge(spark, d):
    return _merged(fixture(spark, d, "f_merge").withColumn("body", F.try_parse_json("body")))


@query(
    "json_merge_payloads",
    with_fixtures("f_api")
    + """, src AS (SELECT page_id, arrival AS rank, CAST(body AS JSON) AS body FROM f_api
  WHERE (content_type LIKE '%application/json%' OR content_type LIKE '%text/plain%') AND url NOT LIKE '%.png%'
  QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY arrival) = 1 AND length(body) >= 10)"""
    + MERGE_SQL,
)
def json_merge_payloads(spark, d):
    kept = S.capture_filter(fixture(spark, d, "f_api"))
    return _merged(kept.select("page_id", c("arrival").alias("rank"), J.json_safe_parse(c("body")).alias("body")))


@query(
    "json_source_priority",
    with_fixtures("f_html")
    + """, parts AS (SELECT page_id, html, regexp_extract(html, 'json">([^<]*)<', 1) AS ld, regexp_extract(html, 'var s=([^;]*);', 1) AS assigned,
  regexp_extract(html, '__INITIAL_STATE__ = ([^;]*);', 1) AS st, regexp_extract(html, '__FIREBASE_DATA__ = ([^;]*);', 1) AS fb,
  regexp_extract(html, '__NEXT_DATA__" type="application/json">([^<]*)<', 1) AS nx FROM f_html),
src0 AS (SELECT page_id, 0 AS rank, ld AS body FROM parts UNION ALL SELECT page_id, 1, assigned FROM parts UNION ALL SELECT page_id, 2, st FROM parts
  UNION ALL SELECT page_id, 3, fb FROM parts UNION ALL SELECT page_id, 4, nx FROM parts UNION ALL SELECT page_id, 5, fb FROM parts
  UNION ALL SELECT page_id, 6, st FROM parts UNION ALL SELECT page_id, 7, nx FROM parts),
src AS (SELECT page_id, rank, CAST(body AS JSON) AS body FROM src0 WHERE body <> '')"""
    + MERGE_SQL,
)
def json_source_priority(spark, d):
    sources = html_pages(spark, d).select("page_id", page_layers(c("html"), F.lit(None).cast(BODIES)).alias("sources"))
    return M.merge_in_row(sources, ["page_id"], "sources").select("page_id", M.dotted(c("path")).alias("path"), "value")


# ---- records over page JSON ------------------------------------------------------------------


def ad_rows(spark, d):
    df = S.spread(fixture(spark, d, "f_json"), "ad_id").select("ad_id", "url", F.try_parse_json("body").alias("raw"))
    return R.with_ad_node(df)


_AD_PATH = """CASE WHEN ad_id % 7 = 0 THEN '$.data' ELSE '$.props.pageProps.' || (CASE ad_id % 3 WHEN 0 THEN 'adDetails' WHEN 1 THEN 'listing' ELSE 'post' END) END"""
_AD = with_fixtures("f_json") + f""", n AS (SELECT ad_id, url, CAST(body AS JSON) AS raw, json_extract(body, {_AD_PATH}) AS ad FROM f_json)"""


def j(*paths, default="NULL"):
    """SQL for the first non-empty of some JSON paths below the ad, or below `raw`/`location` if so prefixed."""
    parts = []
    for p in paths:
        root, rest = ("raw", p[4:]) if p.startswith("raw.") else ("ad", p)
        parts.append(f"nullif(json_extract_string({root}, '$.{rest}'), '')")
    return f"coalesce({', '.join(parts)}, {default})"


def _rec(key, build, sql):
    def run(spark, d):
        rows = build(ad_rows(spark, d))
        return rows.select("ad_id", *[c(f"r.{f}").alias("rec_ad_id" if f == "ad_id" else f) for f in sql_fields])

    sql_fields = ["ad_id" if f == "rec_ad_id" else f for f in sql]
    query(key, _AD + " SELECT ad_id, " + ", ".join(f"CAST({e} AS VARCHAR) AS {f}" for f, e in sql.items()) + " FROM n")(run)


def _struct(column):
    return lambda df: df.withColumn("r", column())


_rec(
    "rec_property",
    _struct(R.rec_property),
    {
        "rec_ad_id": j("adId", "id", "listingId", "raw.query.adId"),
        "title": j("title", "adTitle", "heading"),
        "listing_url": j("listingUrl", "url", "canonicalUrl"),
        "property_type": j("propertyType", "type", "accommodationType", "roomType"),
        "accommodation_type": j("accommodationType", "accomodationType", "roomType"),
        "building_name": j("buildingName", "buildingInfo.name"),
        "beds": j("beds", "bedrooms", "noOfBedrooms", "bedroom"),
        "baths": j("baths", "bathrooms", "noOfBathrooms", "bathroom"),
        "square_feet": j("squareFeet", "sqft", "area", "builtupArea"),
        "rent_amount": j("rent", "rentAmount", "price", "amount", "monthlyRent"),
        "rent_currency": j("currency", "rentCurrency", "priceCurrency", default="'USD'"),
        "deposit": j("deposit", "securityDeposit", "depositAmount"),
        "rent_frequency": j("rentFrequency", "frequency", "billingCycle"),
        "utilities_included": j("utilitiesIncluded", "utilities", "utilityIncluded"),
        "negotiable": j("negotiable", "isNegotiable", "priceNegotiable"),
        "owner_or_agent": j("postedBy", "ownerType", "role", "sellerType"),
    },
)
_rec(
    "rec_description",
    _struct(R.rec_description),
    {
        "full_description": j("description", "adDescription", "details", "aboutProperty"),
        "extra_notes": j("extraNotes", "notes", "specialInstructions", "additionalInfo"),
        "special_instructions": j("specialInstructions", "instructions", "requirements"),
    },
)
_rec(
    "rec_availability",
    _struct(R.rec_availability),
    {
        "available_from": j("availableFrom", "availFrom", "moveInDate", "availableDate", "dateAvailable"),
        "available_to": j("availableTo", "availTo", "moveOutDate"),
        "stay_type": j("stayType", "leaseTerm", "leaseType", "term"),
        "days_available": j("daysAvailable", "availabilityDays", "daysOfWeek"),
        "short_term_allowed": j("shortTermAllowed", "shortTerm", "allowShortTerm"),
        "long_term_allowed": j("longTermAllowed", "longTerm", "allowLongTerm"),
    },
)
_rec(
    "rec_location",
    lambda df: R.with_location(df, "r"),
    {
        "full_address": j("fullAddress", "address", "location.fullAddress"),
        "city": j("city", "location.city", "location.cityName", default="'Houston'"),
        "state": "'Texas'",
        "state_code": "'TX'",
        "country": "'United States'",
        "country_code": "'US'",
        "district": "'Harris County'",
        "locality": j("locality", "location.locality", "neighborhood", "location.neighborhood"),
        "metro_area": j("metroArea", "location.metroArea", "metro", "msaName"),
        "sub_locality": j("subLocality"),
        "zip_code": j("zipCode", "zip", "location.zipCode", "location.zip"),
        "display_address": j("displayAddress"),
        "formatted_address": "'Houston, TX, 77004, United States'",
        "latitude": j("lat", "latitude", "location.lat"),
        "longitude": j("lng", "location.lng"),
        "map_visibility": j("mapVisibility", "showMap"),
        "neighborhoods": j("neighborhoods"),
        "nearby_neighborhoods": j("nearbyNeighborhoods"),
        "nearby_landmarks": j("nearbyLandmarks", "landmarks"),
    },
)
_rec(
    "rec_preferences",
    _struct(R.rec_preferences),
    {
        "preferred_gender": j("preferredGender", "preferences.gender", "gender", "genderPreference"),
        "pets": j("pets", "petsAllowed", "preferences.pets"),
        "smoking": j("smoking", "smokingAllowed", "preferences.smoking"),
        "vegetarian": j("vegetarian", "vegOnly", "preferences.vegetarian"),
        "alcohol_allowed": j("alcoholAllowed", "alcohol", "preferences.alcohol"),
        "couples_welcome": j("couplesWelcome", "couples", "preferences.couples"),
        "age_range": j("ageRange", "preferredAge", "preferences.ageRange"),
        "occupation": j("occupation", "preferredOccupation", "preferences.occupation"),
        "languages": j("languages", "preferredLanguages", "preferences.languages"),
        "raw_preferences": "json_extract(ad, '$.preferences')",
    },
)
_rec(
    "rec_metadata",
    _struct(R.rec_metadata),
    {
        "active_date": j("activeDate", "postedDate", "createdAt", "publishedAt"),
        "expiry_date": j("expiryDate", "expDate", "validTill"),
        "expiry_status": j("expiryStatus", "expired", "isExpired"),
        "category": j("category", "adCategory", "raw.query.category"),
        "intent": j("intent", "adIntent", default="'rent'"),
        "status": j("status", "adStatus", "isActive"),
        "created_at": j("createdAt", "dateCreated", "postedDate"),
        "updated_at": j("updatedAt", "lastModified", "modifiedAt"),
        "timezone": j("timezone", "timeZone", "raw.locale"),
        "page_url": "url",
        "og_title": "NULL",
    },
)
_user = lambda *ks: [f"{u}.{k}" for k in ks for u in ("user", "author", "contact")]
_rec(
    "rec_poster",
    _struct(R.rec_poster),
    {
        "display_name": j(*_user("displayName", "name", "fullName"), "postedByName", "ownerName", "contactName"),
        "email": f"sha256({j(*_user('email', 'emailId'), 'email', 'contactEmail')})",
        "phone": f"sha256({j(*_user('phone', 'mobile', 'phoneNumber'), 'phone', 'mobile', 'contactPhone')})",
        "role": j(*_user("role", "userType"), "postedByRole"),
        "uid": j(*_user("uid", "userId", "id"), "userId", "postedById"),
        "business": j(*_user("business", "businessName", "company")),
        "verification_status": j(*_user("verificationStatus", "verified", "isVerified"), "isVerified"),
        "profile_photo": j(*_user("profilePhoto", "photoUrl", "avatar", "picture")),
        "member_since": j(*_user("memberSince", "createdAt", "joinedAt")),
    },
)
_rec(
    "rec_payment",
    _struct(R.rec_payment),
    {
        "payment_id": j("payment.paymentId", "paymentId"),
        "order_id": j("payment.orderId", "orderId"),
        "plan_id": j("payment.planId", "planId"),
        "plan_name": j("payment.planName", "planName"),
        "paid_amount": j("payment.paidAmount", "payment.amount", "paidAmount"),
        "paid_at": j("payment.paidAt", "paidAt"),
        "payment_method": j("payment.paymentMethod", "payment.method"),
        "promo_code": j("payment.promoCode", "promoCode"),
        "duration_days": j("payment.durationDays", "durationDays"),
    },
)
_rec(
    "rec_privacy",
    _struct(R.rec_privacy),
    {
        "hide_phone": j("privacy.hidePhone", "hidePhone", "maskPhone"),
        "hide_email": j("privacy.hideEmail", "hideEmail", "maskEmail"),
        "hide_address": j("privacy.hideAddress", "hideAddress"),
        "on_whatsapp": j("privacy.whatsappactived", "whatsappactived", "whatsapp"),
        "map_visibility": j("privacy.mapVisibility", "mapVisibility", "showMap"),
    },
)


@query("find_ad_node", _AD + f" SELECT ad_id, {_AD_PATH} AS ad_path, json_extract_string(ad, '$.extra') AS extra FROM n")
def find_ad_node(spark, d):
    return ad_rows(spark, d).select("ad_id", "ad_path", J.json_get_path(c("ad"), "$.extra").alias("extra"))


@query(
    "rec_ad_id",
    _AD + f" SELECT ad_id, {j('adId', 'id', 'listingId', 'raw.query.adId', 'raw.query.id')} AS found, CAST(ad_id AS VARCHAR) AS from_url FROM n",
)
def rec_ad_id(spark, d):
    rows = ad_rows(spark, d)
    bare = F.parse_json(F.lit("{}"))
    return (
        rows.withColumn("found", R.rec_ad_id(ADS_SITE))
        .withColumns({"ad": bare, "raw": bare})
        .select("ad_id", "found", R.rec_ad_id(ADS_SITE).alias("from_url"))
    )


_KNOWN = ["title", "rent", "price", "monthlyRent", "location", "preferences", "user", "author", "contact", "payment", "privacy", "details"]


@query(
    "rec_unknown_fields",
    _AD
    + f""", e AS (SELECT ad_id, unnest(json_keys(ad)) AS key, ad FROM n)
SELECT ad_id, key, CAST(json_extract(ad, '$.' || key) AS VARCHAR) AS value FROM e WHERE key NOT IN ({", ".join(f"'{k}'" for k in _KNOWN)})""",
)
def rec_unknown_fields(spark, d):
    return ad_rows(spark, d).select("ad_id", F.explode(R.rec_unknown_fields(_KNOWN)))


@query(
    "rec_ad",
    _AD
    + f""" SELECT ad_id, {j('adId', 'id', 'listingId', 'raw.query.adId')} AS rec_id, url AS source_url, {j('title', 'adTitle', 'heading')} AS title,
  {j('details')} AS description, {j('leaseTerm')} AS stay_type, '75001' AS zip_code, CAST(0 AS INTEGER) AS n_photos, {j('smoking')} AS smoking, 'room' AS category,
  'true' AS hide_phone, TIMESTAMP '2026-06-01 00:00:00' AS scraped_at FROM n""",
)
def rec_ad(spark, d):
    rows = ad_rows(spark, d).withColumns({"page_id": c("ad_id"), "scraped_at": F.expr("TIMESTAMP_NTZ '2026-06-01 00:00:00'")})
    return R.rec_ad(rows, ADS_SITE).select(
        c("page_id").alias("ad_id"),
        c("ad_id").alias("rec_id"),
        "source_url",
        "property.title",
        c("description.full_description").alias("description"),
        "availability.stay_type",
        "location.zip_code",
        F.size("photos").alias("n_photos"),
        "preferences.smoking",
        "metadata.category",
        "privacy.hide_phone",
        "scraped_at",
    )


def details_rows(spark, d):
    df = html_pages(spark, d).withColumn("scraped_at", F.expr("TIMESTAMP_NTZ '2026-06-01 00:00:00'"))
    staged = df.select("page_id", "url", "scraped_at", H.outlined_tokens(c("html")).alias("page"), H.page_text(c("html")).alias("page_text"))
    return R.rec_scraped_details(staged.select("page_id", "url", "scraped_at", "page.tokens", "page.outline", "page.images", "page_text"), ADS_SITE)


_DETAIL_COLS = """ad_id source_url title ad_type property_category bedrooms bathrooms available_from rent accommodates room_type stay_type accommodation_type
 couples_allowed area_sqft deposit rent_currency posted_by posted_on ad_id_on_site description amenities utilities verified_credentials photos photo_count scraped_at""".split()


@query(
    "rec_scraped_details",
    with_fixtures("f_html")
    + r""" SELECT page_id, CAST(page_id AS VARCHAR) AS ad_id, url AS source_url, regexp_extract(html, '<title> (.*?) </title>', 1) || ' & more' AS title,
  regexp_extract(html, 'Ad Type</td><td>([^<]*)', 1) AS ad_type, 'Apartment' AS property_category, regexp_extract(html, '([0-9] Beds)', 1) AS bedrooms,
  CAST(NULL AS VARCHAR) AS bathrooms, CAST(NULL AS VARCHAR) AS available_from, CAST(NULL AS VARCHAR) AS rent, CAST(NULL AS VARCHAR) AS accommodates,
  CAST(NULL AS VARCHAR) AS room_type, CAST(NULL AS VARCHAR) AS stay_type, CAST(NULL AS VARCHAR) AS accommodation_type, CAST(NULL AS VARCHAR) AS couples_allowed,
  regexp_extract(html, '([0-9]+) sqft', 1) AS area_sqft, regexp_extract(html, 'Deposit</b></div><div>[$]([0-9]+)', 1) AS deposit, 'USD' AS rent_currency,
  'User ' || regexp_extract(html, 'og:title" content="([^"]*)"', 1) AS posted_by, 'Jun 05, 2026' AS posted_on, CAST(page_id AS VARCHAR) AS ad_id_on_site,
  regexp_extract(html, '(Long enough[^<]*)', 1) AS description, ['Gym', 'Lift'] AS amenities, ['Water'] AS utilities, ['Phone Verified'] AS verified_credentials,
  ['https://img.example.com/t/' || CAST(page_id AS VARCHAR) || '.jpg', 'https://img.example.com/full/' || CAST(page_id AS VARCHAR) || '.jpg',
   regexp_extract(html, 'data-src="([^"]*)"', 1)] AS photos, CAST(3 AS INTEGER) AS photo_count, TIMESTAMP '2026-06-01 00:00:00' AS scraped_at,
  'Houston, TX, USA, 77004' AS full_address, 'Harris County' AS county, [regexp_extract(html, 'Neighborhoods: ([A-Z]+),', 1), 'Midtown'] AS hoods,
  'No Smoking' AS smoking, CASE WHEN NOT contains(html, 'Only Dogs') THEN 'Fully furnished' END AS furnishing, 'Alcohol not allowed' AS alcohol, 'Female only' AS gender FROM f_html""",
)
def rec_scraped_details(spark, d):
    return details_rows(spark, d).select(
        "page_id",
        *[c(f"details.{f}") for f in _DETAIL_COLS],
        "details.address.full_address",
        "details.address.county",
        c("details.address.nearby_neighborhoods").alias("hoods"),
        "details.additional_info.smoking",
        "details.additional_info.furnishing",
        "details.tenant_preferences.alcohol",
        c("details.tenant_preferences.gender_preference").alias("gender"),
    )


@query(
    "normalize_missing",
    _AD + f""" SELECT ad_id, {j('title', 'adTitle', default="'not_found'")} AS title, {j('baths', default="'not_found'")} AS baths, 'USD' AS rent_currency,
  CAST(ad_id AS VARCHAR) AS number_text, {j('extraNotes', default="'not_found'")} AS extra_notes FROM n""",
)
def normalize_missing(spark, d):
    rows = ad_rows(spark, d).withColumns({"property": R.resolve_aliases({**A.PROPERTY, "title": ("ad.title", "ad.adTitle")}), "description": R.rec_description(), "number": c("ad_id")})
    out = R.normalize_missing(rows.select("ad_id", "property", "description", "number"), ["property", "description", "number"])
    return out.select("ad_id", "property.title", "property.baths", "property.rent_currency", c("number").alias("number_text"), "description.extra_notes")


@query(
    "is_missing",
    _AD + f" SELECT ad_id, json_extract_string(ad, '$.title') = '' AS title_missing, true AS marker, {j('title')} AS title FROM n",
)
def is_missing(spark, d):
    title = J.json_get_path(c("ad"), "$.title")
    return ad_rows(spark, d).select(
        "ad_id", T.is_missing(title).alias("title_missing"), T.is_missing(F.lit("not_found")).alias("marker"), T.present(title).alias("title")
    )


@query(
    "flatten_keys",
    """SELECT event_id, key, value FROM (SELECT event_id, 'props.k' AS key, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events
  UNION ALL SELECT event_id, 'who.user', CAST(user_id AS VARCHAR) FROM events UNION ALL SELECT event_id, 'list', '[1,2]' FROM events)""",
)
def flatten_keys(spark, d):
    body = F.concat(F.lit('{"props":'), c("props"), F.lit(',"list":[1,2],"who":{"user":'), c("user_id").cast("string"), F.lit("}}"))
    df = table(spark, d, "events").select("event_id", F.try_parse_json(body).alias("v"))
    leaves = M.json_leaves(df, ["event_id"], "v")
    return leaves.select("event_id", M.dotted(c("path")).alias("key"), "value")
