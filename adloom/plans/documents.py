"""Documents, search index, legacy shape (2.G) and validation (2.I)."""

from pyspark.sql import functions as F

from adloom.functions import normalize as N
from adloom.functions.text import label_key
from adloom.operators import document as D
from adloom.operators import quality as Q
from adloom.operators.schema import Schema, document_schema
from adloom.plans.registry import query
from adloom.plans.scalars import items
from adloom.session import new_table_path, settled
from adloom.sources import tables as S
from adloom.sources.fixtures import fixture, table, with_fixtures

c = F.col
OWNER = D.Owner(uid="owner-1", display_name="Front desk")


def ad_records(spark, d):
    """The ads fixture in the shape of the record builders."""
    none = F.lit(None).cast("string")
    return S.spread(fixture(spark, d, "f_ads"), scan=table(spark, d, "orders")).select(
        "ad_id",
        F.struct(
            c("title"), c("json_rent").cast("string").alias("rent_amount"), c("json_beds").cast("string").alias("beds"), none.alias("rent_currency")
        ).alias("property"),
        F.struct(
            c("state_code"), c("zip").alias("zip_code"), c("metro").alias("metro_area"), F.lit("US").alias("country_code"), F.lit("Town").alias("city"),
            c("lat").cast("string").alias("latitude"), c("lng").cast("string").alias("longitude"),
        ).alias("location"),
        F.struct(c("raw_status").alias("status"), F.when(c("raw_status") == "P", "expired").alias("expiry_status")).alias("metadata"),
        F.struct(F.when(c("raw_status") == "F", "true").alias("hide_phone")).alias("privacy"),
        F.struct(
            c("ad_type"), c("details_rent").alias("rent"), c("details_beds").alias("bedrooms"), c("posted_on"), F.lit("Apartment").alias("property_category"),
            F.array(F.lit("Gym"), F.lit("Lift"), F.lit("Fitness Room")).alias("amenities"),
            F.struct(F.lit("Fully furnished").alias("furnishing"), F.when(c("raw_status") == "O", "No Pets").alias("pets")).alias("additional_info"),
            F.struct(F.lit("Female only").alias("gender_preference"), F.lit("Students only allowed").alias("occupation")).alias("tenant_preferences"),
        ).alias("details"),
    )


def documents(spark, d):
    return D.build_document(ad_records(spark, d), OWNER)


_EFF = with_fixtures("f_ads") + """, eff AS (SELECT ad_id, title, coalesce(CAST(json_rent AS DOUBLE), CAST(regexp_extract(details_rent, '[0-9]+') AS DOUBLE)) AS rent, 'USD' AS currency, 'per_week' AS mode,
  coalesce(json_beds, CAST(left(details_beds, 1) AS INTEGER)) AS beds, CAST(strptime(posted_on, '%b %d, %Y') AS DATE) AS active_date,
  CAST(CAST(strptime(posted_on, '%b %d, %Y') AS DATE) + INTERVAL 1 YEAR AS DATE) AS expiry_date, CASE WHEN ad_type = 'Property Wanted' THEN 'find' ELSE 'list' END AS intent,
  CASE WHEN ad_type = 'Property Wanted' THEN 'room' ELSE 'property' END AS category, metro, state_code, zip, raw_status, lat, lng FROM f_ads)"""


@query(
    "effective_values",
    _EFF + " SELECT ad_id, rent, currency, mode, beds, CAST(NULL AS INTEGER) AS baths, active_date, expiry_date, intent, category, metro FROM eff",
)
def effective_values(spark, d):
    rows = D.effective_values(D.conform_record(ad_records(spark, d)))
    names = ["currency", "mode", "beds", "baths", "active_date", "expiry_date", "intent", "category", "metro"]
    return rows.select("ad_id", c("eff.rent").cast("double").alias("rent"), *[c(f"eff.{n}") for n in names])


@query(
    "build_document",
    _EFF
    + """ SELECT CAST(ad_id AS VARCHAR) AS ad_id, 'active' AS status, CASE WHEN raw_status = 'P' THEN 'expiry' ELSE 'active' END AS adexpirystatus, 'America/New_York' AS adtimezone,
  CASE WHEN metro IS NOT NULL THEN 'scraped-metro' END AS admetroarea, active_date AS adactivedate, expiry_date AS adexpirydate, intent, category,
  CASE intent WHEN 'find' THEN 'I am an individual' ELSE 'I am the property owner' END AS role, 'Front desk' AS display_name, 'Town' AS display, metro AS metro_area, lat, lng, true AS show_on_map,
  title, rent, currency, mode, 'fully_furnished' AS furnishing, ['gym_fitness_center', 'elevator'] AS amenities, raw_status = 'F' AS hide_phone_on_ad, raw_status <> 'F' AS share_phone,
  CASE intent WHEN 'list' THEN beds END AS beds, CASE intent WHEN 'list' THEN 'apartment' END AS property_type, CASE intent WHEN 'list' THEN 'Female' END AS preferred_gender,
  CASE intent WHEN 'list' THEN 'students_only' END AS occupation, CASE intent WHEN 'list' THEN CASE raw_status WHEN 'O' THEN 'no_pets' ELSE 'Any' END END AS pets,
  CASE intent WHEN 'list' THEN 'Yes' END AS couples_welcome, CASE intent WHEN 'find' THEN 'female_only' END AS gender_preference, CASE intent WHEN 'find' THEN 'student' END AS seeker_occupation,
  DATE '2100-12-31' AS available_to, true AS long_stay FROM eff""",
)
def build_document(spark, d):
    m, loc, det = "doc.metadata", "doc.location", "doc.details"
    return documents(spark, d).select(
        "doc.ad_id",
        *[c(f"{m}.{f}") for f in ("status", "adexpirystatus", "adtimezone", "admetroarea", "adactivedate", "adexpirydate", "intent", "category", "role")],
        "doc.user.display_name",
        *[c(f"{loc}.{f}") for f in ("display", "metro_area", "lat", "lng", "show_on_map")],
        c(f"{det}.title"),
        c(f"{det}.rent.amount").cast("double").alias("rent"),
        c(f"{det}.rent.currency"),
        c(f"{det}.rent.mode"),
        c(f"{det}.furnishing"),
        c(f"{det}.amenities"),
        "doc.privacy.hide_phone_on_ad",
        "doc.privacy.share_phone",
        "doc.property_details.beds",
        "doc.property_details.property_type",
        *[c(f"doc.preferences.{f}") for f in ("preferred_gender", "occupation", "pets", "couples_welcome")],
        "doc.room_details.gender_preference",
        c("doc.seeker.occupation").alias("seeker_occupation"),
        c(f"{det}.availability.to").alias("available_to"),
        c(f"{det}.availability.stay_type.long").alias("long_stay"),
    )


def index_rows(spark, d):
    idx = D.search_index(documents(spark, d))
    return idx.withColumn("rent", c("rent").cast("double"))


@query(
    "search_index",
    _EFF
    + """ SELECT CAST(ad_id AS VARCHAR) AS ad_id, 'owner-1' AS userid, 'active' AS status, CASE WHEN raw_status = 'P' THEN 'expiry' ELSE 'active' END AS adexpirystatus, active_date AS adactivedate,
  expiry_date AS adexpirydate, lower(title) AS title_lowercase, 'town' AS city, '' AS locality, '' AS sub_locality, '' AS district, '' AS state, state_code, '' AS country, 'US' AS country_code,
  lower(coalesce(metro, '')) AS metro_area, zip AS zipcode, rent, currency, beds, CAST(0 AS INTEGER) AS baths, 'apartment' AS property_type, category, intent FROM eff""",
)
def search_index(spark, d):
    return index_rows(spark, d)


def flagship(spark, d):
    """Ads and rent by intent and state, over the search index."""
    return (
        index_rows(spark, d)
        .groupBy("intent", "state_code")
        .agg(F.count(F.lit(1)).alias("ads"), F.sum(c("rent").cast("decimal(14,2)")).cast("double").alias("total_rent"), F.max("rent").alias("max_rent"))
    )


query(
    "rent_by_intent_and_state",
    _EFF + " SELECT intent, state_code, count(*) AS ads, CAST(sum(CAST(rent AS DECIMAL(14,2))) AS DOUBLE) AS total_rent, max(rent) AS max_rent FROM eff GROUP BY ALL",
)(flagship)


@query("export_documents", _EFF + " SELECT CAST(ad_id AS VARCHAR) AS ad_id, title, rent, intent, beds, active_date AS adactivedate FROM eff WHERE true")
def export_documents(spark, d):
    docs = documents(spark, d).select("doc.*")
    path = new_table_path(spark, "documents")
    S.export_documents(docs, path)
    back = spark.read.schema(docs.schema).json(path)
    return back.select(
        "ad_id", "details.title", c("details.rent.amount").cast("double").alias("rent"), "metadata.intent", "search.beds", "metadata.adactivedate"
    )


@query("write_ads", with_fixtures("f_ads") + " SELECT ad_id, title, intent FROM (SELECT ad_id, title, CASE WHEN ad_type = 'Property Wanted' THEN 'find' ELSE 'list' END AS intent FROM f_ads)")
def write_ads(spark, d):
    ads = fixture(spark, d, "f_ads").withColumn("intent", N.intent(c("ad_type")))
    path = new_table_path(spark, "ads")
    S.write_ads(ads.where("intent = 'find'"), path, "intent")
    S.write_ads(ads.where("intent = 'list'"), path, "intent")
    return spark.read.schema(ads.schema).parquet(path).select("ad_id", "title", "intent")


# ---- validation ------------------------------------------------------------------------------


def _broken(spark, d):
    """Documents of which some were damaged on purpose, so that every rule has something to find."""
    n = c("doc.ad_id").cast("bigint")
    return documents(spark, d).select(
        "ad_id",
        c("doc")
        .withField("metadata.status", F.when(n % 7 == 0, F.lit("gone")).when(n % 7 == 1, F.lit(None)).otherwise(c("doc.metadata.status")))
        .withField("user.role", F.when(n % 5 != 0, c("doc.user.role")))
        .withField("details.rent.mode", F.when(n % 11 == 0, F.lit("per_hour")).otherwise(c("doc.details.rent.mode")))
        .withField("details.amenities", F.when(n % 13 == 0, F.array(F.lit("helipad"))).otherwise(c("doc.details.amenities")))
        .withField("seeker", F.when(n % 2 == 0, c("doc.seeker")))
        .alias("doc"),
    )


@query(
    "validate_required",
    with_fixtures("f_ads")
    + """ SELECT ad_id, list_filter([CASE WHEN ad_id % 7 = 1 THEN 'metadata.status' END, CASE WHEN ad_id % 5 = 0 THEN 'user.role' END], lambda x: x IS NOT NULL) AS missing FROM f_ads""",
)
def validate_required(spark, d):
    return _broken(spark, d).select("ad_id", Q.validate_required(c("doc")).alias("missing"))


@query(
    "validate_enums",
    with_fixtures("f_ads")
    + """ SELECT ad_id, list_filter([CASE WHEN ad_id % 7 = 0 THEN 'metadata.status' END, CASE WHEN ad_id % 11 = 0 THEN 'details.rent.mode' END,
  CASE WHEN ad_id % 13 = 0 THEN 'details.amenities' END], lambda x: x IS NOT NULL) AS outside FROM f_ads""",
)
def validate_enums(spark, d):
    return _broken(spark, d).select("ad_id", Q.validate_enums(c("doc")).alias("outside"))


@query(
    "validate_variant",
    with_fixtures("f_ads") + " SELECT ad_id, NOT (coalesce(ad_type = 'Property Wanted', false) AND ad_id % 2 = 1) AS valid FROM f_ads",
)
def validate_variant(spark, d):
    return _broken(spark, d).select("ad_id", Q.validate_variant(c("doc")).alias("valid"))


# every member with a vocabulary, and the intent whose documents have it
_ENUM_PATHS = [
    ("metadata.status", None), ("metadata.adexpirystatus", None), ("metadata.intent", None), ("metadata.category", None), ("details.rent.mode", None),
    ("details.amenities", None), ("details.utilities", None), ("details.furnishing", None), ("property_details.property_type", "list"),
    *[(f"preferences.{f}", "list") for f in ("occupation", "smoking", "pets", "vegetarian", "age_range", "preferred_gender", "couples_welcome", "alcohol_allowed", "languages")],
    ("room_details.gender_preference", "find"), ("seeker.gender", "find"), ("seeker.occupation", "find"), ("seeker.languages", "find"),
]
_ENUM_LISTS = ("details.amenities", "details.utilities", "preferences.languages", "seeker.languages")
_DAMAGE = ", ".join(f"({k}, '{p}', {repr(need) if need else 'NULL'})" for k, (p, need) in enumerate(_ENUM_PATHS))


@query(
    "validate_schema",
    with_fixtures("f_ads")
    + f""", damage(k, path, need) AS (VALUES {_DAMAGE}), ads AS (SELECT ad_id, ad_id % 25 AS k, CASE WHEN ad_type = 'Property Wanted' THEN 'find' ELSE 'list' END AS intent FROM f_ads)
SELECT ad_id, path, 'enum' AS rule FROM ads JOIN damage USING (k) WHERE need IS NULL OR need = intent
UNION ALL SELECT ad_id, 'metadata.role', 'required' FROM ads WHERE k = 22
UNION ALL SELECT ad_id, CASE intent WHEN 'find' THEN 'room_details' ELSE 'property_details' END, 'required' FROM ads WHERE k = 23
UNION ALL SELECT ad_id, '', 'not' FROM ads WHERE k = 24 AND intent = 'list'""",
)
def validate_schema(spark, d):
    """Every vocabulary damaged in its own share of the documents, a missing role, a missing section, and a listed ad that seeks."""
    docs = settled(documents(spark, d).select("ad_id", "doc"))
    kind, k = docs.schema["doc"].dataType, c("ad_id") % 25
    bad = F.array(F.lit("English"), F.lit("helipad"))
    wrong = {path: F.when(k == at, bad if path in _ENUM_LISTS else F.lit("helipad")).otherwise(c(f"doc.{path}")) for at, (path, _) in enumerate(_ENUM_PATHS)}
    wrong["metadata.role"] = F.when(k != 22, c("doc.metadata.role"))
    doc = _rebuilt(c("doc"), kind, "", wrong)
    members = {f.name: doc[f.name] for f in kind.fields}
    for section in ("room_details", "property_details"):
        members[section] = F.when(k != 23, members[section])
    nobody = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind["seeker"].dataType.fields])
    members["seeker"] = F.when(k == 24, F.coalesce(c("doc.seeker"), nobody)).otherwise(members["seeker"])
    broken = settled(docs.select("ad_id", F.struct(*[v.alias(f) for f, v in members.items()]).alias("doc")))
    # settled before it is a row each: a generator's own expression is interpreted, and a filter on its size would run all checks again
    checked = settled(broken.select("ad_id", Schema(document_schema()).violations(c("doc"), kind).alias("found"))).select("ad_id", F.explode("found").alias("v"))
    return checked.select("ad_id", "v.path", "v.rule")


def _rebuilt(value, kind, path, changes):
    """A struct with some members, named by dotted paths, replaced; what is NULL stays NULL."""
    fields = []
    for f in kind.fields:
        inner = f"{path}.{f.name}".lstrip(".")
        below = any(p.startswith(inner + ".") for p in changes)
        fields.append((_rebuilt(value[f.name], f.dataType, inner, changes) if below else changes.get(inner, value[f.name])).alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields))


# ---- retired shape ---------------------------------------------------------------------------


@query(
    "legacy_amenity_map",
    with_fixtures("f_amen")
    + """, e AS (SELECT ad_id, unnest(string_split(legacy_keys, '|')) AS key, 'on' AS value FROM f_amen
  UNION ALL SELECT ad_id, replace(lower(unnest(string_split(amenity_labels, '|'))), ' ', '_'), 'true' FROM f_amen)
SELECT ad_id, key, value FROM e""",
)
def legacy_amenity_map(spark, d):
    bag = F.map_from_entries(F.transform(items("legacy_keys"), lambda k: F.struct(k, F.lit("on"))))
    both = D.legacy_amenity_map(bag, items("amenity_labels"))
    return fixture(spark, d, "f_amen").select("ad_id", F.explode(both).alias("key", "value")).withColumn("key", label_key(c("key")))


@query(
    "legacy_document",
    with_fixtures("f_ads")
    + """ SELECT ad_id, coalesce(json_beds, CAST(left(details_beds, 1) AS INTEGER)) AS beds, CAST(450 AS DOUBLE) AS square_feet, 'find' AS intent, raw_status AS status,
  CASE WHEN raw_status = 'P' THEN 'expired' ELSE 'active' END AS adexpirystatus, 'property' AS category, 'Town' AS city, metro AS metro_area, 'Female' AS preferred_gender,
  'Students only allowed' AS occupation, CASE raw_status WHEN 'O' THEN 'No Pets' END AS pets, DATE '2026-06-01' AS available_from,
  coalesce(CAST(json_rent AS DOUBLE), CAST(regexp_extract(details_rent, '[0-9]+') AS DOUBLE)) AS rent, CAST(NULL AS VARCHAR) AS plan_id FROM f_ads""",
)
def legacy_document(spark, d):
    keys = ["area450_sqft", "available_from1_june_2026", "ad_typeproperty_wanted", "bedrooms_9"]
    bag = F.create_map(*[F.lit(x) for k in keys for x in (k, "true")])
    docs = D.legacy_document(ad_records(spark, d).withColumn("amenities", bag), OWNER)
    return docs.select(
        "ad_id",
        "doc.property_details.beds",
        "doc.property_details.square_feet",
        "doc.metadata.intent",
        "doc.metadata.status",
        "doc.metadata.adexpirystatus",
        "doc.metadata.category",
        "doc.details.location.city",
        "doc.details.location.metro_area",
        "doc.preferences.preferred_gender",
        "doc.preferences.occupation",
        "doc.preferences.pets",
        "doc.details.available_from",
        c("doc.details.rent.amount").cast("double").alias("rent"),
        "doc.payment.plan_id",
    )
