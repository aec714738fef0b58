"""Closed-vocabulary normalization (2.G) and text functions."""

from pyspark.sql import functions as F

from adloom.functions import normalize as N
from adloom.functions import text as T
from adloom.functions import vocab
from adloom.plans.registry import query
from adloom.sources.fixtures import fixture, table, with_fixtures

c = F.col
# columns need a running session, so every projection below is a function
# ruff: noqa: E731


def _on(fix, key, cols, sql):
    """Register a projection over one fixture: Spark columns against SQL columns."""

    def run(spark, d):
        return fixture(spark, d, fix).select("ad_id", *[e.alias(n) for n, e in cols().items()])

    select = ", ".join(f"{e} AS {n}" for n, e in sql.items())
    query(key, with_fixtures(fix) + f" SELECT ad_id, {select} FROM {fix}")(run)


def items(name):
    return F.filter(F.split(c(name), r"\|"), lambda x: x != "")


def _list(name):
    return f"list_filter(string_split({name}, '|'), lambda x: x <> '')"


_NUM = r"regexp_extract(replace({0}, ',', ''), '[0-9]+([.][0-9]+)?')"
_rent = lambda: N.parse_rent(c("rent_text"))
_on(
    "f_rent",
    "parse_rent",
    lambda: {"amount": _rent()["amount"].cast("double"), "currency": _rent()["currency"], "mode": _rent()["mode"]},
    {
        "amount": "CAST(" + _NUM.format("rent_text") + " AS DOUBLE)",
        "currency": "CASE left(rent_text, 1) WHEN '₹' THEN 'INR' WHEN '£' THEN 'GBP' WHEN '€' THEN 'EUR' ELSE 'USD' END",
        "mode": "CASE WHEN rent_text ILIKE '%week%' THEN 'per_week' WHEN rent_text ILIKE '%day%' THEN 'per_day' WHEN rent_text ILIKE '%year%' THEN 'per_year' ELSE 'per_month' END",
    },
)
_on(
    "f_rent",
    "parse_beds",
    lambda: {"beds": N.parse_beds(c("beds_text"))},
    {"beds": "CASE WHEN beds_text = 'Studio' THEN 0 ELSE CAST(string_split(beds_text, ' ')[1] AS INTEGER) END"},
)
_on("f_rent", "parse_baths", lambda: {"baths": N.parse_baths(c("baths_text"))}, {"baths": "CAST(left(baths_text, 1) AS INTEGER)"})
_on(
    "f_rent",
    "parse_area",
    lambda: {"area": N.parse_area(c("area_text"))},
    {"area": "CAST(replace(string_split(area_text, ' ')[1], ',', '') AS DOUBLE)"},
)


@query(
    "property_type",
    with_fixtures("f_rent")
    + """, both_sources AS (SELECT ad_id, 'fixture' AS origin, type_text FROM f_rent UNION ALL SELECT p_partkey, 'part', p_type FROM part)
SELECT ad_id, origin, CASE regexp_replace(lower(trim(type_text)), ' +', ' ', 'g') WHEN 'town house' THEN 'townhouse' WHEN 'single room' THEN 'single_room'
  WHEN 'apartment' THEN 'apartment' WHEN 'single family home' THEN 'single_family_home' WHEN 'paying guest' THEN 'paying_guest' END AS property_type FROM both_sources""",
)
def property_type(spark, d):
    ads = fixture(spark, d, "f_rent").select("ad_id", F.lit("fixture").alias("origin"), "type_text")
    parts = table(spark, d, "part").select("p_partkey", F.lit("part"), "p_type")
    return ads.union(parts).select("ad_id", "origin", N.property_type(c("type_text")).alias("property_type"))


_on(
    "f_text",
    "rent_from_text",
    lambda: {"rent_text": N.rent_from_text(c("page_text"))},
    {
        "rent_text": r"""CASE WHEN contains(page_text, 'EXPECTED RENT') THEN regexp_extract(page_text, 'EXPECTED RENT\n([^\n]+)', 1)
            ELSE regexp_extract(page_text, 'rent: ([^\n]+)', 1) END"""
    },
)


def _orders(key, cols, sql):
    query(key, f"SELECT o_orderkey, {sql} FROM orders")(
        lambda spark, d: table(spark, d, "orders").select("o_orderkey", *[e.alias(n) for n, e in cols().items()])
    )


_styles = ["MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "yyyy-MM-dd", "MMM dd yyyy"]
_written = lambda: F.expr(
    "CASE o_orderkey % 6 "
    + " ".join(f"WHEN {i} THEN date_format(o_orderdate, '{f}')" for i, f in enumerate(_styles))
    + " ELSE 'about ' || date_format(o_orderdate, 'yyyy') END"
)
_orders("posted_date", lambda: {"posted": N.posted_date(_written())}, "CASE WHEN o_orderkey % 6 < 5 THEN CAST(o_orderdate AS DATE) END AS posted")
_day = lambda: c("o_orderdate").cast("date")
_orders("add_one_year", lambda: {"expires": N.add_one_year(_day())}, "CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) AS expires")
_orders("format_date", lambda: {"day": N.format_date(_day())}, "strftime(o_orderdate, '%Y-%m-%d') AS day")
_orders(
    "ad_status",
    lambda: {"status": N.ad_status(F.expr("CASE o_orderstatus WHEN 'O' THEN 'Expired ad' WHEN 'F' THEN 'live' END"))},
    "CASE o_orderstatus WHEN 'O' THEN 'disable' ELSE 'active' END AS status",
)
_orders(
    "expiry_status",
    lambda: {"status": N.expiry_status(F.expr("CASE o_orderstatus WHEN 'O' THEN 'expiry' WHEN 'F' THEN 'True' ELSE 'no' END"))},
    "CASE WHEN o_orderstatus IN ('O', 'F') THEN 'expiry' ELSE 'active' END AS status",
)


def _part(key, cols, sql):
    query(key, f"SELECT p_partkey, {sql} FROM part")(
        lambda spark, d: table(spark, d, "part").select("p_partkey", *[e.alias(n) for n, e in cols().items()])
    )


_part(
    "slugify",
    lambda: {"slug": T.slugify(F.concat(c("p_name"), F.lit(" -- "), c("p_brand"), F.lit("!")))},
    r"trim(regexp_replace(lower(p_name || ' -- ' || p_brand || '!'), '[^a-z0-9]+', '-', 'g'), '-') AS slug",
)
_part(
    "match_option",
    lambda: {
        "gender": N.match_option(
            F.expr("CASE p_size % 6 WHEN 0 THEN ' female ' WHEN 1 THEN 'Female only' WHEN 2 THEN 'males' WHEN 3 THEN 'ANY' WHEN 4 THEN '' END"),
            vocab.GENDERS,
        ),
        "kind": N.match_option(c("p_type"), ["eco", "Small", "promotion", "medium large"]),
    },
    """CASE p_size % 6 WHEN 0 THEN 'Female' WHEN 1 THEN 'Female' WHEN 2 THEN 'Male' WHEN 3 THEN 'Any' END AS gender,
    CASE p_type WHEN 'ECONOMY' THEN 'eco' WHEN 'SMALL' THEN 'Small' WHEN 'PROMO' THEN 'promotion' WHEN 'MEDIUM' THEN 'medium large' WHEN 'LARGE' THEN 'medium large' END AS kind""",
)


def _events(key, cols, sql):
    query(key, f"SELECT event_id, {sql} FROM events")(
        lambda spark, d: table(spark, d, "events").select("event_id", *[e.alias(n) for n, e in cols().items()])
    )


_ad_type = lambda: F.expr("CASE event_type WHEN 'view' THEN 'Property Wanted' WHEN 'click' THEN 'Property Offered' WHEN 'error' THEN 'x' END")
_events("intent", lambda: {"intent": N.intent(_ad_type())}, "CASE WHEN event_type = 'view' THEN 'find' ELSE 'list' END AS intent")
_events(
    "category_role",
    lambda: {"category": N.category(N.intent(_ad_type())), "role": N.role(N.intent(_ad_type()))},
    """CASE WHEN event_type = 'view' THEN 'room' ELSE 'property' END AS category,
    CASE WHEN event_type = 'view' THEN 'I am an individual' ELSE 'I am the property owner' END AS role""",
)

_info = lambda: items("info_items")
_prefs = lambda: items("pref_items")
_on(
    "f_amen",
    "languages",
    lambda: {"languages": N.languages(items("language_labels"))},
    {"languages": "CASE language_labels WHEN 'English' THEN ['English'] ELSE ['Hindi', 'Tamil'] END"},
)
_pref1 = lambda: F.get(_prefs(), F.lit(0))
_on(
    "f_amen",
    "alcohol_flag",
    lambda: {"alcohol": N.alcohol_flag(_pref1())},
    {"alcohol": "CASE WHEN pref_items LIKE 'Alcohol not%' THEN false WHEN pref_items LIKE 'Alcohol is ok%' OR pref_items LIKE 'Students only allowed%' THEN true END"},
)
_last_info = lambda: F.element_at(_info(), -1)
_on(
    "f_amen",
    "furnishing",
    lambda: {"furnishing": N.furnishing(_last_info())},
    {
        "furnishing": """CASE list_last(string_split(info_items, '|')) WHEN 'Semi Furnished' THEN 'semi_furnished' WHEN 'Furnished with bed' THEN 'furnished_with_bed'
          WHEN 'Fully furnished' THEN 'fully_furnished' ELSE 'unfurnished' END"""
    },
)
_smoke = lambda: F.get(_info(), F.lit(0))
_on(
    "f_amen",
    "slug_or_any",
    lambda: {
        "occupation": N.slug_or_any(c("pref_items"), vocab.OCCUPATION),
        "smoking": N.slug_or_any(_smoke(), vocab.SMOKING),
        "pets": N.slug_or_any(c("info_items"), vocab.PETS),
        "vegetarian": N.slug_or_any(c("info_items"), vocab.VEGETARIAN),
        "age_range": N.slug_or_any(c("pref_items"), vocab.AGE_RANGE),
    },
    {
        "occupation": "CASE WHEN pref_items ILIKE '%student%' THEN 'students_only' WHEN pref_items ILIKE '%professional%' THEN 'professionals_only' ELSE 'Any' END",
        "smoking": "CASE split_part(info_items, '|', 1) WHEN 'No Smoking' THEN 'no_smoking' WHEN 'Smoke outside only' THEN 'smoke_outside_only' WHEN 'Smoking is Ok' THEN 'smoking_ok' ELSE 'Any' END",
        "pets": "CASE WHEN info_items LIKE '%Only Dogs%' THEN 'only_dogs' WHEN info_items LIKE '%Any Pet%' THEN 'any_pet_ok' ELSE 'Any' END",
        "vegetarian": "CASE WHEN info_items LIKE '%Non-veg%' THEN 'non_vegetarian' ELSE 'Any' END",
        "age_range": "CASE WHEN pref_items LIKE '%18 to 25%' THEN '18_to_25' WHEN pref_items LIKE '%70 plus%' THEN '70_plus' ELSE 'Any' END",
    },
)
_on(
    "f_amen",
    "yes_no",
    lambda: {"answer": N.yes_no(F.expr("CASE length(pref_items) % 5 WHEN 0 THEN 'Yes, ok' WHEN 1 THEN 'no' WHEN 2 THEN 'false' WHEN 3 THEN 'maybe' END"))},
    {"answer": "CASE WHEN length(pref_items) % 5 IN (1, 2) THEN 'No' ELSE 'Yes' END"},
)
_on(
    "f_amen",
    "gender_slug",
    lambda: {"gender": N.gender_slug(c("pref_items"))},
    {"gender": "CASE WHEN pref_items LIKE '%Female%' THEN 'female_only' WHEN pref_items LIKE '%Male%' THEN 'male_only' ELSE 'any' END"},
)
_on(
    "f_amen",
    "seeker_gender",
    lambda: {"gender": N.seeker_gender(c("pref_items"))},
    {"gender": "CASE WHEN pref_items LIKE '%Female%' THEN 'female' WHEN pref_items LIKE '%Male%' THEN 'male' ELSE 'other' END"},
)
_on(
    "f_amen",
    "seeker_occupation",
    lambda: {"occupation": N.seeker_occupation(c("pref_items"))},
    {"occupation": "CASE WHEN pref_items LIKE '%Student%' THEN 'student' WHEN pref_items LIKE '%Professional%' THEN 'professional' ELSE 'other' END"},
)
_stay = lambda: N.stay_type(c("stay_text"))
_on(
    "f_amen",
    "stay_type",
    lambda: {"short": _stay()["short"], "long": _stay()["long"]},
    {"short": "coalesce(stay_text = 'Short term', false)", "long": "coalesce(stay_text <> 'Short term', true)"},
)
_on(
    "f_amen",
    "amenity_slugs",
    lambda: {"slugs": N.amenity_slugs(items("amenity_labels"))},
    {"slugs": "CASE WHEN amenity_labels LIKE 'Gym%' THEN ['gym_fitness_center', 'swimming_pool'] ELSE ['elevator', 'car_park'] END"},
)
_on(
    "f_amen",
    "utility_slugs",
    lambda: {"slugs": N.utility_slugs(items("utility_labels"))},
    {"slugs": "CASE left(utility_labels, 1) WHEN 'W' THEN CASE WHEN utility_labels LIKE 'WiFi%' THEN ['internet_wifi', 'refrigerator'] ELSE ['water', 'electricity', 'cable_tv'] END ELSE CAST([] AS VARCHAR[]) END"},
)
_extra = lambda: N.classify_items(_info(), vocab.ADDITIONAL_INFO)
_on(
    "f_amen",
    "classify_additional_info",
    lambda: {f: _extra()[f] for f, _ in vocab.ADDITIONAL_INFO},
    {
        "smoking": "list_last(list_filter(string_split(info_items, '|'), lambda x: x ILIKE '%smoking%'))",
        "veg_non_veg": "list_last(list_filter(string_split(info_items, '|'), lambda x: x ILIKE '%veg%'))",
        "pets": "list_last(list_filter(string_split(info_items, '|'), lambda x: x ILIKE '%pet%'))",
        "furnishing": "list_last(list_filter(string_split(info_items, '|'), lambda x: x ILIKE '%furnish%'))",
    },
)
_tenant = lambda: N.classify_items(_prefs(), vocab.TENANT_PREFS)
_on(
    "f_amen",
    "classify_tenant_prefs",
    lambda: {f: _tenant()[f] for f, _ in vocab.TENANT_PREFS},
    {
        "alcohol": "CASE WHEN pref_items LIKE 'Alcohol%' THEN split_part(pref_items, '|', 1) END",
        "occupation": "CASE WHEN pref_items LIKE 'Students%' THEN split_part(pref_items, '|', 1) END",
        "gender_preference": "CASE WHEN pref_items LIKE '%Female%' THEN 'Female only' WHEN pref_items LIKE '%Male%' THEN 'Male' WHEN pref_items LIKE 'Any%' THEN pref_items END",
        "age_range": "CASE WHEN pref_items LIKE '%18 to 25' THEN '18 to 25' END",
    },
)
_old = lambda: N.legacy_amenity_keys(items("legacy_keys"))
_on(
    "f_amen",
    "legacy_amenity_keys",
    lambda: {n: _old()[n] for n in ("intent", "square_feet", "beds", "available_from")},
    {
        "intent": "'find'",
        "square_feet": "CAST(regexp_extract(legacy_keys, '^area([0-9]+)_', 1) AS DOUBLE)",
        "beds": "CAST(regexp_extract(legacy_keys, 'bedrooms_([0-9])', 1) AS INTEGER)",
        "available_from": "DATE '2026-06-01'",
    },
)

_hoods = lambda: N.neighborhoods(
    F.transform(F.split(F.regexp_extract("page_text", r"Nearby Neighborhoods: ([^\n]+)", 1), "[,|]"), T.strip_ws),
    F.array(F.lit("Midtown"), F.lit("not_found"), F.lit("Uptown")),
)
_on(
    "f_text",
    "neighborhoods",
    lambda: {"primary_name": _hoods()["primary"], "secondary": _hoods()["secondary"]},
    {
        "primary_name": "regexp_extract(page_text, 'Neighborhoods: ([A-Z]+),', 1)",
        "secondary": "['Midtown', 'Uptown']",
    },
)
_on(
    "f_photo",
    "photo_choice",
    lambda: {
        "photos": N.photo_choice(
            F.from_json(F.when(F.col("json_photos").rlike(r'^\["'), F.col("json_photos")), "array<string>"),
            F.split("page_photos", r"\|"),
        )
    },
    {"photos": "CASE WHEN json_photos LIKE '[\"%' THEN [substr(json_photos, 3, length(json_photos) - 4)] ELSE string_split(page_photos, '|') END"},
)


@query("short_hash", "SELECT doc_id, left(sha256(text), 16) AS hash FROM documents")
def short_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", T.short_hash(c("text")).alias("hash"))


@query(
    "truncate_text",
    "SELECT doc_id, CASE WHEN length(text) > 120 THEN left(text, 120) || '…' ELSE text END AS snippet FROM documents",
)
def truncate_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncate_text(c("text")).alias("snippet"))


@query(
    "coalesce_nonempty",
    """SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment WHEN c_nationkey > 12 THEN 'N' || CAST(c_nationkey AS VARCHAR) ELSE c_name END AS picked
    FROM customer""",
)
def coalesce_nonempty(spark, d):
    segment = F.when(c("c_mktsegment") == "BUILDING", "").otherwise(c("c_mktsegment"))
    nation = F.when(c("c_nationkey") > 12, F.concat(F.lit("N"), c("c_nationkey").cast("string")))
    return table(spark, d, "customer").select("c_custkey", T.first_nonempty(segment, nation, c("c_name")).alias("picked"))


@query(
    "contact_from_text",
    r"""WITH found AS (SELECT doc_id, regexp_extract(text, '(\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}') AS p,
    regexp_extract(text, '(?i)[a-z0-9_.+\-]+@[a-z0-9_\-]+\.[a-z]{2,}') AS e FROM documents)
SELECT doc_id, CASE WHEN p <> '' THEN sha256(p) END AS phone, CASE WHEN e <> '' THEN sha256(e) END AS email FROM found""",
)
def contact_from_text(spark, d):
    from adloom.functions.pagetext import contacts

    from adloom.sources.tables import spread

    found = contacts(c("text"))
    return spread(table(spark, d, "documents"), "doc_id").select("doc_id", found["phone"].alias("phone"), found["email"].alias("email"))
