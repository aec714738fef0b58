"""Ad records to nested documents and the flat search index.

`build_document` takes one row per ad with the struct columns of the record builders (missing ones count
as NULL) and works in a handful of projections without any shuffle; joins for geography come before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import aliases as A
from adloom.functions import normalize as N
from adloom.functions import vocab
from adloom.functions.text import first_nonempty, label_key, null_if_empty, slugify
from adloom.operators.geo import metro_precedence

c = F.col


@dataclass(frozen=True)
class Owner:
    """The account that documents are filed under."""

    uid: str | None = None
    display_name: str | None = None
    email: str | None = None
    phone: str | None = None
    is_verified: bool = False
    business: str | None = None
    role: str | None = None


_TEXTS = "array<string>"
_DETAILS = (
    "ad_id title ad_type property_category bedrooms bathrooms area_sqft available_from rent deposit accommodates room_type "
    "stay_type accommodation_type couples_allowed posted_by posted_on ad_id_on_site description"
).split()


def _record_schema() -> dict[str, T.StructType]:
    def texts(names) -> str:
        return ", ".join(f"{n}: string" for n in names)

    details = (
        f"struct<{texts(_DETAILS)}, amenities: {_TEXTS}, utilities: {_TEXTS}, photos: {_TEXTS}, "
        f"additional_info: struct<{texts(f for f, _ in vocab.ADDITIONAL_INFO)}>, "
        f"tenant_preferences: struct<{texts(f for f, _ in vocab.TENANT_PREFS)}>, "
        f"address: struct<nearby_neighborhoods: {_TEXTS}>>"
    )
    sections = {
        "property": A.PROPERTY, "description": A.DESCRIPTION, "availability": A.AVAILABILITY, "location": A.LOCATION,
        "preferences": A.PREFERENCES, "metadata": A.METADATA, "privacy": A.PRIVACY, "payment": A.PAYMENT,
    }
    return {n: f"struct<{texts(spec)}>" for n, spec in sections.items()} | {"details": details, "photos": _TEXTS}


def _conform(value: Column, have: T.DataType | None, want: T.DataType) -> Column:
    if have is None:
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType):
        present = {f.name: f.dataType for f in have.fields}
        fields = [_conform(value[f.name], present.get(f.name), f.dataType).alias(f.name) for f in want.fields]
        return F.struct(*fields)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType):
        return F.transform(value, lambda p: p["url"])
    return value if have == want else value.cast(want)


def conform_record(df: DataFrame) -> DataFrame:
    """Rows with every section and field the document needs; what is not there becomes NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    sections = {
        n: _conform(F.col(n), have.get(n), T._parse_datatype_string(ddl)) for n, ddl in _record_schema().items()
    }
    extra = {n: F.lit(None).cast("string") for n in ("stored_metro", "point_metro") if n not in have}
    return df.withColumns(sections | extra)


def _int(text: Column) -> Column:
    return N.parse_baths(text)


def effective_values(df: DataFrame) -> DataFrame:
    """Adds struct `eff`: per field the first of page JSON, printed details and free text."""
    p, d, a = "property", "details", "availability"
    raw_rent = c(f"{p}.rent_amount")
    plain = raw_rent.rlike(r"^\d+(\.\d+)?$")
    prose = first_nonempty(c("description.full_description"), c(f"{d}.description"))
    frequency = c(f"{p}.rent_frequency")
    step = df.withColumns(
        {
            "_json": F.when(~plain, N.parse_rent(raw_rent)),
            "_printed": N.parse_rent(c(f"{d}.rent")),
            "_prose": N.parse_rent(F.coalesce(N.rent_from_text(prose), N.rent_from_text(c(f"{p}.title")))),
            "_intent": N.intent(c(f"{d}.ad_type")),
            "_active": N.posted_date(c(f"{d}.posted_on")),
        }
    )
    mode = F.when(frequency.rlike("(?i)week|day|year|month"), N.rent_mode(frequency))
    metro = metro_precedence(c("stored_metro"), c("location.metro_area"), c("point_metro"), c("location.country_code"))
    available = first_nonempty(c(f"{a}.available_from"), c(f"{d}.available_from"))
    values = {
        "ad_id": first_nonempty(c("ad_id").cast("string"), c(f"{p}.ad_id"), c(f"{d}.ad_id_on_site"), c(f"{d}.ad_id")),
        "title": first_nonempty(c(f"{p}.title"), c(f"{d}.title")),
        "description": prose,
        "rent": F.coalesce(F.when(plain, raw_rent.try_cast(N.MONEY)), c("_json.amount"), c("_printed.amount"), c("_prose.amount")),
        "currency": F.coalesce(c("_json.currency"), null_if_empty(c(f"{p}.rent_currency")), c("_printed.currency"), c("_prose.currency"), F.lit("USD")),
        "mode": F.coalesce(c("_json.mode"), mode, c("_printed.mode"), c("_prose.mode"), F.lit("per_month")),
        "beds": F.coalesce(N.parse_beds(c(f"{p}.beds")), N.parse_beds(c(f"{d}.bedrooms"))),
        "baths": F.coalesce(_int(c(f"{p}.baths")), _int(c(f"{d}.bathrooms"))),
        "square_feet": F.coalesce(N.parse_area(c(f"{d}.area_sqft")), N.parse_area(c(f"{p}.square_feet"))),
        "property_type": F.coalesce(N.property_type(c(f"{d}.property_category")), N.property_type(c(f"{p}.property_type"))),
        "available_text": available,
        "available_from": N.posted_date(available),
        "active_date": F.coalesce(c("_active"), N.posted_date(c("metadata.active_date"))),
        "expiry_date": F.coalesce(N.add_one_year(c("_active")), N.posted_date(c("metadata.expiry_date"))),
        "intent": c("_intent"),
        "category": N.category(c("_intent")),
        "role": N.role(c("_intent")),
        "metro": metro,
    }
    eff = F.struct(*[v.alias(n) for n, v in values.items()])
    return step.withColumn("eff", eff).drop("_json", "_printed", "_prose", "_intent", "_active")


def _is_true(x: Column) -> Column:
    return F.coalesce(F.lower(x) == "true", F.lit(False))


def _not_false(x: Column) -> Column:
    return F.coalesce(F.lower(x) != "false", F.lit(True))


def _names(x: Column) -> Column:
    """A text field that may hold a JSON array, as an array of names."""
    parsed = F.when(x.startswith("["), F.from_json(x, _TEXTS))
    return F.coalesce(parsed, F.when(x.isNotNull(), F.array(x)), F.array().cast(_TEXTS))


def _languages(x: Column) -> Column:
    """Languages given as an array, an object of flags or a single name."""
    flags = F.map_entries(F.from_json(F.when(x.startswith("{"), x), "map<string,string>"))
    chosen = F.transform(
        F.filter(flags, lambda e: ~F.coalesce(F.lower(e["value"]), F.lit("")).isin("", "false", "0")), lambda e: e["key"]
    )
    return N.languages(F.coalesce(chosen, _names(x)))


def _location(e: str = "eff") -> dict[str, Column]:
    loc = "location"
    plain = "formatted_address city locality sub_locality district state state_code country country_code".split()
    return {
        "display": first_nonempty(c(f"{loc}.display_address"), c(f"{loc}.sub_locality"), c(f"{loc}.city")),
        "street": F.lit(None).cast("string"),
        **{f: c(f"{loc}.{f}") for f in plain},
        "metro_area": c(f"{e}.metro"),
        "zipcode": c(f"{loc}.zip_code"),
        "lat": c(f"{loc}.latitude").try_cast("double"),
        "lng": c(f"{loc}.longitude").try_cast("double"),
        "neighborhoods": N.neighborhoods(_names(c(f"{loc}.nearby_neighborhoods")), c("details.address.nearby_neighborhoods")),
        "show_on_map": _not_false(c("privacy.map_visibility")) & ~_is_true(c("privacy.hide_address")),
    }


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*[v.alias(n) for n, v in values.items()])


def build_document(df: DataFrame, owner: Owner = Owner()) -> DataFrame:
    """Adds the nested document `doc`. Offered ads carry property details and preferences, wanted ads room
    details and seeker; the other two are NULL."""
    ready = effective_values(conform_record(df))
    prefs, printed, info = "preferences", "details.tenant_preferences", "details.additional_info"
    gender = first_nonempty(c(f"{printed}.gender_preference"), c(f"{prefs}.preferred_gender"))
    occupation = first_nonempty(c(f"{printed}.occupation"), c(f"{prefs}.occupation"))
    languages = _languages(c(f"{prefs}.languages"))
    alcohol = F.coalesce(
        N.alcohol_flag(c(f"{printed}.alcohol")).cast("string"), null_if_empty(c(f"{prefs}.alcohol_allowed"))
    )
    couples = F.when(c("details.couples_allowed").rlike("(?i)^yes$"), F.lit("Yes")).otherwise(c(f"{prefs}.couples_welcome"))
    metadata = {
        "status": N.ad_status(c("metadata.status")),
        "adexpirystatus": N.expiry_status(c("metadata.expiry_status")),
        "adtimezone": first_nonempty(c("metadata.timezone"), F.lit(vocab.DEFAULT_TIMEZONE)),
        "admetroarea": null_if_empty(slugify(c("eff.metro"))),
        "adactivedate": c("eff.active_date"),
        "adexpirydate": c("eff.expiry_date"),
        "intent": c("eff.intent"),
        "category": c("eff.category"),
        "role": c("eff.role"),
    }
    user = {
        "uid": F.lit(owner.uid).cast("string"),
        "display_name": F.coalesce(null_if_empty(c("details.posted_by")), F.lit(owner.display_name).cast("string")),
        "email": F.lit(owner.email).cast("string"),
        "phone": F.lit(owner.phone).cast("string"),
        "is_verified": F.lit(owner.is_verified),
        "role": c("eff.role"),
        "business": F.lit(owner.business).cast("string"),
    }
    rent = {
        "amount": F.coalesce(c("eff.rent"), F.lit(0).cast(N.MONEY)),
        "currency": c("eff.currency"),
        "mode": c("eff.mode"),
        "is_negotiable": _is_true(c("property.negotiable")),
        "is_hidden": F.lit(False),
        "utilities_included": _is_true(c("property.utilities_included")),
        "deposit": F.coalesce(N.parse_rent(c("property.deposit"))["amount"], F.lit(0).cast(N.MONEY)),
    }
    availability = {
        "from": c("eff.available_from"),
        "from_text": c("eff.available_text"),
        "to": F.lit(vocab.FAR_FUTURE).cast("date"),
        "stay_type": N.stay_type(c("availability.stay_type"), c("details.stay_type")),
        "days_available": first_nonempty(c("availability.days_available"), F.lit(vocab.DEFAULT_DAYS)),
    }
    nothing = F.array().cast(_TEXTS)
    details = {
        "title": c("eff.title"),
        "description": c("eff.description"),
        "rent": _struct(rent),
        "availability": _struct(availability),
        "amenities": F.coalesce(N.amenity_slugs(c("details.amenities")), nothing),
        "utilities": F.coalesce(N.utility_slugs(c("details.utilities")), nothing),
        "furnishing": N.furnishing(c(f"{info}.furnishing")),
        "open_house": _struct({k: F.lit("") for k in ("date", "start_time", "end_time")}),
    }
    privacy = {
        "show_address_on_map": _not_false(c("privacy.map_visibility")),
        "hide_address_on_ad": _is_true(c("privacy.hide_address")),
        "hide_phone_on_ad": _is_true(c("privacy.hide_phone")),
        "hide_email_on_ad": _is_true(c("privacy.hide_email")),
        "on_whatsapp": _is_true(c("privacy.on_whatsapp")),
        "share_phone": ~_is_true(c("privacy.hide_phone")),
    }
    property_details = {
        "property_type": c("eff.property_type"),
        "accommodation_type": F.coalesce(c("property.accommodation_type"), F.lit("")),
        "square_feet": c("eff.square_feet"),
        "beds": c("eff.beds"),
        "baths": c("eff.baths"),
        "building_name": c("property.building_name"),
        "is_shared": F.lit(False),
    }
    preferences = {
        "occupation": N.slug_or_any(occupation, vocab.OCCUPATION),
        "smoking": N.slug_or_any(first_nonempty(c(f"{info}.smoking"), c(f"{prefs}.smoking")), vocab.SMOKING),
        "pets": N.slug_or_any(first_nonempty(c(f"{info}.pets"), c(f"{prefs}.pets")), vocab.PETS),
        "vegetarian": N.slug_or_any(first_nonempty(c(f"{info}.veg_non_veg"), c(f"{prefs}.vegetarian")), vocab.VEGETARIAN),
        "age_range": N.slug_or_any(first_nonempty(c(f"{printed}.age_range"), c(f"{prefs}.age_range")), vocab.AGE_RANGE),
        "preferred_gender": F.coalesce(
            N.match_option(c(f"{printed}.gender_preference"), vocab.GENDERS),
            N.match_option(c(f"{prefs}.preferred_gender"), vocab.GENDERS),
            F.lit("Any"),
        ),
        "couples_welcome": N.yes_no(couples),
        "alcohol_allowed": N.yes_no(alcohol),
        "languages": languages,
    }
    room = {
        "bath_type": F.lit(""),
        "bath_preference": F.lit(""),
        "gender_preference": N.gender_slug(gender),
        "accommodates": F.coalesce(c("details.accommodates"), F.lit("")),
        "accommodation_type": first_nonempty(c("property.accommodation_type"), c("details.accommodation_type")),
    }
    room["accommodation_type"] = F.coalesce(room["accommodation_type"], F.lit(""))
    seeker = {
        "age": F.lit(None).cast("int"),
        "gender": N.seeker_gender(gender),
        "occupation": N.seeker_occupation(occupation),
        "languages": languages,
    }
    offered, wanted = c("eff.intent") == "list", c("eff.intent") == "find"
    parts = ready.withColumns(
        {
            "_metadata": _struct(metadata),
            "_location": _struct(_location()),
            "_photos": N.photo_choice(c("photos"), c("details.photos")),
        }
    )
    doc = {
        "ad_id": c("eff.ad_id"),
        "metadata": c("_metadata"),
        "user": _struct(user),
        "location": c("_location"),
        "details": _struct(details),
        "privacy": _struct(privacy),
        "photos": c("_photos"),
        "search": _struct(_search(owner)),
        "property_details": F.when(offered, _struct(property_details)),
        "preferences": F.when(offered, _struct(preferences)),
        "room_details": F.when(wanted, _struct(room)),
        "seeker": F.when(wanted, _struct(seeker)),
    }
    keep = [n for n in df.columns if n not in _record_schema() and n not in ("stored_metro", "point_metro")]
    return parts.select(*keep, _struct(doc).alias("doc"))


def _lowered(x: Column) -> Column:
    return F.lower(F.coalesce(x, F.lit("")))


def _search(owner: Owner) -> dict[str, Column]:
    loc = "_location"
    return {
        "ad_id": c("eff.ad_id"),
        "userid": F.lit(owner.uid).cast("string"),
        "status": c("_metadata.status"),
        "adexpirystatus": c("_metadata.adexpirystatus"),
        "adactivedate": c("eff.active_date"),
        "adexpirydate": c("eff.expiry_date"),
        "title_lowercase": _lowered(c("eff.title")),
        **{f: _lowered(c(f"{loc}.{f}")) for f in ("city", "locality", "sub_locality", "district", "state")},
        "state_code": c(f"{loc}.state_code"),
        "country": _lowered(c(f"{loc}.country")),
        "country_code": c(f"{loc}.country_code"),
        "metro_area": _lowered(c("eff.metro")),
        "zipcode": c(f"{loc}.zipcode"),
        "rent": F.coalesce(c("eff.rent"), F.lit(0).cast(N.MONEY)),
        "currency": c("eff.currency"),
        "beds": F.coalesce(c("eff.beds"), F.lit(0)),
        "baths": F.coalesce(c("eff.baths"), F.lit(0)),
        "property_type": F.coalesce(c("eff.property_type"), F.when(c("eff.intent") == "find", F.lit("shared_room"))),
        "category": c("eff.category"),
        "intent": c("eff.intent"),
    }


def search_index(documents: DataFrame) -> DataFrame:
    """The flat index table of documents, one column per index field."""
    return documents.select("doc.search.*")


# ---- retired document shape -----------------------------------------------------------------


def legacy_amenity_map(bag: Column, labels: Column) -> Column:
    """Amenity map joined with the printed labels as true-valued keys; labels win."""
    from adloom.functions.jsonx import last_wins_map

    given = F.transform(F.map_entries(bag), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    keys = F.filter(F.transform(labels, label_key), lambda k: k != "")
    shown = F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit("true").alias("value")))
    none = F.array().cast("array<struct<key:string,value:string>>")
    return last_wins_map(F.concat(F.coalesce(given, none), F.coalesce(shown, none)))


def legacy_document(df: DataFrame, owner: Owner = Owner()) -> DataFrame:
    """Adds `doc` in the retired shape: location inside details, option labels instead of slugs, payment block.

    Facts hidden in amenity keys (`amenities`, a map) win over the other sources.
    """
    bag = c("amenities") if "amenities" in df.columns else F.create_map().cast("map<string,string>")
    base = conform_record(df.withColumn("_bag", bag))
    base = effective_values(base).withColumn("_all", legacy_amenity_map(c("_bag"), c("details.amenities")))
    on = F.map_filter("_all", lambda k, v: ~F.coalesce(F.lower(v), F.lit("")).isin("", "false", "0"))
    ready = base.withColumn("_keys", N.legacy_amenity_keys(F.map_keys(on)))
    prefs, printed, info = "preferences", "details.tenant_preferences", "details.additional_info"

    def option(name: str, *sources: str) -> Column:
        return F.coalesce(*[N.match_option(c(s), vocab.LEGACY_OPTIONS[name]) for s in sources])

    intent = F.coalesce(c("_keys.intent"), F.when(c("metadata.intent").isin("list", "find"), c("metadata.intent")), F.lit("list"))
    status = first_nonempty(c("metadata.status"), F.lit("active"))
    expired = first_nonempty(c("metadata.expiry_status"), F.lit("active"))
    category = first_nonempty(c("metadata.category"), F.lit("property"))
    beds = F.coalesce(c("eff.beds"), c("_keys.beds"))
    kind = F.coalesce(c("eff.property_type"), null_if_empty(c("property.property_type")))
    payment = {f: c(f"payment.{f}") for f in A.PAYMENT}
    nothing = F.array().cast(_TEXTS)
    details = {
        "amenities": F.coalesce(F.filter("details.amenities", lambda x: x != ""), nothing),
        "utilities": F.coalesce(F.filter("details.utilities", lambda x: x != ""), nothing),
        "available_from": F.coalesce(c("_keys.available_from"), c("eff.available_from")),
        "available_to": F.lit(vocab.FAR_FUTURE).cast("date"),
        "days_available": c("availability.days_available"),
        "title": c("eff.title"),
        "description": c("eff.description"),
        "rent": _struct(
            {
                "amount": c("eff.rent"), "currency": c("eff.currency"), "mode": c("eff.mode"),
                "deposit": F.coalesce(N.parse_rent(c("property.deposit"))["amount"], F.lit(0).cast(N.MONEY)),
                "is_hidden": F.lit(False), "is_negotiable": _is_true(c("property.negotiable")),
                "title": c("property.title"), "utilities_included": _is_true(c("property.utilities_included")),
            }
        ),
        "location": _struct(_location()),
    }
    preferences = {
        "age_range": option("age_range", f"{printed}.age_range", f"{prefs}.age_range"),
        "alcohol_allowed": F.coalesce(N.alcohol_flag(c(f"{printed}.alcohol")), c(f"{prefs}.alcohol_allowed").try_cast("boolean")),
        "couples_welcome": F.when(c("details.couples_allowed").rlike("(?i)^yes$"), F.lit("true")).otherwise(c(f"{prefs}.couples_welcome")),
        "languages": _languages(c(f"{prefs}.languages")),
        "occupation": option("occupation", f"{printed}.occupation", f"{prefs}.occupation"),
        "pets": option("pets", f"{info}.pets", f"{prefs}.pets"),
        "preferred_gender": option("gender", f"{printed}.gender_preference", f"{prefs}.preferred_gender"),
        "smoking": option("smoking", f"{info}.smoking", f"{prefs}.smoking"),
        "vegetarian": option("vegetarian", f"{info}.veg_non_veg", f"{prefs}.vegetarian"),
    }
    doc = {
        "ad_id": c("eff.ad_id"),
        "details": _struct(details),
        "metadata": _struct(
            {
                "adactivedate": c("eff.active_date"), "adexpirydate": c("eff.expiry_date"), "adexpirystatus": expired,
                "adtimezone": first_nonempty(c("metadata.timezone"), F.lit(vocab.DEFAULT_TIMEZONE)), "category": category,
                "intent": intent, "order_id": payment["order_id"], "payment_id": payment["payment_id"],
                "role": F.lit(owner.role).cast("string"), "status": status,
            }
        ),
        "payment": _struct({"currency": F.lit("USD"), **payment}),
        "photos": N.photo_choice(c("photos"), c("details.photos")),
        "preferences": _struct(preferences),
        "property_details": _struct(
            {
                "accommodation_type": F.coalesce(c("property.accommodation_type"), F.lit("")), "baths": c("eff.baths"), "beds": beds,
                "building_name": c("property.building_name"), "is_shared": F.lit(False), "property_type": kind,
                "square_feet": F.coalesce(c("_keys.square_feet"), c("eff.square_feet")),
            }
        ),
        "response_count": F.lit(0),
        "user_name": F.coalesce(null_if_empty(c("details.posted_by")), F.lit(owner.display_name).cast("string")),
    }
    keep = [n for n in df.columns if n not in _record_schema() and n not in ("stored_metro", "point_metro", "amenities")]
    return ready.select(*keep, _struct(doc).alias("doc"))
