"""Ad records out of page JSON and page tokens: alias-driven projections, no shuffles.

Input rows carry `url`, `raw` (VARIANT, the merged JSON of a page) and, where a page is at hand,
`tokens` (with their `outline` and `images`, which spare readers a pass), `page_text` and `html`. `with_ad_node` adds the ad object and its nested objects once; every
section is then a struct of path lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import aliases as A
from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions import pagetext as P
from adloom.functions import vocab
from adloom.functions.address import with_parsed_address
from adloom.functions.text import first_where, let
from adloom.functions.urls import SiteProfile, ad_id_from_url


def with_ad_node(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds `ad_path`, `ad` and the nested objects `loc, prefs, user, pay, priv` as VARIANT columns."""
    r = F.col(raw)
    located = df.withColumn("ad_path", J.ad_node_path(r))
    node = located.withColumn("ad", J.at_path(r, F.col("ad_path")))

    def nested(keys) -> Column:
        members = [F.try_variant_get("ad", f"$.{k}", "variant") for k in keys]
        return F.coalesce(*[F.when(~F.is_variant_null(m) & (F.to_json(m) != '""'), m) for m in members])

    return node.withColumns({root: nested(keys) for root, keys in A.ROOTS.items()})


class Merged:
    """Reads record fields from VARIANT columns that hold one merged document (`with_ad_node`)."""

    def first_text(self, aliases) -> Column:
        """First non-empty value among aliases `<root>.<path>`, as text."""
        found = [F.try_variant_get(F.col(a.split(".", 1)[0]), "$." + a.split(".", 1)[1], "string") for a in aliases]
        return first_where(F.array(*found), lambda v: v != "")

    def json(self, root: str) -> Column:
        return F.to_json(root)

    def has_object(self, root: str) -> Column:
        return J.is_object(F.col(root))

    def photos(self) -> Column:
        return J.photos_from_json(F.col("ad"))

    def amenities(self, labels: Column | None) -> Column:
        return J.amenity_bag(F.col("ad"), labels)


MERGED = Merged()


def _value(aliases, default: str | None = None, read: Merged = MERGED) -> Column:
    found = read.first_text(aliases)
    return found if default is None else F.coalesce(found, F.lit(default))


def resolve_aliases(spec, read: Merged = MERGED, **overrides: Column) -> Column:
    """Struct with every field of `spec` as text; `overrides` replace single fields."""
    return F.struct(*[overrides[f].alias(f) if f in overrides else _value(a, A.DEFAULTS.get(f), read).alias(f) for f, a in spec.items()])


def rec_property(title_fallback: Column | None = None, read: Merged = MERGED) -> Column:
    title = _value(A.PROPERTY["title"], read=read)
    return resolve_aliases(A.PROPERTY, read, title=title if title_fallback is None else F.coalesce(title, title_fallback))


def rec_description(text_fallback: Column | None = None, read: Merged = MERGED) -> Column:
    full = _value(A.DESCRIPTION["full_description"], read=read)
    full = full if text_fallback is None else F.coalesce(full, text_fallback)
    return resolve_aliases(A.DESCRIPTION, read, full_description=P.strip_quick_facts(full))


def rec_availability(read: Merged = MERGED) -> Column:
    return resolve_aliases(A.AVAILABILITY, read)


def with_location(df: DataFrame, out: str = "location", address_fallback: Column | None = None, read: Merged = MERGED) -> DataFrame:
    """Adds the location struct; fields missing in JSON come from the parsed address text."""
    stage = df.withColumn("_loc", resolve_aliases(A.LOCATION, read))
    full = F.col("_loc.full_address")
    full = full if address_fallback is None else F.coalesce(full, address_fallback)
    stage = with_parsed_address(stage.withColumn("_full", full), "_full", "_parsed")
    from_text = {
        "city": "city", "country": "country", "country_code": "country_code", "district": "county",
        "zip_code": "zip_code", "state": "state", "state_code": "state_code", "formatted_address": "formatted_address",
    }
    fields = []
    for f in A.LOCATION:
        value = F.col("_full") if f == "full_address" else F.col(f"_loc.{f}")
        if f in from_text:
            value = F.coalesce(value, F.col(f"_parsed.{from_text[f]}"))
        fields.append(value.alias(f))
    raw_location = (read.json("loc") if "loc" in df.columns else F.lit(None).cast("string")).alias("raw_location")
    return stage.withColumn(out, F.struct(*fields, raw_location)).drop("_loc", "_full", "_parsed")


def rec_preferences(read: Merged = MERGED) -> Column:
    raw = F.when(read.has_object("prefs"), read.json("prefs")).alias("raw_preferences")
    return F.struct(resolve_aliases(A.PREFERENCES, read).alias("p"), raw).withField("p.raw_preferences", raw)["p"]


def rec_metadata(tokens: Column | None = None, read: Merged = MERGED, outline: Column | None = None) -> Column:
    def meta(selector: tuple[str, str], attribute: str) -> Column:
        return F.lit(None).cast("string") if tokens is None else H.select_attr(tokens, [selector], attribute, outline)

    fields = [_value(a, A.DEFAULTS.get(f), read).alias(f) for f, a in A.METADATA.items()]
    return F.struct(
        *fields,
        F.col("url").alias("page_url"),
        meta(("attr:property", "og:title"), "content").alias("og_title"),
        meta(("attr:property", "og:description"), "content").alias("og_description"),
        meta(("attr:property", "og:image"), "content").alias("og_image"),
        meta(("attr:rel", "canonical"), "href").alias("canonical_url"),
    )


def rec_poster(mask: bool = True, read: Merged = MERGED) -> Column:
    """Poster fields; e-mail and phone are SHA-256 digests unless `mask` is off."""
    hidden = {f: F.sha2(_value(A.POSTER[f], read=read), 256) for f in A.MASKED} if mask else {}
    return resolve_aliases(A.POSTER, read, **hidden)


def rec_payment(read: Merged = MERGED) -> Column:
    return resolve_aliases(A.PAYMENT, read)


def rec_privacy(read: Merged = MERGED) -> Column:
    return resolve_aliases(A.PRIVACY, read)


def rec_ad_id(site: SiteProfile, read: Merged = MERGED) -> Column:
    return F.coalesce(_value(A.AD_ID, read=read), ad_id_from_url(F.col("url"), site))


def rec_unknown_fields(known: list[str], ad: str = "ad") -> Column:
    """Top-level members of the ad object that are not in `known`, as key to JSON text."""
    members = F.try_variant_get(ad, "$", "map<string,variant>")
    entries = F.filter(F.map_entries(members), lambda e: ~e["key"].isin(known))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], F.to_json(e["value"]))))


TITLES = [("tag", "h1"), ("class", "ad-title"), ("class", "listing-title"), ("class*", "title")]
PROSE = [("class", "ad-description"), ("class", "description"), ("class*", "description"), ("attr:itemprop", "description")]
ADDRESSES = [("attr:itemprop", "address"), ("class", "address"), ("class*", "address")]


def rec_photos(tokens: Column | None = None, read: Merged = MERGED, outline: Column | None = None, shots: Column | None = None) -> Column:
    """Photos of the ad object's first photo list, else of the page source's first gallery."""
    photos = read.photos()
    return photos if tokens is None else let(photos, lambda own: F.when(F.size(own) > 0, own).otherwise(H.photos_static(tokens, outline, shots)))


def rec_amenities(tokens: Column | None = None, read: Merged = MERGED, outline: Column | None = None) -> Column:
    """Amenities of the ad object; without any, the labels that the page styles as such."""
    return read.amenities(None if tokens is None else H.amenity_labels(tokens, outline))


def rec_ad(df: DataFrame, site: SiteProfile, scraped_at: str = "scraped_at", read: Merged = MERGED) -> DataFrame:
    """The ad record: eight sections plus id, source URL and scrape time. Whatever else `df` has in the way of page columns stays."""
    tokens = F.col("tokens") if "tokens" in df.columns else None
    outline = F.col("outline") if "outline" in df.columns else None
    shown = lambda selectors: None if tokens is None else H.select_text(tokens, selectors, outline=outline)
    located = with_location(df, address_fallback=shown(ADDRESSES), read=read)
    keep = [c for c in ("page_id", "html", "tokens", "outline", "images", "page_text", "ld_photos") if c in df.columns]
    shots = F.col("images") if "images" in df.columns else None
    return located.select(
        *keep,
        rec_ad_id(site, read).alias("ad_id"),
        F.col("url").alias("source_url"),
        F.col(scraped_at).alias("scraped_at"),
        rec_property(shown(TITLES), read).alias("property"),
        rec_description(shown(PROSE), read).alias("description"),
        rec_availability(read).alias("availability"),
        "location",
        rec_photos(tokens, read, outline, shots).alias("photos"),
        rec_amenities(tokens, read, outline).alias("amenities"),
        rec_preferences(read).alias("preferences"),
        rec_metadata(tokens, read, outline).alias("metadata"),
        rec_privacy(read).alias("privacy"),
    )


# fields of the details record that come from the quick-facts block or else from the label grid
_FACT_FIELDS = [
    "bedrooms", "bathrooms", "available_from", "rent", "accommodates", "room_type", "stay_type", "accommodation_type",
    "couples_allowed",
]


def rec_scraped_details(df: DataFrame, site: SiteProfile, scraped_at: str = "scraped_at", mask: bool = True) -> DataFrame:
    """Adds `details`, the record read from the printed page: NULL and [] where the page says nothing.

    Needs `url, tokens, page_text`; takes `outline` and `images` where they are there. Intermediate structs are columns of their own, so nothing is scanned twice.
    """
    tokens, text = F.col("tokens"), F.col("page_text")
    outline = F.col("outline") if "outline" in df.columns else None
    shots = F.col("images") if "images" in df.columns else None
    section = lambda heading: H.section_items(tokens, heading, F.col("_headings"))
    step = df.withColumn("_headings", H.section_headings(tokens, outline)).withColumns(
        {
            "_grid": H.grid_fields(H.label_value_grid(tokens, outline)),
            "_overview": H.overview_pick(tokens, outline=outline),
            "_posted": P.posted_line(text),
            "_near": H.address_near_h1(tokens, outline),
            "_info": section(r"^additional\s+info"),
            "_prefs": section(r"^tenant\s+pref"),
            "_photos": H.photos_of_details(tokens, site.photo_path, outline, shots),
            "_contact": P.contacts(text, mask),
            "_hoods": P.neighborhood_names(text, H.neighborhood_links(tokens, outline)),
        }
    ).withColumn("_facts", P.quick_facts(F.col("_overview")))
    step = with_parsed_address(step.withColumn("_full", F.col("_near.full_address")), "_full", "_parsed")

    def fact(name: str) -> Column:
        return F.coalesce(F.col(f"_facts.{name}"), P.sane_or_null(F.col(f"_grid.{name}")))

    from adloom.functions.normalize import classify_items

    site_id = ad_id_from_url(F.col("url"), site)
    near = {f: F.coalesce(F.col(f"_near.{f}"), F.col(f"_parsed.{p}")) for f, p in
            (("city", "city"), ("state", "state"), ("zipcode", "zip_code"), ("county", "county"))}
    details = F.struct(
        site_id.alias("ad_id"),
        F.col("url").alias("source_url"),
        H.select_text(tokens, [("tag", "h1"), ("class*", "ad-title"), ("class*", "listing-title")], outline=outline).alias("title"),
        F.col("_grid.ad_type").alias("ad_type"),
        F.col("_grid.property_category").alias("property_category"),
        *[fact(f).alias(f) for f in _FACT_FIELDS],
        P.clean_area(fact("area_sqft")).alias("area_sqft"),
        P.clean_deposit(fact("deposit")).alias("deposit"),
        F.lit("USD").alias("rent_currency"),
        F.coalesce(F.col("_grid.posted_by"), F.col("_posted.posted_by")).alias("posted_by"),
        F.col("_posted.posted_on").alias("posted_on"),
        F.coalesce(F.col("_posted.ad_id"), site_id).alias("ad_id_on_site"),
        P.strip_quick_facts(F.col("_overview")).alias("description"),
        F.struct(
            F.col("_full").alias("full_address"),
            *[v.alias(f) for f, v in near.items()],
            F.col("_near.nearby_university").alias("nearby_university"),
            F.col("_hoods").alias("nearby_neighborhoods"),
        ).alias("address"),
        section("^amenities$").alias("amenities"),
        section("^utilities$").alias("utilities"),
        classify_items(F.col("_info"), vocab.ADDITIONAL_INFO).alias("additional_info"),
        classify_items(F.col("_prefs"), vocab.TENANT_PREFS).alias("tenant_preferences"),
        P.verified_credentials(section(r"^verified\s+credential"), text).alias("verified_credentials"),
        F.col("_photos").alias("photos"),
        F.size("_photos").alias("photo_count"),
        F.col("_contact").alias("contact_info"),
        F.col(scraped_at).alias("scraped_at"),
    )
    return step.withColumn("details", details).select(*df.columns, "details")


# ---- export forms ---------------------------------------------------------------------------


def normalize_missing(df: DataFrame, columns: list[str] | None = None, marker: str = "not_found") -> DataFrame:
    """Every missing or blank leaf becomes the marker; leaves are text in this export form."""

    def fix(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.StructType):
            return F.struct(*[fix(c[f.name], f.dataType).alias(f.name) for f in t.fields])
        if isinstance(t, T.ArrayType):
            return F.coalesce(F.transform(c, lambda x: fix(x, t.elementType)), F.array().cast(_text_type(t)))
        if isinstance(t, T.MapType):
            return F.transform_values(c, lambda _, v: fix(v, t.valueType))
        text = c.cast("string")
        return F.when(text.rlike(r"\S"), text).otherwise(marker)

    wanted = columns or df.columns
    return df.select(
        *[fix(F.col(f.name), f.dataType).alias(f.name) if f.name in wanted else F.col(f.name) for f in df.schema.fields]
    )


def _text_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _text_type(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_text_type(t.elementType))
    return T.StringType()


def flatten_keys(df: DataFrame) -> DataFrame:
    """Nested structs as flat columns with dotted names; arrays and maps stay leaves."""

    def leaves(prefix: str, c: Column, t: T.DataType):
        if isinstance(t, T.StructType):
            for f in t.fields:
                yield from leaves(f"{prefix}.{f.name}", c[f.name], f.dataType)
        else:
            yield c.alias(prefix)

    return df.select(*[col for f in df.schema.fields for col in leaves(f.name, F.col(f"`{f.name}`"), f.dataType)])
