"""Detail pages and their captured API bodies to ad records.

One shuffle brings the bodies of a page to the page; everything from there to the record is a projection inside the page's row. The JSON
sources are never merged: a field is looked up in them by rank (`functions/overlay.py`).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import aliases as A
from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions import overlay as O
from adloom.functions import pagetext as P
from adloom.functions import vocab
from adloom.functions.text import first_where, let, null_if_empty, text_array
from adloom.functions.urls import SiteProfile
from adloom.operators import geo as G
from adloom.operators import records as R
from adloom.session import settled
from adloom.sources.tables import capture_filter, dealt

BODIES = "array<struct<arrival:bigint,body:string>>"


class Layered(R.Merged):
    """Reads record fields from columns that hold layers (`with_layered_ad`)."""

    def first_text(self, aliases) -> Column:
        holders, _ = _asked()
        asked = [a.rsplit(".", 1) for a in aliases]
        # one parsed expression instead of a call per alias
        return F.expr("coalesce(" + ", ".join(f"try_element_at(texts[{holders.index(h)}], '{name}')" for h, name in asked) + ")")

    def json(self, root: str) -> Column:
        return O.merged_json(F.col(root))

    def has_object(self, root: str) -> Column:
        return F.size(F.col(root)) > 0

    def photos(self) -> Column:
        lists = F.transform(text_array(vocab.PHOTO_LIST_KEYS), lambda k: F.try_variant_get(O.first(F.col("ad_members"), k), "$", "array<variant>"))
        return J.photos_of(first_where(lists, lambda a: F.size(a) > 0))

    def amenities(self, labels: Column | None) -> Column:
        def entry(m: Column) -> Column:
            plain = F.when(~J.is_object(m["value"]), F.try_variant_get(m["value"], "$", "string"))
            return F.struct(m["key"].alias("key"), F.coalesce(plain, F.nullif(m["json"], F.lit("null"))).alias("value"))

        def of(k: Column) -> Column:
            as_list = F.try_variant_get(O.first(F.col("ad_members"), k), "$", "array<variant>")
            members = let(O.objects(F.col("ad_members"), k), lambda objs: F.when(F.size(objs) > 0, F.transform(O.members(objs), entry)))
            return J.amenity_entries(as_list, members)

        return J.amenities_of(F.flatten(F.transform(text_array(vocab.AMENITY_LIST_KEYS), of)), labels)


LAYERED = Layered()


@cache
def _asked() -> tuple[list[str], list[str]]:
    """What the alias lists ask: objects (`ad`, `loc`, `raw.query`, …), and names of their members."""
    specs = (A.PROPERTY, A.DESCRIPTION, A.AVAILABILITY, A.LOCATION, A.PREFERENCES, A.METADATA, A.POSTER, A.PAYMENT, A.PRIVACY, {"": A.AD_ID})
    parts = [a.rsplit(".", 1) for spec in specs for aliases in spec.values() for a in aliases]
    return list(dict.fromkeys(h for h, _ in parts)), sorted({name for _, name in parts})


def bodies_per_page(payloads: DataFrame) -> DataFrame:
    """`page_id, bodies`: the accepted bodies of a page, one per URL, by arrival.

    They all go into the page's one record, and there is one per endpoint that the page has called; a page called up again adds none.
    """
    kept = capture_filter(payloads)
    return kept.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(F.col("arrival").cast("bigint").alias("arrival"), "body"))).alias("bodies"))


def page_layers(html: Column, bodies: Column, linked: Column | None = None) -> Column:
    """All JSON of a page and its API bodies as layers, the weakest source last (see `vocab.SOURCE_ORDER`); within a source later ones win. `linked`
    is the page's `json_ld`, where that is at hand."""
    api = F.transform(F.coalesce(bodies, F.array().cast(BODIES)), lambda b: J.json_safe_parse(b["body"]))
    by_source = {
        "ld": J.json_ld(html) if linked is None else linked, "embedded": J.json_embedded(html), "firebase": F.array(J.json_window_var(html, "__FIREBASE_DATA__")),
        "api": api, "initial_state": F.array(J.json_window_var(html, "__INITIAL_STATE__")), "next_data": F.array(J.json_next_data(html)),
    }
    return O.layers(F.reverse(F.concat(*[by_source[s] for s in vocab.SOURCE_ORDER])))


def with_layered_ad(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds `ad_path`, `ad` and the nested objects `loc, prefs, user, pay, priv`, all as layers, to rows with layers `raw`, and as `texts` per
    object that the aliases name (in the order of `_asked`) the texts, but for empty ones, of the members that records ask for."""
    props = "props.pageProps"
    step = df.withColumns({"_props": O.below(F.col(raw), props)}).withColumns({"_in_props": O.by_key(F.col("_props")), "_in_raw": O.by_key(F.col(raw))})

    def holders(members: Column, keys, prefix: str) -> Column:
        def holder(k: Column) -> Column:
            return F.when(J.is_container(O.first(members, k)), F.struct(F.concat(F.lit(prefix), k).alias("path"), O.objects(members, k).alias("objs")))

        return F.transform(text_array(keys), holder)

    def says_something(k: Column) -> Column:
        v = O.first(F.col("_in_props"), k)
        return F.coalesce(J.is_container(v) | ~F.try_variant_get(v, "$", "string").isin("", "0", "false"), F.lit(False))

    named = F.exists(text_array(["adId", "id", "uid"]), says_something)
    itself = F.array(F.when(named, F.struct(F.lit(f"$.{props}").alias("path"), F.col("_props").alias("objs"))))
    whole = F.array(F.struct(F.lit("$").alias("path"), F.col(raw).alias("objs")))
    found = F.concat(holders(F.col("_in_props"), vocab.PAGE_AD_KEYS, f"$.{props}."), itself, holders(F.col("_in_raw"), vocab.FLAT_AD_KEYS, "$."), whole)
    step = step.withColumn("_ad", first_where(found, lambda x: x.isNotNull()))
    step = step.withColumns({"ad_path": F.col("_ad.path"), "ad": F.col("_ad.objs")}).drop("_props", "_in_props", "_in_raw", "_ad")
    step = step.withColumn("ad_members", O.by_key(F.col("ad")))

    def nested(keys) -> Column:
        # the first member that says anything is the one; if it is no object, there are no layers
        def said(k: Column) -> Column:
            v = O.first(F.col("ad_members"), k)
            return F.when(~F.is_variant_null(v) & (F.to_json(v) != '""'), O.objects(F.col("ad_members"), k))

        return F.coalesce(first_where(F.transform(text_array(keys), said), lambda x: x.isNotNull()), F.array().cast(O.NO_LAYERS))

    step = step.withColumns({root: nested(keys) for root, keys in A.ROOTS.items()})
    holders, names = _asked()
    objs = [F.col(raw if h == "raw" else h) if "." not in h else O.below(F.col(raw if h.startswith("raw.") else h.split(".")[0]), h.split(".", 1)[1]) for h in holders]
    return step.withColumn("texts", F.transform(F.array(*objs), lambda o: O.texts(O.by_key(o), names, filled=True)))


def unknown_fields(known: list[str], ad: str = "ad") -> Column:
    """Top-level members of the ad object that are not in `known`, as key to JSON text."""
    other = F.filter(O.members(F.col(ad)), lambda m: ~m["key"].isin(known))
    return F.map_from_entries(F.transform(other, lambda m: F.struct(m["key"], m["json"])))


@dataclass(frozen=True)
class GeoTables:
    """What locations are enriched from. `zips` the gazetteer; `providers` geocodes `(zip, country_code, geo)` for codes it does not know,
    in order of preference; `localities` `(lat, lng, locality)`; `zip_metros` `(zip, msa)`. Any may be missing."""

    zips: DataFrame | None = None
    providers: tuple[DataFrame, ...] = ()
    localities: DataFrame | None = None
    zip_metros: DataFrame | None = None


def enrich_location(ads: DataFrame, geo: GeoTables, location: str = "location") -> DataFrame:
    """`ads` with everything its `location` struct lacks and its ZIP code tells.

    Geocode: the gazetteer for US codes, else the first provider that knows the code. Only missing fields are filled. A missing locality
    comes from the table of places by coordinates, else it is the city. A missing metro area of a US ad comes from the ZIP code. Ads without a ZIP
    code or without any geocode keep their location as it is. All tables are dimensions by ZIP code or by coordinates; rows without the key
    stay out of the joins, where they would be one hot key.
    """
    loc, fields = F.col(location), [f.name for f in ads.schema[location].dataType.fields]
    known = lambda f: null_if_empty(loc[f].cast("string"))
    sources = ([G.zip_geocodes(geo.zips).withColumn("country_code", F.lit("US"))] if geo.zips is not None else []) + list(geo.providers)
    keyed = ads.withColumns({"zip": F.when(known("zip_code") != "not_found", known("zip_code")), "country_code": F.coalesce(known("country_code"), F.lit("US"))})
    if not sources:
        return ads
    found = G.geo_fallback_chain(keyed, [s.select("zip", "country_code", "geo") for s in sources]).drop("geo_rank")
    g = F.col("geo")
    filled = {f: null_if_empty(loc[f].cast("string")) for f in fields}
    names = {"lat": "latitude", "lng": "longitude"}
    for f in G.GEO_FIELDS:
        filled[names.get(f, f)] = F.coalesce(known(names.get(f, f)), null_if_empty(g[f].cast("string")))
    found = found.withColumn("_filled", F.struct(*[filled[f].alias(f) for f in fields]))
    if geo.localities is not None:
        found = _with_locality(found, geo.localities)
    else:
        found = found.withColumn("_near", F.lit(None).cast("string"))
    town = F.coalesce(F.col("_filled.locality"), F.col("_near"), F.col("_filled.city"), null_if_empty(g["city"]))
    found = found.withColumn("_filled", F.col("_filled").withField("locality", town))
    if geo.zip_metros is not None:
        found = _with_metro(found, geo.zip_metros)
    types = {f.name: f.dataType for f in ads.schema[location].dataType.fields}
    done = F.struct(*[F.col(f"_filled.{f}").cast(types[f]).alias(f) for f in fields])
    return found.withColumn(location, F.when(g.isNotNull(), done).otherwise(loc)).select(*ads.columns)


def _with_locality(found: DataFrame, localities: DataFrame) -> DataFrame:
    point = [F.col(f"_filled.{f}").try_cast("double") for f in ("latitude", "longitude")]
    asks = F.col("_filled.locality").isNull()
    placed = found.withColumns({"_lat": F.when(asks, point[0]), "_lng": F.when(asks, point[1])})
    names = localities.where(F.col("locality") != "").groupBy(F.col("lat").cast("double").alias("_lat"), F.col("lng").cast("double").alias("_lng")).agg(F.min("locality").alias("_near"))
    return G.look_up(placed, names, ["_lat", "_lng"]).drop("_lat", "_lng")


def _with_metro(found: DataFrame, zip_metros: DataFrame) -> DataFrame:
    us = F.upper(F.coalesce(F.col("geo.country_code"), F.col("country_code"))) == "US"
    lacks = F.coalesce(F.col("_filled.metro_area"), F.lit("not_found")) == "not_found"
    asked = found.withColumn("_code", F.when(us & lacks & F.col("geo").isNotNull(), F.col("_filled.zip_code")))
    metros = zip_metros.groupBy(F.col("zip").alias("_code")).agg(F.min("msa").alias("_msa"))
    met = G.look_up(asked, metros, ["_code"])
    return met.withColumn("_filled", F.col("_filled").withField("metro_area", F.coalesce("_msa", "_filled.metro_area"))).drop("_code", "_msa")


def page_into_record(records: DataFrame) -> DataFrame:
    """Records with what the rendered page adds: the description if it reads better there, the poster, photos of its gallery and of its
    linked data. Needs `tokens, page_text, ld_photos`, which it drops."""
    tokens = F.col("tokens")
    outline = F.col("outline") if "outline" in records.columns else None
    overview = P.strip_quick_facts(H.overview_pick(tokens, H.OVERVIEW_LIVE, 20, below_heading=False, outline=outline))
    posted = H.posted_by_cascade(tokens, F.col("page_text"), outline)
    shots = F.col("images") if "images" in records.columns else None
    shown = F.array_distinct(F.concat(H.photos_from_html(tokens, outline, shots), F.col("ld_photos")))
    own = F.col("photos")

    def added(urls: Column) -> Column:
        have = F.filter(F.transform(own, lambda p: p["url"]), lambda u: u.isNotNull())
        new = F.filter(urls, lambda u: ~F.array_contains(have, u))
        return F.transform(new, lambda u, i: F.struct((F.size(own) + i).cast("int").alias("index"), u.alias("url"), F.lit(None).cast("string").alias("alt")))

    step = records.withColumns({"_overview": overview, "_posted": posted, "_shown": shown})
    full = P.overview_merge(F.col("description.full_description"), F.col("_overview"))
    step = step.withColumns(
        {
            "description": F.col("description").withField("full_description", full),
            "photos": F.concat(own, added(F.col("_shown"))),
            "poster": F.struct(null_if_empty(F.col("_posted")).alias("display_name")),
        }
    )
    return step.drop("tokens", "outline", "images", "page_text", "ld_photos", "_overview", "_posted", "_shown")


def detail_records(joined: DataFrame, site: SiteProfile, geo: GeoTables | None = None, details: bool = True, mask: bool = True) -> DataFrame:
    """Rows `page_id, url, html, scraped_at, bodies` to ad records; see `extract_detail_pages`."""
    html = F.col("html")
    # what several readers of the markup ask for is found once
    read = settled(joined.select("page_id", "url", "scraped_at", "html", "bodies", H.visible_html(html).alias("visible"), J.json_ld(html).alias("ld")))
    visible, ld = F.col("visible"), F.col("ld")
    rows = read.select(
        "page_id", "url", "scraped_at", page_layers(html, F.col("bodies"), ld).alias("raw"), H.outlined_tokens(html, visible).alias("page"),
        H.page_text(html, visible).alias("page_text"), J.photos_from_ld(ld).alias("ld_photos"),
    ).select("page_id", "url", "scraped_at", "raw", "page.tokens", "page.outline", "page.images", "page_text", "ld_photos")
    records = settled(R.rec_ad(settled(with_layered_ad(settled(rows))), site, read=LAYERED))
    if details:
        read = R.rec_scraped_details(records.withColumn("url", F.col("source_url")), site, mask=mask)
        records = settled(read.drop("url"))
    merged = settled(page_into_record(records))
    return enrich_location(merged, geo) if geo else merged


def extract_detail_pages(
    pages: DataFrame, payloads: DataFrame, site: SiteProfile, geo: GeoTables | None = None, scraped_at: Column | None = None, details: bool = True, mask: bool = True
) -> DataFrame:
    """One ad record per row of `pages` (`page_id, url, html`) with the API bodies captured on it (`page_id, url, content_type, arrival, body`).

    The record has the eight sections, the poster, `details` (what the printed page says; left out on request) and a location enriched
    from the tables in `geo`. JSON sources win in the order page state, other state, API bodies by arrival, embedded, linked data; a
    field that JSON lacks comes from the page. Pages without bodies, without JSON or without HTML give records of what there is.
    """
    when = F.current_timestamp() if scraped_at is None else scraped_at
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), when.alias("scraped_at"))
    # a page is short but costs milliseconds: by their bytes, the joined pages would end up in a few tasks
    joined = dealt(base.join(bodies_per_page(payloads), "page_id", "left"))
    return detail_records(joined, site, geo, details, mask)
