"""Location enrichment: keyed lookups, nearest place, point in polygon, ZIP to metro.

Whether a dimension is broadcast is left to Spark, which measures it as it is made, and splits a ZIP code that holds a large share
of the ads. Spatial joins work on distinct coordinates, so a spot with very many ads is looked up once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.text import first_nonempty, grab, let, null_if_empty, strip_ws

EARTH_KM = 6371.0088
GEO_FIELDS = [
    "lat", "lng", "city", "locality", "sub_locality", "district", "state", "state_code", "country", "country_code",
    "zip_code", "formatted_address",
]


# ---- keyed lookups --------------------------------------------------------------------------


def look_up(df: DataFrame, found: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """`df` joined with a table of unique keys. Rows without a key match nothing; they are dealt out by the task they come from, as
    under one key they would all meet in one task. `df` is read once."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    salted = df.withColumn("_salt", F.when(known, 0).otherwise(1 + F.spark_partition_id()))
    return salted.join(found.withColumn("_salt", F.lit(0)), [*keys, "_salt"], how).drop("_salt")


def zip_geocodes(zip_dim: DataFrame, states: Column | None = None) -> DataFrame:
    """The gazetteer as geocodes `(zip, geo)`."""
    from adloom.functions.address import state_name

    code, city = F.col("state_code"), null_if_empty(F.col("city"))
    nothing = F.lit(None).cast("string")
    values = {
        "lat": F.col("lat"),
        "lng": F.col("lng"),
        "city": city,
        "locality": nothing,
        "sub_locality": nothing,
        "district": F.concat(F.col("county"), F.lit(" County")),
        "state": state_name(code) if states is None else states,
        "state_code": code,
        "country": F.lit("United States"),
        "country_code": F.lit("US"),
        "zip_code": F.col("zip"),
        "formatted_address": F.when(
            city.isNotNull() & code.isNotNull(), F.concat_ws(", ", city, code, F.col("zip"), F.lit("United States"))
        ),
    }
    usable = zip_dim.where(F.col("lat").isNotNull() & (F.col("lat") != 0))
    return usable.select("zip", F.struct(*[values[f].alias(f) for f in GEO_FIELDS]).alias("geo"))


def zip_enrich(ads: DataFrame, zip_dim: DataFrame) -> DataFrame:
    """Adds `geo` to US ads by ZIP code; NULL for other countries and unknown codes. `zip` is unique in the dimension."""
    us = F.upper(F.coalesce(F.col("country_code"), F.lit("US"))) == "US"
    keyed = ads.withColumn("_zip", F.when(us, F.col("zip")))
    return look_up(keyed, zip_geocodes(zip_dim).withColumnRenamed("zip", "_zip"), ["_zip"]).drop("_zip")


def geo_fallback_chain(ads: DataFrame, providers: list[DataFrame]) -> DataFrame:
    """Adds `geo`, the first hit among tables `(zip, country_code, geo)` in order of preference.

    The tables are united with their rank and reduced to one row per key first, so the ads take part in a
    single join however many providers there are. Of several hits in one table the least counts.
    """
    ranked = None
    for rank, p in enumerate(providers):
        one = p.select("zip", F.upper("country_code").alias("country_code"), F.lit(rank).alias("rank"), "geo")
        ranked = one if ranked is None else ranked.unionByName(one)
    best = ranked.where(F.col("geo").isNotNull()).groupBy("zip", "country_code").agg(F.min(F.struct("rank", "geo")).alias("best"))
    lookup = best.select(F.col("zip"), F.col("country_code").alias("_cc"), F.col("best.geo").alias("geo"), F.col("best.rank").alias("geo_rank"))
    keyed = ads.withColumn("_cc", F.upper(F.coalesce(F.col("country_code"), F.lit("US"))))
    return look_up(keyed, lookup, ["zip", "_cc"]).select(*ads.columns, "geo", "geo_rank")


def backfill_missing(location: Column, geo: Column) -> Column:
    """Location struct whose missing fields come from `geo`; nothing already known is replaced."""
    names = {"lat": "latitude", "lng": "longitude"}

    def one(f: str) -> Column:
        known = location[names.get(f, f)]
        if f in names:
            return F.coalesce(known.cast("double"), geo[f]).alias(names[f])
        return F.coalesce(null_if_empty(known), null_if_empty(geo[f])).alias(f)

    return F.struct(*[one(f) for f in GEO_FIELDS])


def locality_cascade(address: Column, city: Column | None = None) -> Column:
    """Most local name of a VARIANT address, else the city."""
    levels = [F.try_variant_get(address, f"$.{k}", "string") for k in vocab.LOCALITY_LEVELS]
    return first_nonempty(*levels, *([] if city is None else [city]))


_COMPONENTS = """status STRING, results ARRAY<STRUCT<formatted_address: STRING, geometry: STRUCT<location: STRUCT<lat: DOUBLE, lng: DOUBLE>>,
 address_components: ARRAY<STRUCT<long_name: STRING, short_name: STRING, types: ARRAY<STRING>>>>>"""


def geocode_components(body: Column, zip_code: Column) -> Column:
    """Geocode out of a stored response with a typed component list; NULL unless it succeeded."""

    def read(response: Column) -> Column:
        place = F.get(response["results"], F.lit(0))

        def part(kind: str, name: str = "long_name") -> Column:
            return F.get(F.filter(place["address_components"], lambda x: F.array_contains(x["types"], kind)), F.lit(0))[name]

        region, land = "administrative_area_level_1", "country"
        values = {
            "lat": place["geometry"]["location"]["lat"],
            "lng": place["geometry"]["location"]["lng"],
            "city": first_nonempty(*[part(k) for k in ("locality", "sublocality_level_1", "administrative_area_level_3", "administrative_area_level_2")]),
            "locality": first_nonempty(*[part(k) for k in ("neighborhood", "sublocality_level_2", "sublocality_level_1")]),
            "sub_locality": part("sublocality_level_1"),
            "district": part("administrative_area_level_2"),
            "state": part(region),
            "state_code": part(region, "short_name"),
            "country": part(land),
            "country_code": part(land, "short_name"),
            "zip_code": first_nonempty(part("postal_code"), zip_code),
            "formatted_address": place["formatted_address"],
        }
        return F.when(
            (response["status"] == "OK") & place.isNotNull(), F.struct(*[values[f].alias(f) for f in GEO_FIELDS])
        )

    return let(F.from_json(body, _COMPONENTS), read)


def geocode_place(body: Column, zip_code: Column) -> Column:
    """Geocode out of a stored response with a flat address object."""

    def read(v: Column) -> Column:
        def a(*keys: str) -> Column:
            return first_nonempty(*[F.try_variant_get(v, f"$.address.{k}", "string") for k in keys])

        iso = F.try_variant_get(v, "$.address['ISO3166-2-lvl4']", "string")
        number = lambda k: F.nullif(F.try_variant_get(v, f"$.{k}", "string").try_cast("double"), F.lit(0.0))
        values = {
            "lat": number("lat"),
            "lng": number("lon"),
            "city": a("city", "town", "village", "municipality"),
            "locality": a("neighbourhood", "suburb", "city_district", "quarter", "village"),
            "sub_locality": F.lit(None).cast("string"),
            "district": a("county"),
            "state": a("state"),
            "state_code": grab(iso, "-([^-]*)$"),
            "country": a("country"),
            "country_code": F.upper(a("country_code")),
            "zip_code": F.coalesce(a("postcode"), zip_code),
            "formatted_address": F.try_variant_get(v, "$.display_name", "string"),
        }
        return F.when(v.isNotNull(), F.struct(*[values[f].alias(f) for f in GEO_FIELDS]))

    return let(F.try_parse_json(body), read)


# ---- metro names ----------------------------------------------------------------------------


def msa_name_clean(c: Column) -> Column:
    for suffix in (
        r"(?i),?\s*Metro(?:politan)?\s+(?:Statistical\s+)?(?:Area|Division)\b.*",
        r"(?i),?\s*Micro(?:politan)?\s+Statistical\s+Area\b.*",
        r"(?i),?\s*\bCSA\b.*",
    ):
        c = F.regexp_replace(c, suffix, "")
    return strip_ws(c)


def county_representative(zip_dim: DataFrame) -> DataFrame:
    """One point per county: that of its lowest ZIP code. ZIP codes have five digits, so a list is at most 100,000 long."""
    distinct = zip_dim.select("county", "state_code", "zip", "lat", "lng").dropDuplicates(["zip"])
    return distinct.groupBy("county", "state_code").agg(
        F.min_by(F.struct("lat", "lng"), "zip").alias("at"), F.sort_array(F.collect_set("zip")).alias("zips")
    ).select("county", "state_code", "at.lat", "at.lng", "zips")


def build_zip_msa(zip_dim: DataFrame, county_metro: DataFrame) -> DataFrame:
    """`zip, msa` for every ZIP code of a county that lies in a metro area (`county, state_code, raw_msa`)."""
    named = county_metro.select("county", "state_code", msa_name_clean(F.col("raw_msa")).alias("msa")).where("msa <> ''")
    one = named.groupBy("county", "state_code").agg(F.min("msa").alias("msa"))
    return zip_dim.join(one, ["county", "state_code"]).select("zip", "msa").distinct()


def metro_from_zip(ads: DataFrame, zip_msa: DataFrame) -> DataFrame:
    """Fills a missing `metro` of US ads from their ZIP code."""
    us = F.upper(F.coalesce(F.col("country_code"), F.lit("US"))) == "US"
    keyed = ads.withColumn("_zip", F.when(us & null_if_empty(F.col("metro")).isNull(), F.col("zip")))
    dim = zip_msa.select(F.col("zip").alias("_zip"), "msa")
    return look_up(keyed, dim, ["_zip"]).withColumn("metro", F.coalesce(null_if_empty(F.col("metro")), F.col("msa"))).drop("_zip", "msa")


def metro_precedence(stored: Column, scraped: Column, from_point: Column, country_code: Column) -> Column:
    """Stored metro of a complete document, else the metro around the point (US only), else the scraped one."""
    us = F.upper(country_code) == "US"
    return F.coalesce(null_if_empty(stored), F.when(us, from_point), null_if_empty(scraped))


# ---- spatial joins --------------------------------------------------------------------------


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("bigint")


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _left_known(ads: DataFrame, found: DataFrame) -> DataFrame:
    """`ads` left-joined with `found` on lat and lng."""
    added = [c for c in found.columns if c not in ("lat", "lng")]
    return look_up(ads, found, ["lat", "lng"]).select(*ads.columns, *added)


# sides of the cells of the search tree in degrees; a cell has 8 x 8 cells of the next level
FAN = 8
LEVELS = tuple(45.0 / FAN**k for k in range(6))


def _tree_cell(lat: Column, lng: Column, level: int) -> list[Column]:
    return [_cell(F.least(lat, F.lit(89.999999999)), LEVELS[level]).alias("cy"), _cell(F.pmod(lng, F.lit(360.0)), LEVELS[level]).alias("cx")]


def _tree_nodes(spots: DataFrame, level: int) -> DataFrame:
    """Occupied cells of a level: `cy, cx, node`, the node with its number of spots and one of them."""
    held = spots.groupBy(*_tree_cell(F.col("lat"), F.col("lng"), level)).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("lat", "lng")).alias("s"))
    return held.select("cy", "cx", F.struct(F.lit(level).alias("level"), "cy", "cx", "n", F.col("s.lat").alias("lat"), F.col("s.lng").alias("lng")).alias("node"))


def _in_reach(nodes: Column) -> Column:
    """Nodes that may hold the nearest spot of the row's point: none farther than the nearest of the spots that stand for them."""
    here = F.col("lat"), F.col("lng")

    def least(x: Column) -> Column:
        size = F.element_at(F.array(*map(F.lit, LEVELS)), x["level"] + 1)
        # no point of a cell is farther from its middle than half the diagonal of an equally wide cell at the equator
        return haversine_km(*here, (x["cy"] + 0.5) * size, (x["cx"] + 0.5) * size) - F.lit(EARTH_KM * math.sqrt(0.5) * math.radians(1.0)) * size - 1e-6

    return let(F.array_min(F.transform(nodes, lambda x: haversine_km(*here, x["lat"], x["lng"]))), lambda most: F.filter(nodes, lambda x: least(x) <= most))


def _opened(state: DataFrame, nodes: DataFrame, level: int, crowd: int) -> DataFrame:
    """Points with their crowded cells of the level above replaced by the occupied cells in them, as far as those are in reach."""
    up = lambda c: F.floor(F.col(c) / FAN).cast("bigint")
    below = nodes.groupBy(up("cy").alias("_cy"), up("cx").alias("_cx")).agg(F.collect_list("node").alias("inner"))
    is_open = lambda x: (x["level"] == level - 1) & (x["n"] > crowd)
    kept = F.filter("nodes", lambda x: ~is_open(x))
    asked = state.select("lat", "lng", kept.alias("kept"), F.explode_outer(F.filter("nodes", is_open)).alias("o")).select("lat", "lng", "kept", F.col("o.cy").alias("_cy"), F.col("o.cx").alias("_cx"))
    met = asked.join(below, ["_cy", "_cx"], "left").groupBy("lat", "lng").agg(F.any_value("kept").alias("kept"), F.flatten(F.collect_list("inner")).alias("inner"))
    return met.select("lat", "lng", _in_reach(F.concat("kept", "inner")).alias("nodes"))


def nearest_place(ads: DataFrame, places: DataFrame, crowd: int = 16) -> DataFrame:
    """Adds `place, distance_km`: the nearest place (`place, lat, lng`), however far; NULL only without a point or without places.

    Places are counted in a tree of cells, and distinct points go down it: at each level they keep the cells that may hold the nearest place,
    and open those with more than `crowd` places. So a point meets few places wherever it is, in a crowded city as well as at sea, and
    the earth needs no seams: distances to cells are taken to their middles. At every level a point holds an array of cells, a cell at most 64 below it.
    One plan, no job before it is asked for. Ties go to the smaller name.
    """
    points = ads.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("lat", "lng").distinct()
    spots = places.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).groupBy("lat", "lng").agg(F.min("place").alias("place"))
    # at most 40 cells in one row
    top = _tree_nodes(spots, 0).agg(F.collect_list("node").alias("nodes")).withColumn("_all", F.lit(0))
    state = points.withColumn("_all", F.lit(0)).join(F.broadcast(top), "_all").select("lat", "lng", _in_reach(F.col("nodes")).alias("nodes"))
    for level in range(1, len(LEVELS)):
        state = _opened(state, _tree_nodes(spots, level), level, crowd)
    chosen = state.select("lat", "lng", F.explode("nodes").alias("n")).select("lat", "lng", F.col("n.level").alias("level"), F.col("n.cy").alias("cy"), F.col("n.cx").alias("cx"))
    cells = F.array(*[F.struct(F.lit(k).alias("level"), *_tree_cell(F.col("lat"), F.col("lng"), k)) for k in range(len(LEVELS))])
    listed = spots.select(F.col("lat").alias("plat"), F.col("lng").alias("plng"), "place", F.explode(cells).alias("c")).select("plat", "plng", "place", "c.*")
    hits = chosen.join(listed, ["level", "cy", "cx"]).select("lat", "lng", haversine_km(F.col("lat"), F.col("lng"), F.col("plat"), F.col("plng")).alias("distance_km"), "place")
    best = hits.groupBy("lat", "lng").agg(F.min(F.struct("distance_km", "place")).alias("b"))
    return _left_known(ads, best.select("lat", "lng", "b.place", "b.distance_km"))


def ring_points(ring: Column) -> Column:
    """`lng lat,lng lat,…` as an array of points."""
    return F.transform(
        F.split(ring, ","),
        lambda p: F.struct(
            F.split(strip_ws(p), r"\s+")[0].cast("double").alias("x"), F.split(strip_ws(p), r"\s+")[1].cast("double").alias("y")
        ),
    )


def crossings(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd rule: whether a ray from a point to the right crosses an odd number of edges `{px, py, qx, qy}`."""

    def crosses(e: Column) -> Column:
        straddles = (e["py"] > y) != (e["qy"] > y)
        at = (e["qx"] - e["px"]) * (y - e["py"]) / F.nullif(e["qy"] - e["py"], F.lit(0.0)) + e["px"]
        return straddles & F.coalesce(x < at, F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda acc, e: acc != crosses(e))


def point_in_ring(x: Column, y: Column, pts: Column) -> Column:
    """Even-odd rule over an implicitly closed ring."""
    return crossings(x, y, ring_edges(pts))


def ring_edges(pts: Column) -> Column:
    """Edges `{px, py, qx, qy}` of an implicitly closed ring, from each point back to the one before it."""

    def edge(p: Column, i: Column) -> Column:
        q = F.when(i == 0, F.element_at(pts, -1)).otherwise(F.get(pts, i - 1))
        return F.struct(p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy"))

    return F.transform(pts, edge)


def ring_bands(shapes: DataFrame, size: float) -> DataFrame:
    """`metro_id, metro, layer, band, edges`: per shape and horizontal band of `size` degrees the edges that touch it, with the longitudes
    `lo` to `hi` they cover there. An edge is listed once per band it touches, so all bands of a shape hold little more than its edges."""
    edges = shapes.select("metro_id", "metro", "layer", F.explode(ring_edges(ring_points(F.col("ring")))).alias("e"))
    low, high = F.least("e.py", "e.qy"), F.greatest("e.py", "e.qy")
    cut = edges.withColumn("band", F.explode(F.sequence(_cell(low, size), _cell(high, size))))

    def x_at(y: Column) -> Column:
        inside = F.greatest(F.least(y, high), low)
        return F.coalesce(F.col("e.px") + (F.col("e.qx") - F.col("e.px")) * (inside - F.col("e.py")) / F.nullif(F.col("e.qy") - F.col("e.py"), F.lit(0.0)), F.col("e.px"))

    ends = [x_at(F.col("band") * size), x_at((F.col("band") + 1) * size)]
    level = F.col("e.py") == F.col("e.qy")
    ends = [F.when(level, F.col(f"e.{c}")).otherwise(x) for c, x in zip(("px", "qx"), ends)]
    placed = cut.select("metro_id", "metro", "layer", "band", F.struct("e.*", (F.least(*ends) - 1e-9).alias("lo"), (F.greatest(*ends) + 1e-9).alias("hi")).alias("e"))
    return placed.groupBy("metro_id", "metro", "layer", "band").agg(F.collect_list("e").alias("edges"))


def metro_from_point(ads: DataFrame, shapes: DataFrame, cell: float = 1.0) -> DataFrame:
    """Adds `point_metro`: the shape (`metro_id, metro, layer, ring`) around a point, lowest layer first.

    A range join as equi joins. Shapes are listed, without their edges, under the grid cells of their bands: a cell that no edge touches lies wholly inside or
    outside, so its points need no test and outer cells no row. Distinct points in the other cells are tested against the edges of the shape in their band, and the edges
    of a band move once, not once per cell.
    """
    bands = ring_bands(shapes, cell)
    column = lambda x: _cell(x, cell)
    touched = F.array_distinct(F.flatten(F.transform("edges", lambda e: F.sequence(column(e["lo"]), column(e["hi"])))))
    wide = F.sequence(column(F.array_min(F.transform("edges", lambda e: e["lo"]))), column(F.array_max(F.transform("edges", lambda e: e["hi"]))))
    marked = bands.select("*", touched.alias("touched"), F.explode(wide).alias("cx"))
    tested = F.array_contains("touched", F.col("cx"))
    middle = crossings((F.col("cx") + 0.5) * cell, (F.col("band") + 0.5) * cell, F.col("edges"))
    cells = marked.select("metro_id", "metro", "layer", "cx", F.col("band").alias("cy"), tested.alias("tested"), (tested | middle).alias("any")).where("any").drop("any")
    points = ads.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("lat", "lng").distinct()
    hits = points.withColumns({"cx": _cell(F.col("lng"), cell), "cy": _cell(F.col("lat"), cell)}).join(cells, ["cx", "cy"])
    edges = bands.select("metro_id", "layer", F.col("band").alias("cy"), "edges")
    proved = hits.where("tested").join(edges, ["metro_id", "layer", "cy"]).where(crossings(F.col("lng"), F.col("lat"), F.col("edges")))
    columns = ["lat", "lng", "metro_id", "metro", "layer"]
    inside = hits.where(~F.col("tested")).select(*columns).unionByName(proved.select(*columns))
    best = inside.groupBy("lat", "lng").agg(F.min_by("metro", F.struct("layer", "metro_id")).alias("point_metro"))
    return _left_known(ads, best)
