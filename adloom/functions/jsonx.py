"""Embedded JSON: finding it in markup, parsing it leniently, navigating it.

Parsed JSON is a VARIANT column: parsed once, then every path lookup is a binary seek.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.html import attr
from adloom.functions.text import first_where, grab, let, null_if_empty, strip_ws


def kind(v: Column) -> Column:
    """OBJECT, ARRAY or a scalar type name."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v) == "OBJECT", F.lit(False))


def is_container(v: Column) -> Column:
    return F.coalesce(kind(v).isin("OBJECT", "ARRAY"), F.lit(False))


def json_safe_parse(text: Column) -> Column:
    """The JSON value of a text, or of its widest `{…}` or `[…]` part; NULL if neither parses."""
    whole = F.try_parse_json(text)
    part = grab(text, r"(?s)(\{.*\}|\[.*\])")
    return F.coalesce(whole, F.try_parse_json(part))


def json_get_path(v: Column, path: str, as_type: str = "string") -> Column:
    return F.try_variant_get(v, path, as_type)


def _first_json(html: Column, name: str, patterns: list[str]) -> Column:
    """The first match that parses. All patterns hold the name, so pages without it are not searched."""
    return F.when(F.contains(html, F.lit(name)), F.coalesce(*[let(grab(html, p), json_safe_parse) for p in patterns]))


def json_next_data(html: Column) -> Column:
    """Framework state: the body of `script#__NEXT_DATA__`, else an assignment of that name."""
    return _first_json(html, "__NEXT_DATA__", vocab.NEXT_DATA)


def json_window_var(html: Column, name: str) -> Column:
    """Value of `window.<name> = {…};` in any of its spellings. `name` is plain text."""
    quoted = "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in name)
    return _first_json(html, name, [before + quoted + after for before, after in vocab.WINDOW_VAR])


def _parsed(texts: Column) -> Column:
    return F.filter(F.transform(texts, json_safe_parse), lambda v: v.isNotNull())


def json_ld(html: Column) -> Column:
    """Every linked-data block that parses, in page order."""
    blocks = F.regexp_extract_all(html, F.lit(vocab.LINKED_DATA), F.lit(1))
    return _parsed(F.transform(blocks, strip_ws))


def inline_scripts(html: Column) -> Column:
    """Distinct bodies (20 characters or more) of scripts without a source file."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>.*?</script>"), F.lit(0))
    own = F.filter(tags, lambda s: ~s.rlike(r"(?is)^<script\b[^>]*\ssrc\s*="))
    bodies = F.transform(own, lambda s: strip_ws(F.regexp_replace(s, r"(?is)^<script\b[^>]*>|</script>$", "")))
    return F.array_distinct(F.filter(bodies, lambda b: F.length(b) >= 20))


def json_embedded(html: Column) -> Column:
    """Objects assigned in inline scripts, scripts that are JSON as a whole, and JSON in meta content; page order."""

    def of_script(body: Column) -> Column:
        assigned = F.flatten(F.array(*[F.regexp_extract_all(body, F.lit(p), F.lit(1)) for p in vocab.ASSIGNMENTS]))
        objects = F.filter(_parsed(assigned), is_object)
        whole = F.filter(F.array(json_safe_parse(body)), lambda v: v.isNotNull() & is_container(v))
        return F.concat(objects, whole)

    metas = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b([^>]*)>"), F.lit(1))
    contents = F.transform(F.filter(metas, lambda m: m.rlike(r"(?i)\s(name|property)\s*=")), lambda m: attr(m, "content"))
    from_meta = _parsed(F.filter(contents, lambda c: c.startswith("{")))
    return F.concat(F.flatten(F.transform(inline_scripts(html), of_script)), from_meta)


def page_sources(html: Column) -> Column:
    """All JSON of one page as an array `{source, seq, body}`; `seq` counts within a source."""

    def tagged(values: Column, source: str) -> Column:
        return F.transform(
            F.filter(values, lambda v: v.isNotNull()),
            lambda v, i: F.struct(F.lit(source).alias("source"), i.cast("int").alias("seq"), v.alias("body")),
        )

    return F.concat(
        tagged(json_ld(html), "ld"),
        tagged(json_embedded(html), "embedded"),
        tagged(F.array(json_window_var(html, "__FIREBASE_DATA__")), "firebase"),
        tagged(F.array(json_window_var(html, "__INITIAL_STATE__")), "initial_state"),
        tagged(F.array(json_next_data(html)), "next_data"),
    )


def source_rank(source: Column, seq: Column) -> Column:
    """Merge rank: the source decides, then the order within the source."""
    order = F.array(*[F.lit(s) for s in vocab.SOURCE_ORDER])
    return F.array_position(order, source).cast("bigint") * F.lit(1 << 40) + seq.cast("bigint")


# ---- the ad inside a page's JSON ------------------------------------------------------------


def ad_node_path(raw: Column) -> Column:
    """Path of the ad object: a known key of the page properties, the properties themselves if they carry an
    id, a known key at the top, else the root."""
    props = "$.props.pageProps"

    def container_at(path: str) -> Column:
        return F.when(is_container(F.try_variant_get(raw, path, "variant")), F.lit(path))

    has_id = F.coalesce(*[_truthy(F.try_variant_get(raw, f"{props}.{k}", "string")) for k in ("adId", "id", "uid")])
    return F.coalesce(
        *[container_at(f"{props}.{k}") for k in vocab.PAGE_AD_KEYS],
        F.when(has_id.isNotNull(), F.lit(props)),
        *[container_at(f"$.{k}") for k in vocab.FLAT_AD_KEYS],
        F.lit("$"),
    )


def _truthy(s: Column) -> Column:
    return F.when(~s.isin("", "0", "false"), s)


def at_path(raw: Column, path: Column) -> Column:
    """The value at one of the possible ad paths."""
    options = (
        [f"$.props.pageProps.{k}" for k in vocab.PAGE_AD_KEYS] + ["$.props.pageProps"] + [f"$.{k}" for k in vocab.FLAT_AD_KEYS]
    )
    chain = None
    for p in options:
        value = F.try_variant_get(raw, p, "variant")
        chain = F.when(path == p, value) if chain is None else chain.when(path == p, value)
    return chain.otherwise(raw)


# ---- photos and amenities in the ad object --------------------------------------------------


def photos_from_json(ad: Column) -> Column:
    """Photos of the first non-empty photo list of an ad as `{index, url, alt}`."""
    return photos_of_lists([F.try_variant_get(ad, f"$.{k}", "array<variant>") for k in vocab.PHOTO_LIST_KEYS])


def photos_of_lists(lists: list[Column]) -> Column:
    """Photos of the first list that is not empty as `{index, url, alt}`."""
    return photos_of(F.coalesce(*[F.when(F.size(a) > 0, a) for a in lists]))


def photos_of(chosen: Column) -> Column:
    """Photos of one list of texts and objects as `{index, url, alt}`."""

    def photo(p: Column, i: Column) -> Column:
        def of(keys: list[str]) -> Column:
            return F.coalesce(*[null_if_empty(F.try_variant_get(p, f"$.{k}", "string")) for k in keys])

        plain = kind(p) == "STRING"
        return F.when(
            plain | is_container(p),
            F.struct(
                i.cast("int").alias("index"),
                F.when(plain, F.try_variant_get(p, "$", "string")).otherwise(of(vocab.PHOTO_URL_KEYS)).alias("url"),
                F.when(~plain, of(vocab.PHOTO_ALT_KEYS)).alias("alt"),
            ),
        )

    return F.coalesce(
        F.filter(F.transform(chosen, photo), lambda x: x.isNotNull()),
        F.array().cast("array<struct<index:int,url:string,alt:string>>"),
    )


def photos_from_ld(blocks: Column) -> Column:
    """Image URLs of linked-data blocks: `image`, or the images of `@graph`."""

    def urls(image: Column) -> Column:
        many = F.coalesce(F.try_variant_get(image, "$", "array<variant>"), F.array(image))
        return F.transform(
            many,
            lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(
                F.try_variant_get(v, "$.url", "string")
            ),
        )

    def of_block(b: Column) -> Column:
        own = F.try_variant_get(b, "$.image", "variant")
        graph = F.flatten(
            F.transform(
                F.coalesce(F.try_variant_get(b, "$['@graph']", "array<variant>"), F.array().cast("array<variant>")),
                lambda g: urls(F.try_variant_get(g, "$.image", "variant")),
            )
        )
        return F.when(own.isNotNull() & ~F.is_variant_null(own), urls(own)).otherwise(graph)

    return F.array_distinct(
        F.filter(F.flatten(F.transform(blocks, of_block)), lambda u: u.isNotNull() & (u != "") & ~u.startswith("data:"))
    )


def amenity_bag(ad: Column, labels: Column | None = None) -> Column:
    """Map of amenity key to value over all amenity lists and objects, later ones win; else from page labels."""

    def entries(path: str) -> Column:
        members = F.map_entries(F.try_variant_get(ad, path, "map<string,variant>"))
        return F.transform(members, lambda e: F.struct(e["key"].alias("key"), F.try_variant_get(e["value"], "$", "string").alias("value")))

    return amenities_of(F.concat(*[amenity_entries(F.try_variant_get(ad, f"$.{k}", "array<variant>"), entries(f"$.{k}")) for k in vocab.AMENITY_LIST_KEYS]), labels)


ENTRIES = "array<struct<key:string,value:string>>"


def _amenity_key(s: Column) -> Column:
    return F.regexp_replace(F.lower(s), r"\s+", "_")


def amenity_entries(as_list: Column, members: Column) -> Column:
    """`{key, value}` of one amenity source: a list of names and of objects with names, or else the members of an object."""

    def one(v: Column) -> Column:
        name = F.try_variant_get(v, "$.name", "string")
        value = F.coalesce(F.try_variant_get(v, "$.available", "string"), F.try_variant_get(v, "$.value", "string"), F.lit("true"))
        return F.when(
            kind(v) == "STRING", F.struct(_amenity_key(F.try_variant_get(v, "$", "string")).alias("key"), F.lit("true").alias("value"))
        ).when(is_object(v) & (name != ""), F.struct(_amenity_key(name).alias("key"), value.alias("value")))

    return F.coalesce(F.filter(F.transform(as_list, one), lambda e: e.isNotNull()), members, F.array().cast(ENTRIES))


def amenities_of(entries: Column, labels: Column | None = None) -> Column:
    """Map out of `{key, value}` entries, later ones win; out of page labels if there is no entry."""
    if labels is not None:
        short = F.filter(labels, lambda s: (s != "") & (F.length(s) < 60))
        shown = F.transform(short, lambda s: F.struct(_amenity_key(s).alias("key"), F.lit("true").alias("value")))
        entries = let(entries, lambda e: F.when(F.size(e) > 0, e).otherwise(shown))
    return last_wins_map(entries)


def last_wins_map(entries: Column) -> Column:
    """Map from `{key, value}` entries without relying on the session's duplicate-key policy."""

    def build(e: Column) -> Column:
        keys = F.array_distinct(F.transform(e, lambda x: x["key"]))

        def last_value(k: Column) -> Column:
            return F.struct(k, F.try_element_at(F.filter(e, lambda x: x["key"] == k), F.lit(-1))["value"])

        return F.map_from_entries(F.transform(keys, last_value))

    return let(entries, build)
