"""Page structure, page text and embedded JSON (2.D)."""

from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions import pagetext as P
from adloom.functions import vocab
from adloom.functions.text import strip_ws
from adloom.plans.registry import query
from adloom.plans.urls import pages
from adloom.sources.fixtures import fixture, table, with_fixtures

c = F.col

# SQL: markup without comments, scripts and styles
CLEAN = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\b.*?</script>', '', 'g'), '(?is)<style\b.*?</style>', '', 'g')"


def sql_entities(expr):
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        expr = f"replace({expr}, '{entity}', '{char}')"
    return expr


def tokenized(df, *keep):
    """Page rows with their token array, computed once in its own projection."""
    return df.select(*keep, H.html_tokens(c("html")).alias("tokens"))


def html_pages(spark, d):
    return fixture(spark, d, "f_html", dealt_by="p_partkey")


@query(
    "html_tokens",
    rf"""WITH pieces AS (SELECT page_id, regexp_extract_all({CLEAN}, '<[/a-zA-Z][^>]*>|[^<]+|<') AS p FROM pages),
flat AS (SELECT page_id, unnest(p) AS s, generate_subscripts(p, 1) - 1 AS pos FROM pieces)
SELECT page_id, CAST(pos AS INTEGER) AS pos, starts_with(s, '</') AS close,
  CASE WHEN regexp_matches(s, '^</?[a-zA-Z]') THEN lower(regexp_extract(s, '[a-zA-Z][a-zA-Z0-9-]*')) END AS tag,
  CASE WHEN regexp_matches(s, '^</?[a-zA-Z]') THEN regexp_replace(regexp_replace(s, '^</?[a-zA-Z][a-zA-Z0-9-]*', ''), '/?>$', '') END AS attrs,
  CASE WHEN NOT regexp_matches(s, '^</?[a-zA-Z]') THEN {sql_entities("s")} END AS text
FROM flat""",
)
def html_tokens(spark, d):
    exploded = tokenized(pages(spark, d), "page_id").select("page_id", F.explode("tokens").alias("t"))
    return exploded.select("page_id", *[c(f"t.{f}").alias(f) for f in ("pos", "close", "tag", "attrs", "text")])


@query("page_title", "SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1)), ''), 'unknown') AS title FROM pages")
def page_title(spark, d):
    return pages(spark, d).select("page_id", H.page_title(c("html")).alias("title"))


@query(
    "select_text",
    f"""SELECT page_id, trim({sql_entities(f"regexp_extract({CLEAN}, '(?is)<h1[^>]*>([^<]*)</h1>', 1)")}) AS heading,
trim({sql_entities(f"regexp_extract({CLEAN}, '(?is)<div class=.ad.>([^<]*)</div>', 1)")}) AS ad_text FROM pages""",
)
def select_text(spark, d):
    t = c("tokens")
    return tokenized(pages(spark, d), "page_id").select(
        "page_id",
        H.select_text(t, [("class*", "headline"), ("tag", "h1")]).alias("heading"),
        H.select_text(t, [("class", "ad"), ("attr:itemprop", "name")]).alias("ad_text"),
    )


def _fx(key, columns, sql, fix="f_html", key_col="page_id"):
    """A projection over tokenized pages of the markup fixture; `columns` gets the token and the html column."""

    def run(spark, d):
        df = tokenized(html_pages(spark, d), "page_id", "url", "html")
        return df.select("page_id", *[e.alias(n) for n, e in columns(c("tokens"), c("html")).items()])

    query(key, with_fixtures(fix) + f" SELECT page_id, {sql} FROM {fix}")(run)


_META = [("attr:property", "og:title")]
_fx(
    "select_attr",
    lambda t, h: {
        "og_title": H.select_attr(t, _META, "content"),
        "og_description": H.select_attr(t, [("attr:property", "og:description")], "content"),
        "og_image": H.select_attr(t, [("attr:property", "og:image")], "content"),
        "canonical": H.select_attr(t, [("attr:rel", "canonical")], "href"),
    },
    """regexp_extract(html, 'og:title" content="([^"]*)"', 1) AS og_title, CAST(NULL AS VARCHAR) AS og_description, '/logo.png' AS og_image,
  'https://ads.example.com/c/' || CAST(page_id AS VARCHAR) AS canonical""",
)

_fx(
    "label_value_grid",
    lambda t, h: (lambda g: {f: g[f] for f in ("bedrooms", "deposit", "ad_type", "property_category", "rent")})(
        H.grid_fields(H.label_value_grid(t))
    ),
    r"""regexp_extract(html, 'Bedrooms:</span><span>([^<]*)', 1) AS bedrooms, regexp_extract(html, 'Deposit</b></div><div>([^<]*)', 1) AS deposit,
  regexp_extract(html, 'Ad Type</td><td>([^<]*)', 1) AS ad_type, 'Apartment' AS property_category, CAST(NULL AS VARCHAR) AS rent""",
)
_fx(
    "section_items",
    lambda t, h: {
        "amenities": H.section_items(t, "^amenities$"),
        "utilities": H.section_items(t, "^utilities$"),
        "additional_info": H.section_items(t, r"^additional\s+info"),
        "absent": H.section_items(t, "^verified"),
    },
    """['Gym', 'Lift'] AS amenities, ['Water'] AS utilities,
  ['No Smoking', CASE WHEN contains(html, 'Only Dogs') THEN 'Only Dogs' ELSE 'Fully furnished' END] AS additional_info, CAST([] AS VARCHAR[]) AS absent""",
)
_fx(
    "overview_pick",
    lambda t, h: {
        "details": H.overview_pick(t),
        "live": H.overview_pick(t, H.OVERVIEW_LIVE, 20),
        "long_only": H.overview_pick(t, H.OVERVIEW_LIVE, 500),
    },
    r"""regexp_extract(html, '(Long enough[^<]*)', 1) || chr(10) || 'AREA' || chr(10) || regexp_extract(html, '<p>([0-9]+ sqft)', 1) AS details,
  regexp_extract(html, '(Long enough[^<]*)', 1) || chr(10) || 'AREA' || chr(10) || regexp_extract(html, '<p>([0-9]+ sqft)', 1) AS live, CAST(NULL AS VARCHAR) AS long_only""",
)


def _address(t, h):
    a = H.address_near_h1(t)
    return {n: a[n] for n in ("full_address", "city", "state", "zipcode", "county", "nearby_university")}


_fx(
    "address_near_h1",
    _address,
    """'Houston, TX, USA, 77004' AS full_address, 'Houston' AS city, 'TX' AS state, '77004' AS zipcode, 'Harris County' AS county, CAST(NULL AS VARCHAR) AS nearby_university""",
)
_fx(
    "photos_from_html",
    lambda t, h: {"photos": H.photos_from_html(t)},
    r"""['https://img.example.com/t/' || CAST(page_id AS VARCHAR) || '.jpg', 'https://img.example.com/full/' || CAST(page_id AS VARCHAR) || '.jpg',
  regexp_extract(html, 'data-src="([^"]*)"', 1)] AS photos""",
)
_fx(
    "photos_from_ld",
    lambda t, h: {"photos": J.photos_from_ld(J.json_ld(h))},
    "['https://img.example.com/ld/' || CAST(page_id AS VARCHAR) || '.jpg'] AS photos",
)
_fx(
    "json_window_var",
    lambda t, h: {
        "rent": J.json_get_path(J.json_window_var(h, "__INITIAL_STATE__"), "$.ad.rent", "bigint"),
        "fb": J.json_get_path(J.json_window_var(h, "__FIREBASE_DATA__"), "$.ad.fb", "bigint"),
    },
    r"""CAST(regexp_extract(html, '"rent":([0-9]+)', 1) AS BIGINT) AS rent, CAST(nullif(regexp_extract(html, '"fb":([0-9]+)', 1), '') AS BIGINT) AS fb""",
)
_fx(
    "json_ld",
    lambda t, h: {
        "n_blocks": F.size(J.json_ld(h)),
        "name": J.json_get_path(F.get(J.json_ld(h), F.lit(0)), "$.name"),
        "image": J.json_get_path(F.get(J.json_ld(h), F.lit(0)), "$.image[0]"),
    },
    r"""CAST(1 AS INTEGER) AS n_blocks, json_extract_string(regexp_extract(html, 'ld.json">([^<]*)<', 1), '$.name') AS name,
  json_extract_string(regexp_extract(html, 'ld.json">([^<]*)<', 1), '$.image[0]') AS image""",
)
_fx(
    "json_embedded",
    lambda t, h: {
        "n_objects": F.size(J.json_embedded(h)),
        "titles": F.filter(
            F.transform(J.json_embedded(h), lambda v: J.json_get_path(v, "$.ad.title")), lambda x: x.isNotNull()
        ),
    },
    r"""CAST(5 + (CASE WHEN page_id % 4 = 0 THEN 2 ELSE 0 END) + (CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS n_objects,
  list_concat([regexp_extract(html, '<title> (.*?) </title>', 1), regexp_extract(html, '<title> (.*?) </title>', 1),
    'state ' || regexp_extract(html, '<title> (.*?) </title>', 1), 'state ' || regexp_extract(html, '<title> (.*?) </title>', 1)],
    CASE WHEN page_id % 5 = 0 THEN ['next'] ELSE CAST([] AS VARCHAR[]) END) AS titles""",
)


@query(
    "posted_by_cascade",
    with_fixtures("f_html")
    + """ SELECT page_id, 'User ' || regexp_extract(html, 'og:title" content="([^"]*)"', 1) AS posted_by, 'Beside ' || CAST(page_id AS VARCHAR) AS beside,
  CASE WHEN page_id % 2 = 0 THEN 'Info Box' END AS boxed FROM f_html""",
)
def posted_by_cascade(spark, d):
    df = html_pages(spark, d)
    no_line = F.regexp_replace("html", "Posted by: User [^<]*", "")
    beside = F.concat(no_line, F.lit("<table><tr><th>Posted by:</th><td>Beside "), c("page_id").cast("string"), F.lit("</td></tr></table>"))
    boxed = F.when(c("page_id") % 2 == 0, F.concat(no_line, F.lit('<div class="info-box">Posted by: Info Box</div>'))).otherwise(no_line)
    toks = df.select(
        "page_id",
        "html",
        beside.alias("h2"),
        boxed.alias("h3"),
    ).select(
        "page_id",
        H.html_tokens(c("html")).alias("t1"),
        H.page_text(c("html")).alias("x1"),
        H.html_tokens(c("h2")).alias("t2"),
        H.html_tokens(c("h3")).alias("t3"),
    )
    nothing = F.lit("")
    return toks.select(
        "page_id",
        H.posted_by_cascade(c("t1"), c("x1")).alias("posted_by"),
        H.posted_by_cascade(c("t2"), nothing).alias("beside"),
        H.posted_by_cascade(c("t3"), nothing).alias("boxed"),
    )


# ---- page text ------------------------------------------------------------------------------


def _tx(key, columns, sql):
    def run(spark, d):
        return fixture(spark, d, "f_text").select("ad_id", *[e.alias(n) for n, e in columns().items()])

    query(key, with_fixtures("f_text") + f" SELECT ad_id, {sql} FROM f_text")(run)


def _fields(struct, names):
    return {n: struct[n] for n in names}


_LINE_AFTER = "nullif(regexp_extract(page_text, '{0}\\n([^\\n]*)', 1), '')"
_tx(
    "quick_facts",
    lambda: _fields(P.quick_facts(c("page_text")), ["available_from", "accommodates", "rent", "area_sqft", "bedrooms"]),
    f"""{_LINE_AFTER.format("AVAILABLE FROM")} AS available_from, {_LINE_AFTER.format("ACCOMM?ODATES")} AS accommodates,
  {_LINE_AFTER.format("EXPECTED RENT")} AS rent, {_LINE_AFTER.format("AREA")} AS area_sqft, CAST(NULL AS VARCHAR) AS bedrooms""",
)
_tx(
    "strip_quick_facts",
    lambda: {"overview": P.strip_quick_facts(c("page_text"))},
    r"CASE WHEN ad_id % 5 = 0 THEN page_text ELSE string_split(page_text, chr(10))[1] END AS overview",
)
_tx(
    "sane_or_null",
    lambda: {
        "kept": P.sane_or_null(c("page_text"), 250),
        "area": P.clean_area(P.quick_facts(c("page_text"))["area_sqft"]),
        "area_words": P.clean_area(F.lit("large")),
        "deposit": P.clean_deposit(P.quick_facts(c("page_text"))["rent"]),
    },
    f"""CASE WHEN length(page_text) <= 250 THEN page_text END AS kept, regexp_extract({_LINE_AFTER.format("AREA")}, '^[0-9]+') AS area, 'large' AS area_words,
  substr({_LINE_AFTER.format("EXPECTED RENT")}, 2) AS deposit""",
)
_tx(
    "posted_line",
    lambda: _fields(P.posted_line(c("page_text")), ["posted_on", "posted_by"])
    | {"site_ad_id": P.posted_line(c("page_text"))["ad_id"]},
    "'Jun 05, 2026' AS posted_on, CAST(ad_id AS VARCHAR) AS site_ad_id, regexp_extract(page_text, '(User Brand#[0-9]+)', 1) AS posted_by",
)
_tx(
    "overview_merge",
    lambda: {"overview": P.overview_merge(c("json_text"), c("page_text")), "short_page": P.overview_merge(c("json_text"), F.lit("a\nb"))},
    "page_text AS overview, coalesce(json_text, 'a' || chr(10) || 'b') AS short_page",
)
_tx(
    "poster_merge",
    lambda: {"poster": P.poster_merge(c("json_text"), P.posted_line(c("page_text"))["posted_by"])},
    "coalesce(json_text, regexp_extract(page_text, '(User Brand#[0-9]+)', 1)) AS poster",
)
_tx(
    "neighborhood_list",
    lambda: {"names": P.neighborhood_names(c("page_text"))},
    "[regexp_extract(page_text, 'Neighborhoods: ([A-Z]+),', 1), 'Midtown'] AS names",
)
_tx(
    "verified_credentials",
    lambda: {
        "from_text": P.verified_credentials(F.array().cast("array<string>"), c("page_text")),
        "from_items": P.verified_credentials(F.array(F.lit("Email verified"), F.lit("x")), c("page_text")),
    },
    "CASE WHEN page_text LIKE '%Phone Verified' THEN ['Phone Verified'] ELSE CAST([] AS VARCHAR[]) END AS from_text, ['Email verified'] AS from_items",
)

# ---- JSON ------------------------------------------------------------------------------------


@query(
    "json_safe_parse",
    """SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def json_safe_parse(spark, d):
    text = F.expr("CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN 'x = ' || props || '; y' WHEN 2 THEN props ELSE '{broken' END")
    parsed = table(spark, d, "events").select("event_id", J.json_safe_parse(text).alias("v"))
    return parsed.select("event_id", J.json_get_path(c("v"), "$.k", "bigint").alias("k"))


@query(
    "json_get_path",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events",
)
def json_get_path(spark, d):
    parsed = table(spark, d, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return parsed.select(
        "event_id", J.json_get_path(c("v"), "$.k", "bigint").alias("k"), J.json_get_path(c("v"), "$.k.deep").alias("missing")
    )


@query(
    "json_next_data",
    with_fixtures("f_list")
    + """, j AS (SELECT page_id, regexp_extract(html, 'type="application/json">(.*?)</script>', 1) AS b FROM f_list)
SELECT page_id, CAST(json_extract(b, '$.props.pageProps.totalAds') AS BIGINT) AS total, json_extract_string(b, '$.props.pageProps.ads[0].slug') AS slug FROM j""",
)
def json_next_data(spark, d):
    df = fixture(spark, d, "f_list").select("page_id", J.json_next_data(c("html")).alias("v"))
    return df.select(
        "page_id",
        J.json_get_path(c("v"), "$.props.pageProps.totalAds", "bigint").alias("total"),
        J.json_get_path(c("v"), "$.props.pageProps.ads[0].slug").alias("slug"),
    )


@query(
    "photos_from_json",
    with_fixtures("f_photo")
    + """, flat AS (SELECT ad_id, unnest(CAST(json_photos AS JSON[])) AS p, generate_subscripts(CAST(json_photos AS JSON[]), 1) - 1 AS i FROM f_photo)
SELECT ad_id, CAST(i AS INTEGER) AS index, CASE json_type(p) WHEN 'VARCHAR' THEN json_extract_string(p, '$') ELSE coalesce(json_extract_string(p, '$.url'), json_extract_string(p, '$.src')) END AS url,
  json_extract_string(p, '$.caption') AS alt FROM flat""",
)
def photos_from_json(spark, d):
    ad = F.concat(F.lit('{"photos":[],"images":'), c("json_photos"), F.lit("}"))
    df = fixture(spark, d, "f_photo").select("ad_id", F.try_parse_json(ad).alias("ad"))
    return df.select("ad_id", F.explode(J.photos_from_json(c("ad"))).alias("p")).select("ad_id", "p.*")


@query(
    "image_reject",
    with_fixtures("f_photo")
    + """ SELECT ad_id, width_text = '40' OR json_photos LIKE '%logo%' AS rejected, false AS plain, true AS inline_data FROM f_photo""",
)
def image_reject(spark, d):
    url = F.when(F.contains(c("json_photos"), F.lit("logo")), "https://img.example.com/logo.png").otherwise("https://img.example.com/a.jpg")
    return fixture(spark, d, "f_photo").select(
        "ad_id",
        H.image_reject(url, F.lit("front view"), c("width_text")).alias("rejected"),
        H.image_reject(F.lit("https://img.example.com/1.jpg"), side=c("ad_id").cast("string").substr(1, 0)).alias("plain"),
        H.image_reject(F.lit("data:image/png;base64,xx")).alias("inline_data"),
    )


@query(
    "photos_merge",
    with_fixtures("f_photo")
    + """, own AS (SELECT ad_id, CASE WHEN json_photos LIKE '["%' THEN [substr(json_photos, 3, length(json_photos) - 4)] ELSE CAST([] AS VARCHAR[]) END AS j,
  string_split(page_photos, '|') AS p FROM f_photo),
merged AS (SELECT ad_id, list_concat(j, list_filter(p, lambda u: NOT list_contains(j, u))) AS m FROM own)
SELECT ad_id, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS index, unnest(m) AS url FROM merged""",
)
def photos_merge(spark, d):
    own = F.coalesce(
        F.from_json(F.when(c("json_photos").rlike(r'^\["'), c("json_photos")), "array<string>"), F.array().cast("array<string>")
    )
    df = fixture(spark, d, "f_photo").select("ad_id", own.alias("own"), F.split("page_photos", r"\|").alias("shown"))
    return df.select("ad_id", F.explode(H.photos_merge(c("own"), c("shown"))).alias("p")).select("ad_id", "p.*")


@query(
    "amenity_bag",
    with_fixtures("f_amen")
    + """, e AS (SELECT ad_id, unnest(list_transform(string_split(amenity_labels, '|'), lambda x: replace(lower(x), ' ', '_'))) AS key, 'true' AS value FROM f_amen
  UNION ALL SELECT ad_id, 'pool_table', 'false' FROM f_amen UNION ALL SELECT ad_id, 'heat', '2' FROM f_amen)
SELECT ad_id, key, CASE WHEN key = 'gym' THEN 'false' ELSE value END AS value FROM e
UNION ALL SELECT ad_id, 'gym', 'false' FROM f_amen WHERE amenity_labels NOT LIKE 'Gym%'""",
)
def amenity_bag(spark, d):
    body = F.to_json(
        F.struct(
            F.split("amenity_labels", r"\|").alias("amenities"),
            F.array(F.struct(F.lit("Pool Table").alias("name"), F.lit(False).alias("available"))).alias("features"),
            F.struct(F.lit(2).alias("heat"), F.lit(False).alias("gym")).alias("utilities"),
        )
    )
    df = fixture(spark, d, "f_amen").select("ad_id", F.try_parse_json(body).alias("ad"))
    return df.select("ad_id", F.explode(J.amenity_bag(c("ad"))))
