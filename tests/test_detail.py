"""Layers of JSON, selectors and detail pages against plain Python."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.functions import overlay as O
from adloom.functions import urls as U
from adloom.operators import detail as D
from adloom.operators import geo as G
from adloom.session import new_table_path
from adloom.streaming import streams as X

SITE = U.SiteProfile(domain="ads.example.com", photo_path="img.example.com/store/")


def merged(docs):
    """Documents, weakest first, merged one after the other."""
    out = {}
    for doc in docs:
        for k, v in doc.items() if isinstance(doc, dict) else ():
            out[k] = merged([out.get(k), v]) if isinstance(v, dict) and isinstance(out.get(k), dict) else merged([v]) if isinstance(v, dict) else v
    return out


def leaf_rows(doc, path=()):
    if not doc:
        yield path, "{}"
    for k, v in doc.items():
        if isinstance(v, dict):
            yield from leaf_rows(v, (*path, k))
        else:
            yield (*path, k), json.dumps(v, separators=(",", ":"))


def some_doc(rng, depth=0):
    if depth and (depth == 5 or rng.random() < 0.35):
        return rng.choice([1, "s", "", None, True, [1, {"a": 2}], [], {}])
    return {k: some_doc(rng, depth + 1) for k in rng.sample(["a", "b", "c", 'q"'], rng.randint(0, 3))}


def test_layers_read_like_the_merged_document(spark):
    rng = random.Random(5)
    rows = [(i, [json.dumps(some_doc(rng) if rng.random() < 0.95 else [1]) for _ in range(rng.randint(0, 5))]) for i in range(400)]
    strongest_first = F.reverse(F.transform("docs", F.try_parse_json))
    paths = ["a", "b", "a.b", "a.b.c", "b.a.a", "c.c.c.c"]
    df = spark.createDataFrame(rows, "i int, docs array<string>").select("i", O.layers(strongest_first).alias("l"))
    got = df.select(
        "i", F.transform(O.leaves(F.col("l")), lambda x: F.struct(x["path"], x["value"])).alias("leaves"), O.merged_json(F.col("l")).alias("json"),
        F.array(*[O.text(F.col("l"), p) for p in paths]).alias("texts"), F.array(*[O.merged_json(O.below(F.col("l"), p)) for p in paths]).alias("below"),
        O.texts(O.by_key(F.col("l")), ["a", "c", "zz"]).alias("map"), O.members(F.col("l")).alias("members"),
    ).collect()
    for r in got:
        docs = [json.loads(d) for d in rows[r.i][1]]
        want, objects = merged(docs), any(isinstance(d, dict) for d in docs)
        assert sorted((tuple(x[0]), x[1]) for x in r.leaves) == sorted(leaf_rows(want) if objects else [])
        assert (json.loads(r.json) if objects else r.json) == (want if objects else None)

        def at(path):
            here = want
            for k in path.split("."):
                here = here.get(k) if isinstance(here, dict) else None
            return here

        def text(v):
            return None if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":"), sort_keys=True)

        for p, t, b in zip(paths, r.texts, r.below):
            assert t == text(at(p)), (docs, p)
            assert (b and json.loads(b)) == (at(p) if isinstance(at(p), dict) else None)
        assert r.map == {k: text(want[k]) for k in ("a", "c") if k in want}
        assert {m.key: json.loads(m.json) for m in r.members} == want


PAGE = """<html><body><div class="nearby-neighborhood-box"><a href="/a">Oak</a><p><a>Elm</a></p><a>Oak</a></div>
<div class="overview-box"><span>x</span><p>The first paragraph is the long overview of this place.</p></div><section><p>loose</p></section>
<div class="info">nothing</div><div class="info">Posted by: Second Info</div>
<ul class="features"><li class="feature">Big  Pool</li><li class="feature-item">Lift</li></ul></body></html>"""


def tokens_of(spark, page, *columns):
    return spark.createDataFrame([(page,)], "h string").select(H.html_tokens(F.col("h")).alias("t")).select(*[c(F.col("t")).alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_selectors_and_every_element(spark):
    r = tokens_of(
        spark, PAGE, H.neighborhood_links, H.overview_pick, lambda t: H.posted_by_cascade(t, F.lit("")), H.amenity_labels,
        lambda t: F.transform(H.select_all(t, (("class*", "nearby"), H.CHILD, ("tag", "a"))), lambda x: H.element_text(t, x)),
        lambda t: F.transform(H.select_all(t, (("tag", "body"), H.INSIDE, ("tag", "section"), H.CHILD, ("tag", "p"))), lambda x: H.element_text(t, x)),
    )
    assert r.c0 == ["Oak", "Elm"] and r.c1 == "The first paragraph is the long overview of this place."
    assert r.c2 == "Second Info" and r.c3[1:] == ["Big  Pool", "Lift"] and r.c4 == ["Oak", "Oak"] and r.c5 == ["loose"]


def test_poster_beside_a_label(spark):
    cascade = lambda t: H.posted_by_cascade(t, F.lit(""))
    assert tokens_of(spark, "<div><span>Posted by:</span></div><p><b>Posted by</b></p><li>Posted by:</li> Loose Text", cascade).c0 == "Loose Text"
    assert tokens_of(spark, "<div><span>Posted by:</span></div><td>Posted by</td><td>Cell <b>Two</b></td>", cascade).c0 == "Cell Two"


def spans(html):
    """Ends and parents by a plain stack over the same tolerant rules."""
    import re

    pieces = re.findall(r"<[/a-zA-Z][^>]*>|[^<]+|<", html)
    tags = [(re.match(r"</?([a-zA-Z][a-zA-Z0-9-]*)", p).group(1).lower(), p.startswith("</")) if re.match(r"</?[a-zA-Z]", p) else (None, False) for p in pieces]
    ends = []
    for i, (tag, close) in enumerate(tags):
        end = i
        if tag and not close and tag not in H.VOID_TAGS:
            depth, end = 1, len(tags)
            for j in range(i + 1, len(tags)):
                if tags[j][0] == tag:
                    depth -= 1 if tags[j][1] or tag == "p" else -1
                    if depth == 0:
                        end = j
                        break
        ends.append(end)
    nexts = [next((j for j in range(i + 1, len(tags)) if tags[j][0]), None) for i in range(len(tags))]
    return tags, ends, nexts


def test_spans_equal_a_search_for_every_token(spark):
    rng = random.Random(9)
    pages = ["".join(rng.choice(["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<br>", "text", "<li>", "</li>", "<x-y>", "</x-y>"]) for _ in range(rng.randrange(0, 400))) for _ in range(120)]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, h string").select("i", H.html_tokens(F.col("h")).alias("t")).collect()
    for r in got:
        tags, ends, nexts = spans(pages[r.i])
        assert [x.end for x in r.t] == ends and [x.next for x in r.t] == nexts


def test_parents_in_well_nested_pages(spark):
    rng = random.Random(4)

    def element(depth):
        inner = "".join(element(depth + 1) if depth < 6 and rng.random() < 0.6 else rng.choice(["t", "<br>"]) for _ in range(rng.randrange(4)))
        tag = rng.choice(["div", "ul", "span", "b"])
        return f"<{tag}>{inner}</{tag}>"

    pages = ["".join(element(0) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, h string").select("i", H.html_tokens(F.col("h")).alias("t")).select("i", "t", H.parents(F.col("t")).alias("p")).collect()
    for r in got:
        stack, want = [], []
        for t in r.t:
            if t.tag and t.close:
                stack.pop()
            want.append(stack[-1] if stack else -1)
            if t.tag and not t.close and t.tag not in H.VOID_TAGS:
                stack.append(t.pos)
        assert r.p == want


def test_large_pages_cost_their_size(spark):
    def seconds(n):
        rows = "".join(f'<div class="photo item"><h3>Amenities</h3><ul><li>item {k}</li></ul><span>Rent:</span><span>${k}</span><a href="/x{k}"><img src="/p{k}.jpg"></a></div>' for k in range(n))
        df = spark.createDataFrame([(f'<div id="photoDiv"><figure>{rows}</figure></div>',)], "h string").repartition(1).select(H.html_tokens(F.col("h")).alias("t"))
        t = F.col("t")
        read = df.select(F.size(H.photos_from_html(t)).alias("a"), F.size(H.photos_of_details(t)).alias("b"), F.size(H.section_items(t, "^amenities$")).alias("c"), F.size(H.label_value_grid(t)).alias("d"))
        started = time.time()
        r = read.first()
        assert r.a == r.b == 2 * n and r.c == 1 and r.d == n
        return time.time() - started

    seconds(50)
    small, large = seconds(600), seconds(2400)
    assert large < 6 * small + 2, (small, large)


def test_galleries(spark):
    page = """<div class="similar"><div id="photoDiv"><img src="/foreign.jpg"></div></div><div class="roomimageblock"><figure><a href="https://img.example.com/store/big.jpg"><img src="/1.jpg" itemprop="photo"></a></figure>
    <a href="https://img.example.com/store/more.jpg">4 more</a><img src="/outside-figure.jpg"><img src="/spinner.gif"></div><div style="background-image: url('/back.jpg')" class="swiper"></div>
    <div class="fancybox-inner"><img data-src="https://img.example.com/store/viewer.jpg"><img src="/other.jpg"></div><div class="modal show"><img src="https://img.example.com/store/modal.jpg"></div>"""
    store = "https://img.example.com/store/"
    r = tokens_of(spark, page, H.photos_from_html, lambda t: H.photos_of_details(t, SITE.photo_path), H.photos_static, H.photos_of_details)
    assert r.c0 == ["/1.jpg", store + "big.jpg", "/outside-figure.jpg", "/spinner.gif"]
    # the site's block is taken by its id even inside a foreign section
    assert r.c1 == [store + "viewer.jpg", store + "modal.jpg"]
    assert [x.url for x in r.c2] == ["/1.jpg", "/outside-figure.jpg", "/spinner.gif"]
    assert r.c3 == []
    own = page.replace('<div class="similar"><div id="photoDiv"><img src="/foreign.jpg"></div></div>', "")
    r = tokens_of(spark, own, lambda t: H.photos_of_details(t, SITE.photo_path), H.photos_of_details)
    assert r.c0 == ["/1.jpg", store + "big.jpg", store + "more.jpg", store + "viewer.jpg", store + "modal.jpg"]
    assert r.c1 == ["/1.jpg", store + "big.jpg"]
    other = '<div class="nearby-listing gallery"><img src="/n.jpg"></div><div class="gallery"><img src="/icon.png"></div><div class="carousel"><img data-lazy-src="/c.jpg"></div>'
    r = tokens_of(spark, other, H.photos_of_details, H.photos_from_html)
    assert r.c0 == ["/c.jpg"] and r.c1 == ["/c.jpg"]


def detail_inputs(spark):
    html = """<html><head><script type="application/ld+json">{"name":"ld","title":"ld title","image":["https://img.example.com/ld.jpg"]}</script>
<script>var s={"ad":{"title":"embedded","beds":2,"buildingInfo":{"name":"E","floors":3}}};</script><script>window.__FIREBASE_DATA__ = {"ad":{"title":"firebase","baths":"1"}};</script>
<script>window.__INITIAL_STATE__ = {"ad":{"rent":900,"location":{"zip":"77004","city":"Old"},"buildingInfo":"none"}}; </script></head>
<body><h1>Page title</h1><div class="description">First line of the printed text<br>and its second line, as it stands.</div><p>Posted by: Ann</p>
<div class="amenity">Pool</div><div class="gallery"><img src="/g.jpg"></div></body></html>"""
    pages = [(1, "https://ads.example.com/x_rentals_y_11", html), (2, "https://ads.example.com/x_rentals_y_12", "<h1>Bare</h1>"), (3, "https://ads.example.com/x_rentals_y_13", None)]
    bodies = [
        (1, "https://api.example.com/a", "application/json", 5, '{"ad":{"title":"api late","location":{"city":"New","state":"TX"}}}'),
        (1, "https://api.example.com/b", "application/json", 3, '{"ad":{"title":"api early","deposit":"50"}}'),
        (1, "https://api.example.com/a", "application/json", 9, '{"ad":{"title":"second call of the same url"}}'),
        (2, "https://api.example.com/a", "application/json", 1, '{"data":{"title":"flat","description":"one line","photos":["/j.jpg"],"amenities":["Gym"]}}'),
        (4, "https://api.example.com/a", "application/json", 1, '{"ad":{"title":"no such page"}}'),
    ]
    return (
        spark.createDataFrame(pages, "page_id long, url string, html string"),
        spark.createDataFrame(bodies, "page_id long, url string, content_type string, arrival long, body string"),
    )


def test_detail_pages_take_each_field_from_the_strongest_source(spark):
    pages, bodies = detail_inputs(spark)
    rows = {r.ad_id: r for r in D.extract_detail_pages(pages, bodies, SITE, scraped_at=F.expr("timestamp_ntz '2026-06-01 00:00:00'")).collect()}
    assert sorted(rows) == ["11", "12", "13"]
    r = rows["11"]
    assert (r.property.title, r.property.beds, r.property.rent_amount, r.property.deposit, r.property.baths) == ("api late", "2", "900", "50", "1")
    assert (r.location.city, r.location.state, r.location.zip_code) == ("Old", "TX", "77004")  # the page state is stronger than bodies
    assert json.loads(r.location.raw_location) == {"city": "Old", "state": "TX", "zip": "77004"}
    assert r.property.building_name is None  # a scalar of a stronger source hides the object below it
    assert r.description.full_description == "First line of the printed text\nand its second line, as it stands."
    assert r.poster.display_name == "Ann" and r.amenities == {"pool": "true"}
    assert [p.url for p in r.photos] == ["/g.jpg", "https://img.example.com/ld.jpg"] and [p["index"] for p in r.photos] == [0, 1]
    assert r.details.title == "Page title" and r.details.ad_id == "11"
    flat = rows["12"]
    assert (flat.property.title, flat.description.full_description, [p.url for p in flat.photos], flat.amenities) == ("flat", "one line", ["/j.jpg"], {"gym": "true"})
    assert rows["13"].property.title is None and rows["13"].photos == []


def test_locations_are_enriched_only_where_something_is_missing(spark):
    schema = "ad_id int, location struct<zip_code string, country_code string, city string, state string, latitude string, longitude string, locality string, metro_area string, district string>"
    ads = [
        (1, ("10001", None, None, None, None, None, None, None, None)), (2, ("10001", "us", "Mine", None, "1.5", None, "Here", "M", None)), (3, ("99999", "US", None, None, None, None, None, None, None)),
        (4, ("K1A", "CA", None, None, None, None, None, None, None)), (5, (None, None, "Town", None, None, None, None, None, None)), (6, ("00000", "US", "T", None, None, None, None, None, None)), (7, None),
    ]
    zips = spark.createDataFrame([("10001", "Big", "Kings", "NY", 40.5, -74.0, None)], "zip string, city string, county string, state_code string, lat double, lng double, raw_msa string")
    geo = "struct<lat double, lng double, city string, locality string, sub_locality string, district string, state string, state_code string, country string, country_code string, zip_code string, formatted_address string>"
    one = lambda **k: tuple(k.get(f) for f in G.GEO_FIELDS)
    first = spark.createDataFrame([("99999", "US", one(lat=1.0, lng=2.0, city="Far", locality="Quarter", country_code="US")), ("10001", "US", one(city="not asked"))], f"zip string, country_code string, geo {geo}")
    second = spark.createDataFrame([("K1A", "ca", one(lat=5.0, lng=6.0, city="North", country_code="CA")), ("99999", "US", one(city="too late"))], f"zip string, country_code string, geo {geo}")
    places = spark.createDataFrame([(40.5, -74.0, "Village"), (5.0, 6.0, "")], "lat double, lng double, locality string")
    metros = spark.createDataFrame([("10001", "Metro One"), ("K1A", "never"), ("99999", "Metro Far")], "zip string, msa string")
    tables = D.GeoTables(zips, (first, second), places, metros)
    got = {r.ad_id: r.location for r in D.enrich_location(spark.createDataFrame(ads, schema), tables).collect()}
    assert len(got) == len(ads)
    assert tuple(got[1]) == ("10001", "US", "Big", "New York", "40.5", "-74.0", "Village", "Metro One", "Kings County")
    assert tuple(got[2]) == ("10001", "us", "Mine", "New York", "1.5", "-74.0", "Here", "M", "Kings County")
    assert (got[3].city, got[3].locality, got[3].metro_area) == ("Far", "Quarter", "Metro Far")
    assert (got[4].city, got[4].locality, got[4].metro_area) == ("North", "North", None)
    assert tuple(got[5]) == ads[4][1] and tuple(got[6]) == ads[5][1] and got[7] is None


@pytest.mark.parametrize("page", ["", "no markup", "<", "<p", "<div><div>", "</p></p>", "<img src=x><a href=y><img></a>"])
def test_odd_pages(spark, page):
    r = tokens_of(spark, page, H.photos_from_html, H.photos_of_details, H.photos_static, H.neighborhood_links, H.amenity_labels, H.parents)
    assert r.c0 is not None and r.c3 == [] and r.c4 == []


def test_stream_of_pages_and_late_bodies_equals_the_batch_over_batches_and_a_restart(spark):
    pages, bodies = detail_inputs(spark)
    pages = pages.withColumn("captured_at", F.expr("timestamp '2026-01-01 00:00:00' + page_id * interval '1' hour"))
    late = F.when((F.col("page_id") == 1) & (F.col("arrival") == 3), F.expr("interval '20' minute")).otherwise(F.expr("interval '1' minute"))
    bodies = bodies.where("page_id < 4").withColumn("received_at", F.expr("timestamp '2026-01-01 00:00:00' + page_id * interval '1' hour") + late)
    end = spark.sql("SELECT CAST(-1 AS BIGINT) AS page_id, 'end' AS url, '' AS html, timestamp '2030-01-01 00:00:00' AS captured_at")
    last = spark.sql("SELECT CAST(-1 AS BIGINT) AS page_id, 'end' AS url, 'text/plain' AS content_type, CAST(0 AS BIGINT) AS arrival, 'end' AS body, timestamp '2030-01-01 00:00:00' AS received_at")
    folder = new_table_path(spark, "late")
    sink = folder + "/out"
    seen = []
    for put_pages, put_bodies in ((pages.where("page_id <= 2"), bodies.where("arrival <> 3")), (pages.where("page_id > 2"), bodies.where("arrival = 3")), (end, last)):
        put_pages.coalesce(1).write.mode("append").parquet(folder + "/pages")
        put_bodies.coalesce(1).write.mode("append").parquet(folder + "/bodies")
        joined = X.join_bodies(X.file_stream(spark, folder + "/pages", pages.schema, files_per_batch=1), X.file_stream(spark, folder + "/bodies", bodies.schema, files_per_batch=1), "30 minutes", "'5' MINUTE")
        X.append_to_files(joined, sink, folder + "/checkpoint")
        seen.append(spark.read.schema(joined.schema).parquet(sink).count())
    assert seen[-1] == 3 and seen[0] < 3  # pages wait for their bodies, over restarts
    got = {r.page_id: [(b.arrival, b.body) for b in r.bodies] for r in spark.read.schema(joined.schema).parquet(sink).collect()}
    in_time = bodies.where("received_at <= timestamp '2026-01-01 00:00:00' + page_id * interval '1' hour + interval '5' minute")
    want = {r.page_id: [(b.arrival, b.body) for b in r.bodies] for r in D.bodies_per_page(in_time.drop("received_at")).collect()}
    assert got == {1: want[1], 2: want[2], 3: []} and [a for a, _ in got[1]] == [5]  # the body that came after twenty minutes is too late
