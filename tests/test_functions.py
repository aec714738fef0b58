"""Worked examples, one value at a time."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions import normalize as N
from adloom.functions import pagetext as P
from adloom.functions import text as T
from adloom.functions import urls as U
from adloom.functions import vocab
from adloom.functions.address import with_parsed_address

SITE = U.SiteProfile(domain="ads.example.com")


def values(spark, make, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.v for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").collect()]


def of_tokens(spark, make, pages):
    """Readers get their tokens as a column, as in a job."""
    df = spark.createDataFrame(list(enumerate(pages)), "i int, x string").select("i", H.html_tokens(F.col("x")).alias("t"))
    return [r.v for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def check(spark, make, table):
    assert values(spark, make, list(table)) == list(table.values())


def test_urls(spark):
    base = "https://ads.example.com"
    check(spark, lambda u: U.ad_id_from_url(u, SITE), {
        base + "/1-bed-room-basement-apt_rentals_ashburn-va_2027510": "2027510", base + "/x_12/": "12", base + "/about": None, "no url": None, None: None})
    check(spark, lambda u: U.is_detail_url(u, SITE), {base + "/a_rentals_b-nj_1": True, base + "/a/b_rentals_b-nj_1": False, "x": False})
    check(spark, lambda u: U.normalize_url(u, SITE), {
        "HTTPS://Ads.Example.com/A/?q=1#f": "https://ads.example.com/A", base + "/rentals?page=2&x=1": base + "/rentals?page=2",
        "nonsense": "nonsense", base + "/café": base + "/caf%C3%A9"})
    check(spark, lambda u: U.is_listing_url(u, SITE), {base + "/rentals": True, base + "/rentals/x": True, base + "/x?page=3": True, "https://other.net/rentals": False, base + "/y": False})
    check(spark, lambda u: U.page_url(u, F.lit(3)), {base + "/r?page=2&a=1": base + "/r?page=3&a=1", base + "/r#t": base + "/r?page=3#t", base + "/r?a=1": base + "/r?a=1&page=3"})
    check(spark, lambda u: U.resolve_url(u, F.lit(base + "/a/b?q#f")), {
        "c": base + "/a/c", "../c": base + "/c", "/c/../d": base + "/d", "?z": base + "/a/b?z", "//h.net": "https://h.net/", "javascript:void(0)": None, " /c ": base + "/c"})


def test_normalize_url_is_idempotent(spark):
    urls = ["https://a.net/x/?page=2", "http://A.net:80/", "https://ads.example.com/rentals/?page=4", "mailto:x@y.z", "https://a.net/éè/#x"]
    once = values(spark, lambda u: U.normalize_url(u, SITE), urls)
    assert values(spark, lambda u: U.normalize_url(u, SITE), once) == once


def test_rent(spark):
    d = Decimal
    got = values(spark, N.parse_rent, ["$850 /Month", "₹15,000/month", "£90 per week", "call", None])
    assert [tuple(x) if x else None for x in got] == [(d("850.00"), "USD", "per_month"), (d("15000.00"), "INR", "per_month"), (d("90.00"), "GBP", "per_week"), None, None]
    check(spark, N.rent_from_text, {
        "EXPECTED RENT\n$2,200 /Month\nx": "$2,200 /Month", "rent: $900/month, nice": "$900/month", "only $750 per month": "$750 /Month", "none": None})


def test_dates(spark):
    d = datetime.date
    check(spark, N.posted_date, {"Jun 05, 2026": d(2026, 6, 5), "June 5, 2026": d(2026, 6, 5), "01 Jun 2026": d(2026, 6, 1), "2026-06-05": d(2026, 6, 5), "May 1, 2026": d(2026, 5, 1), "soon": None})
    assert values(spark, lambda x: N.add_one_year(x.cast("date")), ["2024-02-29"]) == [d(2025, 2, 28)]


def test_vocabularies(spark):
    check(spark, lambda x: N.match_option(x, vocab.GENDERS), {"Female only": "Female", "male": "Male", "": None, None: None, "robot": None})
    check(spark, lambda x: N.slug_or_any(x, vocab.SMOKING), {"No Smoking": "no_smoking", "Smoke outside only": "smoke_outside_only", None: "Any", "?": "Any"})
    check(spark, N.expiry_status, {"expiry": "expiry", "expired": "expiry", "no": "active", None: "active"})
    check(spark, N.furnishing, {"Semi Furnished": "semi_furnished", "Furnished with bed": "furnished_with_bed", "Fully furnished": "fully_furnished", None: "unfurnished"})
    check(spark, N.alcohol_flag, {"not allowed": False, "Alcohol is ok": True, "?": None, None: None})
    check(spark, N.yes_no, {"No": "No", "Yes, both": "Yes", "false": "No", None: "Yes"})
    labels = lambda x: F.split(x, r"\|")
    check(spark, lambda x: N.utility_slugs(labels(x)), {"Electric vehicle charging|water heater": ["electricity", "water"], "WiFi|Internet": ["internet_wifi"]})
    check(spark, T.slugify, {"New York  Metro!": "new-york-metro", "--": "", None: ""})
    assert values(spark, lambda x: T.slugify(T.slugify(x)), ["A b/C"]) == ["a-b-c"]


def test_addresses(spark):
    rows = [("3411 Wichita Street, Houston, TX, USA, 77004Houston, TXHarris County View on Map...",), ("Jersey City, NJ, USA, 07302 | Hudson County | x",), ("nowhere",)]
    got = with_parsed_address(spark.createDataFrame(rows, "a string"), "a", "p").select("p.*").collect()
    assert [got[0][f] for f in ("zip_code", "state_code", "state", "city", "county", "country_code")] == ["77004", "TX", "Texas", "Houston", "Harris County", "US"]
    assert [got[1][f] for f in ("zip_code", "state_code", "city", "county")] == ["07302", "NJ", "Jersey City", "Hudson County"]
    assert not any(got[2])


def test_page_text(spark):
    line = "Posted on: Jun 05, 2026 | AD ID: 1565512 | Posted by: Fatima"
    assert tuple(values(spark, P.posted_line, [line])[0]) == ("Jun 05, 2026", "1565512", "Fatima")
    block = "Nice flat.\nAVAILABLE FROM\n01 Jun 2026\nACCOMODATES\n4\nEXPECTED RENT\n$2,200 /Month\nBEDROOMS\n2 Beds\nBATHROOMS\n1 Bath\nAREA\n600 sqft"
    facts = values(spark, P.quick_facts, [block])[0]
    assert (facts.available_from, facts.accommodates, facts.rent, facts.bedrooms, facts.area_sqft) == ("01 Jun 2026", "4", "$2,200 /Month", "2 Beds", "600 sqft")
    check(spark, P.strip_quick_facts, {block: "Nice flat.", "Area is large": "Area is large"})
    check(spark, P.sane_or_null, {"x" * 60: "x" * 60, "x" * 61: None, "  ": None})
    raw = values(spark, lambda x: P.contacts(x, mask=False), ["mail a.b@c.org or (555) 010-2345"])[0]
    assert tuple(raw) == ("(555) 010-2345", "a.b@c.org")


PAGE = """<html><head><title> T </title></head><body><!-- <h1>no</h1> --><h1>Flat &amp; <b>garden</h1><p>one<p>two
<div class="box"><div class="desc-description"><p>A long description of the place.</p><br>More</div></div>
<script>var x = "<h1>no</h1>";</script><p>&#8364;5 &lt;ok&gt; &amp;amp;</p></body></html>"""


def test_tokens(spark):
    assert of_tokens(spark, lambda t: H.select_text(t, [("class", "none"), ("tag", "h1")]), [PAGE]) == ["Flat & garden"]
    assert of_tokens(spark, lambda t: H.select_text(t, [("tag", "p")]), [PAGE]) == ["one"]
    assert of_tokens(spark, H.overview_pick, [PAGE]) == ["A long description of the place.\nMore"]
    check(spark, H.page_title, {PAGE: "T", "<p>": "unknown"})
    assert values(spark, H.page_text, [PAGE])[0].endswith("€5 <ok> &amp;")


def test_gallery(spark):
    page = """<div id="photoDiv"><figure id="mainphoto"><a href="#"><img itemprop="photo" src="/1.jpg"></a></figure>
    <div class="related"><img src="/other.jpg"></div><figure><a href="/full.jpg"><img data-src="/2.jpg"><figcaption>4 more photos</figcaption></a></figure>
    <img src="/logo.png"><img src="/tiny.jpg" width="20"></div><div class="gallery"><img src="/late.jpg"></div>"""
    assert of_tokens(spark, H.photos_from_html, [page])[0] == ["/1.jpg", "/2.jpg", "/full.jpg"]


def test_json(spark):
    text = lambda v: F.to_json(v)
    check(spark, lambda x: text(J.json_safe_parse(x)), {'{"a":1}': '{"a":1}', 'x = {"a":[1]};': '{"a":[1]}', "{oops": None, None: None})
    page = '<script>window.__INITIAL_STATE__ = {"a":1}; </script><script type="application/ld+json">{bad</script><script type="application/ld+json">{"b":2}</script>'
    assert values(spark, lambda x: text(J.json_window_var(x, "__INITIAL_STATE__")), [page]) == ['{"a":1}']
    assert values(spark, lambda x: F.transform(J.json_ld(x), text), [page]) == [['{"b":2}']]
    paths = {'{"props":{"pageProps":{"post":{"x":1}}}}': "$.props.pageProps.post", '{"props":{"pageProps":{"id":4}}}': "$.props.pageProps", '{"data":{"x":1}}': "$.data", '{"x":1}': "$"}
    check(spark, lambda x: J.ad_node_path(F.try_parse_json(x)), paths)


@pytest.mark.parametrize("url,alt,side,rejected", [("https://x/a.jpg", "view", "100", False), ("https://x/icon.png", None, None, True), ("https://x/a.jpg", "Sponsor", None, True), ("https://x/a.jpg", None, "79", True), (None, None, None, True)])
def test_image_reject(spark, url, alt, side, rejected):
    row = spark.createDataFrame([(url, alt, side)], "u string, a string, s string").select(H.image_reject(F.col("u"), F.col("a"), F.col("s")).alias("r")).first()
    assert row.r is rejected
