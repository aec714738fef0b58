"""Readers that look at what stands where find what those find that pass over all tokens."""

import pyarrow as pa
from pyspark.sql import functions as F

from adloom.functions import html as H

ODD = (
    '<div class="a&#45;card" id=x> ﻿Overview   </div></p class=c><!-- <b>no</b> --><h2>Amenities</h2><ul><li>Gym</li></ul>1 < 2 </><br class="heading">Rent:'
    '</i></i></i></i></i></i></i></i></i></b></span><span>$5</span>'
)
SHOWN = (
    '<h1>T</h1><div class="neighborhoods"><a href="/x">Mid</a><a>Old</a></div><a>out</a><div id="photo&#68;iv"><figure><img itemprop="photo" src="/1.jpg"></figure>'
    '<div class="related"><img src="/2.jpg"></div></div><div class="swiper"><a href="/l.jpg"><img src="/3.jpg"></a><p class=similar><img src="/4.jpg"></p></div>'
)


def pages(spark, *html):
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(html)], "i int, html string")
    return rows.select("i", H.outlined_tokens(F.col("html")).alias("page"), H.html_tokens(F.col("html")).alias("t")).select("i", "t", "page.tokens", "page.outline")


def test_outline_lists_what_stands_where(spark):
    found = H.Outline(F.col("t"))
    own = F.struct(found.names.alias("names"), found.styled.alias("styled"), found.marked.alias("marked"), found.texts.alias("texts"))
    got = pages(spark, ODD, SHOWN, "", None, "  ", "x \u0085 ", " ").select("t", "tokens", "outline", own.alias("own")).collect()
    assert [(r.t, r.outline) for r in got if r.t is not None] == [(r.tokens, r.own) for r in got if r.t is not None]
    assert got[3].tokens is None and [x.text for x in got[0].outline.texts][:2] == ["Overview ", "Amenities"]


def test_readers_agree_with_and_without_outline(spark):
    t, o = F.col("t"), F.col("outline")
    df = pages(spark, ODD, SHOWN, "", None)
    pairs = [
        (H.label_value_grid(t), H.label_value_grid(t, o)),
        (H.section_items(t, "^amenities$"), H.section_items(t, "^amenities$", H.section_headings(t, o))),
        (H.neighborhood_links(t), H.neighborhood_links(t, o)),
        (H.photos_of_details(t), H.photos_of_details(t, "", o)),
        (H.select_text(t, [("tag", "h1"), ("class*", "card")]), H.select_text(t, [("tag", "h1"), ("class*", "card")], outline=o)),
    ]
    got = df.select([c.alias(f"c{i}") for i, c in enumerate(c for pair in pairs for c in pair)]).collect()
    assert all(r[i] == r[i + 1] for r in got for i in range(0, 10, 2))
    # the ninth closing tag after a label lies beyond the first look; links count inside their block only
    assert [(x.field, x.value) for x in got[0].c0] == [("rent", "$5")] and got[0].c2 == ["Gym"] and got[1].c4 == ["Mid", "Old"]


IMAGES = (
    '<a href=" /big.jpg "><img SRC="/1.jpg" alt="" width="079" height=abc></a><img src="" data-src=\'/2&amp;.jpg\' width="80px">', '<a href="#x"><img data-lazy-src=/3.jpg alt="a &#65; b"/><a><img></a>',
    '<a HREF="javascript:x"><img  src = "/4.jpg" src="/5.jpg" width="0" height="00000000000000007"></a><img src=/6.jpg width=99999999999999999999 data-original="/7.jpg"></img>',
    '<a class="b" href="/8 "><p><IMG src="/9.jpg" İsrc="/x.jpg"><img data-src src="it\'s"></p>', '<img src="/10.jpg" width="12 px" height="-5"><a name=href><img src></a>', "<p>none</p>", "", None,
)


def test_images_are_listed_like_those_found_among_the_tokens(spark):
    t = F.col("t")
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(IMAGES)], "i int, html string").select("i", H.outlined_tokens(F.col("html")).alias("page"), H.html_tokens(F.col("html")).alias("t"))
    got = rows.select("i", "page.images", H.images(t).alias("found"), H.photos_static(t).alias("a"), H.photos_static(t, F.col("page.outline"), F.col("page.images")).alias("b")).orderBy("i").collect()
    assert [r.images for r in got] == [r.found for r in got] and [r.a for r in got] == [r.b for r in got]
    assert [(x.source, x.alt, x.tiny, x.href) for x in got[0].images] == [("/1.jpg", "", True, "/big.jpg"), ("/2&.jpg", None, False, None)]
    assert got[7].images is None and got[6].images == [] and [x.tiny for x in got[2].images] == [True, False]


def test_a_batch_of_pages_comes_back_in_parts():
    page, pages = H._tokenizer(outlined=True).func, [SHOWN * 1000, None, ODD] * 8
    parts = list(page(iter([pa.array(pages), pa.array([], pa.string()), pa.array(["<p>"])])))
    assert [len(p) for p in parts][-1] == 1 and len(parts) > 2 and sum(map(len, parts)) == len(pages) + 1
    assert pa.concat_arrays(parts).to_pylist() == [next(page(iter([pa.array([h], pa.string())]))).to_pylist()[0] for h in [*pages, "<p>"]]
