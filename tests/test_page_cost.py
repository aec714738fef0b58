"""What keeps reading pages cheap: one pass for tokens, attributes computed once, short rows dealt out before they become pages."""

from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.plans import pages
from adloom.sources import fixtures


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_an_attribute_is_looked_up_once(spark):
    df = spark.createDataFrame([('<meta property="og:title" content="A &amp; B"><meta content="">',), (None,)], "html string").select(H.html_tokens(F.col("html")).alias("tokens"))
    got = df.select(H.select_attr(F.col("tokens"), [("attr:property", "og:title")], "content").alias("title"))
    assert [r.title for r in got.collect()] == ["A & B", None]
    assert optimized(got).count("content\\s*=") == 1


def test_rows_are_dealt_out_before_they_grow_into_pages(spark, tmp_path):
    parts = [(i, f"part {i}", "Brand", "SMALL", i, 1.5 * i) for i in range(40)] + [(7, "part 7", "Brand", "SMALL", 7, 9.0), (None, None, None, None, None, None)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    dealt = pages.html_pages(spark, str(tmp_path))
    below = optimized(dealt).split("RepartitionByExpression", 1)[1]
    assert "<html>" not in below and dealt.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert sorted(map(str, dealt.collect())) == sorted(map(str, fixtures.fixture(spark, str(tmp_path), "f_html").collect()))


def test_ends_of_odd_elements(spark):
    page = "</div><div><DIV class=x>a</div><br></br><p>b<p>c</div><a/></>1 < 2 &#x41;&#xD800;<i"
    rows = spark.createDataFrame([(page,), ("",), (None,)], "html string").select(H.html_tokens(F.col("html")).alias("t")).collect()
    got = [(t.tag, t.close, t.end, t.next, t.text) for t in rows[0].t]
    n = len(got)
    assert got[:7] == [
        ("div", True, 0, 1, None), ("div", False, 11, 2, None), ("div", False, 4, 4, None), (None, False, 3, 4, "a"), ("div", True, 4, 5, None), ("br", False, 5, 6, None), ("br", True, 6, 7, None),
    ]
    assert got[7:12] == [("p", False, 9, 9, None), (None, False, 8, 9, "b"), ("p", False, n, 11, None), (None, False, 10, 11, "c"), ("div", True, 11, 12, None)]
    assert "".join(t.text for t in rows[0].t if t.text) == "abc</>1 < 2 A&#xD800;<i"
    assert rows[1].t == [] and rows[2].t is None


def test_spans_of_marked_elements(spark):
    page = "<ul><li><b>x</b></li></ul><p>y</p>"
    df = spark.createDataFrame([(page,)], "html string").select(H.html_tokens(F.col("html")).alias("t"))
    marked = F.transform("t", lambda t: H.matches(t, ("tag", "li")))
    assert df.select(H.covered(F.col("t"), marked)).first()[0] == [i in (1, 2, 3, 4) for i in range(10)]
    assert df.select(H.covered(F.col("t"), marked, itself=False)).first()[0] == [i in (2, 3, 4) for i in range(10)]
