"""Work that costs more than its bytes: it stays behind the dealing of short rows, in many tasks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from adloom.functions import html as H
from adloom.functions.urls import SiteProfile
from adloom.operators import crawl
from adloom.sources import tables as S

SITE = SiteProfile(domain="ads.example.com")


@pytest.mark.parametrize("key", ["embedded_listing_links", "fallback_listing_links"])
def test_no_filter_reads_markup_before_rows_are_dealt(spark, tmp_path, key):
    spark.range(50).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    plan = entry.queries()[key](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan
    assert "__NEXT_DATA__" not in plan[plan.rindex("Repartition"):]


def test_joined_rows_are_dealt_out_however_short(spark):
    a = spark.range(1000)
    joined = a.join(a.groupBy("id").count(), "id", "left")
    out = S.dealt(joined).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in out) == 1000 and len(out) > spark.sparkContext.defaultParallelism


def test_exported_documents_are_compressed_and_read_back(spark, tmp_path):
    docs = spark.range(500).select(F.col("id"), F.struct(F.lit("a title that all share").alias("title"), F.col("id").alias("n")).alias("details")).coalesce(1)
    S.export_documents(docs, f"{tmp_path}/out")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/out/part-*"))
    assert size * 3 < sum(len(r["value"]) for r in docs.select(F.to_json(F.struct("*")).alias("value")).collect())
    assert sorted(map(tuple, spark.read.schema(docs.schema).json(f"{tmp_path}/out").collect())) == sorted(map(tuple, docs.collect()))


def test_link_table_takes_the_least_page_of_an_address_and_shuffles_no_markup(spark):
    def page(k):
        return f'<a href="/flat_rentals_town-nj_{k}">x</a>'

    rows = [(3, "https://ads.example.com/rentals/a", page(3)), (2, "https://ads.example.com/rentals/a/", page(2)), (None, "https://ads.example.com/rentals/a", page(1)),
            (None, "https://ads.example.com/rentals/b", page(4)), (5, None, page(5))]
    links = crawl.link_table(spark.createDataFrame(rows, "page_id long, url string, html string"), SITE).collect()
    assert [(r["page_key"], r["page_id"], [x["url"] for x in r["links"] if x["label"] == "DETAIL"]) for r in links] == [
        ("https://ads.example.com/rentals/a", 2, ["https://ads.example.com/flat_rentals_town-nj_2"])]


def test_only_tags_that_match_are_kept_with_their_selectors(spark):
    page = '<p>a</p><table><tr><td class=info>b</td></tr></table><div class="x meta info">c</div></div class="info"><div id="q">d</div>'
    tokens = spark.createDataFrame([(page,)], "html string").select(H.html_tokens(F.col("html")).alias("t"))
    hits = tokens.select(H._hits(F.col("t"), [("class*", "info"), ("tag", "table"), ("class", "meta"), ("id", "q")]).alias("h")).first()["h"]
    assert [(x["token"]["tag"], x["kinds"]) for x in hits] == [("table", [1]), ("td", [0]), ("div", [0, 2]), ("div", [3])]
