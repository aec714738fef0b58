"""A whole crawl over captured pages: rounds of new pages until nothing new is reached.

Links are read from the HTML once. After that a round joins only what is new with the link table, drops what earlier rounds know, and is
written; the driver asks whether a round is empty and holds no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.functions import urls as U
from adloom.operators.frontier import frontier_limit, listing_pages
from adloom.operators.geo import look_up
from adloom.operators.ranking import first_per_key
from adloom.session import checkpointed, new_table_path, settled
from adloom.sources.tables import seed_frontier

REACHED = "label STRING, page INT, url STRING, page_key STRING, ad_id STRING, captured BOOLEAN, round INT"


def link_table(pages: DataFrame, site: U.SiteProfile) -> DataFrame:
    """`page_key, page_id, links`: per captured address (the least page id counts) its links `{label, pos, url}` in page order: the ads,
    and the next page or, without one, every listing link."""
    keyed = pages.withColumn("page_key", U.normalize_url(F.col("url"), site))
    read = listing_pages(keyed.withColumn("every", U.resolve_all(H.hrefs(F.col("html")), F.col("url"))), site)
    same = F.coalesce(F.col("next_url") == F.col("url"), F.lit(False))
    following = F.when(F.col("next_url").isNotNull() & ~same, F.array("next_url")).otherwise(F.filter(F.array_distinct("every"), lambda u: U.is_listing_url(u, site)))

    def links(urls: Column, label: str) -> Column:
        return F.transform(urls, lambda u, i: F.struct(F.lit(label).alias("label"), i.cast("int").alias("pos"), u.alias("url")))

    # pages are read where they lie: only links are brought together, never markup
    told = settled(read.select("page_key", "page_id", F.concat(links(F.col("detail_urls"), "DETAIL"), links(following, "LISTING")).alias("links")))
    return checkpointed(first_per_key(told.where("page_key IS NOT NULL AND page_id IS NOT NULL"), ["page_key"], ["page_id"]))


def crawl_rounds(pages: DataFrame, starts: DataFrame, site: U.SiteProfile, max_pages: int = 0, max_items: int = 0, max_rounds: int = 0) -> DataFrame:
    """`round, label, page, url, page_key, ad_id, captured`: everything that a crawl over `pages` (`page_id, url, html`) reaches from `starts` (`url`).

    Round 0 holds the starts. Each round, listing pages of the round before are looked up among the captured pages; their links that no
    earlier round reached, by normalized address or by ad, are the next round. `page` counts along the pagination; of several ways to an
    address in one round the one with the least page, then the least parent address and position, counts. `captured` tells whether there is a page to go on from.
    `max_pages` ends pagination there; `max_items` keeps the first ads in order of round, page, address and stops paging in the round that
    reaches it; `max_rounds` bounds the rounds. 0 means no limit. Starts that are NULL or no URL are ignored; without starts or
    pages the result has no further rounds. Each round is one table; an ad linked from everywhere collapses on the map side.
    """
    spark, links = pages.sparkSession, link_table(pages, site)
    path, number, n_ads = new_table_path(spark, "crawl"), 0, 0
    starts = seed_frontier(starts, site).where(U.is_absolute(F.col("url")))
    first = starts.withColumns({"page_key": U.normalize_url(F.col("url"), site), "ad_id": F.when(F.col("label") == "DETAIL", U.ad_id_from_url(F.col("url"), site))})
    _write_round(_once(first.withColumns({"parent": F.lit(""), "pos": F.lit(0)})), links, path, number)
    while True:
        reached = spark.read.schema(REACHED).parquet(path)  # all rounds so far, one folder each
        latest = reached.where(F.col("round") == number)
        n_ads += latest.where("label = 'DETAIL'").count() if max_items else 0
        done = (max_rounds and number >= max_rounds) or (max_items and n_ads >= max_items)
        going = latest.where("label = 'LISTING' AND captured")
        if done or going.isEmpty():
            break
        found = _followed(going, links, site)
        if max_pages:
            found = found.where((F.col("label") == "DETAIL") | (F.col("page") <= max_pages))
        fresh = _unseen(_once(found), reached)
        number += 1
        _write_round(fresh, links, path, number)
    if not max_items:
        return reached
    ads = frontier_limit(reached.where("label = 'DETAIL'"), ["round", "page", "page_key"], max_items)
    return reached.where("label <> 'DETAIL'").unionByName(ads)


def _followed(going: DataFrame, links: DataFrame, site: U.SiteProfile) -> DataFrame:
    met = going.select("page_key", "page").join(links, "page_key").select("page", F.col("page_key").alias("parent"), F.explode("links").alias("l"))
    url, is_ad = F.col("l.url"), F.col("l.label") == "DETAIL"
    return met.select(
        F.col("l.label").alias("label"), F.when(is_ad, F.col("page")).otherwise(F.col("page") + 1).alias("page"), url.alias("url"),
        U.normalize_url(url, site).alias("page_key"), F.when(is_ad, U.ad_id_from_url(url, site)).alias("ad_id"), "parent", F.col("l.pos").alias("pos"),
    )


def _unseen(found: DataFrame, reached: DataFrame) -> DataFrame:
    fresh = found.join(reached.select("page_key"), "page_key", "left_anti")
    known_ads = reached.where(F.col("ad_id").isNotNull()).select("ad_id")
    return look_up(fresh, known_ads, ["ad_id"], "left_anti").select(*found.columns)


def _once(found: DataFrame) -> DataFrame:
    """One row per address, then one per ad: the first in order of page, parent and position."""
    order = ["page", "parent", "pos", "url"]
    by_key = first_per_key(found, ["page_key"], order)
    identity = F.coalesce(F.concat(F.lit("ad "), "ad_id"), F.concat(F.lit("page "), "page_key"))
    return first_per_key(by_key.withColumn("identity", identity), ["identity"], order).drop("identity")


def _write_round(found: DataFrame, links: DataFrame, path: str, number: int) -> None:
    held = links.select("page_key", F.lit(True).alias("captured"))
    marked = found.join(held, "page_key", "left").withColumn("captured", F.coalesce("captured", F.lit(False)))
    marked.select("label", "page", "url", "page_key", "ad_id", "captured").write.parquet(f"{path}/round={number}")
