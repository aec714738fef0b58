"""Keyed state across runs: seen ads, one row per ad, upserts into a store of hash buckets.

Both sides of an upsert are first reduced to one row per ad with map-side combine. That leaves them
hash partitioned by ad, so the full outer join needs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.text import null_if_empty
from adloom.operators.ranking import first_n, first_per_key
from adloom.session import checkpointed
from adloom.sources import tables as S

SCRAPE_ORDER = ["scraped_at", "run_seq", "pos", "payload", "url"]
SEEN_SCHEMA = "ad_id BIGINT"


def skip_seen(ads: DataFrame, seen: DataFrame) -> DataFrame:
    """Ads of no earlier run. Comes before the extraction, which only new pages then pay for."""
    return ads.join(seen.select("ad_id").distinct(), "ad_id", "left_anti")


def mark_seen(seen: DataFrame, ads: DataFrame) -> DataFrame:
    return seen.select("ad_id").union(ads.select("ad_id")).where("ad_id IS NOT NULL").distinct()


def dedup_by_ad(ads: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per ad: the first in scrape order."""
    return first_per_key(ads, ["ad_id"], order or SCRAPE_ORDER)


def latest_by_ad(ads: DataFrame, order: list[str] | None = None) -> DataFrame:
    return first_per_key(ads, ["ad_id"], order or SCRAPE_ORDER, latest=True)


def save_cap(ads: DataFrame, max_items: int, order: list[str] | None = None) -> DataFrame:
    return first_n(ads, order or SCRAPE_ORDER, max_items)


def _complete(side: str) -> Column:
    """Does a stored document have coordinates, locality and metro?"""
    return (
        F.col(f"{side}.lat").isNotNull()
        & null_if_empty(F.col(f"{side}.locality")).isNotNull()
        & null_if_empty(F.col(f"{side}.metro")).isNotNull()
    )


def _outer(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    rest = [c for c in stored.columns if c != "ad_id"]
    old = stored.select("ad_id", F.struct(*rest).alias("old"))
    new = fresh.select("ad_id", F.struct(*rest).alias("new"))
    return old.join(new, "ad_id", "full_outer")


def upsert_refresh(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The new snapshot: fresh rows replace stored ones, but a complete stored document keeps its metro."""
    rest = [c for c in stored.columns if c != "ad_id"]
    kept_metro = F.when(F.coalesce(_complete("old"), F.lit(False)), F.col("old.metro")).otherwise(F.col("new.metro"))
    is_new = F.col("new").isNotNull()
    joined = _outer(stored, fresh)
    return joined.select(
        "ad_id",
        *[
            F.when(is_new, kept_metro if f == "metro" else F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f)
            for f in rest
        ],
    )


def upsert_geo_only(stored: DataFrame, fresh: DataFrame, geo: tuple[str, ...] = ("lat", "locality", "metro")) -> DataFrame:
    """Retired rule: new ads are inserted, complete ones stay, of the others only geo columns are updated."""
    rest = [c for c in stored.columns if c != "ad_id"]
    joined = _outer(stored, fresh)
    insert = F.col("old").isNull()
    patch = F.col("new").isNotNull() & ~F.coalesce(_complete("old"), F.lit(False))

    def pick(f: str) -> Column:
        take_new = insert | patch if f in geo else insert
        return F.when(take_new, F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f)

    return joined.select("ad_id", *[pick(f) for f in rest])


# ---- the ad store: rows in hash buckets of their ad ------------------------------------------

BUCKETS = 64


def _bucket(n: int) -> Column:
    return F.pmod(F.hash("ad_id"), F.lit(n)).alias("bucket")


def read_ads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All ads of the store at `path`, or an empty table."""
    if not S.has_files(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, bucket INT").parquet(f"{path}/data").drop("bucket")


def upsert_ads(spark: SparkSession, path: str, fresh: DataFrame, schema: str, version: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Upsert into the store at `path` by the rule of `upsert_refresh`; returns the store.

    The store is partitioned by a hash of the ad. Only the buckets that `fresh` touches are read, merged into a staging table, and then
    put in place by Spark's dynamic partition overwrite, so a batch costs the buckets it touches, not the store. `buckets` is fixed when
    the store is made; choose it so that a bucket is some hundred MB.

    With `version` given (a stream's batch id), a replay finds its complete staging table and only puts it in place again; a batch that
    died before its staging table was complete has not touched the store. Versions must come in order; the staging tables of all but the latest
    two are emptied. Rows of `fresh` without an ad id are kept out of the store.
    """
    number = version if version is not None else S.next_version(spark, f"{path}/staging")
    staged = f"{path}/staging/v={number}"
    if not S.is_complete(spark, staged):
        latest = checkpointed(latest_by_ad(fresh.where(F.col("ad_id").isNotNull())).withColumn("bucket", _bucket(buckets)))
        # at most as many rows as there are buckets
        touched = [r.bucket for r in latest.select("bucket").distinct().collect()]
        names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
        if S.has_files(spark, f"{path}/data"):
            stored = spark.read.schema(f"{schema}, bucket INT").parquet(f"{path}/data").where(F.col("bucket").isin(touched)).select(*names)
        else:
            stored = spark.createDataFrame([], schema)
        merged = upsert_refresh(stored, latest.select(*names)).withColumn("bucket", _bucket(buckets))
        merged.write.mode("overwrite").parquet(staged)
    ready = spark.read.schema(f"{schema}, bucket INT").parquet(staged)
    ready.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/data")
    S.empty_version(spark, f"{path}/staging", number - 2)
    return read_ads(spark, path, schema)


def load_seen(spark: SparkSession, path: str) -> DataFrame:
    return S.read_snapshot(spark, path, SEEN_SCHEMA)


def save_seen(seen: DataFrame, path: str) -> int:
    return S.write_snapshot(seen, path)
