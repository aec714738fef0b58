"""Run statistics, error log, and validation of documents as expressions over their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.urls import api_endpoint

COUNTERS = [
    "pages_crawled", "ads_found", "ads_enqueued", "ads_scraped", "ads_saved", "ads_failed", "duplicates_skipped",
]


def run_stats(log: DataFrame) -> DataFrame:
    """Per run: one count per kind of event, distinct endpoints, errors. `log(run_id, kind, url)`.

    Endpoints are made distinct by an aggregate of their own, never as a set inside one row.
    """
    counts = log.groupBy("run_id").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in COUNTERS], F.count_if(F.col("kind") == "error").alias("error_count")
    )
    endpoints = endpoint_set(log.where("kind = 'api'"), ["run_id"]).groupBy("run_id").agg(F.count(F.lit(1)).alias("endpoints"))
    return counts.join(endpoints, "run_id", "left").withColumn("endpoints", F.coalesce("endpoints", F.lit(0).cast("bigint")))


def endpoint_set(log: DataFrame, keys: list[str] | None = None, url: str = "url") -> DataFrame:
    """Distinct API endpoints, one per row."""
    return log.select(*(keys or []), api_endpoint(F.col(url)).alias("endpoint")).where("endpoint IS NOT NULL").distinct()


def error_log(log: DataFrame) -> DataFrame:
    """Per URL: attempts that failed, and the last message with its time."""
    errors = log.where("kind = 'error'")
    return (
        errors.groupBy("url")
        .agg(F.count(F.lit(1)).alias("attempts"), F.max(F.struct("ts", "message")).alias("last"))
        .select("url", "attempts", F.col("last.ts").alias("last_ts"), F.col("last.message").alias("last_message"))
    )


def zip_spot_check(zip_dim: DataFrame, zip_msa: DataFrame, wanted: list[str]) -> DataFrame:
    """Coverage over all ZIP codes, then one row per code that should be looked at."""
    joined = zip_dim.select("zip").join(zip_msa, "zip", "left")
    total = joined.agg(F.count(F.lit(1)).alias("n_zips"), F.count("msa").alias("n_mapped"))
    asked = zip_dim.sparkSession.createDataFrame([(z,) for z in wanted], "zip string")
    found = joined.where(F.col("zip").isin(wanted)).groupBy("zip").agg(F.max("msa").alias("msa"))
    rows = asked.join(found.withColumn("hit", F.lit(1).cast("bigint")), "zip", "left").select(
        "zip", "msa", F.coalesce("hit", F.lit(0).cast("bigint")).alias("n_zips"), F.col("msa").isNotNull().cast("bigint").alias("n_mapped")
    )
    return total.select(F.lit("all").alias("zip"), F.lit(None).cast("string").alias("msa"), "n_zips", "n_mapped").unionByName(rows)


# ---- documents ------------------------------------------------------------------------------


def _listed(checks: dict[str, Column]) -> Column:
    """Names of the checks that failed, in order."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items()]), lambda n: n.isNotNull())


REQUIRED = {
    "": ["ad_id", "metadata", "user", "location", "details", "privacy", "photos", "search"],
    "metadata": ["status", "adexpirystatus", "adtimezone", "admetroarea", "adactivedate", "adexpirydate", "intent", "category", "role"],
    "user": ["uid", "display_name", "is_verified", "role"],
}


def validate_required(doc: Column, nullable: tuple[str, ...] = ("metadata.admetroarea", "metadata.adactivedate", "metadata.adexpirydate", "user.display_name", "user.uid")) -> Column:
    """Names of required members that are missing. `nullable` members must exist but may be NULL."""
    checks = {}
    for part, names in REQUIRED.items():
        for n in names:
            path = f"{part}.{n}" if part else n
            if path not in nullable:
                checks[path] = (doc[part][n] if part else doc[n]).isNotNull()
    return _listed(checks)


def validate_enums(doc: Column) -> Column:
    """Names of fields with a value outside their vocabulary. NULL is allowed."""

    def one(c: Column, enum: str) -> Column:
        return F.coalesce(c.isin(vocab.ENUMS[enum]), c.isNull())

    def every(c: Column, enum: str) -> Column:
        return F.coalesce(F.forall(c, lambda x: x.isin(vocab.ENUMS[enum])), F.lit(True))

    meta, det, pref, room, seek = (doc[k] for k in ("metadata", "details", "preferences", "room_details", "seeker"))
    prop = doc["property_details"]
    checks = {f"metadata.{k}": one(meta[k], k) for k in ("status", "adexpirystatus", "intent", "category")}
    checks |= {
        "details.rent.mode": one(det["rent"]["mode"], "mode"),
        "details.furnishing": one(det["furnishing"], "furnishing"),
        "details.amenities": every(det["amenities"], "amenity"),
        "details.utilities": every(det["utilities"], "utility"),
        "property_details.property_type": one(prop["property_type"], "property_type"),
        "room_details.gender_preference": one(room["gender_preference"], "gender_preference"),
        **{f"preferences.{k}": one(pref[k], k) for k in ("occupation", "smoking", "pets", "vegetarian", "age_range", "preferred_gender")},
        "preferences.couples_welcome": one(pref["couples_welcome"], "yes_no"),
        "preferences.alcohol_allowed": one(pref["alcohol_allowed"], "yes_no"),
        "preferences.languages": every(pref["languages"], "language"),
        "seeker.gender": one(seek["gender"], "seeker_gender"),
        "seeker.occupation": one(seek["occupation"], "seeker_occupation"),
        "seeker.languages": every(seek["languages"], "language"),
    }
    return _listed(checks)


def validate_variant(doc: Column) -> Column:
    """A `list` ad has property details and preferences only, a `find` ad room details and seeker only."""
    listed = doc["property_details"].isNotNull() & doc["preferences"].isNotNull()
    seeking = doc["room_details"].isNotNull() & doc["seeker"].isNotNull()
    any_list = doc["property_details"].isNotNull() | doc["preferences"].isNotNull()
    any_find = doc["room_details"].isNotNull() | doc["seeker"].isNotNull()
    intent = doc["metadata"]["intent"]
    ok = F.when(intent == "list", listed & ~any_find).when(intent == "find", seeking & ~any_list).otherwise(True)
    return F.coalesce(ok, F.lit(True))
