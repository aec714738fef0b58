"""Exact dedup by salted digest groups, comparing full content wherever rows are merged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import ascii_lower, free_name, stored


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def exact_groups(docs: DataFrame, text_col: str = "text", digest: Callable[[Column], Column] = sha256, hot_digests: int = 10_000, salts: int = 32) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256 (the digest).

    Texts are equal when identical after lower-casing A-Z; of equal texts the largest doc_id stays.

    1. The digests alone tell which groups are hot: those with over a `hot_digests`-th of all rows (and over 1,000),
       so there are at most `hot_digests` of them, which bounds what is broadcast.
    2. Grouping by digest, salt and *text* merges copies within each task first, then per salt; only hot groups
       have more than one salt. The text is shuffled once.
    3. The salt winners of hot groups are merged by digest and text again.
    4. Rows find their winner by digest. A digest under which two different texts were seen is resolved by text.

    Null text is empty text. A null doc_id is smaller than any other and is kept only in a group without ids.
    Rows that repeat both id and text are all counted, and all marked kept if their id is. An empty table gives no rows.
    """
    rows = docs.select("doc_id", ascii_lower(F.col(text_col)).alias("norm")).withColumn("digest", digest(F.col("norm")))
    light = stored(rows.select("doc_id", "digest"), "digests")
    bound = F.lit(max(1000, light.count() // hot_digests))
    hot = stored(light.groupBy("digest").count().where(F.col("count") > bound).select("digest", F.lit(True).alias("hot")), "hot-digests")

    def tagged(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), "digest", "left").withColumn("hot", F.col("hot").isNotNull())

    merged = (F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    again = (F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0))
    local = tagged(rows).groupBy("digest", "hot", salt.alias("salt"), "norm").agg(*merged)
    winners = stored(local.select("digest", "hot", F.when(F.col("hot"), F.col("norm")).alias("norm"), "keep_id", "group_size"), "salt-winners")
    whole = winners.where("hot").groupBy("digest", "norm").agg(*again)
    variants = F.count(F.lit(1)).alias("variants")
    hot_won = stored(whole.groupBy("digest").agg(*again, variants), "hot-winners")
    cold_won = winners.where(~F.col("hot")).groupBy("digest").agg(*again, variants)

    clashing = stored(hot_won.where("variants > 1").select("digest").union(cold_won.where("variants > 1").select("digest")), "clashing")
    split = tagged(light)
    out = (
        split.where("hot").join(F.broadcast(hot_won), "digest", "left")
        .unionByName(split.where(~F.col("hot")).join(cold_won, "digest", "left"))
        .select("doc_id", "digest", "keep_id", "group_size")
    )
    if not clashing.isEmpty():
        mixed = rows.join(clashing, "digest", "left_semi")
        by_text = mixed.join(mixed.groupBy("digest", "norm").agg(*merged), ["digest", "norm"])
        out = out.join(clashing, "digest", "left_anti").unionByName(by_text.select("doc_id", "digest", "keep_id", "group_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns kept. Rows that repeat id and text become one.

    Null text is empty text; a row without id stays only if no row of its group has one. Columns of any name come back as they were. An
    empty table stays empty. Texts are compared by digest and, where a digest is shared by different texts, by content (`exact_groups`).
    """
    groups = stored(exact_groups(docs), "exact-groups")
    key, digest, gone_id, gone_digest = (free_name(n, docs) for n in ("_key", "_digest", "_gone_id", "_gone_digest"))
    named = lambda df: df.select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_digest))
    same = F.col(key).eqNullSafe(F.col(gone_id)) & (F.col(digest) == F.col(gone_digest))
    keyed = docs.withColumns({key: F.col("doc_id"), digest: sha256(ascii_lower(F.col("text")))})
    left = keyed.join(named(groups.where(~F.col("kept"))), same, "left_anti")
    repeated = stored(named(groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")), "repeated")
    if not repeated.isEmpty():
        left = left.join(repeated, same, "left_anti").unionByName(left.join(repeated, same, "left_semi").dropDuplicates([key, digest]))
    return left.drop(key, digest)
