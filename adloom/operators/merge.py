"""Recursive JSON merge as joins and aggregates over (path, leaf, rank) rows.

A document is the set of its leaves. A later source wins per path; it also removes earlier leaves below
a path it sets to a scalar, and an earlier scalar where it puts an object. No document is ever gathered
into one row, so one page may own any share of the input. Sources that sit in one row already are merged there (`merge_in_row`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import overlay as O
from adloom.session import checkpointed
from adloom.sources.tables import dealt, dealt_by


def json_leaves(df: DataFrame, keep: list[str], body: str) -> DataFrame:
    """`keep…, path, value, empty`: one row per leaf of an object, at any depth; opened inside the row.

    `empty` marks an object without members. Bodies that are no objects give no rows.
    """
    found = df.select(*keep, F.explode(O.leaves(O.layers(F.array(F.col(body))))).alias("l"))
    return found.where(F.size("l.path") > 0).select(*keep, F.col("l.path").alias("path"), F.col("l.value").alias("value"), (F.col("l.value") == "{}").alias("empty"))


def merge_in_row(df: DataFrame, keys: list[str], documents: str) -> DataFrame:
    """`keys…, path, value` of the document that each row's array of VARIANT documents, strongest first, merges to. Narrow: sources that sit in one row stay there."""
    found = df.select(*keys, F.explode(O.leaves(O.layers(F.col(documents)))).alias("l"))
    return found.where(F.size("l.path") > 0).select(*keys, F.col("l.path").alias("path"), F.col("l.value").alias("value"))


def _proper_prefixes(path: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(path) - 1), lambda n: F.slice(path, F.lit(1), n))


def json_deep_merge(df: DataFrame, keys: list[str], rank: str, body: str) -> DataFrame:
    """`keys…, path, value` of the merged documents; `path` is an array, `value` is JSON text.

    `body` is a VARIANT column, `rank` a number: higher wins.
    """
    # a short body grows into many events, which a task sorts: bodies are dealt out, however few splits they come in
    leaves = json_leaves(dealt(df.select(*keys, rank, body)), [*keys, rank], body).withColumnRenamed(rank, "_rank")
    r = F.col("_rank")
    # one event per path a document touches: its leaf, and the objects above it
    self_event = F.struct(F.col("path").alias("path"), F.lit(True).alias("own"))
    above = F.when(
        F.size("path") > 1,
        F.transform(_proper_prefixes(F.col("path")), lambda p: F.struct(p.alias("path"), F.lit(False).alias("own"))),
    ).otherwise(F.array().cast("array<struct<path:array<string>,own:boolean>>"))
    events = leaves.select(*keys, r, "value", "empty", F.explode(F.array_append(above, self_event)).alias("e"))
    leaf_event = F.col("e.own") & ~F.col("empty")
    # written once: what follows reads it several times with different columns
    per_path = checkpointed(
        events.select(
            *keys,
            F.col("e.path").alias("path"),
            F.when(leaf_event, r).alias("leaf_at"),
            F.when(leaf_event, F.col("value")).alias("value"),
            F.when(~leaf_event, r).alias("object_at"),
            (F.col("e.own") & F.col("empty")).alias("empty"),
            (~F.col("e.own")).alias("below"),
        )
        .groupBy(*keys, "path")
        .agg(
            F.max("leaf_at").alias("leaf_at"),
            F.max_by("value", "leaf_at").alias("value"),
            F.max("object_at").alias("object_at"),
            F.max("empty").alias("empty"),
            F.max("below").alias("below"),
        )
    )
    is_leaf = F.col("leaf_at").isNotNull() & (F.col("object_at").isNull() | (F.col("leaf_at") > F.col("object_at")))
    is_bare = F.col("empty") & (F.col("leaf_at").isNull() | (F.col("object_at") > F.col("leaf_at")))
    alive = dealt_by(per_path.where(is_leaf | is_bare), [*keys, "path"]).select(
        *keys,
        "path",
        F.when(is_leaf, F.col("leaf_at")).otherwise(F.col("object_at")).alias("at"),
        F.when(is_leaf, F.col("value")).otherwise("{}").alias("value"),
        (~is_leaf).alias("bare"),
        "below",
    )
    # paths that are a scalar in one source and an object in another: usually few
    scalars = per_path.where(F.col("leaf_at").isNotNull() & F.col("object_at").isNotNull()).select(
        *keys, F.col("path").alias("above"), F.col("leaf_at").alias("blocked_at")
    )
    nested = alive.where(F.size("path") > 1).select(
        *keys, "path", "at", F.explode(_proper_prefixes(F.col("path"))).alias("above")
    )
    overruled = nested.join(scalars, [*keys, "above"]).where("blocked_at > at").select(*keys, "path").distinct()
    survivors = alive.join(overruled, [*keys, "path"], "left_anti")
    # an empty object stays only if nothing below it is left
    doubtful = survivors.where("bare AND below").select(*keys, "path")
    parents = survivors.where("size(path) > 1").select(*keys, F.explode(_proper_prefixes(F.col("path"))).alias("path"))
    filled = parents.join(doubtful, [*keys, "path"], "left_semi").distinct()
    return survivors.join(filled, [*keys, "path"], "left_anti").select(*keys, "path", "value")


def dotted(path: Column) -> Column:
    return F.array_join(path, ".")
