"""Positions, running sums and the first n rows in an order, without sorting everything into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.session import checkpointed

# up to here every task keeps its own n best rows, then parts of the tasks do, then one merge follows
TOP_K_MAX = 5_000
# first merges of a top-k; the last one gets at most so many times n rows
TOP_K_PARTS = 64
# rows of a group that one task sums up at once
BLOCK_BITS = 12


def placed(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` in ranges of a total order, written once, with `_pos`, which grows with the order (and has gaps between ranges)."""
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(ranges.withColumn("_pos", F.monotonically_increasing_id()))


def running_sums(df: DataFrame, group: str, order: list[str], sums: dict[str, Column], largest: dict[str, Column] | None = None) -> DataFrame:
    """Adds running sums (and running maxima) over each group in a total order, each row included.

    In two steps: rows are cut into blocks along the order, every block of a group is summed on its own, and what the blocks before it
    add up to is carried in by a join. So a group of any size spreads over all tasks; only its block totals meet.
    """
    largest = largest or {}
    rows = placed(df.withColumns({f"_in_{n}": c for n, c in {**sums, **largest}.items()}), [group, *order]).withColumn("_block", F.shiftright("_pos", BLOCK_BITS))
    fold = {n: F.sum for n in sums} | {n: F.max for n in largest}
    within = Window.partitionBy(group, "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.withColumns({f"_own_{n}": f(f"_in_{n}").over(within) for n, f in fold.items()})
    totals = rows.groupBy(group, "_block").agg(*[f(f"_in_{n}").alias(f"_all_{n}") for n, f in fold.items()])
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(group).alias("_group"), F.col("_block").alias("_of"), *[f(f"_all_{n}").over(before).alias(f"_carry_{n}") for n, f in fold.items()])
    met = inner.join(carried, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_block") == F.col("_of")))
    zero = F.lit(0)
    done = {n: F.coalesce(f"_own_{n}", zero) + F.coalesce(f"_carry_{n}", zero) for n in sums} | {n: F.greatest(f"_own_{n}", f"_carry_{n}") for n in largest}
    return met.select(*df.columns, *[c.alias(n) for n, c in done.items()])


def first_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """Rows 1 to n in a total order; n = 0 means all rows.

    A small n is a top-k in three steps: per task, per part of the tasks, over all. A large n would push n rows through one task, so
    there the rows are range partitioned and sorted, written once, counted per partition, and kept by global position.
    """
    if n <= 0:
        return df
    if n <= TOP_K_MAX:
        # the part depends on the task, so each task offers its n best to one part only
        parted = df.withColumn("_part", F.spark_partition_id() % TOP_K_PARTS)
        best = Window.partitionBy("_part").orderBy(*order)
        return parted.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= n).drop("_part", "_nth").orderBy(*order).limit(n)
    rows = placed(df, order).withColumn("_range", F.shiftright("_pos", 33))
    # one row per range partition: as many rows as tasks, independent of the data
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), "_first")
    kept = rows.join(offsets, "_range").where(F.col("_offset") + F.col("_pos") - F.col("_first") < n)
    return kept.select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[str], latest: bool = False) -> DataFrame:
    """One row per key: the first (or latest) in `order`. Combines before the shuffle, so hot keys stay cheap.

    `order` must be total over the rows of a key; columns not in it only ride along.
    """
    ride = [c for c in df.columns if c not in keys and c not in order]
    pick = (F.max if latest else F.min)(F.struct(*order, *ride))
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)
