"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.session import new_table_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to the shared folder and read back: computed once, and safe when executors are lost."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; the rows of fold 2 are held out of all training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


HELD_OUT = 2


def free_name(name: str, *frames: DataFrame) -> str:
    """`name`, or that with signs added, so that no column of the frames is called so in any spelling."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_batches(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches that hold about `size` characters of a text column, or one longer row, with the texts; null is empty."""
    for batch in batches:
        at = seen = 0
        texts: list[str] = []
        for k in range(batch.num_rows):
            texts.append(batch.column(column)[k].as_py() or "")
            seen += len(texts[-1])
            if seen >= size or k + 1 == batch.num_rows:
                yield batch.slice(at, k + 1 - at), texts
                at, seen, texts = k + 1, 0, []


def give_back_memory() -> None:
    """What a task has freed goes back to the machine: Python workers outlive their tasks, and those of a later stage share the executor."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run):
    """A function over batches that gives back its memory once its task is through."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back_memory()

    return whole
