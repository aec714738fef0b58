"""The same operators on arriving files.

Every stream runs to the end of its input (`availableNow`) and can be restarted from its checkpoint.
Sinks are files or snapshot versions named after the batch, so a replayed batch writes the same thing.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.urls import SiteProfile, api_endpoint
from adloom.operators.detail import GeoTables, detail_records
from adloom.operators.quality import COUNTERS
from adloom.operators.state import read_ads, upsert_ads
from adloom.session import new_table_path
from adloom.sources.tables import accepted_bodies, read_snapshot, write_snapshot

SALTS = 16

# state that holds whole pages outgrows the heap of any executor: it goes to a key-value store on the local disk, of which all stores of an
# executor together keep a bounded part in memory. A join has one store a part instead of four, blocks are large enough to compress pages
# well, and rows are not counted, which would cost a read per write
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
}


def file_stream(spark: SparkSession, path: str, schema: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _finish(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_to_files(stream: DataFrame, path: str, checkpoint: str, state_on_disk: bool = False) -> None:
    """Exactly-once append to a parquet directory. `state_on_disk` is for streams whose rows wait with all they hold (`join_bodies`); a stream
    that has a checkpoint goes on with the kind of state that it began with."""
    # a stream takes its settings along when it starts
    with _set(stream.sparkSession, _ON_DISK if state_on_disk else {}):
        _finish(stream.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def stream_dedup(ads: DataFrame, key: str = "ad_id", spread_by: str | None = None, salts: int = SALTS) -> DataFrame:
    """Each key once over the life of the stream.

    Two stateful steps: rows of a busy key first meet in `salts` parts, so no task sees more than a
    fraction of them, then the at most `salts` survivors meet by key alone.
    """
    if spread_by is None:
        return ads.select(key).dropDuplicates([key])
    salted = ads.select(key, F.pmod(F.hash(spread_by), F.lit(salts)).alias("_salt"))
    return salted.dropDuplicates([key, "_salt"]).select(key).dropDuplicates([key])


def stream_dedup_within(ads: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """As `stream_dedup`, but state older than `delay` is dropped."""
    return ads.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_upsert(ads: DataFrame, path: str, checkpoint: str, schema: str) -> None:
    """Every micro-batch refreshes the buckets it touches of the ad store at `path`; a replayed batch puts the same rows in place again."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_ads(batch.sparkSession, path, batch, schema, version=batch_id + 1)

    _finish(ads.writeStream.foreachBatch(apply), checkpoint)


def stream_stats(log: DataFrame, path: str, checkpoint: str, keys: list[str]) -> None:
    """Live counters per key: the full result after every batch, as the snapshot of that batch."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(batch, path, batch_id + 1)

    counts = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    _finish(counts.writeStream.outputMode("complete").foreachBatch(publish), checkpoint)


def stream_run_stats(log: DataFrame, path: str, checkpoint: str) -> None:
    """Live run statistics of `log(run_id, kind, url)`: after every batch the snapshots `path/counts` and `path/endpoints` hold the state so far.

    Two queries over one log. Counters are one aggregate. Endpoints pass two chained steps: state that knows each endpoint of a run lets it
    through once, then they are counted; so no row and no task ever holds the endpoints of a run.
    """

    def publish(name: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            write_snapshot(batch, f"{path}/{name}", batch_id + 1)

        return write

    counts = log.groupBy("run_id").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in COUNTERS], F.count_if(F.col("kind") == "error").alias("error_count")
    )
    _finish(counts.writeStream.outputMode("complete").foreachBatch(publish("counts")), f"{checkpoint}/counts")
    called = log.where("kind = 'api'").select("run_id", api_endpoint(F.col("url")).alias("endpoint")).where("endpoint IS NOT NULL")
    endpoints = called.dropDuplicates(["run_id", "endpoint"]).groupBy("run_id").agg(F.count(F.lit(1)).alias("endpoints"))
    _finish(endpoints.writeStream.outputMode("complete").foreachBatch(publish("endpoints")), f"{checkpoint}/endpoints")


def read_run_stats(spark: SparkSession, path: str) -> DataFrame:
    """The statistics that `stream_run_stats` has published so far, one row per run."""
    counters = ", ".join(f"{k} BIGINT" for k in (*COUNTERS, "error_count"))
    counts = read_snapshot(spark, f"{path}/counts", f"run_id BIGINT, {counters}")
    endpoints = read_snapshot(spark, f"{path}/endpoints", "run_id BIGINT, endpoints BIGINT")
    return counts.join(endpoints, "run_id", "left").withColumn("endpoints", F.coalesce("endpoints", F.lit(0).cast("bigint")))


def join_bodies(pages: DataFrame, bodies: DataFrame, lateness: str, delay: str) -> DataFrame:
    """Streams of pages (`page_id, url, html, captured_at`) and API bodies (`page_id, url, content_type, arrival, body, received_at`) as
    `page_id, url, html, captured_at, bodies`.

    A body belongs to its page if it is received at the capture or up to `delay` later. Both sides may be `lateness` out of order. A page comes out
    once the watermark has passed the time in which its bodies count; only then, and for pages as well as bodies, is its state dropped. Of one URL the first
    arrival counts.
    """
    left = pages.withWatermark("captured_at", lateness)
    kept = accepted_bodies(bodies).withWatermark("received_at", lateness)
    right = kept.select(F.col("page_id").alias("of"), F.col("url").alias("endpoint"), F.col("arrival").cast("bigint").alias("arrival"), "body", "received_at")
    in_time = F.expr(f"of = page_id AND received_at >= captured_at AND received_at <= captured_at + INTERVAL {delay}")
    met = left.join(right, in_time, "left_outer")
    body = F.when(F.col("of").isNotNull(), F.struct("endpoint", "arrival", "body"))
    grouped = met.groupBy("page_id", "captured_at", "url", "html").agg(F.array_sort(F.collect_list(body)).alias("all"))
    return grouped.select("page_id", "url", "html", "captured_at", _first_per_endpoint(F.col("all")).alias("bodies"))


def _first_per_endpoint(bodies):
    """Bodies by arrival, of each endpoint the first; `bodies` comes sorted by endpoint, then arrival."""
    firsts = F.filter(bodies, lambda b, i: (i == 0) | (F.get(bodies, i - 1)["endpoint"] != b["endpoint"]))
    long_enough = F.filter(firsts, lambda b: F.length(b["body"]) >= 10)
    return F.array_sort(F.transform(long_enough, lambda b: F.struct(b["arrival"].alias("arrival"), b["body"].alias("body"))))


def stream_detail_pages(pages: DataFrame, bodies: DataFrame, site: SiteProfile, lateness: str, delay: str, geo: GeoTables | None = None, details: bool = True) -> DataFrame:
    """Ad records of arriving pages and their late API bodies: `join_bodies`, then the projections of the batch job."""
    joined = join_bodies(pages, bodies, lateness, delay)
    rows = joined.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.col("captured_at").alias("scraped_at"), "bodies")
    return detail_records(rows, site, geo, details)


def run_to_files(stream: DataFrame, name: str, state_on_disk: bool = False) -> DataFrame:
    """Run a stream into a new parquet directory and return that as a table."""
    spark = stream.sparkSession
    path = new_table_path(spark, name)
    append_to_files(stream, path, path + "-checkpoint", state_on_disk)
    return spark.read.schema(stream.schema).parquet(path)


__all__ = [
    "append_to_files", "file_stream", "join_bodies", "read_ads", "read_run_stats", "read_snapshot", "run_to_files", "stream_dedup", "stream_dedup_within",
    "stream_detail_pages", "stream_run_stats", "stream_stats", "stream_upsert",
]
