"""Sources and sinks: captured pages, API bodies, the ZIP gazetteer, ads and run state.

Every sink writes below a path the caller names. Snapshot tables are directories `v=N`: a writer fills
the next version, a reader takes the newest one that carries Spark's `_SUCCESS` marker, so a lost job
leaves the old version in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.urls import SiteProfile, route_label
from adloom.session import settled

TASKS_PER_CORE = 4

ZIP_SCHEMA = "zip STRING, city STRING, county STRING, state_code STRING, lat DOUBLE, lng DOUBLE, raw_msa STRING"


def spread(df: DataFrame, key: str | None = None, scan: DataFrame | None = None) -> DataFrame:
    """Repartition only if the scan has fewer splits than the cluster has cores.

    A large table already arrives in many splits; moving it through a shuffle would be waste. Without a
    unique `key` rows are dealt out evenly, so that no busy key fills a partition. `scan` names the table
    whose splits count where `df` already joins: asking a join for its partitions would start it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if (df if scan is None else scan).rdd.getNumPartitions() >= cores:
        return df
    # more parts than cores, so that no task is as long as the job
    return df.repartition(TASKS_PER_CORE * cores, key) if key else df.repartition(TASKS_PER_CORE * cores)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly after a join, for work that costs far more than its bytes tell: joined rows arrive in as few tasks as their bytes fill."""
    return settled(df.repartition(_parts(df.sparkSession)))


def dealt_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt out by keys that are theirs alone, for joins by these keys: their parts are not put together again where rows are short on disk but
    long in memory."""
    return df.repartition(_parts(df.sparkSession), *keys)


def _parts(spark: SparkSession) -> int:
    return max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return spread(pages, "page_id")


def seed_frontier(starts: DataFrame, site: SiteProfile, url: str = "url", label: Column | None = None) -> DataFrame:
    """Start URLs as labelled frontier rows on page 1."""
    u = F.col(url)
    return starts.where(u.isNotNull()).select(
        u.alias("url"), route_label(F.lit(None) if label is None else label, u, site).alias("label"), F.lit(1).alias("page")
    )


def payload_first_per_url(payloads: DataFrame) -> DataFrame:
    """First arrival per page and URL; combines on the map side, so a busy URL stays cheap."""
    rest = [c for c in payloads.columns if c not in ("page_id", "url", "arrival")]
    return (
        payloads.groupBy("page_id", "url")
        .agg(F.min(F.struct("arrival", *rest)).alias("first"))
        .select("page_id", "url", "first.*")
    )


def accepted_bodies(payloads: DataFrame) -> DataFrame:
    """API bodies that are JSON or plain text and no asset."""
    kind = F.col("content_type")
    accepted = payloads.where(F.contains(kind, F.lit("application/json")) | F.contains(kind, F.lit("text/plain")))
    return accepted.where(~F.col("url").rlike(vocab.STATIC_ASSETS))


def capture_filter(payloads: DataFrame) -> DataFrame:
    """API bodies worth keeping: JSON or plain text, first per page and URL, no asset, ten characters or more."""
    return payload_first_per_url(accepted_bodies(payloads)).where(F.length("body") >= 10)


def scan_zip_dim(spark: SparkSession, path: str) -> DataFrame:
    """The gazetteer from CSV; an empty table if there is none."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
    if not exists:
        return spark.createDataFrame([], ZIP_SCHEMA)
    return spark.read.schema(ZIP_SCHEMA).option("header", True).csv(path)


def write_ads(ads: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = ads.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def export_documents(documents: DataFrame, path: str) -> None:
    """JSON lines, compressed: member names are most of a document's bytes."""
    documents.write.mode("append").option("compression", "gzip").json(path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at `path`."""
    folder, fs = _folder(spark, path)
    return fs.exists(folder) and len(fs.listStatus(folder)) > 0


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the table at `path`."""
    folder, fs = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(folder)


def next_version(spark: SparkSession, path: str) -> int:
    return (_versions(spark, path) or [-1])[-1] + 1


def empty_version(spark: SparkSession, path: str, version: int) -> None:
    """Frees the files of an old version and keeps its marker."""
    folder, fs = _folder(spark, f"{path}/v={version}")
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            if not status.getPath().getName().startswith("_"):
                fs.delete(status.getPath(), True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(done):
            found.append(int(name[2:]))
    return sorted(found)


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Newest complete version of a snapshot table, or an empty table."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={versions[-1]}")


def read_snapshot_before(spark: SparkSession, path: str, schema: str, version: int) -> DataFrame:
    """Newest complete version older than `version`, or an empty table."""
    older = [v for v in _versions(spark, path) if v < version]
    if not older:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={older[-1]}")


def write_snapshot(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write the next (or the named) version; naming it makes a replay idempotent."""
    if version is None:
        version = (_versions(df.sparkSession, path) or [0])[-1] + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return version
