"""Session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# PySpark's call-site capture costs some twenty JVM calls per column operation; our expressions are large
CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"

# of a repeated key in a JSON object the last one counts; otherwise the whole document would be unreadable
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"


def build_session(master: str | None = None, app: str = "adloom", **conf) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        CALL_SITES: "false",
        DUPLICATE_KEYS: "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or else the checkpoint folder of the context.

    Only a session whose driver and executors are one process gets a new local folder when neither is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="adloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "adloom", f"{name}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing to the shared folder and reading back."""
    path = new_table_path(df.sparkSession, "checkpoint")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """`df` with all columns computed here. What comes later sees plain columns: the optimizer traces the keys of a join, and what is
    mentioned twice, back through all projections below, and large expressions would be written out once per mention."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
