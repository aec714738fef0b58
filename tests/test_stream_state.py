"""Where streams keep what they wait for."""

import glob

from pyspark.sql import functions as F

from adloom.plans import details as PD
from adloom.session import new_table_path
from adloom.streaming import streams as X

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def waiting(spark):
    """Streams of pages and bodies with equal rows, nulls and a page without bodies; the last row lets the watermark pass the others."""
    start, end = "timestamp '2026-01-01 00:00:00'", "timestamp '2030-01-01 00:00:00'"
    pages = spark.createDataFrame([(1, "u", "<p>1"), (1, "u", "<p>1"), (1, "v", "<p>2"), (2, None, None), (None, "w", "<p>3"), (-1, "end", "")], "page_id long, url string, html string")
    bodies = [(1, "a", 5, "a long body 5"), (1, "a", 3, "a long body 3"), (1, "b", 9, "a long body 9"), (2, "a", 1, "short"), (None, "a", 1, "a long body 1"), (-1, "end", 0, "")]
    bodies = spark.createDataFrame(bodies, "page_id long, url string, arrival long, body string").withColumn("content_type", F.lit("text/plain"))
    time = F.when(F.col("page_id") == -1, F.expr(end)).otherwise(F.expr(start))
    folder = new_table_path(spark, "waiting")
    out = []
    for name, df in (("pages", pages.withColumn("captured_at", time)), ("bodies", bodies.withColumn("received_at", time + F.expr("interval '1' minute")))):
        df.coalesce(1).write.parquet(f"{folder}/{name}")
        out.append(X.file_stream(spark, f"{folder}/{name}", df.schema))
    return X.join_bodies(*out, "10 minutes", "'5' MINUTE")


def test_waiting_pages_lie_on_disk_and_come_out_the_same(spark):
    before = spark.conf.get(PROVIDER)
    rows = {}
    for on_disk in (False, True):
        folder = new_table_path(spark, "state")
        joined = waiting(spark)
        X.append_to_files(joined, folder, folder + "-checkpoint", state_on_disk=on_disk)
        rows[on_disk] = sorted((str(r.page_id), str(r.url), str(r.html), [tuple(b) for b in r.bodies]) for r in spark.read.schema(joined.schema).parquet(folder).collect())
        assert bool(glob.glob(f"{folder}-checkpoint/state/**/*.zip", recursive=True)) is on_disk
        assert bool(glob.glob(f"{folder}-checkpoint/state/**/*.delta", recursive=True)) is not on_disk
    assert rows[True] == rows[False] and len(rows[True]) == 4
    assert rows[True][0] == ("1", "u", "<p>1", [(3, "a long body 3"), (9, "a long body 9")])
    assert spark.conf.get(PROVIDER) == before


def test_the_query_over_pages_keeps_its_state_on_disk(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(X, "run_to_files", lambda stream, name, state_on_disk=False: asked.append(state_on_disk) or waiting(spark))
    monkeypatch.setattr(X, "stream_detail_pages", lambda *args: None)
    monkeypatch.setattr(PD, "arriving", lambda *args: (None, None))
    monkeypatch.setattr(PD, "shown", lambda df: df)
    PD.stream_detail_pages(spark, "")
    assert asked == [True]
