"""The streaming run of event_rate equals the batch query on the same files."""

import os
import shutil

from batchkit.session import shared_dir, table
from batchkit.streaming import daily_event_rate_stream
from batchkit.streaming.incremental import start
from conftest import SF0001

import __spark_entry__ as E


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "events_in"
    os.makedirs(src)
    shutil.copy(os.path.join(SF0001, "events.parquet"), src / "part-0.parquet")
    schema = table(spark, SF0001, "events").schema
    df = daily_event_rate_stream(spark, str(src), schema, "purchase", "view")
    q = start(df, shared_dir(spark, "stream_ckpt"), "event_rate_stream_out", mode="complete")
    try:
        q.processAllAvailable()
        got = {r["dt"]: r["r"] for r in spark.sql("select * from event_rate_stream_out").collect()}
    finally:
        q.stop()
    batch = {r["dt"]: r["r"] for r in E.queries()["event_rate"](spark, SF0001).collect()}
    assert got == batch


def test_stream_updates_as_files_arrive(spark, tmp_path):
    from pyspark.sql import functions as F

    from batchkit.operators.business import event_rate

    src = tmp_path / "arriving"
    os.makedirs(src)
    ev = table(spark, SF0001, "events")
    halves = [ev.where(F.col("event_id") % 2 == 0), ev.where(F.col("event_id") % 2 == 1)]
    df = daily_event_rate_stream(spark, str(src), ev.schema, "purchase", "view")
    q = start(df, shared_dir(spark, "stream_ckpt2"), "event_rate_arriving", mode="complete")
    seen = None
    try:
        for i, part in enumerate(halves):
            part.coalesce(1).write.parquet(str(tmp_path / f"stage{i}"))
            for f in os.listdir(tmp_path / f"stage{i}"):
                if f.endswith(".parquet"):
                    shutil.copy(tmp_path / f"stage{i}" / f, src / f"batch{i}-{f}")
            q.processAllAvailable()
            seen = part if seen is None else seen.unionByName(part)
            got = {r["dt"]: r["r"] for r in spark.sql("select * from event_rate_arriving").collect()}
            want = {r["dt"]: r["r"] for r in seen.groupBy(F.to_date("ts").cast("string").alias("dt"))
                    .agg(event_rate("event_type", "purchase", "view").alias("r")).collect()}
            assert got == want
    finally:
        q.stop()
