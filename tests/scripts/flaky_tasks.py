"""Run pipelines whose upstream tasks fail on their first attempt; print results as JSON.

Started by tests/test_retries.py in its own Spark (local[4,4]: a task may be
retried up to 4 times), so a retried task must reproduce exactly the same rows.
"""

import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from batchkit.operators import aggregates as agg  # noqa: E402
from batchkit.operators import business as biz  # noqa: E402
from batchkit.operators import partitions, sorting  # noqa: E402
from batchkit.session import table  # noqa: E402
from batchkit.sinks.tables import write_partitioned  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="flaky-marks-")


def fail_first_attempt(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0:
        open(os.path.join(MARKS, f"{ctx.stageId()}-{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected executor loss")
    yield from batches


def flaky(df):
    return partitions.map_partitions(df, fail_first_attempt, df.schema)


def main(flag):
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flaky-ckpt-"))
    sf = "/root/testdata/sf0.001"
    ev = table(spark, sf, "events").repartition(4)
    if flag == "flaky":
        ev = flaky(ev)
    out = {}
    path = write_partitioned(ev, tempfile.mkdtemp() + "/by_type", "event_type")
    back = spark.read.parquet(path)
    out["written"] = sorted((r["event_id"], r["event_type"]) for r in back.select("event_id", "event_type").collect())
    roll = biz.login_rollup(ev, F.to_date("ts"), "event_type", "user_id", entries_per_block=20)
    out["rollup"] = sorted((r["dt"], r["block"], r["j"]) for r in roll.collect())
    pos = sorting.with_position(ev.select("event_id", "user_id"), [F.col("user_id").desc(), F.col("event_id")])
    out["positions"] = sorted((r["pos"], r["event_id"]) for r in pos.collect())
    bags = agg.group_into_bags(ev, "event_type", "event_id")
    out["bags"] = sorted((r["event_type"], r["block"], r["n"], r["vals"]) for r in bags.collect())
    lists = ev.groupBy("user_id").agg(F.concat_ws(",", F.sort_array(F.collect_list(
        F.format_string("e%d:%d:%d", "event_id", F.col("user_id").cast("int"), F.lit(1))))).alias("item_list"))
    items = biz.explode_item_list(lists, "item_list", keep=["user_id"])
    out["items"] = sorted((r["user_id"], r["sku_id"], r["qty"], r["price"]) for r in items.collect())
    out["injected_failures"] = len(os.listdir(MARKS))
    print("RESULT" + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
