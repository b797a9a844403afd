"""Hot groups are split at run time: the limits are lowered so that small data is over them."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from airgrid.operators import features
from tests.micro import as_set


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, key):
    """A third of the rows share one key."""
    hot = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    return spark.range(30000, numPartitions=8).select(
        "id", F.lit(0).alias("fold"), F.when(hot, key).otherwise((F.col("id") % 2000 + 100).cast("int")).alias("pro2"),
        F.lit(11).alias("hour"), F.lit("A").alias("cnlname"), F.sha2(F.col("id").cast("string"), 256).alias("prgname"),
    )


@pytest.mark.parametrize("key", [5, None])
def test_a_lookup_join_splits_its_hot_key(spark, work, key):
    rows = work.keep(hot_rows(spark, key), "rows")
    averages = work.keep(
        spark.range(2200).select(
            F.col("id").cast("int").alias("pro2"), F.lit(11).alias("hour"), F.lit("A").alias("cnlname"),
            F.array(F.col("id") / 4).alias("average_pro2"),
        ), "averages",
    )
    keys = ["pro2", "hour", "cnlname"]
    expected = as_set(features.look_up(rows, averages, keys, ["cnlname"]).select("id", "average_pro2"))
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
    ):
        joined = features.look_up(rows.repartition(8), averages, keys, ["cnlname"])
        found = {(r["id"], r["average_pro2"]) for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert found == expected and len(found) == 30000


def test_a_hot_segment_is_written_by_several_tasks(spark, work):
    rows = hot_rows(spark, 5).withColumn("pro2", F.when(F.col("pro2") == 5, 5).otherwise(F.col("pro2") % 4 + 6))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="50k"):
        kept = work.keep(rows, "segments", partition_by=["pro2"])
    files = kept.withColumn("file", F.input_file_name()).groupBy("pro2").agg(
        F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n")
    )
    counts = {r["pro2"]: (r["files"], r["n"]) for r in files.collect()}
    assert counts[5][0] >= 4
    assert sum(n for _, n in counts.values()) == 30000
