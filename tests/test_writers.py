"""Sinks: how the work of writing is dealt to tasks."""

import glob
import re

from pyspark.sql import functions as F

from feedloom.session import run_dir
from feedloom.sources import writers


def test_many_small_buckets_are_written_by_several_tasks(spark):
    path = run_dir(spark, "buckets")
    before = spark.conf.get(writers.MERGE, None)
    rows = spark.range(400).select((F.col("id") % 200).cast("string").alias("bucket"), F.col("id").alias("x"))
    writers.write_buckets(rows, path)
    files = glob.glob(f"{path.removeprefix('file:')}/bucket=*/part-*.parquet")
    assert len(files) == 200  # a bucket's rows come together
    assert len({re.search(r"part-(\d+)", f).group(1) for f in files}) > 1
    assert spark.conf.get(writers.MERGE, None) == before
    assert spark.read.parquet(path).count() == 400


def test_training_rows_are_written_by_every_task_of_the_last_shuffle(spark):
    path = run_dir(spark, "training")
    before = spark.conf.get(writers.MERGE, None)
    rows = spark.range(400).groupBy((F.col("id") * 7).alias("x")).agg(F.array(F.count(F.lit(1))).alias("n"))
    writers.write_training(rows, path)
    files = glob.glob(f"{path.removeprefix('file:')}/part-*.parquet")
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but not one task
    assert spark.conf.get(writers.MERGE, None) == before
    assert spark.read.parquet(path).count() == 400
