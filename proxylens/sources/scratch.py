"""Tables in the shared folder of the cluster, so that a result that is used twice is computed once and outlives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder in local mode and an error elsewhere."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """df as a table in buckets of key, a file each, sorted: tables with as many buckets of the same key join without an exchange.

    buckets: the session's shuffle partitions, if not given. The table is external and named in the session's
    catalog; it stays until the shared folder is cleared.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table)
    return spark.table(table)
