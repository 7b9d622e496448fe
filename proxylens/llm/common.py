"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most bytes of a table that is broadcast.
MOST_BYTES = 48 << 20
#: Rows of a key that is met on the map side.
HOT = 10_000
#: Repeated rows are numbered in runs of 2**RUN neighbours.
RUN = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; where none is set, a temporary one in local mode (tests) and an error elsewhere."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a cut of the lineage that outlives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, most_rows: int, most_bytes: int = MOST_BYTES) -> bool:
    """Whether df, a table, has at most so many rows and bytes (written as JSON)."""
    size = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")).first()
    return size.rows <= most_rows and size.bytes <= most_bytes


def broadcast_if_small(df: DataFrame, most_rows: int, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Mark df, a table, for broadcast if it has at most so many rows and bytes (written as JSON); else it joins through a shuffle."""
    return F.broadcast(df) if is_small(df, most_rows, most_bytes) else df


def join_counted(rows: DataFrame, table: DataFrame, key: str, n: str, most_rows: int) -> DataFrame:
    """rows with their match in table, which has a row for each key and how many rows have it (n). Where the table is too large for a broadcast, its hot keys, of which there are few, are met on the map side and only the others shuffled."""
    if is_small(table, most_rows):
        return rows.join(F.broadcast(table), key)
    hot, others = broadcast_if_small(table.where(F.col(n) > HOT), most_rows), table.where(F.col(n) <= HOT)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(others, key))


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with _n, from 0 within keys. Runs of neighbours are counted first, so that no group is one task's."""
    placed = saved(rows.withColumn("_at", F.monotonically_increasing_id()), "repeated").withColumn("_run", F.shiftright("_at", RUN))
    runs = placed.groupBy(*keys, "_run").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(*keys, "_run", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy(*keys, "_run").orderBy("_at")) - 1
    return placed.withColumn("_n", within).join(starts, [*keys, "_run"]).withColumn("_n", F.col("_first") + F.col("_n")).drop("_at", "_run", "_first")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once per row, also where body is a lambda that uses it often."""
    return F.transform(F.array(value), body)[0]


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [root, environment.get("PYTHONPATH", "")]))
