"""Incremental ingest and streaming detection; on a closed input both equal the batch result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from proxylens import config
from proxylens.operators.detect import is_write
from proxylens.operators.events import split_rejects, to_canonical
from proxylens.schemas import CANONICAL


def stream_ingest(spark: SparkSession, path: str, vendor: str, out: str, checkpoint: str, schema: str, per_trigger: int = 100) -> DataStreamWriter:
    """New CSV files of a folder to canonical events in Parquet by vendor and date.

    Lineages hold the file's name without its folder, so that a file that is delivered again has the same ones. A
    batch that is run again replaces its own files: each writes to a folder of its number. `each_lineage_once`
    reads what several such streams have written.
    """
    raw = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", per_trigger).csv(path).withColumn("_file", F.col("_metadata.file_name"))

    def write(batch: DataFrame, number: int) -> None:
        good, _ = split_rejects(to_canonical(batch, vendor))
        dated = good.withColumn("date", F.to_date("event_time")).withColumn("batch", F.lit(number))
        # rows of a date meet, so that a batch writes a few files of some size for each date and not one from every task
        dated.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "vendor", "date").parquet(out)

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def each_lineage_once(spark: SparkSession, landed: str, within: str = "30 days", per_trigger: int = 100) -> DataFrame:
    """A stream of the events of landed folders (a pattern of what `stream_ingest` wrote), each lineage once.

    The lineages seen are kept in the state store, by the time at which they arrive: nothing is late, and what is
    delivered again within the time given is left out. No earlier output is read.
    """
    events = spark.readStream.schema(CANONICAL).option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", True).parquet(landed)
    arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["ingest_lineage_hash"]).drop("_arrived")


def write_dated(events: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """A stream of canonical events to Parquet by vendor and date; every batch is committed once, and writes one file for each date that it holds."""
    dated = events.withColumn("date", F.to_date("event_time")).repartition("vendor", "date")
    return dated.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).partitionBy("vendor", "date")


def write_updates(totals: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """A stream of running totals: each batch writes the totals that changed, in a folder of its number. `latest` reads them."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return totals.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last total of each key."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def run_to_end(writer: DataStreamWriter) -> None:
    """Take what there is now, in batches, and stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def stream_burst(df: DataFrame, window_s: int = config.DETECT["window_s"], watermark: str = "10 minutes") -> DataFrame:
    """Write events by user, domain and tumbling window; rows later than the watermark are left out."""
    kept = df.withWatermark("event_time", watermark).where((F.col("action") == "allow") & is_write())
    counted = kept.groupBy(F.window("event_time", f"{window_s} seconds"), "user_id", "dest_domain").agg(F.count("*").alias("burst_count"))
    return counted.select("user_id", "dest_domain", F.unix_seconds("window.start").alias("window_start"), "burst_count")


def stream_cumulative(df: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Allowed bytes by user, domain and day."""
    kept = df.withWatermark("event_time", watermark).where(F.col("action") == "allow")
    summed = kept.groupBy(F.window("event_time", "1 day"), "user_id", "dest_domain").agg(F.sum("bytes_sent").alias("cumulative_bytes"))
    return summed.select("user_id", "dest_domain", F.to_date("window.start").alias("day"), "cumulative_bytes")
