"""Reading vendor logs and writing events, exports and inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxylens import schemas
from proxylens.operators.events import BROKEN
from proxylens.sources import digests

SEPARATORS = (",", "\t", ";", "|")


def sniff_separator(spark: SparkSession, path: str, glob: str = "*.csv") -> str:
    """The separator that the first line holds most often."""
    first = spark.read.option("pathGlobFilter", glob).text(path).limit(1).collect()
    line = first[0].value if first else ""
    return max(SEPARATORS, key=line.count)


def read_vendor_csv(spark: SparkSession, path: str, sep: str | None = None, glob: str = "*.csv") -> DataFrame:
    """String columns by the first header, `_file`, and `_error`: the text of a row that has more fields than the header, else null. Short rows end in nulls."""
    options = {"header": True, "sep": sep or sniff_separator(spark, path, glob), "encoding": "UTF-8"}
    reader = spark.read.option("pathGlobFilter", glob)
    names = reader.csv(path, **options).columns
    kinds = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_more", "_record"]])
    df = reader.schema(kinds).csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_record", **options)
    # a row of just one field too many fits the columns here, so that its text is put together again
    text = F.coalesce("_record", F.concat_ws(options["sep"], *[F.coalesce(f"`{n}`", F.lit("")) for n in names], "_more"))
    return df.select(*[F.col(f"`{n}`") for n in names], F.col("_metadata.file_path").alias("_file"), F.when(F.col("_more").isNotNull(), text).alias("_error"))


def _with_errors(df: DataFrame) -> DataFrame:
    """df, read from JSON, with `_file` and `_error`, the text of what is not an object."""
    marked = df if "_error" in df.columns else df.withColumn("_error", F.lit(None).cast("string"))
    return marked.withColumn("_file", F.col("_metadata.file_path"))


def read_vendor_json(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Files that hold an array or one object; a file that is not JSON is one row with `_error`."""
    return _with_errors(spark.read.option("pathGlobFilter", glob).json(path, multiLine=True, primitivesAsString=True, columnNameOfCorruptRecord="_error"))


def read_vendor_jsonl(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """An object a line; a line that is none is a row with `_error`, a blank one is left out."""
    return _with_errors(spark.read.option("pathGlobFilter", glob).json(path, primitivesAsString=True, columnNameOfCorruptRecord="_error"))


def read_vendor(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder or one file, each by its suffix, under one set of columns."""
    readers = {"*.json": read_vendor_json, "*.jsonl": read_vendor_jsonl, "*.csv": read_vendor_csv}
    there = lambda glob: not spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path").isEmpty()
    parts = [read(spark, path) for glob, read in readers.items() if there(glob)] or [read_vendor_csv(spark, path, glob="*")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def coerce_event_types(df: DataFrame) -> DataFrame:
    """Canonical columns in their types; what does not fit is null."""
    columns = []
    for part in schemas.CANONICAL.split(", "):
        name, kind = part.split(" ")
        columns.append((F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name))
    return df.select(*columns, *[c for c in df.columns if c not in schemas.COLUMNS])


def write_events(df: DataFrame, base: str) -> None:
    """Snappy Parquet by vendor and date; only the dates that df holds are replaced."""
    dated = df.withColumn("date", F.to_date("event_time"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy("vendor", "date").parquet(base)


def read_events(spark: SparkSession, base: str, vendor: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Events of a vendor and of dates from start to end; other partitions are not read."""
    df = spark.read.parquet(base)
    for condition in (vendor and F.col("vendor") == vendor, start and F.col("date") >= start, end and F.col("date") <= end):
        df = df if condition is None or isinstance(condition, str) else df.where(condition)
    return df


def file_inventory(spark: SparkSession, path: str, events: DataFrame | None = None, vendor: str | None = None) -> DataFrame:
    """file, size, modified, file_hash, file_id, vendor; with the events read from the files also row_count, parse_error_count, min_time and max_time.

    Files are hashed in pieces by the task that they are dealt to; no content goes through a row.
    """
    ident = F.sha2(F.concat_ws("|", "file", "size", F.unix_seconds("modified")), 256)
    out = digests.file_digests(listed(spark, path)).withColumn("file_id", ident).withColumn("vendor", F.lit(vendor).cast("string"))
    if events is None:
        return out
    broken = F.count_if(F.col("reject_reason") == BROKEN) if "reject_reason" in events.columns else F.lit(0)
    per = events.groupBy(F.col("ingest_file").alias("file")).agg(F.count("*").alias("row_count"), broken.alias("parse_error_count"), F.min("event_time").alias("min_time"), F.max("event_time").alias("max_time"))
    filled = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("row_count", "parse_error_count")}
    return out.join(per, "file", "left").withColumns(filled)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """file, size, modified of the files of a path that hold anything; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def stable_new_files(spark: SparkSession, path: str, as_of: str, seen: DataFrame, quiet_s: int = 60, include: str = ".*", exclude: str = "^$") -> DataFrame:
    """Files that did not change for quiet_s seconds before as_of and are not in seen (file)."""
    files = listed(spark, path)
    name = F.substring_index("file", "/", -1)
    calm = F.unix_seconds("modified") <= F.unix_seconds(F.lit(as_of).cast("timestamp")) - quiet_s
    return files.where(calm & name.rlike(include) & ~name.rlike(exclude)).join(seen.select("file"), "file", "left_anti")


def verify_checksums(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """manifest (file, file_hash) rows whose file is missing (now is null) or differs."""
    now = digests.file_digests(listed(spark, path)).select("file", F.col("file_hash").alias("now"))
    return manifest.join(now, "file", "left").where(F.col("now").isNull() | (F.col("now") != F.col("file_hash")))


def write_sanitized_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_report_json(df: DataFrame, path: str) -> None:
    """Reports, evidence rows and discovery logs: one JSON object a line."""
    df.write.mode("overwrite").json(path)


RUN_LOG = "timestamp timestamp, event_type string, run_id string, stage string, status string, row_count long, error_type string, message string"


def write_run_log(events: DataFrame, path: str) -> None:
    """Events of runs (columns of RUN_LOG, as far as they are there), added as JSON lines by date."""
    events.withColumn("date", F.to_date("timestamp")).write.mode("append").partitionBy("date").json(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The run log in fixed types; lines that are not JSON objects are left out."""
    return spark.read.schema(RUN_LOG).json(path, mode="DROPMALFORMED")
