"""Candidates: A large transfers, B risky small ones, C a reproducible sample of B."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proxylens import config
from proxylens.operators.skew import join_spread


def prepare_events(df: DataFrame) -> DataFrame:
    """Events that can be judged: with time, user and domain; the other fields get neutral values."""
    ready = df.where(F.col("event_time").isNotNull() & (F.coalesce("user_id", F.lit("")) != "") & (F.coalesce("dest_domain", F.lit("")) != ""))
    return ready.withColumn("bytes_sent", F.coalesce("bytes_sent", F.lit(0)).cast("long")).withColumn("ingest_lineage_hash", F.coalesce("ingest_lineage_hash", F.lit("")))


def is_write(methods: Sequence[str] = config.WRITE_METHODS) -> Column:
    return F.coalesce(F.upper("http_method").isin(list(methods)), F.lit(False))


def is_high_risk(categories: Sequence[str] = config.HIGH_RISK_CATEGORIES) -> Column:
    return F.coalesce(F.col("app_category").isin(list(categories)), F.lit(False))


def window_start(seconds: int) -> Column:
    """Start of the tumbling window in epoch seconds."""
    at = F.unix_seconds(F.col("event_time").cast("timestamp"))
    return at - F.pmod(at, F.lit(seconds))


def daily_cumulative(df: DataFrame, action: str = "allow") -> DataFrame:
    return df.where(F.col("action") == action).groupBy("user_id", "dest_domain", F.to_date("event_time").alias("day")).agg(F.sum("bytes_sent").alias("cumulative_bytes"))


def burst_counts(df: DataFrame, window_s: int = config.DETECT["window_s"], methods: Sequence[str] = config.WRITE_METHODS, action: str = "allow") -> DataFrame:
    return df.where((F.col("action") == action) & is_write(methods)).groupBy("user_id", "dest_domain", window_start(window_s).alias("window_start")).agg(F.count("*").alias("burst_count"))


def sample_hit(run_id: str, rate: float) -> Column:
    """Whether the first 8 bytes of sha256(run|lineage), modulo 10000, fall under the rate."""
    number = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{run_id}|"), "ingest_lineage_hash"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (number % 10000) < int(rate * 10000)


def detect(df: DataFrame, run_id: str, a_bytes: int = config.DETECT["a_bytes"], burst_n: int = config.DETECT["burst_n"], window_s: int = config.DETECT["window_s"], cum_bytes: int = config.DETECT["cum_bytes"], rate: float = config.DETECT["rate"], categories: Sequence[str] = config.HIGH_RISK_CATEGORIES, methods: Sequence[str] = config.WRITE_METHODS) -> DataFrame:
    """df with burst_count, cumulative_bytes, is_a, is_b, is_c and candidate_flags (array).

    Events are counted by user, domain, window and day; the two totals come from these counts and are joined
    back, cells of many events spread over several tasks by lineage, so that no user's events have to meet in one.
    """
    keys = ["user_id", "dest_domain", "_w", "_day"]
    events = prepare_events(df).withColumn("_w", window_start(window_s)).withColumn("_day", F.to_date("event_time"))
    allowed = F.col("action") == "allow"
    cells = events.groupBy(*keys).agg(F.count(F.when(allowed & is_write(methods), 1)).alias("writes"), F.sum(F.when(allowed, F.col("bytes_sent"))).alias("sent"), F.count("*").alias("_n"))
    totals = cells.select(*keys, "_n", F.sum("writes").over(Window.partitionBy("user_id", "dest_domain", "_w")).alias("burst_count"), F.coalesce(F.sum("sent").over(Window.partitionBy("user_id", "dest_domain", "_day")), F.lit(0)).alias("cumulative_bytes"))
    seen = join_spread(events, totals, keys, "_n", ["ingest_lineage_hash"], counts=cells.select(*keys, "_n"))
    traced = F.col("ingest_lineage_hash") != ""
    is_burst, is_cumulative = F.col("burst_count") >= burst_n, F.col("cumulative_bytes") >= cum_bytes
    marked = seen.withColumn("is_a", traced & F.coalesce(allowed, F.lit(False)) & (F.col("bytes_sent") >= a_bytes))
    marked = marked.withColumn("is_b", traced & F.coalesce(allowed, F.lit(False)) & is_write(methods) & (is_high_risk(categories) | is_burst | is_cumulative))
    marked = marked.withColumn("is_c", F.col("is_b") & (F.col("bytes_sent") < config.MIB) & sample_hit(run_id, rate))
    flags = F.array_compact(F.array(F.when(F.col("is_a"), "A"), F.when(F.col("is_b"), "B"), F.when(F.col("is_c"), "C"), F.when(is_burst, "burst"), F.when(is_cumulative, "cumulative"), F.when(F.col("is_c"), "sampled")))
    return marked.withColumn("candidate_flags", flags).withColumn("burst_hit", is_burst).withColumn("cumulative_hit", is_cumulative).drop("_w", "_day")


def signals(detected: DataFrame, kind: str) -> DataFrame:
    """The findings of kind a, b or c, one per lineage; those of b with what triggered them."""
    found = detected.where(F.col(f"is_{kind}")).dropDuplicates(["ingest_lineage_hash"])
    trigger = F.struct(is_high_risk().alias("high_risk_category"), F.col("burst_count"), F.col("cumulative_bytes"))
    columns = ["ingest_lineage_hash", "user_id", "dest_domain", "event_time", "bytes_sent", "http_method", "app_category", "action", "url_signature"]
    return found.select(*columns, *([trigger.alias("trigger")] if kind == "b" else []))


def detection_metadata(detected: DataFrame, run_id: str, params: dict) -> DataFrame:
    """One row: counts, thresholds and what reproduces the sample."""
    counts = [F.count("*").alias("total_events"), *[F.count_if(f"is_{k}").alias(f"count_{k}") for k in "abc"], F.count_if("burst_hit").alias("burst_events"), F.count_if("cumulative_hit").alias("cumulative_events")]
    settings = [F.lit(v).alias(k) for k, v in sorted((config.DETECT | params).items())]
    return detected.agg(*counts).select("*", *settings, F.lit(run_id).alias("sample_seed"), F.lit("sha256(run|lineage) mod 10000").alias("sample_method"))


def stratified_sample(df: DataFrame, rates: dict[str, float], seed: str) -> DataFrame:
    """The rows of each bytes bucket that the bucket's rate takes; the same for every run with this seed."""
    take = F.lit(False)
    for bucket, rate in rates.items():
        take = take | ((F.col("bytes_bucket") == bucket) & sample_hit(seed, rate))
    return df.where(take)


def population_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("bytes_bucket").agg(F.count("*").alias("events"), F.sum("bytes_sent").alias("bytes"))
