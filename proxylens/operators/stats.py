"""Aggregates over flagged events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proxylens import config
from proxylens.sources.scratch import saved

#: Bits of a value that a step of a percentile looks at.
DIGIT = 16
CARRIED = ["norm_host", "norm_path_template", "dest_domain", "bytes_bucket"]


def grouped_distinct(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """keys, out: how many different values (not null) each group has. Values are made distinct on their own before they are counted by group."""
    return df.where(F.col(value).isNotNull()).select(*keys, value).distinct().groupBy(*keys).agg(F.count("*").alias(out))


def grouped_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, out: str) -> DataFrame:
    """keys, out: the exact percentile, interpolated, of an integer column for each group.

    Equal values are counted first. Then the two ranks between which the percentile lies are narrowed down
    DIGIT bits of the value at a time, over histograms of these digits: no task sees more than 2 ** DIGIT cells
    of a group at once (twice that where values are negative), however many values the group has.
    """
    cells = saved(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("long").alias("_value")).agg(F.count("*").alias("_n")), "percentile-cells")
    most = cells.agg(F.greatest(F.max("_value"), -F.min("_value"))).first()[0] or 0
    position = q * (F.sum("_n") - 1)
    ranks = cells.groupBy(*keys).agg(position.alias("_at")).withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at"))))).withColumn("_which", F.col("_rank"))
    for shift in range((max(int(most).bit_length(), 1) - 1) // DIGIT * DIGIT, -1, -DIGIT):
        digits = cells.groupBy(*keys, F.shiftright("_value", shift).alias("_digit")).agg(F.sum("_n").alias("_n"))
        on = list(keys)
        if "_found" in ranks.columns:
            on, digits = [*keys, "_found"], digits.withColumn("_found", F.shiftright("_digit", DIGIT))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_which").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0))
        met = ranks.join(digits, on).withColumn("_upto", upto).where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")))
        ranks = met.select(*keys, "_at", "_which", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), F.col("_digit").alias("_found"))
    low, high = F.min("_found"), F.max("_found")
    return ranks.groupBy(*keys).agg((low + (high - low) * (F.first("_at") - F.floor(F.first("_at")))).alias(out))


STATS = ["access_count", "unique_users", "bytes_sent_sum", "bytes_sent_max", "bytes_sent_p95", "bytes_received_sum", "burst_max", "cumulative_max", "candidate_flags", "sampled", "first_seen", "last_seen"]


def signature_stats(df: DataFrame, run_id: str, approx: bool = False) -> DataFrame:
    """All columns of the statistics table, one row per signature.

    Sums, counts and extremes are combined on the map side. The exact percentile and the number of users come
    from tables of their own that are joined by signature, so that a hot signature's values never meet in one task;
    approx takes sketches instead, in one shuffle.
    """
    plain = {
        **{c: F.min(c) for c in CARRIED},
        "access_count": F.count("*"),
        "bytes_sent_sum": F.sum("bytes_sent"),
        "bytes_sent_max": F.max("bytes_sent"),
        "bytes_received_sum": F.sum("bytes_received"),
        "burst_max": F.max("burst_count"),
        "cumulative_max": F.max("cumulative_bytes"),
        "candidate_flags": F.array_sort(F.array_distinct(F.flatten(F.collect_set("candidate_flags")))),
        "sampled": F.max("is_c"),
        "first_seen": F.min("event_time"),
        "last_seen": F.max("event_time"),
    }
    if approx:
        plain |= {"unique_users": F.approx_count_distinct("user_id", 0.01), "bytes_sent_p95": F.percentile_approx("bytes_sent", 0.95, 10_000)}
        out = df.groupBy("url_signature").agg(*[v.alias(k) for k, v in plain.items()])
    else:
        events = saved(df.select("url_signature", *CARRIED, "bytes_sent", "bytes_received", "burst_count", "cumulative_bytes", "candidate_flags", "is_c", "event_time", "user_id"), "flagged")
        out = events.groupBy("url_signature").agg(*[v.alias(k) for k, v in plain.items()])
        users = grouped_distinct(events, ["url_signature"], "user_id", "unique_users")
        p95 = grouped_percentile(events, ["url_signature"], "bytes_sent", 0.95, "bytes_sent_p95")
        out = out.join(users, "url_signature", "left").join(p95, "url_signature", "left").withColumn("unique_users", F.coalesce("unique_users", F.lit(0).cast("long")))
    return out.select("url_signature", *CARRIED, *STATS).withColumn("run_id", F.lit(run_id))


def union_flags(df: DataFrame) -> DataFrame:
    return df.groupBy("url_signature").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("candidate_flags")))), "|").alias("flags"))


def run_counts(df: DataFrame) -> DataFrame:
    distinct = [F.count_distinct(c).alias(n) for c, n in (("url_signature", "signatures"), ("user_id", "users"), ("dest_domain", "domains"))]
    return df.agg(F.count("*").alias("events"), *distinct, *[F.count_if(f"is_{k}").alias(f"count_{k}") for k in "abc"])


def exclusion_counts(df: DataFrame, action: str = "allow") -> DataFrame:
    """Events that an action filter leaves out."""
    there = F.col("action").isNotNull() & (F.col("action") != "")
    return df.agg(F.count("*").alias("events"), F.count_if(there & (F.col("action") != action)).alias("excluded"))


def time_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("event_time").alias("min_time"), F.max("event_time").alias("max_time"))


def input_files_summary(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"))


def failures_by_type(cache: DataFrame) -> DataFrame:
    return cache.where(F.col("error_type").isNotNull()).groupBy("error_type").agg(F.count("*").alias("failures"))


def cost_by_run(costs: DataFrame) -> DataFrame:
    return costs.groupBy("run_id").agg(F.sum("cost_usd").alias("cost_usd"), F.count("*").alias("requests"))


def aggregate_codes(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """dimension, codes: the distinct codes of each dimension, `-099` where a required one has none."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).alias("codes")) for d, c in columns.items()])
    seen = df.select(F.explode(pairs).alias("p")).select("p.dimension", F.explode("p.codes").alias("code")).distinct().groupBy("dimension").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    every = df.sparkSession.createDataFrame([(d, config.DIMENSIONS[d][0]) for d in columns], "dimension string, least int")
    fallback = F.when(F.col("least") > 0, F.array(F.concat("dimension", F.lit("-099")))).otherwise(F.expr("cast(array() as array<string>)"))
    return every.join(seen, "dimension", "left").select("dimension", F.coalesce("codes", fallback).alias("codes"))
