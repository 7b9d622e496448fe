"""Data-quality checks: rows of name, violations, ok."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxylens import config
from proxylens.operators.rules import RISKS

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
FORBIDDEN = {"user_id", "src_ip", "device_id", "url_full", "user_agent", "user_dept"}


def verdict(df: DataFrame, name: str) -> DataFrame:
    """df with one count column `violations` as a check's row."""
    return df.select(F.lit(name).alias("name"), F.col("violations").cast("long"), (F.col("violations") == 0).alias("ok"))


def check_coverage_sum(coverage: DataFrame) -> DataFrame:
    return verdict(coverage.agg(F.count_if(F.col("rule_hit") + F.col("unknown") != F.col("signatures")).alias("violations")), "coverage_sum")


def check_coverage_range(coverage: DataFrame) -> DataFrame:
    bad = (F.least("rule_hit", "unknown", "signatures", "new_hits") < 0) | (F.col("rule_hit") > F.col("signatures"))
    return verdict(coverage.agg(F.count_if(bad).alias("violations")), "coverage_range")


def check_orphans(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    return verdict(child.join(parent, key, "left_anti").agg(F.count("*").alias("violations")), name)


def check_sanitized(df: DataFrame) -> DataFrame:
    """Forbidden columns, and strings that look like e-mail addresses."""
    strings = [c for c, t in df.dtypes if t == "string"]
    hits = reduce(lambda a, b: a + b, [F.count_if(F.col(c).rlike(EMAIL)) for c in strings], F.lit(len(FORBIDDEN & set(df.columns))))
    return verdict(df.agg(hits.alias("violations")), "sanitized")


def check_distribution(events: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Shares of A, B and C events outside their bounds."""
    n = F.greatest(F.count("*"), F.lit(1))
    out = reduce(lambda a, b: a + b, [F.when((F.count_if(f"is_{k}") / n).between(lo, hi), 0).otherwise(1) for k, (lo, hi) in bounds.items()])
    return verdict(events.agg(out.alias("violations")), "distribution")


def signature_stability(old: DataFrame, new: DataFrame, key: str = "url_full", least: float = 0.98) -> DataFrame:
    """compared, match_rate, ok of two versions' signatures (distinct by key)."""
    a, b = (d.select(key, F.col("url_signature").alias(n)).distinct() for d, n in ((old, "a"), (new, "b")))
    rate = F.coalesce(F.avg(F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0)), F.lit(1.0))
    return a.join(b, key).agg(F.count("*").alias("compared"), F.round(rate, 6).alias("match_rate"), (rate >= least).alias("ok"))


def rule_accuracy(classified: DataFrame, expected: DataFrame, least: float = 0.95) -> DataFrame:
    """expected: norm_host, usage_type."""
    joined = classified.select("norm_host", F.col("usage_type").alias("got")).distinct().join(expected.select("norm_host", F.col("usage_type").alias("want")), "norm_host")
    rate = F.coalesce(F.avg(F.when(F.col("got") == F.col("want"), 1.0).otherwise(0.0)), F.lit(1.0))
    return joined.agg(F.count("*").alias("compared"), F.round(rate, 6).alias("accuracy"), (rate >= least).alias("ok"))


def check_idempotent(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that are in one table and not in the other, repeats counted."""
    tagged = first.withColumn("_n", F.lit(1)).union(second.withColumn("_n", F.lit(-1)))
    uneven = tagged.groupBy(*first.columns).agg(F.sum("_n").alias("_balance")).where("_balance != 0")
    return verdict(uneven.agg(F.count("*").alias("violations")), "idempotent")


def check_canonical(df: DataFrame) -> DataFrame:
    """name, violations, ok for each rule of the canonical event."""
    tests = {
        "action": F.col("action").isin("allow", "block", "unknown"),
        "bytes_sent": F.col("bytes_sent") >= 0,
        "bytes_received": F.col("bytes_received") >= 0,
        "lineage": F.col("ingest_lineage_hash").rlike("^[a-f0-9]{64}$"),
        "event_time": F.col("event_time").isNotNull(),
        "user_id": F.coalesce("user_id", F.lit("")) != "",
        "dest_host": F.coalesce("dest_host", F.lit("")) != "",
        "dest_domain": F.coalesce("dest_domain", F.lit("")) != "",
        "vendor": F.coalesce(F.col("vendor").isin(list(config.VENDORS)), F.lit(False)),
        "log_type": F.coalesce("log_type", F.lit("")) != "",
        "status_code": F.col("status_code").isNull() | F.col("status_code").between(100, 599),
        "http_method": F.col("http_method").isNull() | F.col("http_method").rlike("^[A-Z]+$"),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.count_if(~F.coalesce(t, F.lit(False))).alias("violations")) for n, t in tests.items() if n == "lineage" or n in df.columns])
    return df.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.name", "r.violations", (F.col("r.violations") == 0).alias("ok"))


def check_risk_values(cache: DataFrame) -> DataFrame:
    return verdict(cache.agg(F.count_if(~F.coalesce(F.col("risk_level").isin(list(RISKS)), F.lit(False))).alias("violations")), "risk_values")
