"""The classification cache as snapshots: last update wins, human decisions stay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxylens import config
from proxylens.sources.scratch import saved

ALLOWED = ["service_name", "usage_type", "risk_level", "category", "confidence", "rationale", "classification_source", "status", "error_type", "failure_count", "fs_code"]


def dedupe_updates(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("r")).select(*keys, "r.*")


def merge_cache(base: DataFrame, updates: DataFrame, key: str = "url_signature", allowed: Sequence[str] = ALLOWED) -> tuple[DataFrame, DataFrame]:
    """(merged, refused). Allowed columns that the updates carry change, all others stay; rows that a person has verified refuse updates."""
    marked = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c != key], F.lit(True).alias("_there"))
    both = base.withColumn("_old", F.lit(True)).join(marked, F.col(key) == F.col("_key"), "full_outer")
    locked = F.coalesce(F.col("_old") & F.col("is_human_verified"), F.lit(False))
    columns = [F.coalesce(key, "_key").alias(key)]
    for c in base.columns:
        if c == key:
            continue
        new = f"_new_{c}"
        if new not in marked.columns:
            columns.append(F.coalesce(c, F.lit(False)).alias(c) if c == "is_human_verified" else F.col(c))
        elif c in allowed:
            columns.append(F.when(F.col("_there").isNotNull() & ~locked, F.col(new)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.when(F.col("_old").isNull(), F.col(new)).otherwise(F.col(c)).alias(c))
    refused = updates.join(base.where("is_human_verified").select(key), key, "left_semi")
    return both.select(*columns), refused


def part_of(key: str) -> Column:
    """The part of a snapshot that a key is kept in: 256 parts, named so that no part looks like a number."""
    return F.concat(F.lit("p"), F.substring(key, 1, 2))


def write_cache(df: DataFrame, path: str, key: str = "url_signature") -> None:
    """Write the parts of a snapshot that df has rows of, each whole; other parts stay as they are."""
    parted = df.withColumn("part", part_of(key)).repartition("part")
    parted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("part")


def touched_parts(spark: SparkSession, path: str, updates: DataFrame, key: str = "url_signature") -> DataFrame:
    """The rows of the snapshot's parts that updates have keys in. The parts' names, 256 at most, prune the scan."""
    names = [r.part for r in updates.select(part_of(key).alias("part")).distinct().collect()]
    return spark.read.parquet(path).where(F.col("part").isin(names)).drop("part")


def merge_into(path: str, updates: DataFrame, key: str = "url_signature", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """Merge updates, a table, into the snapshot at path and return the refused ones. Only parts with updates are read and written, each replaced whole."""
    base = touched_parts(updates.sparkSession, path, updates, key)
    merged, refused = merge_cache(base, updates, key, allowed)
    refused = saved(refused, "refused")
    write_cache(saved(merged, "merged"), path, key)
    return refused


def cache_hits(sigs: DataFrame, cache: DataFrame) -> DataFrame:
    return sigs.join(cache, "url_signature", "left_semi")


def unknown_signatures(sigs: DataFrame, cache: DataFrame, max_fail: int = 3) -> DataFrame:
    """Signatures that wait for a class: not in the cache, or in review with few failures; not budget-skipped ones."""
    state = cache.select("url_signature", "status", F.coalesce("failure_count", F.lit(0)).alias("failure_count"))
    joined = sigs.join(state, "url_signature", "left")
    waits = F.col("status").isNull() | ~F.col("status").isin("active", "failed_permanent") & (F.col("failure_count") < max_fail)
    return joined.where(waits).drop("status", "failure_count")


def status_transition(cache: DataFrame, failures: DataFrame, max_fail: int = 3) -> DataFrame:
    """cache after failures (url_signature, error_message)."""
    last = failures.groupBy("url_signature").agg(F.max("error_message").alias("error_message"), F.count("*").alias("new_failures"))
    joined = cache.join(last, "url_signature", "left")
    failed = F.col("new_failures").isNotNull() & ~F.coalesce("is_human_verified", F.lit(False))
    count = F.coalesce("failure_count", F.lit(0)) + F.coalesce("new_failures", F.lit(0))
    permanent = classify_error(F.col("error_message"))["permanent"] | (count >= max_fail)
    out = joined.withColumn("status", F.when(failed, F.when(permanent, "failed_permanent").otherwise("needs_review")).otherwise(F.col("status")))
    out = out.withColumn("error_type", F.when(failed, classify_error(F.col("error_message"))["error_type"]).otherwise(F.col("error_type")))
    return out.withColumn("failure_count", F.when(failed, count).otherwise(F.coalesce("failure_count", F.lit(0))).cast("int")).select(*cache.columns)


def classify_error(message: Column) -> Column:
    """struct<error_type, permanent> of a failure's text."""
    text, kind, permanent = F.lower(message), None, F.lit(False)
    for name in config.PERMANENT_ERRORS + config.TRANSIENT_ERRORS:
        kind = F.when(text.contains(name), name) if kind is None else kind.when(text.contains(name), name)
    for name in config.PERMANENT_ERRORS:
        permanent = permanent | F.coalesce(text.contains(name), F.lit(False))
    return F.struct(kind.otherwise("unknown_error").alias("error_type"), permanent.alias("permanent"))


def propagate_codes(stats: DataFrame, cache: DataFrame, columns: Sequence[str] = ("fs_code", "im_code")) -> DataFrame:
    """stats with the codes of active cache rows."""
    active = cache.where("status = 'active'").select("url_signature", *[F.col(c).alias(f"_c_{c}") for c in columns])
    out = stats.join(active, "url_signature", "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"_c_{c}", c) if c in stats.columns else F.col(f"_c_{c}"))
    return out.drop(*[f"_c_{c}" for c in columns])


def backfill_fs_code(cache: DataFrame) -> DataFrame:
    """The old combined code moves to fs_code; active rows without review by a person go to review."""
    needs = F.col("fs_code").isNull() & F.col("fs_uc_code").isNotNull()
    status = F.when(needs & (F.col("status") == "active") & ~F.coalesce("is_human_verified", F.lit(False)), "needs_review").otherwise(F.col("status"))
    return cache.withColumn("status", status).withColumn("fs_code", F.when(needs, F.col("fs_uc_code")).otherwise(F.col("fs_code")))


def mark_budget_skipped(gated: DataFrame) -> DataFrame:
    """Updates for the signatures that the budget leaves out."""
    return gated.where(~F.col("analyze")).select("url_signature", F.lit("skipped").alias("status"), F.col("reason").alias("error_type"))
