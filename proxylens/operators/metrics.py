"""Observability tables, and the recorder that fills them while stages are written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from proxylens.sources.scratch import saved

STAGES = "run_id string, stage string, started_at timestamp, finished_at timestamp, row_count long, totals map<string, long>"
UNITS = {"duration_ms": "ms", "row_count": "rows", "rows_per_sec": "rows/sec"}


class StageRecorder:
    """Writes the stages of a run and keeps when each began and ended and what passed.

    Counts are taken by an Observation in the pass that writes: nothing is read a second time. A stage whose
    writing fails is not recorded.
    """

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id, self.stages = spark, run_id, []

    def write(self, df: DataFrame, stage: str, totals: dict[str, Column] | None = None) -> DataFrame:
        """df, written and read again; totals: sums that are taken on the way, by name."""
        names = sorted(totals or {})
        seen, began = Observation(f"{self.run_id}-{stage}"), dt.datetime.now(dt.timezone.utc)
        out = saved(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(totals[n]), F.lit(0)).cast("long").alias(n) for n in names]), stage)
        found = seen.get
        self.stages.append((self.run_id, stage, began, dt.datetime.now(dt.timezone.utc), found["rows"], {n: found[n] for n in names}))
        return out

    def log(self) -> DataFrame:
        """A row for each stage that was written."""
        return self.spark.createDataFrame(self.stages, STAGES)


def stage_metrics(log: DataFrame) -> DataFrame:
    """log (run_id, stage, started_at, finished_at, row_count): duration and rows per second of each stage, all its writes together."""
    per = log.groupBy("run_id", "stage").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"), F.sum("row_count").alias("row_count"))
    ms = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1000
    return per.withColumn("duration_ms", ms).withColumn("rows_per_sec", F.when(ms > 0, F.col("row_count") * 1000 / ms).otherwise(0.0))


def metric_rows(log: DataFrame) -> DataFrame:
    """The same in long form: run_id, stage, metric_name, value, unit, started_at, finished_at; totals by their names."""
    plain = stage_metrics(log).select("run_id", "stage", "started_at", "finished_at", F.explode(F.create_map(*[x for n in UNITS for x in (F.lit(n), F.col(n).cast("double"))])).alias("metric_name", "value"))
    units = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    named = plain.withColumn("unit", units[F.col("metric_name")])
    sums = log.select("run_id", "stage", "started_at", "finished_at", F.explode("totals").alias("metric_name", "value")).withColumn("value", F.col("value").cast("double")).withColumn("unit", F.lit("count"))
    return named.unionByName(sums).select("run_id", "stage", "metric_name", "value", "unit", "started_at", "finished_at")


def run_log_summary(log: DataFrame) -> DataFrame:
    """Events of a run log by run and kind, with the rows they name and the last message."""
    last = F.max_by("message", F.struct("timestamp", "message"))
    return log.groupBy("run_id", "event_type").agg(F.count("*").alias("events"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"), last.alias("last_message"))


def cost_budget_metrics(costs: DataFrame, limit: float) -> DataFrame:
    total = F.coalesce(F.sum("cost_usd"), F.lit(0.0))
    return costs.agg(F.count("*").alias("requests"), F.round(total, 6).alias("cost_usd"), F.round(total / limit, 6).alias("utilisation"))
