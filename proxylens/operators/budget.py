"""The queue for an outside classifier: costs, priorities, batches, payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proxylens.sources.scratch import saved

#: Rows of a shard that are packed together.
BLOCK = 1024


def estimate_cost(n_in: Column, n_out: Column, price_in: float, price_out: float, buffer: float = 1.2) -> Column:
    """USD for tokens at prices per thousand."""
    return (n_in / 1000 * price_in + n_out / 1000 * price_out) * buffer


def priority_from_flags(flags: Column) -> Column:
    out = F.when(F.array_contains(flags, "A"), "A")
    for p in "BC":
        out = out.when(F.array_contains(flags, p), p)
    return out


def budget_gate(df: DataFrame, remaining: float, mode: str = "static") -> DataFrame:
    """df (candidate_flags, cost) with priority, analyze, reason. A and B always go; running mode spends in order of priority."""
    ranked = df.withColumn("priority", priority_from_flags(F.col("candidate_flags")))
    always = F.coalesce(F.col("priority").isin("A", "B"), F.lit(False))
    if mode == "running":
        # a shard's sum of costs before it, then the sum within the shard: no window over all rows
        low = ranked.withColumn("_order", F.coalesce("priority", F.lit("Z"))).withColumn("_shard", F.substring("url_signature", 1, 2))
        sums = low.groupBy("_order", "_shard").agg(F.sum("cost").alias("spent"))
        before = Window.orderBy("_order", "_shard").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("_order", "_shard", F.coalesce(F.sum("spent").over(before), F.lit(0.0)).alias("before"))
        within = Window.partitionBy("_order", "_shard").orderBy("url_signature").rowsBetween(Window.unboundedPreceding, 0)
        ranked = low.join(sums, ["_order", "_shard"]).withColumn("_until", F.col("before") + F.sum("cost").over(within)).drop("before")
        afford = F.col("_until") <= remaining
    else:
        afford = F.col("cost") <= remaining
    name = F.when(F.col("priority").isNull(), "no_priority_flags").otherwise(F.concat(F.lit("priority_"), "priority"))
    reason = F.when(always, F.concat(name, F.lit("_always_analyze"))).when(afford, F.concat(name, F.lit("_budget_available"))).otherwise(F.concat(name, F.lit("_budget_exhausted")))
    return ranked.withColumn("analyze", always | afford).withColumn("reason", reason).drop("_order", "_shard", "_until")


def make_batches(df: DataFrame, n: int = 20, chars: int | None = None) -> DataFrame:
    """df (url_signature, payload) with shard and batch: at most n rows and, with chars, so many characters of payload; a longer payload is a batch of its own.

    Shards are the signatures' first two characters. With chars, rows are packed in order: a batch ends before the row that
    does not fit. Where a batch ends depends on where it began, and it begins within n rows of any place; so each
    block of BLOCK rows is folded once for each of its n possible beginnings, the blocks of a shard are
    chained by these, and each block is then dealt out on its own. No task folds a shard row by row.
    """
    sharded = df.withColumn("shard", F.substring("url_signature", 1, 2))
    order = Window.partitionBy("shard").orderBy("url_signature")
    if chars is None:
        return sharded.withColumn("batch", F.floor((F.row_number().over(order) - 1) / n).cast("int"))
    size = F.coalesce(F.length("payload"), F.lit(0))
    ahead = F.collect_list(size).over(order.rowsBetween(0, n - 1))
    zero = F.struct(F.lit(0).alias("rows"), F.lit(0).alias("used"), F.lit(True).alias("open"))

    def pack(a: Column, x: Column) -> Column:
        fits = a["open"] & ((a["rows"] == 0) | (a["used"] + x <= chars))
        return F.struct((a["rows"] + fits.cast("int")).alias("rows"), (a["used"] + F.when(fits, x).otherwise(0)).alias("used"), fits.alias("open"))

    at = F.row_number().over(order) - 1
    placed = sharded.select(F.struct(*sharded.columns).alias("row"), "shard", at.alias("at"), F.aggregate(ahead, zero, pack)["rows"].alias("span"))
    steps = F.array_sort(F.collect_list(F.struct((F.col("at") % BLOCK).alias("at"), "span", "row")))
    blocks = saved(placed.groupBy("shard", F.floor(F.col("at") / BLOCK).cast("int").alias("block")).agg(steps.alias("steps")), "batch-blocks")

    def walk(begin: Column) -> Column:
        """Where the first batch of the next block begins, and how many begin here."""
        start = F.struct(begin.alias("next"), F.lit(0).alias("made"))
        hit = lambda a, s: F.when(s["at"] == a["next"], F.struct((a["next"] + s["span"]).alias("next"), (a["made"] + 1).alias("made"))).otherwise(a)
        return F.aggregate("steps", start, hit, lambda a: F.struct((a["next"] - F.size("steps")).alias("next"), a["made"].alias("made")))

    ways = blocks.select("shard", "block", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), walk).alias("ways"))
    chain = ways.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("block", "ways"))).alias("chain"))
    empty = F.struct(F.lit(0).alias("next"), F.lit(0).alias("made"), F.expr("cast(array() as array<struct<block:int,next:int,made:int>>)").alias("out"))

    def link(a: Column, b: Column) -> Column:
        way = F.get(b["ways"], a["next"])
        own = F.array(F.struct(b["block"].alias("block"), a["next"].alias("next"), a["made"].alias("made")))
        return F.struct(way["next"].alias("next"), (a["made"] + way["made"]).alias("made"), F.concat(a["out"], own).alias("out"))

    begins = chain.select("shard", F.explode(F.aggregate("chain", empty, link)["out"]).alias("b")).select("shard", "b.*")
    first = F.struct(F.col("next"), F.col("made"), F.expr("cast(array() as array<int>)").alias("out"))

    def deal(a: Column, s: Column) -> Column:
        begin = s["at"] == a["next"]
        made = a["made"] + begin.cast("int")
        return F.struct(F.when(begin, a["next"] + s["span"]).otherwise(a["next"]).alias("next"), made.alias("made"), F.concat(a["out"], F.array(made - 1)).alias("out"))

    dealt = blocks.join(begins, ["shard", "block"]).select(F.explode(F.arrays_zip("steps", F.aggregate("steps", first, deal)["out"].alias("batch"))).alias("z"))
    return dealt.select("z.steps.row.*", F.col("z.batch").alias("batch"))


def request_payload(df: DataFrame) -> DataFrame:
    """url_signature and the JSON an outside classifier may see: host, path and counts, no user field."""
    fields = ["norm_host", "norm_path_template", "access_count", "unique_users", "bytes_sent_sum"]
    return df.select("url_signature", F.to_json(F.struct(*fields)).alias("payload"))


def budget_status(costs: DataFrame, limit: float) -> DataFrame:
    """Spent, remaining and utilisation of each UTC day."""
    return costs.groupBy(F.to_date("at").alias("day")).agg(F.sum("cost_usd").alias("spent")).withColumn("remaining", F.greatest(F.lit(0.0), F.lit(float(limit)) - F.col("spent"))).withColumn("utilisation", F.col("spent") / limit)


def retry_summary(attempts: DataFrame) -> DataFrame:
    return attempts.agg(F.max("attempt").alias("attempts_max"), F.sum("backoff_s").alias("backoff_s"), F.count_if(F.col("error_type") == "rate_limit_error").alias("rate_limit_events"), F.max(F.when(F.col("error_type").isNotNull(), F.struct("at", "error_type")))["error_type"].alias("last_error"))


