"""Reports as DataFrame functions. Top-k reports carry a tie-break, so that they are the same on every run."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from proxylens.operators.taxonomy import normalize_taxonomy
from proxylens import config

CLASS = ["service_name", "usage_type", "risk_level", "category"]
BLANKS = {"service_name": "Unknown", "usage_type": "unknown", "risk_level": "unknown", "category": "Unknown"}


def active(cache: DataFrame) -> DataFrame:
    return cache.where("status = 'active'").select("url_signature", *CLASS)


def with_class(df: DataFrame, cache: DataFrame) -> DataFrame:
    """df with the classes of active cache rows, null where there is none."""
    return df.join(active(cache), "url_signature", "left")


def share(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, part / whole * 100).otherwise(0.0), 4)


# -- risk -------------------------------------------------------------------------------------------


def executive_kpi(events: DataFrame, cache: DataFrame) -> DataFrame:
    """metric, value."""
    joined = with_class(events, cache)
    one = joined.agg(F.count("*").alias("events"), F.count_distinct("url_signature").alias("signatures"), F.count_distinct("user_id").alias("users"), F.count_if("is_a").alias("high_volume"), F.count_if("is_b").alias("high_risk_small"), F.count_if("is_c").alias("coverage_sample"), F.count_if(F.col("usage_type") == "genai").alias("genai_events"), F.count_if(F.col("risk_level") == "high").alias("high_risk_events"), F.count_if(F.col("action") == "block").alias("blocked"))
    pairs = ", ".join(f"'{c}', {c}" for c in one.columns)
    return one.selectExpr(f"stack({len(one.columns)}, {pairs}) as (metric, value)")


def top_services(stats: DataFrame, cache: DataFrame, k: int = 10, by: str = "service") -> DataFrame:
    """Generative services by bytes sent; by='signature' ranks signatures instead."""
    found = stats.join(active(cache).where("usage_type = 'genai'"), "url_signature")
    if by == "signature":
        ranked = found.select("url_signature", "service_name", "access_count", "bytes_sent_sum")
        key = "url_signature"
    else:
        ranked = found.groupBy("service_name").agg(F.sum("access_count").alias("access_count"), F.sum("bytes_sent_sum").alias("bytes_sent_sum"), F.count("*").alias("signatures"))
        key = "service_name"
    top = ranked.orderBy(F.desc("bytes_sent_sum"), key).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("bytes_sent_sum"), key)))


def top_users(events: DataFrame, cache: DataFrame, k: int = 10) -> DataFrame:
    """Users by bytes sent; risk_score is the share of their events that are high-risk."""
    joined = with_class(events, cache)
    high = F.col("risk_level") == "high"
    per = joined.groupBy("user_id").agg(F.sum("bytes_sent").alias("bytes_sent"), F.count_distinct(F.when(high, F.col("dest_domain"))).alias("high_risk_destinations"), F.count_if(F.col("usage_type") == "genai").alias("genai_accesses"), F.count_if("burst_hit").alias("burst_events"), F.round(F.count_if(high) / F.count("*"), 6).alias("risk_score"))
    return per.orderBy(F.desc("bytes_sent"), "user_id").limit(k)


def findings(stats: DataFrame, cache: DataFrame, flag: str, k: int) -> DataFrame:
    """Signatures with the flag by bytes sent; for B with the kind of trigger."""
    found = with_class(stats, cache).where(F.array_contains("candidate_flags", flag))
    trigger = F.when(F.array_contains("candidate_flags", "burst"), "burst").when(F.array_contains("candidate_flags", "cumulative"), "cumulative").otherwise("category")
    columns = ["url_signature", "norm_host", "norm_path_template", "access_count", "unique_users", "bytes_sent_sum", "bytes_sent_max", *[F.coalesce(c, F.lit(b)).alias(c) for c, b in BLANKS.items()]]
    return found.select(*columns, *([trigger.alias("trigger_type")] if flag == "B" else [])).orderBy(F.desc("bytes_sent_sum"), "url_signature").limit(k)


def department_risk(events: DataFrame, cache: DataFrame) -> DataFrame:
    joined = with_class(events, cache)
    genai = F.count_distinct(F.when(F.col("usage_type") == "genai", F.col("url_signature")))
    per = joined.groupBy(F.coalesce("user_dept", F.lit("Unknown")).alias("department")).agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("events"), share(F.count_if(F.col("risk_level") == "high"), F.count("*")).alias("high_risk_pct"), share(genai, F.count_distinct("url_signature")).alias("genai_pct"))
    return per.withColumn("events_per_user", F.round(F.col("events") / F.col("users"), 6)).withColumn("avg_risk_score", F.col("events_per_user"))


def time_series(events: DataFrame, cache: DataFrame) -> DataFrame:
    """Weekly and monthly shares, in one pass over events with both periods exploded."""
    joined = with_class(events, cache)
    week = F.concat(F.date_format("event_time", "yyyy"), F.lit("-W"), F.lpad(F.weekofyear("event_time").cast("string"), 2, "0"))
    periods = F.array(F.struct(F.lit("week").alias("kind"), week.alias("period"), F.date_trunc("week", "event_time").alias("start")), F.struct(F.lit("month").alias("kind"), F.date_format("event_time", "yyyy-MM").alias("period"), F.date_trunc("month", "event_time").alias("start")))
    each = joined.select("usage_type", "risk_level", "action", F.explode(periods).alias("p"))
    n = F.count("*")
    return each.groupBy("p.kind", "p.period", F.date_format("p.start", "yyyy-MM-dd").alias("start")).agg(n.alias("events"), share(F.count_if(F.coalesce("usage_type", F.lit("unknown")) == "unknown"), n).alias("unknown_pct"), share(F.count_if(F.col("usage_type") == "genai"), n).alias("genai_pct"), share(F.count_if(F.col("risk_level") == "high"), n).alias("high_risk_pct"), share(F.count_if(F.col("action") == "block"), n).alias("blocked_pct"))


def policy_gaps(events: DataFrame, cache: DataFrame) -> DataFrame:
    """Services of a domain that are both allowed and blocked, with what to do: review_block where risk is high."""
    per = with_class(events, cache).groupBy("dest_domain", F.coalesce("service_name", F.lit("Unknown")).alias("service_name")).agg(F.count_if(F.col("action") == "allow").alias("allowed"), F.count_if(F.col("action") == "block").alias("blocked"), F.coalesce(F.max(F.col("risk_level") == "high"), F.lit(False)).alias("high"))
    return per.where("allowed > 0 and blocked > 0").select("dest_domain", "service_name", "allowed", "blocked", F.when(F.col("high"), "review_block").otherwise("align_policy").alias("recommendation"))


def risk_map(events: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events by keys and risk level."""
    return with_class(events, cache).groupBy(*keys).agg(*[F.count_if(F.coalesce("risk_level", F.lit("unknown")) == r).alias(r) for r in ("low", "medium", "high", "unknown")])


def risk_map_periods(events: DataFrame, cache: DataFrame, units: Sequence[str] = ("week", "month")) -> DataFrame:
    """kind, start and the events by risk level, for each week and month (each event counts in both)."""
    starts = F.array(*[F.struct(F.lit(u).alias("kind"), F.date_format(F.date_trunc(u, "event_time"), "yyyy-MM-dd").alias("start")) for u in units])
    return risk_map(events.withColumn("_at", F.explode(starts)).select("*", "_at.*"), cache, ["kind", "start"])


# -- audit ------------------------------------------------------------------------------------------


def audit_population(events: DataFrame) -> DataFrame:
    n, taken = F.count("*"), F.count_if(F.size("candidate_flags") > 0)
    return events.agg(n.alias("population"), taken.alias("extracted"), (n - taken).alias("not_extracted"), share(taken, n).alias("extracted_pct"))


def audit_sampling(events: DataFrame, rate: float) -> DataFrame:
    pool = F.count_if(F.col("is_b") & (F.col("bytes_sent") < config.MIB))
    return events.agg(pool.alias("pool"), F.count_if("is_c").alias("sampled"), F.lit(rate).alias("rate"), share(F.count_if("is_c"), pool).alias("sampled_pct"))


def zero_exclusion(stats: DataFrame) -> DataFrame:
    """How many signatures of small volume carry no flag, and how many do."""
    small = F.col("bytes_sent_max") < config.MIB
    return stats.agg(F.count_if(small).alias("small"), F.count_if(small & (F.size("candidate_flags") == 0)).alias("small_unflagged"), F.count_if(small & F.array_contains("candidate_flags", "B")).alias("small_b"), F.count_if(small & F.array_contains("candidate_flags", "C")).alias("small_c"))


def model_usage(cache: DataFrame) -> DataFrame:
    n = F.count("*")
    source = F.coalesce("classification_source", F.lit("NONE"))
    return cache.agg(n.alias("signatures"), *[F.count_if(source == s).alias(f"by_{s.lower()}") for s in ("RULE", "LLM", "HUMAN")], *[F.count_if(F.col("status") == s).alias(s) for s in ("active", "needs_review", "skipped", "failed_permanent")])


# -- spend ------------------------------------------------------------------------------------------


def usage(events: DataFrame, cache: DataFrame, include_unknown: bool = True) -> DataFrame:
    """user_id, department, service, accesses of generative (and unclassified) traffic."""
    joined = with_class(events, cache)
    counted = (F.col("usage_type") == "genai") | (F.col("usage_type").isNull() if include_unknown else F.lit(False))
    return joined.where(counted).groupBy("user_id", F.coalesce("user_dept", F.lit("Unknown")).alias("department"), F.coalesce("service_name", F.lit("Unknown")).alias("service")).agg(F.count("*").alias("accesses"))


def priced(used: DataFrame, prices: Sequence[tuple[str, float, float]] = config.PRICES, default: tuple[float, float] = config.DEFAULT_PRICE) -> DataFrame:
    """used with monthly_cost."""
    table = F.broadcast(used.sparkSession.createDataFrame(list(prices), "service string, per_user double, per_access double"))
    joined = used.join(table, "service", "left")
    cost = F.coalesce("per_user", F.lit(default[0])) + F.coalesce("per_access", F.lit(default[1])) * F.col("accesses")
    return joined.withColumn("monthly_cost", cost).drop("per_user", "per_access")


def spend_summary(costs: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("monthly_cost"), F.lit(0.0))
    return costs.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("service").alias("services"), F.round(total, 6).alias("monthly_cost"), F.round(total * 12, 6).alias("annual_cost"))


def savings(costs: DataFrame, assume: dict = config.SAVINGS) -> DataFrame:
    """kind, affected, monthly_savings: several services, little use, large departments."""
    users = costs.groupBy("user_id", "department").agg(F.count("*").alias("services"), F.sum("accesses").alias("accesses"), F.sum("monthly_cost").alias("cost"))
    depts = users.groupBy("department").agg(F.count("*").alias("people"), F.count_if(F.col("services") >= 2).alias("duplicate"), F.count_if(F.col("accesses") < assume["dormant_accesses"]).alias("dormant"), F.sum("cost").alias("cost"))
    one = depts.agg(F.sum("people").alias("people"), F.count("*").alias("departments"), F.sum("duplicate").alias("duplicate"), F.sum("dormant").alias("dormant"), F.count_if(F.col("people") >= assume["department_users"]).alias("consolidation"), F.sum("cost").alias("cost"))
    per_user, per_dept = F.col("cost") / F.col("people"), F.col("cost") / F.col("departments")
    rows = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("affected"), F.round(F.col(k) * assume[k] * unit, 6).alias("monthly_savings")) for k, unit in (("duplicate", per_user), ("dormant", per_user), ("consolidation", per_dept))]
    return one.where("people > 0").select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def spend_by(costs: DataFrame, key: str) -> DataFrame:
    """By department or service; user_count counts pairs of user and service."""
    return costs.groupBy(key).agg(F.count("*").alias("user_count"), F.sum("accesses").alias("accesses"), F.round(F.sum("monthly_cost"), 6).alias("monthly_cost"))


def next_month_cost(cost: DataFrame, hits: DataFrame) -> DataFrame:
    """cost_usd of one row times the share of signatures that the cache misses."""
    return cost.crossJoin(hits).select("cost_usd", "hit_rate", F.round(F.col("cost_usd") * (1 - F.col("hit_rate")), 6).alias("next_month_usd"))


# -- evidence ---------------------------------------------------------------------------------------


def evidence_rows(stats: DataFrame, cache: DataFrame) -> DataFrame:
    """Statistics with classes, every column filled."""
    joined = with_class(stats, cache)
    return joined.select("url_signature", *[F.coalesce(c, F.lit(b)).alias(c) for c, b in BLANKS.items()], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("access_count", "unique_users", "bytes_sent_sum")], F.array_join("candidate_flags", "|").alias("candidate_flags"))


def evidence_by_dimension(stats: DataFrame, cache: DataFrame) -> DataFrame:
    """Statistics with the class and the codes of all eight dimensions, from new columns or old ones, with what that says of the record."""
    facts = stats.select("url_signature", *[F.coalesce(c, F.lit("")).alias(c) for c in ("norm_host", "norm_path_template", "dest_domain")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("bytes_sent_sum", "access_count", "unique_users")], F.array_join("candidate_flags", "|").alias("candidate_flags"), *[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) for c in ("first_seen", "last_seen")])
    own = [c for c in cache.columns if c not in facts.columns or c == "url_signature"]
    joined = normalize_taxonomy(facts.join(cache.select(*own), "url_signature", "left"))
    blanks = {"service_name": "Unknown", "category": "", "usage_type": "unknown", "risk_level": "medium", "classification_source": "UNKNOWN"}
    filled = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(b)).alias(c) for c, b in blanks.items()]
    single = [F.coalesce(F.try_element_at(d, F.lit(1)), F.lit("")).alias(f"{d}_code") for d in ("fs", "im")]
    many = [F.col(d).alias(f"{d}_codes") for d in ("uc", "dt", "ch", "rs", "lg", "ob")]
    return joined.select(*facts.columns, *filled, F.coalesce("confidence", F.lit(0.0)).alias("confidence"), *single, *many, F.col("taxonomy_schema_version").alias("taxonomy_version"), "needs_review", "source_format")


def taxonomy_assignments(evidence: DataFrame) -> DataFrame:
    """A row for each signature of evidence_by_dimension: its class and a map of dimension to codes."""
    one = lambda c: F.filter(F.array(c), lambda x: x != "")
    codes = [x for d in ("FS", "IM", "UC", "DT", "CH", "RS", "LG", "OB") for x in (F.lit(d), one(F.col(f"{d.lower()}_code")) if d in ("FS", "IM") else F.col(f"{d.lower()}_codes"))]
    return evidence.select("url_signature", "service_name", "usage_type", "risk_level", "confidence", "classification_source", F.create_map(*codes).alias("codes"))


def discovery_log(evidence: DataFrame) -> DataFrame:
    """What was found and what is decided: high is blocked, low allowed, the rest reviewed."""
    risk = F.col("risk_level")
    return evidence.select("url_signature", "service_name", "risk_level", F.when(risk == "high", "prohibited").when(risk == "medium", "restricted").when(risk == "low", "approved").otherwise("unclassified").alias("classification"), F.when(risk == "high", "block").when(risk == "low", "allow").otherwise("needs_review").alias("decision"))


def bundle_summary(evidence: DataFrame) -> DataFrame:
    return evidence.agg(F.count("*").alias("signatures"), F.sum("access_count").alias("accesses"), F.sum("bytes_sent_sum").alias("bytes_sent"), F.count_if(F.col("usage_type") == "genai").alias("genai"), F.count_if(F.col("risk_level") == "high").alias("high_risk"))


def sanitized_events(events: DataFrame, cache: DataFrame, salt: str, most: int | None = 100_000) -> DataFrame:
    """Events without personal fields: a salted hash for the user, host and class columns; the report's limit of rows, or all."""
    user = F.substring(F.sha2(F.concat(F.lit(salt), F.coalesce("user_id", F.lit(""))), 256), 1, 16)
    out = with_class(events, cache).select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), user.alias("user_hash"), "dest_domain", "url_signature", "http_method", "action", "bytes_sent", *[F.coalesce(c, F.lit(b)).alias(c) for c, b in BLANKS.items()])
    return out if most is None else out.orderBy("event_time", "user_hash", "url_signature", "bytes_sent").limit(most)


def sanitized_signatures(stats: DataFrame, cache: DataFrame) -> DataFrame:
    return with_class(stats, cache).select("url_signature", "norm_host", "norm_path_template", "access_count", "unique_users", "bytes_sent_sum", *[F.coalesce(c, F.lit(b)).alias(c) for c, b in BLANKS.items()])


# -- runs and cache ---------------------------------------------------------------------------------


def run_summary(runs: DataFrame, costs: DataFrame, files: DataFrame) -> DataFrame:
    """Runs with cost and files, each aggregated before it is joined."""
    cost = costs.groupBy("run_id").agg(F.sum("cost_usd").alias("total_cost_usd"))
    count = files.groupBy("run_id").agg(F.count_distinct("file_id").alias("file_count"))
    return runs.join(cost, "run_id", "left").join(count, "run_id", "left").withColumn("total_cost_usd", F.coalesce("total_cost_usd", F.lit(0.0))).withColumn("file_count", F.coalesce("file_count", F.lit(0)))


def cache_status(cache: DataFrame) -> DataFrame:
    return cache.groupBy("status", "usage_type").agg(F.count("*").alias("signatures"), F.round(F.avg("confidence"), 6).alias("avg_confidence"), F.count_if("is_human_verified").alias("human_verified"))


def genai_summary(cache: DataFrame) -> DataFrame:
    return cache.where("usage_type = 'genai' and status = 'active'").groupBy("service_name", "risk_level").agg(F.count("*").alias("signature_count"), F.round(F.avg("confidence"), 6).alias("avg_confidence"))


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id").limit(n)


def cache_statistics(cache: DataFrame) -> DataFrame:
    """kind, value, signatures: the cache by source, usage and status in one pass."""
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.coalesce(c, F.lit("none")).alias("value")) for c in ("classification_source", "usage_type", "status")])
    return cache.select(F.explode(kinds).alias("k")).groupBy("k.kind", "k.value").agg(F.count("*").alias("signatures"))


def dashboard_series(events: DataFrame, cache: DataFrame) -> DataFrame:
    """dimension, value, events, bytes_sent by risk, usage, category, action and day, in one pass."""
    joined = with_class(events, cache)
    values = [("risk", F.coalesce("risk_level", F.lit("unknown"))), ("usage", F.coalesce("usage_type", F.lit("unknown"))), ("category", F.coalesce("category", F.lit("Unknown"))), ("action", F.col("action")), ("day", F.date_format("event_time", "yyyy-MM-dd"))]
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), v.alias("value")) for n, v in values])
    return joined.select("bytes_sent", F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("events"), F.sum("bytes_sent").alias("bytes_sent"))


def dashboard_periods(events: DataFrame, cache: DataFrame) -> DataFrame:
    """kind, start and the counts and shares of each day and each week, in one pass."""
    at = lambda unit: F.date_format(F.date_trunc(unit, "event_time"), "yyyy-MM-dd")
    periods = F.array(*[F.struct(F.lit(k).alias("kind"), at(u).alias("start")) for k, u in (("daily", "day"), ("weekly", "week"))])
    each = with_class(events, cache).select("user_id", "usage_type", "risk_level", "bytes_sent", F.explode(periods).alias("p"))
    n, genai, high = F.count("*"), F.count_if(F.col("usage_type") == "genai"), F.count_if(F.col("risk_level") == "high")
    counts = [n.alias("total_events"), F.count_distinct("user_id").alias("unique_users"), genai.alias("genai_events"), high.alias("high_risk_events"), F.sum("bytes_sent").alias("bytes_sent_total")]
    unknown = F.count_if(F.coalesce("usage_type", F.lit("unknown")) == "unknown")
    return each.groupBy("p.kind", "p.start").agg(*counts, share(unknown, n).alias("unknown_pct"), share(genai, n).alias("genai_pct"), share(high, n).alias("high_risk_pct"))


def dashboard_output(series: DataFrame, periods: DataFrame, run_id: str) -> DataFrame:
    """One nested row from dashboard_series and dashboard_periods: a list for each dimension, daily and weekly series. It has a line a day and a value, so it stays small."""

    def sorted_list(*columns: str, when: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(when, F.struct(*columns))))

    parts = {f"by_{d}": sorted_list("value", "events", when=F.col("dimension") == d) for d in ("risk", "usage", "category", "action")}
    summary = series.agg(*[c.alias(n) for n, c in parts.items()])
    daily = sorted_list("start", "total_events", "unique_users", "genai_events", "high_risk_events", "bytes_sent_total", when=F.col("kind") == "daily")
    weekly = sorted_list("start", "total_events", "unique_users", "unknown_pct", "genai_pct", "high_risk_pct", when=F.col("kind") == "weekly")
    both = summary.crossJoin(periods.agg(daily.alias("daily"), weekly.alias("weekly")))
    return both.select(F.lit(run_id).alias("run_id"), F.struct(*parts).alias("summary"), F.struct("daily", "weekly").alias("series"))


def drilldown(events: DataFrame, cache: DataFrame, key: str, k: int = 20) -> DataFrame:
    per = with_class(events, cache).groupBy(key).agg(F.count("*").alias("events"), F.sum("bytes_sent").alias("bytes_sent"), F.count_if(F.col("risk_level") == "high").alias("high_risk"))
    return per.orderBy(F.desc("events"), key).limit(k)


def _hash_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row: the hash of all lines, joined by line feeds."""
    digest, first = hashlib.sha256(), True
    for pdf in batches:
        for line in pdf["line"]:
            digest.update(("" if first else "\n").encode() + line.encode())
            first = False
    yield pd.DataFrame({"manifest_hash": [digest.hexdigest()]})


def manifest_hash(files: DataFrame) -> DataFrame:
    """One row: sha256 of the sorted lines hash|vendor|min|max. One task sorts the lines, a line a file, on disk if need be, and hashes them as they come."""
    lines = files.select(F.concat_ws("|", "file_hash", "vendor", "min_time", "max_time").alias("line"))
    hashed = lines.repartition(1).sortWithinPartitions("line").mapInPandas(_hash_lines, "manifest_hash string")
    return hashed.agg(F.coalesce(F.max("manifest_hash"), F.sha2(F.lit(""), 256)).alias("manifest_hash"))


def run_identity(manifest: DataFrame, *parts: str) -> DataFrame:
    """run_key from the manifest and the settings, run_id from its first 16 characters."""
    key = F.sha2(F.concat_ws("|", "manifest_hash", *map(F.lit, parts)), 256)
    return manifest.select("manifest_hash", key.alias("run_key"), F.substring(key, 1, 16).alias("run_id"))


def run_report(counts: DataFrame, coverage: DataFrame, run_id: str, versions: dict[str, str]) -> DataFrame:
    """One row: counts, coverage, hit rate and versions."""
    c, v = F.struct(*counts.columns), F.struct(*coverage.columns)
    joined = counts.select(c.alias("counts")).crossJoin(coverage.select(v.alias("coverage")))
    rate = F.when(F.col("coverage.signatures") > 0, F.col("coverage.rule_hit") / F.col("coverage.signatures")).otherwise(0.0)
    return joined.select(F.lit(run_id).alias("run_id"), "counts", "coverage", rate.alias("hit_rate"), F.create_map(*[F.lit(x) for kv in sorted(versions.items()) for x in kv]).alias("versions"))


