"""A proxy log over the given tables, and the frames that the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proxylens.operators import budget, detect, domains, rules, signatures, stats
from proxylens.sources.scratch import bucketed, saved

#: Thresholds for these tables; the package's defaults never fire on them.
RUN = "run1"
PARAMS = {"a_bytes": 1 << 20, "burst_n": 2, "window_s": 86_400, "cum_bytes": 2_000_000, "rate": 0.2}
COST = {"n_in": 100, "n_out": 200, "price_in": 0.01, "price_out": 0.03}
RULES = [
    {"rule_id": "r1", "priority": 50, "service_name": "GenSite", "usage_type": "genai", "risk_level": "high", "category": "GenAI", "match": {"domain_suffixes": ["example.com", "example.net", "example.org"], "url_regex": ["^m\\."]}},
    {"rule_id": "r2", "priority": 70, "service_name": "OrgSocial", "usage_type": "social", "risk_level": "medium", "category": "Social", "match": {"domain_suffixes": ["example.org"], "path_prefix": ["/en/"]}},
    {"rule_id": "r3", "priority": 100, "service_name": "SiteCom", "usage_type": "business", "risk_level": "low", "category": "Business", "match": {"domain_suffixes": ["example.com"]}},
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events joined to pages: what a proxy would have logged."""
    events, pages = table(spark, sf_dir, "events"), table(spark, sf_dir, "pages").select("page_id", "url")
    n = pages.agg(F.count("*")).scalar()  # found when the query runs
    joined = events.withColumn("page_id", F.col("event_id") % n).join(pages, "page_id")
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int") % 5
    category = F.when(k == 0, "GenAI").when(k == 1, "AI").when(k == 2, "Unknown").when(k == 3, "Business").when(k == 4, "Storage")
    return joined.select(
        "event_id", "page_id", F.col("ts").cast("timestamp").alias("event_time"), F.concat(F.lit("u"), "user_id").alias("user_id"), F.concat(F.lit("dept"), F.col("user_id") % 7).alias("user_dept"), F.col("url").alias("url_full"),
        F.when(kind.isin("click", "view"), "GET").when(kind == "signup", "POST").when(kind == "purchase", "PUT").when(kind == "error", "POST").alias("http_method"),
        F.when(kind == "error", "block").otherwise("allow").alias("action"), F.round(F.col("value") * 10000).cast("long").alias("bytes_sent"), F.round(F.col("value") * 1000).cast("long").alias("bytes_received"),
        category.alias("app_category"), F.sha2(F.concat(F.lit("evt|"), "event_id"), 256).alias("ingest_lineage_hash"),
    )


def sign(events: DataFrame) -> DataFrame:
    return signatures.sign_events(events, domains.suffix_table(events.sparkSession))


def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sign(log(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detect(signed(spark, sf_dir), RUN, **PARAMS)


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signed events, written once."""
    return saved(signed(spark, sf_dir).drop("pii_hits", "original_path", "original_query", "norm_url", "page_id", "url_full"), "signed")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged events over signed ones that are written once, as their totals and the events themselves both come from them."""
    return detect.detect(kept(spark, sf_dir), RUN, **PARAMS)


def events_and_cache(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The flagged events and the cache of their signatures, both written once, as reports look at them several times."""
    events = saved(found(spark, sf_dir), "flagged")
    return events, saved(cache_of(events.select("url_signature", "norm_host", "norm_path_template").distinct()), "cache")


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.signature_stats(found(spark, sf_dir), RUN)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct signatures."""
    return signed(spark, sf_dir).select("url_signature", "norm_host", "norm_path_template").distinct()


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signatures' classes as a cache: what no rule knows waits for review."""
    return cache_of(sites(spark, sf_dir))


def cache_of(found: DataFrame) -> DataFrame:
    known = rules.classify(found, rules.load_rules(found.sparkSession, RULES))
    digit = F.instr(F.lit("0123456789abcdef"), F.substring("url_signature", 2, 1)) - 1
    matched = F.col("rule_id").isNotNull()
    return known.select(
        "url_signature", "service_name", "usage_type", "risk_level", "category", "confidence", "classification_source", F.when(matched, "active").otherwise("needs_review").alias("status"),
        F.col("url_signature").startswith("0").alias("is_human_verified"), F.when(matched, 0).otherwise(digit % 5).cast("int").alias("failure_count"), F.when(~matched, F.when(digit < 8, "timeout").otherwise("rate_limit_error")).alias("error_type"),
    )


def statistics_and_cache(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The statistics and the cache of their signatures, both written once in buckets of the signature."""
    stats_ = bucketed(statistics(spark, sf_dir), "statistics", "url_signature")
    return stats_, bucketed(cache_of(stats_.select("url_signature", "norm_host", "norm_path_template")), "cache", "url_signature")


def digit(place: int):
    """The signature's hexadecimal digit at a place, 0 to 15."""
    return F.instr(F.lit("0123456789abcdef"), F.substring("url_signature", place, 1)) - 1


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a firewall writes it: strings, with blanks, odd values and rows that occur twice."""
    k = F.col("event_id")
    rows = log(spark, sf_dir).select(
        k.cast("string").alias("event_id"), F.when(k % 50 == 0, "").otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias("start"), F.when(k % 40 == 7, "   ").otherwise(F.col("user_id")).alias("srcuser"),
        F.concat(F.lit("10.0."), k % 256, F.lit(".1")).alias("src"), F.when(k % 60 != 11, F.col("url_full")).alias("url"), F.when(k % 20 == 3, "x").when(k % 20 == 4, "-5").otherwise(F.col("bytes_sent").cast("string")).alias("bytes_sent"),
        F.col("bytes_received").cast("string").alias("bytes_received"), F.element_at(F.array(*map(F.lit, ("ALLOW", "deny", " alert ", "other"))), (k % 4 + 1).cast("int")).alias("action"), F.lower("http_method").alias("http_method"), F.col("app_category").alias("url_category"),
    )
    # the rows that occur twice are repeated in the pass that makes them
    times = F.when(F.col("event_id").cast("long") % 100 == 1, 2).otherwise(1)
    return rows.withColumn("_times", F.explode(F.array_repeat(F.lit(1), times))).drop("_times")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored classification for each signature, in the new form, the old one, or between."""
    return records_of(sites(spark, sf_dir))


def records_of(found: DataFrame) -> DataFrame:
    """The same for signatures that are there already."""
    d4, d6, d7, d10 = digit(4), digit(6), digit(7), digit(10)
    return found.select(
        "url_signature", "norm_host", "norm_path_template", F.when(d4 < 8, "FS-001").alias("fs_code"), F.when(d4.isin(10, 11, 12), "FS-002").when(d4 == 13, "UC-003").when(d4 == 14, "DEPRECATED").alias("fs_uc_code"), F.when(digit(5) < 14, "IM-001").alias("im_code"),
        F.when(d6 < 8, '["UC-002","UC-001","UC-002",5]').when(d6 < 10, "nonsense").alias("uc_codes_json"), F.when(d7 < 6, '["DT-001"]').when(d7 < 8, "[]").alias("dt_codes_json"), F.when(d7 >= 4, "DT-002").alias("dt_code"), F.when(digit(8) > 0, '["CH-001"]').alias("ch_codes_json"),
        F.when(digit(9) < 15, '["RS-001","RS-002"]').alias("rs_codes_json"), F.when(d10 < 12, '["LG-001"]').alias("ev_codes_json"), F.when(d10 >= 8, "LG-002").alias("ev_code"),
    )


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What it would have cost to ask for every signature: run_id, at, cost_usd."""
    digit = F.instr(F.lit("0123456789abcdef"), F.substring("url_signature", 3, 1)) - 1
    seen = signed(spark, sf_dir).groupBy("url_signature").agg(F.min("event_time").alias("at"), F.count("*").alias("n"))
    price = budget.estimate_cost(F.lit(COST["n_in"]) * F.col("n"), F.lit(COST["n_out"]) * F.col("n"), COST["price_in"], COST["price_out"])
    return seen.select("url_signature", F.concat(F.lit("run"), digit % 3).alias("run_id"), "at", price.alias("cost_usd"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each day of the log."""
    day = F.date_format("event_time", "yyyy-MM-dd")
    per = log(spark, sf_dir).groupBy(day.alias("day")).agg(F.sum("bytes_sent").alias("size"), F.date_format(F.min("event_time"), "yyyy-MM-dd HH:mm:ss").alias("min_time"), F.date_format(F.max("event_time"), "yyyy-MM-dd HH:mm:ss").alias("max_time"))
    number = F.dayofmonth(F.to_date("day")) % 3
    return per.select("day", "size", "min_time", "max_time", F.lit("proxy").alias("vendor"), F.sha2("day", 256).alias("file_hash"), F.sha2(F.concat_ws("|", "day", "size"), 256).alias("file_id"), F.concat(F.lit("run"), number).alias("run_id"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir).groupBy("run_id").agg(F.min("min_time").alias("started_at"), F.max("max_time").alias("finished_at"))
