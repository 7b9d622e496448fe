"""All queries over the given tables, by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from proxylens.operators import budget, cache, detect, domains, metrics, quality, reports, rules, signatures, stats
from proxylens.plans import proxylog as p
from proxylens.plans.oracles import sql
from proxylens.plans.register import ORACLES, QUERIES, query
from proxylens.sources.scratch import saved, scratch_path

def clock(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def flags_text(df: DataFrame) -> DataFrame:
    return df.withColumn("candidate_flags", F.array_join("candidate_flags", "|"))


STATS = "SELECT url_signature, norm_host, norm_path_template, dest_domain, bytes_bucket, access_count, unique_users, bytes_sent_sum, bytes_sent_max, round(bytes_sent_p95, 4) AS bytes_sent_p95, bytes_received_sum, burst_max, cumulative_max, array_to_string(candidate_flags, '|') AS candidate_flags, sampled, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen, 'run1' AS run_id FROM stats"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = p.statistics(spark, sf_dir).withColumn("bytes_sent_p95", F.round("bytes_sent_p95", 4))
    return flags_text(df).withColumn("first_seen", clock("first_seen")).withColumn("last_seen", clock("last_seen")).orderBy(F.desc("bytes_sent_sum"), "url_signature")


@query(STATS)
def signature_stats(spark, sf_dir):
    return flagship(spark, sf_dir)


@query("SELECT event_id, norm_host, norm_path, norm_query, norm_host || norm_path || CASE WHEN norm_query <> '' THEN '?' || norm_query ELSE '' END AS norm_url FROM norm")
def normalized_urls(spark, sf_dir):
    return signatures.normalize_urls(p.log(spark, sf_dir)).select("event_id", "norm_host", "norm_path", "norm_query", "norm_url")


@query("SELECT event_id, norm_path_template, path_depth, param_count, method_group, bytes_bucket, has_auth_token_like, url_signature FROM sig")
def event_signatures(spark, sf_dir):
    return p.signed(spark, sf_dir).select("event_id", "norm_path_template", "path_depth", "param_count", "method_group", "bytes_bucket", "has_auth_token_like", "url_signature")


@query("SELECT url_signature, count(*) AS events FROM sig GROUP BY ALL")
def signature_groups(spark, sf_dir):
    return signatures.signature_groups(p.signed(spark, sf_dir))


@query("SELECT event_id, dest_domain FROM sig")
def registrable_domains(spark, sf_dir):
    return p.signed(spark, sf_dir).select("event_id", "dest_domain")


_MAILED = "SELECT sha256(concat_ws('|', 'h.com', '/p?p=2', '', method_group, bytes_bucket, '1.0')) AS url_signature, 'ip=10.0.0.' || (event_id % 3) || '&who=' || user_id || '@example.com' AS q FROM sig"


@query(" UNION ALL ".join(f"SELECT 'run1' AS run_id, url_signature, 'query' AS field_source, '{kind}' AS pii_type, ':{kind}' AS redacted_token, sha256(q) AS original_hash, count(*) AS occurrence_count FROM ({_MAILED}) GROUP BY ALL" for kind in ("email", "ip")))
def pii_audit(spark, sf_dir):
    """The audit of a log whose urls carry the user's mail address and an IP address."""
    mailed = F.concat(F.lit("h.com/p?who="), "user_id", F.lit("@example.com&ip=10.0.0."), F.col("event_id") % 3)
    events = p.log(spark, sf_dir).withColumn("url_full", mailed)
    return signatures.pii_audit(p.sign(events), p.RUN)


@query("SELECT event_id, subset AS key_param_subset, sha256(concat_ws('|', norm_host, norm_path_template, subset, method_group, bytes_bucket, '1.0')) AS url_signature FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(string_split(norm_query, '&'), lambda x: split_part(x, '=', 1) IN ('page', 'id'))), '&'), '') AS subset FROM sig)")
def key_param_signatures(spark, sf_dir):
    """Signatures that tell pages of a listing apart."""
    found = signatures.sign_events(p.log(spark, sf_dir), domains.suffix_table(spark), key_params=["page", "id"])
    return found.select("event_id", "key_param_subset", "url_signature")


@query("SELECT event_id, is_a, is_b, is_c, burst_count, cumulative_bytes, array_to_string(candidate_flags, '|') AS candidate_flags FROM det")
def event_flags(spark, sf_dir):
    return flags_text(p.found(spark, sf_dir)).select("event_id", "is_a", "is_b", "is_c", "burst_count", "cumulative_bytes", "candidate_flags")


@query("SELECT user_id, dest_domain, strftime(event_time, '%Y-%m-%d') AS day, sum(bytes_sent)::BIGINT AS cumulative_bytes FROM sig WHERE action = 'allow' GROUP BY ALL")
def daily_cumulative(spark, sf_dir):
    return detect.daily_cumulative(p.signed(spark, sf_dir)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT user_id, dest_domain, (floor(epoch(event_time))::BIGINT // 300) * 300 AS window_start, count(*) AS burst_count FROM sig WHERE action = 'allow' AND http_method IN ('POST', 'PUT', 'PATCH') GROUP BY ALL")
def burst_counts(spark, sf_dir):
    return detect.burst_counts(p.signed(spark, sf_dir))


for kind in "abc":

    def _signals(spark, sf_dir, kind=kind):
        found = detect.signals(p.found(spark, sf_dir), kind).withColumn("event_time", clock("event_time"))
        return found.select("*", "trigger.*").drop("trigger") if kind == "b" else found

    extra = ", app_category IN ('GenAI', 'AI', 'Unknown', 'Uncategorized') AS high_risk_category, burst_count, cumulative_bytes" if kind == "b" else ""
    QUERIES[f"signals_{kind}"] = _signals
    ORACLES[f"signals_{kind}"] = sql(f"SELECT ingest_lineage_hash, user_id, dest_domain, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, bytes_sent, http_method, app_category, action, url_signature{extra} FROM det WHERE is_{kind}")


@query("SELECT count(*) AS total_events, count_if(is_a)::BIGINT AS count_a, count_if(is_b)::BIGINT AS count_b, count_if(is_c)::BIGINT AS count_c, count_if(burst_count >= 2)::BIGINT AS burst_events, count_if(cumulative_bytes >= 2000000)::BIGINT AS cumulative_events FROM det")
def detection_metadata(spark, sf_dir):
    return detect.detection_metadata(p.found(spark, sf_dir), p.RUN, p.PARAMS).select("total_events", "count_a", "count_b", "count_c", "burst_events", "cumulative_events")


@query("SELECT event_id, bytes_bucket FROM sig WHERE ('0x' || substr(sha256('s1|' || ingest_lineage_hash), 1, 16))::UBIGINT % 10000 < CASE bytes_bucket WHEN 'T' THEN 5000 WHEN 'L' THEN 1000 WHEN 'M' THEN 10000 ELSE 0 END")
def stratified_sample(spark, sf_dir):
    return detect.stratified_sample(p.signed(spark, sf_dir), {"T": 0.5, "L": 0.1, "M": 1.0}, "s1").select("event_id", "bytes_bucket")


@query("SELECT bytes_bucket, count(*) AS events, sum(bytes_sent)::BIGINT AS bytes FROM sig GROUP BY ALL")
def population_profile(spark, sf_dir):
    return detect.population_profile(p.signed(spark, sf_dir))


@query("SELECT url_signature, array_to_string(candidate_flags, '|') AS flags FROM stats")
def union_flags(spark, sf_dir):
    return stats.union_flags(p.found(spark, sf_dir))


@query("SELECT count(*) AS events, count(DISTINCT url_signature) AS signatures, count(DISTINCT user_id) AS users, count(DISTINCT dest_domain) AS domains, count_if(is_a)::BIGINT AS count_a, count_if(is_b)::BIGINT AS count_b, count_if(is_c)::BIGINT AS count_c FROM det")
def run_counts(spark, sf_dir):
    return stats.run_counts(p.found(spark, sf_dir))


@query("SELECT count(*) AS events, count_if(action <> 'allow')::BIGINT AS excluded FROM log")
def exclusion_counts(spark, sf_dir):
    return stats.exclusion_counts(p.log(spark, sf_dir))


@query("SELECT strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS min_time, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS max_time FROM log")
def time_range(spark, sf_dir):
    return stats.time_range(p.log(spark, sf_dir)).select(clock("min_time"), clock("max_time"))


@query("SELECT count(*) AS files, sum(size)::BIGINT AS bytes, min(min_time) AS min_time, max(max_time) AS max_time FROM files")
def input_files_summary(spark, sf_dir):
    return stats.input_files_summary(p.files(spark, sf_dir))


@query("SELECT error_type, count(*) AS failures FROM cache WHERE error_type IS NOT NULL GROUP BY ALL")
def failures_by_type(spark, sf_dir):
    return stats.failures_by_type(p.cache(spark, sf_dir))


@query("SELECT run_id, round(sum(cost_usd), 6) AS cost_usd, count(*) AS requests FROM costs GROUP BY run_id")
def cost_by_run(spark, sf_dir):
    return stats.cost_by_run(p.costs(spark, sf_dir)).withColumn("cost_usd", F.round("cost_usd", 6))


@query("SELECT url_signature, rule_id, match_reason, coalesce(tier, 0)::INT AS tier, service_name, usage_type, risk_level, category FROM cls")
def classified(spark, sf_dir):
    return rules.classify(p.sites(spark, sf_dir), rules.load_rules(spark, p.RULES)).withColumn("tier", F.coalesce("tier", F.lit(0))).select("url_signature", "rule_id", "match_reason", "tier", "service_name", "usage_type", "risk_level", "category")


@query("SELECT rule_id, 'FS,IM,UC,DT,CH,RS,LG' AS missing, count(*) AS signatures, sum(n)::BIGINT AS events FROM cls JOIN (SELECT url_signature, count(*) AS n FROM sig GROUP BY 1) USING (url_signature) WHERE rule_id IS NOT NULL GROUP BY rule_id")
def rules_to_migrate(spark, sf_dir):
    """The rules without codes that the log meets, with what hangs on them."""
    table = rules.load_rules(spark, p.RULES)
    seen = p.signed(spark, sf_dir).groupBy("url_signature").agg(F.first("norm_host").alias("norm_host"), F.first("norm_path_template").alias("norm_path_template"), F.count("*").alias("n"))
    met = rules.match_rules(seen, table).select("url_signature", "rule_id").join(seen, "url_signature").groupBy("rule_id").agg(F.count("*").alias("signatures"), F.sum("n").alias("events"))
    return rules.rules_to_migrate(table).join(met, "rule_id").withColumn("missing", F.array_join("missing", ","))


@query("SELECT count(*) AS signatures, count(rule_id) AS rule_hit, count(*) FILTER (WHERE rule_id IS NOT NULL AND cached = 0) AS new_hits, count(*) - count(rule_id) AS unknown FROM (SELECT *, (strpos('0123456789abcdef', substr(url_signature, 2, 1)) - 1 < 8)::INT AS cached FROM cls)")
def rule_coverage(spark, sf_dir):
    """Half of the signatures are in the cache already."""
    found = p.sites(spark, sf_dir)
    return rules.rule_coverage(found, p.cache_of(found).where(p.digit(2) < 8), rules.match_rules(found, rules.load_rules(spark, p.RULES)))


@query("SELECT url_signature, CASE WHEN norm_host LIKE 'm.%' AND norm_host LIKE '%.example.net' THEN 'low' WHEN norm_host LIKE '%.example.net' THEN 'high' ELSE risk_level END AS risk_level, (norm_host LIKE '%.example.net') AS overridden FROM cls")
def overrides(spark, sf_dir):
    hosts = p.sites(spark, sf_dir).where("norm_host like 'm.%.example.net'").select(F.col("norm_host").alias("key")).distinct()
    suffix = spark.range(1).select(F.lit("example.net").alias("key"), F.lit(False).alias("whole"), F.lit("high").alias("o_risk"))
    entries = suffix.unionByName(hosts.select("key", F.lit(True).alias("whole"), F.lit("low").alias("o_risk"))).select("*", F.lit(None).cast("string").alias("o_usage"), F.lit(False).alias("block"))
    return rules.apply_overrides(rules.classify(p.sites(spark, sf_dir), rules.load_rules(spark, p.RULES)), entries).select("url_signature", "risk_level", "overridden")


@query("SELECT c.url_signature FROM cache c WHERE status = 'active'")
def cache_hits(spark, sf_dir):
    return cache.cache_hits(p.sites(spark, sf_dir), p.cache(spark, sf_dir).where("status = 'active'")).select("url_signature")


@query("SELECT url_signature FROM cache WHERE status = 'needs_review' AND failure_count < 3")
def unknown_signatures(spark, sf_dir):
    return cache.unknown_signatures(p.sites(spark, sf_dir), p.cache(spark, sf_dir)).select("url_signature")


@query("SELECT url_signature, CASE WHEN bytes_sent_sum > 5000000 AND NOT is_human_verified THEN 'high' ELSE risk_level END AS risk_level, service_name, status, is_human_verified FROM cache JOIN stats USING (url_signature)")
def merged_cache(spark, sf_dir):
    stats_, known = p.statistics_and_cache(spark, sf_dir)
    merged, _ = cache.merge_cache(known, stats_.where("bytes_sent_sum > 5000000").select("url_signature", F.lit("high").alias("risk_level")))
    return merged.select("url_signature", "risk_level", "service_name", "status", "is_human_verified")


def _snapshot(spark, sf_dir):
    """The cache at a path, after updates of two parts of 256, and the updates that were refused."""
    path = scratch_path(spark, "cache")
    cache.write_cache(p.cache(spark, sf_dir), path)
    known = cache.read_cache(spark, path).select("url_signature", "service_name").where(F.substring("url_signature", 1, 2).isin("0a", "7f", "33"))
    updates = known.where(p.digit(4) < 12).select("url_signature", F.lit("high").alias("risk_level"), F.lit(True).alias("is_human_verified"))
    fresh = known.where("substr(url_signature, 1, 1) = '3'").select(F.concat("url_signature", F.lit("x")).alias("url_signature"), F.lit("low").alias("risk_level"), F.lit(False).alias("is_human_verified"))
    return path, cache.merge_into(path, saved(updates.unionByName(fresh), "updates"))


@query("SELECT url_signature, CASE WHEN hit AND NOT is_human_verified THEN 'high' ELSE risk_level END AS risk_level, service_name, is_human_verified FROM (SELECT *, substr(url_signature, 1, 2) IN ('0a', '7f', '33') AND strpos('0123456789abcdef', substr(url_signature, 4, 1)) - 1 < 12 AS hit FROM cache) UNION ALL SELECT url_signature || 'x', 'low', NULL, false FROM cache WHERE starts_with(url_signature, '33')")
def cache_snapshot(spark, sf_dir):
    """The cache after a merge that rewrote the touched parts only."""
    path, _ = _snapshot(spark, sf_dir)
    return cache.read_cache(spark, path).select("url_signature", "risk_level", "service_name", "is_human_verified")


@query("SELECT url_signature, 'high' AS risk_level FROM cache WHERE is_human_verified AND substr(url_signature, 1, 2) = '0a' AND strpos('0123456789abcdef', substr(url_signature, 4, 1)) - 1 < 12")
def refused_updates(spark, sf_dir):
    """Updates of rows that a person has verified."""
    return _snapshot(spark, sf_dir)[1].select("url_signature", "risk_level")


@query("SELECT url_signature, CASE WHEN action = 1 AND NOT is_human_verified THEN CASE WHEN failure_count + 1 >= 3 THEN 'failed_permanent' ELSE 'needs_review' END ELSE status END AS status, (failure_count + CASE WHEN action = 1 AND NOT is_human_verified THEN 1 ELSE 0 END)::INT AS failure_count FROM (SELECT c.*, coalesce(b.one, 0) AS action FROM cache c LEFT JOIN (SELECT DISTINCT url_signature, 1 AS one FROM sig WHERE action = 'block') b USING (url_signature))")
def status_transition(spark, sf_dir):
    failures = p.signed(spark, sf_dir).where("action = 'block'").select("url_signature").distinct().withColumn("error_message", F.lit("Timeout while waiting"))
    return cache.status_transition(p.cache(spark, sf_dir), failures).select("url_signature", "status", "failure_count")


@query("SELECT url_signature, max(event_id) AS event_id FROM sig GROUP BY ALL")
def dedupe_updates(spark, sf_dir):
    rows = p.signed(spark, sf_dir).select("url_signature", "event_id", F.col("event_id").alias("seq"))
    return cache.dedupe_updates(rows, ["url_signature"], "seq").select("url_signature", "event_id")


_GATED = "SELECT url_signature, access_count * 0.0084 AS cost, CASE WHEN list_contains(candidate_flags, 'A') THEN 'A' WHEN list_contains(candidate_flags, 'B') THEN 'B' WHEN list_contains(candidate_flags, 'C') THEN 'C' END AS priority FROM stats"


def _queue(spark, sf_dir):
    return p.statistics(spark, sf_dir).select("url_signature", "candidate_flags", (F.col("access_count") * F.lit(0.0084)).alias("cost"))


@query(f"SELECT url_signature, priority, coalesce(priority IN ('A', 'B'), false) OR cost <= 0.3 AS analyze FROM ({_GATED})")
def budget_gate(spark, sf_dir):
    return budget.budget_gate(_queue(spark, sf_dir), 0.3).select("url_signature", "priority", "analyze")


@query("SELECT strftime(at_time, '%Y-%m-%d') AS day, round(sum(cost_usd), 6) AS spent, round(greatest(0.0, 10.0 - sum(cost_usd)), 6) AS remaining FROM costs GROUP BY 1")
def budget_status(spark, sf_dir):
    return budget.budget_status(p.costs(spark, sf_dir), 10.0).select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("spent", 6).alias("spent"), F.round("remaining", 6).alias("remaining"))


@query("SELECT url_signature, substr(url_signature, 1, 2) AS shard, ((row_number() OVER (PARTITION BY substr(url_signature, 1, 2) ORDER BY url_signature) - 1) // 20)::INT AS batch FROM stats")
def batches(spark, sf_dir):
    return budget.make_batches(p.statistics(spark, sf_dir).select("url_signature"), 20)


@query(
    "WITH RECURSIVE q AS (SELECT url_signature, substr(url_signature, 1, 2) AS shard, length(to_json({'norm_host': norm_host, 'norm_path_template': norm_path_template, 'access_count': access_count, 'unique_users': unique_users, 'bytes_sent_sum': bytes_sent_sum})::VARCHAR) AS size, row_number() OVER (PARTITION BY substr(url_signature, 1, 2) ORDER BY url_signature) AS i FROM stats),"
    " walk AS (SELECT url_signature, shard, i, 0 AS batch, 1 AS n, size AS used FROM q WHERE i = 1 UNION ALL SELECT q.url_signature, q.shard, q.i, batch + (w.n = 20 OR used + size > 300)::INT, CASE WHEN w.n = 20 OR used + size > 300 THEN 1 ELSE w.n + 1 END, CASE WHEN w.n = 20 OR used + size > 300 THEN size ELSE used + size END FROM walk w JOIN q ON q.shard = w.shard AND q.i = w.i + 1)"
    " SELECT url_signature, shard, batch FROM walk"
)
def batches_by_chars(spark, sf_dir):
    return budget.make_batches(budget.request_payload(p.statistics(spark, sf_dir)), 20, 300).select("url_signature", "shard", "batch")


@query("SELECT count(*) AS requests, round(sum(cost_usd), 6) AS cost_usd, round(sum(cost_usd) / 10.0, 6) AS utilisation FROM costs")
def cost_budget_metrics(spark, sf_dir):
    return metrics.cost_budget_metrics(p.costs(spark, sf_dir), 10.0)


# -- reports ----------------------------------------------------------------------------------------


def _events_cache(spark, sf_dir):
    return p.events_and_cache(spark, sf_dir)


def _stats_cache(spark, sf_dir):
    return p.statistics_and_cache(spark, sf_dir)


@query("SELECT unnest(['events', 'signatures', 'users', 'high_volume', 'high_risk_small', 'coverage_sample', 'genai_events', 'high_risk_events', 'blocked']) AS metric, unnest([count(*), count(DISTINCT url_signature), count(DISTINCT user_id), count_if(is_a)::BIGINT, count_if(is_b)::BIGINT, count_if(is_c)::BIGINT, count_if(usage_type = 'genai')::BIGINT, count_if(risk_level = 'high')::BIGINT, count_if(action = 'block')::BIGINT]) AS value FROM ev")
def executive_kpi(spark, sf_dir):
    return reports.executive_kpi(*_events_cache(spark, sf_dir))


@query("SELECT service_name, access_count, bytes_sent_sum, signatures, (row_number() OVER (ORDER BY bytes_sent_sum DESC, service_name))::INT AS rank FROM (SELECT service_name || substr(url_signature, 3, 1) AS service_name, sum(access_count)::BIGINT AS access_count, sum(bytes_sent_sum)::BIGINT AS bytes_sent_sum, count(*) AS signatures FROM stats JOIN act USING (url_signature) WHERE usage_type = 'genai' GROUP BY 1) ORDER BY bytes_sent_sum DESC, service_name LIMIT 10")
def top_services(spark, sf_dir):
    """Sixteen services by the signatures' third digit, of which ten are shown."""
    stats_, known = _stats_cache(spark, sf_dir)
    return reports.top_services(stats_, known.withColumn("service_name", F.concat("service_name", F.substring("url_signature", 3, 1))))


@query("SELECT url_signature, service_name, access_count, bytes_sent_sum, (row_number() OVER (ORDER BY bytes_sent_sum DESC, url_signature))::INT AS rank FROM stats JOIN act USING (url_signature) WHERE usage_type = 'genai' ORDER BY bytes_sent_sum DESC, url_signature LIMIT 10")
def top_service_signatures(spark, sf_dir):
    return reports.top_services(*_stats_cache(spark, sf_dir), by="signature")


@query("SELECT user_id, sum(bytes_sent)::BIGINT AS bytes_sent, count(DISTINCT CASE WHEN risk_level = 'high' THEN dest_domain END) AS high_risk_destinations, count_if(usage_type = 'genai')::BIGINT AS genai_accesses, count_if(burst_count >= 2)::BIGINT AS burst_events, round(count_if(risk_level = 'high') / count(*), 6) AS risk_score FROM ev GROUP BY user_id ORDER BY bytes_sent DESC, user_id LIMIT 10")
def top_users(spark, sf_dir):
    return reports.top_users(*_events_cache(spark, sf_dir))


for flag, k in (("A", 1000), ("B", 1000), ("C", 500)):

    def _findings(spark, sf_dir, flag=flag, k=k):
        return reports.findings(*_stats_cache(spark, sf_dir), flag, k)

    extra = ", CASE WHEN list_contains(candidate_flags, 'burst') THEN 'burst' WHEN list_contains(candidate_flags, 'cumulative') THEN 'cumulative' ELSE 'category' END AS trigger_type" if flag == "B" else ""
    QUERIES[f"findings_{flag.lower()}"] = _findings
    ORACLES[f"findings_{flag.lower()}"] = sql(f"SELECT url_signature, norm_host, norm_path_template, access_count, unique_users, bytes_sent_sum, bytes_sent_max, coalesce(service_name, 'Unknown') AS service_name, coalesce(usage_type, 'unknown') AS usage_type, coalesce(risk_level, 'unknown') AS risk_level, coalesce(category, 'Unknown') AS category{extra} FROM stats LEFT JOIN act USING (url_signature) WHERE list_contains(candidate_flags, '{flag}') ORDER BY bytes_sent_sum DESC, url_signature LIMIT {k}")


@query("SELECT user_dept AS department, count(DISTINCT user_id) AS users, count(*) AS events, round(count_if(risk_level = 'high') / count(*) * 100, 4) AS high_risk_pct, round(count(DISTINCT CASE WHEN usage_type = 'genai' THEN url_signature END) / count(DISTINCT url_signature) * 100, 4) AS genai_pct, round(count(*) / count(DISTINCT user_id), 6) AS events_per_user, round(count(*) / count(DISTINCT user_id), 6) AS avg_risk_score FROM ev GROUP BY user_dept")
def department_risk(spark, sf_dir):
    return reports.department_risk(*_events_cache(spark, sf_dir))


_PERIOD = "count(*) AS events, round(count_if(coalesce(usage_type, 'unknown') = 'unknown') / count(*) * 100, 4) AS unknown_pct, round(count_if(usage_type = 'genai') / count(*) * 100, 4) AS genai_pct, round(count_if(risk_level = 'high') / count(*) * 100, 4) AS high_risk_pct, round(count_if(action = 'block') / count(*) * 100, 4) AS blocked_pct FROM ev GROUP BY 1, 2, 3"


@query(f"SELECT 'week' AS kind, strftime(event_time, '%Y-W%V') AS period, strftime(date_trunc('week', event_time), '%Y-%m-%d') AS start, {_PERIOD} UNION ALL SELECT 'month', strftime(event_time, '%Y-%m'), strftime(date_trunc('month', event_time), '%Y-%m-%d'), {_PERIOD}")
def time_series(spark, sf_dir):
    return reports.time_series(*_events_cache(spark, sf_dir))


@query("SELECT dest_domain, coalesce(service_name, 'Unknown') AS service_name, count_if(action = 'allow')::BIGINT AS allowed, count_if(action = 'block')::BIGINT AS blocked, CASE WHEN coalesce(bool_or(risk_level = 'high'), false) THEN 'review_block' ELSE 'align_policy' END AS recommendation FROM ev GROUP BY 1, 2 HAVING count_if(action = 'allow') > 0 AND count_if(action = 'block') > 0")
def policy_gaps(spark, sf_dir):
    return reports.policy_gaps(*_events_cache(spark, sf_dir))


@query("SELECT user_id, dest_domain, count(*) FILTER (WHERE risk_level = 'low') AS low, count(*) FILTER (WHERE risk_level = 'medium') AS medium, count(*) FILTER (WHERE risk_level = 'high') AS high, count(*) FILTER (WHERE risk_level IS NULL) AS \"unknown\" FROM ev GROUP BY user_id, dest_domain")
def risk_map(spark, sf_dir):
    return reports.risk_map(*_events_cache(spark, sf_dir), ["user_id", "dest_domain"])


_RISKS = "count(*) FILTER (WHERE risk_level = 'low') AS low, count(*) FILTER (WHERE risk_level = 'medium') AS medium, count(*) FILTER (WHERE risk_level = 'high') AS high, count(*) FILTER (WHERE risk_level IS NULL) AS \"unknown\""


@query(f"SELECT user_dept, {_RISKS} FROM ev GROUP BY user_dept")
def risk_map_departments(spark, sf_dir):
    return reports.risk_map(*_events_cache(spark, sf_dir), ["user_dept"])


@query(" UNION ALL ".join(f"SELECT '{k}' AS kind, strftime(date_trunc('{k}', event_time), '%Y-%m-%d') AS start, {_RISKS} FROM ev GROUP BY 2" for k in ("week", "month")))
def risk_map_periods(spark, sf_dir):
    return reports.risk_map_periods(*_events_cache(spark, sf_dir))


@query("SELECT count(*) AS population, count_if(len(candidate_flags) > 0)::BIGINT AS extracted, count_if(len(candidate_flags) = 0)::BIGINT AS not_extracted, round(count_if(len(candidate_flags) > 0) / count(*) * 100, 4) AS extracted_pct FROM det")
def audit_population(spark, sf_dir):
    return reports.audit_population(p.found(spark, sf_dir))


@query("SELECT count_if(is_b AND bytes_sent < 1048576)::BIGINT AS pool, count_if(is_c)::BIGINT AS sampled, 0.2 AS rate, round(count_if(is_c) / count_if(is_b AND bytes_sent < 1048576) * 100, 4) AS sampled_pct FROM det")
def audit_sampling(spark, sf_dir):
    return reports.audit_sampling(p.found(spark, sf_dir), 0.2)


@query("SELECT count_if(bytes_sent_max < 1048576)::BIGINT AS small, count_if(bytes_sent_max < 1048576 AND len(candidate_flags) = 0)::BIGINT AS small_unflagged, count_if(bytes_sent_max < 1048576 AND list_contains(candidate_flags, 'B'))::BIGINT AS small_b, count_if(bytes_sent_max < 1048576 AND list_contains(candidate_flags, 'C'))::BIGINT AS small_c FROM stats")
def zero_exclusion(spark, sf_dir):
    return reports.zero_exclusion(p.statistics(spark, sf_dir))


_DIGIT = "strpos('0123456789abcdef', substr(url_signature, {}, 1)) - 1"


@query(f"SELECT count(*) AS signatures, count_if(source = 'RULE')::BIGINT AS by_rule, count_if(source = 'LLM')::BIGINT AS by_llm, count_if(source = 'HUMAN')::BIGINT AS by_human, count_if(state = 'active')::BIGINT AS active, count_if(state = 'needs_review')::BIGINT AS needs_review, count_if(state = 'skipped')::BIGINT AS skipped, count_if(state = 'failed_permanent')::BIGINT AS failed_permanent FROM (SELECT CASE WHEN {_DIGIT.format(5)} < 4 THEN 'LLM' WHEN {_DIGIT.format(5)} = 4 THEN 'HUMAN' ELSE classification_source END AS source, CASE WHEN {_DIGIT.format(6)} = 0 THEN 'skipped' WHEN {_DIGIT.format(6)} = 1 THEN 'failed_permanent' ELSE status END AS state FROM cache)")
def model_usage(spark, sf_dir):
    """Classes from all sources and in all states, by the signatures' digits."""
    known = p.cache(spark, sf_dir)
    sources = F.when(p.digit(5) < 4, "LLM").when(p.digit(5) == 4, "HUMAN").otherwise(F.col("classification_source"))
    states = F.when(p.digit(6) == 0, "skipped").when(p.digit(6) == 1, "failed_permanent").otherwise(F.col("status"))
    return reports.model_usage(known.withColumn("classification_source", sources).withColumn("status", states))


def _spend(spark, sf_dir):
    """Services as users know them: the classes' names, with two of the price list in place of two of the rules' names."""
    events, known = _events_cache(spark, sf_dir)
    named = F.when(F.col("service_name") == "GenSite", F.when(p.digit(3) < 8, "Claude").otherwise("DeepL")).otherwise(F.col("service_name"))
    return reports.priced(reports.usage(events, known.withColumn("service_name", named)))


@query("SELECT user_id, department, service, accesses, monthly_cost FROM spend")
def usage_cost(spark, sf_dir):
    return _spend(spark, sf_dir)


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT service) AS services, round(sum(monthly_cost), 6) AS monthly_cost, round(sum(monthly_cost) * 12, 6) AS annual_cost FROM spend")
def spend_summary(spark, sf_dir):
    return reports.spend_summary(_spend(spark, sf_dir))


@query("WITH u AS (SELECT user_id, department, count(*) AS services, sum(accesses) AS accesses, sum(monthly_cost) AS cost FROM spend GROUP BY 1, 2), d AS (SELECT department, count(*) AS people, count_if(services >= 2) AS dup, count_if(accesses < 5) AS dorm, sum(cost) AS cost FROM u GROUP BY 1), o AS (SELECT sum(people) AS people, count(*) AS depts, sum(dup) AS dup, sum(dorm) AS dorm, count_if(people >= 10) AS cons, sum(cost) AS cost FROM d) SELECT unnest(['duplicate', 'dormant', 'consolidation']) AS kind, unnest([dup, dorm, cons])::BIGINT AS affected, unnest([round(dup * 0.3::DOUBLE * (cost / people), 6), round(dorm * 0.2::DOUBLE * (cost / people), 6), round(cons * 0.25::DOUBLE * (cost / depts), 6)]) AS monthly_savings FROM o")
def savings(spark, sf_dir):
    return reports.savings(_spend(spark, sf_dir))


@query("SELECT department, count(*) AS user_count, sum(accesses)::BIGINT AS accesses, round(sum(monthly_cost), 6) AS monthly_cost FROM spend GROUP BY 1")
def spend_by_department(spark, sf_dir):
    return reports.spend_by(_spend(spark, sf_dir), "department")


@query("SELECT service, count(*) AS user_count, sum(accesses)::BIGINT AS accesses, round(sum(monthly_cost), 6) AS monthly_cost FROM spend GROUP BY 1")
def spend_by_service(spark, sf_dir):
    return reports.spend_by(_spend(spark, sf_dir), "service")


@query("SELECT round(sum(cost_usd), 6) AS cost_usd, any_value(h.hit_rate) AS hit_rate, round(round(sum(cost_usd), 6) * (1 - any_value(h.hit_rate)), 6) AS next_month_usd FROM costs, (SELECT round(count_if(status = 'active') / count(*), 6) AS hit_rate FROM cache) h")
def next_month_cost(spark, sf_dir):
    cost = p.costs(spark, sf_dir).agg(F.round(F.sum("cost_usd"), 6).alias("cost_usd"))
    hits = p.cache(spark, sf_dir).agg(F.round(F.count_if(F.col("status") == "active") / F.count("*"), 6).alias("hit_rate"))
    return reports.next_month_cost(cost, hits)


_EVIDENCE = "SELECT url_signature, coalesce(service_name, 'Unknown') AS service_name, coalesce(usage_type, 'unknown') AS usage_type, coalesce(risk_level, 'unknown') AS risk_level, coalesce(category, 'Unknown') AS category, access_count, unique_users, bytes_sent_sum, array_to_string(candidate_flags, '|') AS candidate_flags FROM stats LEFT JOIN act USING (url_signature)"


@query(_EVIDENCE)
def evidence_rows(spark, sf_dir):
    return reports.evidence_rows(*_stats_cache(spark, sf_dir))


@query(f"SELECT url_signature, service_name, risk_level, CASE risk_level WHEN 'high' THEN 'prohibited' WHEN 'medium' THEN 'restricted' WHEN 'low' THEN 'approved' ELSE 'unclassified' END AS classification, CASE risk_level WHEN 'high' THEN 'block' WHEN 'low' THEN 'allow' ELSE 'needs_review' END AS decision FROM ({_EVIDENCE})")
def discovery_log(spark, sf_dir):
    return reports.discovery_log(reports.evidence_rows(*_stats_cache(spark, sf_dir)))


@query(f"SELECT count(*) AS signatures, sum(access_count)::BIGINT AS accesses, sum(bytes_sent_sum)::BIGINT AS bytes_sent, count_if(usage_type = 'genai')::BIGINT AS genai, count_if(risk_level = 'high')::BIGINT AS high_risk FROM ({_EVIDENCE})")
def bundle_summary(spark, sf_dir):
    return reports.bundle_summary(reports.evidence_rows(*_stats_cache(spark, sf_dir)))


@query("SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, substr(sha256('pepper' || user_id), 1, 16) AS user_hash, dest_domain, url_signature, http_method, action, bytes_sent, coalesce(service_name, 'Unknown') AS service_name, coalesce(usage_type, 'unknown') AS usage_type, coalesce(risk_level, 'unknown') AS risk_level, coalesce(category, 'Unknown') AS category FROM ev")
def sanitized_events(spark, sf_dir):
    return reports.sanitized_events(*_events_cache(spark, sf_dir), "pepper", None)


@query("SELECT url_signature, norm_host, norm_path_template, access_count, unique_users, bytes_sent_sum, coalesce(service_name, 'Unknown') AS service_name, coalesce(usage_type, 'unknown') AS usage_type, coalesce(risk_level, 'unknown') AS risk_level, coalesce(category, 'Unknown') AS category FROM stats LEFT JOIN act USING (url_signature)")
def sanitized_signatures(spark, sf_dir):
    return reports.sanitized_signatures(*_stats_cache(spark, sf_dir))


@query("SELECT r.run_id, started_at, finished_at, round(coalesce(cost, 0), 6) AS total_cost_usd, coalesce(n, 0) AS file_count FROM (SELECT run_id, min(min_time) AS started_at, max(max_time) AS finished_at FROM files GROUP BY 1) r LEFT JOIN (SELECT run_id, sum(cost_usd) AS cost FROM costs GROUP BY 1) c USING (run_id) LEFT JOIN (SELECT run_id, count(DISTINCT file_id) AS n FROM files GROUP BY 1) f USING (run_id)")
def run_summary(spark, sf_dir):
    return reports.run_summary(p.runs(spark, sf_dir), p.costs(spark, sf_dir), p.files(spark, sf_dir)).withColumn("total_cost_usd", F.round("total_cost_usd", 6))


@query("SELECT status, usage_type, count(*) AS signatures, round(avg(confidence), 6) AS avg_confidence, count_if(is_human_verified)::BIGINT AS human_verified FROM cache GROUP BY 1, 2")
def cache_status(spark, sf_dir):
    return reports.cache_status(p.cache(spark, sf_dir))


@query("SELECT service_name, risk_level, count(*) AS signature_count, round(avg(confidence), 6) AS avg_confidence FROM cache WHERE usage_type = 'genai' AND status = 'active' GROUP BY 1, 2")
def genai_summary(spark, sf_dir):
    return reports.genai_summary(p.cache(spark, sf_dir))


@query("SELECT 'classification_source' AS kind, coalesce(classification_source, 'none') AS value, count(*) AS signatures FROM cache GROUP BY 2 UNION ALL SELECT 'usage_type', usage_type, count(*) FROM cache GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM cache GROUP BY 2")
def cache_statistics(spark, sf_dir):
    return reports.cache_statistics(p.cache(spark, sf_dir))


@query("SELECT run_id, min(min_time) AS started_at, max(max_time) AS finished_at FROM files GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2")
def recent_runs(spark, sf_dir):
    return reports.recent_runs(p.runs(spark, sf_dir), 2)


@query(" UNION ALL ".join(f"SELECT '{n}' AS dimension, {e} AS value, count(*) AS events, sum(bytes_sent)::BIGINT AS bytes_sent FROM ev GROUP BY 2" for n, e in (("risk", "coalesce(risk_level, 'unknown')"), ("usage", "coalesce(usage_type, 'unknown')"), ("category", "coalesce(category, 'Unknown')"), ("action", "action"), ("day", "strftime(event_time, '%Y-%m-%d')"))))
def dashboard_series(spark, sf_dir):
    return reports.dashboard_series(*_events_cache(spark, sf_dir))


_PERIODS = " UNION ALL ".join(f"SELECT '{k}' AS kind, strftime(date_trunc('{u}', event_time), '%Y-%m-%d') AS start, count(*) AS total_events, count(DISTINCT user_id) AS unique_users, count_if(usage_type = 'genai')::BIGINT AS genai_events, count_if(risk_level = 'high')::BIGINT AS high_risk_events, sum(bytes_sent)::BIGINT AS bytes_sent_total, round(count_if(coalesce(usage_type, 'unknown') = 'unknown') / count(*) * 100, 4) AS unknown_pct, round(count_if(usage_type = 'genai') / count(*) * 100, 4) AS genai_pct, round(count_if(risk_level = 'high') / count(*) * 100, 4) AS high_risk_pct FROM ev GROUP BY 1, 2" for k, u in (("daily", "day"), ("weekly", "week")))


@query(_PERIODS)
def dashboard_periods(spark, sf_dir):
    return reports.dashboard_periods(*_events_cache(spark, sf_dir))


_LISTED = ", ".join(f"(SELECT to_json(list({{'value': value, 'events': n}} ORDER BY value))::VARCHAR FROM (SELECT {e} AS value, count(*) AS n FROM ev GROUP BY 1)) AS by_{d}" for d, e in (("risk", "coalesce(risk_level, 'unknown')"), ("usage", "coalesce(usage_type, 'unknown')"), ("category", "coalesce(category, 'Unknown')"), ("action", "action")))


@query(f"WITH per AS ({_PERIODS}) SELECT 'run1' AS run_id, {_LISTED}, (SELECT to_json(list({{'start': start, 'total_events': total_events, 'unique_users': unique_users, 'genai_events': genai_events, 'high_risk_events': high_risk_events, 'bytes_sent_total': bytes_sent_total}} ORDER BY start))::VARCHAR FROM per WHERE kind = 'daily') AS daily, (SELECT to_json(list({{'start': start, 'total_events': total_events, 'unique_users': unique_users, 'unknown_pct': unknown_pct, 'genai_pct': genai_pct, 'high_risk_pct': high_risk_pct}} ORDER BY start))::VARCHAR FROM per WHERE kind = 'weekly') AS weekly")
def dashboard_output(spark, sf_dir):
    """The nested row with its parts as JSON."""
    events, known = _events_cache(spark, sf_dir)
    out = reports.dashboard_output(reports.dashboard_series(events, known), reports.dashboard_periods(events, known), p.RUN)
    return out.select("run_id", *[F.to_json(f"summary.{d}").alias(d) for d in ("by_risk", "by_usage", "by_category", "by_action")], *[F.to_json(f"series.{k}").alias(k) for k in ("daily", "weekly")])


@query("SELECT user_id, count(*) AS events, sum(bytes_sent)::BIGINT AS bytes_sent, count_if(risk_level = 'high')::BIGINT AS high_risk FROM ev GROUP BY 1 ORDER BY events DESC, user_id LIMIT 20")
def drilldown_users(spark, sf_dir):
    return reports.drilldown(*_events_cache(spark, sf_dir), "user_id")


@query("SELECT manifest_hash, run_key, substr(run_key, 1, 16) AS run_id FROM (SELECT manifest_hash, sha256(manifest_hash || '|v1|rules1') AS run_key FROM (SELECT sha256(string_agg(line, chr(10) ORDER BY line)) AS manifest_hash FROM (SELECT concat_ws('|', file_hash, vendor, min_time, max_time) AS line FROM files)))")
def run_identity(spark, sf_dir):
    return reports.run_identity(reports.manifest_hash(p.files(spark, sf_dir)), "v1", "rules1")


# -- checks -----------------------------------------------------------------------------------------


_COVERAGE = "SELECT count(*) AS signatures, count(rule_id) AS rule_hit, count(*) - count(rule_id) AS unknown FROM cls"


@query(f"SELECT name, violations, violations = 0 AS ok FROM (SELECT 'coverage_sum' AS name, (SELECT count(*) FILTER (WHERE rule_hit + unknown <> signatures) FROM ({_COVERAGE})) AS violations UNION ALL SELECT 'coverage_range', (SELECT count(*) FILTER (WHERE least(rule_hit, unknown, signatures) < 0 OR rule_hit > signatures) FROM ({_COVERAGE})) UNION ALL SELECT 'stats_without_cache', (SELECT count(*) FROM stats WHERE url_signature NOT IN (SELECT url_signature FROM cache WHERE status = 'active')) UNION ALL SELECT 'costs_without_run', (SELECT count(*) FROM costs WHERE run_id NOT IN (SELECT run_id FROM files WHERE day(day::DATE) > 1)) UNION ALL SELECT 'sanitized', (SELECT count(*) FILTER (WHERE regexp_matches(dest_domain || ' ' || coalesce(service_name, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) FROM ev) UNION ALL SELECT 'risk_values', (SELECT count(*) FILTER (WHERE risk_level IS NULL OR risk_level NOT IN ('low', 'medium', 'high')) FROM ev))")
def quality_checks(spark, sf_dir):
    """Against active rows of the cache, files after a month's first day and events without a class, so that most checks find something."""
    stats_, known = p.statistics_and_cache(spark, sf_dir)
    found = stats_.select("url_signature", "norm_host", "norm_path_template")
    coverage = rules.rule_coverage(found, known, rules.match_rules(found, rules.load_rules(spark, p.RULES)))
    out = quality.check_coverage_sum(coverage).union(quality.check_coverage_range(coverage))
    out = out.union(quality.check_orphans(stats_, known.where("status = 'active'"), "url_signature", "stats_without_cache")).union(quality.check_orphans(p.costs(spark, sf_dir), p.files(spark, sf_dir).where("dayofmonth(to_date(day)) > 1"), "run_id", "costs_without_run"))
    events = p.found(spark, sf_dir)
    return out.union(quality.check_sanitized(reports.sanitized_events(events, known, "pepper", None))).union(quality.check_risk_values(reports.with_class(events, known)))


@query("SELECT count(*) AS compared, round(avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END), 6) AS match_rate, avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) >= 0.98 AS ok FROM (SELECT DISTINCT url_full, method_group, bytes_bucket, url_signature AS a, sha256(concat_ws('|', norm_host, CASE WHEN contains(q0, 'utm_') THEN norm_path || '?p=' || (param_count + len(regexp_extract_all(q0, '(^|&)utm_[^=&]*=[^&]')))::INT ELSE norm_path_template END, '', method_group, bytes_bucket, '1.0')) AS b FROM (SELECT *, regexp_extract(url_full, '^[^?#]*\\?([^#]*)', 1) AS q0 FROM sig))")
def signature_stability(spark, sf_dir):
    """Against a version that keeps tracking parameters: the share of signatures that would stay."""
    new = p.signed(spark, sf_dir)
    query = F.regexp_extract("url_full", r"^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_count(query, F.lit("(^|&)utm_[^=&]*=[^&]")).cast("int")
    bare = new.withColumn("norm_query", F.when(query.contains("utm_"), F.array_join(F.array_repeat(F.lit("k=v"), F.col("param_count") + kept), "&")).otherwise(F.col("norm_query")))
    keyed = lambda df: df.withColumn("key", F.concat_ws("|", "url_full", "method_group", "bytes_bucket"))
    return quality.signature_stability(keyed(signatures.add_signature(bare)), keyed(new), "key")


@query("SELECT count(*) AS compared, round(avg(CASE WHEN usage_type = want THEN 1.0 ELSE 0.0 END), 6) AS accuracy, avg(CASE WHEN usage_type = want THEN 1.0 ELSE 0.0 END) >= 0.95 AS ok FROM (SELECT DISTINCT cls.norm_host, usage_type, want FROM cls JOIN (SELECT norm_host, CASE WHEN 2 * count(*) FILTER (WHERE app_category IN ('GenAI', 'AI')) >= count(*) THEN 'genai' ELSE 'business' END AS want FROM sig GROUP BY 1) w ON cls.norm_host = w.norm_host)")
def rule_accuracy(spark, sf_dir):
    """Against what most events of a host were categorised as."""
    events = p.signed(spark, sf_dir)
    known = rules.classify(p.sites(spark, sf_dir), rules.load_rules(spark, p.RULES))
    most = 2 * F.count_if(F.col("app_category").isin("GenAI", "AI")) >= F.count("*")
    return quality.rule_accuracy(known, events.groupBy("norm_host").agg(F.when(most, "genai").otherwise("business").alias("usage_type")))


from proxylens.plans import rawlog, taxonomylog, ingestlog, vendorlog, checklog  # noqa: E402, F401 (they register their queries)
