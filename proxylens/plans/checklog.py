"""Queries over what a run leaves behind: exports read back, orphans of all relations, the running budget, time forms, log order."""

from __future__ import annotations

from pyspark.sql import functions as F

from proxylens.functions import fields
from proxylens.operators import budget, quality, reports, signatures
from proxylens.plans import proxylog as p
from proxylens.plans.register import query
from proxylens.plans.registry import _EVIDENCE
from proxylens.sources import logs
from proxylens.sources.scratch import saved, scratch_path

_NAMES = "coalesce(service_name, 'Unknown')"


@query(
    f"SELECT 'signatures' AS sink, {_NAMES} AS name, count(*) AS rows, sum(access_count)::BIGINT AS accesses FROM stats LEFT JOIN act USING (url_signature) GROUP BY 2"
    f" UNION ALL SELECT 'evidence', service_name, count(*), sum(access_count)::BIGINT FROM ({_EVIDENCE}) GROUP BY 2"
    f" UNION ALL SELECT 'discovery', CASE risk_level WHEN 'high' THEN 'block' WHEN 'low' THEN 'allow' ELSE 'needs_review' END, count(*), 0 FROM ({_EVIDENCE}) GROUP BY 2"
)
def exported_files(spark, sf_dir):
    """The sanitized CSV, the evidence and the discovery log as they are written, read back by plain readers."""
    stats_, known = p.statistics_and_cache(spark, sf_dir)
    paths = {k: scratch_path(spark, f"export-{k}") for k in ("signatures", "evidence", "discovery")}
    evidence = reports.evidence_rows(stats_, known)
    logs.write_sanitized_csv(reports.sanitized_signatures(stats_, known), paths["signatures"])
    logs.write_report_json(evidence, paths["evidence"])
    logs.write_report_json(reports.discovery_log(evidence), paths["discovery"])
    count = lambda df, sink, name, n: df.groupBy(F.lit(sink).alias("sink"), F.col(name).alias("name")).agg(F.count("*").alias("rows"), F.sum(n).cast("long").alias("accesses"))
    table = spark.read.option("header", True).csv(paths["signatures"])
    out = count(table, "signatures", "service_name", F.col("access_count").cast("long"))
    out = out.unionByName(count(spark.read.json(paths["evidence"]), "evidence", "service_name", F.col("access_count")))
    return out.unionByName(count(spark.read.json(paths["discovery"]), "discovery", "decision", F.lit(0)))


_RUN = "'run' || ((strpos('0123456789abcdef', substr(url_signature, 3, 1)) - 1) % 3)"
_ORPHANS = {
    "stats_without_run": f"SELECT count(*) FROM cls WHERE {_RUN} = 'run2'",
    "files_without_run": "SELECT count(*) FROM files WHERE run_id = 'run2'",
    "costs_without_run": "SELECT count(*) FROM costs WHERE run_id = 'run2'",
    "metrics_without_run": "SELECT 2 * count(*) FROM files WHERE run_id = 'run2'",
    "pii_without_run": f"SELECT count(*) FROM (SELECT DISTINCT url_signature, user_id FROM sig WHERE {_RUN} = 'run2')",
    "stats_without_cache": "SELECT count(*) FROM cls WHERE rule_id IS NULL",
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS name, n::BIGINT AS violations, n = 0 AS ok FROM (SELECT ({body}) AS n)" for name, body in _ORPHANS.items()))
def orphan_checks(spark, sf_dir):
    """All relations between a run's tables, where one of three runs was lost and the cache holds what rules know."""
    runs = saved(p.runs(spark, sf_dir).where("run_id != 'run2'"), "runs")
    own = F.concat(F.lit("run"), p.digit(3) % 3)
    sites, files = saved(p.sites(spark, sf_dir).withColumn("run_id", own), "sites"), saved(p.files(spark, sf_dir), "files")
    metrics = files.select("run_id", F.explode(F.array(F.lit("duration_ms"), F.lit("row_count"))).alias("metric_name"))
    pii = p.signed(spark, sf_dir).select("url_signature", "user_id").distinct().withColumn("run_id", own)
    children = {"stats": sites, "files": files, "costs": p.costs(spark, sf_dir), "metrics": metrics, "pii": pii}
    out = quality.check_orphans(sites, p.cache_of(sites.drop("run_id")).where("status = 'active'"), "url_signature", "stats_without_cache")
    for name, child in children.items():
        out = out.unionByName(quality.check_orphans(child, runs, "run_id", f"{name}_without_run"))
    return out


_GATED = "SELECT url_signature, access_count * 0.0084 AS cost, CASE WHEN list_contains(candidate_flags, 'A') THEN 'A' WHEN list_contains(candidate_flags, 'B') THEN 'B' WHEN list_contains(candidate_flags, 'C') THEN 'C' END AS priority FROM stats"


@query(f"SELECT url_signature, priority, \"analyze\", CASE WHEN priority IS NULL THEN 'no_priority_flags' ELSE 'priority_' || priority END || CASE WHEN priority IN ('A', 'B') THEN '_always_analyze' WHEN \"analyze\" THEN '_budget_available' ELSE '_budget_exhausted' END AS reason FROM (SELECT url_signature, priority, coalesce(priority IN ('A', 'B'), false) OR sum(cost) OVER (ORDER BY coalesce(priority, 'Z'), substr(url_signature, 1, 2), url_signature) <= 5.00001 AS \"analyze\" FROM ({_GATED}))")
def budget_running(spark, sf_dir):
    """A budget that is spent in order of priority, with the reason for each signature."""
    queue = p.statistics(spark, sf_dir).select("url_signature", "candidate_flags", (F.col("access_count") * F.lit(0.0084)).alias("cost"))
    return budget.budget_gate(queue, 5.00001, "running").select("url_signature", "priority", "analyze", "reason")


@query("SELECT event_id, CASE event_id % 9 WHEN 8 THEN NULL WHEN 7 THEN strftime(event_time, '%Y-%m-%d 00:00:00') WHEN 3 THEN strftime(event_time - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS event_time FROM log")
def time_forms(spark, sf_dir):
    """The log's times in every form that is read: ISO with and without zone, slashes, access-log style, epoch seconds and milliseconds, a date, and nonsense."""
    t, k = F.col("event_time"), (F.col("event_id") % 9).cast("int")
    shown = lambda form: F.date_format(t, form)
    forms = [shown("yyyy-MM-dd'T'HH:mm:ss'Z'"), shown("yyyy/MM/dd HH:mm:ss"), shown("dd/MMM/yyyy:HH:mm:ss '+0000'"), shown("yyyy-MM-dd'T'HH:mm:ss'+09:00'"), F.unix_seconds(t).cast("string"), F.unix_millis(t).cast("string"), F.concat(F.lit("  "), shown("yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" ")), shown("yyyy-MM-dd"), F.lit("yesterday")]
    written = p.log(spark, sf_dir).select("event_id", F.element_at(F.array(*forms), k + 1).alias("time"))
    return written.select("event_id", F.date_format(fields.parse_event_time(["time"], ["time"]), "yyyy-MM-dd HH:mm:ss").alias("event_time"))


@query("SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, substr(sha256('pepper' || user_id), 1, 16) AS user_hash, dest_domain, url_signature, bytes_sent, coalesce(risk_level, 'unknown') AS risk_level FROM ev ORDER BY strftime(event_time, '%Y-%m-%d %H:%M:%S'), substr(sha256('pepper' || user_id), 1, 16), url_signature, bytes_sent LIMIT 100")
def sanitized_first_events(spark, sf_dir):
    """The export with its limit, which is taken in order of time."""
    events, known = p.events_and_cache(spark, sf_dir)
    return reports.sanitized_events(events, known, "pepper", 100).select("event_time", "user_hash", "dest_domain", "url_signature", "bytes_sent", "risk_level")


@query("SELECT event_id, norm_host, norm_path, norm_query FROM norm")
def hot_url_events(spark, sf_dir):
    """Normal urls where urls of more than 20 events count as hot and are spread over several tasks."""
    return signatures.normalize_urls(p.log(spark, sf_dir), hot=20).select("event_id", "norm_host", "norm_path", "norm_query")
