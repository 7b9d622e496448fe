"""Queries over stored classifications: codes, old and new records, model results, budget and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxylens import config
from proxylens.functions import codes
from proxylens.operators import budget, cache, metrics, quality, reports, rules, stats, taxonomy
from proxylens.plans import proxylog as p
from proxylens.plans.register import query

LISTS = ("fs", "uc", "dt", "ch", "im", "rs", "lg", "ob")


def joined(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def _canon(c: str) -> str:
    return f"list_sort(list_distinct({c}))"


def _text(c: str) -> str:
    return f"array_to_string({c}, '|')"


def _json(c: str) -> str:
    return f"'[' || array_to_string(list_transform({_canon(c)}, lambda x: '\"' || x || '\"'), ',') || ']'"


@query(f"SELECT url_signature, {', '.join(f'{_text(c)} AS {c}' for c in LISTS[:-1])}, '' AS ob, {_text('missing')} AS missing, CASE WHEN legacy THEN 'legacy' ELSE 'new' END AS source_format, legacy OR len(missing) > 0 AS needs_review, '0.1.1' AS taxonomy_schema_version FROM recs")
def taxonomy_records(spark, sf_dir):
    return joined(taxonomy.normalize_taxonomy(p.records(spark, sf_dir)), *LISTS, "missing").select("url_signature", *LISTS, "missing", "source_format", "needs_review", "taxonomy_schema_version")


_NEW = "list_filter([d[4] < 8, d[5] < 14, d[6] < 8, d[7] < 6, d[8] > 0, d[9] < 15, d[10] < 12], lambda x: x)"


@query(f"SELECT url_signature, len({_NEW}) > 0 AS has_new, (d[4] BETWEEN 10 AND 13 OR d[7] >= 4 OR d[10] >= 8) AND len({_NEW}) = 0 AS legacy_only, array_to_string(m, '|') AS missing, (d[4] BETWEEN 10 AND 13 OR d[7] >= 4 OR d[10] >= 8) AND len({_NEW}) = 0 OR len(m) > 0 AS needs_migration FROM (SELECT *, list_filter([CASE WHEN NOT (d[4] < 8 OR d[4] BETWEEN 10 AND 13) THEN 'FS' END, CASE WHEN d[5] >= 14 THEN 'IM' END, CASE WHEN d[6] >= 8 THEN 'UC' END, CASE WHEN d[8] = 0 THEN 'CH' END, CASE WHEN d[9] = 15 THEN 'RS' END], lambda x: x IS NOT NULL) AS m FROM rec)")
def migration_status(spark, sf_dir):
    return joined(taxonomy.migration_status(p.records(spark, sf_dir)), "missing").select("url_signature", "has_new", "legacy_only", "missing", "needs_migration")


@query("SELECT url_signature, fs[1] AS fs_uc_code, dt[1] AS dt_code, ch[1] AS ch_code, rs[1] AS rs_code, lg[1] AS ev_code FROM recs")
def legacy_codes(spark, sf_dir):
    return taxonomy.to_legacy_codes(taxonomy.normalize_taxonomy(p.records(spark, sf_dir))).select("url_signature", "fs_uc_code", "dt_code", "ch_code", "rs_code", "ev_code")


@query(f"SELECT url_signature, fs[1] AS fs_code, im[1] AS im_code, {_json('uc')} AS uc_codes_json, {_json('dt')} AS dt_codes_json, {_json('rs')} AS rs_codes_json, '[]' AS ob_codes_json, 'DEPRECATED' AS fs_uc_code FROM recs")
def stored_records(spark, sf_dir):
    return taxonomy.to_record(taxonomy.normalize_taxonomy(p.records(spark, sf_dir))).select("url_signature", "fs_code", "im_code", "uc_codes_json", "dt_codes_json", "rs_codes_json", "ob_codes_json", "fs_uc_code")


@query(f"SELECT url_signature, {', '.join(f'{_text(_canon(c))} AS {c}' for c in LISTS[:-1])} FROM recs")
def packed_codes(spark, sf_dir):
    """Codes to a map and back."""
    packed = taxonomy.pack_codes(taxonomy.normalize_taxonomy(p.records(spark, sf_dir))).select("url_signature", "codes")
    return joined(taxonomy.unpack_codes(packed), *LISTS[:-1]).select("url_signature", *LISTS[:-1])


@query("SELECT url_signature, array_to_string(list_sort(list_distinct(list_concat(uc, dt, ['DT-001']))), '|') AS merged, coalesce(len(list_filter(list_concat(uc, dt), lambda x: starts_with(x, 'UC-'))), 0)::INT AS of_uc FROM recs")
def merged_codes(spark, sf_dir):
    seen = taxonomy.normalize_taxonomy(p.records(spark, sf_dir))
    both = F.filter(F.concat("uc", "dt"), lambda c: codes.valid_code_format(c, "UC"))
    return seen.select("url_signature", F.array_join(codes.merge_codes(F.col("uc"), F.col("dt"), F.array(F.lit("DT-001"))), "|").alias("merged"), F.size(both).alias("of_uc"))


_UNKNOWN = " UNION ALL ".join(f"SELECT url_signature, '{c.upper()}: unknown code ' || x AS e FROM (SELECT url_signature, unnest({c}) AS x FROM recs) WHERE x LIKE '%-002' AND x NOT LIKE 'LG%' OR x = 'UC-003'" for c in ("fs", "uc", "dt", "rs"))


@query(f"SELECT r.url_signature, coalesce(e.errors, '') AS errors FROM recs r LEFT JOIN (SELECT url_signature, array_to_string(list_sort(list_distinct(list(e))), '; ') AS errors FROM (SELECT url_signature, unnest(missing) || ': too few codes' AS e FROM recs UNION ALL {_UNKNOWN}) GROUP BY 1) e USING (url_signature)")
def assignment_errors(spark, sf_dir):
    found = taxonomy.validate_assignment(taxonomy.normalize_taxonomy(p.records(spark, sf_dir)), taxonomy.load_dictionary(spark), "url_signature")
    return found.withColumn("errors", F.array_join("errors", "; "))


@query("SELECT dimension, array_to_string(list_sort(list_distinct(list(x))), '|') AS codes FROM (" + " UNION ALL ".join(f"SELECT '{c.upper()}' AS dimension, unnest({c}) AS x FROM recs" for c in LISTS[:-1]) + ") GROUP BY 1 UNION ALL SELECT 'OB', '' FROM recs HAVING count(*) >= 0")
def aggregated_codes(spark, sf_dir):
    return joined(stats.aggregate_codes(taxonomy.normalize_taxonomy(p.records(spark, sf_dir)), {d: d.lower() for d in config.DIMENSIONS}), "codes")


_SHOWN = ", ".join(f"{_text(c)} AS {c}_codes" for c in ("uc", "dt", "ch", "rs", "lg"))
_BY_DIMENSION = f"SELECT url_signature, norm_host, norm_path_template, dest_domain, bytes_sent_sum, access_count, unique_users, array_to_string(candidate_flags, '|') AS candidate_flags, strftime(first_seen, '%Y-%m-%dT%H:%M:%S') AS first_seen, strftime(last_seen, '%Y-%m-%dT%H:%M:%S') AS last_seen, service_name, category, usage_type, risk_level, coalesce(classification_source, 'UNKNOWN') AS classification_source, confidence, coalesce(fs[1], '') AS fs_code, coalesce(im[1], '') AS im_code, {_SHOWN}, '' AS ob_codes, '0.1.1' AS taxonomy_version, legacy OR len(missing) > 0 AS needs_review, CASE WHEN legacy THEN 'legacy' ELSE 'new' END AS source_format FROM stats JOIN cache USING (url_signature) JOIN (SELECT * EXCLUDE (norm_host) FROM recs) USING (url_signature)"


def _evidence(spark, sf_dir) -> DataFrame:
    stats_, known = p.statistics_and_cache(spark, sf_dir)
    # the statistics have a row for each signature: the events are not signed again for their records
    records = p.records_of(stats_.select("url_signature", "norm_host", "norm_path_template")).drop("norm_host", "norm_path_template")
    return reports.evidence_by_dimension(stats_, known.join(records, "url_signature"))


@query(_BY_DIMENSION)
def evidence_by_dimension(spark, sf_dir):
    return joined(_evidence(spark, sf_dir), *[f"{c}_codes" for c in ("uc", "dt", "ch", "rs", "lg", "ob")])


@query(f"SELECT url_signature, service_name, usage_type, risk_level, confidence, classification_source, 'FS=' || fs_code || ';IM=' || im_code || ';UC=' || uc_codes || ';DT=' || dt_codes || ';CH=' || ch_codes || ';RS=' || rs_codes || ';LG=' || lg_codes || ';OB=' AS codes FROM ({_BY_DIMENSION})")
def taxonomy_assignments(spark, sf_dir):
    found = reports.taxonomy_assignments(_evidence(spark, sf_dir))
    text = F.concat_ws(";", *[F.concat(F.lit(f"{d}="), F.array_join(F.try_element_at("codes", F.lit(d)), "|")) for d in ("FS", "IM", "UC", "DT", "CH", "RS", "LG", "OB")])
    return found.withColumn("codes", text)


# -- cache and model results -------------------------------------------------------------------------


def _coded(spark, sf_dir) -> DataFrame:
    """The cache with the records' codes."""
    return p.cache(spark, sf_dir).join(p.records(spark, sf_dir).select("url_signature", "fs_code", "fs_uc_code", "im_code"), "url_signature")


@query("SELECT url_signature, CASE WHEN status = 'active' AND d[4] < 8 THEN 'FS-001' END AS fs_code, CASE WHEN status = 'active' AND d[5] < 14 THEN 'IM-001' END AS im_code FROM stats JOIN cache USING (url_signature) JOIN (SELECT url_signature, d FROM rec) USING (url_signature)")
def propagated_codes(spark, sf_dir):
    return cache.propagate_codes(p.sites(spark, sf_dir), _coded(spark, sf_dir)).select("url_signature", "fs_code", "im_code")


@query("SELECT url_signature, CASE WHEN d[4] < 8 THEN 'FS-001' WHEN d[4] IN (10, 11, 12) THEN 'FS-002' WHEN d[4] = 13 THEN 'UC-003' WHEN d[4] = 14 THEN 'DEPRECATED' END AS fs_code, CASE WHEN d[4] BETWEEN 10 AND 14 AND status = 'active' AND NOT is_human_verified THEN 'needs_review' ELSE status END AS status FROM cache JOIN (SELECT url_signature, d FROM rec) USING (url_signature)")
def backfilled_codes(spark, sf_dir):
    return cache.backfill_fs_code(_coded(spark, sf_dir)).select("url_signature", "fs_code", "status")


@query("SELECT url_signature, 'skipped' AS status, CASE WHEN len(list_intersect(candidate_flags, ['C'])) > 0 THEN 'priority_C' ELSE 'no_priority_flags' END || '_budget_exhausted' AS error_type FROM stats WHERE len(list_intersect(candidate_flags, ['A', 'B'])) = 0 AND access_count * 0.0084 > 0.02")
def budget_skipped(spark, sf_dir):
    queue = p.statistics(spark, sf_dir).select("url_signature", "candidate_flags", (F.col("access_count") * F.lit(0.0084)).alias("cost"))
    return cache.mark_budget_skipped(budget.budget_gate(queue, 0.02))


_MESSAGES = ["Error: invalid_api_key given", "HTTP 429 rate_limit_error", "Timeout while waiting", "context_length_exceeded: 9000", "something else", "server_error 500"]
_KINDS = [("invalid_api_key", True), ("rate_limit_error", False), ("timeout", False), ("context_length_exceeded", True), ("unknown_error", False), ("server_error", False)]


@query(f"SELECT url_signature, {[k for k, _ in _KINDS]}[(d[11] % 6 + 1)::INT] AS error_type, {[p_ for _, p_ in _KINDS]}[(d[11] % 6 + 1)::INT] AS permanent FROM rec".replace("True", "true").replace("False", "false"))
def error_classes(spark, sf_dir):
    message = F.element_at(F.array(*map(F.lit, _MESSAGES)), (p.digit(11) % 6 + 1).cast("int"))
    return p.sites(spark, sf_dir).select("url_signature", cache.classify_error(message).alias("e")).select("url_signature", "e.*")


@query("SELECT url_signature, CASE WHEN d[12] / 16.0 < 0.7 THEN 'unknown' ELSE usage_type END AS usage_type FROM cache JOIN (SELECT url_signature, d FROM rec) USING (url_signature)")
def confident_usage(spark, sf_dir):
    return rules.apply_confidence_policy(p.cache(spark, sf_dir).withColumn("confidence", p.digit(12) / 16)).select("url_signature", "usage_type")


def _coded_rules(spark) -> DataFrame:
    full = {"fs_code": "FS-001", "im_code": "IM-001", **{f"{c}_codes": [f"{c.upper()}-001"] for c in ("uc", "dt", "ch", "rs", "lg")}}
    return rules.load_rules(spark, [{**p.RULES[0]}, {**p.RULES[1], **full}, {**p.RULES[2], **full, "uc_codes": []}, {"rule_id": "r4", "priority": 90, "match": {"domain_suffixes": ["example.net"]}, **full}])


@query("SELECT url_signature, CASE WHEN regexp_matches(norm_host, '(^|\\.)example\\.org$') AND norm_path_template LIKE '/en/%' THEN 'r2' ELSE 'r4' END AS rule_id FROM sites WHERE regexp_matches(norm_host, '(^|\\.)example\\.org$') AND norm_path_template LIKE '/en/%' OR regexp_matches(norm_host, '(^|\\.)example\\.net$')")
def strict_rules(spark, sf_dir):
    """Only rules with complete codes."""
    return rules.match_rules(p.sites(spark, sf_dir), _coded_rules(spark), strict=True).select("url_signature", "rule_id")


@query("SELECT url_signature, 'exact' AS rule_id, 'host_exact' AS match_reason, 3 AS tier FROM sites WHERE norm_host = (SELECT min(norm_host) FROM sites) AND url_signature <> (SELECT min(url_signature) FROM sites) UNION ALL SELECT min(url_signature), 'one', 'signature_exact', 1 FROM sites HAVING count(*) > 0")
def exact_rules(spark, sf_dir):
    """A rule for one host as a whole and one for one signature."""
    found = p.sites(spark, sf_dir)
    first = found.agg(F.min("norm_host").alias("h"), F.min("url_signature").alias("s")).first()
    table = rules.load_rules(spark, [{"rule_id": "exact", "match": {"domain_exact": [first.h or "none"]}}, {"rule_id": "one", "match": {"url_signatures": [first.s or "none"]}}])
    return rules.match_rules(found, table).select("url_signature", "rule_id", "match_reason", "tier")


@query("SELECT url_signature, coalesce(fs[1], 'FS-099') AS fs_code, coalesce(im[1], 'IM-099') AS im_code, CASE WHEN len(uc) > 0 THEN array_to_string(uc, '|') ELSE 'UC-099' END AS uc_codes, CASE WHEN len(ch) > 0 THEN 'CH-001' ELSE 'CH-099' END AS ch_codes, array_to_string(list_filter([CASE WHEN d[12] = 15 THEN 'usage_type' END, CASE WHEN d[12] = 14 THEN 'confidence' END], lambda x: x IS NOT NULL), '|') AS faults, CASE WHEN d[12] >= 14 THEN 'needs_review' ELSE 'active' END AS status FROM recs")
def model_results(spark, sf_dir):
    """Outside classifications in old and new form, some of them at fault."""
    d = p.digit(12)
    given = p.records(spark, sf_dir).select("url_signature", "fs_code", "fs_uc_code", "im_code", "uc_codes_json", "dt_codes_json", "dt_code", "ch_codes_json", "rs_codes_json", "ev_codes_json", "ev_code", F.when(d == 15, "games").otherwise("genai").alias("usage_type"), F.lit("low").alias("risk_level"), F.lit("Service").alias("service_name"), F.lit("Category").alias("category"), F.lit("why").alias("rationale"), F.when(d == 14, 1.5).otherwise(0.5).alias("confidence"))
    got = rules.ingest_model_results(given, taxonomy.fallback_codes(taxonomy.load_dictionary(spark)))
    return joined(got, "uc_codes", "ch_codes", "faults").select("url_signature", "fs_code", "im_code", "uc_codes", "ch_codes", "faults", "status")


# -- queue, runs, checks -------------------------------------------------------------------------------


@query("SELECT url_signature, norm_host, norm_path_template, access_count, unique_users, bytes_sent_sum FROM stats")
def request_payloads(spark, sf_dir):
    payload = budget.request_payload(p.statistics(spark, sf_dir))
    return payload.select("url_signature", F.from_json("payload", "norm_host string, norm_path_template string, access_count long, unique_users long, bytes_sent_sum long").alias("j")).select("url_signature", "j.*")


@query("SELECT max(event_id % 5)::INT AS attempts_max, sum(event_id % 7)::BIGINT AS backoff_s, count(*) FILTER (WHERE event_id % 6 = 1) AS rate_limit_events, arg_max(CASE WHEN event_id % 6 = 1 THEN 'rate_limit_error' ELSE 'timeout' END, event_id) FILTER (WHERE event_id % 6 IN (1, 2)) AS last_error FROM log")
def retry_summary(spark, sf_dir):
    k = F.col("event_id")
    attempts = p.log(spark, sf_dir).select((k % 5).cast("int").alias("attempt"), (k % 7).alias("backoff_s"), F.when(k % 6 == 1, "rate_limit_error").when(k % 6 == 2, "timeout").alias("error_type"), k.alias("at"))
    return budget.retry_summary(attempts)


@query("SELECT 'run1' AS run_id, (SELECT count(*) FROM det) AS events, (SELECT count(*) FROM cls) AS signatures, (SELECT count(rule_id) FROM cls) AS rule_hit, round((SELECT count(rule_id) / count(*) FROM cls), 6) AS hit_rate, 'v1' AS taxonomy")
def run_report(spark, sf_dir):
    found = p.sites(spark, sf_dir)
    coverage = rules.rule_coverage(found, p.cache_of(found), rules.match_rules(found, rules.load_rules(spark, p.RULES)))
    row = reports.run_report(stats.run_counts(p.found(spark, sf_dir)), coverage, p.RUN, {"taxonomy": "v1"})
    return row.select("run_id", "counts.events", "coverage.signatures", "coverage.rule_hit", F.round("hit_rate", 6).alias("hit_rate"), F.try_element_at("versions", F.lit("taxonomy")).alias("taxonomy"))


@query("SELECT 'distribution' AS name, ((count(*) FILTER (WHERE is_a) / count(*) NOT BETWEEN 0.001 AND 0.1)::INT + (count(*) FILTER (WHERE is_b) / count(*) NOT BETWEEN 0.01 AND 0.2)::INT)::BIGINT AS violations, violations = 0 AS ok FROM det")
def flag_distribution(spark, sf_dir):
    return quality.check_distribution(p.found(spark, sf_dir), {"a": (0.001, 0.1), "b": (0.01, 0.2)})


@query("SELECT name, violations, violations = 0 AS ok FROM (SELECT 'idempotent' AS name, (SELECT count(DISTINCT url_signature) FROM det WHERE action = 'block' AND url_signature IS NOT NULL) + (SELECT count(DISTINCT url_signature) FROM det WHERE action = 'block' AND url_signature IN (SELECT url_signature FROM det WHERE action <> 'block')) AS violations)")
def idempotency(spark, sf_dir):
    """Events of each signature in two runs, of which the second leaves blocked events out: each signature with a blocked event differs, twice where it is in both."""
    counts = lambda df: df.groupBy("url_signature").agg(F.count("*").alias("n"))
    events = p.found(spark, sf_dir)
    return quality.check_idempotent(counts(events), counts(events.where("action != 'block'")))
