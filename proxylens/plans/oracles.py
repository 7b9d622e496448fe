"""The shared frames as SQL, for queries that are compared with another engine."""

CTES = r"""
WITH log AS (
  SELECT e.event_id, p.page_id, e.ts AS event_time, 'u' || e.user_id AS user_id, 'dept' || (e.user_id % 7) AS user_dept, p.url AS url_full,
    CASE WHEN event_type IN ('click', 'view') THEN 'GET' WHEN event_type = 'signup' THEN 'POST' WHEN event_type = 'purchase' THEN 'PUT' WHEN event_type = 'error' THEN 'POST' END AS http_method,
    CASE WHEN event_type = 'error' THEN 'block' ELSE 'allow' END AS action, round(value * 10000)::BIGINT AS bytes_sent, round(value * 1000)::BIGINT AS bytes_received,
    ['GenAI', 'AI', 'Unknown', 'Business', 'Storage'][(json_extract_string(props, '$.k')::INT % 5) + 1] AS app_category, sha256('evt|' || e.event_id) AS ingest_lineage_hash
  FROM events e JOIN pages p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id),
bare AS (SELECT *, regexp_replace(trim(url_full), '^https?://', '', 'i') AS b FROM log),
parts AS (SELECT * EXCLUDE (b), regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?#]*)', 1)), ':80$', ''), ':443$', '') AS norm_host,
  regexp_replace(regexp_replace(regexp_extract(b, '^[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/+', '/', 'g') AS p0, regexp_extract(b, '^[^?#]*\?([^#]*)', 1) AS q0 FROM bare),
pairs AS (SELECT * EXCLUDE (p0), CASE WHEN p0 = '/' THEN p0 ELSE regexp_replace(p0, '/$', '') END AS p1,
  list_sort(list_filter(list_transform(list_filter(string_split(q0, '&'), lambda x: contains(x, '=')), lambda x, i: {'k': split_part(x, '=', 1), 'pos': i, 'v': substr(x, strpos(x, '=') + 1)}),
    lambda s: s.v <> '' AND NOT starts_with(s.k, 'utm_') AND s.k NOT IN ('gclid', 'dclid', 'fbclid', 'msclkid', 'ttclid', 'twclid', 'igshid', 'mc_cid', 'mc_eid', 'yclid', '_ga', '_gl', 'ref', 'referrer', 'session', 'sid', 'phpsessid', 'srsltid', 'spm', 'utm_id'))) AS kv FROM parts),
raw AS (SELECT * EXCLUDE (p1, q0, kv), p1 AS norm_path_0, coalesce(array_to_string(list_transform(kv, lambda s: s.k || '=' || s.v), '&'), '') AS norm_query_0 FROM pairs),
norm AS (SELECT *, {path} AS norm_path, {query} AS norm_query FROM raw),
counted AS (SELECT *, CASE WHEN norm_query = '' THEN 0 ELSE len(string_split(norm_query, '&')) END::INT AS param_count FROM norm),
tmpl AS (SELECT *, CASE WHEN param_count > 0 THEN norm_path || '?p=' || param_count ELSE norm_path END AS norm_path_template, len(list_filter(string_split(norm_path, '/'), lambda x: x <> ''))::INT AS path_depth,
  CASE WHEN upper(http_method) IN ('GET', 'HEAD', 'OPTIONS') THEN 'GET' WHEN upper(http_method) IN ('POST', 'PUT', 'PATCH', 'DELETE') THEN 'WRITE' ELSE 'OTHER' END AS method_group,
  CASE WHEN bytes_sent <= 1023 THEN 'T' WHEN bytes_sent <= 1048575 THEN 'L' WHEN bytes_sent <= 10485759 THEN 'M' WHEN bytes_sent <= 1073741823 THEN 'H' ELSE 'X' END AS bytes_bucket,
  regexp_matches(norm_query, '(?i)token|auth|key|secret|session|jwt') AS has_auth_token_like, regexp_extract(norm_host, '([^.]+\.[^.]+)$', 1) AS dest_domain FROM counted),
sig AS (SELECT *, sha256(concat_ws('|', norm_host, norm_path_template, '', method_group, bytes_bucket, '1.0')) AS url_signature FROM tmpl),
win AS (SELECT *, count_if(action = 'allow' AND http_method IN ('POST', 'PUT', 'PATCH')) OVER (PARTITION BY user_id, dest_domain, floor(epoch(event_time))::BIGINT // 86400)::BIGINT AS burst_count,
  coalesce(sum(CASE WHEN action = 'allow' THEN bytes_sent END) OVER (PARTITION BY user_id, dest_domain, event_time::DATE), 0)::BIGINT AS cumulative_bytes FROM sig),
ab AS (SELECT *, action = 'allow' AND bytes_sent >= 1048576 AS is_a, action = 'allow' AND http_method IN ('POST', 'PUT', 'PATCH') AND (app_category IN ('GenAI', 'AI', 'Unknown', 'Uncategorized') OR burst_count >= 2 OR cumulative_bytes >= 2000000) AS is_b FROM win),
abc AS (SELECT *, is_b AND bytes_sent < 1048576 AND ('0x' || substr(sha256('run1|' || ingest_lineage_hash), 1, 16))::UBIGINT % 10000 < 2000 AS is_c FROM ab),
det AS (SELECT *, list_filter([CASE WHEN is_a THEN 'A' END, CASE WHEN is_b THEN 'B' END, CASE WHEN is_c THEN 'C' END, CASE WHEN burst_count >= 2 THEN 'burst' END, CASE WHEN cumulative_bytes >= 2000000 THEN 'cumulative' END, CASE WHEN is_c THEN 'sampled' END], lambda x: x IS NOT NULL) AS candidate_flags FROM abc),
stats AS (SELECT url_signature, min(norm_host) AS norm_host, min(norm_path_template) AS norm_path_template, min(dest_domain) AS dest_domain, min(bytes_bucket) AS bytes_bucket, count(*) AS access_count, count(DISTINCT user_id) AS unique_users, sum(bytes_sent)::BIGINT AS bytes_sent_sum, max(bytes_sent) AS bytes_sent_max,
  quantile_cont(bytes_sent, 0.95) AS bytes_sent_p95, sum(bytes_received)::BIGINT AS bytes_received_sum, max(burst_count) AS burst_max, max(cumulative_bytes) AS cumulative_max, list_sort(list_distinct(flatten(list(candidate_flags)))) AS candidate_flags, bool_or(is_c) AS sampled, min(event_time) AS first_seen, max(event_time) AS last_seen FROM det GROUP BY url_signature),
sites AS (SELECT DISTINCT url_signature, norm_host, norm_path_template FROM sig),
hit AS (SELECT *, CASE WHEN regexp_matches(norm_host || norm_path_template, '^m\.') AND regexp_matches(norm_host, '(^|\.)example\.(com|net|org)$') THEN 1 WHEN regexp_matches(norm_host, '(^|\.)example\.org$') AND norm_path_template LIKE '/en/%' THEN 2 WHEN regexp_matches(norm_host, '(^|\.)example\.com$') THEN 3 END AS r FROM sites),
cls AS (SELECT url_signature, norm_host, norm_path_template, 'r' || r AS rule_id, ['host+path_regex', 'host+path_suffix', 'host_suffix'][r] AS match_reason, [2, 2, 3][r]::INT AS tier, coalesce(['GenSite', 'OrgSocial', 'SiteCom'][r], 'Unknown') AS service_name, coalesce(['genai', 'social', 'business'][r], 'unknown') AS usage_type, coalesce(['high', 'medium', 'low'][r], 'medium') AS risk_level, coalesce(['GenAI', 'Social', 'Business'][r], 'Unknown') AS category FROM hit),
cache AS (SELECT url_signature, service_name, usage_type, risk_level, category, CASE WHEN rule_id IS NOT NULL THEN 1.0 ELSE 0.0 END AS confidence, CASE WHEN rule_id IS NOT NULL THEN 'RULE' END AS classification_source, CASE WHEN rule_id IS NOT NULL THEN 'active' ELSE 'needs_review' END AS status, starts_with(url_signature, '0') AS is_human_verified,
  CASE WHEN rule_id IS NOT NULL THEN 0 ELSE (strpos('0123456789abcdef', substr(url_signature, 2, 1)) - 1) % 5 END::INT AS failure_count, CASE WHEN rule_id IS NULL THEN CASE WHEN strpos('0123456789abcdef', substr(url_signature, 2, 1)) - 1 < 8 THEN 'timeout' ELSE 'rate_limit_error' END END AS error_type FROM cls),
act AS (SELECT url_signature, service_name, usage_type, risk_level, category FROM cache WHERE status = 'active'),
ev AS (SELECT det.*, act.* EXCLUDE (url_signature) FROM det LEFT JOIN act USING (url_signature)),
costs AS (SELECT url_signature, 'run' || ((strpos('0123456789abcdef', substr(url_signature, 3, 1)) - 1) % 3) AS run_id, min(event_time) AS at_time, (100 * count(*) / 1000 * 0.01::DOUBLE + 200 * count(*) / 1000 * 0.03::DOUBLE) * 1.2::DOUBLE AS cost_usd FROM sig GROUP BY url_signature),
days AS (SELECT strftime(event_time, '%Y-%m-%d') AS day, sum(bytes_sent)::BIGINT AS size, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS min_time, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS max_time FROM log GROUP BY 1),
files AS (SELECT *, 'proxy' AS vendor, sha256(day) AS file_hash, sha256(day || '|' || size) AS file_id, 'run' || (day(day::DATE) % 3) AS run_id FROM days),
used AS (SELECT user_id, user_dept AS department, coalesce(CASE WHEN service_name = 'GenSite' THEN CASE WHEN strpos('0123456789abcdef', substr(url_signature, 3, 1)) - 1 < 8 THEN 'Claude' ELSE 'DeepL' END ELSE service_name END, 'Unknown') AS service, count(*) AS accesses FROM ev WHERE usage_type = 'genai' OR usage_type IS NULL GROUP BY 1, 2, 3),
spend AS (SELECT *, CASE WHEN service = 'Claude' THEN 20.0 WHEN service = 'DeepL' THEN 6.99 ELSE 15.0 END::DOUBLE AS monthly_cost FROM used),
raw0 AS (SELECT event_id AS k, CASE WHEN event_id % 50 <> 0 THEN strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS event_time, CASE WHEN event_id % 40 <> 7 THEN user_id END AS user_id, '10.0.' || (event_id % 256) || '.1' AS src_ip, CASE WHEN event_id % 60 <> 11 THEN url_full END AS url_full,
  CASE WHEN event_id % 20 IN (3, 4) THEN 0 ELSE greatest(bytes_sent, 0) END AS bytes_sent, greatest(bytes_received, 0) AS bytes_received, ['allow', 'block', 'allow', 'unknown'][(event_id % 4 + 1)::INT] AS action, http_method, app_category FROM log),
vendor_log AS (SELECT *, regexp_replace(trim(url_full), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE k % 100 = 1)),
canon AS (SELECT * EXCLUDE (bare), nullif(lower(regexp_replace(regexp_extract(bare, '^([^/?#]*)', 1), '^.*@', '')), '') AS dest_host, nullif(regexp_extract(bare, '^[^/?#]*([^?#]*)', 1), '') AS url_path, nullif(regexp_extract(url_full, '^[^?#]*\?([^#]*)', 1), '') AS url_query FROM vendor_log),
judged AS (SELECT *, CASE WHEN event_time IS NULL THEN 'no event_time' WHEN user_id IS NULL THEN 'no user_id' WHEN dest_host IS NULL THEN 'no dest_host' END AS reject_reason FROM canon),
dig AS (SELECT *, list_transform(range(1, 13), lambda i: strpos('0123456789abcdef', substr(url_signature, i, 1)) - 1) AS d FROM cls),
rec AS (SELECT url_signature, norm_host, d, CASE WHEN d[4] < 8 THEN ['FS-001'] WHEN d[4] IN (10, 11, 12) THEN ['FS-002'] ELSE []::VARCHAR[] END AS fs, CASE WHEN d[6] < 8 THEN ['UC-002', 'UC-001', 'UC-002'] WHEN d[4] = 13 THEN ['UC-003'] ELSE []::VARCHAR[] END AS uc,
  CASE WHEN d[7] < 6 THEN ['DT-001'] ELSE ['DT-002'] END AS dt, CASE WHEN d[8] > 0 THEN ['CH-001'] ELSE []::VARCHAR[] END AS ch, CASE WHEN d[5] < 14 THEN ['IM-001'] ELSE []::VARCHAR[] END AS im, CASE WHEN d[9] < 15 THEN ['RS-001', 'RS-002'] ELSE []::VARCHAR[] END AS rs, CASE WHEN d[10] < 12 THEN ['LG-001'] ELSE ['LG-002'] END AS lg,
  d[4] IN (10, 11, 12) OR (d[6] >= 8 AND d[4] = 13) OR d[7] >= 6 OR d[10] >= 12 AS legacy FROM dig),
recs AS (SELECT *, list_filter([CASE WHEN len(fs) = 0 THEN 'FS' END, CASE WHEN len(uc) = 0 THEN 'UC' END, CASE WHEN len(ch) = 0 THEN 'CH' END, CASE WHEN len(im) = 0 THEN 'IM' END, CASE WHEN len(rs) = 0 THEN 'RS' END], lambda x: x IS NOT NULL) AS missing FROM rec)
"""
# The redaction rules, in order.
RULES = [
    (r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", ":uuid"),
    (r"(?i)\b[0-9a-f]{16,}\b", ":hex"),
    (r"\b[A-Za-z0-9_-]{20,}\b", ":tok"),
    (r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", ":email"),
    (r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", ":ip"),
    (r"\b[0-9]{6,}\b", ":id"),
]


def redacted(column: str) -> str:
    for pattern, token in RULES:
        column = f"regexp_replace({column}, '{pattern}', '{token}', 'g')"
    return column


def sql(body: str) -> str:
    """body over the shared frames; a body with frames of its own adds them, recursive ones too."""
    shared = CTES.replace("{path}", redacted("norm_path_0")).replace("{query}", redacted("norm_query_0"))
    if body.startswith("WITH RECURSIVE "):
        return f"{shared.replace('WITH ', 'WITH RECURSIVE ', 1)}, {body[15:]}"
    return f"{shared}, {body[5:]}" if body.startswith("WITH ") else f"{shared}\n{body}"
