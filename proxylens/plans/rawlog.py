"""Queries over the log as a firewall writes it: reading, canonical events, rejects, partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxylens.operators import events, quality
from proxylens.plans import proxylog as p
from proxylens.plans.register import query
from proxylens.sources import logs
from proxylens.sources.scratch import saved, scratch_path

VENDOR = "paloalto"


def canonical(spark, sf_dir) -> DataFrame:
    return events.to_canonical(p.raw_log(spark, sf_dir), VENDOR)


def shown(df: DataFrame) -> DataFrame:
    return df.select(F.col("raw_event_id").cast("long").alias("event_id"), F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "vendor", "log_type", "user_id", "src_ip", "dest_host", "url_path", "url_query", "http_method", "action", "app_category", "bytes_sent", "bytes_received", "reject_reason")


_CANONICAL = "SELECT k AS event_id, event_time, 'paloalto' AS vendor, 'firewall' AS log_type, user_id, src_ip, dest_host, url_path, url_query, http_method, action, app_category, bytes_sent, bytes_received, reject_reason FROM judged"


@query(_CANONICAL)
def canonical_events(spark, sf_dir):
    return shown(canonical(spark, sf_dir))


@query(_CANONICAL)
def read_csv_log(spark, sf_dir):
    """The same after a round through CSV files and the reader that finds the separator."""
    path = scratch_path(spark, "raw-log")
    p.raw_log(spark, sf_dir).write.option("header", True).option("sep", ";").csv(path)
    return shown(events.to_canonical(logs.read_vendor(spark, path).drop("_file"), VENDOR))


@query("SELECT count(*) AS rows, count(*) AS lineages FROM judged")
def lineage_counts(spark, sf_dir):
    """Rows that occur twice have lineages of their own."""
    return canonical(spark, sf_dir).agg(F.count("*").alias("rows"), F.count_distinct("ingest_lineage_hash").alias("lineages"))


@query("SELECT coalesce(reject_reason, 'accepted') AS reason, count(*) AS rows FROM judged GROUP BY 1")
def reject_reasons(spark, sf_dir):
    good, bad = events.split_rejects(canonical(spark, sf_dir))
    return good.select(F.lit("accepted").alias("reason")).union(bad.select("reject_reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query("SELECT count(*) FILTER (WHERE event_time IS NULL) AS event_time, count(*) FILTER (WHERE user_id IS NULL) AS user_id, count(*) FILTER (WHERE dest_host IS NULL) AS dest_domain, count(*) FILTER (WHERE bytes_sent IS NULL) AS bytes_sent, count(*) FILTER (WHERE http_method IS NULL) AS http_method, count(*) FILTER (WHERE coalesce(action, '') = '') AS action FROM judged")
def field_gaps(spark, sf_dir):
    return events.required_field_gaps(canonical(spark, sf_dir))


_BAD = {"action": "action NOT IN ('allow', 'block', 'unknown')", "bytes_sent": "bytes_sent < 0", "bytes_received": "bytes_received < 0", "lineage": "k % 37 = 1", "event_time": "event_time IS NULL", "user_id": "user_id IS NULL", "dest_host": "dest_host IS NULL", "dest_domain": "dest_host IS NULL", "vendor": "k % 31 = 2", "log_type": "k % 41 = 2", "status_code": "k % 43 = 3", "http_method": "NOT regexp_matches(http_method, '^[A-Z]+$')"}


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) FILTER (WHERE {bad}) AS violations, count(*) FILTER (WHERE {bad}) = 0 AS ok FROM judged" for n, bad in _BAD.items()))
def canonical_conformance(spark, sf_dir):
    """Canonical events of which some were spoilt afterwards, so that most rules find something."""
    k = F.col("raw_event_id").cast("long")
    spoilt = {"ingest_lineage_hash": F.when(k % 37 == 1, "short"), "vendor": F.when(k % 31 == 2, "nobody"), "log_type": F.when(k % 41 == 2, ""), "status_code": F.when(k % 43 == 3, 700)}
    return quality.check_canonical(canonical(spark, sf_dir).withColumns({c: F.coalesce(v, c) for c, v in spoilt.items()}))


@query("SELECT 'paloalto' AS vendor, substr(event_time, 1, 10) AS date, count(*) AS events, sum(bytes_sent)::BIGINT AS bytes_sent FROM judged WHERE reject_reason IS NULL AND substr(event_time, 9, 2) BETWEEN '05' AND '20' AND substr(event_time, 1, 7) = (SELECT min(substr(event_time, 1, 7)) FROM judged) GROUP BY 2")
def event_partitions(spark, sf_dir):
    """Accepted events written by vendor and date; the 5th to the 20th of the first month read back in their types."""
    path = scratch_path(spark, "events")
    logs.write_events(events.split_rejects(canonical(spark, sf_dir))[0], path)
    month = logs.read_events(spark, path, VENDOR).agg(F.date_format(F.min("date"), "yyyy-MM").alias("m")).first().m or "1970-01"
    read = logs.read_events(spark, path, VENDOR, f"{month}-05", f"{month}-20")
    return logs.coerce_event_types(read).groupBy("vendor", F.date_format("date", "yyyy-MM-dd").alias("date")).agg(F.count("*").alias("events"), F.sum("bytes_sent").alias("bytes_sent"))


# Labels and their ASCII forms.
INTERNATIONAL = [("Bücher", "xn--bcher-kva"), ("MÜNCHEN", "xn--mnchen-3ya"), ("日本", "xn--wgv71a"), ("plain", "plain"), ("école", "xn--cole-9oa")]
_ASCII = "[" + ", ".join(f"'{a}'" for _, a in INTERNATIONAL) + "]"


@query(f"SELECT {_ASCII}[(event_id % 5 + 1)::INT] || '.' || norm_host AS norm_host, count(*) AS events FROM sig GROUP BY 1")
def international_hosts(spark, sf_dir):
    """The log's hosts below labels in other scripts: signatures see their ASCII forms."""
    from proxylens.operators import signatures

    label = F.element_at(F.array(*[F.lit(a) for a, _ in INTERNATIONAL]), (F.col("event_id") % 5 + 1).cast("int"))
    host, rest = F.regexp_extract("url_full", "^[a-z]+://([^/?#]*)", 1), F.regexp_extract("url_full", "^[a-z]+://[^/?#]*(.*)$", 1)
    moved = p.log(spark, sf_dir).withColumn("url_full", F.concat(F.lit("http://"), label, F.lit("."), host, rest))
    return signatures.normalize_urls(moved).groupBy("norm_host").agg(F.count("*").alias("events"))


@query("SELECT 'p' || (k % 7) AS kind, CASE k % 7 WHEN 0 THEN '/a%20b%2Ac/' || k % 10 WHEN 1 THEN '/users/:uuid' WHEN 2 THEN '/mail/:email' WHEN 3 THEN '/h/:ip' WHEN 4 THEN '/n/:id' WHEN 5 THEN '/t/:hex' ELSE '/x' END AS norm_path, CASE WHEN k % 7 = 6 THEN 'password=s&z=1' ELSE '' END AS norm_query, count(*) AS events, CASE k % 7 WHEN 1 THEN 'uuid' WHEN 2 THEN 'email' WHEN 3 THEN 'ip' WHEN 4 THEN 'id' WHEN 5 THEN 'hex' WHEN 6 THEN 'sensitive_param' ELSE '' END AS hits FROM (SELECT event_id AS k FROM log) GROUP BY ALL")
def redacted_paths(spark, sf_dir):
    """Paths and queries that reach every step: escapes, each redaction, sensitive parameters."""
    from proxylens.operators import signatures

    k = F.col("event_id")
    kinds = [F.concat(F.lit("/a b*c/"), k % 10), F.lit("/users/550e8400-e29b-41d4-a716-446655440000"), F.lit("/mail/ann@example.com"), F.lit("/h/10.1.2.3"), F.lit("/n/1234567"), F.lit("/t/00112233445566778899aabbccddeeff"), F.lit("/x?z=1&password=s&utm_source=q")]
    urls = p.log(spark, sf_dir).select((k % 7).alias("k"), F.concat(F.lit("e.com"), F.element_at(F.array(*kinds), (k % 7 + 1).cast("int"))).alias("url_full"))
    found = signatures.normalize_urls(urls).withColumn("hits", F.array_join(F.array_distinct(F.transform("pii_hits", lambda h: h["pii_type"])), ","))
    return found.groupBy(F.concat(F.lit("p"), "k").alias("kind"), "norm_path", "norm_query", "hits").agg(F.count("*").alias("events"))


@query("SELECT 'query' AS field_source, 'email' AS pii_type, ':email' AS redacted_token, count(*) AS values, sum(n)::BIGINT AS occurrence_count FROM (SELECT url_signature, user_id, count(*) AS n FROM sig GROUP BY ALL)")
def mail_audit(spark, sf_dir):
    """The redaction audit of a log whose urls carry the user's address."""
    from proxylens.operators import signatures

    signed = saved(p.signed(spark, sf_dir).select("url_signature", "user_id"), "signed")
    with_mail = signatures.normalize_urls(signed.withColumn("url_full", F.concat(F.lit("h.com/p?who="), "user_id", F.lit("@example.com"))))
    return signatures.pii_audit(with_mail, p.RUN).groupBy("field_source", "pii_type", "redacted_token").agg(F.count("*").alias("values"), F.sum("occurrence_count").alias("occurrence_count"))
