"""Golden values of normalisation, signatures, detection, ingest, rules, cache, taxonomy and budget."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from proxylens import config
from proxylens.functions import codes
from proxylens.operators import budget, cache, detect, domains, events, rules, signatures, taxonomy
from proxylens.sources import logs


def normal(spark, *urls):
    rows = signatures.normalize_urls(spark.createDataFrame([(u,) for u in urls], "url_full string")).collect()
    by = {r.url_full: r for r in rows}
    return [by[u] for u in urls]


def test_urls(spark):
    urls = ["https://example.com/path", "example.com/path", "HTTPS://WWW.EXAMPLE.COM/path", "example.com:80/path", "example.com/path//to///resource", "example.com/path/", "example.com/", "https://x.com", "example.com/a?utm_source=t&utm_medium=e&gclid=abc&id=123", "example.com/a?z=1&a=2&m=3", "example.com/users/550e8400-e29b-41d4-a716-446655440000", "example.com/a?email=test@example.com", "example.com/a?ip=192.168.1.1", "example.com/user/123456789", "https://müller.de/x", "e.com/a b*~+%7e%zz;p"]
    got = normal(spark, *urls)
    assert [r.norm_host for r in got[:4]] == ["example.com", "example.com", "www.example.com", "example.com"]
    assert [r.norm_path for r in got[4:8]] == ["/path/to/resource", "/path", "/", ""]
    assert got[7].norm_host == "x.com"
    assert [r.norm_query for r in got[8:10]] == ["id=123", "a=2&m=3&z=1"]
    assert got[10].norm_path == "/users/:uuid" and got[11].norm_query == "email=:email" and got[12].norm_query == "ip=:ip" and got[13].norm_path == "/user/:id"
    assert got[14].norm_host == "xn--mller-kva.de"
    assert got[15].norm_path == "/a%20b%2A~%2B~%25zz"
    assert [h.pii_type for h in got[11].pii_hits] == ["email"]


def test_signature_edges(spark):
    sizes = [(0, "T"), (1023, "T"), (1024, "L"), (1048575, "L"), (1048576, "M"), (10485759, "M"), (10485760, "H"), (1073741823, "H"), (1073741824, "X"), (10_000_000_000, "X")]
    df = spark.createDataFrame([(s, b, "h", "/path/to/resource", "a=1&b=2&c=3", None) for s, b in sizes], "bytes_sent long, want string, norm_host string, norm_path string, norm_query string, http_method string")
    for r in signatures.add_signature(df).collect():
        assert (r.bytes_bucket, r.method_group, r.norm_path_template, r.path_depth, r.param_count) == (r.want, "OTHER", "/path/to/resource?p=3", 3, 3)


def made(spark, rows):
    base = {"user_id": "user1", "dest_domain": "example.com", "bytes_sent": 100, "http_method": "POST", "app_category": "Business", "event_time": dt.datetime(2024, 1, 15, 10), "action": "allow", "url_signature": "sig1"}
    return spark.createDataFrame([Row(**{**base, **r, "ingest_lineage_hash": f"h{i}"}) for i, r in enumerate(rows)])


def test_detection_boundaries(spark):
    big = detect.detect(made(spark, [{"bytes_sent": b, "http_method": "GET"} for b in (1048575, 1048576, 1048577)]), "r")
    assert [r.is_a for r in big.orderBy("bytes_sent").collect()] == [False, True, True]
    kinds = detect.detect(made(spark, [{"http_method": m, "app_category": c} for m, c in (("POST", "AI"), ("POST", "Unknown"), ("GET", "AI"), ("POST", "Business"))]), "r")
    assert [r.is_b for r in kinds.orderBy("ingest_lineage_hash").collect()] == [True, True, False, False]
    start = dt.datetime(2024, 1, 15, 10)
    assert detect.detect(made(spark, [{"event_time": start + dt.timedelta(seconds=10 * i)} for i in range(20)]), "r").where("is_b").count() == 20
    assert detect.detect(made(spark, [{"event_time": start + dt.timedelta(seconds=10 * i)} for i in range(19)]), "r").where("is_b").count() == 0
    spread = [{"event_time": dt.datetime(2024, 1, 15) + dt.timedelta(minutes=30 * i), "bytes_sent": 1 << 20} for i in range(21)]
    assert detect.detect(made(spark, spread), "r").where("is_b").count() == 21
    risky = detect.detect(made(spark, [{"app_category": "AI"} for _ in range(300)]), "run", rate=0.2)
    assert 0 < risky.where("is_c").count() < 300 and {r.ingest_lineage_hash for r in risky.where("is_c").collect()} == {r.ingest_lineage_hash for r in risky.where("is_c").collect()}


def test_detection_of_a_hot_pair_counts_cells(spark):
    """A third of all events by one user on one domain: the windows run over counts, not over events."""
    rows = [{"event_time": dt.datetime(2024, 1, 15) + dt.timedelta(seconds=i), "bytes_sent": 1000, "http_method": "POST" if i % 2 else "GET"} for i in range(600)] + [{"user_id": f"u{i}"} for i in range(300)]
    found = detect.detect(made(spark, rows), "r")
    hot = found.where("user_id = 'user1'").agg(F.min("burst_count").alias("lo"), F.max("burst_count").alias("hi"), F.min("cumulative_bytes").alias("sent")).first()
    assert (hot.lo, hot.hi, hot.sent) == (150, 150, 600_000) and found.count() == 900
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "Aggregate" in plan.split("Window [")[-1]


# header, row, then what is expected: user, action, bytes sent, host
SAMPLES = {
    "paloalto": ("start,srcuser,src,url,bytes_sent,action,http_method", "2024-01-15T10:00:00Z,ann,10.0.0.1,https://a.com/x,10,allow,GET", ("ann", "allow", 10, "a.com")),
    "zscaler": ("date,time,user,srcip,url,action,bytes_sent", "2024-01-15,10:00:00,bob,1.1.1.1,https://b.com:8443/,blocked,x", ("bob", "block", 0, "b.com:8443")),
    "netskope": ("timestamp,user,url,action,bytes_uploaded", "1705312800000,cy,c.com/p,allowed,5", ("cy", "allow", 0, "c.com")),
    "umbrella": ("timestamp,identity,url,action,request_size", "2024-01-15 10:00:00,dee,https://d.com,ALLOW,7", ("dee", "allow", 7, "d.com")),
    "bluecoat": ("date,time,cs-username,url,cs-bytes,action", "2024-01-15,10:00:00,eve,https://u:p@e.com/,3,-", ("eve", "allow", 3, "e.com")),
    "skyhigh": ("timestamp,user,url,action,bytes_sent", "2024-01-15T10:00:00,flo,https://f.com/,Deny,3", ("flo", "block", 3, "f.com")),
    "ifilter": ("date,time,ユーザ名,url,判定結果,送信バイト数", "2024-01-15,19:00:00,gus,https://g.com/,規制,-4", ("gus", "block", 0, "g.com")),
    "mdca": ("Timestamp,User,Url,ActionType", "2024-01-15T10:00:00Z,h@x.com,https://h.com/,Success", ("h@x.com", "allow", 0, "h.com")),
}


@pytest.mark.parametrize("vendor", sorted(config.VENDORS))
def test_vendor_rows(spark, tmp_path, vendor):
    header, row, want = SAMPLES[vendor]
    (tmp_path / "log.csv").write_text(f"{header}\n{row}\n{row}\n{',' * header.count(',')}\n", encoding="utf-8")
    good, bad = events.split_rejects(events.to_canonical(logs.read_vendor(spark, str(tmp_path)), vendor))
    rows = good.collect()
    assert len(rows) == 2 and len({r.ingest_lineage_hash for r in rows}) == 2
    assert all((r.user_id, r.action, r.bytes_sent, r.dest_host, r.event_time) == (*want, dt.datetime(2024, 1, 15, 10)) for r in rows)
    assert [r.reject_reason for r in bad.collect()] in ([], ["no event_time"])
    logs.write_events(good, str(tmp_path / "out"))
    assert logs.read_events(spark, str(tmp_path / "out"), vendor, "2024-01-15", "2024-01-15").count() == 2


def test_lineage_numbers_equal_rows_by_blocks(spark, monkeypatch):
    """Rows that repeat more often than a block is long, rows that differ in a column outside the hash, nulls and single rows."""
    monkeypatch.setattr(events, "BLOCK", 7)
    df = spark.createDataFrame([("f", "x", "1")] * 50 + [("f", "x", "2")] * 9 + [("f", None, None)] * 8 + [("f", "y", "1")], "_file string, a string, `odd.name` string")
    got = events.lineage_hash(df, ["a"], "_file")
    assert got.columns == [*df.columns, "ingest_lineage_hash"]
    rows = got.collect()
    assert len(rows) == len({r.ingest_lineage_hash for r in rows}) == 68
    assert {(r.a, r["odd.name"]): sum(x[:3] == r[:3] for x in rows) for r in rows} == {("x", "1"): 50, ("x", "2"): 9, (None, None): 8, ("y", "1"): 1}
    again = events.lineage_hash(df.repartition(5), ["a"], "_file").collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert events.lineage_hash(df.limit(0), ["a"], "_file").count() == 0


def test_json_readers(spark, tmp_path):
    """An array of objects, one object, and lines of objects, all under one set of columns."""
    (tmp_path / "a.json").write_text('[{"timestamp": "2024-01-15T10:00:00Z", "user": "ann", "url": "https://a.com/x", "action": "allowed", "cs-bytes": 5}, {"timestamp": "2024-01-15T10:00:01Z", "user": "bob", "url": "b.com", "n": null}]')
    (tmp_path / "b.json").write_text('{"timestamp": "2024-01-15T10:00:02Z", "user": "cy", "url": "c.com"}')
    (tmp_path / "c.jsonl").write_text('{"timestamp": "2024-01-15T10:00:03Z", "user": "dee", "url": "d.com"}\n{"timestamp": "2024-01-15T10:00:04Z", "user": "eve", "url": "e.com", "cs-bytes": "7"}\n')
    good, _ = events.split_rejects(events.to_canonical(logs.read_vendor(spark, str(tmp_path)), "netskope"))
    assert sorted((r.user_id, r.bytes_sent) for r in good.collect()) == [("ann", 5), ("bob", 0), ("cy", 0), ("dee", 0), ("eve", 7)]
    (tmp_path / "d.csv").write_text("timestamp,user,url\n2024-01-15T10:00:05Z,flo,f.com\n")
    assert logs.read_vendor(spark, str(tmp_path)).count() == 6


def test_exports_and_checksums(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long")
    logs.write_sanitized_csv(df, str(tmp_path / "csv"))
    logs.write_report_json(df, str(tmp_path / "json"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2 and spark.read.json(str(tmp_path / "json")).where("n = 2").count() == 1
    manifest = logs.file_inventory(spark, str(tmp_path / "json/*.json")).select("file", "file_hash").cache()
    assert manifest.count() and logs.verify_checksums(spark, str(tmp_path / "json/*.json"), manifest).count() == 0
    assert logs.verify_checksums(spark, str(tmp_path / "json/*.json"), manifest.withColumn("file_hash", F.lit("0"))).count() == manifest.count()


def test_stable_new_files(spark, tmp_path):
    for name in ("old.csv", "seen.csv", "x.tmp"):
        (tmp_path / name).write_text("a\n")
    seen = spark.createDataFrame([(f"file:{tmp_path}/seen.csv",)], "file string")
    later = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S")
    assert [r.file.rsplit("/", 1)[1] for r in logs.stable_new_files(spark, str(tmp_path), later, seen, exclude="tmp$").collect()] == ["old.csv"]


def test_migration_status(spark):
    rows = [("FS-001", "IM-001", '["UC-001"]', None, None), (None, None, None, "DEPRECATED", "DT-001"), (None, None, "x", "FS-002", None)]
    got = taxonomy.migration_status(spark.createDataFrame(rows, "fs_code string, im_code string, uc_codes_json string, fs_uc_code string, dt_code string")).collect()
    assert [(r.has_new, r.legacy_only, r.missing) for r in got] == [(True, False, ["DT", "CH", "RS", "LG"]), (False, True, ["FS", "IM", "UC", "CH", "RS", "LG"]), (False, True, ["IM", "UC", "DT", "CH", "RS", "LG"])]


def test_domains(spark):
    df = spark.createDataFrame([("a.b.co.jp",), ("x.com",), ("com",), ("q.w.ck",), ("www.ck",), ("local",), ("h.com:81",)], "host string")
    got = {r.host: r.dest_domain for r in domains.registrable_domain(df, "host", domains.suffix_table(spark)).collect()}
    assert got == {"a.b.co.jp": "b.co.jp", "x.com": "x.com", "com": "com", "q.w.ck": "q.w.ck", "www.ck": "www.ck", "local": "local", "h.com:81": "h.com"}


def test_rules(spark):
    table = rules.load_rules(spark, [
        {"rule_id": "b", "priority": 10, "match": {"domain_suffixes": ["x.com"]}},
        {"rule_id": "a", "priority": 90, "match": {"domain_exact": ["api.x.com"], "path_prefix": ["/V1/*"]}},
        {"rule_id": "s", "priority": 99, "match": {"url_signatures": ["s3"]}},
        {"rule_id": "off", "enabled": False, "match": {"domain_suffixes": ["x.com"]}},
    ])
    sigs = spark.createDataFrame([("s1", "api.x.com", "/v1/z"), ("s2", "api.x.com", "/v2"), ("s3", "y.org", "/"), ("s4", "notx.com", "/")], "url_signature string, norm_host string, norm_path_template string")
    got = {r.url_signature: (r.rule_id, r.match_reason) for r in rules.match_rules(sigs, table).collect()}
    assert got == {"s1": ("a", "host+path_exact"), "s2": ("b", "host_suffix"), "s3": ("s", "signature_exact")}
    assert rules.match_rules(sigs, table, strict=True).count() == 0
    with pytest.raises(ValueError, match="condition"):
        rules.load_rules(spark, [{"rule_id": "x"}])


def test_cache_protects_people(spark):
    schema = "url_signature string, risk_level string, status string, is_human_verified boolean, failure_count int, error_type string"
    base = spark.createDataFrame([("s1", "low", "active", True, 0, None), ("s2", "low", "active", False, 2, None)], schema)
    merged, refused = cache.merge_cache(base, spark.createDataFrame([("s1", "high"), ("s2", "high"), ("s3", "high")], "url_signature string, risk_level string"))
    assert {r.url_signature: r.risk_level for r in merged.collect()} == {"s1": "low", "s2": "high", "s3": "high"} and [r.url_signature for r in refused.collect()] == ["s1"]
    failed = cache.status_transition(base, spark.createDataFrame([("s1", "timeout"), ("s2", "timeout")], "url_signature string, error_message string"))
    assert {r.url_signature: (r.status, r.failure_count) for r in failed.collect()} == {"s1": ("active", 0), "s2": ("failed_permanent", 3)}


def test_codes(spark):
    df = spark.createDataFrame([('["UC-002", "", "UC-001", "UC-002", 5]',), ("no",), (None,)], "j string")
    assert [r.c for r in df.select(codes.canonical_codes(codes.parse_codes(F.col("j"))).alias("c")).collect()] == ['["UC-001","UC-002"]', "[]", "[]"]
    record = spark.createDataFrame([("k", "FS-001", "IM-001", '["UC-001"]', "DT-009", None)], "k string, fs_code string, im_code string, uc_codes_json string, dt_code string, ch_code string")
    got = taxonomy.normalize_taxonomy(record).first()
    # one dimension from its old column makes the record legacy
    assert (got.fs, got.dt, got.source_format, got.missing, got.needs_review) == (["FS-001"], ["DT-009"], "legacy", ["CH", "RS", "LG"], True)
    assert [r.c for r in spark.createDataFrame([(["UC-002", " UC-001 ", "UC-011"],)], "a array<string>").select(codes.canonical_codes(F.col("a")).alias("c")).collect()] == ['["UC-001","UC-002","UC-011"]']
    dictionary = taxonomy.load_dictionary(spark)
    assert {r.dimension: r.code for r in taxonomy.fallback_codes(dictionary).collect()}["UC"] == "UC-099"
    errors = taxonomy.validate_assignment(taxonomy.normalize_taxonomy(record), dictionary, "k").first().errors
    assert "CH: too few codes" in errors and "DT: unknown code DT-009" in errors


def test_budget(spark):
    df = spark.createDataFrame([("aa1", ["A"], 5.0), ("ab1", ["C"], 0.5), ("ac1", [], 0.5), ("ad1", ["C"], 0.6)], "url_signature string, candidate_flags array<string>, cost double")
    assert {r.url_signature: r.analyze for r in budget.budget_gate(df, 0.5).collect()} == {"aa1": True, "ab1": True, "ac1": True, "ad1": False}
    assert {r.url_signature: r.analyze for r in budget.budget_gate(df, 5.5, "running").collect()} == {"aa1": True, "ab1": True, "ac1": False, "ad1": False}
    long = spark.createDataFrame([(f"aa{i:03d}", "x" * 30) for i in range(45)], "url_signature string, payload string")
    assert budget.make_batches(long).groupBy("batch").count().agg(F.max("count")).first()[0] == 20
    assert budget.make_batches(long, 20, 100).groupBy("batch").count().agg(F.max("count")).first()[0] == 3


def test_overrides_take_a_dataframe(spark):
    from proxylens.operators import rules

    df = spark.createDataFrame([("m.a.net", "medium", "business"), ("b.a.net", "medium", "business"), ("c.org", "medium", "business")], "norm_host string, risk_level string, usage_type string")
    entries = spark.createDataFrame([("a.net", False, "high", None, False), ("m.a.net", True, "low", None, False)], "key string, whole boolean, o_risk string, o_usage string, block boolean")
    got = {r.norm_host: (r.risk_level, r.overridden) for r in rules.apply_overrides(df, entries).collect()}
    assert got == {"m.a.net": ("low", True), "b.a.net": ("high", True), "c.org": ("medium", False)}


@pytest.mark.parametrize("block", [4, 1024])
def test_batches_by_characters_equal_packing_row_by_row(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(budget, "BLOCK", block)
    rng = random.Random(block)
    rows = [(rng.choice(["aa", "ab", "0f"]) + f"{i:05d}", "x" * rng.choice([0, 1, 30, 60, 99, 100, 101, 250])) for i in range(300)] + [("ff1", None)]
    got = {r.url_signature: (r.shard, r.batch, r.n) for r in budget.make_batches(spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(rows)], "url_signature string, payload string, n int"), 5, 100).collect()}
    want = {}
    for shard in {s[:2] for s, _ in rows}:
        batch, n, used = 0, 0, 0
        for s, t in sorted((s, t or "") for s, t in rows if s[:2] == shard):
            if n and (n == 5 or used + len(t) > 100):
                batch, n, used = batch + 1, 0, 0
            n, used, want[s] = n + 1, used + len(t), (shard, batch)
    assert {s: v[:2] for s, v in got.items()} == want and len(got) == 301
