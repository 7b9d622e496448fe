"""Readers with broken rows, hashing in pieces, spread joins, bounded statistics, snapshots by parts, bucketed joins, recorded stages."""

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from proxylens.operators import cache, events, metrics, reports, skew, stats
from proxylens.sources import digests, logs, scratch


def test_broken_rows_are_errors_of_their_file(spark, tmp_path):
    head = "timestamp,user,url,category"
    (tmp_path / "a.csv").write_text(f"{head}\n2024-01-15T10:00:00Z,ann,a.com,x\n2024-01-15T10:00:00Z,bob,b.com,x,more\n2024-01-15T10:00:00Z,cy,c.com,x,more,and,more\n2024-01-15T10:00:00Z,dee,d.com\n")
    (tmp_path / "b.jsonl").write_text('{"timestamp": "2024-01-15T10:00:00Z", "user": "eve", "url": "e.com"}\n\n{"timestamp": \n[1, 2\n')
    (tmp_path / "c.json").write_text('[{"timestamp": "2024-01-15T10:00:00Z", "user": "flo", "url": "f.com"}]')
    rows = events.to_canonical(logs.read_vendor(spark, str(tmp_path)), "netskope").collect()
    by = lambda reason: sorted((r.ingest_file.rsplit("/", 1)[1], r.user_id) for r in rows if r.reject_reason == reason)
    assert by(None) == [("a.csv", "ann"), ("a.csv", "dee"), ("b.jsonl", "eve"), ("c.json", "flo")]
    assert by(events.BROKEN) == [("a.csv", "bob"), ("a.csv", "cy"), ("b.jsonl", None), ("b.jsonl", None)]
    raw = logs.read_vendor_csv(spark, str(tmp_path))
    assert [r._error for r in raw.where("user = 'bob'").collect()] == ["2024-01-15T10:00:00Z,bob,b.com,x,more"]


def test_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "PIECE", 7)
    for i in range(1, 30):
        (tmp_path / f"f {i}%.bin").write_bytes(os.urandom(i * 11))
    got = {os.path.basename(r.file): (r.size, r.file_hash) for r in logs.file_inventory(spark, str(tmp_path)).collect()}
    want = {f: (len(b), hashlib.sha256(b).hexdigest()) for f in os.listdir(tmp_path) if not f.startswith(".") for b in [(tmp_path / f).read_bytes()]}
    assert {k.replace("%20", " ").replace("%25", "%"): v for k, v in got.items()} == want


@pytest.mark.parametrize("hot", [5, 1_000])
def test_join_spread_equals_a_plain_join(spark, hot):
    rows = spark.range(500).select("id", F.when(F.col("id") % 10 == 7, None).when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    table = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("value", F.concat(F.lit("v"), F.coalesce("k", F.lit("-"))))
    got = skew.join_spread(rows, table, ["k"], "n", ["id"], hot)
    assert got.columns == ["id", "k", "value"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.withColumn("value", F.concat(F.lit("v"), F.coalesce("k", F.lit("-")))).collect()))


def test_a_hot_key_is_in_no_single_partition(spark):
    """One key with half of all rows: with AQE off, the join's partitions hold about as much each."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
        joined = skew.join_spread(rows, rows.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", ["id"], 200)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 1.5 * 40_000 / len(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("digit", [3, 16])
def test_percentiles_by_digits(spark, monkeypatch, digit):
    monkeypatch.setattr(stats, "DIGIT", digit)
    rng = np.random.default_rng(digit)
    groups = {"hot": rng.integers(0, 1 << 40, 3000), "ties": rng.integers(0, 4, 200), "one": np.array([77]), "two": np.array([5, 1 << 33]), "signed": rng.integers(-1000, 1000, 301), None: np.array([3, 9])}
    df = spark.createDataFrame([(g, int(v)) for g, x in groups.items() for v in x] + [("empty", None), ("one", None)], "g string, v long")
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {r.g: r.p for r in stats.grouped_percentile(df.where("g is not null"), ["g"], "v", q, "p").collect()}
        assert got.keys() == {"hot", "ties", "one", "two", "signed"}
        for g, p in got.items():
            assert abs(p - np.quantile(groups[g].astype(float), q)) <= 1e-6 * max(1, abs(p))
    assert {r.g: r.n for r in stats.grouped_distinct(df, ["g"], "v", "n").collect() if r.g} == {g: len(set(x.tolist())) for g, x in groups.items() if g}
    assert stats.grouped_percentile(df.limit(0), ["g"], "v", 0.5, "p").count() == 0


def test_percentile_holds_no_groups_values(spark):
    """No window or aggregate of the plan sees a group's values: neither percentile nor collected lists, and windows run over digits."""
    df = spark.range(1000).select(F.lit("one").alias("g"), F.col("id").alias("v"))
    plan = stats.grouped_percentile(df, ["g"], "v", 0.95, "p")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower().replace("percentile-cells", "") and "collect_" not in plan


def made_cache(spark, n=400):
    ids = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("url_signature"), "id")
    return ids.select("url_signature", F.lit("old").alias("service_name"), F.lit("low").alias("risk_level"), (F.col("id") % 7 == 0).alias("is_human_verified"))


def test_merge_touches_only_parts_with_updates(spark, tmp_path):
    path = str(tmp_path / "cache")
    cache.write_cache(made_cache(spark), path)
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    known = made_cache(spark).where("url_signature like '0%' or url_signature like 'ab%'")
    updates = known.select("url_signature", F.lit("high").alias("risk_level"))
    refused = cache.merge_into(path, updates)
    touched = {f"p{r.url_signature[:2]}" for r in known.collect()}
    after = files()
    part = lambda f: f.split("part=")[1].split("/")[0]
    assert {f: t for f, t in before.items() if part(f) not in touched} == {f: t for f, t in after.items() if part(f) not in touched}
    assert not {f for f in before if part(f) in touched} & set(after)
    assert sorted(r.url_signature for r in refused.collect()) == sorted(r.url_signature for r in known.where("is_human_verified").collect())
    want = {r.url_signature: "high" if part_ and not r.is_human_verified else "low" for r in made_cache(spark).collect() for part_ in [r.url_signature[0] == "0" or r.url_signature[:2] == "ab"]}
    assert {r.url_signature: r.risk_level for r in cache.read_cache(spark, path).collect()} == want
    plan = cache.touched_parts(spark, path, updates)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan


def test_bucketed_tables_join_without_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = made_cache(spark)
        known = scratch.bucketed(made.withColumn("status", F.lit("active")).withColumn("usage_type", F.lit("genai")).withColumn("category", F.lit("c")), "cache", "url_signature", 4)
        table = scratch.bucketed(made.select("url_signature", F.lit(1).cast("long").alias("access_count"), F.lit(1).cast("long").alias("unique_users"), F.lit(2).cast("long").alias("bytes_sent_sum"), F.array(F.lit("A")).alias("candidate_flags")), "statistics", "url_signature", 4)
        joined = reports.evidence_rows(table, known)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stages_are_counted_while_they_are_written(spark):
    run = metrics.StageRecorder(spark, "r1")
    first = run.write(spark.range(1000).withColumn("odd", F.col("id") % 2), "first", {"odd": F.col("odd"), "ids": F.col("id")})
    assert run.write(first.where("odd = 1"), "second").count() == 500
    run.write(first.limit(0), "third", {"odd": F.col("odd")})
    log = run.log()
    assert [(r.stage, r.row_count, r.totals) for r in log.collect()] == [("first", 1000, {"odd": 500, "ids": 499_500}), ("second", 500, {}), ("third", 0, {"odd": 0})]
    rows = {(r.stage, r.metric_name): r for r in metrics.metric_rows(log).collect()}
    assert rows["second", "row_count"].value == 500 and rows["first", "ids"].value == 499_500 and rows["first", "ids"].unit == "count"
    assert rows["first", "duration_ms"].value > 0 and rows["third", "rows_per_sec"].value == 0
    with pytest.raises(Exception, match="no such"):
        run.write(spark.range(1).select(F.raise_error(F.lit("no such"))), "broken")
    assert run.log().count() == 3
