"""Streams over a closed input equal the batch functions."""

from pyspark.sql import functions as F

from proxylens.operators import detect
from proxylens.plans import proxylog
from proxylens.streaming import streams

SF = "/root/testdata/sf0.001"
HEADER = "start,srcuser,src,url,bytes_sent,action,http_method"


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_ingest_takes_each_lineage_once(spark, tmp_path):
    log, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    log.mkdir()
    rows = [f"2024-01-15T10:00:0{i}Z,u{i},10.0.0.1,https://a.com/x,10,allow,GET" for i in range(5)]
    schema = ", ".join(f"{c} string" for c in HEADER.split(","))
    (log / "a.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    (log / "b.csv").write_text("\n".join([HEADER, rows[0].replace("u0", "new"), ",,,,,,"]) + "\n")
    run(streams.stream_ingest(spark, str(log), "paloalto", out, state, schema, per_trigger=1))
    assert spark.read.parquet(out).count() == 6
    # the same file is delivered again under its name in a run without state: no lineage is written twice
    run(streams.stream_ingest(spark, str(log), "paloalto", out, str(tmp_path / "other"), schema, per_trigger=1))
    got = spark.read.parquet(out)
    assert got.count() == got.select("ingest_lineage_hash").distinct().count() == 6
    assert got.select("vendor", "date").distinct().count() == 1


def written(spark, tmp_path):
    """The log as files of an hour's order, and its schema."""
    path = str(tmp_path / "events")
    proxylog.signed(spark, SF).select("event_time", "user_id", "dest_domain", "http_method", "action", "bytes_sent").repartition(3).write.parquet(path)
    return path, spark.read.parquet(path)


def test_bursts_and_sums_equal_the_batch(spark, tmp_path):
    path, batch = written(spark, tmp_path)
    for name, make, plain, columns in (
        ("bursts", lambda d: streams.stream_burst(d, watermark="400 days"), detect.burst_counts(batch), ("user_id", "dest_domain", "window_start", "burst_count")),
        ("sums", lambda d: streams.stream_cumulative(d, watermark="400 days"), detect.daily_cumulative(batch), ("user_id", "dest_domain", "day", "cumulative_bytes")),
    ):
        stream = make(spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path))
        run(stream.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"state-{name}")))
        got = sorted(str(tuple(r)) for r in spark.table(name).select(*columns).collect())
        assert got and got == sorted(str(tuple(r)) for r in plain.select(*columns).collect())


def test_late_rows_are_left_out(spark, tmp_path):
    """Rows behind the watermark do not change a window that is closed."""
    path = tmp_path / "in"
    schema = "event_time timestamp, user_id string, dest_domain string, http_method string, action string, bytes_sent long"
    for i, rows in enumerate(([("2024-01-15 10:00:00",)] * 2, [("2024-01-15 12:00:00",)], [("2024-01-15 10:00:01",), ("2024-01-15 12:00:05",)])):
        spark.createDataFrame(rows, "t string").select(F.to_timestamp("t").alias("event_time"), F.lit("u").alias("user_id"), F.lit("d.com").alias("dest_domain"), F.lit("POST").alias("http_method"), F.lit("allow").alias("action"), F.lit(1).cast("long").alias("bytes_sent")).coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    for upto in range(1, 4):
        stream = spark.readStream.schema(schema).parquet(f"{path}/[0-{upto - 1}]")
        run(streams.stream_burst(stream, watermark="10 minutes").writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state))
    assert [r.burst_count for r in spark.read.parquet(out).collect() if r.window_start == 1705312800] == [2]
