"""What keeps queries in step with their input: how often a source is read, what is shuffled, how large and how many files are."""

import glob
import re
from collections import Counter

from pyspark.sql import functions as F

from proxylens.operators import events, metrics, signatures
from proxylens.plans import ingestlog, rawlog, taxonomylog
from proxylens.plans import proxylog as p
from proxylens.sources.scratch import saved
from proxylens.streaming import streams


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_wanted_columns_take_no_shuffle(spark, small):
    """lineages and domains are made where they are asked for."""
    raw = saved(p.raw_log(spark, small), "raw")
    some = ["event_time", "user_id", "dest_host", "action"]
    found = events.to_canonical(raw, rawlog.VENDOR, only=some)
    assert found.columns == [*[c for c in events.schemas.COLUMNS if c in some], "reject_reason"]
    assert not any(x in plan(found) for x in ("Aggregate", "Window", "Join"))
    every = events.to_canonical(raw, rawlog.VENDOR).select(found.columns)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, every.collect()))


def test_rows_that_occur_twice_are_made_once(spark, small):
    """the log is joined once, and hosts are not made from numbered rows."""
    raw = p.raw_log(spark, small)
    assert "Union" not in plan(raw)
    assert raw.count() == p.log(spark, small).select(F.sum(F.when(F.col("event_id") % 100 == 1, 2).otherwise(1))).first()[0]


def test_events_are_parsed_once(spark, small):
    """no filter parses times and hosts again, no key is looked for where none is hot, and the stage's code is short enough to be compiled."""
    raw = saved(p.raw_log(spark, small), "raw")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        good = events.split_rejects(events.to_canonical(raw, rawlog.VENDOR))[0]
        filters = [x for x in plan(good).splitlines() if re.match(r"[\s:+-]*Filter", x) and "no event_time" in x]
        assert filters and not any("RLIKE" in x or "regexp" in x for x in filters)
        assert len(re.findall(r"\bJoin ", plan(good))) == 1
        code = spark._jvm.PythonSQLUtils.explainString(good._jdf.queryExecution(), "codegen")
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000  # longer methods are interpreted
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_detection_carries_no_texts(spark, small, monkeypatch):
    """the urls' texts stay in the normalize stage's table and are not shuffled and written again."""
    write, seen = metrics.StageRecorder.write, {}
    monkeypatch.setattr(metrics.StageRecorder, "write", lambda self, df, stage, totals=None: seen.update({stage: {*df.columns}}) or write(self, df, stage, totals))
    ingestlog.recorded_run(spark, small)
    assert {*ingestlog.URL_TEXTS} <= seen["normalize"] and not {*ingestlog.URL_TEXTS} & seen["detect"]
    assert "ingest_lineage_hash" in seen["normalize"] & seen["detect"]


def test_urls_are_made_once(spark, small):
    """F5, F8: signing reads events once for the rows, as the dictionary is written; hits are counted before they are taken apart."""
    log = saved(p.log(spark, small), "once-read")
    assert physical(p.sign(log)).count("once-read") == 1
    assert physical(signatures.normalize_urls(log)).count("once-read") == 1
    audited = plan(signatures.pii_audit(p.sign(log.withColumn("url_full", F.concat(F.lit("h.com/p?who="), "user_id", F.lit("@example.com")))), p.RUN))
    assert "Aggregate" in audited.split("Generate explode(pii_hits")[1]


def test_raw_files_grow_in_number(spark, small):
    """a file has a bounded number of rows and a header of its own."""
    path = ingestlog.raw_files(spark, small, piece=500)
    files = glob.glob(f"{path}/part=*/*.txt")
    heads = [open(f).readline() for f in files]
    sizes = [sum(1 for _ in open(f)) - 1 for f in files]
    rows = p.raw_log(spark, small).count()
    assert sum(sizes) == rows and len(set(heads)) == 1 and heads[0].startswith("event_id;")
    assert len(files) >= rows // 1000 and max(sizes) < 1000


def test_records_sign_no_events_again(spark, small, monkeypatch):
    """stored classifications come from the statistics' signatures."""
    signed, calls = p.signed, []
    monkeypatch.setattr(p, "signed", lambda *a: calls.append(a) or signed(*a))
    taxonomylog._evidence(spark, small)
    assert len(calls) == 1


def test_streams_write_one_file_a_date(spark, small, tmp_path):
    """files of a batch grow with its dates, not with tasks times dates."""
    source, out, once = (str(tmp_path / n) for n in ("in", "out", "once"))
    rows = p.raw_log(spark, small)
    rows.repartition(6).write.option("header", True).csv(source)
    streams.run_to_end(streams.stream_ingest(spark, source, rawlog.VENDOR, out, str(tmp_path / "a"), ", ".join(f"`{c}` string" for c in rows.columns)))
    streams.run_to_end(streams.write_dated(streams.each_lineage_once(spark, out, per_trigger=1000), once, str(tmp_path / "b")))
    for folder, depth in ((out, "batch=*/vendor=*/date=*"), (once, "vendor=*/date=*")):
        per = Counter(f.rsplit("/", 1)[0] for f in glob.glob(f"{folder}/{depth}/*.parquet"))
        assert per and set(per.values()) == {1}
