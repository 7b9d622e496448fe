"""Every query with SQL equals it on the smallest tables; a sample of the others on plain expectations."""

import os

import duckdb
import pytest

from proxylens.plans import proxylog, registry
from proxylens.sources.scratch import saved

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.fixture(scope="module")
def held():
    return {}


@pytest.fixture
def shared(monkeypatch, held):
    """Frames that many queries begin with are made once; `test_equals_sql_on_more_rows` runs them as they are."""

    def once(name, keep):
        made = getattr(proxylog, name)

        def get(spark, sf_dir):
            if (name, sf_dir) not in held:
                held[name, sf_dir] = keep(made(spark, sf_dir), name)
            return held[name, sf_dir]

        monkeypatch.setattr(proxylog, name, get)

    for name in ("log", "raw_log", "signed", "kept", "found", "statistics", "sites", "cache", "costs", "files", "records"):
        once(name, saved)
    for name in ("statistics_and_cache", "events_and_cache"):
        once(name, lambda pair, name: pair)


def plain(rows, columns):
    return sorted(str([round(float(r[c]), 5) if isinstance(r[c], float) or type(r[c]).__name__ == "Decimal" else r[c] for c in columns]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, tables, shared, name):
    df = registry.QUERIES[name](spark, SF)
    found = tables.sql(registry.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    want = [dict(zip(found.columns, row, strict=True)) for row in found.fetchall()]
    assert plain([r.asDict() for r in df.collect()], columns) == plain(want, columns)


def test_entry_is_the_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_planning_starts_no_jobs(spark):
    """Frames over the log are built without running anything but the reading of schemas, a job for each of two tables."""
    group = "planning"
    spark.sparkContext.setJobGroup(group, group)
    proxylog.flagged(spark, SF)
    proxylog.cache(spark, SF)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 4


@pytest.mark.parametrize("name", ["risk_map", "executive_kpi", "taxonomy_records", "canonical_events", "quality_checks", "signature_stats", "evidence_rows", "cache_snapshot"])
def test_equals_sql_on_more_rows(spark, name):
    """At sf0.01, where groups without any class occur."""
    sf = SF.replace("0.001", "0.01")
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    df, found = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLES[name])
    columns = sorted(df.columns)
    assert plain([r.asDict() for r in df.collect()], columns) == plain([dict(zip(found.columns, row, strict=True)) for row in found.fetchall()], columns)
