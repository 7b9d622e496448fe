"""The pipeline's rows against every stage recomputed on what the one before kept; and the pipeline on empty tables."""

from collections import Counter

import duckdb
import pandas as pd

import corpus_pipeline
from proxylens.llm import quality
from proxylens.llm.queries import CONTAMINATION_SQL, MIX_SQL

FIELDS = ["doc_id", "text", "lang", "source", "n_chars"]


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each_class(rows):
    """Of the classes of texts with Jaccard similarity 0.8 or more, and of equal texts, the row with the least id stays."""
    sets, top = [grams(r["text"]) for r in rows], list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if (rows[i]["text"] or "") == (rows[j]["text"] or "") or (a and b and 5 * both >= 4 * (len(a) + len(b) - both)):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    classes = {}
    for i, r in enumerate(rows):
        classes.setdefault(find(i), []).append(r)
    return [min(c, key=lambda r: r["doc_id"]) for c in classes.values()]


def by_sql(sql, rows, **tables):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=FIELDS).convert_dtypes(dtype_backend="pyarrow"))
    for name, path in tables.items():
        con.sql(f"create view {name} as select * from '{path}'")
    found = con.sql(sql)
    return [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]


def test_rows_equal_the_stages_recomputed(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select(*FIELDS)
    report = {r.doc_id: r.keep for r in quality.quality_report(docs, spark.read.parquet(f"{small}/labels.parquet")).collect()}  # has a brute-force test of its own
    rows = [r.asDict() for r in docs.collect()]
    good = [r for r in rows if report[r["doc_id"]]]
    single = one_of_each_class(good)
    hit = {r["doc_id"] for r in by_sql(CONTAMINATION_SQL, single, benchmark=f"{small}/benchmark.parquet") if r["contaminated"]}
    clean = [r for r in single if r["doc_id"] not in hit]
    assert len(rows) > len(good) > len(single) > len(clean) > 50
    mixed = by_sql(MIX_SQL, clean)
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixed if r["size"]}
    want = Counter({str(tuple(r[c] for c in FIELDS)): copies[r["doc_id"]] for r in clean if copies.get(r["doc_id"])})

    got = corpus_pipeline.run(spark, small).collect()
    assert Counter(str(tuple(r[c] for c in FIELDS)) for r in got if (r.text or "").split()) == want
    law = {s: sorted(r.slot for r in got if r.shard == s) for s in {r.shard for r in got}}
    assert all(slots == list(range(len(slots))) for slots in law.values()) and all(0 <= s < 24 for s in law)
    # the same document is in the same shard, however often it is taken
    assert all(len({r.shard for r in got if r.doc_id == d}) == 1 for d in {r.doc_id for r in got})


def test_empty_tables(spark, small, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and {*FIELDS, "shard", "slot"} <= set(got.columns)

