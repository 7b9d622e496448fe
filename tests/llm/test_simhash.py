"""SimHash components against fingerprints bit by bit and all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from proxylens.llm import simhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Least node of the component of each of some fingerprints, over all pairs."""
    p = np.array(prints, np.uint64)
    top = list(range(len(p)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, x in enumerate(p):
        for j in np.flatnonzero(np.bitwise_count(p[i + 1 :] ^ x) <= 3).tolist():
            a, b = find(i), find(i + 1 + j)
            top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(p))]


def test_query_equals_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    extra = [(10_000 + i, t) for i, t in enumerate(["", None, "one", "one two", "ONE two", rows[0].text, rows[0].text + " tail", " ".join(f"w{i}" for i in range(200_000))])]
    got = {r.doc_id: r for r in simhash.simhash_components(docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))).collect()}
    every = sorted([(r.doc_id, r.text) for r in rows] + extra)
    prints = [plain_print(t) for _, t in every]
    assert [got[i].fingerprint for i, _ in every] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i, _ in every] == [every[k][0] for k in plain_components(prints)]


@pytest.mark.parametrize("block", [3, simhash.BLOCK])
def test_components_of_planted_bits(spark, monkeypatch, block):
    """Chains of 1, 2, 3 and 4 different bits anywhere, and one bucket of many members; in small blocks too."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(5)
    prints = set(map(int, rng.integers(0, 1 << 64, 60, np.uint64)))
    for p in list(prints)[:40]:
        for _ in range(6):
            p ^= sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 5)), replace=False))
            prints.add(p)
    centre = int(rng.integers(0, 1 << 64, dtype=np.uint64))
    prints |= {centre ^ sum(1 << int(b) for b in rng.choice(30, int(rng.integers(0, 7)), replace=False)) for _ in range(120)}
    prints = sorted(prints)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    got = {r.print: r.component_id for r in simhash.component_table(spark.createDataFrame(rows, "doc_id long, print long")).collect()}
    assert [got[p] for _, p in rows] == plain_components(prints)


def test_pivots_discard_only_what_is_far():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 64, 300, np.uint64)
    b = a ^ np.array([sum(1 << int(k) for k in rng.choice(64, int(rng.integers(0, 6)), replace=False)) for _ in a], np.uint64)
    tables = [np.bitwise_count(x[:, None] ^ simhash.PIVOTS).astype(np.int8) for x in (a, b)]
    i, j = simhash.near_pairs(a, b, *tables)
    want = np.argwhere(np.bitwise_count(a[:, None] ^ b[None, :]) <= 3)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))


def test_table_and_keys_in_columns(spark):
    """The tables and keys that Spark computes: distances to the pivots, and a shared key for every 3 different bits."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 64, 400, np.uint64)
    b = a ^ np.array([sum(1 << int(k) for k in rng.choice(64, 3, replace=False)) for _ in a], np.uint64)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a.view(np.int64), b.view(np.int64), strict=True)], "a long, b long")
    shared = df.select(F.size(F.array_intersect(simhash.bucket_keys(F.col("a")), simhash.bucket_keys(F.col("b")))).alias("n"), simhash.distance_table(F.col("a")).alias("near"), "a")
    for r in shared.collect():
        assert r.n >= 1
        assert list(r.near) == np.bitwise_count(np.uint64(r.a % (1 << 64)) ^ simhash.PIVOTS).tolist()
