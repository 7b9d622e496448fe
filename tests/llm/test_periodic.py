"""Periodic runs against a search over all periods."""

import binascii
import hashlib
from fractions import Fraction

import numpy as np
import pytest

from proxylens.llm import periodic


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                stretch = (i, j - i + q)
                if not any(q % p == 0 and any(s <= i and s + n >= i + stretch[1] for s, n in found[p]) for p in found):
                    found.setdefault(q, []).append(stretch)
            i = j + 1
    return sorted((s, n, q) for q, runs in found.items() for s, n in runs)


def plain_report(doc_id, text):
    words = (text or "").encode().split()
    h, n = binascii.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_random_texts_with_repeats(letters):
    rng = np.random.default_rng(letters)
    texts = []
    for _ in range(150):
        words = []
        while len(words) < rng.integers(1, 400):
            part = [b"%d" % x for x in rng.integers(0, letters, int(rng.integers(1, 40)))]
            words += (part * int(rng.integers(1, 8)))[: int(rng.integers(1, 150))]
        texts.append(words)
    texts += [[], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 3 + [b"a"], [b"a"] * 20_000, [b"x%d" % (i % 4999) for i in range(19_996)], [b"x%d" % (i % 4999) for i in range(19_995)]]
    got = periodic.runs_of(texts)
    for words, runs in zip(texts[:-3], got, strict=False):
        assert runs == plain_runs(words)
    assert got[-3:] == [[(0, 20_000, 1)], [(0, 19_996, 4999)], []]
    assert [periodic.runs_of([t])[0] for t in texts[:20]] == got[:20]


def test_every_period_is_found():
    """A run of four periods exactly for each period, among words that do not repeat, at odd places."""
    texts = []
    for q in range(1, 130):
        period = [b"p%d" % (i % max(1, q - 1)) for i in range(q - 1)] + [b"end"]
        run = (period * 6)[: max(6, 4 * q)]
        texts.append([b"l%d" % i for i in range(q % 7)] + run + [b"r%d" % i for i in range(q % 5)])
    for q, runs in enumerate(periodic.runs_of(texts), 1):
        assert (q % 7, max(6, 4 * q), q) in runs


def test_query_equals_plain_search(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").where("length(text) < 8000 or text is null")
    # 43, 44 and 48: ids whose texts get a periodic end
    ids = [i for i in range(300_000, 300_060) if binascii.crc32(str(i).encode()) % 10 == 0][:4]
    extra = [(-1, None), (-2, ""), (None, "a b " * 9), *((i, " ".join(f"w{k % 50}" for k in range(120))) for i in ids), (-3, "one two\tthree\n" * 5)]
    got = periodic.run_report(docs.union(spark.createDataFrame(extra, "doc_id long, text string"))).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()] + extra
    want = sorted(map(str, (plain_report(i, t) for i, t in rows if i is not None)))
    assert sorted(str(tuple(r)) for r in got if r.doc_id is not None) == want
    assert [tuple(r)[1:6] for r in got if r.doc_id is None] == [(1, 0, 18, 2, 9000)]


def test_collapsed_texts(spark):
    found = periodic.run_columns(spark.createDataFrame([(1, "say " + "ha " * 7 + "stop"), (2, None)], "doc_id long, text string"))
    rows = {r.doc_id: r for r in found.collect()}
    assert bytes(rows[1].collapsed) == b"say ha stop" and [tuple(r) for r in rows[1].runs] == [(1, 7, 1)]
    assert bytes(rows[2].collapsed) == b"" and rows[2].best is None
