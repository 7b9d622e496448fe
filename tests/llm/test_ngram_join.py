from collections import defaultdict
from fractions import Fraction

from pyspark.sql import Row

from proxylens.llm import ngram_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """doc_id -> (class id, links) by comparing all pairs."""
    sets = []
    for r in rows:
        words = (r.text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    n = len(rows)
    near = defaultdict(set)
    post = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            post[g].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in post[g]:
                common[j] += 1
        for j, c in common.items():
            if j != i and Fraction(c, len(s) + len(sets[j]) - c) >= Fraction(4, 5):
                near[i].add(j)
    for i in range(n):
        near[i] |= {j for j in range(n) if j != i and (rows[i].text or "") == (rows[j].text or "") and not sets[i]}
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in near:
        for j in near[i]:
            root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(n):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i].doc_id for i in members if rows[i].doc_id is not None]
        out += [(rows[i].doc_id, min(ids) if ids else None, len(near[i])) for i in members]
    return sorted(out, key=str)


def check(spark, docs):
    got = ngram_join.similarity_classes(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(docs.collect())
    kept = ngram_join.keep_one(docs).collect()
    assert len(kept) == len({(c if c is not None else str(r)) for r, (_, c, _) in enumerate(brute(docs.collect()))}) or None in [c for _, c, _ in brute(docs.collect())]


def test_documents_equal_brute_force(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(300))
    near = [" ".join(f"w{i}" if i != k else "other" for i in range(300)) for k in range(0, 300, 6)]
    rows = [Row(i, t, "en", "s", 1) for i, t in enumerate([long, long.upper(), "", None, "", "a b", "A  B", "a b c", long, *near])]
    rows += [Row(0, long, "en", "s", 1), Row(None, "only this one text here now", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    check(spark, docs)
    assert sorted(x.doc_id for x in ngram_join.keep_one(docs).collect() if x.doc_id is not None) == [0, 2, 5, 7]
    assert ngram_join.similarity_classes(docs.limit(0)).count() == 0


def test_large_buckets_are_compared_by_blocks(spark, monkeypatch):
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join([*base, *(f"t{k}x{i}" for i in range(k % 12))]) for k in range(90)]
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    check(spark, spark.createDataFrame([Row(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA))


def test_an_outlier_meets_each_block_once(spark):
    """One bucket of 1,000 texts of one component and one outlier: as many meetings as blocks, not their square."""
    still = spark.createDataFrame([(5, 0, i, 0) for i in range(1000)] + [(5, 0, 5000, 5000)], "key long, band int, node long, root long")
    placed, meetings = ngram_join.block_pairs(still)
    assert placed.count() == 1001
    pairs = {(r.lo, r.hi) for r in meetings.collect()}
    assert len(pairs) == 1 + 4  # the outlier's block with itself and with the four others
    blocks = {r.node: r.block for r in placed.collect()}
    assert all((min(b, blocks[5000]), max(b, blocks[5000])) in pairs for b in blocks.values())


def test_large_buckets_are_joined_on_the_map_side(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE", 3)
    base = [f"b{i}" for i in range(60)]
    check(spark, spark.createDataFrame([Row(i, " ".join([*base, *(f"t{k}x{i}" for k in range(i % 5))]), "en", "s", 1) for i in range(40)], SCHEMA))


def test_pruning_keeps_pairs_at_the_threshold():
    for compared, least in ngram_join.least_matches():
        assert 0 < least < 0.8 * compared
