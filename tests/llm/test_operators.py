import binascii
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from proxylens.llm import decontam, flac, hmm, mixing, pii, quality, sharding, token_counts, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and a column whose name is used inside."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [Row(1, "Hello World hello", "en", "a", 1, "x"), Row(1, "Hello World hello", "en", "a", 1, "x"), Row(2, None, None, None, None, None), Row(None, "", "en", "a", 0, "y"), Row(3, long, "de", "b", 5, "z"), Row(4, "Hello World hello", "fr", "b", 1, "q"), Row(5, "É à ß 😀 \x1f\x85 mixed", "fr", None, 1, "q")]
    return spark.createDataFrame(rows, SCHEMA)


def test_hmm_forward_is_exact_and_sums_to_one():
    rng = np.random.default_rng(1)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    model = hmm.Hmm(norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((4, 3)), 0), 0, np.zeros(4))
    seqs = [rng.integers(0, 4, n).astype(np.uint16) for n in (1, 7, 3, 12)]
    for seq, got in zip(seqs, model.score(seqs), strict=True):
        a = model.start * model.emit[seq[0]]
        for x in seq[1:]:
            a = (a @ model.step) * model.emit[x]
        assert math.isclose(got, math.log10(a.sum()), rel_tol=1e-12)
    every = [np.array([i // 64 % 4, i // 16 % 4, i // 4 % 4, i % 4], np.uint16) for i in range(256)]
    assert math.isclose((10 ** model.score(every)).sum(), 1, rel_tol=1e-9)
    starts, steps, emissions = model.expected(seqs)
    assert math.isclose(starts.sum(), 4, rel_tol=1e-5) and math.isclose(emissions.sum(), sum(map(len, seqs)), rel_tol=1e-5) and math.isclose(steps.sum(), sum(len(s) - 1 for s in seqs), rel_tol=1e-5)


def test_hmm_expected_counts_of_whole_sequences():
    """Against plain forward and backward recursions, in one segment and in many."""
    rng = np.random.default_rng(7)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    model = hmm.Hmm(norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0))
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 900, 40, 2, 41)]
    starts, steps, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for seq in seqs:
        alphas, betas = [model.start * model.emit[seq[0]]], [np.ones(3)]
        alphas[0] = alphas[0] / alphas[0].sum()
        for x in seq[1:]:
            a = (alphas[-1] @ model.step) * model.emit[x]
            alphas.append(a / a.sum())
        for x in seq[:0:-1]:
            b = model.step @ (model.emit[x] * betas[0])
            betas.insert(0, b / b.sum())
        for t, x in enumerate(seq):
            gamma = alphas[t] * betas[t]
            emissions[x] += gamma / gamma.sum()
            if t:
                pair = alphas[t - 1][:, None] * model.step * (model.emit[x] * betas[t])
                steps += pair / pair.sum()
            else:
                starts += gamma / gamma.sum()
    for segment in (hmm.SEGMENT, 7):
        for got, want in zip(model.expected(seqs, segment), (starts, steps, emissions), strict=True):
            assert np.allclose(got, want, rtol=1e-4)
        assert np.allclose(model.score(seqs, segment), model.score(seqs), rtol=1e-12)


def test_hmm_score_equals_a_recursion_over_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(900, None), (901, "never seen wordlings " * 3), (None, "a b")], "doc_id long, text string"))
    small = {"states": 3, "rounds": 2, "own": 50, "tail": 16, "frequent": 200}
    t = hmm.train(docs, **small)
    counts = {bytes(r.word): r.n for r in t.words.collect()}
    own = t.classes.words[: 1 + t.classes.own]
    of = lambda w: own.index(w) if w in own else len(own) + hmm.bucket_of(w, 16)
    mass = {}
    for w, n in counts.items():
        if of(w) >= len(own):
            mass[of(w)] = mass.get(of(w), 0.1) + n + 0.1
    for r in hmm.score_corpus(docs, **small).join(docs, ["doc_id"]).collect():
        total, state = 0.0, None
        for w in [*(r.text or "").encode().lower().split(), b""]:
            c = of(w)
            emit = t.model.emit[c] * (1 if c < len(own) else (counts.get(w, 0) + 0.1) / mass.get(c, 0.1))
            state = (t.model.start if state is None else state @ t.model.step) * emit
            total += math.log10(state.sum())
            state = state / state.sum()
        assert math.isclose(r.score, total, rel_tol=1e-8), r.doc_id


def test_hmm_training_raises_the_likelihood():
    rng = np.random.default_rng(2)
    seqs = [np.concatenate([rng.integers(1 + 4 * (i % 2), 5 + 4 * (i % 2), 40), [0]]).astype(np.uint16) for i in range(60)]
    counts = np.bincount(np.concatenate(seqs), minlength=9).astype(float)
    model, before = hmm.first_model(counts, 3, 1), -math.inf
    for _ in range(6):
        score = model.score(seqs).sum()
        assert score > before - 1e-3 * abs(before if before > -math.inf else 1)
        before = score
        model = hmm.maximized(*model.expected(seqs), counts)
    assert before > hmm.first_model(counts, 1, 1).score(seqs).sum()


def test_hmm_scores(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    small = {"states": 3, "rounds": 2, "own": 50, "tail": 16, "frequent": 200}
    got = {r.doc_id: r for r in hmm.score_corpus(docs, **small).collect()}
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), b""] for r in docs.collect()}
    held = {i: binascii.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = {}
    for i, words in tokens.items():
        if not held[i]:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(w in counts for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel_tol=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert hmm.score_corpus(odd, **small).count() == odd.count()
    assert hmm.score_corpus(odd.limit(0), **small).count() == 0


def base_spans(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def good(kind, value):
        digits = re.sub("[^0-9]", "", value)
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return [True, all(int(x) <= 255 for x in value.split(".")) if kind == 1 else True, 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0, 9 <= len(digits) <= 15][kind]

    return sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, text or "") if good(k, m.group()))


def test_pii_base_spans_equal_plain_matching(spark):
    extra = [(10**6, "a@b.c_d@e.f x@y.z.w@q.r 1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4 4111-1111-1111-1112 +1 (988) 555-2485 +49.30.1234567 😀é a@é.com me@x-y.org"), (10**6 + 1, None), (10**6 + 2, ""), (10**6 + 3, "1" * 20_000 + "@" + "a." * 5_000)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r.doc_id: r for r in pii.pii_report(docs).collect()}
    for r in docs.collect():
        want = base_spans(r.text)
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [got[r.doc_id][f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in want) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(got[r.doc_id].spans.split(","))


def test_pii_added_spans_on_planted_spellings(spark):
    """Spellings and look-alikes that the training does not write, between words of the documents; figures are in the README."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng = np.random.default_rng(8)

    def card(sep):
        d = [4, *rng.integers(0, 10, 14).tolist()]
        doubled = [x * 2 - 9 * (x > 4) if i % 2 == 0 else x for i, x in enumerate(d)]
        d = "".join(map(str, [*d, -sum(doubled) % 10]))
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    names = ["ann", "bob.k", "mia99", "leo_x"]
    n = lambda low, high: int(rng.integers(low, high))
    good, bad = [], []
    for i in range(50):
        who = names[i % 4]
        good += [("email", f"{who} {{at}} mail{n(1, 9)} {{dot}} com"), ("email", f"{who}[AT]host{n(1, 9)}.example.org"), ("ip", f"{n(11, 255)}[dot]{n(11, 255)}[dot]{n(11, 255)}[dot]{n(11, 255)}"), ("card", card("_")), ("card", card("  ")), ("phone", f"({n(200, 999)}) {n(200, 999)}-{n(1000, 9999)}")]
        bad += [f"20{n(10, 30)}-{n(10, 13)}-{n(10, 29)} {n(10, 24)}:{n(10, 60)}", f"version {n(0, 9)}-{n(0, 9)}-{n(0, 9)}-{n(0, 9)}", f"lines {n(10, 99)}, {n(10, 99)}, {n(10, 99)}, {n(10, 99)}", f"look at stars dot {who}", f"isbn {n(100, 999)} {n(10, 99)} {n(1000, 9999)}"]
    rows, at = [], {}
    words = ["heea", "onstha", "erti", "thnd", "rely"]
    for i, (kind, value) in enumerate(good):
        head = f"{words[i % 5]} {words[i % 3]} "
        rows.append((10**6 + i, f"{head}{value} {words[i % 4]}"))
        at[10**6 + i] = f"{kind}:{len(head)}:{len(head) + len(value)}"
    rows += [(2 * 10**6 + i, f"{words[i % 5]} {value} {words[i % 4]}") for i, value in enumerate(bad)]
    planted = spark.createDataFrame(rows, docs.schema)
    got = pii.with_spans(planted, pii.train(docs)).select("_row.doc_id", pii.written(F.col("base")).alias("base"), pii.written(F.col("spans")).alias("spans")).collect()
    found = {r.doc_id: set(filter(None, r.spans.split(","))) - set(r.base.split(",")) for r in got}
    caught = {kind: np.mean([at[10**6 + i] in found[10**6 + i] for i, (k, _) in enumerate(good) if k == kind]) for kind in pii.KINDS}
    wrong = sum(len(found[i]) for i in found if i >= 2 * 10**6) + sum(len(found[i] - {at[i]}) for i in at)
    right = sum(at[i] in found[i] for i in at)
    print("planted:", {k: round(float(v), 3) for k, v in caught.items()}, "precision", round(right / (right + wrong), 3))
    assert all(v >= 0.9 for v in caught.values()) and right / (right + wrong) >= 0.95


@pytest.mark.parametrize("n", [20_000])
def test_pii_of_a_text_with_very_many_spans(spark, n):
    text = " ".join(f"a{i}@b{i}.org +1 (988) 555-{i:04d}"[:40] for i in range(n))
    rows = pii.pii_report(spark.createDataFrame([(1, text), (2, "x" * 1_000_000 + "@" + "y." * 200_000 + "z")], "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in rows}
    want = base_spans(text)
    assert by[1].n_email == n and by[1].base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want).encode()).hexdigest()
    assert by[2].n_email == 1


def test_pii_redacts(spark, odd):
    docs = spark.createDataFrame([(1, "write to ann@x.org or +1 (988) 555-2485."), (2, None)], "doc_id long, text string")
    assert [r.text for r in pii.redact(docs).orderBy("doc_id").collect()] == ["write to [EMAIL] or [PHONE].", None]
    assert pii.redact(odd).columns == odd.columns and pii.pii_report(odd.limit(0)).count() == 0


def test_shards(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard_manifest(docs, bucket_bytes=20_000).collect()
    assert len(rows) == docs.count()
    for shard in range(24):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert all(r.grown_shard in (r.shard, 24) for r in rows) and any(r.grown_shard == 24 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, sharding.shard_manifest(docs.repartition(5), bucket_bytes=20_000).collect()))
    assert sharding.shuffle_into_shards(odd).drop("shard", "slot").exceptAll(odd).count() == 0
    assert sharding.shuffle_into_shards(odd).count() == odd.count() and sharding.shuffle_into_shards(odd.limit(0)).count() == 0


def test_shards_law_and_shuffle_are_computed_again(spark):
    """The law by Spark's hash over plain pairs, Fisher-Yates by hand over each whole bucket, equal rows spread."""
    rows = [(i % 40, f"text {i}", f"n{i % 3}") for i in range(400)] + [(None, "boilerplate", "n")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    size = 2000
    got = sharding.shuffle_into_shards(docs, 4, 9, size).collect()
    assert sorted(map(str, got)) == sorted(map(str, sharding.shuffle_into_shards(docs.repartition(7), 4, 9, size).collect()))
    pairs = spark.createDataFrame([(d, s) for d in {r[0] for r in rows} for s in range(5)], "d long, s int").select("d", "s", F.xxhash64(F.lit(9), "s", "d").alias("h")).collect()
    law = lambda d, n: max((r.h, r.s) for r in pairs if r.d == d and r.s < n)[1]
    assert all(r.shard == law(r.doc_id, 4) for r in got)
    assert {r.grown_shard for r in sharding.shard_manifest(docs, 4, 9, size).collect()} == {law(d, 5) for d in {r[0] for r in rows}}
    ties = {(r.doc_id, r.text, r.note): r.tie for r in docs.select("*", sharding.row_hash(docs, 9).alias("tie")).collect()}
    bytes_of = lambda s: sum(len(r.text.encode()) + 8 for r in got if r.shard == s)
    parts = [max(1, math.ceil(bytes_of(s) / size)) for s in range(4)]
    hot = law(None, 4)
    assert parts[hot] > 2
    for s in range(4):
        if s == hot:
            continue
        slots, base = [r for r in sorted(got, key=lambda r: r.slot) if r.shard == s], 0
        buckets = [[r for r in slots if ties[r[:3]] % parts[s] == b] for b in range(parts[s])]
        for b, bucket in enumerate(buckets):
            order = np.arange(len(bucket))
            np.random.default_rng([9, sum(parts[:s]) + b]).shuffle(order)
            plain = sorted(bucket, key=lambda r: ties[r[:3]])
            assert slots[base : base + len(bucket)] == [plain[i] for i in order] or len({r[:3] for r in bucket}) < len(bucket)
            base += len(bucket)
    copies = sorted(r.slot for r in got if r.doc_id is None)
    assert copies[-1] - copies[0] >= 299 and sorted(r.slot for r in got if r.shard == hot) == list(range(sum(r.shard == hot for r in got)))


def test_mix(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.02 * own[0].target
        assert own[0].target <= 2 * own[0].source_size + 1e-6
    assert math.isclose(sum({r.source: r.target for r in rows}.values()), 1.5 * sum(r.size for r in rows))
    assert sum(r.size for r in mixing.mixture(docs).select(mixing.word_count(F.col("text")).alias("size")).collect()) == sum(r.taken for r in rows)
    assert mixing.mix(odd).count() == odd.count() and mixing.mixture(odd).columns == odd.columns and mixing.mix(odd.limit(0)).count() == 0


def test_mix_reaches_its_target_with_repeated_rows(spark):
    """A third of a source, and all of another, is one row many times."""
    one = [(None, "the same eight words in every single row", "a", "x")] * 400 + [(i, f"document {i} has a text of eight words", "a", "x") for i in range(800)]
    two = [(None, "other words", "b", str(i % 3)) for i in range(600)]
    docs = spark.createDataFrame(one + two, "doc_id long, text string, source string, lang string")
    rows = mixing.mix(docs, (20, 3), share=1.3).collect()
    assert len(rows) == 1800
    for source, copies in (("a", "same"), ("b", "other")):
        own = [r for r in rows if r.source == source]
        words = max(r.size for r in own)
        assert 0 <= own[0].target - sum(r.taken for r in own) < words, source
        drawn = [r.copies - min(x.copies for x in own) for r in own if copies in r.text]
        assert 0.3 * len(drawn) * (own[0].target / own[0].source_size % 1) < sum(drawn) < len(drawn)
    key = lambda r: str((r.doc_id, r.text, r.source, r.lang, r.copies))
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mix(docs.repartition(5), (20, 3), share=1.3).collect()))


def test_mix_one_row_five_hundred_times(spark):
    """One row 500 times and 100 other rows: taken within 2 % of the target whatever the seed."""
    rows = [(7, "one row that is there five hundred times over", "a")] * 500 + [(i, " ".join(["word"] * (20 + i % 90)), "a") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in ("mix", "b", "c"):
        got = mixing.mix(docs, (1,), share=0.9, seed=seed).collect()
        assert abs(sum(r.taken for r in got) - got[0].target) <= 0.02 * got[0].target
    import duckdb

    from proxylens.llm import queries

    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [*rows, (1, None, "b"), (2, "x y", None), (None, "", "a"), *[(i, "t " * (i % 7), "b") for i in range(30)]])
    want = con.sql(queries.MIX_SQL).fetchall()
    df = spark.createDataFrame(con.sql("select * from documents").fetchall(), "doc_id long, text string, source string")
    names = ("doc_id", "size", "source_size", "target", "taken")
    assert sorted(str((*r[:3], round(r[3], 6), r[4])) for r in want) == sorted(str((*(r[c] for c in names[:3]), round(r.target, 6), r.taken)) for r in mixing.mix(df).collect())


def test_mix_inclusion_follows_the_weights(spark):
    """Long documents are certain of a copy, short ones come as often as their weight says; over many seeds."""
    rows = [(i, " ".join(["w"] * (3 if i % 4 else 1000)), "a") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    short, long = 2.0, 10.0  # binary digits of 3 and of 1000
    factor = 0.15 * (60 * 3 + 20 * 1000) / (60 * 3 * short + 20 * 1000 * long)
    seen = {3: 0, 1000: 0}
    for seed in range(6):
        for r in mixing.mix(docs, (1,), share=0.15, seed=str(seed)).collect():
            assert r.copies <= 1
            seen[r.size] += r.copies
    assert abs(seen[1000] / (6 * 20) - factor * long) < 0.1
    certain = mixing.mix(docs, (1,), share=1.2, rounds=1).collect()  # later rounds fill the rest with short documents
    factor *= 8
    assert factor * long > 1 and all(r.copies >= 1 for r in certain if r.size == 1000) and any(r.copies == 0 for r in certain if r.size == 3)
    weighed = docs.withColumn("v", F.when(F.col("doc_id") < 40, 0.0).otherwise(3.0))
    assert {r.doc_id for r in mixing.mix(weighed, (1,), share=0.3, weight_col="v").where("copies > 0").collect()} <= set(range(40, 80))


def test_urls(spark):
    urls = [(1, "http://A.Net/x"), (2, "https://example.net/en/y?q#z"), (3, "http://sub.example.com/de/1"), (4, "x.org/fr/"), (5, None), (6, "ftp://b.org/fr/p"), (7, "http://net"), (8, "http://badnet/"), (9, "a://b://c/d")]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert [(got[i].host, got[i].path, got[i]["rule"]) for i, _ in urls] == [("a.net", "/x", "net/"), ("example.net", "/en/y", "example.net/en/"), ("sub.example.com", "/de/1", "example.com/de/"), ("", "", None), ("", "", None), ("b.org", "/fr/p", "org/fr/"), ("net", "", None), ("badnet", "/", None), ("b:", "//c/d", None)]
    assert got[1].verdict == "block" and got[2].verdict == "allow"
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_model_generalises(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host, path = url_filter.url_parts(F.col("url"))
    rows = [(r.h, r.p, r.v) for r in pages.select(host.alias("h"), path.alias("p")).withColumn("v", url_filter.rule_column(F.col("h"), F.col("p"), url_filter.RULES, lambda r, v: v)).where("v is not null").collect()]
    train, test = rows[::2], rows[1::2]
    weights, bias = url_filter.fit_logistic([(h, p, float(v == "block")) for h, p, v in train])
    right = sum((weights[s := url_filter.gram_slots(h, p)].sum() / len(s) ** 0.5 + bias >= 0) == (v == "block") for h, p, v in test)
    assert right / len(test) > 0.95


def padded(text):
    raw = (text or "").encode()
    while not raw or len(raw) % 64:
        raw += b"\0"
    return raw


def test_media_manifest_has_the_expected_values(spark):
    """Sizes by hand; sums by plain Python over the bytes."""
    docs = spark.createDataFrame([(0, None), (1, ""), (2, "a"), (3, "b" * 63), (4, "c" * 64), (5, "d" * 65), (6, "é" * 5000)], "doc_id long, text string")
    got = {r.doc_id: r for r in flac.media_manifest(docs).collect()}
    assert [(got[i].n_bytes, got[i].payload_bytes) for i in range(7)] == [(0, 64), (0, 64), (1, 64), (63, 64), (64, 64), (65, 128), (10_000, 10_048)]
    assert got[0].feature == got[1].feature == f"total={-128 * 64};energy={128 * 128 * 64};peak=128;crossings=0;blocks=1;loudest_offset=0"
    for i, text in [(r.doc_id, r.text) for r in docs.collect()]:
        raw = padded(text)
        x = [b - 128 for b in raw]
        want = {"total": sum(x), "energy": sum(v * v for v in x), "peak": max(map(abs, x)), "crossings": sum((a < 0) != (b < 0) for a, b in zip(x, x[1:], strict=False)), "blocks": -(-len(x) // 4096)}
        assert dict(p.split("=") for p in got[i].feature.split(";")).items() >= {k: str(v) for k, v in want.items()}.items()
        stream = flac.encode_many([raw])[0]
        assert (got[i].media_bytes, got[i].media_sha256) == (len(stream), hashlib.sha256(stream).hexdigest())
        assert (got[i].payload_sha256, got[i].tail_crc32) == (hashlib.sha256(raw).hexdigest(), binascii.crc32(raw[-64:]))


def test_flac_round_trip_and_checks(spark, odd):
    rng = np.random.default_rng(3)
    payloads = [rng.integers(0, 256, 64 * n, dtype=np.uint8).tobytes() for n in (1, 5, 64, 65, 200)] + [bytes(64), b"ab" * 5000, bytes(range(256)) * 33, b""]
    streams = flac.encode_many(payloads)
    assert [b"".join(x for _, x in blocks) for blocks in flac.decode_many(streams)] == payloads
    assert [o for o, _ in flac.decode_many(streams)[4]] == [0, 4096, 8192, 12288][: -(-len(payloads[4]) // 4096)]
    broken = bytearray(streams[2])
    broken[-30] ^= 1
    with pytest.raises(ValueError, match="CRC-16"):
        flac.decode_many([bytes(broken)])
    table = streams[4].index(b"\x83")
    size = int.from_bytes(streams[4][43:46], "big")
    unseekable = streams[4][:4] + b"\x80" + streams[4][5:42] + streams[4][46 + size :]
    assert table == 42 and b"".join(x for _, x in flac.decode_many([unseekable])[0]) == payloads[4]
    rows = {(r.doc_id, r.payload_sha256) for r in flac.media_manifest(odd).collect()}
    for r in odd.collect():
        assert (r.doc_id, hashlib.sha256(padded(r.text)).hexdigest()) in rows
    assert flac.pcm_blocks(flac.decode_column(flac.encode_column(odd.select("doc_id", F.encode("text", "UTF-8").alias("payload"))))).where("doc_id = 3").count() > 1


def test_quality(spark, odd):
    """Fitted on the labels of one half, judged on those of the other."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    got = quality.quality_report(docs, labels.where(half == 0)).join(labels.where(half == 1), "doc_id")
    right = got.agg(F.count("*").alias("n"), F.avg((F.col("keep") == (F.col("quality") == 1)).cast("double")).alias("all"), F.avg(F.when(F.col("quality") == 1, F.col("keep").cast("double"))).alias("good")).first()
    assert right.n > 1500 and right.all > 0.97 and right.good > 0.995
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(odd, none).count() == odd.count() and quality.keep_good(odd, none).columns == odd.columns
    assert quality.keep_good(odd.limit(0), labels).count() == 0
    assert {r.score for r in quality.quality_report(odd, none).collect()} == {0.5}


def test_quality_equals_brute_force(spark):
    """Features, fit, posteriors by host and path, and threshold in plain loops."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "lang")
    docs = docs.union(spark.createDataFrame([(10**6, "a new site " * 9, "nowhere", "en"), (10**6 + 1, None, None, None), (0, "again", "nowhere", "xx")], docs.schema))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows, y = docs.collect(), {r.doc_id: r.quality for r in labels.collect()}
    x = {i: quality.features_of((r.text or "").encode()) for i, r in enumerate(rows)}
    seen = [i for i, r in enumerate(rows) if r.doc_id in y]
    w, bias = quality.fit(np.array([x[i] for i in seen]), np.array([float(y[rows[i].doc_id]) for i in seen]))
    evidence = {i: max(-12, min(12, bias + sum(a * b for a, b in zip([*f, *(v * v for v in f)], w, strict=True)))) for i, f in x.items()}
    mean = sum(y[rows[i].doc_id] for i in seen) / len(seen)

    def posteriors(key, prior):
        groups = {key(r): [] for r in rows}
        for i in seen:
            groups[key(rows[i])].append(y[rows[i].doc_id])
        n, within, between = len(seen), mean - mean * mean, 0.0
        for k, g in groups.items():
            if g:
                m = sum(g) / len(g)
                between += len(g) * ((m - prior(k)) ** 2 - max(m - m * m, 1e-6) / len(g))
        strength = min(max(max(within, 1e-6) / max(between / n, 1e-9), 5.0), 1e6)
        return {k: (sum(g) + prior(k) * strength) / (len(g) + strength) for k, g in groups.items()}

    hosts = posteriors(lambda r: r.source, lambda k: mean)
    paths = posteriors(lambda r: (r.source, r.lang), lambda k: hosts[k[0]])
    logit = lambda p: math.log(p / (1 - p))
    score = {i: 1 / (1 + math.exp(-(evidence[i] + logit(min(max(paths[r.source, r.lang], 1e-3), 1 - 1e-3)) - logit(mean)))) for i, r in enumerate(rows)}
    threshold = min(0.5, np.percentile([score[i] for i in seen if y[rows[i].doc_id] == 1], 0.05))
    want = sorted((str(r.doc_id), round(score[i], 5), bool(score[i] >= threshold - 1e-7), round(paths[r.source, r.lang], 6), round(hosts[r.source], 6)) for i, r in enumerate(rows))
    got = sorted((str(r.doc_id), round(r.score, 5), r.keep, round(r.path_posterior, 6), round(r.host_posterior, 6)) for r in quality.quality_report(docs, labels).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and a[2] == b[2] and np.allclose([a[1], *a[3:]], [b[1], *b[3:]], atol=2e-5), (a, b)


def test_quality_threshold_covers_all_labels(spark):
    """Ten bad documents behind the fitting sample are labelled good: the threshold has to see them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    behind = labels.join(docs, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").collect()[150:]
    turned = [r.doc_id for r in behind if r.quality == 0][:10]
    labels = labels.withColumn("quality", F.when(F.col("doc_id").isin(turned), 1).otherwise(F.col("quality")))
    rows = quality.quality_report(docs, labels, sample=150, lost=0.005).join(labels, "doc_id").where("quality = 1").collect()
    threshold = np.percentile([r.score for r in rows], 0.5)
    assert len(turned) == 10 and len(rows) > 200 and threshold < 0.5
    assert all(r.keep == (r.score >= threshold) for r in rows)


def test_percentile_is_exact(spark):
    values = [*np.random.default_rng(4).random(2000) ** 9, *[0.25] * 500, 0.0, 1.0]
    scores = spark.createDataFrame([(float(v),) for v in values], "score double")
    for share in (0, 0.0005, 0.3, 0.9, 1):
        assert math.isclose(quality.percentile(scores, share), np.percentile(values, 100 * share), rel_tol=1e-12, abs_tol=1e-300)
    assert quality.percentile(scores.limit(0), 0.5) is None


def test_token_counts_equal_the_library(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_counts.tokenizer_path())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    docs = docs.union(spark.createDataFrame([(99, "it's <|endoftext|>x I'LL\u00a0go e\u0301 \u0301a 123 don't!!\n<|STARTOFTEXT|>")], "doc_id long, text string"))
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, table=100).collect()) == want


def test_frequent_runs_are_merged_without_a_shuffle(spark):
    rows = [(f"the the the rare{i} common{i % 5} {'x' * 300}",) for i in range(400)] + [(None,)]
    docs = spark.createDataFrame(rows, "text string").repartition(40)
    assert token_counts.frequent_runs(docs, 6) == [b"the", *[f"common{i}".encode() for i in range(5)]]
    assert token_counts.frequent_runs(docs.limit(0)) == []
    plan = token_counts.count_tokens(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def brute_hits(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    out = []
    for r in docs:
        w, hit, ids = words(r.text), set(), set()
        for item in items:
            b = words(item.text)
            n = min(10, len(b))
            grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids |= {str(item.item_id)} if item.item_id is not None else set()
        out.append((str(r.doc_id), len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return sorted(out)


def test_decontamination_with_short_items(spark, odd):
    items = spark.createDataFrame([(1, "Hello world"), (1, "one"), (2, None), (3, "..."), (None, "word5 word6"), (10, " ".join(f"word{i}" for i in range(50, 75))), (11, "a a a a a a a a a a a a")], "item_id long, text string")
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(50, "x a a a a a a a a a a a y one-two"), (51, "word60 " * 3 + " ".join(f"word{i}" for i in range(55, 66)))], "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontam.contamination_report(docs, items).collect())
    assert got == brute_hits(docs.collect(), items.collect())
    assert decontam.contamination_report(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontam.decontaminate(odd, items).columns == odd.columns


@pytest.mark.parametrize("words", [20_000, 1_000_000])
def test_decontamination_of_one_word_repeated(spark, words):
    items = spark.createDataFrame([(1, " ".join(["same"] * 12)), (2, "same same other"), (None, "stray tale")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "same " * words), (2, "same " * 9), (3, "a stray tale"), (4, "same " * 11 + "other")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontam.contamination_report(docs, items).collect()}
    assert got == {1: (words, words, 1, True), 2: (9, 0, 0, False), 3: (3, 2, 0, True), 4: (12, 12, 2, True)}


def test_contamination_sql_on_items_without_id(spark):
    import duckdb

    from proxylens.llm import queries

    items = [(None, "alpha beta gamma"), (1, "delta epsilon"), (2, "beta"), (3, None)]
    docs = [(1, "an alpha beta gamma here"), (2, "delta epsilon"), (3, "alpha"), (4, None), (None, "beta beta")]
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.sql("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    want = con.sql(queries.CONTAMINATION_SQL).fetchall()
    got = decontam.contamination_report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(str, want)) == sorted(map(str, map(tuple, got.collect())))


def test_decontaminate_searches_items_without_id(spark):
    items = spark.createDataFrame([(None, "alpha beta gamma"), (1, "delta epsilon")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "an alpha beta gamma here"), (2, "delta epsilon"), (3, "alpha beta"), (4, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in decontam.decontaminate(docs, items).collect()) == [3, 4]


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == before.columns, name
        kept = docs.count()
        assert 0 < kept and (name == "mixture" or kept <= before.count())
    assert corpus_pipeline.run(spark, sf).count() == kept
