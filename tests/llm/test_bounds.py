"""What must not grow: rows for a shared passage, rows that come to the driver, memory for a long payload, questions for one word."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from proxylens.llm import common, decontam, flac, hmm, quality


def test_a_prompt_that_many_texts_and_items_share(spark, monkeypatch):
    """Rows stay linear in texts and items; counts are those of a search by hand."""
    n, rows = 400, {}

    def counted(df, name):
        out = common.saved(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(decontam, "saved", counted)
    prompt = " ".join(f"prompt{i}" for i in range(14))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.concat(F.lit("d"), "id"), F.lit(prompt), F.concat(F.lit("e"), "id")).alias("text"))
    items = spark.range(n).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.lit(prompt), F.concat(F.lit("own"), "id")).alias("text"))
    got = decontam.contamination_report(docs, items)
    assert got.where("n_hit = 14 and n_words = 16").count() == n and got.where(f"n_items = {n}").count() == n
    assert got.select("items_sha256").distinct().count() == 1
    assert max(rows.values()) <= 6 * n, rows


def test_decontamination_by_shuffles_equals_broadcasts(spark, monkeypatch, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(str, decontam.contamination_report(docs, items).collect()))
    monkeypatch.setattr(decontam, "MOST_PRINTS", 10)
    monkeypatch.setattr(decontam, "SALTS", 3)
    assert sorted(map(str, decontam.contamination_report(docs, items).collect())) == want


def test_rows_of_one_id_that_come_to_the_driver_are_bounded(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, y, plain=quality.fit: fitted.append(len(x)) or plain(x, y))
    docs = spark.range(3_040).select(F.when(F.col("id") < 3_000, 0).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("some words of text "), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    assert quality.quality_report(docs, labels, sample=20).count() == 3_040
    assert fitted == [40] or fitted == [20]  # with the repeated id in the sample, or without


def test_a_long_payload_takes_memory_in_proportion():
    """32 MB of text in both directions, under 340 MB (64 MB took under 500)."""
    words = np.random.default_rng(4).integers(97, 123, 1 << 25, np.uint8)
    words[::6] = 32
    payload = words.tobytes()
    tracemalloc.start()
    stream = flac.encode_many([payload])[0]
    encoding = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    found = flac.signal(flac.decode_many([stream])[0])
    decoding = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["pcm"] == payload and found["total"] == int(words.astype(np.int64).sum()) - 128 * len(words)
    assert max(encoding, decoding) < 340 << 20
    x = words < 128
    assert found["crossings"] == int((x[1:] != x[:-1]).sum())


def test_a_text_asks_once_for_a_word_it_repeats(spark):
    docs = spark.createDataFrame([(i, f"plain words here {i % 3}") for i in range(60)] + [(1000 + i, "neverseen " * 5_000 + "plain") for i in range(20)], "doc_id long, text string")
    got = {r.doc_id: r for r in hmm.score_corpus(docs, states=2, rounds=1, own=2, tail=4, frequent=2).collect()}
    trained = hmm.train(docs, states=2, rounds=1, own=2, tail=4, frequent=2)
    assert trained.encoded.agg(F.max(F.size("misses"))).first()[0] <= 4
    counts = {bytes(r.word): r.n for r in trained.words.collect()}
    v, n = len(counts), sum(counts.values())
    for doc_id in (1000, 1001, 3, 4):
        tokens = [*docs.where(f"doc_id = {doc_id}").first().text.encode().split(), b""]
        assert np.isclose(got[doc_id].base_score, sum(np.log10((counts.get(t, 0) + 0.1) / (n + 0.1 * (v + 1))) for t in tokens), rtol=1e-9)
        assert got[doc_id].n_known == sum(t in counts for t in tokens)


def test_hmm_segments_hold_little():
    """The buffers of a pass, which every worker has, stay under 64 MB in double precision (201 MB with segments of 1 << 20)."""
    from proxylens.llm import hmm

    assert 2 * 8 * hmm.STATES * hmm.SEGMENT < 64 << 20
