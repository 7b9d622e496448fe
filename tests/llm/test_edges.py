"""Every operator and every stage of the pipeline on odd rows: clashing names, nulls, ties, repeated rows, long texts, empty tables."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from proxylens.llm import alignment, decontam, flac, hmm, mixing, ngram_join, periodic, pii, quality, sharding, simhash, token_counts, url_filter

#: Names that operators use inside, or once did.
CLASHING = ["_tie", "_bucket", "_keep", "_digest", "_row", "row", "size", "target", "copies", "taken", "source_size", "_copy", "tie", "bucket", "first", "digest", "keep", "score", "rank", "words", "h", "_n", "_u", "_hit", "base", "spans", "letters", "signal", "media", "print", "near", "key", "block", "other", "node", "root", "id", "runs", "collapsed", "pairs", "n_docs"]
KEPT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def clashing(spark):
    long = " ".join(f"w{i % 1234} me{i}@host{i % 9}.org" for i in range(8_000))
    rows = [Row(1, "Hello World hello", "en", "a", 1), Row(1, "Hello World hello", "en", "a", 1), Row(2, None, None, None, None), Row(None, "", "en", "a", 0), Row(None, None, None, None, None), Row(3, long, "de", "b", 5), Row(4, "Hello World hello", "fr", "b", 1), Row(5, "É à ß 😀 \x1f\x85 mixed", "fr", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.concat_ws("/", F.lit(c), F.coalesce("doc_id", F.lit(-1))).alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """labels and benchmark with nulls, and the same without rows."""
    out = {}
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (3, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "completely other words"), (None, None), (2, "")], "item_id long, text string")
    for name, share in (("some", True), ("none", False)):
        out[name] = str(tmp_path_factory.mktemp(name))
        labels.where(F.lit(share)).write.parquet(f"{out[name]}/labels.parquet")
        items.where(F.lit(share)).write.parquet(f"{out[name]}/benchmark.parquet")
    return out


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
@pytest.mark.parametrize("with_rows", ["some", "none"])
def test_stages(spark, clashing, tables, name, stage, with_rows):
    got = stage(spark, clashing, tables[with_rows])
    assert got.columns[: len(clashing.columns)] == clashing.columns and (name == "shards" or got.columns == clashing.columns)
    found = got.select(*clashing.columns).collect()
    before = {str(r) for r in clashing.collect()}
    assert found and {str(r) for r in found} <= before
    if name == "shards":
        assert len(found) == clashing.count()
    assert stage(spark, clashing.limit(0), tables[with_rows]).count() == 0


REPORTS = {
    "op1": lambda d, i: hmm.score_corpus(d, states=2, rounds=1, own=20, tail=8, frequent=50),
    "op2": lambda d, i: pii.pii_report(d),
    "op3": lambda d, i: sharding.shard_manifest(d),
    "op4": lambda d, i: url_filter.filter_urls(d.withColumn("page_id", F.col("doc_id")).withColumn("url", F.col("text"))),
    "op5": lambda d, i: flac.media_manifest(d),
    "op6": lambda d, i: quality.quality_report(d, i),
    "op7": lambda d, i: mixing.mix(d).select("doc_id", "size", "source_size", "target", "taken"),
    "op8": lambda d, i: token_counts.count_tokens(d),
    "op9": lambda d, i: ngram_join.similarity_classes(d),
    "op10": lambda d, i: decontam.contamination_report(d, i.select(F.col("doc_id").alias("item_id"), F.lit("hello world").alias("text"))),
    "op11": lambda d, i: simhash.simhash_components(d),
    "op12": lambda d, i: periodic.run_report(d),
    "op13": lambda d, i: alignment.alignment_report(d),
}


@pytest.mark.parametrize("op", sorted(REPORTS))
def test_reports(spark, clashing, tables, op):
    labels = spark.read.parquet(f"{tables['some']}/labels.parquet")
    with_extra, plain = (sorted(map(str, REPORTS[op](d, labels).collect())) for d in (clashing, clashing.select(*KEPT)))
    if op in ("op3", "op4", "op7"):  # equal but for which of equal rows, or which draw of a repeated row, is which
        assert len(with_extra) == len(plain) == clashing.count()
    else:
        assert with_extra == plain and len(plain) == clashing.count()
    assert REPORTS[op](clashing.limit(0), labels).count() == 0


def test_redact_passes_clashing_columns(spark, clashing):
    got = pii.redact(clashing)
    assert got.columns == clashing.columns and got.count() == clashing.count()
    assert got.where("doc_id = 3").first().text.count("[EMAIL]") == 8_000


def test_pipeline_runs_on_nulls(spark, clashing, tables, tmp_path):
    import shutil

    sf = str(tmp_path / "sf")
    shutil.copytree(tables["some"], sf)
    clashing.select(*KEPT).write.parquet(f"{sf}/documents.parquet")
    assert set(corpus_pipeline.run(spark, sf).columns) == {*KEPT, "shard", "slot"}
    assert corpus_pipeline.run(spark, sf).count() > 0
