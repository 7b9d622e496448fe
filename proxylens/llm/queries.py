"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from proxylens.llm import alignment, decontam, flac, hmm, mixing, ngram_join, periodic, pii, quality, sharding, simhash, token_counts, url_filter
from proxylens.llm.common import table


def op1_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_corpus(table(spark, sf_dir, "documents"))


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, sf_dir, "documents"))


def op4_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op5_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_manifest(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_ngram_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_hmm_scores, op2_pii_spans, op3_shards, op4_url_verdicts, op5_flac_media, op6_quality, op7_mix, op8_token_counts, op9_ngram_classes, op10_contamination, op11_simhash_components, op12_periodic_runs, op13_token_alignment)}

#: The mix: words, targets by water-filling over sources, expected copies by water-filling over weights, and walks down the ranking of the Pareto quotients.
_MIX_WALK = """
c{n} AS (SELECT id, src, q, size, room, sum(size) OVER (PARTITION BY src ORDER BY q) AS upto FROM pool JOIN s{n} USING (src) WHERE q > behind AND size <= room),
s{m} AS (SELECT s.src, coalesce(min(q) FILTER (WHERE upto > c.room), 'infinity'::DOUBLE) AS behind, any_value(s.room) - coalesce(sum(size) FILTER (WHERE upto <= c.room), 0) AS room FROM s{n} s LEFT JOIN c{n} c USING (src) GROUP BY s.src),
"""
MIX_SQL = (
    r"""
WITH raw AS (SELECT doc_id, coalesce('s' || source, 'n') AS src, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
  substr(sha256('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(source, '') || '|' || coalesce(text, '')), 1, 13) AS drawn FROM documents),
numbered AS (SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY drawn) AS alike, row_number() OVER (PARTITION BY drawn) - 1 AS n FROM raw),
d AS (SELECT id, doc_id, src, source, size, length(bin(size))::DOUBLE AS w, (('0x' || CASE WHEN alike > 1 THEN substr(sha256('mix|' || drawn || '|0|' || n), 1, 13) ELSE drawn END)::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM numbered),
tot AS (SELECT src, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
share AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS sw, source_size * 2.0::DOUBLE AS top FROM tot),
lev AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(top) OVER (ORDER BY top / sw, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(sw) OVER (ORDER BY top / sw, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM share),
t AS (SELECT src, source_size, coalesce(least(top, (SELECT arg_min(level, top / sw) FROM lev WHERE level * sw <= top) * sw), top) AS target FROM lev),
g AS (SELECT src, w, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
gs AS (SELECT h.src, h.w, any_value(target) AS target, any_value(h.words) AS words, coalesce(sum(o.words) FILTER (WHERE o.w > h.w), 0) AS above, sum(o.w * o.words) FILTER (WHERE o.w <= h.w) AS mass FROM g h JOIN g o USING (src) JOIN t USING (src) GROUP BY h.src, h.w),
gf AS (SELECT *, CASE WHEN mass > 0 THEN (target - above * 2.0::DOUBLE) / mass END AS f FROM gs),
best AS (SELECT src, arg_max(f, w) AS f FROM gf WHERE f * w <= 2 GROUP BY src),
lam AS (SELECT gf.src, w, words, target, least(2.0::DOUBLE, coalesce(best.f * w, 2.0::DOUBLE)) AS lam FROM gf LEFT JOIN best USING (src)),
s0 AS (SELECT src, -1.0::DOUBLE AS behind, any_value(target) - sum(floor(lam) * words) AS room FROM lam GROUP BY src),
dl AS (SELECT d.*, floor(lam) AS whole, lam - floor(lam) AS chance FROM d JOIN lam USING (src, w)),
pool AS (SELECT id, src, size, (u / (1 - u)) / (chance / (1 - chance)) AS q FROM dl WHERE chance > 0 AND size > 0),
"""
    + "".join(_MIX_WALK.format(n=n, m=n + 1) for n in range(3))
    + """
took AS (SELECT id FROM c0 WHERE upto <= room UNION ALL SELECT id FROM c1 WHERE upto <= room UNION ALL SELECT id FROM c2 WHERE upto <= room)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (whole + (k.id IS NOT NULL)::INT))::BIGINT AS taken FROM dl JOIN t USING (src) LEFT JOIN took k USING (id)
"""
)

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(regexp_split_to_array({_LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
CONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS g FROM b, range(1, len(w) - n + 2) r(i)),
lens AS (SELECT DISTINCT n FROM b),
dw AS (SELECT uid, n, i, w[i:i + n - 1] AS g FROM d, lens, range(1, len(w) - n + 2) r(i) WHERE len(w) >= n),
h AS (SELECT uid, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
pos AS (SELECT uid, count(DISTINCT i + k) AS n_hit FROM h, range(0, h.n) r(k) GROUP BY uid),
its AS (SELECT uid, count(x) AS n_items, coalesce(string_agg(x, ',' ORDER BY x), '') AS ids FROM (SELECT DISTINCT uid, item_id::VARCHAR AS x FROM h) GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (uid) LEFT JOIN its USING (uid)
"""

ORACLES = {"op7_mix": MIX_SQL, "op10_contamination": CONTAMINATION_SQL}
