"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

The model learns from a small labelled table of URLs. Without one, the labels are those of the rules:
URLs that a rule decides teach the model what to say of the others. At most `sample` distinct labelled
URLs, the first in order of their hash, are used for the fit.

Null urls and urls without `://` have an empty host and path, which no rule fits; the model judges them by its
intercept and the empty n-gram set. Urls of any length are looked at whole. Repeated rows and equal urls are
judged alike; a score of 0 blocks. With no labelled URL at all every verdict of the model is `allow`. An empty
table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxylens.llm.common import ascii_lower, ship_package

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
GRAMS, SLOTS, SAMPLE = (3, 4, 5), 1 << 14, 4_000


def url_parts(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]], pick) -> Column:
    """pick(rule, verdict) of the longest rule that fits host, or a parent domain of it, and path."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.lit(pick(rule, verdict))) if out is None else out.when(fits, F.lit(pick(rule, verdict)))
    return out if out is not None else F.lit(None).cast("string")


def gram_slots(host: str, path: str) -> np.ndarray:
    """The distinct slots of the n-grams of host and path."""
    found = set()
    for mark, part in ((b"h", f"^{host}$".encode()), (b"p", f"^{path}$".encode())):
        for n in GRAMS:
            found.update(zlib.crc32(mark + part[i : i + n]) % SLOTS for i in range(len(part) - n + 1))
    return np.fromiter(sorted(found), np.int64, len(found))


def fit_logistic(rows: Sequence[tuple[str, str, float]], rounds: int = 300, rate: float = 0.5, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch gradient steps with adaptive rates; rows of host, path, label."""
    weights, bias = np.zeros(SLOTS), 0.0
    if not rows:
        return weights, -1.0
    slots = [gram_slots(h, p) for h, p, _ in rows]
    sizes = np.array([len(s) for s in slots])
    flat, owner, y = np.concatenate(slots), np.repeat(np.arange(len(rows)), sizes), np.array([r[2] for r in rows])
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    seen, seen_bias = np.full(SLOTS, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(owner, weights[flat], len(rows)) * scale + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        slope = np.bincount(flat, (error * scale)[owner], SLOTS) / len(rows) + ridge * weights
        seen += slope**2
        seen_bias += error.mean() ** 2
        weights -= rate * slope / np.sqrt(seen)
        bias -= rate * error.mean() / np.sqrt(seen_bias)
    return weights, bias


def train(labelled: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on rows of host, path, label (1: block)."""
    distinct = labelled.where(F.col("label").isNotNull()).groupBy("host", "path").agg(F.avg("label").alias("label"))
    first = distinct.orderBy(F.xxhash64("host", "path"), "host", "path").limit(sample)
    return fit_logistic([(r.host, r.path, float(r.label)) for r in first.collect()])


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, score (of the model), verdict for every page; labelled: url, label (1: block)."""
    spark = pages.sparkSession
    ship_package(spark)
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    h, p = F.col("host"), F.col("path")
    ruled = parts.select("*", rule_column(h, p, rules, lambda r, v: r).alias("rule"), rule_column(h, p, rules, lambda r, v: v).alias("ruling"))
    if labelled is None:
        taught = ruled.select("host", "path", F.when(F.col("ruling") == "block", 1.0).when(F.col("ruling") == "allow", 0.0).alias("label"))
    else:
        lh, lp = url_parts(F.col("url"))
        taught = labelled.select(lh.alias("host"), lp.alias("path"), F.col("label").cast("double").alias("label"))
    model = spark.sparkContext.broadcast(train(taught, sample))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in batches:
            scores = []
            for a, b in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                slots = gram_slots(a, b)
                scores.append(float(weights[slots].sum() / max(len(slots), 1) ** 0.5 + bias))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    scored = ruled.mapInArrow(judge, T.StructType([*ruled.schema, T.StructField("score", T.DoubleType())]))
    verdict = F.coalesce("ruling", F.when(F.col("score") >= 0, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("score", 9).alias("score"))
