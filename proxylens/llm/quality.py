"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes.

A logistic model on the form of a text (fitted on at most `sample` labelled documents, the first in
order of the hash of their id) gives each document's evidence. The labels of all documents are counted by
path (host and sub-collection) and by host. The spread of the group means beyond what chance explains sets
how strongly a level is shrunk: hosts towards the whole corpus, paths towards their host, so that a path
without labels has its host's posterior and a host without labels the corpus's mean. The posterior of a path
moves the odds of its documents. The threshold is the one that keeps all but `lost` of all labelled good
documents, in the fitting sample or not, 0.5 at most. Each text is looked at once, besides the sample's.

Hosts are `source`, paths `source` and `lang`; nulls form groups of their own. Null text counts as empty;
texts of any length are looked at whole. Equal texts and repeated rows of one site are judged alike, and rows
at the threshold stay. With no labels, or labels of one kind, everything is kept with the score 0.5. Several
labels of a document count by their mean. Empty tables give no rows. Columns of the input, whatever their
names, pass through `keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxylens.llm.common import broadcast_if_small, saved, ship_package

FEATURES = ("letters", "upper", "digits", "marks", "bars", "high", "word_len", "words", "distinct", "lines", "marked", "pairs")
SAMPLE, LOST = 20_000, 0.0005
#: Most paths whose posteriors, and most documents whose labels are broadcast.
MOST_PATHS, MOST_LABELS = 200_000, 1_000_000
#: Most cells of a histogram that come to the driver.
CELLS = 4096


def _classes() -> np.ndarray:
    kind = np.full(256, 5)
    for c in range(128):
        ch = chr(c)
        kind[c] = 0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 4 if ch in "|#*%&$!" else 6 if ch.isspace() else 3
    return kind


KIND = _classes()


def features_of(text: bytes) -> list[float]:
    """How a text looks, as numbers of about the same size."""
    counts = np.bincount(KIND, np.bincount(np.frombuffer(text, np.uint8), minlength=256), 7)
    lower, upper, digits, marks, bars, high, _ = counts
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    n, size = max(len(words), 1), max(len(text) - counts[6], 1)
    letters = max(lower + upper, 1)
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:" for w in words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [(lower + upper + high) / size, upper / letters, digits / size, marks / size, bars / size, high / size, min(size / n, 30) / 10, np.log1p(len(words)) / 5, len(set(words)) / n, len(set(lines)) / max(len(lines), 1), marked / n, pairs / max(n - 1, 1)]


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features_of(t.as_py() or b"") for t in batch.column("text")]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(rows, pa.list_(pa.float64()))], [*kept, "features"])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on features and their squares by Newton's method; weights and intercept."""
    x = np.hstack([x, x * x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step / max(1.0, float(np.abs(step).max()) / 20)
        if float(np.abs(step).max()) < 1e-8:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def evidence(self) -> Column:
        """The logit of a document by its features alone."""
        n = len(FEATURES)
        out = F.lit(self.bias)
        for i in range(n):
            f = F.col("features")[i]
            out = out + f * float(self.weights[i]) + f * f * float(self.weights[n + i])
        return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), out))


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def logit(c: Column) -> Column:
    return F.ln(c / (F.lit(1.0) - c))


def shrunk(groups: DataFrame, prior: Column) -> DataFrame:
    """groups (n, total, square columns) with `posterior`, shrunk to prior as the data say."""
    mean = F.col("total") / F.col("n")
    own = F.greatest(F.col("square") / F.col("n") - mean * mean, F.lit(1e-6)) / F.col("n")
    spread = groups.where("n > 0").agg(F.sum("n").alias("n"), F.sum(F.col("n") * ((mean - prior) ** 2 - own)).alias("between"), F.sum("square").alias("square"), F.sum("total").alias("total")).first()
    if not spread.n:
        return groups.withColumn("posterior", prior)
    whole = spread.total / spread.n
    within = max(spread.square / spread.n - whole * whole, 1e-6)
    strength = min(max(within / max(spread.between / spread.n, 1e-9), 5.0), 1e6)
    return groups.withColumn("posterior", (F.col("total") + prior * strength) / (F.col("n") + strength))


def site_keys(host: str, path: str) -> list[Column]:
    """_h, _p: host and path as keys that are never null."""
    return [F.coalesce(F.concat(F.lit(mark), F.col(c).cast("string")), F.lit("n")).alias(name) for name, mark, c in (("_h", "h", host), ("_p", "p", path))]


def site_posteriors(sites: DataFrame, labelled: DataFrame) -> DataFrame:
    """_h, _p, host_posterior, path_posterior, shift (of the logit) for each of the sites (_h, _p) by the labels (_h, _p, y)."""
    none = sites.select("_h", "_p", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("total"), F.lit(0.0).alias("square"))
    given = labelled.groupBy("_h", "_p").agg(F.count("*").alias("n"), F.sum("y").alias("total"), F.sum(F.col("y") * F.col("y")).alias("square"))
    sums = [F.sum(c).alias(c) for c in ("n", "total", "square")]
    paths = saved(none.union(given).groupBy("_h", "_p").agg(*sums), "quality-paths")
    overall = paths.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    mean = min(max(overall.total / overall.n, 1e-3), 1 - 1e-3) if overall.n else 0.5
    hosts = shrunk(paths.groupBy("_h").agg(*sums), F.lit(mean)).select("_h", F.col("posterior").alias("host_posterior"))
    joined = shrunk(saved(paths.join(hosts, "_h"), "quality-hosts"), F.col("host_posterior"))
    clipped = F.greatest(F.lit(1e-3), F.least(F.lit(1 - 1e-3), F.col("posterior")))
    return joined.select("_h", "_p", "host_posterior", F.col("posterior").alias("path_posterior"), (logit(clipped) - logit(F.lit(mean))).alias("shift"))


def nth(scores: DataFrame, n: int) -> float:
    """The value of `score`, in [0, 1], at place n from below; each histogram narrows the range to one cell."""
    low, high = 0.0, 1.0
    while low < high:
        cell = F.least(F.floor((F.col("score") - low) / ((high - low) / CELLS)), F.lit(CELLS - 1)).alias("cell")
        cells = scores.where(F.col("score").between(low, high)).groupBy(cell).agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()  # CELLS rows at most
        for c in sorted(cells, key=lambda c: c["cell"]):
            if n < c.n:
                low, high = c.low, c.high
                break
            n -= c.n
    return low


def percentile(scores: DataFrame, share: float) -> float | None:
    """The exact percentile of `score`, between neighbours in proportion; None without rows."""
    rows = scores.count()
    if not rows:
        return None
    place = (rows - 1) * share
    below = nth(scores, int(place))
    return below if place == int(place) else below + (nth(scores, int(place) + 1) - below) * (place - int(place))


def taught(docs: DataFrame, marks: DataFrame, sample: int) -> tuple[Model, bool]:
    """The model of the first `sample` labelled documents, and whether there was something to learn. Rows with the same id all count, but of more than 2 * sample rows so many are drawn by a hash of what they hold."""
    chosen = broadcast_if_small(saved(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-sample"), sample)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(chosen, "doc_id").select("doc_id", "y", "text")
    seen = texts.mapInArrow(_featurize, f"doc_id {kind}, y double, features array<double>")
    rows = seen.orderBy(F.xxhash64("doc_id", "features"), "doc_id", "features").limit(2 * sample).collect()
    x, y = np.array([r.features for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r.y for r in rows])
    if len(set(y > 0.5)) < 2:
        return Model(np.zeros(2 * len(FEATURES)), 0.0), False
    return Model(*fit(x, y)), True


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lost: float = LOST, host: str = "source", path: str = "lang", kept: list[str] | None = None) -> DataFrame:
    """row (the columns `kept` of docs, all by default), evidence, host_posterior, path_posterior, score, keep."""
    ship_package(docs.sparkSession)
    marks = saved(labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("y")), "quality-marks")
    sites_of = docs.select("doc_id", *site_keys(host, path))
    # ids that are labelled and in docs: the sample is drawn among them
    known = saved(sites_of.join(broadcast_if_small(marks, MOST_LABELS), "doc_id").select("doc_id", "_h", "_p", "y"), "quality-known")
    model, learned = taught(docs, known.groupBy("doc_id").agg(F.first("y").alias("y")), sample)
    sites = saved(site_posteriors(sites_of.select("_h", "_p").distinct(), known), "quality-sites")

    raw = docs.select(F.struct(*(kept or docs.columns)).alias("row"), F.col("doc_id").alias("_id"), *site_keys(host, path), F.col("text").cast("binary").alias("text"))
    schema = T.StructType([*(f for f in raw.schema if f.name != "text"), T.StructField("features", T.ArrayType(T.DoubleType()))])
    placed = raw.mapInArrow(_featurize, schema).join(broadcast_if_small(sites, MOST_PATHS), ["_h", "_p"], "left")
    score = sigmoid(model.evidence() + F.col("shift")) if learned else F.lit(0.5)
    scored = saved(placed.select("row", "_id", sigmoid(model.evidence()).alias("evidence"), "host_posterior", "path_posterior", score.alias("score")), "quality-scores")

    threshold = 0.0
    if learned:
        good = broadcast_if_small(marks.where("y > 0.5").select(F.col("doc_id").alias("_id")), MOST_LABELS)
        threshold = min(0.5, percentile(saved(scored.select("_id", "score").join(good, "_id").select("score"), "quality-good"), lost) * (1 - 1e-9))
    return scored.drop("_id").withColumn("keep", F.col("score") >= threshold)


def quality_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, evidence, host_posterior, path_posterior, score, keep for every document."""
    rows = judged(docs, labels, kept=["doc_id"], **options)
    return rows.select("row.doc_id", *[F.round(c, 9).alias(c) for c in ("evidence", "host_posterior", "path_posterior", "score")], "keep")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not rejected, columns as they came."""
    return judged(docs, labels, **options).where("keep").select("row.*")
