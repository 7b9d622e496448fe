"""Hidden Markov language model: Baum-Welch training over all partitions, exact scaled forward scoring.

A token is a word (a run without ASCII white space, A-Z lower-cased) or the end of its text. States emit
token classes: the end, each of the `own` most frequent words, and `tail` buckets of all other words by
their last three bytes. A word of a bucket is drawn by its smoothed count within the bucket, with one
further place for words never seen. So the model's parameters are few enough to broadcast, while the
word table grows with the corpus and is only joined.

Training and scoring both run over whole texts, however long. Each task sums the expected counts of its
texts and the sums meet in a shuffle by parameter. A text that is longer than a segment keeps the state of
the forward pass at the segments' borders only; the backward pass computes each segment again.

Null text counts as empty: it scores the end alone. Null doc_id is held out. Repeated rows, equal texts
and ties are scored each and learned from as often as they occur. Without any training text (an empty
table, or all rows held out) every token is unknown and the model's score is the base score's form with
N = V = 0; an empty table gives no rows. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxylens.llm.common import saved, ship_package

STATES, ROUNDS, OWN, TAIL = 12, 5, 1023, 1024
#: Words whose counts are broadcast; all others are joined.
FREQUENT = 150_000
#: Tokens whose texts are handled side by side, tokens whose states are held at once, and cells an octave of the histogram of counts.
GROUP, SEGMENT, OCTAVE = 1 << 22, 1 << 18, 32
SMOOTH = 0.1


def bucket_of(word: bytes, tail: int) -> int:
    return zlib.crc32(word[-3:]) % tail


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(10)) == 0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update((text.as_py() or b"").lower().split())
            counts[b""] += 1  # the end
            if len(counts) > 300_000:
                yield out(counts)
                counts.clear()
    if counts:
        yield out(counts)


@dataclass
class Classes:
    """What tasks need to know of words."""

    words: list[bytes]  # the frequent ones, the end (b"") first
    logs: np.ndarray  # log10(count + SMOOTH) of each
    own: int  # the end and the first own words are classes of their own
    tail: int

    def __post_init__(self):
        m, n = len(self.words), 1 + self.own
        classes = [i if i < n else n + bucket_of(w, self.tail) for i, w in enumerate(self.words)]
        self.class_of = np.array(classes + [n + b for b in range(self.tail)], np.uint16)
        self.size = n + self.tail
        self.frequent = m


class _Index(dict):
    def __init__(self, classes: Classes):
        super().__init__({w: i for i, w in enumerate(classes.words)})
        self.base, self.tail = classes.frequent, classes.tail

    def __missing__(self, word: bytes) -> int:
        return self.base + bucket_of(word, self.tail)


class Lanes:
    """Sequences side by side, the longest first: their tokens step by step, each step's from place at[t] on, lives[t] of them."""

    def __init__(self, seqs: list[np.ndarray]):
        sizes = np.array([len(s) for s in seqs], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        flat = np.concatenate([seqs[i] for i in self.order])
        lives = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        at = np.concatenate([[0], np.cumsum(lives)])
        step = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.tokens = np.empty_like(flat)
        self.tokens[at[step] + np.repeat(np.arange(len(sizes)), sizes)] = flat
        self.lives, self.at = lives.tolist(), at.tolist()

    def segments(self, most: int) -> list[tuple[int, int]]:
        """Ranges of steps of at most `most` tokens, or of one step."""
        out, lo = [], 0
        while lo < len(self.lives):
            hi = max(lo + 1, int(np.searchsorted(self.at, self.at[lo] + most, "right")) - 1)
            out.append((lo, hi))
            lo = hi
        return out


class _Pass:
    """Scaled forward states of a segment after the other, states x tokens, in one set of buffers."""

    def __init__(self, model: Hmm, lanes: Lanes, segments: list[tuple[int, int]], kind):
        most, k = max(lanes.at[hi] - lanes.at[lo] for lo, hi in segments), len(model.start)
        self.lanes, self.start, self.into = lanes, model.start.astype(kind)[:, None], np.ascontiguousarray(model.step.T, kind)
        self.rows = np.ascontiguousarray(model.emit.T, kind)
        self.alpha, self.emit, self.scale = np.empty((k, most), kind), np.empty((k, most), kind), np.empty(most, kind)

    def forward(self, lo: int, hi: int, before: np.ndarray | None) -> np.ndarray:
        """Fills the buffers for steps lo to hi, from the states of step lo - 1; the states of step hi - 1."""
        at, lives = self.lanes.at, self.lanes.lives
        base, n = at[lo], at[hi] - at[lo]
        tokens = self.lanes.tokens[base : at[hi]]
        for row, out in zip(self.rows, self.emit, strict=True):
            np.take(row, tokens, out=out[:n], mode="clip")
        for t in range(lo, hi):
            own = slice(at[t] - base, at[t] - base + lives[t])
            a, c = self.alpha[:, own], self.scale[own]
            if t:
                np.matmul(self.into, before[:, : lives[t]], out=a)
                a *= self.emit[:, own]
            else:
                np.multiply(self.start, self.emit[:, own], out=a)
            np.add.reduce(a, 0, out=c)
            a /= c
            before = a
        return before


@dataclass
class Hmm:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # classes x states
    own: int = 0
    tail_logs: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log10 of the total mass of each class; 0 for own ones

    def score(self, seqs: list[np.ndarray], segment: int = SEGMENT) -> np.ndarray:
        """log10 of the probability of each class sequence: the forward recursion, scaled at each token."""
        lanes = Lanes(seqs)
        segments, before = lanes.segments(segment), None
        run, total = _Pass(self, lanes, segments, np.float64), np.zeros(len(seqs))
        for lo, hi in segments:
            before = run.forward(lo, hi, before).copy()
            base, n = lanes.at[lo], lanes.at[hi] - lanes.at[lo]
            logs = np.log10(run.scale[:n])
            for t in range(lo, hi):
                total[: lanes.lives[t]] += logs[lanes.at[t] - base : lanes.at[t] - base + lanes.lives[t]]
        out = np.empty_like(total)
        out[lanes.order] = total
        return out

    def expected(self, seqs: list[np.ndarray], segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Baum-Welch: expected starts, steps and emissions of the sequences, in single precision within a segment."""
        lanes = Lanes(seqs)
        segments, marks, before = lanes.segments(segment), [], None
        run, at, lives, k = _Pass(self, lanes, segments, np.float32), lanes.at, lanes.lives, len(self.start)
        for lo, hi in segments:
            marks.append(before)
            before = run.forward(lo, hi, before).copy()
        steps, emissions = np.zeros((k, k)), np.zeros((len(self.emit), k))
        back, beta, ahead = np.ascontiguousarray(self.step, np.float32), np.empty((k, lives[0]), np.float32), np.empty((k, 0), np.float32)
        for i, (lo, hi) in reversed(list(enumerate(segments))):
            base, n = at[lo], at[hi] - at[lo]
            if i < len(segments) - 1:  # the buffers hold the last segment
                ahead = ahead.copy()
                run.forward(lo, hi, marks[i])
            for t in range(hi - 1, lo - 1, -1):
                own, later = slice(at[t] - base, at[t] - base + lives[t]), ahead.shape[1]
                a, b = run.alpha[:, own], beta[:, : lives[t]]
                if later:
                    np.matmul(back, ahead, out=b[:, :later])
                    steps += np.matmul(a[:, :later], ahead.T)
                b[:, later:] = 1
                a *= b  # the probabilities of the states now
                ahead = run.emit[:, own]
                ahead *= b
                ahead /= run.scale[own]
            tokens = lanes.tokens[base : at[hi]].astype(np.intp)
            for s in range(k):
                emissions[:, s] += np.bincount(tokens, run.alpha[s, :n], len(self.emit))
        return run.alpha[:, : lives[0]].sum(1, dtype=np.float64), steps * self.step, emissions


def first_model(class_counts: np.ndarray, states: int, seed: int) -> Hmm:
    """States that differ at random around the class frequencies, and tend to last."""
    rng = np.random.default_rng(seed)
    emit = (class_counts[:, None] + SMOOTH) * np.exp(rng.normal(0, 0.5, (len(class_counts), states)))
    even = np.full(states, 1 / states)
    stay = 0.9 if states > 1 else 1.0
    step = np.full((states, states), (1 - stay) / max(states - 1, 1))
    np.fill_diagonal(step, stay)
    return Hmm(even, step, emit / emit.sum(0))


def maximized(starts: np.ndarray, steps: np.ndarray, emissions: np.ndarray, class_counts: np.ndarray) -> Hmm:
    prior = (class_counts + SMOOTH) / (class_counts + SMOOTH).sum()
    emit = emissions + prior[:, None]
    start, step = starts + 1e-2, steps + 1e-2
    return Hmm(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def _encoder(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: Classes = shared.value
        index, logs, own = _Index(classes), np.append(classes.logs, np.zeros(classes.tail)), 1 + classes.own
        find = index.__getitem__
        for batch in batches:
            seqs, known, sure, rest, misses = [], [], [], [], []
            for text in batch.column("text"):
                tokens = (text.as_py() or b"").lower().split()
                tokens.append(b"")
                at = np.fromiter(map(find, tokens), np.int64, len(tokens))
                cls, log, missed = classes.class_of[at], logs[at], np.flatnonzero(at >= classes.frequent)
                seqs.append(cls.tobytes())
                known.append(len(at) - len(missed))
                own_sum = float(log[cls < own].sum())
                sure.append(own_sum)
                rest.append(float(log.sum()) - own_sum)
                misses.append(Counter(tokens[i] for i in missed))
            n = pa.array([len(s) // 2 for s in seqs], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), n, pa.array(known, pa.int64()), pa.array(sure, pa.float64()), pa.array(rest, pa.float64()), pa.array(seqs, pa.binary()), pa.array([list(m) for m in misses], pa.list_(pa.binary())), pa.array([list(m.values()) for m in misses], pa.list_(pa.int64()))], ["doc_id", "held_out", "n_tokens", "known", "own_log", "rest_log", "seq", "misses", "times"])

    return encode


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Hmm = shared.value
        sums, group, held = None, [], 0

        def flush():
            nonlocal sums, group, held
            got = model.expected(group)
            sums = got if sums is None else tuple(a + b for a, b in zip(sums, got, strict=True))
            group, held = [], 0

        for batch in batches:
            for seq in batch.column("seq"):
                group.append(np.frombuffer(seq.as_py(), np.uint16))
                held += len(group[-1])
                if held >= GROUP:
                    flush()
        if group:
            flush()
        if sums is not None:
            flat = np.concatenate([s.ravel() for s in sums])
            there = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(flat[there], pa.float64())], ["place", "n"])

    return run


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Hmm = shared.value
        for batch in batches:
            seqs = [np.frombuffer(s.as_py(), np.uint16) for s in batch.column("seq")]
            if not seqs:
                continue
            states = model.score(seqs)
            mass = [float(model.tail_logs[s].sum()) for s in seqs]
            kept = [c for c in batch.schema.names if c != "seq"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(states, pa.float64()), pa.array(mass, pa.float64())], [*kept, "state_score", "tail_mass"])

    return run


def frequent_words(words: DataFrame, most: int) -> list:
    """Rows of word, n: all words from some count on, `most` at most, in order of falling count."""
    real = words.where(F.length("word") > 0).withColumn("cell", F.floor(F.log2("n") * OCTAVE))
    room, least = most, None
    for r in sorted(real.groupBy("cell").count().collect(), key=lambda r: -r["cell"]):  # 64 * OCTAVE rows at most
        room -= r["count"]
        if room < 0:
            break
        least = r["cell"]
    found = real.where(F.col("cell") >= least).select("word", "n").collect() if least is not None else []  # `most` rows at most
    return sorted(found, key=lambda r: (-r.n, bytes(r.word)))


@dataclass
class Trained:
    model: Hmm
    classes: Classes
    words: DataFrame  # word, n of the training texts, the end as the empty word
    tokens: int
    distinct: int
    end_known: bool
    encoded: DataFrame


def train(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, own: int = OWN, tail: int = TAIL, frequent: int = FREQUENT, seed: int = 5) -> Trained:
    """The model of the documents that are not held out, and all documents in its classes."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    counted = docs.where(~F.col("held_out")).select("text").mapInArrow(_count_words, "word binary, n long")
    words = saved(counted.groupBy("word").agg(F.sum("n").alias("n")), "hmm-words")

    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = frequent_words(words, frequent)
    end = words.where(F.length("word") == 0).first()
    table = [b"", *(bytes(r.word) for r in top)]
    counts = np.array([end.n if end else 0, *(r.n for r in top)], np.float64)
    own = min(own, len(top))
    classes = Classes(table, np.log10(counts + SMOOTH), own, tail)
    owned = spark.createDataFrame([(bytearray(w),) for w in table[: 1 + own]], "word binary")
    others = words.join(F.broadcast(owned), "word", "left_anti")  # 1 + own rows
    buckets = others.groupBy(F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(tail)).cast("int").alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()  # `tail` rows at most
    class_counts, mass = np.zeros(classes.size), np.zeros(classes.size)
    class_counts[: 1 + own] = counts[: 1 + own]
    mass[1 + own :] = np.log10(SMOOTH)
    for r in buckets:
        class_counts[1 + own + r.b] = r.n
        mass[1 + own + r.b] = np.log10(r.n + SMOOTH * (r.v + 1))

    shared = spark.sparkContext.broadcast(classes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = docs.mapInArrow(_encoder(shared), f"doc_id {kind}, held_out boolean, n_tokens long, known long, own_log double, rest_log double, seq binary, misses array<binary>, times array<long>")
    encoded = saved(encoded.withColumn("uid", F.monotonically_increasing_id()), "hmm-texts")  # stays as written

    model = first_model(class_counts, states, seed)
    training = encoded.where(~F.col("held_out")).select("seq")
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(model)
        sums = np.zeros(states + states * states + classes.size * states)
        for r in training.mapInArrow(_counter(now), "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).collect():  # one row per parameter
            sums[r.place] = r.n
        cut = states + states * states
        model = maximized(sums[:states], sums[states:cut].reshape(states, states), sums[cut:].reshape(classes.size, states), class_counts)
        now.destroy()
    model.tail_logs, model.own = mass, own
    return Trained(model, classes, words, int(total.n), int(total.v), end is not None, encoded)


def score_corpus(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document; options: see train."""
    spark, t = docs.sparkSession, train(docs, **options)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # each text asks once for a word, however often it has it
    asked = t.encoded.select("uid", F.explode(F.arrays_zip("misses", "times")).alias("m")).select("uid", F.col("m.misses").alias("word"), F.col("m.times").alias("k")).join(t.words, "word", "left")
    looked = asked.groupBy("uid").agg(F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("missed_log"), F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("found"))
    scored = t.encoded.drop("misses", "times").mapInArrow(_scorer(spark.sparkContext.broadcast(t.model)), f"doc_id {kind}, held_out boolean, n_tokens long, known long, own_log double, rest_log double, uid long, state_score double, tail_mass double")
    joined = scored.join(looked, "uid", "left")
    tail_log = F.col("rest_log") + F.coalesce("missed_log", F.lit(0.0))
    base = F.col("own_log") + tail_log - F.col("n_tokens") * F.lit(float(np.log10(t.tokens + SMOOTH * (t.distinct + 1))))
    ends_known = F.lit(0 if t.end_known else 1)
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("known") - ends_known + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(t.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("state_score") + tail_log - F.col("tail_mass")).alias("score"))
