"""Periodic runs: stretches of words that repeat with a period at least EXPONENT times, found by minimizers of several scales.

At scale s the grams of k = 2 ** s words are hashed and each window of w = k / 2 grams keeps its least. Within a
run of period q, k / 2 < q <= k, grams less than q apart differ and grams q apart are equal, so the least of a
window and the least of the window q words later are q apart and have no equal between them; a run of 4 periods
holds both windows. Hence neighbouring equal minimizers that are more than w and at most k words apart seed each
such run, and every seed is extended word by word to both sides as far as words q apart are equal. Periods up to
SHORT are found by comparing the words with those q later directly. A stretch whose period is a multiple of a
smaller one is the smaller one's run and is left out.

Scales go up to a quarter of the longest text, so every period is found; the hashes only propose, words decide.
Texts are laid end to end with separators that equal nothing, up to CHUNK_BYTES at a time and a long text alone;
texts too short for a scale leave before it. Memory and work are in proportion to the words of a chunk (times the
square of the number of scales). No rows are shuffled.

Words are runs without ASCII white space. Null and empty texts have no words, no runs, and the hash of an empty
string. A run is given by (start, length, period) with words numbered from 0; of runs with equal exponent the
first start, then the shorter period is named best. Repeated rows are answered each. Empty tables give no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import binascii
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxylens.llm.common import ship_package

EXPONENT, SHORTEST, SHORT = 4, 6, 4
#: Bytes of texts that are searched at a time.
CHUNK_BYTES = 1 << 21
Run = tuple[int, int, int]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _windows(x: np.ndarray, w: int, least: Callable) -> np.ndarray:
    """The least (or greatest) of every w neighbours; w is a power of two."""
    at = 1
    while at < w:
        x = least(x[:-at], x[at:])
        at *= 2
    return x


def minimizers(h: np.ndarray, w: int) -> np.ndarray:
    """Places whose value is the least of some window of w neighbours."""
    if len(h) < w:
        return np.zeros(0, np.int64)
    least = _windows(h, w, np.minimum)
    edge = np.zeros(w - 1, h.dtype)
    return np.flatnonzero(_windows(np.concatenate([edge, least, edge]), w, np.maximum) == h)


def _reach(ids: np.ndarray, at: int, period: int, step: int) -> int:
    """How many places from at, in direction step, hold a word that is equal to the one `period` later."""
    total, size = 0, 64
    while True:
        lo, hi = (at + total, at + total + size) if step > 0 else (at - total - size + 1, at - total + 1)
        lo, hi = max(lo, 0), min(hi, len(ids) - period)
        if lo >= hi:
            return total
        unequal = np.flatnonzero((ids[lo:hi] != ids[lo + period : hi + period])[::step])
        if len(unequal):
            return total + int(unequal[0])
        total, size = total + hi - lo, 2 * size


def _is_run(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether a stretch with this period is long enough and has no smaller one (a smaller one would divide it)."""
    if length < max(SHORTEST, EXPONENT * period):
        return False
    rest, factor = period, 2
    while rest > 1:
        if rest % factor == 0:
            small = period // factor
            if (ids[start : start + period] == ids[start + small : start + small + period]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor = factor + 1 if factor * factor <= rest else max(rest, factor + 1)
    return True


def _long_runs(ids: np.ndarray, places: np.ndarray, starts: np.ndarray, periods: np.ndarray) -> Iterator[Run]:
    """The runs that hold the seeds (starts, of the words at places; periods)."""
    order = np.lexsort((starts, periods))
    done, last = -1, -1
    for at, period in zip(places[starts[order]].tolist(), periods[order].tolist(), strict=True):
        if period != last:
            done, last = -1, period
        if at < done:
            continue
        right = _reach(ids, at, period, 1)
        done = at + max(right, 1)
        if right:
            left = _reach(ids, at - 1, period, -1) if at else 0
            found = (at - left, left + right + period, period)
            if _is_run(ids, *found):
                yield found


def find_runs(ids: np.ndarray, sizes: Sequence[int]) -> list[Run]:
    """All runs of texts laid end to end, each of sizes words and a separator behind it that equals nothing; sorted."""
    found: list[Run] = []
    for q in range(1, SHORT + 1):
        equal = np.concatenate([[False], ids[:-q] == ids[q:], [False]]) if len(ids) > q else np.zeros(2, bool)
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins + q >= max(SHORTEST, EXPONENT * q)
        found += [(a, b - a + q, q) for a, b in zip(begins[long].tolist(), ends[long].tolist(), strict=True) if _is_run(ids, a, b - a + q, q)]
    sizes = np.asarray(sizes, np.int64)
    h, places, k = _mixed(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), np.arange(len(ids)), 1
    while True:
        # texts that can hold a run of more than k words' period, for the grams of 2 * k words
        stay = sizes >= EXPONENT * (k + 1)
        if not stay.any():
            return sorted(found)
        if not stay.all():
            keep = np.repeat(stay, sizes + 1)[: len(h)]  # the last grams would end behind the last text
            h, places, sizes = h[keep], places[keep], sizes[stay]
        h = _mixed(h[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:])
        places, k = places[: len(h)], 2 * k
        if k <= SHORT:
            continue
        chosen = minimizers(h, k // 2)
        order = chosen[np.argsort(h[chosen], kind="stable")]
        apart = order[1:] - order[:-1]
        seeds = np.flatnonzero((h[order[1:]] == h[order[:-1]]) & (apart > k // 2) & (apart <= k))
        found += _long_runs(ids, places, order[seeds], apart[seeds])


class _Ids(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def runs_of(texts: Sequence[Sequence[bytes]]) -> list[list[Run]]:
    """The runs of each text, a list of words; sorted by start, then period."""
    ids, sizes = _Ids(), [len(t) for t in texts]
    flat = np.full(sum(sizes) + len(sizes), -1, np.int64)
    ends = np.cumsum(np.asarray(sizes, np.int64) + 1)
    for words, end in zip(texts, ends.tolist(), strict=True):
        flat[end - 1 - len(words) : end - 1] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    flat[ends - 1] = len(ids) + np.arange(len(ends))
    found, out = find_runs(flat, sizes), [[] for _ in texts]
    owners = np.searchsorted(ends, np.array([r[0] for r in found], np.int64), side="right").tolist()
    for (start, length, period), i in zip(found, owners, strict=True):
        out[i].append((start - int(ends[i]) + sizes[i] + 1, length, period))
    return out


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that a run holds behind its first period."""
    if not runs:
        return list(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, [s + q for s, _, q in runs], 1)
    np.add.at(depth, [s + n for s, n, _ in runs], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]


def best_run(runs: Sequence[Run]) -> Run | None:
    """The run with the greatest length / period, the first of several."""
    if not runs:
        return None
    most = max(n / q for _, n, q in runs) * (1 - 1e-9)
    return min((r for r in runs if r[1] / r[2] >= most), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def planted(words: list[bytes], doc_id: object) -> list[bytes]:
    """words, with a periodic end for one id of ten by its hash: a fixed corruption of the input that runs are to be found in. Ids that are null have none."""
    h = binascii.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    period = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (period * ((n - a) // len(period) + 1))[: n - a]


def chunks(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_BYTES together."""
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > CHUNK_BYTES:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


PARTS = ("start", "length", "period")
FIELDS = pa.struct([(p, pa.int64()) for p in PARTS])


def run_columns(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", change: Callable[[list[bytes], object], list[bytes]] | None = None) -> DataFrame:
    """df's id_col with runs (array<struct<start, length, period>>), best, and collapsed (binary: the kept words joined by a space). change, if given, maps the words of a text and its id to the words that are searched."""
    ship_package(df.sparkSession)
    run = "struct<start:bigint,length:bigint,period:bigint>"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks([n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()]):
                part = batch.slice(lo, hi - lo)
                texts = [(t.as_py() or b"").split() for t in part.column("text")]
                if change:
                    texts = list(map(change, texts, part.column("id").to_pylist()))
                runs = runs_of(texts)
                named = [[dict(zip(PARTS, r, strict=True)) for r in x] for x in runs]
                best = [b and dict(zip(PARTS, b, strict=True)) for b in map(best_run, runs)]
                kept = [b" ".join(collapsed(t, r)) for t, r in zip(texts, runs, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(named, pa.list_(FIELDS)), pa.array(best, FIELDS), pa.array(kept, pa.binary())], ["id", "runs", "best", "collapsed"])

    kind = df.schema[id_col].dataType.simpleString()
    chosen = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return chosen.mapInArrow(search, f"id {kind}, runs array<{run}>, best {run}, collapsed binary").withColumnRenamed("id", id_col)


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the best run (start, length, period, exponent_milli; null without runs) and hashes of all runs and of the kept words, for every document with its planted end."""
    found = run_columns(docs, change=planted)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    milli = F.expr("1000 * best.length div best.period")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
