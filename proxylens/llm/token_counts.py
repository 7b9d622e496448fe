"""Token counts with a two-tier lookup on the map side.

Tier one is a broadcast table of the lengths of the most frequent pre-tokens, found by merging bounded
sketches of the partitions, neighbours with neighbours until few are left; tier two is a cache in each
worker that encodes what the table misses. Nothing is shuffled. A pre-token here is a run without ASCII
white space: the tokenizer's pattern never crosses white space, so the counts of the runs add up to the
count of the text. The table only saves time; the counts are those of the library whatever it holds. Runs
of more than LONGEST bytes are encoded each time they occur, so that table and cache are bounded in bytes.

Null text counts as empty and has no tokens. Very long texts and runs are encoded whole. Repeated rows
and equal texts are counted each, so ties need no order. Empty input gives no rows. Extra columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxylens.llm.common import saved, ship_package

#: Entries of the broadcast table, of a partition's sketch, and of a worker's cache before it starts anew.
TABLE, SKETCH, CACHE = 65_536, 8_192, 500_000
#: Bytes of a run that is kept anywhere; sketches that come to the driver, and that are merged to one before.
LONGEST, MOST_SKETCHES, MERGED = 128, 8, 16
LIMIT = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Of a file beside the installed public tokenizers, on whichever machine this runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Lengths(dict):
    """bytes of a pre-token -> number of tokens; encodes what it has not seen, and starts anew when full."""

    def __init__(self, path: str, table: dict[bytes, int], most: int = CACHE):
        from tokenizers import Tokenizer

        super().__init__(table)
        self.encode, self.table, self.most = Tokenizer.from_file(path).encode, table, most + len(table)

    def __missing__(self, run: bytes) -> int:
        n = len(self.encode(run.decode(), add_special_tokens=False).ids)
        if len(run) > LONGEST:
            return n
        if len(self) >= self.most:
            self.clear()
            self.update(self.table)
        self[run] = n
        return n


def _row(counts: Counter, most: int) -> pa.RecordBatch:
    top = counts.most_common(most)
    return pa.RecordBatch.from_arrays([pa.array([[w for w, _ in top]], pa.list_(pa.binary())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], ["runs", "ns"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of a partition's most frequent short runs."""
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update((text.as_py() or b"").split())
            if len(counts) > 16 * SKETCH:
                counts = Counter(dict(counts.most_common(4 * SKETCH)))
    yield _row(Counter({w: n for w, n in counts.items() if len(w) <= LONGEST}), SKETCH)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for runs, ns in zip(batch.column("runs"), batch.column("ns"), strict=True):
            counts.update(dict(zip(runs.as_py(), ns.as_py(), strict=True)))
            if len(counts) > 4 * TABLE:
                counts = Counter(dict(counts.most_common(2 * TABLE)))
    yield _row(counts, TABLE)


def frequent_runs(docs: DataFrame, most: int = TABLE) -> list[bytes]:
    """About the most frequent runs of all texts, `most` at most; MOST_SKETCHES sketches come to the driver."""
    ship_package(docs.sparkSession)
    kind = "runs array<binary>, ns array<long>"
    sketches = saved(docs.select(F.col("text").cast("binary")).mapInArrow(_sketch, kind), "token-sketches")
    while (left := sketches.count()) > MOST_SKETCHES:
        sketches = saved(sketches.coalesce(-(-left // MERGED)).mapInArrow(_merge, kind), "token-sketches")
    counts: Counter = Counter()
    for r in sketches.collect():
        counts.update(dict(zip(map(bytes, r.runs), r.ns, strict=True)))
    return [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]]


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = LIMIT, table: int = TABLE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document; tokenizer: a name or an absolute path of a .json file."""
    spark = docs.sparkSession
    ship_package(spark)
    find = (lambda: tokenizer) if os.path.isabs(tokenizer) else (lambda: tokenizer_path(tokenizer))
    lengths = Lengths(find(), {})
    frequent = spark.sparkContext.broadcast({run: lengths[run] for run in frequent_runs(docs, table)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lengths(find(), frequent.value)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            counts = [sum(map(known.__getitem__, t.split())) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
