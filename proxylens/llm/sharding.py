"""Sharding by a two-pass external shuffle.

Pass one scatters records into memory-sized buckets with seeded hashes, a partition for each bucket; pass
two runs Fisher-Yates over each whole bucket. The shard follows the law `key`: it is the one whose seeded
hash with doc_id is largest, so a further shard takes rows only into itself. A shard has as many buckets as
its bytes need, so that a hot shard (a third of all rows without doc_id, say) has more of them.

Where a row goes within its shard is decided by the hash of all its columns, so the result is the same from
run to run. Rows that are equal in all columns share a bucket; where they would take more than a quarter of
it, they are told apart by their number and spread. Null doc_id: all such rows share a shard. Null text counts as empty. Texts of any length stay whole.
Repeated rows keep one slot each. Empty input gives no rows. Input columns, whatever their names, pass
through; only a clashing `shard` or `slot` column of the input is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxylens.llm.common import broadcast_if_small, numbered, saved, ship_package

#: Most repeated rows, and most buckets, whose table is broadcast.
MOST_REPEATED, MOST_BUCKETS = 1_000_000, 500_000


def record_size() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(8)


def shard_of(n_shards: int, seed: int) -> Column:
    """The shard in 0..n_shards-1 whose hash with doc_id is largest."""
    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), s, F.col("doc_id")).alias("h"), s.alias("s"))))["s"]


def row_hash(docs: DataFrame, seed: int) -> Column:
    """A seeded hash of all columns; their places tell nulls apart."""
    parts = [x for i, f in enumerate(docs.schema) for x in (F.lit(i), F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`"))]
    return F.xxhash64(F.lit(seed), F.lit("bucket"), *parts)


def _fisher_yates(seed: int):
    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """One whole bucket at a time; the input is sorted by bucket."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ids = batch.column("bucket").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi == lo:
                    continue
                if held and held[0].column("bucket")[0].as_py() != ids[lo]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in buckets(batches):
            number, n = bucket.column("bucket")[0].as_py(), bucket.num_rows
            order = np.arange(n)
            np.random.default_rng([seed, number]).shuffle(order)  # Fisher-Yates
            slots = pa.array(np.arange(n) + bucket.column("first")[0].as_py(), pa.int64())
            for lo in range(0, n, 2048):
                part = bucket.select(["row", "shard"]).take(pa.array(order[lo : lo + 2048]))
                yield from part.append_column("slot", slots.slice(lo, 2048)).to_batches()

    return run


def shuffle_into_shards(docs: DataFrame, n_shards: int = 24, seed: int = 20240601, bucket_bytes: int = 32 << 20) -> DataFrame:
    """docs with `shard` int and `slot` long, gapless from 0 within each shard, rows in slot order within each bucket."""
    ship_package(docs.sparkSession)
    docs = docs.drop("shard", "slot")
    rows = docs.select(F.struct("*").alias("row"), shard_of(n_shards, seed).alias("shard"), record_size().alias("size"), row_hash(docs, seed).alias("tie"))
    slim = saved(rows.groupBy("shard", "tie").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")), "shard-ties")
    # equal rows may share a bucket until they weigh on it
    repeated = saved(slim.where((F.col("rows") > 1) & (F.col("bytes") > bucket_bytes // 4)).select("tie"), "shard-repeats")
    if not repeated.isEmpty():
        repeated = broadcast_if_small(repeated, MOST_REPEATED)
        several = numbered(rows.join(repeated, "tie", "left_semi"), ["tie"]).withColumn("tie", F.xxhash64(F.lit(seed), "tie", "_n"))
        rows = rows.join(repeated, "tie", "left_anti").unionByName(several.select(*rows.columns))

    held = {r.shard: r.bytes for r in slim.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}  # n_shards rows at most
    parts = [max(1, math.ceil(held.get(s, 0) / bucket_bytes)) for s in range(n_shards)]
    begins = np.concatenate([[0], np.cumsum(parts)]).astype(int).tolist()
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("shard"))
    placed = rows.withColumn("bucket", (pick(begins[:-1]) + F.pmod("tie", pick(parts))).cast("int"))
    counts = saved(placed.groupBy("shard", "bucket").count(), "shard-buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = saved(counts.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")), "shard-firsts")
    dealt = placed.join(broadcast_if_small(first, MOST_BUCKETS), "bucket").repartitionById(begins[-1], "bucket").sortWithinPartitions("bucket", "tie")
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return dealt.select("row", "shard", "bucket", "first").mapInArrow(_fisher_yates(seed), schema).select("row.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; the files of a bucket hold its rows in slot order."""
    sharded.write.partitionBy("shard").parquet(path)


def shard_manifest(docs: DataFrame, n_shards: int = 24, seed: int = 20240601, bucket_bytes: int = 32 << 20) -> DataFrame:
    """Digest of the shuffled records: one row per record."""
    sharded = shuffle_into_shards(docs.select("doc_id", "text"), n_shards, seed, bucket_bytes)
    text = F.coalesce("text", F.lit(""))
    return sharded.select("doc_id", record_size().alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", shard_of(n_shards + 1, seed).alias("grown_shard"))
