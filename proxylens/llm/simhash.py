"""SimHash near-duplicates: fingerprints, and the components of those that differ in at most RADIUS bits.

Equal fingerprints are collapsed first. For each distinct one the Hamming distances to PIVOTS reference
fingerprints are computed once and kept in a table. Distances to a reference differ by no more than the
fingerprints themselves, so a pair whose greatest difference of coordinates is above RADIUS is discarded from
the tables alone; only the survivors are compared bit by bit.

Which pairs meet at all: of the four quarters of 16 bits, two fingerprints with 3 different bits share one, and
of the four pieces of 12 bits of what remains they share one again. Sixteen keys of 28 bits a fingerprint
therefore bring every link together. Buckets are cut into blocks of BLOCK members and dealt out block against
block, so that a task holds two blocks at most, however large the bucket; pairs are formed inside tasks only,
which hand out no more links than join the same fingerprints. In a bucket of m distinct fingerprints the rows
moved are m * m / BLOCK.

Words are runs without ASCII white space, A-Z lower-cased; shingles are SHINGLE words joined by a space, repeats
included, hashed by XXH64 with seed 42. A bit is set where over half of the hashes have it. A text of fewer
words has one shingle of all; one without words, null included, has fingerprint zero and is linked like any
other. Texts of any length are taken whole, in pieces. The component is named by its least doc_id (null only if
all are null). Repeated rows have equal fingerprints; there are no ties to break. Empty tables give no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxylens.llm.common import join_counted, saved, ship_package
from proxylens.llm.ngram_join import components

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Reference fingerprints; any would do, these are fixed random ones.
PIVOTS = np.random.default_rng(31).integers(0, 1 << 64, 32, np.uint64)
#: Members of a block of a bucket.
BLOCK = 1024
#: Shingles that are hashed at a time, and cells of the distance tables that are compared at a time.
PIECE, CELLS = 1 << 16, 1 << 20
#: Most distinct fingerprints, or keys of large buckets, that are broadcast.
MOST_ROWS = 1_000_000


def shingle_hashes(words: list[bytes]) -> Iterator[np.ndarray]:
    """The hashes of all shingles, in pieces."""
    size = min(SHINGLE, len(words))
    for lo in range(0, len(words) - size + 1 if size else 0, PIECE):
        part = words[lo : lo + PIECE + size - 1]
        text, ends = b" ".join(part), np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = np.concatenate([[0], ends[:-size]]).tolist()
        yield np.fromiter((xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))


def fingerprint(text: bytes) -> int:
    """The 64 bits that over half of the shingles' hashes have."""
    words = text.lower().split()
    ones, total = np.zeros(64, np.int64), 0
    for h in shingle_hashes(words):
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        total += len(h)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py() or b"") for t in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (the 64 bits as a long)."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_sketch, f"doc_id {kind}, print long")


def distance_table(print_: Column) -> Column:
    """The Hamming distances to the pivots, a byte each."""
    near = [F.bit_count(print_.bitwiseXOR(F.lit(int(p)))) for p in PIVOTS.view(np.int64)]
    return F.unhex(F.concat(*[F.lpad(F.hex(n), 2, "0") for n in near]))


def bucket_keys(print_: Column) -> Column:
    """16 keys: a quarter of the bits, with a quarter of the others. Fingerprints within RADIUS share one."""
    keys = []
    for quarter in range(4):
        turned = F.shiftleft(print_, 16 * quarter).bitwiseOR(F.shiftrightunsigned(print_, 64 - 16 * quarter)) if quarter else print_
        for piece in range(4):
            low = F.shiftrightunsigned(turned, 12 * piece).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((4 * quarter + piece) << 28).bitwiseOR(F.shiftleft(F.shiftrightunsigned(turned, 48), 12)).bitwiseOR(low))
    return F.array(*keys)


def near_pairs(a: np.ndarray, b: np.ndarray, near_a: np.ndarray, near_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of a and b within RADIUS. The pairs are discarded one coordinate of the tables after the other; survivors are verified."""
    out, rows = [], max(1, CELLS // max(1, len(b)))
    first = near_b[:, 0]
    for lo in range(0, len(a), rows):
        i, j = np.nonzero(np.abs(near_a[lo : lo + rows, None, 0] - first[None, :]) <= RADIUS)
        i += lo
        for c in range(1, near_a.shape[1]):
            close = np.abs(near_a[i, c] - near_b[j, c]) <= RADIUS
            i, j = i[close], j[close]
        verified = np.bitwise_count(a[i] ^ b[j]) <= RADIUS
        out.append((i[verified], j[verified]))
    return tuple(np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in (0, 1))


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node of its component under the links (i, j)."""
    label, before = np.arange(n), None
    while before is None or (label != before).any():
        before = label.copy()
        np.minimum.at(label, i, before[j])
        np.minimum.at(label, j, before[i])
        label = np.minimum(label, label[label])
    return label


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, lo, hi: each group holds the members of one block or of two. Links (a, b) that join what is near."""
    held: list[tuple[np.ndarray, ...]] = []
    last = None

    def links() -> Iterator[pa.RecordBatch]:
        prints, near, block = (np.concatenate([x[k] for x in held]) for k in (0, 1, 2))
        low = block == last[1]
        sides = [np.flatnonzero(low), np.flatnonzero(low if last[1] == last[2] else ~low)]
        i, j = near_pairs(prints[sides[0]], prints[sides[1]], near[sides[0]], near[sides[1]])
        i, j = sides[0][i], sides[1][j]
        top = forest(len(prints), i[i != j], j[i != j])
        joined = np.flatnonzero(top != np.arange(len(top)))
        if len(joined):
            yield pa.RecordBatch.from_arrays([pa.array(prints[top[joined]].view(np.int64)), pa.array(prints[joined].view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "lo", "hi")], 1)
        prints, block = batch.column("print").to_numpy().view(np.uint64), batch.column("block").to_numpy()
        near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(-1, len(PIVOTS)).astype(np.int8)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            group = tuple(keys[lo].tolist())
            if held and group != last:
                yield from links()
                held.clear()
            held.append((prints[lo:hi], near[lo:hi], block[lo:hi]))
            last = group
    if held:
        yield from links()


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the fingerprints of nodes, a table (print, near), that join all those within RADIUS of one another."""
    keyed = nodes.select("print", "near", F.explode(bucket_keys(F.col("print"))).alias("key"))
    shared = saved(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "simhash-shared")
    # members of buckets that nobody shares stop here, on the map side while the shared keys are few
    met = join_counted(keyed, shared, "key", "members", MOST_ROWS)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = met.withColumn("block", F.pmod(F.xxhash64("print"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = placed.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "print", "near")
    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_link, "a long, b long")


def component_table(prints: DataFrame) -> DataFrame:
    """print, n_docs, component_id for the distinct fingerprints of prints, a table (doc_id, print)."""
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_docs"))
    nodes = saved(nodes.withColumn("near", distance_table(F.col("print"))), "simhash-nodes")
    roots = components(saved(links(nodes), "simhash-links"))
    placed = nodes.join(roots, nodes["print"] == roots["node"], "left").withColumn("root", F.coalesce("root", "print"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return saved(placed.join(names, "root").select("print", "n_docs", "component_id"), "simhash-components")


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id for every document."""
    prints = saved(fingerprints(docs), "simhash-prints")
    found = join_counted(prints, component_table(prints), "print", "n_docs", MOST_ROWS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

