"""Self-join of texts by the Jaccard similarity of their word n-grams, with Bayesian candidate pruning.

Equal texts are collapsed first. Each distinct text gets a MinHash signature; texts that agree on all
values of a band are candidates. MinHash values of a candidate pair are compared a few at a time and the
pair is dropped as soon as the posterior probability (uniform prior) that it reaches the threshold is
below `TOLERANCE`; the others are verified exactly on their whole n-gram sets.

Candidates come in two rounds, so that a group of near copies costs no square of its size in rows. First
every member of a band's bucket meets the bucket's first member; the links found give components. Then
the pairs of a bucket that lie in different components are pruned and verified, block against block inside
tasks, which hand out no more links than join the same texts. Blocks hold one large component, or several
small ones; blocks of one and the same component do not meet, so that an outlier in a bucket meets each other
member once. With BANDS bands of ROWS values a pair at the threshold misses all buckets with probability 6e-7,
more similar ones less. Classes are the components of the verified links.

`link_counts` compares all pairs within a class, block by block inside tasks, and hands out counts only: the
work of this part is the square of the number of different texts of a class.

Words are runs without ASCII white space, A-Z lower-cased. A text of fewer than `n` words has one n-gram
of all its words; one without words has none and is like equal texts only. Null text counts as empty. Texts of
any length are compared whole. Class ids are the least doc_id of the class (null only if all are null).
Repeated rows are copies of one another; among rows with the least id one stays. Empty input gives no rows.
Other columns, whatever their names, pass through `keep_one`; `similarity_classes` ignores them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proxylens.llm.common import broadcast_if_small, saved, ship_package

N, THRESHOLD, TOLERANCE = 5, Fraction(4, 5), 1e-7
BANDS, ROWS = 36, 5
HASHES, STEP = BANDS * ROWS, 30
#: Members of a bucket that is joined on the map side.
LARGE = 10_000
#: Members of a block; larger buckets and classes are compared block against block.
BLOCK = 256
#: Most rows of a table of digests that is broadcast.
MOST_DIGESTS = 1_000_000
ODD = np.random.default_rng(11).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = np.random.default_rng(12).integers(0, 1 << 63, N, np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def ngram_set(text: bytes, hashes: dict, n: int = N) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word n-grams."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(w))
    count = len(w) - size + 1
    x = np.full(count, size * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for i in range(size):
        x += w[i : i + count] * PLACES[i]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return np.unique(x)


def signature(grams: np.ndarray) -> np.ndarray:
    """For each hash function, bits of the least value, as uint16."""
    least = np.full(HASHES, (1 << 64) - 1, np.uint64)
    for lo in range(0, len(grams), 2048):
        np.minimum(least, (grams[lo : lo + 2048, None] * ODD).min(0), out=least)
    return (least >> np.uint64(16)).astype(np.uint16)


def least_matches(threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(compared, matches): fewer matches mean a posterior below tolerance. P(J >= t | m of c) is P(Bin(c + 1, t) <= m)."""
    t, out = float(threshold), []
    for c in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(c + 1, m) * t**m * (1 - t) ** (c + 1 - m)
        out.append((c, m))
    return out


def surviving(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs of signatures (rows of a and b) that stay above the tolerance."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for compared, least in least_matches():
        matches = matches + (a[alive, done:compared] == b[alive, done:compared]).sum(1)
        stay = matches >= least
        alive, matches, done = alive[stay], matches[stay], compared
    return alive


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        sizes, sigs = [], []
        for text in batch.column("text"):
            grams = ngram_set(text.as_py() or b"", hashes)
            sizes.append(len(grams))
            sigs.append(signature(grams).tobytes())
            if len(hashes) > 1_000_000:
                hashes.clear()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary())], ["doc_id", "digest", "size", "sig"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        sets = []
        for text in batch.column("text"):
            sets.append(ngram_set(text.as_py() or b"", hashes).tobytes())
            if len(hashes) > 1_000_000:
                hashes.clear()
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "grams"])


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).take(pa.array(surviving(a, b)))


def similar(both: int, a: int, b: int) -> bool:
    return both * THRESHOLD.denominator >= THRESHOLD.numerator * (a + b - both)


def similar_sets(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return similar(int((both[1:] == both[:-1]).sum()), len(x), len(y))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for i, (x, y) in enumerate(zip(batch.column("grams_a"), batch.column("grams_b"), strict=True)):
            if similar_sets(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)):
                kept.append(i)
        yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """node, digest, min_doc, n_docs, n_first (rows with that doc_id), size, sig: a row for each distinct text."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    sketched = docs.select("doc_id", F.unhex(F.md5(text)).alias("digest"), text.cast("binary").alias("text")).mapInArrow(_sketch, f"doc_id {kind}, digest binary, size int, sig binary")
    counted = sketched.groupBy("digest", "doc_id").agg(F.count("*").alias("rows"), F.first("size").alias("size"), F.first("sig").alias("sig"))
    grouped = counted.groupBy("digest").agg(F.min("doc_id").alias("min_doc"), F.sum("rows").alias("n_docs"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rows"))["rows"].alias("n_first"), F.first("size").alias("size"), F.first("sig").alias("sig"))
    return saved(grouped.withColumn("node", F.monotonically_increasing_id()), "ngram-texts")


def band_members(texts: DataFrame) -> DataFrame:
    """key, band, node, leader, members for the buckets of two or more texts. Large buckets meet their rows on the map side."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(j, F.substring(F.col("sig"), j * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    bands = texts.where(F.col("size") > 0).select("node", F.posexplode(keys).alias("band", "key"))
    shared = saved(bands.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("members")).where(F.col("members") > 1), "ngram-shared")
    large, few = broadcast_if_small(shared.where(F.col("members") > LARGE), MOST_DIGESTS), shared.where(F.col("members") <= LARGE)
    return saved(bands.join(large, "key").unionByName(bands.join(few, "key")), "ngram-members")


def close_sizes(a: str, b: str):
    """No pair of sets reaches the threshold unless the smaller has that share of the larger."""
    return F.least(a, b) * THRESHOLD.denominator >= F.greatest(a, b) * THRESHOLD.numerator


def with_facts(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """pairs (a, b), a table, with the facts (node, ...) of both as *_a and *_b. A text in many pairs is dealt out in copies, one for BLOCK pairs."""
    out = pairs
    for side, other in ("ab", "ba"):
        hot = saved(pairs.groupBy(side).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("copies")).where(F.col("copies") > 1), "ngram-hot")
        hot = broadcast_if_small(hot, MOST_DIGESTS)
        own = facts.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in facts.columns if c != "node"])
        own = own.join(hot, side, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
        out = out.join(hot, side, "left").withColumn("copy", F.coalesce(F.pmod(F.xxhash64(other), F.col("copies")), F.lit(0)).cast("int")).drop("copies")
        out = out.join(own, [side, "copy"]).drop("copy")
    return out


def pruned(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of candidates, a table, that survive the comparison of their signatures."""
    both = with_facts(pairs, texts.select("node", "size", "sig"))
    return both.where(close_sizes("size_a", "size_b")).select("a", "b", "sig_a", "sig_b").mapInArrow(_prune, "a long, b long")


def gram_sets(nodes: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """node, grams for the given nodes, from the documents' texts."""
    wanted = saved(texts.select("node", "digest").join(nodes, "node"), "ngram-wanted")
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.unhex(F.md5(text)).alias("digest"), text.cast("binary").alias("text")).join(broadcast_if_small(wanted, MOST_DIGESTS), "digest")
    return found.select("node", "text").mapInArrow(_grams, "node long, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))


def verified(pairs: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that are similar indeed."""
    pairs = saved(pairs, "ngram-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = gram_sets(nodes, texts, docs)
    return saved(with_facts(pairs, saved(sets, "ngram-sets")).select("a", "b", "grams_a", "grams_b").mapInArrow(_verify, "a long, b long"), "ngram-links")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the links of a partition, as many as join the same nodes."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    ends = [(x, top(x)) for x in parent if top(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.int64()), pa.array([r for _, r in ends], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of a link, root the least of its component.

    Each partition first boils its links down to a forest; alternating star operations join the forests.
    """
    edges = saved(links.select("a", "b").mapInArrow(_forest, "a long, b long").distinct(), "ngram-edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 16))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a != b")
        edges = saved(small.distinct(), "ngram-edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _cross(block_lo, block_hi, same: bool, band: int) -> list[tuple[int, int]]:
    """Links of two blocks (node, root, size, signature, n-gram set arrays), or of one with itself, between different components: a forest of them.

    Pairs that share an earlier band have that bucket's task compare them.
    """
    (n0, r0, s0, g0, sets0), (n1, r1, s1, g1, sets1) = block_lo, block_hi
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    i, j = np.nonzero(r0[:, None] != r1[None, :])
    small, large = np.minimum(s0[i], s1[j]), np.maximum(s0[i], s1[j])
    fits = small * THRESHOLD.denominator >= large * THRESHOLD.numerator
    if same:
        fits &= i < j
    i, j = i[fits], j[fits]
    out = []
    for at in range(0, len(i), 20_000):
        x, y = i[at : at + 20_000], j[at : at + 20_000]
        if band:
            earlier = (g0[x, : band * ROWS] == g1[y, : band * ROWS]).reshape(len(x), band, ROWS).all(2).any(1)
            x, y = x[~earlier], y[~earlier]
        kept = surviving(g0[x], g1[y])
        for u, v in zip(x[kept].tolist(), y[kept].tolist(), strict=True):
            a, b = top(int(r0[u])), top(int(r1[v]))
            if a != b and similar_sets(np.frombuffer(sets0[u], np.uint64), np.frombuffer(sets1[v], np.uint64)):
                parent[a] = b
                out.append((int(min(n0[u], n1[v])), int(max(n0[u], n1[v]))))
    return out


def _cross_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, lo, hi: each group holds the members of one block or two."""
    held: list[pa.RecordBatch] = []

    def pairs() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        node, root, size, block = (rows.column(c).to_numpy() for c in ("node", "root", "size", "block"))
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
        lo, hi = held[0].column("lo")[0].as_py(), held[0].column("hi")[0].as_py()
        sets = np.empty(len(node), object)
        sets[:] = rows.column("grams").to_pylist()
        sides = [(node[block == k], root[block == k], size[block == k].astype(np.int64), sig[block == k], sets[block == k]) for k in (lo, hi)]
        found = _cross(*sides, lo == hi, held[0].column("band")[0].as_py())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "lo", "hi")], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            group = tuple(keys[lo].tolist())
            if held and group != last:
                yield from pairs()
                held.clear()
            held.append(batch.slice(lo, hi - lo))
            last = group
    if held:
        yield from pairs()


def block_pairs(still: DataFrame) -> tuple[DataFrame, DataFrame]:
    """still (key, node, root, ...) with `block`; and key, block, lo, hi for each pair of blocks that is to meet, twice for two blocks."""
    per = still.groupBy("key", "root").agg(F.count("*").alias("n")).withColumn("part", F.when(F.col("n") * 4 >= BLOCK, F.col("root")).otherwise(-1))
    pools = saved(per.withColumn("total", F.sum("n").over(Window.partitionBy("key", "part"))).select("key", "root", "part", F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks")), "ngram-pools")
    placed = still.join(pools, ["key", "root"]).withColumn("block", F.xxhash64("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))).drop("part", "blocks")
    blocks = pools.select("key", "part", "blocks").distinct().select("key", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    blocks = saved(blocks.select("key", "part", F.xxhash64("part", F.col("i").cast("int")).alias("block")), "ngram-blocks")
    a, b = (blocks.select("key", F.col("part").alias(f"part_{x}"), F.col("block").alias(x)) for x in ("lo", "hi"))
    pairs = saved(a.join(b, "key").where((F.col("lo") <= F.col("hi")) & ((F.col("part_lo") != F.col("part_hi")) | (F.col("part_lo") == -1))).select("key", "lo", "hi"), "ngram-block-pairs")
    return placed, pairs.select("key", F.col("lo").alias("block"), "lo", "hi").union(pairs.where("lo != hi").select("key", F.col("hi").alias("block"), "lo", "hi"))


def unresolved(members: DataFrame, roots: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between different components of texts that share a bucket. Members are dealt out by pairs of blocks; pairs are formed inside tasks only."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("key")
    # two members have met already: one leads the bucket
    still = saved(placed.where(F.col("members") > 2).join(open_keys, "key").select("key", "band", "node", "root"), "ngram-open")
    sets = saved(gram_sets(still.select("node").distinct(), texts, docs), "ngram-sets")
    placed, meetings = block_pairs(still)
    dealt = placed.join(meetings, ["key", "block"]).join(texts.select("node", "size", "sig").join(sets, "node"), "node")
    dealt = dealt.select("key", "band", "lo", "hi", "block", "node", "root", "size", "sig", "grams")
    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_cross_groups, "a long, b long").distinct()


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """texts (see distinct_texts) and roots (node, root of texts with links)."""
    texts = distinct_texts(docs)
    members = band_members(texts)
    stars = saved(members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "ngram-stars")
    roots = components(verified(pruned(stars, texts), texts, docs))
    links = saved(unresolved(members, roots, texts, docs), "ngram-crossing")
    if not links.isEmpty():
        known = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(known.union(links))
    return texts, roots


def _count_blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Similar texts of each text of two blocks of a class: their number and that of their documents."""
    lo, hi = pdf[pdf["block"] == key[1]], pdf[pdf["block"] == key[2]]
    sets = [[np.frombuffer(g, np.uint64) for g in x["grams"]] for x in (lo, hi)]
    sizes = [np.array([len(s) for s in x], np.int64) for x in sets]
    both = np.zeros((len(sets[0]), len(sets[1])), np.float32)
    flat = [np.concatenate([*x, np.zeros(0, np.uint64)]) for x in sets]
    owner = [np.repeat(np.arange(len(x)), n) for x, n in zip(sets, sizes, strict=True)]
    universe = np.intersect1d(*flat)
    for at in range(0, len(universe), 4096):
        part, sides = universe[at : at + 4096], []
        for x, own, rows in zip(flat, owner, sets, strict=True):
            place = np.searchsorted(part, x).clip(0, len(part) - 1)
            there = part[place] == x
            side = np.zeros((len(rows), len(part)), np.float32)
            side[own[there], place[there]] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    both = both.astype(np.int64)
    hit = both * THRESHOLD.denominator >= THRESHOLD.numerator * (sizes[0][:, None] + sizes[1][None, :] - both)
    same = key[1] == key[2]
    if same:
        np.fill_diagonal(hit, False)
    docs = [x["n_docs"].to_numpy() for x in (lo, hi)]
    out = [(lo["node"].to_numpy(), hit.sum(1), hit @ docs[1])] + ([] if same else [(hi["node"].to_numpy(), hit.sum(0), hit.T @ docs[0])])
    return pd.DataFrame({"node": np.concatenate([x[0] for x in out]), "texts": np.concatenate([x[1] for x in out]), "documents": np.concatenate([x[2] for x in out])})


def link_counts(texts: DataFrame, roots: DataFrame, docs: DataFrame) -> DataFrame:
    """node, texts, documents: how many other texts, and documents of them, each text of a class is similar to."""
    sizes = roots.groupBy("root").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    sets = gram_sets(roots.select("node"), texts, docs)
    held = roots.join(sizes, "root").join(texts.select("node", "n_docs"), "node").join(sets, "node")
    held = held.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    held = held.select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "n_docs", "grams")
    counted = held.groupBy("root", "lo", "hi").applyInPandas(_count_blocks, "node long, texts long, documents long")
    return counted.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))


def similarity_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_copies (documents with equal text, itself included), n_links (other documents that are similar or equal)."""
    texts, roots = classes(docs)
    counts = link_counts(texts, roots, docs)
    placed = texts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = placed.groupBy("root").agg(F.min("min_doc").alias("class_id"))
    table = placed.join(names, "root").join(counts, "node", "left").select("digest", "class_id", F.col("n_docs").alias("n_copies"), (F.col("n_docs") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"))
    slim = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"))
    return slim.join(table, "digest").select("doc_id", "class_id", "n_copies", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, the one whose id is the class id; columns as they came."""
    texts, roots = classes(docs)
    placed = texts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = placed.groupBy("root").agg(F.min(F.struct(F.col("min_doc").isNull(), "min_doc", "node"))["node"].alias("kept"))
    rulings = placed.join(kept, "root").where((F.col("node") != F.col("kept")) | (F.col("n_docs") > 1))
    rulings = saved(rulings.select("digest", (F.col("node") == F.col("kept")).alias("first"), F.col("min_doc").alias("doc"), F.col("n_first").alias("rows")), "ngram-rulings")
    keyed = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"))
    ruled = keyed.join(broadcast_if_small(rulings, MOST_DIGESTS), "digest", "left").where(F.col("first").isNull() | (F.col("first") & F.col("row.doc_id").eqNullSafe(F.col("doc"))))
    single = F.coalesce("rows", F.lit(1)) == 1
    if rulings.where("first and rows > 1").isEmpty():
        return ruled.select("row.*")
    return ruled.where(single).select("row.*").union(ruled.where(~single).dropDuplicates(["digest"]).select("row.*"))
