"""Cross-tokenizer alignment: the tokens of a byte-level BPE (A) and of a sentence-piece model (B) over equal bytes.

Equal texts are one: texts are shuffled by their full content, each distinct one is encoded and aligned once, and
its pair counts weigh as many as its rows. Both encodings are held against the same bytes, a space and the text;
byte offsets where tokens of both end cut the tokens into groups, and the two tokens that end there are linked.
Links are counted by id pair over the corpus, a distinct text's pairs first within itself, so that what is shuffled is one row
a text and pair, combined on the map side. The counts then go back to the texts: pairs that make up at least one
part in MOST_PAIRS of all links are broadcast, of which there are MOST_PAIRS at most, so that no frequent pair is a
hot key; the others are joined through a shuffle. A text's measures are joined to its rows by its digest.

Texts that are null or empty, or whose tokens of A or B do not give back the bytes (a sentence piece model may
replace characters), have no tokens: zeros and an empty string. Texts of any length are encoded whole. Ties: every
A id whose count with a B id is the highest is a best one. Repeated rows are answered each. Empty tables give no rows. Other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proxylens.llm.common import join_counted, saved, ship_package
from proxylens.llm.token_counts import tokenizer_path

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: The pattern by which byte-level BPE splits a text before merging: a fixed value of that kind of tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pairs that are broadcast at most.
MOST_PAIRS = 500_000
#: Distinct texts whose measures are broadcast at most; bytes of texts that are encoded at a time.
MOST_TEXTS, CHUNK_BYTES = 500_000, 1 << 21


def located(name: str) -> str:
    return name if os.path.isabs(name) else tokenizer_path(name)


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes are themselves, others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Side:
    """A vocabulary: the bytes of every id, and the ids of texts."""

    def __init__(self, entries: list[bytes], encode):
        self.entries, self.encode = np.array(entries, object), encode
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        numbers = np.arange(len(entries)).astype(str).astype(object)
        self.inner, self.last = numbers + ",", numbers


def byte_side(path: str) -> Side:
    """A byte-level BPE of a tokenizers file. Special strings are ordinary text. Merges are ranked by id, as they are in such files, which is checked."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab = byte_letters(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    bytes_of = {word: bytes(letters[c] for c in word) for word in vocab if all(c in letters for c in word)}
    ranked = [vocab[a + b] for a, b in merges]
    if ranked != sorted(ranked):
        raise ValueError(f"{path}: merges are not in the order of their ids")
    used = {vocab[c] for c in letters} | set(ranked)
    ranks = {bytes_of[word]: i for word, i in vocab.items() if i in used}
    entries = [b""] * (max(vocab.values()) + 1)
    for word, i in ranks.items():
        entries[i] = word
    encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Side(entries, lambda texts: [encoding.encode_ordinary(" " + t) for t in texts])


def piece_side(path: str) -> Side:
    """A sentence piece model with byte fallback, which puts a space before each text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    entries = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Side(entries, lambda texts: model.encode(texts, num_threads=1))


def align(a: np.ndarray, b: np.ndarray, sides: tuple[Side, Side]) -> tuple[int, np.ndarray, bytes]:
    """Of two encodings of the same bytes: number of groups, the linked pairs (A id << 32 | B id), and the groups as text."""
    ends = [np.cumsum(s.sizes[x]) for s, x in zip(sides, (a, b), strict=True)]
    common = np.intersect1d(*ends, assume_unique=True)
    last = [np.searchsorted(e, common) for e in ends]  # every token has bytes, so one ends at each place
    sizes = [np.diff(x, prepend=-1) for x in last]
    # both lists of a group stand next to each other
    before = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])])[:-1]
    words = np.empty(len(a) + len(b), object)
    for ids, side, size, start, end, sign in ((a, sides[0], sizes[0], before, last[0], "|"), (b, sides[1], sizes[1], before + sizes[0], last[1], ";")):
        own = side.inner[ids]
        own[end] = side.last[ids[end]] + sign
        words[np.repeat(start - (end + 1 - size), size) + np.arange(len(ids))] = own
    pairs = a[last[0]] << 32 | b[last[1]]
    return len(common), pairs, "".join(words.tolist())[:-1].encode()


def _align_batches(byte_bpe: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = byte_side(located(byte_bpe)), piece_side(located(pieces))
        for batch in batches:
            sizes = [n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()]
            for lo, hi in _chunks(sizes):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column("text").to_pylist()]
                encoded = zip(*(s.encode(texts) for s in sides), strict=True)
                rows: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "ns")}
                for text, ids in zip(texts, encoded, strict=True):
                    want = b" " + text.encode()
                    a, b = (np.array(x, np.int64) for x in ids)
                    if not text or any(b"".join(s.entries[x].tolist()) != want for s, x in zip(sides, (a, b), strict=True)):
                        found = (0, 0, 0, 0, "", [], [])
                    else:
                        n, pairs, groups = align(a, b, sides)
                        distinct, ns = np.unique(pairs, return_counts=True)
                        found = (len(a), len(b), n, len(pairs), hashlib.sha256(groups).hexdigest(), distinct, ns)
                    for column, value in zip(rows.values(), found, strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("digest"), part.column("n_docs"), *(pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True))], ["digest", "n_docs", *rows])

    return run


def _chunks(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_BYTES together."""
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > CHUNK_BYTES:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def aligned_texts(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """A row for each distinct text: node, digest, n_docs, n_a, n_b, n_groups, n_links, groups (a hash), and the linked pairs with how often each is linked in the text (pairs, ns)."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("n_docs"))
    kind = "digest binary, n_docs long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, ns array<long>"
    aligned = texts.select(digest(F.col("text")).alias("digest"), "n_docs", "text").mapInArrow(_align_batches(byte_bpe, pieces), kind)
    return saved(aligned.withColumn("node", F.monotonically_increasing_id()), "aligned-texts")


def text_pairs(texts: DataFrame) -> DataFrame:
    """node, n_docs, pair, k (how often the text links it)."""
    return texts.select("node", "n_docs", F.explode(F.arrays_zip("pairs", "ns")).alias("z")).select("node", "n_docs", F.col("z.pairs").alias("pair"), F.col("z.ns").alias("k"))


def pair_counts(texts: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n (links over all documents), best (whether no other A id is linked with the B id more often). A B id has no more rows than A has ids."""
    counts = text_pairs(texts).groupBy("pair").agg(F.sum(F.col("k") * F.col("n_docs")).alias("n"))
    named = counts.withColumn("a_id", F.shiftright("pair", 32).cast("int")).withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    return saved(named.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id"))), "aligned-pairs")


def text_measures(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """node, n_best, count_sum for the texts with links."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most MOST_PAIRS pairs have so many links
    frequent = F.col("n") >= -(-total // MOST_PAIRS)
    held, slim = text_pairs(texts).select("node", "pair", "k"), counts.select("pair", "n", "best")
    rare = slim.where(~frequent)
    weighed = [F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum")]
    first = F.broadcast(slim.where(frequent))
    if rare.isEmpty():
        return held.join(first, "pair").groupBy("node").agg(*weighed)
    both = held.join(first, "pair").unionByName(held.join(first, "pair", "left_anti").join(rare, "pair"))
    return both.groupBy("node").agg(*weighed)


def alignment_report(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    texts = aligned_texts(docs, byte_bpe, pieces)
    measures = text_measures(texts, pair_counts(texts))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    table = texts.join(measures, "node", "left").select("digest", "n_docs", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), F.col("groups").alias("groups_sha256"))
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    return join_counted(rows, saved(table, "aligned-measures"), "digest", "n_docs", MOST_TEXTS).drop("digest", "n_docs")
