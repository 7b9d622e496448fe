"""Benchmark decontamination by winnowing, with DataFrame functions only.

Each text keeps the minimum k-gram hash of every sliding window of `window - k + 1` k-grams, so any
shared span of `window` words leaves a shared fingerprint at the same place of the span. Training and
test fingerprints are joined, and a hit is extended to all windows of the text that hold the fingerprint; these
are looked up, word for word, among the windows of the items. Every window that is shared holds one. Items of fewer than `window` words
are one window of their own length, fingerprinted by all grams of that length.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. Null and empty texts have
no words; items without words never occur. The windows of items without id are searched like others; such
items have no name to give and are left out of n_items and items_sha256. Every row is fingerprinted; hits are
worked out once for equal texts and reported for each row. Repeated item ids count once. Texts of any length, also of one word repeated, take
memory in proportion to their length. Empty tables give no hits. Input columns, whatever their names, pass
through `decontaminate`; `contamination_report` ignores those it does not name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxylens.llm.common import ascii_lower, broadcast_if_small, is_small, let, saved

#: Around words, upper-case letters being part of words not yet lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5
#: Most rows that are broadcast of: fingerprints of items, matched texts.
MOST_PRINTS, MOST_TEXTS = 1_000_000, 1_000_000
#: Copies of a benchmark table that is too large for a broadcast.
SALTS = 16
LOW32 = (1 << 32) - 1
NO_HITS = "cast(array() as array<struct<length:int,hash:bigint,pos:int>>)"
NO_PRINTS = "cast(array() as array<struct<hash:bigint,pos:int>>)"


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text))


def digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def fingerprints(words: Column, gram: int, window: int) -> Column:
    """array<struct<hash, pos>>: for every span of `window` words the rightmost minimum of its gram hashes."""
    span = window - gram + 1

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - gram), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(gram)]))

    def winnowed(h: Column) -> Column:
        # the hash's high half, then the position from behind: the least is the rightmost minimum
        order = F.transform(h, lambda x, i: F.shiftleft(F.shiftright(x, 32), 32).bitwiseOR(F.lit(LOW32) - i))
        least = let(order, lambda o: F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(o) - span), lambda i: F.array_min(F.slice(o, i + 1, span)))))
        return F.transform(least, lambda v: (F.lit(LOW32) - v.bitwiseAND(F.lit(LOW32))).cast("int")) if span > 1 else F.sequence(F.lit(0), F.size(h) - 1)

    def prints(w: Column) -> Column:
        return let(hashes(w), lambda h: F.transform(winnowed(h), lambda p: F.struct(F.get(h, p).alias("hash"), p.alias("pos"))))

    return let(words, lambda w: F.when(F.size(w) >= window, prints(w)).otherwise(F.expr(NO_PRINTS)))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, item_words, length (of its windows)."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("item_words")).where(F.size("item_words") > 0).distinct()
    return items.withColumn("length", F.least(F.size("item_words"), F.lit(WINDOW)))


def gram_of(length: Column) -> Column:
    return F.when(length == WINDOW, GRAM).otherwise(length)


def join_benchmark(rows: DataFrame, table: DataFrame, on: list[str], salt: list[str], how: str = "inner") -> DataFrame:
    """rows with what table, of the benchmark and one row a key, has for them. A table that is too large for a broadcast is copied SALTS times, so that what very many texts share is dealt out by the salt columns."""
    if is_small(table, MOST_PRINTS):
        return rows.join(F.broadcast(table), on, how)
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)).cast("int")).join(copies, [*on, "_salt"], how).drop("_salt")


def window_tables(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of all distinct windows of items: (length, window, list), a window being its words; and (list, items), the distinct lists of ids of the items that have a window, sorted as strings."""
    texts = let(F.struct("item_words", "length"), lambda x: F.transform(F.sequence(F.lit(0), F.size(x["item_words"]) - x["length"]), lambda i: F.array_join(F.slice(x["item_words"], i + 1, x["length"]), " ")))
    spread = items.select("item_id", "length", F.explode(F.array_distinct(texts)).alias("window"))
    held = spread.groupBy("length", "window").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    held = saved(held.withColumn("list", F.md5(F.to_json("items"))), "decontam-windows")
    return held.select("length", "window", "list"), saved(held.select("list", "items").dropDuplicates(["list"]), "decontam-lists")


def find_hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per distinct contaminated text: _digest, n_hit, found (names a set of lists); and one per set: found, items (sorted ids as strings).

    A fingerprint that a text shares with items is extended to the windows of the text that hold it, and these
    are looked up among the items' windows. Lists of items meet each set of lists, not each text, so
    that a passage that many texts and many items share costs rows in proportion to both, not to their product.
    """
    items = saved(item_windows(benchmark), "decontam-items")
    short = [r.length for r in items.where(F.col("length") < WINDOW).select("length").distinct().collect()]  # at most WINDOW - 1 numbers
    lengths = [(WINDOW, GRAM), *((n, n) for n in sorted(short))]

    def prints(words: Column, n: int, g: int) -> Column:
        return F.transform(fingerprints(words, g, n), lambda p: F.struct(F.lit(n).alias("length"), p["hash"].alias("hash"), p["pos"].alias("pos")))

    own = F.concat(*[F.when(F.col("length") == n, prints(F.col("item_words"), n, g)).otherwise(F.expr(NO_HITS)) for n, g in lengths])
    wanted = saved(items.select(F.explode(own).alias("p")).select("p.length", "p.hash").distinct(), "decontam-wanted")
    windows, lists = window_tables(items)

    texts = docs.select(digest(F.col("text")).alias("_digest"), words_of(F.col("text")).alias("words"))
    every = texts.select("_digest", F.explode(F.concat(*[prints(F.col("words"), n, g) for n, g in lengths])).alias("p")).select("_digest", "p.*")
    found = join_benchmark(every, wanted, ["length", "hash"], ["_digest", "pos"], "left_semi")
    marked = saved(found.groupBy("_digest").agg(F.collect_set(F.struct("length", "pos")).alias("marks")), "decontam-marks")

    hit_texts = broadcast_if_small(marked.select("_digest"), MOST_TEXTS)
    matched = docs.select("text", digest(F.col("text")).alias("_digest")).join(hit_texts, "_digest", "left_semi").groupBy("_digest").agg(F.first("text").alias("text"))
    held = matched.select("_digest", words_of(F.col("text")).alias("words")).join(marked, "_digest")

    def around(x: Column, n: int, g: int) -> Column:
        """The text's windows of n words that hold a marked gram of g words."""
        own = F.filter(x["marks"], lambda m: m["length"] == n)
        starts = F.array_distinct(F.flatten(F.transform(own, lambda m: F.sequence(F.greatest(m["pos"] - (n - g), F.lit(0)), F.least(m["pos"], F.size(x["words"]) - n)))))
        return F.transform(starts, lambda at: F.struct(F.lit(n).alias("length"), at.alias("start"), F.array_join(F.slice(x["words"], at + 1, n), " ").alias("window")))

    here = let(F.struct("words", "marks"), lambda x: F.concat(*[around(x, n, g) for n, g in lengths]))
    asked = held.select("_digest", F.explode(here).alias("h")).select("_digest", "h.*")
    spans = saved(join_benchmark(asked, windows, ["length", "window"], ["_digest", "start"]).select("_digest", "start", "length", "list"), "decontam-spans")

    positions = spans.select("_digest", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    per_text = positions.groupBy("_digest").agg(F.count("*").alias("n_hit"))
    per_set = spans.groupBy("_digest").agg(F.array_sort(F.collect_set("list")).alias("lists")).withColumn("found", F.md5(F.array_join("lists", ",")))
    hits = saved(per_text.join(per_set, "_digest"), "decontam-hits")
    sets = hits.select("found", "lists").dropDuplicates(["found"]).select("found", F.explode("lists").alias("list")).join(lists, "list")
    named = sets.groupBy("found").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return hits.drop("lists"), saved(named, "decontam-sets")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    hits, sets = find_hits(docs, benchmark)
    named = sets.select("found", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    hits = saved(hits.join(named, "found").drop("found"), "decontam-report")
    every = docs.select("doc_id", digest(F.col("text")).alias("_digest"), F.size(split_words(F.col("text"))).cast("long").alias("n_words")).join(broadcast_if_small(hits, MOST_TEXTS), "_digest", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return every.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of any item; columns as they came."""
    hits = find_hits(docs, benchmark)[0].select(F.col("_digest").alias("_hit"))
    kept = docs.select(F.struct("*").alias("_row"), digest(F.col("text")).alias("_digest")).join(broadcast_if_small(hits, MOST_TEXTS), F.col("_digest") == F.col("_hit"), "left_anti")
    return kept.select("_row.*")
