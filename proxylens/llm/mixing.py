"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

A source's target is its share of all words by weight, held at `cap` times what it has, the excess
going to the others by weight. Within a source the copies a document is to have in expectation are
proportional to its inclusion weight, `cap` at most, so that they add up to the target in words. The whole
copies among them are certain and are given first; what is left of each, below one, is the document's
inclusion probability, and documents are ranked by random odds over inclusion odds. The sample goes down
the ranking until the next document would pass the target in words; later rounds go on behind it with
documents that still fit.

The inclusion weight is the number of binary digits of a document's words: a long document is more likely
to come than a short one, by far less than its length. `weight_col` names another: positive numbers, rounded
down to an eighth of an octave; documents with none or with zero are never taken.

Null text counts 0 words; null source is a source of its own, last in order. Rows with equal doc_id,
source and text get a draw each, by the hash of their other columns and their number among equal rows.
Different rows whose ranks tie are taken or left together. Texts of any length are counted whole. Empty
input gives no rows. `mixture` returns the input's columns, whatever their names; in `mix` the added columns
replace clashing ones of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proxylens.llm.common import broadcast_if_small, numbered, saved

WORD = r"[^\x20\x09-\x0D]++"
#: The rank is a number of so many bits, searched in steps of CELL bits, so that no window holds more than 2**CELL rows a source.
BITS, CELL = 52, 12
ADDED = ("size", "source_size", "target", "copies", "taken")
#: Weights are rounded down to such parts of an octave.
PARTS = 8
#: Most draws of repeated rows that are broadcast.
MOST_REPEATED = 1_000_000
#: Most sources whose table is broadcast.
MOST_SOURCES = 200_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draw(seed: str, columns: Sequence[str] = ("doc_id", "source", "text")) -> Column:
    """BITS random bits in hexadecimal that the row's contents decide."""
    parts = [F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, BITS // 4)


def uniform(drawn: Column) -> Column:
    """A number in (0, 1)."""
    return (F.conv(drawn, 16, 10).cast("double") + 0.5) / float(1 << BITS)


def set_apart(rows: DataFrame, repeated: DataFrame, seed: str) -> DataFrame:
    """rows with an own draw _u for each of those whose draw is in `repeated`; the same set of draws for the same rows."""
    several = numbered(rows.join(repeated, "_u", "left_semi"), ["_u", "_rest"])
    several = several.withColumn("_u", draw(seed, ("_u", "_rest", "_n"))).drop("_n")
    return rows.join(repeated, "_u", "left_anti").unionByName(several)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """_source, source_size, target from rows of _source, size."""
    totals = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = totals.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), place + 1)).withColumn("top", F.col("source_size") * F.lit(float(cap)))
    full_first = Window.orderBy(F.col("top") / F.col("w"), F.col("_source").asc_nulls_last())
    earlier, on = full_first.rowsBetween(Window.unboundedPreceding, -1), full_first.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)) - F.coalesce(F.sum("top").over(earlier), F.lit(0.0))) / F.sum("w").over(on)
    leveled = weighted.withColumn("level", level)
    fits = F.min(F.when(F.col("level") * F.col("w") <= F.col("top"), F.struct(F.col("top") / F.col("w"), "level"))).over(Window.partitionBy())["level"]
    return leveled.select("_source", "source_size", F.coalesce(F.least("top", fits * F.col("w")), F.col("top")).alias("target"))


def _boundary(rows: DataFrame, room: DataFrame, keys: list[str], cell: Column) -> DataFrame:
    """Per source the first cell, in order, at which the words pass `room`, with the room left before it."""
    words = rows.join(room, keys).groupBy(*keys, "room", cell.alias("cell")).agg(F.sum("size").alias("words"))
    ordered = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    past = words.withColumn("until", F.sum("words").over(ordered)).where(F.col("until") > F.col("room"))
    return past.groupBy(*keys).agg(F.min(F.struct("cell", (F.col("room") - F.col("until") + F.col("words")).alias("room"))).alias("b")).select(*keys, "b.cell", "b.room")


def _round(slim: DataFrame, state: DataFrame, n: int) -> DataFrame:
    """Adds to state (_sid, lo, room) the rank hi{n} before which documents of up to max{n} words are taken, and goes on from there."""
    shift = BITS - CELL
    open_rows = slim.join(broadcast_if_small(state.select("_sid", "lo", F.col("room").alias("fits")), MOST_SOURCES), "_sid").where((F.col("rank") >= F.col("lo")) & (F.col("size") <= F.col("fits")))
    rows, keys, room, depth = open_rows.select("_sid", "rank", "size"), ["_sid"], state.select("_sid", "room"), 0
    while shift >= 2 * CELL:
        found = _boundary(rows, room, keys, F.shiftright("rank", shift))
        depth += 1
        rows, keys = rows.withColumn(f"c{depth}", F.shiftright("rank", shift)), [*keys, f"c{depth}"]
        room, shift = found.select(*keys[:-1], F.col("cell").alias(f"c{depth}"), "room"), shift - CELL
    end = _boundary(rows, room, keys, F.col("rank")).select("_sid", F.col("cell").alias("end"), F.col("room").alias("left"))
    ahead = state.join(end, "_sid", "left")
    return ahead.select("_sid", *[c for c in state.columns if c not in ("_sid", "lo", "room")], F.col("lo").alias(f"lo{n}"), F.coalesce("end", F.lit(1 << (BITS + 1))).alias(f"hi{n}"), F.col("room").alias(f"max{n}"), (F.coalesce("end", F.lit(1 << (BITS + 1))) + 1).alias("lo"), F.coalesce("left", F.lit(0.0)).alias("room"))


def expected_copies(words: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """_sid, _w, source_size, target, whole, chance, room from rows of _sid, _w, words: a row for each weight in a source."""
    heavy_first = Window.partitionBy("_sid").orderBy(F.desc("_w"))
    earlier, on = heavy_first.rowsBetween(Window.unboundedPreceding, -1), heavy_first.rowsBetween(0, Window.unboundedFollowing)
    over = F.sum(F.col("_w") * F.col("words")).over(on)
    factor = F.when(over > 0, (F.col("target") - F.coalesce(F.sum("words").over(earlier), F.lit(0)) * F.lit(float(cap))) / over)
    placed = words.join(targets, "_sid").withColumn("factor", factor)
    own = Window.partitionBy("_sid")
    # the heavier weights are at the cap; the first from which on none is
    best = F.max(F.when((F.col("_w") > 0) & (F.col("factor") * F.col("_w") <= float(cap)), F.struct("_w", "factor"))).over(own)["factor"]
    copies = F.when(F.col("_w") > 0, F.least(F.lit(float(cap)), F.coalesce(best * F.col("_w"), F.lit(float(cap))))).otherwise(0.0)
    found = placed.withColumn("copies", copies).withColumn("whole", F.floor("copies"))
    room = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(own)
    return found.select("_sid", "_w", "source_size", "target", "whole", (F.col("copies") - F.col("whole")).alias("chance"), room.cast("double").alias("room"))


def _mixed(docs: DataFrame, weights: Sequence[float], share: float, cap: float, seed: str, rounds: int, weight_col: str | None) -> DataFrame:
    """_row (the input's columns), size, source_size, target, copies."""
    rest = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    others = F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("long")
    words = word_count(F.col("text"))
    given = F.col(weight_col).cast("double") if weight_col else None
    weight = F.length(F.bin(words)).cast("double") if given is None else F.when(given > 0, F.pow(F.lit(2.0), F.floor(F.log2(given) * PARTS) / PARTS)).otherwise(0.0)
    sid = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    sized = docs.select(F.struct("*").alias("_row"), F.col("source").alias("_source"), sid.alias("_sid"), words.alias("size"), weight.alias("_w"), draw(seed).alias("_u"), others.alias("_rest"))
    slim = saved(sized.drop("_row"), "mix-sizes")
    repeated = saved(slim.groupBy("_u").count().where("count > 1").select("_u"), "mix-repeats")
    if not repeated.isEmpty():
        repeated = broadcast_if_small(repeated, MOST_REPEATED)
        sized, slim = set_apart(sized, repeated, seed), saved(set_apart(slim, repeated, seed), "mix-apart")

    targets = source_targets(slim, weights, share, cap).withColumn("_sid", F.coalesce(F.concat(F.lit("s"), F.col("_source").cast("string")), F.lit("n"))).drop("_source")
    levels = saved(expected_copies(slim.groupBy("_sid", "_w").agg(F.sum("size").alias("words")), targets, cap), "mix-levels")
    lookup = broadcast_if_small(levels.drop("room"), MOST_SOURCES)

    def ranked(df: DataFrame) -> DataFrame:
        """rank: the quotient of random and inclusion odds, q, as q / (1 + q) in BITS bits."""
        u = uniform(F.col("_u"))
        q = (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance")))
        return df.withColumn("rank", F.when(F.col("chance") > 0, F.floor(q / (1 + q) * float(1 << BITS))).otherwise(1 << (BITS + 1)).cast("long"))

    ranks = saved(ranked(slim.join(lookup, ["_sid", "_w"])).where((F.col("size") > 0) & (F.col("chance") > 0)).select("_sid", "rank", "size"), "mix-ranks")
    state = saved(levels.select("_sid", F.lit(0).cast("long").alias("lo"), "room").distinct(), "mix-round")
    for n in range(rounds):
        state = saved(_round(ranks, state, n), "mix-round")
    placed = ranked(sized.join(lookup, ["_sid", "_w"])).join(broadcast_if_small(state.drop("lo", "room"), MOST_SOURCES), "_sid")
    drawn = F.lit(False)
    for n in range(rounds):
        drawn = drawn | ((F.col("rank") >= F.col(f"lo{n}")) & (F.col("rank") < F.col(f"hi{n}")) & (F.col("size") <= F.col(f"max{n}")))
    copies = (F.col("whole") + F.when(drawn & (F.col("chance") > 0) & (F.col("size") > 0), 1).otherwise(0)).cast("long")
    return placed.select("_row", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix", rounds: int = 3, weight_col: str | None = None) -> DataFrame:
    """docs with size, source_size, target, copies and taken = copies * size."""
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ADDED]
    mixed = _mixed(docs, weights, share, cap, seed, rounds, weight_col)
    return mixed.select(*kept, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix", rounds: int = 3, weight_col: str | None = None) -> DataFrame:
    """The mix itself: each document as often as it is taken; columns as they came."""
    mixed = _mixed(docs, weights, share, cap, seed, rounds, weight_col)
    return mixed.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("_row.*")
