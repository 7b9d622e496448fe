"""Joins of many rows with a table of one row a key, where a few keys may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key that one task takes; keys with more are spread over several.
HOT = 1_000_000


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def hashable(df: DataFrame) -> list[str]:
    """The columns whose values tell df's rows apart in a hash."""
    return [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]


def join_spread(rows: DataFrame, table: DataFrame, on: Sequence[str], n: str, salt: Sequence[str], hot: int | None = None, counts: DataFrame | None = None, written: bool = False) -> DataFrame:
    """rows with the other columns of table, which has one row for each value of `on` (null is a value) and says how many rows have it (n).

    Keys of more than `hot` rows are split: their rows go to parts by a hash of the salt columns, and the table's
    row to each part, in the one pass over rows that the join takes anyway. Only these keys are broadcast; there
    are no more of them than the rows divided by hot. counts, with the columns `on` and n, tells them without what the rest of the
    table takes to make. written: counts are read from files, so that it is looked up first whether there are such keys at all.
    """
    hot = hot or HOT
    parts = F.greatest(F.ceil(F.col(n) / hot), F.lit(1)).cast("int")
    counted = table.withColumn("_parts", parts)
    names, heads = [f"_on_{c}" for c in on], [f"_hot_{c}" for c in on]
    few = (counted if counts is None else counts.withColumn("_parts", parts)).where("_parts > 1").select(*[F.col(c).alias(h) for c, h in zip(on, heads, strict=True)], F.col("_parts").alias("_share"))
    if written and few.isEmpty():
        plain = table.drop(n).withColumnsRenamed(dict(zip(on, names, strict=True)))
        return rows.join(plain, _same(on, names)).drop(*names)
    place = F.when(F.col("_share").isNotNull(), F.pmod(F.xxhash64(*salt), F.col("_share"))).otherwise(0).cast("int")
    placed = rows.join(F.broadcast(few), _same(on, heads), "left").withColumn("_salt", place).drop(*heads, "_share")
    dealt = counted.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop(n, "_parts").withColumnsRenamed(dict(zip(on, names, strict=True)))
    return placed.join(dealt, _same([*on, "_salt"], [*names, "_part"])).drop(*names, "_salt", "_part")
