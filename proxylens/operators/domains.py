"""Host suffixes: every suffix match is an equi-join on exploded suffixes, never a nested loop.

Lookup tables carry no broadcast hint: Catalyst broadcasts them by their size in bytes, or shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxylens import config
from proxylens.operators.skew import hashable, join_spread
from proxylens.sources.scratch import saved


def suffixes_of(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c], without port."""
    labels = F.split(F.regexp_replace(host, ":[0-9]+$", ""), "\\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def suffix_table(spark: SparkSession, suffixes: Sequence[str] = config.SUFFIXES, path: str | None = None) -> DataFrame:
    """suffix, kind (plain, wildcard, exception) from a list, or from a file in the public list's form."""
    raw = spark.read.text(path).select(F.trim("value").alias("value")).where("value != '' and value not like '//%'") if path else spark.createDataFrame([(s,) for s in suffixes], "value string")
    kind = F.when(F.col("value").startswith("!"), "exception").when(F.col("value").startswith("*."), "wildcard").otherwise("plain")
    return raw.select(F.regexp_replace("value", "^(!|\\*\\.)", "").alias("suffix"), kind.alias("kind")).distinct()


def registrable_domain(df: DataFrame, host_col: str, suffixes: DataFrame, out: str = "dest_domain", hot: int | None = None, seen: DataFrame | None = None, salt: Sequence[str] | None = None) -> DataFrame:
    """df with the label before the longest public suffix and that suffix; the host where none fits.

    Works on distinct hosts, each with its suffixes as keys of an equi-join; rows of a hot host are spread by
    what they hold when they are joined back. The hosts and their domains are written once, so that df is not made
    again for each use of them and a small table of them is broadcast. seen: a frame with the same host column and
    as many rows of each host, if it takes less to make than df. salt: the columns that tell rows of a hot host apart, if not all.
    """
    counted = (df if seen is None else seen).groupBy(F.col(host_col).alias("_host")).agg(F.count("*").alias("_host_rows"))
    hosts = saved(counted, "hosts")
    parts = hosts.where(F.col("_host").isNotNull()).select("_host", F.size(F.split("_host", "\\.")).alias("n"), F.posexplode(suffixes_of(F.col("_host"))).alias("pos", "suffix"))
    found = parts.join(suffixes, "suffix")
    # labels that belong to the public suffix, from the right
    size = F.col("n") - F.col("pos") + F.when(F.col("kind") == "wildcard", 1).when(F.col("kind") == "exception", -1).otherwise(0)
    best = found.groupBy("_host", "n").agg(F.max_by(size, F.struct(F.col("kind") == "exception", size)).alias("size"))
    labels = F.split(F.regexp_replace("_host", ":[0-9]+$", ""), "\\.")
    name = F.when(F.col("n") > F.col("size"), F.array_join(F.slice(labels, F.col("n") - F.col("size"), F.col("size") + 1), ".")).otherwise(F.col("_host"))
    named = hosts.join(best.select("_host", name.alias("_domain")), "_host", "left").select(F.col("_host").alias(host_col), "_host_rows", F.coalesce("_domain", "_host").alias(out))
    rows = df.drop(out)
    return join_spread(rows, saved(named, "domains"), [host_col], "_host_rows", salt or hashable(rows), hot, hosts.withColumnRenamed("_host", host_col), written=True)
