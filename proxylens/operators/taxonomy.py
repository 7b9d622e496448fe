"""Taxonomy records: old and new forms, the code dictionary, and its checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxylens import config
from proxylens.functions.codes import CODE, canonical_array, canonical_codes, parse_codes

#: Array dimensions with their JSON column, and the old column of every dimension.
JSON_COLUMNS = {"UC": "uc_codes_json", "DT": "dt_codes_json", "CH": "ch_codes_json", "RS": "rs_codes_json", "LG": "ev_codes_json", "OB": "ob_codes_json"}
LEGACY = {"FS": "fs_uc_code", "UC": "fs_uc_code", "DT": "dt_code", "CH": "ch_code", "RS": "rs_code", "LG": "ev_code", "OB": "ob_code"}


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _given(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def normalize_taxonomy(df: DataFrame, version: str = "0.1.1") -> DataFrame:
    """df with one array column of codes per dimension (fs … ob), missing, source_format, needs_review.

    New columns win over old ones. A record of which any dimension comes from its old column is `legacy` and
    goes to review, as does one that lacks codes of a required dimension.
    """
    nothing = F.expr("cast(array() as array<string>)")
    new = {"FS": F.array_compact(F.array(_given(_column(df, "fs_code")))), "IM": F.array_compact(F.array(_given(_column(df, "im_code"))))}
    for d, c in JSON_COLUMNS.items():
        new[d] = parse_codes(_column(df, c))
    out, fell_back = df, F.lit(False)
    for d in config.DIMENSIONS:
        old = F.array_compact(F.array(_given(_column(df, LEGACY[d])))) if d in LEGACY else nothing
        old = F.filter(old, _starts(d)) if d in ("FS", "UC") else old
        out = out.withColumn(d.lower(), F.when(F.size(new[d]) > 0, new[d]).otherwise(old))
        fell_back = fell_back | ((F.size(new[d]) == 0) & (F.size(old) > 0))
    missing = F.array_compact(F.array(*[F.when(F.size(d.lower()) < least, d) for d, (least, _) in config.DIMENSIONS.items()]))
    out = out.withColumn("missing", missing).withColumn("source_format", F.when(fell_back, "legacy").otherwise("new"))
    return out.withColumn("needs_review", (F.col("source_format") == "legacy") | (F.size("missing") > 0)).withColumn("taxonomy_schema_version", F.coalesce(_given(_column(df, "taxonomy_schema_version")), _given(_column(df, "taxonomy_version")), F.lit(version)))


def _starts(dimension: str):
    return lambda c: c.startswith(f"{dimension}-")


def migration_status(df: DataFrame) -> DataFrame:
    """df with has_new, legacy_only, missing, needs_migration: what the columns as stored hold in the new form and in the old one."""
    some = lambda c: F.coalesce(F.col(c) != "", F.lit(False)) if c in df.columns else F.lit(False)
    new = {"FS": some("fs_code"), "IM": some("im_code")} | {d: F.size(parse_codes(_column(df, c))) > 0 for d, c in JSON_COLUMNS.items() if d != "OB"}
    old = {d: some(c) for d, c in LEGACY.items() if d not in ("UC", "OB")}
    old["FS"] = old["FS"] & F.coalesce(_column(df, "fs_uc_code") != "DEPRECATED", F.lit(False))
    any_of = lambda parts: reduce(lambda a, b: a | b, parts)
    missing = F.array_compact(F.array(*[F.when(~(new[d] | old.get(d, F.lit(False))), d) for d in ("FS", "IM", "UC", "DT", "CH", "RS", "LG")]))
    out = df.withColumn("has_new", any_of(new.values())).withColumn("legacy_only", any_of(old.values()) & ~any_of(new.values())).withColumn("missing", missing)
    return out.withColumn("needs_migration", F.col("legacy_only") | (F.size("missing") > 0))


def to_legacy_codes(df: DataFrame) -> DataFrame:
    """The first code of each dimension in the old columns."""
    for d, c in LEGACY.items():
        if d != "UC":
            df = df.withColumn(c, F.try_element_at(d.lower(), F.lit(1)))
    return df


def to_record(df: DataFrame) -> DataFrame:
    """The stored form: codes as canonical JSON beside old columns marked DEPRECATED."""
    out = df.withColumn("fs_code", F.try_element_at("fs", F.lit(1))).withColumn("im_code", F.try_element_at("im", F.lit(1)))
    for d, c in JSON_COLUMNS.items():
        out = out.withColumn(c, canonical_codes(F.col(d.lower())))
    return out.withColumn("fs_uc_code", F.lit("DEPRECATED"))


def pack_codes(df: DataFrame) -> DataFrame:
    """df with map<dimension, codes>."""
    pairs = [x for d in config.DIMENSIONS for x in (F.lit(d), F.col(d.lower()))]
    return df.withColumn("codes", F.create_map(*pairs))


def unpack_codes(df: DataFrame) -> DataFrame:
    for d in config.DIMENSIONS:
        df = df.withColumn(d.lower(), canonical_array(F.try_element_at("codes", F.lit(d))))
    return df


def load_dictionary(spark: SparkSession, source: DataFrame | str | None = None) -> DataFrame:
    """code, dimension, label: active codes, EV renamed to LG, defaults for dimensions without codes."""
    rows = spark.read.csv(source, header=True) if isinstance(source, str) else source
    defaults = [(f"LG-{i:03d}", "LG") for i in range(1, 16)] + [(f"{d}-{n}", d) for d in config.DIMENSIONS if d != "LG" for n in ("001", "099")]
    spare = spark.createDataFrame([(c, d, c) for c, d in defaults], "code string, dimension string, label string")
    if rows is None:
        return spare
    active = rows.where("status = 'active'")
    is_ev = F.col("dimension") == "EV"
    kept = active.select(F.when(is_ev, F.regexp_replace("code", "^EV-", "LG-")).otherwise(F.col("code")).alias("code"), F.when(is_ev, "LG").otherwise(F.col("dimension")).alias("dimension"), "label")
    return kept.unionByName(spare.join(kept.select("dimension").distinct(), "dimension", "left_anti").select("code", "dimension", "label"))


def fallback_codes(dictionary: DataFrame) -> DataFrame:
    """dimension, code: the code whose label says unknown, else other, else -099, else the last, else a static one."""
    label = F.lower("label")
    rank = F.when(label.contains("unknown"), 0).when(label.contains("other"), 1).when(F.col("code").endswith("-099"), 2).otherwise(3)
    number = F.substring_index("code", "-", -1).try_cast("int")
    best = dictionary.groupBy("dimension").agg(F.min_by("code", F.struct(rank, F.when(rank == 3, -number).otherwise(number), F.col("code"))).alias("code"))
    every = dictionary.sparkSession.createDataFrame([(d,) for d in config.DIMENSIONS], "dimension string")
    return every.join(best, "dimension", "left").select("dimension", F.coalesce("code", F.concat("dimension", F.lit("-099"))).alias("code"))


def dictionary_stats(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("dimension").agg(F.count("*").alias("codes"), F.array_sort(F.collect_list("code")).alias("allowed"))


def validate_assignment(df: DataFrame, dictionary: DataFrame, key: str) -> DataFrame:
    """key, errors (sorted array): wrong numbers of codes, unknown codes, codes of another dimension."""
    sizes = []
    for d, (least, most) in config.DIMENSIONS.items():
        n = F.size(F.coalesce(d.lower(), F.expr("cast(array() as array<string>)")))
        sizes.append(F.when(n < least, F.lit(f"{d}: too few codes")))
        if most:
            sizes.append(F.when(n > most, F.lit(f"{d}: too many codes")))
    by_size = df.select(key, F.explode(F.array_compact(F.array(*sizes))).alias("error"))
    pairs = F.array(*[F.struct(F.lit(d).alias("own"), F.col(d.lower()).alias("codes")) for d in config.DIMENSIONS])
    each = df.select(key, F.explode(pairs).alias("p")).select(key, "p.own", F.explode("p.codes").alias("code"))
    known = dictionary.select("code", F.col("dimension").alias("of"))
    joined = each.join(known, "code", "left")
    error = F.when(~F.coalesce(F.col("code").rlike(CODE), F.lit(False)), F.concat("own", F.lit(": bad form "), "code")).when(F.col("of").isNull(), F.concat("own", F.lit(": unknown code "), "code")).when(F.col("of") != F.col("own"), F.concat("own", F.lit(": foreign code "), "code"))
    found = by_size.union(joined.select(key, error.alias("error")).where(F.col("error").isNotNull())).groupBy(key).agg(F.array_sort(F.collect_set("error")).alias("errors"))
    return df.select(key).join(found, key, "left").select(key, F.coalesce("errors", F.expr("cast(array() as array<string>)")).alias("errors"))
