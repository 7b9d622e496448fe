"""Classification by rules: tables of conditions joined to signatures, best tier and priority first."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proxylens import config
from proxylens.functions.codes import valid_code_format
from proxylens.operators.domains import suffixes_of
from proxylens.operators.taxonomy import JSON_COLUMNS, normalize_taxonomy

RULE = (
    "rule_id string, priority int, enabled boolean, service_name string, usage_type string, risk_level string, category string, rationale string, rule_version string, "
    "domain_suffixes array<string>, domain_exact array<string>, url_regex array<string>, path_prefix array<string>, url_signatures array<string>, "
    "fs_code string, im_code string, uc_codes array<string>, dt_codes array<string>, ch_codes array<string>, rs_codes array<string>, lg_codes array<string>, ob_codes array<string>"
)
LISTS = ("domain_suffixes", "domain_exact", "url_regex", "path_prefix", "url_signatures")
RISKS, USAGES = ("low", "medium", "high"), ("business", "genai", "devtools", "storage", "social", "unknown")
REQUIRED = ("FS", "IM", "UC", "DT", "CH", "RS", "LG")


def load_rules(spark: SparkSession, rules: Sequence[dict] | str) -> DataFrame:
    """Enabled rules in order, from dicts or the path of a JSON list; raises ValueError on a rule that is not well-formed."""
    if isinstance(rules, str):
        rules = json.loads(spark.read.text(rules, wholetext=True).first().value)
    rows, names = [], [c.split(" ")[0] for c in RULE.split(", ")]
    for rule in rules:
        match = rule.get("match", rule)
        if not rule.get("rule_id") or not any(match.get(k) for k in LISTS):
            raise ValueError(f"a rule needs an id and a condition: {rule}")
        if rule.get("risk_level", "low") not in RISKS or rule.get("usage_type", "unknown") not in USAGES:
            raise ValueError(f"unknown risk or usage: {rule}")
        flat = {**rule, **{k: match.get(k) or [] for k in LISTS}, **{k: rule.get(k) or rule.get("taxonomy_codes", {}).get(k) for k in names[14:]}}
        flat |= {"priority": int(rule.get("priority", 100)), "enabled": bool(rule.get("enabled", True))}
        rows.append(tuple(flat.get(n) for n in names))
    return spark.createDataFrame(rows, RULE).where("enabled").orderBy("priority", "rule_id")


def codes_complete():
    """Whether a row has one FS and IM code and at least one of UC, DT, CH, RS and LG."""
    ok = (F.coalesce("fs_code", F.lit("")) != "") & (F.coalesce("im_code", F.lit("")) != "")
    for c in ("uc", "dt", "ch", "rs", "lg"):
        ok = ok & (F.size(F.coalesce(f"{c}_codes", F.expr("cast(array() as array<string>)"))) > 0)
    return ok


def rule_candidates(sigs: DataFrame, rules: DataFrame) -> DataFrame:
    """url_signature, tier, reason and the rule's columns for every rule that fits."""
    rules = rules.withColumn("needs_taxonomy", ~codes_complete())
    kept = [c for c in rules.columns if c != "enabled"]
    exact = rules.select(F.explode("url_signatures").alias("url_signature"), *kept)
    tier1 = sigs.select("url_signature").join(exact, "url_signature").withColumn("tier", F.lit(1)).withColumn("match_reason", F.lit("signature_exact"))
    hosts = sigs.select("url_signature", "norm_host", "norm_path_template", F.explode(suffixes_of(F.col("norm_host"))).alias("key"))
    lookup = rules.select(F.explode("domain_exact").alias("key"), F.lit(True).alias("whole"), *kept).union(rules.select(F.explode("domain_suffixes").alias("key"), F.lit(False).alias("whole"), *kept))
    met = hosts.join(lookup, "key").where(~F.col("whole") | (F.col("key") == F.regexp_replace("norm_host", ":[0-9]+$", "")))
    template = F.lower("norm_path_template")
    by_path = F.exists("path_prefix", lambda p: template.startswith(F.lower(F.regexp_replace(p, "\\*$", ""))))
    by_regex = F.exists("url_regex", lambda r: F.regexp_like(F.concat("norm_host", "norm_path_template"), F.concat(F.lit("(?i)"), r)))
    has_path, has_regex = F.size("path_prefix") > 0, F.size("url_regex") > 0
    reason = F.when(has_path & by_path, F.when(F.col("whole"), "host+path_exact").otherwise("host+path_suffix")).when(~has_path & has_regex & by_regex, "host+path_regex").when(~has_path & ~has_regex, F.when(F.col("whole"), "host_exact").otherwise("host_suffix"))
    rest = met.withColumn("match_reason", reason).where(F.col("match_reason").isNotNull()).withColumn("tier", F.when(F.col("match_reason").startswith("host+"), 2).otherwise(3))
    columns = ["url_signature", "tier", "match_reason", *kept]
    return tier1.select(*columns).union(rest.select(*columns))


def match_rules(sigs: DataFrame, rules: DataFrame, strict: bool = False) -> DataFrame:
    """The best rule of each signature that has any: lowest tier, then priority, then rule id. strict: only rules with complete codes."""
    found = rule_candidates(sigs, rules)
    if strict:
        found = found.where(~F.col("needs_taxonomy"))
    columns = [c for c in found.columns if c not in ("url_signature", *LISTS)]
    best = found.groupBy("url_signature").agg(F.min_by(F.struct(*columns), F.struct("tier", "priority", "rule_id")).alias("r"))
    return best.select("url_signature", "r.*")


def classify(sigs: DataFrame, rules: DataFrame, strict: bool = False) -> DataFrame:
    """Every signature with its rule's class or the default one."""
    matched = match_rules(sigs, rules, strict).select("url_signature", "rule_id", "match_reason", "tier", "service_name", "usage_type", "risk_level", "category", "needs_taxonomy")
    joined = sigs.join(matched, "url_signature", "left")
    out = joined.withColumn("classification_source", F.when(F.col("rule_id").isNotNull(), "RULE")).withColumn("confidence", F.when(F.col("rule_id").isNotNull(), 1.0).otherwise(0.0))
    for column, default in (("service_name", "Unknown"), ("usage_type", "unknown"), ("risk_level", "medium"), ("category", "Unknown")):
        out = out.withColumn(column, F.coalesce(column, F.lit(default)))
    return out


def rules_to_migrate(rules: DataFrame) -> DataFrame:
    """The rules that lack codes, with the dimensions that are missing."""
    gaps = F.array_compact(F.array(*[F.when(F.coalesce(F.col(f"{d.lower()}_code"), F.lit("")) == "", d) if d in ("FS", "IM") else F.when(F.size(F.coalesce(f"{d.lower()}_codes", F.expr("cast(array() as array<string>)"))) == 0, d) for d in REQUIRED]))
    return rules.select("rule_id", gaps.alias("missing")).where(F.size("missing") > 0)


def rule_coverage(stats: DataFrame, cache: DataFrame, matched: DataFrame) -> DataFrame:
    """One row: signatures, hits by rules (new and cached) and the rest."""
    cached = cache.where("status = 'active' and classification_source = 'RULE'").select("url_signature", F.lit(True).alias("cached"))
    new = matched.select("url_signature", F.lit(True).alias("new"))
    both = stats.select("url_signature").distinct().join(cached, "url_signature", "left").join(new, "url_signature", "left")
    hit = F.coalesce("cached", F.lit(False)) | F.coalesce("new", F.lit(False))
    return both.agg(F.count("*").alias("signatures"), F.count_if(hit).alias("rule_hit"), F.count_if(F.coalesce("new", F.lit(False)) & F.col("cached").isNull()).alias("new_hits"), F.count_if(~hit).alias("unknown"))


def apply_confidence_policy(df: DataFrame, min_conf: float = 0.7) -> DataFrame:
    """Usage below the confidence is unknown."""
    return df.withColumn("usage_type", F.when(F.coalesce("confidence", F.lit(0.0)) < min_conf, "unknown").otherwise(F.col("usage_type")))


def apply_overrides(df: DataFrame, entries: Sequence[dict] | DataFrame) -> DataFrame:
    """Allow and block lists: entries with domain_suffix or domain_exact, risk and usage; the longest domain wins, block over allow.

    As a DataFrame, entries has the columns key, whole (domain_exact), o_risk, o_usage, block.
    """
    if not isinstance(entries, DataFrame):
        rows = [(e.get("domain_suffix") or e["domain_exact"], "domain_exact" in e, e.get("risk"), e.get("usage"), bool(e.get("block"))) for e in entries]
        entries = df.sparkSession.createDataFrame(rows, "key string, whole boolean, o_risk string, o_usage string, block boolean")
    hosts = df.select("norm_host").distinct().select("norm_host", F.explode(suffixes_of(F.col("norm_host"))).alias("key"))
    best = hosts.join(entries, "key").where(~F.col("whole") | (F.col("key") == F.col("norm_host"))).groupBy("norm_host").agg(F.max_by(F.struct("o_risk", "o_usage"), F.struct("block", F.length("key"))).alias("o"))
    joined = df.join(best, "norm_host", "left")
    return joined.withColumn("risk_level", F.coalesce("o.o_risk", "risk_level")).withColumn("usage_type", F.coalesce("o.o_usage", "usage_type")).withColumn("overridden", F.col("o").isNotNull()).drop("o")


def _of(dimension: str):
    return lambda code: valid_code_format(code, dimension)


def from_old_codes(df: DataFrame) -> DataFrame:
    """df with the code columns of all eight dimensions, taken from the old columns where they are not there or empty."""
    json_of = {c: F.to_json(F.coalesce(F.col(f"{d.lower()}_codes"), F.expr("cast(array() as array<string>)"))) for d, c in JSON_COLUMNS.items() if f"{d.lower()}_codes" in df.columns}
    seen = normalize_taxonomy(df.withColumns(json_of))
    out = df.drop("fs_code", "im_code", *[f"{d.lower()}_codes" for d in JSON_COLUMNS])
    keep = [F.col(c) for c in out.columns]
    codes = [F.try_element_at(d, F.lit(1)).alias(f"{d}_code") for d in ("fs", "im")] + [F.col(d.lower()).alias(f"{d.lower()}_codes") for d in JSON_COLUMNS]
    return seen.select(*keep, *codes)


def classification_faults(df: DataFrame) -> DataFrame:
    """df with the names of the fields that do not conform."""
    tests = {
        "usage_type": F.col("usage_type").isin(list(USAGES)),
        "risk_level": F.col("risk_level").isin(list(RISKS)),
        "service_name": F.length("service_name").between(1, 100),
        "category": F.length("category") <= 50,
        "rationale": F.length("rationale") <= 400,
        "confidence": F.col("confidence").between(0, 1),
    }
    for d in config.DIMENSIONS:
        name = f"{d.lower()}_code" if d in ("FS", "IM") else f"{d.lower()}_codes"
        if name in df.columns:
            tests[name] = valid_code_format(F.col(name), d) if d in ("FS", "IM") else F.forall(name, _of(d))
    return df.withColumn("faults", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in tests.items() if name in df.columns])))


def ingest_model_results(df: DataFrame, fallbacks: DataFrame) -> DataFrame:
    """Outside classifications: old codes in the form of eight dimensions, missing ones filled from the fallbacks, faults sent to review."""
    codes = {r.dimension: r.code for r in fallbacks.collect()}  # eight rows
    out = from_old_codes(df)
    for d in config.DIMENSIONS:
        name = f"{d.lower()}_code" if d in ("FS", "IM") else f"{d.lower()}_codes"
        default = F.lit(codes.get(d, f"{d}-099"))
        if name in ("fs_code", "im_code"):
            out = out.withColumn(name, F.coalesce(F.nullif(F.trim(name), F.lit("")), default))
        elif d != "OB":
            out = out.withColumn(name, F.when(F.size(F.coalesce(name, F.expr("cast(array() as array<string>)"))) > 0, F.col(name)).otherwise(F.array(default)))
    checked = classification_faults(out)
    return checked.withColumn("status", F.when(F.size("faults") == 0, "active").otherwise("needs_review"))
