"""URL normalisation, redaction audit, and signatures: tables in, tables out, JVM expressions only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxylens import config
from proxylens.functions.fields import bytes_bucket, method_group
from proxylens.operators.domains import registrable_domain
from proxylens.operators.skew import hashable, join_spread
from proxylens.sources.scratch import saved


def decoded(part: Column) -> Column:
    """Percent-decoded; stray percent signs stay."""
    return F.try_url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def recoded(path: Column) -> Column:
    """Percent escapes in one form: everything but unreserved characters and slashes."""
    out = F.url_encode(decoded(F.replace(path, F.lit("+"), F.lit("%2B"))))
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.coalesce(out, path)


def query_pairs(query: Column, keep: Sequence[str] = ()) -> Column:
    """array<struct<k, pos, v>> of a query, sorted by key, without blank values and tracking keys."""
    pieces = F.filter(F.split(query, "&"), lambda p: p.contains("="))
    pairs = F.transform(pieces, lambda p, i: F.struct(decoded(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"), i.alias("pos"), decoded(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))

    def kept(p: Column) -> Column:
        ok = (p["v"] != "") & ~p["k"].isin(config.DROP_KEYS)
        for prefix in config.DROP_PREFIXES:
            ok = ok & ~p["k"].startswith(prefix)
        return ok & p["k"].isin(list(keep)) if keep else ok

    return F.array_sort(F.filter(pairs, kept))


def redact(text: Column, field: str) -> tuple[Column, Column]:
    """text with each rule's matches replaced in turn, and array<struct<field, pii_type, redacted_token>> of the rules that hit."""
    hits = []
    for name, pattern, token in config.REDACTIONS:
        hits.append(F.when(text.rlike(pattern), F.struct(F.lit(field).alias("field_source"), F.lit(name).alias("pii_type"), F.lit(token).alias("redacted_token"))))
        text = F.regexp_replace(text, pattern, token)
    return text, F.array_compact(F.array(*hits))


def punycode_hosts(df: DataFrame, host_col: str) -> DataFrame:
    """df with non-ASCII hosts in their ASCII form. Only the distinct non-ASCII hosts leave the JVM."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ascii_form(host: str) -> str:
            try:
                return host.encode("idna").decode()
            except UnicodeError:
                return host

        for pdf in batches:
            yield pdf.assign(_ascii=pdf["_host"].map(ascii_form))

    odd = df.select(F.col(host_col).alias("_host")).where(F.col("_host").rlike(r"[^\x00-\x7F]")).distinct()
    named = odd.mapInPandas(encode, "_host string, _ascii string")
    return df.join(named, df[host_col] == named["_host"], "left").withColumn(host_col, F.coalesce("_ascii", host_col)).drop("_host", "_ascii")


def normalize_urls(df: DataFrame, url_col: str = "url_full", keep_keys: Sequence[str] = (), idn: bool = True, hot: int | None = None) -> DataFrame:
    """df with the columns of normalized_urls; each distinct url is normalised once and written, and rows of a hot url are spread by what they hold."""
    urls = saved(df.groupBy(url_col).agg(F.count("*").alias("_url_rows")), "urls")
    return join_spread(df, saved(normalized_urls(urls, url_col, keep_keys, idn), "normal-urls"), [url_col], "_url_rows", hashable(df), hot, urls, written=True)


def normalized_urls(df: DataFrame, url_col: str, keep_keys: Sequence[str] = (), idn: bool = True) -> DataFrame:
    """df with norm_host, norm_path, norm_query, norm_url, pii_hits, original_path, original_query.

    pii_hits holds every redaction rule that hit path or query and sensitive parameters; an e-mail
    address in a path is found in its decoded form too.
    """
    bare = F.regexp_replace(F.trim(F.col(url_col)), "(?i)^https?://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?#]*)", 1)), ":80$", ""), ":443$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, "^[^/?#]*([^?#]*)", 1), ";[^/]*$", ""), "/+", "/")
    path = F.when(path == "/", path).otherwise(F.regexp_replace(path, "/$", ""))
    path = F.when(path.rlike("[^A-Za-z0-9/._~-]"), recoded(path)).otherwise(path)
    query = F.regexp_extract(bare, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.array_join(F.transform(query_pairs(query, keep_keys), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    split = df.withColumn("norm_host", host).withColumn("original_path", path).withColumn("original_query", F.when(query == "", "").otherwise(pairs))
    if idn:
        split = punycode_hosts(split, "norm_host")
    email = config.REDACTIONS[3]
    with_mail = F.when(F.col("original_path").contains("%40"), F.regexp_replace(F.replace("original_path", F.lit("%40"), F.lit("@")), email[1], email[2])).otherwise(F.col("original_path"))
    mailed = F.when(with_mail != F.col("original_path"), F.struct(F.lit("path").alias("field_source"), F.lit("email").alias("pii_type"), F.lit(":email").alias("redacted_token")))
    clean_path, path_hits = redact(with_mail, "path")
    clean_query, query_hits = redact(F.col("original_query"), "query")
    out = split.withColumn("norm_path", clean_path).withColumn("norm_query", clean_query)
    sensitive = F.when(F.col("norm_path").rlike(config.SENSITIVE) | F.col("norm_query").rlike(config.SENSITIVE), F.struct(F.lit("path_or_query").alias("field_source"), F.lit("sensitive_param").alias("pii_type"), F.lit("").alias("redacted_token")))
    hits = F.array_distinct(F.concat(F.array_compact(F.array(mailed)), path_hits, query_hits, F.array_compact(F.array(sensitive))))
    return out.withColumn("pii_hits", hits).withColumn("norm_url", F.concat("norm_host", "norm_path", F.when(F.col("norm_query") != "", F.concat(F.lit("?"), "norm_query")).otherwise("")))


def pii_audit(df: DataFrame, run_id: str) -> DataFrame:
    """One row per signature, kind of hit and original value, with its count."""
    # events of one signature and url are counted before their hits are taken apart and hashed
    per = df.where(F.size("pii_hits") > 0).groupBy("url_signature", "original_path", "original_query", "pii_hits").agg(F.count("*").alias("_events"))
    hit = per.select("url_signature", "original_path", "original_query", "_events", F.explode("pii_hits").alias("h"))
    original = F.when(F.col("h.field_source") == "path", F.col("original_path")).otherwise(F.col("original_query"))
    keyed = hit.select("url_signature", "h.*", F.sha2(original, 256).alias("original_hash"), "_events")
    return keyed.groupBy("url_signature", "field_source", "pii_type", "redacted_token", "original_hash").agg(F.sum("_events").alias("occurrence_count")).withColumn("run_id", F.lit(run_id))


def url_parts(df: DataFrame, key_params: Sequence[str] = ()) -> DataFrame:
    """df (with norm_path, norm_query) with what a signature takes from the url alone."""
    count = F.when(F.col("norm_query") == "", 0).otherwise(F.size(F.split("norm_query", "&")))
    subset = F.array_join(F.array_sort(F.filter(F.split("norm_query", "&"), lambda p: F.substring_index(p, "=", 1).isin(list(key_params)))), "&") if key_params else F.lit("")
    out = df.withColumn("param_count", count).withColumn("norm_path_template", F.when(count > 0, F.concat("norm_path", F.lit("?p="), count)).otherwise(F.col("norm_path")))
    out = out.withColumn("path_depth", F.size(F.array_remove(F.split("norm_path", "/"), "")))
    return out.withColumn("key_param_subset", subset).withColumn("has_auth_token_like", F.col("norm_query").rlike(config.AUTH_WORDS))


def event_parts(df: DataFrame, version: str = config.SIGNATURE_VERSION) -> DataFrame:
    """df (with url_parts, http_method, bytes_sent) with method group, bytes bucket and url_signature."""
    out = df.withColumn("method_group", method_group(F.col("http_method"))).withColumn("bytes_bucket", bytes_bucket(F.col("bytes_sent")))
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("norm_host", "norm_path_template", "key_param_subset", "method_group", "bytes_bucket")]
    return out.withColumn("url_signature", F.sha2(F.concat_ws("|", *parts, F.lit(version)), 256))


def add_signature(df: DataFrame, version: str = config.SIGNATURE_VERSION, key_params: Sequence[str] = ()) -> DataFrame:
    """df (with norm_* columns, http_method, bytes_sent) with the parts of the signature and url_signature."""
    return event_parts(url_parts(df, key_params), version)


def url_dictionary(urls: DataFrame, suffixes: DataFrame, url_col: str = "url_full", keep_keys: Sequence[str] = (), key_params: Sequence[str] = ()) -> DataFrame:
    """urls, a row for each, with their normal form, domain and part of the signature."""
    return registrable_domain(url_parts(normalized_urls(urls, url_col, keep_keys), key_params), "norm_host", suffixes)


def sign_events(df: DataFrame, suffixes: DataFrame, url_col: str = "url_full", keep_keys: Sequence[str] = (), key_params: Sequence[str] = (), version: str = config.SIGNATURE_VERSION) -> DataFrame:
    """df with normal urls, dest_domain and url_signature: one dictionary of the distinct urls, written and joined back once; rows of a hot url are spread by lineage."""
    urls = saved(df.groupBy(url_col).agg(F.count("*").alias("url_rows")), "urls")
    known = saved(url_dictionary(urls, suffixes, url_col, keep_keys, key_params), "url-dictionary")
    return event_parts(join_spread(df, known, [url_col], "url_rows", ["ingest_lineage_hash"], counts=urls, written=True), version)


def signature_groups(df: DataFrame) -> DataFrame:
    """Events of each signature."""
    return df.groupBy("url_signature").agg(F.count("*").alias("events"))
