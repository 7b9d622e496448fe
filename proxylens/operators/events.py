"""Raw vendor rows to canonical events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proxylens import config, schemas
from proxylens.functions import fields as f
from proxylens.operators.domains import registrable_domain, suffix_table

REQUIRED = ("event_time", "user_id", "dest_host")
#: Why a row is rejected that its reader could not parse (a row with `_error`).
BROKEN = "parse error"
#: Rows that repeat are dealt out again in blocks of this many.
BLOCK = 4096


def lineage_hash(df: DataFrame, columns: list[str], file_col: str) -> DataFrame:
    """df with ingest_lineage_hash of file, sorted items and the ordinal among equal rows of the file: unique and the same on every run. No group of equal rows is one task's."""
    items = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))) for c in sorted(columns)]
    text = F.concat_ws("\x1f", F.col(file_col), *items)
    # rows that are equal in all columns are counted before they are shuffled, and dealt out by blocks of their numbers;
    # shuffles carry a short key of the content, which is hashed in full behind them
    every = [f"`{c}`" for c in df.columns]
    counted = df.groupBy(*every).agg(F.count("*").alias("_rows")).withColumn("_key", F.xxhash64(text))

    def placed(rows: DataFrame) -> DataFrame:
        # those that are dealt out come first, so that their numbers are the same without the others
        order = Window.partitionBy("_key", "_content").orderBy(F.col("_rows") <= BLOCK, *every)
        before = F.coalesce(F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        met = rows.repartition("_key").withColumn("_content", F.sha2(text, 256))
        return met.withColumn("_first", before + 1).withColumn("_last", F.col("_first") + F.col("_rows") - 1)

    few = placed(counted).where(F.col("_rows") <= BLOCK).withColumn("_n", F.explode(F.sequence("_first", "_last")))
    blocks = placed(counted.where(F.col("_rows") > BLOCK)).withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(BLOCK).cast("long"))))
    many = blocks.repartition("_content", "_from").withColumn("_n", F.explode(F.sequence("_from", F.least("_last", F.col("_from") + BLOCK - 1)))).drop("_from")
    numbered = few.unionByName(many).drop("_rows", "_key", "_first", "_last")
    return numbered.select(*every, F.sha2(F.concat_ws("|", "_content", "_n"), 256).alias("ingest_lineage_hash"))


def to_canonical(raw: DataFrame, vendor: str, mapping: dict | None = None, suffixes: DataFrame | None = None, compat: bool = False, only: Sequence[str] | None = None) -> DataFrame:
    """The 24 canonical columns and reject_reason, from string columns as read, an `_file` column, and `_error` of rows that could not be parsed.

    only: the canonical columns that are wanted; lineages and domains take shuffles and are made if they are among them.
    """
    m = mapping or config.VENDORS[vendor]
    present = [c for c in raw.columns if c not in ("_file", "_error")]
    wanted = [c for c in schemas.COLUMNS if only is None or c in only]
    rows = raw if "_file" in raw.columns else raw.withColumn("_file", F.lit(""))
    source = lineage_hash(rows, present, "_file") if "ingest_lineage_hash" in wanted else rows.withColumn("ingest_lineage_hash", F.lit(None).cast("string"))
    pick = lambda field: f.named(m.get(field, []), present)
    url = f.first_nonblank(pick("url"))
    # what takes parsing comes out of an array of one, so that no filter on it is pushed below and parses it again
    parsed = F.struct(f.parse_event_time(m["time"], present, m["tz"]).alias("event_time"), f.extract_host(url, compat).alias("dest_host"))
    rest = source.select(
        F.lit(vendor).alias("vendor"),
        F.lit(m["log_type"]).alias("log_type"),
        f.first_nonblank(pick("user")).alias("user_id"),
        f.first_nonblank(f.named(["user_dept", "department", "dept"], present)).alias("user_dept"),
        f.first_nonblank(pick("device")).alias("device_id"),
        f.first_nonblank(pick("src_ip")).alias("src_ip"),
        url.alias("url_full"),
        f.url_path(url).alias("url_path"),
        f.url_query(url).alias("url_query"),
        F.upper(f.first_nonblank(pick("method"))).alias("http_method"),
        f.status_code(pick("status")).alias("status_code"),
        f.map_action(pick("action"), m["allow"], m["block"]).alias("action"),
        f.first_nonblank(pick("app")).alias("app_name"),
        f.first_nonblank(pick("category")).alias("app_category"),
        f.first_nonblank(f.named(["content_type", "content-type"], present)).alias("content_type"),
        f.first_nonblank(pick("user_agent")).alias("user_agent"),
        f.nonneg_long(pick("sent")).alias("bytes_sent"),
        f.nonneg_long(pick("received")).alias("bytes_received"),
        f.first_nonblank(f.named(["event_id", "raw_event_id", "id"], present)).alias("raw_event_id"),
        F.col("_file").alias("ingest_file"),
        "ingest_lineage_hash",
        (F.col("_error").isNotNull() if "_error" in raw.columns else F.lit(False)).alias("_broken"),
        F.inline(F.array(parsed)),
    )
    out = rest.select(*[c for c in schemas.COLUMNS if c != "dest_domain"], "_broken")
    if "dest_domain" in wanted:
        # hosts are counted in the rows as they come, before they are numbered
        seen = raw.select(f.extract_host(url, compat).alias("dest_host"))
        # a lineage is a row's own, so that no other column has to be hashed to spread rows
        salt = ["ingest_lineage_hash"] if "ingest_lineage_hash" in wanted else None
        out = registrable_domain(out, "dest_host", suffixes if suffixes is not None else suffix_table(raw.sparkSession), seen=seen, salt=salt)
    reason = F.coalesce(F.when(F.col("_broken"), F.lit(BROKEN)), *[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in REQUIRED])
    return out.select(*wanted, reason.alias("reject_reason"))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that have time, user and host, and the others with the reason."""
    return df.where("reject_reason is null").drop("reject_reason"), df.where("reject_reason is not null")


def required_field_gaps(df: DataFrame) -> DataFrame:
    """One row: null or blank values of each field that detection needs."""
    return df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(c) for c in ("event_time", "user_id", "dest_domain", "bytes_sent", "http_method", "action")])
