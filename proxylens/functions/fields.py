"""Column builders for fields of raw log rows. Null and blank values count as missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxylens import config

TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "dd/MMM/yyyy:HH:mm:ss Z", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")
#: The scheme that a url may begin with, as a pattern.
SCHEME = "(?:[A-Za-z][A-Za-z0-9+.-]*://)?"


def named(columns: Sequence[str], present: Sequence[str]) -> list[Column]:
    """The columns of a candidate list that there are."""
    return [F.col(f"`{c}`") for c in columns if c in present]


def first_nonblank(columns: Sequence[Column]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns]) if columns else F.lit(None).cast("string")


def instant(text: Column, tz: str = "UTC") -> Column:
    """A timestamp from ISO text with or without zone, common local forms, or epoch seconds or milliseconds."""
    text = F.trim(text.cast("string"))
    # the plainest form first: no text has this form and another
    plain = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(TIME_FORMATS[0])), tz))
    zoned = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ].*(Z|[+-]\d{2}:?\d{2})$"), text.try_cast("timestamp"))
    local = F.coalesce(*[F.try_to_timestamp(F.regexp_replace(text, r"(?<=:\d{2})\.\d+$", ""), F.lit(f)) for f in TIME_FORMATS])
    number = text.try_cast("double")
    epoch = F.when(text.rlike(r"^\d{9,14}(\.\d+)?$"), F.timestamp_millis((number * F.when(number >= 1e11, 1).otherwise(1000)).cast("long")))
    return F.when(text != "", F.coalesce(plain, zoned, epoch, F.to_utc_timestamp(local, tz)))


def parse_event_time(candidates: Sequence[str], present: Sequence[str], tz: str = "UTC") -> Column:
    """The first candidate that holds a date; a `date` and a `time` column together are one instant, a time alone is none."""
    tries = []
    if {"date", "time"} <= {*candidates} & {*present}:
        tries.append(instant(F.concat_ws(" ", F.trim("date"), F.trim("time")), tz))
    tries += [instant(c, tz) for c in named(candidates, present)]
    return F.coalesce(*tries) if tries else F.lit(None).cast("timestamp")


def nonneg_long(columns: Sequence[Column]) -> Column:
    """The first column that is an integer of 0 or more; else 0."""
    numbers = [F.trim(c.cast("string")).try_cast("long") for c in columns]
    return F.coalesce(*[F.when(n >= 0, n) for n in numbers], F.lit(0)).cast("long")


def extract_host(url: Column, compat: bool = False) -> Column:
    """Lower-case host with its port, without user and password; compat drops hosts of urls that have no path."""
    host = F.lower(F.regexp_replace(F.regexp_extract(F.trim(url), rf"^{SCHEME}([^/?#]*)", 1), r"^.*@", ""))
    found = F.nullif(host, F.lit(""))
    return F.when(F.regexp_replace(F.trim(url), rf"^{SCHEME}", "").contains("/"), found) if compat else found


def url_path(url: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(url), rf"^{SCHEME}[^/?#]*([^?#]*)", 1), F.lit(""))


def url_query(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.lit(""))


def map_action(columns: Sequence[Column], allow: Sequence[str], block: Sequence[str], default: str = "unknown") -> Column:
    """What the first column says whose value is in either list, case aside."""
    lists = (("allow", [v.lower() for v in allow]), ("block", [v.lower() for v in block]))
    each = [F.when(F.lower(F.trim(c.cast("string"))).isin(values), F.lit(name)) for c in columns for name, values in lists]
    return F.coalesce(*each, F.lit(default))


def status_code(columns: Sequence[Column]) -> Column:
    numbers = [F.trim(c.cast("string")).try_cast("int") for c in columns]
    return F.coalesce(*[F.when(n.between(100, 599), n) for n in numbers]) if numbers else F.lit(None).cast("int")


def method_group(method: Column) -> Column:
    upper, out = F.upper(method), None
    for name, methods in config.METHOD_GROUPS.items():
        out = F.when(upper.isin(methods), name) if out is None else out.when(upper.isin(methods), name)
    return out.otherwise("OTHER")


def bytes_bucket(size: Column) -> Column:
    out = None
    for name, most in config.BYTES_BUCKETS:
        out = F.when(size <= most, name) if out is None else out.when(size <= most, name)
    return out.otherwise(config.BYTES_BUCKETS[-1][0])
