"""Column builders for taxonomy codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxylens import config

CODE = "^[A-Z]{2}-[0-9]{3}$"
NONE = "cast(array() as array<string>)"


def canonical_array(codes: Column) -> Column:
    """Codes without blanks and repeats, sorted; never null."""
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(F.transform(codes, lambda c: F.trim(c)), lambda c: c.isNotNull() & (c != "")))), F.expr(NONE))


def canonical_codes(codes: Column) -> Column:
    """Canonical JSON text of an array of codes."""
    return F.to_json(canonical_array(codes))


def parse_codes(text: Column) -> Column:
    """The strings of a JSON array; anything else gives an empty array."""
    values = F.try_parse_json(text).try_cast("array<variant>")
    strings = F.filter(values, lambda v: F.schema_of_variant(v) == "STRING")
    return F.coalesce(F.transform(strings, lambda v: v.cast("string")), F.expr(NONE))


def merge_codes(*codes: Column) -> Column:
    return canonical_array(F.flatten(F.array(*[F.coalesce(c, F.expr(NONE)) for c in codes])))


def valid_code_format(code: Column, dimension: str | None = None) -> Column:
    good = F.coalesce(code.rlike(CODE), F.lit(False))
    return good & code.startswith(f"{dimension}-") if dimension else good


def cardinality_errors(codes: dict[str, Column]) -> Column:
    """Names of the dimensions that hold too few or too many codes."""
    faults = []
    for name, (least, most) in config.DIMENSIONS.items():
        n = F.size(F.coalesce(codes[name], F.expr(NONE)))
        wrong = n < least
        faults.append(F.when(wrong | (n > most) if most else wrong, F.lit(name)))
    return F.array_compact(F.array(*faults))
