"""Lenient and strict casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy_text(c: Column) -> Column:
    """true for the texts true, 1, t and yes in any case; else false."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1", "t", "yes"), F.lit(False))


def strict_bool(v: Column) -> Column:
    """true only for a JSON true; v is a variant."""
    return F.coalesce((F.schema_of_variant(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"), F.lit(False))


def repaired_bool(v: Column) -> Column:
    """A JSON boolean as it is, the text true in any case as true, all else false; v is a variant."""
    text = F.lower(F.try_variant_get(v, "$", "string")) == "true"
    kind = F.schema_of_variant(v)
    return F.coalesce(F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(kind == "STRING", text), F.lit(False))


def number(c: Column, default: float | None = None) -> Column:
    out = c.try_cast("double")
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def whole_number(c: Column, default: int | None = None) -> Column:
    out = c.try_cast("double").cast("bigint")
    return out if default is None else F.coalesce(out, F.lit(default).cast("bigint"))


def moment(c: Column) -> Column:
    """A timestamp, null where the text is none."""
    return F.try_to_timestamp(c)
