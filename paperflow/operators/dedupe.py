"""One row per key, and exact samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered(order: tuple[Column | str, ...], null: Column) -> Column:
    """What rows are compared by: one thing after another, where `null` says how a null compares with the rest."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[part for n, c in enumerate(columns) for part in ((c.isNull() == null).alias(f"null{n}"), c.alias(f"value{n}"))])


def keep_first(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The row of each key that comes first by `order`; null comes after all values, and a key whose orders are all null keeps a row.

    An aggregate, so that a key's rows are reduced before they are shuffled.
    """
    best = df.groupBy(key).agg(F.min_by(F.struct(*df.columns), ordered(order, F.lit(True))).alias("_row"))
    return best.select("_row.*")


def keep_last(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The row of each key that comes last by `order`; null comes before all values."""
    best = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), ordered(order, F.lit(False))).alias("_row"))
    return best.select("_row.*")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows, the same for a seed whatever the partitions; all rows if n is not positive or not less than their number."""
    if n <= 0:
        return df
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)
