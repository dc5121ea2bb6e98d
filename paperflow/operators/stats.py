"""Counts and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import moment, truthy_text
from .dedupe import keep_first

IRRELEVANT = ("irrelevant", "low_relevance", "low-relevance")


def corpus_stats(df: DataFrame, flag: str, stamps: dict[str, str], order: str, key: str = "doi") -> DataFrame:
    """(metric, value) as text: papers, computational and other ones, and the latest of each stamp, N/A without any."""
    rows = keep_first(df.select(key, flag, *stamps.values(), order), key, order)
    own = F.count_if(truthy_text(F.col(flag)))
    latest = [F.max(moment(F.col(c))) for c in stamps.values()]
    one = rows.agg(F.count("*").alias("total"), own.alias("own"), *[x.alias(n) for n, x in zip(stamps, latest)])
    values = [("total_papers", F.col("total").cast("string")), ("computational", F.col("own").cast("string")), ("non_computational", (F.col("total") - F.col("own")).cast("string"))]
    values += [(n, F.coalesce(F.date_format(n, "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))) for n in stamps]
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in values])).alias("s")).select("s.*")


def exploded_counts(df: DataFrame, labels: str, most: int | None = 10) -> DataFrame:
    """(label, count) of a list column, the most frequent first, of equals the smaller label; empty lists count nothing."""
    counts = df.select(F.explode(labels).alias("label")).where("label is not null").groupBy("label").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "label").limit(most) if most else counts


def papers_by_year(df: DataFrame, year: str, flag: str, current: int) -> DataFrame:
    """Papers of each year up to the current one: all, flagged true, flagged false."""
    known = df.withColumn("_year", F.col(year).try_cast("int")).where(F.col("_year") <= current)
    return known.groupBy(F.col("_year").alias("year")).agg(F.count("*").alias("papers"), F.count_if(F.col(flag) == F.lit(True)).alias("computational"), F.count_if(F.col(flag) == F.lit(False)).alias("non_computational"))


def annotation_report(df: DataFrame, dimensions: dict[str, str], lists: dict[str, str] | None = None, only: dict[str, Column] | None = None, most: int = 15, missing: dict[str, str] | None = None) -> DataFrame:
    """(dimension, value, count, percent), all dimensions in one pass.

    dimensions are columns, lists list columns, whose values count one by one
    and of which the `most` frequent are kept, of equals the smaller value. Some
    dimensions look at rows of a condition only. percent is of the rows that a
    dimension looks at. Missing values are N/A or what `missing` says; empty
    lists count nothing.
    """
    only, missing, lists = only or {}, missing or {}, lists or {}
    none = F.array().cast("array<string>")
    values = {n: F.array(F.coalesce(F.col(c).cast("string"), F.lit(missing.get(n, "N/A")))) for n, c in dimensions.items()}
    values |= {n: F.filter(F.coalesce(F.col(c), none), lambda x: x.isNotNull()) for n, c in lists.items()}
    # a null value for the row itself, so that rows are counted along with their values
    whole = {n: F.concat(F.array(F.lit(None).cast("string")), v) for n, v in values.items()}
    asked = {n: F.when(F.coalesce(only[n], F.lit(False)), v).otherwise(none) if n in only else v for n, v in whole.items()}
    pairs = F.concat(*[tagged(n, v) for n, v in asked.items()])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("count"))
    rows = counts.where("value is null").select("dimension", F.col("count").alias("_rows"))
    kept = counts.where("value is not null")
    if lists:
        # the most frequent of each part of a dimension's values, then of those: no task sees a whole dimension
        long = F.col("dimension").isin(*lists)
        parts = Window.partitionBy("dimension", F.pmod(F.xxhash64("value"), F.lit(PARTS))).orderBy(F.desc("count"), "value")
        some = kept.where(long).withColumn("_place", F.row_number().over(parts)).where(F.col("_place") <= most)
        best = some.withColumn("_place", F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("count"), "value"))).where(F.col("_place") <= most)
        kept = kept.where(~long).unionByName(best.drop("_place"))
    return kept.join(rows, "dimension").select("dimension", "value", "count", F.round(100 * F.col("count") / F.col("_rows"), 2).alias("percent"))


#: Parts of a dimension's values, of each of which the most frequent are found first.
PARTS = 64


def tagged(name: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("dimension"), v.alias("value")))


def value_counts(df: DataFrame, *columns: str, most: int | None = None) -> DataFrame:
    counts = df.groupBy(*columns).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), *columns).limit(most) if most else counts


def relevance_mix(df: DataFrame, relevance: str, drop: Sequence[str] = IRRELEVANT) -> tuple[DataFrame, DataFrame]:
    """(count and percent of each relevance, rows that are left when the irrelevant ones go)."""
    mix = annotation_report(df, {"relevance": relevance}).drop("dimension").withColumnRenamed("value", "relevance")
    return mix, df.where(~F.coalesce(F.col(relevance), F.lit("")).isin(*drop))


def facet_values(df: DataFrame, scalars: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """(facet, value): distinct values of columns and list columns, in one pass."""
    of = lambda name, values: F.transform(values, lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value")))
    none = F.array().cast("array<string>")
    all_ = F.concat(*[of(c, F.array(F.col(c).cast("string"))) for c in scalars], *[of(c, F.coalesce(F.col(c), none)) for c in lists])
    return df.select(F.explode(all_).alias("f")).select("f.*").where("value is not null and value <> ''").distinct()


def split_counts(df: DataFrame, flag: str) -> DataFrame:
    """(class, papers); without the column all are non-computational."""
    name = F.when(F.coalesce(F.col(flag), F.lit(False)), "computational").otherwise("non_computational") if flag in df.columns else F.lit("non_computational")
    return df.groupBy(name.alias("class")).agg(F.count("*").alias("papers"))
