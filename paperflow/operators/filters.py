"""Filters and searches over the corpus."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import clean_doi

#: Columns that every cleaned paper has, in order.
ESSENTIAL = ("doi", "pmid", "title", "abstract", "year", "authors", "journal")


def clean_corpus(df: DataFrame) -> DataFrame:
    """Clean keys, none empty; the essential columns first, backfilled; no section texts."""
    drop = [c for c in df.columns if c == "sections_extracted_successfully" or (c.startswith("extracted_") and c.endswith("_section"))]
    out = df.drop(*drop).withColumn("doi", clean_doi(F.col("doi"))).where("doi <> ''")
    for c in ESSENTIAL:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("")) if c in out.columns else F.lit(""))
    return out.select(*ESSENTIAL, *[c for c in out.columns if c not in ESSENTIAL])


def with_score(df: DataFrame, score: float = 0.0, column: str = "annotation_score") -> DataFrame:
    """A score for rows that have none yet, as a number."""
    old = F.col(column).try_cast("double") if column in df.columns else F.lit(None).cast("double")
    return df.withColumn(column, F.coalesce(old, F.lit(score)))


def domain_filter_score(df: DataFrame, flag: str = "kw_domain_inclusion", base: float = 50.0) -> DataFrame:
    """Rows whose flag is true, with a base score."""
    return df.where(F.col(flag)).withColumn("annotation_score", F.lit(base)).withColumn("pipeline_category", F.lit("keyword_filtered_and_scored"))


def domain_filter_increment(df: DataFrame, flag: str = "kw_domain_inclusion", step: float = 50.0, relevance: float = 100.0) -> DataFrame:
    """Rows whose flag is true; the score, 0 if it is no number, grows by a step."""
    score = F.coalesce(F.col("annotation_score").try_cast("double"), F.lit(0.0)) + step
    return df.where(F.coalesce(F.col(flag), F.lit(False))).withColumn("relevance_score", F.lit(relevance)).withColumn("annotation_score", score)


def split_by_class(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """(exactly true, exactly false); null is in neither."""
    return df.where(F.col(flag) == F.lit(True)), df.where(F.col(flag) == F.lit(False))


def contains(c: Column, query: str) -> Column:
    return F.coalesce(F.lower(c).contains(query.lower()), F.lit(False))


def search_corpus(df: DataFrame, query: str = "", years: Sequence[int] = (), journals: Sequence[str] = (), regex: bool = False) -> DataFrame:
    """Title or abstract contains the query (a pattern if asked for), year and journal are among those given; empty means any."""
    test = (lambda c: F.coalesce(c.rlike(f"(?i){query}"), F.lit(False))) if regex else (lambda c: contains(c, query))
    if query:
        df = df.where(test(F.col("title")) | test(F.col("abstract")))
    if years:
        df = df.where(F.col("year").isin(*years))
    return df.where(F.col("journal").isin(*journals)) if journals else df


def search_any_column(df: DataFrame, query: str) -> DataFrame:
    """Rows of which any column, as text, contains the query."""
    return df.where(reduce(lambda a, b: a | b, [contains(F.col(c).cast("string"), query) for c in df.columns]))


def filter_nodes(df: DataFrame, years: tuple[int, int] | None, lists: dict[str, Sequence[str]], key: str, most: int | None = None) -> DataFrame:
    """Nodes within a range of years whose lists share a label with each selection that is not empty; the first `most` by key."""
    if years:
        df = df.where(F.col("year").between(*years))
    for name, wanted in lists.items():
        if wanted:
            df = df.where(F.coalesce(F.arrays_overlap(name, F.array(*map(F.lit, wanted))), F.lit(False)))
    return df.orderBy(key).limit(most) if most else df


def class_review_report(df: DataFrame, flag: Column, fields: dict[str, Column]) -> DataFrame:
    """Successful annotations whose flag is false, with the columns a reviewer needs."""
    return df.where((F.col("llm_annotation_status") == "success") & (flag == F.lit(False))).select(*[c.alias(n) for n, c in fields.items()])


def drop_prefixed_columns(df: DataFrame, prefix: str = "kw_detail_") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])
