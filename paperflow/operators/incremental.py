"""What is new, what is still to do, and what is out of date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_first, keep_last


def done_rows(existing: DataFrame, status: str, done: tuple[str, ...] = ("success",), filled: str | None = None) -> DataFrame:
    """Rows of a finished status, and those that have a value in the column `filled`, whatever their status says."""
    finished = F.coalesce(F.col(status).isin(*done), F.lit(False))
    return existing.where(finished | F.col(filled).isNotNull() if filled else finished)


def select_unprocessed(df: DataFrame, existing: DataFrame, key: str, status: str, force: bool = False, filled: str | None = None) -> DataFrame:
    """Rows whose key has no finished row yet; failures are tried again."""
    return df if force else df.join(done_rows(existing, status, filled=filled).select(key).distinct(), key, "left_anti")


def with_finished(existing: DataFrame, new: DataFrame, status: str, filled: str | None = None) -> DataFrame:
    """Finished rows and the new ones; failed ones go, since they are among the new."""
    return done_rows(existing, status, filled=filled).unionByName(new, allowMissingColumns=True)


def select_for_annotation(pool: DataFrame, annotated: DataFrame, key: str = "doi", relevance: str = "relevance_score") -> DataFrame:
    """Rows with a key that are not annotated yet and not marked irrelevant."""
    open_ = pool.where((F.coalesce(F.col(key), F.lit("")) != "") & (F.coalesce(F.col(relevance), F.lit("")) != "irrelevant"))
    return open_.join(annotated.select(key).distinct(), key, "left_anti")


def incremental_sections(raw: DataFrame, existing: DataFrame, order: str, key: str = "doi") -> DataFrame:
    """Existing rows and the first new row of each new key, with the section columns and a success flag."""
    sections = [c for c in raw.columns if c.startswith("extracted_") and c.endswith("_section")]
    flag = F.coalesce(F.col("sections_extracted_successfully"), F.lit(False)) if "sections_extracted_successfully" in raw.columns else F.lit(False)
    wanted = raw.where(F.coalesce(F.col(key), F.lit("")) != "").select(key, "pmid", *sections, flag.alias("sections_extracted_successfully"), order)
    new = keep_first(wanted.join(existing.select(key).distinct(), key, "left_anti"), key, order).drop(order)
    return existing.unionByName(new, allowMissingColumns=True)


def merge_new_candidates(pool: DataFrame, sources: list[tuple[str, DataFrame]], order: str, key: str = "doi") -> DataFrame:
    """New candidates of several sources in order of rank: keys in neither the pool nor an earlier source; found_via names the source."""
    ranked = [df.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("found_via", F.lit(name)).withColumn("_rank", F.lit(n)) for n, (name, df) in enumerate(sources)]
    all_ = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    fresh = all_.join(pool.select(key).distinct(), key, "left_anti")
    return keep_first(fresh, key, "_rank", order).drop("_rank")


def upsert_curated(pool: DataFrame, curated: DataFrame, order: str, key: str = "doi") -> DataFrame:
    """Curated values over the pool's where they are not null; new keys are added; curated rows say so in found_via and status.

    Of several curated rows of a key the last by `order` counts, a column that is
    not taken over; rows without a key are skipped.
    """
    curated = keep_last(curated.where(F.coalesce(F.col(key), F.lit("")) != ""), key, order).drop(order)
    marked = curated.withColumn("_curated", F.lit(True))
    p, c = pool.alias("p"), marked.alias("c")
    joined = p.join(c, F.col(f"p.{key}") == F.col(f"c.{key}"), "full_outer")
    is_curated = F.coalesce(F.col("c._curated"), F.lit(False))
    names = [*pool.columns, *[x for x in curated.columns if x not in pool.columns]]

    def value(name: str) -> Column:
        sides = [F.col(f"{side}.{name}") for side, df in (("c", curated), ("p", pool)) if name in df.columns]
        return F.coalesce(*sides).alias(name)

    stamped = [n for n in ("found_via", "status") if n in pool.columns]
    fixed = {"found_via": "csv_curation", "status": "curated_method"}
    return joined.select(*[value(n) for n in names if n not in stamped], *[F.when(is_curated, fixed[n]).otherwise(F.col(f"p.{n}")).alias(n) for n in stamped])


def expand_neighbors(seeds: DataFrame, links: DataFrame, seed: str, source: str, target: str) -> DataFrame:
    """Ids one link away from any seed, without the seeds."""
    known = seeds.where(F.col(seed).isNotNull()).select(F.col(seed).alias("id")).distinct()
    found = links.join(known, links[source] == known["id"], "left_semi").select(F.col(target).alias("id")).distinct()
    return found.join(known, "id", "left_anti")


def select_stale(df: DataFrame, refreshed: str, now: str, days: int = 7, key: str = "doi") -> DataFrame:
    """Rows with a key that were never refreshed, or at least so many whole days ago; 0 selects all."""
    elapsed = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(refreshed)) / 86400)
    return df.where((F.coalesce(F.col(key).cast("string"), F.lit("")) != "") & (F.col(refreshed).isNull() | (elapsed >= days)))


def citation_counts(papers: DataFrame, links: DataFrame, key: str, target: str, now: str) -> DataFrame:
    """Papers with the number of links to each, 0 without any, and when that was counted."""
    counts = links.groupBy(F.col(target).alias(key)).agg(F.count("*").alias("citations"))
    return papers.drop("citations").join(counts, key, "left").withColumn("citations", F.coalesce("citations", F.lit(0).cast("bigint"))).withColumn("citations_updated", F.lit(now))
