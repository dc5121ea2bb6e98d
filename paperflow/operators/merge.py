"""Joining section logs, annotations, reviews and curation onto the corpus."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import clean_doi
from ..sources.buckets import BucketTable
from .dedupe import keep_first, keep_last

#: Rank of each extraction status, in lower case; others rank OTHER_RANK.
STATUS_RANKS = {
    "extracted from pdf (sections found)": 4,
    "extracted from html (sections found)": 3,
    "pdf processed but no relevant sections found": 2,
    "html processed (no sections found by heuristics)": 1,
    "oa_html_landing_page": 0.5,
    "oa_pdf_link": 0.5,
    "oa_pdf_fallback": 0.5,
    "oa but no direct location info from unpaywall": 0,
    "closed access or not found in unpaywall": 0,
    "skipped pdf (pymupdf not installed)": -0.5,
    "skipped: empty doi": -0.6,
    "unpaywall/network error": -1,
    "html fetch error": -1,
    "pdf download error": -1,
    "general error": -1,
    "initial: not processed": -2,
    "serialization error": -3,
}
OTHER_RANK = -4
#: Names of sections.
SECTIONS = ("introduction", "results_discussion", "conclusion", "methods", "code_availability", "data_availability")


def status_rank(status: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for k, v in STATUS_RANKS.items() for x in (k, float(v))])
    return F.coalesce(F.try_element_at(ranks, F.lower(status)), F.lit(float(OTHER_RANK)))


def best_attempt(log: DataFrame, order: str, key: str = "doi", status: str = "section_extraction_status", at: str = "extracted_at_timestamp") -> DataFrame:
    """Each key's attempt of the best status, of equals the latest, of those the first by `order`.

    An aggregate: attempts of a key that is tried over and over are reduced
    before the shuffle.
    """
    when = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(2**62)))
    return keep_last(log, key, status_rank(F.col(status)), when, -F.col(order))


def merge_sections(papers: DataFrame, best: DataFrame, key: str = "doi", sections: Sequence[str] = SECTIONS) -> DataFrame:
    """Papers with their best attempt, and whether it gave any section; defaults where there was none."""
    texts = [f"extracted_{s}_section" for s in sections]
    joined = papers.drop(*texts, "is_open_access", "full_text_access_type", "section_extraction_status").join(best.select(key, "is_open_access", "full_text_access_type", "section_extraction_status", *texts), key, "left")
    found = F.lower(F.coalesce("section_extraction_status", F.lit(""))).rlike("extracted from (html|pdf)")
    any_text = reduce(lambda a, b: a | b, [F.trim(F.coalesce(F.col(t), F.lit(""))) != "" for t in texts])
    return joined.withColumns({
        "sections_extracted_successfully": found & any_text,
        "is_open_access": F.coalesce("is_open_access", F.lit(False)),
        "full_text_access_type": F.coalesce("full_text_access_type", F.lit("Unknown")),
        "section_extraction_status": F.coalesce("section_extraction_status", F.lit("Not Processed")),
        **{t: F.coalesce(F.col(t), F.lit("")) for t in texts},
    })


def join_curated_categories(papers: DataFrame, curated: DataFrame, renamed: dict[str, str], order: str, key: str = "doi", score: float = 100.0) -> DataFrame:
    """The first curated row of each key beside the paper, under new names; matched papers get the curated score."""
    first = keep_first(curated, key, order).select(key, *[F.col(a).alias(b) for a, b in renamed.items()], F.lit(True).alias("_matched"))
    joined = papers.join(first, key, "left")
    scores = {c: F.when(F.col("_matched"), F.lit(score)).otherwise(F.col(c).cast("double")) for c in ("annotation_score", "relevance_score")}
    return joined.withColumns(scores).drop("_matched")


def combine_sources(pool: DataFrame, sections: DataFrame, annotated: DataFrame, weak: DataFrame, order: str, now: str, key: str = "doi", prefix: str = "weak_annot_", score: float = 2.0) -> DataFrame:
    """Pool rows whose key is in all three tables, with the last row of each; the left side's columns win, weak ones are prefixed."""
    base = pool
    for df in (sections, annotated, weak):
        base = base.join(df.select(key).distinct(), key, "left_semi")
    taken = set(pool.columns)
    for df, p in ((sections, ""), (annotated, ""), (weak, prefix)):
        last = keep_last(df, key, order)
        names = [c for c in df.columns if c not in (key, order) and p + c not in taken]
        base = base.join(last.select(key, *[F.col(c).alias(p + c) for c in names]), key, "left")
        taken |= {p + c for c in names}
    defaults = {"annotation_date": F.lit(now), "annotation_score": F.lit(score), "annotation_status": F.lit("LLM_processed")}
    return base.withColumns({n: F.coalesce(F.col(n), v) if n in taken else v for n, v in defaults.items()})


def with_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")


def update_master(master: DataFrame, new: DataFrame, order: str, key: str = "doi", score: str = "annotation_score", lock: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(master with the new annotations, rows whose key is new), one row per key, both from the same pick.

    Of several new rows of a key the last by `order` (a column of `new`) counts.
    Master rows of the lock's score or more are curated and stay; of several
    the one of the highest score. New rows without a key are left out.
    """
    picked = keep_last(with_key(new, key), key, order)
    number = F.col(score).try_cast("double")
    ranked = master.withColumn("_rank", F.when(F.coalesce(number, F.lit(0.0)) >= lock, 0).otherwise(2)).unionByName(picked.drop(*{order} - set(master.columns)).withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    best = keep_first(ranked, key, "_rank", -number).drop("_rank")
    return best, picked.join(master.select(key).distinct(), key, "left_anti")


def update_master_table(table: BucketTable, new: DataFrame, order: str, score: str = "annotation_score", lock: float = 3.0) -> DataFrame:
    """`update_master` on a master that is kept in buckets: only those of the new keys are rewritten. Gives the rows whose key is new."""
    before, changes = table.version(), with_key(new, table.key)
    table.update(changes, lambda master, rows: update_master(master, rows, order, table.key, score, lock)[0])
    return keep_last(changes, table.key, order).join(table.read(before).select(table.key).distinct(), table.key, "left_anti")


def overlay_manual(papers: DataFrame, overlay: DataFrame, now: str, order: str, key: str = "doi", score: float = 100.0, status: str = "human_annotated") -> DataFrame:
    """Every overlay column over the paper's, empty text included; keys that are no papers are skipped; rows marked for deletion go.

    Of several overlay rows of a key the last by `order` counts, a column that is
    not laid over. Keys are compared cleaned.
    """
    columns = [c for c in overlay.columns if c not in (key, order)]
    papers = papers.withColumn(key, clean_doi(F.col(key)))
    last = keep_last(with_key(overlay.withColumn(key, clean_doi(F.col(key))), key), key, order)
    known = last.select(key, *[F.col(c).alias(f"_m_{c}") for c in columns], F.lit(True).alias("_matched"))
    joined = papers.join(known, key, "left")
    out = {c: F.when(F.col("_matched"), F.col(f"_m_{c}")).otherwise(F.col(c) if c in papers.columns else F.lit(None)) for c in columns}
    old = lambda n, kind: F.col(n).cast(kind) if n in papers.columns else F.lit(None).cast(kind)
    out |= {"annotation_score": F.when(F.col("_matched"), F.lit(score)).otherwise(old("annotation_score", "double")), "manual_annotation_status": F.when(F.col("_matched"), status).otherwise(old("manual_annotation_status", "string")), "manual_annotation_timestamp": F.when(F.col("_matched"), now).otherwise(old("manual_annotation_timestamp", "string"))}
    marked = F.lower(F.coalesce("mark_for_deletion", F.lit(""))) == "yes" if "mark_for_deletion" in [*papers.columns, *columns] else F.lit(False)
    return joined.withColumns(out).drop("_matched", *[f"_m_{c}" for c in columns]).where(~marked)


def overlay_table(table: BucketTable, overlay: DataFrame, now: str, order: str, score: float = 100.0, status: str = "human_annotated") -> None:
    """`overlay_manual` on papers of cleaned keys that are kept in buckets: only those of the overlay's keys are rewritten."""
    changes = with_key(overlay.withColumn(table.key, clean_doi(F.col(table.key))), table.key)
    table.update(changes, lambda papers, rows: overlay_manual(papers, rows, now, order, table.key, score, status))


def merge_manual(annotated: DataFrame, manual: DataFrame, deleted: DataFrame, now: str, order: str, key: str = "doi", score: float = 100.0) -> DataFrame:
    """Manual rows over annotated ones, manual-only rows added, deleted keys in neither.

    Of several rows of a key on either side the last by `order` counts, a column
    of both that is not kept. Keys are compared cleaned; rows without one go.
    """
    gone = deleted.select(clean_doi(F.col(key)).alias(key)).distinct()
    annotated, manual = (keep_last(with_key(df.withColumn(key, clean_doi(F.col(key))), key), key, order).drop(order) for df in (annotated, manual))
    a, m = annotated.join(gone, key, "left_anti").alias("a"), manual.join(gone, key, "left_anti").withColumn("_manual", F.lit(True)).alias("m")
    joined = a.join(m, F.col(f"a.{key}") == F.col(f"m.{key}"), "full_outer")
    by_hand = F.coalesce(F.col("m._manual"), F.lit(False))

    def value(name: str) -> Column:
        if name == key:
            return F.coalesce(f"a.{key}", f"m.{key}")
        if name not in manual.columns:
            return F.col(f"a.{name}")
        other = F.col(f"a.{name}") if name in annotated.columns else F.lit(None)
        return F.when(by_hand, F.col(f"m.{name}")).otherwise(other)

    stamped = ("annotation_score", "manual_reviewed", "manual_review_date")
    names = [n for n in [*annotated.columns, *[c for c in manual.columns if c not in annotated.columns]] if n not in stamped]
    old = F.col("a.annotation_score").cast("double") if "annotation_score" in annotated.columns else F.lit(0.0)
    return joined.select(*[value(n).alias(n) for n in names], F.when(by_hand, F.lit(score)).otherwise(old).alias("annotation_score"), by_hand.alias("manual_reviewed"), F.when(by_hand, F.lit(now)).alias("manual_review_date"))


def prepare_review(existing: DataFrame, annotated: DataFrame, key: str = "doi") -> DataFrame:
    """Existing review rows untouched, and a pending row for every new key, scored by how far its annotation went."""
    state = F.col("llm_annotation_status")
    score = F.when(state == "detailed_llm_annotated", 70.0).when(state == "middle_llm_annotated", 60.0).otherwise(F.coalesce(F.col("annotation_score").cast("double"), F.lit(0.0)))
    fresh = annotated.join(existing.select(key).distinct(), key, "left_anti").withColumn("annotation_score", score)
    blank = {c: F.lit("") for c in ("manual_notes", "manual_reviewer_id", "manual_review_timestamp")}
    return existing.unionByName(fresh.withColumns({"manual_review_status": F.lit("pending"), **blank}), allowMissingColumns=True)


def integrate_reviews(reviews: Sequence[DataFrame], deleted: DataFrame, order: str, flag: str, columns: Sequence[str], key: str = "doi", score: float = 100.0) -> tuple[DataFrame, DataFrame]:
    """(true, false) of the reviewed tables, one row per key, after deletions and reviewers' verdicts; a null flag is in neither.

    The earlier table wins, within it the first by `order`.
    """
    ranked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("_table", F.lit(n)) for n, df in enumerate(reviews)])
    cleaned = ranked.withColumn(key, clean_doi(F.col(key))).where(F.col(key) != "")
    gone = deleted.select(clean_doi(F.col(key)).alias(key)).distinct()
    rows = keep_first(cleaned.join(gone, key, "left_anti"), key, "_table", order)
    verdict, state = F.col("manual_review_status"), F.col("llm_annotation_status")
    acted = verdict.isin("reviewed", "reclassify_to_comp", "reclassify_to_noncomp")
    reviewed = F.when(state == "detailed_llm_annotated", "human_reviewed_detailed").when(state == "middle_llm_annotated", "human_reviewed_broad_only").otherwise("human_reviewed")
    new_state = F.when(verdict == "reclassify_to_comp", "human_reclassified_to_comp").when(verdict == "reclassify_to_noncomp", "human_reclassified_to_noncomp").when(verdict == "reviewed", reviewed).otherwise(state)
    out = rows.withColumns({
        "annotation_score": F.when(acted, F.lit(score)).otherwise(F.col("annotation_score").cast("double")),
        "llm_annotation_status": new_state,
        flag: F.when(verdict == "reclassify_to_comp", True).when(verdict == "reclassify_to_noncomp", False).otherwise(F.col(flag)),
    })
    conformed = out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns])
    return conformed.where(F.col(flag) == F.lit(True)), conformed.where(F.col(flag) == F.lit(False))


def seed_manual(curated: DataFrame, order: str, key: str = "doi", now: str = "") -> DataFrame:
    """A record to annotate by hand for the first row of each key that has a curated category."""
    some = reduce(lambda a, b: a | b, [F.trim(F.coalesce(F.col(c), F.lit(""))) != "" for c in ("category", "pipeline_category", "name")])
    rows = keep_first(curated.where(F.coalesce(F.col(key), F.lit("")) != ""), key, order).where(some)
    parts = F.filter(F.transform(F.split(F.coalesce("category", F.lit("")), ","), F.trim), lambda x: x != "")
    return rows.select(key, parts.alias("final_paper_classification"), F.nullif(F.trim("pipeline_category"), F.lit("")).alias("final_pipeline_step"), F.nullif(F.trim("name"), F.lit("")).alias("package_algorithm_name"), F.lit(True).alias("manual_reviewed"), F.lit(now).alias("manual_review_date"))


def join_embeddings(vectors: DataFrame, papers: DataFrame, key: str = "doi") -> DataFrame:
    """Papers that have a vector, with it."""
    return vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).join(papers, key)
