"""Whole workloads, from tables to tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsons
from ..functions.keys import clean_doi
from ..operators import dedupe, filters, graph, incremental, merge, scoring, stats, vectors, vocabulary


def ingest(raw: DataFrame, vocabularies: Mapping[str, vocabulary.Vocabulary], order: str, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """(papers that are in the domain, their most frequent method labels).

    Rows without a key go before the only shuffle; tagging is a projection.
    """
    known = raw.withColumn("doi", clean_doi(F.col("doi"))).where("doi <> ''")
    one = dedupe.keep_first(known, "doi", order)
    tagged = vocabulary.extract_concepts(one.withColumn("_text", vocabulary.corpus_text(F.col("title"), F.col("abstract"))), "_text", vocabularies).drop("_text")
    kept = filters.domain_filter_score(tagged)
    return kept, stats.exploded_counts(kept, "kw_detected_methods", most)


def annotate(papers: DataFrame, attempts: DataFrame, existing: DataFrame, annotator, schema: T.StructType, order: str, now: str, model: str) -> tuple[DataFrame, DataFrame]:
    """(all annotations, those to review): sections of the best attempt, prompts for what is not annotated yet, parsed answers."""
    todo = incremental.select_unprocessed(papers, existing, "doi", "llm_annotation_status")
    whole = merge.merge_sections(todo, merge.best_attempt(attempts, order))
    from ..functions.text import build_prompt

    sections = {s: F.col(f"extracted_{s}_section") for s in merge.SECTIONS}
    prompts = whole.withColumn("prompt", build_prompt("Classify the paper. Answer with one JSON object.", schema.json(), F.col("title"), F.col("abstract"), sections))
    answers = scoring.annotate_with(prompts, annotator, "doi", "prompt")
    _, parsed = jsons.parse_llm_json(F.col("answer"))
    read = answers.withColumn("state", F.when(F.col("status") == "success", parsed).otherwise(F.col("status"))).drop("status")
    new = jsons.project_schema_keys(read, "answer", schema, "state", now, model).drop("answer", "state")
    done = incremental.with_finished(existing, new, "llm_annotation_status")
    return done, new.where(F.col("llm_annotation_status") == "success")


def similarity_graph(rows: DataFrame, papers: DataFrame, key: str, labels: Column, relevant: float = vectors.RELEVANT, uncertain: float = vectors.UNCERTAIN, least: float = graph.LEAST) -> tuple[DataFrame, DataFrame]:
    """(classified papers, edges): centroids of labelled vectors, the nearest of each vector, and the graph of neighbours."""
    labelled = rows.withColumn("_label", labels).where("_label is not null")
    main = vectors.centroid_table(vectors.centroids(labelled, "_label"), "_label")
    classified = vectors.classify_by_centroid(rows.select(key, "embedding"), main, {}, relevant, uncertain)
    return papers.join(classified.drop("embedding"), key, "left"), graph.similarity_edges(rows, key, least=least)
