"""Scores and labels that follow from annotations."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import strict_bool
from ..sources.buckets import BucketTable, Folder

#: Fields whose presence counts for completeness, of every annotation and of methods papers.
CORE_FIELDS = ("llm_annot_main_goal_of_paper", "llm_annot_classification", "llm_annot_contribution_type")
METHOD_FIELDS = (
    "llm_annot_package_algorithm_name", "llm_annot_algorithms_bases_used", "llm_annot_pipeline_analysis_steps", "llm_annot_tested_data_modalities",
    "llm_annot_tested_assay_types_platforms", "llm_annot_compared_algorithms_packages", "llm_annot_code_availability_details", "llm_annot_data_used_details",
)
#: Order of relevance; null and unknown ones count as uncertain.
RELEVANCE_ORDER = {"irrelevant": 0.0, "low_relevance": 1.0, "uncertain": 1.5, "null": 1.5, "relevant": 2.0, "highly_relevant": 3.0}
UNCERTAIN = 1.5


def score_and_split(df: DataFrame, classification: str, flag: str, status: str, score: float = 60.0) -> tuple[DataFrame, DataFrame]:
    """(computational, others), which together are the input. `classification` is JSON text; only a true flag is computational."""
    value = F.try_parse_json(classification)
    scored = df.withColumn("is_computational", strict_bool(F.try_variant_get(value, f"$.{flag}", "variant"))).withColumn("annotation_score", F.when(F.col(status) == "middle_llm_annotated", F.lit(score)).otherwise(F.coalesce(F.col("annotation_score").cast("double"), F.lit(0.0))))
    return scored.where("is_computational"), scored.where("not is_computational")


def filled(df: DataFrame, name: str) -> Column:
    """1 for a list or map that is not empty, a struct or text that is not blank; 0 else and for a missing column."""
    if name not in df.columns:
        return F.lit(0)
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        has = F.size(c) > 0
    elif isinstance(kind, T.StructType):
        has = c.isNotNull()
    else:
        has = F.trim(c.cast("string")) != ""
    return F.coalesce(has & c.isNotNull(), F.lit(False)).cast("int")


def completeness_score(df: DataFrame, is_method: Column, complete: float, method: float, section: float, core: Sequence[str] = CORE_FIELDS, methods: Sequence[str] = METHOD_FIELDS) -> Column:
    """0 unless annotated; else 0.5 and shares for filled fields, for methods papers and for sections, 1 at most."""
    share = lambda names: sum((filled(df, n) for n in names), F.lit(0)) / float(len(names))
    total = F.lit(0.5) + share(core) * complete
    total += F.when(F.coalesce(is_method, F.lit(False)), method + share(methods) * (method / 2)).otherwise(0.0)
    total += F.when(F.coalesce(F.col("sections_extracted_successfully"), F.lit(False)), section).otherwise(0.0)
    return F.when(F.col("llm_annotation_status") == "middle_llm_annotated", F.least(F.lit(1.0), F.round(total, 3))).otherwise(0.0)


def final_labels(df: DataFrame, categories: str, is_method: Column, steps: str) -> DataFrame:
    """Categories, and for methods papers the first pipeline step, as defaults before any review."""
    return df.withColumns({
        "final_paper_classification": F.coalesce(F.col(categories), F.array().cast("array<string>")),
        "final_pipeline_step": F.when(F.coalesce(is_method, F.lit(False)), F.get(F.col(steps), F.lit(0))),
        "manual_reviewed": F.lit(False),
        "manual_review_date": F.lit(None).cast("string"),
    })


def consolidate_relevance(exclusion: Column, inclusion: Column, pipeline: Column, similarity: Column) -> Column:
    """struct(status, source) by the first rule that applies: keywords before similarity."""
    rule = lambda status, source: F.struct(F.lit(status).cast("string").alias("status"), F.lit(source).alias("source"))
    return (
        F.when(F.coalesce(exclusion, F.lit(False)), rule("low-relevance", "keyword_exclusion"))
        .when(F.coalesce(inclusion, F.lit(False)), rule("relevant", "keyword_inclusion"))
        .when(F.coalesce(F.size(pipeline), F.lit(0)) > 0, rule("relevant", "keyword_pipeline"))
        .when(similarity.isin("low-relevance_by_similarity", "uncertain_by_similarity"), rule("low-relevance", "keyword_no_core_terms"))
        .when(similarity == "relevant_by_similarity", rule("relevant", "scibert_similarity"))
        .otherwise(rule(None, "unknown"))
    )


def some(label: Column) -> Column:
    """A list of one label; empty for blank ones."""
    blank = F.lower(F.coalesce(label, F.lit(""))).isin("", "nan", "none")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.array(label))


def consolidate_categories(similar: Column, similar_pipeline: Column, paper_types: Column, pipelines: Column) -> tuple[Column, Column]:
    """(categories, pipeline categories): distinct, in order of trust; a methodology paper is a computational method first."""
    no = F.array().cast("array<string>")
    types, own = F.coalesce(paper_types, no), some(similar)
    method = F.array_contains(types, "Methodology Paper") & ~F.array_contains(own, "Computational Method")
    first = F.when(method, F.array(F.lit("Computational Method"))).otherwise(no)
    return F.array_distinct(F.concat(first, own, types)), F.array_distinct(F.concat(some(similar_pipeline), F.coalesce(pipelines, no)))


def seed_override(df: DataFrame, is_seed: str = "is_seed") -> DataFrame:
    """Seeds are relevant by curation, with the curated category and pipeline where there are any, and score 2; others 1."""
    seed = F.coalesce(F.col(is_seed), F.lit(False))

    def over(column: str, curated: str) -> Column:
        return F.when(seed & (F.coalesce(F.col(curated), F.lit("")) != ""), F.array(F.col(curated))).otherwise(F.col(column))

    return df.withColumns({
        "relevance_status": F.when(seed, "relevant").otherwise(F.col("relevance_status")),
        "relevance_source": F.when(seed, "manual_curation").otherwise(F.col("relevance_source")),
        "category": over("category", "original_curated_category"),
        "pipeline_category": over("pipeline_category", "original_curated_pipeline_category"),
        "annotation_score": F.when(seed, 2.0).otherwise(1.0),
    })


def promote_relevance(current: Column, new: Column) -> Column:
    """The new value if it ranks higher, or the current one is null or uncertain, or the new one is irrelevant."""
    order = F.create_map(*[F.lit(x) for kv in RELEVANCE_ORDER.items() for x in kv])
    rank = lambda c: F.coalesce(F.try_element_at(order, F.lower(c)), F.lit(UNCERTAIN))
    return F.when((rank(new) > rank(current)) | current.isNull() | current.isin("null", "uncertain") | (new == "irrelevant"), new).otherwise(current)


def answered(annotator: Callable[[str], str], text: str) -> tuple[str | None, str]:
    """(answer, status) of one call."""
    try:
        return annotator(text), "success"
    except Exception as e:  # the annotator is the caller's
        return None, f"llm_error_{type(e).__name__}"


def annotate_with(df: DataFrame, annotator: Callable[[str], str], key: str, prompt: str) -> DataFrame:
    """(key, answer, status) from a caller's annotator, one text to one JSON text. An error becomes a status, never a failed job; limit concurrency by partitions.

    Answers last as long as the job: for calls that cost something, `annotate_in_batches`.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [answered(annotator, text) for text in frame[prompt]]
            yield pd.DataFrame({key: frame[key], "answer": [a for a, _ in found], "status": [s for _, s in found]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, prompt).mapInPandas(run, f"{key} {kind}, answer string, status string")


def answer_table(spark: SparkSession, path: str, key: T.StructField, buckets: int = 16) -> BucketTable:
    """Where answers are kept: (key, attempt, answer, status)."""
    kind = T.StructType([T.StructField(key.name, key.dataType), T.StructField("attempt", T.IntegerType()), T.StructField("answer", T.StringType()), T.StructField("status", T.StringType())])
    return BucketTable(spark, f"{path}/answers", kind, key.name, buckets)


def annotate_in_batches(df: DataFrame, annotator: Callable[[str], str], key: str, prompt: str, path: str, attempt: int = 1, at_once: int = 8, absorb: int = 50) -> DataFrame:
    """(key, attempt, answer, status) of all rows of `df` from a caller's annotator, each answer kept below `path` as soon as its batch is done.

    A batch is `at_once` rows, each a task of its own whose answer is committed
    when the task ends, even if the job fails; so no more calls than that are in
    flight, and no more are lost if the annotator, an executor or the driver
    dies. Started again with the same path, keys that have an answer of this
    attempt, or one that succeeded in any, are not asked again. After every
    `absorb` batches the small files of answers are put into a bucket table.
    Of rows that share a key one is asked; rows without a key are left out.
    """
    spark = df.sparkSession
    table, loose = answer_table(spark, path, df.schema[key]), Folder(spark, f"{path}/loose")

    def put_away() -> None:
        names = loose.names("")
        found = [f"{loose.path}/{n}" for n in names if any(x.endswith(".parquet") for x in loose.names(n))]
        if found:
            table.update(spark.read.schema(table.schema).parquet(*found), lambda old, new: old.unionByName(new).dropDuplicates([key, "attempt"]))
        for n in names:
            loose.remove(n)

    put_away()
    done = table.read().where((F.col("attempt") == attempt) | (F.col("status") == "success")).select(key).distinct()
    asked = df.where(F.col(key).isNotNull()).select(key, F.col(prompt).alias("prompt")).join(done, key, "left_anti").dropDuplicates([key])
    pending = f"{path}/pending-{uuid.uuid4().hex}"
    asked.withColumn("place", F.monotonically_increasing_id()).write.parquet(pending)
    rows = spark.read.parquet(pending)
    # places are in order within each part; there are as many counts as parts
    parts = sorted((r["part"], r["count"]) for r in rows.groupBy(F.shiftright("place", 33).alias("part")).count().collect())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k, text in zip(frame[key], frame["prompt"]):
                answer, status = answered(annotator, text)
                yield pd.DataFrame({key: [k], "attempt": [attempt], "answer": [answer], "status": [status]})

    number = 0
    for part, count in parts:
        for start in range(0, count, at_once):
            first = (part << 33) + start
            batch = rows.where(F.col("place").between(first, first + at_once - 1)).repartitionById(at_once, (F.col("place") - first).cast("int"))
            # with the second algorithm a task's files are final when the task is done
            answers = batch.select(key, "prompt").mapInPandas(run, table.schema)
            answers.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{loose.path}/{uuid.uuid4().hex}")
            number += 1
            if number % absorb == 0:
                put_away()
    put_away()
    Folder(spark, pending).remove("")
    return table.read().join(df.select(key).distinct(), key, "left_semi")
