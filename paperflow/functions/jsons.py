"""JSON columns: model answers, schemas, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import repaired_bool
from .keys import strip

#: Answer fields that are lists.
LIST_FIELDS = ("contribution_type", "algorithms_bases_used", "pipeline_analysis_steps", "tested_data_modalities", "tested_assay_types_platforms", "compared_algorithms_packages", "data_used_details")
SUCCESS, PARSE_ERROR = "success", "llm_error_json_parse"


def unfenced(text: Column) -> Column:
    """Without a code fence around the whole text."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"^```(json)?\s*", ""), r"\s*```$", "")


def parse_llm_json(text: Column) -> tuple[Column, Column]:
    """(variant, status) of a model's answer, fenced or not."""
    value = F.coalesce(F.try_parse_json(strip(text)), F.try_parse_json(unfenced(text)))
    return value, F.when(value.isNull(), PARSE_ERROR).otherwise(SUCCESS)


def project_schema_keys(df: DataFrame, answer: str, schema: T.StructType, status: str, now: str, model: str, prefix: str = "llm_annot_", score: float | None = None) -> DataFrame:
    """Earlier prefixed columns give way to those of the schema, read from the answer; unknown keys are dropped.

    `status` names a column; classification is always an object. With a score,
    successful rows get it as annotation_score, and section texts are dropped.
    """
    kept = [c for c in df.columns if not c.startswith(prefix) and c not in ("llm_annotation_status", "llm_annotation_timestamp", "llm_annotation_error", "llm_model_used")]
    read = df.withColumn("_answer", F.from_json(unfenced(F.col(answer)), schema))
    done = F.col(status) == SUCCESS
    fields = []
    for f in schema:
        value = F.when(done, F.col("_answer")[f.name])
        if f.name == "classification" and isinstance(f.dataType, T.StructType):
            value = F.coalesce(value, F.struct(*[F.lit(None).cast(x.dataType).alias(x.name) for x in f.dataType]))
        fields.append(value.alias(prefix + f.name))
    if score is not None:
        kept = [c for c in kept if not (c.startswith("extracted_") and c.endswith("_section")) and c != "annotation_score"]
        old = F.col("annotation_score") if "annotation_score" in df.columns else F.lit(0.0)
        fields.append(F.when(done, F.lit(score)).otherwise(old.cast("double")).alias("annotation_score"))
    stamps = [F.col(status).alias("llm_annotation_status"), F.lit(now).alias("llm_annotation_timestamp"), F.when(~done, F.col(status)).alias("llm_annotation_error"), F.lit(model).alias("llm_model_used")]
    keep = [c for c in kept if c != status or not status.startswith("llm_annotation")]
    return read.select(*keep, *fields, *stamps)


def is_kind(v: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith(kind), F.lit(False))


def clean_llm_fields(v: Column) -> dict[str, Column]:
    """Repaired fields of an answer (a variant): lists that are none become empty, a code link that is no object becomes unclear."""
    out = {name: F.when(is_kind(v, f"$.{name}", "ARRAY"), F.to_json(F.try_variant_get(v, f"$.{name}", "variant"))).otherwise("[]") for name in LIST_FIELDS}
    has = is_kind(v, "$.classification", "OBJECT")
    flag = F.try_variant_get(v, "$.classification.is_computational_methods_paper", "variant")
    out["is_computational"] = F.when(has & flag.isNotNull(), repaired_bool(flag))
    categories = F.try_variant_get(v, "$.classification.assigned_categories", "variant")
    out["assigned_categories"] = F.when(has & is_kind(v, "$.classification.assigned_categories", "ARRAY"), F.to_json(categories)).otherwise("[]")
    details = is_kind(v, "$.code_availability_details", "OBJECT")
    out["code_status"] = F.when(details, F.try_variant_get(v, "$.code_availability_details.status", "string")).otherwise("Unclear")
    out["code_link"] = F.when(details, F.try_variant_get(v, "$.code_availability_details.link", "string"))
    return out


def flatten_struct(df: DataFrame, name: str, prefix: str = "") -> DataFrame:
    """A struct column as columns prefix + name + _ + field."""
    fields = df.schema[name].dataType.names
    return df.select(*[c for c in df.columns if c != name], *[F.col(name)[f].alias(f"{prefix}{name}_{f}") for f in fields])


def nest_columns(df: DataFrame, schema: T.StructType, prefix: str = "") -> DataFrame:
    """The inverse, driven by the nested schema: every struct of it is made from columns prefix + name + _ + field."""
    nested = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.StructType)}
    used = {f"{prefix}{n}_{x}" for n, kind in nested.items() for x in kind.names}
    made = [F.struct(*[F.col(f"{prefix}{n}_{x}").alias(x) for x in kind.names]).alias(n) for n, kind in nested.items()]
    return df.select(*[c for c in df.columns if c not in used], *made)


def split_sections_log(df: DataFrame, sections: tuple[str, ...], key: str = "doi") -> tuple[DataFrame, DataFrame]:
    """Papers with defaults for what is missing, and a log with the sections nested; rows without a key are in neither."""
    known = df.where(F.coalesce(F.col(key), F.lit("")) != "")
    texts = [f"extracted_{s}_section" for s in sections]
    papers = known.select(*[c for c in known.columns if c not in texts], *[(F.coalesce(F.col(t), F.lit("")) != "").alias(f"has_{s}_section") for s, t in zip(sections, texts)])
    log = known.select(key, F.struct(*[F.coalesce(F.col(t), F.lit("")).alias(s) for s, t in zip(sections, texts)]).alias("extracted_sections_data"))
    return papers, log
