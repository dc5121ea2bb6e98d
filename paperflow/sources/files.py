"""JSON Lines, CSV, Parquet and XML, with fixed schemas."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import clean_doi
from ..operators.dedupe import keep_first

CORRUPT = "_corrupt_record"
#: CSV that is read back as it was written: quotes are doubled, and white space at the ends of a value belongs to it (Spark's writer would cut it). Empty text is written in quotes, null as nothing.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: The flat table that is published, in order.
PUBLISHED = (
    "doi", "pmid", "title", "abstract", "year", "journal", "annotation_score", "manual_annotation_status", "manual_annotation_timestamp", "mark_for_deletion",
    "llm_annot_main_goal_of_paper", "llm_annot_classification.is_computational_methods_paper", "llm_annot_classification.primary_application_domain", "llm_annot_classification.assigned_categories",
    "llm_annot_llm_notes", "llm_annot_package_algorithm_name", "llm_annot_pipeline_analysis_steps", "llm_annot_tested_data_modalities", "llm_annot_tested_assay_types_platforms",
    "llm_annot_compared_algorithms_packages", "llm_annot_code_availability_details.status", "llm_annot_code_availability_details.link", "llm_annot_code_availability_details.license",
    "llm_annot_code_availability_details.version", "llm_annot_data_used_details", "llm_annot_primary_programming_languages", "llm_annot_llm_notes_detailed",
)

ARTICLE = (
    "MedlineCitation struct<PMID string, Article struct<ArticleTitle string, Abstract struct<AbstractText array<string>>, "
    "Journal struct<Title string, JournalIssue struct<PubDate struct<Year string, MedlineDate string>>>, "
    "AuthorList struct<Author array<struct<LastName string, Initials string, CollectiveName string>>>, Language string, "
    "PublicationTypeList struct<PublicationType array<string>>>, "
    "MeshHeadingList struct<MeshHeading array<struct<DescriptorName string>>>, KeywordList struct<Keyword array<string>>>, "
    "PubmedData struct<ArticleIdList struct<ArticleId array<struct<_IdType string, _VALUE string>>>>"
)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines): malformed lines are set aside, blank ones skipped; a missing path gives empty tables."""
    lines = T.StructType([T.StructField("value", T.StringType())])
    try:
        text = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        text = spark.createDataFrame([], lines)
    return split_json(text.where(F.trim("value") != ""), "value", schema)


def split_json(df: DataFrame, value: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The same for a column of JSON texts; other columns stay beside the parsed ones."""
    wide = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    parsed = df.withColumn("_row", F.from_json(value, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    others = [c for c in df.columns if c != value]
    bad = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_row").isNull()
    return parsed.where(~bad).select(*others, *[f"_row.{f.name}" for f in schema]), parsed.where(bad).select(*others, value)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def read_curated_csv(spark: SparkSession, path: str, key: str = "doi", order: str | None = None) -> DataFrame:
    """All columns as text, keys cleaned, the first row of each key; rows without a key go. `order` names a column that gives the order of rows.

    A value of nothing is null, one of two quotes is empty text: Spark takes
    both for null where its null value is empty, so it gets one that no file holds.
    """
    df = spark.read.options(**CSV).option("multiLine", True).option("nullValue", uuid.uuid4().hex).csv(path)
    return curated(df, key, order)


def curated(df: DataFrame, key: str = "doi", order: str | None = None) -> DataFrame:
    cleaned = df.withColumn(key, clean_doi(F.col(key))).where(F.col(key) != "")
    if order is None:
        return keep_first(cleaned.withColumn("_order", F.monotonically_increasing_id()), key, "_order").drop("_order")
    return keep_first(cleaned, key, F.col(order).try_cast("bigint"))


def article_columns(article: Column, query_label: str, scrape_date: str) -> dict[str, Column]:
    """Columns of a raw paper from a parsed article (see ARTICLE)."""
    cited, art = article["MedlineCitation"], article["MedlineCitation"]["Article"]
    ids = article["PubmedData"]["ArticleIdList"]["ArticleId"]
    of_type = lambda kind: F.get(F.filter(ids, lambda x: x["_IdType"] == kind), F.lit(0))["_VALUE"]
    date = art["Journal"]["JournalIssue"]["PubDate"]
    author = lambda a: F.coalesce(F.when(a["LastName"].isNotNull(), F.concat_ws(", ", a["LastName"], a["Initials"])), a["CollectiveName"])
    no_text = F.array().cast("array<string>")
    return {
        "doi": F.lower(of_type("doi")),
        "pmid": cited["PMID"],
        "pmcid": of_type("pmc"),
        "title": art["ArticleTitle"],
        "abstract": F.get(art["Abstract"]["AbstractText"], F.lit(0)),
        "year": F.coalesce(date["Year"], F.nullif(F.regexp_extract(date["MedlineDate"], r"^\d{4}", 0), F.lit(""))),
        "journal": art["Journal"]["Title"],
        "authors": F.coalesce(F.filter(F.transform(art["AuthorList"]["Author"], author), lambda x: x.isNotNull()), no_text),
        "mesh_terms": F.coalesce(F.transform(cited["MeshHeadingList"]["MeshHeading"], lambda x: x["DescriptorName"]), no_text),
        "author_keywords": F.coalesce(cited["KeywordList"]["Keyword"], no_text),
        "publication_types": F.coalesce(art["PublicationTypeList"]["PublicationType"], no_text),
        "language": art["Language"],
        "source": F.lit("pubmed"),
        "query_label": F.lit(query_label),
        "scrape_date": F.lit(scrape_date),
    }


def parse_article_xml(df: DataFrame, xml: str, query_label: str, scrape_date: str) -> DataFrame:
    """Raw papers from a column of article elements, beside the other columns."""
    parsed = df.withColumn("_article", F.from_xml(xml, ARTICLE, {"rowTag": "PubmedArticle"}))
    return parsed.select(*[c for c in df.columns if c != xml], *[v.alias(k) for k, v in article_columns(F.col("_article"), query_label, scrape_date).items()])


def read_article_xml(spark: SparkSession, path: str, query_label: str, scrape_date: str) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(ARTICLE).load(path)
    return rows.select(*[v.alias(k) for k, v in article_columns(F.struct("*"), query_label, scrape_date).items()])


def write_embeddings(df: DataFrame, path: str, key: str = "doi") -> None:
    df.select(key, F.col("embedding").cast("array<float>").alias("embedding")).write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return non_empty(spark.read.parquet(path))


def non_empty(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0))


def flat_table(df: DataFrame, order: tuple[str, ...] = PUBLISHED) -> DataFrame:
    """Structs as column.field columns, lists of text joined by commas, lists of structs as JSON; exactly the columns of `order`, null where there is none."""
    flat: dict[str, Column] = {}
    for f in df.schema:
        if isinstance(f.dataType, T.StructType):
            for g in f.dataType:
                flat[f"{f.name}.{g.name}"] = flat_value(F.col(f"`{f.name}`")[g.name], g.dataType)
        else:
            flat[f.name] = flat_value(F.col(f"`{f.name}`"), f.dataType)
    return df.select(*[flat.get(c, F.lit(None).cast("string")).alias(c) for c in order])


def flat_value(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.array_join(c, ", ")
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else c


def write_flat_csv(df: DataFrame, path: str) -> None:
    flat_table(df).write.mode("overwrite").options(**CSV).csv(path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")
