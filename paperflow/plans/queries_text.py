"""Queries of sources, keys, text and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts, jsons, keys, text
from ..sources import files
from ..sources.buckets import shared_folder
from .corpus import ANNOTATED, ANSWERS, CURATED, PAPERS, sql_of, view
from .registry import query

C = F.col
P = f"WITH papers AS ({sql_of(PAPERS)})"
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
CLEAN = r"regexp_replace(lower(regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')), '^(doi:|https?://dx\.doi\.org/|https?://doi\.org/)', '')"
LINES = "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 5 = 0 THEN substring(props, 1, length(props) - 1) ELSE props END AS value FROM {events}"


def papers(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, PAPERS)


@query("read_jsonl_quarantine", f"WITH lines AS ({sql_of(LINES)}) SELECT CAST(json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.k') AS BIGINT) AS k, CASE WHEN NOT json_valid(value) THEN value END AS bad, count(*) AS n FROM lines WHERE value <> '' GROUP BY 1, 2")
def read_jsonl_quarantine(spark, d):
    path = shared_folder(spark, "jsonl")
    view(spark, d, LINES).select("value").write.text(path)
    good, bad = files.read_jsonl(spark, path, T.StructType([T.StructField("k", T.LongType())]))
    rows = good.select("k", F.lit(None).cast("string").alias("bad")).unionByName(bad.select(F.lit(None).cast("long").alias("k"), C("value").alias("bad")))
    return rows.groupBy("k", "bad").agg(F.count("*").alias("n"))


@query("write_jsonl", f"{P} SELECT seq, title, CAST(2 AS BIGINT) AS n FROM papers")
def write_jsonl(spark, d):
    path, rows = shared_folder(spark, "jsonl"), papers(spark, d).select("seq", "title")
    files.write_jsonl(rows, path)
    files.write_jsonl(rows, path, append=True)
    return spark.read.schema(rows.schema).json(path).groupBy("seq", "title").agg(F.count("*").alias("n"))


CSV_ROWS = "SELECT CAST(seq AS STRING) AS seq, doi, title, CASE WHEN seq % 5 = 0 THEN 'NA' ELSE journal END AS note FROM (" + PAPERS + ") p"


@query("read_curated_csv", f"WITH r AS ({sql_of(CSV_ROWS)}), c AS (SELECT {CLEAN.format('doi')} AS doi, title, note, CAST(seq AS BIGINT) AS seq FROM r) SELECT doi, title, note, CAST(seq AS VARCHAR) AS seq FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY seq) AS rn FROM c WHERE doi <> '') WHERE rn = 1")
def read_curated_csv(spark, d):
    path = shared_folder(spark, "csv")
    view(spark, d, CSV_ROWS).write.options(**files.CSV).csv(path)
    return files.read_curated_csv(spark, path, order="seq").select("doi", "title", "note", "seq")


XML = """SELECT doc_id AS seq, '<PubmedArticle><MedlineCitation><PMID>' || CAST(doc_id AS STRING) || '</PMID><Article><Journal><Title>' || source || '</Title><JournalIssue><PubDate>'
  || CASE WHEN doc_id % 2 = 0 THEN '<Year>' || CAST(2000 + doc_id % 20 AS STRING) || '</Year>' ELSE '<MedlineDate>' || CAST(1990 + doc_id % 9 AS STRING) || ' Jan-Feb</MedlineDate>' END || '</PubDate></JournalIssue></Journal><ArticleTitle>T' || CAST(n_chars AS STRING)
  || '</ArticleTitle><Abstract><AbstractText>' || replace(replace(replace(trim(regexp_replace('first ' || text, '[\\\\x00-\\\\x1F]+', ' ')), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</AbstractText><AbstractText>second</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><Initials>J' || CAST(doc_id % 3 AS STRING) || '</Initials></Author><Author><CollectiveName>Group</CollectiveName></Author></AuthorList><Language>'
  || lang || '</Language></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="pubmed">1</ArticleId><ArticleId IdType="doi">10.1/AB' || CAST(doc_id AS STRING) || '</ArticleId>' || CASE WHEN doc_id % 3 = 0 THEN '<ArticleId IdType="pmc">PMC' || CAST(doc_id AS STRING) || '</ArticleId>' ELSE '' END || '</ArticleIdList></PubmedData></PubmedArticle>' AS article FROM {documents}"""


@query("parse_article_xml", "SELECT doc_id AS seq, '10.1/ab' || doc_id AS doi, CAST(doc_id AS VARCHAR) AS pmid, CASE WHEN doc_id % 3 = 0 THEN 'PMC' || doc_id END AS pmcid, 'T' || n_chars AS title, trim(regexp_replace('first ' || text, '[\\x00-\\x1F]+', ' ', 'g')) AS abstract, CAST(CASE WHEN doc_id % 2 = 0 THEN 2000 + doc_id % 20 ELSE 1990 + doc_id % 9 END AS VARCHAR) AS year, source AS journal, 'Doe, J' || doc_id % 3 || '|Group' AS authors, lang AS language FROM documents")
def parse_article_xml(spark, d):
    rows = files.parse_article_xml(view(spark, d, XML), "article", "label", "2025-01-01")
    return rows.select("seq", "doi", "pmid", "pmcid", "title", "abstract", "year", "journal", F.array_join("authors", "|").alias("authors"), "language")


@query("embeddings_parquet", "SELECT vec_id AS doi, CAST(len(embedding) AS BIGINT) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM embeddings WHERE vec_id % 9 <> 0")
def embeddings_parquet(spark, d):
    path = shared_folder(spark, "vectors")
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select(C("vec_id").alias("doi"), F.when(C("vec_id") % 9 == 0, F.array().cast("array<float>")).otherwise(C("embedding")).alias("embedding"))
    files.write_embeddings(vectors, path)
    return files.read_embeddings(spark, path).select("doi", F.size("embedding").cast("long").alias("n"), F.round(C("embedding")[0].cast("double"), 6).alias("first"))


@query("export_flat_csv", 'SELECT \'10.1/\' || doc_id AS doi, CASE WHEN quality = 1 THEN \'true\' ELSE \'false\' END AS "llm_annot_classification.is_computational_methods_paper", CASE WHEN toxic = 1 THEN \'a, b\' ELSE \'b\' END AS llm_annot_pipeline_analysis_steps, \'[{"name":"n\' || doc_id || \'"}]\' AS llm_annot_compared_algorithms_packages FROM labels')
def export_flat_csv(spark, d):
    rows = spark.read.parquet(f"{d}/labels.parquet").select(
        F.concat(F.lit("10.1/"), "doc_id").alias("doi"),
        F.struct((C("quality") == 1).alias("is_computational_methods_paper")).alias("llm_annot_classification"),
        F.when(C("toxic") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"))).alias("llm_annot_pipeline_analysis_steps"),
        F.array(F.struct(F.concat(F.lit("n"), "doc_id").alias("name"))).alias("llm_annot_compared_algorithms_packages"),
    )
    path = shared_folder(spark, "flat")
    files.write_flat_csv(rows, path)
    shown = ("doi", "llm_annot_classification.is_computational_methods_paper", "llm_annot_pipeline_analysis_steps", "llm_annot_compared_algorithms_packages")
    return spark.read.option("header", True).option("escape", '"').csv(path).select(*[C(f"`{c}`") for c in shown])


@query("clean_doi", f"{P} SELECT seq, {CLEAN.format('doi')} AS doi FROM papers")
def clean_doi(spark, d):
    return papers(spark, d).select("seq", keys.clean_doi(C("doi")).alias("doi"))


LOOSE = "SELECT seq, doi || CASE seq % 3 WHEN 0 THEN '; x' WHEN 1 THEN ', 10.2/y' ELSE ' (note)' END AS doi FROM (" + PAPERS + ") p"


@query("clean_doi_loose", f"WITH r AS ({sql_of(LOOSE)}) SELECT seq, regexp_extract(regexp_replace({STRIP.format('lower(coalesce(doi, chr(32)))')}, '^(https?://)?(dx\\.)?doi\\.org/', ''), '^[^;, ]*') AS doi FROM r")
def clean_doi_loose(spark, d):
    return view(spark, d, LOOSE).select("seq", keys.clean_doi_loose(C("doi")).alias("doi"))


STOP = ", ".join(f"'{w}'" for w in keys.STOP_WORDS)


@query("normalize_title", rf"{P}, w AS (SELECT seq, string_split(regexp_replace(regexp_replace(regexp_replace(lower(title), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\p{{Nd}}+', '', 'g'), '\s+', ' ', 'g'), ' ') AS w FROM papers) SELECT seq, array_to_string(list_filter(w, lambda x: x <> '' AND x NOT IN ({STOP})), ' ') AS title FROM w")
def normalize_title(spark, d):
    return papers(spark, d).select("seq", keys.normalize_title(C("title")).alias("title"))


@query("normalize_authors", "SELECT doc_id AS seq, array_to_string(list_sort([lang || 'son', CASE WHEN doc_id % 2 = 0 THEN 'o' ELSE 'van der b' END]), '_') AS authors FROM documents")
def normalize_authors(spark, d):
    authors = F.array(F.concat(C("lang"), F.lit("Son, J. K.")), F.when(C("doc_id") % 2 == 0, "O'Hara").otherwise("Van der B, X"), F.lit(" ,"))
    return spark.read.parquet(f"{d}/documents.parquet").select(C("doc_id").alias("seq"), keys.normalize_authors(authors).alias("authors"))


@query("truncate_text", f"{P} SELECT seq, substring(nullif({STRIP.format('abstract')}, ''), 1, 200) AS abstract FROM papers")
def truncate_text(spark, d):
    return papers(spark, d).select("seq", text.truncate_text(C("abstract"), 200).alias("abstract"))


@query("annotation_to_text", "SELECT doc_id AS seq, CASE quality WHEN 1 THEN 'Yes' ELSE 'No' END AS flag, CASE WHEN toxic = 1 THEN 'x y' ELSE 'y' END AS list, CASE WHEN doc_id % 2 = 0 THEN 'n' || doc_id ELSE 'n' || doc_id || ' v' END AS objects, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'd' || doc_id END AS plain FROM labels")
def annotation_to_text(spark, d):
    rows = spark.read.parquet(f"{d}/labels.parquet").select(
        C("doc_id").alias("seq"), (C("quality") == 1).alias("flag"), F.array(F.when(C("toxic") == 1, "x").otherwise(""), F.lit("y")).alias("list"),
        F.array(F.struct(F.concat(F.lit(" n"), "doc_id").alias("name"), F.when(C("doc_id") % 2 == 0, "N/A").otherwise("v").alias("details"))).alias("objects"),
        F.when(C("doc_id") % 3 == 0, "None").otherwise(F.concat(F.lit("d"), "doc_id")).alias("plain"),
    )
    return rows.select("seq", *[text.annotation_to_text(C(c), rows.schema[c].dataType).alias(c) for c in ("flag", "list", "objects", "plain")])


LISTS = "SELECT doc_id AS seq, CASE doc_id % 4 WHEN 0 THEN '[''' || lang || ''', ''' || source || ''']' WHEN 1 THEN lang || ' , ' || source || ',' WHEN 2 THEN lang ELSE NULL END AS value FROM {documents}"


@query("parse_list_text", "SELECT doc_id AS seq, CASE doc_id % 4 WHEN 2 THEN lang WHEN 3 THEN '' ELSE lang || '|' || source END AS items FROM documents")
def parse_list_text(spark, d):
    return view(spark, d, LISTS).select("seq", F.array_join(text.parse_list_text(C("value")), "|").alias("items"))


@query("split_multi", f"WITH c AS ({sql_of(CURATED)}) SELECT seq, CASE WHEN quality = 1 THEN 'computational analysis - method|review' ELSE 'dataset' END AS categories, CASE WHEN toxic = 1 THEN 'clustering|alignment' ELSE '' END AS pipelines FROM c")
def split_multi(spark, d):
    return view(spark, d, CURATED).select("seq", F.array_join(text.split_multi(C("category")), "|").alias("categories"), F.array_join(text.split_multi(C("pipeline_category")), "|").alias("pipelines"))


BOOLS = """SELECT event_id AS seq, CASE event_id % 6 WHEN 0 THEN 'true' WHEN 1 THEN '"True"' WHEN 2 THEN 'false' WHEN 3 THEN '1' WHEN 4 THEN '"yes"' ELSE 'null' END AS value FROM {events}"""


@query("coerce_bool", "SELECT event_id AS seq, event_id % 6 IN (0, 3) AS truthy, event_id % 6 = 0 AS strict, event_id % 6 IN (0, 1) AS repaired FROM events")
def coerce_bool(spark, d):
    v = F.try_parse_json("value")
    return view(spark, d, BOOLS).select("seq", casts.truthy_text(C("value")).alias("truthy"), casts.strict_bool(v).alias("strict"), casts.repaired_bool(v).alias("repaired"))


@query("coerce_num_date", "SELECT event_id AS seq, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS BIGINT) END AS year, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE CAST(user_id AS DOUBLE) END AS score, CASE WHEN event_id % 4 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events")
def coerce_num_date(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(C("event_id").alias("seq"), F.when(C("event_id") % 3 == 0, "n.d.").otherwise(C("user_id").cast("string")).alias("n"), F.when(C("event_id") % 4 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("t"))
    return e.select("seq", casts.whole_number(C("n")).alias("year"), casts.number(C("n"), 0).alias("score"), F.date_format(casts.moment(C("t")), "yyyy-MM-dd").alias("day"))


@query("flatten_struct", "SELECT doc_id AS seq, CAST(quality AS BIGINT) AS llm_annot_c_quality, CAST(toxic AS BIGINT) AS llm_annot_c_toxic FROM labels")
def flatten_struct(spark, d):
    rows = spark.read.parquet(f"{d}/labels.parquet").select(C("doc_id").alias("seq"), F.struct(C("quality").cast("long").alias("quality"), C("toxic").cast("long").alias("toxic")).alias("c"))
    return jsons.flatten_struct(rows, "c", "llm_annot_")


@query("nest_columns", "SELECT doc_id AS seq, '{\"quality\":' || quality || ',\"toxic\":' || toxic || '}' AS c FROM labels")
def nest_columns(spark, d):
    flat = flatten_struct(spark, d)
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("c", T.StructType([T.StructField("quality", T.LongType()), T.StructField("toxic", T.LongType())]))])
    return jsons.nest_columns(flat, schema, "llm_annot_").select("seq", F.to_json("c").alias("c"))


@query("parse_llm_json", "SELECT event_id AS seq, CASE WHEN event_id % 5 < 3 THEN 'success' ELSE 'llm_error_json_parse' END AS status, CASE WHEN event_id % 5 < 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def parse_llm_json(spark, d):
    value, status = jsons.parse_llm_json(C("answer"))
    return view(spark, d, ANSWERS).select("seq", value.alias("v"), status.alias("status")).select("seq", "status", F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query("project_schema_keys", "SELECT event_id AS seq, CASE WHEN event_id % 5 < 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS llm_annot_k, CASE WHEN event_id % 5 < 3 THEN 'success' ELSE 'llm_error_json_parse' END AS llm_annotation_status, '2025-01-01' AS llm_annotation_timestamp, CASE WHEN event_id % 5 >= 3 THEN 'llm_error_json_parse' END AS llm_annotation_error, 'm' AS llm_model_used, CASE WHEN event_id % 5 < 3 THEN 70.0::DOUBLE ELSE 0.0::DOUBLE END AS annotation_score FROM events")
def project_schema_keys(spark, d):
    rows = view(spark, d, ANSWERS).withColumn("state", jsons.parse_llm_json(C("answer"))[1]).withColumn("llm_annot_old", F.lit(1))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("classification", T.StructType([T.StructField("flag", T.BooleanType())]))])
    out = jsons.project_schema_keys(rows, "answer", schema, "state", "2025-01-01", "m", score=70.0)
    return out.select("seq", "llm_annot_k", "llm_annotation_status", "llm_annotation_timestamp", "llm_annotation_error", "llm_model_used", "annotation_score")


@query("clean_llm_fields", f"""WITH a AS ({sql_of(ANNOTATED)}) SELECT seq, CASE seq % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS is_computational, CASE seq % 6 WHEN 0 THEN '["a","b"]' ELSE '[]' END AS categories, CASE seq % 3 WHEN 0 THEN '["s1","s2"]' ELSE '[]' END AS steps, CASE seq % 4 WHEN 0 THEN 'Available' WHEN 1 THEN 'Unclear' END AS code_status, CASE WHEN seq % 4 = 0 THEN 'https://x' END AS code_link FROM a""")
def clean_llm_fields(spark, d):
    f = jsons.clean_llm_fields(F.try_parse_json("annotation"))
    return view(spark, d, ANNOTATED).select("seq", f["is_computational"].alias("is_computational"), f["assigned_categories"].alias("categories"), f["pipeline_analysis_steps"].alias("steps"), f["code_status"].alias("code_status"), f["code_link"].alias("code_link"))


SECTIONED = "SELECT doc_id AS seq, CASE WHEN doc_id % 13 = 0 THEN '' ELSE '10.1/' || CAST(doc_id AS STRING) END AS doi, CASE WHEN doc_id % 2 = 0 THEN 'm ' || text || ' e' END AS extracted_methods_section, CASE WHEN doc_id % 3 = 0 THEN 'c' END AS extracted_conclusion_section FROM {documents}"


@query("split_sections_log", "SELECT '10.1/' || doc_id AS doi, doc_id AS seq, doc_id % 2 = 0 AS has_methods_section, doc_id % 3 = 0 AS has_conclusion_section, CASE WHEN doc_id % 2 = 0 THEN 'm ' || text || ' e' ELSE '' END AS methods, CASE WHEN doc_id % 3 = 0 THEN 'c' ELSE '' END AS conclusion FROM documents WHERE doc_id % 13 <> 0")
def split_sections_log(spark, d):
    kept, log = jsons.split_sections_log(view(spark, d, SECTIONED), ("methods", "conclusion"))
    return kept.join(log, "doi").select("doi", "seq", "has_methods_section", "has_conclusion_section", "extracted_sections_data.*")


@query("build_prompt", f"""{P} SELECT seq, 'Extract.' || chr(10) || chr(10) || '# Paper' || chr(10) || 'Title: ' || title || chr(10) || 'Abstract: ' || coalesce(substring(nullif({STRIP.format('abstract')}, ''), 1, 2000), 'N/A') || chr(10) || chr(10) || CASE WHEN seq % 2 = 0 THEN '# Full text' || chr(10) || '## Methods Section' || chr(10) || 'we did' ELSE '# Full text' || chr(10) || '{text.NO_SECTIONS}' END || chr(10) || chr(10) || '# Answer' || chr(10) || '{{}}' AS prompt FROM papers""")
def build_prompt(spark, d):
    methods = F.when(C("seq") % 2 == 0, " we did ")
    return papers(spark, d).select("seq", text.build_prompt("Extract.", "{}", C("title"), C("abstract"), {"methods": methods}).alias("prompt"))


def _each(pattern: str, to: str, sql: str) -> str:
    return STRIP.format(f"regexp_replace({sql}, '{pattern}', '{to}', 'g')")


JOINED = _each(r"\s*\.\s*", ". ", _each(r"\s*\.\s*\.", ". ", _each(r"\s+", " ", "title || '. ' || abstract || '. '")))


@query("prepare_embedding_text", f"{P} SELECT seq, {JOINED} AS text FROM papers")
def prepare_embedding_text(spark, d):
    return papers(spark, d).select("seq", text.embedding_text([C("title"), C("abstract"), F.lit("")]).alias("text"))
