"""The corpus as views of the given tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: {name} stands for a given table.
PAPERS = """SELECT doc_id AS seq,
  CASE WHEN doc_id % 17 = 16 THEN NULL ELSE CASE doc_id % 4 WHEN 0 THEN '10.1000/P' WHEN 1 THEN 'doi:10.1000/P' WHEN 2 THEN 'https://doi.org/10.1000/P' ELSE ' HTTP://DX.DOI.ORG/10.1000/P' END
    || CAST(CASE WHEN doc_id % 10 = 9 THEN doc_id - 9 ELSE doc_id END AS STRING) END AS doi,
  split_part(text, chr(10), 1) AS title, substring(text, length(split_part(text, chr(10), 1)) + 2) AS abstract,
  CAST(2005 + doc_id % 21 AS INT) AS year, source AS journal, lang AS language, n_chars FROM {documents}"""
#: Curated rows: a key as in PAPERS, cleaned; categories from labels.
CURATED = """SELECT '10.1000/p' || CAST(doc_id AS STRING) AS doi, doc_id AS seq, CASE WHEN quality = 1 THEN 'computational analysis - method;review' ELSE 'dataset' END AS category,
  CASE WHEN toxic = 1 THEN 'clustering; ;alignment' ELSE '' END AS pipeline_category, 'tool' || CAST(doc_id % 7 AS STRING) AS name, quality, toxic FROM {labels}"""
#: The same with a second, later row of every third key and one without a place in the order.
REPEATED = "SELECT * FROM (" + CURATED + ") WHERE seq % 5 <> 4 UNION ALL SELECT doi, seq + 1 AS seq, 'later' AS category, pipeline_category, 'later ' || name AS name, quality, toxic FROM (" + CURATED + ") WHERE seq % 3 = 0 UNION ALL SELECT doi, NULL AS seq, 'nowhere' AS category, pipeline_category, 'nowhere' AS name, quality, toxic FROM (" + CURATED + ") WHERE seq % 5 >= 3"
#: An attempt log: many rows for each user.
ATTEMPTS = """SELECT '10.1000/u' || CAST(user_id AS STRING) AS doi, event_id AS seq, ts AS extracted_at_timestamp, value > 50 AS is_open_access, event_type AS full_text_access_type,
  CASE event_type WHEN 'purchase' THEN 'Extracted from PDF (sections found)' WHEN 'click' THEN 'Extracted from HTML (sections found)' WHEN 'view' THEN 'OA_pdf_link' WHEN 'signup' THEN 'General Error' ELSE 'General Error: timeout' END AS section_extraction_status,
  CASE WHEN event_id % 3 = 0 THEN ' ' WHEN event_id % 3 = 1 THEN 'intro ' || props ELSE NULL END AS extracted_introduction_section,
  CASE WHEN event_id % 4 = 0 THEN 'methods' END AS extracted_methods_section, CAST(NULL AS STRING) AS extracted_results_discussion_section, CAST(NULL AS STRING) AS extracted_conclusion_section,
  CAST(NULL AS STRING) AS extracted_code_availability_section, CAST(NULL AS STRING) AS extracted_data_availability_section FROM {events}"""
#: Model answers: plain, fenced and broken JSON.
ANSWERS = """SELECT event_id AS seq, '10.1000/u' || CAST(user_id AS STRING) AS doi,
  CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN 2 THEN '```' || chr(10) || props || '```' WHEN 3 THEN 'Sure: ' || props ELSE substring(props, 1, length(props) - 1) END AS answer FROM {events}"""
#: Annotated papers: JSON with every kind of defect.
ANNOTATED = """SELECT event_id AS seq, '10.1000/u' || CAST(user_id AS STRING) AS doi, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 3 = 0 THEN 'detailed_llm_annotated' ELSE 'middle_llm_annotated' END AS llm_annotation_status, value AS annotation_score,
  '{{"classification": ' || CASE event_id % 6 WHEN 0 THEN '{{"is_computational_methods_paper": true, "assigned_categories": ["a", "b"]}}' WHEN 1 THEN '{{"is_computational_methods_paper": "True", "assigned_categories": "a"}}'
    WHEN 2 THEN '{{"is_computational_methods_paper": false}}' WHEN 3 THEN '{{"is_computational_methods_paper": 1, "assigned_categories": []}}' WHEN 4 THEN '"none"' ELSE 'null' END
  || ', "pipeline_analysis_steps": ' || CASE event_id % 3 WHEN 0 THEN '["s1", "s2"]' WHEN 1 THEN '"s1"' ELSE 'null' END
  || ', "code_availability_details": ' || CASE event_id % 4 WHEN 0 THEN '{{"status": "Available", "link": "https://x"}}' WHEN 1 THEN '"yes"' ELSE '{{"status": null}}' END || '}}' AS annotation FROM {events}"""
#: A pool of weak annotations.
POOL = """SELECT o_orderkey AS seq, '10.1000/o' || CAST(o_orderkey AS STRING) AS doi, CASE o_orderpriority WHEN '1-URGENT' THEN 'highly_relevant' WHEN '2-HIGH' THEN 'relevant' WHEN '3-MEDIUM' THEN 'uncertain' WHEN '4-NOT SPECIFIED' THEN 'low_relevance' ELSE 'irrelevant' END AS relevance_score,
  c_mktsegment AS paper_type, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS llm_model, o_orderdate AS queried FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
#: A master table with scores, and new annotations of part of it.
MASTER = """SELECT '10.1000/c' || CAST(c_custkey AS STRING) AS doi, CAST(c_custkey % 5 AS DOUBLE) AS annotation_score, c_mktsegment AS annotation FROM {customer} WHERE c_custkey % 3 <> 0"""
FRESH = """SELECT '10.1000/c' || CAST(CASE WHEN c_custkey % 6 = 4 THEN c_custkey - 2 ELSE c_custkey END AS STRING) AS doi, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(2 AS DOUBLE) END AS annotation_score,
  'new ' || c_mktsegment || CAST(c_custkey AS STRING) AS annotation, CASE WHEN c_custkey % 12 = 2 THEN NULL ELSE c_custkey END AS seq FROM {customer} WHERE c_custkey % 2 = 0"""
#: Links between papers.
LINKS = "SELECT l_partkey AS source, l_suppkey AS target FROM {lineitem}"

TABLE = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view above as a DataFrame; only the columns that a job uses are read."""
    names = set(TABLE.findall(sql))
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def sql_of(sql: str) -> str:
    """The same for an engine that knows the tables by name."""
    return TABLE.sub(r"\1", sql.replace("{{", "\0").replace("}}", "\1")).replace("\0", "{").replace("\1", "}")
