"""Queries of whole workloads."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import jobs
from .corpus import ATTEMPTS, PAPERS, view
from .queries_tables import FIRST, GROUPS, HIT, NOW, VALUES
from .queries_text import P, STRIP, papers
from .registry import query

C = F.col


@query("top_labels", f"{FIRST}, t AS (SELECT seq, lower(title || ' ' || abstract) AS text FROM one), {VALUES}, hits AS (SELECT DISTINCT seq, label FROM t, v WHERE {HIT}) SELECT label, count(*) AS count FROM hits WHERE label IN ('english', 'spanish') AND seq IN (SELECT seq FROM hits WHERE label = 'english') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_labels(spark, d):
    return jobs.ingest(view(spark, d, PAPERS), GROUPS, "seq")[1]


SCHEMA = T.StructType([T.StructField("classification", T.StructType([T.StructField("flag", T.BooleanType())])), T.StructField("n", T.LongType())])


@query("annotation_run", f"""{P} SELECT '10.1000/u' || seq AS doi, seq % 4 <> 0 AS is_new, CASE WHEN seq % 4 <> 0 THEN length(title) + coalesce(length(substring(nullif({STRIP.format('abstract')}, ''), 1, 2000)), 3) END AS llm_annot_n, 'success' AS llm_annotation_status FROM papers""")
def annotation_run(spark, d):
    """Prompts from titles and abstracts of whole documents, and the sections of the best attempt; the annotator counts letters."""

    def annotator(prompt: str) -> str:
        title, rest = prompt.split("Title: ", 1)[1].split("\nAbstract: ", 1)
        return f"```json\n{json.dumps({'n': len(title) + len(rest.split(chr(10) * 2 + '# Full text' + chr(10), 1)[0]), 'other': 1})}\n```"

    docs = papers(spark, d).select(F.concat(F.lit("10.1000/u"), "seq").alias("doi"), "title", "abstract", "seq")
    existing = docs.select("doi", F.when(C("seq") % 4 == 0, "success").otherwise("failed").alias("llm_annotation_status"))
    done, _ = jobs.annotate(docs.drop("seq"), view(spark, d, ATTEMPTS), existing, annotator, SCHEMA, "seq", NOW, "m")
    return done.select("doi", C("llm_annot_n").isNotNull().alias("is_new"), "llm_annot_n", "llm_annotation_status")


@query("similarity_graph", """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), m AS (SELECT label, list(value ORDER BY place) AS c FROM (SELECT label, place, avg(value) AS value FROM (SELECT label, unnest(range(64)) AS place, unnest(v) AS value FROM e) GROUP BY 1, 2) GROUP BY 1),
n AS (SELECT vec_id, max_by(CAST(m.label AS VARCHAR), list_cosine_similarity(v, c)) AS category FROM e, m GROUP BY 1), k AS (SELECT a.vec_id AS source, b.vec_id AS target, list_cosine_similarity(a.v, b.v) AS w, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.vec_id) AS rn FROM (SELECT e.*, category FROM e JOIN n USING (vec_id)) a JOIN e b ON a.vec_id <> b.vec_id)
SELECT category, count(*) AS edges FROM k JOIN n ON n.vec_id = source WHERE rn <= 10 AND w >= 0.3 AND source < target GROUP BY 1""")
def similarity_graph(spark, d):
    """Edges of each category's papers."""
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    papers, edges = jobs.similarity_graph(rows, rows.select("vec_id"), "vec_id", C("label").cast("string"), 0.6, 0.3, 0.3)
    return edges.join(papers.select(C("vec_id").alias("source"), "category"), "source").groupBy("category").agg(F.count("*").alias("edges"))
