"""Queries of filters, duplicates, increments, vocabularies and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import clean_doi
from ..operators import dedupe, filters, incremental, merge, vocabulary
from ..sources.buckets import BucketTable, shared_folder
from .corpus import ANNOTATED, ATTEMPTS, CURATED, FRESH, LINKS, MASTER, POOL, REPEATED, sql_of, view
from .queries_text import CLEAN, P, papers
from .registry import SQL, query

C = F.col
PC = f"{P}, clean AS (SELECT * REPLACE ({CLEAN.format('doi')} AS doi) FROM papers WHERE {CLEAN.format('doi')} <> '')"
FIRST = f"{PC}, one AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY seq) AS rn FROM clean) WHERE rn = 1)"
FLAG = "CASE seq % 3 WHEN 0 THEN true WHEN 1 THEN false END"
NOW = "2025-01-01"
#: In SQL a missing place is written as a number: with NULLS LAST the other engine's first row of a group varied from run to run.
LAST = f"cur AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY coalesce(seq, -1) DESC) AS rn FROM ({sql_of(REPEATED)})) WHERE rn = 1)"


def flag(seq="seq"):
    return F.when(C(seq) % 3 == 0, True).when(C(seq) % 3 == 1, False)


def cleaned(spark, d):
    return papers(spark, d).withColumn("doi", clean_doi(C("doi"))).where("doi <> ''")


@query("clean_corpus", f"{PC} SELECT doi, '' AS pmid, title, abstract, CAST(year AS VARCHAR) AS year, '' AS authors, journal, seq, language, n_chars FROM clean")
def clean_corpus(spark, d):
    return filters.clean_corpus(papers(spark, d).withColumn("extracted_methods_section", F.lit("x")))


@query("domain_filter_score", f"{P} SELECT seq, 50.0::DOUBLE AS annotation_score, 'keyword_filtered_and_scored' AS pipeline_category FROM papers WHERE seq % 3 = 0")
def domain_filter_score(spark, d):
    return filters.domain_filter_score(papers(spark, d).withColumn("kw_domain_inclusion", flag())).select("seq", "annotation_score", "pipeline_category")


@query("domain_filter_increment", f"{P} SELECT seq, 100.0::DOUBLE AS relevance_score, CASE WHEN seq % 2 = 0 THEN 50 + seq ELSE 50 END::DOUBLE AS annotation_score FROM papers WHERE seq % 3 = 0")
def domain_filter_increment(spark, d):
    rows = papers(spark, d).withColumn("kw_domain_inclusion", flag()).withColumn("annotation_score", F.when(C("seq") % 2 == 0, C("seq").cast("string")).otherwise("none"))
    return filters.domain_filter_increment(rows).select("seq", "relevance_score", "annotation_score")


@query("split_by_class", f"{P} SELECT seq, CASE seq % 3 WHEN 0 THEN 'computational' ELSE 'other' END AS class FROM papers WHERE seq % 3 < 2")
def split_by_class(spark, d):
    yes, no = filters.split_by_class(papers(spark, d).withColumn("flag", flag()), "flag")
    return yes.select("seq", F.lit("computational").alias("class")).unionByName(no.select("seq", F.lit("other").alias("class")))


@query("search_corpus", f"{P} SELECT seq, title, year, journal FROM papers WHERE (contains(lower(title), 'the th') OR contains(lower(abstract), 'the th')) AND year IN (2006, 2007, 2010) AND journal IN ('src1', 'src2', 'src3', 'src4', 'src5')")
def search_corpus(spark, d):
    return filters.search_corpus(papers(spark, d), "the TH", [2006, 2007, 2010], ["src1", "src2", "src3", "src4", "src5"]).select("seq", "title", "year", "journal")


@query("search_any_column", f"{P} SELECT seq, journal FROM papers WHERE contains(lower(coalesce(doi, '')), 'p1') OR contains(CAST(seq AS VARCHAR), 'p1') OR contains(lower(journal), 'p1') OR contains(lower(title), 'p1')")
def search_any_column(spark, d):
    return filters.search_any_column(papers(spark, d).select("seq", "doi", "journal", "title"), "P1").select("seq", "journal")


@query("filter_nodes", f"{P} SELECT seq, year FROM papers WHERE year BETWEEN 2008 AND 2015 AND (seq % 2 = 0 OR language = 'en') ORDER BY seq LIMIT 100")
def filter_nodes(spark, d):
    rows = papers(spark, d).withColumn("labels", F.array("language", F.when(C("seq") % 2 == 0, "even").otherwise("odd")))
    return filters.filter_nodes(rows, (2008, 2015), {"labels": ["even", "en"]}, "seq", 100).select("seq", "year")


@query("class_review_report", f"{P} SELECT doi, title, language AS primary_domain, language || ', ' || journal AS categories FROM papers WHERE seq % 2 = 0 AND seq % 3 = 1")
def class_review_report(spark, d):
    rows = papers(spark, d).withColumn("llm_annotation_status", F.when(C("seq") % 2 == 0, "success").otherwise("failed"))
    rows = rows.withColumn("c", F.struct(flag().alias("flag"), C("language").alias("domain"), F.array("language", "journal").alias("categories")))
    return filters.class_review_report(rows, C("c.flag"), {"doi": C("doi"), "title": C("title"), "primary_domain": C("c.domain"), "categories": F.array_join("c.categories", ", ")})


@query("drop_prefixed_columns", f"{P} SELECT seq, language AS kw_tissue FROM papers")
def drop_prefixed_columns(spark, d):
    return filters.drop_prefixed_columns(papers(spark, d).select("seq", C("language").alias("kw_tissue"), C("title").alias("kw_detail_a"), C("title").alias("kw_detail_b")))


def in_order(way: str) -> str:
    """One row per key by a place in the order that many rows, and all rows of some keys, lack."""
    place = "CASE WHEN seq % 4 < 2 THEN NULL ELSE seq END"
    return f"{PC}, o AS (SELECT doi, {place} AS place, CASE WHEN seq % 10 = 9 THEN title ELSE 'first' END AS title FROM clean) SELECT doi, place, coalesce(title, '') AS title, 0.0::DOUBLE AS annotation_score FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY coalesce(place, {'-1' if way == 'DESC' else '4000000000'}) {way}, title {way}) AS rn FROM o) WHERE rn = 1"


def unordered(spark, d):
    rows = cleaned(spark, d).withColumn("place", F.when(C("seq") % 4 >= 2, C("seq")))
    return filters.with_score(rows.select("doi", "place", F.when(C("seq") % 10 == 9, C("title")).otherwise("first").alias("title")))


@query("dedupe_keep_first", in_order("ASC"))
def dedupe_keep_first(spark, d):
    return dedupe.keep_first(unordered(spark, d), "doi", "place", "title")


@query("dedupe_keep_last", in_order("DESC"))
def dedupe_keep_last(spark, d):
    return dedupe.keep_last(unordered(spark, d), "doi", "place", "title")


@query("sample_n", f"{P} SELECT seq, title FROM papers ORDER BY md5('42|' || seq), seq LIMIT 80")
def sample_n(spark, d):
    return dedupe.sample_n(papers(spark, d).select("seq", "title"), "seq", 80)


EXISTING = "SELECT seq, CASE WHEN seq % 4 = 0 THEN 'success' ELSE 'failed' END AS status FROM ({papers}) WHERE seq % 2 = 0"


@query("select_unprocessed", f"{P} SELECT seq, CASE WHEN seq % 4 = 0 THEN 'success' WHEN seq % 2 = 0 AND n_chars > 1000 THEN NULL ELSE 'new' END AS status, CASE WHEN seq % 2 = 0 AND n_chars > 1000 THEN title END AS introduction FROM papers")
def select_unprocessed(spark, d):
    rows = papers(spark, d).select("seq", "n_chars", "title")
    existing = rows.where("seq % 2 = 0").select("seq", F.when(C("seq") % 4 == 0, "success").when(C("n_chars") <= 1000, "failed").alias("status"), F.when(C("n_chars") > 1000, C("title")).alias("introduction"))
    new = incremental.select_unprocessed(rows.select("seq"), existing, "seq", "status", filled="introduction").withColumn("status", F.lit("new"))
    return incremental.with_finished(existing, new, "status", filled="introduction")


@query("select_for_annotation", f"WITH pool AS ({sql_of(POOL)}) SELECT doi, relevance_score FROM pool WHERE relevance_score <> 'irrelevant' AND seq % 3 <> 0")
def select_for_annotation(spark, d):
    pool = view(spark, d, POOL)
    return incremental.select_for_annotation(pool, pool.where("seq % 3 = 0")).select("doi", "relevance_score")


@query("incremental_sections", f"{FIRST} SELECT doi, CAST(seq AS VARCHAR) AS pmid, CASE WHEN seq % 2 = 0 THEN title ELSE 'old' END AS extracted_methods_section, seq % 2 = 1 AS sections_extracted_successfully FROM one WHERE doi NOT IN (SELECT doi FROM one WHERE seq % 2 = 1) OR seq % 2 = 1")
def incremental_sections(spark, d):
    raw = cleaned(spark, d).withColumn("pmid", C("seq").cast("string")).withColumn("extracted_methods_section", C("title"))
    first = dedupe.keep_first(raw.select("doi", "seq", "pmid"), "doi", "seq").where("seq % 2 = 1")
    existing = first.select("doi", "pmid", F.lit("old").alias("extracted_methods_section"), F.lit(True).alias("sections_extracted_successfully"))
    return incremental.incremental_sections(raw, existing, "seq")


@query("merge_new_candidates", f"""{PC}, c AS (SELECT doi, seq, 0 AS r, 'curated' AS found_via FROM clean WHERE seq % 5 = 0 UNION ALL SELECT doi, seq, 1, 'keyword' FROM clean WHERE seq % 3 = 0 UNION ALL SELECT doi, seq, 2, 'similar' FROM clean)
SELECT doi, seq, found_via FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY r, seq) AS rn FROM c WHERE doi NOT IN (SELECT doi FROM clean WHERE seq % 7 = 0)) WHERE rn = 1""")
def merge_new_candidates(spark, d):
    rows = cleaned(spark, d).select("doi", "seq")
    return incremental.merge_new_candidates(rows.where("seq % 7 = 0"), [("curated", rows.where("seq % 5 = 0")), ("keyword", rows.where("seq % 3 = 0")), ("similar", rows)], "seq").select("doi", "seq", "found_via")


@query("upsert_curated", f"""{FIRST}, {LAST} SELECT coalesce(cur.doi, one.doi) AS doi, coalesce(cur.name, one.title) AS title, one.year AS year, cur.category AS category, CASE WHEN cur.doi IS NOT NULL THEN 'csv_curation' ELSE 'pool' END AS found_via, CASE WHEN cur.doi IS NOT NULL THEN 'curated_method' ELSE 'new' END AS status FROM one FULL JOIN cur ON one.doi = cur.doi""")
def upsert_curated(spark, d):
    pool = dedupe.keep_first(cleaned(spark, d).select("doi", "seq", "title", "year"), "doi", "seq").drop("seq").withColumns({"found_via": F.lit("pool"), "status": F.lit("new")})
    return incremental.upsert_curated(pool, view(spark, d, REPEATED).select("doi", C("name").alias("title"), "category", C("seq").alias("added")), "added")


@query("expand_neighbors", "WITH s AS (SELECT p_partkey FROM part WHERE p_size <= 10) SELECT DISTINCT l_suppkey AS id FROM lineitem WHERE l_partkey IN (FROM s) AND l_suppkey NOT IN (FROM s)")
def expand_neighbors(spark, d):
    """Every part of a small size is a seed, so seeds grow with the table."""
    seeds = spark.read.parquet(f"{d}/part.parquet").where("p_size <= 10").select(C("p_partkey").alias("pmid"))
    return incremental.expand_neighbors(seeds, view(spark, d, LINKS), "pmid", "source", "target")


@query("select_stale", "SELECT event_id AS doi, epoch_us(ts) AS refreshed_us FROM events WHERE event_id % 4 = 0 OR floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(ts))) / 86400) >= 7")
def select_stale(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").select(C("event_id").alias("doi"), F.when(C("event_id") % 4 != 0, C("ts")).alias("refreshed"), F.unix_micros(C("ts").cast("timestamp")).alias("refreshed_us"))
    return incremental.select_stale(rows, "refreshed", "2024-02-01 00:00:00").select("doi", "refreshed_us")


@query("citation_counts", "SELECT p_partkey AS doi, p_name AS title, coalesce(n, 0)::BIGINT AS citations, '2025-01-01' AS citations_updated FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey")
def citation_counts(spark, d):
    links = spark.read.parquet(f"{d}/lineitem.parquet").select("l_partkey")
    return incremental.citation_counts(spark.read.parquet(f"{d}/part.parquet").select(C("p_partkey").alias("doi"), C("p_name").alias("title")), links, "doi", "l_partkey", NOW)


#: Words that occur in the given documents, as vocabularies.
WORDS = {"english": ["the", "and", "of"], "german": ["der", "und", "mit"], "french": ["les", "des", "est"], "spanish": ["que", "los", "para"], "legal": ["license", "reserved"], "secret": ["token"]}
VOCABULARY = vocabulary.load_vocabulary({label: [rf"\b{w}\b" for w in words] for label, words in WORDS.items()})
GROUPS = {
    "inclusion": {"english": VOCABULARY["english"]}, "exclusion": {"legal": VOCABULARY["legal"]}, "tissue": {k: VOCABULARY[k] for k in ("german", "french")},
    "organism": {"spanish": VOCABULARY["spanish"]}, "disease": {"french": VOCABULARY["legal"]}, "paper_type": {"Methodology Paper": VOCABULARY["german"], "Review": VOCABULARY["french"]},
    "pipeline": {"secret": VOCABULARY["secret"], "legal": VOCABULARY["legal"]}, "method": {k: VOCABULARY[k] for k in ("english", "spanish")},
}
TEXT = f"{P}, t AS (SELECT seq, lower(title || ' ' || abstract) AS text FROM papers)"
VALUES = "v(label, word, place) AS (VALUES " + ", ".join(f"('{k}', '{w}', {n})" for n, (k, ws) in enumerate(WORDS.items()) for w in ws) + ")"
HIT = r"regexp_matches(text, '(^|[^\p{L}\p{N}_])(?:' || word || ')([^\p{L}\p{N}_]|$)')"
HITS = f"{TEXT}, {VALUES}, hits AS (SELECT seq, label, word, place FROM t, v WHERE {HIT})"


def has(*labels: str) -> str:
    return "coalesce(bool_or(label IN (" + ", ".join(f"'{x}'" for x in labels) + ")), false)"


def tagged(spark, d):
    return papers(spark, d).select("seq", vocabulary.corpus_text(C("title"), C("abstract")).alias("text"))


#: The same vocabulary as a file, in all the shapes that such files have.
WORDS_FILE = r"""# words of the documents
english:   # the commonest
  - "\\bthe\\b"
  - '\band\b'  # don't miss it
  - \bof\b
'german': ['\bder\b', "\\bund\\b", \bmit\b] # one line
french:
- '\bles\b'
- "\\bdes\\b" # it's here
- \best\b
"spanish": # a comment
    - \bque\b
    - '\blos\b'
    - '\bpara\b'

legal:
  - "\\blicense\\b"
  - \breserved\b  # as in 'all rights'
secret: [\btoken\b]
Empty: [] # an 'empty' list
"""


@query("load_vocabulary", f"{HITS} SELECT label, patterns, documents FROM (SELECT label, count(*)::BIGINT AS patterns FROM v GROUP BY 1) JOIN (SELECT label, count(DISTINCT seq)::BIGINT AS documents FROM hits GROUP BY 1) USING (label)")
def load_vocabulary(spark, d):
    """How many patterns each label of a vocabulary file has, and how many texts it tags."""
    loaded = vocabulary.read_vocabulary(WORDS_FILE.splitlines())
    sizes = F.create_map(*[F.lit(x) for k, v in loaded.items() for x in (k, len(v))])
    found = tagged(spark, d).select(F.explode(vocabulary.tag_all(C("text"), loaded)).alias("label")).groupBy("label").agg(F.count("*").alias("documents"))
    return found.select("label", sizes[C("label")].cast("long").alias("patterns"), "documents")


@query("tag_any", f"{HITS} SELECT t.seq, {has('legal', 'secret')} AS flag FROM t LEFT JOIN hits USING (seq) GROUP BY t.seq")
def tag_any(spark, d):
    return tagged(spark, d).select("seq", vocabulary.tag_any(C("text"), {k: VOCABULARY[k] for k in ("legal", "secret")}).alias("flag"))


@query("tag_first", f"{HITS} SELECT t.seq, min_by(label, place) AS label FROM t LEFT JOIN hits USING (seq) GROUP BY t.seq")
def tag_first(spark, d):
    return tagged(spark, d).select("seq", vocabulary.tag_first(C("text"), VOCABULARY).alias("label"))


@query("tag_all", f"{HITS} SELECT DISTINCT seq, label FROM hits")
def tag_all(spark, d):
    return tagged(spark, d).select("seq", F.explode(vocabulary.tag_all(C("text"), VOCABULARY)).alias("label"))


@query("tag_detail", f"{HITS} SELECT DISTINCT seq, label, word AS fragment FROM hits")
def tag_detail(spark, d):
    found = tagged(spark, d).select("seq", F.explode(vocabulary.tag_detail(C("text"), VOCABULARY)).alias("label", "fragments"))
    return found.select("seq", "label", F.explode("fragments").alias("fragment"))


def listed(**labels: str) -> str:
    """Sorted names of labels that hit, joined."""
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"coalesce(array_to_string(list_sort(list_distinct(list(CASE label {cases} END) FILTER (label IN ({', '.join(repr(k) for k in labels)})))), '|'), '')"


CONCEPTS = f"""{HITS} SELECT t.seq, {has('english')} AS kw_domain_inclusion, {has('legal')} AS kw_domain_exclusion, {listed(german='german', french='french')} AS kw_tissue, {listed(spanish='spanish')} AS kw_organism,
{listed(german='Methodology Paper', french='Review')} AS kw_paper_type, {listed(secret='secret', legal='legal')} AS kw_pipeline_category, {listed(english='english', spanish='spanish')} AS kw_detected_methods,
coalesce(array_to_string(list_sort(list_distinct(list(word) FILTER (label = 'legal'))), '|'), '') AS french_detail FROM t LEFT JOIN hits USING (seq) GROUP BY t.seq"""
CONCEPTS = CONCEPTS.replace("coalesce(array_to_string(list_sort(list_distinct(list(word) FILTER (label = 'legal'))), '|'), '') AS french_detail", "coalesce(array_to_string(list_sort(list_distinct(coalesce(list(word) FILTER (label = 'legal'), list(word) FILTER (label = 'french')))), '|'), '') AS french_detail")


def concept_columns(df):
    lists = [F.array_join(c, "|").alias(c) for c in ("kw_tissue", "kw_organism", "kw_paper_type", "kw_pipeline_category", "kw_detected_methods")]
    french = F.coalesce(F.array_join(F.try_element_at("kw_detail_biological_concepts", F.lit("french")), "|"), F.lit(""))
    return df.select("seq", "kw_domain_inclusion", "kw_domain_exclusion", *lists, french.alias("french_detail"))


@query("extract_concepts", CONCEPTS)
def extract_concepts(spark, d):
    return concept_columns(vocabulary.extract_concepts(tagged(spark, d), "text", GROUPS))


@query("curated_then_extract", CONCEPTS.replace("FROM papers)", "FROM (SELECT p.seq, coalesce(c.name || ' los', p.title) AS title, p.abstract FROM papers p LEFT JOIN cur c ON '10.1000/p' || p.seq = c.doi))", 1).replace(P, f"{P}, {LAST}", 1))
def curated_then_extract(spark, d):
    rows = papers(spark, d).withColumn("doi", F.concat(F.lit("10.1000/p"), "seq"))
    curated = view(spark, d, REPEATED).select("doi", F.concat("name", F.lit(" los")).alias("title"), "seq")
    return concept_columns(vocabulary.curated_then_extract(rows, curated, ["title"], GROUPS, "seq"))


#: Parts of words from which a vocabulary of 85 labels and 360 patterns of its own kinds is made by rule.
PARTS = ("th", "er", "on", "an", "re", "in", "ed", "ha", "en", "ti", "st", "nd", "sch", "keit", "ung", "lich", "tion", "ment", "que", "ent")
KINDS = (r"\b{a}{b}\b", r"\b{a}{b}(?:{c})?\b", r"\b(?:{a}|{b}){c}\b", r"\b{a}{b}\s+{c}", r"{a}{b}{c}\b", r"\b{a}[aeiou]{b}\w*")
LARGE = [(f"label {n % 85}", KINDS[n % 6].format(a=PARTS[n % 20], b=PARTS[n // 20], c=PARTS[(n * 7 + n // 20) % 20])) for n in range(360)]
LARGE_SQL = ", ".join(f"('{label}', '{p}')" for label, p in LARGE)


@query("tag_large_vocabulary", f"{P}, t AS (SELECT seq, lower(regexp_replace(title || ' ' || abstract, '[^\\x00-\\x7F]', ' ', 'g')) AS text FROM papers), v(label, pattern) AS (VALUES {LARGE_SQL}) SELECT DISTINCT seq, label, lower(unnest(regexp_extract_all(text, '(?i)' || pattern))) AS fragment FROM t, v")
def tag_large_vocabulary(spark, d):
    """85 labels and 360 patterns over ASCII texts, where both engines see the same edges of words."""
    by_label: dict[str, list[str]] = {}
    for label, p in LARGE:
        by_label.setdefault(label, []).append(p)
    text = F.regexp_replace(F.concat_ws(" ", "title", "abstract"), r"[^\x00-\x7F]", " ")
    found = papers(spark, d).select("seq", F.explode(vocabulary.tag_detail(F.lower(text), vocabulary.load_vocabulary(by_label))).alias("label", "fragments"))
    return found.select("seq", "label", F.explode("fragments").alias("fragment"))


#: Keywords of a large map: the words of the benchmark, each of which stands for those that begin alike.
KEYWORDS = "SELECT DISTINCT upper(substring(word, 1, 3)) AS label, word AS keyword, word AS place FROM (SELECT explode(split(lower(text), '[^a-z0-9]+')) AS word FROM {benchmark}) WHERE length(word) >= 5"
LARGE_MAP = r"""WITH t AS (SELECT DISTINCT doc_id AS id, unnest(string_split_regex(text, '[\x20\x09-\x0D]+')) AS term FROM documents), w AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS keyword FROM benchmark),
d AS (SELECT term, regexp_replace(lower(term), '[^a-z0-9]', '', 'g') AS plain FROM (SELECT DISTINCT term FROM t)), k AS (SELECT keyword, upper(substring(keyword, 1, 3)) AS label FROM w WHERE length(keyword) >= 5),
one AS (SELECT term, min_by(label, keyword) AS label FROM d JOIN k ON contains(plain, keyword) GROUP BY term), m AS (SELECT id, coalesce(label, t.term) AS term FROM t LEFT JOIN one USING (term))
SELECT id, md5(array_to_string(list_sort(list_distinct(list(CASE WHEN regexp_replace(lower(term), '[^a-z0-9]', '', 'g') LIKE '%the%' THEN 'General' ELSE term END))), '|')) AS terms FROM m GROUP BY id"""


@query("harmonize_large_map", LARGE_MAP)
def harmonize_large_map(spark, d):
    """All words of all documents through a map that is a table, and its labels through a second one."""
    rows = spark.read.parquet(f"{d}/documents.parquet").select(C("doc_id").alias("id"), F.split("text", r"[\x20\x09-\x0D]+").alias("terms"))
    second = spark.range(1).select(F.lit("General").alias("label"), F.lit("the").alias("keyword"), F.lit(0).alias("place"))
    found = vocabulary.harmonize_with_tables(rows, "terms", view(spark, d, KEYWORDS), second)
    return found.select("id", F.md5(F.array_join("terms", "|").cast("binary")).alias("terms"))


MAPS = ({"Source one": ["SRC-1"], "Two": ["src2", "purchase"]}, {"General": ["source ONE"], "English": ["en"]})
TERMS = "SELECT doc_id AS id, source AS a, lang AS b FROM {documents}"
HARMONIZED = "CASE WHEN contains(source, 'src1') THEN 'General' WHEN contains(source, 'src2') THEN 'Two' ELSE source END"


@query("harmonize_terms", f"SELECT doc_id AS id, array_to_string(list_sort(list_distinct([{HARMONIZED}, CASE WHEN lang = 'en' THEN 'English' ELSE lang END])), '|') AS terms FROM documents")
def harmonize_terms(spark, d):
    rows = view(spark, d, TERMS).select("id", F.array("a", "b").alias("terms"))
    return vocabulary.harmonize_term_table(rows, "terms", *MAPS).select("id", F.array_join("terms", "|").alias("terms"))


CONTEXTS = {"Brain": ["click", "sign"], "Liver": [r"\bview\b"]}
CONTEXT = "CASE WHEN event_id % 9 = 0 THEN ' N/A ' WHEN event_id % 9 = 1 THEN NULL ELSE event_type END"


@query("harmonize_context", f"SELECT event_id AS seq, CASE WHEN event_id % 9 < 2 THEN NULL WHEN event_type IN ('click', 'signup') THEN 'Brain' WHEN event_type = 'view' THEN 'Liver' END AS context FROM events")
def harmonize_context(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(C("event_id").alias("seq"), F.expr(CONTEXT).alias("c"))
    return e.select("seq", vocabulary.harmonize_context(C("c"), vocabulary.load_vocabulary(CONTEXTS)).alias("context"))


@query("unassigned_contexts", f"SELECT DISTINCT context FROM (SELECT {CONTEXT} AS context FROM events) WHERE context NOT IN ('click', 'signup', 'view')")
def unassigned_contexts(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(F.expr(CONTEXT).alias("context"))
    labelled = e.withColumn("label", vocabulary.harmonize_context(C("context"), vocabulary.load_vocabulary(CONTEXTS)))
    return vocabulary.unassigned_contexts(labelled, "context", "label")


@query("context_counts", f"WITH e AS (SELECT {CONTEXT} AS c, props AS p FROM events) SELECT 'tissue' AS context, count(*) FILTER (c IN ('click', 'signup', 'view')) AS with_label, count(*) FILTER (c IS NULL OR c NOT IN ('click', 'signup', 'view')) AS without_label FROM e UNION ALL SELECT 'disease', count(*) FILTER (contains(p, '7')), count(*) FILTER (NOT contains(p, '7')) FROM e")
def context_counts(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(F.expr(CONTEXT).alias("c"), "props")
    labelled = e.select(vocabulary.harmonize_context(C("c"), vocabulary.load_vocabulary(CONTEXTS)).alias("tissue"), vocabulary.harmonize_context(C("props"), {"Seven": ("7",)}).alias("disease"))
    return vocabulary.context_counts(labelled, ["tissue", "disease"])


@query("clean_type_labels", "SELECT event_id AS seq, CASE WHEN event_type = 'click' THEN 'Method|Tool' WHEN event_id % 2 = 0 THEN 'a,b|' || event_type ELSE event_type END AS labels FROM events")
def clean_type_labels(spark, d):
    raw = F.when(C("event_type") == "click", '["click"]').when(C("event_id") % 2 == 0, F.concat(F.lit('["computational analysis - a;b", "'), "event_type", F.lit('"]'))).otherwise(F.concat(F.lit("computational analysis - "), "event_type"))
    return spark.read.parquet(f"{d}/events.parquet").select(C("event_id").alias("seq"), F.array_join(vocabulary.clean_type_labels(raw, {"click": ["Tool", "Method"]}), "|").alias("labels"))


RANK = "CASE lower(section_extraction_status) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in merge.STATUS_RANKS.items()) + f" ELSE {merge.OTHER_RANK} END"
BEST = f"WITH log AS ({sql_of(ATTEMPTS)}), best AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY {RANK} DESC, extracted_at_timestamp DESC NULLS LAST, seq) AS rn FROM log) WHERE rn = 1)"


@query("best_attempt", f"{BEST} SELECT doi, seq, section_extraction_status, extracted_introduction_section, extracted_methods_section FROM best")
def best_attempt(spark, d):
    return merge.best_attempt(view(spark, d, ATTEMPTS), "seq").select("doi", "seq", "section_extraction_status", "extracted_introduction_section", "extracted_methods_section")


@query("merge_sections", f"""{BEST}, p AS (SELECT '10.1000/u' || doc_id AS doi, text AS title FROM documents)
SELECT p.doi, title, coalesce(is_open_access, false) AS is_open_access, coalesce(full_text_access_type, 'Unknown') AS full_text_access_type, coalesce(section_extraction_status, 'Not Processed') AS section_extraction_status,
regexp_matches(lower(coalesce(section_extraction_status, '')), 'extracted from (html|pdf)') AND (trim(coalesce(extracted_introduction_section, '')) <> '' OR trim(coalesce(extracted_methods_section, '')) <> '') AS sections_extracted_successfully, coalesce(extracted_introduction_section, '') AS extracted_introduction_section FROM p LEFT JOIN best ON p.doi = best.doi""")
def merge_sections(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.concat(F.lit("10.1000/u"), "doc_id").alias("doi"), C("text").alias("title"))
    out = merge.merge_sections(docs, merge.best_attempt(view(spark, d, ATTEMPTS), "seq"))
    return out.select("doi", "title", "is_open_access", "full_text_access_type", "section_extraction_status", "sections_extracted_successfully", "extracted_introduction_section")


@query("join_curated_categories", f"""{FIRST}, cur AS ({sql_of(CURATED)}) SELECT one.doi, title, cur.category AS curated_category, cur.pipeline_category AS curated_pipeline, cur.name AS curated_name, CASE WHEN cur.doi IS NOT NULL THEN 100.0 ELSE 0.0 END::DOUBLE AS annotation_score, CASE WHEN cur.doi IS NOT NULL THEN 100.0 ELSE 0.0 END::DOUBLE AS relevance_score FROM one LEFT JOIN cur ON one.doi = cur.doi""")
def join_curated_categories(spark, d):
    pool = dedupe.keep_first(cleaned(spark, d).select("doi", "seq", "title"), "doi", "seq").drop("seq").withColumns({"annotation_score": F.lit(0.0), "relevance_score": F.lit(0.0)})
    return merge.join_curated_categories(pool, view(spark, d, CURATED), {"category": "curated_category", "pipeline_category": "curated_pipeline", "name": "curated_name"}, "seq")


@query("combine_sources", f"""{FIRST}, s AS (SELECT doi, max_by(title, seq) AS methods FROM clean WHERE seq % 2 = 0 GROUP BY 1), a AS (SELECT doi, max_by(n_chars, seq) AS goal FROM clean WHERE seq % 3 <> 0 GROUP BY 1), w AS (SELECT doi, max_by(language, seq) AS paper_type FROM clean WHERE seq % 5 <> 0 GROUP BY 1)
SELECT one.doi, one.title, s.methods, a.goal, w.paper_type AS weak_annot_paper_type, '{NOW}' AS annotation_date, 2.0::DOUBLE AS annotation_score, 'LLM_processed' AS annotation_status FROM one JOIN s USING (doi) JOIN a USING (doi) JOIN w USING (doi)""")
def combine_sources(spark, d):
    rows = cleaned(spark, d)
    pool = dedupe.keep_first(rows.select("doi", "seq", "title"), "doi", "seq").drop("seq")
    sections = rows.where("seq % 2 = 0").select("doi", "seq", C("title").alias("methods"), F.lit("other").alias("title"))
    annotated = rows.where("seq % 3 <> 0").select("doi", "seq", C("n_chars").alias("goal"))
    weak = rows.where("seq % 5 <> 0").select("doi", "seq", C("language").alias("paper_type"))
    return merge.combine_sources(pool, sections, annotated, weak, "seq", NOW)


@query("update_master", f"""WITH m AS ({sql_of(MASTER)}), n AS (SELECT * EXCLUDE (rn, seq) FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY coalesce(seq, -1) DESC) AS rn FROM ({sql_of(FRESH)})) WHERE rn = 1) SELECT doi, annotation_score, annotation, false AS is_new FROM m WHERE annotation_score >= 3 OR doi NOT IN (SELECT doi FROM n) UNION ALL SELECT doi, annotation_score, annotation, doi NOT IN (SELECT doi FROM m) FROM n WHERE doi NOT IN (SELECT doi FROM m WHERE annotation_score >= 3)""")
def update_master(spark, d):
    master, new = merge.update_master(view(spark, d, MASTER), view(spark, d, FRESH), "seq")
    return master.join(new.select("doi", F.lit(True).alias("is_new")), "doi", "left").select("doi", "annotation_score", "annotation", F.coalesce("is_new", F.lit(False)).alias("is_new"))


@query("update_master_buckets", SQL["update_master"])
def update_master_buckets(spark, d):
    """The same on a master that is kept in buckets, of which the new annotations rewrite those that they fall into."""
    master = view(spark, d, MASTER)
    table = BucketTable(spark, shared_folder(spark, "master"), master.schema, "doi")
    table.update(master, lambda _, rows: rows)
    new = merge.update_master_table(table, view(spark, d, FRESH), "seq")
    return table.read().join(new.select("doi", F.lit(True).alias("is_new")), "doi", "left").select("doi", "annotation_score", "annotation", F.coalesce("is_new", F.lit(False)).alias("is_new"))


OVERLAY = "SELECT upper(doi) AS doi, seq, CASE WHEN seq % 2 = 0 THEN '' ELSE name END AS title, CASE WHEN seq % 7 = 0 THEN 'Yes' ELSE 'no' END AS mark_for_deletion FROM (" + REPEATED + ") c"


@query("overlay_manual", f"""{FIRST}, o AS (SELECT lower(doi) AS doi, title, mark_for_deletion FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY coalesce(seq, -1) DESC) AS rn FROM ({sql_of(OVERLAY)})) WHERE rn = 1) SELECT one.doi, CASE WHEN o.doi IS NOT NULL THEN o.title ELSE one.title END AS title, o.mark_for_deletion, CASE WHEN o.doi IS NOT NULL THEN 100 ELSE 60 END::DOUBLE AS annotation_score, CASE WHEN o.doi IS NOT NULL THEN 'human_annotated' END AS manual_annotation_status, CASE WHEN o.doi IS NOT NULL THEN '{NOW}' END AS manual_annotation_timestamp FROM one LEFT JOIN o ON one.doi = o.doi WHERE coalesce(lower(o.mark_for_deletion), '') <> 'yes'""")
def overlay_manual(spark, d):
    pool = dedupe.keep_first(cleaned(spark, d).select("doi", "seq", "title"), "doi", "seq").drop("seq").withColumn("annotation_score", F.lit(60.0))
    return merge.overlay_manual(pool, view(spark, d, OVERLAY), NOW, "seq")


@query("merge_manual", f"""{FIRST}, m AS (SELECT doi, name AS title, category FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY coalesce(seq, -1) DESC) AS rn FROM ({sql_of(REPEATED)}) WHERE toxic = 0) WHERE rn = 1), x AS (SELECT doi FROM ({sql_of(CURATED)}) WHERE seq % 5 = 0)
SELECT coalesce(a.doi, m.doi) AS doi, CASE WHEN m.doi IS NOT NULL THEN m.title ELSE a.title END AS title, a.year, m.category, CASE WHEN m.doi IS NOT NULL THEN 100 ELSE 60 END::DOUBLE AS annotation_score, m.doi IS NOT NULL AS manual_reviewed, CASE WHEN m.doi IS NOT NULL THEN '{NOW}' END AS manual_review_date
FROM (SELECT * FROM one WHERE doi NOT IN (SELECT doi FROM x)) a FULL JOIN (SELECT * FROM m WHERE doi NOT IN (SELECT doi FROM x)) m ON a.doi = m.doi""")
def merge_manual(spark, d):
    pool = cleaned(spark, d).select("doi", (-C("seq")).alias("seq"), "title", "year").withColumn("annotation_score", F.lit(60.0))
    curated = view(spark, d, REPEATED).where("toxic = 0").select(F.upper("doi").alias("doi"), "seq", C("name").alias("title"), "category")
    return merge.merge_manual(pool, curated, view(spark, d, CURATED).where("seq % 5 = 0").select("doi"), NOW, "seq")


@query("seed_manual", f"WITH cur AS ({sql_of(CURATED)}) SELECT doi, replace(category, ';', ';') AS categories, nullif(trim(pipeline_category), '') AS final_pipeline_step, name AS package_algorithm_name, true AS manual_reviewed, '{NOW}' AS manual_review_date FROM cur")
def seed_manual(spark, d):
    out = merge.seed_manual(view(spark, d, CURATED), "seq", now=NOW)
    return out.select("doi", F.array_join("final_paper_classification", "|").alias("categories"), "final_pipeline_step", "package_algorithm_name", "manual_reviewed", "manual_review_date")


REVIEWS = f"WITH a AS ({sql_of(ANNOTATED)}), one AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY seq) AS rn FROM a) WHERE rn = 1)"


@query("prepare_review", f"{REVIEWS} SELECT doi, CASE WHEN seq % 4 = 0 THEN 1.0 WHEN llm_annotation_status = 'detailed_llm_annotated' THEN 70.0 WHEN llm_annotation_status = 'middle_llm_annotated' THEN 60.0 ELSE round(annotation_score, 6) END::DOUBLE AS annotation_score, CASE WHEN seq % 4 = 0 THEN 'reviewed' ELSE 'pending' END AS manual_review_status, CASE WHEN seq % 4 = 0 THEN 'kept' ELSE '' END AS manual_notes FROM one")
def prepare_review(spark, d):
    one = dedupe.keep_first(view(spark, d, ANNOTATED), "doi", "seq")
    existing = one.where("seq % 4 = 0").select("doi", F.lit(1.0).alias("annotation_score"), F.lit("reviewed").alias("manual_review_status"), F.lit("kept").alias("manual_notes"))
    return merge.prepare_review(existing, one).select("doi", F.round("annotation_score", 6).alias("annotation_score"), "manual_review_status", "manual_notes")


VERDICT = "CASE seq % 5 WHEN 0 THEN 'reviewed' WHEN 1 THEN 'reclassify_to_comp' WHEN 2 THEN 'reclassify_to_noncomp' ELSE 'pending' END"


@query("integrate_reviews", f"""WITH a AS ({sql_of(ANNOTATED)}), r AS (SELECT *, CASE WHEN seq % 2 = 0 THEN 0 ELSE 1 END AS t, {VERDICT} AS v, {FLAG} AS flag FROM a), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY t, seq) AS rn FROM r WHERE doi NOT IN (SELECT doi FROM a WHERE seq % 97 = 0)) WHERE rn = 1)
SELECT doi, seq, CASE WHEN v = 'pending' THEN round(annotation_score, 6) ELSE 100 END::DOUBLE AS annotation_score, CASE v WHEN 'reclassify_to_comp' THEN 'human_reclassified_to_comp' WHEN 'reclassify_to_noncomp' THEN 'human_reclassified_to_noncomp' WHEN 'reviewed' THEN CASE llm_annotation_status WHEN 'detailed_llm_annotated' THEN 'human_reviewed_detailed' WHEN 'middle_llm_annotated' THEN 'human_reviewed_broad_only' ELSE 'human_reviewed' END ELSE llm_annotation_status END AS llm_annotation_status,
CASE v WHEN 'reclassify_to_comp' THEN true WHEN 'reclassify_to_noncomp' THEN false ELSE flag END AS flag, NULL::VARCHAR AS manual_notes FROM one WHERE CASE v WHEN 'reclassify_to_comp' THEN true WHEN 'reclassify_to_noncomp' THEN false ELSE flag END IS NOT NULL""")
def integrate_reviews(spark, d):
    rows = view(spark, d, ANNOTATED).withColumn("manual_review_status", F.expr(VERDICT)).withColumn("flag", flag()).drop("annotation")
    yes, no = merge.integrate_reviews([rows.where("seq % 2 = 0"), rows.where("seq % 2 <> 0")], rows.where("seq % 97 = 0"), "seq", "flag", ["doi", "seq", "annotation_score", "llm_annotation_status", "flag", "manual_notes"])
    return yes.unionByName(no).withColumn("annotation_score", F.round("annotation_score", 6))


@query("join_embeddings", "SELECT vec_id AS doi, source AS journal, CAST(len(embedding) AS BIGINT) AS n FROM embeddings JOIN documents ON vec_id = doc_id WHERE vec_id % 9 <> 0")
def join_embeddings(spark, d):
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select(C("vec_id").alias("doi"), F.when(C("vec_id") % 9 == 0, F.array().cast("array<float>")).otherwise(C("embedding")).alias("embedding"))
    docs = spark.read.parquet(f"{d}/documents.parquet").select(C("doc_id").alias("doi"), C("source").alias("journal"))
    return merge.join_embeddings(vectors, docs).select("doi", "journal", F.size("embedding").cast("long").alias("n"))
