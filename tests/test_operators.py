import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperflow.operators import dedupe, filters, graph, incremental, merge, scoring, sections, vectors
from paperflow.plans.corpus import ATTEMPTS, view
from paperflow.sources import buckets, files
from paperflow.streaming import attempts


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_dedupe_is_idempotent_whatever_the_partitions(spark):
    df = spark.range(200).select((F.col("id") % 17).alias("k"), F.col("id").alias("seq"))
    once = dedupe.keep_first(df, "k", "seq")
    assert pairs(once, "k", "seq") == [(k, k) for k in range(17)]
    assert pairs(dedupe.keep_first(once.repartition(5), "k", "seq"), "k", "seq") == pairs(once, "k", "seq")
    assert pairs(dedupe.keep_last(df.repartition(7), "k", "seq"), "k")[:2] == [(0,), (1,)]


@pytest.mark.parametrize("n", [0, 7, 500])
def test_sample_n(spark, n):
    df = spark.range(100).withColumnRenamed("id", "k")
    got = pairs(dedupe.sample_n(df, "k", n), "k")
    assert len(got) == (100 if n == 0 else min(n, 100))
    assert got == pairs(dedupe.sample_n(df.repartition(9), "k", n), "k")


def test_unprocessed_and_done_are_the_input(spark):
    df = spark.range(30).select(F.col("id").alias("k"))
    existing = df.where("k % 2 = 0").withColumn("status", F.when(F.col("k") % 4 == 0, "success").otherwise("failed"))
    new = incremental.select_unprocessed(df, existing, "k", "status")
    assert new.count() + incremental.done_rows(existing, "status").count() == 30
    assert incremental.select_unprocessed(df, existing, "k", "status", force=True).count() == 30


def test_best_attempt_does_not_depend_on_partitions(spark, data):
    log = view(spark, data, ATTEMPTS)
    assert pairs(merge.best_attempt(log, "seq"), "doi", "seq") == pairs(merge.best_attempt(log.repartition(13), "seq"), "doi", "seq")


def test_best_attempt_ties(spark):
    rows = [("a", 1, "General Error", "2024-01-02"), ("a", 2, "OA_pdf_link", "2024-01-01"), ("a", 3, "oa_html_landing_page", "2024-01-01"), ("b", 4, "odd", None), ("b", 5, "odd", "2024-01-01")]
    log = spark.createDataFrame(rows, "doi string, seq int, section_extraction_status string, extracted_at_timestamp string")
    assert pairs(merge.best_attempt(log, "seq"), "doi", "seq") == [("a", 2), ("b", 5)]


def test_splits(spark):
    df = spark.createDataFrame([(1, '{"f": true}', "x"), (2, '{"f": "true"}', "middle_llm_annotated"), (3, "no", "x"), (4, None, "x")], "id int, c string, s string").withColumn("annotation_score", F.lit(None).cast("double"))
    yes, no = scoring.score_and_split(df, "c", "f", "s")
    assert pairs(yes, "id") == [(1,)]
    assert pairs(no, "id", "annotation_score") == [(2, 60.0), (3, 0.0), (4, 0.0)]
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, f boolean")
    assert [pairs(x, "id") for x in filters.split_by_class(flags, "f")] == [[(1,)], [(2,)]]


def test_overlay_empty_text_wins_and_upsert_null_does_not(spark):
    papers = spark.createDataFrame([("a", "t"), ("b", "u")], "doi string, title string")
    overlay = spark.createDataFrame([("a", "first", 1), ("A ", "", 2), ("a", "no place", None), ("z", "skipped", 1)], "doi string, title string, n int")
    assert pairs(merge.overlay_manual(papers, overlay, "now", "n"), "doi", "title") == [("a", ""), ("b", "u")]
    curated = spark.createDataFrame([("a", "first", 1), ("a", None, 2), ("c", "new", None), (None, "x", 1)], "doi string, title string, n int")
    assert pairs(incremental.upsert_curated(papers, curated, "n"), "doi", "title") == [("a", "t"), ("b", "u"), ("c", "new")]
    both = spark.createDataFrame([("a", "t", 1), ("a", "t2", 3), ("b", "u", 1)], "doi string, title string, n int")
    manual = spark.createDataFrame([("a", "m1", 1), ("doi:A", "m2", 2), ("c", "m3", None)], "doi string, title string, n int")
    assert pairs(merge.merge_manual(both, manual, spark.createDataFrame([("B",)], "doi string"), "now", "n"), "doi", "title", "annotation_score") == [("a", "m2", 100.0), ("c", "m3", 100.0)]


def test_rows_without_a_place_in_the_order_are_kept(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "x"), ("b", 2, "y"), ("b", 3, "z")], "k string, n int, t string")
    assert pairs(dedupe.keep_first(df, "k", "n"), "k", "t") == [("a", "x"), ("b", "y")]
    assert pairs(dedupe.keep_last(df, "k", "n"), "k", "t") == [("a", "x"), ("b", "z")]


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


ATTEMPT = "doi string, seq long, section_extraction_status string, extracted_at_timestamp string"


def test_state_of_attempts_in_buckets(spark, data, tmp_path):
    """However the log is cut, delivered again or late, the state is the best attempt; a batch rewrites the buckets of its keys only."""
    log = view(spark, data, ATTEMPTS).select("doi", "seq", "section_extraction_status", F.col("extracted_at_timestamp").cast("string"))
    table = attempts.state(spark, str(tmp_path), log.schema, buckets=8)
    assert table.read().count() == 0
    batches = [log.where(f"seq % 3 = {n}") for n in (2, 0, 1)]
    for n, batch in enumerate(batches):
        attempts.apply(table, batch, n, "seq")
    wanted = pairs(merge.best_attempt(log, "seq"), *log.columns)
    assert pairs(attempts.latest(spark, str(tmp_path), log.schema, buckets=8), *log.columns) == wanted
    attempts.apply(table, batches[1], 1, "seq")
    assert pairs(table.read(), *log.columns) == wanted and table.version().tag == 2
    with pytest.raises(ValueError, match="lost"):
        attempts.apply(table, batches[0], 9, "seq")
    before = table.version()
    files = files_of(tmp_path)
    attempts.apply(table, spark.createDataFrame([("new key", 1, "closed", None)], ATTEMPT), 3, "seq")
    after = table.version()
    assert sum(before.buckets.get(b) != f for b, f in after.buckets.items()) == 1
    kept = {f: t for f, t in files.items() if f in files_of(tmp_path)}
    assert len(kept) >= 7 and all(files_of(tmp_path)[f] == t for f, t in kept.items())
    assert len(table.versions()) == 2 and table.read().count() == len(wanted) + 1
    with pytest.raises(FileNotFoundError):
        table.version(41)


def test_a_failed_update_leaves_the_version_before(spark, tmp_path):
    table = buckets.BucketTable(spark, str(tmp_path), T.StructType.fromDDL("k long, v string"), "k", 4)
    table.update(spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v")), lambda old, new: new)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        table.update(spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("v")), lambda old, new: new.withColumn("v", (F.col("k") / F.lit(0)).cast("string")))
    with pytest.raises(ValueError, match="no change touches"):
        table.update(spark.range(1).select(F.col("id").alias("k"), F.lit("x").alias("v")), lambda old, new: table.read())
    assert pairs(table.read().groupBy("v").count(), "v", "count") == [("old", 40)]
    table.update(spark.range(40).select(F.col("id").alias("k"), F.lit("").alias("v")), lambda old, new: old.where("k % 2 = 0"))
    assert table.read().count() == 20 and len([p for p in (tmp_path / "data").iterdir()]) == 2
    with pytest.raises(ValueError, match="4 buckets"):
        buckets.BucketTable(spark, str(tmp_path), table.schema, "k", 8).version()


def test_master_in_buckets_is_the_master(spark, tmp_path):
    schema = T.StructType.fromDDL("doi string, annotation_score double, x string")
    table = buckets.BucketTable(spark, str(tmp_path), schema, "doi", 8)
    master = spark.createDataFrame([(f"k{i}", float(i % 5), "old") for i in range(60)], schema)
    new = spark.createDataFrame([(f"k{i}", 2.0, f"new{n}", n) for i in (1, 3, 4, 70, 71) for n in (1, 2)] + [(None, 2.0, "no", 1)], "doi string, annotation_score double, x string, n int")
    table.update(master, lambda old, rows: rows)
    wanted, fresh = merge.update_master(master, new, "n")
    before = files_of(tmp_path)
    assert pairs(merge.update_master_table(table, new, "n"), "doi", "x") == pairs(fresh, "doi", "x")
    assert pairs(table.read(), *schema.names) == pairs(wanted, *schema.names)
    assert sum(files_of(tmp_path).get(f) == t for f, t in before.items()) == len(before)  # the version before is whole
    schema = T.StructType.fromDDL("doi string, x string, annotation_score double, manual_annotation_status string, manual_annotation_timestamp string")
    papers = spark.createDataFrame([(f"k{i}", "t", 1.0, None, None) for i in range(60)], schema)
    overlay = spark.createDataFrame([("K1 ", "by hand", 1), ("nowhere", "y", 1)], "doi string, x string, n int")
    table = buckets.BucketTable(spark, str(tmp_path / "o"), schema, "doi", 8)
    table.update(papers, lambda old, rows: rows)
    merge.overlay_table(table, overlay, "now", "n")
    assert pairs(table.read(), "doi", "x") == pairs(merge.overlay_manual(papers, overlay, "now", "n"), "doi", "x")


def test_answers_survive_an_annotator_that_dies(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "store")

    def annotator(text, log=str(calls), die=str(tmp_path / "die")):
        import os

        if text == "prompt 13" and not os.path.exists(die):
            open(die, "w").close()
            os._exit(1)
        with open(log, "a") as f:
            f.write(text + "\n")
        if text == "prompt 5":
            raise KeyError(text)
        return f"answer to {text}"

    df = spark.createDataFrame([(i, f"prompt {i}") for i in range(20)] + [(19, "prompt 19"), (None, "x")], "k long, p string").coalesce(3)
    with pytest.raises(Exception, match="(?i)worker"):
        scoring.annotate_in_batches(df, annotator, "k", "p", path, at_once=2, absorb=3)
    first = calls.read_text().split("\n")[:-1]
    assert first
    found = scoring.annotate_in_batches(df, annotator, "k", "p", path, at_once=2, absorb=3)
    assert pairs(found, "k", "answer") == sorted((i, None if i == 5 else f"answer to prompt {i}") for i in range(20))
    called = calls.read_text().split("\n")[:-1]
    # only the call that was in flight beside the one that died may be made again
    assert len(called) - len(set(called)) <= 1 and len(set(called)) == 20
    again = scoring.annotate_in_batches(df, annotator, "k", "p", path, attempt=2)
    assert pairs(again.where("attempt = 2"), "k", "status") == [(5, "llm_error_KeyError")] and len(calls.read_text().split("\n")[:-1]) == len(called) + 1


def test_locked_master_rows_stay(spark):
    master = spark.createDataFrame([("a", 3.0, "old"), ("b", 2.0, "old")], "doi string, annotation_score double, x string")
    new = spark.createDataFrame([("a", 2.0, "new", 1), ("b", 2.0, "new", 1), ("c", None, "newer", 2), ("c", 2.0, "new", 1), (None, 2.0, "no key", 1)], "doi string, annotation_score double, x string, n int")
    out, fresh = merge.update_master(master, new, "n")
    assert out.columns == ["doi", "annotation_score", "x"] and pairs(out, "doi", "x") == [("a", "old"), ("b", "new"), ("c", "newer")]
    assert pairs(fresh, "doi", "x") == [("c", "newer")]


@pytest.mark.parametrize(("block_rows", "cells"), [(None, None), (30, 1), (30, 9), (5, 40)])
@pytest.mark.parametrize("symmetric", [False, True])
@pytest.mark.parametrize("clusters", [False, True])
def test_similarity_edges(spark, block_rows, cells, symmetric, clusters):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(120, 6)).round(1)
    if clusters:
        m = (rng.normal(size=(8, 6))[np.arange(120) % 8] + m / 20).round(3)
    m[7] = m[8] = m[9]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(500, []), (501, None), (502, [0.0] * 6)], "id long, embedding array<double>")
    got = {(r["source"], r["target"]) for r in graph.similarity_edges(df, "id", 5, 0.5, symmetric, block_rows, cells).collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    wanted = set()
    for i in range(len(m)):
        best = sorted((j for j in range(len(m)) if j != i), key=lambda j: (-s[i, j], j))[:5]
        wanted |= {(min(i, j), max(i, j)) for j in best if s[i, j] >= 0.5 and (symmetric or i < j)}
    assert got == wanted


def test_vectors_without_clusters_are_searched_by_several_tasks(spark, monkeypatch):
    """Several blocks, each a task, at the sizes that are set; text as ids, equal vectors by the smaller id."""
    plans, plan_cells = [], graph.plan_cells
    monkeypatch.setattr(graph, "plan_cells", lambda *a: plans.append(plan_cells(*a)) or plans[-1])
    m = np.random.default_rng(6).normal(size=(5000, 16))
    m[::100] = m[0]
    df = spark.createDataFrame([(f"{i:05}", v.tolist()) for i, v in enumerate(m)], "id string, embedding array<double>")
    rows = graph.similarity_edges(df, "id", 3, 0.3).collect()
    assert plans[0].blocks() >= 4
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    s[::100, ::100] = np.where(np.eye(50, dtype=bool), -2, 1)
    best = np.argsort(-s, axis=1, kind="stable")[:, :3]
    assert {(r["source"], r["target"]) for r in rows} == {(f"{i:05}", f"{j:05}") for i in range(5000) for j in best[i] if s[i, j] >= 0.3 and i < j}


def test_cells_that_cannot_hold_an_edge_do_not_meet(spark):
    """2,000 vectors around 20 directions: most pairs of blocks are never formed; all are without clusters or a least similarity."""
    rng = np.random.default_rng(3)
    m = rng.normal(size=(20, 32))[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 32)) / 10
    known = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, v array<double>")
    plan = graph.plan_cells(known, 0.7, 100, 20)
    n = plan.blocks()
    assert n >= 20 and len(plan.pairs()) < 0.3 * n * (n + 1) / 2
    assert graph.plan_cells(known, 0.0, 100, 20).near.sum() >= plan.near.sum()
    assert len(graph.plan_cells(known, -1.0, 100, 20).pairs()) == n * (n + 1) / 2
    empty = known.where("id < 0").withColumnRenamed("v", "embedding")
    assert graph.similarity_edges(empty, "id").collect() == []


def test_spectral_layout(spark):
    """500 nodes in three loose groups: the same vectors as an eigen-decomposition, and neighbours nearer than others."""
    rng = np.random.default_rng(4)
    n, pairs_of = 500, {}
    group = np.array([0] * 250 + [1] * 150 + [2] * 100)
    for i in range(n):
        for j in rng.choice(np.flatnonzero(group == group[i]), 8):
            if i != j:
                pairs_of[min(i, int(j)), max(i, int(j))] = float(rng.uniform(0.5, 1))
    for i, j in rng.integers(0, n, (60, 2)).tolist():
        if i != j:
            pairs_of[min(i, j), max(i, j)] = 0.5
    edges = spark.createDataFrame([(i, j, w) for (i, j), w in pairs_of.items()], "source long, target long, weight double")
    got = {r["id"]: (r["x"], r["y"]) for r in graph.spectral_layout(edges, rounds=16).collect()}
    a = np.zeros((n, n))
    for (i, j), w in pairs_of.items():
        a[i, j] = a[j, i] = w
    root = np.sqrt(a.sum(1))
    values, vectors_of = np.linalg.eigh(a / np.outer(root, root))
    at = np.array([got[i] for i in range(n)])
    for k in range(2):
        assert abs(abs(at[:, k] * root @ vectors_of[:, -2 - k]) - 1) < 1e-3
    apart = lambda rows: np.mean([np.linalg.norm(at[i] - at[j]) for i, j in rows])
    assert apart(pairs_of) < apart(rng.integers(0, n, (2000, 2)).tolist()) / 3


def test_spectral_layout_works_out_its_edges_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    edges = spark.range(40).selectExpr("id AS source", "(id * 7 + 1) % 40 AS target", "0.5 + id / 100 AS weight").where("source <> target")
    assert graph.spectral_layout(edges.mapInArrow(counted, edges.schema), rounds=4).count() == 40
    assert made.value == edges.count()


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_dense_ranks(spark, ranges):
    df = spark.range(500).select((F.col("id") % 90).cast("string").alias("c")).union(spark.createDataFrame([(None,)], "c string"))
    got = {r["c"]: r["rank"] for r in graph.dense_ranks(df, "c", ranges).collect()}
    assert got == {c: i for i, c in enumerate(sorted({str(i) for i in range(90)}))}


def test_centroid_classes(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "id int, embedding array<double>")
    out = vectors.classify_by_centroid(df, {"a": [1.0, 0.0], "b": [0.0, 1.0]}, {"b": {"p": [0.1, 1.0], "q": [1.0, 0.0]}})
    assert pairs(out, "id", "category", "pipeline_category", "relevance")[:2] == [(1, "a", "", "relevant_by_similarity"), (2, "b", "p", "relevant_by_similarity")]
    assert [r["top_categories"] for r in out.where("id = 3").collect()] == [["a", "b"]]


def test_annotator_errors_become_states(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "k string, prompt string")
    out = scoring.annotate_with(df, lambda t: t.upper(), "k", "prompt")
    assert pairs(out, "k", "answer", "status")[0] == ("a", "X", "success")
    assert out.where("k = 'b'").first()["status"] == "llm_error_AttributeError"


def sections_of(spark, function, text):
    return function(spark.createDataFrame([(text,)], "text string"), "text").first().asDict()


def test_windowed_sections(spark):
    long = " ".join(["word"] * 40)
    of = lambda text: sections_of(spark, sections.extract_sections_windowed, text)
    assert of(f"x\n1. Methods.\n\n{long}\n\n{long}\nReferences\nz")["methods"] == f"{long}\n{long}"
    assert of("Methods\nshort\n")["methods"] is None and of("the methods are here")["methods"] is None and of(None)["methods"] is None
    # the first line of a header counts; if its section is too short, a less preferred header does
    assert of(f"Background\n{long}\nIntroduction\nshort\nFunding\nIntroduction\n{long}")["introduction"] == long
    assert len(of("Summary\n" + "word " * 5000)["conclusion"]) == sections.WINDOW - 1


def test_parsed_sections(spark):
    long = " ".join(["word"] * 40)
    of = lambda text: sections_of(spark, sections.parse_sections, text)
    got = of(f"T\nIntroduction \n{long}\n2\n{long}  {long}\nIII. Results\nx\nresults\n{long}\nConclusions here\nData availability\n{long}\nReferences")
    assert got["introduction"] == long and got["methods"] == f"{long} {long}"
    assert got["results_discussion"] == long and got["conclusion"] is None and got["data_availability"] == long
    # the line right after a header does not end its section
    assert of(f"Introduction\nMethods\n{long}\nResults")["introduction"] == f"Methods\n{long}"
    assert of(None)["introduction"] is None and of("")["methods"] is None


def test_full_text(spark):
    long = " ".join(["word"] * 40)
    rows = [(1, f"Code availability\n{long}\nReferences\nthe dataset: Dryad", "pdf"), (2, "Software available, code: zenodo", "html"), (3, " ", "pdf"), (4, None, "html")]
    out = sections.extract_full_text(spark.createDataFrame(rows, "id int, text string, src string"), "text", "src")
    got = {r["id"]: r for r in out.collect()}
    assert (got[1]["extracted_code_availability_section"], got[1]["extracted_data_availability_section"]) == (long, "Mentioned data availability sources: dataset: Dryad")
    assert got[2]["extracted_code_availability_section"] == "Mentioned code availability sources: Software available, code: zenodo"
    assert [got[k]["full_text_extraction_status"] for k in (1, 2, 3, 4)] == ["success", "success_from_html", "failed_empty_pdf_text", "failed_empty_html_text"]
    assert got[2]["has_code_availability_section"] and not got[2]["has_methods_section"]


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": "b"}\n{"a": 2, "z": 3}\n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    good, bad = files.read_jsonl(spark, str(tmp_path), schema)
    assert sorted(r["a"] for r in good.collect()) == [1, 2]
    assert sorted(r["value"] for r in bad.collect()) == ["not json", '{"a": "b"}'] or bad.count() == 2
    assert files.read_jsonl(spark, str(tmp_path / "none"), schema)[0].count() == 0


def test_article_xml_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<Set><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle></Article></MedlineCitation></PubmedArticle></Set>")
    row = files.read_article_xml(spark, str(tmp_path), "q", "d").first()
    assert (row["pmid"], row["title"], row["doi"], row["authors"]) == ("7", "T", None, [])
