import hashlib
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from paperflow.llm import decontam, langid, quality, queries
from test_minhash import brute  # the brute-force groups of near duplicates

sys.path.pop(0)


def kept_by(spark, stage, docs, data):
    return sorted(r["doc_id"] for r in stage(spark, docs, data).collect())


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        rows = docs.collect()
        out = stage(spark, docs, data)
        assert out.columns == columns, name
        got = sorted(r["doc_id"] for r in out.collect())
        if n == 0:
            known = quality.with_statistics(docs)
            model = quality.train(quality.training_rows(known, spark.read.parquet(f"{data}/labels.parquet")))
            score = model.score(np.array([quality.statistics(r["text"]) for r in rows]))
            assert got == sorted(r["doc_id"] for r, s in zip(rows, score) if s >= 0.3)
        elif n == 1:
            model = langid.train(docs.where(~langid.held_out()))
            found = [langid.label(model, [r["text"]], False, langid.PENALTY)[0] for r in rows]
            assert got == sorted(r["doc_id"] for r, (lang, score, _) in zip(rows, found) if lang != "und" and score >= corpus_pipeline.OWN_LANGUAGE)
        elif n == 2:
            assert got == [k for k, _, _, kept in brute([(r["doc_id"], r["text"]) for r in rows]) if kept]
        else:
            items = [decontam.words_only(r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
            clean = [r["doc_id"] for r in rows if not any(i in decontam.words_only(r["text"]) for i in items)]
            assert set(got) <= set(clean) and len(got) >= len(clean) - 1
        assert 0 < len(got) < len(rows) or n == 1
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    library = Tokenizer.from_file(queries.tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert {r["doc_id"] for r in last} == set(texts)
    for r in last:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_is_all_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
    run = corpus_pipeline.run(spark, data)
    assert sorted(map(tuple, run.select("doc_id", "ids_sha256").collect())) == sorted(map(tuple, docs.select("doc_id", "ids_sha256").collect()))


@pytest.mark.parametrize("n", range(5))
def test_stages_stand_odd_and_no_rows(spark, data, odd, n):
    docs = odd.select("doc_id", "text", "lang", F.lit("src").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for df in (docs, docs.limit(0)):
        assert corpus_pipeline.STAGES[n][1](spark, df, data).count() <= df.count()


def test_repeated_rows_go(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    twice = docs.union(docs.limit(50))
    assert kept_by(spark, corpus_pipeline.one_of_each, twice, data) == kept_by(spark, corpus_pipeline.one_of_each, docs, data)


def test_columns_named_like_results_come_through(spark, data):
    """Each stage that filters gives every column back as it was, whatever its name."""
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60)
    own = ["score", "predicted", "statistics", "lang_pred", "spans", "hits", "goes", "n", "kept", "own_3", "id"]
    named = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in own})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, named, data)
        assert rows.columns == named.columns, name
        for r in rows.collect():
            assert all(r[c] == f"{c} of {r['doc_id']}" for c in own), name
