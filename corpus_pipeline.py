"""From raw documents to encoded training data: each stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.llm import bpe, decontam, langid, minhash, quality
from paperflow.llm.common import shared_dir, stored, table, temporary
from paperflow.llm.queries import tokenizer_path

#: A document is kept if at least this share of its letters is of its language.
OWN_LANGUAGE = 0.4


def kept(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The documents whose rows `decide` keeps, with their own columns: these stand under other names meanwhile, so that no result of an operator takes the place of one."""
    names = {c: f"own_{n}" for n, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    rows = decide(docs.select("doc_id", "text", *[docs[c].alias(own) for c, own in names.items()]))
    return rows.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold, learned from the labels of these documents."""

    def decide(rows: DataFrame) -> DataFrame:
        known = stored(quality.with_statistics(rows), "statistics")
        model = quality.train(quality.training_rows(known, table(spark, sf_dir, "labels")))
        return quality.scored(known, model).where("predicted = 1")

    return kept(docs, decide)


def in_one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, most of them in one of the learned languages."""
    model = langid.train(docs.where(~langid.held_out()))
    own = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= OWN_LANGUAGE)
    return kept(docs, lambda rows: langid.identify(rows, model, spans=False).where(own))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; of rows repeated exactly one stays."""
    ids = minhash.near_duplicates(docs).where("doc_id is not null").groupBy("doc_id")
    named = stored(ids.agg(F.bool_or(~F.col("kept")).alias("goes"), F.count("*").alias("n")).where("goes or n > 1"), "named")
    once = docs.join(named, "doc_id", "left_anti")
    repeated = docs.join(named.where("not goes"), "doc_id", "left_semi").dropDuplicates()
    return once.unionByName(repeated).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    items = table(spark, sf_dir, "benchmark")
    return kept(docs, lambda rows: decontam.with_hits(rows, items).where(F.size("hits") == 0))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids (little-endian uint32) in place of the text, and a digest of what the ids decode to."""
    coded = bpe.encode_texts(docs, tokenizer_path(), drop_text=True)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good),
    ("language ID", in_one_language),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding", encoded),
]

#: Its stages are not expressible in SQL; tests hold it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        # what a stage stores on its way goes once its result is written
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
