"""Queries of the operators over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bpe, decontam, exact, hosts, langid, minhash, pseudo_likelihood, quality, runs, spelling, token_counts, warc
from .common import fold, stored, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op3_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is played as a melody; excerpts of every twentieth one are searched for among all."""
    return audio.matched(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.scored(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = stored(quality.with_statistics(docs, drop_text=True), "statistics")
    model = quality.train(quality.training_rows(known, table(spark, sf_dir, "labels")))
    return quality.scored(known, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    found = decontam.with_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), drop_text=True)
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.item_id", "hit.distance", F.col("hit.start").alias("hit_start"), F.col("hit.end").alias("hit_end"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judged(table(spark, sf_dir, "pages").select("page_id", "url"), hosts.outcomes_of(table(spark, sf_dir, "labels")))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), drop_text=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), model, drop_text=True)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "spans")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic(table(spark, sf_dir, "documents").select("doc_id", "text"), change=runs.repeated_tail)
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period)), "")
    # greatest length, then smallest start, then period
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("length"), r.start.alias("start"), r.period.alias("period")))), F.lit(0))
    out = found.withColumn("best", best)
    longest = [F.col("best.start").alias("start"), (-F.col("best.length")).alias("length"), F.col("best.period").alias("period"), F.expr("-1000 * best.length div best.period").alias("exponent_milli")]
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *longest, F.sha2(lines, 256).alias("runs_sha256"), F.col("digest").alias("collapsed_sha256"))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(spelling.counted(table(spark, sf_dir, "documents"), change=spelling.typo))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_audio": op3_audio,
    "op4_pseudo_likelihood": op4_pseudo_likelihood,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_minhash": op7_minhash,
    "op8_hosts": op8_hosts,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
    "op11_runs": op11_runs,
    "op12_exact": op12_exact,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {"op8_hosts": hosts.oracle(), "op12_exact": exact.ORACLE}
