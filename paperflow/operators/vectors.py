"""Embeddings: encoding, centroids, classification."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_multi
from ..sources.buckets import shared_folder, written
from .dedupe import keep_first

#: Thresholds of similarity, and the category that has pipelines.
RELEVANT, UNCERTAIN = 0.80, 0.65
WITH_PIPELINES = ("computational analysis - method",)
#: Numbers of a learned vector, and hashes of words that it is made from.
DIMENSIONS, FEATURES = 64, 1024


@dataclass(frozen=True)
class Encoder:
    """A trained encoder: the weight of each feature, and what turns weighted features into a vector."""

    weights: np.ndarray
    axes: np.ndarray

    def __call__(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Vectors of unit length of texts, each given by the features that it has and their counts."""
        out = np.zeros((len(counts), self.axes.shape[1]))
        for i, (places, n) in enumerate(counts):
            x = n * self.weights[places]
            out[i] = (x / max(np.linalg.norm(x), 1e-300)) @ self.axes[places]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def hashed_words(df: DataFrame, key: str, text: str, features: int) -> DataFrame:
    """(key, counts): the words of a text, in lower case, counted by hash; a vector of zeros for blank texts."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    return HashingTF(numFeatures=features, inputCol="_words", outputCol="counts").transform(df.select(key, words.alias("_words"))).select(key, "counts")


def train_encoder(counts: DataFrame, dimensions: int = DIMENSIONS) -> Encoder:
    """Latent semantic analysis of all texts: counts weighted by how few texts have a feature, then the directions in which they vary most.

    Weights are Spark's IDF. Of the weighted texts, brought to unit length, Spark
    adds up the products of all pairs of features, a number for each pair however
    many texts there are; their eigenvectors are found on the driver. Each
    direction points to where its largest number is.
    """
    some = counts.where(F.exists(vector_to_array("counts"), lambda x: x > 0))
    idf = IDF(inputCol="counts", outputCol="weighed").fit(some)
    unit = Normalizer(inputCol="weighed", outputCol="unit").transform(idf.transform(some)).select("unit")
    weights = idf.idf.toArray()
    spread = unit.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("unit")).alias("s")).first()["s"]
    mean, deviation, n = spread["mean"].toArray(), np.sqrt(spread["variance"].toArray()), spread["count"]
    together = np.nan_to_num(Correlation.corr(unit, "unit").first()[0].toArray())
    np.fill_diagonal(together, 1.0)
    # about zero, not about the mean: a text without anything in common with another has a cosine of 0
    second = together * np.outer(deviation, deviation) * (n - 1) / n + np.outer(mean, mean)
    _, axes = np.linalg.eigh(second)
    axes = axes[:, ::-1][:, :dimensions]
    return Encoder(weights, axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0))


def learned_embeddings(df: DataFrame, key: str, text: str, dimensions: int = DIMENSIONS, features: int = FEATURES) -> DataFrame:
    """(key, embedding): vectors of the texts by an encoder that is trained on them, so that texts on the same things are near each other; empty ones for blank texts."""
    # gone over several times; texts are split into words once
    counts = written(hashed_words(df, key, text, features), shared_folder(df.sparkSession, "counts"))
    none = F.array().cast("array<float>")
    if counts.where(F.exists(vector_to_array("counts"), lambda x: x > 0)).limit(2).count() < 2:
        # nothing to learn from
        return counts.select(key, F.when(F.exists(vector_to_array("counts"), lambda x: x > 0), F.array_repeat(F.lit(dimensions**-0.5).cast("float"), dimensions)).otherwise(none).alias("embedding"))
    encoder = train_encoder(counts, dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = batch.column(1), batch.column(2)
            found: list = [[] for _ in range(len(batch))]
            rows = [i for i in range(len(batch)) if len(places[i].values)]
            if rows:
                vectors = encoder([(places[i].values.to_numpy(), values[i].values.to_numpy()) for i in rows])
                for i, v in zip(rows, vectors.astype(np.float32)):
                    found[i] = v
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float32()))], names=[key, "embedding"])

    dense = vector_to_array("counts")
    pairs = F.filter(F.transform(dense, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p.x > 0)
    sparse = counts.withColumn("_pairs", pairs).select(key, F.col("_pairs.i").alias("i"), F.col("_pairs.x").alias("x"))
    return sparse.mapInArrow(run, T.StructType([df.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))]))


def embed_text(df: DataFrame, key: str, text: str, encoder: Callable[[list[str]], np.ndarray] | None = None) -> DataFrame:
    """(key, embedding): vectors of the texts by a caller's encoder, or by one that is trained on them; empty ones for blank texts."""
    if encoder is None:
        return learned_embeddings(df, key, text)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [(x or "").strip() for x in frame[text]]
            some = [i for i, x in enumerate(texts) if x]
            found: list[list[float]] = [[] for _ in texts]
            if some:
                for i, v in zip(some, encoder([texts[i] for i in some])):
                    found[i] = [float(x) for x in v]
            yield pd.DataFrame({key: frame[key], "embedding": found})

    return df.select(key, text).mapInPandas(run, T.StructType([df.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))]))


def expand_seeds(seeds: DataFrame, papers: DataFrame, key: str = "doi", with_pipelines: Sequence[str] = WITH_PIPELINES) -> DataFrame:
    """(key, category, pipeline): every category of a seed that has title or abstract; for those with pipelines every pipeline."""
    known = papers.where((F.coalesce("title", F.lit("")) != "") | (F.coalesce("abstract", F.lit("")) != "")).select(key).distinct()
    each = seeds.join(known, key, "left_semi").select(key, F.explode(split_multi(F.col("category"))).alias("category"), split_multi(F.col("pipeline_category")).alias("pipelines"))
    several = F.col("category").isin(*with_pipelines) & (F.size("pipelines") > 0)
    return each.select(key, "category", F.explode(F.when(several, F.col("pipelines")).otherwise(F.array(F.lit("")))).alias("pipeline"))


def centroids(vectors: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """(label, centroid): the mean vector of each label. Numbers are averaged place by place, partially before the shuffle."""
    long = vectors.select(label, F.posexplode(F.col(vector).cast("array<double>")).alias("place", "value"))
    means = long.groupBy(label, "place").agg(F.avg("value").alias("value"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("centroid"))


def centroid_table(found: DataFrame, label: str) -> dict[str, list[float]]:
    """Centroids by label on the driver: a row of numbers for each label, however many rows carry it."""
    return {str(r[label]): list(r["centroid"]) for r in found.toLocalIterator()}


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def relevance_of(score: Column, relevant: float, uncertain: float) -> Column:
    return F.when(score >= relevant, "relevant_by_similarity").when(score >= uncertain, "uncertain_by_similarity").otherwise("low-relevance_by_similarity")


def matrix(table: dict[str, list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """(labels in order, unit centroids as columns)."""
    names = sorted(table)
    rows = np.array([table[n] for n in names], float).reshape(len(names), -1)
    return np.array(names, object), (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)).T


def classify_by_centroid(vectors: DataFrame, main: dict[str, list[float]], pipelines: dict[str, dict[str, list[float]]], relevant: float = RELEVANT, uncertain: float = UNCERTAIN) -> DataFrame:
    """Category of each vector by its nearest centroid, of equals the smaller label; a category that has pipelines is scored again among these.

    Centroids go to the tasks as matrices, and a batch of vectors is multiplied
    by them at once. Null and empty vectors are null in every result.
    """
    tables = {name: matrix(t) for name, t in pipelines.items() if t}
    names, units = matrix(main)
    listed = pa.list_(pa.string())
    kinds = {"score": pa.float64(), "category": pa.string(), "pipeline_category": pa.string(), "nearest": pa.string(), "top_categories": listed, "top_pipeline_categories": listed}

    def ranked(similar: np.ndarray, labels: np.ndarray) -> list[list[str]]:
        """Labels of at least `uncertain`, the most similar first."""
        order = np.argsort(-similar, axis=1, kind="stable")
        return [[labels[k] for k in row if s[k] >= uncertain] for row, s in zip(order, similar)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            at = batch.schema.get_field_index("embedding") if at is None else at
            raw = batch.column(at).to_pylist()
            some = [i for i, v in enumerate(raw) if v]
            out: dict[str, list] = {n: [None] * len(raw) for n in kinds}
            if some and len(names):
                v = np.array([raw[i] for i in some], float)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                similar = v @ units
                best, top = similar.argmax(1), ranked(similar, names)
                for name in set(names[best]):
                    mine = np.flatnonzero(names[best] == name)
                    labels, inner = tables.get(name, (np.array([], object), None))
                    second = v[mine] @ inner if len(labels) else None
                    tops = ranked(second, labels) if len(labels) else [[]] * len(mine)
                    for row, k in enumerate(mine.tolist()):
                        pipeline = labels[second[row].argmax()] if len(labels) else ""
                        score = second[row].max() if len(labels) else similar[k, best[k]]
                        values = (float(score), name, pipeline, f"{name}::{pipeline}" if len(labels) else name, top[k], tops[row])
                        for column, value in zip(out.values(), values):
                            column[some[k]] = value
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, kinds[n]) for n, x in out.items())], names=[*batch.schema.names, *out])

    strings = T.ArrayType(T.StringType())
    types = {n: T.DoubleType() if n == "score" else strings if n.startswith("top_") else T.StringType() for n in kinds}
    found = vectors.drop(*kinds, "relevance").mapInArrow(run, T.StructType([*(f for f in vectors.schema if f.name not in {*kinds, "relevance"}), *(T.StructField(n, t) for n, t in types.items())]))
    rounded = found.withColumn("score", F.round("score", 4))
    return rounded.withColumn("relevance", F.when(F.col("score").isNotNull(), relevance_of(F.col("score"), relevant, uncertain)))


def join_classification(papers: DataFrame, found: DataFrame, seeds: DataFrame, order: str, key: str = "doi") -> DataFrame:
    """Papers with their class, defaults for those without a vector, and the curated labels of seeds: both from a key's first row by `order`."""
    first = keep_first(seeds.select(key, "category", "pipeline_category", order), key, order)
    curated = first.select(key, F.col("category").alias("original_curated_category"), F.col("pipeline_category").alias("original_curated_pipeline_category"), F.lit(True).alias("is_seed"))
    joined = papers.join(found, key, "left").join(curated, key, "left")
    no = F.array().cast("array<string>")
    return joined.withColumns({"relevance": F.coalesce("relevance", F.lit("no_embedding_data")), "category": F.coalesce("category", F.lit("")), "pipeline_category": F.coalesce("pipeline_category", F.lit("")), "top_categories": F.coalesce("top_categories", no), "score": F.coalesce("score", F.lit(0.0)), "is_seed": F.coalesce("is_seed", F.lit(False))})
