"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, column, fold, stored

STATISTICS = (
    "log_words", "mean_word", "long_words", "upper", "digits", "marks", "symbols", "pipes", "bangs", "spaces", "not_ascii", "types", "top_word", "repeats", "log_lines", "words_per_line",
    "repeated_lines", "ended_lines", "capital_words", "letter_entropy", "packed",
)
FEATURES, RIDGE, FOLDS, SEED = 192, 1.0, 3, 11
#: Width of the kernel, in standard deviations of a statistic, times the square root of their number.
WIDTH = 0.8
#: Steps of the calibration grid over raw scores of -1 to 2.
GRID = 3000
THRESHOLD = 0.3

_SYMBOLS = re.compile(r"[#$%&*@^~<>=+\\/{}\[\]_]")
_MARKS = re.compile(r"[.,;:?'\"()-]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text, in the order of STATISTICS; an empty text has all 0."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars = len(words), len(text)
    lower = [w.lower() for w in words]
    counts = Counter(lower)
    sizes = list(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    share = letters[letters > 0] / letters.sum()
    raw = text.encode("utf-8", "surrogatepass")
    return [
        math.log1p(n), sum(sizes) / n, sum(s > 12 for s in sizes) / n, len(_UPPER.findall(text)) / chars, len(_DIGIT.findall(text)) / chars,
        len(_MARKS.findall(text)) / chars, len(_SYMBOLS.findall(text)) / chars, text.count("|") / chars, text.count("!") / chars, (chars - sum(sizes)) / chars,
        1 - sum(letters[:128]) / letters.sum(), len(counts) / n, max(counts.values()) / n, sum(map(str.__eq__, lower, lower[1:])) / n, math.log1p(len(lines)), math.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines), sum(x.rstrip()[-1] in ".!?:;\"" for x in lines) / len(lines), sum(w[0].isupper() for w in words) / n, float(-(share * np.log2(share)).sum()), len(zlib.compress(raw, 1)) / len(raw),
    ]


def with_statistics(df: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """`df` with statistics array<double> of each text."""
    bounded_batches(df.sparkSession)
    df = df.drop("statistics")
    fields = [f for f in df.schema if not (drop_text and f.name == text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(x) for x in column(batch, text)]
            keep = [batch.schema.get_field_index(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(rows, pa.list_(pa.float64()))], names=[*(f.name for f in fields), "statistics"])

    return df.mapInArrow(run, T.StructType([*fields, T.StructField("statistics", T.ArrayType(T.DoubleType()))]))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    grid: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = features(x, self.mean, self.scale) @ self.weights
        return np.interp(raw, np.linspace(-1, 2, GRID + 1), self.grid)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Cosines at random frequencies, whose products approximate the Gaussian kernel, and a constant."""
    rng = np.random.default_rng(SEED)
    z = np.clip((x - mean) / scale, -8, 8)
    frequency = rng.normal(size=(x.shape[1], FEATURES)) / (WIDTH * math.sqrt(x.shape[1]))
    phase = rng.uniform(0, 2 * math.pi, FEATURES)
    return np.c_[np.cos(z @ frequency + phase) * math.sqrt(2 / FEATURES), np.ones(len(x))]


def rows_of(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("statistics")).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, len(STATISTICS))


def rising(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic regression of means by pooling neighbours that fall; a value for each bin."""
    pools: list[list[float]] = []
    for s, c in zip(sums.tolist(), counts.tolist()):
        pools.append([s, c, 1])
        while len(pools) > 1 and pools[-2][0] * max(pools[-1][1], 1e-9) >= pools[-1][0] * max(pools[-2][1], 1e-9):
            s2, c2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + s2, pools[-1][1] + c2, pools[-1][2] + n2]
    return np.concatenate([[s / max(c, 1e-9)] * n for s, c, n in pools])


def train(rows: DataFrame) -> Model:
    """Fit all of `rows` (fold, y, statistics): sums of each partition, added up by Spark; the driver solves one small system.

    Calibration uses scores of each row under the model of the other folds.
    Without rows, or with one class only, every score is the (smoothed) share of
    label 1, 0.5 without rows.
    """
    k = len(STATISTICS)
    at = [F.col("statistics")[i] for i in range(k)]
    # gone over three times
    rows = stored(rows.select("fold", "y", "statistics"), "training")
    head = rows.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(at)]).first()
    if not head["n"]:
        return Model(np.zeros(k), np.ones(k), np.zeros(FEATURES + 1), np.full(GRID + 1, 0.5))
    mean = np.array([head[f"m{i}"] for i in range(k)])
    scale = np.array([head[f"s{i}"] if head[f"s{i}"] > 1e-9 else 1.0 for i in range(k)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z, y, f = features(rows_of(batch), mean, scale), np.array(column(batch, "y")), np.array(column(batch, "fold"))
            for i in range(FOLDS):
                own = z[f == i]
                total[i] += own.T @ np.c_[own, y[f == i]]
        for i in range(FOLDS):
            if total[i].any():
                yield pa.RecordBatch.from_arrays([pa.array([i] * (FEATURES + 1), pa.int64()), pa.array(range(FEATURES + 1), pa.int64()), pa.array(list(total[i]), pa.list_(pa.float64()))], names=["fold", "row", "sums"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        # in order of size, so that the sum does not depend on which partition came first
        return pd.DataFrame({"fold": frame["fold"][:1], "row": frame["row"][:1], "sums": [np.sort(np.stack(frame["sums"].to_list()), 0).sum(0)]})

    shape = "fold long, row long, sums array<double>"
    normal = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
    for r in rows.select("fold", "y", "statistics").mapInArrow(sums, shape).groupBy("fold", "row").applyInPandas(added, shape).collect():
        normal[r["fold"], r["row"]] = r["sums"]

    def solved(total: np.ndarray) -> np.ndarray:
        penalty = RIDGE * np.diag([*[1.0] * FEATURES, 1e-6])
        return np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    others = np.stack([solved(normal.sum(0) - normal[i]) if (normal.sum(0) - normal[i]).any() else solved(normal.sum(0)) for i in range(FOLDS)])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, y, f = features(rows_of(batch), mean, scale), np.array(column(batch, "y")), np.array(column(batch, "fold"))
            raw = (z * others[f]).sum(1) if len(f) else np.zeros(0)
            where = np.clip(np.rint((raw + 1) / 3 * GRID), 0, GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(y, pa.float64())], names=["bin", "y"])

    bins = rows.select("fold", "y", "statistics").mapInArrow(binned, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).collect()
    bins.sort(key=lambda r: r["bin"])
    share = (sum(r["y"] for r in bins) + 1) / (sum(r["n"] for r in bins) + 2)
    # each bin leans a little on the share of all
    level = rising(np.array([r["y"] for r in bins]), np.array([float(r["n"]) for r in bins]))
    known = np.array([r["bin"] for r in bins])
    grid = np.interp(np.arange(GRID + 1), known, 0.99 * level + 0.01 * share)
    return Model(mean, scale, solved(normal.sum(0)), np.clip(grid, 0, 1))


def training_rows(statistics_: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(fold, y, statistics) of the labelled rows whose key's crc32 modulo 5 is not 0; null labels don't count, repeated ones count again."""
    known = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull()).select(key, (F.col("quality") > 0).cast("double").alias("y"))
    own = statistics_.where(fold(key, 5) != 0).select(key, "statistics")
    return own.join(known, key).select(F.pmod(F.crc32(F.concat(F.lit("fold"), F.col(key).cast("string")).cast("binary")), F.lit(FOLDS)).alias("fold"), "y", "statistics")


def scored(df: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """`df`, which has statistics, with score (0 to 1) and predicted (1 if score >= threshold) in their place.

    Every row has a score, those of null and empty texts that of no words;
    repeated rows repeat with the same score. Input columns named score or
    predicted are replaced.
    """
    df = df.drop("score", "predicted")
    fields = [f for f in df.schema if f.name != "statistics"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(rows_of(batch))
            keep = [batch.schema.get_field_index(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=[*(f.name for f in fields), "score", "predicted"])

    return df.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
