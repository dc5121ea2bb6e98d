"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle hashes yields two values, the least and the
greatest, each of which two sets share with probability equal to their Jaccard
similarity. 192 permutations give 64 bands of 6 values; two sets of similarity
0.75 meet in no band with a probability below 4e-6, less than with independent
values, since the least and the greatest of a permutation are in different
bands.

Equal sets are one class before anything is paired. In each band's bucket the
members are compared with its hub, the member with the fullest buckets, which in
a group of edited copies is the text they come from. What is linked then needs
no further comparison; only those that are still apart meet, block by block. Links
are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILE_CLEANUP, bounded_batches, column, setting, shared_dir, stored, temporary
from .graph import components

WIDTH, PERCENT = 5, 75
PERMUTATIONS, ROWS = 192, 6
#: Low bytes of so many signature values, for an estimate of a pair's similarity; 0.62 is more than 5 deviations below 0.75.
SKETCH, LEAST = 2 * PERMUTATIONS, 0.62
#: Members of a family that meet in one task, on either side, and their shingles (8 MB); a longer text is in a block of few others.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20

_rng = np.random.default_rng(20240607)
_MULTIPLY = (_rng.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]
_WEIGHTS = _rng.integers(0, 2**62, max(WIDTH, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word 5-grams; of the whole sequence if it is shorter; empty without words."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and space, tab to carriage return
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < WIDTH:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - WIDTH + 1
    s = h[:n] * _WEIGHTS[0]
    for k in range(1, WIDTH):
        s += h[k : n + k] * _WEIGHTS[k]
    return np.unique(mixed(s))


def extremes(values: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value under each permutation."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(x), block):
        h = _MULTIPLY * x[at : at + block] + _ADD
        np.minimum(low, h.min(1), out=low)
        np.maximum(high, h.max(1), out=high)
    return low, high


def buckets(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = np.concatenate([low, high]).reshape(-1, ROWS).astype(np.uint64)
    keys = (rows * _WEIGHTS[:ROWS]).sum(1, dtype=np.uint64) + np.arange(len(rows), dtype=np.uint64) * _WEIGHTS[0]
    return mixed(keys).view(np.int64)


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether 100 * intersection >= 75 * union, of full sets."""
    if 100 * min(len(one), len(other)) < PERCENT * max(len(one), len(other)):
        return False
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= PERCENT * (len(one) + len(other) - common)


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n_shingles, content, bands, sketch) of each row; content tells equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, content, bands, sketch = [], [], [], []
            for x in column(batch, "text"):
                values = shingles(x)
                n.append(len(values))
                if not len(values):
                    content.append(None)
                    bands.append(None)
                    sketch.append(None)
                    continue
                low, high = extremes(values)
                content.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                bands.append(buckets(low, high))
                sketch.append(np.concatenate([low, high]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(content, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())], names=["id", "n_shingles", "content", "bands", "sketch"])

    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, n_shingles long, content binary, bands array<long>, sketch binary")


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose set sizes and sketches allow the similarity asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(column(batch, c)), np.uint8).reshape(-1, SKETCH) for c in ("sketch_a", "sketch_b"))
            keep = (x == y).mean(1) >= LEAST
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    side = lambda s: nodes.select(F.col("id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= 75 * union. texts: (id, text) of every node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", shingles(""))
        for batch in batches:
            keep = []
            for x, y in zip(column(batch, "text_a"), column(batch, "text_b")):
                if x != last[0]:
                    last = x, shingles(x)
                keep.append(similar(last[1], shingles(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # rows come sorted by the hub, so its set is made once for a run of pairs
    with_b = pairs.join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    both = with_b.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def hashed(texts: DataFrame) -> DataFrame:
    """(id, values) of (id, text): the sorted shingle hashes, hashed once however many tasks meet them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((shingles(x).tobytes() for x in column(batch, "text")), pa.binary())], names=["id", "values"])

    return texts.select("id", "text").mapInArrow(run, "id long, values binary")


def common(one: list[np.ndarray], other: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set of `one`, the sizes of its intersections with all of `other`, counted over one sorted list of these."""
    values = np.concatenate([*other, np.array([], np.uint64)])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(len(other)), [len(x) for x in other])[order]
    for x in one:
        first = np.searchsorted(values, x, "left")
        n = np.searchsorted(values, x, "right") - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield np.bincount(owner[at], minlength=len(other))


def leftovers(members: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between members of one family (id, component, main) that are in different components.

    A family is the largest component of some bucket, main, and all that share
    such a bucket with it. Its members are dealt into blocks of bounded rows and
    shingles, and every block of those outside main meets every block: a task
    holds two blocks of sets, counts what they have in common without taking
    pairs one by one, and only links leave it.
    """
    outside = F.col("component") != F.col("main")
    sized = members.join(nodes.groupBy("id").agg(F.max("n_shingles").alias("n")), "id")
    blocks = lambda c: F.ceil(F.greatest(F.count_if(c) / BLOCK, F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES))
    sizes = sized.groupBy("main").agg(blocks(outside).alias("nx"), blocks(~outside).alias("ny"))
    deal = F.pmod(F.xxhash64("id"), F.when(outside, F.col("nx")).otherwise(F.col("ny")))
    dealt = members.join(sizes, "main").withColumn("block", F.when(outside, deal).otherwise(F.col("nx") + deal))
    # every pair of blocks i <= j of which i is outside main
    low = F.transform(F.sequence(F.lit(0), F.least(F.col("block"), F.col("nx") - 1)), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    high = F.when(F.col("block") + 1 < F.col("nx") + F.col("ny"), F.transform(F.sequence(F.col("block") + 1, F.col("nx") + F.col("ny") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))))
    cells = dealt.withColumn("cell", F.explode(F.when(outside & high.isNotNull(), F.concat(low, high)).otherwise(low))).select("main", "cell.i", "cell.j", "block", "id", "component")
    sets = stored(hashed(texts.join(members.select("id").distinct(), "id", "left_semi")), "sets")
    whole = cells.join(sets, "id")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        one, two = frame[frame["block"] == i], frame[frame["block"] == j]
        (ids, component, values), (ids2, component2, values2) = ((x["id"].to_numpy(), x["component"].to_numpy(), [np.frombuffer(v, np.uint64) for v in x["values"]]) for x in (one, two))
        size = np.array([len(v) for v in values2], np.int64)
        found = []
        for x, shared in enumerate(common(values, values2)):
            linked = (100 * shared >= PERCENT * (len(values[x]) + size - shared)) & (shared > 0) & (component2 != component[x])
            if i == j:
                linked &= ids2 > ids[x]
            found += [(min(ids[x], y), max(ids[x], y)) for y in ids2[linked].tolist()]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return whole.groupBy("main", "i", "j").applyInPandas(run, "a long, b long")


def versions(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of all texts that share an id."""
    many = sets.groupBy("id").agg(F.min("content").alias("least"), F.max("content").alias("most")).where("least <> most").select("id")
    of_id = stored(sets.select("id", "content").join(many, "id", "left_semi").distinct().join(classes.withColumnRenamed("id", "representative"), "content").select("id", "representative"), "versions")
    return of_id.groupBy("id").agg(F.min("representative").alias("a")).join(of_id, "id").select("a", F.col("representative").alias("b")).where("a <> b").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of `df`.

    A document's set is that of `shingles`. component_id is the smallest key
    that can be reached over links, kept tells whether it is the row's own.
    Documents without words link with nothing. Rows of null key are in no
    component (component_id null) and are kept. Repeated rows repeat in the
    result; rows of one key with different texts are versions of one document,
    linked by any of them. The result is written to the shared folder, and what
    is stored on the way is removed.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = shared_dir(spark, "near-duplicates")
    with temporary(spark):
        found = grouped(df, key, text)
        with setting(spark, FILE_CLEANUP, "true"):
            found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def grouped(df: DataFrame, key: str, text: str) -> DataFrame:
    """As `near_duplicates`, over tables that stay."""
    spark = df.sparkSession
    rows = stored(signatures(df, key, text), "signatures")
    sets = rows.where("content is not null and id is not null")
    classes = stored(sets.groupBy("content").agg(F.min("id").alias("id")), "classes")
    nodes = stored(sets.join(classes, ["content", "id"], "left_semi").select("id", "n_shingles", "sketch", "bands").dropDuplicates(["id", "sketch"]), "nodes")
    members = nodes.select("id", F.explode("bands").alias("bucket"))
    full = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(members.join(full, "bucket"), "buckets")
    popular = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = shared.join(popular, "id").select("bucket", "id", "weight")
    hubs = weighed.groupBy("bucket").agg(F.max(F.struct("weight", -F.col("id"))).alias("hub")).select("bucket", (-F.col("hub.col2")).alias("a"))
    stars = stored(shared.select("bucket", F.col("id").alias("b")).join(hubs, "bucket").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    involved = shared.select("id").distinct()
    texts = stored(df.select(F.col(key).alias("id"), F.col(text).alias("text")).join(involved, "id", "left_semi").dropDuplicates(), "texts")
    links = stored(confirmed(likely(stars, nodes), texts).union(versions(sets, classes)), "links")
    if not links.isEmpty():
        found = components(links)
    else:
        found = spark.createDataFrame([], "node long, component long")

    # members of a bucket that are still apart: those outside its largest component, against all others
    state = stored(shared.join(found.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")), "state")
    parts = state.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    apart = parts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts")).where("parts > 1").select("bucket", F.col("most.component").alias("main"))
    more = stored(leftovers(state.join(apart, "bucket").select("id", "component", "main").distinct(), nodes, texts), "links")
    if not more.isEmpty():
        found = components(links.union(more))

    of_class = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select("content", F.coalesce("component", "id").alias("component_id"))
    # a row without words belongs to the other texts of its id
    wordless = rows.where("content is null and id is not null").select("id").distinct()
    of_id = sets.select("id", "content").join(wordless, "id", "left_semi").join(of_class, "content").groupBy("id").agg(F.min("component_id").alias("of_id"))
    joined = rows.select("id", "n_shingles", "content").join(of_class, "content", "left").join(of_id, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "of_id", "id"))
    return joined.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
