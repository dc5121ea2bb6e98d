"""The similarity graph of papers."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import annotation_to_text
from ..sources.buckets import Folder, shared_folder

#: Neighbours of a node, and the least similarity of an edge.
NEIGHBOURS, LEAST = 10, 0.7
#: Numbers in a block of vectors (32 MB); blocks that vectors are dealt into as long as these are not larger, and the least rows of one.
BLOCK_NUMBERS, BLOCKS, BLOCK_ROWS = 1 << 22, 16, 1024
#: Rows of a block that are multiplied at once by so many others, and pairs of them that are then looked at closely at once.
SLAB, OTHERS, PAIRS = 512, 8192, 1 << 14
#: Vectors of a cell on average, and the most cells: their centres and counts are on the driver.
CELL_ROWS, CELLS = 256, 1024
#: Ranges into which distinct values are dealt to be numbered.
RANGES = 64
#: Rounds of a layout after which its vectors are made orthonormal.
EVERY = 4
#: Citations up to which a node has each size.
SIZES = ((4, 5), (24, 8), (49, 12), (99, 16))
LARGEST = 20


@dataclass(frozen=True)
class Cells:
    """Unit vectors around which all others are dealt; blocks of neighbouring cells, and which pairs of cells can hold an edge.

    block[c] and parts[c] tell a cell's first block and over how many it is
    dealt; near[c, d] whether the widest angles of two cells leave room for one.
    """

    centres: np.ndarray
    block: np.ndarray
    parts: np.ndarray
    near: np.ndarray

    def pairs(self) -> np.ndarray:
        """(i, j), i <= j: the blocks that must meet, those of cells that can hold an edge."""
        c, d = np.nonzero(self.near)
        found = {(int(x), int(y)) for c, d in zip(c, d) for x in range(self.block[c], self.block[c] + self.parts[c]) for y in range(self.block[d], self.block[d] + self.parts[d]) if x <= y}
        return np.array(sorted(found), int).reshape(-1, 2)

    def blocks(self) -> int:
        return int((self.block + self.parts).max(initial=0))


def units(vectors: Sequence) -> np.ndarray:
    m = np.asarray(vectors, float) if isinstance(vectors, np.ndarray) else np.array([np.asarray(v, float) for v in vectors])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def units_of(column: pa.ListArray) -> np.ndarray:
    """Unit vectors of a column of lists, which must be of one length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError(f"vectors of {lengths.min()} to {lengths.max()} numbers")
    return units(column.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), -1))


def with_cells(known: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, v, cell, angle): the cell of each vector, the nearest centre's, and how far it is from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                similar = units_of(batch.column("v")) @ centres.T
                cell = similar.argmax(1)
                angle = np.arccos(np.clip(similar[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype("int32")), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    return known.mapInArrow(run, T.StructType([*known.schema, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())]))


def centres_of(known: DataFrame, n: int) -> np.ndarray:
    """n vectors far apart: of 4 n drawn by a hash of their id always the one that is furthest from those taken before. So cells are narrow, not of equal size."""
    drawn = units([r["v"] for r in known.orderBy(F.xxhash64("id")).limit(4 * n).collect()])
    taken, nearest_of = [0], drawn @ drawn[0]
    while len(taken) < min(n, len(drawn)):
        taken.append(int(nearest_of.argmin()))
        nearest_of = np.maximum(nearest_of, drawn @ drawn[taken[-1]])
    return drawn[taken]


def cells_of(sizes: dict[int, int], widest: dict[int, float], centres: np.ndarray, least: float, most: int) -> Cells:
    """Cells with rows put in a row, each next to its nearest neighbour that is not placed yet, and cut into blocks of at most `most` rows; a larger cell is dealt over several."""
    n = len(centres)
    angles = np.arccos(np.clip(centres @ centres.T, -1, 1))
    wide = np.array([widest.get(c, 0.0) for c in range(n)])
    used = np.array([c in sizes for c in range(n)])
    # far less than any angle that matters, far more than what rounding adds
    near = (angles - wide[:, None] - wide[None, :] <= np.arccos(np.clip(least, -1, 1)) + 1e-6) & used[:, None] & used[None, :]
    block, parts = np.zeros(n, int), np.zeros(n, int)
    left, at, filled, here = set(sizes), 0, 0, next(iter(sorted(sizes)), None)
    while left:
        left.remove(here)
        if filled and filled + sizes[here] > most:
            at, filled = at + 1, 0
        block[here], parts[here] = at, -(-sizes[here] // most)
        filled += sizes[here]
        if parts[here] > 1:
            at, filled = at + parts[here], 0
        rest = np.array(sorted(left), int)
        here = int(rest[angles[here, rest].argmin()]) if len(rest) else None
    return Cells(centres, block, parts, near)


def plan_cells(known: DataFrame, least: float, most: int, cells: int) -> Cells:
    """Cells for these vectors: a row of counts for each cell comes to the driver."""
    centres = centres_of(known, cells)
    found = with_cells(known, centres).groupBy("cell").agg(F.count("*").alias("rows"), F.max("angle").alias("angle")).collect()
    return cells_of({r["cell"]: r["rows"] for r in found}, {r["cell"]: r["angle"] for r in found}, centres, least, most)


def similarity_edges(vectors: DataFrame, key: str, k: int = NEIGHBOURS, least: float = LEAST, symmetric: bool = False, block_rows: int | None = None, cells: int | None = None) -> DataFrame:
    """(source, target, weight): of each node's k nearest by cosine those of at least `least`, where source < target.

    Like its model, it keeps a pair only if the smaller node lists the larger;
    `symmetric` also keeps those that only the larger lists. The result is exact:
    vectors are dealt into cells around some of them, and two cells meet unless
    the angle between their centres, less the widest angle within each, already
    rules `least` out. Neighbouring cells make up blocks of at most BLOCK_NUMBERS
    numbers; a block is a task, past which the vectors of all blocks that it
    meets are led in batches while it keeps the k nearest of each row. So a
    vector is copied once for each block that its block meets: for clustered
    vectors few, for vectors without any clusters all, as in any exact search.
    With `least` of 0 or less nothing is ruled out.
    """
    known = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col(key).isNotNull())
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    known = known.select(F.col(key).alias("id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"))
    if least > 0:
        # a vector of zeros is like none
        known = known.where(F.exists("v", lambda x: x != 0))
    size = known.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width")).first()
    kind = known.schema["id"].dataType.simpleString()
    if not size["rows"]:
        return known.select(F.col("id").alias("source"), F.col("id").alias("target"), F.lit(0.0).alias("weight"))
    most = block_rows or max(1, min(BLOCK_NUMBERS // size["width"], max(BLOCK_ROWS, math.ceil(size["rows"] / BLOCKS))))
    plan = plan_cells(known, least, most, cells or min(CELLS, max(1, math.ceil(size["rows"] / CELL_ROWS))))
    near = plan.near
    met = [[] for _ in range(plan.blocks())]
    for i, j in plan.pairs().tolist():
        met[i].append(j)
        if i != j:
            met[j].append(i)
    array = lambda x: F.from_json(F.lit(json.dumps(x)), "array<array<int>>")
    place = F.get(array(np.stack([plan.block, plan.parts], 1).tolist()), F.col("cell"))
    block = (place[0] + F.pmod(F.xxhash64("id"), F.greatest(place[1], F.lit(1)))).cast("int")
    dealt = with_cells(known, plan.centres).withColumn("block", block)
    spread = dealt.withColumn("at", F.explode(F.get(array(met), F.col("block")))).select("at", (F.col("block") != F.col("at")).alias("other"), "block", "cell", "id", "v")
    # a block's own rows come first
    led = spread.repartitionById(len(met), F.col("at")).sortWithinPartitions("at", "other", "block", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, block = None, [], None
        for here, other, part in parts_of(batches):
            if here != at:
                if at is not None:
                    yield (block or Block(own, near, k, least)).listed()
                at, own, block = here, [], None
            if not other:
                own.append(part)
            elif own:
                block = block or Block(own, near, k, least)
                block.meet(*part)
        if at is not None and own:
            yield (block or Block(own, near, k, least)).listed()

    found = led.mapInArrow(run, f"source {kind}, near array<struct<w double, target {kind}>>")
    # a row per node, or more where its id is repeated
    best = found.groupBy("source").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    listed = best.select("source", F.explode("near").alias("n")).select("source", F.col("n.target").alias("target"), (-F.col("n.w")).alias("weight"))
    if symmetric:
        return listed.select(F.least("source", "target").alias("source"), F.greatest("source", "target").alias("target"), "weight").groupBy("source", "target").agg(F.max("weight").alias("weight"))
    return listed.where(F.col("source") < F.col("target"))


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, tuple[pa.Array, np.ndarray, np.ndarray]]]:
    """(block, whether of others, (ids, cells, unit vectors)) of rows in order of these, at most OTHERS at once; batches are put together."""

    def done(held: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        columns = [pa.concat_arrays([b.column(n) for b in held]) for n in ("id", "cell", "v")]
        return columns[0], columns[1].to_numpy(zero_copy_only=False), units_of(columns[2])

    held, n, now = [], 0, None
    for batch in batches:
        place = batch.column("at").to_numpy() * 2 + batch.column("other").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
        for start, end in zip(cuts, cuts[1:]):
            for a in range(start, end, OTHERS):
                rows = min(OTHERS, end - a)
                if held and (now != place[a] or n + rows > OTHERS):
                    yield int(now) // 2, bool(now % 2), done(held)
                    held, n = [], 0
                held.append(batch.slice(a, rows))
                n, now = n + rows, place[a]
    if held:
        yield int(now) // 2, bool(now % 2), done(held)


def plain(ids: pa.Array) -> np.ndarray:
    if pa.types.is_integer(ids.type):
        return ids.to_numpy(zero_copy_only=False)
    found = np.empty(len(ids), object)
    found[:] = ids.to_pylist()
    return found


class Block:
    """The k nearest of each row of a block among all rows that it meets, of equals the smaller id; a row is not its own neighbour.

    Similarities are found in single precision first. What that can be off by
    never decides: pairs that may be among the nearest are worked out in double
    precision, one by one, so that equal vectors are equally near wherever they
    stand. They are held back and sorted in when there are as many as a row has
    neighbours, or when the rows met have doubled.
    """

    def __init__(self, own: list[tuple[pa.Array, np.ndarray, np.ndarray]], near: np.ndarray, k: int, least: float):
        self.kind, self.near, self.k, self.least = own[0][0].type, near, k, least
        self.ids, self.cell, self.rows = (np.concatenate(x) for x in zip(*((plain(i), c, v) for i, c, v in own)))
        self.single = self.rows.astype(np.float32)
        # of a sum of so many products, and what both vectors lose
        self.off = (self.rows.shape[1] + 4) * 2.0**-23
        n = len(self.ids)
        self.weight, self.other = np.full((n, k), -np.inf), np.repeat(self.ids[:, None], k, 1)
        self.bound, self.begun = np.full(n, float(least)), np.zeros(n, bool)
        self.held, self.n_held, self.met, self.sorted_at = [], 0, 0, 0
        for part in own:
            self.meet(*part)

    def meet(self, ids: pa.Array, cell: np.ndarray, rows: np.ndarray) -> None:
        ids, columns = plain(ids), rows.astype(np.float32).T
        mine = np.flatnonzero(self.near[:, np.unique(cell)].any(1)[self.cell])
        for at in range(0, len(mine), SLAB):
            part = mine[at : at + SLAB]
            m = self.single[part] @ columns
            if m.shape[1] > self.k and not self.begun[part].all():
                # one more than k, since a row may be among them
                self.bound[part] = np.maximum(self.bound[part], np.partition(m, -self.k - 1, axis=1)[:, -self.k - 1] - self.off)
                self.begun[part] = True
            found = np.flatnonzero((m >= (self.bound[part] - self.off).astype(np.float32)[:, None]).ravel())
            for a in range(0, len(found), PAIRS):
                row, column = np.divmod(found[a : a + PAIRS], m.shape[1])
                self.hold(part[row], ids[column], np.einsum("ij,ij->i", self.rows[part[row]], rows[column]))
        self.met += len(ids)
        if self.n_held and self.met >= 2 * self.sorted_at:
            self.sort_in()

    def hold(self, row: np.ndarray, other: np.ndarray, weight: np.ndarray) -> None:
        last = self.weight[row, -1]
        keep = (weight >= self.least) & (self.ids[row] != other) & ((weight > last) | ((weight == last) & (other < self.other[row, -1])))
        self.held.append((row[keep], other[keep], weight[keep]))
        self.n_held += int(keep.sum())
        if self.n_held > max(PAIRS, self.k * len(self.ids)):
            self.sort_in()

    def sort_in(self) -> None:
        row, other, weight = (np.concatenate(x) for x in zip(*self.held))
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, self.k), row])
        other = np.concatenate([self.other[touched].ravel(), other])
        weight = np.concatenate([self.weight[touched].ravel(), weight])
        place = np.unique(other, return_inverse=True)[1] if other.dtype == object else other
        order = np.lexsort((place, -weight, row))
        starts = np.searchsorted(row[order], touched)
        best = order[starts[:, None] + np.arange(self.k)]
        self.other[touched], self.weight[touched] = other[best], weight[best]
        self.bound[touched] = np.maximum(self.bound[touched], self.weight[touched, -1])
        self.held, self.n_held, self.sorted_at = [], 0, self.met

    def listed(self) -> pa.RecordBatch:
        """(source, near): the negative weights of its neighbours, and their ids."""
        if self.n_held:
            self.sort_in()
        some = self.weight > -np.inf
        ends = np.concatenate([[0], some.sum(1).cumsum()]).astype(np.int32)
        near = pa.StructArray.from_arrays([pa.array(-self.weight[some]), pa.array(self.other[some].tolist(), self.kind)], names=["w", "target"])
        return pa.RecordBatch.from_arrays([pa.array(self.ids.tolist(), self.kind), pa.ListArray.from_arrays(pa.array(ends), near)], names=["source", "near"])


def project_2d(vectors: DataFrame, key: str) -> DataFrame:
    """(key, x, y): the two principal components; each points to where its largest loading is positive."""
    rows = vectors.where(F.size("embedding") > 0).select(key, array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    model = PCA(k=2, inputCol="v", outputCol="p").fit(rows)
    loads = model.pc.toArray()
    signs = np.sign(loads[np.abs(loads).argmax(0), [0, 1]])
    p = vector_to_array("p")
    return model.transform(rows).select(key, (p[0] * float(signs[0])).alias("x"), (p[1] * float(signs[1])).alias("y"))


def spectral_layout(edges: DataFrame, key: str = "id", rounds: int = 24, width: int = 6, folder: str | None = None) -> DataFrame:
    """(key, x, y): a layout that puts neighbours of an undirected weighted graph (source, target, weight) near each other.

    x and y are the second and third eigenvectors of its normalised adjacency
    matrix A, over the square roots of the degrees, as spectral layouts have
    them. They are found by orthogonal iteration over tables, with `width`
    vectors at once: a round joins the edges with the numbers of one end and
    adds them up at the other. The first eigenvector, known from the degrees, is
    taken out; products of the vectors, `width` squared numbers, come to the
    driver every few rounds to make them orthonormal, and last to turn them to
    where A acts along them. The matrix iterated is (I + A) / 2, so that the
    largest eigenvalues come first. Numbers are written below `folder`, which
    cuts the lineage. Nodes without edges are in no row.
    """
    tables = Rounds(edges.sparkSession, folder)
    # read four times below
    edges = tables.written(edges.select("source", "target", "weight"))
    both = edges.select("source", "target", "weight").union(edges.select("target", "source", "weight")).where("source <> target").groupBy("source", "target").agg(F.max("weight").cast("double").alias("weight"))
    root = tables.written(both.groupBy(F.col("source").alias("id")).agg(F.sqrt(F.sum("weight")).alias("root")))
    ends = lambda side: root.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
    half = both.join(ends("source"), "source").join(ends("target"), "target").select("source", "target", (F.col("weight") / (2 * F.col("source_root") * F.col("target_root"))).alias("w"))
    links = tables.written(half.union(root.select("id", "id", F.lit(0.5))))

    def moved(rows: DataFrame) -> DataFrame:
        """(id, v) times (I + A) / 2; the root, last of v, stays as it is."""
        at = links.join(rows.withColumnRenamed("id", "target"), "target").groupBy(F.col("source").alias("id"))
        return at.agg(F.array(*[F.sum(F.col("w") * F.col("v")[i]) for i in range(width + 1)]).alias("v"))

    now = tables.written(root.select("id", F.array(*[F.xxhash64("id", F.lit(i)) / F.lit(2.0**63) for i in range(width)], "root").alias("v")), True)
    for n in range(rounds):
        now = moved(now)
        if n % EVERY == EVERY - 1 or n == rounds - 1:
            now = tables.written(now, True)
            now = turned(now, orthonormal(now, width))
    now = tables.written(now, True)
    both_ends = now.join(moved(now).withColumnRenamed("v", "p"), "id")
    acts = products(both_ends, "v", "p", width)
    _, axes = np.linalg.eigh((acts + acts.T) / 2)
    turn = np.zeros((width + 1, 3))
    turn[:width, :2], turn[width, 2] = axes[:, ::-1][:, :2], 1
    placed = turned(now, turn).select("id", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"), F.col("v")[2].alias("root"))
    # each axis points to where its largest number is, of equals the one of the smallest id
    signs = placed.agg(*[F.min_by(F.signum(n), F.struct(-F.round(F.abs(F.col(n)), 9), F.col("id"))).alias(n) for n in ("x", "y")]).first()
    return placed.select(F.col("id").alias(key), *[(F.col(n) * (signs[n] or 1.0) / F.col("root")).alias(n) for n in ("x", "y")])


def products(rows: DataFrame, one: str, other: str, size: int) -> np.ndarray:
    """Of two array columns the sums of all products of a number of one and a number of the other."""
    sums = rows.agg(*[F.sum(F.col(one)[i] * F.col(other)[j]) for i in range(size) for j in range(size)]).first()
    return np.array([v or 0.0 for v in sums]).reshape(size, size)


def orthonormal(rows: DataFrame, width: int) -> np.ndarray:
    """What to multiply the vectors of rows (id, v), of which the root is the last, by so that the others are orthogonal to it and to each other and of length 1; vectors that depend on others become zeros."""
    gram = products(rows, "v", "v", width + 1)
    along = gram[:width, width] / (gram[width, width] or 1.0)
    values, axes = np.linalg.eigh(gram[:width, :width] - np.outer(along, gram[:width, width]))
    scale = np.where(values > 1e-12 * max(values.max(), 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    turn = np.zeros((width + 1, width + 1))
    turn[:width, :width] = (scale[:, None] * axes.T).T
    turn[width, :width], turn[width, width] = -(turn[:width, :width].T @ along), 1
    return turn


def turned(rows: DataFrame, by: np.ndarray) -> DataFrame:
    """Rows (id, v) with v times a matrix; its columns are the new vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(by)) @ by
            ends = np.arange(len(batch) + 1, dtype=np.int32) * by.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(new.ravel()))], names=["id", "v"])

    # a matrix that changes is data: an expression of its numbers would be compiled anew each time
    return rows.select("id", "v").mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("v", T.ArrayType(T.DoubleType()))]))


class Rounds:
    """Tables of the rounds of an iteration, in a folder of their own; those of a round go when the next one is written."""

    def __init__(self, spark: SparkSession, path: str | None):
        self.spark, self.path, self.n, self.last = spark, path or shared_folder(spark, "rounds"), 0, None

    def written(self, df: DataFrame, replaces: bool = False) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.path}/{self.n}")
        if replaces:
            if self.last is not None:
                Folder(self.spark, self.path).remove(str(self.last))
            self.last = self.n
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.n}")


def node_table(df: DataFrame, key: str, display: Sequence[str], raw: dict[str, str]) -> DataFrame:
    """A node for each paper: id, place, attributes as text, and the lists that are filtered by."""
    kinds = {f.name: f.dataType for f in df.schema}
    shown = [annotation_to_text(F.col(c), kinds[c]).alias(c) if c in kinds else F.lit("").alias(c) for c in display]
    lists = [F.coalesce(F.col(c), F.array().cast("array<string>")).alias(name) if isinstance(kinds.get(c), T.ArrayType) else F.lit(None).cast("string").alias(name) for name, c in raw.items()]
    place = [F.col(c) if c in kinds else F.lit(None).cast("double").alias(c) for c in ("x", "y")]
    return df.select(F.col(key).alias("id"), *place, *shown, *lists)


def node_size(citations: Column) -> Column:
    out = F.lit(LARGEST)
    for most, size in reversed(SIZES):
        out = F.when(citations <= most, size).otherwise(out)
    return out


def dense_ranks(values: DataFrame, name: str, ranges: int = RANGES) -> DataFrame:
    """(name, rank): the place of each distinct value in their order, from 0, over all tasks; null has none.

    Values are dealt into ranges around a few of them, numbered within each, and
    lifted by the number of values in the ranges before. To the driver come the
    bounds alone.
    """
    distinct = values.select(name).where(F.col(name).isNotNull()).distinct()
    bounds = sorted(r[name] for r in distinct.orderBy(F.xxhash64(name)).limit(ranges).collect())
    lower = F.array(*map(F.lit, bounds)).cast(T.ArrayType(distinct.schema[name].dataType))
    dealt = distinct.withColumn("_range", F.size(F.filter(lower, lambda x: x <= F.col(name))))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    # one row for each range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(name)) - 1
    lifted = dealt.withColumn("_number", number).join(sizes.select("_range", before.alias("_before")), "_range")
    return lifted.select(name, (F.col("_before") + F.col("_number")).alias("rank"))


def node_style(nodes: DataFrame, citations: str, categories: str) -> DataFrame:
    """Size class, logarithmic size, first category, and a palette index in order of label."""
    n = F.coalesce(F.col(citations), F.lit(0))
    styled = nodes.withColumns({"size": node_size(n), "log_size": 8 + 5 * F.log1p(n / 100.0), "first_category": F.coalesce(F.get(F.col(categories), F.lit(0)), F.lit("Unknown"))})
    index = dense_ranks(styled, "first_category").withColumnRenamed("rank", "colour")
    return styled.join(index, "first_category")


def visible_edges(edges: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """Edges between nodes that are shown, with the places of both ends."""
    end = lambda side: nodes.select(F.col(key).alias(side), F.col("x").alias(f"{side}_x"), F.col("y").alias(f"{side}_y"))
    return edges.join(end("source"), "source").join(end("target"), "target")
