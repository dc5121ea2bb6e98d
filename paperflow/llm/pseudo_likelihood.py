"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network reads the two words on either side of each word and predicts its
class; within a class a word has its share of the corpus. Frequent words are
classes of their own, the others are grouped by the company they keep. What
other places of the corpus hold between the same two neighbours is counted and
weighed against the network by how many different words stand there. A
document's score is the sum over its words of the log-probability of each,
given both sides.

Documents are dealt into groups by their content. One group trains a first
network, all others go on from it side by side, and their results are averaged,
so the outcome does not depend on how the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import window_counts as W
from .common import column, stored

#: Types of words: so many frequent words, and the endings of the others. One more stands beyond a document's ends.
FREQUENT = 8192
TYPES = FREQUENT + W.ENDINGS
#: The most frequent types are classes of their own, the others fall into SHARED classes.
OWN, SHARED = 40, 24
CLASSES = OWN + SHARED
#: The most frequent types by whose company all types are told apart.
COMPANY = 64
SIDE, WIDTH, HIDDEN = 2, 16, 24
BATCH, SEED = 2048, 5
#: Steps of the first network and of those that go on from it; they shrink to a tenth, and to nothing.
RATE, LATER = 0.01, 0.004
#: Words of a training group, and documents whose repeats a task adds up before it sends them.
GROUP_WORDS, KNOWN_TEXTS = 1_000_000, 500_000
#: Words scored at once.
BLOCK = 8192
#: Tasks of a stage that is dealt out by group or chunk; more of these share tasks.
MOST_TASKS = 20_000
#: Weights are summed as whole numbers of this many parts, so that their order does not matter.
PARTS = 1 << 20
SHAPES = {"mix": (2 * SIDE * WIDTH, HIDDEN), "shift": (HIDDEN,), "out": (HIDDEN, CLASSES), "bias": (CLASSES,)}


@dataclass
class Vocabulary:
    """What the corpus says about words: their types and classes, and where types stand (a row of numbers each)."""

    frequent: np.ndarray
    rank: np.ndarray
    kind: np.ndarray
    log_size: np.ndarray
    space: np.ndarray

    def types(self, keys: np.ndarray) -> np.ndarray:
        return types_of(self.frequent, self.rank, keys)


def types_of(frequent: np.ndarray, rank: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Type of each word: its rank among the frequent ones (sorted keys and their ranks), else that of its ending."""
    ending = FREQUENT + (keys & np.uint64(W.ENDINGS - 1)).astype(np.int64)
    if not len(frequent):
        return ending
    at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
    return np.where(frequent[at] == keys, rank[at], ending)


def neighbours(types: np.ndarray, sizes: np.ndarray, distance: int) -> np.ndarray:
    """Places of words that have one of the same document at a distance after them."""
    document = np.repeat(np.arange(len(sizes)), sizes)
    return np.flatnonzero(document[:-distance] == document[distance:]) if len(types) > distance else np.zeros(0, np.int64)


def company(chunks: DataFrame, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences of each type, how often each of the COMPANY types stands before and after it within SIDE words), summed by Spark."""
    width = 1 + 2 * COMPANY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TYPES * width, np.int64)
        for batch in batches:
            for sizes, vocab, at in zip(*(column(batch, c) for c in ("sizes", "vocab", "at"))):
                keys, at = W.words_of(vocab, at)
                t, sizes = types_of(frequent, rank, keys)[at], np.array(sizes, np.int64)
                total += np.bincount(t * width, minlength=len(total))
                for d in range(1, SIDE + 1):
                    i = neighbours(t, sizes, d)
                    for own, other, side in ((t[i], t[i + d], 1 + COMPANY), (t[i + d], t[i], 1)):
                        near = other < COMPANY
                        total += np.bincount(own[near] * width + side + other[near], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])

    found = chunks.select("sizes", "vocab", "at").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(TYPES * width, np.int64)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    out = out.reshape(TYPES, width)
    return out[:, 0], out[:, 1:]


def placed(counts: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Types as points of WIDTH numbers, principal components of their company; a row of zeros beyond the documents' ends.

    Types that occur seldom lean on the company of all.
    """
    whole = near.sum(0) + 1.0
    mean = whole / whole.sum()
    share = (near + 50 * mean) / (near.sum(1, keepdims=True) + 50)
    x = np.sqrt(share) - np.sqrt(mean)
    weight = np.sqrt(counts)[:, None]
    _, axes = np.linalg.eigh((x * weight).T @ (x * weight))
    axes = axes[:, ::-1][:, :WIDTH]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(WIDTH)] < 0, -1, 1)
    y = x @ axes
    spread = np.sqrt((y**2 * weight).sum(0) / max(weight.sum(), 1e-9))
    return np.vstack([y / np.maximum(spread, 1e-3), np.zeros(WIDTH)]).astype(np.float32)


def clusters(points: np.ndarray, weight: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """k-means from points chosen one by one, each the heaviest by its distance to those before it."""
    centre = points[[int(weight.argmax())]]
    gap = ((points - centre[0]) ** 2).sum(1)
    while len(centre) < k:
        centre = np.vstack([centre, points[int((gap * weight).argmax())]])
        gap = np.minimum(gap, ((points - centre[-1]) ** 2).sum(1))
    for _ in range(rounds):
        own = ((centre**2).sum(1) - 2 * points @ centre.T).argmin(1)
        mass = np.bincount(own, weight, k)
        sums = np.stack([np.bincount(own, weight * points[:, j], k) for j in range(points.shape[1])], 1)
        centre = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centre)
    return ((centre**2).sum(1) - 2 * points @ centre.T).argmin(1)


def learned_vocabulary(chunks: DataFrame, found: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary, and the number of words in each class."""
    keys, _ = W.frequent_words(found, FREQUENT)
    order = np.argsort(keys)
    frequent, rank = keys[order], order.astype(np.int64)
    counts, near = company(chunks, frequent, rank)
    space = placed(counts, near)
    kind = np.arange(TYPES)
    kind[OWN:] = OWN + clusters(space[OWN:-1].astype(np.float64), counts[OWN:].astype(np.float64), SHARED)
    size = np.bincount(kind, counts, CLASSES)
    return Vocabulary(frequent, rank, kind, np.log(np.maximum(size, 1)), space), size


def windows(types: np.ndarray, sizes: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The types on both sides of each word, or of those at some places; TYPES beyond a document's ends."""
    end = np.repeat(np.cumsum(sizes), sizes)
    begin = end - np.repeat(sizes, sizes)
    if at is None:
        at = np.arange(len(types))
    else:
        begin, end = begin[at], end[at]
    out = np.full((len(at), 2 * SIDE), TYPES, np.int64)
    for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        there = at + d
        ok = (there >= begin) & (there < end)
        out[ok, k] = types[there[ok]]
    return out


def initial(size: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    net = {n: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32) for n, s in SHAPES.items()}
    share = (size + 0.5) / (size + 0.5).sum()
    return net | {"shift": np.zeros(HIDDEN, np.float32), "out": net["out"] * np.float32(0.1), "bias": np.log(share).astype(np.float32)}


def slopes(net: dict[str, np.ndarray], x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the weighted cross-entropy of some words; weights add up to 1."""
    hidden = np.tanh(x @ net["mix"] + net["shift"])
    p = hidden @ net["out"]
    p += net["bias"]
    p -= p.max(1, keepdims=True)
    np.exp(p, out=p)
    p *= (weight / p.sum(1))[:, None]
    p[np.arange(len(p)), target] -= weight
    back = (p @ net["out"].T) * (1 - hidden * hidden)
    return {"out": hidden.T @ p, "bias": p.sum(0), "mix": x.T @ back, "shift": back.sum(0)}


def step(net: dict[str, np.ndarray], slope: dict[str, np.ndarray], memory: dict, t: int, rate: float) -> None:
    """One step of Adam, in place."""
    for name, g in slope.items():
        m, v = memory.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        net[name] -= np.float32(rate) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def parts(texts: list, limit: int = 400_000) -> Iterator[list]:
    """Consecutive (types, weight) of about `limit` words."""
    held, size = [], 0
    for x in texts:
        held.append(x)
        size += len(x[0])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def fitted(net: dict[str, np.ndarray], texts: list[tuple[np.ndarray, int]], kind: np.ndarray, space: np.ndarray, rate: float, last: float) -> tuple[dict[str, np.ndarray], int]:
    """(net, words) after one pass over all words of some texts (types, number of copies), in their order; steps go from `rate` to `last`."""
    net, memory, t = {n: w.copy() for n, w in net.items()}, {}, 0
    steps = max(1, sum(len(x) for x, _ in texts) // BATCH)
    for part in parts(texts):
        types, sizes = np.concatenate([x for x, _ in part]), np.array([len(x) for x, _ in part])
        copies = np.repeat(np.array([n for _, n in part], np.float32), sizes)
        # a window never holds its own word, so every word of every document is a target
        chosen = np.random.default_rng(SEED).permutation(len(types))
        context, target, copies = windows(types, sizes, chosen), kind[types[chosen]], copies[chosen]
        for a in range(0, len(chosen), BATCH):
            at = slice(a, a + BATCH)
            t += 1
            w = copies[at] / copies[at].sum()
            step(net, slopes(net, space[context[at]].reshape(-1, 2 * SIDE * WIDTH), target[at], w), memory, t, rate + (last - rate) * min(1.0, t / steps))
    return net, sum(len(x) * n for x, n in texts)


def texts_by_group(chunks: DataFrame, vocabulary: Vocabulary, groups: int, first: bool) -> DataFrame:
    """(grp, content, n, types): documents that have words, of the first group or of all others. Types come once from a task, repeats as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}

        def repeats() -> Iterator[pa.RecordBatch]:
            some = [(k, n) for k, n in seen.items() if n]
            seen.clear()
            if some:
                yield pa.RecordBatch.from_arrays([pa.array([k % groups for k, _ in some], pa.int64()), pa.array([k for k, _ in some], pa.int64()), pa.array([n for _, n in some], pa.int64()), pa.array([None] * len(some), pa.binary())], names=["grp", "content", "n", "types"])

        for batch in batches:
            for sizes, vocab, at in zip(*(column(batch, c) for c in ("sizes", "vocab", "at"))):
                keys, at = W.words_of(vocab, at)
                types, rows, end = vocabulary.types(keys).astype(np.uint16), [], 0
                for size in sizes:
                    own, end = at[end : end + size], end + size
                    if not size:
                        continue
                    content = xxhash.xxh3_64_intdigest(keys[own].tobytes()) >> 1
                    if (content % groups == 0) != first:
                        continue
                    if content in seen:
                        seen[content] += 1
                        continue
                    seen[content] = 0
                    rows.append((content % groups, content, 1, W.packed(types[own])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["grp", "content", "n", "types"])
                if len(seen) > KNOWN_TEXTS:
                    yield from repeats()
        yield from repeats()

    return chunks.select("sizes", "vocab", "at").mapInArrow(run, "grp long, content long, n long, types binary")


def trained(chunks: DataFrame, vocabulary: Vocabulary, start: dict[str, np.ndarray], n_words: int) -> dict[str, np.ndarray]:
    """A network trained on every word of every document: the first group alone, then the others from there, averaged by their words."""
    groups = 1 + n_words // GROUP_WORDS
    kind, space = vocabulary.kind, vocabulary.space

    def learning(net: dict[str, np.ndarray], rate: float, last: float) -> DataFrame:
        def run(table: pa.Table) -> pa.Table:
            copies: dict[int, int] = {}
            types: dict[int, bytes] = {}
            for c, n, t in zip(*(table[x].to_pylist() for x in ("content", "n", "types"))):
                copies[c] = copies.get(c, 0) + n
                if t is not None:
                    types[c] = t
            made, words = fitted(net, [(W.unpacked(types[c], np.uint16).astype(np.int64), copies[c]) for c in sorted(types)], kind, space, rate, last)
            values = np.concatenate([made[n].ravel() for n in SHAPES]).astype(np.float64)
            return pa.table({"place": np.arange(len(values)), "value": np.rint(values * PARTS).astype(np.int64), "words": np.full(len(values), words, np.int64)})

        rows = texts_by_group(chunks, vocabulary, groups, rate == RATE)
        # groups are small as bytes and long as work, so they must not be put together by size
        each = rows.repartition(min(groups, MOST_TASKS), "grp").groupBy("grp").applyInArrow(run, "place long, value long, words long")
        weight = F.col("words").cast("decimal(18,0)")
        return each.groupBy("place").agg(F.sum(F.col("value").cast("decimal(18,0)") * weight).alias("value"), F.sum(weight).alias("words"))

    net = start
    for rate, last in ((RATE, RATE / 10), (LATER, 0.0))[: 1 + (groups > 1)]:
        rows = learning(net, rate, last).select("place", (F.col("value").cast("double") / F.col("words").cast("double")).alias("value")).toArrow()
        if not rows.num_rows:
            continue
        values = np.empty(rows.num_rows)
        values[rows["place"].to_numpy()] = rows["value"].to_numpy() / PARTS
        ends = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1]
        net = {n: x.reshape(s).astype(np.float32) for (n, s), x in zip(SHAPES.items(), np.split(values, ends))}
    return net


def class_log_probabilities(net: dict[str, np.ndarray], vocabulary: Vocabulary, types: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log-probability of each word's class given both sides."""
    context = windows(types, sizes)
    # what each type adds to the hidden layer, at each place
    added = [vocabulary.space @ net["mix"][k * WIDTH : (k + 1) * WIDTH] for k in range(2 * SIDE)]
    kind = vocabulary.kind[types]
    out = np.empty(len(types))
    for a in range(0, len(types), BLOCK):
        at = slice(a, a + BLOCK)
        hidden = added[0][context[at, 0]]
        for k in range(1, 2 * SIDE):
            hidden += added[k][context[at, k]]
        hidden += net["shift"]
        np.tanh(hidden, out=hidden)
        logits = hidden @ net["out"]
        logits += net["bias"]
        own = logits[np.arange(len(hidden)), kind[at]]
        top = logits.max(1)
        logits -= top[:, None]
        np.exp(logits, out=logits)
        out[at] = own - top - np.log(logits.sum(1))
    return out


def scored(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, pll, per_word, counted_pll, counted_per_word) of every row, under a network and counts made from all rows of `df`.

    pll is the sum of the log-probabilities that the network gives each word
    from both sides, per_word its mean. The counted ones weigh the network
    against what other places of the corpus hold between the same two
    neighbours, so that texts that occur twice stand out. 0 and null for texts
    that are null or have no words. Repeated rows repeat in the result. Other columns are not read.
    """
    chunks = stored(W.chunked(df, key, text), "chunks", compression="zstd")
    n_words = W.total_words(chunks)
    buckets = W.bucket_count(n_words)
    found = stored(W.met(W.sent(chunks, buckets), n_words), "windows", compression="zstd")
    vocabulary, size = learned_vocabulary(chunks, found)
    net = trained(chunks, vocabulary, initial(size), n_words)

    def run(chunk: pa.Table, rows: pa.Table) -> pa.Table:
        names = [key, "n_words", "pll", "per_word", "counted_pll", "counted_per_word"]
        out: list[list] = [[] for _ in names]
        for ids, sizes, vocab, at in zip(*(chunk[c].to_pylist() for c in ("ids", "sizes", "vocab", "at"))):
            keys, at = W.words_of(vocab, at)
            sizes = np.array(sizes, np.int64)
            total, known, left = W.answers(keys, at, sizes, rows.to_pylist(), buckets)
            types = vocabulary.types(keys)
            share = np.log(total) - vocabulary.log_size[vocabulary.kind[types]]
            alone = class_log_probabilities(net, vocabulary, types[at], sizes) + share[at]
            both = np.log(known + left * np.exp(alone))
            ends = np.cumsum(sizes)
            whole, plain = (np.r_[0.0, np.cumsum(x)] for x in (both, alone))
            whole, plain = whole[ends] - whole[ends - sizes], plain[ends] - plain[ends - sizes]
            mean = lambda x: np.where(sizes > 0, x / np.maximum(sizes, 1), np.nan)
            for column_, values in zip(out, (ids, sizes, plain, mean(plain), whole, mean(whole))):
                column_.extend(values)
        kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
        return pa.Table.from_arrays([pa.array(x, t, from_pandas=True) for x, t in zip(out, kinds)], names=names)

    tasks = min(1 + n_words // W.CHUNK_WORDS, MOST_TASKS)
    both = chunks.repartition(tasks, "chunk").groupBy("chunk").cogroup(found.where("chunk >= 0").repartition(tasks, "chunk").groupBy("chunk"))
    return both.applyInArrow(run, f"{key} long, n_words long, pll double, per_word double, counted_pll double, counted_per_word double")
