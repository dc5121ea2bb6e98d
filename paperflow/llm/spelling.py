"""Spelling variants: words one edit apart, found by a frontier of states on a trie in tables.

The trie of all words is a table of edges (node, label, child); words of one
length share nodes, and there is a second trie of the words read backwards. A
state is (word, node, what is left of the word); without an edit it stands on
the word's own path. An edit in the latter half of a word is made in the first
trie, one in the former half in the other, so that it comes after at least half
of the word has been read: few branches are left there. A letter is passed over
to reach a word that lacks it, or exchanged for another one, and then the rest
must be read exactly, level by level: each level is a join of all states with
the edges, which are labelled with blocks of letters, the largest power of two
that the rest holds. So a level at least halves the rest, and the number of
levels is the logarithm of the longest word. Words of one letter more are found
from the other side. Nodes and labels are 64-bit hashes; every pair found is
compared by letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, column, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
#: Letters in one step of the making of states; a longer word is a step of its own.
LETTERS = 1 << 17
#: Words of a batch that are counted together before they leave a task.
COUNTED = 1 << 18

_rng = np.random.default_rng(20250301)
_BASE = np.uint64(int(_rng.integers(2**40, 2**62)) * 2 + 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SALT = _rng.integers(1, 2**62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lower(word: str) -> str:
    """A-Z alone."""
    return word.lower() if word.isascii() else word.encode("utf-8").lower().decode("utf-8")


def typo(key: int | None, word: str) -> str:
    """One word in 31, told by the document and the word, loses a letter; without a key none does."""
    if key is None:
        return word
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def counted(df: DataFrame, key: str = "doc_id", text: str = "text", change: Callable[[int | None, str], str] | None = None, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(id, word, n): the words of at least so many letters that occur at least so often in all texts, written to the shared folder.

    A word is a run of letters up to U+00FF, A-Z in lower case; `change` is
    applied to every word of a document and makes none longer. Null and empty texts have none.
    """
    bounded_batches(df.sparkSession)

    def table_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for k, x in zip(column(batch, "key"), column(batch, "text")):
                own: Counter = Counter()
                for word, n in Counter(RUN.findall(x or "")).items():
                    if len(word) >= least_letters:
                        own[lower(word)] += n
                if change is None:
                    counts.update(own)
                    continue
                for word, n in own.items():
                    changed = change(k, word)
                    if len(changed) >= least_letters:
                        counts[changed] += n
            if len(counts) > COUNTED:
                yield table_of(counts)
                counts = Counter()
        yield table_of(counts)

    words = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    totals = words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    return stored(totals.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


class Reading:
    """Words read forwards or backwards: hashes of all prefixes and blocks."""

    def __init__(self, words: list[str], backwards: bool):
        self.backwards = np.uint64(backwards)
        self.length = np.array([len(w) for w in words], np.int64)
        text = "".join(w[::-1] if backwards else w for w in words)
        self.letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.first = np.cumsum(self.length) - self.length
        longest = int(self.length.max(initial=0)) + 2
        with np.errstate(over="ignore"):
            self.power, self.inverse = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(longest, b, np.uint64), dtype=np.uint64)]) for b in (_BASE, _INVERSE))
            place = np.arange(len(self.letters)) - np.repeat(self.first, self.length)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.letters + np.uint64(1)) * self.power[place], dtype=np.uint64)])

    def prefix(self, word: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.sums[self.first[word] + end] - self.sums[self.first[word]]

    def block(self, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[self.first[word] + end] - self.sums[self.first[word] + start]) * self.inverse[start]

    def node(self, word: np.ndarray, depth: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The node after `depth` letters, in the trie of words of that length."""
        x = self.prefix(word, depth) * _SALT[0] + length.astype(np.uint64) * _SALT[1] + self.backwards * _SALT[2]
        x = (x ^ (x >> np.uint64(31))) * _SALT[3]
        return (x ^ (x >> np.uint64(29))).view(np.int64)

    def places(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, place) for all places from start to before end."""
        n = np.maximum(end - start, 0)
        word = np.repeat(np.arange(len(n)), n)
        return word, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def step(left: np.ndarray) -> np.ndarray:
    """Letters of the block that is read next: the largest power of two that is left, 0 if none is."""
    return np.where(left > 0, 1 << np.log2(np.maximum(left, 1)).astype(np.int64), 0)


def label(r: Reading, word: np.ndarray, at: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.array(r.block(word, at, at + size).view(np.int64))


def labels(r: Reading, word: np.ndarray, at: np.ndarray) -> pa.Array:
    """The labels of all blocks from a place to the word's end."""
    found, used = [], []
    left = r.length[word] - at
    while (left > 0).any():
        size = step(left)
        found.append(r.block(word, at, at + size).view(np.int64))
        used.append(size > 0)
        at, left = at + size, left - size
    if not found:
        return pa.array([[]] * len(word), pa.list_(pa.int64()))
    values, mask = np.stack(found, 1), np.stack(used, 1)
    ends = np.concatenate([[0], np.cumsum(mask.sum(1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[mask]))


def edges_of(r: Reading, ids: np.ndarray) -> list[pa.Array]:
    """(node, label, child) of each word's path, from where an edit can be followed on."""
    half = (r.length + 1) // 2 if not r.backwards else r.length // 2 + 1
    word, at = r.places(half, r.length)
    size = step(r.length[word] - at)
    return [pa.array(r.node(word, at, r.length[word])), label(r, word, at, size), pa.array(r.node(word, at + size, r.length[word]))]


def shortened(r: Reading, ids: np.ndarray) -> list[pa.Array]:
    """States (id, node, rest) that have passed over a letter; of equal letters in a row over the last."""
    word, at = r.places(r.length // 2 if not r.backwards else (r.length + 1) // 2, r.length)
    here = r.first[word] + at
    last = at + 1 == r.length[word]
    keep = last | (r.letters[here] != r.letters[np.where(last, here, here + 1)])
    word, at = word[keep], at[keep]
    return [pa.array(ids[word]), pa.array(r.node(word, at, r.length[word] - 1)), labels(r, word, at + 1)]


def exchanged(r: Reading, ids: np.ndarray) -> list[pa.Array]:
    """Both the states (id, node, letter, label, rest) before an exchange of a letter and the edges (node, letter, label, child) over any letter and the block behind it."""
    word, at = r.places(r.length // 2 if not r.backwards else (r.length + 1) // 2, r.length)
    size = step(r.length[word] - at - 1)
    after = at + 1 + size
    letter = pa.array(r.letters[r.first[word] + at].astype(np.int32))
    return [pa.array(ids[word]), pa.array(r.node(word, at, r.length[word])), letter, label(r, word, at + 1, size), pa.array(r.node(word, after, r.length[word])), labels(r, word, after)]


def ends_of(r: Reading, ids: np.ndarray) -> list[pa.Array]:
    """(node, id) of the node where each word ends."""
    word = np.arange(len(ids))
    return [pa.array(r.node(word, r.length, r.length)), pa.array(ids)]


def made(words: DataFrame, make: Callable[[Reading, np.ndarray], list[pa.Array]], schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = np.array(column(batch, "id"), np.int64), column(batch, "word")
            start = 0
            while start < len(texts):
                end, total = start + 1, len(texts[start])
                while end < len(texts) and total + len(texts[end]) <= LETTERS:
                    total += len(texts[end])
                    end += 1
                for backwards in (False, True):
                    yield pa.RecordBatch.from_arrays(make(Reading(texts[start:end], backwards), ids[start:end]), names=names)
                start = end

    return words.select("id", "word").mapInArrow(run, schema)


def key_of(*names: str | Column) -> Column:
    return F.xxhash64(*names)


def candidates(words: DataFrame) -> DataFrame:
    """(a, b): pairs of ids whose words may be one edit apart; no such pair is left out, b is not the longer word."""
    edges = made(words, edges_of, "node long, label long, child long").select(key_of("node", "label").alias("at"), "child")
    edges = stored(edges.repartition("at").dropDuplicates(), "edges")
    branches = made(words, exchanged, "id long, node long, letter int, label long, child long, rest array<long>").select(key_of("node", "label").alias("at"), "id", "letter", "child", "rest")
    dealt = branches.repartition("at")
    over = dealt.select("at", F.col("letter").alias("other"), "child").dropDuplicates()
    changed = dealt.select("at", "id", "letter", "rest").join(over, "at").where("letter < other").select("id", F.col("child").alias("node"), "rest")
    states = stored(made(words, shortened, "id long, node long, rest array<long>").unionByName(changed), "frontier")
    ended = []
    longest = words.agg(F.coalesce(F.max(F.char_length("word")), F.lit(0))).first()[0]
    for _ in range(max(1, longest).bit_length()):
        ended.append(states.where("size(rest) = 0").select("id", "node"))
        going = states.where("size(rest) > 0").select("id", key_of(F.col("node"), F.col("rest")[0]).alias("at"), F.expr("slice(rest, 2, size(rest))").alias("rest"))
        states = stored(going.join(edges, "at").select("id", F.col("child").alias("node"), "rest"), "frontier")
        if states.isEmpty():
            break
    else:
        ended.append(states.where("size(rest) = 0").select("id", "node"))
    last = made(words, ends_of, "node long, id long").withColumnRenamed("id", "b")
    reached = ended[0]
    for more in ended[1:]:
        reached = reached.unionByName(more)
    return reached.join(last, "node").select(F.col("id").alias("a"), "b").distinct()


def near(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for all words exactly one inserted, deleted or replaced letter apart, both ways."""
    side = lambda s: words.select(F.col("id").alias(s), F.struct("word", "n").alias(f"of_{s}"))
    pairs = candidates(words).join(side("a"), "a").join(side("b"), "b").where(F.levenshtein("of_a.word", "of_b.word", 1) == 1)
    both = pairs.select(F.explode(F.array(F.struct(F.col("of_a").alias("x"), F.col("of_b").alias("y")), F.struct(F.col("of_b").alias("x"), F.col("of_a").alias("y")))).alias("p"))
    return both.select("p.x.word", "p.x.n", F.col("p.y.word").alias("near"), F.col("p.y.n").alias("near_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), form not null: the last word on the way along forms.

    A form is at least TIMES as frequent as its word, so a way is no longer than
    the logarithm of the largest count; its length halves each round.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        ways = moved.select("word", "root")


def grouped(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (id, word, n).

    The form is the near word of largest n, of the first in the order of code
    points among equals, if its n is at least `times` that of the word. A word
    without near words is its own root, with n_near 0 and no form.
    """
    best = near(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best"))
    fits = -F.col("best.n") >= times * F.col("n")
    formed = stored(best.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n")), "forms")
    found = words.join(formed, "word", "left").join(rooted(formed.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
