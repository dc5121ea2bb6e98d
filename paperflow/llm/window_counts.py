"""Words of documents in chunks, and what the rest of the corpus holds at each word's place.

A chunk is the words of some documents: its distinct words, and the place of
each word among these. Chunks send the keys of their distinct words and windows
(the words on both sides, and the word between them), counted, to buckets; a
bucket adds them up over all chunks and sends back what each key needs. All of
it grows with the corpus, no key is dropped, and a key that is everywhere
reaches its bucket once from each chunk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, column
from .minhash import mixed

#: Words of a chunk (a longer text is a chunk of its own), documents of one, and keys of a bucket.
CHUNK_WORDS, CHUNK_TEXTS, BUCKET_KEYS = 1_000_000, 50_000, 2_000_000
#: A word's key has BITS bits, of which the lower ones tell its last letters.
BITS, ENDINGS, LAST = 48, 1 << 10, 3
#: Letters that are split into words at once; longer texts are cut between words.
PIECE = 1 << 20
#: Letters without white space beyond which a text is cut anywhere: places within a chunk have powers up to 2^24.
LONGEST = 1 << 22
#: Multiplier of the words' hashes, and its inverse modulo 2^64.
POWER = 0x9E3779B97F4A7C15
INVERSE = pow(POWER, -1, 1 << 64)
#: Words that make up at least this share of the corpus are listed: at most 2^18 words.
LISTED = 1 / (1 << 18)
EDGE = np.uint64(0x9E3779B97F4A7C15)
LEFT, RIGHT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

_SPACE = re.compile(r"\s")

CHUNKS = "chunk long, ids array<long>, sizes array<int>, vocab binary, at binary"
SENT = "bucket long, chunk long, vocab binary, vocab_n binary, windows binary, windows_n binary"
MET = "chunk long, bucket long, vocab binary, total binary, some binary, same binary, others binary, kinds binary"


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T).tobytes())


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def rising(values: np.ndarray) -> bytes:
    """Sorted numbers, by their steps."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def risen(raw: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpacked(raw, kind), dtype=kind)


@lru_cache(maxsize=1)
def letter_kinds() -> np.ndarray:
    """0 for white space, 1 for letters, digits and the underscore, 2 for all else, by code point."""
    letters = np.arange(0x110000, dtype=np.uint32).view("<U1")
    kinds = np.where(np.char.isalnum(letters), 1, np.where(np.char.isspace(letters), 0, 2)).astype(np.uint8)
    kinds[ord("_")] = 1
    return kinds


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """POWER to the 0, 1, 2 and so on, and INVERSE, modulo 2^64."""
    out = np.empty((2, 1 << 12), np.uint64)
    for row, base in zip(out, (POWER, INVERSE)):
        row[:] = base
        row[0] = 1
        np.cumprod(row, out=row)
    return out[0], out[1]


def power_of(place: np.ndarray, which: int) -> np.ndarray:
    """A power for each place up to 2^24."""
    low = powers()[which]
    high = np.empty(1 << 12, np.uint64)
    high[:] = pow((POWER, INVERSE)[which], 1 << 12, 1 << 64)
    high[0] = 1
    np.cumprod(high, out=high)
    return low[place & 0xFFF] * high[place >> 12]


def pieces(text: str) -> Iterator[str]:
    """A long text cut between words; where LONGEST letters are without white space, within one, whose parts count as words."""
    at = 0
    while len(text) - at > PIECE:
        m = _SPACE.search(text, at + PIECE, at + PIECE + LONGEST)
        end = m.start() if m else min(len(text), at + PIECE + LONGEST)
        if end == len(text):
            break
        yield text[at:end]
        at = end
    yield text[at:]


def word_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the words of all texts, number of words of each): runs of letters and digits, or of neither, in lower case."""
    code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = letter_kinds()[code]
    change = np.flatnonzero(np.diff(kind, prepend=np.uint8(0), append=np.uint8(0)))
    # text ends in white space, so every change but those to white space begins a word, and the next change ends it
    begins = np.flatnonzero(kind[np.minimum(change, len(kind) - 1)] > 0)
    first = change[begins]
    end = change[begins + 1] if len(begins) else first
    letters = code.astype(np.uint64)
    sums = np.zeros(len(code) + 1, np.uint64)
    place = np.arange(len(code))
    np.cumsum(letters * power_of(place, 0), out=sums[1:])
    whole = mixed(mixed((sums[end] - sums[first]) * power_of(first, 1)) + (end - first).astype(np.uint64))
    last = letters[end - 1]
    for k in range(2, LAST + 1):
        last = last << np.uint64(21) | np.where(end - k >= first, letters[np.maximum(end - k, 0)], np.uint64(0))
    keys = whole >> np.uint64(64 - BITS) & ~np.uint64(ENDINGS - 1) | mixed(last) & np.uint64(ENDINGS - 1)
    begin = np.cumsum([0, *(len(x) + 1 for x in texts)])
    return keys, np.diff(np.searchsorted(first, begin))


class Chunk:
    """Words of documents; texts are held until there are enough letters to split."""

    def __init__(self) -> None:
        self.ids, self.keys, self.sizes, self.held, self.letters, self.size = [], [], [], [], 0, 0

    def split(self) -> None:
        keys, sizes = word_keys([x for _, x in self.held])
        for (n, _), size in zip(self.held, sizes.tolist()):
            self.sizes[n] += size
        self.keys.append(keys)
        self.size += len(keys)
        self.held, self.letters = [], 0

    def add(self, key: int | None, text: str | None) -> None:
        self.ids.append(key)
        self.sizes.append(0)
        for piece in pieces((text or "").lower()):
            self.held.append((len(self.ids) - 1, piece))
            self.letters += len(piece)
            if self.letters >= PIECE:
                self.split()

    def row(self, chunk: int) -> pa.RecordBatch:
        self.split()
        vocab, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        arrays = [pa.array([chunk]), pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.sizes], pa.list_(pa.int32())), pa.array([rising(vocab)], pa.binary()), pa.array([packed(at.astype(place_kind(len(vocab))))], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["chunk", "ids", "sizes", "vocab", "at"])


def place_kind(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def chunked(df: DataFrame, key: str, text: str) -> DataFrame:
    """CHUNKS of all rows; null and empty texts have no words. Write it before use: chunks are numbered by partition."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Chunk()
        for batch in batches:
            for k, t in zip(column(batch, "id"), column(batch, "text")):
                held.add(k, t)
                if held.size >= CHUNK_WORDS or len(held.ids) >= CHUNK_TEXTS:
                    yield held.row(number)
                    number, held = number + 1, Chunk()
        if held.ids:
            yield held.row(number)

    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, CHUNKS)


def words_of(vocab: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the distinct words, sorted, and the place of each word among them) of a chunk."""
    keys = risen(vocab, np.uint64)
    return keys, unpacked(at, place_kind(len(keys)))


def total_words(chunks: DataFrame) -> int:
    return chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).first()["n"] or 0


def bucket_count(n: int) -> int:
    return 1 + n // BUCKET_KEYS


def starts_of_buckets(n: int, bits: int) -> np.ndarray:
    """The least hash of `bits` bits in each of n buckets, which divide the hashes in order."""
    return np.array([-(-(b << bits) // n) for b in range(n)], np.uint64)


def window_bits(buckets: int) -> int:
    """Bits of a window's key that tell its sides apart; 16 more tell the word."""
    return min(48, 32 + (buckets - 1).bit_length())


def window_keys(words: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """A key for each word: hashes of its two sides, then of itself."""
    left, right = np.roll(words, 1), np.roll(words, -1)
    ends = np.cumsum(sizes)[sizes > 0]
    left[ends - sizes[sizes > 0]] = EDGE
    right[ends - 1] = EDGE
    sides = mixed(left * LEFT + right * RIGHT) >> np.uint64(64 - bits)
    return sides << np.uint64(16) | words >> np.uint64(24) & np.uint64(0xFFFF)


def sent(chunks: DataFrame, buckets: int) -> DataFrame:
    """SENT: of each chunk and bucket the distinct keys of words and windows, sorted, with their counts."""
    bits = window_bits(buckets)
    edges, word_edges = starts_of_buckets(buckets, bits) << np.uint64(16), starts_of_buckets(buckets, BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, sizes, vocab, at in zip(*(column(batch, c) for c in ("chunk", "sizes", "vocab", "at"))):
                keys, at = words_of(vocab, at)
                windows, windows_n = np.unique(window_keys(keys[at], np.array(sizes, np.int64), bits), return_counts=True)
                words, words_n = keys, np.bincount(at, minlength=len(keys))
                a, b = (np.r_[np.searchsorted(x, e), len(x)] for x, e in ((words, word_edges), (windows, edges)))
                rows = [(k, chunk, rising(words[a[k] : a[k + 1]]), packed(words_n[a[k] : a[k + 1]]), rising(windows[b[k] : b[k + 1]]), packed(windows_n[b[k] : b[k + 1]])) for k in np.flatnonzero(np.diff(a) + np.diff(b)).tolist()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=[x.split()[0] for x in SENT.split(", ")])

    return chunks.select("chunk", "sizes", "vocab", "at").mapInArrow(run, SENT)


def others_at(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(same, others, kinds) for each window of a bucket, which may repeat: of how many other words between the same sides how many are this one, and how many are distinct."""
    order = np.argsort(keys, kind="stable")
    sorted_, n = keys[order], counts[order]
    first = np.r_[True, sorted_[1:] != sorted_[:-1]][: len(keys)]
    begin = np.flatnonzero(first)
    of_word = np.add.reduceat(n, begin) if len(begin) else n
    sides = sorted_[begin] >> np.uint64(16)
    side_begin = np.flatnonzero(np.r_[True, sides[1:] != sides[:-1]][: len(sides)])
    length = np.diff(np.r_[side_begin, len(sides)])
    of_sides = np.repeat(np.add.reduceat(of_word, side_begin) if len(side_begin) else of_word, length)
    same = of_word - 1
    found = np.stack([same, of_sides - 1, np.repeat(length, length) - (same == 0)])
    out = np.empty((3, len(keys)), np.int64)
    out[:, order] = found[:, np.cumsum(first) - 1]
    return out[0], out[1], out[2]


def met(rows: DataFrame, n_words: int) -> DataFrame:
    """MET of what chunks sent: for each chunk and bucket the words' totals in the corpus, and `others_at` of the windows of which there are others.

    Rows of chunk -1 list the frequent words of a bucket and their totals.
    """
    least = max(2, LISTED * n_words)

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        got = {c: table[c].to_pylist() for c in ("chunk", "vocab", "vocab_n", "windows", "windows_n")}
        vocab, windows = ([risen(x, np.uint64) for x in got[c]] for c in ("vocab", "windows"))
        n = np.concatenate([unpacked(x, np.int64) for x in got["vocab_n"]])
        words, where = np.unique(np.concatenate(vocab), return_inverse=True)
        total = np.bincount(where, n, len(words)).astype(np.int64)
        around = others_at(np.concatenate(windows), np.concatenate([unpacked(x, np.int64) for x in got["windows_n"]]))
        often = total >= least
        rows = [(-1, bucket, packed(words[often]), packed(total[often]), b"", b"", b"", b"")] if often.any() else []
        a = b = 0
        of_key = total[where]
        for chunk, v, w in zip(got["chunk"], vocab, windows):
            own = [x[b : b + len(w)] for x in around]
            some = np.flatnonzero(own[1])
            rows.append((chunk, bucket, b"", packed(of_key[a : a + len(v)]), rising(some.astype(np.uint32)), *(packed(x[some]) for x in own)))
            a, b = a + len(v), b + len(w)
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in MET.split(", ")])

    return rows.repartition(min(bucket_count(n_words), 20_000), "bucket").groupBy("bucket").applyInArrow(run, MET)


def frequent_words(found: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, totals) of the most frequent words, at most `most`, of equals the smaller key; listed ones only, so few reach the driver."""
    rows = [(unpacked(r["vocab"], np.uint64), unpacked(r["total"], np.int64)) for r in found.where("chunk = -1").select("vocab", "total").toLocalIterator()]
    keys, n = np.concatenate([np.zeros(0, np.uint64), *(r[0] for r in rows)]), np.concatenate([np.zeros(0, np.int64), *(r[1] for r in rows)])
    order = np.lexsort((keys, -n))[:most]
    return keys[order], n[order]


def answers(vocab: np.ndarray, at: np.ndarray, sizes: np.ndarray, rows: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(total of each distinct word, known and left of each word) of a chunk from the rows of MET that answer it.

    A word's probability is known + left * that of a model: if of n other words
    between the same sides k are this one and t are distinct, known is
    k / (n + t) and left t / (n + t); without other words 0 and 1.
    """
    bits = window_bits(buckets)
    rows = sorted(rows, key=lambda r: r["bucket"])
    total = np.concatenate([np.zeros(0, np.int64), *(unpacked(r["total"], np.int64) for r in rows)])
    windows, place = np.unique(window_keys(vocab[at], sizes, bits), return_inverse=True)
    known, left = np.zeros(len(windows)), np.ones(len(windows))
    begin = np.searchsorted(windows, starts_of_buckets(buckets, bits) << np.uint64(16))
    for r in rows:
        some = begin[r["bucket"]] + risen(r["some"], np.uint32).astype(np.int64)
        same, others, kinds = (unpacked(r[c], np.int64) for c in ("same", "others", "kinds"))
        known[some], left[some] = same / (others + kinds), kinds / (others + kinds)
    return total, known[place], left[place]
