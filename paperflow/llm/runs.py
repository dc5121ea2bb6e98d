"""Periodic runs of words, by tiles of the size of their periods.

A run is a stretch of words that repeats with a period, at least twice and over
at least 12 words, that cannot be extended. Where words stand one period apart
from equal words, over as long a stretch, the stretch covers a boundary of its
octave: periods from B to 2B have boundaries every B words. A tile is one
boundary with the words around it, [c - B, c + 3B). Boundaries where neither half
a B before nor half a B behind agrees with the words any period further, told by
sums of random numbers, have no tile; Z-functions of the others' words, forwards
and backwards from the boundary, tell how far each period holds within B. The
pieces found by all tiles are shuffled by document and period and stitched to
whole stretches; of equal stretches the smallest period is the run's. Periods
below 8 are compared directly.

Tiles of documents of many words are rows of their own, dealt over all tasks;
those of others are solved where they are made.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, column, stored

#: Words of the shortest run, and periods that have no tiles.
LEAST, DIRECT = 12, 8
#: Words of a document whose tiles are dealt, and of the tiles of one row, without what they overlap.
LONG = 1 << 14
#: Bytes of a text that are split into words at once.
CHUNK = 1 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")

Change = Callable[[int | None, np.ndarray], np.ndarray]


def words_of(text: str | None) -> tuple[np.ndarray, list[bytes]]:
    """The numbers of all words of a text, and the words that they number."""
    data = (text or "").encode("utf-8", "surrogatepass")
    known: dict[bytes, int] = {}
    found, start = [], 0
    while start < len(data):
        end = start + CHUNK
        if end < len(data):
            gap = _GAP.search(data, end)
            end = gap.start() if gap else len(data)
        # bytes.split knows the same white space
        found += [np.fromiter((known.setdefault(w, len(known)) for w in data[start:end].split()), np.int32)]
        start = end
    return np.concatenate([*found, np.array([], np.int32)]), list(known)


def repeated_tail(key: int | None, words: np.ndarray) -> np.ndarray:
    """One document in ten, told by its key, ends in a stretch of its own words that repeats; without a key none does."""
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], np.resize(words[a : a + p], n - a)])


def least_match(period: np.ndarray | int) -> np.ndarray:
    """Over so many words in a row those of a run agree with the words one period further."""
    return np.maximum(LEAST - period, period)


def direct(words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of all stretches of agreement long enough for a run, for the shortest periods."""
    for q in range(1, min(DIRECT, len(words) // 2 + 1)):
        same = np.zeros(len(words) - q + 2, np.int8)
        same[1:-1] = words[:-q] == words[q:]
        turns = np.flatnonzero(np.diff(same)).reshape(-1, 2)
        for start, end in turns[turns[:, 1] - turns[:, 0] >= least_match(q)].tolist():
            yield q, start, end


def boundaries(sums: np.ndarray, b: int) -> Iterator[tuple[int, np.ndarray]]:
    """(boundary, periods) of the octave of b: where half of b, before or behind, may agree one period further."""
    half = b // 2
    block = sums[half:] - sums[:-half]
    found = []
    for shift, first in ((0, 0), (b - half, 1)):
        # rows of b; a row's first sum against all of the next row
        x = block[shift:]
        rows = len(x) // b + (len(x) % b > 0)
        if rows < 2:
            continue
        x = np.concatenate([x, np.full(rows * b - len(x), np.nan)]).reshape(rows, b)
        r, j = np.nonzero(x[1:] == x[:-1, :1])
        found.append(((r + first) * b << 32) + b + j)
    if not found:
        return
    both = np.unique(np.concatenate(found))
    at, q = both >> 32, both & (2**32 - 1)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    yield from zip(at[starts].tolist(), np.split(q, starts[1:]))


def z_function(x: list[int]) -> list[int]:
    """z[i]: how many items from i on agree with those from 0 on."""
    n = len(x)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def agreement(one: np.ndarray, other: np.ndarray) -> int:
    """How many items from the start on agree."""
    n = min(len(one), len(other))
    differ = one[:n] != other[:n]
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


def solved(words: np.ndarray, c: int, b: int, periods: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(period, start, end): around boundary c, the stretch of at most b words on either side that agree one period further."""
    low, high = max(0, c - b), min(len(words), c + 3 * b)
    if len(periods) * 8 > b:
        forward = z_function(words[c:high].tolist())
        # backwards: the words before c against those before c + q
        before, both = words[low:c][::-1].tolist(), words[low : min(high, c + 2 * b)][::-1].tolist()
        backward = z_function([*before, -1, *both])
        shift = len(before) + 1 + len(both) - (c - low)
        reach = lambda q: (forward[q] if q < len(forward) else 0, backward[shift - q] if shift - q > len(before) else 0)
    else:
        reach = lambda q: (agreement(words[c : c + b], words[c + q : c + q + b]), agreement(words[low:c][::-1], words[low + q : c + q][::-1]))
    for q in periods.tolist():
        right, left = reach(q)
        if right + left:
            yield q, c - min(left, b), c + min(right, b)


def stitched(pieces: list[tuple[int, int, int]]) -> np.ndarray:
    """(period, start, end) with pieces of one period that touch put together."""
    if not pieces:
        return np.zeros((0, 3), np.int64)
    x = np.array(sorted(set(pieces)), np.int64)
    # ends of earlier periods are far below: one running maximum does for all
    lift = x[:, 0] * (x[:, 2].max() + 1)
    reach = np.maximum.accumulate(x[:, 2] + lift)
    new = np.concatenate([[True], (x[1:, 1] + lift[1:] > reach[:-1]) | (x[1:, 0] != x[:-1, 0])])
    first = np.flatnonzero(new)
    return np.stack([x[first, 0], x[first, 1], np.maximum.reduceat(x[:, 2], first)], 1)


_NUMBERS = np.random.default_rng(1).random(1 << 16)


def sums_of(words: np.ndarray) -> np.ndarray:
    """Running sums of a random whole number for each word: equal blocks have equal differences, others hardly ever."""
    number = np.floor(_NUMBERS[words & 0xFFFF] * 2**20) + (words >> 16)
    return np.concatenate([[0.0], np.cumsum(number)])


def octaves(n: int) -> Iterator[int]:
    b = DIRECT
    while 2 * b <= n:
        yield b
        b *= 2


def pieces_of(words: np.ndarray) -> np.ndarray:
    """All stretches of agreement of one document that are long enough for a run."""
    found = list(direct(words))
    sums = sums_of(words)
    for b in octaves(len(words)):
        for c, periods in boundaries(sums, b):
            found += solved(words, c, b, periods)
    x = stitched(found)
    return x[x[:, 2] - x[:, 1] >= least_match(x[:, 0])]


def tiles_of(words: np.ndarray, size: int) -> Iterator[tuple[int, int, list[int], list[int], np.ndarray]]:
    """(octave, first word, boundaries, periods, words) of groups of neighbouring tiles; boundaries and periods go in pairs, boundaries counted from the first word."""
    sums = sums_of(words)
    for b in octaves(len(words)):
        width = max(size, b)
        group: list[tuple[int, np.ndarray]] = []
        for c, periods in [*boundaries(sums, b), (-1, np.array([], np.int64))]:
            if group and (c < 0 or c - group[0][0] >= width or sum(len(q) for _, q in group) > 1 << 16):
                low = max(0, group[0][0] - b)
                at = np.repeat([x - low for x, _ in group], [len(q) for _, q in group])
                yield b, low, at.tolist(), np.concatenate([q for _, q in group]).tolist(), words[low : group[-1][0] + 3 * b]
                group = []
            group.append((c, periods))


def collapsed(words: np.ndarray, known: list[bytes], dropped: np.ndarray | None = None) -> str:
    """SHA-256 of the kept words, joined by spaces."""
    kept = words if dropped is None else words[~dropped]
    digest = hashlib.sha256()
    for at in range(0, len(kept), 1 << 16):
        digest.update((b" " if at else b"") + b" ".join([known[i] for i in kept[at : at + (1 << 16)].tolist()]))
    return digest.hexdigest()


def repeats(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Words that stand behind the first period of some run."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


PIECE = "struct<period:long,first:long,last:long>"
TILE = "struct<octave:long,low:long,boundary:array<int>,period:array<int>,words:binary>"
_PIECE_TYPE = pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
_TILE_TYPE = pa.struct([("octave", pa.int64()), ("low", pa.int64()), ("boundary", pa.list_(pa.int32())), ("period", pa.list_(pa.int32())), ("words", pa.binary())])


def pieces_array(pieces: list[np.ndarray | None]) -> pa.Array:
    return pa.array([None if x is None else [dict(zip(("period", "first", "last"), r)) for r in x.tolist()] for x in pieces], _PIECE_TYPE)


def searched(df: DataFrame, key: str, text: str, change: Change | None, long: int) -> DataFrame:
    """A row of each document (row, key, n, digest, text, pieces, tile null), and rows of tiles of long ones.

    Only documents of which something is found, or still to be solved, keep
    their text; the others have their digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("key").type
            n, digest, pieces, texts = [], [], [], []
            for row, k, x in zip(column(batch, "row"), column(batch, "key"), column(batch, "text")):
                words, known = words_of(x)
                words = change(k, words) if change else words
                tiled = False
                if len(words) > long:
                    small = stitched(list(direct(words)))
                    for b, low, at, q, part in tiles_of(words, long):
                        tiled = True
                        tile = {"octave": b, "low": low, "boundary": at, "period": q, "words": part.astype(np.int32).tobytes()}
                        yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), *(pa.nulls(1, t) for t in (kind, pa.string(), pa.int64(), pa.string(), _PIECE_TYPE)), pa.array([tile], _TILE_TYPE)], names=names)
                else:
                    small = pieces_of(words)
                n.append(len(words))
                pieces.append(small)
                late = tiled or len(small) > 0
                texts.append(x if late else None)
                digest.append(None if late else collapsed(words, known))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pieces_array(pieces), pa.nulls(len(n), _TILE_TYPE)], names=names)

    names = ["row", "key", "text", "n", "digest", "pieces", "tile"]
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"row long, key {rows.schema['key'].dataType.simpleString()}, text string, n long, digest string, pieces array<{PIECE}>, tile {TILE}")


def tile_pieces(tiles: DataFrame) -> DataFrame:
    """(row, period, first, last) from rows of tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pieces = [], []
            for row, tile in zip(column(batch, "row"), column(batch, "tile")):
                words = np.frombuffer(tile["words"], np.int32)
                at, q = np.array(tile["boundary"], np.int64), np.array(tile["period"], np.int64)
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                found = [p for c, periods in zip(at[starts].tolist(), np.split(q, starts[1:])) for p in solved(words, c, tile["octave"], periods)]
                x = stitched(found)
                rows.append(np.full(len(x), row))
                pieces.append(x + np.array([0, tile["low"], tile["low"]]))
            x = np.concatenate([*pieces, np.zeros((0, 3), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*rows, np.array([], np.int64)])), *(pa.array(x[:, i].astype(np.int64)) for i in range(3))], names=["row", "period", "first", "last"])

    # few, large rows: one by one over all tasks
    dealt = tiles.select("row", "tile").repartition(F.xxhash64("row", "tile.octave", "tile.low", "tile.boundary"))
    return dealt.mapInArrow(run, "row long, period long, first long, last long")


def stretches(pieces: DataFrame) -> DataFrame:
    """(row, start, length, period) of all runs, from pieces (row, period, first, last)."""
    order = Window.partitionBy("row", "period").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = pieces.withColumn("new", F.coalesce(F.col("first") > before, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(order))
    whole = islands.groupBy("row", "period", "island").agg(F.min("first").alias("start"), (F.max("last") - F.min("first") + F.col("period")).alias("length"))
    fit = whole.where(F.col("length") >= F.greatest(F.lit(LEAST), 2 * F.col("period")))
    return fit.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def digested(df: DataFrame, change: Change | None) -> DataFrame:
    """(key, n, runs, digest) of documents (key, n, text, runs): the digest of the words that their runs leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest = []
            for k, x, runs in zip(column(batch, "key"), column(batch, "text"), batch.column(3)):
                words, known = words_of(x)
                words = change(k, words) if change else words
                dropped = None
                if runs.values is not None and len(runs.values):
                    dropped = repeats(len(words), *(runs.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "length", "period")))
                digest.append(collapsed(words, known, dropped))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(digest, pa.string())], names=["key", "n", "runs", "digest"])

    rows = df.select("key", "text", "n", "runs")
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, n long, runs array<struct<start:long,length:long,period:long>>, digest string")


def periodic(df: DataFrame, key: str = "doc_id", text: str = "text", change: Change | None = None, long: int = LONG) -> DataFrame:
    """(key, n, runs, digest) of every row of `df`: its number of words, its runs and the digest of the words left.

    runs has (start, length, period) of all runs, by start, then period; of each
    run the words behind its first period are left out of the digest, the
    SHA-256 of all others joined by spaces. Null and empty texts have no words,
    no runs and the digest of nothing. Repeated rows repeat in the result; other
    columns of `df` are not looked at. `change` is applied to a document's words
    first.
    """
    bounded_batches(df.sparkSession)
    found = stored(searched(df, key, text, change, long), "pieces")
    documents = found.where("n is not null")
    pieces = documents.select("row", F.explode("pieces").alias("p")).select("row", "p.*")
    runs = stretches(pieces.unionByName(tile_pieces(found.where("n is null"))))
    in_order = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    listed = runs.groupBy("row").agg(in_order.alias("runs")).select("row", F.transform("runs", lambda r: F.struct(r.start.alias("start"), r.length.alias("length"), r.period.alias("period"))).alias("runs"))
    # documents of which nothing was found are done
    none = F.array().cast("array<struct<start:long,length:long,period:long>>")
    done = documents.where("digest is not null").select("key", "n", none.alias("runs"), "digest")
    late = digested(documents.where("digest is null").select("row", "key", "text", "n").join(listed, "row", "left"), change)
    return done.unionByName(late.select("key", "n", F.coalesce("runs", none).alias("runs"), "digest")).withColumnRenamed("key", key)
