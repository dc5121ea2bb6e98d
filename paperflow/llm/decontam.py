"""Passages of benchmark items in texts, up to an edit distance, by the pigeonhole principle.

An item that occurs with at most k errors leaves at least one of any k + 1
pieces of it untouched. The pieces of all items are sought at once, and every
hit is verified by Myers' bit-parallel distance around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, column, fresh, replaced

#: Errors allowed for each letter of an item, rounded down: items of up to 16 letters are sought without errors.
RATE = 0.06
#: Bytes of item text that one pass over the documents searches for; more items take more passes.
BLOCK_BYTES = 4_000_000

_GAP = re.compile(r"[\W_]+")
HIT = T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "start", "end", "distance")])


def words_only(text: str | None) -> str:
    """Lower case; letters and digits, with one space for whatever else stands between them, and one at either end."""
    return f" {_GAP.sub(' ', (text or '').lower()).strip()} "


def budget(item: str) -> int:
    return int(RATE * len(item))


def cut(item: str, n: int) -> list[tuple[int, str]]:
    """n pieces of nearly equal length, with their places."""
    edges = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def closest(masks: dict[str, int], m: int, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of a pattern of m letters in text, if within `most`; the earliest of equals.

    Column by column: `up` and `down` hold where the distance rises and falls
    from one pattern letter to the next.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best: tuple[int, int] | None = None
    for j, letter in enumerate(text):
        same = masks.get(letter, 0)
        keep = same | down
        diagonal = (((same & up) + up) ^ up) | same
        rise, fall = down | (~(diagonal | up) & full), up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        # an occurrence may begin anywhere: the first row stays 0
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (~(keep | rise) & full), rise & keep
        if score <= most and (best is None or score < best[0]):
            best = score, j + 1
            if not score:
                break
    return best


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, letter in enumerate(item):
        masks[letter] = masks.get(letter, 0) | 1 << i
    return masks


class Finder:
    """Searches texts for a block of items (item_id, words-only text)."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        self.items = [(i, x, budget(x), masks_of(x), masks_of(x[::-1])) for i, x in items]
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for n, (_, x, k, _, _) in enumerate(self.items):
            for at, piece in cut(x, k + 1):
                by_piece.setdefault(piece, []).append((n, at))
        self.pieces = ahocorasick.Automaton()
        for piece, where in by_piece.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) of the best occurrence of each item, in letters of words_only(text)."""
        plain = words_only(text)
        best: dict[int, tuple[int, int, int]] = {}
        seen: dict[int, int] = {}
        for last, (size, where) in self.pieces.iter(plain):
            for n, at in where:
                item_id, item, k, forward, backward = self.items[n]
                if best.get(n, (1,))[0] == 0:
                    continue
                begin = last + 1 - size - at
                # hits that lie along one occurrence ask for the same window
                if n in seen and abs(begin - seen[n]) <= k and k:
                    if n in best:
                        continue
                seen[n] = begin
                low = max(0, begin - k)
                window = plain[low : max(0, begin + len(item) + k)]
                found = closest(forward, len(item), window, k)
                if found and (n not in best or found[0] < best[n][0]):
                    end = low + found[1]
                    back = closest(backward, len(item), plain[max(0, end - len(item) - k) : end][::-1], found[0])
                    best[n] = found[0], end - (back[1] if back else len(item)), end
        return sorted((self.items[n][0], s, e, d) for n, (d, s, e) in best.items())


@lru_cache(maxsize=2)
def finder(items: tuple[tuple[int, str], ...]) -> Finder:
    return Finder(items)


def blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of bounded size. Items without words are left out, as are null keys.

    A benchmark is small next to the documents: all of its items pass through
    the driver, and a worker holds one search for each block.
    """
    known = benchmark.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).distinct()
    total = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 + total // BLOCK_BYTES
    for b in range(n):
        part = known if n == 1 else known.where(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == b)
        items = tuple(sorted((r["k"], x) for r in part.toLocalIterator() if (x := words_only(r["t"])).strip()))
        if items:
            yield items


def with_hits(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "item_id", item_text: str = "text", drop_text: bool = False) -> DataFrame:
    """`df`, with or without the text, with hits array<struct<item_id, start, end, distance>>: every item that occurs in the text within its error budget.

    Case, punctuation and line breaks don't count; starts and ends are letters
    of the text so reduced. An item that occurs more than once is reported where
    it fits best. Null and empty texts have no hits. The documents are not
    shuffled; items beyond BLOCK_BYTES are searched for in further passes of the
    same rows.
    """
    bounded_batches(df.sparkSession)
    df = df.drop("hits")
    before = fresh("hits_before", df.columns)
    arrow_hits = pa.list_(pa.struct([(f.name, pa.int64()) for f in HIT]))

    def searching(items, drop):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = finder(items)
            for batch in batches:
                rows = [[dict(zip(HIT.names, h)) for h in search.find(x)] for x in column(batch, text)]
                yield replaced(batch, text if drop else "", {"hits": pa.array(rows, arrow_hits)})

        return run

    out, searches = df, list(blocks(benchmark, key, item_text))
    for n, items in enumerate(searches):
        # the last search is the last to need the text
        drop = drop_text and n == len(searches) - 1
        own = [f for f in df.schema if not (drop and f.name == text)]
        if n:
            out = out.withColumnRenamed("hits", before)
            own.append(T.StructField(before, T.ArrayType(HIT)))
            order = [*df.columns, before]
            out = out.select(*order)
        out = out.mapInArrow(searching(items, drop), T.StructType([*own, T.StructField("hits", T.ArrayType(HIT))]))
        if n:
            out = out.withColumn("hits", F.concat(before, "hits")).drop(before)
    if not searches:
        out = df.withColumn("hits", F.array().cast(T.ArrayType(HIT)))
        return out.drop(text) if drop_text else out
    return out
