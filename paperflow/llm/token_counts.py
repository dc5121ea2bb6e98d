"""Token counts by rank-synchronous array merging."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import bpe_tables as B
from .common import bounded_batches, column, replaced


class Counter:
    """Counts tokens of texts; pre-tokens seen before are looked up, the new ones of a batch are merged together."""

    def __init__(self, path: str):
        self.vocab = B.vocabulary(path)
        self.known: dict[str, int] = {}

    def learn(self, new: list[str]) -> None:
        _, counts = self.vocab.merge([x.encode("utf-8", "surrogatepass") for x in new])
        self.known.update(zip(new, counts.tolist()))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > B.CACHE_PIECES:
            self.known.clear()
        out, open_ = [0] * len(texts), []
        get = self.known.get
        for i, text in enumerate(texts):
            parts = self.vocab.split(text)
            out[i] = len(parts) // 2
            for part in parts[::2]:
                found = B.pieces(B.normalized(part))
                counts = list(map(get, found))
                if None in counts:
                    open_.append((i, found))
                else:
                    out[i] += sum(counts)
        if open_:
            new = {x for _, found in open_ for x in found if x not in self.known}
            self.learn(list(new))
            for i, found in open_:
                out[i] += sum(map(get, found))
        return out


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """Columns of `df` but the text, with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Null texts count as empty: 0 bytes, 0 tokens. Special strings inside a text
    are one token each. Repeated rows stay; columns of the input named like a
    result are replaced. Whole texts are counted, in Arrow batches of bounded
    rows; nothing is shuffled.
    """
    names = ("n_bytes", "n_tokens", "over_limit")
    df = df.drop(*(n for n in names if n != text))
    bounded_batches(df.sparkSession)
    schema = T.StructType([*(f for f in df.schema if f.name != text), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            texts = [x or "" for x in column(batch, text)]
            n = counter.counts(texts)
            yield replaced(batch, text, {"n_bytes": pa.array([len(x) if x.isascii() else len(x.encode()) for x in texts], pa.int64()), "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([x > limit for x in n])})

    return df.mapInArrow(run, schema)
