"""BPE encoding and decoding; long texts by tree concatenation.

A long text is halved until its chunks are short, wherever the cuts fall, and
the chunks are encoded as rows of their own, so that many tasks share one text.
Neighbours are then joined, pair by pair up the tree: the text around a join is
encoded again in a growing window until its first token is the left side's and
one of its later tokens is the right side's, over the same bytes. In BPE a
sequence is the encoding of its text if every two neighbours in it are, so what
stands left of the first agreement, the window, and what stands right of the
last one together are the exact encoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe_tables as B
from .common import bounded_batches, column, fresh, replaced, stored

#: Texts of more letters than LONG are cut into chunks of at most CHUNK letters.
LONG, CHUNK = 32_768, 8_192
RESULT = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]


class Encoder:
    """Ids of normalised text; pre-tokens seen before are looked up."""

    def __init__(self, path: str):
        self.vocab = B.vocabulary(path)
        self.known: dict[str, tuple[bytes, str]] = {}

    def lookup(self, found: list[list[str]]) -> None:
        """Make every pre-token known: (ids as little-endian uint32, their tokens joined by spaces)."""
        if len(self.known) > B.CACHE_PIECES:
            self.known.clear()
        new = list({x for ps in found for x in ps if x not in self.known})
        if not new:
            return
        symbols, counts = self.vocab.merge([x.encode() for x in new])
        tokens, raw, at = self.vocab.tokens, symbols.astype("<u4").tobytes(), 0
        ids = symbols.tolist()
        for x, n in zip(new, counts.tolist()):
            self.known[x] = raw[4 * at : 4 * (at + n)], " ".join([tokens[i] for i in ids[at : at + n]])
            at += n

    def texts(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids and decoded text of raw texts, special strings included."""
        split = [[p if k % 2 else B.pieces(B.normalized(p)) for k, p in enumerate(self.vocab.split(x))] for x in texts]
        self.lookup([p for s in split for p in s[::2]])
        known, out = self.known, []
        for s in split:
            got = [e for k, p in enumerate(s) for e in ([(np.uint32(self.vocab.specials[p]).tobytes(), p)] if k % 2 else [known[x] for x in p])]
            out.append((b"".join([e[0] for e in got]), " ".join([e[1] for e in got])))
        return out

    def plain(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one normalised text and the byte at which each begins."""
        spans = B.piece_spans(text)
        found = [text[a:b] for a, b in spans]
        self.lookup([found])
        ids = np.frombuffer(b"".join([self.known[x][0] for x in found]), "<u4").astype(np.int64)
        counts = np.fromiter((len(self.known[x][0]) // 4 for x in found), np.int64, len(found))
        if text.isascii():
            starts = np.fromiter((a for a, _ in spans), np.int64, len(spans))
        else:
            at = np.zeros(len(text) + 1, np.int64)
            letters = np.frombuffer(text.encode("utf-32-le"), "<u4")
            np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF), out=at[1:])
            starts = at[np.fromiter((a for a, _ in spans), np.int64, len(spans))]
        width = self.vocab.width[ids]
        before = np.cumsum(width) - width
        first = np.cumsum(counts) - counts
        return ids, before + np.repeat(starts - before[first] if len(first) else starts, counts)

    def decoded(self, ids: np.ndarray) -> str:
        return " ".join([self.vocab.tokens[i] for i in ids.tolist()])


def joined(coder: Encoder, text: bytes, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], begin: int, end: int, window: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Encoding of text[begin:end] from those of its two halves; positions are bytes of `text`."""
    (li, ls), (ri, rs) = left, right
    if not len(li) or not len(ri):
        return (ri, rs) if not len(li) else (li, ls)
    cut, k = None, window
    while True:
        whole_left, whole_right = k >= len(li), k >= len(ri)
        a = begin if whole_left else int(ls[-k])
        b = end if whole_right else int(rs[k])
        if (a == begin or text[a] & 0xC0 != 0x80) and (b == end or text[b] & 0xC0 != 0x80):
            wi, ws = coder.plain(text[a:b].decode())
            ws = ws + a
            if whole_left or (len(wi) and wi[0] == li[-k] and ws[0] == ls[-k]):
                if whole_right:
                    cut = len(wi), len(ri)
                else:
                    # the last token of the window is excluded: its end is where the window was cut
                    at = np.searchsorted(rs, ws[:-1])
                    same = (at < k) & (rs[np.minimum(at, len(rs) - 1)] == ws[:-1]) & (ri[np.minimum(at, len(ri) - 1)] == wi[:-1])
                    hits = np.flatnonzero(same)
                    cut = (int(hits[0]), int(at[hits[0]])) if len(hits) else None
                if cut:
                    keep = 0 if whole_left else len(li) - k
                    return np.r_[li[:keep], wi[: cut[0]], ri[cut[1] :]], np.r_[ls[:keep], ws[: cut[0]], rs[cut[1] :]]
            if whole_left and whole_right:
                return wi, ws
        k *= 2


def tree(coder: Encoder, text: bytes, parts: list[tuple[np.ndarray, np.ndarray]], bounds: list[int]) -> np.ndarray:
    """Join the encodings of consecutive parts of `text`; bounds: where each part begins, and the end."""
    while len(parts) > 1:
        n = len(parts) // 2 * 2
        parts = [joined(coder, text, parts[i], parts[i + 1], bounds[i], bounds[i + 2]) for i in range(0, n, 2)] + parts[n:]
        bounds = bounds[: n + 1 : 2] + bounds[n + 1 :]
    return parts[0][0] if parts else np.zeros(0, np.int64)


def halves(text: str, most: int) -> list[str]:
    if len(text) <= most:
        return [text]
    return halves(text[: len(text) // 2], most) + halves(text[len(text) // 2 :], most)


def long_texts(texts: DataFrame, path: str, chunk: int) -> DataFrame:
    """Encodings of distinct texts (text_key, text): chunks are dealt out, encoded, and joined text by text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = B.vocabulary(path)
        for batch in batches:
            for key, text in zip(column(batch, "text_key"), column(batch, "text")):
                rows, n = [], 0
                for k, part in enumerate(vocab.split(text)):
                    for c in [part] if k % 2 else halves(B.normalized(part), chunk):
                        rows.append((key, n, k, c))
                        n += 1
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["text_key", "chunk", "part", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(path)
        for batch in batches:
            ids, starts = [], []
            for part, text in zip(column(batch, "part"), column(batch, "text")):
                i, s = (np.array([coder.vocab.specials[text]]), np.zeros(1, np.int64)) if part % 2 else coder.plain(text)
                ids.append(i.astype("<u4").tobytes())
                starts.append(s.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(starts, pa.binary())], names=[*batch.schema.names, "ids", "starts"])

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        coder, done = Encoder(path), []
        for _, rows in frame.sort_values("chunk").groupby("part", sort=True):
            texts = [x.encode() for x in rows["text"]]
            bounds = [0, *np.cumsum([len(x) for x in texts]).tolist()]
            parts = [(np.frombuffer(i, "<u4").astype(np.int64), np.frombuffer(s, "<u4").astype(np.int64) + at) for i, s, at in zip(rows["ids"], rows["starts"], bounds)]
            done.append(parts[0][0] if rows["part"].iloc[0] % 2 else tree(coder, b"".join(texts), parts, bounds))
        ids = np.concatenate(done)
        return pd.DataFrame({"text_key": [frame["text_key"].iloc[0]], "n_tokens": [len(ids)], "ids": [ids.astype("<u4").tobytes()], "decoded": [coder.decoded(ids)]})

    chunks = texts.mapInArrow(cut, "text_key string, chunk long, part long, text string")
    coded = chunks.repartition("text_key", "chunk").mapInArrow(encode, "text_key string, chunk long, part long, text string, ids binary, starts binary")
    return coded.groupBy("text_key").applyInPandas(join, T.StructType([T.StructField("text_key", T.StringType()), *RESULT]))


def encode_texts(df: DataFrame, path: str, text: str = "text", long: int = LONG, chunk: int = CHUNK, drop_text: bool = False) -> DataFrame:
    """Columns of `df`, with or without the text, with n_tokens, ids (little-endian uint32) and decoded (the tokens, joined by spaces).

    Null texts count as empty: no ids. Special strings inside a text are one id
    each. Texts of at most `long` letters are encoded where they are; longer
    ones as the module says, equal ones once. Repeated rows stay; input columns
    named like a result are replaced.
    """
    bounded_batches(df.sparkSession)
    names = [f.name for f in RESULT]
    df = df.drop(*(n for n in names if n != text))
    kept = [f for f in df.schema if not (drop_text and f.name == text)]
    schema = T.StructType([*kept, *RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(path)
        for batch in batches:
            got = coder.texts([x or "" for x in column(batch, text)])
            yield replaced(batch, text if drop_text else "", {"n_tokens": pa.array([len(i) // 4 for i, _ in got], pa.int64()), "ids": pa.array([i for i, _ in got], pa.binary()), "decoded": pa.array([d for _, d in got], pa.string())})

    is_long = F.coalesce(F.length(text) > long, F.lit(False))
    short = df.where(~is_long).mapInArrow(run, schema)
    key, joined_on = F.sha2(F.col(text), 256), fresh("text_key", df.columns)
    distinct = df.where(is_long).select(key.alias("text_key"), F.col(text).alias("text")).dropDuplicates(["text_key"])
    coded = stored(long_texts(distinct, path, chunk), "bpe").withColumnRenamed("text_key", joined_on)
    keyed = df.where(is_long).withColumn(joined_on, key).select(*[f.name for f in kept], joined_on)
    tall = keyed.join(coded, joined_on).select(*[f.name for f in kept], *names)
    return short.unionByName(tall)


def decode_ids(ids: bytes | None, path: str) -> str:
    """The tokens of little-endian uint32 ids, joined by spaces."""
    vocab = B.vocabulary(path)
    return " ".join([vocab.tokens[i] for i in np.frombuffer(ids or b"", "<u4").tolist()])
