"""Language of texts: script ranges narrow the candidates, per-word scores and a switching penalty label spans.

A word scores the sum of its letter trigrams' log-probabilities under each
language that writes its script; the Viterbi path over a text's words changes
language only where that gains more than the penalty. A text's language is that
of most of its letters on the path.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, column, fold, replaced, slices

#: First code points of script ranges; what lies between two of them is one script. Ranges of one script share a name.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
NAMES = sorted({n for _, n in SCRIPTS})
FIRSTS = np.array([f for f, _ in SCRIPTS], np.uint32)
SCRIPT_OF_RANGE = np.array([NAMES.index(n) for _, n in SCRIPTS], np.int64)

BUCKETS = 1 << 16
#: A language writes a script if that has this share of its learned letters.
SHARE = 0.01
PENALTY = 12.0
#: Letters of texts whose words step through the path together, and of those that are scored at once; longer texts are cut between words.
GROUP, PART = 4_000_000, 400_000
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
UNKNOWN = "und"

_SPACE = re.compile(r"\s")


@lru_cache(maxsize=1)
def letter_kinds() -> np.ndarray:
    """2 for letters, 1 for marks that stand within words, 0 for the rest, by code point."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    return np.array([2 if k == "L" else k == "M" for k in kinds], np.uint8)


@dataclass
class Words:
    """Words of a list of texts: which text, where they begin and end in it, their letters' trigram buckets and scripts."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    buckets: np.ndarray
    script: np.ndarray
    letters: np.ndarray


def words(texts: list[str]) -> Words:
    # lower-casing must keep the places of letters
    lowered = [x.lower() if x.isascii() else x.replace("İ", "i").lower() for x in texts]
    code = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(x) + 1 for x in lowered), np.int64, len(lowered))
    begin = np.cumsum(sizes) - sizes
    kind = letter_kinds()[code]
    inside = kind > 0
    at = np.flatnonzero(inside)
    plain = np.where(inside, code, np.uint32(32))
    before = np.r_[np.uint32(32), plain[:-1]][at] if len(plain) else plain[at]
    after = np.r_[plain[1:], np.uint32(32)][at] if len(plain) else plain[at]
    a, b, c = (np.uint32(m) for m in MULTIPLIERS)
    buckets = ((before * a + plain[at] * b + after * c) >> np.uint32(16)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1]) if len(at) else at
    last = np.r_[first[1:], len(at)] - 1 if len(first) else first
    start = at[first]
    text = np.searchsorted(begin, start, "right") - 1
    script = SCRIPT_OF_RANGE[np.searchsorted(FIRSTS, code[start], "right") - 1]
    letters = np.add.reduceat((kind[at] == 2).astype(np.int64), first) if len(first) else first
    return Words(text, start - begin[text], at[last] + 1 - begin[text] if len(first) else start, first, buckets, script, letters)


@dataclass
class Model:
    languages: list[str]
    #: log-probabilities, a row for each bucket
    weights: np.ndarray
    #: a row for each script, true for the languages that write it
    writes: np.ndarray


def train(df: DataFrame, text: str = "text", lang: str = "lang", alpha: float = 0.5) -> Model:
    """Trigram and script counts of each language over all rows with a text and a language; summed by Spark.

    The model is 0.26 MB for each language, on the driver and in every worker.
    """
    bounded_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = column(batch, "text"), column(batch, "lang")
            for s in slices([len(x) for x in texts], PART):
                w = words(texts[s])
                names = sorted(set(langs[s]))
                of_text = np.array([names.index(x) for x in langs[s]], np.int64)
                of_word = of_text[w.text]
                of_letter = np.repeat(of_word, np.diff(np.r_[w.first, len(w.buckets)])) if len(w.first) else of_word
                for k, name in enumerate(names):
                    total = sums.setdefault(name, np.zeros(BUCKETS + len(NAMES), np.int64))
                    total[:BUCKETS] += np.bincount(w.buckets[of_letter == k], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(w.script[of_word == k], w.letters[of_word == k], len(NAMES)).astype(np.int64)
        for name, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(total[some])], names=["lang", "bucket", "n"])

    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))

    def of_language(table: pa.Table) -> pa.Table:
        n = np.zeros(BUCKETS + len(NAMES))
        n[table["bucket"].to_numpy()] = table["n"].to_numpy()
        grams, scripts = n[:BUCKETS], n[BUCKETS:]
        weights = np.log((grams + alpha) / (grams.sum() + alpha * BUCKETS)).astype(np.float32)
        writes = scripts >= SHARE * max(scripts.sum(), 1)
        return pa.table({"lang": table["lang"][:1], "weights": pa.array([weights.tobytes()], pa.binary()), "writes": pa.array([writes.tobytes()], pa.binary())})

    found = {r["lang"]: r for r in counts.groupBy("lang").applyInArrow(of_language, "lang string, weights binary, writes binary").toLocalIterator()}
    languages = sorted(found)
    weights = np.zeros((BUCKETS, len(languages)), np.float32)
    writes = np.zeros((len(NAMES), len(languages)), bool)
    for k, name in enumerate(languages):
        weights[:, k], writes[:, k] = np.frombuffer(found[name]["weights"], np.float32), np.frombuffer(found[name]["writes"], bool)
    return Model(languages, weights, writes)


def scores(model: Model, w: Words) -> np.ndarray:
    """Log-score of each word under each language; words of a script that no language writes say nothing."""
    letters = model.weights[w.buckets]
    out = np.add.reduceat(letters, w.first, axis=0) if len(w.first) else np.zeros((0, len(model.languages)), np.float32)
    writes = model.writes[w.script]
    some = writes.any(1)
    return np.where(some[:, None], np.where(writes, out, np.float32(-1e6)), np.float32(0))


def viterbi(gain: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of each word. gain: word rows, text after text; sizes: words of each text. All texts step together."""
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    length = sizes[order]
    steps = int(length[0]) if len(length) else 0
    active = len(length) - np.searchsorted(length[::-1], np.arange(steps), "right")
    back = np.zeros(gain.shape, np.uint16)
    path = np.zeros(len(gain), np.int64)
    own = np.arange(gain.shape[1], dtype=np.uint16)
    value = np.zeros((len(length), gain.shape[1]), np.float32)
    for t in range(steps):
        n = active[t]
        at = begin[:n] + t
        v = value[:n]
        if t:
            best = v.argmax(1)
            switch = v[np.arange(n), best] - np.float32(penalty)
            change = switch[:, None] > v
            back[at] = np.where(change, best[:, None].astype(np.uint16), own)
            v = np.where(change, switch[:, None], v)
        value[:n] = v + gain[at]
    state = value.argmax(1) if steps else np.zeros(len(length), np.int64)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = back[at, state[:n]]
    return path


def part_for(languages: int) -> int:
    """Letters that are scored at once: fewer for more than 64 languages, so that the scores, a number for each letter and language, stay below 100 MB."""
    return max(1, PART * 64 // max(64, languages))


def cut(text: str, part: int) -> Iterator[tuple[int, str]]:
    """(start, part) of a long text, cut at white space after every `part` letters; a word of more letters is cut where it is."""
    at = 0
    while len(text) - at > part:
        m = _SPACE.search(text, at + part, at + 2 * part)
        end = m.start() if m else min(at + 2 * part, len(text))
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def label(model: Model, texts: list[str | None], spans: bool, penalty: float) -> list[tuple[str, float, list[dict] | None]]:
    """(language, share of the letters on the path that are its own, spans) of each text."""
    plain = [x or "" for x in texts]
    if not model.languages:
        return [(UNKNOWN, 0.0, [])] * len(plain)
    most = part_for(len(model.languages))
    pieces = [(i, start, part) for i, x in enumerate(plain) for start, part in cut(x, most)]
    of_text, begin = np.array([i for i, _, _ in pieces], np.int64), np.array([b for _, b, _ in pieces], np.int64)
    parts = []
    at = 0
    for s in slices([len(x) for _, _, x in pieces], most):
        w = words([x for _, _, x in pieces[s]])
        shift = begin[w.text + at]
        parts.append((of_text[w.text + at], w.start + shift, w.end + shift, w.letters, scores(model, w), model.writes[w.script].any(1)))
        at += s.stop - s.start
    text, start, end, letters, gain, known = (np.concatenate(x) for x in zip(*parts))
    sizes = np.bincount(text, minlength=len(plain))
    path = viterbi(gain, sizes, penalty)
    width = len(model.languages)
    mass = np.bincount(text * width + path, letters, len(plain) * width).reshape(-1, width)
    sure = np.bincount(text * width + path, letters * known, len(plain) * width).reshape(-1, width)
    best, total = mass.argmax(1), mass.sum(1)
    share = sure[np.arange(len(plain)), best] / np.maximum(total, 1)
    out = [(model.languages[b], float(x), None) if n else (UNKNOWN, 0.0, None) for b, x, n in zip(best.tolist(), share.tolist(), total.tolist())]
    if spans:
        edge = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (path[1:] != path[:-1])]) if len(text) else text
        last = np.r_[edge[1:], len(text)] - 1 if len(edge) else edge
        found: list[list[dict]] = [[] for _ in plain]
        for i, a, b, k in zip(text[edge].tolist(), start[edge].tolist(), end[last].tolist(), path[edge].tolist()):
            found[i].append({"start": a, "end": b, "lang": model.languages[k]})
        out = [(x, y, z) for (x, y, _), z in zip(out, found)]
    return out


def identify(df: DataFrame, model: Model, text: str = "text", spans: bool = True, penalty: float = PENALTY, drop_text: bool = False) -> DataFrame:
    """`df`, with or without the text, with lang_pred, score (0 to 1) and, if asked for, spans: (start, end, lang) in letters of the text.

    Texts that are null or have no letter are `und`, with score 0 and no spans.
    Repeated rows stay; input columns named like a result are replaced.
    """
    bounded_batches(df.sparkSession)
    result = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if spans:
        span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
        result.append(T.StructField("spans", T.ArrayType(span)))
    df = df.drop(*(f.name for f in result))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, list]] = []
        group = GROUP * 64 // max(64, len(model.languages))

        def flush() -> Iterator[pa.RecordBatch]:
            got = label(model, [x for _, texts in held for x in texts], spans, penalty)
            at = 0
            for batch, texts in held:
                mine = got[at : at + len(texts)]
                at += len(texts)
                new = [pa.array([x[0] for x in mine], pa.string()), pa.array([x[1] for x in mine], pa.float64())]
                new += [pa.array([x[2] for x in mine], span_type)] if spans else []
                yield replaced(batch, text if drop_text else "", dict(zip((f.name for f in result), new)))
            held.clear()

        size = 0
        for batch in batches:
            texts = column(batch, text)
            held.append((batch, texts))
            size += sum(len(x or "") for x in texts)
            if size > group:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return df.mapInArrow(run, T.StructType([*(f for f in df.schema if not (drop_text and f.name == text)), *result]))


def held_out(key: str = "doc_id") -> Column:
    return fold(key, 4) == 2
