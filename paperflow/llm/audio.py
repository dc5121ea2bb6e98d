"""Chroma fingerprints of recordings, and their alignment.

A recording's frames are reduced to 12 pitch classes. Sixteen filters compare
sums of rectangles of that image, each looked up in its integral image, and give
two bits each: a 32-bit integer for each frame. Recordings are compared by the
bits in which they differ at an offset. Offsets to compare at are looked up by
signs only, the steadier of each filter's bits: a clip is looked up from several
places between two frames, and with its least certain signs either way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, column, stored

RATE, FRAME, HOP = 2000, 512, 128
LOW, HIGH = 100.0, 950.0
#: Filters (kind, first pitch class, pitch classes, frames): every kind over several bands and widths.
FILTERS = tuple((n % 6, (5 * n) % 9, 3 + n % 4 if (5 * n) % 9 + 3 + n % 4 <= 12 else 3, 4 + 2 * (n % 5)) for n in range(16))
REACH = max(f[3] for f in FILTERS)
#: Steps between the four levels of a filter. The middle one is off 0, so that bands without sound, where noise is compared with noise, are always below it.
STEP, FLOOR = 0.12, 0.005
GRAY = np.array([0, 1, 3, 2], np.uint32)
#: Recordings are linked if at their best offset at most MOST_ERRORS of the bits differ; one that covers less than half a clip needs LEAST equal pairs of integers as well.
LEAST, MOST_ERRORS = 3, 0.25
#: A clip need not begin on a frame of the recording: it is looked up from these samples on.
SHIFTS = tuple(range(0, HOP, HOP // 4))
#: Of the signs of a key, this many of the least certain ones are tried either way.
UNSURE = 3
#: The bits of an integer that hold the signs.
SIGNS = 0xAAAAAAAA
#: Keys of one integer's signs stand apart from those of two.
SINGLE = 1 << 32
QUERY_EVERY = 20


@lru_cache(maxsize=1)
def pitch_classes() -> np.ndarray:
    """For each frequency of a frame's spectrum its pitch class, -1 outside the range."""
    f = np.fft.rfftfreq(FRAME, 1 / RATE)
    inside = (f >= LOW) & (f <= HIGH)
    return np.where(inside, np.rint(12 * np.log2(np.maximum(f, 1) / 440)).astype(int) % 12, -1)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Pitch-class energies of each frame, of unit length; recordings shorter than a frame have none."""
    n = (len(samples) - FRAME) // HOP + 1
    if n <= 0:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP][:n] * np.hanning(FRAME)
    energy = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    kinds = pitch_classes()
    out = np.stack([energy[:, kinds == k].sum(1) for k in range(12)], 1)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(length > 1e-3, out / np.maximum(length, 1e-3), 0)


def ratios(image: np.ndarray) -> np.ndarray:
    """The filters' values for each frame that has REACH frames from it on."""
    n = max(0, len(image) - REACH + 1)
    out = np.zeros((n, len(FILTERS)))
    if not n:
        return out
    whole = np.zeros((len(image) + 1, 13))
    whole[1:, 1:] = image.cumsum(0).cumsum(1)
    at = np.arange(n)

    def area(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        return whole[at + t1, y1] - whole[at + t0, y1] - whole[at + t1, y0] + whole[at + t0, y0]

    for k, (kind, y, h, w) in enumerate(FILTERS):
        total, t, p = area(0, w, y, y + h), w // 2, h // 2
        if kind == 0:
            one = total / 2
            other = (area(0, w, 0, 12) - total) / 6
        elif kind == 1:
            one = area(0, w, y, y + p)
            other = total - one
        elif kind == 2:
            one = area(0, t, y, y + h)
            other = total - one
        elif kind == 3:
            one = area(0, t, y, y + p) + area(t, w, y + p, y + h)
            other = total - one
        elif kind == 4:
            one = area(0, w, y + h // 3, y + h - h // 3)
            other = total - one
        else:
            one = area(w // 3, w - w // 3, y, y + h)
            other = total - one
        out[:, k] = np.log((1 + one) / (1 + other))
    return out


def packed(values: np.ndarray) -> np.ndarray:
    """An integer for each frame: two bits of each filter, of which the higher tells whether it is above FLOOR."""
    out = np.zeros(len(values), np.uint32)
    for k in range(len(FILTERS)):
        out |= GRAY[np.digitize(values[:, k], (-STEP, FLOOR, STEP))] << np.uint32(2 * k)
    return out


def fingerprint(image: np.ndarray) -> np.ndarray:
    """A packed integer for each frame that has REACH frames from it on."""
    return packed(ratios(image))


def lookups(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): what a clip is looked up by, from all SHIFTS and with its UNSURE least certain signs either way: as `sign_key` has it, or, if it is too short to hold two integers that share no frame, as `single_key` has it."""
    keys, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    short = len(ratios(chroma(samples))) <= REACH
    for shift in SHIFTS:
        values = ratios(chroma(samples[shift:]))
        n = len(values) if short else len(values) - REACH
        if n <= 0:
            continue
        signs = packed(values).astype(np.int64) & SIGNS
        high, low = 2 * np.arange(len(FILTERS)) + 1, 2 * np.arange(len(FILTERS))
        if short:
            key, bits, margin = signs - SINGLE, high, values
        else:
            key, bits, margin = signs[:n] | signs[REACH:] >> 1, np.r_[high, low], np.c_[values[:n], values[REACH:]]
        weak = np.argpartition(np.abs(margin - FLOOR), UNSURE, axis=1)[:, :UNSURE]
        for turned in range(1 << UNSURE):
            keys.append(key ^ sum(((1 << bits[weak[:, b]]) for b in range(UNSURE) if turned >> b & 1), np.zeros(n, np.int64)))
            places.append(np.arange(n))
    both = np.unique(np.stack([np.concatenate(keys), np.concatenate(places)]), axis=1)
    return both[0], both[1]


def rendered(notes: list[float | None], note_samples: int = 256) -> np.ndarray:
    """16-bit samples of a melody: a note for each number, 48 semitones to one, silence for null and not-a-number."""
    values = np.array([np.nan if x is None else x for x in notes], float)
    steps = np.clip(np.rint(np.nan_to_num(values) * 48), -18, 18)
    loud = np.where(np.isnan(values), 0.0, 1.0)
    pitch = np.repeat(330 * 2 ** (steps / 12), note_samples)
    phase = np.cumsum(2 * np.pi * pitch / RATE)
    return (12000 * np.repeat(loud, note_samples) * (np.sin(phase) + 0.3 * np.sin(2 * phase))).astype(np.int16)


def excerpt(samples: np.ndarray, note_samples: int = 256) -> np.ndarray:
    """The middle half of a recording with noise over it; equal recordings have equal excerpts."""
    n = len(samples) // note_samples
    part = samples[n // 4 * note_samples : (n // 4 + n // 2) * note_samples].astype(float)
    seed = int.from_bytes(hashlib.blake2b(samples.tobytes(), digest_size=8).digest(), "little")
    return np.clip(part + np.random.default_rng(seed).normal(0, 600, len(part)), -32768, 32767).astype(np.int16)


def recordings(df: DataFrame, key: str, notes: str) -> DataFrame:
    """(id, recording, clip): 16-bit PCM of each row's melody, and for ids divisible by QUERY_EVERY that of an excerpt to search for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(a, 200) for a in range(0, whole.num_rows, 200)):
                ids, sounds = column(batch, "id"), [rendered(x or []) for x in column(batch, "notes")]
                clips = [excerpt(s).tobytes() if i is not None and i % QUERY_EVERY == 0 else None for i, s in zip(ids, sounds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sounds], pa.binary()), pa.array(clips, pa.binary())], names=["id", "recording", "clip"])

    return df.select(F.col(key).alias("id"), F.col(notes).alias("notes")).mapInArrow(run, "id long, recording binary, clip binary")


@F.pandas_udf(T.ArrayType(T.LongType()))
def fingerprint_of(pcm: pd.Series) -> pd.Series:
    """Fingerprint of 16-bit PCM at RATE; null for null."""
    return pcm.map(lambda x: None if x is None else fingerprint(chroma(np.frombuffer(x, np.int16).astype(float))).astype(np.int64))


@F.pandas_udf(T.ArrayType(T.LongType()))
def lookups_of(pcm: pd.Series) -> pd.Series:
    """Lookups of 16-bit PCM at RATE, the place in the lower 31 bits; null for null."""

    def one(x: bytes | None) -> np.ndarray | None:
        if x is None:
            return None
        keys, places = lookups(np.frombuffer(x, np.int16).astype(float))
        return keys << 31 | places

    return pcm.map(one)


def content(prints: Column) -> Column:
    return F.sha1(F.array_join(prints, ",").cast("binary"))


def sign_key(first: Column, second: Column) -> Column:
    """The signs of two integers REACH frames apart, which share no frame: rarely equal by chance."""
    return first.bitwiseAND(F.lit(SIGNS)).bitwiseOR(F.shiftright(second.bitwiseAND(F.lit(SIGNS)), 1))


def single_key(prints: Column) -> Column:
    """The signs of one integer: often equal by chance, so only for clips that have no other key."""
    return prints.bitwiseAND(F.lit(SIGNS)) - F.lit(SINGLE)


def compared(whole: np.ndarray, clip: np.ndarray, offsets: np.ndarray) -> tuple[int, int, float] | None:
    """(offset, equal, bit_errors) where most bits are left below MOST_ERRORS of those compared, of some offsets and their neighbours."""
    best = None
    for at in np.unique(np.concatenate([offsets - 1, offsets, offsets + 1])).tolist():
        start, skip = max(at, 0), max(-at, 0)
        n = min(len(whole) - start, len(clip) - skip)
        if n <= 0:
            continue
        different = whole[start : start + n] ^ clip[skip : skip + n]
        wrong, same = int(np.bitwise_count(different).sum()), different == 0
        if wrong > MOST_ERRORS * 32 * n or (2 * n < len(clip) and (same[:-REACH] & same[REACH:]).sum() < LEAST):
            continue
        rank = (MOST_ERRORS * 32 * n - wrong, -abs(at), at)
        if best is None or rank > best[0]:
            best = rank, (at, int(same.sum()), wrong / (32.0 * n))
    return best and best[1]


@F.pandas_udf(T.StructType([T.StructField("offset", T.IntegerType()), T.StructField("equal", T.LongType()), T.StructField("bit_errors", T.DoubleType())]))
def comparison(prints: pd.Series, clip_prints: pd.Series, offsets: pd.Series) -> pd.DataFrame:
    found = [compared(np.asarray(x, np.int64).astype(np.uint32), np.asarray(y, np.int64).astype(np.uint32), np.asarray(o, np.int64)) or (None, None, None) for x, y, o in zip(prints, clip_prints, offsets)]
    return pd.DataFrame({"offset": pd.array([f[0] for f in found], "Int32"), "equal": pd.array([f[1] for f in found], "Int64"), "bit_errors": pd.array([f[2] for f in found], "Float64")})


def alignments(clips: DataFrame, whole: DataFrame) -> DataFrame:
    """(clip, recording, offset, equal, bit_errors) at each pair's best offset, for pairs within MOST_ERRORS there that share a key; clips (id, prints, lookups) and recordings (id, prints)."""
    keys = F.zip_with("prints", F.slice("prints", REACH + 1, F.size("prints")), sign_key)
    index = whole.select(F.col("id").alias("recording"), F.posexplode(keys).alias("recording_at", "key")).where("key is not null")
    if not clips.where(F.size("prints").between(1, REACH)).isEmpty():
        index = index.unionByName(whole.select(F.col("id").alias("recording"), F.posexplode(F.transform("prints", single_key)).alias("recording_at", "key")))
    asked = clips.select(F.col("id").alias("clip"), F.explode("lookups").alias("sought")).select("clip", F.shiftright("sought", 31).alias("key"), F.col("sought").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("at"))
    met = asked.join(index, "key").groupBy("clip", "recording").agg(F.collect_set(F.col("recording_at") - F.col("at")).alias("offsets"))
    both = met.join(clips.select(F.col("id").alias("clip"), F.col("prints").alias("clip_prints")), "clip").join(whole.toDF("recording", "prints"), "recording")
    return both.select("clip", "recording", comparison("prints", "clip_prints", "offsets").alias("best")).select("clip", "recording", "best.*").where("offset is not null")


def matched(df: DataFrame, key: str, notes: str) -> DataFrame:
    """One row for each row of `df`: id, n_frames, class_id, and for clips match_class, match_offset, bit_errors and n_matches.

    class_id is the smallest id of the recordings with the same fingerprint, so
    copies are compared once. match_class is the class that a clip aligns with
    with the fewest bit errors (then most equal integers, then smallest id),
    match_offset the frame of it at which the clip begins, n_matches the number
    of classes within MOST_ERRORS. All are null without a match. Recordings
    shorter than REACH frames have no fingerprint: class_id is their own id.
    """
    bounded_batches(df.sparkSession)
    made = recordings(df, key, notes).select("id", fingerprint_of("recording").alias("prints"), fingerprint_of("clip").alias("clip_prints"), lookups_of("clip").alias("lookups"))
    rows = stored(made.withColumn("content", F.when(F.size("prints") > 0, content(F.col("prints")))).withColumn("clip_content", F.when(F.size("clip_prints") > 0, content(F.col("clip_prints")))), "prints")
    classes = stored(rows.where("content is not null and id is not null").groupBy("content").agg(F.min("id").alias("class_id")), "classes")
    asked = rows.where("clip_content is not null and id is not null").groupBy("clip_content").agg(F.min("id").alias("clip_id"))
    whole = rows.select("id", "content", "prints").join(classes, (rows["id"] == classes["class_id"]) & (rows["content"] == classes["content"]), "left_semi").select("id", "prints").dropDuplicates(["id"])
    clips = rows.select("id", "clip_content", "clip_prints", "lookups").join(asked.select(F.col("clip_id").alias("id"), "clip_content"), ["id", "clip_content"], "left_semi").select("id", "clip_prints", "lookups", "clip_content").dropDuplicates(["id"])
    found = alignments(clips.select("id", F.col("clip_prints").alias("prints"), "lookups"), whole).where(F.col("bit_errors") <= MOST_ERRORS)
    order = F.struct("bit_errors", -F.col("equal"), "recording")
    best = found.groupBy("clip").agg(F.min_by(F.struct("recording", "offset", "bit_errors"), order).alias("best"), F.count("*").alias("n_matches"))
    answers = clips.select(F.col("id").alias("clip"), "clip_content").join(best, "clip").select("clip_content", F.col("best.recording").alias("match_class"), F.col("best.offset").cast("long").alias("match_offset"), F.round("best.bit_errors", 6).alias("bit_errors"), "n_matches")
    return rows.join(classes, "content", "left").join(answers, "clip_content", "left").select(F.col("id").alias(key), F.coalesce(F.size("prints"), F.lit(0)).cast("long").alias("n_frames"), F.coalesce("class_id", "id").alias("class_id"), "match_class", "match_offset", "bit_errors", "n_matches")
