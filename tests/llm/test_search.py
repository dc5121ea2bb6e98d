import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperflow.llm import audio, decontam, queries


def distance_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row[1:], default=len(pattern))


def test_bit_parallel_distance():
    rng = random.Random(3)
    for _ in range(800):
        p = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 90)))
        if rng.random() < 0.5:
            t = t[:20] + p[: len(p) // 2] + "x" + p[len(p) // 2 :] + t[20:]
        assert decontam.closest(decontam.masks_of(p), len(p), t, len(p) + 5)[0] == distance_within(p, t)


def edit(rng, text, n):
    for _ in range(n):
        at = rng.randrange(1, len(text) - 1)
        text = text[:at] + rng.choice(["", text[at] + "q", "z"]) + text[at + 1 :]
    return text


def test_items_within_the_budget_are_found(spark, data, odd):
    rng = random.Random(5)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    clean = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").limit(60).collect()]
    docs, wanted = [], set()
    for n, (item_id, text) in enumerate(items):
        plain = decontam.words_only(text)
        k = decontam.budget(plain)
        planted = edit(rng, plain.strip(), rng.randint(0, k)).upper().replace(" ", ",\n ", 3)
        host = clean[n % len(clean)]
        docs.append((n, host[: len(host) // 2] + " " + planted + " " + host[len(host) // 2 :]))
    lists = items + [(700, None), (701, ""), (None, "no key"), (702, "!!"), (703, "short words"), (0, items[0][1])]
    benchmark = spark.createDataFrame(lists, "item_id long, text string")
    df = spark.createDataFrame(docs + [(801, "some Short  words, here"), (802, "shorts words")], "doc_id long, text string").union(odd.select("doc_id", "text"))
    got = {(r["doc_id"], h["item_id"]): h for r in decontam.with_hits(df, benchmark).collect() for h in r["hits"]}
    for n, text in docs:
        for item_id, item in items:
            plain = decontam.words_only(item)
            k = decontam.budget(plain)
            if n == items.index((item_id, item)) or (n, item_id) in got:
                d = distance_within(plain, decontam.words_only(text))
                assert ((n, item_id) in got) == (d <= k)
                if d <= k:
                    assert got[n, item_id]["distance"] == d
                    wanted.add((n, item_id))
    assert len(wanted) >= len(items) * 0.8
    assert (801, 703) in got and (802, 703) not in got


def test_blocks_of_items(spark, data, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    hits = lambda: sorted((r["doc_id"], sorted(tuple(h) for h in r["hits"])) for r in decontam.with_hits(docs.select("doc_id", "text"), benchmark).collect())
    whole = hits()
    assert any(h for _, h in whole)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 2500)
    assert len(list(decontam.blocks(benchmark, "item_id", "text"))) > 2
    assert hits() == whole
    named = docs.select("doc_id", "text", F.lit(1).alias("before"), F.lit("x").alias("hits_before"))
    found = decontam.with_hits(named, benchmark, drop_text=True)
    assert found.columns == ["doc_id", "before", "hits_before", "hits"] and {(r["before"], r["hits_before"]) for r in found.collect()} == {(1, "x")}
    assert sorted((r["doc_id"], sorted(tuple(h) for h in r["hits"])) for r in found.collect()) == whole
    assert decontam.with_hits(docs, benchmark.limit(0)).where("size(hits) > 0").count() == 0
    assert decontam.with_hits(docs, benchmark.limit(0), drop_text=True).columns == [*(c for c in docs.columns if c != "text"), "hits"]
    assert decontam.with_hits(docs.limit(0), benchmark).count() == 0


def test_the_error_budget_is_one_rule_for_all_lengths(spark):
    items = [(n, " ".join(["word", "item", "text", "more", "thing"][(n + i) % 5] + str(n + i) for i in range(n))) for n in range(1, 12)]
    docs = [(n, f"before it {x[:3]}{'' if decontam.budget(decontam.words_only(x)) else x[3]}{x[4:]} and after") for n, x in items]
    got = {r["doc_id"]: {h["item_id"]: h["distance"] for h in r["hits"]} for r in decontam.with_hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for n, item in items:
        for m, doc in docs:
            d = distance_within(decontam.words_only(item), decontam.words_only(doc))
            assert got[m].get(n) == (d if d <= decontam.RATE * len(decontam.words_only(item)) else None)


def test_every_document_against_every_item(spark, data):
    """All pairs of some documents and all items, by plain dynamic programming."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").limit(12).collect()]
    docs = [r for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect() if len(r["text"]) < 700][:40]
    found = decontam.with_hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], h["item_id"]): h["distance"] for r in found.collect() for h in r["hits"]}
    wanted = {}
    for k, text in docs:
        for i, item in items:
            plain = decontam.words_only(item)
            d = distance_within(plain, decontam.words_only(text))
            if d <= decontam.budget(plain):
                wanted[k, i] = d
    assert got == wanted


def any_item_occurs(items, text, budgets):
    """Whether an item occurs in a text within its budget, by the whole table of edit distances, column by column, of all items at once."""
    m = max(map(len, items))
    letters = np.zeros((len(items), m), np.int32)
    for row, item in zip(letters, items):
        row[: len(item)] = list(map(ord, item))
    steps, last = np.arange(m + 1), [len(x) for x in items]
    column = np.tile(steps, (len(items), 1))
    least = column[range(len(items)), last]
    for c in map(ord, text):
        new = np.zeros_like(column)
        new[:, 1:] = np.minimum(column[:, :-1] + (letters != c), column[:, 1:] + 1)
        column = np.minimum.accumulate(new - steps, 1) + steps
        least = np.minimum(least, column[range(len(items)), last])
    return bool((least <= budgets).any())


def test_the_stage_drops_just_the_documents_with_items(spark, data):
    """The decontamination stage against edit distances of every document and item: planted items within their budgets, one error beyond them, and the documents as they are."""
    rng = random.Random(8)
    items = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").collect()]
    texts = [r["text"][:800] for r in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").limit(36).collect()]
    for n, item in enumerate(items[:24]):
        k = decontam.budget(decontam.words_only(item))
        planted = edit(rng, decontam.words_only(item).strip(), k + n % 3)
        texts[n] = f"{texts[n][:300]} {planted} {texts[n][300:500]}"
    docs = spark.createDataFrame([(n, t, "en", "s", len(t)) for n, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    plain = [decontam.words_only(x) for x in items]
    budgets = np.array([decontam.budget(x) for x in plain])
    wanted = [n for n, t in enumerate(texts) if not any_item_occurs(plain, decontam.words_only(t), budgets)]
    got = sorted(r["doc_id"] for r in corpus_pipeline.without_benchmark(spark, docs, data).collect())
    assert got == wanted and 0 < len(wanted) < len(texts)


def test_clips_of_held_notes_are_found():
    """Most bands of a held note hold noise only; its keys must not."""
    rng, found = np.random.default_rng(5), 0
    for n in range(30):
        notes = np.concatenate([np.repeat(rng.integers(-18, 18) / 48, 40), rng.integers(-18, 18, 24) / 48])
        song = audio.rendered(list(notes))
        part = song[2048 : 2048 + 6144].astype(float)
        clip = np.clip(part + rng.normal(0, 600, len(part)), -32768, 32767).astype(np.int16).astype(float)
        values = audio.packed(audio.ratios(audio.chroma(song.astype(float)))).astype(np.int64)
        signs = values & audio.SIGNS
        index = set((signs[: -audio.REACH] | signs[audio.REACH :] >> 1).tolist())
        keys, _ = audio.lookups(clip)
        found += bool(index & set(keys.tolist()))
    assert found >= 27


def test_filters_are_sums_over_rectangles():
    image = np.random.default_rng(1).random((40, 12))
    prints = audio.fingerprint(image)
    assert len(prints) == 40 - audio.REACH + 1
    for t in (0, 5, len(prints) - 1):
        for n, (kind, y, h, w) in enumerate(audio.FILTERS):
            if kind != 2:
                continue
            one, other = image[t : t + w // 2, y : y + h].sum(), image[t + w // 2 : t + w, y : y + h].sum()
            level = np.digitize(np.log((1 + one) / (1 + other)), (-audio.STEP, audio.FLOOR, audio.STEP))
            assert (prints[t] >> np.uint32(2 * n)) & 3 == audio.GRAY[level]


def test_pitch_classes():
    t = np.arange(audio.RATE) / audio.RATE
    for semitone in (0, 3, 7):
        image = audio.chroma(9000 * np.sin(2 * np.pi * 440 * 2 ** (semitone / 12) * t))
        assert (image.argmax(1) == semitone).all()


def test_clips_are_found(spark, data):
    got = queries.QUERIES["op3_audio"](spark, data).collect()
    clips = [r for r in got if r["vec_id"] % audio.QUERY_EVERY == 0]
    assert len(got) == spark.read.parquet(f"{data}/embeddings.parquet").count()
    assert np.mean([r["match_class"] == r["class_id"] and r["match_offset"] == 32 for r in clips]) >= 0.9
    assert all(r["match_class"] is None for r in got if r["vec_id"] % audio.QUERY_EVERY)


def test_alignment_as_brute_force(spark):
    rng = np.random.default_rng(4)
    songs = [[float(x) for x in rng.normal(size=64) / 8] for _ in range(12)]
    songs[5] = songs[4][:50] + songs[3][:14]
    df = spark.createDataFrame([(20 * n, s) for n, s in enumerate(songs)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in audio.matched(df, "vec_id", "embedding").collect()}
    prints = {20 * n: audio.fingerprint(audio.chroma(audio.rendered(s).astype(float))) for n, s in enumerate(songs)}
    for n, s in enumerate(songs):
        clip = audio.fingerprint(audio.chroma(audio.excerpt(audio.rendered(s)).astype(float)))
        best = []
        for k, whole in prints.items():
            for at in range(len(whole) - len(clip) + 1):
                wrong = sum(int(a ^ b).bit_count() for a, b in zip(clip, whole[at:]))
                best.append((wrong / (32 * len(clip)), k, at))
        error, k, at = min(best)
        r = got[20 * n]
        assert (r["match_class"], r["match_offset"]) == (k, at) and abs(r["bit_errors"] - error) < 1e-6


def test_excerpts_off_the_hop_and_noisy_ones(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("embedding").distinct().orderBy("embedding").limit(60).collect()
    songs = [audio.rendered(r["embedding"]) for r in rows]
    rng, clips = np.random.default_rng(8), []
    for n, s in enumerate(songs):
        for k, (shift, noise) in enumerate([(32, 600), (64, 600), (96, 600), (0, 4000), (64, 4000)]):
            part = s[4096 + shift : 12288 + shift].astype(float)
            clips.append((10 * n + k, np.clip(part + rng.normal(0, noise, len(part)), -32768, 32767).astype(np.int16).tobytes()))
    whole = spark.createDataFrame([(n, s.tobytes()) for n, s in enumerate(songs)], "id long, pcm binary").select("id", audio.fingerprint_of("pcm").alias("prints"))
    asked = spark.createDataFrame(clips, "id long, pcm binary").select("id", audio.fingerprint_of("pcm").alias("prints"), audio.lookups_of("pcm").alias("lookups"))
    got = {(r["clip"], r["recording"]): (r["offset"], r["bit_errors"]) for r in audio.alignments(asked, whole).collect()}
    prints = {r["id"]: np.array(r["prints"]) for r in whole.collect()}
    for clip_id, pcm in clips:
        x, y = prints[clip_id // 10], audio.fingerprint(audio.chroma(np.frombuffer(pcm, np.int16).astype(float))).astype(np.int64)
        wanted = min((np.bitwise_count(x[at : at + len(y)] ^ y).sum() / (32 * len(y)), at) for at in range(len(x) - len(y) + 1))
        assert wanted[0] <= audio.MOST_ERRORS
        assert abs(got[clip_id, clip_id // 10][1] - wanted[0]) < 1e-9


@pytest.mark.parametrize("n", [1, 5, 12])
def test_short_clips_are_found(spark, n):
    """Clips of so few integers that no two of them share no frame, cut on and off the hop, with noise over them: recall against comparing with everything."""
    rng = np.random.default_rng(11)
    songs = [audio.rendered([float(x) for x in rng.normal(size=64) / 6]) for _ in range(40)]
    size = audio.FRAME + audio.HOP * (audio.REACH + n - 2)
    clips = []
    for i, song in enumerate(songs):
        at = 2048 + 32 * (i % 4)
        clips.append((i, np.clip(song[at : at + size] + rng.normal(0, 300, size), -32768, 32767).astype(np.int16).tobytes()))
    whole = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(songs)], "id long, pcm binary").select("id", audio.fingerprint_of("pcm").alias("prints"))
    asked = spark.createDataFrame(clips, "id long, pcm binary").select("id", audio.fingerprint_of("pcm").alias("prints"), audio.lookups_of("pcm").alias("lookups"))
    got = {(r["clip"], r["recording"]) for r in audio.alignments(asked, whole).collect()}
    prints = {r["id"]: np.array(r["prints"]) for r in whole.collect()}
    wanted = set()
    for i, pcm in clips:
        y = audio.fingerprint(audio.chroma(np.frombuffer(pcm, np.int16).astype(float))).astype(np.int64)
        assert len(y) == n
        x = prints[i]
        if min(np.bitwise_count(x[at : at + n] ^ y).sum() / (32 * n) for at in range(len(x) - n + 1)) <= audio.MOST_ERRORS:
            wanted.add((i, i))
    assert len(wanted) >= 36 and len(wanted & got) >= 0.9 * len(wanted)


def test_odd_recordings(spark):
    rows = [(1000, None), (1020, []), (1040, [None] * 64), (None, [0.1] * 64), (1060, [float("nan"), 0.2]), (1080, [0.1, -0.2] * 32), (1081, [0.1, -0.2] * 32), (1080, [0.1, -0.2] * 32)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = audio.matched(df, "vec_id", "embedding").collect()
    assert len(got) == len(rows)
    assert {r["class_id"] for r in got if r["vec_id"] in (1080, 1081)} == {1080}
    assert all(r["n_frames"] == 0 and r["class_id"] == r["vec_id"] for r in got if r["vec_id"] in (1000, 1020, 1060))
    assert audio.matched(df.limit(0), "vec_id", "embedding").count() == 0


@pytest.mark.parametrize("n", [0, 100, 511])
def test_short_recordings_have_no_frames(n):
    assert audio.chroma(np.zeros(n)).shape == (0, 12) and len(audio.fingerprint(audio.chroma(np.zeros(n)))) == 0
