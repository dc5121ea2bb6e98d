import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperflow.llm import queries, runs


def all_runs(words):
    """By definition: every maximal stretch of every period, without those of a smaller one."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def rewritten(key, words):
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text, change):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    words = rewritten(key, words) if change else words
    found = all_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    digest = hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
    return len(words), found, digest


def result(df, **options):
    return [(r["doc_id"], r["n"], [tuple(x) for x in r["runs"]], r["digest"]) for r in runs.periodic(df, **options).collect()]


def texts(seed):
    """Repetitions of all kinds: of one word, of repetitions, of long stretches with words between, over few words."""
    rng = random.Random(seed)
    out = []
    for i in range(60):
        few = [chr(97 + rng.randrange(2 + i % 3)) for _ in range(rng.randrange(1, 40))]
        words = []
        while len(words) < rng.randrange(20, 900):
            kind = rng.randrange(4)
            if kind == 0:
                words += few * rng.randrange(1, 6)
            elif kind == 1:
                words += [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 50))]
            elif kind == 2:
                words += (words[-rng.randrange(1, 200) :] or ["x"]) * rng.randrange(1, 4)
            else:
                words += [rng.choice("ab") for _ in range(rng.randrange(1, 60))]
        out.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words)))
    return [*out, (100, "same " * 700), (101, "a b " * 333), (102, "x y"), (103, "one word here " * 13)]


@pytest.mark.parametrize("long", [runs.LONG, 40])
def test_as_brute_force(spark, long):
    """Also with the tiles of nearly all documents dealt."""
    rows = texts(1)
    got = result(spark.createDataFrame(rows, "doc_id long, text string"), long=long)
    assert sorted(got) == [(k, *expected(k, t, False)) for k, t in rows]


def test_odd_rows(spark, odd):
    got = result(odd, change=runs.repeated_tail, long=1000)
    wanted = [(r["doc_id"], *expected(r["doc_id"], r["text"], True)) for r in odd.where("length(text) < 9999 or text is null").collect()]
    assert sorted((x for x in got if x[0] != 900100), key=str) == sorted(wanted, key=str)
    # one word 60,000 times, in its own or a repeated tail's words: one run of period 1
    assert [x[1:3] for x in got if x[0] == 900100] == [(60_000, [(0, 60_000, 1)])]
    assert result(odd.limit(0)) == []


def test_query(spark, data, documents):
    got = {r["doc_id"]: r for r in queries.op11_runs(spark, data).collect()}
    rows = documents.where(F.length("text") < 6000).collect()
    assert len(rows) > 100 and len(got) == documents.count()
    for r in rows:
        _, found, digest = expected(r["doc_id"], r["text"], True)
        mine = got[r["doc_id"]]
        assert mine["n_runs"] == len(found) and mine["collapsed_sha256"] == digest
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(found, key=lambda x: (x[0], x[2])))
        assert mine["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (mine["start"], mine["length"], mine["period"]) == (best or (None, None, None))
        assert mine["exponent_milli"] == (1000 * best[1] // best[2] if best else None)


def test_words_in_chunks(monkeypatch):
    text = " ".join(f"word{i % 97}é" for i in range(5000))
    whole = runs.words_of(text)
    monkeypatch.setattr(runs, "CHUNK", 100)
    cut = runs.words_of(text)
    assert whole[1] == cut[1] and np.array_equal(whole[0], cut[0])
    assert runs.collapsed(*cut) == hashlib.sha256(text.encode()).hexdigest()
