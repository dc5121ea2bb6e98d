import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from paperflow.llm import queries, spelling


def counts(rows):
    n = Counter()
    for k, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{k}:{word}".encode())
            if k is not None and h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}


def near_words(words):
    """One letter inserted, deleted or replaced, by patterns with a hole and by plain deletion."""
    near, holes = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].append(w)
            less = w[:i] + w[i + 1 :]
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for same in holes.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    return near


def expected(words):
    near, forms, out = near_words(words), {}, []
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def grouped(spark, words):
    table = spark.createDataFrame([(i, w, n) for i, (w, n) in enumerate(words.items())], "id long, word string, n long")
    return sorted(tuple(r) for r in spelling.grouped(table).collect())


def test_query(spark, data, documents):
    words = counts([(r["doc_id"], r["text"]) for r in documents.collect()])
    got = sorted(tuple(r) for r in queries.op13_spelling(spark, data).collect())
    assert len(got) > 1000 and got == expected(words)


@pytest.mark.parametrize("seed", range(3))
def test_near_words(spark, seed):
    """Few letters, so that most words have many near ones; equal letters in a row; long words; ties."""
    rng = random.Random(seed)
    words = {}
    for _ in range(400):
        w = "".join(rng.choice("abé") for _ in range(rng.choice([7, 8, 8, 9, 12, 40, 333])))
        for _ in range(4):
            words[w] = rng.choice([2, 3, 20, 30, 300, 4000])
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:at] + ("" if kind == 0 else rng.choice("abÿ")) + w[at + (kind < 2) :]
    words = {w: n for w, n in words.items() if len(w) >= 7} | {"a" * k: 10**k for k in range(7, 12)}
    assert grouped(spark, words) == expected(words)


def test_odd_rows(spark, odd):
    got = {r["word"]: r["n"] for r in spelling.counted(odd, change=spelling.typo, least_letters=2).collect()}
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got["word"] in (60_000, 60_001) or "wor" in got
    assert set(counts(texts)) <= set(got)
    assert spelling.grouped(spelling.counted(odd.limit(0))).collect() == []
    assert grouped(spark, {"alonest": 2}) == [("alonest", None, "alonest", 2, 0, None)]
