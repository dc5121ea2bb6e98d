import random
import re

import pytest
from pyspark.sql import functions as F

from paperflow.llm import graph, minhash, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((top(a), top(b)))
                above[hi] = lo
    return sorted((k, len(s), top(k), k == top(k)) for k, s in sets)


def result(df):
    return sorted(tuple(r) for r in minhash.near_duplicates(df).where("doc_id is not null").collect())


def edited(rng, tokens, n):
    tokens = list(tokens)
    for _ in range(n):
        tokens[rng.randrange(len(tokens))] = f"edit{rng.randrange(10**9)}"
    return " ".join(tokens)


def test_as_brute_force(documents, odd):
    df = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    assert result(df) == brute([tuple(r) for r in df.collect()])
    nulls = minhash.near_duplicates(df).where("doc_id is null").collect()
    assert len(nulls) == 2 and all(r["component_id"] is None and r["kept"] for r in nulls)


def test_groups_of_edited_copies(spark):
    """Copies around the threshold: chains, copies of copies, and a group most of whose members are linked by their source only."""
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 8, 30, 120, 300]))]
        rows.append((len(rows), " ".join(base)))
        chain = base
        for _ in range(14):
            text = edited(rng, base, max(1, len(base) // rng.choice([20, 40, 70])))
            rows.append((len(rows), text))
            chain = edited(rng, chain, max(1, len(chain) // 60)).split()
            rows.append((len(rows), " ".join(chain)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = brute(rows)
    assert len({w[2] for w in wanted}) > 12
    assert result(df) == wanted


def test_leftovers_alone_find_all_links(spark):
    """As if no hub had linked anything: all members of two families meet block by block."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(900)}" for _ in range(80)]
    rows = [(n, edited(rng, base, rng.randrange(4))) for n in range(60)]
    df = spark.createDataFrame(rows, "id long, text string")
    signed = minhash.signatures(df, "id", "text").select("id", "n_shingles", "sketch", "bands")
    members = df.select("id", F.col("id").alias("component"), F.when(F.col("id") % 2 == 0, 0).otherwise(1).cast("long").alias("main"))
    old, minhash.BLOCK = minhash.BLOCK, 8
    try:
        got = {(r["a"], r["b"]) for r in minhash.leftovers(members, signed, df).collect()}
    finally:
        minhash.BLOCK = old
    sets = dict((k, shingles(t)) for k, t in rows)
    wanted = {(a, b) for a in sets for b in sets if a < b and a % 2 == b % 2 and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert got == wanted and wanted


def test_texts_of_one_id_link_their_copies(spark, words):
    a, b, c, d = (" ".join(words(40)) for _ in range(4))
    rows = [(3, a), (5, b), (7, a), (7, b), (9, c), (8, c), (8, d), (4, d), (11, ""), (11, c), (12, "")]
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    assert {k: v for k, _, v, _ in got} == {3: 3, 5: 3, 7: 3, 9: 4, 8: 4, 4: 4, 11: 4, 12: 12}


def test_extremes_are_unbiased():
    rng = random.Random(1)
    a = [rng.randrange(2**64) for _ in range(3000)]
    import numpy as np

    x, y = np.array(a[:2000], np.uint64), np.array(a[500:2500], np.uint64)
    (l1, h1), (l2, h2) = minhash.extremes(x), minhash.extremes(y)
    agree = ((l1 == l2).mean() + (h1 == h2).mean()) / 2
    assert abs(agree - 1500 / 2500) < 0.1


@pytest.mark.parametrize("n", [1, 2, 9])
def test_components_of_chains(spark, n):
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(100, 50), (50, 50)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {k: 0 for k in range(n + 1)} | {50: 50, 100: 50}


def test_empty(odd):
    assert minhash.near_duplicates(odd.limit(0)).count() == 0
    assert queries.QUERIES["op7_minhash"]
