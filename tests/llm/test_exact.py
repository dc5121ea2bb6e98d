import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from paperflow.llm import exact, queries


def expected(rows):
    groups = {}
    plain = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    order = lambda k, t: (-len(t or ""), k is None, k or 0)
    for k, t in rows:
        groups.setdefault(plain(t), []).append(order(k, t))
    out = []
    for k, t in rows:
        same = groups[plain(t)]
        best = min(same)
        keep = None if best[1] else best[2]
        out.append((k, keep, len(same), order(k, t) == best, hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df, **options):
    return sorted((tuple(r) for r in exact.duplicates(df, **options).collect()), key=str)


def copies(n=400):
    """Groups of copies with other white space, one of them a third of all rows, and many single texts."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        text = "the text that everyone has" if i % 3 == 0 else f"text {rng.randrange(n // 3)} é 日本" if i % 3 == 1 else f"single {i}"
        rows.append((i, text.replace(" ", rng.choice([" ", "  ", "\n", "\t\x0b", "\x0c\r"]))))
    return rows


# 0: all hashes equal; top bits: few hashes, so that texts of a hash differ and no directory can part them
@pytest.mark.parametrize("mask", [-1, 0, -(1 << 61)])
@pytest.mark.parametrize("capacity", [exact.CAPACITY, 500])
def test_as_brute_force(spark, odd, mask, capacity):
    rows = copies() + [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"hash": F.lit(1), "points": F.lit("x"), "page": F.lit(0)})
    assert result(df, mask=mask, capacity=capacity) == expected(rows)


def test_no_rows_and_rows_that_stay(spark, odd):
    assert result(odd.limit(0)) == []
    df = spark.createDataFrame([(*r, 1, "x") for r in copies()], "doc_id long, text string, n int, gone_key string")
    left = exact.without_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(k for k, _, _, kept, _ in expected(copies()) if kept)


def test_directory_parts_what_is_full(spark):
    slots = spark.createDataFrame([(i, 10 if i < 8 else 100 if i == 9 else 0) for i in range(16)], "slot long, bytes long")
    got = {r["slot"]: (r["bucket"], r["pages"]) for r in exact.directory(slots, 4, 0, 40).collect()}
    assert [got[i] for i in range(8)] == [(0, 1)] * 4 + [(4, 1)] * 4
    assert got[8] == (8, 1) and got[9] == (9, 3) and {got[i] for i in (10, 11)} == {(10, 1)} and {got[i] for i in range(12, 16)} == {(12, 1)}


def test_query(same_rows):
    same_rows(queries.op12_exact, queries.ORACLE_SQL["op12_exact"])
