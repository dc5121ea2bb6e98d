import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from paperflow.llm import pseudo_likelihood as P
from paperflow.llm import window_counts as W
from paperflow.llm.common import stored

BIG = "/root/testdata/sf0.01"


def split(text):
    return re.findall(r"\w+|[^\w\s]+", (text or "").lower())


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_counts_of_windows_as_brute_force(spark, odd, monkeypatch, size):
    monkeypatch.setattr(W, "CHUNK_WORDS", size)
    monkeypatch.setattr(W, "BUCKET_KEYS", 500)
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefg") + rng.choice(["", "", str(rng.randrange(40))]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += texts[:9] + ["a a a a a", "b"] + [None, ""] + ["one hot text of all"] * 200
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).union(odd.select("doc_id", "text"))
    chunks = stored(W.chunked(df, "doc_id", "text"), "chunks")
    every = [split(r["text"]) for r in df.collect()]
    n = W.total_words(chunks)
    assert n == sum(map(len, every))
    buckets = W.bucket_count(n)
    assert buckets > 3
    words, at_place = Counter(w for t in every for w in t), defaultdict(Counter)
    places = lambda t: [(t[i - 1] if i else None, t[i + 1] if i + 1 < len(t) else None) for i in range(len(t))]
    for t in every:
        for w, p in zip(t, places(t)):
            at_place[p][w] += 1
    found = stored(W.met(W.sent(chunks, buckets), n), "windows")
    assert {r["chunk"] for r in found.collect()} - {-1} == {r["chunk"] for r in chunks.collect() if any(r["sizes"])}
    got = []
    for r in chunks.collect():
        keys, at = W.words_of(r["vocab"], r["at"])
        sizes = np.array(r["sizes"], np.int64)
        total, known, left = W.answers(keys, at, sizes, [x.asDict() for x in found.where(f"chunk = {r['chunk']}").collect()], buckets)
        ends = np.cumsum(sizes)
        got += [(k, [tuple(x) for x in zip(total[at[e - s : e]].tolist(), known[e - s : e].tolist(), left[e - s : e].tolist())]) for k, s, e in zip(r["ids"], sizes, ends)]
    wanted = []
    for r in df.collect():
        t = split(r["text"])
        out = []
        for w, p in zip(t, places(t)):
            others = at_place[p] - Counter([w])
            n_, k, kinds = sum(others.values()), others[w], len(others)
            out.append((words[w], k / (n_ + kinds), kinds / (n_ + kinds)) if n_ else (words[w], 0.0, 1.0))
        wanted.append((r["doc_id"], out))
    assert [k for k, _ in sorted(got, key=str)] == [k for k, _ in sorted(wanted, key=str)]
    for (_, x), (_, y) in zip(sorted(got, key=str), sorted(wanted, key=str)):
        assert len(x) == len(y) and np.allclose(np.array(x), np.array(y), atol=1e-6)
    frequent, totals = W.frequent_words(found, 5)
    best = sorted(words.items(), key=lambda kv: -kv[1])[:5]
    assert totals.tolist() == [c for _, c in best]


def test_long_texts_are_split_between_words(monkeypatch):
    text = "Some words, of ΣΑΣ a text\n... that is long " * 30
    monkeypatch.setattr(W, "PIECE", 17)
    assert len(list(W.pieces(text))) > 10
    assert [w for p in W.pieces(text.lower()) for w in split(p)] == split(text)
    assert list(W.pieces("x" * 100)) == ["x" * 100] and list(W.pieces("")) == [""]


def test_words_are_told_apart():
    rng = random.Random(4)
    letters = list("abcDEFxyz019_-.,!?'ßéΣσ日本語🙂 \n\t\x1c\xa0") + ["İ", "\u0301"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))).lower() for _ in range(3000)]
    keys, sizes = W.word_keys(texts)
    words = [split(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in words]
    flat = [x for w in words for x in w]
    of = {}
    assert all(of.setdefault(w, k) == k for w, k in zip(flat, keys.tolist())) and len(set(of.values())) == len(of) > 2000
    ending = {w: k % W.ENDINGS for w, k in of.items()}
    assert all(ending[w] == k for w, k in ((w, W.word_keys([w[-3:]])[0][0] % W.ENDINGS) for w in list(of)[:300]))
    assert [len(x) for x in W.word_keys([])] == [0, 0] and W.word_keys(["", " "])[1].tolist() == [0, 0]


@pytest.mark.parametrize("kind", [np.uint16, np.uint32, np.uint64, np.int64, np.float32])
def test_packed_numbers_come_back(kind):
    x = np.arange(0, 1000, 3).astype(kind)
    assert (W.unpacked(W.packed(x), kind) == x).all() and (W.unpacked(W.packed(x[:0]), kind) == x[:0]).all()
    if kind not in (np.float32,):
        assert (W.risen(W.rising(x), kind) == x).all()


def small_net(rng):
    return {n: rng.normal(size=s).astype(np.float64) * 0.3 for n, s in P.SHAPES.items()}


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    net, x = small_net(rng), rng.normal(size=(7, 2 * P.SIDE * P.WIDTH))
    target, weight = rng.integers(0, P.CLASSES, 7), rng.dirichlet(np.ones(7))

    def loss():
        logits = np.tanh(x @ net["mix"] + net["shift"]) @ net["out"] + net["bias"]
        return -(weight * (logits[np.arange(7), target] - np.log(np.exp(logits).sum(1)))).sum()

    got = P.slopes(net, x, target, weight)
    for name, g in got.items():
        flat = net[name].reshape(-1)
        for i in rng.choice(flat.size, 6, replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g.reshape(-1)[i]) < 1e-6


def test_training_as_one_word_at_a_time(monkeypatch):
    """A pass over a tiny corpus, with every gradient summed word by word and Adam written out."""
    monkeypatch.setattr(P, "BATCH", 16)
    rng = np.random.default_rng(2)
    kind, space = rng.integers(0, P.CLASSES, P.TYPES), np.vstack([rng.normal(size=(P.TYPES, P.WIDTH)), np.zeros(P.WIDTH)]).astype(np.float32)
    texts = [(rng.integers(0, P.TYPES, n), c) for n, c in ((9, 1), (1, 5), (22, 2))]
    start = {n: w.astype(np.float32) for n, w in small_net(rng).items()}
    made, words = P.fitted(start, texts, kind, space, 0.01, 0.001)
    assert words == 9 + 5 + 44
    net, m, v = ({n: f(w.astype(np.float64)) for n, w in start.items()} for f in (np.copy, np.zeros_like, np.zeros_like))
    flat = [(d, i) for d, (t, _) in enumerate(texts) for i in range(len(t))]
    order = np.random.default_rng(P.SEED).permutation(len(flat))
    for t, a in enumerate(range(0, len(flat), 16), 1):
        some = [flat[k] for k in order[a : a + 16]]
        mass = sum(texts[d][1] for d, _ in some)
        total = {n: np.zeros_like(w) for n, w in net.items()}
        for d, i in some:
            types, copies = texts[d]
            near = [types[i + k] if 0 <= i + k < len(types) else P.TYPES for k in (-2, -1, 1, 2)]
            x = np.concatenate([space[j] for j in near]).astype(np.float64)
            hidden = np.tanh(x @ net["mix"] + net["shift"])
            p = np.exp(hidden @ net["out"] + net["bias"])
            p /= p.sum()
            p[kind[types[i]]] -= 1
            p *= copies / mass
            back = (net["out"] @ p) * (1 - hidden**2)
            for n, g in (("out", np.outer(hidden, p)), ("bias", p), ("mix", np.outer(x, back)), ("shift", back)):
                total[n] += g
        rate = 0.01 + (0.001 - 0.01) * min(1.0, t / 2)
        for n, g in total.items():
            m[n] = 0.9 * m[n] + 0.1 * g
            v[n] = 0.999 * v[n] + 0.001 * g * g
            net[n] = net[n] - rate * (m[n] / (1 - 0.9**t)) / (np.sqrt(v[n] / (1 - 0.999**t)) + 1e-8)
    for n in net:
        assert np.abs(made[n] - net[n]).max() < 2e-3 and np.abs(start[n] - net[n]).max() > 1e-3


def test_classes_as_one_word_at_a_time():
    rng = np.random.default_rng(2)
    net = {n: w.astype(np.float32) for n, w in small_net(rng).items()}
    kind, space = rng.integers(0, P.CLASSES, P.TYPES), np.vstack([rng.normal(size=(P.TYPES, P.WIDTH)), np.zeros(P.WIDTH)]).astype(np.float32)
    vocabulary = P.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), kind, np.zeros(P.CLASSES), space)
    sizes = np.array([3, 0, 1, 7])
    types = rng.integers(0, P.TYPES, sizes.sum())
    got = P.class_log_probabilities(net, vocabulary, types, sizes)
    for text in np.split(np.arange(sizes.sum()), np.cumsum(sizes)[:-1]):
        for k, i in enumerate(text):
            near = [types[text[k + d]] if 0 <= k + d < len(text) else P.TYPES for d in (-2, -1, 1, 2)]
            logits = np.tanh(np.concatenate([space[j] for j in near]) @ net["mix"] + net["shift"]) @ net["out"] + net["bias"]
            assert abs(got[i] - (logits[kind[types[i]]] - np.log(np.exp(logits).sum()))) < 1e-3


def test_types_and_clusters():
    keys, sizes = W.word_keys(["the bathe xthe", "", "of a"])
    assert sizes.tolist() == [3, 0, 2]
    assert len(set((keys & np.uint64(W.ENDINGS - 1)).tolist())) == 3 and len(set(keys.tolist())) == 5
    order = np.argsort(keys[:2])
    types = P.types_of(keys[:2][order], order, keys)
    assert types[:2].tolist() == [0, 1] and types[2] == P.FREQUENT + int(keys[0] & np.uint64(W.ENDINGS - 1))
    points = np.repeat(np.array([[0.0, 0], [9, 0], [0, 9]]), 5, 0) + np.random.default_rng(0).normal(size=(15, 2)) * 0.1
    own = P.clusters(points, np.ones(15), 3)
    assert len(set(own[:5])) == len(set(own[5:10])) == len(set(own[10:])) == 1 and len(set(own)) == 3


def test_what_it_learns_does_not_depend_on_partitions(spark, monkeypatch):
    """Several training groups; the same scores from 1, 8 and 64 partitions, and better ones than those of single words."""
    monkeypatch.setattr(P, "GROUP_WORDS", 100_000)
    monkeypatch.setattr(W, "CHUNK_WORDS", 50_000)
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text")
    counts = Counter(w for r in docs.collect() for w in split(r["text"]))
    n = sum(counts.values())
    single = sum(c * np.log(c / n) for c in counts.values()) / n
    first = None
    for parts in (1, 8, 64):
        got = by_id(P.scored(docs.repartition(parts)))
        net = sum(r["per_word"] * r["n_words"] for r in got.values() if r["n_words"]) / n
        assert net > single + 0.29
        first = first or got
        assert max(abs(r[c] - first[k][c]) for k, r in got.items() for c in ("counted_per_word", "per_word") if r["n_words"]) < 1e-3


def test_scores_tell_texts_apart(spark, odd):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text")
    every = docs.collect()
    rng = random.Random(1)
    shuffled = [(10**6 + r["doc_id"], " ".join(sorted(r["text"].split(), key=lambda _: rng.random()))) for r in every[:80]]
    noise = [(2 * 10**6 + n, " ".join("".join(rng.choice("qxzjkv") for _ in range(7)) for _ in range(80))) for n in range(20)]
    twice = [(3 * 10**6 + r["doc_id"], r["text"]) for r in every[100:130]]
    df = docs.union(odd.select("doc_id", "text")).union(spark.createDataFrame(shuffled + noise + twice, "doc_id long, text string"))
    rows = P.scored(df).collect()
    assert len(rows) == df.count()
    got = {r["doc_id"]: r for r in rows}
    mean = lambda ids, c="counted_per_word": np.mean([got[k][c] for k in ids if got[k]["n_words"]])
    own = [r["doc_id"] for r in every[:80]]
    assert mean(own) > mean([10**6 + k for k in own]) and mean(own, "per_word") > mean([10**6 + k for k in own], "per_word")
    assert mean(own) > mean([k for k, _ in noise])
    # texts that occur twice stand apart from those that share next to nothing with others
    runs = {r["doc_id"]: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for r in every if (w := split(r["text"]))}
    times = Counter(x for s in runs.values() for x in s)
    single = [k for k, s in runs.items() if len(s) > 20 and sum(times[x] > 1 for x in s) < 0.1 * len(s)]
    alone = sorted(got[k]["counted_per_word"] for k in single if not 100 <= k < 130)
    assert len(alone) > 300
    assert np.mean([got[k]["counted_per_word"] > alone[int(0.9 * len(alone))] for k in single if 100 <= k < 130]) > 0.95
    blank = [r for r in rows if r["doc_id"] in (900001, 900002, 900003)]
    assert len(blank) == 3 and all((r["n_words"], r["pll"], r["counted_pll"], r["counted_per_word"], r["per_word"]) == (0, 0.0, 0.0, None, None) for r in blank)


def test_few_or_no_words(spark, odd):
    assert P.scored(odd.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert [(r["n_words"], r["counted_per_word"]) for r in P.scored(none).collect()] == [(0, None)] * 2
    one = by_id(P.scored(spark.createDataFrame([(1, "word"), (2, "")], "doc_id long, text string")))
    assert one[1]["n_words"] == 1 and np.isfinite(one[1]["pll"]) and one[2]["pll"] == 0
    hot = by_id(P.scored(spark.createDataFrame([(k, "the same few words") for k in range(300)] + [(999, "some other words here")], "doc_id long, text string").repartition(5)))
    assert abs(hot[0]["counted_per_word"] - hot[299]["counted_per_word"]) < 1e-9 and hot[0]["counted_per_word"] > hot[999]["counted_per_word"] + 1


def test_texts_without_white_space_are_cut(monkeypatch):
    """A text of more letters than places have powers for, as of a file in base64."""
    chunk = W.Chunk()
    chunk.add(1, "x" * (17 << 20))
    chunk.split()
    assert sum(chunk.sizes) == 4
    monkeypatch.setattr(W, "PIECE", 10)
    monkeypatch.setattr(W, "LONGEST", 20)
    assert ["".join(W.pieces(t)) == t for t in ("a" * 95, "a b " * 30, "", "a" * 15 + " " + "b" * 30)] == [True] * 4
    assert [len(p) for p in W.pieces("a" * 95)] == [30, 30, 30, 5]
