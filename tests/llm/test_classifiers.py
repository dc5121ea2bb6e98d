import math
import random
import unicodedata
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperflow.llm import common, hosts, langid, quality, queries
from paperflow.llm.common import fold

BIG = "/root/testdata/sf0.01"


def test_fold(spark):
    df = spark.createDataFrame([(5,), (123,), (None,)], "k long")
    assert [r[0] for r in df.select(fold("k", 5)).collect()] == [zlib.crc32(b"5") % 5, zlib.crc32(b"123") % 5, 0]


def test_quality_held_out(spark):
    scored = queries.op5_quality(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").where("held_out").collect()
    good, poor = [r["score"] for r in scored if r["quality"] == 1], [r["score"] for r in scored if r["quality"] == 0]
    assert np.mean([g > p for g in good for p in poor]) > 0.9
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in scored)


def test_the_whole_quality_query_is_its_plain_version(spark, data):
    """Dense matrices over all labelled rows, cross-fitted scores, isotonic means by the min-max formula."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    labels = [(r["doc_id"], float(r["quality"] > 0)) for r in spark.read.parquet(f"{data}/labels.parquet").collect() if r["quality"] is not None and r["doc_id"] in docs]
    crc = lambda x: zlib.crc32(x.encode())
    learned = [(k, y) for k, y in labels if crc(str(k)) % 5]
    x = np.array([quality.statistics(docs[k]) for k, _ in learned])
    y = np.array([y for _, y in learned])
    folds = np.array([crc(f"fold{k}") % quality.FOLDS for k, _ in learned])
    spread = np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    rng = np.random.default_rng(quality.SEED)
    frequency = rng.normal(size=(x.shape[1], quality.FEATURES)) / (quality.WIDTH * x.shape[1] ** 0.5)
    phase = rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def raised(rows):
        z = np.clip((rows - x.mean(0)) / spread, -8, 8)
        return np.hstack([np.cos(z @ frequency + phase) * (2 / quality.FEATURES) ** 0.5, np.ones((len(rows), 1))])

    def fitted(some):
        z = raised(x[some])
        return np.linalg.solve(z.T @ z + np.diag([quality.RIDGE] * quality.FEATURES + [1e-6 * quality.RIDGE]), z.T @ y[some])

    raw = np.zeros(len(y))
    for i in range(quality.FOLDS):
        raw[folds == i] = raised(x[folds == i]) @ fitted(folds != i)
    places = np.clip(np.rint((raw + 1) / 3 * quality.GRID), 0, quality.GRID).astype(int)
    known = np.unique(places)
    level = [max(min(y[(places >= a) & (places <= b)].mean() for b in known[n:]) for a in known[: n + 1]) for n in range(len(known))]
    share = (y.sum() + 1) / (len(y) + 2)
    grid = np.interp(np.arange(quality.GRID + 1), known, 0.99 * np.array(level) + 0.01 * share)
    ids = sorted(docs)
    wanted = np.interp(raised(np.array([quality.statistics(docs[k]) for k in ids])) @ fitted(folds >= 0), np.linspace(-1, 2, quality.GRID + 1), grid)
    got = {r["doc_id"]: r for r in queries.op5_quality(spark, data).collect()}
    assert sorted(got) == ids
    assert np.allclose([got[k]["score"] for k in ids], wanted, atol=1e-6)
    assert all(got[k]["held_out"] == (crc(str(k)) % 5 == 0) for k in ids)


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = [(int(i % quality.FOLDS), float(v), [float(a) for a in s]) for i, (v, s) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "fold long, y double, statistics array<double>").repartition(4)
    model = quality.train(df)
    z = quality.features(x, x.mean(0), x.std(0))
    wanted = np.linalg.solve(z.T @ z + quality.RIDGE * np.diag([*[1.0] * quality.FEATURES, 1e-6]), z.T @ y)
    assert np.allclose(model.weights, wanted, atol=1e-6)
    assert (np.diff(model.grid) >= -1e-12).all()


def test_isotonic():
    level = quality.rising(np.array([1.0, 0, 1, 3, 2]), np.array([2.0, 2, 2, 3, 3]))
    assert np.allclose(level, [0.25, 0.25, 0.5, 5 / 6, 5 / 6])


def test_quality_odd_rows(spark, odd):
    known = quality.with_statistics(odd)
    for labels in ([], [(900004, 1, 0)], [(900001, 0, 0), (900004, 1, 0), (None, 1, 0), (900002, None, 0), (900006, 1, 1), (900007, 0, 0)]):
        model = quality.train(quality.training_rows(known, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
        got = quality.scored(known, model).collect()
        assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.scored(known.limit(0), model).count() == 0


def test_language_held_out(spark):
    got = queries.op10_language_id(spark, BIG).join(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98


def plain_words(text):
    """(start, end, trigram buckets, script, letters) of each word, letter by letter."""
    low = text.replace("İ", "i").lower()
    inside = [unicodedata.category(c)[0] in "LM" for c in low]
    at = 0
    while at < len(low):
        if not inside[at]:
            at += 1
            continue
        end = at
        while end < len(low) and inside[end]:
            end += 1
        codes = [32, *map(ord, low[at:end]), 32]
        grams = [(sum(c * m for c, m in zip(codes[i : i + 3], langid.MULTIPLIERS)) % 2**32) >> 16 for i in range(end - at)]
        script = max((first, name) for first, name in langid.SCRIPTS if first <= ord(low[at]))[1]
        yield at, end, grams, script, sum(unicodedata.category(c)[0] == "L" for c in low[at:end])
        at = end


def test_the_whole_language_query_is_its_plain_version(spark, data):
    """Counts in dictionaries, a path word by word, spans from the path."""
    docs = {r["doc_id"]: (r["text"], r["lang"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    crc = lambda k: zlib.crc32(str(k).encode())
    parsed = {k: list(plain_words(t or "")) for k, (t, _) in docs.items()}
    grams, scripts = {}, {}
    for k, (_, lang) in docs.items():
        if crc(k) % 4 != 2 and lang is not None:
            for _, _, g, script, letters in parsed[k]:
                grams.setdefault(lang, Counter()).update(g)
                scripts.setdefault(lang, Counter())[script] += letters
    languages = sorted(grams)
    totals = {x: sum(grams[x].values()) + 0.5 * langid.BUCKETS for x in languages}
    writes = {x: {s for s, n in scripts[x].items() if n >= langid.SHARE * sum(scripts[x].values())} for x in languages}

    def gains(word):
        able = [x for x in languages if word[3] in writes[x]]
        return [0.0 if not able else sum(math.log((grams[x][b] + 0.5) / totals[x]) for b in word[2]) if x in able else -1e6 for x in languages], bool(able)

    for r in queries.op10_language_id(spark, data).collect():
        found = parsed[r["doc_id"]]
        assert r["held_out"] == (crc(r["doc_id"]) % 4 == 2)
        value, back, sure = [0.0] * len(languages), [], []
        for n, word in enumerate(found):
            gain, able = gains(word)
            best = max(range(len(languages)), key=lambda i: value[i])
            back.append([best if n and value[best] - langid.PENALTY > v else i for i, v in enumerate(value)])
            value = [max(v, value[best] - langid.PENALTY) + g if n else g for v, g in zip(value, gain)]
            sure.append(able)
        state, path = max(range(len(languages)), key=lambda i: value[i]), []
        for step in reversed(back):
            path.append(state)
            state = step[state]
        path.reverse()
        mass, own = Counter(), Counter()
        for word, state, able in zip(found, path, sure):
            mass[state] += word[4]
            own[state] += word[4] * able
        if not sum(mass.values()):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        best = min(mass, key=lambda i: (-mass[i], i))
        assert r["lang_pred"] == languages[best] and abs(r["score"] - own[best] / sum(mass.values())) < 1e-9
        spans = []
        for word, state in zip(found, path):
            if spans and spans[-1][2] == languages[state]:
                spans[-1][1] = word[1]
            else:
                spans.append([word[0], word[1], languages[state]])
        assert [[x["start"], x["end"], x["lang"]] for x in r["spans"]] == spans


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 4, 1, 6, 0, 3])
    gain = rng.normal(size=(sizes.sum(), 3)).astype(np.float32)
    path = langid.viterbi(gain, sizes, 0.8)
    at = 0
    for n in sizes:
        best = max(np.ndindex(*[3] * n), key=lambda p: sum(gain[at + i, s] for i, s in enumerate(p)) - 0.8 * sum(a != b for a, b in zip(p, p[1:])), default=())
        assert tuple(path[at : at + n]) == best
        at += n


def test_language_spans_and_odd_rows(spark, odd):
    model = langid.train(spark.read.parquet(f"{BIG}/documents.parquet"))
    assert model.languages == ["de", "en", "es", "fr"]
    text = "İ The thing of and the erin with that. Der die und nicht ein mit der schtentz und die ge."
    df = odd.select("doc_id", "text", "lang", "score").union(spark.createDataFrame([(1, text, "x", 0.0)], "doc_id long, text string, lang string, score double"))
    got = langid.identify(df, model).collect()
    assert len(got) == df.count()
    for r in got:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, [])
        else:
            assert r["lang_pred"] in model.languages and 0 <= r["score"] <= 1
    spans = next(r["spans"] for r in got if r["doc_id"] == 1)
    assert [(s["lang"], text[s["start"] : s["end"]].split()[-1]) for s in spans] == [("en", "that"), ("de", "ge")]
    assert langid.identify(df.limit(0), model).count() == 0
    none = langid.train(df.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, none, spans=False).collect()} == {"und"}


def test_long_texts_are_labelled_in_pieces(spark, monkeypatch):
    model = langid.train(spark.read.parquet(f"{BIG}/documents.parquet"))
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the thing of", "der die und", "que los para", "les des est"]) for _ in range(300)) for _ in range(6)] + ["x" * 500, ""]
    whole = langid.label(model, texts, True, langid.PENALTY)
    monkeypatch.setattr(langid, "PART", 97)
    assert len(list(langid.cut(texts[0], 97))) > 10 and "".join(p for _, p in langid.cut(texts[0], 97)) == texts[0]
    assert langid.part_for(4) == langid.part_for(64) == 97 and langid.part_for(640) == 9
    assert langid.label(model, texts[:6] + [""], True, langid.PENALTY) == whole[:6] + whole[7:]


def test_many_languages(spark):
    rows = [(f"wort{n} {n}sprache {'abcdefghij'[n % 10] * 5}{n}q", f"l{n:04d}") for n in range(620)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 620 and model.weights.shape == (langid.BUCKETS, 620)
    got = langid.label(model, [t for t, _ in rows[:620:31]], False, langid.PENALTY)
    assert all(0 <= score <= 1 for _, score, _ in got)


def test_language_without_the_text_column(spark, odd):
    model = langid.train(spark.read.parquet(f"{BIG}/documents.parquet"))
    got = langid.identify(odd, model, drop_text=True)
    assert got.columns == ["doc_id", "n_tokens", "lang", "lang_pred", "score", "spans"] and got.count() == odd.count()


def test_scripts_narrow(spark):
    rows = [("Это русский текст про язык", "ru"), ("This is a text in English about language", "en"), ("Αυτό είναι ένα κείμενο", "el")] * 3
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    got = [langid.label(model, [t], False, langid.PENALTY)[0][0] for t in ("слово", "word", "λόγος", "字")]
    assert got[:3] == ["ru", "en", "el"] and langid.label(model, ["字"], False, langid.PENALTY)[0][1] == 0.0


def test_hosts_as_sql(same_rows):
    same_rows(queries.op8_hosts, queries.ORACLE_SQL["op8_hosts"])


def test_hosts_odd_urls_and_reputation(spark):
    urls = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTPS://ExAmple.ORG/es/x?q#f"), (5, "x://example.org/en/12"), (6, "x://a.b.example.org/de"), (7, "x://org"), (8, "x://norg/"), (9, "x://a.com/de/"), (10, "x://a.com:80/fr/"), (11, "x://www.a.co.uk/p"), (12, "x://10.0.0.1/p"), (None, "x://q.net/")]
    urls += [(100 + n, "x://bad.net/p") for n in range(60)] + [(200 + n, f"x://good{n % 3}.net/p") for n in range(60)]
    outcomes = spark.createDataFrame([(100 + n, 0) for n in range(50)] + [(200 + n, 1) for n in range(50)] + [(200, 0), (None, 0), (201, None)], "page_id long, good int")
    got = {r["page_id"]: r for r in hosts.judged(spark.createDataFrame(urls, "page_id long, url string"), outcomes).collect()}
    assert [(got[k]["host"], got[k]["path"]) for k in range(1, 5)] == [("", ""), ("", ""), ("", ""), ("example.org", "/es/x")]
    assert [got[k]["rule"] for k in range(4, 11)] == ["example.org/es/", "example.org/en/1", "org/", None, None, "com/de/", None]
    assert got[4]["verdict"] == got[5]["verdict"] == got[9]["verdict"] == "block" and got[6]["verdict"] == "allow"
    assert got[159]["verdict"] == "block" and got[259]["verdict"] == "allow"
    host = F.col("h")
    df = spark.createDataFrame([("www.a.co.uk:80",), ("a.b.net",), ("net",), ("10.0.0.1",), ("",)], "h string").select(hosts.suffix_of(host).alias("s"), hosts.domain_of(host, hosts.suffix_of(host)).alias("d"))
    assert [tuple(r) for r in df.collect()] == [("co.uk", "a.co.uk"), ("net", "b.net"), ("net", "net"), ("", "10.0.0.1"), ("", "")]
    assert hosts.judged(spark.createDataFrame([], "page_id long, url string"), outcomes).count() == 0
    assert hosts.judged(spark.createDataFrame(urls, "page_id long, url string"), outcomes.limit(0)).count() == len(urls)


def test_suffix_tables(spark):
    urls = spark.createDataFrame([(n, f"x://{h}/p") for n, h in enumerate(["a.b.or.jp", "me.github.io", "q.gob.mx:80", "github.io", "www.plain.net", ""])], "page_id long, url string")
    table = spark.createDataFrame([("or.jp",), ("github.io",), ("GOB.mx",), ("jp",), (None,), ("",)], "suffix string")
    pages = urls.select("page_id", hosts.host_of(F.col("url")).alias("host"))
    none = spark.createDataFrame([], "page_id long, good int")
    got = {r["host"]: (r["suffix"], r["domain"]) for r in hosts.reputations(pages, none, suffixes=table).collect()}
    assert got == {"a.b.or.jp": ("or.jp", "b.or.jp"), "me.github.io": ("github.io", "me.github.io"), "q.gob.mx:80": ("gob.mx", "q.gob.mx"), "github.io": ("github.io", "github.io"), "www.plain.net": ("net", "plain.net"), "": ("", "")}
    assert hosts.judged(urls, none, suffixes=table).count() == 6


def test_shared_folders(spark, tmp_path):
    made = []
    with common.temporary(spark):
        made.append(common.shared_dir(spark, "x"))
        spark.range(3).write.parquet(made[0])
    assert not Path(made[0].removeprefix("file://")).exists()
    kept = common.stored(spark.range(3), "y")
    assert kept.count() == 3
    assert common.fresh("a", ["A", "b", "a_"]) == "a__"

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.sql.warehouse.dir": "file:/tmp/x", "spark.master": "spark://somewhere"}.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session, "x")


@pytest.mark.parametrize("name", ["op5_quality", "op10_language_id"])
def test_all_rows_come_back(spark, data, documents, name):
    assert queries.QUERIES[name](spark, data).count() == documents.count()


def test_temporary_tables_of_other_threads_stay(spark):
    """Of two blocks in two threads, the one that ends first removes its own folders only."""
    import threading

    inside, over, left = threading.Event(), threading.Event(), {}

    def other():
        with common.temporary(spark):
            paths = common.stored(spark.range(5), "other").inputFiles()
            inside.set()
            over.wait(60)
            left["other"] = spark.read.parquet(*paths).count()

    thread = threading.Thread(target=other)
    with common.temporary(spark):
        thread.start()
        inside.wait(60)
        mine = common.stored(spark.range(5), "mine").inputFiles()[0]
    over.set()
    thread.join()
    assert left["other"] == 5 and not Path(mine.removeprefix("file://")).exists()
