import hashlib
import json
import random
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from paperflow.llm import bpe, bpe_tables, queries, token_counts

LETTERS = list("abcdeilmnorstv'''  \n\t!!..<|>012²ⅧéÉßΣσςİHẖ̀\xa0\x1c\x85​한字日🙂👍🏽 _-") + ["'ll", "'re", "<|endoftext|>", "<|startoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_path())


def texts(n, letters=LETTERS, most=80, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_counts_are_the_library_s(library):
    sample = texts(4000) + ["a" * 3000, "ab" * 2000, "!" * 2000, "", "<|endoftext|>"]
    assert token_counts.Counter(queries.tokenizer_path()).counts(sample) == [len(e.ids) for e in library.encode_batch(sample, add_special_tokens=False)]


def test_contractions_are_single_tokens(library):
    # the join of two encodings relies on it
    assert all(len(library.encode(c, add_special_tokens=False).ids) == 1 for c in bpe_tables.CONTRACTIONS)


def test_no_pair_outranks_the_one_that_makes_its_parts():
    vocab = bpe_tables.vocabulary(queries.tokenizer_path())
    left, right = vocab.keys // vocab.size, vocab.keys % vocab.size
    rank_of = np.full(vocab.size, -1)
    rank_of[vocab.made] = np.arange(len(vocab.made))
    assert (rank_of[left] < vocab.ranks).all() and (rank_of[right] < vocab.ranks).all()
    assert len(np.unique(vocab.made)) == len(vocab.made)


@pytest.mark.parametrize("letters", [LETTERS[:-2], list("abcdeinorst"), list("字日本語é"), list("'lrems!"), list("a"), list(" a")])
def test_joined_halves_are_the_whole(library, letters):
    coder = bpe.Encoder(queries.tokenizer_path())
    rng = random.Random(5)
    for text in map(bpe_tables.normalized, texts(150, letters, 300, 2)):
        parts = bpe.halves(text, rng.choice([1, 3, 10, 40]))
        raw = [p.encode() for p in parts]
        bounds = [0, *np.cumsum([len(x) for x in raw]).tolist()]
        coded = [(i, s + at) for (i, s), at in zip(map(coder.plain, parts), bounds)]
        assert bpe.tree(coder, text.encode(), coded, bounds).tolist() == coder.plain(text)[0].tolist()


def check(rows, library, text_of):
    for r in rows:
        ids = library.encode(text_of(r) or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False) == bpe.decode_ids(r["ids"], queries.tokenizer_path())


def test_encoding_of_documents_in_small_chunks(documents, odd, library):
    df = documents.select("doc_id", "text").union(odd.select("doc_id", "text")).union(odd.sparkSession.createDataFrame([(1, "x<|endoftext|>Y" * 90), (2, "é" * 900), (3, " " * 800)], "doc_id long, text string"))
    rows = bpe.encode_texts(df, queries.tokenizer_path(), long=700, chunk=101).collect()
    assert len(rows) == df.count()
    check(rows, library, lambda r: r["text"])


def test_columns_of_any_name_come_back(spark, library):
    rows = [(1, "long text " * 50, "a", "b"), (2, "short", "c", "d"), (2, "short", "c", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_key string, Text_Key_ string")
    for drop in (False, True):
        got = bpe.encode_texts(df, queries.tokenizer_path(), long=100, chunk=40, drop_text=drop)
        assert got.columns == [c for c in df.columns if not (drop and c == "text")] + ["n_tokens", "ids", "decoded"]
        assert sorted((r["doc_id"], r["text_key"], r["Text_Key_"]) for r in got.collect()) == [(1, "a", "b"), (2, "c", "d"), (2, "c", "d")]
        texts_of = {1: rows[0][1], 2: "short"}
        check(got.collect(), library, lambda r: texts_of[r["doc_id"]])


@pytest.mark.parametrize("change", ["normalizer", "split", "ranks", "model"])
def test_other_vocabularies_are_refused(tmp_path, change):
    spec = json.loads(Path(queries.tokenizer_path()).read_text())
    if change == "normalizer":
        spec["normalizer"] = {"type": "NFKC"}
    elif change == "split":
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": r"\\S+"}
    elif change == "ranks":
        spec["model"]["merges"].reverse()
    else:
        spec["model"]["end_of_word_suffix"] = None
    path = tmp_path / "x.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="x.json"):
        bpe_tables.Vocabulary(str(path))


def test_odd_rows(odd, library):
    rows = bpe.encode_texts(odd, queries.tokenizer_path()).collect()
    assert len(rows) == odd.count()
    check(rows, library, lambda r: r["text"])
    counts = token_counts.count_tokens(odd, queries.tokenizer_path())
    assert counts.columns == ["doc_id", "score", "lang", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(r["n_tokens"] for r in counts.collect()) == sorted(r["n_tokens"] for r in rows)
    assert bpe.encode_texts(odd.limit(0), queries.tokenizer_path()).count() == 0
    assert token_counts.count_tokens(odd.limit(0), queries.tokenizer_path()).count() == 0


def test_queries(spark, data, library):
    texts_of = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    counts = {r["doc_id"]: r for r in queries.op2_token_counts(spark, data).collect()}
    coded = queries.op9_bpe(spark, data).collect()
    assert len(coded) == len(counts) == len(texts_of)
    for r in coded:
        ids = library.encode(texts_of[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) == counts[r["doc_id"]]["n_tokens"]
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert counts[r["doc_id"]]["n_bytes"] == len(texts_of[r["doc_id"]].encode())
        assert counts[r["doc_id"]]["over_limit"] == (len(ids) > 2048)
