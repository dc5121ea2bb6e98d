import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperflow.functions import casts, jsons, keys, text
from paperflow.operators import patterns, vocabulary


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(n, r) for n, r in enumerate(rows)], f"n int, v {kind}")
    return [r[1] for r in sorted(df.select("n", column).collect())]


def test_clean_doi(spark):
    got = values(spark, keys.clean_doi(F.col("v")), [None, " HTTPS://doi.org/10.1/ABC\n", "doi:10.1/x", "http://dx.doi.org/10.2/Y", "10.48550/arXiv.1", "doi:doi:1"])
    assert got == ["", "10.1/abc", "10.1/x", "10.2/y", "10.48550/arxiv.1", "doi:1"]


def test_clean_doi_loose(spark):
    assert values(spark, keys.clean_doi_loose(F.col("v")), ["https://dx.doi.org/10.1/A; see", "10.1/b,c", "10.1/c d", None]) == ["10.1/a", "10.1/b", "10.1/c", ""]


def test_normalize_title(spark):
    got = values(spark, keys.normalize_title(F.col("v")), ["The Analysis of 12 Cells (Preprint)", "Über: die  Zelle!", None, "", "the of and"])
    assert got == ["analysis cells preprint", "über die zelle", "", "", ""]


def test_normalize_authors(spark):
    got = values(spark, keys.normalize_authors(F.col("v")), [["Smith, J", "Doe, A.B."], ["van der Berg, K", "Élan"], [], None, [" ", "O"]], "array<string>")
    assert got == ["doe_smith", "van der berg_élan", "", "", "o"]


def test_truncate_text(spark):
    assert values(spark, text.truncate_text(F.col("v"), 3), [" abcd ", "  ", None, "é"]) == ["abc", None, None, "é"]


@pytest.mark.parametrize(
    ("kind", "rows", "wanted"),
    [
        ("string", [" a ", "N/A", "nan", "[]", None], ["a", "", "", "", ""]),
        ("boolean", [True, False, None], ["Yes", "No", ""]),
        ("array<string>", [["a", "", "b"], [], None], ["a b", "", ""]),
        ("struct<x:string,y:int>", [("N/A", 3), ("a", None), None], ["3", "a", ""]),
        ("array<struct<x:string,y:string>>", [[("a", "nan"), (None, "b")], []], ["a b", ""]),
    ],
)
def test_annotation_to_text(spark, kind, rows, wanted):
    schema = T._parse_datatype_string(f"v {kind}")["v"].dataType
    assert values(spark, text.annotation_to_text(F.col("v"), schema), rows, kind) == wanted


def test_parse_list_text(spark):
    got = values(spark, text.parse_list_text(F.col("v")), ["['a', 'b']", '["c"]', "a, ,b", "[broken", None, ""])
    assert got == [["a", "b"], ["c"], ["a", "b"], ["[broken"], [], []]


def test_embedding_text(spark):
    df = spark.createDataFrame([("A title", None, "x\n y")], "a string, b string, c string")
    assert df.select(text.embedding_text([F.col(c) for c in "abc"])).first()[0] == "A title. x y"


def test_bools(spark):
    v = F.try_parse_json("v")
    rows = ["true", '"TRUE"', "false", "1", '"x"', None, "null"]
    assert values(spark, casts.strict_bool(v), rows) == [True, False, False, False, False, False, False]
    assert values(spark, casts.repaired_bool(v), rows) == [True, True, False, False, False, False, False]
    assert values(spark, casts.truthy_text(F.col("v")), ["Yes", "t", "0", None]) == [True, True, False, False]


def test_parse_llm_json(spark):
    value, status = jsons.parse_llm_json(F.col("v"))
    rows = ['{"a": 1}', '```json\n{"a": 1}\n```', '```\n{"a": 1}```', "no", None, ""]
    assert values(spark, F.to_json(value), rows) == ['{"a":1}'] * 3 + [None] * 3
    assert values(spark, status, rows)[3:] == [jsons.PARSE_ERROR] * 3


def test_nesting_is_inverted(spark):
    schema = T.StructType.fromDDL("id int, a struct<x_y:int,z:string>")
    df = spark.createDataFrame([(1, (2, "q"))], schema)
    assert jsons.nest_columns(jsons.flatten_struct(df, "a"), schema).collect() == df.collect()


def test_vocabulary_errors():
    with pytest.raises(ValueError, match="label 'x': invalid pattern"):
        vocabulary.load_vocabulary({"x": ["("]})
    assert vocabulary.load_vocabulary({"x": None}) == {"x": ()}


def test_vocabulary_files():
    lines = ["# words", "", "Cells:", "  - '\\bcells?\\b'", '  - "\\\\bT cell\\\\b"  # one', "none: []", "'RNA seq':", "- it''s", "- 'it''s'"]
    assert vocabulary.read_vocabulary(lines) == {"Cells": (r"\bcells?\b", r"\bT cell\b"), "none": (), "RNA seq": ("it''s", "it's")}
    with pytest.raises(ValueError, match="line 2"):
        vocabulary.read_vocabulary(["a:", "what"])
    with pytest.raises(ValueError, match="label 'a': invalid pattern"):
        vocabulary.read_vocabulary(["a:", "- '('"])


def test_shapes_of_vocabulary_files():
    """Comments behind labels, lists and quoted patterns; apostrophes in comments; lists of one line; escapes."""
    lines = ["'Other one': # needs quotes", '  - "\\\\b(?:colitis|Crohn\'s)\\\\b" # can\'t go', "- 'foo' # don't", "Empty: [] # an 'empty' list", "Flow: [a, 'b, c', \"d\\\\s\"] # x", "Plain label:   # none", "  - \\bfoo bar\\b  # it's", "  -   c#d", '"q\\"x":']
    assert vocabulary.read_vocabulary(lines) == {"Other one": (r"\b(?:colitis|Crohn's)\b", "foo"), "Empty": (), "Flow": ("a", "b, c", r"d\s"), "Plain label": (r"\bfoo bar\b", "c#d"), 'q"x': ()}
    for bad in ("- 'a' b", "- 'a", "x: y", "z: [a", r'- "\d"'):
        with pytest.raises(ValueError, match="line 2"):
            vocabulary.read_vocabulary(["a:", bad])


@pytest.mark.parametrize(
    ("pattern", "texts", "keys"),
    [(r"\bcells?\b", {"cell"}, {"cell"}), ("RNA-Seq", {"rna-seq"}, {None}), (r"\bRNA-Seq", {"rna-seq"}, {"rna"}), (r"\bAD\b", {"ad"}, {"ad"}), ("a|b", {"a", "b"}, {None}), (r"\b(?:malaria|MS)\b", {"malaria", "ms"}, {"mala", "ms"}), ("(x|y)tail", {"tail"}, {None}), ("ab{0,2}cd", {"cd"}, {None}),
     (r"[a-z]x.*\blong one\b", {"long one"}, {"long"}), (r"a\.b", {"a.b"}, {None}), ("ab*", {"a"}, {None}), ("(?:un)?known", {"known"}, {None}), (r"\bsingle[- ]cell", {"single"}, {"sing"}), ("ab+c", {"ab"}, {None}), (r"(?:\balpha\b|\bbeta\b)", {"alpha", "beta"}, {"alph", "beta"})],
)
def test_needs_of_patterns(pattern, texts, keys):
    found = patterns.needs(pattern)
    assert {n.text for n in found} == texts and {n.key() for n in found} == keys


@pytest.mark.parametrize("pattern", [r"\d+", "", r"\x41bc", r"x\x2dseq", "(?x) rna -seq", "(?i)a", r"(a)\1b", "[a-z&&[b]]x", "a|", "(?=ab)", "é"])
def test_patterns_that_need_nothing(pattern):
    assert not patterns.needs(pattern)


@pytest.mark.parametrize(
    ("pattern", "within", "lookups"),
    [(r"\b(?:on|th)ung\b", True, {"^onun", "^thun"}), (r"\bi[ae]th\w*", True, {"^iath", "^ieth"}), (r"[a-z]+keit\b", True, {"$keit"}), (r"\bcells?\b", True, {"^cell"}), (r"\bT cells\b", False, {"^cell"}), (r"\ba[A-z]bc\b", False, {"$bc"}), (r"\bab[^c]d\b", False, {"^ab"}), (r"\bab(?=c)", False, {"^ab"}),
     (r"\bx2\d+\b", True, {"^x2"}), (r"abs.cd\b", False, {"$cd"}), ("known", False, set()), (r"\b(?:a|)b+c\b", True, {"$c"}), (r"\b(?:ab|c)+\b", True, {"^ab", "^c"}), (r"\b[AB]c\w*|dd\b", True, {"^ac", "^bc", "$dd"}), (r"\b[ab]+", True, {"^a", "^b"}), (r"\b\w*[xy]z\b", True, {"$xz", "$yz"})],
)
def test_patterns_are_found_by_ends_of_words(pattern, within, lookups):
    found = patterns.found_by(pattern)
    assert found.within_word == within and found.keys == lookups


def random_patterns(rng, n):
    words = ["cell", "cells", "rna", "rna-seq", "ad", "it", "tumor", "x_y", "42"]

    def part(depth):
        kind = rng.randrange(12)
        w = rng.choice(words)
        if kind < 4:
            return w.upper() if kind == 3 else w
        if kind == 4:
            return rf"\b{w}\b"
        if kind == 5:
            return rng.choice([r"\s+", r"\W", ".", "[- ]?", "[a-c]", r"\w*", r"\d", "s?", "é", r"\x41", r"\-", r"\.", "[^ ]"])
        if kind in (6, 7) and depth < 2:
            inner = "|".join(part(depth + 1) for _ in range(rng.randrange(1, 4)))
            return rng.choice(["(?:", "("]) + inner + ")" + rng.choice(["", "", "?", "+", "{1,2}", "*", "+?"])
        if kind == 8:
            return w + rng.choice(["?", "*", "+", "{2}", "{0,1}"])
        if kind == 9:
            return rng.choice([r"\b", r"\B", "^", "(?=c)", "(?!r)", "(?<!a)"])
        if kind == 10:
            return rng.choice([r"(a)\1", "|", r"(\w)\1"]) if depth else r"(\w)\1"
        return rng.choice([" ", "-", "_", "a"])

    return ["".join(part(0) for _ in range(rng.randrange(1, 5))) for _ in range(n)]


def test_index_loses_no_match(spark):
    """Random patterns with escapes, sets, options, lookarounds and back references against each pattern on its own."""
    import random
    import re

    rng = random.Random(7)
    signs = ["cell", "cells", "CELL", "rna", "RNA-Seq", "ad", "Ad", "it", "tumor", "tumors", "x_y", "42", "é", "A", "aa", "K", "İ", "-", ".", " ", "  ", "_", "ß"]
    rows = ["".join(rng.choice(signs) + rng.choice(["", " ", " ", "é", "-"]) for _ in range(rng.randrange(0, 14))) for _ in range(60)]
    chosen = []
    for p in random_patterns(rng, 400):
        try:
            re.compile(p)
        except re.error:
            continue
        chosen.append(p)
    assert sum(bool(patterns.needs(p)) for p in chosen) > 150
    index = patterns.Index((str(i), p) for i, p in enumerate(chosen))
    got = values(spark, F.transform(index.found(F.col("v")), lambda x: F.concat_ws("\0", F.array(x["name"]), x.found)), rows)
    df = spark.createDataFrame([(v,) for v in rows], "v string").coalesce(1)
    for at in range(0, len(chosen), 40):
        part = chosen[at : at + 40]
        wanted = df.select(*[F.regexp_extract_all("v", F.lit(f"(?i){p}"), F.lit(0)) for p in part]).collect()
        for mine, row in zip(got, wanted):
            own = {int(x.split("\0")[0]): x.split("\0")[1:] for x in mine}
            assert [own.get(at + i, []) for i in range(len(part))] == [list(x) for x in row]
    # patterns within words are run on words: the same different matches, and the same patterns in their order
    parts = values(spark, F.transform(index.fragments(F.col("v")), lambda x: F.concat_ws("\0", F.array(x["name"]), x.found)), rows)
    names = values(spark, F.transform(index.matching(F.col("v")), lambda x: x["name"]), rows)
    some = values(spark, index.any(F.col("v")), rows)
    for mine, whole, name, any_match in zip(parts, got, names, some):
        of = lambda hits: {(x.split("\0")[0], f) for x in hits for f in x.split("\0")[1:]}
        assert of(mine) == of(whole)
        assert name == [x.split("\0")[0] for x in whole] and any_match == bool(whole)
    assert any(kinds["words"] for kinds in index.keys.values())


def test_tags(spark):
    vocab = vocabulary.load_vocabulary({"none": [], "a": [r"\bcells?\b"], "b": ["rna", r"\brna-seq\b"]})
    rows = ["Cells and RNA-seq", "cellular", "", None]
    assert values(spark, vocabulary.tag_all(F.col("v"), vocab), rows) == [["a", "b"], [], [], []]
    assert values(spark, vocabulary.tag_first(F.col("v"), vocab), rows) == ["a", None, None, None]
    assert values(spark, vocabulary.tag_any(F.col("v"), vocab), rows) == [True, False, False, False]
    assert values(spark, vocabulary.tag_detail(F.col("v"), vocab), rows[:2]) == [{"a": ["cells"], "b": ["rna", "rna-seq"]}, {}]


def test_harmonize(spark):
    maps = {"RNA": ["RNA-seq"], "Any": ["seq"]}
    assert values(spark, vocabulary.harmonize_terms(F.col("v"), maps), [["scRNA seq", "x-seq", "other", "other"], []], "array<string>") == [["Any", "RNA", "other"], []]
    assert values(spark, vocabulary.harmonize_context(F.col("v"), {"Brain": ("brain",)}), ["Mouse brain", "n/a", " None ", "liver", None]) == ["Brain", None, None, None, None]


def test_large_maps_as_expressions(spark):
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc-1") for _ in range(rng.randrange(1, 7)))
    maps = [{f"{kind}{i}": [word() for _ in range(rng.randrange(0, 4))] for i in range(40)} for kind in ("x", "ab")]
    rows = [(i, [word() + " " + word() for _ in range(rng.randrange(0, 5))]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, terms array<string>")
    tables = [spark.createDataFrame([(label, w, n) for n, (label, ws) in enumerate(m.items()) for w in ws], "label string, keyword string, place int") for m in maps]
    wanted = df.select("id", vocabulary.harmonize_terms(F.col("terms"), *maps).alias("terms")).orderBy("id").collect()
    assert vocabulary.harmonize_with_tables(df, "terms", *tables).orderBy("id").collect() == wanted


def test_rows_meet_large_maps_once(spark):
    """However many maps: the rows are read for their distinct terms, for what these become, and for their ids."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.createDataFrame([(i, [f"word {i % 7}", f"other {i}"]) for i in range(30)], "id int, terms array<string>")
    maps = [spark.createDataFrame([(f"label {n}", f"{word}", n)], "label string, keyword string, place int") for n, word in enumerate(("word3", "label", "other1"))]
    found = {r["id"]: r["terms"] for r in vocabulary.harmonize_with_tables(df.mapInArrow(counted, df.schema), "terms", *maps).collect()}
    assert found[3] == ["label 1", "other 3"] and found[10] == ["label 1", "label 2"] and read.value <= 3 * 30
