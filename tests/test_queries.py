"""Every corpus query against its SQL; queries without SQL against what their result must satisfy."""

from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest

from paperflow.operators import sections, vectors
from paperflow.plans import queries_jobs, queries_models, queries_tables, queries_text  # noqa: F401
from paperflow.plans.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, same_rows):
    same_rows(QUERIES[name], SQL[name])


def test_queries_without_sql():
    assert set(QUERIES) - set(SQL) == {"embed_text", "project_2d", "spectral_layout"}


class Visible(HTMLParser):
    """The visible text of a page by a parser, against which the expressions are held; a lone < does not end a piece."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [""], 0

    def mark(self, *_):
        self.parts.append("")

    handle_comment = handle_decl = handle_pi = unknown_decl = mark

    def handle_starttag(self, tag, attrs):
        self.mark()
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.mark()
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts[-1] += data


def parsed(page):
    parser = Visible()
    parser.feed(page or "")
    parser.close()
    return "\n".join(x.strip() for x in parser.parts if x.strip())


ODD_PAGES = [
    "a &lt;b&gt; &amp;lt; &copy; &copy2 &notit; &hellip;&nbsp; x", "&#65;&#x42;&#128;&#0;&#1114112;&#55296;&#1; &#x1F600; &bogus; & && &#; &;", "<p title='a>b' x=\"c>d\">text</p>", "1 < 2 and 3 > 2", "<!-- <p>no</p> --> yes<!-- -->",
    "<script>var a = '<p>no</p>';</script>seen<STYLE>p{}</STYLE >too", "<br/>one<br />two<img src=x>three", "<!DOCTYPE html><?xml v?>text", "  edges  ", "", None, "no marks", "<b>bold</b><i>it</i>", "&amp;amp;", "&AMP;&ampx",
]


def test_html_to_text(spark, data):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in QUERIES["html_to_text"](spark, data).collect()}
    assert got == {k: parsed(v) for k, v in pages.items()}
    df = spark.createDataFrame(list(enumerate(ODD_PAGES)), "n int, html string").select("n", sections.html_to_text("html").alias("text"))
    assert [r["text"] for r in df.orderBy("n").collect()] == [parsed(p) for p in ODD_PAGES]


def on_own_rows(spark, folder, name, table, rows, schema):
    """Rows of a query, and those of its SQL, over a table of these rows."""
    duck = duckdb.connect()
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = QUERIES[name](spark, str(folder))
    wanted = duck.sql(SQL[name])
    assert got.columns == wanted.columns
    return sorted((tuple(r) for r in got.collect()), key=repr), sorted(wanted.fetchall(), key=repr)


def test_html_to_text_of_entities_cut_off(spark, tmp_path):
    pages = ["<title>a &amp;&amp;&amp</title><p>b &amp; c</p>", "<p>x &lt</p>", "<p>&#39;y&#39</p>", "<p>&amp;lt &copy;</p>", "", None]
    got, wanted = on_own_rows(spark, tmp_path, "html_to_text", "pages", list(enumerate(pages)), "page_id long, html string")
    assert got == wanted and (0, "a &&&amp\nb & c") in got


ODD_TITLES = [
    "", "  ", " lead", "trail ", "\ttabs\t", "cr\r", "in\rner", '"quoted"', 'a "b" c', '"', '""', "\\", 'a\\"b', ",", "a,b", "#c", "\x00null", "\x1f", "\u00a0nbsp\u00a0", "\ufeffbom", "null", ' "x"', None,
]


def test_read_curated_csv_of_odd_titles(spark, tmp_path):
    """White space, quotes, nothing and empty text come back as they were, in the note as well (no id here is one of those without key or whose note is NA)."""
    rows = [(n * 170 + own + 1, None if t is None else f"{t}\nrest", "en", "web" if own else t, 1) for n, t in enumerate(ODD_TITLES) for own in (0, 1, 2)]
    got, wanted = on_own_rows(spark, tmp_path, "read_curated_csv", "documents", rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got == wanted and {r[1] for r in got} == set(ODD_TITLES)


def test_embeddings_are_near_in_a_language(spark, data):
    """The nearest other document by learned vectors is of the same language; whole documents count; the same whatever the partitions."""
    rows = queries_models.embedded(spark, data).collect()
    got = {r["seq"]: np.array(r["embedding"]) for r in rows}
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert set(got) == set(docs) and all(len(v) == vectors.DIMENSIONS for v in got.values())
    ids = sorted(got)
    m = np.stack([got[i] for i in ids])
    similar = m @ m.T
    np.fill_diagonal(similar, -2)
    # copies of a text are of its language anyway
    same = [docs[ids[i]]["lang"] == docs[ids[j]]["lang"] for i, j in enumerate(similar.argmax(1)) if docs[ids[i]]["text"] != docs[ids[j]]["text"]]
    assert len(same) > 100 and np.mean(same) >= 0.9


def test_learned_vectors_are_those_of_an_eigen_decomposition(spark):
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(words[:3] if i % 2 else words[2:], 12)) for i in range(40)] + ["", None, "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    counts = vectors.hashed_words(df, "k", "t", 64).orderBy("k").collect()
    c = np.array([r["counts"].toArray() for r in counts])[:40]
    x = c * np.log(41 / ((c > 0).sum(0) + 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, axes = np.linalg.eigh(x.T @ x / 40)
    wanted = x @ axes[:, ::-1][:, :2]
    wanted /= np.linalg.norm(wanted, axis=1, keepdims=True)
    got = vectors.learned_embeddings(df.repartition(3), "k", "t", 2, 64).orderBy("k").collect()
    assert [len(r["embedding"]) for r in got] == [2] * 40 + [0] * 3
    m = np.array([r["embedding"] for r in got[:40]])
    assert np.allclose(m @ m.T, wanted @ wanted.T, atol=1e-4)
    assert [r["embedding"] for r in vectors.learned_embeddings(df.where("k > 39"), "k", "t").collect()] == [[], [], []]


def test_texts_are_split_into_words_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.createDataFrame([(i, f"a{i % 3} b{i % 5} c") for i in range(30)], "k int, t string")
    assert len(vectors.embed_text(df.mapInArrow(counted, df.schema), "k", "t").collect()) == 30
    assert read.value == 30


def test_embed_text(spark, data):
    assert all(r["n"] == 64 and r["length"] == 1.0 for r in QUERIES["embed_text"](spark, data).collect())


def test_project_2d(spark, data):
    import numpy as np

    got = {r["vec_id"]: (r["x"], r["y"]) for r in QUERIES["project_2d"](spark, data).collect()}
    table = spark.read.parquet(f"{data}/embeddings.parquet").orderBy("vec_id").collect()
    m = np.array([r["embedding"] for r in table], float)
    _, vectors = np.linalg.eigh(np.cov(m.T))
    top = vectors[:, ::-1][:, :2]
    top = top * np.sign(top[np.abs(top).argmax(0), [0, 1]])
    wanted = m @ top
    assert np.allclose([got[r["vec_id"]] for r in table], wanted, atol=2e-3)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
