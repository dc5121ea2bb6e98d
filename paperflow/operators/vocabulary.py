"""Tagging text with vocabularies of regular expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import strip
from ..functions.names import fresh
from ..sources.buckets import Folder, shared_folder, written
from .dedupe import keep_last
from .patterns import Index, of_text, of_vocabulary

Vocabulary = Mapping[str, Sequence[str]]
#: Letters by which keywords of a large map are joined to terms.
PIECE = 3
#: Vocabularies of which extract_concepts makes columns.
GROUPS = ("inclusion", "exclusion", "tissue", "organism", "disease", "paper_type", "pipeline", "method")


def load_vocabulary(raw: Mapping[str, Sequence[str] | None]) -> dict[str, tuple[str, ...]]:
    """A checked vocabulary, label by label in order. An invalid pattern is an error that names it; a label without patterns matches nothing."""
    out = {}
    for label, patterns in raw.items():
        for p in patterns or ():
            try:
                re.compile(p)
            except re.error as e:
                raise ValueError(f"label {label!r}: invalid pattern {p!r}: {e}") from e
        out[label] = tuple(patterns or ())
    return out


#: Escapes within double quotes that are other signs than themselves.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "b": "\b", "f": "\f", "v": "\v", "e": "\x1b"}
_SCALAR = re.compile(r"""\s*(?:'(?P<single>(?:''|[^'])*)'|"(?P<double>(?:\\.|[^"\\])*)"|(?P<plain>[^\s'"#\[\]{},&*!|>%@`-][^\n]*?|-\S[^\n]*?))""")


def read_vocabulary(lines: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """A vocabulary from lines of YAML of one shape: `label:` lines, each with a list of `- pattern` lines or a `[pattern, ..]` of one line.

    Patterns and labels may stand in quotes: single ones, where a doubled quote
    is one, or double ones with YAML's escapes by a backslash. Blank lines and
    comments, on lines of their own or behind others, are skipped; any other
    line is an error. Of a label that stands twice the later one counts.
    """
    raw: dict[str, list[str]] = {}
    label = None
    for n, line in enumerate(lines, 1):
        text = line.strip()
        if not text or text.startswith("#") or text == "---":
            continue
        try:
            if text.startswith("- ") and label is not None:
                raw[label].append(alone(text[2:], ""))
                continue
            label, rest = scalar(text, ":")
            raw[label] = listed(rest[1:])
        except ValueError as e:
            raise ValueError(f"line {n}: {e}: {text!r}") from None
    return load_vocabulary(raw)


def scalar(text: str, ends: str) -> tuple[str, str]:
    """A value at the start of a text, and what follows it: nothing, a comment, or one of the signs in `ends`."""
    closing = rf"(?=\s*$|\s+#|\s*[{re.escape(ends)}](?:\s|$))" if ends == ":" else rf"(?=\s*$|\s+#|\s*[{re.escape(ends)}])" if ends else r"(?=\s*$|\s+#)"
    m = re.compile(_SCALAR.pattern + closing).match(text)
    if not m:
        raise ValueError("neither a label nor a pattern")
    rest = text[m.end() :].strip()
    if ends and not rest.startswith(tuple(ends)):
        raise ValueError("neither a label nor a pattern")
    if m["single"] is not None:
        return m["single"].replace("''", "'"), rest
    if m["double"] is not None:
        return re.sub(r"\\(.)", escaped, m["double"]), rest
    return m["plain"], rest


def escaped(m: re.Match) -> str:
    if m[1].isalnum() and m[1] not in ESCAPES:
        raise ValueError(f"an unknown escape {m[0]}")
    return ESCAPES.get(m[1], m[1])


def alone(text: str, ends: str) -> str:
    value, rest = scalar(text, ends)
    if rest and not rest.startswith("#"):
        raise ValueError("more than one value")
    return value


def listed(text: str) -> list[str]:
    """The values of `[a, b]`; none of nothing and of a comment."""
    text = text.strip()
    if not text or text.startswith("#"):
        return []
    if not text.startswith("["):
        raise ValueError("a label with a value that is no list")
    out, text = [], text[1:].strip()
    while not text.startswith("]"):
        value, text = scalar(text, ",]")
        out.append(value)
        text = text[1:].strip() if text.startswith(",") else text
    if text[1:].strip() and not re.match(r"\s+#|$", text[1:]):
        raise ValueError("more behind a list")
    return out


def corpus_text(title: Column, abstract: Column, keywords: Column | None = None) -> Column:
    """What is tagged: title, abstract and keywords in lower case."""
    parts = [F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")), F.coalesce(F.array_join(keywords, " "), F.lit("")) if keywords is not None else F.lit("")]
    return F.lower(strip(F.concat_ws(" ", *parts)))


def tag_any(text: Column, vocabulary: Vocabulary) -> Column:
    """Whether a pattern matches; false for a null text."""
    return F.coalesce(of_vocabulary(vocabulary).any(text), F.lit(False))


def tag_first(text: Column, vocabulary: Vocabulary) -> Column:
    """The first label of the vocabulary that matches, else null."""
    return F.get(of_vocabulary(vocabulary).matching(text), F.lit(0))["name"]


def tag_all(text: Column, vocabulary: Vocabulary) -> Column:
    """All labels that match, sorted."""
    return names_of(of_vocabulary(vocabulary).matching(text))


def names_of(hits: Column) -> Column:
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(hits, lambda p: p["name"]))), F.array().cast("array<string>"))


def detail_of(hits: Column) -> Column:
    """Label to distinct matched fragments in lower case, sorted; every pattern reports its own. hits: (name, found)."""
    own = lambda name: F.flatten(F.transform(F.filter(hits, lambda p: p["name"] == name), lambda p: p.found))
    fragments = F.transform(names_of(hits), lambda name: F.array_sort(F.array_distinct(F.transform(own(name), F.lower))))
    return F.map_from_arrays(names_of(hits), fragments)


def tag_detail(text: Column, vocabulary: Vocabulary) -> Column:
    """Label to matched fragments, for labels that match."""
    return of_text(of_vocabulary(vocabulary).fragments(text), detail_of)


def merged_details(maps: list[Column]) -> Column:
    """Maps joined; of equal labels the later vocabulary's stands."""
    return reduce(lambda a, b: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b), maps)


def extract_concepts(df: DataFrame, text: str, vocabularies: Mapping[str, Vocabulary]) -> DataFrame:
    """All kw_ columns of one text column, in lower case.

    vocabularies: inclusion, exclusion, tissue, organism, disease, paper_type,
    pipeline and method; a missing one is empty. A text is gone over once with
    one index for all of them.
    """
    every = Index((f"{group}:{label}", p) for group in GROUPS for label, ps in vocabularies.get(group, {}).items() for p in ps)
    hits = fresh("hits", df.columns)
    found = df.withColumn(hits, F.coalesce(every.fragments(F.col(text)), F.array().cast("array<struct<name:string,found:array<string>>>")))

    def of(group: str) -> Column:
        own = F.filter(F.col(hits), lambda p: F.startswith(p["name"], F.lit(f"{group}:")))
        return F.transform(own, lambda p: F.struct(F.substring(p["name"], len(group) + 2, 1 << 30).alias("name"), p.found.alias("found")))

    return found.withColumns({
        "kw_domain_inclusion": F.size(of("inclusion")) > 0,
        "kw_domain_exclusion": F.size(of("exclusion")) > 0,
        "kw_tissue": names_of(of("tissue")),
        "kw_organism": names_of(of("organism")),
        "kw_disease": names_of(of("disease")),
        "kw_paper_type": names_of(of("paper_type")),
        "kw_pipeline_category": names_of(of("pipeline")),
        "kw_detected_methods": names_of(of("method")),
        "kw_detail_pipeline_categories": of_text(of("pipeline"), detail_of),
        "kw_detail_biological_concepts": merged_details([of_text(of(n), detail_of) for n in ("tissue", "organism", "disease")]),
    }).drop(hits)


def curated_then_extract(df: DataFrame, curated: DataFrame, columns: Sequence[str], vocabularies: Mapping[str, Vocabulary], order: str, key: str = "doi") -> DataFrame:
    """Curated columns over the record's before its title and abstract are tagged; of several curated rows of a key the last by `order` counts."""
    last = keep_last(curated.where(F.coalesce(F.col(key), F.lit("")) != ""), key, order)
    known = last.select(key, *[F.col(c).alias(f"_curated_{c}") for c in columns])
    joined = df.join(known, key, "left").withColumns({c: F.coalesce(f"_curated_{c}", c) for c in columns}).drop(*[f"_curated_{c}" for c in columns])
    return extract_concepts(joined.withColumn("_text", corpus_text(F.col("title"), F.col("abstract"))), "_text", vocabularies).drop("_text")


def harmonize_term(term: Column, labels: Mapping[str, Sequence[str]]) -> Column:
    """The first label one of whose keywords occurs in the term, letters and digits only; else the term."""
    bare = lambda s: re.sub("[^a-z0-9]", "", s.lower())
    plain = F.regexp_replace(F.lower(term), "[^a-z0-9]", "")
    rules = [F.when(reduce(lambda a, b: a | b, [plain.contains(k) for k in map(bare, ks) if k]), label) for label, ks in labels.items() if any(map(bare, ks))]
    return F.coalesce(*rules, term)


def harmonize_terms(terms: Column, *maps: Mapping[str, Sequence[str]]) -> Column:
    """Distinct sorted labels of a list of terms; the maps are applied one after another."""

    def through(labels: Mapping[str, Sequence[str]]):
        return lambda t: harmonize_term(t, labels)

    for labels in maps:
        terms = F.array_distinct(F.transform(terms, through(labels)))
    return F.array_sort(terms)


def harmonize_term_table(df: DataFrame, terms: str, *maps: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same for large maps: every distinct term is labelled once, then joined back. `df` needs a column `id`."""
    long = df.select("id", F.explode(terms).alias("term"))
    labelled = long.select("term").distinct()
    label = F.col("term")
    for m in maps:
        label = harmonize_term(label, m)
    found = long.join(labelled.withColumn("label", label), "term").groupBy("id").agg(F.array_sort(F.collect_set("label")).alias(terms))
    return df.drop(terms).join(found, "id", "left").withColumn(terms, F.coalesce(terms, F.array().cast("array<string>")))


def pieces(text: Column, n: int) -> Column:
    """All distinct runs of n letters of a text."""
    places = F.sequence(F.lit(1), F.char_length(text) - n + 1)
    return F.when(F.char_length(text) >= n, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def harmonized(terms: DataFrame, keywords: DataFrame, folder: str) -> DataFrame:
    """(term, label) of the terms of (term) in which a keyword of (label, keyword, place) occurs, letters and digits only: the label of least place.

    Keywords meet only those terms that share their rarest run of three letters
    (shorter keywords: themselves), counted over the terms, and are then searched for. So
    neither the plan nor a task grows with the keywords, and no keyword meets
    all terms. Keywords and their pieces are written first: while they are small,
    the pieces of terms, many times the terms, meet them without a shuffle.
    """
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    words = keywords.select("label", "place", bare(F.col("keyword")).alias("keyword")).where("keyword <> ''")
    distinct = written(terms.where("term is not null").select("term").distinct().select("term", bare(F.col("term")).alias("plain")), folder)
    plain, keyword = F.col("plain"), F.col("keyword")
    of_terms = distinct.select("term", "plain", F.explode(F.concat(*[pieces(plain, n) for n in range(1, PIECE + 1)])).alias("piece"))
    own = F.when(F.char_length(keyword) < PIECE, F.array(keyword)).otherwise(pieces(keyword, PIECE))
    of_words = written(words.select("label", "place", "keyword", F.explode(own).alias("piece")), folder)
    asked_for = written(of_words.select("piece").distinct(), folder)
    counts = of_terms.join(asked_for, "piece", "left_semi").groupBy("piece").agg(F.count("*").alias("n"))
    # a piece that no term has rules the keyword out
    rarest = of_words.join(counts, "piece", "left").groupBy("label", "place", "keyword").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("best"))
    asked = written(rarest.where("best.n > 0").select("label", "place", "keyword", F.col("best.piece").alias("piece")), folder)
    found = asked.join(of_terms, "piece").where(F.contains(plain, keyword)).select("term", "place", "label")
    return found.groupBy("term").agg(F.min(F.struct("place", "label")).alias("best")).select("term", "best.label")


def harmonize_with_tables(df: DataFrame, terms: str, *maps: DataFrame) -> DataFrame:
    """As `harmonize_term_table`, for maps that are tables (label, keyword, place), applied one after another; `df` needs a column `id`.

    Every distinct term is led through all maps before the terms of the rows
    meet those that change, once; while these are few, without a shuffle. What
    comes of that is written, so that the data shuffled for it go before the
    rows are put together; tables made on the way go as well.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "terms")
    long = df.select("id", F.explode(F.array_distinct(terms)).alias("term"))
    known = written(long.where("term is not null").select("term").distinct().withColumn("label", F.col("term")), folder)
    for m in maps:
        found = written(harmonized(known.select(F.col("label").alias("term")), m, folder), folder).select(F.col("term").alias("label"), F.col("label").alias("_next"))
        known = written(known.join(found, "label", "left").select("term", F.coalesce("_next", "label").alias("label")), folder)
    changed = written(known.where("label <> term"), folder)
    named = written(long.join(changed, "term", "left").select("id", F.coalesce("label", "term").alias("term")), shared_folder(spark, "named"))
    Folder(spark, folder).remove("")
    found = named.groupBy("id").agg(F.array_sort(F.collect_set("term")).alias(terms))
    return df.drop(terms).join(found, "id", "left").withColumn(terms, F.coalesce(terms, F.array().cast("array<string>")))


def harmonize_context(context: Column, vocabulary: Vocabulary) -> Column:
    """The first label that matches a context by pattern or whole word; null for null, blank, n/a and none."""
    text = strip(F.lower(context))
    return F.when(~text.isin("", "n/a", "none"), tag_first(text, vocabulary))


def context_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(context, with_label, without_label): of each label column how many rows have one."""
    pairs = F.array(*[F.struct(F.lit(c).alias("context"), F.col(c).isNotNull().alias("has")) for c in labels])
    each = df.select(F.explode(pairs).alias("p"))
    return each.groupBy("p.context").agg(F.count_if("p.has").alias("with_label"), F.count_if(~F.col("p.has")).alias("without_label"))


def unassigned_contexts(df: DataFrame, context: str, label: str) -> DataFrame:
    """Distinct contexts that got no label."""
    return df.where(F.col(label).isNull() & (F.trim(F.coalesce(F.col(context), F.lit(""))) != "")).select(context).distinct()


def clean_type_labels(labels: Column, mapping: Mapping[str, Sequence[str]]) -> Column:
    """Mapped labels give their replacements, others lose the analysis prefix and semicolons; distinct and sorted. `labels` is text: a JSON list or one label."""
    known = F.create_map(*[c for k, v in mapping.items() for c in (F.lit(k), F.array(*map(F.lit, v)))]) if mapping else None
    plain = lambda x: F.array(strip(F.replace(F.replace(x, F.lit("computational analysis - "), F.lit("")), F.lit(";"), F.lit(","))))
    each = (lambda x: F.coalesce(F.try_element_at(known, x), plain(x))) if known is not None else plain
    items = F.coalesce(F.from_json(labels, "array<string>"), F.array(labels))
    items = F.when(labels.isNull(), F.array().cast("array<string>")).otherwise(items)
    return F.array_sort(F.array_distinct(F.flatten(F.transform(items, each))))
