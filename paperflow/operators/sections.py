"""Sections of full texts: header lines are found once, sections are the lines between them."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import strip

MIN_WORDS = 31
WINDOW = 7000
#: Longer lines are no headers.
HEADER_CHARS = 80
#: Titles of numbered sections in their order, of sections without a number, and of what ends all of them.
NUMBERED = {
    "introduction": ("introduction",),
    "methods": ("methods", "materials and methods"),
    "results_discussion": ("results", "discussion", "results and discussion"),
    "conclusion": ("conclusion", "conclusions"),
}
UNNUMBERED = {
    "data_availability": ("data availability", "data availability statement"),
    "code_availability": ("code availability", "code availability statement"),
}
LAST = ("acknowledgements", "references", "supplementary", "appendix")
#: Header lines in order of preference, and those that end a section.
LINE_HEADERS = {
    "introduction": ("introduction", "background"),
    "results_discussion": ("results and discussion", "results", "discussion", "discussion and future work"),
    "conclusion": ("conclusion", "summary", "final remarks"),
    "methods": ("methods", "materials and methods", "experimental procedures", "study design"),
    "data_availability": ("data availability", "availability of data", "data and materials availability", "data/code availability"),
    "code_availability": ("code availability", "availability of code", "software availability", "data/code availability"),
}
STOPS = ("introduction", "background", "results", "discussion", "conclusion", "references", "acknowledgements", "supplementary", "funding", "appendix")
#: What is said to be available, and patterns of the words that say so or name where; at most NEAR signs lie between.
SUBJECTS = {"code": ("code", "software", "repository"), "data": ("data", "dataset", "database", "repository")}
PLACES = {
    "code": ("available", "access", "download", r"https?://(?:www\.)?github\.com", "zenodo", "bioconductor", "figshare", "bitbucket", "gitlab", "source code"),
    "data": ("available", "access", "download", "zenodo", "10x genomics", "figshare", "dryad", "geo", "ega", "arrayexpress", "genbank", "sra", "pdb"),
}
#: Accession numbers are this word and digits.
ACCESSION = "gse"
NEAR = 5


def word_count(c: Column) -> Column:
    text = strip(c)
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.size(F.split(text, r"\s+")))


def any_of(words: Sequence[str]) -> str:
    return "|".join(map(re.escape, words))


def number(n: int) -> str:
    """A section's number as a header: 2, or II and a dot."""
    return rf"{n}|{('i', 'ii', 'iii', 'iv', 'v')[n - 1]}\s*\."


def header_patterns() -> dict[str, tuple[str, str]]:
    """For each section what its header line is, and what a line that ends it begins with: the next number, a later title, or the end matter."""
    out, titles = {}, list(NUMBERED.values())
    for n, (name, own) in enumerate(NUMBERED.items(), 1):
        later = [t for ts in titles[n:] for t in ts]
        out[name] = rf"(?i)^(?:{number(n)}|{any_of(own)})\s*$", rf"(?i)^(?:{number(n + 1)}|{any_of([*later, *LAST])})"
    for name, own in UNNUMBERED.items():
        out[name] = rf"(?i)^(?:{any_of(own)})\s*$", rf"(?i)^(?:{any_of(LAST)})"
    return out


def matching(pattern: str) -> Callable[[Column], Column]:
    return lambda line: line.rlike(pattern)


def first_true(flags: Column) -> Column:
    """Place of the first true from 1 on, 0 without any."""
    return F.coalesce(F.array_position(flags, True), F.lit(0)).cast("int")


def parse_sections(df: DataFrame, text: str) -> DataFrame:
    """`df` with a column for each section: the lines after its header line, up to one that ends it; null if absent or of fewer than MIN_WORDS words.

    Runs of spaces and tabs become one space; lines stay, unlike in its model,
    which makes a section one line: that can be done later, but not undone. The
    line right after a header never ends its section.
    """
    lines = F.split(F.regexp_replace(strip(F.col(text)), r"[ \t]{2,}", " "), "\n")
    # what no header or end begins with is looked at once
    begins = rf"(?i)^(?:{'|'.join(number(n) for n in range(1, 6))}|{any_of([t for ts in (*NUMBERED.values(), *UNNUMBERED.values(), LAST) for t in ts])})"
    heads = F.transform("_lines", lambda x: F.when(x.rlike(begins), F.substring(x, 1, HEADER_CHARS)).otherwise(""))
    found = df.withColumn("_lines", lines).withColumn("_heads", heads)
    places, sections = {}, {}
    for name, (own, stop) in header_patterns().items():
        at = first_true(F.transform("_heads", matching(own)))
        places[f"_at_{name}"] = F.when(F.coalesce(at, F.lit(0)) > 0, at)
        begin, total = F.col(f"_at_{name}"), F.size("_lines")
        end = first_true(F.transform(F.slice("_heads", begin + 2, total), matching(stop)))
        length = F.when(end > 0, end).otherwise(total - begin)
        sections[name] = F.when(begin.isNotNull(), strip(F.array_join(F.slice("_lines", begin + 1, length), "\n")))
    out = found.withColumns(places).withColumns({f"_s_{n}": c for n, c in sections.items()})
    return out.select(*df.columns, *[F.when(word_count(F.col(f"_s_{n}")) >= MIN_WORDS, F.col(f"_s_{n}")).alias(n) for n in sections])


def label(line: Column) -> Column:
    """Which header a line is: lower case, without number and final dot; empty for other lines."""
    return F.lower(F.regexp_extract(line, header_line([h for hs in LINE_HEADERS.values() for h in hs]), 1))


def header_line(headers: Sequence[str]) -> str:
    return rf"(?i)^\s*(?:[0-9]+(?:\.\s*|\s+))?({any_of(headers)})\.?\s*$"


def extract_sections_windowed(df: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """`df` with a column for each section: the text after its header line, cut to a window and at the first line that ends sections.

    Of a section's headers the first one counts, in order of preference, whose
    text has MIN_WORDS words. Every step is a projection of its own, so that
    what several columns need is made once.
    """
    headers = list(dict.fromkeys(h for hs in LINE_HEADERS.values() for h in hs))
    near, texts = {}, {}
    for n, header in enumerate(headers):
        at = F.array_position("_labels", header).cast("int")
        rest = F.regexp_replace(F.array_join(F.slice("_lines", at + 1, F.size("_lines")), "\n"), r"^\s*\n", "")
        near[f"_near{n}"] = F.when(at > 0, F.split(F.substring(rest, 1, window), "\n"))
        stop = first_true(F.transform(f"_near{n}", matching(header_line(STOPS))))
        own = F.slice(f"_near{n}", 1, F.when(stop > 0, stop - 1).otherwise(F.size(f"_near{n}")))
        texts[f"_text{n}"] = strip(F.regexp_replace(F.array_join(own, "\n"), r"\n+", "\n"))
    found = df.withColumn("_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n")).withColumn("_labels", F.transform("_lines", label))
    found = found.withColumns(near).withColumns(texts)
    long_enough = {h: F.when(word_count(F.col(f"_text{n}")) >= MIN_WORDS, F.col(f"_text{n}")) for n, h in enumerate(headers)}
    return found.select(*df.columns, *[F.coalesce(*[long_enough[h] for h in hs]).alias(name) for name, hs in LINE_HEADERS.items()])


def mention_pattern(kind: str) -> str:
    accession = rf"|{ACCESSION}[0-9]+" if kind == "data" else ""
    return rf"(?i)(?:{any_of(SUBJECTS[kind])})\W{{0,{NEAR}}}\b(?:{'|'.join(PLACES[kind])}{accession})\b"


def availability_mentions(text: Column, kind: str) -> Column:
    """Distinct mentions of available code or data, sorted, as one sentence; null without any."""
    found = F.array_sort(F.array_distinct(F.filter(F.transform(F.regexp_extract_all(text, F.lit(mention_pattern(kind)), F.lit(0)), strip), lambda x: x != "")))
    return F.when(F.size(found) > 0, F.concat(F.lit(f"Mentioned {kind} availability sources: "), F.array_join(found, ", ")))


def extract_full_text(df: DataFrame, text: str, source: str, window: int = WINDOW) -> DataFrame:
    """`df` with extracted_ columns for all sections, what is mentioned as available where there is no such section, flags, and how it went."""
    found = extract_sections_windowed(df, text, window)
    for kind in SUBJECTS:
        name = f"{kind}_availability"
        found = found.withColumn(name, F.coalesce(F.col(name), availability_mentions(F.col(text), kind)))
    named = found.select(*df.columns, *[F.col(n).alias(f"extracted_{n}_section") for n in LINE_HEADERS])
    return section_flags(named, text, source, list(LINE_HEADERS))


#: What is no text: comments, scripts and styles with what is in them (or up to the end, if they do not end), tags and declarations. A tag may hold a greater sign in quotes.
MARKUP = r"""(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script[^>]*>|\z)|<style\b[^>]*>.*?(?:</style[^>]*>|\z)|</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*+>|</?[a-z][^>]*>|<[!?/][^>]*>"""
#: White space at the ends of a text, Unicode's included.
ENDS = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"
_BETWEEN = "\x01"


def sign_of(number: Column) -> Column:
    """The character of a code point as pages have them: 128 to 159 as in Windows' code page, nothing for controls and what is no character, a replacement for what cannot be one."""
    windows = {n: bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}
    known = F.create_map(*[F.lit(x) for n, c in windows.items() if c for x in (n, c)])
    none = number.between(1, 8) | (number == 11) | number.between(14, 31) | number.between(127, 159) | number.between(0xFDD0, 0xFDEF) | ((number % 65536) >= 65534)
    sign = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    bad = number.isNull() | (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    small = number.cast("int")
    return F.when(bad, "�").when(F.map_contains_key(known, small), F.try_element_at(known, small)).when(none, "").otherwise(sign)


def decoded(text: Column, bare: bool = True) -> Column:
    """Entities in a text, by name or number, as the characters that they stand for; each once, so that what is decoded is not looked at again. `bare`: numbers, and names that may stand without a semicolon, are found so as well; else an entity ends with its semicolon."""
    table = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    short = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))

    def one(piece: Column) -> Column:
        """What follows an ampersand."""
        number = F.regexp_extract(piece, r"^(#(?:[0-9]+|[xX][0-9a-fA-F]+);" + ("?)" if bare else ")"), 1)
        digits = F.regexp_extract(number, r"([0-9a-fA-F]+);?$", 1)
        value = F.when(number.rlike("^#[xX]"), F.conv(digits, 16, 10).try_cast("bigint")).otherwise(digits.try_cast("bigint"))
        named = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*;)", 1)
        legacy = F.regexp_extract(piece, f"^({short})", 1) if bare else F.lit("")
        rest = lambda name: F.substring(piece, F.char_length(name) + 1, F.char_length(piece))
        of = lambda name: F.try_element_at(table, name)
        return (
            F.when(number != "", F.concat(sign_of(value), rest(number)))
            .when((named != "") & of(named).isNotNull(), F.concat(of(named), rest(named)))
            .when(legacy != "", F.concat(of(legacy), rest(legacy)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    parts = F.split(text, "&")
    whole = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, 1 << 30), one), ""))
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def html_to_text(html: Column | str, bare: bool = True) -> Column:
    """Visible text, a line for each piece between marks: no scripts, styles or comments, entities decoded (`bare`: those without a semicolon too, as a parser has them). Null becomes empty."""
    page = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    pieces = F.split(F.regexp_replace(page, MARKUP, _BETWEEN), _BETWEEN)
    trimmed = F.transform(pieces, lambda x: F.regexp_replace(decoded(x, bare), ENDS, ""))
    return F.array_join(F.filter(trimmed, lambda x: x != ""), "\n")


def section_flags(df: DataFrame, text: str, source: str, sections: Sequence[str]) -> DataFrame:
    """has_ columns, and how the extraction of a row went. `source` is html or pdf."""
    empty = F.trim(F.coalesce(F.col(text), F.lit(""))) == ""
    state = F.when(empty, F.concat(F.lit("failed_empty_"), F.col(source), F.lit("_text"))).when(F.col(source) == "html", "success_from_html").otherwise("success")
    flags = {f"has_{s}_section": F.coalesce(F.col(f"extracted_{s}_section") != "", F.lit(False)) for s in sections}
    return df.withColumns({"full_text_extraction_status": state, "full_text_extraction_error": F.when(empty, "no text extracted"), **flags})
