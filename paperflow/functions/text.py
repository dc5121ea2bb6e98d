"""Text columns: truncation, lists, annotations, prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import strip

#: Texts that stand for nothing.
EMPTY_TEXTS = ("[]", "{}", "N/A", "None", "", "nan")
EMPTY_VALUES = ("N/A", "", "nan")
#: Letters of an abstract, a long section and a short section that go into a prompt.
ABSTRACT_CHARS, LONG_CHARS, SHORT_CHARS = 2000, 4000, 1500
#: Sections in prompt order, with heading and limit.
PROMPT_SECTIONS = (
    ("introduction", "Introduction Section", LONG_CHARS),
    ("methods", "Methods Section", LONG_CHARS),
    ("results_discussion", "Results and Discussion Section", LONG_CHARS),
    ("conclusion", "Conclusion Section", SHORT_CHARS),
    ("data_availability", "Data Availability Section", SHORT_CHARS),
    ("code_availability", "Code Availability Section", SHORT_CHARS),
)
NO_SECTIONS = "There is no full text; judge by the title and the abstract."


def truncate_text(c: Column, most: int) -> Column:
    """The first letters of the stripped text; null for null and blank."""
    return F.substring(F.nullif(strip(c), F.lit("")), 1, most)


def shown(value: Column, kind: T.DataType) -> Column:
    """A scalar as text, null if it stands for nothing."""
    text = strip(value.cast("string"))
    return F.when(~text.isin(*EMPTY_VALUES), text)


def annotation_to_text(c: Column, kind: T.DataType) -> Column:
    """Readable text of an annotation of any type: empty for null and for texts that stand for nothing."""
    if isinstance(kind, T.StructType):
        out = F.concat_ws(" ", *[shown(c[f.name], f.dataType) for f in kind])
    elif isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, T.StructType):
            item = lambda x: F.concat_ws(" ", *[shown(x[f.name], f.dataType) for f in inner])
        else:
            item = lambda x: x.cast("string")
        out = strip(F.array_join(F.filter(F.transform(c, item), lambda x: x != ""), " "))
    elif isinstance(kind, T.BooleanType):
        out = F.when(c, "Yes").otherwise(F.when(~c, "No"))
    else:
        text = strip(c.cast("string"))
        out = F.when(~text.isin(*EMPTY_TEXTS), text)
    return F.coalesce(out, F.lit(""))


def parse_list_text(c: Column) -> Column:
    """An array from a list literal, else from comma-separated text; null becomes an empty array."""
    text = strip(c)
    literal = F.from_json(F.translate(text, "'", '"'), "array<string>")
    parts = F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")
    return F.coalesce(F.when(text.startswith("[") & text.endswith("]"), F.coalesce(literal, F.array(text))).otherwise(parts), F.array().cast("array<string>"))


def split_multi(c: Column, separator: str = ";") -> Column:
    """Stripped non-empty parts; null becomes an empty array."""
    return F.coalesce(F.filter(F.transform(F.split(c, separator), strip), lambda x: x != ""), F.array().cast("array<string>"))


def build_prompt(instructions: str, answer_schema: str, title: Column, abstract: Column, sections: dict[str, Column]) -> Column:
    """Instructions, the paper's text with each section cut to its limit, and the schema of the answer."""
    blocks = [F.concat(F.lit(f"## {head}\n"), truncate_text(sections[name], most)) for name, head, most in PROMPT_SECTIONS if name in sections]
    joined = F.concat_ws("\n\n", *blocks) if blocks else F.lit("")
    head = F.concat(F.lit("Title: "), F.coalesce(title, F.lit("N/A")), F.lit("\nAbstract: "), F.coalesce(truncate_text(abstract, ABSTRACT_CHARS), F.lit("N/A")), F.lit("\n\n"))
    body = F.when(joined != "", F.concat(F.lit("# Full text\n"), joined)).otherwise(F.lit(f"# Full text\n{NO_SECTIONS}"))
    return F.concat(F.lit(instructions + "\n\n# Paper\n"), head, body, F.lit("\n\n# Answer\n" + answer_schema))


def embedding_text(parts: list[Column]) -> Column:
    """All parts joined as sentences, with single spaces and single periods."""
    text = F.concat_ws(". ", *[F.coalesce(p, F.lit("")) for p in parts])
    text = strip(F.regexp_replace(text, r"\s+", " "))
    text = strip(F.regexp_replace(text, r"\s*\.\s*\.", ". "))
    return strip(F.regexp_replace(text, r"\s*\.\s*", ". "))
