"""Many regular expressions on one text: an index from words to the patterns that can match.

Of each pattern it is worked out what every match must hold: one of several
plain texts, each perhaps at the edge of a word. A text is split into words
once; the first and last letters of its distinct words are looked up among those
that patterns ask for, and only patterns that are found so are run. Patterns
whose matches lie within a word are run on the words that were found, not on the
text. Patterns whose text need not begin or end a word are found by a plain
search for it, and patterns that ask for nothing are always run. The patterns
are data, not branches of a plan.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: At most so many first or last letters of a word are looked up.
LETTERS = 4
#: Ways to spell the end of a word that are looked up one by one.
SPELLINGS = 64
#: Of runs: words and what is not ASCII between them, so that the edges of words within a run are those in its text.
RUN, BEYOND = r"[\w[^\x00-\x7F]]", r"[^\x00-\x7F]"
#: Sets of word characters alone.
_WORD_SET = re.compile(r"\[(?:[a-z]-[a-z]|[A-Z]-[A-Z]|[0-9]-[0-9]|[A-Za-z0-9_](?!-)|\\[dw])+\]")


@dataclass(frozen=True)
class Need:
    """A text in lower case that a match holds, and whether a word starts and ends with it."""

    text: str
    starts: bool
    ends: bool

    def key(self) -> str | None:
        """The first letters of a word that every text with this need has, if that can be said."""
        words = [(m[0], m.start(), m.end()) for m in re.finditer("[a-z0-9_]+", self.text)]
        keys = []
        for word, start, end in words:
            whole = end < len(self.text) or self.ends
            if (start > 0 or self.starts) and (len(word) >= LETTERS or whole):
                keys.append(word[:LETTERS])
        return max(keys, key=len, default=None)

    def lookup(self) -> str | None:
        """First letters (^) or last letters ($) of a word that every text with this need has, if either can be said."""
        found = []
        for m in re.finditer("[a-z0-9_]+", self.text):
            if m.start() > 0 or self.starts:
                found.append("^" + m[0][:LETTERS])
            if m.end() < len(self.text) or self.ends:
                found.append("$" + m[0][-LETTERS:])
        return max(found, key=len, default=None)


class _Unknown(Exception):
    """The pattern uses what is not understood here."""


class _Reader:
    """Alternatives of sequences of items: a letter, a set of letters, an edge of a word, a group of alternatives, or None for anything else."""

    def __init__(self, pattern: str):
        self.pattern, self.at = pattern, 0
        #: Whether all that a match takes up are word characters.
        self.within_word = True

    def peek(self, n: int = 1) -> str:
        return self.pattern[self.at : self.at + n]

    def alternatives(self) -> list[list]:
        out: list[list] = [[]]
        while self.at < len(self.pattern) and self.peek() != ")":
            if self.peek() == "|":
                self.at += 1
                out.append([])
            else:
                self.item(out[-1])
        return out

    def item(self, sequence: list) -> None:
        c = self.peek()
        if c == "\\":
            sign = self.pattern[self.at + 1 : self.at + 2]
            self.at += 2
            if sign in ("b", "s", "S", "d", "D", "w", "W", "B"):
                found = "edge" if sign == "b" else None
                self.within_word &= sign in "bdw"
            elif sign.isalnum() or not sign:
                raise _Unknown
            else:
                found = sign
                self.within_word = False
        elif c == "[":
            found = self.set()
        elif c == "(":
            found = self.group()
        else:
            self.at += 1
            found = None if c in ".^$" or not c.isascii() else c
            self.within_word &= c == "_" or (c.isascii() and c.isalnum())
        least, most = self.times()
        if least == 0:
            found = None
        sequence.append(found)
        if most != 1:
            sequence.append(None)

    def set(self) -> frozenset | None:
        """The letters of a set of a few word characters."""
        m = re.compile(r"\[\^?\]?(?:\\.|[^\]\\\[&])*\]", re.DOTALL).match(self.pattern, self.at)
        if not m:
            raise _Unknown
        self.within_word &= bool(_WORD_SET.fullmatch(m[0]))
        self.at = m.end()
        return frozenset(m[0][1:-1].lower()) if re.fullmatch(r"\[\w{1,8}\]", m[0], re.ASCII) else None

    def group(self) -> list[list] | None:
        m = re.compile(r"\((\?:|\?P?<[A-Za-z]\w*>|\?<?[=!]|\?)?").match(self.pattern, self.at)
        kind = m[1] or ""
        if kind == "?":
            raise _Unknown
        self.at = m.end()
        inner = self.alternatives()
        if self.peek() != ")":
            raise _Unknown
        self.at += 1
        if kind.endswith(("=", "!")):
            self.within_word = False
            return None
        return inner

    def times(self) -> tuple[int, int]:
        least, most = 1, 1
        while True:
            m = re.compile(r"[*+?]|\{(\d+)(?:,(\d*))?\}").match(self.pattern, self.at)
            if not m:
                if self.peek() == "{":
                    raise _Unknown
                return least, most
            self.at = m.end()
            least = 0 if m[0] in "*?" else min(least, int(m[1] or 1))
            most = 1 if m[0] == "?" and most == 1 else 2


def _best(alternatives: list[list]) -> list[Need] | None:
    """Needs of which each match holds one: of every alternative the one that says most; None if an alternative asks for nothing."""
    out = []
    for sequence in alternatives:
        choices, n = [], len(sequence)
        edge = lambda i: 0 <= i < n and sequence[i] == "edge"
        i = 0
        while i < n:
            item = sequence[i]
            if isinstance(item, list):
                inner = _best(item)
                if inner:
                    # a group's text begins and ends where the group does only if it is all of it
                    whole = [len(a) and all(isinstance(x, str) and x != "edge" for x in a) for a in item]
                    choices.append([Need(x.text, x.starts or (w and edge(i - 1)), x.ends or (w and edge(i + 1))) for x, w in zip(inner, whole)])
                i += 1
            elif isinstance(item, str) and item != "edge":
                j = i
                while j < n and isinstance(sequence[j], str) and sequence[j] != "edge":
                    j += 1
                choices.append([Need("".join(sequence[i:j]).lower(), edge(i - 1), edge(j))])
                i = j
            else:
                i += 1
        if not choices:
            return None
        # what can be looked up before plain searches, then the longest of the shortest
        out += max(choices, key=lambda c: (all(x.lookup() for x in c), min(len(x.text) for x in c)))
    return out


def _spelled(sequence: list, back: bool) -> set[str]:
    """First letters (^), or last ones ($), of the word at an edge of the sequence, in all the ways it can be spelled; empty if that can't be said."""
    items = sequence[::-1] if back else sequence
    best: set[str] = set()
    for i in [n for n, item in enumerate(items) if item == "edge"]:
        words = {""}
        for item in items[i + 1 :]:
            if isinstance(item, list):
                plain = all(isinstance(x, str) and x != "edge" for a in item for x in a)
                options = {"".join(a).lower() for a in item} if plain else set()
            else:
                options = set(item) if isinstance(item, frozenset) else {item.lower()} if isinstance(item, str) and item != "edge" else set()
            longer = {o + w if back else w + o for w in words for o in options}
            if not longer or len(longer) > SPELLINGS or not all(re.fullmatch("[a-z0-9_]*", w) for w in longer):
                break
            words = longer
            if min(map(len, words)) >= LETTERS:
                break
        found = {"$" + w[-LETTERS:] if back else "^" + w[:LETTERS] for w in words}
        best = max(best, found, key=lambda f: min(map(len, f), default=0))
    return best if all(len(k) > 1 for k in best) else set()


@dataclass(frozen=True)
class Found:
    """How a pattern is found: by first (^) or last ($) letters of words, or by texts to search for; and whether all its matches lie within words so found."""

    keys: frozenset[str]
    texts: frozenset[str]
    within_word: bool


def found_by(pattern: str) -> Found | None:
    """None if the pattern has to be tried on every text."""
    reader = _Reader(pattern)
    try:
        alternatives = reader.alternatives()
        if reader.at < len(pattern):
            raise _Unknown
    except _Unknown:
        return None
    keys, texts = set(), set()
    for sequence in alternatives:
        need = _best([sequence]) or []
        ways = [{x.lookup() or "" for x in need}, _spelled(sequence, False), _spelled(sequence, True)]
        best = max(ways, key=lambda w: min(map(len, w), default=0))
        if min(map(len, best), default=0):
            keys |= best
        elif need:
            texts |= {x.text for x in need}
        else:
            return None
    return Found(frozenset(keys), frozenset(texts), reader.within_word and not texts)


def needs(pattern: str) -> list[Need] | None:
    """Plain texts of which every match of the pattern, whatever its case, holds at least one; None if nothing can be said."""
    reader = _Reader(pattern)
    try:
        found = reader.alternatives()
        if reader.at < len(pattern):
            raise _Unknown
        return _best(found)
    except _Unknown:
        return None


def of_text(text: Column, f: Callable[[Column], Column]) -> Column:
    """f of a text that is worked out once, however often f uses it."""
    return F.get(F.transform(F.array(text), f), F.lit(0))


def branches(words: set[str]) -> str:
    """An expression for several words of word characters, letter by letter; empty for none."""
    by_letter: dict[str, set[str]] = {}
    for w in words:
        if w:
            by_letter.setdefault(w[0], set()).add(w[1:])
    parts = [letter + branches(rest) for letter, rest in sorted(by_letter.items())]
    return f"(?:{'|'.join([*parts, ''] if '' in words else parts)})" if parts else ""


def constant(x, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(x)), kind)


class Index:
    """An index over (name, pattern) pairs, in their order."""

    def __init__(self, patterns: Iterable[tuple[str, str]]):
        self.patterns = list(patterns)
        #: Letters looked up, to patterns to run on the words found (`words`) and on whole texts (`texts`).
        self.keys: dict[str, dict[str, list[int]]] = {}
        #: Texts searched for, to patterns to run on whole texts.
        self.texts: dict[str, list[int]] = {}
        self.always: list[int] = []
        for n, (_, pattern) in enumerate(self.patterns):
            found = found_by(pattern)
            if found is None:
                self.always.append(n)
                continue
            for key in sorted(found.keys):
                self.keys.setdefault(key, {"words": [], "texts": []})["words" if found.within_word else "texts"].append(n)
            for plain in sorted(found.texts):
                self.texts.setdefault(plain, []).append(n)

    def words(self, text: Column) -> Column:
        """Structs (word, entries) of the distinct runs of a text that hold words of which first or last letters are looked up, with what is found."""
        ends = sorted({(k[0], len(k) - 1) for k in self.keys})
        starts, stops = (branches({k[1:] for k in self.keys if k[0] == side}) for side in "^$")
        # runs that begin or end with letters looked up, and those with more than one word
        tails = f"|(?<={stops})" if stops else ""
        some = F.regexp_extract_all(text, F.lit(f"(?i)(?<!{RUN})(?:{f'{starts}{RUN}*+|' if starts else ''}\\w*+(?:{BEYOND}{RUN}*+{tails}))"), F.lit(0))
        slots: list[list[dict]] = [[] for _ in self.keys]
        for key, numbers in self.keys.items():
            slots[zlib.crc32(key.encode()) % len(slots)].append({"key": key, **numbers})
        table = constant(slots, "array<array<struct<key:string,words:array<int>,texts:array<int>>>>")

        def entries(run: Column) -> Column:
            own = F.when(F.octet_length(run) == F.char_length(run), F.array(run)).otherwise(F.split(run, "[^A-Za-z0-9_]+"))
            of_word = lambda w: F.array(*[F.concat(F.lit(side), (F.left if side == "^" else F.right)(w, F.lit(n))) for side, n in ends])
            keys = F.array_distinct(F.flatten(F.transform(own, lambda w: of_text(F.lower(w), of_word))))
            slot = lambda k: F.get(table, F.pmod(F.crc32(k.cast("binary")), F.lit(len(slots))).cast("int"))
            return F.flatten(F.transform(keys, lambda k: F.filter(slot(k), lambda e: e["key"] == k)))

        found = F.transform(F.array_distinct(some), lambda run: F.struct(run.alias("word"), entries(run).alias("entries")))
        return F.filter(found, lambda x: F.size(x["entries"]) > 0)

    def searched(self, text: Column) -> list[Column]:
        """Numbers of the patterns that are run on whole texts and not found by words."""
        parts = [F.array(*map(F.lit, self.always)).cast("array<int>")]
        if self.texts:
            plain = constant([{"t": t, "n": n} for t, n in self.texts.items()], "array<struct<t:string,n:array<int>>>")
            parts.append(of_text(F.lower(text), lambda low: F.flatten(F.transform(F.filter(plain, lambda p: F.contains(low, p.t)), lambda p: p.n))))
        return parts

    def pattern(self, n: Column) -> Column:
        every = constant([{"name": name, "pattern": f"(?i){p}"} for name, p in self.patterns], "array<struct<name:string,pattern:string>>")
        return F.get(every, n)

    def trials(self, text: Column) -> Column:
        """Structs (n, name, pattern, text): every pattern that can match, by number, and what to run it on, a word or the whole text."""
        on = lambda n, t: of_text(self.pattern(n), lambda p: F.struct(n.alias("n"), p["name"].alias("name"), p.pattern.alias("pattern"), t.alias("text")))
        whole = lambda numbers: F.transform(F.array_distinct(F.concat(*numbers)), lambda n: on(n, text))
        if not self.keys:
            return whole(self.searched(text))

        def of_words(words: Column) -> Column:
            single = F.flatten(F.transform(words, lambda x: F.transform(F.array_distinct(F.flatten(x["entries"]["words"])), lambda n: on(n, x["word"]))))
            return F.concat(single, whole([F.flatten(F.flatten(F.transform(words, lambda x: x["entries"]["texts"]))), *self.searched(text)]))

        return of_text(self.words(text), of_words)

    def any(self, text: Column) -> Column:
        """Whether a pattern matches; null for a null text."""
        return of_text(text, lambda t: F.exists(self.trials(t), lambda p: F.rlike(p.text, p.pattern)))

    def matching(self, text: Column) -> Column:
        """Structs (n, name) of the patterns that match, by number; null for a null text."""
        hits = lambda t: F.filter(self.trials(t), lambda p: F.rlike(p.text, p.pattern))
        return of_text(text, lambda t: F.array_sort(F.array_distinct(F.transform(hits(t), lambda p: F.struct(p["n"].alias("n"), p["name"].alias("name"))))))

    def fragments(self, text: Column) -> Column:
        """Structs (name, found) of matches: all the different ones of each pattern, in any order, in one struct or several; null for a null text."""

        def within(t: Column) -> Column:
            every = F.transform(self.trials(t), lambda p: F.struct(p["name"].alias("name"), F.array_distinct(F.regexp_extract_all(p.text, p.pattern, F.lit(0))).alias("found")))
            return F.filter(every, lambda p: F.size(p.found) > 0)

        return of_text(text, within)

    def found(self, text: Column) -> Column:
        """Structs (name, found) of the patterns that match, by number, with all their matches in order; null for a null text."""

        def within(t: Column) -> Column:
            numbers = F.array_sort(F.array_distinct(F.transform(self.trials(t), lambda p: p["n"])))
            every = F.transform(F.transform(numbers, self.pattern), lambda p: F.struct(p["name"].alias("name"), F.regexp_extract_all(t, p.pattern, F.lit(0)).alias("found")))
            return F.filter(every, lambda p: F.size(p.found) > 0)

        return of_text(text, within)


def of_vocabulary(vocabulary: dict[str, Sequence[str]]) -> Index:
    return Index((label, p) for label, patterns in vocabulary.items() for p in patterns)
