"""Vocabulary of a word-level BPE tokenizer file, its pre-tokens, and rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import regex

#: Fixed values of the tokenizer file's format: contractions that are pre-tokens of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WORD_END = "</w>"
#: Pre-tokens whose symbols are kept; beyond it the cache is emptied, so that a worker's memory is bounded.
CACHE_PIECES = 100_000

#: Fixed values of the tokenizer file: how texts are normalised and split, which `normalized` and `pieces` do.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_ASCII = re.compile("|".join([*CONTRACTIONS, r"[a-z]+", r"[0-9]", r"[^ \t-\ra-z0-9]+"]))
_UNICODE = regex.compile("|".join([*CONTRACTIONS, r"\p{L}+", r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}]+"]))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def normalized(text: str) -> str:
    """NFC, then lower case letter by letter (so no final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str) -> list[str]:
    """Pre-tokens of a normalised text."""
    return (_ASCII if text.isascii() else _UNICODE).findall(text)


def piece_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in (_ASCII if text.isascii() else _UNICODE).finditer(text)]


class Vocabulary:
    """Merge table, symbols and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError(f"{path}: a BPE vocabulary with word ends is needed")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if spec.get("normalizer") != NORMALIZER or steps[0].get("pattern") != {"Regex": SPLIT} or [s.get("type") for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: its texts are normalised or split in another way than here")
        vocab: dict[str, int] = model["vocab"]
        self.specials = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.size = 1 + max([*vocab.values(), *self.specials.values()])
        self.tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + WORD_END] for x in letters], np.int64)
        #: bytes of text under each symbol
        self.width = np.array([len(t) - len(WORD_END) * (t.endswith(WORD_END) and t != WORD_END) for t in self.tokens], np.int64)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = made  # by rank
        self.none = len(pairs)
        # merging all occurrences of a pair at once is exact only if no pair ranks before one that makes a part of it
        first = np.full(self.size, -1, np.int64)
        first[made] = np.arange(len(made))
        if len(np.unique(made)) != len(made) or (np.maximum(first[keys // self.size], first[keys % self.size]) >= np.arange(len(keys))).any():
            raise ValueError(f"{path}: a pair ranks before one that makes a part of it")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def split(self, text: str) -> list[str]:
        """Raw text between special strings, and the special strings at the odd places."""
        return self.special_pattern.split(text) if self.special_pattern else [text]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, end to end, and the number of each word's symbols.

        Every step finds the lowest-ranked pair of each unfinished word and
        replaces all its occurrences (from the left, where they overlap) in all
        words at once. A pair that contains a new symbol ranks after the pair
        that made it, so this gives what one merge at a time gives.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)
        full = sizes > 0
        symbols[ends[full] - 1] = self.final[raw[ends[full] - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        out_symbols: list[np.ndarray] = []
        out_words: list[np.ndarray] = []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            ranks = np.full(len(symbols), self.none, np.int64)
            same = np.flatnonzero(word[1:] == word[:-1])
            ranks[same] = self.rank(symbols[same], symbols[same + 1])
            length = np.diff(np.r_[first, len(symbols)])
            low = np.minimum.reduceat(ranks, first)
            done = np.repeat(low == self.none, length)
            if done.any():
                out_symbols.append(symbols[done])
                out_words.append(word[done])
            low = np.repeat(low, length)
            hit = np.flatnonzero((ranks == low) & ~done)
            if len(hit):
                # in a run of overlapping hits every second one stands
                start = np.r_[True, hit[1:] != hit[:-1] + 1]
                run = hit[np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))]
                hit = hit[(hit - run) % 2 == 0]
                symbols[hit] = self.made[low[hit]]
                done[hit + 1] = True
            symbols, word = symbols[~done], word[~done]
        if not out_words:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        symbols, word = np.concatenate(out_symbols), np.concatenate(out_words)
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process and file; read from the executor's own copy of the tokenizer package."""
    return Vocabulary(path)
