"""Word-by-word use of the tokenizers library.

Both tokenizer files here cut a text into pieces before any merge, and no piece runs
from a non-space character into white space. A text is therefore the sequence of its
white-space runs and words, each encoded on its own, and equal words have equal ids.
Tasks keep the results of words in a bounded dictionary and ask the library only for
new ones. Words whose letters end before a run of plain punctuation are cut there,
which is a piece border too. Anything else goes to the library's whole encoder.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from tokenizers import Tokenizer

# The Unicode White_Space characters, as the tokenizers' patterns use them.
WHITE = "\t-\r \x85\xa0  -     　"
WORD = re.compile(f"[^{WHITE}]+")
SEGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# A space beside another one, at either end, or other than blank and line feed.
UNEVEN = re.compile(f"[{WHITE}][{WHITE}]|[^\\S \n]|[\x1c-\x1f]|\\A[{WHITE}]|[{WHITE}]\\Z")
SEPARATORS = re.compile("[\x1c-\x1f]")
PUNCTUATION = ".,!?;:"
REMEMBERED = 800_000


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself if printable, else 256 and up in turn."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def as_bytes(piece: str) -> str:
    """A piece as the byte-level models see it."""
    return piece.encode().decode("latin-1").translate(BYTE_LETTERS)


@cache
def load(path: str) -> Tokenizer:
    """One tokenizer per Python worker; no truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _latin(word: str) -> bool:
    return word.isascii() or max(word) <= "\xff"


class Counts(dict):
    """Tokens of a segment under a byte-level tokenizer with blank-prefixed pieces."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = load(path)
        self.model = self.tokenizer.model

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def fresh(self, segment: str) -> int:
        core = segment.rstrip(PUNCTUATION)
        letters = core[1:] if core[:1] == " " else core
        if letters.isalpha():
            if len(core) == len(segment):
                return len(self.model.tokenize(as_bytes(segment)))
            return self[core] + self[segment[len(core) :]]
        return self.whole(segment)

    def __missing__(self, segment: str) -> int:
        count = self.fresh(segment)
        if len(self) >= REMEMBERED:
            self.clear()
        self[segment] = count
        return count

    def of(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        look_up = self.__getitem__
        if UNEVEN.search(text):
            return sum(map(look_up, SEGMENT.findall(text)))
        lines = text.split("\n")
        total = 0 if len(lines) == 1 else (len(lines) - 1) * self["\n"]
        for line in lines:
            first, *rest = line.split(" ")
            total += look_up(first)
            total += sum([look_up(f" {w}") for w in rest])
        return total


class Ids(dict):
    """Packed ids of a word under a lower-casing tokenizer that drops white space."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def fresh(self, word: str) -> bytes:
        core = word.rstrip(PUNCTUATION)
        if core.isalpha() and _latin(core):
            if len(core) < len(word):
                return self[core] + self[word[len(core) :]]
            lower = core.lower()
            if lower != core:
                return self[lower]
            return self.pack([t.id for t in self.model.tokenize(as_bytes(core))])
        return self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        packed = self.fresh(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = packed
        return packed

    def of(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        found = WORD.findall(text) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, found))


@cache
def counts(path: str) -> Counts:
    return Counts(path)


@cache
def ids(path: str) -> Ids:
    return Ids(path)
