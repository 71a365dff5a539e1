"""Pre-tokens of byte-level vocabularies, and a bounded memory of what each of them gives."""

import re
from collections.abc import Callable, Iterator

import regex

#: Fixed value: how the byte-level vocabulary splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same split for texts of Latin letters, which the standard library does in less than half the time.
LATIN = r"A-Za-zªµºÀ-ÖØ-öø-ʯ"
DIGITS = r"0-9²³¹¼½¾"
LATIN_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[{DIGITS}]+| ?[^\s{LATIN}{DIGITS}]+|\s+(?!\S)|\s+"
BEYOND_LATIN = re.compile("[^\x00-\x1b\x20-\x84\x86-ʯ]")
#: Pre-tokens remembered by a worker. The memory never changes a result.
KNOWN_WORDS = 600_000
PIECE_CHARS = 1 << 20
SAFE = regex.compile(r"\p{L}(?= \p{L})")


class Splitter:
    """Cuts texts into pre-tokens; special strings are pre-tokens of their own."""

    def __init__(self, special: list[str]):
        longest = sorted(special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.any = regex.compile(PATTERN)
        self.latin = re.compile(LATIN_PATTERN)

    def _plain(self, text: str) -> list[str]:
        return (self.any if BEYOND_LATIN.search(text) else self.latin).findall(text)

    def split(self, text: str) -> list[str]:
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1 and len(text) <= PIECE_CHARS:
            return self._plain(text)
        out: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(part)
            else:
                for piece in pieces(part):
                    out += self._plain(piece)
        return out


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """A text in parts that split like the whole: each cut stands before a space between two letters."""
    first = 0
    while len(text) - first > most:
        cut = SAFE.search(text, first + most)
        if cut is None:
            break
        yield text[first : cut.start() + 1]
        first = cut.start() + 1
    yield text[first:]


class Memory:
    """What is known of pre-tokens: the recent half and the half before it, so common words stay and rare ones go."""

    def __init__(self, work: Callable[[list[str]], list], most: int = KNOWN_WORDS):
        self.work, self.most = work, most
        self.recent: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def of(self, tokens: list[list[str]]) -> dict[str, object]:
        """A dictionary that holds all of `tokens`."""
        wanted = set().union(*tokens)
        if len(self.recent) + len(wanted) > self.most // 2:
            self.older, self.recent = self.recent, {}
        missing = wanted - self.recent.keys()
        for token in missing & self.older.keys():
            self.recent[token] = self.older[token]
        new = list(missing - self.older.keys())
        if new:
            self.recent.update(zip(new, self.work(new), strict=True))
        return self.recent
