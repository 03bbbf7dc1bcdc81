"""Encoding whole texts with a tokenizers file, each distinct word about once per Python worker.

A text is cut at its spaces. The word splitters never join characters on both
sides of a space, but for the space that leads a byte-level word, so a text's
ids are those of its space-led pieces in a row. The one exception is a space
between other white space, where runs of white space meet: such texts are cut
before every run of white space instead. Where white space carries no ids, a
text is cut at all of it, else also before its line ends if all of them stand
alone. A piece that is not remembered is normalised by the file's normaliser,
split by the file's pattern and encoded by its model; pieces with a special token go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
import weakref
from array import array
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import regex

# white space as the tokenizers see it: Python's, without the four separators
_SPACE, _OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_WS = r"\t-\r\x85\p{Z}"

RUNS_KEPT = 500_000  # of each of two generations; some 200 MB in all


@dataclass(frozen=True)
class Splitter:
    """How a kind of file splits: into pieces that never interact, and a piece into words."""

    words: str
    spaces_count: bool  # False if white space carries no ids


# fixed values: the word patterns of the two kinds of file, with Unicode white space spelled out
BYTE_LEVEL = Splitter(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+", True
)
WORD_END = Splitter(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WS}\p{{L}}\p{{N}}]+", False)

RUNS = rf"{_SPACE}*{_OTHER}+|{_SPACE}+"
# the character itself comes first, so that a search skips to the next one of it
ENTANGLED = rf" (?!{_OTHER})(?<!{_OTHER} )"  # a space whose two sides are white space
CROWDED = rf"\n(?:(?!{_OTHER})|(?<!{_OTHER}\n))"  # a line end with white space on a side
MARKS = frozenset(".,;:!?")
SIMPLE = "\u0130"  # letters below are in normal form, and have one lower case everywhere
SEPARATORS = re.compile("[\x1c-\x1f]").search  # white space to Python alone


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, all other bytes in order
    for the characters from U+0100 on.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def packed(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit values."""
    return array("I", ids).tobytes()


class Known(dict):
    """The bytes of runs: remembered, or computed when asked for.

    Runs live in two generations of at most ``keep``; one that does not come
    again within a generation is forgotten and, if need be, computed again.
    """

    def __init__(self, compute: Callable[[str], bytes], keep: int = RUNS_KEPT):
        super().__init__()
        self.compute, self.keep, self.old = compute, keep, {}

    def __missing__(self, run: str) -> bytes:
        value = self.old.get(run)
        if value is None:
            value = self.compute(run)
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        self[run] = value
        return value


class WordEncoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, splitter: Splitter, keep: int = RUNS_KEPT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model.tokenize
        normalizer = self.tokenizer.normalizer
        self.normalize = normalizer.normalize_str if normalizer is not None else None
        self.special = specials(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.letters = byte_letters()
        self.words = regex.compile(splitter.words).findall
        self.space = " " if splitter.spaces_count else ""
        self.spaces_count = splitter.spaces_count
        self.lead = self.letters[32] if splitter.spaces_count else ""
        self.runs = re.compile(RUNS).findall
        self.entangled = re.compile(ENTANGLED).search if splitter.spaces_count else lambda text: None
        self.crowded = re.compile(CROWDED).search
        me = weakref.ref(self)  # no cycle, so that a task's memory goes with its encoder
        self.led = Known(lambda piece: me()._led(piece), keep)  # pieces, without the space before them
        self.bare = Known(lambda piece: me()._bare(piece), max(1, keep // 8))  # pieces as they are

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model(spelled)]).tobytes()

    def _ids(self, piece: str) -> bytes:
        if self.special(piece):
            return packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if self.normalize is not None:
            piece = piece.lower() if piece.isascii() else self.normalize(piece)
        return b"".join(map(self._word, self.words(piece)))

    def _bare(self, piece: str) -> bytes:
        if self.normalize is None:
            if piece.isalpha():
                return self._word(piece)
            if piece[-1:] in MARKS and piece[:-1].isalpha():
                return self._word(piece[:-1]) + self.bare[piece[-1]]
        return self._ids(piece)

    def _led(self, piece: str) -> bytes:
        if piece.isalpha():
            if piece.isascii():
                spelled = self.lead + (piece.lower() if self.normalize is not None else piece)
                return array("I", [t.id for t in self.model(spelled)]).tobytes()
            if self.normalize is None:
                return self._word(self.space + piece)
            if max(piece) < SIMPLE:
                return self._word(self.space + piece.lower())
        elif piece[-1:] in MARKS and piece[:-1].lower().isalpha():  # a word and one mark: two words to every pattern
            return self.led[piece[:-1]] + self.bare[piece[-1]]
        elif piece[:1] == "\n":  # never led by a space, see _text
            return self.bare["\n"] + self._bare(piece[1:])
        elif "\n" in piece:
            lines = piece.split("\n")
            if all(line and line == line.strip() for line in lines):  # every line end stands alone
                return self.led[lines[0]] + b"".join(self.bare["\n"] + self.bare[line] for line in lines[1:])
        return self._ids(self.space + piece)

    def _text(self, text: str) -> bytes:
        if not self.spaces_count and not SEPARATORS(text):
            return b"".join(map(self.led.__getitem__, text.split()))
        if self.entangled(text):
            return b"".join(map(self.bare.__getitem__, self.runs(text)))
        if "\n" in text:
            if not self.crowded(text):
                text = text.replace("\n", " \n")
            elif " \n" in text:
                pieces = text.split(" ")
                led = [self.bare[" " + p] if p[:1] == "\n" else self.led[p] for p in pieces[1:]]
                return self.bare[pieces[0]] + b"".join(led)
        pieces = text.split(" ")
        return self.bare[pieces[0]] + b"".join(map(self.led.__getitem__, pieces[1:]))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; none for null."""
        return [self._text(t) if t else b"" for t in texts]


@lru_cache(maxsize=1)
def _kept(path: str, splitter: Splitter, written: tuple[int, int]) -> WordEncoder:
    return WordEncoder(path, splitter)


def worker_encoder(path: str, splitter: Splitter) -> WordEncoder:
    """The encoder of this Python worker, with the words that its earlier tasks met.

    A worker keeps the encoder it used last, for the file as it stands now.
    """
    file = os.stat(path)
    return _kept(path, splitter, (file.st_mtime_ns, file.st_size))


def specials(texts: Iterable[str]):
    """A search for any of the special tokens' texts."""
    return re.compile("|".join(map(re.escape, texts)) or r"(?!)").search
