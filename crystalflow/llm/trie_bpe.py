"""Byte-level BPE encoding by a prefix-sharing walk over the trie of distinct words.

Of the encoding of a prefix only its last token has to be known: cutting that
token off leaves a shorter prefix, whose encoding goes before it. A token can
be the last one of a prefix if it ends there and may stand next to the last
token of the prefix before it, that is, if BPE leaves the two as they are when
it meets them alone; exactly one token can. The distinct words of a batch are
put in sorted order, which is the depth-first order of their trie, and a stack
holds the last token for every depth: what two words share is computed once.
The tokens that end a prefix are known from its longest end that begins a token.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from crystalflow.llm.helpers import chunks, id_and_text
from crystalflow.llm.tokens import BYTE_LEVEL, CROWDED, ENTANGLED, MARKS, RUNS, byte_letters, packed, specials

class Vocabulary:
    """Tokens and merges of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {text.encode(): number for text, number in special.items()}
        model = spec["model"]["vocab"]
        self.ids = {bytes(letters[c] for c in word): number for word, number in model.items() if word not in special}
        self.bytes = {number: word for word, number in (self.ids | self.special).items()}
        # (left, right) -> (rank, token), and what each merged token was made from
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (model[part] for part in (merge.split(" ") if isinstance(merge, str) else merge))
            token = self.ids[self.bytes[left] + self.bytes[right]]
            self.merges[left, right] = (rank, token)
            self.made.setdefault(token, (rank, left, right))

    def beside(self, left: int, right: int) -> bool:
        """True if BPE leaves ``left`` next to ``right``: no merge reaches across the border.

        Both sides are taken apart again, the later merge first; at every moment
        the two tokens at the border must not have merged before the next merge
        on either side took place.
        """
        until = len(self.merges) * 2  # merges up to here (half ranks: 2 r, + 1 if at the right) have been done
        while True:
            across = self.merges.get((left, right))
            if across is not None and 2 * across[0] < until:
                return False
            on_left, on_right = self.made.get(left), self.made.get(right)
            if on_left is None and on_right is None:
                return True
            if on_right is None or on_left is not None and on_left[0] > on_right[0]:
                until, left = 2 * on_left[0], on_left[2]
            else:  # of equal merges the one further left comes first
                until, right = 2 * on_right[0] + 1, on_right[1]


class Ends:
    """What may end a text: its longest end that begins a token, as a numbered state, and all tokens that end there."""

    def __init__(self, ids: dict[bytes, int]):
        self.ids = ids
        self.states: dict[bytes, int] = {b"": 0}
        for word in ids:
            for k in range(1, len(word) + 1):
                self.states.setdefault(word[:k], len(self.states))
        self.names = list(self.states)
        self.steps: dict[int, int] = {}  # from 256 state + byte, as far as met
        self.tokens: list[list[tuple[int, int]] | None] = [None] * len(self.names)  # (length, token) by state, longest first

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte, whose ``tokens`` are set."""
        name = self.names[state] + bytes([byte])
        while name not in self.states:
            name = name[1:]
        to = self.states[name]
        if self.tokens[to] is None:
            ends = (name[k:] for k in range(len(name)))
            self.tokens[to] = [(len(end), self.ids[end]) for end in ends if end in self.ids]
        if len(self.steps) >= STEPS_KEPT:
            self.steps.clear()
        self.steps[state << 8 | byte] = to
        return to


PIECES_KEPT = 200_000  # of each of two generations; some 80 MB in all
LONG = 200  # characters; longer pieces are not remembered
STEPS_KEPT = 200_000  # some 25 MB
PAIRS_KEPT = 500_000  # some 50 MB
CHUNK = 6 << 20  # bytes of text whose new words share one trie
ALWAYS = MARKS | {"\n"}  # pieces that others are put together with


class Generations(dict):
    """Values of pieces, in two generations of at most about ``keep``."""

    def __init__(self, keep: int):
        super().__init__()
        self.keep, self.old = keep, {}
        self.long: list[str] = []

    def lacking(self, pieces: set[str]) -> set[str]:
        """Those of ``pieces`` without a value; all others can be looked up until the next call."""
        lack = pieces.difference(self)
        if len(self) + len(lack) > self.keep and self:
            self.old = dict(self)
            self.clear()
            lack = pieces
        again = lack & self.old.keys()
        self.update((piece, self.old[piece]) for piece in again)
        lack = lack - again
        self.long = [piece for piece in lack if len(piece) > LONG]
        return lack

    def settle(self) -> None:
        """Forget the long pieces, once they have been looked up."""
        for piece in self.long:
            self.pop(piece, None)
        self.long = []


class TrieEncoder:
    """Encodes whole texts; remembers distinct pieces between spaces or line ends."""

    def __init__(self, path: str, keep: int = PIECES_KEPT):
        self.vocabulary = v = Vocabulary(path)
        self.ends = Ends(v.ids)
        self.sizes = {number: len(word) for number, word in v.bytes.items()}
        self.packed = {number: packed([number]) for number in v.bytes}
        self.words_of = pa.array([v.bytes.get(k, b"") for k in range(max(v.bytes) + 1)], pa.large_binary())
        self.runs = re.compile(RUNS).findall
        self.entangled = re.compile(ENTANGLED).search
        self.crowded = re.compile(CROWDED).search
        self.words = regex.compile(BYTE_LEVEL.words).findall
        names = [t.decode() for t in v.special]
        self.has_special = specials(names)
        self.special = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        self.led = Generations(keep)  # pieces, without the space before them; a line end at their start has none
        self.bare = Generations(max(1, keep // 8))  # pieces as they are
        self.pairs: dict[int, dict[int, bool]] = defaultdict(dict)  # which tokens may follow which, as far as asked

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The packed ids of each distinct word, by a depth-first walk of their trie."""
        if sum(map(len, self.pairs.values())) >= PAIRS_KEPT:
            self.pairs.clear()
        beside, pairs, sizes, ids_of, ends = self.vocabulary.beside, self.pairs, self.sizes, self.packed, self.ends
        steps, step, tokens = ends.steps.get, ends.step, ends.tokens
        last, states, before = [-1], [0], b""  # last token and state by depth, and the word they stand for
        out = {}
        for word in sorted(words):
            end = _shared(before, word)
            del last[end + 1 :], states[end + 1 :]
            state = states[end]
            for byte in word[end:]:
                end += 1
                to = steps(state << 8 | byte)
                state = step(state, byte) if to is None else to
                for length, token in tokens[state]:
                    if length < end:
                        left = last[end - length]
                        following = pairs[left]
                        fits = following.get(token)
                        if fits is None:
                            fits = following[token] = beside(left, token)
                        if not fits:
                            continue
                    last.append(token)
                    states.append(state)
                    break
                else:
                    raise ValueError(f"no encoding of {word!r}")
            ids, at = [], end
            while at:
                token = last[at]
                ids.append(ids_of[token])
                at -= sizes[token]
            ids.reverse()
            out[word] = b"".join(ids)
            before = word
        return out

    def _parts(self, run: str) -> list[bytes | int]:
        """A run's words, with special tokens as their ids."""
        if self.has_special(run) is None:
            return [w.encode() for w in self.words(run)]
        parts: list[bytes | int] = []
        at = 0
        for found in self.special.finditer(run):
            parts += [w.encode() for w in self.words(run[at : found.start()])]
            parts.append(self.vocabulary.special[found[0].encode()])
            at = found.end()
        return parts + [w.encode() for w in self.words(run[at:])]

    def _learn(self, known: Generations, pieces: set[str], space: str) -> None:
        """Encode the pieces that are not known, all in one trie; those made of known ones are put together."""
        stems = {p[:-1] for p in pieces.difference(known) if p[-1:] in MARKS and p[:-1].isalpha()}
        alone: list[str] = []
        parts: dict[str, list[bytes | int]] = {}
        marked, starting = [], []
        for piece in known.lacking(pieces | stems):
            if piece.isalpha():
                alone.append(piece)
            elif piece[-1:] in MARKS and piece[:-1].isalpha():  # a word and one mark
                marked.append(piece)
            elif space and piece[:1] == "\n":
                starting.append(piece)
            else:
                parts[piece] = self._parts(space + piece)
        spelled = [(space + piece).encode() for piece in alone]
        words = self.encode_words({p for ps in parts.values() for p in ps if isinstance(p, bytes)}.union(spelled))
        known.update(zip(alone, map(words.__getitem__, spelled), strict=True))
        for piece, ps in parts.items():
            known[piece] = b"".join([words[p] if isinstance(p, bytes) else packed([p]) for p in ps])
        for piece in marked:
            known[piece] = known[piece[:-1]] + self.bare[piece[-1]]
        for piece in starting:
            known[piece] = self.bare["\n"] + self.bare[piece[1:]]

    def _cut(self, text: str) -> str | list[str]:
        """The text to be cut at its spaces, or its runs."""
        if self.entangled(text):
            return self.runs(text)
        if "\n" in text:
            if not self.crowded(text):  # every line end stands alone
                return text.replace("\n", " \n")
            if " \n" in text:
                return self.runs(text)
        return text

    def _pieces(self, texts: Iterable[str | None]) -> tuple[list[list[str]], pa.DictionaryArray, np.ndarray]:
        """The bare pieces of each text, the led ones of all texts in a row, and where a text's begin among them."""
        cut = [self._cut(text or "") for text in texts]
        spaced = pa.array([c if isinstance(c, str) else "" for c in cut], pa.large_string())
        pieces = pc.split_pattern(spaced, " ")
        at = pieces.offsets.to_numpy().astype(np.int64)
        led = np.ones(at[-1], bool)
        led[at[:-1]] = False  # the first of each text, which stands for the runs of a text cut at those
        first = pieces.values.filter(pa.array(~led)).to_pylist()
        bare = [[piece] if isinstance(c, str) else c for c, piece in zip(cut, first, strict=True)]
        return bare, pieces.values.filter(pa.array(led)).dictionary_encode(), at - np.arange(len(at))

    def encode_all(self, texts: Sequence[str | None]) -> pa.ListArray:
        """The ids of each text; none for null."""
        bare, rest, at = self._pieces(texts)
        led = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
        distinct = set(led)
        starts = {p[1:] for p in distinct.difference(self.led) if p[:1] == "\n"}
        self._learn(self.bare, starts.union(ALWAYS, *bare), "")
        self._learn(self.led, distinct, " ")
        plain = self.bare.__getitem__
        ids = [*map(self.led.__getitem__, led), *(b"".join(map(plain, pieces)) for pieces in bare)]
        self.bare.settle()
        self.led.settle()
        which = np.insert(rest.indices.to_numpy().astype(np.int64), at[:-1], np.arange(len(led), len(ids)))
        ends, data = _side_by_side(pa.array(ids, pa.large_binary()).take(pa.array(which)))
        ends = ends[at + np.arange(len(at))] // 4
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(data, "<i4")))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; none for null."""
        return [packed(ids) for ids in self.encode_all(texts).to_pylist()]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids, as ``decode`` gives it; none is null."""
        ends, data = _side_by_side(self.words_of.take(ids.flatten()))
        ends = ends[ids.offsets.to_numpy() - ids.offsets[0].as_py()]
        texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), data])
        try:
            return texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # not all UTF-8
            return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.large_string())


def _side_by_side(values: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Where each of some large binary values starts, with the end of the last, and all their bytes."""
    _, ends, data = values.buffers()
    if not len(values) or data is None:
        return np.zeros(len(values) + 1, np.int64), pa.py_buffer(b"")
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1]
    return ends - ends[0], data.slice(int(ends[0]), int(ends[-1] - ends[0]))


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


@lru_cache(maxsize=1)
def _kept(path: str, written: tuple[int, int]) -> TrieEncoder:
    return TrieEncoder(path)


def worker_encoder(path: str) -> TrieEncoder:
    """The encoder of this Python worker, with the words that its earlier tasks met.

    A worker keeps the encoder it used last, for the file as it stands now.
    """
    file = os.stat(path)
    return _kept(path, (file.st_mtime_ns, file.st_size))


def _gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``size`` bytes, as far as they allow."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in [*held, batch]) > size:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """The id column and ``ids`` of every whole text; with ``decoded`` also the text that they decode to.

    A null text counts as empty and has no ids. Rows that repeat are encoded
    each; other columns are not read; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in _gathered(chunks(batches, size=CHUNK), CHUNK):
            ids = encoder.encode_all(batch.column("text").to_pylist())
            columns, names = [batch.column("id"), ids], [id_col, "ids"]
            if decoded:
                columns, names = [*columns, encoder.decode_all(ids).cast(pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = id_and_text(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(tokens: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id column and ``text`` for rows of ids; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, text string")
