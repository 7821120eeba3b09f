"""Whole-text encoding with a public tokenizer file, word by word.

A text is cut where the tokenizer's own splitting is sure to cut too; each
distinct piece is encoded once by the ``tokenizers`` library and remembered for
the life of the worker process, within a fixed budget.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, repeat

import numpy as np

#: Characters (with a charge per entry) remembered before the memory starts anew.
BUDGET = 80_000_000
ENTRY = 60

#: A word of Latin letters and the marks that end it: a cut for both kinds of
#: tokenizer, so words need encoding once for all marks that follow them.
_WORD = r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
WORD = re.compile(_WORD)
ENDED = re.compile(rf"({_WORD})([.,;:!?]*)")

TWO_SPACES = re.compile(r"\s\s")
BETWEEN_WORDS = re.compile(r"(?<=[^\W_])(?= [^\W_])")


def spaced_pieces(text: str) -> list[str]:
    """Pieces of a text for splitting patterns that keep one space in front of
    a word: a single white-space character between others always starts a new
    match, so the text may be cut before it (and after a line feed)."""
    flat = text.replace("\n", " ")  # printable: no other white space, nor the mark used here
    if ("  " not in flat and flat.isprintable()) or ("\x1f" not in text and not TWO_SPACES.search(text)):
        return text.replace(" ", "\x1f ").replace("\n", "\x1f\n\x1f").split("\x1f")
    return BETWEEN_WORDS.split(text)


def dropped_space_pieces(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space altogether."""
    return text.replace("\n", " ").split(" ")


def ended_word(piece: str) -> tuple[str, ...]:
    """A piece as a word and its marks."""
    m = ENDED.fullmatch(piece)
    return (m[1], m[2]) if m and m[2] else (piece,)


def lower_ended_word(piece: str) -> tuple[str, ...]:
    """The same for tokenizers that lower-case."""
    m = ENDED.fullmatch(piece)
    return ((m[1].lower(), m[2]) if m[2] else (m[1].lower(),)) if m else (piece,)


class PieceMemory:
    """Ids of pieces in one flat array; ``encode_new`` gives the id lists of
    pieces not seen before, ``parts`` says which smaller pieces one consists of. Texts
    in which ``special`` finds something are encoded whole, by ``encode_whole``.
    ``at_once``: most new pieces a call of ``encode_new`` gets; a list is made for each,
    and few at a time leave Python's garbage collector nothing to walk through."""

    def __init__(self, cut, encode_new, parts=None, special=None, encode_whole=None, at_once=1 << 62):
        self.cut, self.encode_new, self.parts = cut, encode_new, parts or (lambda p: (p,))
        self.special, self.encode_whole, self.at_once = special, encode_whole, at_once
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _add(self, pieces: list[str]) -> None:
        whole, made = [], []
        for p in pieces:
            parts = self.parts(p)
            if parts == (p,):
                whole.append(p)
            else:
                made.append((p, parts))
                whole += [x for x in parts if x not in self.known]
        if whole:
            whole = list(dict.fromkeys(whole))
            lists = self.encode_new(whole)
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            self._store(whole, np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths)
        made = [(p, parts) for p, parts in made if p not in self.known]
        if made:
            at = np.fromiter((self.known[x] for _, parts in made for x in parts), np.int64)
            ids, upto = self._gather(at)
            ends = upto[np.cumsum([len(parts) for _, parts in made])]
            self._store([p for p, _ in made], ids, np.diff(ends, prepend=0))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known pieces in a row, and where each starts."""
        lengths = self.start[at + 1] - self.start[at]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[np.repeat(self.start[at] - upto[:-1], lengths) + np.arange(upto[-1])], upto

    def _store(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first, total = len(self.known), len(ids)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(pieces) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.flat[self.used:self.used + total] = ids
        self.start[first + 1:first + 1 + len(pieces)] = self.used + np.cumsum(lengths)
        self.used += total
        self.known.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.size += sum(map(len, pieces)) + ENTRY * len(pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: the ids of all texts in a row and where each ends."""
        if self.size > BUDGET:
            self.clear()
        whole = [i for i, t in enumerate(texts) if self.special and self.special.search(t)]
        cut = [self.cut(t) for t in texts]
        for i in whole:
            cut[i] = []
        pieces = [p for c in cut for p in c]
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            different = list(dict.fromkeys(new))
            for a in range(0, len(different), self.at_once):
                self._add([p for p in different[a:a + self.at_once] if p not in self.known])
            at[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        ids, upto = self._gather(at)
        ends = upto[np.cumsum([len(c) for c in cut])] if cut else np.zeros(0, np.int64)
        if whole:
            lists = np.split(ids, ends[:-1])
            for i, found in zip(whole, self.encode_whole([texts[i] for i in whole]), strict=True):
                lists[i] = np.array(found, np.uint32)
            ids, ends = np.concatenate(lists), np.cumsum([len(x) for x in lists])
        return ids, ends


def _byte_chars() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 characters as
    themselves, the others as the characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in shown)}


BYTE_CHARS = _byte_chars()


def byte_words(words: list[str]) -> list[str]:
    """Words as a byte-level vocabulary writes them, rewritten in one go: a line feed,
    which no word holds, keeps them apart."""
    if not words:
        return []
    return "\n".join(words).encode().decode("latin-1").translate(BYTE_CHARS).split(chr(BYTE_CHARS[10]))


_MEMORIES: dict[tuple[int, str], PieceMemory] = {}


def memory_of(tokenizer_json: str, cut) -> PieceMemory:
    """This process's memory for a tokenizer file's content."""
    key = (zlib.crc32(tokenizer_json.encode()), cut.__name__)
    if key not in _MEMORIES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        # Strings of special tokens, in any case: the library cuts texts at them first.
        names = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        special = re.compile("|".join(map(re.escape, names)), re.IGNORECASE) if names else None
        tokenize, lower = tokenizer.model.tokenize, cut is dropped_space_pieces

        def encode_new(pieces: list[str]) -> list[list[int]]:
            out: list = [None] * len(pieces)
            # A plain word is one match of the splitting pattern: straight to the model.
            plain = [i for i, p in enumerate(pieces) if WORD.fullmatch(p) and not (lower and p != p.lower())]
            for i, word in zip(plain, byte_words([pieces[i] for i in plain]), strict=True):
                out[i] = [t.id for t in tokenize(word)]
            rest = [i for i, ids in enumerate(out) if ids is None]
            for i, e in zip(rest, tokenizer.encode_batch_fast(
                    [pieces[i] for i in rest], add_special_tokens=False), strict=True):
                out[i] = e.ids
            return out

        def encode_whole(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        _MEMORIES[key] = PieceMemory(
            cut, encode_new, lower_ended_word if lower else ended_word, special, encode_whole, at_once=500)
    return _MEMORIES[key]


def slices(texts: list[str], limit: int = 1 << 21) -> list[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, to bound what one step holds."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            out.append((start, i + 1))
            start, size = i + 1, 0
    if start < len(texts):
        out.append((start, len(texts)))
    return out
