"""Whole-text encoding with a public tokenizer, one space-separated chunk at a time.

Both byte-level and word-end BPE merge only inside pre-tokens, and no pre-token of
these tokenizers reaches over a space that has a non-space on its left side (a space
may only begin a pre-token, or lie in a run of white space). Cutting a text in front of
such spaces therefore changes no id, and each distinct chunk is encoded once per worker.
A new chunk is cut further, at single line feeds and before closing punctuation, where
pre-tokens end as well; pieces of Latin letters are one pre-token each and go straight
to the tokenizer's model, all others through the whole tokenizer.
"""
from __future__ import annotations

import os
import re
import unicodedata
from array import array

# A space after a non-space: the place to cut where white space comes in runs.
_CUT = re.compile(r"(?<=\S) ")
_SPACE = re.compile(r"\s")
_CLOSING = ".,;:!?%$*&#|"
_LATIN_END = "ɐ"
# Memory of a cache entry besides its letters and ids: a string, a bytes object, a slot.
_ENTRY_BYTES = 150


def byte_letters() -> dict[int, int]:
    """Byte value -> code point that stands for it in byte-level vocabularies: printable
    Latin-1 bytes are themselves, the others follow from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class _Run(Exception):
    """A chunk ends in white space: the space after it is not a place to cut."""


class _Cache(dict):
    """Piece of text -> packed ids, filled on demand.

    Two generations: when the newer one has ``max_bytes`` it becomes the older one, and what
    was in the one before goes; a piece found in the older one moves to the newer. So pieces
    in use stay, and memory is bounded in bytes, whatever the pieces are.
    """

    def __init__(self, make, max_bytes: int, max_chars: int):
        self.make, self.max_bytes, self.max_chars = make, max_bytes, max_chars
        self.old: dict[str, bytes] = {}
        self.bytes = 0

    def __missing__(self, w: str) -> bytes:
        ids = self.old.get(w)
        if ids is None:
            ids = self.make(w)
        if len(w) <= self.max_chars:
            self[w] = ids
            self.bytes += _ENTRY_BYTES + len(w) + len(ids)
        return ids

    def turn(self) -> None:
        if self.bytes > self.max_bytes:
            self.old = dict(self)
            self.clear()
            self.bytes = 0


class CachedTokenizer:
    """ids of whole texts as packed little-endian integers.

    path: tokenizer file; wide: 4 bytes an id instead of 2; max_bytes and max_chars
    bound the caches (each holds two generations of max_bytes; longer chunks are encoded
    each time), never the input.
    """

    def __init__(self, path: str, wide: bool = True, max_bytes: int = 40 << 20, max_chars: int = 40):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tokenize = self.tok.model.tokenize
        self.lower = self.tok.normalizer is not None           # NFC and lower case
        self.spaced = not self.lower                           # a word's first symbol holds its space
        self.code = "I" if wide else "H"
        self.letters = byte_letters()
        self.space = chr(self.letters[0x20])
        self.cache = _Cache(self._after_space, max_bytes, max_chars)                # with a space in front
        self.bare = _Cache(self._piece, max_bytes // 4, max_chars)            # as they stand

    def _piece(self, s: str) -> bytes:
        """Ids of a piece of text."""
        word = s[1:] if s[:1] == " " else s
        ids = None
        if word.isalpha() and max(word) < _LATIN_END:
            if self.lower:
                word = unicodedata.normalize("NFC", word).lower()
            elif s is not word:
                word = s
            if not self.lower or word.isalpha():
                letters = word.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in self.tokenize(letters)]
        if ids is None:
            ids = self.tok.encode(s, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def _is_word(self, s: str) -> bool:
        return s.isalpha() and (not self.lower or s.lower().isalpha())

    def _after_space(self, w: str) -> bytes:
        if w.isascii() and w.isalpha():                        # most chunks; its letters stand for themselves
            return array(self.code, [t.id for t in self.tokenize(w.lower() if self.lower else self.space + w)]).tobytes()
        core = w.rstrip(_CLOSING)
        if core and core is not w and self._is_word(core):
            return self.cache[core] + self.bare[w[len(core):]]
        if not w or w[-1].isspace():
            raise _Run
        return self._chunk(w, " ")

    def _chunk(self, w: str, space: str) -> bytes:
        """Ids of a chunk, ``space`` standing before it."""
        if w.isalpha():
            return self._piece(space + w)
        lines = w.split("\n")
        if len(lines) > 1 and (not all(lines) or _SPACE.search(w.replace("\n", ""))):
            return self._piece(space + w)                      # other white space: not cut
        out = []
        for i, line in enumerate(lines):
            if i:
                out.append(self.bare["\n"])
                space = ""
            core = line.rstrip(_CLOSING)
            if core != line and self._is_word(core):
                out += [self.cache[core] if space else self.bare[core], self.bare[line[len(core):]]]
            else:
                out.append(self.bare[space + line])
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text, without special tokens (null: empty)."""
        if not text:
            return b""
        cut = text.split(" ")
        head, last = cut[0], cut[-1]
        if len(cut) == 1:
            return self._chunk(head, "")
        try:
            if head and head[-1].isspace():
                raise _Run
            body = b"".join(map(self.cache.__getitem__, cut[1:-1]))
        except _Run:
            head, *rest = _CUT.split(text)
            return self._chunk(head, "") + b"".join([self._chunk(w, " ") for w in rest])
        return self._chunk(head, "") + body + self._chunk(last, " ")

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        self.cache.turn()
        self.bare.turn()
        return [self.encode(t) for t in texts]
