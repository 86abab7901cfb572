"""Token ids of whole texts with a public tokenizer file.

Both kinds of file cut a text into pieces before anything else, and the ids of a text are
those of its pieces in turn; each task keeps the ids of pieces it has met. What cannot be
cut the same way outside the tokenizer is encoded whole by it.

- *Word BPE* (normaliser, letters and digits): pieces are chunks between white space.
- *Byte-level BPE*: pieces are those of the public pattern. Every character beyond ASCII is
  first held against the tokenizer's own cuts; texts with one that differs go whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from string import punctuation

import regex

# Pieces that a Python worker remembers, some 220 bytes each.
KNOWN = 1_200_000
# White space for Python only.
_ODD = re.compile("[\x1c-\x1f]")

# The public pattern of byte-level BPE, and its form for plain ASCII.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_ASCII_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)


def default_path() -> str:
    """The word BPE file of the installed public tokenizers."""
    return public_path("word_bpe_49k.json")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printed]
    return {**{b: chr(b) for b in printed}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


_LETTERS = _byte_letters()


def _spelled(piece: str) -> str:
    """A piece as the letters of its UTF-8 bytes, the form that the models know."""
    return piece.encode().decode("latin-1").translate(_LETTERS)


class _Known(dict):
    """Ids of pieces, found when first asked for."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.find(piece)
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, the special tokens' strings included."""

    def __init__(self, path: str, known: int = KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Pieces are remembered here; a second memory inside only costs time.
        self.model._resize_cache(0)
        self.special = [t["content"] for t in form["added_tokens"]]
        self.known = known
        before = form["pre_tokenizer"] or {}
        self.byte_level = (
            form["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        self.ids = _Known(self._piece if self.byte_level else self._chunk)
        # Characters beyond ASCII that are cut alike here and there, and those that are not.
        self.alike: set[str] = set(map(chr, range(128)))
        self.different: set[str] = set()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.ids) > self.known:
            self.ids.clear()
        known = self.ids
        out = []
        for text in texts:
            pieces = self._pieces(text) if self.byte_level else self._chunks(text)
            if pieces is None:
                out.append(self._whole(text))
            else:
                out.append(b"".join([known[piece] for piece in pieces]))
        return out

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    # ------------------------------------------------------------------ word BPE

    def _chunks(self, text: str) -> list[str] | None:
        if _ODD.search(text):
            return None
        # Case falls away in plain ASCII; the strings of special tokens keep theirs.
        return (text.lower() if text.isascii() and "<|" not in text else text).split()

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            return self._word(chunk)
        word = chunk.rstrip(punctuation)
        low = word.lower()
        # Normaliser and cut only change the case of such a word, and part it from marks.
        if not (low.isalpha() and max(low) < "ɐ"):
            return self._whole(chunk)
        if word != chunk:
            return self.ids[low] + self.ids[chunk[len(word) :]]
        return self._word(_spelled(low)) if low == word else self.ids[low]

    # ------------------------------------------------------------- byte-level BPE

    def _pieces(self, text: str) -> list[str] | None:
        if any(s in text for s in self.special):
            return None
        if text.isascii():
            return _ASCII_PIECES.findall(text)
        letters = set(text)
        for letter in letters - self.alike - self.different:
            (self.alike if self._cut_alike(letter) else self.different).add(letter)
        return _PIECES.findall(text) if letters <= self.alike else None

    def _cut_alike(self, letter: str) -> bool:
        probe = f"a{letter}a 1{letter}1 .{letter}. {letter} {letter}{letter}  {letter}' {letter}"
        cut = [probe[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
        return cut == _PIECES.findall(probe)

    def _piece(self, piece: str) -> bytes:
        return self._word(_spelled(piece))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, with what it has learned."""
    return Encoder(path)
