"""Exact token ids of whole texts, word by word, with a cache.

The vocabulary's normaliser works on characters and its pre-tokeniser never
crosses white space, so a text's ids are the ids of its words in order. A
word's ids are looked up, and only unseen pieces reach the BPE model. Texts
where that does not hold for certain (the special tokens' strings, control
characters that Python splits at and the vocabulary does not, capital sigma)
go through the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The pre-tokeniser's pattern of the vocabulary file, and its form for ASCII.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PIECE_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_WHOLE = re.compile("[\x1c-\x1fΣİ]|<\\|")
#: Words and pieces (about 230 bytes each) that a Python worker keeps. Frequent ones come early, so a full cache takes
#: no more, until STALE times as many were not in it: then the texts are others, and it starts anew.
CACHE_WORDS, CACHE_PIECES, STALE = 250_000, 80_000, 8


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenIds:
    """Ids of texts under one vocabulary file, as little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.by_word = _Words(self)

    def piece(self, p: str) -> bytes:
        """Ids of a run of letters, a digit or a run of signs; words differ more than their pieces do."""
        own = self.pieces.get(p)
        if own is None:
            letters = p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
            own = array("H", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(self.pieces) < CACHE_PIECES:
                self.pieces[p] = own
        return own

    def encode(self, text: str) -> bytes:
        if _WHOLE.search(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.by_word.__getitem__, text.lower().split()))


class _Words(dict):
    def __init__(self, ids: TokenIds) -> None:
        super().__init__()
        self.ids = ids
        self.missed = 0

    def __missing__(self, word: str) -> bytes:
        if word.isascii():
            # letters are one piece, and so are signs after them
            core = word.rstrip(_SIGNS)
            if core.isalpha():
                pieces = (word,) if len(core) == len(word) else (core, word[len(core):])
            else:
                pieces = PIECE_ASCII.findall(word)
        else:
            pieces = PIECE.findall(word)
        own = b"".join(map(self.ids.piece, pieces))
        if len(self) < CACHE_WORDS:
            self[word] = own
        elif self.missed < STALE * CACHE_WORDS:
            self.missed += 1
        else:
            self.clear()
            self.ids.pieces.clear()
            self.missed = 0
        return own


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """One per Python worker, which serves many tasks."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
