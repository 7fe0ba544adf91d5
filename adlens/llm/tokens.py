"""Token ids of whole texts with a public tokenizer file.

The tokenizer drops white space and never joins characters across it, so a text's ids
are the ids of its space-separated words in turn. Workers keep the ids of words they
have met (a bounded table that starts anew when full): most words of a corpus repeat.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from adlens.llm.common import python_words

KEEP_WORDS = 800_000
# Words of these characters need no Unicode composition and have one lower case; the
# tokenizer's own pieces of them (letters, single digits, other marks) are cut here.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ſ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


_STOPS = b".,;:!?"


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in keep}
    table |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)}
    return table


class _Table(dict):
    """Results of ``make`` by key, made on first use; starts anew when full."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """``ids(text)``: the text's ids as little-endian uint16 bytes, whole and in order."""

    def __init__(self, path: str, most: int = KEEP_WORDS):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        if array("H", [1]).tobytes() != b"\x01\x00":
            raise RuntimeError("a little-endian machine is expected")
        if self.tok.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.letters = _byte_letters()
        self.words = _Table(self._word, most)
        self.pieces = _Table(self._piece, most)

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
        return array("H", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        pieces = self.pieces
        if word.isalpha():  # ASCII letters only: one piece
            return pieces[word.decode().lower()]
        if word[-1] in _STOPS and word[:-1].isalpha():
            return pieces[word[:-1].decode().lower()] + pieces[chr(word[-1])]
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text and "İ" not in text:
            return b"".join(map(pieces.__getitem__, _PIECE.findall(text.lower())))
        return array("H", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.words.__getitem__, python_words(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
