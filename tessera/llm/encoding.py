"""Token ids of whole texts by a public tokenizer, in bounded memory."""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from array import array
from functools import cache

import pyarrow as pa

#: Letters at the start of a piece, but for numerals that are no digits.
_HEAD = re.compile(r"[^\W\d_]+")


def _byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printed, else the next from U+0100 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printed]
    return "".join(chr(b if b in printed else 256 + others.index(b)) for b in range(256))


_LETTERS = _byte_letters()


class PieceEncoder:
    """Ids as little-endian uint32 bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    Both kinds of vocabulary split a text before each single space or line
    end, so the ids of a text are those of its pieces between them, and within
    a piece after the letters that it begins with. Those letters are one word
    of the library's model; the rest of a piece comes from its tokenizer. A
    piece's ids are kept; of two generations of ``max_kept`` pieces the older
    is dropped when the younger is full. Where white space has tokens, a piece
    but the first begins with its space or line end, and texts with other
    white space next to those are encoded whole. Where it has none, letters
    count in lower case, and texts whose lower case depends on more than each
    letter are encoded whole.
    """

    def __init__(self, path: str, white_space_has_tokens: bool, max_kept: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = white_space_has_tokens
        self.max_kept = max_kept
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.rest = cache(self._whole)  # of what follows a word, one at most for each piece kept

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str, space: str) -> bytes:
        """Ids of letters, with the byte letter of the white space before them."""
        if not word.isascii():
            word = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(space + word)]).tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        if self.spaced:
            return text.replace("\n", " \n").split(" ")
        if "<|" in text:  # a special token, or what would become one
            return None
        if not text.isascii():
            if "Σ" in text or not unicodedata.is_normalized("NFC", text) or not unicodedata.is_normalized("NFC", text.lower()):
                return None
        return text.lower().replace("\n", " ").split(" ")

    def _learn(self, piece: str) -> bytes | None:
        """A piece's ids, from now on kept; None if its white space is uneven."""
        space, body = "", piece
        if self.spaced:
            if not piece or piece[-1].isspace() or piece[0].isspace() and (piece[0] != "\n" or piece[1].isspace()):
                return None
            body, space = (piece[1:], _LETTERS[10]) if piece[0] == "\n" else (piece, _LETTERS[32])
        if (ids := self.old.get(piece)) is None:
            head = body if body.isalpha() else (found[0] if (found := _HEAD.match(body)) else "")
            if not head.isalpha():
                ids = self._whole(" " + body if self.spaced and piece is body else piece)
            else:
                # A line end is a word of its own, a space belongs to the word after it.
                ids = self._word(head, "") if space == _LETTERS[10] else self._word(head, space)
                if space == _LETTERS[10]:
                    ids = self.rest("\n") + ids
                if len(head) < len(body):
                    ids += self.rest(body[len(head) :])
        self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if len(self.young) > self.max_kept:
            self.old, self.young = self.young, {}
            self.rest.cache_clear()
        pieces = self._pieces(text)
        if pieces is None:
            return self._whole(text)
        first = b""
        if self.spaced:  # the first piece has no space before it
            if text[0].isspace() or pieces[0][-1].isspace():
                return self._whole(text)
            first, pieces = self._whole(pieces[0]), pieces[1:]
        ids = list(map(self.young.get, pieces))
        try:
            return first + b"".join(ids)
        except TypeError:
            for i, known in enumerate(ids):
                if known is None and (known := self.young.get(pieces[i]) or self._learn(pieces[i])) is None:
                    return self._whole(text)
                ids[i] = known
            return first + b"".join(ids)


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def release() -> None:
    """Lets go of what this Python worker has kept for tokenizing: workers are reused, and stages that don't tokenize need the memory."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()  # an encoder and its cache hold each other
        pa.default_memory_pool().release_unused()


def encoder(path: str, white_space_has_tokens: bool) -> PieceEncoder:
    """One encoder for each vocabulary and Python worker."""
    key = (path, white_space_has_tokens)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(*key)
    return _ENCODERS[key]
