"""Exact, cached tokenisation with the tokenizers library.

Both vocabularies used here split a text into words before any merge is applied, and a single
space between two non-space characters always ends a word. The ids of a text are therefore the
concatenated ids of its space-separated pieces. Each distinct piece is encoded once per worker and
kept, as little-endian unsigned 32-bit bytes, in a bounded dictionary. A piece that is one run of
letters is a word by itself, so the library's model encodes it directly; a run of letters followed by
punctuation is two such words; any other piece goes through the library's whole chain. Texts for which
the argument does not hold (adjacent or outer white space, special-token markers, anything
unprintable) are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import pyarrow as pa

from .common import release_memory

#: Pieces kept per worker, in two generations: when the young one is full it becomes the old one, and
#: what was not used meanwhile goes. Bounds memory, never changes ids.
CACHE_ENTRIES = 900_000

#: Letters below are letters to every release of Unicode.
LAST_LETTER = "\u0500"

#: Separates pieces; texts that hold it are encoded whole.
CUT = "\x1f"

#: Letters, then punctuation that no rule of either vocabulary joins with letters.
_ENDED = re.compile(r"( ?[^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)")

_MODELS: dict[str, "PieceEncoder"] = {}


class _Pieces(dict):
    """Ids by piece: the young generation, which takes over from the old one what is used again."""

    def __init__(self, learn: Callable[[str], bytes], old: dict):
        self.learn, self.old = learn, old

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.learn(piece)
        self[piece] = ids
        return ids


def _byte_letters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: printable Latin-1 characters
    stand for themselves, the other bytes, in order, for the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
SPACE = _BYTE_LETTERS[ord(" ")]


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps_space = "ByteLevel" in str(type(self.tokenizer.pre_tokenizer))
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        self.known = _Pieces(self._learn, {})

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, piece: str) -> bytes:
        word = piece[1:] if self.keeps_space and piece[:1] == " " else piece
        if word.isalpha() and (self.keeps_space or word.islower()) and (word.isascii() or max(word) < LAST_LETTER):
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
            return array("I", [t.id for t in self.model.tokenize(letters if word is piece else SPACE + letters)]).tobytes()
        if ended := _ENDED.fullmatch(piece):
            return self.known[ended[1]] + self.known[ended[2]]
        return self._ids(piece)

    def _pieces(self, text: str) -> list[str] | None:
        """The pieces of a text; None if it must be encoded whole."""
        flat = text.replace("\n", " ")
        if "  " in flat or flat[0] == " " or flat[-1] == " " or "<|" in flat or not flat.isprintable():
            return None
        if self.keeps_space:
            # a line feed between words is a word of its own
            return text.replace("\n", CUT + "\n" + CUT).replace(" ", CUT + " ").split(CUT)
        # lower case is given here, as the vocabulary does; a capital sigma's depends on what follows it
        if not self.lowers or "Σ" in flat or not is_normalized("NFC", flat):
            return None
        return flat.lower().split(" ")

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit bytes; null counts as empty."""
        if not text:
            return b""
        pieces = self._pieces(text)
        if pieces is None:
            return self._ids(text)
        if len(self.known) >= CACHE_ENTRIES // 2:
            self.known.old = {}
            self.known = _Pieces(self._learn, self.known)
        return b"".join(map(self.known.__getitem__, pieces))


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file; loaded once per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceEncoder(path)
    return _MODELS[path]


def encoded(rows: Iterator[pa.RecordBatch], path: str, at_most: int = 4 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, token bytes) of (id, text) batches, in groups of about so many characters."""
    codec, ids, found, size = encoder(path), [], [], 0
    for batch in rows:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            ids.append(doc_id.as_py())
            found.append(codec.encode(text))
            size += len(text or "")
            if size >= at_most:
                yield ids, found
                ids, found, size = [], [], 0
    if ids:
        yield ids, found
    release_memory()
