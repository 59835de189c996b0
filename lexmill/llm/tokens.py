"""Token ids of whole texts with the vocabulary files of public tokenizers.

Ids come from the tokenizers library. As one word occurs in many documents, a
task keeps the ids of the blank-separated chunks it has met, and only asks the
library about new ones. A text that cannot be cut at blanks without changing
its ids, or that holds a special token of the vocabulary, goes to the library whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable
from types import ModuleType

import numpy as np
import regex

# Chunks a Python worker remembers before it starts anew (some 200 MB).
REMEMBERED = 1_000_000

# The letters that stand for bytes in byte-level vocabularies: printable Latin-1 stands for
# itself, the other bytes follow in order from U+0100.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {byte: 0x100 + i for i, byte in enumerate(b for b in range(0x100) if b not in _SHOWN)}

def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_state() -> dict:
    """Values that live as long as the Python worker. Functions of this package
    reach workers by value, with new globals for every task."""
    name = "lexmill_worker_state"
    return sys.modules.setdefault(name, ModuleType(name)).__dict__


def encoder(path: str, blanks: str) -> "Encoder":
    """The worker's encoder for a vocabulary file, made once per process."""
    made = worker_state()
    if (path, blanks) not in made:
        made[path, blanks] = Encoder(path, blanks)
    return made[path, blanks]


class Encoder(dict):
    """Ids of texts as little-endian bytes, ``dtype`` wide.

    ``blanks="kept"``: the vocabulary writes a blank with the word after it.
    ``blanks="dropped"``: white space only parts words.
    """

    # A blank amid white space, or white space that ends in a blank: such a run is one token.
    RUN = re.compile(r"\s (?:\s|\Z)")
    # Chunks of Latin-1 characters are cut into the words of the model here, others by the library.
    LATIN = re.compile(r" ?[\x21-\x7e\xa1-\xff]+")
    CUTS = {
        True: regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"),
        False: regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"),
    }
    # The most common chunks: letters, and perhaps one mark after them that begins no contraction.
    MARKS = frozenset(".,;:!?)\"")

    def __init__(self, path: str, blanks: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.kept = blanks == "kept"
        self.cut = self.CUTS[self.kept].findall

    def ids(self, text: str) -> bytes:
        """The ids of one text, without special tokens."""
        if len(self) > REMEMBERED:
            self.clear()
        if any(token in text for token in self.special):
            return self._whole(text)
        if not self.kept:
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        if self.RUN.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        return self[first] + b"".join(map(self.__getitem__, [" " + chunk for chunk in rest]))

    def __missing__(self, chunk: str) -> bytes:
        if self.LATIN.fullmatch(chunk):
            letters = chunk[1:] if chunk[0] == " " else chunk
            if letters.isalpha():
                value = self[chunk] = self._word(chunk if self.kept else chunk.lower())
                return value
            if letters[-1] in self.MARKS and letters[:-1].isalpha():
                value = self[chunk] = self[chunk[:-1]] + self[chunk[-1]]
                return value
        left, line, right = chunk.partition("\n")
        if left and right and not left[-1].isspace() and not right[0].isspace():
            value = self[left] + self[line] + self[right]
        elif not self.LATIN.fullmatch(chunk):
            value = self._whole(chunk)
        else:
            words = self.cut(chunk if self.kept else chunk.lower())
            value = self._word(words[0]) if len(words) == 1 else b"".join(map(self.__getitem__, words))
        self[chunk] = value
        return value

    def _word(self, word: str) -> bytes:
        if word.isascii():
            word = "Ġ" + word[1:] if word[0] == " " else word
        else:
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self._packed([t.id for t in self.model.tokenize(word)])

    def _whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        values = array(self.code, ids)
        if sys.byteorder == "big":
            values.byteswap()
        return values.tobytes()


def little_endian_32(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def texts_of(column) -> Iterable[str]:
    """The texts of an Arrow column one at a time; null is empty."""
    for value in column:
        yield value.as_py() or ""
