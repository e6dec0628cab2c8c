"""Token ids of texts by a public tokenizer file, fast where words repeat.

The tokenizers library does all byte-pair merging. For the usual normaliser (NFC, white space, lower case) and word
splitter, ids depend on each blank-separated word alone; words are then looked up, and only new ones are merged. A text
with any character outside Latin letters and printable ASCII, or with a special token's string, goes to the library
whole, so the ids are always the library's.
"""

from __future__ import annotations

from array import array

import regex
from tokenizers import Tokenizer

from .common import take_over

#: Fixed value: the word pattern this fast path stands for; another one in the file turns the fast path off.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
UNUSUAL = regex.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e\xa0-ɏ]")
END = 1
_LOADED: dict[str, WordTokenizer] = {}


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


class _Words(dict):
    """Ids of a lower-cased word as little-endian 16-bit numbers; at most ``most`` words are remembered."""

    def __init__(self, model, most: int = 600_000):
        self.model, self.most, self.letters = model, most, byte_letters()
        self.split = regex.compile(PATTERN).findall

    def merge(self, piece: str) -> list[int]:
        if not (piece.isascii() and piece.isalnum()):
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(piece)]

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            out = array("H", self.merge(word)).tobytes()
        elif len(word) > 1 and word[-1] in ".," and (stem := word[:-1]).isalpha() and stem.isascii():
            out = self[stem] + array("H", self.merge(word[-1])).tobytes()
        else:
            out = array("H", [i for piece in self.split(word) for i in self.merge(piece)]).tobytes()
        if len(self) >= self.most:
            self.clear()
        self[word] = out
        return out


class WordTokenizer:
    """Ids of whole texts; ``encode`` gives little-endian unsigned 16-bit ids, the end id last."""

    def __init__(self, path: str, end: int = END):
        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 65536:
            raise ValueError("ids must fit 16 bits")
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [s.get("pattern", {}).get("Regex") for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.fast = kinds == ["NFC", "Replace", "Lowercase"] and splits[:1] == [PATTERN] and spec["model"].get("end_of_word_suffix") == "</w>"
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.words = _Words(self.library.model)
        self.end = array("H", [end]).tobytes()

    @classmethod
    def load(cls, path: str) -> WordTokenizer:
        """One tokenizer for a Python worker's life, so that later tasks find the words of earlier ones."""
        take_over(_LOADED.clear)
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.fast and not UNUSUAL.search(text) and not any(s in text for s in self.special):
            return b"".join(map(self.words.__getitem__, text.lower().split())) + self.end
        return array("H", self.library.encode(text, add_special_tokens=False).ids).tobytes() + self.end
