"""Cutting texts into the words of a byte-level pre-tokenizer, and remembering what each became."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# The pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts of ASCII and Latin-1 letters only, for which the plain re module is quicker.
LATIN_PATTERN = (
    r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[!-/:-@\[-`{-~]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)

_words_of_any = regex.compile(PATTERN).findall
_words_of_latin = re.compile(LATIN_PATTERN).findall
_beyond_latin = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ]").search


def words(text: str) -> list[str]:
    """The pre-tokenizer's words; together they are the text, and no merge crosses their borders."""
    return _words_of_any(text) if _beyond_latin(text) else _words_of_latin(text)


#: Longer words are worked out each time, so that text without spaces isn't remembered whole.
LONGEST = 256
#: Characters and bytes remembered by a worker, of keys and values together.
MOST_BYTES = 32 << 20


class _Known(dict):
    """Packed ids by word. A word that is looked up and not there gets a place, and is in `new` until the place is filled."""

    def __init__(self, given: dict[str, bytes]):
        super().__init__(given)
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        self[word] = self.new[word] = place = bytearray()
        return place


class WordEncoder:
    """Packed ids of texts, put together from those of their words.

    Each word of a text is looked up once, as that is most of the work; `encode_words` is asked for the words of
    a batch that weren't remembered. When more than `remembered` words, or `most_bytes` of them and their ids, are
    there after a batch, all are forgotten, so memory is bounded by count and by size; no result depends on it.
    `special` has the packed ids of added tokens, at which texts are cut first, the longest first.
    """

    def __init__(self, encode_words: Callable[[list[str]], list[bytes]], special: dict[str, bytes], remembered: int, most_bytes: int = MOST_BYTES):
        self.encode_words, self.special, self.remembered, self.most_bytes = encode_words, special, remembered, most_bytes
        longest = sorted(map(re.escape, special), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(longest) + ")") if longest else None
        self.forget()

    def forget(self) -> None:
        self.known, self.bytes = _Known(self.special), 0

    def _parts(self, text: str) -> list[str]:
        if self.cut is None or not self.cut.search(text):
            return words(text)
        return [w for part in self.cut.split(text) for w in ([part] if part in self.special else words(part))]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        get = self.known.__getitem__
        found = [list(map(get, self._parts(t))) if t else [] for t in texts]
        if self.known.new:
            try:
                self._fill()
            except BaseException:
                self.forget()  # places without ids
                raise
        out = [b"".join(own) for own in found]
        if len(self.known) > self.remembered or self.bytes > self.most_bytes:
            self.forget()
        return out

    def _fill(self) -> None:
        """Give the new words their ids, in the places that texts hold already."""
        new = self.known.new
        made = self.encode_words(list(new))
        for (word, place), ids in zip(new.items(), made, strict=True):
            place += ids
            if len(word) > LONGEST:
                del self.known[word]
            else:
                self.known[word] = ids
                self.bytes += len(word) + len(ids)
        self.known.new = {}


class Memo(dict):
    """Results by piece, forgotten all at once when there are `most` of them or `most_bytes` characters, so that memory is bounded."""

    def __init__(self, make, most: int, most_bytes: int = MOST_BYTES):
        super().__init__()
        self.make, self.most, self.most_bytes, self.bytes = make, most, most_bytes, 0

    def __missing__(self, piece):
        made = self.make(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most or self.bytes > self.most_bytes:
                self.clear()
                self.bytes = 0
            self[piece] = made
            self.bytes += len(piece)
        return made
