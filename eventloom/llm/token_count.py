"""Token counts for a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton finds every vocabulary entry that ends at each place of a word; dynamic
programming over places carries the best score and the number of pieces of the best path, no back
pointers. The tokenizer's rules decide: a later start replaces an earlier one only with a strictly
better score (so of equal paths the one with the longest last piece stays), a character that is no
entry by itself scores ten below the lowest entry and becomes the byte pieces of its UTF-8 form
or, without those in the vocabulary, one unknown piece for each run of such characters.
Words begin at each space, which is written U+2581; no piece crosses a word's begin, so the words of
a text are counted apart, and the counts of the last `remembered` different words are kept.

Cases: null and empty texts have no tokens; a text of spaces has the pieces of its spaces. Repeated
rows give repeated counts, an empty table an empty one. A column named like the count is replaced,
all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.pieces import Memo

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class ViterbiCounter:
    """Counts the pieces of a word's best segmentation."""

    def __init__(self, vocabulary: list[tuple[str, float]], remembered: int = 600_000):
        self.automaton = ahocorasick.Automaton()
        self.characters = {piece for piece, _ in vocabulary if len(piece) == 1}
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in vocabulary), default=0.0) - UNKNOWN_PENALTY
        pieces = {piece for piece, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.word = Memo(self.count_word, remembered)

    def count_word(self, word: str) -> int:
        n = len(word)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        if self.characters.issuperset(word):
            for end, (length, score) in self.automaton.iter(word):  # by end, the longest first
                start = end + 1 - length
                if best[start] + score > best[end + 1]:
                    best[end + 1], count[end + 1] = best[start] + score, count[start] + 1
            return count[n]
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, found in self.automaton.iter(word):
            matches[end + 1].append(found)
        after_unknown = [False] * (n + 1)
        for end in range(1, n + 1):
            for length, score in matches[end]:
                if best[end - length] + score > best[end]:
                    best[end], count[end] = best[end - length] + score, count[end - length] + 1
            letter = word[end - 1]
            if letter not in self.characters and best[end - 1] + self.unknown > best[end]:
                best[end], after_unknown[end] = best[end - 1] + self.unknown, True
                if self.bytes:
                    count[end] = count[end - 1] + len(letter.encode("utf-8", "replace"))
                else:
                    count[end] = count[end - 1] + (not after_unknown[end - 1])
        return count[n]

    def count(self, text: str | None) -> int:
        """A text begins with a space of its own, unless it has one."""
        if not text:
            return 0
        first, *rest = text.replace(SPACE, " ").removeprefix(" ").split(" ")
        return sum(map(self.word.__getitem__, [SPACE + first, *[SPACE + word for word in rest]]))


@lru_cache(maxsize=2)
def counter(path: str, remembered: int) -> ViterbiCounter:
    return ViterbiCounter(read_vocabulary(path), remembered)


def count_tokens(
    df: DataFrame, path: str, text: str = "text", count: str = "n_tokens", remembered: int = 600_000
) -> DataFrame:
    """Add the number of tokens of a text column. `path`: a sentencepiece file that the executors can open."""
    kept = [c for c in df.columns if c.lower() != count.lower()]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("source_of_" + count))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(count, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = counter(path, remembered)
        for batch in batches:
            counts = pa.array(map(mine.count, batch.column(batch.num_columns - 1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], names=schema.names)

    return rows.mapInArrow(run, schema)
