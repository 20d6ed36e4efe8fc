"""Byte-level BPE by forced boundaries: encoding to token ids and decoding back.

A pair of bytes that stands inside no token of the vocabulary can't be bridged by any merge, so the
place between them is a certain cut. Texts are cut there, and where the pre-tokenizer cuts; the
fragments are merged each on its own, those of many words in step, and their ids concatenated. The
result equals merging the whole text. The ids of the last words are remembered, a bounded number and size,
until a task ends; long fragments without a cut are merged with a heap in n log n.

Cases: null and empty texts have no ids; strings of added tokens become their ids, longest first;
repeated rows give repeated results; an empty table gives an empty one. Decoding turns bytes that
aren't UTF-8 into U+FFFD; a null id list decodes to an empty text, an unknown id is an error.
Columns named like an output are replaced, all others kept.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.batches import slices
from eventloom.llm.pieces import WordEncoder

SHORT = 48
SLICE_BYTES = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBpe:
    """A vocabulary file of byte-level BPE, with the certain cuts that follow from it.

    Without `special`, strings of added tokens are ordinary text.
    """

    def __init__(self, path: str, remembered: int = 300_000, special: bool = True):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        pre, model = stored.get("pre_tokenizer") or {}, stored["model"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or stored.get("normalizer") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = byte_letters()
        self.tokens = {i: bytes(letters[c] for c in s) for s, i in model["vocab"].items() if all(c in letters for c in s)}
        ids = {b: i for i, b in self.tokens.items()}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = model["vocab"][a], model["vocab"][b]
            self.merges[left, right] = (rank, model["vocab"][a + b])
        #: inside[a, b]: the bytes a and b stand side by side in some token.
        self.inside = np.zeros((256, 256), bool)
        for token in self.tokens.values():
            self.inside[list(token[:-1]), list(token[1:])] = True
        self.keys = np.array(sorted(self.merges, key=lambda p: p[0] << 32 | p[1]), np.int64).reshape(-1, 2)
        self.ranks = np.array([self.merges[a, b][0] for a, b in self.keys.tolist()], np.int64)
        self.made = np.zeros(len(self.merges), np.int64)
        self.made[self.ranks] = [self.merges[a, b][1] for a, b in self.keys.tolist()]
        self.keys = self.keys[:, 0] << 32 | self.keys[:, 1]
        added = {t["content"]: t["id"] for t in stored.get("added_tokens", [])}
        for s, i in added.items():
            self.tokens[i] = s.encode()
        ordered = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.places = np.cumsum(self.sizes) - self.sizes
        self.encode = WordEncoder(self.of_words, {s: i.to_bytes(4, "little") for s, i in added.items() if special}, remembered)

    def fragments(self, data: bytes, starts: np.ndarray) -> np.ndarray:
        """Begins of the fragments of words that lie end to end: where a word starts, and at certain cuts."""
        at = np.frombuffer(data, np.uint8)
        begins = np.zeros(len(at), bool)
        begins[1:] = ~self.inside[at[:-1], at[1:]]
        begins[starts] = True
        return np.flatnonzero(begins)

    def of_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word (none is empty)."""
        encoded = [w.encode("utf-8", "replace") for w in words]
        data = b"".join(encoded)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        starts = np.cumsum(sizes) - sizes
        begins = self.fragments(data, starts)
        lengths = np.diff(begins, append=len(data))
        token, fragment = self.merged(data, begins, lengths)
        word = np.searchsorted(starts, begins, side="right")[fragment] - 1
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        packed = token.astype("<u4").tobytes()
        edges = [0, *ends.tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:])]

    def merged(self, data: bytes, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all fragments in order, and the number of the fragment of each."""
        number = np.repeat(np.arange(len(begins)), lengths)
        token = np.array(self.single, np.int64)[np.frombuffer(data, np.uint8)]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for i in np.flatnonzero(lengths > SHORT).tolist():
            ids = self._long(token[begins[i] : begins[i] + lengths[i]].tolist())
            done.append((np.array(ids, np.int64), np.full(len(ids), i)))
        short = (lengths <= SHORT)[number]
        token, number = token[short], number[short]
        rank = self._rank(token, number, np.arange(len(token)))
        while len(token):
            first = np.flatnonzero(np.diff(number, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(number)))
            open_ = least < len(self.merges)
            if not open_.all():
                done.append((token[~open_], number[~open_]))
                token, number, rank, least = token[open_], number[open_], rank[open_], least[open_]
                if not len(token):
                    break
            at = np.flatnonzero(rank == least)
            at = at[np.diff(number[at], prepend=-1) != 0]  # the leftmost of each fragment
            token[at] = self.made[rank[at]]
            kept = np.ones(len(token), bool)
            kept[at + 1] = False
            moved = at - np.arange(len(at))
            token, number, rank = token[kept], number[kept], rank[kept]
            rank[moved] = self._rank(token, number, moved)
            left = moved[moved > 0] - 1
            rank[left] = self._rank(token, number, left)
        if not done:
            return token, number
        token, number = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(number, kind="stable")
        return token[order], number[order]

    def _rank(self, token: np.ndarray, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the merges of the tokens at these places with the next ones; past all ranks where there is none."""
        after = np.minimum(at + 1, len(token) - 1)
        key = token[at] << 32 | token[after]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        fits = (self.keys[found] == key) & (after > at) & (number[at] == number[after])
        return np.where(fits, self.ranks[found], len(self.merges))

    def _long(self, parts: list[int]) -> list[int]:
        merges, n = self.merges, len(parts)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(*merges[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
        heap = [(rank, i, a, b, new) for rank, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = new, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (pair := (parts[x], parts[y])) in merges:
                    rank, made = merges[pair]
                    heapq.heappush(heap, (rank, x, *pair, made))
        return [p for p, kept in zip(parts, alive) if kept]

    def decode(self, packed: bytes | None) -> str:
        """The bytes of all tokens end to end, read as UTF-8."""
        ids = np.frombuffer(packed or b"", "<u4")
        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("a token id is not in the vocabulary")
        ends = np.cumsum(sizes)
        at = np.repeat(self.places[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.bytes[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def bpe(path: str, remembered: int) -> ForcedBoundaryBpe:
    """One for each Python worker, with what it remembers."""
    return ForcedBoundaryBpe(path, remembered)


def _with_columns(df: DataFrame, outputs: dict[str, tuple[T.DataType, pa.DataType]], source: str, path: str, remembered: int, make) -> DataFrame:
    """df with columns made from another one's Python values, slices of bounded size at a time.

    A column that stays is sent once, also if it is the source.
    """
    names = {c.lower() for c in outputs}
    out_names = [c for c in df.columns if c.lower() not in names]
    place = next((i for i, c in enumerate(out_names) if c.lower() == source.lower()), len(out_names))
    rows = df.select(*[F.col(f"`{c}`") for c in out_names], *([F.col(f"`{source}`").alias("source_of_bpe")] if place == len(out_names) else []))
    n = len(out_names)
    schema = T.StructType([*rows.schema.fields[:n], *[T.StructField(c, kind) for c, (kind, _) in outputs.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, remembered)
        try:
            for batch in batches:
                for part in slices(batch, place, SLICE_BYTES):
                    made = make(model, part.column(place).to_pylist())
                    columns = [pa.array(c, kind) for c, (_, kind) in zip(made, outputs.values())]
                    yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=schema.names)
        finally:
            model.encode.forget()  # the worker may wait long for its next task, beside others

    return rows.mapInArrow(run, schema)


def encode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", remembered: int = 300_000, decoded: str | None = None
) -> DataFrame:
    """Add the token ids of a text column, packed as little-endian unsigned 32-bit integers.

    `path` is a tokenizer file that the executors can open; `remembered` bounds what a worker keeps.
    With `decoded`, a column of that name has the text that the ids stand for, found in the same pass.
    """

    def make(model: ForcedBoundaryBpe, texts: list[str | None]) -> list[list]:
        packed = model.encode(texts)
        return [packed, list(map(model.decode, packed))] if decoded else [packed]

    outputs = {ids: (T.BinaryType(), pa.binary())} | ({decoded: (T.StringType(), pa.string())} if decoded else {})
    return _with_columns(df, outputs, text, path, remembered, make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded", remembered: int = 300_000) -> DataFrame:
    """Add the text that packed token ids stand for, special tokens included."""
    return _with_columns(df, {text: (T.StringType(), pa.string())}, ids, path, remembered, lambda model, rows: [list(map(model.decode, rows))])


def as_array(ids: str = "ids") -> F.Column:
    """Packed ids as an array of integers, for readers that want one."""
    digits = F.hex(F.col(ids))
    count = (F.length(F.col(ids)) / 4).cast("int")
    at = lambda i, k: F.substring(digits, i * 8 + 2 * k + 1, F.lit(2))
    number = lambda i: F.conv(F.concat(at(i, 3), at(i, 2), at(i, 1), at(i, 0)), 16, 10).cast("long")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), number)).otherwise(F.array().cast("array<bigint>"))
