"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put in another order, by piece tables.

A document is a short list of descriptors (buffer, start, end) over two immutable buffers: the bytes of
the batch's texts as they arrived, and the sentinels. Cutting splits a descriptor; an arrangement
permutes descriptors; the inverse permutation restores the text. No text is copied until a result is
asked for, and hashes stream the descriptors' bytes one after the other.

`fill_in_middle` draws the cuts and the form from a hash of the row's key, so that repeated runs and
lost executors give the same rows. `restore` rebuilds the text from output and form alone: sentinels are found
in the output, which holds each once, and mark its descriptors.

Cases: a null or empty text, and one that contains a sentinel, is plain: the output is the text, the
character counts are null. A null key hashes like an empty one. Texts of any length are one row;
repeated rows give repeated results; an empty table gives an empty one. Columns named like an output are
replaced, all others kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.batches import point_starts, slices, text_bytes

# The sentinels before prefix, suffix and middle, and the forms' orders.
SENTINELS = ("<P>", "<S>", "<M>")
PREFIX, MIDDLE, SUFFIX, BEFORE_PREFIX, BEFORE_SUFFIX, BEFORE_MIDDLE = range(6)
ORDERS = {
    "psm": (BEFORE_PREFIX, PREFIX, BEFORE_SUFFIX, SUFFIX, BEFORE_MIDDLE, MIDDLE),
    "spm": (BEFORE_SUFFIX, SUFFIX, BEFORE_PREFIX, PREFIX, BEFORE_MIDDLE, MIDDLE),
}
PLAIN = "plain"
TEXT, MARKS = 0, 1

SLICE_BYTES = 4 << 20


class PieceTable:
    """Descriptors over immutable buffers; every change makes a new list of them."""

    def __init__(self, buffers: tuple[memoryview, ...], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, at: int) -> PieceTable:
        """Split the descriptor that holds byte `at` of the sequence; at its limits one half is empty."""
        made, passed = list(self.pieces), 0
        for i, (buffer, start, end) in enumerate(made):
            if at <= passed + end - start:
                made[i : i + 1] = [(buffer, start, start + at - passed), (buffer, start + at - passed, end)]
                return PieceTable(self.buffers, made)
            passed += end - start
        raise ValueError("a cut beyond the end")

    def joined(self, pieces: list[tuple[int, int, int]]) -> PieceTable:
        return PieceTable(self.buffers, self.pieces + pieces)

    def arranged(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def restored(self, order: tuple[int, ...], first: int) -> PieceTable:
        """Undo `arranged(order)`, and keep the first so many descriptors."""
        inverse = np.argsort(order)
        return PieceTable(self.buffers, [self.pieces[i] for i in inverse[:first]])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.stream())


class Marks:
    """The sentinels as one buffer, and where they are in it."""

    def __init__(self, sentinels: tuple[str, str, str]):
        self.each = [s.encode() for s in sentinels]
        for a, b in permutations([*self.each, *self.each], 2):
            if not a or a is not b and a in b or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError("sentinels must not be empty, contain or overlap one another")
        self.buffer = memoryview(b"".join(self.each))
        limits = np.cumsum([0, *map(len, self.each)]).tolist()
        self.pieces = [(MARKS, a, b) for a, b in zip(limits, limits[1:])]

        self.search = re.compile(b"|".join(map(re.escape, self.each))).search

    def arrange(self, data: memoryview, start: int, cuts: tuple[int, int], end: int, form: str) -> PieceTable:
        """A text given by its place in `data`, cut at two places and put in the order of the form."""
        table = PieceTable((data, self.buffer), [(TEXT, start, end)])
        if form == PLAIN:
            return table
        return table.cut(cuts[0] - start).cut(cuts[1] - start).joined(self.pieces).arranged(ORDERS[form])

    def restore(self, data: memoryview, start: int, end: int, form: str | None) -> PieceTable:
        """The text of an output: cut before and after each sentinel, then the inverse order."""
        table = PieceTable((data, self.buffer), [(TEXT, start, end)])
        if form is None or form == PLAIN:
            return table
        place = start
        for mark in (self.each[at - BEFORE_PREFIX] for at in ORDERS[form] if at >= BEFORE_PREFIX):
            found = self.search(data, place, end)
            if found is None or found[0] != mark:
                raise ValueError(f"an output of form {form} lacks a sentinel")
            place = found.end()
            table = table.cut(found.start() - start).cut(place - start)
        # Before the first sentinel lies an empty descriptor; the others are in the form's order.
        return PieceTable(table.buffers, table.pieces[1:]).restored(ORDERS[form], 3)


def draws(key: str, seed: int) -> F.Column:
    """Four unsigned 32-bit numbers from the hash of seed and key, as an array."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def _mapped(df: DataFrame, inputs: list[F.Column], outputs: dict[str, tuple[T.DataType, pa.DataType]], make) -> DataFrame:
    """df with columns that `make` computes from slices of the input columns, the first of which is a text."""
    names = {c.lower() for c in outputs}
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names], *inputs)
    n = len(rows.columns) - len(inputs)
    schema = T.StructType([*rows.schema.fields[:n], *[T.StructField(c, kind) for c, (kind, _) in outputs.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, n, SLICE_BYTES):
                made = make(*part.columns[n:])
                columns = [pa.array(c, kind) for c, (_, kind) in zip(made, outputs.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def fill_in_middle(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: int = 1,
    percent: int = 90,
    suffix_first: int = 20,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Add n (code points), form (plain, psm or spm), prefix_chars, middle_chars, output and output_sha256.

    `percent` of the texts are rearranged, `suffix_first` percent of those with the suffix first.
    """
    marks = Marks(sentinels)
    outputs = {
        "n": (T.LongType(), pa.int64()),
        "form": (T.StringType(), pa.string()),
        "prefix_chars": (T.LongType(), pa.int64()),
        "middle_chars": (T.LongType(), pa.int64()),
        "output": (T.StringType(), pa.string()),
        "output_sha256": (T.StringType(), pa.string()),
    }

    def make(texts: pa.Array, drawn: pa.Array) -> list[list]:
        data, limits = text_bytes(texts)
        starts = point_starts(data)
        first = np.searchsorted(starts, limits)
        sizes = np.diff(first)
        h = drawn.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
        cuts = np.sort(h[:, :2] % (sizes[:, None] + 1), axis=1)
        places = starts[first[:-1, None] + cuts].tolist()
        rows: list[list] = [[] for _ in outputs]
        for i, (start, end) in enumerate(zip(limits.tolist(), limits[1:].tolist())):
            plain = start == end or h[i, 2] % 100 >= percent or marks.search(data, start, end) is not None
            form = PLAIN if plain else "spm" if h[i, 3] % 100 < suffix_first else "psm"
            table = marks.arrange(data, start, places[i], end, form)
            low, high = cuts[i].tolist()
            counts = (None, None) if plain else (low, high - low)
            for row, value in zip(rows, (int(sizes[i]), form, *counts, table.bytes(), table.sha256())):
                row.append(value)
        return rows

    return _mapped(df, [F.col(f"`{text}`").alias("source_of_output"), draws(key, seed).alias("draws_of_output")], outputs, make)


def restore(
    df: DataFrame, output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS, texts: bool = True
) -> DataFrame:
    """Add `restored`, the text that output and form stand for, and restored_sha256; without `texts` only the hash."""
    marks = Marks(sentinels)
    outputs = {"restored": (T.StringType(), pa.string())} if texts else {}
    outputs["restored_sha256"] = (T.StringType(), pa.string())

    def make(outs: pa.Array, forms: pa.Array) -> list[list]:
        data, limits = text_bytes(outs)
        tables = [marks.restore(data, *at) for at in zip(limits.tolist(), limits[1:].tolist(), forms.to_pylist())]
        hashes = [t.sha256() for t in tables]
        return [[t.bytes() for t in tables], hashes] if texts else [hashes]

    return _mapped(df, [F.col(f"`{output}`").alias("source_of_restored"), F.col(f"`{form}`").alias("form_of_restored")], outputs, make)
