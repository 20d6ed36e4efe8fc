"""Alignment of two tokenizers over the same texts, by pointer jumping.

Both tokenizers cut the bytes of a space and the text. Every token of either points to its
farthest-right overlapping token; doubling the pointers of all tokens of a block of texts at once
leads each to the last token of its component, where tokens of both sides end together. That
terminal labels the group. The last tokens of a group, one of each side, are a link.

`align` is one pass without a shuffle. It works on blocks of texts of bounded size, and gives each
document its tokens, groups and links; a link is a number into its block's dictionary of id pairs, of two
bytes where the dictionary allows, and a pair that all documents have leaves a block once. `count_links` sums the dictionaries for the whole
corpus, finds for each id of the second side its most frequent partner, and brings the counts back to the
blocks that asked for them. What is shuffled is two or four bytes a link and the dictionaries, not a row a link.

Cases: a text that is null or empty, or that one of the tokenizers doesn't give back byte by byte, has
no tokens, groups or links. Strings of special tokens are ordinary text. Long texts are blocks of
their own; repeated rows count as often as they come, under any ids; an empty table gives an empty one.
Columns named like an output are replaced, all others kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.batches import slices
from eventloom.llm.bpe import ForcedBoundaryBpe

BLOCK_BYTES = 2 << 20
#: Names that `align` gives the columns of which `count_links` makes its own.
BLOCK, LINKS, DICTIONARY = "link_block", "link_numbers", "link_pairs"


class Side:
    """A tokenizer: token ids of texts, and the bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.written = [str(i) + mark for i in range(len(tokens)) for mark in ",|;"]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def spelled(self, ids: np.ndarray) -> bytes:
        """The bytes of these tokens end to end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.places[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


class BytesSide(Side):
    """A vocabulary file of byte-level BPE, asked for a space and the text."""

    def __init__(self, path: str, remembered: int):
        self.model = ForcedBoundaryBpe(path, remembered, special=False)
        super().__init__([self.model.tokens.get(i, b"") for i in range(max(self.model.tokens) + 1)])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(p, "<u4").astype(np.int64) for p in self.model.encode([" " + t for t in texts])]


class PiecesSide(Side):
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([self._spelling(i) for i in range(self.model.vocab_size())])

    def _spelling(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.model.is_byte(i) else None
        return bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=1)
def sides(a: str, b: str, remembered: int) -> tuple[Side, Side]:
    """One pair for each Python worker."""
    return BytesSide(a, remembered), PiecesSide(b)


def terminals(a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """For the tokens of a, then of b, the token of b at which their component ends, numbered in b.

    Both cover the same bytes. The farthest-right token that overlaps one is the last of the other side
    that begins before its end, or itself if that doesn't reach farther; at a common end b's is pointed to.
    """
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_next = np.searchsorted(b_end - b_sizes, a_end, side="left") - 1 + len(a_end)
    b_next = np.searchsorted(a_end - a_sizes, b_end, side="left") - 1
    if len(b_end):
        b_next = np.where(a_end[b_next] > b_end, b_next, np.arange(len(b_end)) + len(a_end))
    points = np.concatenate([a_next, b_next])
    while not np.array_equal(farther := points[points], points):
        points = farther
    return points - len(a_end)


def align_texts(a: Side, b: Side, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """By text: ids of both sides, none where a side doesn't spell the text. Then the group of each token of all texts."""
    some = [t or "" for t in texts]
    none = np.empty(0, np.int64)
    of_a, of_b = a.ids(some), b.ids(some)
    for i, text in enumerate(some):
        wanted = b" " + text.encode() if text else None
        if wanted is None or a.spelled(of_a[i]) != wanted or b.spelled(of_b[i]) != wanted:
            of_a[i] = of_b[i] = none
    all_a, all_b = np.concatenate([none, *of_a]), np.concatenate([none, *of_b])
    ends = terminals(a.sizes[all_a], b.sizes[all_b])
    last = np.zeros(len(all_b), bool)
    last[ends] = True
    group = (np.cumsum(last) - 1)[ends]
    return of_a, of_b, group[: len(all_a)], group[len(all_a) :]


def _numbers(pairs: int) -> np.dtype:
    """Of the links of a block with so many different pairs."""
    return np.dtype("<u2" if pairs <= 1 << 16 else "<u4")


def _edges(parts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, parts)])


def _digest(a: Side, b: Side, ids: tuple[np.ndarray, np.ndarray], groups: tuple[np.ndarray, np.ndarray]) -> str:
    """Hash of a1,a2|b1;a3|b2,b3: ids by group, those of a first."""
    if not len(ids[0]):
        return ""
    order = np.argsort(np.concatenate([groups[0] * 2, groups[1] * 2 + 1]), kind="stable")
    after = [np.append(np.diff(g) > 0, True) for g in groups]  # whether a token is its group's last
    spelled = [side.written for side in (a, b)]
    words = [*map(spelled[0].__getitem__, (ids[0] * 3 + after[0]).tolist()), *map(spelled[1].__getitem__, (ids[1] * 3 + 2 * after[1]).tolist())]
    return hashlib.sha256("".join(map(words.__getitem__, order.tolist()))[:-1].encode()).hexdigest()


def align(
    df: DataFrame,
    a: str,
    b: str,
    text: str = "text",
    groups: bool = True,
    remembered: int = 200_000,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add n_a, n_b, n_groups, groups_sha256, with `groups` the ids of each group, and what `count_links` needs.

    a: place of a byte-level BPE file, b: of a sentencepiece model; the executors open both.
    """
    ids = T.ArrayType(T.IntegerType())
    outputs: dict[str, tuple[T.DataType, pa.DataType]] = {
        "n_a": (T.LongType(), pa.int64()),
        "n_b": (T.LongType(), pa.int64()),
        "n_groups": (T.LongType(), pa.int64()),
        "groups_sha256": (T.StringType(), pa.string()),
        BLOCK: (T.LongType(), pa.int64()),
        LINKS: (T.BinaryType(), pa.binary()),
        DICTIONARY: (T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])), pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))),
    }
    if groups:
        listed = pa.list_(pa.int32())
        outputs["groups"] = (T.ArrayType(T.StructType([T.StructField("a", ids), T.StructField("b", ids)])), pa.list_(pa.struct([("a", listed), ("b", listed)])))
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in outputs], F.col(f"`{text}`").alias("source_of_groups"))
    n = len(rows.columns) - 1
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, kind) for c, (kind, _) in outputs.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, n, block_bytes):
                made = _block(*sides(a, b, remembered), part.column(n).to_pylist(), block, groups)
                columns = [pa.array(made[c], kind) for c, (_, kind) in outputs.items()]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=schema.names)
                block += 1

    return rows.mapInArrow(run, schema)


def _block(a: Side, b: Side, texts: list[str | None], block: int, groups: bool) -> dict[str, list]:
    of_a, of_b, group_a, group_b = align_texts(a, b, texts)
    edges_a, edges_b = _edges(of_a), _edges(of_b)
    last_a, last_b = (np.flatnonzero(np.append(np.diff(g) > 0, True)[: len(g)]) for g in (group_a, group_b))
    pairs = np.concatenate([*of_a, edges_a[:0]])[last_a] << 32 | np.concatenate([*of_b, edges_b[:0]])[last_b]
    known, number, count = np.unique(pairs, return_inverse=True, return_counts=True)
    packed, links = number.astype(_numbers(len(known))), np.searchsorted(last_b, edges_b)
    own = [((group_a[i:j], group_b[k:m])) for i, j, k, m in zip(edges_a, edges_a[1:], edges_b, edges_b[1:])]
    made: dict[str, list] = {
        "n_a": list(map(len, of_a)),
        "n_b": list(map(len, of_b)),
        "n_groups": np.diff(links).tolist(),
        "groups_sha256": [_digest(a, b, ids, g) for ids, g in zip(zip(of_a, of_b), own)],
        BLOCK: [block] * len(texts),
        LINKS: [packed[i:j].tobytes() for i, j in zip(links, links[1:])],
        DICTIONARY: [None] * len(texts),
    }
    made[DICTIONARY][0] = [{"pair": p, "n": c} for p, c in zip(known.tolist(), count.tolist())]
    if groups:
        split = lambda ids, g: [x.tolist() for x in np.split(ids, np.flatnonzero(np.diff(g)) + 1)] if len(ids) else []
        made["groups"] = [[{"a": x, "b": y} for x, y in zip(split(i, g), split(j, h))] for i, j, (g, h) in zip(of_a, of_b, own)]
    return made


def link_counts(aligned: DataFrame) -> DataFrame:
    """Corpus-wide counts of id pairs: a_id, b_id, n, and whether no other partner of the b id has more."""
    listed = aligned.where(F.col(DICTIONARY).isNotNull()).select(F.inline(DICTIONARY))
    counts = listed.groupBy("pair").agg(F.sum("n").alias("n"))
    low = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(low.alias("b_id")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("b_id", low).join(most, "b_id")
    return counts.select("pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def count_links(aligned: DataFrame) -> DataFrame:
    """For rows of `align` that were written: n_links, n_best and count_sum in place of the columns it needs.

    n_best counts the links whose pair is the most frequent one of its b id, count_sum adds their counts.
    """
    rows = aligned.drop("n_links", "n_best", "count_sum")
    listed = rows.where(F.col(DICTIONARY).isNotNull()).select(F.col(BLOCK), F.posexplode(DICTIONARY).alias("place", "entry"))
    wanted = listed.select(F.col(BLOCK).alias("block"), "place", F.col("entry.pair").alias("pair"))
    found = wanted.join(link_counts(aligned).select("pair", "n", "best"), "pair").select("block", "place", "n", "best")
    rows = rows.drop(DICTIONARY)
    kept = [f for f in rows.schema.fields if f.name not in (BLOCK, LINKS)]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]])

    def total(of: pa.Table, counted: pa.Table) -> pa.Table:
        counts, best = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, np.int64)
        place = counted.column("place").to_numpy()
        counts[place] = counted.column("n").to_numpy()
        best[place] = counted.column("best").to_numpy().astype(np.int64)
        links = of.column(LINKS).to_pylist()
        kind = _numbers(counted.num_rows)
        numbers = np.frombuffer(b"".join(links), kind)
        edges = np.cumsum([0, *map(len, links)]) // kind.itemsize
        made = [pa.array(np.diff(edges))]
        for values in (best, counts):
            made.append(pa.array(np.diff(np.append(0, np.cumsum(values[numbers]))[edges])))
        return pa.table([*[of.column(f.name) for f in kept], *made], names=schema.names)

    return rows.groupBy(BLOCK).cogroup(found.groupBy("block")).applyInArrow(total, schema)
