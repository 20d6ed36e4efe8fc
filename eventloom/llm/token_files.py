"""Token ids in Arrow's file format: batches of fixed-size lists, for zero-copy random access.

Documents are laid end to end in ascending order of their id, each with an end id behind it, and cut
into sequences of equal length; only the last sequence of a file is filled up, which its mask shows.
A sequence is found by its number alone: batch and row follow from it by division, and memory-mapped
columns are used where they lie. Beside each file lies an index with the id and number of tokens of
each document. `write_token_files` sorts and writes with as many tasks as the cluster has partitions;
each task names its files by chance and only those of the tasks that ended are listed, so a task that
is lost or runs twice leaves no wrong rows.

Cases: null and empty texts have the end id alone; rows with the same id are ordered by their text;
null ids come first; an empty table makes no file. Only the two columns named are read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.files import make_folder, open_input, open_output
from eventloom.llm.pieces import WordEncoder
from eventloom.llm.workspace import written

SEQUENCE = 2048
ROWS = 64
#: Words that the library is asked for at once, and the space as byte-level tokens write it.
TOGETHER = 64
SPACE = "Ġ"
INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
LISTED = "path string, index string, low long, documents long, tokens long"


class LibraryEncoder:
    """The tokenizers library, asked once for each word that isn't remembered.

    A byte-level pre-tokenizer cuts texts into words that the model encodes independently, so words
    are cut here and the library encodes those that are new. Texts for tokenizers of any other kind
    are encoded whole.
    """

    def __init__(self, path: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        stored = json.loads(self.tokenizer.to_str())
        pre, added = stored.get("pre_tokenizer") or {}, stored.get("added_tokens", [])
        by_word = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if by_word and not stored.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            special = {t["content"]: np.array([t["id"]], self.kind).tobytes() for t in added}
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.spaced = np.zeros(max(self.tokenizer.get_vocab().values(), default=-1) + 1, bool)
            self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
            self.together = 1 if any(" " in t for t in special) else TOGETHER
            self.encode = WordEncoder(self.ask_words, special, remembered)
        else:
            self.encode = lambda texts: self.ask([t or "" for t in texts])

    def ask(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def ask_words(self, new: list[str]) -> list[bytes]:
        """Ids of words that differ. Those of letters behind a space are asked many at a time, end to end, as a text
        costs the library as much again as its words; there a word begins at each token that begins with the space."""
        behind = [w for w in new if w[0] == " " and w[1:].isalpha()] if self.together > 1 else []
        groups = [behind[at : at + self.together] for at in range(0, len(behind), self.together)]
        made: dict[str, bytes] = {}
        for group, packed in zip(groups, self.ask(["".join(g) for g in groups])):
            starts = np.flatnonzero(self.spaced[np.frombuffer(packed, self.kind)]) * self.kind.itemsize
            if len(starts) == len(group):  # else there are words without a token for the space
                made.update(zip(group, map(packed.__getitem__, map(slice, starts.tolist(), [*starts[1:].tolist(), len(packed)]))))
        alone = [w for w in new if w not in made]
        made.update(zip(alone, self.ask(alone)))
        return [made[w] for w in new]


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int) -> LibraryEncoder:
    return LibraryEncoder(path, remembered)


class SequenceWriter:
    """Packs ids into the sequences of one file."""

    def __init__(self, folder: str, kind: np.dtype, length: int):
        self.length, self.kind = length, kind
        self.path, self.index = (f"{folder}/{uuid.uuid4().hex}{end}.arrow" for end in ("", "-index"))
        ids, mask = pa.list_(pa.from_numpy_dtype(kind), length), pa.list_(pa.bool_(), length)
        self.schema = pa.schema([("input_ids", ids), ("mask", mask)])
        self.files = open_output(self.path), open_output(self.index)
        self.out, self.docs = pa.ipc.new_file(self.files[0], self.schema), pa.ipc.new_file(self.files[1], INDEX)
        self.waiting: list[bytes] = []
        self.bytes = self.tokens = self.documents = 0

    def add(self, doc_ids: list, packed: list[bytes]) -> None:
        counts = [len(p) // self.kind.itemsize for p in packed]
        self.docs.write_batch(pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64())], schema=INDEX))
        self.documents += len(doc_ids)
        self.tokens += sum(counts)
        self.waiting += packed
        self.bytes += sum(map(len, packed))
        full = self.length * ROWS * self.kind.itemsize
        if self.bytes >= full:
            data = b"".join(self.waiting)
            end = len(data) - len(data) % full
            for at in range(0, end, full):
                self._write(np.frombuffer(data, self.kind, self.length * ROWS, at), self.length * ROWS)
            self.waiting, self.bytes = [data[end:]], len(data) - end

    def _write(self, ids: np.ndarray, valid: int) -> None:
        mask = pa.array(np.arange(len(ids)) < valid)
        arrays = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(ids), mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.waiting), self.kind)
        if len(rest):
            self._write(np.pad(rest, (0, -len(rest) % self.length)), len(rest))
        for x in (self.out, self.docs, *self.files):
            x.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = SEQUENCE,
    remembered: int = 800_000,
) -> DataFrame:
    """Encode all documents into files below `folder`; returns the list of files, a written table.

    The list has path, index, low (smallest document id), documents and tokens of each file.
    """
    make_folder(folder)
    rows = (
        docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer, remembered)
        end = np.array([end_id], library.kind).tobytes()
        files, low = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column(0).to_pylist()
                if files is None:
                    files, low = SequenceWriter(folder, library.kind, length), ids[0]
                files.add(ids, [packed + end for packed in library.encode(part.column(1).to_pylist())])
        if files is not None:
            files.close()
            row = {"path": [files.path], "index": [files.index], "low": [low], "documents": [files.documents], "tokens": [files.tokens]}
            kinds = [("path", pa.string()), ("index", pa.string()), ("low", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64())]
            yield pa.RecordBatch.from_pydict(row, pa.schema(kinds))

    return written(rows.mapInArrow(write, LISTED), "token-files")


def sequences(path: str, numbers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and mask of some sequences of a file, by number; ids lie in the mapped file itself."""
    file = pa.ipc.open_file(open_input(path))
    out = []
    for n in numbers:
        batch = file.get_batch(n // ROWS)
        ids, mask = batch.column(0), batch.column(1)
        k = n % ROWS
        out.append((ids[k].values.to_numpy(zero_copy_only=True), mask[k].values.to_numpy(zero_copy_only=False)))
    return out


def documents_of(path: str, index: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id and tokens of each document of a file, one batch of sequences at a time."""
    file = pa.ipc.open_file(open_input(path))

    def runs() -> Iterator[np.ndarray]:
        for k in range(file.num_record_batches):
            batch = file.get_batch(k)
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            yield ids[batch.column(1).flatten().to_numpy(zero_copy_only=False)]

    more, rest = runs(), np.empty(0, np.uint16)
    docs = pa.ipc.open_file(open_input(index))
    for k in range(docs.num_record_batches):
        batch = docs.get_batch(k)
        for doc_id, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts, have = [rest], len(rest)
            while have < n:
                parts.append(next(more))
                have += len(parts[-1])
            whole = np.concatenate(parts) if len(parts) > 1 else rest
            yield doc_id, whole[:n]
            rest = whole[n:]


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the listed files: doc_id, start, n_tokens, ids_crc32, read from the files.

    `start` counts the ids of all documents before; the sums over files are taken from their list,
    which has one row for each file and is the only thing the driver sees.
    """
    spark = files.sparkSession
    listed = sorted(files.collect(), key=lambda r: (r["low"] is not None, r["low"] or 0))
    starts, at = [], 0
    for r in listed:
        starts.append((r["path"], r["index"], at))
        at += r["tokens"]
    parts = spark.createDataFrame(starts, "path string, index string, start long").repartition(max(1, len(starts)))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, rows = row["start"], []
                for doc_id, ids in documents_of(row["path"], row["index"]):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), fields)], schema=pa.schema(fields))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), fields)], schema=pa.schema(fields))

    return parts.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
