"""Benchmark decontamination: n-gram seeds, rare ones first, then Smith-Waterman alignment of words.

Texts are read as words of Unicode letters, marks and digits, lower-cased; a letter of a script without
spaces is a word, and every other character separates. For every n-gram of the benchmark items,
the documents that hold it are counted over all documents. Each document that holds an n-gram of an
item is a candidate for it. Around a rare n-gram (in at most `common` of all documents) the two are
aligned at once. Around more frequent ones, which may be an item that very many documents hold or
mere common words, they are aligned unless `most` shows that no alignment there can reach `least`; that
bound is never too low, so no pair is lost by frequency. Matches score 2, other words and gaps -1. The
share of the best possible score is the pair's score; pairs from `least` on are returned. A document
that has no n words in a row with an item is no candidate for it.

The benchmark is taken in blocks of at most `block` n-grams, each sent to all executors; documents
are scanned per block and never shuffled. Only seed counts are (bounded by the block).

Cases: null and empty documents and items match nothing, as do items of fewer than n words unless
a document holds all their words in a row (they are one n-gram). Repeated rows give repeated pairs.
Null ids are carried. An empty table on either side gives no pairs. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.shingles import blocks, letter_words, mix
from eventloom.llm.workspace import written

PAIRS = "doc_id long, item_id long, score double, matched int, first_word long, last_word long"


def gram_hashes(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Like shingles, without the rule for short texts."""
    from eventloom.llm.shingles import shingle

    return shingle(words, rows, n)


@dataclass
class Items:
    """A block of benchmark items: words end to end, and each distinct n-gram's owners."""

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray  # sorted, one row for each (gram, item, place)
    item: np.ndarray
    place: np.ndarray


def read_items(rows: list[tuple], n: int) -> Items:
    ids = [i for i, _ in rows]
    words = []
    for _, text in rows:
        [(_, _, data, limits)] = blocks(_lowered(pa.array([text or ""])))
        words.append(letter_words(data, limits)[0])
    grams, item, place = [], [], []
    for k, own in enumerate(words):
        size = min(n, len(own))
        value, at = gram_hashes(own, np.zeros(len(own), np.int64), size) if size else (own, np.empty(0, np.int64))
        grams.append(value), item.append(np.full(len(value), k)), place.append(at)
    if not grams:
        return Items([], [], np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    value, owner, at = (np.concatenate(x) for x in (grams, item, place))
    order = np.argsort(value, kind="stable")
    return Items(ids, words, value[order], owner[order], at[order])


def _sizes(items: Items, n: int) -> list[int]:
    return sorted({min(n, len(w)) for w in items.words if len(w)})


def _found(data: np.ndarray, limits: np.ndarray, known: np.ndarray, sizes: list[int]):
    """Words and rows of some texts, and (index in known, place of the first word) of every known n-gram."""
    words, rows = letter_words(data, limits)
    which, place = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size in sizes:
        value, at = gram_hashes(words, rows, size)
        i = np.minimum(np.searchsorted(known, value), len(known) - 1)
        hit = known[i] == value
        which.append(i[hit]), place.append(at[hit])
    return words, rows, np.concatenate(which), np.concatenate(place)


def align(query: np.ndarray, window: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, matched words, and first and last word of the window in it.

    Rows are computed at once: a gap in the window costs 1 a word, so the best gap that ends at a
    place is a running maximum of score plus place.
    """
    n, place = len(window), np.arange(len(window) + 1)
    rows = np.zeros((len(query) + 1, n + 1), np.int64)
    for i, word in enumerate(query):
        last = rows[i]
        here = np.maximum(last - 1, 0)
        here[1:] = np.maximum(here[1:], last[:-1] + np.where(window == word, 2, -1))
        rows[i + 1] = np.maximum.accumulate(here + place) - place
    i, j = np.unravel_index(np.argmax(rows), rows.shape)
    top, end, matched, start = int(rows[i, j]), int(j) - 1, 0, int(j)
    while i and j and rows[i, j]:
        same = query[i - 1] == window[j - 1]
        if rows[i, j] == rows[i - 1, j - 1] + (2 if same else -1):
            matched += bool(same)
            i, j = i - 1, j - 1
            start = int(j)
        elif rows[i, j] == rows[i - 1, j] - 1:
            i -= 1
        else:
            j -= 1
            start = int(j)
    return top, matched, start, end


def _lowered(texts: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.utf8_lower(texts)


def most(query: np.ndarray, window: np.ndarray) -> int:
    """No local alignment scores more: each word of the window that the query has as a match, every other one as a loss."""
    known = np.isin(window, query)
    total = np.concatenate([[0], np.cumsum(np.where(known, 2, -1))])
    best = int((total - np.minimum.accumulate(total)).max())
    return min(best, 2 * int(np.isin(query, window[known]).sum())) if best else 0


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 3,
    least: float = 0.5,
    common: float = 0.0002,
    block: int = 2_000_000,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of documents and benchmark items with an alignment score of `least` or more."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    out = None
    for rows in _item_blocks(items, block):
        found = _against(docs, read_items(rows, n), n, least, common)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], PAIRS) if out is None else out


def _item_blocks(items: DataFrame, block: int) -> Iterator[list[tuple]]:
    """The items with words, in lists of at most `block` characters (or one item); one list is in memory at a time."""
    rows, size = [], 0
    for r in items.where(F.col("text").rlike(r"[^\s]")).orderBy("item_id", "text").toLocalIterator():
        if rows and size + len(r["text"]) > block:
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if rows:
        yield rows


def _against(docs: DataFrame, items: Items, n: int, least: float, common: float) -> DataFrame:
    spark, sizes = docs.sparkSession, _sizes(items, n)
    if not sizes:
        return spark.createDataFrame([], PAIRS)
    known = np.unique(items.grams)
    sent = spark.sparkContext.broadcast((known, sizes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sizes = sent.value
        total, documents = np.zeros(len(known), np.int64), 0
        for batch in batches:
            documents += batch.num_rows
            for _, _, data, limits in blocks(_lowered(batch.column(1))):
                _, rows, which, place = _found(data, limits, known, sizes)
                pairs = np.unique(which * np.int64(len(limits)) + rows[place])
                total += np.bincount(pairs // len(limits), minlength=len(known))
        seen = np.flatnonzero(total)
        which, value = np.append(seen, -1), np.append(total[seen], documents)
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int64()), pa.array(value, pa.int64())], names=["gram", "n"])

    # One row for each n-gram of the block at most, and one for the number of documents.
    counted = docs.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts, documents = np.zeros(len(known), np.int64), 0
    for r in counted:
        if r["gram"] < 0:
            documents = r["n"]
        else:
            counts[r["gram"]] = r["n"]
    pairs = np.unique(np.stack([items.grams, items.item.astype(np.uint64)]), axis=1)
    seed, first = np.unique(pairs[0], return_index=True)
    rare = counts <= common * documents  # `known` and `seed` are the same n-grams
    model = spark.sparkContext.broadcast((seed, np.append(first, pairs.shape[1]), pairs[1].astype(np.int64), rare, items, sizes))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, first, owner, rare, items, sizes = model.value
        for batch in batches:
            ids, out = batch.column(0), []
            for row, _, data, limits in blocks(_lowered(batch.column(1))):
                words, rows, which, place = _found(data, limits, seed, sizes)
                if not len(which):
                    continue
                many = first[which + 1] - first[which]
                at = np.repeat(first[which] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                item, place, sure = owner[at], np.repeat(place, many), np.repeat(rare[which], many)
                doc = rows[place]
                order = np.lexsort((place, item, doc))
                item, place, doc, sure = item[order], place[order], doc[order], sure[order]
                begins = np.searchsorted(rows, np.arange(len(limits)))
                near = np.array([2 * len(w) + 16 for w in items.words])[item]
                new = np.ones(len(item), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > near[1:])
                edges = [*np.flatnonzero(new).tolist(), len(item)]
                best: dict[tuple[int, int], tuple] = {}
                for a, b in zip(edges, edges[1:]):
                    d, k = int(doc[a]), int(item[a])
                    query = items.words[k]
                    low = max(int(begins[d]), int(place[a]) - 2 * len(query))
                    high = min(int(begins[d + 1]), int(place[b - 1]) + 2 * len(query) + 1)
                    floor = 0 if sure[a:b].any() else 2 * len(query) * least
                    for top, matched, start, end in _windows(query, words[low:high], floor):
                        share = top / (2 * len(query))
                        if share >= least and share > best.get((d, k), (0,))[0]:
                            best[d, k] = (share, matched, low + start - int(begins[d]), low + end - int(begins[d]))
                out += [(ids[row + d].as_py(), items.ids[k], *v) for (d, k), v in best.items()]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
                names = ["doc_id", "item_id", "score", "matched", "first_word", "last_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return docs.mapInArrow(score, PAIRS)


def _windows(query: np.ndarray, words: np.ndarray, floor: float = 0) -> Iterator[tuple[int, int, int, int]]:
    """Alignments in overlapping windows, so that a run of many seeds costs no more memory than one.

    Windows in which no alignment can score `floor` or more are left out.
    """
    size = max(256, 6 * len(query))
    for at in range(0, max(1, len(words) - 2 * len(query)), size - 2 * len(query)):
        window = words[at : at + size]
        if floor and most(query, window) < floor:
            continue
        top, matched, start, end = align(query, window)
        yield top, matched, at + start, at + end
