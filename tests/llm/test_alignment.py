"""Alignment of two tokenizers against the libraries and plain sets of byte offsets."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import alignment, queries
from eventloom.llm.bpe import byte_letters
from eventloom.llm.workspace import written
from tests.llm.conftest import SMALL
from tests.llm.test_tokens import PIECES

A, B = queries.vocabulary(queries.TOKENIZER), queries.vocabulary(queries.UNIGRAM)


class Plain:
    """The same with the libraries, a document at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letters = byte_letters()

    def tokens(self, text):
        if not text:
            return [], []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        of_a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in ids]
        of_b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            byte = self.b.is_byte(i)
            of_b.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
        wanted = (" " + text).encode()
        if b"".join(t for _, t in of_a) != wanted or b"".join(t for _, t in of_b) != wanted:
            return [], []
        return of_a, of_b

    def groups(self, text):
        of_a, of_b = self.tokens(text)
        ends = [np.cumsum([len(t) for _, t in side]).tolist() for side in (of_a, of_b)]
        common = sorted(set(ends[0]) & set(ends[1])) if of_a else []
        groups = [[[], []] for _ in common]
        for k, (side, e) in enumerate(zip((of_a, of_b), ends)):
            for (i, _), end in zip(side, e):
                groups[bisect.bisect_left(common, end)][k].append(i)
        return groups, [(x[-1], y[-1]) for x, y in groups]

    def rows(self, texts):
        found = [self.groups(t) for t in texts]
        counts = Counter(link for _, links in found for link in links)
        most = defaultdict(int)
        for (_, b), n in counts.items():
            most[b] = max(most[b], n)
        out = []
        for groups, links in found:
            said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append(
                (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links))
                + (sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links))
                + (hashlib.sha256(said.encode()).hexdigest() if groups else "",)
            )
        return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def fuzzed(n):
    rnd = random.Random(11)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_equals_plain_offsets(spark, plain, block_bytes):
    texts = fuzzed(300) + ["the old river"] * 40 + [None, "", " ", "a", "<|endoftext|> </s> <s>", "<0x41>", "▁a ▁ b", "x" * 5000, "日本" * 900, "a" + " " * 300 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    rows = written(alignment.align(df, A, B, block_bytes=block_bytes), "test-alignment")
    found = {r["row"]: r for r in alignment.count_links(rows).collect()}
    assert len(found) == len(texts)
    for i, wanted in enumerate(plain.rows(texts)):
        assert tuple(found[i][c] for c in COLUMNS) == wanted, (i, texts[i])
        assert [[g.a, g.b] for g in found[i].groups] == plain.groups(texts[i])[0]
    assert sum(r.n_a == 0 for r in found.values()) > 3 and max(r.n_groups for r in found.values()) > 100


def test_query_equals_plain_offsets(spark, plain):
    found = {r.doc_id: r for r in queries.op12_alignment(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    for d, wanted in zip(docs, plain.rows([d.text for d in docs])):
        assert tuple(found[d.doc_id][c] for c in COLUMNS) == wanted


def naive_terminals(a, b):
    """By components of the graph of overlaps."""
    spans = []
    for side in (a, b):
        at = 0
        for size in side:
            spans.append((at, at + size))
            at += size
    label = list(range(len(spans)))
    changed = True
    while changed:
        changed = False
        for i, (s, e) in enumerate(spans):
            for j, (t, f) in enumerate(spans):
                if s < f and t < e and label[i] != label[j]:
                    label[i] = label[j] = max(label[i], label[j])
                    changed = True
    return [x - len(a) for x in label]


def test_pointers_lead_to_the_last_token_of_each_component():
    rnd = random.Random(2)
    for _ in range(60):
        total = rnd.randint(1, 25)
        cuts = [sorted({*rnd.sample(range(1, total), rnd.randint(0, total - 1)), total}) if total > 1 else [1] for _ in range(2)]
        a, b = (np.diff([0, *c]) for c in cuts)
        assert alignment.terminals(a, b).tolist() == naive_terminals(a.tolist(), b.tolist())
    # One long chain: tokens of two, shifted by one.
    a, b = np.array([2] * 1000), np.array([1] + [2] * 999 + [1])
    assert set(alignment.terminals(a, b).tolist()) == {1000}
    assert len(alignment.terminals(np.empty(0, np.int64), np.empty(0, np.int64))) == 0


def test_awkward_rows(spark, plain, awkward, nothing):
    rows = written(alignment.align(awkward.withColumn("n_links", F.lit("mine")), A, B, groups=False), "test-alignment")
    found = alignment.count_links(rows)
    assert {*awkward.columns, *COLUMNS} == {*found.columns} and dict(found.dtypes)["n_links"] == "bigint"
    wanted = dict(zip([r["row"] for r in awkward.collect()], plain.rows([r.text for r in awkward.collect()])))
    assert {r["row"]: tuple(r[c] for c in COLUMNS) for r in found.collect()} == wanted
    assert alignment.count_links(written(alignment.align(nothing, A, B), "test-alignment")).count() == 0


def test_what_travels_by_pair_is_a_row_a_block(spark):
    df = spark.range(5000, numPartitions=2).select(F.lit("the same old text").alias("text"))
    rows = written(alignment.align(df, A, B, groups=False), "test-alignment")
    assert rows.where(F.col(alignment.DICTIONARY).isNotNull()).count() == rows.select(alignment.BLOCK).distinct().count() == 2
    assert {(r.n_best, r.count_sum) for r in alignment.count_links(rows).collect()} == {(4, 20_000)}
    assert alignment.link_counts(rows).agg(F.sum("n")).first()[0] == 20_000


def test_blocks_with_more_pairs_than_two_bytes_count(spark):
    """One block with 70,000 different pairs, whose links have four bytes each, and one with two, whose links have two."""
    assert [alignment._numbers(n).itemsize for n in (0, 1 << 16, (1 << 16) + 1)] == [2, 2, 4]
    many = [(k << 32 | k % 7000, 1) for k in range(70_000)]
    few = [(3 << 32 | 3, 2), (70_001 << 32 | 3, 1)]
    rows = [
        (1, 1, np.arange(35_000, dtype="<u4").tobytes(), many),
        (2, 1, np.arange(69_999, 34_999, -1, dtype="<u4").tobytes(), None),
        (3, 2, np.array([0, 1, 0], "<u2").tobytes(), few),
        (4, 2, b"", None),
    ]
    schema = f"row long, {alignment.BLOCK} long, {alignment.LINKS} binary, {alignment.DICTIONARY} array<struct<pair: long, n: long>>"
    found = {r["row"]: (r.n_links, r.n_best, r.count_sum) for r in alignment.count_links(spark.createDataFrame(rows, schema)).collect()}
    # Pair 3-3 has three links in all, so of the ten pairs with 3 in the second place it alone is the best.
    assert found == {1: (35_000, 35_000 - 4, 35_002), 2: (35_000, 35_000 - 5, 35_000), 3: (3, 2, 7), 4: (0, 0, 0)}
