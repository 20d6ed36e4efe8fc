"""Fill-in-the-middle against string operations, SQL and exact round trips."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

import __spark_entry__ as entry
from eventloom.llm import piece_table, queries
from eventloom.llm.batches import point_starts, slices, text_bytes
from tests.compare import connect, difference
from tests.llm.conftest import SMALL

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def plain_version(key, text):
    """The same by string operations."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = text[:low], text[low:high], text[high:]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", low, high - low, f"<P>{a}<S>{c}<M>{b}"


TEXTS = ["", None, "a", "<P>", "x<S>y", "<", "<P", "P><P", "ß é 日本語 😀 <M", "\u0000\n", "<<S", "𝔘𝔫𝔦", "é" * 40] * 9


def test_rows_equal_string_operations(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = piece_table.restore(piece_table.fill_in_middle(df)).collect()
    assert len(found) == len(TEXTS) and {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        wanted = plain_version(r.doc_id, r.text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == wanted
        assert (r.output_sha256, r.restored_sha256, r.restored) == (sha(r.output), sha(r.text or ""), r.text or "")


def test_query_equals_sql(spark):
    name = "op11_piece_table"
    assert difference(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) is None


def test_awkward_rows(spark, awkward, nothing):
    found = piece_table.restore(piece_table.fill_in_middle(awkward)).collect()
    assert len(found) == awkward.count()
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, r.text)
        assert r.restored == (r.text or "") and r.score == "s"
    assert piece_table.restore(piece_table.fill_in_middle(nothing)).count() == 0
    # Columns named like an output are replaced, and the transformation of an output is a new one.
    again = piece_table.fill_in_middle(piece_table.fill_in_middle(awkward).drop("text"), text="output")
    assert again.columns.count("output") == 1 and again.where("form != 'plain'").count() < len(found)


@given(st.text(max_size=30), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.sampled_from(sorted(piece_table.ORDERS)))
def test_any_cuts_are_undone(text, one, other, form):
    marks = piece_table.Marks(piece_table.SENTINELS)
    data, limits = text_bytes(pa.array(["before", text, "after"]))
    starts = point_starts(data)
    first = int(np.searchsorted(starts, limits[1]))
    cuts = tuple(int(starts[first + k]) for k in sorted((one % (len(text) + 1), other % (len(text) + 1))))
    table = marks.arrange(data, int(limits[1]), cuts, int(limits[2]), form)
    output = table.bytes()
    assert table.sha256() == hashlib.sha256(output).hexdigest() and len(table.pieces) == 6
    assert table.restored(piece_table.ORDERS[form], 3).bytes() == text.encode()
    if not marks.search(text.encode()):
        assert marks.restore(memoryview(output), 0, len(output), form).bytes() == text.encode()


def test_descriptors_of_cuts():
    table = piece_table.PieceTable((memoryview(b"abcdef"),), [(0, 1, 5)])
    assert table.cut(2).pieces == [(0, 1, 3), (0, 3, 5)]
    assert table.cut(0).pieces == [(0, 1, 1), (0, 1, 5)] and table.cut(4).pieces == [(0, 1, 5), (0, 5, 5)]
    assert table.cut(1).cut(3).arranged((2, 0, 1)).bytes() == b"ebcd"
    with pytest.raises(ValueError):
        table.cut(5)


def test_sentinels_that_could_be_mistaken():
    for wrong in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "ba", "<M>"), ("aa", "b", "c"), ("<P>", "P", "<M>")):
        with pytest.raises(ValueError):
            piece_table.Marks(wrong)
    with pytest.raises(ValueError):
        piece_table.Marks(piece_table.SENTINELS).restore(memoryview(b"<P>a<M>b"), 0, 8, "psm")


def test_slices_are_bounded_by_bytes():
    texts = ["a" * 10, None, "b" * 95, "c" * 10, "", "d" * 300, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "t"])
    parts = list(slices(batch, 1, 100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(7))
    for p in parts:
        data, limits = text_bytes(p.column(1))
        assert len(data) <= 100 or p.num_rows == 1
        assert [bytes(data[a:b]).decode() for a, b in zip(limits, limits[1:])] == [t or "" for t in p.column(1).to_pylist()]
    assert list(slices(batch.slice(0, 0), 1, 100)) == []


def test_registered_rates(spark):
    counts = {r.form: r["count"] for r in queries.op11_piece_table(spark, "/root/testdata/sf0.01").groupBy("form").count().collect()}
    assert 60 < counts["plain"] < 150 and 120 < counts["spm"] < 240
