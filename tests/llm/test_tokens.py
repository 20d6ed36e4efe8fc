"""Encoding, counting and files against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from eventloom.llm import bpe, queries, token_count, token_files
from eventloom.llm.pieces import LONGEST, Memo, WordEncoder, words
from eventloom.llm.workspace import new_folder

BPE, UNIGRAM = queries.vocabulary(queries.TOKENIZER), queries.vocabulary(queries.UNIGRAM)
PIECES = (
    [" ", "  ", "\n", "\t", "a", "b's", "'re", "'S", "é", "ß", "²", "½", "\x1c", "\x85", "\xa0", "\u3000", "日本", "😀"]
    + ["<|endoftext|>", "_", "__", "1", "٣", "Ⅷ", "ªº", "\x00", "can't", "!!", "hello", " the", "\u200b", "ǅ", "à ", "▁"]
)


def fuzzed(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_encoding_equals_the_library_and_decodes_back(documents):
    library, mine = Tokenizer.from_file(BPE), bpe.ForcedBoundaryBpe(BPE, remembered=500)
    texts = fuzzed(1500) + ["aaaaab" * 2000, "", None] + [r.text for r in documents.limit(40).collect()]
    for text, packed in zip(texts, mine.encode(texts)):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert mine.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_no_token_spans_a_forced_boundary():
    mine = bpe.ForcedBoundaryBpe(BPE)
    assert not mine.inside.all()
    data = "wörter ünd zéichen".encode()
    begins = mine.fragments(data, np.array([0]))
    for b in begins[1:].tolist():
        assert not any(data[b - 1 : b + 1] in token for token in mine.tokens.values())


def test_bytes_that_are_no_text_and_unknown_ids():
    mine = bpe.ForcedBoundaryBpe(BPE)
    lone = np.array([mine.single[0xC3]], "<u4").tobytes()
    assert mine.decode(lone) == "\ufffd" and mine.decode(None) == ""
    with pytest.raises((ValueError, IndexError)):
        mine.decode(np.array([60_000], "<u4").tobytes())


def test_encode_frame(spark, awkward, nothing):
    rows = bpe.decode(bpe.encode(awkward, BPE), BPE, text="again")
    assert set(awkward.columns) | {"again"} == set(rows.columns)
    assert all((r.text or "") == r.again for r in rows.collect()) and rows.count() == awkward.count()
    assert bpe.encode(nothing, BPE).count() == 0
    one = bpe.encode(awkward.where("doc_id = 9"), BPE).select(bpe.as_array().alias("a")).first().a
    assert one == Tokenizer.from_file(BPE).encode("a").ids


def test_counts_equal_the_library(documents, awkward, nothing):
    vocabulary = token_count.read_vocabulary(UNIGRAM)
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    mine = token_count.ViterbiCounter(vocabulary, remembered=300)
    for text in fuzzed(1500) + [r.text for r in documents.limit(40).collect()]:
        assert mine.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    counted = token_count.count_tokens(awkward, UNIGRAM).select("text", "n_tokens").collect()
    assert all(r.n_tokens == mine.count(r.text) for r in counted) and token_count.count_tokens(nothing, UNIGRAM).count() == 0


def test_ties_and_unknown_pieces():
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("ba", -2.0)]
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    mine = token_count.ViterbiCounter(vocabulary)
    rnd = random.Random(3)
    for _ in range(500):
        text = "".join(rnd.choice("ab xy") for _ in range(rnd.randint(1, 9))).strip() or "a"
        assert mine.count(text) == len(library.encode(text).ids), text


def test_files_round_trip(spark, documents):
    library = Tokenizer.from_file(BPE)
    files = token_files.write_token_files(documents, new_folder(spark, "t"), BPE, 2, length=128)
    got = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, d in zip(got, sorted(documents.collect(), key=lambda d: d.doc_id), strict=True):
        ids = np.array(library.encode(d.text or "").ids + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_sequences_are_found_by_number_and_lie_in_the_file(spark, documents):
    files = token_files.write_token_files(documents, new_folder(spark, "t"), BPE, 2, length=64).collect()
    path, index = files[0]["path"], files[0]["index"]
    whole = np.concatenate([ids for _, ids in token_files.documents_of(path, index)])
    last = (len(whole) - 1) // 64
    for number, (ids, mask) in zip((0, 1, 70, last), token_files.sequences(path, [0, 1, 70, last])):
        assert len(ids) == len(mask) == 64 and not ids.flags.owndata
        assert ids[mask].tolist() == whole[number * 64 : number * 64 + 64].tolist()


def test_files_of_awkward_rows(spark, awkward, nothing):
    files = token_files.write_token_files(awkward, new_folder(spark, "t"), BPE, 2)
    rows = token_files.read_token_files(files).collect()
    assert len(rows) == awkward.count() and sum(r.n_tokens == 1 for r in rows) == 3
    assert token_files.read_token_files(token_files.write_token_files(nothing, new_folder(spark, "t"), BPE, 2)).count() == 0


def test_what_is_remembered_is_bounded_by_size():
    unbroken = ["".join(random.Random(k).choices("abcdefgh", k=20_000)) for k in range(20)]
    mine = bpe.ForcedBoundaryBpe(BPE)
    library = Tokenizer.from_file(BPE)
    for text, packed in zip(unbroken, mine.encode(unbroken)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert mine.encode.bytes == 0 and not set(unbroken) & set(mine.encode.known)
    small = WordEncoder(mine.of_words, {}, remembered=10_000, most_bytes=300)
    texts = [" ".join(f"w{k}x{i}" for i in range(10)) for k in range(50)]
    assert [small([t])[0] for t in texts] == mine.encode(texts)
    assert small.bytes < 600 and small.bytes == sum(len(k) + len(v) for k, v in small.known.items())
    memo = Memo(len, 1000, most_bytes=50)
    assert all(memo["x" * k] == k for k in range(400)) and sum(map(len, memo)) <= 50 + LONGEST
    assert max(map(len, memo)) <= LONGEST
    counter = token_count.ViterbiCounter(token_count.read_vocabulary(UNIGRAM), 1000)
    for text in unbroken[:2]:
        counter.count(text)
    assert len(counter.word) == 0


def test_decoding_in_the_same_pass(awkward):
    both = bpe.encode(awkward, BPE, decoded="again").collect()
    apart = bpe.decode(bpe.encode(awkward, BPE), BPE, text="again").collect()
    assert sorted(map(repr, both)) == sorted(map(repr, apart)) and all(r.again == (r.text or "") for r in both)


def test_a_known_word_is_looked_up_once(monkeypatch):
    class Counted(str):
        hashed = 0

        def __hash__(self):
            Counted.hashed += 1
            return super().__hash__()

    mine = WordEncoder(lambda new: [w.encode() for w in new], {}, remembered=100)
    assert mine(["a b a", None, " c"]) == [b"a b a", b"", b" c"]
    monkeypatch.setattr("eventloom.llm.pieces.words", lambda text: [Counted(w) for w in words(text)])
    assert mine(["a b a", "c"]) == [b"a b a", b"c"]
    # Three known words and a new one, which is also put down.
    assert 4 <= Counted.hashed <= 8
    Counted.hashed = 0
    assert mine([" c a b"] * 50) == [b" c a b"] * 50 and Counted.hashed == 150


def test_words_that_could_not_be_encoded_are_not_remembered():
    def broken(new):
        raise ValueError(new)

    mine = WordEncoder(broken, {}, remembered=100)
    with pytest.raises(ValueError):
        mine(["a b"])
    mine.encode_words = lambda new: [w.encode() for w in new]
    assert mine(["a b"]) == [b"a b"]


def test_new_words_are_asked_together():
    mine, asked = token_files.LibraryEncoder(BPE, 1000), []
    new = [f" {a}{b}" for a in "abcdefgh" for b in ("", "and", "éß", "日本", "٣", "!")] + ["and", "  ", " ", "\n", " \x1c", " ǅ"]
    alone = [np.array(e.ids, mine.kind).tobytes() for e in mine.tokenizer.encode_batch(new, add_special_tokens=False)]
    ask = mine.ask
    mine.ask = lambda texts: asked.extend(texts) or ask(texts)
    assert mine.ask_words(new) == alone and mine.ask_words([]) == []
    assert len(asked) < len(new) / 2


def test_words_are_asked_alone_where_tokens_do_not_show_their_begin(tmp_path):
    """A vocabulary without the space, and an added token that holds one."""
    words_only = Tokenizer(models.WordLevel({"Ġa": 0, "b": 1, "[UNK]": 2}, unk_token="[UNK]"))
    words_only.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    words_only.save(str(tmp_path / "plain.json"))
    words_only.add_special_tokens(["a b"])
    words_only.save(str(tmp_path / "added.json"))
    for name in ("plain", "added"):
        mine, library = token_files.LibraryEncoder(str(tmp_path / f"{name}.json"), 100), Tokenizer.from_file(str(tmp_path / f"{name}.json"))
        texts = ["a b c", "b a b a", " a a b x", "a  b", ""]
        want = [np.array(e.ids, mine.kind).tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
        assert isinstance(mine.encode, WordEncoder) and mine.encode(texts) == want
