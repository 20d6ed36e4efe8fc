"""Jaccard classes and fingerprints against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from eventloom.llm import jaccard_join, queries, spotsigs
from eventloom.llm.components import connected_components
from tests.compare import connect, difference
from tests.llm.conftest import SMALL


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def brute(rows, n, percent):
    sets, root = [shingles(t, n) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


@pytest.fixture(scope="module")
def edited(spark):
    """Copies edited at many rates, of texts of many lengths, and a chain in which only neighbours link."""
    rnd, rows = random.Random(11), []
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    for size in (2, 3, 4, 9, 11, 13, 20, 40, 80, 200, 400):
        base = [word() for _ in range(size)]
        for _ in range(7):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                own[rnd.randrange(size)] = word()
            rows.append(" ".join(own + [word() for _ in range(rnd.randint(0, size // 30))]))
    chain = [word() for _ in range(200)]
    rows += [" ".join(chain[3 * k : 3 * k + 110]) for k in range(20)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("n", "percent", "tokens"), [(3, 90, 1 << 17), (5, 80, 2048)])
def test_classes_equal_brute_force(spark, monkeypatch, edited, n, percent, tokens):
    monkeypatch.setattr(jaccard_join, "GROUP_TOKENS", tokens)  # small groups: families of several
    docs = spark.createDataFrame(edited, "doc_id long, text string")
    got = {r.doc_id: (r["size"], r.component) for r in jaccard_join.jaccard_classes(docs, n, percent).collect()}
    assert got == brute(edited, n, percent)


def test_query_equals_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_jaccard_join(spark, SMALL).collect()}
    assert got == brute(rows, 3, 90)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_what_the_prefix_promises(spark, percent):
    import numpy as np

    rng, pairs = np.random.default_rng(2), 0
    partners = spark.range(1, 700).select("id", jaccard_join.least_shared(F.col("id"), percent).alias("m")).collect()
    promised = {r.id: r.m for r in partners}
    for size in (1, 2, 5, 9, 10, 12, 30, 100, 500):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            drop = rng.integers(0, size // 9 + 2)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, size // 9 + 1), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                pairs += 1
                met = np.intersect1d(*(s[: jaccard_join.prefix_length(len(s), percent)] for s in (a, b)))
                assert len(met) >= max(promised[len(a)], promised[len(b)])
    assert pairs > 100
    for x in range(1, 200):
        most = jaccard_join.largest_sharing(x, percent)
        assert jaccard_join.shared_prefix(most, percent) <= x < jaccard_join.shared_prefix(most + 1, percent)


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
def test_repeated_keys_in_any_batches(monkeypatch, step):
    import pyarrow as pa

    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    rows = sorted([(k, v) for k in range(9) for v in range(k)] + [(3, 0), (8, 7), (8, 7), (6, 0)])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + step])], names=["key", "node"]) for i in range(0, len(rows), step)]
    got = [tuple(r.values()) for b in jaccard_join.repeated(iter(batches)) for r in b.to_pylist()]
    assert got == [(k, v, min(k, 4)) for k in range(2, 9) for v in range(k)]


def test_awkward_rows(spark, awkward, nothing):
    rows = jaccard_join.jaccard_classes(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r["size"], r.component))
    assert by_id[5] == by_id[6] and {c for _, c in by_id[6]} == {5}
    assert by_id[2] == {(0, 2)} and by_id[3] == {(0, 3)} and by_id[4] == {(0, 4)} and by_id[9] == {(1, 9)}
    assert jaccard_join.jaccard_classes(nothing).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300), (101, 100)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def spots(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    common, out = set(spotsigs.ANCHORS), set()
    for i, w in enumerate(words):
        if w in common:
            ahead = [x for x in words[i + 1 :] if x not in common][:2]
            if ahead:
                out.add((w, *ahead))
    return out or {tuple(words[i : i + 2]) for i in range(len(words))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_equal_brute_force(spark, documents):
    got = {r.doc_id: r for r in queries.op5_spotsigs(spark, SMALL).collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in documents.collect()), reverse=True)
    prints = {}
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got.pop(doc_id)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(spots(text), spots(edited)))
        assert r.near_next == pytest.approx(jaccard(spots(text), spots(after)))
        assert prints.setdefault(r.fingerprint, spots(text)) == spots(text)
        assert (r.fingerprint == r.edited_fingerprint) == (spots(text) == spots(edited))
    assert not got


def test_chains_reach_beyond_any_run_of_common_words(spark):
    texts = ["river " + "the and of " * 40 + "stone bridge", "the " * 30, "the a river", "river the", "", "über the straße und die brücke"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = {r.id: r.signatures for r in spotsigs.with_signatures(rows, "text", "signatures").collect()}
    hashed = lambda words: spark.range(1).select(F.xxhash64(F.array(*map(F.lit, words)))).first()[0]
    for i, text in enumerate(texts):
        assert sorted(found[i]) == sorted({hashed(s) for s in spots(text)}), text
    assert len(found[0]) == 3


def test_next_document_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "DOCUMENTS_PER_BUCKET", 2)
    ids = [3, 5, 9, 10, 11, 500, 501, 502, 10**12, 10**12 + 1, -4, 77, 78, 79, 80]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in spotsigs.with_next(docs).where("ghost = 0").collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def test_awkward_fingerprints(spark, awkward, nothing):
    rows = spotsigs.edit_resistance(awkward)
    assert rows.count() == awkward.count() and rows.where("near_edited IS NULL OR near_next IS NULL").count() == 0
    assert spotsigs.edit_resistance(nothing).count() == 0
    single = spotsigs.edit_resistance(spark.createDataFrame([(1, "the old man")], "doc_id long, text string")).first()
    assert single.near_next == 1.0
    rows = spotsigs.fingerprints(awkward).groupBy("text").agg(F.count_distinct("fingerprint").alias("n")).collect()
    assert all(r.n == 1 for r in rows)


def test_similar_equals_brute_force(spark, edited):
    rows = spotsigs.fingerprints(spark.createDataFrame(edited, "doc_id long, text string"))
    got = {(r.query, r.document): r.likeness for r in spotsigs.similar(rows.where("doc_id % 3 = 0"), rows, 0.6).collect()}
    sets = {d: spots(t) for d, t in edited}
    want = {(a, b): j for a in sets for b in sets if a % 3 == 0 and a != b and (j := jaccard(sets[a], sets[b])) >= 0.6}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_join_query_equals_sql(spark):
    name = "op8_jaccard_join"
    assert difference(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.SQL[name]) is None


def test_pairs_of_a_batch_hang_on_their_smallest():
    import numpy as np

    rnd = random.Random(3)
    for size in (0, 1, 5, 60, 400):
        pairs = [(rnd.randrange(-size, size), rnd.randrange(-size, size)) for _ in range(size)] + [(k, k + 1) for k in range(1000, 1000 + size)]
        rnd.shuffle(pairs)
        root = {x: x for p in pairs for x in p}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        a, b = jaccard_join.hang(*np.array(pairs, np.int64).reshape(-1, 2).T)
        assert sorted(zip(b.tolist(), a.tolist())) == sorted((x, find(x)) for x in root if find(x) != x)


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    edges = [(1000 * g + rnd.randrange(60), 1000 * g + rnd.randrange(60)) for g in range(12) for _ in range(5 * g)] + [(-7, k) for k in range(13_000, 13_300)]
    root = {x: x for a, b in edges if a != b for x in (a, b)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = [tuple(r) for r in connected_components(spark.createDataFrame(edges * 2, "a long, b long")).collect()]
    assert sorted(found) == sorted((x, find(x)) for x in root)
