"""Ranking by preferences: features, pairs and cut against plain versions, accuracy on held-out rows."""

import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries, ranking
from tests.llm.test_tokens import PIECES

SF = "/root/testdata/sf0.01"
SPACES = [chr(i) for i in range(0x110000) if unicodedata.category(chr(i))[0] == "Z"] + list("\t\n\v\f\r")


def plain_features(text):
    text = text or ""
    category = unicodedata.category
    words = [w for w in re.split("[" + re.escape("".join(SPACES)) + "]", text) if w]
    lines = [x for x in text.split("\n") if x]
    letter = lambda c: category(c)[0] in "LM"
    upper = lambda c: category(c) in ("Lu", "Lt")
    stop, comma = set(".!?"), set(",;:")
    punctuation = lambda c: category(c)[0] == "P" and c not in stop | comma
    symbol = lambda c: category(c)[0] == "S"
    other = lambda c: not (c in SPACES or letter(c) or category(c) == "Nd" or c in stop | comma or punctuation(c) or symbol(c))
    marked = lambda c: c in stop | comma or punctuation(c) or symbol(c) or other(c)
    n, w = max(len(text), 1), max(len(words), 1)
    count = lambda test: sum(map(test, text))
    share = lambda test: sum(map(test, words)) / w
    sizes = [len(x) for x in words]
    mean = sum(sizes) / w
    triples = list(zip(words, words[1:], words[2:]))
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(len(lines)),
        count(upper) / max(1, count(lambda c: upper(c) or category(c) == "Ll")), count(lambda c: category(c) == "Nd") / n,
        count(SPACES.__contains__) / n, count(stop.__contains__) / w, count(comma.__contains__) / w, count(punctuation) / w,
        count(symbol) / w, count(other) / w,
        mean, math.sqrt(max(sum(s * s for s in sizes) / w - mean**2, 0)), share(lambda x: len(x) >= 14), share(lambda x: len(x) <= 3),
        share(lambda x: upper(x[0])), share(lambda x: sum(map(upper, x)) >= 2 and sum(map(upper, x)) == sum(map(letter, x))),
        share(lambda x: marked(x[-1])), share(lambda x: all(map(marked, x))), share(lambda x: any(map(letter, x)) and any(map(marked, x))),
        len(words) / max(1, len(lines)), len(set(words)) / w, max(Counter(words).values(), default=0) / w,
        1 - len(set(triples)) / len(triples) if triples else 0, 1 - len(set(lines)) / len(lines) if lines else 0,
    ]


def test_features_equal_the_plain_version():
    rnd = random.Random(3)
    pieces = [*PIECES, "\n", "the river", "THE", "x", "...", "ǅabc", " ", "a,b", "averyveryverylongword"]
    texts = ["".join(rnd.choice(pieces) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " ", "\n\n", "a", "a\n", "b b b b b b"]
    found = ranking.features(texts)
    assert found.shape == (len(texts), len(ranking.FEATURES))
    for text, row in zip(texts, found):
        assert row == pytest.approx(plain_features(text), abs=1e-6), text
    assert np.array_equal(found[100:101], ranking.features([texts[100]]))  # whatever else is in the batch


def test_held_out_rows(spark):
    found = queries.op13_ranking(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id")
    rows = found.where("held_out").collect()
    good = [r for r in rows if r.quality == 1]
    assert len(rows) > 80 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert np.mean([r.predicted for r in good]) >= 0.97
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)


def rows_of(spark, n=400, copies=1):
    rnd = random.Random(n)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    texts = [(i, " ".join(word() + ("!!" if i % 4 == 0 else "") for _ in range(30)), int(i % 4 != 0)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts for _ in range(copies if i == 0 else 1)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, q) for i, _, q in texts], "doc_id long, quality int")


def test_preferences_order_the_scores(spark):
    docs, labels = rows_of(spark)
    model = ranking.train(labels.where("doc_id < 300"), docs, rivals=5)
    ranked = ranking.rank(docs, model).cache()
    scores = {r.doc_id: r.rank_score for r in ranked.collect()}
    assert max(scores[i] for i in range(0, 400, 4)) < min(scores[i] for i in scores if i % 4)
    cut = ranking.cut(ranked, labels.where("doc_id < 300"))
    decided = ranking.decide(ranked, cut).collect()
    assert all(r.predicted == (r.doc_id % 4 != 0) and (r.score >= 0.5) == bool(r.predicted) for r in decided)


def test_pairs_are_bounded_and_prefer_label_1(spark):
    rows = [(i, int(i < 9), [float(i < 9), float(i)]) for i in range(30)]
    chosen = spark.createDataFrame(rows, "id long, label int, x array<double>")
    found = ranking.pairs(chosen, rivals=4).collect()
    assert len(found) == 9 * 4 == len({(tuple(r.better), tuple(r.worse)) for r in found})
    assert all(r.better[0] == 1 and r.worse[0] == 0 for r in found)
    turned = ranking.pairs(chosen.withColumn("label", 1 - F.col("label")), rivals=50).collect()
    assert len(turned) == 9 * 21 and all(r.better[0] == 0 and r.worse[0] == 1 for r in turned)


def test_sample_is_bounded_whatever_is_repeated(spark):
    docs, labels = rows_of(spark, copies=3000)
    repeated = labels.unionByName(labels).unionByName(spark.createDataFrame([(0, 0)] * 500 + [(None, 1), (5, None), (6, 7)], labels.schema))
    chosen = ranking.sample(repeated, docs.repartition(3), 100, "doc_id", "quality", "text").collect()
    assert len(chosen) <= 100 and len({(r.id, r.label) for r in chosen}) == len(chosen) > 90
    assert {len(r.x) for r in chosen} == {len(ranking.FEATURES)}


def test_cut_has_the_fewest_labels_on_its_wrong_side(spark):
    rnd = random.Random(4)
    rows = [(i, round(rnd.gauss(2 * (i % 3 > 0), 1), 2), int(i % 3 > 0)) for i in range(300)]
    ranked = spark.createDataFrame([r[:2] for r in rows], "doc_id long, rank_score double")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None), (999, 0)], "doc_id long, quality int")
    wrong = lambda cut: sum((s >= cut) != q for _, s, q in rows)
    found = ranking.cut(ranked, labels, levels=1000)
    assert wrong(found) == min(map(wrong, [r[1] for r in rows]))
    assert ranking.cut(ranked, labels.where("quality = 5")) == 0.0
    # Equal scores can't be cut apart.
    same = ranked.withColumn("rank_score", F.lit(1.5))
    assert wrong(ranking.cut(same, labels)) >= 0 and ranking.cut(same, labels) == 1.5


def test_nothing_to_learn_from(spark, awkward, nothing):
    docs, labels = rows_of(spark, 20)
    for none in (labels.limit(0), labels.where("quality = 1")):
        model = ranking.train(none, docs)
        assert model is None
        ranked = ranking.rank(awkward, model)
        decided = ranking.decide(ranked, ranking.cut(ranked, none), learned=False).collect()
        assert len(decided) == awkward.count() and {(r.score, r.predicted) for r in decided} == {(0.5, 1)}
    model = ranking.train(*reversed(rows_of(spark)))
    found = ranking.decide(ranking.rank(awkward, model), 0.0).collect()
    assert len(found) == awkward.count() and {type(r.score) for r in found} == {float}
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert ranking.rank(nothing, model).count() == 0
