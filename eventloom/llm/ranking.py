"""Quality scores by Bradley-Terry ranking.

Labelled texts are turned into preference pairs: one of label 1 is preferred to one of label 0. Each text
has a score, a linear function of its features, and the chance that one text is preferred to another is
the logistic function of the difference of their scores; so fitting is logistic regression, without
intercept, on differences of features. The scores rank texts; a cut of the ranking makes a decision.
The cut is a quantile of the scores of all labelled learning rows: the one at which the fewest of them
lie on the wrong side. `score` is the logistic function of what a text is above the cut, so 0.5 is the cut.

Features look at the form of whole texts: lengths, kinds of characters and words, repeated words, word
triples and lines. Each becomes steps at quantiles of the fit sample, so that the score can bend.

The ranking is fit on at most `documents` labelled texts, those with the lowest hashes of the key, and `rivals`
pairs for each of the rarer label. The cut looks at the scores of all labelled rows.

Cases: null and empty texts have the features of no words and are scored like any. Null labels and
labels other than 0 and 1 are left out; repeated label rows and copies of a text count once in the fit, as often as
they come in the cut. Without pairs (no label, or only one) nothing is learned and every score is 0.5. Equal
texts have equal scores. An empty table gives an empty one. Columns named like an output are
replaced, all others kept.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.batches import slices
from eventloom.llm.workspace import written

SLICE_BYTES = 1 << 20
SPACE, LOWER, UPPER, LETTER, DIGIT, STOP, COMMA, MARK, SYMBOL, OTHER = range(10)
KINDS = 10
#: Names of the features, as `features` gives them.
FEATURES = (
    "characters", "words", "lines", "upper_letters", "digits", "spaces", "stops", "commas", "marks", "symbols", "others",
    "word_length", "word_spread", "long_words", "short_words", "capitalised", "all_upper", "ends_in_mark", "lone_marks", "mixed",
    "line_words", "distinct_words", "most_frequent", "repeated_triples", "repeated_lines",
)

_tables: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """The kind of every code point."""
    if not _tables:
        by_category = {"Ll": LOWER, "Lu": UPPER, "Lt": UPPER, "Nd": DIGIT, "Zs": SPACE, "Zl": SPACE, "Zp": SPACE}
        by_letter = {"L": LETTER, "M": LETTER, "N": OTHER, "P": MARK, "S": SYMBOL}
        table = np.full(0x110000, OTHER, np.uint8)
        for i in range(0x110000):
            category = unicodedata.category(chr(i))
            table[i] = by_category.get(category, by_letter.get(category[0], OTHER))
        table[[9, 10, 11, 12, 13]] = SPACE
        table[list(map(ord, ".!?"))] = STOP
        table[list(map(ord, ",;:"))] = COMMA
        _tables.append(table)
    return _tables[0]


def _repeats(owner: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By owner: the number of different keys, and how often the most frequent one comes."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[first], np.diff(first, append=len(key)))
    return np.bincount(owner[first], minlength=n), most


def _hashes(points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each of the stretches of code points, equal for equal ones."""
    with np.errstate(over="ignore"):
        value = (points.astype(np.uint64) + np.uint64(0x9E37)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        sizes = ends - begins
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        weight = (at.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        weight ^= weight >> np.uint64(31)
        product = value[np.repeat(begins, sizes) + at] * (weight | np.uint64(1))
        return np.add.reduceat(product, np.cumsum(sizes) - sizes) if len(sizes) else np.empty(0, np.uint64)


def features(texts: list[str | None]) -> np.ndarray:
    """A row of `FEATURES` for each text, of whole texts."""
    some = [t or "" for t in texts]
    n = len(some)
    points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, some), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    kind = _kinds()[np.minimum(points, 0x10FFFF)]
    by_kind = np.bincount(owner * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS).astype(float)
    by_owner = lambda of, weights=None: np.bincount(of, weights=weights, minlength=n)

    # Words: runs of characters other than spaces.
    inside = kind != SPACE
    before = np.zeros(len(points), bool)
    before[1:] = inside[:-1] & (owner[1:] == owner[:-1])
    begins = np.flatnonzero(inside & ~before)
    after = np.zeros(len(points), bool)
    after[:-1] = inside[1:] & (owner[1:] == owner[:-1])
    ends = np.flatnonzero(inside & ~after) + 1
    of, length = owner[begins], ends - begins
    passed = lambda test: np.append(0, np.cumsum(test))
    within = lambda test: (sums := passed(test))[ends] - sums[begins]
    letters = within((kind >= LOWER) & (kind <= LETTER))
    upper, marks = within(kind == UPPER), within(kind >= STOP)
    first, last = (kind[begins], kind[ends - 1]) if len(begins) else (kind[:0], kind[:0])
    words = by_owner(of)
    some_words = np.maximum(words, 1)
    mean = by_owner(of, length) / some_words
    spread = np.sqrt(np.maximum(by_owner(of, length.astype(float) ** 2) / some_words - mean**2, 0))
    share = lambda test: by_owner(of, test) / some_words

    word = _hashes(points, begins, ends)
    distinct, most = _repeats(of, word, n)
    triple = of[2:] == of[:-2]
    with np.errstate(over="ignore"):
        key = word[:-2] * np.uint64(3) + word[1:-1] * np.uint64(0x9E3779B97F4A7C15) + word[2:] * np.uint64(0xBF58476D1CE4E5B9)
    triples = by_owner(of[2:][triple])
    different, _ = _repeats(of[2:][triple], key[triple], n)

    # Lines: what lies between line ends, empty ones left out.
    inside = points != 10
    limit = np.ones(len(points), bool)
    limit[1:] = ~inside[:-1] | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(inside & limit)
    closing = np.ones(len(points), bool)
    closing[:-1] = ~inside[1:] | (owner[1:] != owner[:-1])
    stops = np.flatnonzero(inside & closing) + 1
    lines = by_owner(owner[starts])
    line_kinds, _ = _repeats(owner[starts], _hashes(points, starts, stops), n)

    characters = np.maximum(sizes, 1)
    cased = np.maximum(by_kind[:, LOWER] + by_kind[:, UPPER], 1)
    columns = [
        np.log1p(sizes), np.log1p(words), np.log1p(lines), by_kind[:, UPPER] / cased, by_kind[:, DIGIT] / characters,
        by_kind[:, SPACE] / characters, *[by_kind[:, k] / some_words for k in (STOP, COMMA, MARK, SYMBOL, OTHER)],
        mean, spread, share(length >= 14), share(length <= 3), share(first == UPPER), share((upper >= 2) & (upper == letters)),
        share(last >= STOP), share(marks == length), share((letters > 0) & (marks > 0)),
        words / np.maximum(lines, 1), distinct / some_words, most / some_words,
        1 - different / np.maximum(triples, 1) * (triples > 0) - (triples == 0), 1 - line_kinds / np.maximum(lines, 1) - (lines == 0),
    ]
    return np.stack(columns, axis=1).astype(float).reshape(n, len(FEATURES))


@dataclass
class Ranking:
    """Steps of each feature with what passing them adds to a text's score, and the cut."""

    steps: list[np.ndarray]
    weights: list[np.ndarray]  # by feature: one for each step
    cut: float = 0.0

    def raw(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values))
        for k, (steps, weights) in enumerate(zip(self.steps, self.weights)):
            sums = np.append(0, np.cumsum(weights))
            total += sums[np.searchsorted(steps, values[:, k], side="right")]
        return total


def sample(labels: DataFrame, docs: DataFrame, documents: int, key: str, label: str, text: str) -> DataFrame:
    """id, label and features of labelled texts, `documents` at most: those whose keys have the lowest hashes.

    Only that many keys are sent to the executors, whatever the size of the tables; copies of a text
    with the same label are one row.
    """
    keys = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
    lowest = keys.distinct().orderBy(F.xxhash64("key"), "key", "label").limit(documents)
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # of a task, so that a text with many copies isn't looked at as often
        for batch in batches:
            ids = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            new = [i for i, x in enumerate(ids) if x not in seen and not seen.add(x)]
            for part in slices(batch.take(pa.array(new, pa.int64())), 2, SLICE_BYTES):
                values = pa.array(features(part.column(2).to_pylist()).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], values], names=["id", "label", "x"])
            if len(seen) > 4 * documents:
                seen.clear()

    chosen = texts.join(F.broadcast(lowest), "key").select(F.xxhash64("text").alias("id"), "label", "text")
    found = chosen.mapInArrow(look, "id long, label int, x array<double>").dropDuplicates(["id", "label"])
    return found.orderBy("id", "label").limit(documents)


def pairs(chosen: DataFrame, rivals: int) -> DataFrame:
    """(better, worse): features of a preferred and another text. Each of the rarer label meets `rivals` of the other."""
    ranked = chosen.withColumn("at", F.row_number().over(Window.partitionBy("label").orderBy("id")) - 1)
    counts = {r["label"]: r["n"] for r in ranked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return ranked.select(F.col("x").alias("better"), F.col("x").alias("worse")).limit(0)
    rare = min(counts, key=lambda k: (counts[k], k))
    others = counts[1 - rare]
    few = ranked.where(F.col("label") == rare).select(F.col("x").alias("mine"), "at")
    met = few.select("mine", F.explode(F.sequence(F.lit(0), F.lit(min(rivals, others) - 1))).alias("k"), "at")
    met = met.select("mine", F.pmod(F.col("at") * rivals + F.col("k"), F.lit(others)).alias("at"))
    joined = met.join(ranked.where(F.col("label") != rare).select(F.col("x").alias("theirs"), "at"), "at")
    names = ("better", "worse") if rare == 1 else ("worse", "better")
    return joined.select(F.col("mine").alias(names[0]), F.col("theirs").alias(names[1]))


def train(
    labels: DataFrame,
    docs: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    documents: int = 6000,
    rivals: int = 12,
    steps: int = 8,
    penalty: float = 0.002,
) -> Ranking | None:
    """Fit the ranking on labelled texts, with its cut at 0; None if there are no preferences to learn from."""
    chosen = written(sample(labels, docs, documents, key, label, text), "ranking-sample")
    met = written(pairs(chosen, rivals), "ranking-pairs")
    if met.isEmpty():
        return None
    levels = [(k + 1) / (steps + 1) for k in range(steps)]
    values = chosen.select(*[F.col("x")[k].alias(name) for k, name in enumerate(FEATURES)])
    found = values.agg(*[F.percentile(F.col(name), F.array(*map(F.lit, levels))).alias(name) for name in FEATURES]).first()
    limits = [np.unique(np.array(found[name])) for name in FEATURES]
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(s)).alias("s")) for k, own in enumerate(limits) for s in own])

    def passed(column: str) -> F.Column:
        return F.transform(listed, lambda step: (F.get(F.col(column), step["k"]) >= step["s"]).cast("double"))

    # Every other pair is turned round, so that both outcomes come.
    turned = F.pmod(F.xxhash64("better", "worse"), F.lit(2))
    sign = F.lit(1.0) - 2 * turned
    differences = met.select(
        F.zip_with(passed("better"), passed("worse"), lambda a, b: (a - b) * sign).alias("x"), (1.0 - turned).alias("y")
    )
    examples = written(differences, "ranking-differences").select(array_to_vector("x").alias("x"), "y")
    linear = LogisticRegression(featuresCol="x", labelCol="y", fitIntercept=False, standardization=False, regParam=penalty, maxIter=60)
    weight = linear.fit(examples).coefficients.toArray()
    edges = np.cumsum([0, *map(len, limits)])
    return Ranking(limits, [weight[i:j] for i, j in zip(edges, edges[1:])])


def rank(df: DataFrame, model: Ranking | None, text: str = "text") -> DataFrame:
    """Add rank_score, the Bradley-Terry score of each text."""
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != "rank_score"], F.col(f"`{text}`").alias("source_of_score"))
    n = len(rows.columns) - 1
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("rank_score", T.DoubleType())])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        for batch in batches:
            for part in slices(batch, n, SLICE_BYTES):
                scores = mine.raw(features(part.column(n).to_pylist())) if mine else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(scores, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def cut(ranked: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", levels: int = 400) -> float:
    """The quantile of the labelled rows' scores that the fewest labels contradict; half-way to the next score below.

    All labelled rows are looked at: quantiles from a mergeable sketch, then counts of the labels between them.
    """
    wanted = labels.select(F.col(f"`{key}`").alias("cut_key"), F.col(f"`{label}`").cast("int").alias("cut_label")).where("cut_label IN (0, 1)")
    scores = ranked.select(F.col(f"`{key}`").alias("cut_key"), F.col("rank_score").alias("score"))
    labelled = written(scores.join(wanted, "cut_key").select("score", "cut_label"), "ranking-labelled")
    shares = [k / levels for k in range(levels + 1)]
    found = labelled.agg(F.percentile_approx("score", F.array(*map(F.lit, shares)), 100 * levels).alias("at")).first()["at"]
    if found is None:
        return 0.0
    limits = sorted(set(found))
    passed = F.size(F.filter(F.array(*map(F.lit, limits)), lambda limit: F.col("score") >= limit)).alias("passed")
    between = labelled.groupBy(passed).agg(F.sum("cut_label").alias("good"), F.count("*").alias("n"), F.max("score").alias("last")).collect()
    good, bad, last = np.zeros(len(limits) + 1), np.zeros(len(limits) + 1), np.full(len(limits) + 1, -np.inf)
    for r in between:
        good[r["passed"]], bad[r["passed"]], last[r["passed"]] = r["good"], r["n"] - r["good"], r["last"]
    # A cut at limits[i] has on its wrong side the good ones below and the others from there on.
    wrong = np.cumsum(good)[:-1] + (bad.sum() - np.cumsum(bad)[:-1])
    i = int(np.argmin(wrong))
    below = last[: i + 1].max()
    return float((limits[i] + below) / 2) if np.isfinite(below) else float(limits[i])


def decide(ranked: DataFrame, cut: float, learned: bool = True) -> DataFrame:
    """score and predicted in place of rank_score: 1 from the cut on."""
    above = F.col("rank_score") - F.lit(cut)
    score = 1 / (1 + F.exp(-above)) if learned else F.lit(0.5)
    # By the sign, as the logistic function of a tiny difference rounds to 0.5.
    score = F.when(above < 0, F.least(score, F.lit(float(np.nextafter(0.5, 0))))).otherwise(score)
    return ranked.drop("score", "predicted").withColumns({"score": score, "predicted": F.when(above < 0, 0).otherwise(1)}).drop("rank_score")
