"""Toxicity scores by weak supervision.

Many voters look at a text: each word of several lexicons is one, and so are patterns of address,
command and emphasis, and the words and word beginnings that nearly only labelled toxic texts have
(`induced` of them at most). A generative label model treats the true class as hidden: each voter fires with
one rate on toxic and another on other texts (its accuracy), and the given label is one more voter,
which may be wrong. Expectation-maximisation estimates the rates and the posterior of each text. Voters
that fire together within a class are correlated and share their weight: a voter's evidence is divided
by the sum of its correlations within the classes. A linear classifier over the words of the texts is
then trained on the posteriors (each text as both classes, weighted), sparse by an L1 penalty. Its
features are the words of a text and their beginnings of five to seven letters; a text is scored by
all its words.

The label model and the classifier are fit on at most `documents` labelled texts, those whose ids have
the lowest hashes; label rows that are repeated count once. Scoring reads whole texts.

Cases: null and empty texts get the classifier's score for no words. Labels that are null are left
out; texts repeated under an id count as often as they come. Without any labelled text the score is 0 for all. An
empty table gives an empty one. Columns named like an output are replaced, all others kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.pieces import Memo
from eventloom.llm.workspace import written

# Lexicons, one voter for each word.
LEXICONS = {
    "names for people": "idiot idiots moron morons imbecile fool fools clown clowns loser losers dumbass jerk creep coward"
    " liar freak pig rat bastard bitch asshole scumbag retard weirdo",
    "contempt": "stupid dumb pathetic worthless disgusting useless ridiculous ignorant ugly hateful despicable vile"
    " repulsive brainless clueless shameful miserable",
    "dehumanising": "scum trash garbage vermin filth parasite parasites subhuman savage savages animal animals",
    "obscene": "fuck fucking fucked shit bullshit crap damn cunt dick piss whore slut",
    "violence": "kill murder hang shoot stab slaughter exterminate lynch rape",
    "german": "idiot trottel dummkopf versager abschaum dreck arschloch scheiße ekelhaft widerlich erbärmlich wertlos blöd",
    "french": "imbécile crétin abruti débile ordure connard salaud salope merde minable dégoûtant répugnant",
    "spanish": "imbécil estúpido estúpida basura escoria asqueroso patético perdedor payaso mierda pendejo cabrón",
}
PATTERNS = {
    "you are": r"\b(?:you are|you're|you people|du bist|tu es|eres)\b(?: \w+){0,2} \b(?:idiot|moron|stupid|pathetic|worthless|disgusting|scum|trash|loser|clown)",
    "such a": r"\b(?:such an?|what an?|bunch of|pack of) (?:\w+ )?(?:idiot|moron|loser|clown|liar|coward|scum|trash)",
    "go away": r"\b(?:shut up|get lost|go away|go to hell|drop dead|piss off)\b",
    "hate": r"\b(?:i hate|we hate|everyone hates|nobody likes)\b",
    "threat": r"\b(?:i will|i'll|we will|going to) (?:kill|hurt|find|destroy|beat)\b",
    "exclamation": r"!{3,}",
    "masked": r"\b\w+\*{2,}\w*",
}
_words = re.compile(r"[^\W\d_]+").findall
BEGINNINGS = (5, 6, 7)


def features_of(word: str) -> tuple[str, ...]:
    """The word, and its beginnings with a star."""
    return (word, *[word[:k] + "*" for k in BEGINNINGS if len(word) >= k])


def features(text: str | None) -> list[str]:
    return sorted({f for w in set(_words((text or "").lower())) for f in features_of(w)})


class Voters:
    """All voters; a text's votes are the numbers of those that fire."""

    def __init__(self, lexicons: dict[str, str], patterns: dict[str, str]):
        words = dict.fromkeys(w for line in lexicons.values() for w in line.split())
        self.names = [*words, *patterns]
        self.word = {w: i for i, w in enumerate(words)}
        self.patterns = [(len(words) + k, re.compile(p, re.IGNORECASE)) for k, p in enumerate(patterns.values())]

    def __call__(self, text: str | None) -> list[int]:
        found = set(re.findall(r"[^\W_]+", (text or "").lower()))
        fired = [self.word[w] for w in found & self.word.keys()]
        return sorted(fired) + [i for i, p in self.patterns if p.search(text or "")]


@dataclass
class LabelModel:
    """Evidence for the toxic class: a start, and what a voter adds by firing."""

    start: float
    fired: np.ndarray
    label: tuple[float, float]  # what the labels 0 and 1 add
    weight: np.ndarray  # of each voter, after what it shares with correlated ones

    @classmethod
    def fit(cls, votes: np.ndarray, labels: np.ndarray, rounds: int = 40) -> LabelModel:
        """votes: 0/1 by text and voter; labels: 0/1 by text."""
        some = votes.any(axis=1)
        toxic = np.where(labels == 1, np.where(some, 0.9, 0.4), np.where(some, 0.2, 0.02))
        for _ in range(rounds):
            total = np.array([(1 - toxic).sum(), toxic.sum()])
            rate = np.stack([(1 - toxic) @ votes, toxic @ votes]) + np.array([[0.05], [0.5]])
            rate /= (total + 1)[:, None]
            rate = np.clip(rate, 1e-5, 1 - 1e-5)
            said = np.clip((np.array([(1 - toxic) @ labels, toxic @ labels]) + 0.5) / (total + 1), 1e-3, 1 - 1e-3)
            weight = 1 / cls._shared(votes, toxic, rate)
            fired, silent = np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0]))
            start = np.log((total[1] + 0.5) / (total[0] + 0.5)) + float(weight @ silent)
            label = (float(np.log((1 - said[1]) / (1 - said[0]))), float(np.log(said[1] / said[0])))
            model = cls(float(start), weight * (fired - silent), label, weight)
            now = model.posterior(votes, labels)
            if np.abs(now - toxic).max(initial=0) < 1e-4:
                break
            toxic = now
        return model

    @staticmethod
    def _shared(votes: np.ndarray, toxic: np.ndarray, rate: np.ndarray) -> np.ndarray:
        """For each voter, 1 and the sum of its positive correlations with the others within the classes."""
        covariance = np.zeros((votes.shape[1], votes.shape[1]))
        for share, mean in ((1 - toxic, rate[0]), (toxic, rate[1])):
            centred = (votes - mean) * np.sqrt(share)[:, None]
            covariance += centred.T @ centred
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = covariance / scale[:, None] / scale[None, :]
        correlation[np.abs(correlation) < 0.05] = 0  # no more than chance gives
        np.fill_diagonal(correlation, 1)
        return np.maximum(correlation, 0).sum(axis=1)

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.start + votes @ self.fired + np.array(self.label)[labels], -30, 30)))


@dataclass
class Classifier:
    """A linear classifier: what a text without words has, and what each feature adds."""

    start: float
    weights: dict[str, float]


def _telling(fit: DataFrame, induced: int, vocabulary: int) -> tuple[list[str], list[str]]:
    """Features that nearly only texts labelled toxic have; and those that they have twice as often as others, or more."""
    base = fit.agg((F.sum("label") / F.count("*")).alias("base"))
    counts = fit.select("label", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
    share = F.col("toxic") / (F.col("toxic") + F.col("other"))
    more = counts.where("toxic >= 3").where(share >= 2 * F.coalesce(F.lit(base.first()["base"]), F.lit(0.0)))
    ordered = more.orderBy(F.desc(F.col("toxic") - 3 * F.col("other")), "feature").limit(vocabulary).collect()
    nearly = [r["feature"] for r in ordered if r["toxic"] >= 4 and r["other"] <= 0.1 * r["toxic"]]
    return nearly[:induced], [r["feature"] for r in ordered]


def train(
    labelled: DataFrame,
    label: str = "toxic",
    text: str = "text",
    key: str = "doc_id",
    documents: int = 5000,
    induced: int = 300,
    vocabulary: int = 20_000,
    lexicons: dict[str, str] = LEXICONS,
    patterns: dict[str, str] = PATTERNS,
) -> Classifier | None:
    """Fit the label model and the classifier; labelled: rows with text, key and label 0 or 1."""
    spark, voters = labelled.sparkSession, Voters(lexicons, patterns)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            columns = [pa.array(map(voters, texts), pa.list_(pa.int32())), pa.array(map(features, texts), pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["id", "label", "votes", "features"])

    rows = labelled.select(
        F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`")).alias("id"),
        F.col(f"`{label}`").cast("int").alias("label"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).where("label in (0, 1)")
    fit = rows.orderBy("id").limit(documents).repartition(32)  # the few chosen texts arrive in one task
    fit = written(fit.mapInArrow(look, "id long, label int, votes array<int>, features array<string>"), "toxicity-sample")
    more, words = _telling(fit, induced, vocabulary)
    number = {f: len(voters.names) + k for k, f in enumerate(more)}
    listed = F.array(*[F.lit(f) for f in more]).cast("array<string>")
    found = fit.select("id", "votes", F.array_intersect("features", listed).alias("induced"), "label").collect()
    if not found:
        return None
    votes, labels = np.zeros((len(found), len(voters.names) + len(more))), np.array([r["label"] for r in found])
    for i, r in enumerate(found):
        votes[i, r["votes"] + [number[f] for f in r["induced"]]] = 1
    toxic = LabelModel.fit(votes, labels).posterior(votes, labels)
    if not words:
        return Classifier(float(np.log(toxic.mean() / (1 - toxic.mean()))), {})
    posteriors = spark.createDataFrame([(r["id"], float(p)) for r, p in zip(found, toxic)], "id long, p double").dropDuplicates(["id"])
    classes = F.array(F.struct(F.lit(1.0).alias("y"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - F.col("p")).alias("w")))
    counter = CountVectorizerModel.from_vocabulary(sorted(words), "features", "x").setBinary(True)
    examples = counter.transform(fit.join(F.broadcast(posteriors), "id")).select("x", F.explode(classes).alias("as"))
    examples = written(examples.select("x", "as.y", "as.w").where("w > 0.001"), "toxicity-examples")
    linear = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", elasticNetParam=1.0, regParam=0.0002, maxIter=30, standardization=False)
    fitted = linear.fit(examples)
    weight = fitted.coefficients.toArray()
    return Classifier(float(fitted.intercept), {sorted(words)[i]: float(weight[i]) for i in np.flatnonzero(weight)})


def sample(labels: DataFrame, docs: DataFrame, documents: int = 5000, key: str = "doc_id", label: str = "toxic", text: str = "text") -> DataFrame:
    """Labelled texts of `documents` distinct keys and labels at most, those with the lowest hashes of the key.

    Only those keys and labels are sent to the executors, whatever the size of the tables and however
    often a label row is repeated.
    """
    keys = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").alias(label)).where(F.col(key).isNotNull() & F.col(label).isNotNull())
    chosen = keys.distinct().orderBy(F.xxhash64(key), key, label).limit(documents)
    return docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text)).join(F.broadcast(chosen), key)


def score(df: DataFrame, model: Classifier | None, text: str = "text", remembered: int = 400_000) -> DataFrame:
    """Add score (probability of being toxic) and predicted (1 from 0.5 on)."""
    kept = [c for c in df.columns if c.lower() not in ("score", "predicted")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("source_of_score"))
    outputs = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType([*rows.schema.fields[:-1], *outputs])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        weights = mine.weights if mine else {}
        known = Memo(lambda word: tuple(f for f in features_of(word) if f in weights), remembered)
        for batch in batches:
            scores = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                has = {f for w in set(_words((text or "").lower())) for f in known[w]}
                logit = mine.start + sum(weights[f] for f in sorted(has)) if mine else -np.inf
                scores.append(float(1 / (1 + np.exp(-np.maximum(logit, -700)))) if mine else 0.0)
            columns = [pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return rows.mapInArrow(run, schema)
