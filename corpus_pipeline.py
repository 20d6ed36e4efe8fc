"""A corpus pipeline of five stages over `documents`; each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontaminate, jaccard_join, language, pii, queries
from eventloom.llm.workspace import written
from eventloom.session import configure

PROBE = "pipeline_"  # columns of a stage's own, dropped before it returns


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts of a learned language: those with letters that parse into phrases of two characters or more.

    The automata are learned from all labelled rows that come in, a bounded sample of them.
    """
    configure(spark)
    model = language.train(docs)
    # Under names of its own, no column is replaced by an output, and each text is sent to Python once.
    named = [PROBE + str(i) for i in range(len(docs.columns))]
    found = language.identify(docs.toDF(*named), model, text=named[docs.columns.index("text")])
    return found.where(~language.rejected()).select(*named).toDF(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class linked by word 5-shingles at a Jaccard of 0.8: the one with the smallest id.

    Texts without words are no copies of one another and stay. Of rows with the same id one of the class
    stays. A row without an id stays if no row of its class has one, and is then the only one.
    """
    configure(spark)
    found = jaccard_join.jaccard_classes(docs, n=5, percent=80)
    least = found.where((F.col("size") == 0) | F.col("doc_id").eqNullSafe(F.col("component")))
    kept = written(least.groupBy("class", "doc_id").agg(F.min("node").alias("node")).select("doc_id", "node"), "pipeline-kept")
    kept = kept.select(F.col("doc_id").alias(PROBE + "id"), F.col("node").alias(PROBE + "node"))
    if docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("doc_id IS NULL OR rows > 1").isEmpty():
        # Every id of the whole table belongs to one row: the ids alone decide.
        return docs.join(kept.select(PROBE + "id"), docs["doc_id"] == F.col(PROBE + "id"), "left_semi")
    return _one_of_each(docs, kept.where(F.col(PROBE + "node") != jaccard_join.EMPTY))


def _one_of_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """For tables with repeated or null ids: rows are told apart by their sets too, and one of each in `kept` stays."""
    rows = docs.select(F.struct(*_all(docs)).alias(PROBE + "row"), F.col("doc_id"), F.col("text"))
    node = jaccard_join.nodes(rows, 5, PROBE + "node_")
    empty = F.col(PROBE + "node_") == jaccard_join.EMPTY
    node = node.withColumn(PROBE + "copy", F.when(empty, F.monotonically_increasing_id() + 1).otherwise(F.lit(0)))
    same = F.col("doc_id").eqNullSafe(F.col(PROBE + "id")) & (F.col(PROBE + "node_") == F.col(PROBE + "node")) & (F.col(PROBE + "copy") == F.col(PROBE + "zero"))
    joined = node.join(kept.withColumn(PROBE + "zero", F.lit(0)), same, "left").where(empty | F.col(PROBE + "node").isNotNull())
    return _rows(joined.dropDuplicates(["doc_id", PROBE + "node_", PROBE + "copy"]), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage, edited or not.

    Rows are told apart by a 64-bit hash of id and text, so that clean rows under a repeated or null id stay.
    """
    configure(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(F.xxhash64("doc_id", "text").alias(PROBE + "key"), F.col("text"))
    found = decontaminate.contaminated(keyed, benchmark, doc_id=PROBE + "key").select("doc_id").distinct()
    found = written(found, "pipeline-leaks").withColumnRenamed("doc_id", PROBE + "key")
    return docs.join(found, F.xxhash64(docs["doc_id"], docs["text"]) == F.col(PROBE + "key"), "left_anti")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind; n_chars counts the new text."""
    configure(spark)
    found = pii.redact(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return found
    counted = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", counted).select(*_all(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, number of tokens, ids, and whether the ids decode to the text."""
    configure(spark)
    path = queries.vocabulary(queries.TOKENIZER)
    rows = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, decoded="decoded")
    return rows.select(
        "doc_id", "lang", "source", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def _all(docs: DataFrame) -> list[F.Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _rows(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(PROBE + "row").getField(c).alias(c) for c in docs.columns])


STAGES = [
    ("language", identified),
    ("jaccard_join", deduplicated),
    ("decontaminate", decontaminated),
    ("pii", redacted),
    ("bpe", encoded),
]
#: Suffix automata, boosted trees and merges are beyond SQL; the tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written as Parquet and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
