"""The registered queries of the operators, and their SQL where SQL can express them.

Each reads the whole table, calls its operator and derives the columns asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    alignment,
    bpe,
    decontaminate,
    jaccard_join,
    language,
    pii,
    piece_table,
    ranking,
    spotsigs,
    token_count,
    token_files,
    toxicity,
    url_filter,
)
from eventloom.llm.workspace import new_folder, written
from eventloom.session import configure

TOKENIZER, UNIGRAM = "byte_bpe_50k.json", "piece_bpe_32k.model"
END_ID = 2

# The rules for URLs.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, n: int) -> F.Column:
    """crc32 of a number written as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.build_rules(spark.createDataFrame(RULES, "rule string, verdict string"))
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, vocabulary(UNIGRAM)).select("doc_id", "n_tokens")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.train(docs))
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(written("base_spans"), 256).alias("base_sha256"), written("spans").alias("spans"))


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.edit_resistance(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, new_folder(spark, "tokens"), vocabulary(TOKENIZER), END_ID)
    return token_files.read_token_files(files)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    model = language.train(docs.where("NOT held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "lang_phrases", "lang_chars")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"), n=3, percent=90)
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 5) == 0)
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.train(toxicity.sample(labels, docs))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, path, decoded="decoded").select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = piece_table.fill_in_middle(docs, percent=90, suffix_first=20).drop("text")
    return piece_table.restore(made, texts=False).drop("output")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, vocabulary(TOKENIZER), vocabulary(UNIGRAM), groups=False).drop("text")
    found = alignment.count_links(written(aligned, "alignment"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 3) == 1)
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = ranking.train(labels, docs)
    ranked = written(ranking.rank(docs, model).drop("text"), "ranked")
    return ranking.decide(ranked, ranking.cut(ranked, labels), learned=model is not None)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_decontaminate, op3_token_count, op4_pii, op5_spotsigs,
        op6_token_files, op7_language, op8_jaccard_join, op9_toxicity, op10_bpe,
        op11_piece_table, op12_alignment, op13_ranking,
    )
}

SQL = {
    "op1_url_filter": r"""
WITH parts AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id, rest,
        translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
    FROM parts
), judged AS (
    SELECT page_id, host, path,
        CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
             WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM split
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
""",    "op8_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+') IF x <> ''] AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::UBIGINT[]
        WHEN len(w) < 3 THEN [hash(array_to_string(w, ' '))]
        ELSE [hash(w[i], w[i + 1], w[i + 2]) FOR i IN range(1, len(w) - 1)] END)) AS s
    FROM words
), classes AS (
    SELECT s, min(doc_id) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), posted AS (
    SELECT c, n, unnest(s) AS h FROM classes
), edges AS (
    SELECT a.c AS x, b.c AS y FROM posted a JOIN posted b ON a.h = b.h AND a.c <> b.c AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
    GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
    SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
), least AS (
    SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(least(k.c, l.y), d.doc_id) AS component_id
FROM sets d LEFT JOIN classes k ON d.s = k.s LEFT JOIN least l ON l.x = k.c
""",
    "op11_piece_table": r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
    FROM drawn
), cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substring(t, 1, low) AS a, substring(t, low + 1, high - low) AS b, substring(t, high + 1, n - high) AS c FROM cuts
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
""",
}
