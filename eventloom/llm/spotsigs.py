"""SpotSigs fingerprints with DataFrame functions only.

Where a common word (the anchor) stands, the next content words make a chain; anchor and chain hash to
one signature. The set of a text's signatures is what is compared, by Jaccard. Texts without any
spot use every two neighbouring words, texts of one word that word, so equal texts have equal sets
and only texts without words have empty ones.

`similar` joins a table of queries with a table of documents: both are partitioned by set length,
since a likeness of t needs lengths within a factor t; in hash order, two sets that are alike share
one of their first (1 - t) n + 1 signatures, so only those meet in the join, and a pair is kept where
its smallest shared signature was posted.

Cases: null texts are empty; two empty sets have likeness 1, an empty and another one 0; repeated
rows count as often as they come; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words that anchor a spot, in the languages covered.
ANCHORS = (
    "a an and are as at be by for from has have he her his i in is it its not of on or she that the their they this to was"
    " we were will with you"
    " als am auf aus bei das dem den der des die ein eine einen er es für ich im ist mit nicht sich sie sind und von war wie zu"
    " au aux avec ce ces dans de du elle en est et il je la le les ne nous ou par pas pour qu que qui se son sur un une vous"
    " al como con del el ella esta ha las lo los más no para pero por su sus y ya"
).split()
DOCUMENTS_PER_BUCKET = 1000
#: A table of bucket borders up to so many rows (an id and a number each) is sent to all executors.
SENT_ROWS = 1_000_000


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once, also where the optimizer moves the whole expression into a filter."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_signatures(df: DataFrame, text: str, name: str, chain: int = 2) -> DataFrame:
    """Add the sorted distinct signatures of a text column."""
    common = lambda w: w.isin(ANCHORS)

    def spots(words: Column) -> Column:
        marked = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda m: common(m["word"]))
        # Before the k-th anchor, at i, are i - k content words; so the next ones are found by number, however far away.
        after = lambda content, m, k: [F.get(content, m["at"] - k + j) for j in range(chain)]
        spot = lambda content: lambda m, k: F.array_compact(F.array(m["word"], *after(content, m, k)))
        found = _bound(F.filter(words, lambda w: ~common(w)), lambda content: F.transform(marked, spot(content)))
        return F.filter(found, lambda s: F.size(s) > 1)

    def signatures(words: Column) -> Column:
        pair = lambda w, at: F.xxhash64(F.array_compact(F.array(w, F.get(words, at + 1))))
        hashed = lambda found: F.transform(found, lambda s: F.xxhash64(s))
        return _bound(spots(words), lambda found: F.when(F.size(found) > 0, hashed(found)).otherwise(F.transform(words, pair)))

    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return df.withColumn(name, F.sort_array(F.array_distinct(_bound(words, signatures))))


def fingerprint(signatures: str) -> Column:
    """A short name of a signature set: its length and 128 bits of it."""
    return F.concat_ws(
        "-", F.size(signatures).cast("string"), F.lower(F.hex(F.xxhash64(signatures))), F.lower(F.hex(F.xxhash64(F.lit(1), F.col(signatures))))
    )


def likeness(a: str, b: str) -> Column:
    """Jaccard of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / F.nullif(union, F.lit(0)))


def similar(queries: DataFrame, docs: DataFrame, least: float = 0.8, key: str = "doc_id", signatures: str = "signatures") -> DataFrame:
    """Pairs (query, document, likeness) of a set of queries and all documents with a likeness of `least` or more."""
    ratio = 1 / least
    band = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(ratio)) + 1e-9)

    def side(df: DataFrame, id_: str, set_: str, reach: int) -> DataFrame:
        rows = df.select(F.col(key).alias(id_), F.col(signatures).alias(set_)).where(F.size(set_) > 0)
        n = F.size(set_)
        posted = F.slice(set_, F.lit(1), (n - F.ceil(n * least - 1e-9) + 1).cast("int"))
        bands = F.sequence(band(n) - reach, band(n) + reach)
        return rows.withColumn("band", F.explode(bands)).select(id_, set_, "band", F.explode(posted).alias("posted"))

    q, d = side(queries, "query", "q", 1), side(docs, "document", "d", 0)
    met = q.join(d, ["band", "posted"]).where((F.col("query") != F.col("document")) & _first_shared())
    return met.withColumn("likeness", likeness("q", "d")).where(F.col("likeness") >= least - 1e-9).select("query", "document", "likeness")


def _first_shared() -> Column:
    """A pair is compared only where its smallest shared signature is posted, and only if the lengths allow it.

    What is left of both sets from there bounds what they share.
    """
    return F.array_min(F.array_intersect("q", "d")) == F.col("posted")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and next_text: the text of the next document by descending id; after the last comes the first.

    Documents are dealt into buckets of neighbouring ids, by quantiles of the ids and evenly between
    them; each bucket also gets the document that follows it, so one shuffle brings all neighbours
    together. Rows with the same id are ordered by their text, null ids come last. Each row also has
    its bucket and place, by which `next_of` finds further columns of the next row without a shuffle.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    shares = [k / 64 for k in range(65)]
    found = rows.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", shares, 20_000).alias("borders")).first()
    borders = sorted(set(found["borders"] or [0]))
    fine = max(1, found["n"] // DOCUMENTS_PER_BUCKET // max(1, len(borders) - 1))
    listed = F.array(*[F.lit(b).cast("long") for b in borders])
    segment = F.greatest(F.size(F.filter(listed, lambda b: b <= F.col("doc_id"))) - 1, F.lit(0))
    low, high = F.get(listed, segment), F.coalesce(F.get(listed, segment + 1), F.get(listed, segment) + 1)
    within = F.least(F.floor((F.col("doc_id") - low).cast("double") / (high - low) * fine), F.lit(fine - 1))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(segment * fine + within).cast("long")
    tops = rows.select("doc_id", bucket.alias("bucket"), segment.alias("segment")).groupBy("segment", "bucket")
    tops = tops.agg(F.max("doc_id").alias("top"), F.max(F.col("doc_id").isNull()).alias("none"))
    inner = tops.withColumn("above", F.lead("bucket").over(Window.partitionBy("segment").orderBy("bucket")))
    # One row for each of the 64 segments: from a segment's last bucket on to the next segment's first.
    ends = tops.groupBy("segment").agg(F.max("bucket").alias("bucket"), F.min("bucket").alias("first"))
    ends = ends.withColumn("over", F.lead("first").over(Window.partitionBy(F.lit(0)).orderBy("segment")))
    lowest = ends.agg(F.min("first").alias("lowest"))
    # A bucket's first row follows the last row of the bucket above; that of the highest follows the lowest.
    ghosts = (
        inner.join(ends.select("segment", "bucket", "over"), ["segment", "bucket"], "left")
        .crossJoin(F.broadcast(lowest))
        .select(F.col("top").alias("doc_id_"), F.coalesce("above", "over", "lowest").alias("goes_to"), F.coalesce("above", "over").isNull().alias("wraps"))
    )
    if ghosts.count() <= SENT_ROWS:
        ghosts = F.broadcast(ghosts)
    dealt = rows.withColumn("bucket", bucket).join(ghosts, F.col("doc_id").eqNullSafe(F.col("doc_id_")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("ghost"))
    other = F.struct(F.col("goes_to").alias("bucket"), F.when(F.col("wraps"), 2).otherwise(1).alias("ghost"))
    placed = dealt.select("doc_id", "text", F.explode(F.when(F.col("goes_to").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("at"))
    placed = placed.select("doc_id", "text", F.col("at.bucket").alias("bucket"), F.col("at.ghost").alias("ghost"))
    return placed.withColumn("next_text", next_of("text"))


def next_of(column: str) -> Column:
    order = [F.col("ghost").asc(), F.col("doc_id").desc_nulls_last(), F.col("text").asc()]
    return F.lead(column).over(Window.partitionBy("bucket").orderBy(*order))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = 2) -> DataFrame:
    """Per row: doc_id, text, signatures and fingerprint of the text."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return with_signatures(rows, "text", "signatures", chain).withColumn("fingerprint", fingerprint("signatures"))


def edit_resistance(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = 2) -> DataFrame:
    """How fingerprints bear an edit: each text against itself with the last half replaced by the next document's begin.

    Returns doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited and near_next.
    """
    rows = with_next(docs, doc_id, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_signatures(rows.withColumn("edited_text", edited), "text", "signatures", chain)
    rows = rows.withColumn("next_signatures", next_of("signatures")).where("ghost = 0")
    rows = with_signatures(rows, "edited_text", "edited_signatures", chain)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited_text",
        fingerprint("signatures").alias("fingerprint"),
        fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )
