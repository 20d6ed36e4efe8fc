"""Exact Jaccard join of word shingle sets by a token-group matrix.

A document is the set of its distinct shingles of n words. Two documents link when 100 times the
size of the intersection is at least `percent` times that of the union. The join finds every class
of documents connected by links, and loses no link between different sets.

1. Equal sets become one node, known by the hash of the set.
2. Grouping. A set of n tokens shares at least t n with each partner. In the order of the tokens'
   hashes, the first n - ceil(t n) + l(n) of a linked pair so have the l(n) of the smaller set in
   common. Those prefixes are posted; a token of one node only joins nothing, and a node with fewer
   repeated tokens than its partners would share with it has no partner and is done. Of a node's r
   repeated tokens, the rarest r - m + 1 contain a common one, m being what any partner shares. Nodes
   that meet in one of those come into the same family, and all links lie within families. Passages
   that many documents share make no family: their tokens are the most frequent ones.
3. Each family is cut into groups of documents of like size, bounded in rows and tokens.
4. The matrix holds, for each group, the union of its tokens. A query's overlap with the union
   bounds its overlap with every member, so groups that can't hold a partner stay closed. Inside an
   opened group all overlaps come from one product of 0/1 matrices.
   Groups are opened for their own members; then for those of the family's first group; then only
   for documents that are still outside the class of that group, as links inside a class
   change nothing. Of such a document, the tokens of its prefix that are in no other prefix of the
   family bound the size of a partner, and groups without that size stay closed. A family of near copies of
   any size so costs a few openings for each group.
5. Links join to components; the smallest document id names each.

Cases: a text with fewer than n words is one shingle of all of them; null texts and texts without
words are empty sets, linked with nothing. Repeated rows are members of the same class; null ids
come out as null with the class of their set. An empty table gives an empty result. Only the two
named columns are read. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.components import connected_components
from eventloom.llm.shingles import mix, shingle_sets
from eventloom.llm.workspace import written

#: A group's bounds: so many tokens together, a document counting as FLOOR tokens at least.
GROUP_TOKENS, FLOOR = 131_072, 1024
#: A table of family members up to so many rows (some 40 bytes each) is sent to all executors.
SENT_ROWS = 1_000_000
#: Tokens of more nodes than this count as equally frequent.
FREQUENT = 4096


def shared_prefix(n: int, percent: int) -> int:
    """How many tokens the prefix of a set of n tokens has in common with that of a partner as large or larger: l(n)."""
    return max(1, min(-(-n * percent // 100), 3 * n * (100 - percent) // 200))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + shared_prefix(n, percent)


def largest_sharing(x: int, percent: int) -> int:
    """The largest n with l(n) <= x, for x from 1."""
    return max(100 * x // percent, (200 * (x + 1) - 1) // max(1, 3 * (100 - percent)))


def least_shared(size: Column, percent: int) -> Column:
    """What the prefix of a set shares with that of any partner: the l of the smallest partner it can have."""
    share = lambda c: F.floor((c * percent + 99) / 100)
    partner = share(size)
    return F.greatest(F.lit(1), F.least(share(partner), F.floor(3 * partner * (100 - percent) / 200)))


def set_digest(tokens: np.ndarray) -> np.uint64:
    return mix(np.array([np.add.reduce(mix(tokens)) + np.uint64(len(tokens))], np.uint64))[0]


def profiles(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, size of its set, node (hash of the set); docs: columns doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for _, tokens, limits in shingle_sets(batch.column(1), n):
                edges = limits.tolist()
                sizes += np.diff(limits).tolist()
                nodes += [int(set_digest(tokens[a:b]).view(np.int64)) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], names=["doc_id", "size", "node"]
            )

    return docs.mapInArrow(run, "doc_id long, size long, node long")


EMPTY = int(set_digest(np.empty(0, np.uint64)).view(np.int64))


def nodes(df: DataFrame, n: int, name: str, text: str = "text") -> DataFrame:
    """Add to any rows the hash of the set of a text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, tokens, limits in shingle_sets(batch.column(batch.num_columns - 1), n):
                edges = limits.tolist()
                found += [int(set_digest(tokens[a:b]).view(np.int64)) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=schema.names)

    rows = df.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{text}`").alias("source_of_" + name))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(name, T.LongType())])
    return rows.mapInArrow(run, schema)


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, node) in order, those whose key more than one node has, with the number of its nodes up to FREQUENT."""
    last, frequent = np.empty((2, 0), np.int64), False  # the open key's rows; of a frequent one, its last row, already given

    def rows_of(rows: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
        kept = held > 1
        columns = [pa.array(rows[0][kept]), pa.array(rows[1][kept]), pa.array(held[kept], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "node", "held"])

    for batch in batches:
        rows = np.concatenate([last, np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))])], axis=1)
        if not rows.shape[1]:
            continue
        rows = rows[:, np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)])]
        begins = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
        counts = np.diff(begins, append=rows.shape[1])
        if frequent:
            counts[0] += FREQUENT
        held = np.repeat(np.minimum(counts, FREQUENT), np.diff(begins, append=rows.shape[1]))
        given, end = int(frequent), int(begins[-1])
        frequent = bool(counts[-1] >= FREQUENT)
        if frequent:
            last, end = rows[:, -1:], rows.shape[1]
        else:
            last = rows[:, end:]
        yield rows_of(rows[:, given:end], held[given:end])
    if not frequent and last.shape[1] > 1:
        yield rows_of(last, np.full(last.shape[1], last.shape[1]))


def hang(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of a batch: the smallest node of each part they connect, with each other node of it."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = np.split(at, 2)
    least = np.arange(len(names))
    while (least[a] != least[b]).any():
        low = np.minimum(least[a], least[b])
        for ends in (a, b, least[a], least[b]):
            np.minimum.at(least, ends, low)
        while (least[least] != least).any():
            least = least[least]
    others = least != np.arange(len(names))
    return names[least[others]], names[others]


def _met(docs: DataFrame, sizes: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs of nodes (a, b) that meet in a posting; they connect all that meet, not every pair is named:
    those that meet in a batch hang on the smallest of them, so that a family has no long chains.

    sizes: node and size of each distinct set.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies need not post again; forgotten from time to time, which only repeats rows
        for batch in batches:
            for _, tokens, limits in shingle_sets(batch.column(1), n):
                edges, keys, nodes = limits.tolist(), [], []
                for a, b in zip(edges, edges[1:]):
                    if a < b and (node := int(set_digest(tokens[a:b]).view(np.int64))) not in seen:
                        seen.add(node)
                        keys.append(tokens[a : a + prefix_length(b - a, percent)])
                        nodes.append(np.full(len(keys[-1]), node))
                if len(seen) > 500_000:
                    seen = set()
                if keys:
                    columns = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "node"])

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre = None, None  # the open key and its smallest node
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nodes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            centres = nodes[begins]
            if keys[0] == key:
                centres[0] = centre
            key, centre = keys[-1], centres[-1]
            a, b = hang(np.repeat(centres, np.diff(begins, append=len(keys))), nodes)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    in_order = lambda rows: rows.repartition("key").sortWithinPartitions("key", "node")
    found = in_order(docs.mapInArrow(post, "key long, node long")).mapInArrow(repeated, "key long, node long, held int")
    # A window holds the tokens of one set.
    own = Window.partitionBy("node")
    ranked = found.withColumn("repeated", F.count("*").over(own)).withColumn("rank", F.row_number().over(own.orderBy("held", "key")))
    ranked = ranked.join(sizes.select("node", "size"), "node")
    posted = ranked.where(F.col("rank") <= F.col("repeated") - least_shared(F.col("size"), percent) + 1).select("key", "node")
    return in_order(posted).mapInArrow(stars, "a long, b long").distinct()


def _groups(members: DataFrame) -> DataFrame:
    """members (node, family, size, doc_id) with the number of their group in the family and the family's groups.

    A family's documents are laid out by size; equal sizes are spread by hash. The layout is summed
    over distinct sizes, of which a family has few, not over its documents.
    """
    weight = F.greatest("size", F.lit(FLOOR))
    sizes = members.groupBy("family", "size").agg(F.count("*").alias("alike"))
    before = Window.partitionBy("family").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("family")
    laid = sizes.select(
        "family",
        "size",
        "alike",
        F.coalesce(F.sum(F.col("alike") * weight).over(before), F.lit(0)).alias("begin"),
        F.sum(F.col("alike") * weight).over(whole).alias("all"),
    )
    place = F.col("begin") + F.pmod(F.xxhash64("node"), F.col("alike")) * weight
    return members.join(laid, ["family", "size"]).select(
        "node", "family", "size", "doc_id",
        F.floor(place / GROUP_TOKENS).alias("group"),
        (F.col("all") > GROUP_TOKENS).alias("many"),
    )


def overlaps(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set with each other, by products of 0/1 matrices, some tokens at a time."""
    a, b = np.concatenate(rows), np.concatenate(columns)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(rows), len(columns)), np.int64)
    if not len(shared):
        return out

    def places(sets: list[np.ndarray], tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
        hit = shared[at] == tokens
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]

    (ra, ta), (rb, tb) = places(rows, a), places(columns, b)
    step = 8192
    for low in range(0, len(shared), step):
        one, two = (np.zeros((len(s), min(step, len(shared) - low)), np.float32) for s in (rows, columns))
        for matrix, r, t in ((one, ra, ta), (two, rb, tb)):
            here = (t >= low) & (t < low + step)
            matrix[r[here], t[here] - low] = 1
        out += (one @ two.T).astype(np.int64)
    return out


def links_between(rows: list[np.ndarray], columns: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every linked pair of sets."""
    both = overlaps(rows, columns)
    union = np.array([len(s) for s in rows])[:, None] + np.array([len(s) for s in columns])[None, :] - both
    return np.nonzero((100 * both >= percent * union) & (both > 0))


def _spanning(pairs: Iterator[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Of links between n documents, those that first join two parts."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _unpack(tokens: bytes, sizes: list[int]) -> list[np.ndarray]:
    return np.split(np.frombuffer(tokens, np.uint64), np.cumsum(sizes)[:-1])


GROUP = "family long, group long, many boolean, nodes array<long>, sizes array<long>, tokens binary, a array<long>, b array<long>"


def _opened(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """One row for each group: its members' nodes, and links that join them; their sets only where the family has more groups."""
    kinds = [("family", pa.int64()), ("group", pa.int64()), ("many", pa.bool_()), ("nodes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("tokens", pa.binary()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]

    def run(table: pa.Table) -> pa.Table:
        nodes, sets, known = [], [], set()
        for node, text in zip(table["node"].to_pylist(), table["text"].to_pylist()):
            for _, tokens, limits in shingle_sets(pa.array([text], pa.string()), n):
                # Repeated ids bring other texts too, and repeated rows the same one.
                if node not in known and len(tokens) and int(set_digest(tokens).view(np.int64)) == node:
                    known.add(node), nodes.append(node), sets.append(tokens)
        links = _spanning(zip(*(x.tolist() for x in links_between(sets, sets, percent))), len(sets)) if len(sets) > 1 else []
        many = table["many"][0].as_py()
        row = {
            "family": [table["family"][0].as_py()], "group": [table["group"][0].as_py()], "many": [many],
            "nodes": [nodes], "sizes": [[len(s) for s in sets]], "tokens": [np.concatenate(sets).tobytes() if many and sets else b""],
            "a": [[nodes[x] for x, _ in links]], "b": [[nodes[y] for _, y in links]],
        }
        return pa.Table.from_pydict(row, pa.schema(kinds))

    return texts.groupBy("family", "group").applyInArrow(run, GROUP)


def _across(queries: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the members of query rows and of the other groups of their family.

    A group is opened only for queries whose overlap with the union of its tokens allows a link.
    """
    if "highs" not in queries.columns:
        queries = queries.withColumn("highs", F.transform("sizes", lambda s: F.floor(s * 100 / percent)))
    q = queries.select("family", *[F.col(c).alias(f"q_{c}") for c in ("group", "nodes", "sizes", "tokens", "highs")])
    rows = q.join(groups.select("family", "group", "nodes", "sizes", "tokens"), "family").where(
        (F.array_max("q_highs") >= F.array_min("sizes")) & (F.array_max("sizes") * 100 >= F.array_min("q_sizes") * percent)
    ).select("q_nodes", "q_sizes", "q_highs", "q_tokens", "nodes", "sizes", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_nodes, q_sizes, q_highs, q_tokens, nodes, sizes, tokens = (c[i].as_py() for c in batch.columns)
                members = _unpack(tokens, sizes)
                union, low, high = np.unique(np.frombuffer(tokens, np.uint64)), min(sizes), max(sizes)
                wanted = []
                for node, most, own in zip(q_nodes, q_highs, _unpack(q_tokens, q_sizes)):
                    if most < low or 100 * high < percent * len(own):
                        continue
                    at = np.minimum(np.searchsorted(union, own), len(union) - 1)
                    bound = int((union[at] == own).sum())
                    if 100 * bound >= percent * (len(own) + max(low, bound) - bound):
                        wanted.append((node, own))
                if not wanted:
                    continue
                x, y = links_between([s for _, s in wanted], members, percent)
                pairs = ((k, len(wanted) + m) for k, m in zip(x.tolist(), y.tolist()))
                names = [node for node, _ in wanted] + nodes
                links = [(names[k], names[m]) for k, m in _spanning(pairs, len(names)) if names[k] != names[m]]
                # A query that is itself a member ties both of its places together, which is right.
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def jaccard_classes(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, size (of its shingle set), node (hash of the set), component and class (its smallest node)."""
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    profile = written(profiles(docs, n), "jaccard-profiles")
    filled = profile.where("size > 0")
    reps = filled.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"))
    families = connected_components(_met(docs, reps, n, percent), "jaccard-families").withColumnRenamed("component", "family")
    members = written(_groups(families.join(reps, "node").select("node", "family", "size", "doc_id")), "jaccard-members")
    wanted = members.select(F.col("doc_id").alias("rep"), "node", "family", "group", "many")
    if wanted.count() <= SENT_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"])).select("family", "group", "many", "node", "text")
    groups = written(_opened(texts, n, percent), "jaccard-groups")
    links = groups.select(F.explode(F.arrays_zip("a", "b")).alias("l")).select("l.a", "l.b")
    large = groups.where("many AND size(nodes) > 0")
    if not large.isEmpty():
        first = large.groupBy("family").agg(F.min("group").alias("group"))
        links = links.unionByName(_across(large.join(first, ["family", "group"]), large, percent))
        classes = connected_components(links, "jaccard-classes")
        outside = written(_outside(large, first, classes), "jaccard-outside")
        more = _across(_bounded(outside, large, percent), large, percent)
        links = classes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    classes = connected_components(links, "jaccard-links")
    named = classes.join(reps, "node").select("node", "component", "doc_id")
    named = named.join(named.groupBy("component").agg(F.min("doc_id").alias("least")), "component").select("node", "least", F.col("component").alias("class"))
    copies = reps.select("node", F.col("doc_id").alias("own"))
    least = copies.join(named, "node", "left").select("node", F.coalesce("least", "own").alias("component"), F.coalesce("class", "node").alias("class"))
    return profile.join(least, "node", "left").select("doc_id", "size", "node", F.coalesce("component", "doc_id").alias("component"), "class")


def _outside(groups: DataFrame, first: DataFrame, classes: DataFrame) -> DataFrame:
    """Groups cut down to the members that aren't in the class most members of the family's first group are in."""
    each = groups.select("family", "group", F.posexplode("nodes").alias("at", "node"))
    known = each.join(classes, "node", "left").select("family", "group", "at", F.coalesce("component", "node").alias("component"))
    head = known.join(first, ["family", "group"]).groupBy("family", "component").agg(F.count("*").alias("held"))
    head = head.groupBy("family").agg(F.max_by("component", F.struct("held", "component")).alias("head"))
    rest = known.join(head, "family").where("component <> head").groupBy("family", "group").agg(F.collect_set("at").alias("rest"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sets = _unpack(row["tokens"], row["sizes"])
                kept = sorted(row.pop("rest"))
                row["nodes"], row["sizes"] = ([row[c][k] for k in kept] for c in ("nodes", "sizes"))
                row["tokens"] = np.concatenate([sets[k] for k in kept]).tobytes()
                yield pa.RecordBatch.from_pylist([row], pa.schema([f for f in batch.schema if f.name != "rest"]))

    rows = groups.join(rest, ["family", "group"]).select("family", "group", "nodes", "sizes", "tokens", "rest")
    return rows.mapInArrow(cut, "family long, group long, nodes array<long>, sizes array<long>, tokens binary")


def _bounded(outside: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Groups cut down to the members that may have a partner in their family, with the largest size (highs) it can have.

    Of the tokens in q's prefix, x are in other prefixes of the family. A partner d has l(|d|) <= x, as the
    prefixes of both hold that many common tokens.
    """

    def prefixes(tokens: bytes, sizes: list[int]) -> list[np.ndarray]:
        return [t[: prefix_length(len(t), percent)] for t in _unpack(tokens, sizes)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for family, sizes, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                token, held = np.unique(np.concatenate(prefixes(tokens, sizes)), return_counts=True)
                columns = [pa.array(np.full(len(token), family)), pa.array(token.view(np.int64)), pa.array(held.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["family", "token", "held"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for family, group, sizes, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                own = prefixes(tokens, sizes)
                token, at = np.concatenate(own).view(np.int64), np.repeat(np.arange(len(sizes)), [len(t) for t in own])
                columns = [pa.array(np.full(len(token), family)), pa.array(np.full(len(token), group)), pa.array(at), pa.array(token)]
                yield pa.RecordBatch.from_arrays(columns, names=["family", "group", "at", "token"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sets, highs, kept = _unpack(row["tokens"], row["sizes"]), [], []
                for at, x in sorted((r["at"], r["x"]) for r in row["found"]):
                    size, most = row["sizes"][at], largest_sharing(x, percent)
                    if 100 * most >= percent * size:
                        kept.append(at), highs.append(min(most, 100 * size // percent))
                if kept:
                    new = {"family": row["family"], "group": row["group"], "highs": highs, "tokens": np.concatenate([sets[k] for k in kept]).tobytes()}
                    new |= {c: [row[c][k] for k in kept] for c in ("nodes", "sizes")}
                    yield pa.RecordBatch.from_pylist([new], schema)

    schema = pa.schema([("family", pa.int64()), ("group", pa.int64()), ("nodes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("tokens", pa.binary()), ("highs", pa.list_(pa.int64()))])
    shared = groups.select("family", "sizes", "tokens").mapInArrow(count, "family long, token long, held long")
    shared = shared.groupBy("family", "token").agg(F.sum("held").alias("held")).where("held > 1")
    spelled = outside.select("family", "group", "sizes", "tokens").mapInArrow(spell, "family long, group long, at long, token long")
    found = spelled.join(shared, ["family", "token"], "left_semi").groupBy("family", "group", "at").agg(F.count("*").alias("x"))
    found = found.groupBy("family", "group").agg(F.collect_list(F.struct("at", "x")).alias("found"))
    rows = outside.join(found, ["family", "group"]).select("family", "group", "nodes", "sizes", "tokens", "found")
    return rows.mapInArrow(cut, "family long, group long, nodes array<long>, sizes array<long>, tokens binary, highs array<long>")
