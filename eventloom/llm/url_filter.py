"""URL filter: a sorted array of 64-bit digests, probed by binary search in a memory map.

`build_rules` sorts rule strings by their xxhash64 into shards of Arrow files in the shared folder;
nothing passes through the driver but one line per shard. `judge` makes, for every URL, all rule
strings that could fit it (host suffixes and path prefixes of the lengths that rules have), probes
the digests of a whole batch at once and compares the stored strings, so that a digest collision
can't decide. The longest rule that fits gives the verdict.

Cases: a null URL, or one without `://`, has an empty host and path and gets the default verdict, as
does any URL without a fitting rule. Rules that occur repeatedly count once; of two verdicts for one
rule, "block" holds. Null rules are left out. With no rules, every URL gets the default. All columns
of the pages are kept but those named like an output, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.files import make_folder, open_input, open_output
from eventloom.llm.workspace import new_folder, written

RULES_PER_SHARD = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class RuleFiles:
    """Shards as (lowest digest, file), ascending; the lengths that rules have, of host and path."""

    shards: tuple[tuple[int, str], ...]
    lengths: tuple[tuple[int, int], ...]


def digest(text: str) -> int:
    """What Spark's xxhash64 gives: seed 42, read as a signed integer."""
    value = xxhash.xxh64_intdigest(text, seed=42)
    return value - (1 << 64) if value >> 63 else value


def build_rules(rules: DataFrame, shards: int | None = None, rule: str = "rule", verdict: str = "verdict") -> RuleFiles:
    """Write the sorted digest array of rule strings (host and path, like `example.net/en/`).

    Without a number of shards there is one for each `RULES_PER_SHARD` rows.
    """
    shards = shards or 1 + rules.count() // RULES_PER_SHARD
    spark = rules.sparkSession
    folder = new_folder(spark, "url-rules")
    make_folder(folder)
    rows = (
        rules.where(F.col(rule).isNotNull() & F.col(rule).contains("/"))
        .groupBy(F.col(rule).alias("rule"))
        .agg(F.max((F.col(verdict) == "block").cast("int")).alias("block"))
        .select(F.xxhash64("rule").alias("digest"), "rule", F.col("block") == 1)
        .toDF("digest", "rule", "block")
        .repartitionByRange(shards, "digest")
        .sortWithinPartitions("digest", "rule")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        path = f"{folder}/{uuid.uuid4().hex}.arrow"
        with open_output(path) as out, pa.ipc.new_file(out, table.schema) as writer:
            writer.write_table(table)
        lengths = {(r.index("/"), len(r) - r.index("/")) for r in table["rule"].to_pylist()}
        listed = [{"host": h, "path": p} for h, p in sorted(lengths)]
        yield pa.RecordBatch.from_pydict(
            {"low": [table["digest"][0].as_py()], "path": [path], "lengths": [listed]},
            pa.schema([("low", pa.int64()), ("path", pa.string()), ("lengths", pa.list_(pa.struct([("host", pa.int32()), ("path", pa.int32())])))]),
        )

    found = written(rows.mapInArrow(write, "low long, path string, lengths array<struct<host: int, path: int>>"), "url-shards")
    lengths = found.select(F.inline("lengths")).distinct().collect()
    listed = sorted((r["low"], r["path"]) for r in found.select("low", "path").collect())
    return RuleFiles(tuple(listed), tuple(sorted((r["host"], r["path"]) for r in lengths)))


class DigestArray:
    """The shards, each memory-mapped on its first use."""

    def __init__(self, rules: RuleFiles):
        self.rules = rules
        self.lows = np.array([low for low, _ in rules.shards], np.int64)
        self.open: dict[int, tuple] = {}

    def shard(self, k: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
        if k not in self.open:
            batches = pa.ipc.open_file(open_input(self.rules.shards[k][1])).read_all().combine_chunks()
            self.open[k] = (
                batches["digest"].chunk(0).to_numpy(zero_copy_only=True),
                batches["rule"].chunk(0),
                batches["block"].chunk(0),
            )
        return self.open[k]

    def probe(self, texts: list[str]) -> list[bool | None]:
        """For each text: whether its rule blocks, or None if it is no rule."""
        out: list[bool | None] = [None] * len(texts)
        if not len(self.lows) or not texts:
            return out
        keys = np.fromiter(map(digest, texts), np.int64, len(texts))
        shard = np.searchsorted(self.lows, keys, side="right") - 1
        for k in np.unique(shard[shard >= 0]).tolist():
            stored, rule, block = self.shard(k)
            mine = np.flatnonzero(shard == k)
            low = np.searchsorted(stored, keys[mine], side="left")
            high = np.searchsorted(stored, keys[mine], side="right")
            for i, a, b in zip(mine[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                for j in range(a, b):
                    if rule[j].as_py() == texts[i]:
                        out[i] = block[j].as_py()
        return out


def url_parts(url: str) -> tuple:
    """Columns for host and path of a URL column."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^?#]*)", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1)


def judge(pages: DataFrame, rules: RuleFiles, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every page."""
    host, path = url_parts(url)
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    by_host: dict[int, list[int]] = {}
    for h, p in sorted(rules.lengths, reverse=True):
        by_host.setdefault(h, []).append(p)

    def fits(host: str, path: str) -> list[str]:
        """Longest first; of equal length, the longer host first. Only suffixes as long as a rule's host are made."""
        found = []
        for n, paths in by_host.items():
            if n == len(host) or n < len(host) and host[len(host) - n - 1] == ".":
                found += [host[len(host) - n :] + path[:m] for m in paths if m <= len(path)]
        return sorted(found, key=len, reverse=True)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(rules)
        for batch in batches:
            candidates = [
                fits(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            ]
            flat = list(dict.fromkeys(c for own in candidates for c in own))
            known = {c: b for c, b in zip(flat, array.probe(flat)) if b is not None}
            rule = [next((c for c in own if c in known), None) for own in candidates]
            verdict = [default if r is None else "block" if known[r] else "allow" for r in rule]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    from pyspark.sql import types as T

    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return parts.mapInArrow(probe, schema)
