"""Language identification by cross-parsing against suffix automata.

For each language, labelled text makes a suffix automaton: a graph in which every path from the root
spells a substring of that text. A new text is parsed into phrases, each the longest match that the
automaton can follow; the language that needs the fewest phrases, normalised to bits per character
(phrases times the logarithm of the length of the language's text), wins. Whole texts are parsed.

Texts are lower-cased; every run of characters other than letters counts as one space. A text is
parsed in stretches of `STRETCH` characters, all stretches of a batch in step: a phrase ends at a
stretch's end for every language alike. The automata are fit on a bounded sample of the labelled rows
(`documents` distinct texts per language and `characters` of each, taken at a place given by the text's hash).

At most `MOST_LANGUAGES` languages can be learned; more are an error, as the automata would pass a worker's memory.

Cases: a text that is null or has no letter is "und" with score 0; so is every text if there is no
labelled one. Of equal languages the first by name wins. The score is one less the ratio of the best
to the second-best number of bits, 1 with only one language. Repeated rows get the same result; an
empty table gives an empty one. Columns named like an output are replaced, all others kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.batches import slices
from eventloom.llm.files import make_folder, open_input, open_output
from eventloom.llm.workspace import new_folder, written

STRETCH = 256
SLICE_BYTES = 1 << 20
UNDETERMINED = "und"
MOST_LANGUAGES = 200


@dataclass
class Automata:
    """Suffix automata of several languages as one table of steps.

    A step from state s (already times `width`) over class c leads to steps[s + c] >> 1; its lowest bit
    is set if a phrase ended before the character. Class 0 is padding and stays where it is, class 1 a
    letter that no sample has. Classes from `width` on are letters too rare for a column of their own:
    their steps are listed by state * `rare` + class - width in `keys`, and lead to `after`.
    """

    languages: list[str]
    classes: np.ndarray  # by code point
    width: int
    steps: np.ndarray
    roots: np.ndarray
    bits: np.ndarray  # logarithm of the length of each language's text
    rare: int
    keys: np.ndarray  # sorted
    after: np.ndarray
    lost: np.ndarray  # by language, the state after a letter that it doesn't have


def letters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts end to end, and their limits; other characters than letters are spaces."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    limits = np.cumsum([0, *map(len, lowered)])
    return np.where(_letter_table()[np.minimum(points, 0x10FFFF)], points, 32), limits


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """The transitions of each state, the root first."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        now = len(after)
        after.append({}), length.append(length[last] + 1), link.append(0)
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = now
            p = link[p]
        if p >= 0:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(after)
                after.append(dict(after[q])), length.append(length[p] + 1), link.append(link[q])
                while p >= 0 and after[p].get(c) == q:
                    after[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return after


def build(texts: dict[str, list[str]], most_classes: int = 127) -> Automata:
    """Automata from sample texts by language; letters beyond the most frequent ones have sparse steps."""
    joined = {}
    for language in sorted(texts):
        points, limits = letters_of([" " + t for t in texts[language]])
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        joined[language] = points[keep]
    every = np.concatenate([*joined.values(), [32]])
    value, count = np.unique(every, return_counts=True)
    value = value[np.lexsort((value, -count))]
    common, others = value[: most_classes - 1], value[most_classes - 1 :]
    width = 1 << int(len(common) + 1).bit_length()
    classes = np.full(0x110000, 1, np.uint8 if not len(others) else np.int32)  # 1: a letter that no sample has
    classes[common] = np.arange(2, len(common) + 2)
    classes[others] = np.arange(width, width + len(others))
    tables, roots, losts, base = [], [], [], 0
    keys, after_rare = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for points in joined.values():
        after = suffix_automaton(classes[points].tolist())
        source = np.repeat(np.arange(len(after)), [len(a) for a in after])
        label = np.fromiter((c for a in after for c in a), np.int64, len(source))
        target = np.fromiter((s for a in after for s in a.values()), np.int64, len(source))
        sparse = label >= width
        keys.append((source[sparse] + base) * len(others) + label[sparse] - width), after_rare.append(target[sparse] + base)
        source, label, target = source[~sparse], label[~sparse], target[~sparse]
        lost = len(after)  # a letter that this language doesn't have was a phrase of its own
        table = np.zeros((lost + 1, width), np.int64)
        first = np.full(width, lost, np.int64)
        first[label[source == 0]] = target[source == 0]
        table[:] = (first + base) * width * 2 + 1  # no match: a new phrase begins
        table[0] -= 1  # the root is where the first phrase begins
        table[source, label] = (target + base) * width * 2
        table[:, 0] = (np.arange(lost + 1) + base) * width * 2
        tables.append(table)
        roots.append(base * width), losts.append(lost + base)
        base += lost + 1
    kind = np.int32 if base * width * 2 < 1 << 31 else np.int64
    steps = np.concatenate([t.astype(kind).ravel() for t in tables]) if tables else np.empty(0, kind)
    bits = np.array([np.log2(max(2, len(p))) for p in joined.values()])
    key, to = np.concatenate(keys), np.concatenate(after_rare)
    order = np.argsort(key)
    return Automata(list(joined), classes, width, steps, np.array(roots, kind), bits, len(others), key[order], to[order], np.array(losts, np.int64))


def _rare_steps(model: Automata, state: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The entries that `steps` would have, for states by language (rows) and rare classes (columns)."""

    def look(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = states * np.int64(model.rare) + (letters.astype(np.int64) - model.width)
        i = np.minimum(np.searchsorted(model.keys, wanted), len(model.keys) - 1)
        return model.keys[i] == wanted, model.after[i]

    here = state.astype(np.int64) // model.width
    root = (model.roots.astype(np.int64) // model.width)[:, None]
    held, to = look(here)
    begun, first = look(np.broadcast_to(root, here.shape))
    to = np.where(held, to, np.where(begun, first, model.lost[:, None]))
    return to * model.width * 2 + (~held & (here != root))


def sample(labelled: DataFrame, text: str = "text", lang: str = "lang", documents: int = 60, characters: int = 700) -> dict[str, list[str]]:
    """Up to so many distinct texts of each language, a stretch of so many characters of each.

    Those with the lowest hashes of each language are taken, however many copies there are of any text.
    Each task and each merge keeps at most `documents` hashes of a language; what reaches the driver is
    bounded by languages * documents * characters.
    """
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = F.xxhash64("text")
    lowest = written(_lowest(rows.select("lang", order.alias("order")), documents), "language-sample")
    found = lowest.groupBy("lang").agg(F.max("order").alias("last")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; at most {MOST_LANGUAGES} can be learned")
    if not found:
        return {}
    last = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], r["last"])])
    place = F.pmod(order, F.greatest(F.length("text") - characters, F.lit(1))).cast("int") + 1
    chosen = rows.where(order <= last[F.col("lang")])
    chosen = chosen.select("lang", order.alias("order"), F.substring("text", place, F.lit(characters)).alias("text")).distinct()
    out: dict[str, list[str]] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["order"], r["text"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def _lowest(rows: DataFrame, documents: int) -> DataFrame:
    """(lang, order): the lowest distinct numbers of each language, so many at most."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes, order = names.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for k, name in enumerate(names.dictionary.to_pylist()):
                own = np.concatenate([held.get(name, order[:0]), order[codes == k]])
                held[name] = np.unique(own)[:documents]
            if len(held) > MOST_LANGUAGES:
                break  # more than can be learned, as the driver will see
        names, numbers = [n for n, own in held.items() for _ in own], [np.empty(0, np.int64), *held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(numbers))], names=["lang", "order"])

    # Spark applies the limit by rank within each task too, before rows are dealt by language.
    distinct = rows.mapInArrow(keep, "lang string, order long").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    return distinct.withColumn("rank", rank).where(F.col("rank") <= documents).drop("rank")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", documents: int = 60, characters: int = 700) -> Automata:
    return build(sample(labelled, text, lang, documents, characters))


def phrases(model: Automata, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of phrases by text and language, number of characters, and whether a text has a letter."""
    points, limits = letters_of(texts)
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(limits))
    letter = points != 32
    has = np.bincount(owner, weights=letter, minlength=n) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    points, owner = points[keep], owner[keep]
    sizes = np.bincount(owner, minlength=n)
    lanes = -(-sizes // STRETCH)
    total = int(lanes.sum())
    counts = np.zeros((len(model.languages), n))
    if not total or not model.languages:
        return counts, sizes, has
    first = np.cumsum(lanes) - lanes
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    matrix = np.zeros((STRETCH, total), model.classes.dtype)
    matrix[place % STRETCH, first[owner] + place // STRETCH] = model.classes[points]
    lane_owner = np.repeat(np.arange(n), lanes)
    for low in range(0, total, 4096):
        part = matrix[:, low : low + 4096]
        state = np.repeat(model.roots[:, None], part.shape[1], axis=1)
        ended = np.ones(state.shape, np.int32)
        for row in part:
            if model.rare and len(sparse := np.flatnonzero(row >= model.width)):
                step = model.steps.take(state + np.where(row < model.width, row, 0))
                step[:, sparse] = _rare_steps(model, state[:, sparse], row[sparse])
            else:
                step = model.steps.take(state + row)
            ended += step & 1
            state = step >> 1
        for k in range(len(model.languages)):
            counts[k] += np.bincount(lane_owner[low : low + 4096], weights=ended[k], minlength=n)
    return counts, sizes, has


def identify(df: DataFrame, model: Automata, text: str = "text") -> DataFrame:
    """Add lang_pred, score, lang_phrases (of the winner) and lang_chars (what was parsed).

    The automata are written below the shared folder once and memory-mapped by the workers. A column
    that stays is sent to them once, also if it is the text.
    """
    outputs = [("lang_pred", T.StringType(), pa.string()), ("score", T.DoubleType(), pa.float64()), ("lang_phrases", T.LongType(), pa.int64()), ("lang_chars", T.LongType(), pa.int64())]
    kept = [c for c in df.columns if c.lower() not in [name for name, *_ in outputs]]
    n = len(kept)
    place = next((i for i, c in enumerate(kept) if c.lower() == text.lower()), n)
    rows = df.select(*[F.col(f"`{c}`") for c in kept], *([F.col(f"`{text}`").alias("source_of_lang")] if place == n else []))
    schema = T.StructType([*rows.schema.fields[:n], *[T.StructField(name, kind) for name, kind, _ in outputs]])
    folder = store(model, new_folder(df.sparkSession, "automata"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = load(folder)
        for batch in batches:
            for part in slices(batch, place, SLICE_BYTES):
                found = _judge(mine, part.column(place).to_pylist())
                columns = [pa.array(c, kind) for c, (*_, kind) in zip(found, outputs)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


ARRAYS = ("classes", "steps", "roots", "bits", "keys", "after", "lost")


def store(model: Automata, folder: str) -> str:
    """Write the automata below a folder: a file of the bytes of each array, and one that names them."""
    make_folder(folder)
    kinds = {}
    for name in ARRAYS:
        array = getattr(model, name)
        kinds[name] = array.dtype.str
        with open_output(f"{folder}/{name}") as file:
            file.write(array.tobytes())
    with open_output(f"{folder}/model.json") as file:
        file.write(json.dumps({"languages": model.languages, "width": model.width, "rare": model.rare, "kinds": kinds}).encode())
    return folder


def load(folder: str) -> Automata:
    """The stored automata; where the folder is on a local file system, as memory maps that all workers share."""
    with open_input(f"{folder}/model.json") as file:
        said = json.loads(file.read())
    arrays = {}
    for name, kind in said["kinds"].items():
        with open_input(f"{folder}/{name}") as file:
            arrays[name] = np.frombuffer(file.read_buffer(), kind)
    return Automata(languages=said["languages"], width=said["width"], rare=said["rare"], **arrays)


def rejected() -> F.Column:
    """Whether what `identify` found speaks against every language: no letters, or phrases of under two characters on average."""
    return (F.col("lang_pred") == UNDETERMINED) | (2 * (F.col("lang_phrases") - 1) > F.col("lang_chars"))


def _judge(model: Automata, texts: list[str | None]) -> tuple[list, list, list, list]:
    counts, sizes, has = phrases(model, texts)
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), [0] * len(texts), sizes.tolist()
    bits = counts * model.bits[:, None] / np.maximum(sizes, 1)
    best = np.argmin(bits, axis=0)
    ordered = np.sort(bits, axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = 1 - ordered[0] / ordered[1] if len(ordered) > 1 else np.ones(len(texts))
    return (
        [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has)],
        [float(s) if h else 0.0 for s, h in zip(score, has)],
        counts[best, np.arange(len(texts))].astype(np.int64).tolist(),
        sizes.tolist(),
    )
