"""Removal of word sequences that an earlier document has too, by prefix-partitioned suffix trees.

A window is a run of ``window`` consecutive words. Suffixes are grouped by a prefix: of all the word
n-grams of a window, the one of least hash is its anchor, so equal windows have equal anchors, and one
anchor serves some twenty neighbouring windows. The group of an anchor holds the stretches of text whose
windows it anchors. Only anchors found in two documents matter. Where a group would outgrow a task's
memory, its windows take longer n-grams as anchors, up to the whole window, whose group is a single
stretch: prefixes are as long as they need to be, and no occurrence is left out.

In each group a task builds the tree of all suffixes by doubling: the nodes at depth 2m are the distinct
pairs of nodes at depth m. A node at the depth of a window with leaves in two documents is a repeat, and
its least document keeps it. Neighbouring repeated windows join to maximal repeats.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import SPACES, map_texts, text_bytes
from usagelens.session import materialize

WINDOW = 50
LENGTHS = (10, 20, 30, 40, 50)
LAST = (1 << 63) - 1
#: Characters that a task works on at a time, about.
CHUNK = 1_000_000
BASE = 0x9E3779B97F4A7C15


#: Bytes whose words are hashed together; a longer word is hashed by itself.
BLOCK = 1 << 19
IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES.encode(), np.uint8))


@cache
def byte_powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, for blocks of up to 2^bits bytes."""
    one = np.full((1 << bits) - 1, BASE, np.uint64)
    back = np.full((1 << bits) - 1, pow(BASE, -1, 1 << 64), np.uint64)
    return tuple(np.concatenate([[np.uint64(1)], np.multiply.accumulate(x)]) for x in (one, back))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def block_hashes(block: np.ndarray) -> np.ndarray:
    """A hash of each word of some bytes, which does not depend on its place: a polynomial, mixed."""
    edges = np.diff((~IS_SPACE[block]).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, back = byte_powers(max(8, (len(block) - 1).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((block.astype(np.uint64) + np.uint64(1)) * powers[:len(block)])])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word of a text. Hashes only choose groups, in which the words themselves are compared."""
    data, at, out = text_bytes(text), 0, [np.zeros(0, np.uint64)]
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            # The block ends after its last space; without one it is a word of BLOCK bytes or more.
            last = max(data.rfind(c, at, end) for c in SPACES.encode())
            if last < 0:
                gap = re.compile(rb"[ \t\n\x0b\f\r]").search(data, end)
                end = gap.start() if gap else len(data)
                out.append(np.array([xxhash.xxh64_intdigest(data[at:end])], np.uint64))
                at = end
                continue
            end = last + 1
        out.append(block_hashes(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(out)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, from their word hashes: a polynomial modulo 2^64, whose
    value does not depend on the place, mixed once more."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
    powers = np.multiply.accumulate(np.full(len(hashes), power, np.uint64))
    back = np.multiply.accumulate(np.full(n, inverse, np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.add.accumulate(hashes * powers)])
    return mixed((sums[length:length + n] - sums[:n]) * back)


def least_in_run(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value in each run of ``width``."""
    at, size = np.arange(len(values)), 1
    while size * 2 <= width:
        left, right = at[:len(at) - size], at[size:]
        at = np.where(values[right] < values[left], right, left)
        size *= 2
    if size < width:
        left, right = at[:len(values) - width + 1], at[width - size:]
        at = np.where(values[right] < values[left], right, left)
    return at


def anchored(hashes: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window of a run of words (its place), and the hash of each n-gram."""
    if len(hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    values = run_hashes(hashes, length)
    return least_in_run(values, window - length + 1), values


def pieces(marks: np.ndarray, *others: np.ndarray) -> list[tuple[int, int]]:
    """Runs (first, last) of true ``marks`` in which the ``others`` do not change."""
    at = np.flatnonzero(marks)
    if not len(at):
        return []
    cut = np.diff(at) > 1
    for other in others:
        cut |= other[at[1:]] != other[at[:-1]]
    edges = np.flatnonzero(cut)
    return list(zip(at[np.r_[0, edges + 1]].tolist(), at[np.r_[edges, len(at) - 1]].tolist(), strict=True))


def pending_marks(size: int, runs: list[dict] | None) -> np.ndarray:
    """Which window starts are still to be placed; all of them without ``runs``."""
    if runs is None:
        return np.ones(size, bool)
    marks = np.zeros(size, bool)
    for run in runs:
        marks[run["first"]:run["last"] + 1] = True
    return marks


def document_anchors(texts: list[str | None], pending: list, length: int,
                     window: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The anchors of each text's pending windows: keys, and places."""
    keys, places = [], []
    for text, runs in zip(texts, pending, strict=True):
        at, values = anchored(word_hashes(text), length, window)
        if runs is not None:
            at = at[pending_marks(len(at), runs)]
        # Anchors of following windows never step back.
        chosen = at[np.flatnonzero(np.diff(at, prepend=-1))]
        keys.append(values[chosen].view(np.int64))
        places.append(chosen.astype(np.int32))
    return keys, places


def document_stretches(texts: list[str | None], pending: list, shared: list, length: int,
                       window: int) -> tuple[list[list[dict]], list[list[dict]]]:
    """For each text the stretches (key, first, words) of its shared anchors, and the runs of windows
    whose anchors have too large a group."""
    stretches, left = [], []
    for text, runs, marks in zip(texts, pending, shared, strict=True):
        words = text_bytes(text).split()
        at, values = anchored(word_hashes(text), length, window)
        state = np.zeros(len(values), np.int8)
        for mark in marks:
            state[mark["at"]] = 2 if mark["large"] else 1
        todo, kind = pending_marks(len(at), runs), state[at]
        stretches.append([
            {"key": int(values[at[a]].view(np.int64)), "first": a, "words": b" ".join(words[a:b + window]).decode("utf-8", "surrogatepass")}
            for a, b in pieces(todo & (kind == 1), at)])
        left.append([{"first": a, "last": b} for a, b in pieces(todo & (kind == 2))])
    return stretches, left


def tree_nodes(ids: np.ndarray, depth: int) -> np.ndarray:
    """The node at ``depth`` below which the suffix at each place lies; equal numbers, equal words.

    Doubles the depth as far as it fits, then joins two overlapping nodes. Suffixes shorter than
    ``depth`` have none and are left out at the end.
    """
    node, size = np.unique(ids, return_inverse=True)[1], 1
    while size < depth:
        step = min(size, depth - size)
        pairs = node[:len(node) - step].astype(np.int64) * (int(node.max(initial=0)) + 1) + node[step:]
        node, size = np.unique(pairs, return_inverse=True)[1], size + step
    return node


def repeats(stretches: list[str], least: np.ndarray, most: np.ndarray, window: int) -> list[list[dict]]:
    """For each stretch the runs (first, last: windows; least: a document) that a document has which
    is smaller than some document of the stretch.

    ``least`` and ``most``: the smallest and greatest document of each stretch.
    """
    numbers: dict[str, int] = {}
    split = [s.split(" ") for s in stretches]
    sizes = np.array([len(s) for s in split])
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for s in split for w in s), np.int64, int(sizes.sum()))
    node = tree_nodes(ids, window)
    owner = np.repeat(np.arange(len(split)), sizes)[:len(node)]
    place = np.arange(len(node)) - (np.cumsum(sizes) - sizes)[owner]
    whole = place + window <= sizes[owner]
    node, owner, place = node[whole], owner[whole], place[whole]
    first = np.full(int(node.max(initial=0)) + 1, LAST)
    np.minimum.at(first, node, least[owner])
    holder = first[node]
    out: list[list[dict]] = [[] for _ in stretches]
    for a, b in pieces(holder < most[owner], owner, holder):
        out[owner[a]].append({"first": int(place[a]), "last": int(place[b]), "least": int(holder[a])})
    return out


def _trees(stretches: DataFrame, window: int, batch_rows: int) -> DataFrame:
    """``repeats`` of the rows (key, words, low, high), which lie sorted by key in their partition."""
    schema = "key long, c1 long, c2 long, runs array<struct<first: int, last: int, least: long>>"
    runs_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("least", pa.int64())]))

    def solve(rows: pa.Table) -> pa.RecordBatch:
        runs = repeats(rows["words"].to_pylist(), rows["low"].to_numpy(), rows["high"].to_numpy(), window)
        names = ["key", "c1", "c2"]
        keep = np.fromiter((bool(r) for r in runs), bool, len(runs))
        columns = [rows[c].combine_chunks().filter(pa.array(keep)) for c in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array([r for r in runs if r], runs_type)], names=[*names, "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows < batch_rows:
                continue
            keys = held["key"].to_numpy()
            cuts = np.flatnonzero(np.diff(keys)) + 1
            if len(cuts):
                yield solve(held.slice(0, int(cuts[-1])))
                held = held.slice(int(cuts[-1])).combine_chunks()
        if held is not None and held.num_rows:
            yield solve(held)

    return stretches.mapInArrow(run, schema)


def _digest(words: Column) -> dict[str, Column]:
    """128 bits that stand for a stretch in joins."""
    return {"c1": F.xxhash64(words), "c2": F.xxhash64(F.lit("second"), words)}


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 lengths: tuple[int, ...] = LENGTHS, group_rows: int = 4_000) -> DataFrame:
    """(id, mark, first, last): runs of words of a document that a smaller document has too.

    ``id`` is the key, the greatest long for null; ``mark`` tells texts of one key apart.
    ``group_rows`` bounds the rows of a group in a task; ``lengths`` ends with ``window``.
    """
    docs = docs.select(*identity(key, text), F.col(text).alias("text"))
    pending: DataFrame | None = None
    levels = []
    for length in lengths:
        at_end = length == lengths[-1]
        source = docs.withColumn("runs", F.lit(None).cast("array<struct<first: int, last: int>>")) if pending is None \
            else docs.join(pending, ["id", "mark"])

        def start_anchors(length: int = length) -> Callable[..., list]:
            return lambda texts, runs: list(document_anchors(texts, runs, length, window))

        anchors = materialize(
            map_texts(source, "text", "key array<long>, at array<int>", start_anchors, ("runs",), CHUNK)
            .drop("text", "runs").where(F.size("key") > 0), "anchors")
        places = anchors.select("id", "mark", F.inline(F.arrays_zip("key", "at")))
        large = F.lit(False) if at_end else F.col("n") > group_rows
        # Stored, so that the join has a plain exchange on both sides and a very common key can be split.
        common = materialize(
            places.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
            .where("low < high").select("key", large.alias("large")), "shared-keys")
        # Equal rows of one key have the same anchors, which count once.
        marks = places.join(common, "key").groupBy("id", "mark").agg(
            F.collect_set(F.struct("at", "large")).alias("shared"))

        def start_stretches(length: int = length) -> Callable[..., list]:
            return lambda texts, runs, shared: list(document_stretches(texts, runs, shared, length, window))

        found = materialize(
            map_texts(source.join(marks, ["id", "mark"]), "text",
                      "stretches array<struct<key: long, first: int, words: string>>, "
                      "rest array<struct<first: int, last: int>>", start_stretches, ("runs", "shared"), CHUNK)
            .select("id", "mark", "stretches", "rest"), "stretches")
        levels.append(found.select("id", "mark", F.inline("stretches")).withColumnRenamed("first", "start"))
        # Stored, so that its size is known when the texts are joined with it, and a small one is broadcast.
        pending = materialize(found.where(F.size("rest") > 0).select("id", "mark", F.col("rest").alias("runs"))
                              .dropDuplicates(["id", "mark"]), "pending")
        if at_end or pending.isEmpty():
            break
    stretches = levels[0]
    for level in levels[1:]:
        stretches = stretches.union(level)
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = (stretches.groupBy("key", "words").agg(F.min("id").alias("low"), F.max("id").alias("high"))
              .withColumns(_digest(F.col("words"))).repartition(parallel, "key").sortWithinPartitions("key"))
    nodes = _trees(groups, window, batch_rows=8_000)
    places = stretches.select("id", "mark", "key", "start", *[c.alias(n) for n, c in _digest(F.col("words")).items()])
    return (places.join(nodes, ["key", "c1", "c2"])
            .select("id", "mark", "start", F.inline("runs")).where(F.col("least") < F.col("id"))
            .select("id", "mark", (F.col("start") + F.col("first")).alias("first"),
                    (F.col("start") + F.col("last") + (window - 1)).alias("last")))


def identity(key: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark")]


def covered(size: int, runs: list[dict] | None) -> np.ndarray:
    """Which of ``size`` words lie in a run."""
    change = np.zeros(size + 1, np.int64)
    for run in runs or []:
        change[run["first"]] += 1
        change[run["last"] + 1] -= 1
    return np.cumsum(change[:size]) > 0


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
          lengths: tuple[int, ...] = LENGTHS, group_rows: int = 4_000) -> DataFrame:
    """``docs`` with n_words, n_removed, removed (maximal runs of words: first, last) and kept, the
    other words joined by a space.

    A word goes if it lies in a window whose words also start in a document with a smaller key;
    windows are those of the input. A null key is greater than all others, and such rows never remove
    from each other. Rows of one key do not either, and equal rows of one key are treated alike, however
    many there are. Null, empty and short texts keep what they have.
    Columns of the new names are replaced.
    """
    found = find_repeats(docs, key, text, window, lengths, group_rows).groupBy("id", "mark").agg(
        F.collect_set(F.struct("first", "last")).alias("runs"))
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "removed", "kept")]
    base = docs.select(F.struct(*names).alias("row"), F.col(text).alias("text"), *identity(key, text))

    def make(texts: list[str | None], runs: list) -> list:
        sizes, gone, spans, kept = [], [], [], []
        for t, r in zip(texts, runs, strict=True):
            words = text_bytes(t).split()
            marks = covered(len(words), r)
            sizes.append(len(words))
            gone.append(int(marks.sum()))
            spans.append([{"first": a, "last": b} for a, b in pieces(marks)])
            rest = words if not gone[-1] else [words[i] for i in np.flatnonzero(~marks)]
            kept.append(b" ".join(rest).decode("utf-8", "surrogatepass"))
        return [sizes, gone, spans, kept]

    added = "n_words long, n_removed long, removed array<struct<first: int, last: int>>, kept string"
    joined = base.join(found, ["id", "mark"], "left").select("row", "text", "runs")
    out = map_texts(joined, "text", added, lambda: make, ("runs",), CHUNK)
    return out.select("row.*", "n_words", "n_removed", "removed", "kept")
