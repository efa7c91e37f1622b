"""Packing of encoded documents into sequences of one length by first-fit decreasing.

A document's ids are cut into blocks of the sequence length and a rest. Blocks and rests are dealt into
groups at random, each group is packed by itself: the longest first, each into the first sequence that
still has room, which a tournament tree over the free places of all sequences finds in logarithmic
time. A group has a few thousand pieces of bounded size, so it fits a task whatever the corpus is, and
rests of all sizes meet in it, so little is left free.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from usagelens.llm.bpe import byte_characters
from usagelens.llm.common import map_texts

ID_BYTES = 4
# Fixed value: the word pattern of byte-level BPE vocabularies that name none.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteVocabulary:
    """A byte-level BPE vocabulary: ``ranks``: id of each byte string; ``special``: ids of strings that
    are tokens as they stand; ``content``: the file. Sent to tasks as such, encoders are made there."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], content: str) -> None:
        self.ranks, self.special, self.content = ranks, special, content

    def __reduce__(self) -> tuple:
        return ByteVocabulary, (self.ranks, self.special, self.content)

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens=self.special)

    @cached_property
    def slow(self) -> Tokenizer:
        return Tokenizer.from_str(self.content)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, special strings being one id each.

        The faster of two engines takes no runs of about a million white-space characters; the other
        one, with the same ids, encodes such texts.
        """
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def read_byte_vocabulary(path: str) -> ByteVocabulary:
    """Read a tokenizers file of byte-level BPE.

    Ids must follow the order of the merges, so that the pair of lowest rank is the one whose merged
    token has the lowest id; other files are refused.
    """
    with open(path, encoding="utf-8") as file:
        content = file.read()
    data = json.loads(content)
    model, splitter = data["model"], data["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if data["normalizer"] or model["type"] != "BPE" or any(splitter.get(k) != v for k, v in plain.items()):
        raise ValueError(f"{path}: not byte-level BPE without a normalizer")
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in pairs]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    ranks = {bytes(byte_of[c] for c in token): number for token, number in model["vocab"].items()
             if token not in special}
    return ByteVocabulary(ranks, special, content)


def pieces(docs: DataFrame, vocabulary: ByteVocabulary, key: str, text: str, size: int, end: int) -> DataFrame:
    """(key, doc_tokens, start, ids): each document's ids with ``end`` after them, cut into pieces of
    ``size`` and a rest; ids are little-endian unsigned 32-bit integers. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def start() -> Callable[[list[str | None]], list]:
        encode = shared.value.encode

        def make(texts: list[str | None]) -> list:
            counts, cut = [], []
            for t in texts:
                ids = np.append(encode(t or ""), end).astype("<u4").tobytes()
                counts.append(len(ids) // ID_BYTES)
                cut.append([ids[i:i + size * ID_BYTES] for i in range(0, len(ids), size * ID_BYTES)])
            return [counts, cut]

        return make

    made = map_texts(docs.select(F.col(key).alias("id"), F.col(text).alias("content")), "content",
                     "doc_tokens long, cut array<binary>", start)
    return made.select(F.col("id").alias(key), "doc_tokens", F.posexplode("cut").alias("number", "ids")).select(
        key, "doc_tokens", (F.col("number").cast("long") * size).alias("start"), "ids")


class Tournament:
    """Free places of a row of sequences; each inner node has the greater of its two children's."""

    def __init__(self, count: int, size: int) -> None:
        self.leaves = 1 << max(0, count - 1).bit_length()
        self.free = [size] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Take ``length`` places in the first sequence that has them: (its number, places free before)."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        number, before = node - self.leaves, free[node]
        free[node] = before - length
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return number, before


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset for each of ``lengths``, none over ``size``; ties in the given order."""
    order = np.argsort(-lengths, kind="stable")
    tree = Tournament(len(lengths), size)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        number, before = tree.place(length)
        sequence[i], offset[i] = number, size - before
    return sequence, offset


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 1024, end: int = 0,
         group_pieces: int = 4096, seed: int = 42) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset) for each piece of each document.

    ``path``: a byte-level BPE file, read on the driver and broadcast. A sequence has ``size`` ids at
    most, without gaps from offset 0 on; what it lacks is for the caller to pad. A document is cut at
    multiples of ``size`` only, so a shorter one stays whole. Null and empty texts are the id ``end``
    alone. Repeated rows are packed each by itself, a null key is passed on, an empty table gives an
    empty one, other columns are not read.

    Groups have about ``group_pieces`` pieces, drawn by a seeded random number for each piece, so no key
    and no document, however long or frequent, can fill one; the number of groups follows rows and
    bytes of the table. Each group numbers its sequences by itself.
    """
    rows, content = docs.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    # Two bytes or more make an id in nearly all texts; with fewer, groups are twice as large.
    groups = 1 + (rows + (content or 0) // (2 * size)) // group_pieces
    cut = pieces(docs, read_byte_vocabulary(path), key, text, size, end).withColumn(
        "group", F.floor(F.rand(seed) * groups).cast("long"))
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = {f.name: f.dataType for f in cut.schema.fields} | {"ids": T.BinaryType()}
    schema = T.StructType([T.StructField(n, types.get(n, T.LongType())) for n in names])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(key, "ascending"), ("start", "ascending")])
        lengths = np.array(pa.compute.binary_length(table["ids"])).astype(np.int64) // ID_BYTES
        sequence, offset = first_fit_decreasing(lengths, size)
        number = (table["group"][0].as_py() << 32) + sequence
        made = {"length": pa.array(lengths), "sequence_id": pa.array(number), "offset": pa.array(offset)}
        return pa.table([made[n] if n in made else table[n] for n in names], names=names)

    return cut.groupBy("group").applyInArrow(run, schema)
