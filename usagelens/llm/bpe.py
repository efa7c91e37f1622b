"""Byte-pair encoding of a published vocabulary, merged with a segment tree over pair ranks.

The leaves of a word's tree hold the ranks of its adjacent pairs, each joined with its position; the
root is then the leftmost pair of lowest rank. A merge changes three leaves and their paths to the
root, so a word of n symbols costs n log n. Words of one size class are merged together: the trees are
the rows of one array, and a step does one merge in each row that still has a mergeable pair.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from usagelens.llm.common import map_texts, spread, text_bytes

NO_RANK = np.iinfo(np.int64).max
#: White space in the sense of Unicode without the line feed, which separates words here.
WHITE = "\t\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """The character that stands for each byte: visible Latin-1 ones for themselves, the others in
    order from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in visible:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class Vocabulary(NamedTuple):
    """``names``: token of each id; ``first`` and ``last``: id of a byte inside and at the end of a
    word; ``pairs``: sorted keys of mergeable pairs with ``ranks`` and ``merged`` ids; ``special``:
    ids of strings that are tokens as they stand; ``pattern``: what is a word."""

    names: list[bytes]
    first: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    special: dict[str, int]
    pattern: str


def read_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizers file: BPE over byte characters with a word-end suffix."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    ids, suffix = data["model"]["vocab"], data["model"]["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    names = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, number in [*ids.items(), *special.items()]:
        names[number] = token.encode()
    chars = byte_characters()
    merges = data["model"]["merges"]
    keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
    merged = np.array([ids[a + b] for a, b in merges], np.int64)
    order = np.argsort(keys)
    pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return Vocabulary(names, np.array([ids[c] for c in chars]), np.array([ids[c + suffix] for c in chars]),
                      keys[order], order.astype(np.int64), merged, special, pattern)


def pair_ranks(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    keys = left << 32 | right
    at = np.minimum(np.searchsorted(vocabulary.pairs, keys), len(vocabulary.pairs) - 1)
    return np.where(vocabulary.pairs[at] == keys, vocabulary.ranks[at], NO_RANK)


def merge_rows(symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Merge each row of ``symbols`` until no pair is left; returns them with -1 where merged away.

    A row has a power of two of places; the first ``lengths`` of them count.
    """
    rows, size = symbols.shape
    place = np.arange(size)
    tree = np.full((rows, 2 * size), NO_RANK)
    leaf = pair_ranks(symbols[:, :-1], symbols[:, 1:], vocabulary)
    leaf[place[1:] >= lengths[:, None]] = NO_RANK
    tree[:, size:2 * size - 1] = np.where(leaf == NO_RANK, NO_RANK, leaf * size + place[:-1])
    level = size // 2
    while level:
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        level //= 2
    after = np.broadcast_to(place + 1, (rows, size)).copy()
    before = np.broadcast_to(place - 1, (rows, size)).copy()
    out = symbols.copy()
    live = np.flatnonzero(tree[:, 1] != NO_RANK)
    while len(live):
        top = tree[live, 1]
        at, rank = top % size, top // size
        gone = after[live, at]
        out[live, at], out[live, gone] = vocabulary.merged[rank], -1
        following = after[live, gone]
        after[live, at] = following
        inside = following < lengths[live]
        before[live[inside], following[inside]] = at[inside]
        leading = before[live, at]
        tree[live, size + gone] = NO_RANK

        def put(row: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            rank = pair_ranks(out[row, left], out[row, right], vocabulary)
            tree[row, size + left] = np.where(rank == NO_RANK, NO_RANK, rank * size + left)

        tree[live[~inside], size + at[~inside]] = NO_RANK
        put(live[inside], at[inside], following[inside])
        has = leading >= 0
        put(live[has], leading[has], at[has])
        nodes = [size + gone, size + at, np.where(has, size + leading, size + at)]
        while nodes[0][0] > 1:
            for k in range(3):
                nodes[k] = nodes[k] >> 1
                tree[live, nodes[k]] = np.minimum(tree[live, 2 * nodes[k]], tree[live, 2 * nodes[k] + 1])
        live = live[tree[live, 1] != NO_RANK]
    return out


def merge_words(words: list[bytes], vocabulary: Vocabulary, budget: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after another, and how many each has.

    Words of one size class are merged together, ``budget`` places at a time.
    """
    classes = np.fromiter((max(1, (len(w) - 1).bit_length()) for w in words), np.int64, len(words))
    sizes = np.zeros(len(words), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for bits in np.unique(classes):
        size = 1 << int(bits)
        members = np.flatnonzero(classes == bits)
        step = max(1, budget // size)
        for low in range(0, len(members), step):
            part = members[low:low + step]
            chosen = [words[i] for i in part]
            lengths = np.fromiter(map(len, chosen), np.int64, len(chosen))
            symbols = np.zeros((len(part), size), np.int64)
            inside = np.arange(size) < lengths[:, None]
            data = np.frombuffer(b"".join(chosen), np.uint8)
            symbols[inside] = vocabulary.first[data]
            symbols[np.arange(len(part)), lengths - 1] = vocabulary.last[data[np.cumsum(lengths) - 1]]
            merged = merge_rows(symbols, lengths, vocabulary)
            kept = inside & (merged >= 0)
            sizes[part] = kept.sum(1)
            parts.append((part, merged[kept]))
    start = np.cumsum(sizes) - sizes
    flat = np.zeros(int(sizes.sum()), np.int64)
    for part, ids in parts:
        flat[spread(start[part], sizes[part])] = ids
    return flat, sizes


def category_ranges(letter: str) -> str:
    """The code points of a general category, as ranges of a character class."""
    codes = np.array([i for i in range(0x110000) if unicodedata.category(chr(i))[0] == letter])
    edges = np.flatnonzero(np.diff(codes) > 1)
    firsts, lasts = codes[np.r_[0, edges + 1]], codes[np.r_[edges, len(codes) - 1]]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts, strict=True))


class Runs:
    """Sequences of numbers by key, kept in one array."""

    def __init__(self) -> None:
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])

    def take(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[keys]
        return self.flat[spread(self.start[keys], sizes)], sizes


class Numbered(dict):
    """Numbers keys as they come; ``fresh`` has those not seen before."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key: object) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def taken(self) -> list:
        out, self.fresh = self.fresh, []
        return out


class Encoder:
    """Encodes texts; remembers the ids of up to ``limit`` words between calls.

    No word of the vocabulary's pattern goes across white space, so each run between ASCII spaces
    is split into pieces once, and each piece merged once.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 500_000) -> None:
        self.vocabulary, self.limit = vocabulary, limit
        pattern = (vocabulary.pattern.replace("\\p{L}", category_ranges("L"))
                   .replace("\\p{N}", category_ranges("N")).replace("\\s", " \n"))
        self.word = re.compile("\n|" + pattern)
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")
        self.white = re.compile(f"[{WHITE}]+")
        self.clear()

    def clear(self) -> None:
        self.words, self.pieces = Numbered(), Numbered()
        self.word_pieces, self.piece_ids = Runs(), Runs()

    def plain(self, text: str) -> str:
        """The normalizer's form; case is folded character by character, so a final sigma is like
        any other."""
        return self.white.sub(" ", unicodedata.normalize("NFC", text)).replace("\u03a3", "\u03c3").lower()

    def split(self, words: list[bytes]) -> tuple[list[str | int], np.ndarray]:
        """The pieces of all words one after another, ids of special strings among them, and how
        many each word has."""
        decoded = b"\n".join(words).decode("utf-8", "surrogatepass")
        if not self.special.search(decoded):
            found = self.word.findall(self.plain(decoded) + "\n")
            ends = np.fromiter((i for i, x in enumerate(found) if x == "\n"), np.int64, len(words))
            return [x for x in found if x != "\n"], np.diff(ends, prepend=-1) - 1
        out: list[str | int] = []
        sizes = []
        for word in decoded.split("\n"):
            before = len(out)
            for part in self.special.split(word):
                known = self.vocabulary.special.get(part)
                out += [known] if known is not None else self.word.findall(self.plain(part))
            sizes.append(len(out) - before)
        return out, np.array(sizes, np.int64)

    def learn(self, words: list[bytes]) -> None:
        pieces, sizes = self.split(words)
        self.word_pieces.add(self.pieces.of(pieces), sizes)
        fresh = self.pieces.taken()
        flat, sizes = merge_words([b"\0" if isinstance(p, int) else p.encode("utf-8", "surrogatepass")
                                   for p in fresh], self.vocabulary)
        for i, p in enumerate(fresh):
            if isinstance(p, int):  # one byte is one id, so the place is there
                flat[sizes[:i].sum()] = p
        self.piece_ids.add(flat, sizes)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        if not texts:
            return []
        if len(self.words) > self.limit:
            self.clear()
        split = [text_bytes(t).split() for t in texts]
        numbers = self.words.of([w for ws in split for w in ws])
        if fresh := self.words.taken():
            self.learn(fresh)
        pieces, sizes = self.word_pieces.take(numbers)
        ids, lengths = self.piece_ids.take(pieces)
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
        return np.split(ids, cuts[np.cumsum([len(ws) for ws in split])][:-1])


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> bytes:
    """The tokens joined by one space, in UTF-8: the file names no decoder, so word ends stay."""
    return b" ".join(map(vocabulary.names.__getitem__, ids.tolist()))


def _encoded(docs: DataFrame, path: str, text: str, added: str,
             make: Callable[[np.ndarray, Vocabulary], tuple]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def start() -> Callable[[list[str | None]], list]:
        encoder = Encoder(shared.value)
        return lambda texts: list(zip(*(make(ids, shared.value) for ids in encoder.encode(texts)), strict=True))

    return map_texts(docs, text, added, start, chunk=2_000_000)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids (little-endian unsigned 32-bit integers) and decoded.

    ``path``: the vocabulary's file, read once on the driver and broadcast; it has the size of a
    vocabulary. Null and empty texts have no ids. Rows are encoded one by one, without a shuffle;
    columns of these names in ``docs`` are replaced.
    """

    def make(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[int, bytes, str]:
        return len(ids), ids.astype("<u4").tobytes(), decode(ids, vocabulary).decode()

    return _encoded(docs, path, text, "n_tokens long, ids binary, decoded string", make)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """As :func:`encode`, with the SHA-256 of the ids and of the decoded text in their place."""

    def make(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[int, str, str]:
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(decode(ids, vocabulary)).hexdigest())

    return _encoded(docs, path, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
