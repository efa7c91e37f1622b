"""Benchmark decontamination: BM25 over an inverted index of test items with block-max WAND.

Every passage of every document is a query. Impacts are divided by what an item needs to be retrieved,
a share of its score against itself, so that one threshold, 1, holds for all items. A first test, that a
passage can reach the threshold for some item at all, is made for all passages of a batch at once. The
most common terms are set aside for as long as no item gets more than ``COMMON_SHARE`` of the threshold
from them; the impacts of the rare ones are added up for each passage and item. A passage without the
rest of the threshold in rare terms cannot reach it. Passages that pass walk the posting lists.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import WordTable, map_texts, spread, text_bytes

EDGES = b".,;:!?\"'()[]{}<>*#%&$|"


def normal_words(text: str | None) -> list[bytes]:
    """Words between ASCII spaces with A-Z lowered and punctuation at the ends removed."""
    return [w for w in (x.strip(EDGES) for x in text_bytes(text).lower().split()) if w]


#: Part of the threshold that an item's common terms may make up.
COMMON_SHARE = 0.6


class Item(NamedTuple):
    """A test item: its words up to the last sentence, and the words of the last sentence. An item
    of one sentence takes its last quarter as the answer."""

    question: list[bytes]
    answer: list[bytes]


def parts_of(text: str | None) -> Item:
    sentences = [s for s in (text or "").replace("\n", " ").replace("? ", "?\n").replace(". ", ".\n").split("\n")
                 if normal_words(s)]
    words = normal_words(text)
    tail = len(normal_words(sentences[-1])) if len(sentences) > 1 else max(1, len(words) // 4)
    return Item(words[:len(words) - tail], words[len(words) - tail:])


def shingles(words: list[bytes], size: int = 5) -> set[tuple[bytes, ...]]:
    """Runs of ``size`` words; a shorter text is one run."""
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


class Index:
    """Posting lists in blocks with the greatest impact of each list and block.

    ``items``: text by id. ``share``: the part of an item's score against itself that a passage
    must reach. Items without a word are in no list.
    """

    def __init__(self, items: dict[int, str], share: float = 0.7, k1: float = 1.2, b: float = 0.75,
                 block: int = 64) -> None:
        self.block = block
        self.ids = sorted(i for i, text in items.items() if normal_words(text))
        self.parts = [parts_of(items[i]) for i in self.ids]
        words = [q + a for q, a in self.parts]
        mean = sum(map(len, words)) / max(1, len(words))
        counts = [Counter(w) for w in words]
        document_frequency = Counter(t for c in counts for t in c)
        self.longest = max(map(len, words), default=1)
        self.postings: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for n, c in enumerate(counts):
            impact = {t: math.log(1 + (len(words) - document_frequency[t] + 0.5) / (document_frequency[t] + 0.5))
                      * f * (k1 + 1) / (f + k1 * (1 - b + b * len(words[n]) / mean)) for t, f in c.items()}
            need = share * sum(impact.values())
            for t, x in impact.items():
                self.postings[t].append((n, x / need))
        self.most = {t: max(x for _, x in p) for t, p in self.postings.items()}
        self.blocks = {t: [max(x for _, x in p[i:i + block]) for i in range(0, len(p), block)]
                       for t, p in self.postings.items()}

        self._set_rare()

    def _set_rare(self) -> None:
        """The rare terms, their postings in one array each for items and impacts, and what each
        item needs from them."""
        common = [0.0] * len(self.ids)
        self.rare: list[bytes] = []
        for t, posting in sorted(self.postings.items(), key=lambda p: (-len(p[1]), p[0])):
            if all(common[n] + x <= COMMON_SHARE for n, x in posting):
                for n, x in posting:
                    common[n] += x
            else:
                self.rare.append(t)
        lists = [self.postings[t] for t in self.rare]
        self.sizes = np.array([0, *map(len, lists)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.items = np.array([n for p in lists for n, _ in p], np.int64)
        self.impacts = np.array([x for p in lists for _, x in p], np.float64)
        self.needs = 1 - np.array(common)

    def search(self, terms: set[bytes]) -> list[tuple[int, float]]:
        """All items (number, score) whose score for ``terms`` is at least 1, by block-max WAND."""
        found = []
        cursors = [[self.postings[t][0][0], 0, t] for t in terms if t in self.postings]
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for at, cursor in enumerate(cursors):
                bound += self.most[cursor[2]]
                if bound >= 1 - 1e-9:
                    pivot = at
                    break
            if pivot is None:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # The blocks that would hold the pivot bound its score more tightly.
            tight, limit = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.ids)
            for _, place, term in cursors[:pivot + 1]:
                posting = self.postings[term]
                place = bisect_left(posting, (item, -1.0), place)
                if place < len(posting):
                    number = place // self.block
                    tight += self.blocks[term][number]
                    last = min(len(posting), (number + 1) * self.block) - 1
                    limit = min(limit, posting[last][0] + 1)
            if tight < 1 - 1e-9:
                target = max(item + 1, limit)
            else:
                target = item + 1
                score = 0.0
                for cursor in cursors[:pivot + 1]:
                    posting = self.postings[cursor[2]]
                    place = bisect_left(posting, (item, -1.0), cursor[1])
                    if place < len(posting) and posting[place][0] == item:
                        score += posting[place][1]
                if score >= 1 - 1e-9:
                    found.append((item, score))
            moved = []
            for cursor in cursors[:pivot + 1]:
                posting = self.postings[cursor[2]]
                place = bisect_left(posting, (target, -1.0), cursor[1])
                if place < len(posting):
                    moved.append([posting[place][0], place, cursor[2]])
            cursors = moved + cursors[pivot + 1:]
        return found

    def rare_terms(self) -> WordTable:
        """For each raw word the number of its term, 0 if it is no rare one."""
        numbers = {t: n for n, t in enumerate(self.rare, 1)}
        return WordTable(lambda words: np.array([numbers.get(w.lower().strip(EDGES), 0) for w in words], np.int64))


def overlap(item: Item, passage: list[bytes]) -> tuple[float, float]:
    """Share of the question's five-word shingles and of the answer's words that a passage has."""
    text, words = shingles(passage), set(passage)
    asked = shingles(item.question)
    if 0 < len(item.question) < 5:
        own = shingles(passage, len(item.question))
        question = len(asked & own) / len(asked)
    else:
        question = len(asked & text) / len(asked) if asked else 1.0
    answers = set(item.answer)
    return question, len(answers & words) / len(answers) if answers else 1.0


def document_leaks(text: str | None, passages: list[int], width: int, index: Index,
                   least: float) -> dict[int, tuple[float, float, float]]:
    """Verified items (number: score, question and answer overlap) of the passages at these words."""
    raw, out = text_bytes(text).lower().split(), {}
    for start in passages:
        words = [w for w in (x.strip(EDGES) for x in raw[start:start + width]) if w]
        for item, score in index.search(set(words)):
            question, answer = overlap(index.parts[item], words)
            if question >= least and answer >= least:
                out[item] = max(out.get(item, (0.0, 0.0, 0.0)), (score, question, answer))
    return out


def candidate_passages(terms: np.ndarray, sizes: np.ndarray, stride: int, index: Index) -> list[list[int]]:
    """For each text the starts of the passages, two strides long, that some item can be found in.

    ``terms``: rare terms of the words of all texts, ``sizes``: the words of each. A term counts once
    in each stride, so the sum of a passage is never too low.
    """
    strides = -(-sizes // stride)
    first = np.cumsum(strides) - strides
    at = np.flatnonzero(terms)
    text = np.repeat(np.arange(len(sizes)), sizes)[at]
    window = first[text] + (at - (np.cumsum(sizes) - sizes)[text]) // stride
    window, term = np.divmod(np.unique(window * len(index.sizes) + terms[at]), len(index.sizes))
    places = spread(index.starts[term], index.sizes[term])
    window = np.repeat(window, index.sizes[term])
    item, impact = index.items[places], index.impacts[places]
    # A stride belongs to the passage that starts with it and to the one before, in the same text.
    also = ~np.isin(window, first)
    passage = np.concatenate([window, window[also] - 1])
    key, inverse = np.unique(passage * len(index.needs) + np.concatenate([item, item[also]]), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([impact, impact[also]]), len(key))
    passage, item = np.divmod(key, len(index.needs))
    out: list[list[int]] = [[] for _ in sizes]
    for p in np.unique(passage[total >= index.needs[item] - 1e-6]).tolist():
        owner = int(np.searchsorted(first, p, side="right")) - 1
        out[owner].append((p - int(first[owner])) * stride)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", share: float = 0.7,
               least_overlap: float = 0.8, shard_items: int = 20_000) -> DataFrame:
    """(key, item_key, score, question_overlap, answer_overlap): the test items in each document.

    Passages are two strides wide, a stride has the words of the longest item and 64 at least, so an
    item lies wholly in one of them. ``score`` is BM25 divided by what retrieval needs. Items are
    indexed in shards of at most ``shard_items``, broadcast one after another, so a large benchmark
    takes more passes and not more memory. Null, empty and blank texts and items leak nothing; rows
    repeated in ``docs`` repeat their results; of several items of one id, one is used for each
    distinct text.
    """
    spark = docs.sparkSession
    rows = items.where(f"`{item_key}` is not null and `{item_text}` is not null").select(
        F.col(item_key).cast("long").alias("id"), F.col(item_text).alias("text")).distinct()
    leak = f"`{item_key}`: long, score: double, question_overlap: double, answer_overlap: double"
    shards = max(1, math.ceil(rows.count() / shard_items))
    result = None
    for shard in range(shards):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == shard).orderBy("id", "text").collect()
        index = Index({n: r["text"] for n, r in enumerate(own)}, share)
        shared = spark.sparkContext.broadcast((index, [own[n]["id"] for n in index.ids]))

        def start(shared=shared) -> Callable[[list[str | None]], list]:
            index, names = shared.value
            table, stride = index.rare_terms(), max(64, index.longest)

            def make(texts: list[str | None]) -> list:
                split = [text_bytes(t).split() for t in texts]
                sizes = np.fromiter(map(len, split), np.int64, len(split))
                found = candidate_passages(table.lookup([w for ws in split for w in ws]), sizes, stride, index)
                out = []
                for text, starts in zip(texts, found, strict=True):
                    leaks = document_leaks(text, starts, 2 * stride, index, least_overlap) if starts else {}
                    out.append([{item_key: names[n], "score": s, "question_overlap": q, "answer_overlap": a}
                                for n, (s, q, a) in leaks.items()])
                return [out]

            return make

        found = map_texts(docs.select(key, text), text, f"leaks array<struct<{leak}>>", start)
        part = found.select(key, F.inline("leaks"))
        result = part if result is None else result.union(part)
    return result


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  **options: object) -> DataFrame:
    """``docs`` without the documents that hold a test item; rows without a key are judged too, by
    their text, through a key of their own."""
    leaks = find_leaks(docs, items, key, text, **options)
    named = docs.join(leaks.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")
    nameless = docs.where(F.col(key).isNull())
    by_text = find_leaks(nameless.select(F.col(text).alias("body"), F.col(text)), items, "body", text, **options)
    bad = by_text.select(F.col("body").alias(text)).distinct()
    return named.where(F.col(key).isNotNull()).unionByName(
        nameless.join(bad, text, "left_anti").select(docs.columns))
