"""Operators that compare documents, against brute force."""

import hashlib
import random
import time
from collections import Counter
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_texts import ODD, SCHEMA
from usagelens.llm import simhash, substring_dedup
from usagelens.llm.components import connected


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(keys, linked):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {k: find(k) for k in keys}


def varied(seed, n=90):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            body = rng.choice(texts).split()
            for _ in range(rng.randrange(3)):
                body[rng.randrange(len(body))] = rng.choice(words)
        else:
            body = rng.choices(words, k=rng.randrange(1, 400))
        texts.append(" ".join(body))
    return texts


@pytest.mark.parametrize("bits", [2, 3])
def test_simhash_equals_brute_force(spark, bits):
    texts = varied(1) + ODD + ["A B c", "a b C", "   "]
    ids = list(range(10, 10 + len(texts)))
    random.Random(2).shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), SCHEMA).withColumn("fp", F.lit("clash"))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs, bits=bits).collect()}
    fps = {i: plain_fingerprint(t) for i, t in zip(ids, texts)}
    pairs = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= bits]
    roots = plain_roots(ids, pairs)
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in ids}
    kept = simhash.keep_one(docs, bits=bits)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))


def test_simhash_nulls_repeats_and_empty(spark):
    rows = [(None, "alone here now"), (4, "same text"), (None, "same text"), (4, "same text"), (2, "same text"), (None, "alone here now")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs).groupBy("doc_id", "component_id").count().collect()
    assert {(r[0], r[1], r[2]) for r in got} == {(None, None, 2), (4, 2, 2), (2, 2, 1), (None, 2, 1)}
    assert sorted(str(r["doc_id"]) for r in simhash.keep_one(docs).collect()) == ["2", "None", "None", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_posting_lists_are_linked_like_short_ones():
    rng = random.Random(3)
    members = sorted({rng.randrange(1 << 16) for _ in range(2_000)})
    want = plain_roots(members, [(a, b) for i, a in enumerate(members) for b in members[i + 1:] if (a ^ b).bit_count() <= 2])
    links = simhash.list_links(members, 2)
    assert all((a ^ b).bit_count() <= 2 for a, b in links) and len(links) < len(members)
    assert plain_roots(members, links) == want


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {"chain": [(i, i + 1) for i in range(70)], "star": [(50, i) for i in range(100) if i != 50],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "none": []}[shape]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "src long, dst long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    want = plain_roots(nodes, [e for e in edges if e[0] != e[1]])
    assert {k: got.get(k, k) for k in nodes} == want


def plain_dedup(rows, window):
    """Of (id, text): the words that stay and how many go."""
    big = float("inf")
    starts = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for p in range(len(words) - window + 1):
            g = tuple(words[p:p + window])
            starts[g] = min(starts.get(g, big), big if i is None else i)
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if starts[tuple(words[p:p + window])] < (big if i is None else i):
                gone[p:p + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, window, n=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    shared = [rng.choices(words, k=rng.randrange(window // 2, 3 * window)) for _ in range(6)]
    rows = []
    for i in range(n):
        body = rng.choices(words, k=rng.randrange(3 * window))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = rng.choice(shared)
        rows.append((rng.randrange(25) if i % 9 else None, " ".join(body)))
    return rows + [(3, None), (4, ""), (5, "a " * 200), (6, "a " * 300), (6, "a " * 300), rows[0], rows[1]]


@pytest.mark.parametrize("group_rows", [1, 5, 4_000])
def test_substring_dedup_equals_brute_force(spark, group_rows):
    for seed, window, lengths in ((1, 12, (3, 6, 12)), (2, 50, substring_dedup.LENGTHS)):
        rows = passages(seed, window)
        docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS mark", "2 AS runs", "'x' AS kept", "3 AS row")
        out = substring_dedup.dedup(docs, window=window, lengths=lengths, group_rows=group_rows)
        got = [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in out.collect()]
        assert sorted(got, key=str) == plain_dedup(rows, window)
        for r in out.collect():
            assert sum(s["last"] - s["first"] + 1 for s in r["removed"]) == r["n_removed"]


def test_word_hashes_follow_the_words_alone(monkeypatch):
    rng = random.Random(4)
    words = ["a", "b", "ab", "ba", "é", "\x00", "x" * 40, "y" * 90, *("".join(rng.choices("abc", k=6)) for _ in range(40))]
    known = {}
    for block in (64, 1 << 19):
        monkeypatch.setattr(substring_dedup, "BLOCK", block)
        for _ in range(200):
            chosen = rng.choices(words, k=rng.randrange(30))
            text = rng.choice(["", " ", "\n\t"]) + "".join(w + "".join(rng.choices(" \t\n\x0b\f\r", k=rng.randrange(1, 4)))
                                                         for w in chosen)
            hashes = substring_dedup.word_hashes(text).tolist()
            assert len(hashes) == len(chosen)
            for w, h in zip(chosen, hashes):
                # Words of a block's length or more are hashed in another way.
                assert known.setdefault((w, len(w.encode()) >= block), h) == h
    short = {k: h for k, h in known.items() if not k[1]}
    assert len(set(short.values())) == len(short)
    assert len(substring_dedup.word_hashes(None)) == len(substring_dedup.word_hashes(" \n")) == 0


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    out = substring_dedup.dedup(spark.createDataFrame([(1, None), (2, "short")], SCHEMA))
    assert sorted((r["n_words"], r["n_removed"], r["kept"]) for r in out.collect()) == [(0, 0, ""), (1, 0, "short")]


@pytest.mark.parametrize("group_rows", [1, 4_000])
def test_many_equal_rows_cost_no_more_than_their_number(spark, group_rows):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long)] * 1_000 + [(None, long + " end")] * 1_000 + [(7, "x " + long), (9, "other")]
    start = time.time()
    out = substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA), group_rows=group_rows)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out.collect())
    assert got == {(5, 300, 0, long): 1_000, (None, 301, 300, "end"): 1_000, (7, 301, 300, "x"): 1, (9, 1, 0, "other"): 1}
    assert time.time() - start < 90
