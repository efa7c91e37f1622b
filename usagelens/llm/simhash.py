"""Near duplicates by SimHash fingerprints.

A fingerprint has eight bytes. Two of them that differ in at most b bits share at least 8 - b bytes
in the same positions. The index therefore has a posting list for each choice of 8 - b byte positions
and their values: a pair reaches the guaranteed count of shared positional bytes exactly if it meets
in at least one list. The members of a list differ in b bytes only, so a list of distinct fingerprints
has a bounded length, 65,536 for two bits, whatever the size of the corpus and of its groups of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import map_texts, text_bytes
from usagelens.llm.components import connected
from usagelens.session import materialize


def shingle_hashes(words: list[bytes], size: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of each run of ``size`` words joined by a space; of all words if there are fewer."""
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return [digest(b" ".join(words), seed)] if words else []
    return [digest(b" ".join(s), seed) for s in zip(*(words[k:] for k in range(size)), strict=False)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``hashes``: the bits set in over half of them; none gives zero."""
    ends = np.cumsum(sizes)
    out = np.zeros(len(sizes), np.uint64)
    for bit in range(64):
        ones = np.concatenate([[0], np.cumsum((hashes >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        count = ones[ends] - ones[ends - sizes]
        out |= (2 * count > sizes).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """(key, fp: long) of every row, in one pass without a shuffle.

    A-Z count as lower case; words are separated by ASCII white space only. Null, empty and blank
    texts have the fingerprint zero. Other columns are not read.
    """

    def make(texts: list[str | None]) -> list:
        rows = [np.array(shingle_hashes(text_bytes(t).lower().split(), size), np.uint64) for t in texts]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return [majority(np.concatenate(rows), sizes).view(np.int64)]

    return map_texts(docs.select(key, text), text, "fp long", lambda: make, chunk=1_000_000).select(key, "fp")


def postings(fps: DataFrame, bits: int = 2) -> DataFrame:
    """(list, value, fps): the posting lists with two members or more of distinct ``fps`` (fp)."""
    rows = []
    for number, drop in enumerate(combinations(range(8), bits)):
        mask = (1 << 64) - 1
        for at in drop:
            mask &= ~(0xFF << (8 * at))
        signed = mask - (1 << 64) if mask >> 63 else mask
        rows.append(F.struct(F.lit(number).alias("list"), F.col("fp").bitwiseAND(F.lit(signed)).alias("value")))
    members = fps.select("fp", F.explode(F.array(*rows)).alias("at")).select("at.list", "at.value", "fp")
    return members.groupBy("list", "value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)


def _root(parent: dict, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def list_links(members: list[int], bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs in a posting list that differ in at most ``bits`` bits.

    All pairs in a list share the guaranteed bytes; the bits are verified. Short lists compare
    every member with the rest; long ones look up each member's possible neighbours, of which
    there are a fixed number, so the work is linear in the list.
    """
    members = sorted(members)
    parent, links = {m: m for m in members}, []

    def join(a: int, b: int) -> None:
        ra, rb = _root(parent, a), _root(parent, b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            links.append((a, b))

    differing = 0
    for m in members:
        differing |= m ^ members[0]
    places = [1 << k for k in range(64) if differing >> k & 1]
    masks = [sum(c) for n in range(1, bits + 1) for c in combinations(places, n)]
    if len(members) <= len(masks):
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                if (a ^ b).bit_count() <= bits:
                    join(a, b)
    else:
        for a in members:
            for mask in masks:
                if (b := a ^ mask) > a and b in parent:
                    join(a, b)
    return links


def fingerprint_links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """(src, dst) pairs of distinct fingerprints that connect whatever ``bits`` or fewer connect."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [link for row in batch["fps"]
                   for link in list_links([int(x) & 0xFFFFFFFFFFFFFFFF for x in row], bits)]
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"src": pairs[:, 0], "dst": pairs[:, 1]})

    return postings(fps, bits).select("fps").mapInPandas(run, "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3,
                    bits: int = 2) -> DataFrame:
    """(key, fingerprint, component_id) for each row of ``docs``.

    Rows whose fingerprints differ in at most ``bits`` bits are linked; ``component_id`` is the
    smallest key that a row reaches. Equal fingerprints are joined before any index is built, so a
    group of copies enters it once. Null keys count as greater than all others: they get a row, and
    name a component only if all of its rows have none. An empty table gives an empty table.
    """
    rows = materialize(fingerprints(docs, key, text, size), "simhash")
    distinct = rows.groupBy("fp").agg(F.min(key).alias("least"))
    links = materialize(fingerprint_links(distinct.select("fp"), bits), "simhash-links")
    groups = connected(links)
    labelled = distinct.join(groups.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    names = materialize(labelled.join(named, "root").select("fp", "component_id"), "simhash-names")
    return rows.join(names, "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``docs`` without the rows that have a near duplicate with a smaller key; of repeated rows of
    one key one stays. Rows without a key stay."""
    firsts = near_duplicates(docs, key, text, **options).where(F.col(key) == F.col("component_id"))
    keys = firsts.select(key).distinct()
    named = docs.where(F.col(key).isNotNull()).join(keys, key, "left_semi").dropDuplicates([key])
    return named.unionByName(docs.where(F.col(key).isNull()))
