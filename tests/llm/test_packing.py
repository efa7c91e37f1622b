"""Packing: ids of the tokenizers library, each in one piece, sequences without gaps and little padding."""

import os
import random
from zlib import crc32

import numpy as np
import pytest

from usagelens.llm import packing, queries
from usagelens.llm.common import table

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)
SF_DIR = "/root/testdata/sf0.001"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def plain_first_fit(lengths, size):
    free, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if at == len(free):
            free.append(size)
        out[i] = (at, size - free[at])
        free[at] -= lengths[i]
    return [out[i] for i in range(len(lengths))]


def checked(rows, docs, size=1024):
    """The share of padding, after a check of every piece and sequence."""
    ids = {key: np.array(library_ids(text), "<u4") for key, text in docs}
    parts, sequences = {}, {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and len(own) == r["length"] > 0
        assert bytes(r["ids"]) == own.tobytes()
        parts.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    copies = {}
    for key, _ in docs:
        copies[key] = copies.get(key, 0) + 1
    for key, own in parts.items():
        expected = [(s, min(size, len(ids[key]) - s)) for s in range(0, len(ids[key]), size)] * copies[key]
        assert sorted(own) == sorted(expected)
    assert set(parts) == set(ids)
    padding = 0
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
        padding += 0 if end & (end - 1) == 0 else size - end
    return padding / max(1, sum(len(ids[k]) * n for k, n in copies.items()))


def test_first_fit_decreasing_is_the_plain_one():
    rng = np.random.default_rng(1)
    for count in (0, 1, 2, 3, 50, 257):
        for top in (4, 64, 1024):
            lengths = rng.integers(1, top + 1, count)
            sequence, offset = packing.first_fit_decreasing(lengths, 1024)
            assert list(zip(sequence, offset)) == plain_first_fit(lengths.tolist(), 1024)


def test_ids_of_any_text():
    vocabulary = packing.read_byte_vocabulary(PATH)
    rng = random.Random(2)
    points = [*range(0x20, 0x250), 0x301, 0x3A3, 0xA0, 0x2003, 0x3000, 0x1F600, 0x4E2D, 0x660, 0x1D7CE, 0x85, 0x200B]
    texts = ["", "a", "<|endoftext|>", "x<|endoftext|> <|endoftext|", "a" * 50_000, "\n" * 3_000 + "x", " " * 3_000,
             "y" + " " * 1_500_000 + "x", "it's we'll I'M 12a  b\t\tc \r\n", *["".join(chr(rng.choice(points)) for _ in range(200)) for _ in range(300)]]
    for text in texts:
        assert vocabulary.encode(text).tolist() == library_ids(text)[:-1]


def test_every_character_is_split_alike():
    vocabulary = packing.read_byte_vocabulary(PATH)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for low in range(0, len(points), 4_096):
        text = "".join(f"a{chr(p)} {chr(p)}1" for p in points[low:low + 4_096])
        assert vocabulary.encode(text).tolist() == library_ids(text)[:-1]


def test_small_groups_nulls_repeats_and_long_texts(spark):
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice("ab cde.") for _ in range(rng.randint(0, 9_000)))) for i in range(60)]
    docs += [(100, None), (101, ""), (None, "no key"), (102, "long " * 100_000)] + [(103, "again " * 1_500)] * 30
    rows = [(k, t, "x", 5) for k, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, group int").repartition(5)
    packed = packing.pack(df, PATH, group_pieces=40)
    found = packed.collect()
    assert checked(found, docs) < 0.3
    groups = {r["sequence_id"] >> 32 for r in found}
    assert len(groups) > 5 and max(sum(r["sequence_id"] >> 32 == g for r in found) for g in groups) < 160


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, PATH).count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        packing.read_byte_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_on_a_whole_table(spark):
    docs = [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    packed = packing.pack(table(spark, SF_DIR, "documents"), PATH).collect()
    assert checked(packed, docs) < 0.03
    digest = {(r["doc_id"], r["start"]): crc32(bytes(r["ids"])) for r in packed}
    rows = queries.op13_packing(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in rows} == digest
