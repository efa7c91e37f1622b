"""Spelling variants against a comparison of all pairs of words."""

import os
import random
import re
from zlib import crc32

import pytest

from usagelens.llm import queries, spelling
from usagelens.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def plain_words(docs, least=7, typo_every=31):
    counts = {}
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if key is None else key}:{word}".encode())
            if typo_every and h % typo_every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= least:
                counts[word] = counts.get(word, 0) + 1
    return counts


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a != b and len(a) - len(b) <= 1 and a[at + 1:] == b[at + (len(a) == len(b)):]


def plain_variants(counts, ratio=10):
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, counts[w], len(near[w]), counts.get(forms[w])))
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def variants_of(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.variants(words, **options)
    assert found.count() == len(counts)
    return rows_of(found)


def test_one_edit_anywhere_is_found(spark):
    rng = random.Random(3)
    counts = {}
    for size in (1, 2, 3, 7, 8, 9, 10, 11, 15, 30):
        word = "".join(rng.choice("abß") for _ in range(size))
        counts[word] = 1000
        for at in range(size + 1):
            counts.setdefault(word[:at] + "c" + word[at:], rng.randint(2, 90))
            counts.setdefault(word[:at] + "a" + word[at + 1:], rng.randint(2, 90))
            counts.setdefault(word[:at] + word[at + 1:] or "x", rng.randint(2, 90))
    assert variants_of(spark, counts) == plain_variants(counts)


def test_runs_of_one_letter_and_random_words(spark):
    rng = random.Random(5)
    counts = {"a" * n: 10 ** (n % 5) for n in range(5, 14)}
    counts |= {"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))): rng.choice([2, 30, 500]) for _ in range(300)}
    assert variants_of(spark, counts) == plain_variants(counts)


def test_long_chains_and_ties(spark):
    chain = {("b" * n + "aaaaaaaaaaaa")[:12]: 10 ** n for n in range(12)}
    ties = {"qqqqqqq": 2, "qqqqqqx": 20, "qqqqqqé": 20, "qqqqqqqq": 20, "zzzzzzz": 1}
    found = variants_of(spark, chain | ties)
    assert found == plain_variants(chain | ties)
    assert {r[2] for r in found if r[0] in chain} == {"b" * 11 + "a"}
    assert variants_of(spark, ties, ratio=11) == plain_variants(ties, 11)


def test_words_of_texts(spark):
    rng = random.Random(7)
    some = lambda n: "".join(rng.choice("abcÀÿ×") for _ in range(n))
    texts = [None, "", " \n", "Straße ÄNDERUNG-abcdefg1abcdefgh", "x" * 50_000 + " " + some(9),
             *[" ".join(some(rng.randint(5, 12)).upper() for _ in range(60)) for _ in range(40)]]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [docs[-1]] * 3 + [(None, "Wortschatz Wortschatz"), (-5, "einszwei")]
    df = spark.createDataFrame([(k, t, 1, "y") for k, t in docs], "doc_id long, text string, n int, word string")
    for every in (31, 3, None):
        found = {r["word"]: r["n"] for r in spelling.counted_words(df, typo_every=every).collect()}
        assert found == plain_words(docs, typo_every=every)


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.counted_words(empty)).count() == 0
    one = spark.createDataFrame([("alleine", 3), (None, 4)], "word string, n long")
    assert rows_of(spelling.variants(one)) == {("alleine", None, "alleine", 3, 0, None)}
    with pytest.raises(ValueError):
        spelling.variants(one, ratio=1)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_on_a_whole_table(spark):
    docs = [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    counts = {w: n for w, n in plain_words(docs).items() if n >= 2}
    assert rows_of(queries.op11_spelling_variants(spark, SF_DIR)) == plain_variants(counts)
