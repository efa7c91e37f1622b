"""The URL model keeps every substring and every context, whatever their number."""

import math
import random
from collections import Counter

import pytest

from usagelens.llm import url_filter

SCHEMA = "key string, accepted boolean, n int"


def test_the_model_grows_with_the_urls(spark):
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x400, 0x450)]
    keys = ["".join(rng.choices(letters, k=40)) for _ in range(2_000)]
    rows = [(k, i % 2 == 0, 3) for i, k in enumerate(keys)]
    every = {f"^{k}$"[i:i + n] for k in keys for n in range(1, 5) for i in range(43 - n)}
    assert len(every) > 100_000
    assert url_filter.train(spark.createDataFrame(rows, SCHEMA)).where("gram <> ''").count() == len(every)


@pytest.mark.parametrize("most", [0, 20, 100_000])
def test_contexts_count_what_is_pruned_and_all_is_scored(spark, most):
    rng = random.Random(6)
    rows = [("".join(rng.choices("abc", k=rng.randrange(1, 9))), rng.random() < 0.5, 1) for _ in range(25)]
    model = url_filter.train(spark.createDataFrame(rows, SCHEMA), 3, 2.0, min_count=3)
    counts, contexts = {s: Counter() for s in (True, False)}, {s: Counter() for s in (True, False)}
    for key, side, n in rows:
        s = f"^{key}$"
        for i in range(len(s)):
            for k in range(1, min(3, i + 1) + 1):
                counts[side][s[i - k + 1:i + 1]] += n
                contexts[side][s[i - k + 1:i], k] += n

    def p(side, gram):
        if not gram:
            return 1 / 256
        below, at = p(side, gram[1:]), (gram[:-1], len(gram))
        if contexts[True][at] + contexts[False][at] < 3:
            return below
        n = counts[side][gram] if counts[True][gram] + counts[False][gram] >= 3 else 0
        return (n + 2.0 * below) / (contexts[side][at] + 2.0)

    keys = ["abcabc", "ccc", "zab", "", "a"]
    got = url_filter.score(spark.createDataFrame([(k,) for k in keys], "key string"), model, 3, most).collect()
    for key, score in got:
        s = f"^{key}$"
        total = sum(math.log(p(True, s[max(0, i - 2):i + 1]) / p(False, s[max(0, i - 2):i + 1])) for i in range(1, len(s)))
        total += math.log(p(True, "^") / p(False, "^"))
        assert score == pytest.approx(total / (len(key) + 1), abs=1e-9)
    assert len(got) == len(keys)
