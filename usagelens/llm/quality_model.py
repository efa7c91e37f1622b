"""Quality classifier: supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams of each word are hashed into buckets.
Every bucket has a learned vector; a document is the mean of its vectors, and a softmax over two
classes follows. Training is stochastic gradient descent in numpy, in groups of a bounded number of
labelled documents, a task each. Because the output is linear in the mean, a trained model scores a
bucket by one number, and a document by the mean of these: scoring needs one table lookup a word and
one a pair, and the models of all groups are averaged bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import WordTable, map_texts, segment_sums, text_bytes
from usagelens.session import materialize

#: Bucket of a pair of equal words: repetition looks alike whatever the word.
REPEAT = 0


class Features(NamedTuple):
    """Shape of the hashed features: ``2 ** bits`` buckets, character n-grams of these lengths."""

    bits: int = 16
    shortest: int = 3
    longest: int = 4


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _place(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets from 1 on, by the upper bits of a product."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    return np.maximum(mixed >> np.uint64(64 - bits), np.uint64(1)).astype(np.int64)


def owned_buckets(words: list[bytes], hashes: np.ndarray, shape: Features) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words in no particular order, and the number of the word that each belongs to: one
    for itself and one for each character n-gram of ``<word>``."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Decoded at once: no word has a line feed, and bytes beside an ASCII one decode as they do at an end.
    framed = (b"<" + b">\n<".join(words) + b">").decode("utf-8", "replace")
    chars = np.frombuffer(framed.encode("utf-32-le", "surrogatepass"), np.uint32)
    within = chars != ord("\n")
    owner, chars = np.cumsum(~within)[within], chars[within].astype(np.uint64)
    parts, owners = [_place(hashes, shape.bits)], [np.arange(len(words))]
    for n in range(shape.shortest, shape.longest + 1):
        last = len(chars) - n + 1
        if last <= 0:
            continue
        key = np.full(last, n, np.uint64)
        for k in range(n):
            key = key * np.uint64(0x100000001B3) ^ chars[k:last + k]
        inside = owner[:last] == owner[n - 1:]
        key = key[inside]
        parts.append(_place(key ^ (key >> np.uint64(29)), shape.bits))
        owners.append(owner[:last][inside])
    return np.concatenate(parts), np.concatenate(owners)


def word_buckets(words: list[bytes], hashes: np.ndarray, shape: Features) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after another, and how many each word has."""
    place, owner = owned_buckets(words, hashes, shape)
    order = np.argsort(owner, kind="stable")
    return place[order], np.bincount(owner, minlength=len(words))


def pair_buckets(hashes: np.ndarray, starts: np.ndarray, shape: Features) -> np.ndarray:
    """Bucket of each word with the one before it; -1 for the first of a document."""
    before = np.roll(hashes, 1)
    place = _place(before * np.uint64(0xC2B2AE3D27D4EB4F) ^ hashes, shape.bits)
    place[before == hashes] = REPEAT
    place[starts] = -1
    return place


class Model(NamedTuple):
    """``scores``: the log-odds that each bucket adds; ``bias``: those of an empty document."""

    scores: np.ndarray
    bias: float
    shape: Features


def document_features(text: str | None, shape: Features) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text with their share in its mean; at most ``2 ** bits`` of them."""
    words = text_bytes(text).split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    hashes = word_hashes(words)
    own, _ = owned_buckets(words, hashes, shape)
    starts = np.zeros(len(words), bool)
    starts[0] = True
    pairs = pair_buckets(hashes, starts, shape)
    place, n = np.unique(np.concatenate([own, pairs[1:]]), return_counts=True)
    return place.astype(np.int32), (n / n.sum()).astype(np.float32)


def fit(sample: pd.DataFrame, shape: Features, dims: int = 8, epochs: int = 12, rate: float = 0.5,
        seed: int = 7) -> Model:
    """Gradient descent over single documents in a fixed random order, both classes weighing alike."""
    size = 1 << shape.bits
    labels = sample["label"].to_numpy() if len(sample) else np.zeros(0, int)
    counts = np.bincount(labels, minlength=2)
    if counts.min() == 0:
        return Model(np.zeros(size, np.float32), 0.0, shape)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / dims, 1 / dims, (size, dims))
    # A vector as one item: single items are put back faster than rows of numbers.
    items = vectors.view(f"V{dims * vectors.itemsize}")[:, 0]
    output, bias = np.zeros((dims, 2)), np.zeros(2)
    places = [np.frombuffer(p, np.int32) for p in sample["place"]]
    shares = [np.frombuffer(s, np.float32) for s in sample["share"]]
    weight = len(labels) / (2 * counts)
    # Sort the rows by content, so that the fit does not depend on the order they arrive in.
    rows = sorted(range(len(labels)), key=lambda i: (labels[i], len(places[i]), places[i].tobytes()))
    steps = epochs * len(rows)
    for epoch in range(epochs):
        for k, i in enumerate(random.permutation(rows)):
            pace = rate * (1 - (epoch * len(rows) + k) / steps) * min(weight[labels[i]], 8.0)
            at = places[i].astype(np.int64)
            own = vectors.take(at, axis=0)
            mean = shares[i] @ own
            low, high = (mean @ output + bias).tolist()
            less = float(np.exp(-abs(high - low)))
            p = np.array([1.0, less] if low > high else [less, 1.0]) / (1 + less)
            p[labels[i]] -= 1
            step = output @ p
            output -= pace * (mean[:, None] * p)
            bias -= 0.1 * pace * p
            # Vectors move by their share; the factor keeps rare buckets of long texts learning.
            own -= np.dot((pace * 20) * shares[i][:, None], step[None, :])
            items.put(at, own.view(items.dtype)[:, 0])
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32),
                 float(bias[1] - bias[0]), shape)


def fit_groups(sample: DataFrame, text: str, shape: Features) -> DataFrame:
    """For each ``group`` of ``sample`` (group, sample_label, text) the ``scores`` and the ``bias`` of its fit.

    A group without one of the labels has none.
    """

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["sample_label"].nunique() < 2:
            return pd.DataFrame({"scores": [], "bias": []})
        made = [document_features(t, shape) for t in rows[text]]
        model = fit(pd.DataFrame({"label": rows["sample_label"], "place": [place.tobytes() for place, _ in made],
                                  "share": [share.tobytes() for _, share in made]}), shape)
        return pd.DataFrame({"scores": [model.scores], "bias": [model.bias]})

    return sample.groupBy("group").applyInPandas(learn, "scores array<float>, bias double")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", per_class: int = 1_500, shape: Features = Features()) -> Model:
    """Learn from all documents that ``labels`` (key, label 0 or 1) covers.

    They are dealt by the hash of their key into groups of about ``per_class`` documents of the more
    frequent label; those of the other label go into several groups where they would be fewer, into all
    of them at most. Every group is fitted by a task, and the log-odds of the groups are averaged, so only
    a number for each bucket comes to the driver.
    A key labelled twice counts once, with its lower label; null labels and keys are ignored. With
    no document of one class the model is undecided: every score is one half.
    """
    size = 1 << shape.bits
    once = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
            .groupBy(F.col(key).alias("sample_key")).agg(F.min(label).cast("int").alias("sample_label")))
    keyed = docs.select(F.col(key).alias("sample_key"), F.col(text))
    there = once.join(keyed.select("sample_key"), "sample_key", "left_semi")
    counts = {r["sample_label"]: r["count"] for r in there.groupBy("sample_label").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(size, np.float32), 0.0, shape)
    groups = -(-max(counts.values()) // per_class)
    copies = [min(groups, groups * per_class // counts[value]) for value in (0, 1)]
    own = F.pmod(F.xxhash64("sample_key"), F.lit(groups))
    every = F.sequence(F.lit(0), F.when(F.col("sample_label") == 1, copies[1]).otherwise(copies[0]) - 1)
    sample = keyed.join(once, "sample_key").dropDuplicates(["sample_key"])
    dealt = sample.select("sample_label", text, F.explode(F.transform(every, lambda k: (own + k) % groups)).alias("group"))
    fits = materialize(fit_groups(dealt, text, shape), "quality-fits")
    bias = fits.agg(F.avg("bias")).first()[0]
    if bias is None:
        return Model(np.zeros(size, np.float32), 0.0, shape)
    mean = fits.select(F.posexplode("scores").alias("place", "score")).groupBy("place").agg(F.avg("score").alias("score"))
    scores = mean.toPandas().set_index("place")["score"].reindex(range(size))
    return Model(scores.to_numpy(np.float32), bias, shape)


def score_texts(texts: list[str | None], model: Model, table: WordTable) -> np.ndarray:
    """Probability of label 1 for each text; an empty or null one gets the bias alone."""
    split = [text_bytes(t).split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    rows = table.lookup([w for ws in split for w in ws])
    starts = np.zeros(len(rows), bool)
    starts[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    pairs = pair_buckets(rows["hash"], starts, model.shape)
    value = rows["sum"] + np.where(starts, 0, model.scores[pairs])
    total, n = segment_sums(value, sizes), segment_sums(rows["n"] + ~starts, sizes)
    return 1 / (1 + np.exp(-(total / np.maximum(n, 1) + model.bias)))


def word_scores(model: Model) -> WordTable:
    """For each word its hash, the sum of its buckets' scores and their number."""

    def compute(words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words), [("hash", np.uint64), ("sum", np.float32), ("n", np.int32)])
        if words:
            hashes = word_hashes(words)
            place, sizes = word_buckets(words, hashes, model.shape)
            out["hash"], out["n"] = hashes, sizes
            out["sum"] = segment_sums(model.scores[place], sizes)
        return out

    return WordTable(compute)


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1; columns of that name are replaced.

    Rows are scored one by one: nothing is shuffled. Null and empty texts get the model's bias.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable[[list[str | None]], list]:
        table = word_scores(shared.value)
        return lambda texts: [score_texts(texts, shared.value, table)]

    return map_texts(docs, text, "score double", start)
