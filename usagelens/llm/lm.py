"""Language-model scores of texts: a log-bilinear model trained by noise-contrastive estimation.

The vector of the next word is predicted as a linear function of the vectors of the two words before
it; its products with the words' vectors, plus a bias, are the logits. The output classes are the most
frequent words and one class for all others, which is shared out among them by their counts, so every
text has a proper probability. Each task trains on all texts of its partition from the same start; the
parameters are then averaged, weighted by the tokens they have seen. Log-probabilities are normalised:
the logarithm of the sum over all classes is computed by batched matrix products, once for each
context of two words that occurs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import chunks, count_floor, map_texts, segment_sums, text_bytes
from usagelens.session import materialize

#: The end of a text, a token of its own; no word is empty.
END = b""
LOG10 = math.log(10)


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, then the end."""
    return [*text_bytes(text).lower().split(), END]


class Counts(NamedTuple):
    """``table``: (token, n) of the whole corpus. ``frequent``: its tokens of at least some count,
    most frequent first, with their counts; the bound on their number is a parameter."""

    table: DataFrame
    total: int
    distinct: int
    frequent: list[bytes]
    counts: np.ndarray


def count_tokens(docs: DataFrame, text: str = "text", max_frequent: int = 200_000,
                 flush: int = 300_000) -> Counts:
    """Token counts of all ``docs``, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in counter], pa.string()),
                                              pa.array(list(counter.values()), pa.int64())], names=["token", "n"])
            counter.clear()
            return out

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for t in texts:
                counter.update(tokens_of(t))
                if len(counter) > flush:
                    yield rows()
        if counter:
            yield rows()

    counted = docs.select(text).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    table = materialize(counted, "token-counts")
    total, distinct = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    floor = count_floor(table, "n", max_frequent)
    rows = sorted(((n, t) for t, n in table.where(F.col("n") >= floor).collect()),
                  key=lambda r: (-r[0], r[1])) if floor else []
    return Counts(table, total, distinct, [t.encode() for _, t in rows], np.array([n for n, _ in rows], np.int64))


class Model(NamedTuple):
    """Context vectors (a row for each class, then one for the start of a text), a matrix for each
    place of the context, output vectors and biases. The last class is that of all other words."""

    context: np.ndarray
    first: np.ndarray
    second: np.ndarray
    output: np.ndarray
    bias: np.ndarray


def start_model(class_counts: np.ndarray, dims: int, seed: int = 11) -> Model:
    """Unigram biases, no output vectors and small random context vectors: the model begins as the
    unigram distribution of its classes."""
    random = np.random.default_rng(seed)
    n = len(class_counts)
    share = (class_counts + 1) / (class_counts + 1).sum()
    return Model(random.normal(0, 0.3, (n + 1, dims)).astype(np.float32), np.eye(dims, dtype=np.float32),
                 0.5 * np.eye(dims, dtype=np.float32), np.zeros((n, dims), np.float32),
                 np.log(share).astype(np.float32))


def examples(classes: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that, within its text."""
    at = np.arange(len(classes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one = np.where(at >= 1, np.roll(classes, 1), start)
    two = np.where(at >= 2, np.roll(classes, 2), start)
    return one, two


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, d], size) for d in range(values.shape[1])], 1).astype(np.float32)


class Trainer:
    """Gradient steps of noise-contrastive estimation with one shared noise sample a batch."""

    def __init__(self, model: Model, noise_share: np.ndarray, noise: int = 64, rate: float = 0.1,
                 batch: int = 4096, seed: int = 5) -> None:
        self.parts = [p.copy() for p in model]
        self.squares = [np.full_like(p, 1e-3) for p in self.parts]
        self.cumulative = np.cumsum(noise_share)
        self.offset = (np.log(noise_share) + math.log(noise)).astype(np.float32)
        self.noise, self.rate, self.batch = noise, rate, batch
        self.random = np.random.default_rng(seed)
        self.seen = 0

    def learn(self, targets: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        for low in range(0, len(targets), self.batch):
            self.step(*(x[low:low + self.batch] for x in (targets, one, two)))
        self.seen += len(targets)

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        context, first, second, output, bias = self.parts
        a, b = context[one], context[two]
        guess = a @ first + b @ second
        own = output[target]
        noise = np.minimum(np.searchsorted(self.cumulative, self.random.random(self.noise)), len(bias) - 1)
        score = np.einsum("bd,bd->b", guess, own) + bias[target] - self.offset[target]
        up = 1 / (1 + np.exp(np.clip(score, -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(guess @ output[noise].T + bias[noise] - self.offset[noise], -30, 30)))
        back = up[:, None] * own + down @ output[noise]
        d_output = _scatter(target, up[:, None] * guess, len(bias))
        np.add.at(d_output, noise, down.T @ guess)
        d_bias = np.bincount(target, up, len(bias)).astype(np.float32)
        np.add.at(d_bias, noise, down.sum(0))
        d_context = (_scatter(one, back @ first.T, len(context)) + _scatter(two, back @ second.T, len(context)))
        for p, g, s in zip(self.parts, (d_context, a.T @ back, b.T @ back, d_output, d_bias), self.squares, strict=True):
            g /= len(target)
            s += g * g
            p += self.rate * g / np.sqrt(s)


def class_table(counts: Counts, classes: int) -> tuple[int, np.ndarray]:
    """How many words have a class of their own, and the counts of all classes."""
    own = min(classes, len(counts.frequent))
    named = counts.counts[:own]
    return own, np.append(named, counts.total - named.sum()).astype(np.float64)


def train(docs: DataFrame, counts: Counts, text: str = "text", classes: int = 2_000, dims: int = 16) -> Model:
    """The model of all ``docs``. The average is a sum for each parameter row, combined by a shuffle;
    the driver gets one row for each class and no more than that."""
    own, class_counts = class_table(counts, classes)
    initial = start_model(class_counts, dims)
    share = (class_counts + 1) / (class_counts + 1).sum()
    words = {w: i for i, w in enumerate(counts.frequent[:own])}
    shared = docs.sparkSession.sparkContext.broadcast((initial, share, words))
    values = [f"v{d}" for d in range(dims + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, share, words = shared.value
        trainer, other = Trainer(model, share), len(words)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low, high in chunks(texts):
                split = [tokens_of(t) for t in texts[low:high]]
                sizes = np.fromiter(map(len, split), np.int64, len(split))
                ids = np.fromiter(map(words.get, (w for ws in split for w in ws), repeat(other)), np.int64, int(sizes.sum()))
                trainer.learn(ids, *examples(ids, sizes, other + 1))
        if trainer.seen:
            context, first, second, output, bias = trainer.parts
            rows = np.vstack([np.pad(m, ((0, 0), (0, 1))) for m in (context, first, second)]
                             + [np.column_stack([output, bias])]).astype(np.float64) * trainer.seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(trainer.seen))),
                 *(pa.array(c) for c in rows.T)], names=["row", "seen", *values])

    parts = docs.select(text).mapInArrow(run, "row long, seen double, " + ", ".join(f"{v} double" for v in values))
    mean = parts.groupBy("row").agg(*[(F.sum(v) / F.sum("seen")).alias(v) for v in values]).collect()
    if not mean:
        return initial
    rows = np.array([r[1:] for r in sorted(mean)], np.float32)
    cuts = np.cumsum([len(initial.context), dims, dims])
    context, first, second, last = np.split(rows, cuts)
    return Model(context[:, :dims], first[:, :dims], second[:, :dims], last[:, :dims], last[:, dims])


class Scorer:
    """Normalised log-probabilities (base 10) of classes; keeps the normaliser of each context."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.one, self.two = model.context @ model.first, model.context @ model.second
        self.size = len(model.context)
        self.normaliser = np.full(self.size * self.size, np.nan, np.float32)

    def score(self, targets: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = one * self.size + two
        fresh = np.unique(key[np.isnan(self.normaliser[key])])
        for low in range(0, len(fresh), 2048):
            part = fresh[low:low + 2048]
            logits = (self.one[part // self.size] + self.two[part % self.size]) @ self.model.output.T + self.model.bias
            most = logits.max(1)
            self.normaliser[part] = most + np.log(np.exp(logits - most[:, None]).sum(1))
        guess = self.one[one] + self.two[two]
        own = np.einsum("bd,bd->b", guess, self.model.output[targets]) + self.model.bias[targets]
        return (own - self.normaliser[key]).astype(np.float64) / LOG10


def score(docs: DataFrame, model: Model, counts: Counts, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    ``base_score``: the unigram log10-probability with add-one smoothing; ``score``: the model's. A
    null or empty text is its end alone. Frequent words are looked up in the task; the counts of the
    others come from a join on the word, after the occurrences within a text are added up. Rows are
    told apart by a number of their own, so repeated rows and null keys each keep their result.
    Columns of these names are replaced.
    """
    own = len(model.bias) - 1
    numbers = {w: i for i, w in enumerate(counts.frequent)}
    others = counts.total - int(counts.counts[:own].sum())
    spread = others + counts.distinct - own + 1
    base_size = counts.total + counts.distinct + 1
    shared = docs.sparkSession.sparkContext.broadcast((model, numbers, counts.counts))

    def start() -> Callable[[list[str | None]], list]:
        model, numbers, n = shared.value
        scorer = Scorer(model)
        log_count = np.append(np.log10(n + 1.0), 0.0)  # the last one: not among the frequent

        def make(texts: list[str | None]) -> list:
            split = [tokens_of(t) for t in texts]
            words = [w for ws in split for w in ws]
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            at = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
            classes = np.where((at < 0) | (at >= own), own, at)
            lm = scorer.score(classes, *examples(classes, sizes, own + 1))
            lm = lm + (classes == own) * (log_count[at] - math.log10(spread))
            base = log_count[at] - math.log10(base_size)
            rare = np.flatnonzero(at < 0)
            owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
            lists: list[Counter] = [Counter() for _ in texts]
            for i, w in zip(owner.tolist(), rare.tolist(), strict=True):
                lists[i][words[w]] += 1
            rows = [[{"token": t.decode("utf-8", "replace"), "n": n} for t, n in c.items()] for c in lists]
            return [sizes, segment_sums((at >= 0).astype(np.int64), sizes).astype(np.int64), segment_sums(base, sizes),
                    segment_sums(lm, sizes), rows]

        return make

    added = "n_tokens long, n_known long, base_score double, score double, __l_rare array<struct<token: string, n: long>>"
    rows = materialize(map_texts(docs, text, added, start, chunk=2_000_000)
                       .drop(text).withColumn("__l_row", F.monotonically_increasing_id()), "lm-rows")
    rare = rows.select("__l_row", F.inline("__l_rare")).join(
        counts.table.withColumnsRenamed({"n": "c"}), "token")
    sums = rare.groupBy("__l_row").agg(
        F.sum("n").alias("__l_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("__l_sum"))
    value = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (rows.drop("__l_rare").join(sums, "__l_row", "left")
            .withColumns({"n_known": F.col("n_known") + value("__l_known"),
                          "train_tokens": F.lit(counts.total).cast("long"),
                          "base_score": F.col("base_score") + value("__l_sum"),
                          "score": F.col("score") + value("__l_sum")})
            .drop("__l_row", "__l_known", "__l_sum"))
