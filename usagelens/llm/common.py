"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Separators of words: the space and the five ASCII control characters from tab to return.
#: ``bytes.split()`` separates at exactly these.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text as an array, without a user function; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS + "+"))


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id, written as text, leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == remainder, F.lit(False))


def text_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def chunks(texts: list, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` characters each; a longer text has its own range."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class WordTable(dict):
    """Numbers words as they come and keeps what ``compute`` says of each.

    ``compute`` gets a list of new words and returns an array with a row for each. The table
    empties itself between calls when it has more than ``limit`` words, so that its memory does
    not follow the vocabulary of the corpus.
    """

    def __init__(self, compute: Callable[[list[bytes]], np.ndarray], limit: int = 400_000) -> None:
        super().__init__()
        self.compute, self.limit, self.fresh = compute, limit, []
        self.rows = compute([])

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """The row of each of ``words``."""
        if len(self) > self.limit:
            self.clear()
            self.rows = self.rows[:0]
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            self.rows = np.concatenate([self.rows, self.compute(self.fresh)])
            self.fresh = []
        return self.rows[numbers]


def segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; runs may be empty."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64),
                            np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs with these starts and sizes, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def map_texts(docs: DataFrame, text: str, added: str,
              start: Callable[[], Callable[..., list]], also: tuple[str, ...] = (),
              chunk: int = 4_000_000) -> DataFrame:
    """``docs`` with the columns ``added`` (a DDL schema), made of their texts in Arrow batches.

    ``start`` is called once a task and returns a function from some texts, and the columns ``also``,
    to a list of new columns. The columns of ``docs`` pass through untouched, so nulls and large
    integers stay exact; columns with the names of new ones are replaced. About ``chunk`` characters
    are worked on at a time.
    """
    fields = StructType.fromDDL(added)
    docs = docs.drop(*fields.names)
    schema = StructType([*docs.schema.fields, *fields.fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            texts, *more = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text, *also)]
            for low, high in chunks(texts, chunk):
                columns = make(texts[low:high], *(c[low:high] for c in more))
                made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                kept = [c.slice(low, high - low) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def count_floor(counted: DataFrame, count: str, most_rows: int) -> int | None:
    """The least bound on ``count`` that at most ``most_rows`` rows of ``counted`` reach.

    Bounds go in steps of an eighth of a power of two, so at most a few hundred rows come to the
    driver. None if even the highest step has too many.
    """
    step = F.floor(8 * F.log2(count)).cast("int").alias("step")
    sizes = counted.groupBy(step).agg(F.count("*"), F.min(count)).collect()
    floor, rows = None, 0
    for _, size, least in sorted(sizes, reverse=True):
        if rows + size > most_rows:
            break
        floor, rows = least, rows + size
    return floor
