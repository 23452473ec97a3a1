"""Shared parts of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import work_folder

#: Text bytes a Python task works on at once; only a longer single text exceeds it.
PIECE_BYTES = 4 << 20


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: later steps neither rerun it nor depend on one executor."""
    folder = work_folder(df.sparkSession, label)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def parts(spark: SparkSession, least: int = 64) -> int:
    """Buckets to deal rows into: at least `least`, and as many as the session shuffles into."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in slices of about PIECE_BYTES of text, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        ends = np.cumsum(sizes, dtype=np.int64)
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + PIECE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def map_texts(docs: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply `work` to slices of rows inside the tasks; `docs` holds a text column."""

    def run(batches):
        for piece in text_batches(batches):
            yield from work(piece)

    return docs.mapInArrow(run, schema)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes per row; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def utf8(text: str = "text"):
    return F.coalesce(F.col(text), F.lit(""))


class WordCodes(dict):
    """64-bit code of a word: the same in every task. Starts anew when it holds `most` words, so memory stays bounded."""

    def __init__(self, most: int = 400_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Codes of all runs of `width` consecutive codes."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = codes[:n].copy()
    for k in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[k:k + n]
        out ^= out >> np.uint64(29)
    return mixed(out)
