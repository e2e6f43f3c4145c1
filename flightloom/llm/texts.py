"""Helpers shared by the operators: texts as bytes, words, hashes, folds, written tables.

A word is a run of ``[^\\x20\\x09-\\x0D]``. That is what ``bytes.split`` finds, as ``bytes``
knows only ASCII white space; ``bytes.lower`` likewise changes only A-Z.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.session import shared_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The white space that ``bytes.split`` knows.
BLANKS = " \t\n\x0b\x0c\r"


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of ``text`` (NULL: empty); other columns go."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as an empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


# Of a table whose size is known before it is written, at least so many in a file.
ROWS_IN_FILE = 5_000


def written(frame: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The frame as a parquet table in the folder the cluster shares; cuts the lineage.

    With ``rows``, about how many it has, a small one is not spread over as many files as there
    are shuffle partitions: each file costs its executor several calls and processes.
    """
    spark = frame.sparkSession
    path = shared_path(spark, name)
    if rows is not None:
        frame = frame.coalesce(1 + rows // ROWS_IN_FILE)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def with_totals(rows: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """The inner join of ``rows`` and ``totals``, an aggregate by ``key``; hot keys are split.

    Spark splits the rows of a hot key if both sides are shuffled for the join. An aggregate
    lies by its key already and would not be, hence a second key that says the same.
    """
    again = F.xxhash64(key)
    left, right = rows.withColumn("_again", again), totals.withColumn("_again", again)
    return left.join(right, [key, "_again"]).drop("_again")


def hash_sample(rows: DataFrame, most: int, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """At most ``most`` rows, those with the least hashes of ``by``; repeatable.

    All but about twice as many are filtered out where they are, so that the task that sorts
    the rest has a bounded number of rows. ``by`` tells rows apart.
    """
    share = min(1.0, (2 * most + 100) / max(1, rows.count()))
    rank = F.pmod(F.xxhash64(*by), F.lit(1 << 40))
    few = rows.filter(rank < int(share * (1 << 40)))
    return few.orderBy(rank, *rows.columns).limit(most)


# A row of a sample: an id may have any number of rows, and equal rows count once.
SAMPLED = ("doc_id", "_hash")


def text_sample(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """``doc_id``, ``text``, ``_hash`` and the columns of ``ids`` for rows with these ids.

    At most ``most`` different rows, however many an id has; equal rows are still there more
    than once, to be dropped by ``SAMPLED`` when they are small. ``ids`` has one row per id and
    a bounded number of them.
    """
    own = id_and_text(docs).withColumn("_hash", F.xxhash64("text"))
    found = own.join(F.broadcast(ids.select("doc_id")), "doc_id").select(*SAMPLED)
    keys = written(found.distinct(), "sample-keys")
    few = hash_sample(keys, most, SAMPLED)
    return own.join(F.broadcast(few.join(ids, "doc_id")), [*SAMPLED])


def columns_out(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def sliced(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes, so that long texts don't pile up."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


class WordCache(dict):
    """A value per word, found once. Holds ``most`` bytes of words and values, and as many of
    those before; longer words than ``LONGEST`` are not held, as few of them come again."""

    LONGEST = 64
    # What an entry takes beside its word and value.
    ENTRY = 100

    def __init__(self, value: Callable[[bytes], object], most: int = 24 << 20) -> None:
        super().__init__()
        self.value, self.most, self.size, self.older = value, most, 0, {}

    def __missing__(self, word):
        if len(word) > self.LONGEST:
            return self.value(word)
        found = self.older.get(word)
        if found is None:
            found = self.value(word)
        self.size += getsizeof(word) + getsizeof(found) + self.ENTRY
        if self.size > self.most:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self[word] = found
        return found


# One per Python worker, which serves many tasks.
_HASHES = WordCache(xxhash.xxh3_64_intdigest)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


# An odd multiplier near 2^64 / golden ratio, and the usual 64-bit finisher.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; with fewer words one, for the whole; or none."""
    n = len(hashes)
    size = min(size, n)
    if not n:
        return hashes
    out = hashes[: n - size + 1].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k : n - size + 1 + k]
    return mix(out + np.uint64(size))
