"""Line deduplication that returns keep bitmaps, not text.

Hashes of line keys are range-partitioned and sorted by hash, document (largest first) and
position. Each task streams its rows with constant memory: of a run of equal hashes, the
first document's lines stay, and from the third document on the rest is known to go. Range
partitioning splits the run of a hot line over many tasks; a run that touches the end of a
task's rows is left open, and is settled from at most three documents per task and run.

Edge cases: a NULL text is one empty line. Short keys are never dropped. A NULL id counts as
the smallest one. Rows that share an id are one document when documents are counted, and each
row gets the bitmap of its own text. An empty table gives no bitmaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.texts import columns_out, sliced, written

_NO_ID = -(1 << 63)
MIN_CHARS, MIN_DOCS = 20, 3

_LINES = "h1 bigint, h2 bigint, doc bigint, text_hash bigint, pos int, n_lines int"
_LINES_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("h1", "h2", "doc", "text_hash")]
    + [("pos", pa.int32()), ("n_lines", pa.int32())]
)
_RUNS = f"{_LINES}, state int"
_RUNS_ARROW = pa.schema([*_LINES_ARROW, ("state", pa.int32())])
_DROP, _OPEN, _WITNESS = 0, 1, 2


def count_lines(text: str) -> Column:
    """Lines of a text; a NULL text is one empty line."""
    whole = F.coalesce(text, F.lit(""))
    breaks = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit("")))
    return (breaks + 1).cast("bigint")


def _identity(docs: DataFrame) -> DataFrame:
    """``doc`` and ``text_hash`` name a row; equal rows share them."""
    return docs.withColumns(
        {
            "doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)),
            "text_hash": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )


def line_key(line: bytes, least: int = MIN_CHARS) -> bytes | None:
    """The stripped, lower-cased line, if it has ``least`` code points."""
    key = line.strip().lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8")) < least):
        return None
    return key


def line_hashes(docs: DataFrame, least: int) -> DataFrame:
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for doc, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text.split(b"\n")
                for pos, line in enumerate(lines):
                    if key := line_key(line, least):
                        digest = xxhash.xxh3_128_digest(key)
                        h1 = int.from_bytes(digest[:8], "big", signed=True)
                        h2 = int.from_bytes(digest[8:], "big", signed=True)
                        rows.append((h1, h2, doc, text_hash, pos, len(lines)))
            columns = zip(*rows) if rows else [()] * len(_LINES_ARROW)
            yield columns_out(_LINES_ARROW, dict(zip(_LINES_ARROW.names, columns)))

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return _identity(docs).select("doc", "text_hash", text).mapInArrow(hashes, _LINES)


def _stream(min_docs: int):
    """Marks the rows of a sorted partition; keeps a few documents of the run in hand."""

    def rows_of(batches):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*out) if out else [()] * len(_RUNS_ARROW)
            made = columns_out(_RUNS_ARROW, dict(zip(_RUNS_ARROW.names, columns)))
            out.clear()
            return made

        runs = groupby(rows_of(batches), key=lambda row: row[:2])
        first, upcoming = True, next(runs, None)
        while upcoming is not None:
            # Rows are held back only until the run is known to be large, or ends.
            documents, held, last = 0, [], None
            for row in upcoming[1]:
                if row[2] != last:
                    documents, last = documents + 1, row[2]
                    if documents <= min_docs:
                        held.append([])
                if documents <= min_docs:
                    held[documents - 1].append(row)
                elif first:
                    out.append((*row, _OPEN))
                else:
                    out.append((*row, _DROP))
                if len(out) >= 50_000:
                    yield flush()
            following = next(runs, None)
            # The task's rows may hold only the end, or only the beginning, of this run.
            if first or following is None:
                out.extend((*rows[0], _WITNESS) for rows in held)
                out.extend((*row, _OPEN) for rows in held for row in rows)
            elif documents >= min_docs:
                out.extend((*row, _DROP) for rows in held[1:] for row in rows)
            first, upcoming = False, following
        if out:
            yield flush()

    return mark


def dropped_lines(docs: DataFrame, least: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row (doc, text_hash, pos, n_lines) per line that goes."""
    hashes = written(line_hashes(docs, least), "line-hashes")
    order = ["h1", "h2", F.col("doc").desc(), "pos"]
    ranged = hashes.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = written(ranged.mapInArrow(_stream(min_docs), _RUNS), "line-runs")
    # At most ``min_docs`` witnesses for each of two runs per task: bounded by the task count.
    edges = (
        marked.filter(F.col("state") == _WITNESS)
        .groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("keeper"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    settled = (
        marked.filter(F.col("state") == _OPEN)
        .join(F.broadcast(edges), ["h1", "h2"])
        .filter(F.col("doc") != F.col("keeper"))
    )
    names = ["doc", "text_hash", "pos", "n_lines"]
    return marked.filter(F.col("state") == _DROP).select(*names).union(settled.select(*names))


def pack_bitmap(dropped: list[int], n_lines: int) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    bits = np.frombuffer(zlib.decompress(bitmap), np.uint8)
    return np.unpackbits(bits, count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, least: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, text_hash, n_dropped, bitmap) per document that loses lines; others keep all.

    A bitmap has one bit per line, set for those that stay, packed and deflated.
    """

    @F.pandas_udf("binary")
    def packed(positions: pd.Series, n_lines: pd.Series) -> pd.Series:
        return pd.Series([pack_bitmap(p, n) for p, n in zip(positions, n_lines)], dtype=object)

    return (
        dropped_lines(docs, least, min_docs)
        .groupBy("doc", "text_hash")
        .agg(F.collect_set("pos").alias("positions"), F.max("n_lines").alias("lines"))
        .select(
            "doc",
            "text_hash",
            F.size("positions").cast("bigint").alias("n_dropped"),
            packed("positions", "lines").alias("bitmap"),
        )
    )


def without_lines(text: str, bitmap: bytes | None) -> str:
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = unpack_bitmap(bitmap, len(lines))
    return "\n".join([line for line, stays in zip(lines, keep) if stays])


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, count_as: str | None = None
) -> DataFrame:
    """All columns of ``docs`` with ``text`` cut to the lines that stay.

    ``n_chars``, where there is one, follows the text of documents that lose lines.
    ``count_as`` names a further column for how many a document loses.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([without_lines(t, b) for t, b in zip(texts, found)], dtype=object)

    names = docs.columns
    row = F.struct(*[docs[c] for c in names]).alias("_row")
    left = _identity(docs.select(row, "doc_id", "text"))
    key = [left["doc"] == bitmaps["doc"], left["text_hash"] == bitmaps["text_hash"]]
    joined = left.join(bitmaps, key, "left")
    whole = F.coalesce("_row.text", F.lit(""))
    kept = F.when(F.col("bitmap").isNull(), F.col("_row.text")).otherwise(cut(whole, "bitmap"))
    found = {c: F.col("_row").getField(c) for c in names} | {"text": kept}
    if "n_chars" in names:
        n = F.when(F.col("bitmap").isNotNull(), F.char_length(kept)).otherwise(found["n_chars"])
        found["n_chars"] = n.cast(docs.schema["n_chars"].dataType)
    columns = [column.alias(c) for c, column in found.items()]
    if count_as:
        columns.append(F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias(count_as))
    return joined.select(*columns)
