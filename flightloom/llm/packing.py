"""Best-fit packing by minimum bin slack.

Per bin, a subset-sum over the available lengths, kept as the bits of one integer, finds the
fullest feasible combination with the longest length left; it is removed as often as it fits
into what is left. The search sees only how many pieces each length has (at most ``size``
counts), so it does not grow with the corpus; pieces are numbered within their length by
Spark and take the places that the plan gives to these numbers.

Edge cases: a NULL text is an empty one and has the end token alone. Rows are packed one by
one, so repeated rows and NULL ids each get places. An empty table gives no pieces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import LongType, StructField, StructType

from flightloom.llm.texts import columns_out, id_and_text, sliced, written

SIZE = 1024
END = 2
# Rows of one length are numbered in parts of about so many, so that a hot length is split.
PART_ROWS = 1_000_000
# Fixed values of the tokenizer family that the vocabulary belongs to: the pattern that cuts
# texts, and the added token, which has its own id wherever a text spells it out.
SPECIAL = {"<|endoftext|>": 50256}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# The pattern keeps a step per blank of a run and breaks at a million of them. Longer texts are
# looked through for such runs; the blanks are all characters of Unicode's White_Space.
LONG = 100_000
_BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=2)
def _encoders(path: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The byte-level vocabulary from its file of base64 tokens and ranks; the second encoder
    takes its text as one word."""
    import base64

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines)}
    names = {"mergeable_ranks": ranks, "special_tokens": SPECIAL}
    return (
        tiktoken.Encoding("bytes", pat_str=PATTERN, **names),
        tiktoken.Encoding("one-word", pat_str=r"(?s:.+)", **names),
    )


def token_ids(text: str, path: str, long: int = LONG) -> array:
    encoder, whole = _encoders(path)
    ids, at = array("I"), 0
    if len(text) >= long:
        # A run is one word, but for its last blank if a word follows: that goes with the word.
        for run in re.finditer(f"[{_BLANKS}]{{{long},}}", text):
            rest = run.end()
            if rest < len(text) and not text.startswith(tuple(SPECIAL), rest):
                rest -= 1
            ids.extend(encoder.encode(text[at : run.start()], allowed_special="all"))
            ids.extend(whole.encode(text[run.start() : rest], disallowed_special=()))
            at = rest
    ids.extend(encoder.encode(text[at:], allowed_special="all"))
    ids.append(END)
    return ids


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than ``size``."""
    head = n % size or size
    return [(0, head), *((at, size) for at in range(head, n, size))]


_PIECES = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
)


def pieces(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document's ids, with the ids themselves if asked for."""
    schema = pa.schema([*_PIECES, ("ids", pa.binary())]) if with_ids else _PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 8 << 20):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = token_ids(text.decode("utf-8"), path)
                whole = np.asarray(ids, "<u4").tobytes()
                for piece, (start, length) in enumerate(cuts(len(ids), size)):
                    part = whole[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, crc32(part), part))
            yield columns_out(schema, dict(zip([*_PIECES.names, "ids"], zip(*rows))))

    fields = ", ".join(f"{c} bigint" for c in _PIECES.names) + ", ids binary" * with_ids
    return id_and_text(docs).mapInArrow(cut, fields)


def fullest(counts: dict[int, int], size: int) -> list[int]:
    """The lengths of the fullest bin that holds the longest length left, longest first.

    ``reach`` has bit s set if some of the lengths seen so far add up to s.
    """
    lengths = sorted(counts, reverse=True)
    room = size - lengths[0]
    every = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for rank, length in enumerate(lengths):
        left = min(counts[length] - (rank == 0), room // length)
        chunk = 1
        while left > 0:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & every
            left, chunk = left - take, chunk * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = [lengths[0]]
    for length, take, before in reversed(steps):
        # Lengths added later are shorter; they are used only where needed.
        if not before >> total & 1:
            total -= length * take
            chosen += [length] * take
    return sorted(chosen, reverse=True)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, how many such bins); uses up all counts."""
    left = {length: n for length, n in counts.items() if n > 0}
    bins = []
    while left:
        bin_ = fullest(left, size)
        need = {length: bin_.count(length) for length in set(bin_)}
        times = min(left[length] // k for length, k in need.items())
        bins.append((tuple(bin_), times))
        for length, k in need.items():
            left[length] -= k * times
            if not left[length]:
                del left[length]
    return bins


def places(bins: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length: rows (first number, first sequence, offset) in the order of the numbers."""
    used: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for bin_, times in bins:
        offset = 0
        for length in bin_:
            first = used.get(length, 0)
            found.setdefault(length, []).append((first, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def pack(pieces: DataFrame, size: int = SIZE, part_rows: int = PART_ROWS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``pieces`` must be a parquet table.

    Rows go by their place in the table's files, so that equal ones are told apart.
    """
    of_length = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    parts_of = [-(-of_length.get(n, 0) // part_rows) or 1 for n in range(size + 1)]
    place_in = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    named = pieces.select(*pieces.columns, *(c.alias(n) for c, n in zip(place_in, ("_file", "_at"))))
    many = F.element_at(F.lit(parts_of), (F.col("length") + 1).cast("int"))
    part = F.pmod(F.xxhash64("_file", "_at"), many).cast("int")
    parts = named.withColumn("_part", part)
    # One row per length and million pieces of it.
    counts = parts.groupBy("length", "_part").count().collect()
    counts.sort(key=lambda row: (row["length"], row["_part"]))
    # By length, the number of its pieces in the parts before.
    base = [np.zeros(n, np.int64) for n in parts_of]
    seen = dict.fromkeys(of_length, 0)
    for row in counts:
        base[row["length"]][row["_part"]] = seen[row["length"]]
        seen[row["length"]] += row["count"]
    where = pieces.sparkSession.sparkContext.broadcast((base, places(plan(of_length, size))))

    within = Window.partitionBy("length", "_part").orderBy("_file", "_at")
    numbered = parts.withColumn("_number", F.row_number().over(within) - 1)
    own, added = pieces.columns, ["sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, table = where.value
        for batch in batches:
            length = batch["length"].to_numpy()
            number, part = batch["_number"].to_numpy(), batch["_part"].to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                rows, own_number = table[int(one)], number[at] + base[int(one)][part[at]]
                row = rows[np.searchsorted(rows[:, 0], own_number, "right") - 1]
                sequence[at] = row[:, 1] + own_number - row[:, 0]
                offset[at] = row[:, 2]
            arrays = [*batch.select(own).columns, pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*own, *added])

    fields = StructType([*pieces.schema, *(StructField(c, LongType()) for c in added)])
    return numbered.mapInArrow(place, fields)


def pack_documents(
    docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False
) -> DataFrame:
    """Tokenizes, cuts and packs whole documents."""
    return pack(written(pieces(docs, path, size, with_ids), "pieces"), size)
