"""Vector codes: product quantisation in integers, by Drake and Hamerly's adaptive bounds.

Vectors are cut into four parts; each part position has a codebook of up to 256 entries, found
by rounds of exact integer k-means. Between rounds each part keeps its b nearest entries with
ordered lower bounds of their distances, and one outer bound for all others. When the entries
have moved, bounds fall by as much as these; a part whose own entry is nearer than every bound
keeps it, otherwise the listed entries are compared in integers, and only a part that the outer
bound does not settle is compared with the whole codebook. b follows from how many bounds the
last round needed.

A round is one pass over the written table and one sum per entry; the driver holds codebooks
only, whose size does not grow with the rows.

Edge cases: vectors that are NULL or hold NULL, NaN or infinite components are dropped. A vector
whose length is not that of the first kept one (least id, NULL last, then least vector), or with
a component so large that squared distances leave 64 bits, has no code and NULL errors, and
takes no part in the codebooks. Lengths that four does not divide are filled up with zeros.
With fewer than 256 vectors the codebooks are as small. Rows with equal ids each have a code;
sums beyond 64 bits are NULL. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from flightloom.llm.texts import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Bounds per part: at first, and the least and most that the adaption may choose.
BOUNDS, LEAST_BOUNDS, MOST_BOUNDS = 8, 2, 32
# The adaption leaves so many parts in a thousand to the outer bound.
LEFT_OVER = 20
_CHUNK = 4096


@dataclass
class Model:
    """Codebooks, (entries, width) per part, and what a round needs of the one before."""

    books: list[np.ndarray]
    moved: list[np.ndarray] | None = None
    bounds: int = BOUNDS

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    def digest(self) -> str:
        numbers = (str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def integer_vectors(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, ints) of the kept rows, written, and the width of a part.

    ``ints`` is NULL for vectors that have no code.
    """
    usable = F.col("embedding").isNotNull() & F.forall("embedding", _finite)
    kept = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    kept = kept.filter(usable)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1)
    size = first.select(F.size("embedding")).first()
    size = size[0] if size else 0
    width = max(1, -(-size // PARTS))
    # Four parts' squared distances fit in 64 bits.
    limit = min(math.isqrt((1 << 60) // width) // 2, (1 << 31) - 1)
    fits = (F.size("embedding") == size) & F.forall(
        "embedding", lambda x: F.abs(x.cast("double")) < limit / SCALE - 1
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    padded = F.concat(whole, F.array_repeat(F.lit(0), PARTS * width - size))
    ints = F.when(fits, padded).alias("ints")
    return written(kept.select("vec_id", "label", ints), "vectors"), width


def first_books(vectors: DataFrame, width: int, entries: int = ENTRIES) -> list[np.ndarray]:
    order = [F.col("vec_id").asc_nulls_last(), "ints"]
    rows = vectors.filter("ints is not null").orderBy(*order).limit(entries).select("ints")
    start = np.array([r.ints for r in rows.collect()], np.int64).reshape(-1, PARTS, width)
    return [np.ascontiguousarray(start[:, p]) for p in range(PARTS)]


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all entries, exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:  # sums of products are exact in doubles
        a, b = x.astype(np.float64), book.astype(np.float64)
        found = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
        return found.astype(np.int64)
    found = np.zeros((len(x), len(book)), np.int64)
    for k in range(x.shape[1]):
        found += (x[:, k, None] - book[None, :, k]) ** 2
    return found


def _below(x: np.ndarray) -> np.ndarray:
    """As 32-bit numbers that are no larger."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def search_all(x: np.ndarray, book: np.ndarray, bounds: int):
    """(near, low): per vector its nearest entries in order, and lower bounds of the distances
    to each but the first and, last, to all that are not listed. Ties go to the lower entry."""
    n, k = len(x), len(book)
    found = distances(x, book)
    best = found.argmin(1)
    rows = np.arange(n)
    least = found[rows, best]
    found[rows, best] = -1
    if k > bounds:
        near = np.argpartition(found, bounds, axis=1)[:, : bounds + 1]
        order = np.argsort(np.take_along_axis(found, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        outer = np.take_along_axis(found, near[:, -1:], 1)
        near = near[:, :-1]
        # The entry that the partition puts at the border is the nearest of those left out.
        outer = np.sqrt(outer.astype(np.float64))
    else:
        near = np.argsort(found, axis=1, kind="stable")
        near = np.concatenate([near, np.repeat(near[:, :1], bounds - k, axis=1)], axis=1)
        outer = np.full((n, 1), np.inf)
    low = np.sqrt(np.maximum(np.take_along_axis(found, near, 1), 0).astype(np.float64))
    low[:, min(k, bounds) :] = np.inf
    low = np.concatenate([low[:, 1:], outer], axis=1)
    return near, low, least


def search_near(x: np.ndarray, model: Model, part: int, near: np.ndarray, low: np.ndarray):
    """The same after the entries have moved, from the lists of the round before.

    Also returns how many listed bounds each vector needed; one more than there are means that
    it was compared with the whole codebook.
    """
    book, moved = model.books[part], model.moved[part]
    own = ((x - book[near[:, 0]]) ** 2).sum(1)
    low = low.astype(np.float64)
    low[:, :-1] -= moved[near[:, 1:]]
    low[:, -1] -= moved.max(initial=0)
    # Lists stay ordered by their bounds.
    order = np.argsort(low[:, :-1], axis=1, kind="stable")
    near = np.concatenate([near[:, :1], np.take_along_axis(near[:, 1:], order, 1)], axis=1)
    low = np.concatenate([np.take_along_axis(low[:, :-1], order, 1), low[:, -1:]], axis=1)
    reach = np.sqrt(own.astype(np.float64)) * (1 + 1e-9)
    need = (low[:, :-1] <= reach[:, None]).sum(1)
    unsure = np.flatnonzero((need > 0) | (low[:, -1] <= reach))
    if len(unsure):
        listed = near[unsure]
        # By entry, then stably by distance: ties go to the lower entry.
        listed = np.sort(listed, axis=1)
        exact = ((x[unsure, None] - book[listed]) ** 2).sum(2)
        # Lists that were filled up name their own entry again.
        exact[:, 1:][listed[:, 1:] == listed[:, :-1]] = 1 << 61
        order = np.argsort(exact, axis=1, kind="stable")
        listed = np.take_along_axis(listed, order, 1)
        exact = np.take_along_axis(exact, order, 1)
        near[unsure], own[unsure] = listed, exact[:, 0]
        low[unsure, :-1] = np.sqrt(exact[:, 1:].astype(np.float64))
        settled = np.sqrt(exact[:, 0].astype(np.float64)) * (1 + 1e-9) < low[unsure, -1]
        rest = unsure[~settled]
        if len(rest):
            near[rest], low[rest], own[rest] = search_all(x[rest], book, near.shape[1])
            need[rest] = near.shape[1]
    return near, low, own, need


def resized(near: np.ndarray, low: np.ndarray, bounds: int):
    """Lists of another length: what is cut off joins the outer bound."""
    have = near.shape[1]
    if bounds < have:
        outer = low[:, bounds - 1 :].min(1, keepdims=True)
        return near[:, :bounds], np.concatenate([low[:, : bounds - 1], outer], axis=1)
    if bounds > have:
        more = np.repeat(near[:, :1], bounds - have, axis=1)
        far = np.full((len(low), bounds - have), np.inf)
        return (
            np.concatenate([near, more], axis=1),
            np.concatenate([low[:, :-1], far, low[:, -1:]], axis=1),
        )
    return near, low


def _assign(table: DataFrame, model: Model, listed: int | None) -> DataFrame:
    """One round: the table with ``near``, ``low`` and ``need`` of each row.

    ``listed`` is the length of the lists in the table, None if it has none yet.
    """
    width, bounds = model.width, model.bounds
    schema = StructType(
        [
            *[table.schema[c] for c in ("vec_id", "label", "ints")],
            *[StructField(c, BinaryType()) for c in ("near", "low", "need")],
            StructField("error", LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def chunk(batch: pa.RecordBatch) -> pa.RecordBatch:
        ints = batch["ints"]
        has = np.flatnonzero(np.asarray(ints.is_valid()))
        x = np.asarray(ints.flatten()).reshape(len(has), PARTS, width).astype(np.int64)
        lists = np.zeros((len(has), PARTS, bounds), np.uint8)
        lows = np.zeros((len(has), PARTS, bounds), np.float32)
        needs = np.zeros((len(has), PARTS), np.uint8)
        errors = np.zeros(len(has), np.int64)
        if listed is not None:
            old = _stacked(batch["near"], np.uint8, (PARTS, listed))
            old_low = _stacked(batch["low"], np.float32, (PARTS, listed))
        for p in range(PARTS if len(has) else 0):
            own = x[:, p]
            if listed is None:
                near, low, error = search_all(own, model.books[p], bounds)
            else:
                near, low, error, need = search_near(
                    own, model, p, old[:, p].astype(np.int64), old_low[:, p]
                )
                needs[:, p] = need
                near, low = resized(near, low, bounds)
            lists[:, p], lows[:, p] = near, _below(low)
            errors += error
        spread = {
            "near": _blobs(lists, has, len(batch)),
            "low": _blobs(lows, has, len(batch)),
            "need": _blobs(needs, has, len(batch)),
        }
        error = np.ma.masked_all(len(batch), np.int64)
        error[has] = errors
        columns = {c: batch[c] for c in ("vec_id", "label", "ints")} | spread
        columns["error"] = pa.array(error.filled(0), mask=np.ma.getmaskarray(error))
        return pa.RecordBatch.from_arrays(
            [columns[f.name].cast(f.type) for f in arrow], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                yield chunk(batch.slice(at, _CHUNK))

    return table.mapInArrow(run, schema)


def _stacked(column: pa.Array, kind: type, shape: tuple) -> np.ndarray:
    whole = b"".join(column.drop_null().to_pylist())
    return np.frombuffer(whole, kind).reshape(-1, *shape)


def _blobs(rows: np.ndarray, has: np.ndarray, n: int) -> pa.Array:
    out: list[bytes | None] = [None] * n
    for at, row in zip(has.tolist(), rows):
        out[at] = row.tobytes()
    return pa.array(out, pa.binary())


def _sums(state: DataFrame, width: int, bounds: int) -> DataFrame:
    """(part, entry, n, s0, s1, ...) over all rows; part -1 counts needed bounds instead."""
    kind = pa.schema(
        [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, ENTRIES, width), np.int64)
        count = np.zeros((PARTS, ENTRIES), np.int64)
        needed = np.zeros(256, np.int64)
        for batch in batches:
            x = np.asarray(batch["ints"].drop_null().flatten()).reshape(-1, PARTS, width)
            code = _stacked(batch["near"], np.uint8, (PARTS, bounds))[:, :, 0]
            needed += np.bincount(
                _stacked(batch["need"], np.uint8, (PARTS,)).ravel(), minlength=256
            )
            for p in range(PARTS):
                order = np.argsort(code[:, p], kind="stable")
                entries, starts = np.unique(code[order, p], return_index=True)
                if len(entries):
                    total[p, entries] += np.add.reduceat(x[order, p].astype(np.int64), starts)
                    count[p] += np.bincount(code[:, p], minlength=ENTRIES)
        rows = [
            (int(p), int(e), int(count[p, e]), total[p, e].tolist())
            for p, e in zip(*np.nonzero(count))
        ]
        rows += [(-1, int(k), int(needed[k]), [0] * width) for k in np.flatnonzero(needed)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind
            )

    slim = state.select("ints", "near", "need").filter("ints is not null")
    partial = slim.mapInArrow(run, "part int, entry int, n bigint, s array<bigint>")
    wide = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide)


def _moved(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far each entry moved, rounded up."""
    step = ((after - before) ** 2).sum(1).astype(np.float64)
    return np.nextafter(np.sqrt(step) * (1 + 1e-12), np.inf)


def adapted(needed: dict[int, int], bounds: int) -> int:
    """The list length for the next round: as many bounds as all but some parts needed.

    ``needed[k]`` parts had k bounds in their way; k = ``bounds`` had to search everything.
    """
    total = sum(needed.values())
    if needed.get(bounds, 0) * 1000 > LEFT_OVER * total:
        return min(MOST_BOUNDS, 2 * bounds)
    for size in range(LEAST_BOUNDS, bounds):
        beyond = sum(n for k, n in needed.items() if k >= size)
        if beyond * 1000 <= LEFT_OVER * total:
            return size
    return bounds


def quantise(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Model, list[int]]:
    """(vec_id, label, code, error) per kept row, written; the model; the list lengths used."""
    vectors, width = integer_vectors(embeddings)
    model = Model(first_books(vectors, width))
    table, listed, used = vectors, None, []
    for _ in range(rounds):
        used.append(model.bounds)
        table = written(_assign(table, model, listed), "bounds")
        counted = listed is not None
        listed = model.bounds
        after = [book.copy() for book in model.books]
        needed: dict[int, int] = {}
        for part, entry, n, *sums in _sums(table, width, listed).collect():
            if part < 0:
                needed[entry] = n
            else:
                after[part][entry] = [int(s) // n for s in sums]
        moved = [_moved(a, b) for a, b in zip(model.books, after)]
        bounds = adapted(needed, listed) if counted else listed
        model = Model(after, moved, bounds)
    coded = _assign(table, model, listed)
    lists = F.hex("near")
    parts = [F.substr(lists, F.lit(1 + 2 * model.bounds * p), F.lit(2)) for p in range(PARTS)]
    code = F.lower(F.concat(*parts)).cast(StringType())
    return written(coded.select("vec_id", "label", code.alias("code"), "error"), "codes"), model, used


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum over rows of equal label; NULL labels are one label."""
    totals = coded.groupBy(F.col("label").alias("_label")).agg(
        F.try_sum("error").alias("label_error")
    )
    totals = written(totals, "label-errors")
    return coded.join(totals, coded["label"].eqNullSafe(totals["_label"]), "left").drop("_label")
