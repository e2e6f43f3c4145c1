"""Quality classifier: random-indexing word vectors, pooled, and a two-layer numpy network.

Random indexing: each word has a fixed sparse vector of +1 and -1; the vector of a word is the
sum of those of its neighbours over the whole corpus. Words are kept in ``WORDS`` hashed rows
and, by their shape (``Aa.``, ``A!``, ``9``), in ``SHAPES`` further rows, so the table has a
fixed size and a rare word still has the vector of its shape. A document is the mean of its
words' vectors with a few shares and lengths; the network learns on at most ``MOST_LABELLED``
labelled rows, and one temperature, fitted on rows kept out of training, calibrates it.

Only the text is an input of a score. Edge cases: a NULL text is an empty one, whose vector
is zero, and gets a score like any other. Rows are scored one by one. Without labels of both
kinds every score is the share of label 1, or 0.5. An id has the label that most of its label
rows have (1 if as many), and counts once; its different texts count as rows, equal ones once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.texts import (
    SAMPLED,
    WordCache,
    columns_out,
    hash_sample,
    id_and_text,
    sliced,
    text_sample,
    written,
)

WORDS, SHAPES, DIM = 4096, 512, 48
NONZERO = 6
NEIGHBOURS = 2
MOST_LABELLED = 12_000
HIDDEN = 32
_ROWS = WORDS + SHAPES


_KINDS = bytes(
    65 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else 97 if 97 <= b <= 122 or b >= 128 else b
    for b in range(256)
)


def shape(word: bytes) -> bytes:
    """Runs of upper case, lower case, digits or one other byte as one sign each."""
    return re.sub(rb"(.)\1+", rb"\1", word.translate(_KINDS), flags=re.DOTALL)[:12]


# By a word's translated form, of which there are few, and by the word: both rows in a number.
_FORM_OF = WordCache(lambda kinds: crc32(shape(kinds)) % SHAPES, most=8 << 20)
_ROWS_OF = WordCache(
    lambda word: crc32(word) % WORDS * SHAPES + _FORM_OF[word.translate(_KINDS)]
)


def word_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.fromiter(map(_ROWS_OF.__getitem__, words), np.int64, len(words))
    return both // SHAPES, WORDS + both % SHAPES


def index_vectors() -> np.ndarray:
    """The sparse random vector of each row."""
    rng = np.random.default_rng(7)
    out = np.zeros((_ROWS, DIM), np.float32)
    for row in out:
        row[rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Sums the neighbours' index vectors over all documents; rows of unit length."""
    random = index_vectors()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # How often each row is followed by another, one or two words on; fixed in size.
        follow = np.zeros(_ROWS * _ROWS, np.int32)
        for batch in sliced(batches, 2 << 20):
            words: list[bytes] = []
            for text in batch["text"].to_pylist():
                words += text.split()
                words += [b""] * NEIGHBOURS  # keeps documents apart
            row, form = word_rows(words)
            real = np.fromiter(map(len, words), np.int64, len(words)) > 0
            for k in range(1, NEIGHBOURS + 1):
                both = real[:-k] & real[k:]
                for left in (row, form):
                    at = left[:-k][both] * _ROWS
                    for right in (row, form):
                        np.add.at(follow, at + right[k:][both], 1)
        counts = follow.reshape(_ROWS, _ROWS)
        sums = np.zeros((_ROWS, DIM), np.float32)
        for at in range(0, _ROWS, 512):
            sums[at : at + 512] += counts[at : at + 512].astype(np.float32) @ random
            sums += counts[at : at + 512].T.astype(np.float32) @ random[at : at + 512]
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(list(sums[used]), pa.list_(pa.float32()))],
            ["row", "vector"],
        )

    parts = id_and_text(docs).select("text").mapInArrow(gather, "row int, vector array<float>")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((_ROWS, DIM), np.float64)
        for batch in batches:
            vectors = batch["vector"].flatten().to_numpy(zero_copy_only=False)
            np.add.at(sums, batch["row"].to_numpy(), vectors.reshape(-1, DIM))
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(list(sums[used].astype(np.float32)))],
            ["row", "vector"],
        )

    # Summed row by row in parallel; what the driver gets has at most _ROWS vectors.
    summed = parts.repartition("row").mapInArrow(add, "row int, vector array<float>").collect()
    table = np.zeros((_ROWS, DIM), np.float32)
    for row in summed:
        table[row["row"]] += np.array(row["vector"], np.float32)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.maximum(length, 1e-9)


def features(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Per text: the mean word vector, the mean shape vector, and a few shares."""
    out = np.zeros((len(texts), 2 * DIM + 4), np.float32)
    for start in range(0, len(texts), 256):
        _features(texts[start : start + 256], table, out[start : start + 256])
    return out


def _features(texts: list[bytes], table: np.ndarray, out: np.ndarray) -> None:
    words: list[bytes] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.split()
        if own:
            lengths[i] = len(own)
            words += own
            lines = [line for line in text.split(b"\n") if line.strip()]
            out[i, -4:] = (
                np.log1p(len(own)) / 10,
                len(set(own)) / len(own),
                len(set(lines)) / max(1, len(lines)),
                min(len(text) / len(own), 40) / 40,
            )
    owner = np.repeat(np.arange(len(texts)) * _ROWS, lengths)
    row, form = word_rows(words)
    counts = np.bincount(owner + row, minlength=len(texts) * _ROWS)
    counts += np.bincount(owner + form, minlength=len(texts) * _ROWS)
    shares = counts.reshape(len(texts), _ROWS) / np.maximum(lengths, 1)[:, None].astype(np.float32)
    shares = shares.astype(np.float32)
    out[:, :DIM] = shares[:, :WORDS] @ table[:WORDS]
    out[:, DIM : 2 * DIM] = shares[:, WORDS:] @ table[WORDS:]


@dataclass
class Network:
    """Two layers with a scaled input; ``temperature`` divides the logit."""

    center: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.center) / self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -30, 30)
        return 1 / (1 + np.exp(-z.astype(np.float64)))


def constant(width: int, share: float) -> Network:
    """A network that gives every input the score ``share``."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    zero = np.zeros(width, np.float32)
    return Network(
        zero, zero + 1, np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.log(share / (1 - share))
    )


def train(x: np.ndarray, y: np.ndarray, seed: int = 1) -> Network:
    """Adam on the logistic loss; the temperature is fitted on every fifth row."""
    if len(set(y.tolist())) < 2:
        return constant(x.shape[1], float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held].tolist())) < 2:
        held[:] = False
    xt, yt = x[~held], y[~held].astype(np.float64)
    center, scale = xt.mean(axis=0), xt.std(axis=0) + 1e-3
    xt = (xt - center) / scale
    weights = [
        rng.normal(0, np.sqrt(2 / xt.shape[1]), (xt.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(max(12, min(200, 60_000 // len(yt)))):
        for rows in np.array_split(rng.permutation(len(yt)), max(1, len(yt) // 128)):
            xb, yb = xt[rows], yt[rows]
            before = xb @ weights[0] + weights[1]
            hidden = np.maximum(before, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30)))
            error = (p - yb) / len(rows)
            back = np.outer(error, weights[2]) * (before > 0)
            grads = [xb.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
            step += 1
            for w, g, (m, v) in zip(weights, grads, moments):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(center, scale, weights[0], weights[1], weights[2], float(weights[3][0]))
    if held.any():
        z, yh = net.logits(x[held]), y[held]
        tries = np.geomspace(0.25, 8, 41)
        net.temperature = float(min(tries, key=lambda t: np.logaddexp(0, np.where(yh, -z, z) / t).sum()))
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` different labelled texts, by a hash of the id; see ``text_sample``."""
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    once = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    return text_sample(docs, hash_sample(written(once, "labels"), most), most)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, Network]:
    """Word vectors from all ``docs``, a network from the ``labels`` given."""
    table = word_vectors(docs)
    width = 2 * DIM + 4

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4 << 20):
            x = features(batch["text"].to_pylist(), table)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in names], pa.array(list(x), pa.list_(pa.float32()))],
                [*names, "x"],
            )

    names = (*SAMPLED, "label")
    sample = labelled_sample(docs, labels, label, MOST_LABELLED).select(*names, "text")
    made = sample.mapInArrow(vectors, "doc_id bigint, _hash bigint, label int, x array<float>")
    # At most MOST_LABELLED vectors, as equal rows meet before they get here.
    rows = made.dropDuplicates([*SAMPLED]).toArrow()
    order = np.lexsort((rows["_hash"].to_numpy(), rows["doc_id"].to_numpy()))
    order = np.random.default_rng(3).permutation(order) if len(order) else order
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return table, train(x[order], rows["label"].to_numpy()[order])


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: tuple[np.ndarray, Network]) -> DataFrame:
    """``doc_id`` and the probability of label 1 for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = shared.value
        for batch in sliced(batches, 4 << 20):
            found = net.scores(features(batch["text"].to_pylist(), table))
            yield columns_out(_SCORES, {"doc_id": batch["doc_id"], "score": found})

    return id_and_text(docs).mapInArrow(judge, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, Network], least: float) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = shared.value
        for batch in sliced(batches, 4 << 20):
            texts = [(text or "").encode() for text in batch["text"].to_pylist()]
            yield batch.filter(pa.array(net.scores(features(texts, table)) >= least))

    return docs.mapInArrow(keep, docs.schema)
