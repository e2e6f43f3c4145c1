"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive class; all other text is unlabelled, and holds
toxic documents with the class prior. The risk of the negative class is what unlabelled text
gives, less the positives' share of it, and is not let below zero, so that the classifier
can't gain by fitting unlabelled text further. Several numpy classifiers, started apart, are
averaged.

A word's features are itself and its first letters, hashed. The classifier is linear in how
many distinct words of a text have a feature, so a word adds a fixed amount that is found
once. It is fitted on at most ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` documents and uses the
``FEATURES`` features that part the two best; whole texts of all documents are scored.

Only the text is an input of a score. Edge cases: a NULL text is an empty one and has the
score of a text without any feature. Rows are scored one by one. Without a positive label all
scores are 0; without unlabelled text, the share of confirmed ones. Repeated labels count once;
the different texts of an id count as rows, equal ones once.
"""

from __future__ import annotations

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

MOST_POSITIVE, MOST_UNLABELLED = 4_000, 8_000
FEATURES = 1_500
# Standard errors between a feature's shares in the two samples; less may be chance.
LEAST_GAP = 4.0
STEMS = (4, 5, 6)
CLASSIFIERS = 3
_MARKS = b".,;:!?\"'()[]{}<>#*$%&|-_/\\+=~^@`"


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashes of the word without marks around it, and of its first letters."""
    word = word.strip(_MARKS)
    stems = {word, *(b"%d:" % n + word[:n] for n in STEMS if len(word) > n)}
    return tuple(sorted({crc32(s) for s in stems})) if word else ()


def distinct_words(text: bytes) -> set[bytes]:
    return set(text.lower().split())


@dataclass
class Classifier:
    """``weights`` by feature hash; ``bias`` and weights are means over the classifiers."""

    weights: dict[int, float]
    bias: float

    def word(self, word: bytes) -> float:
        return sum(self.weights.get(f, 0.0) for f in word_features(word))


def nn_pu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the sigmoid loss."""
    rng = np.random.default_rng(seed)
    width = positive.shape[1]
    theta = np.r_[rng.normal(0, 0.01, width), -1.0]
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    batches = max(1, len(unlabelled) // 256)
    step, epochs = 0, max(20, min(200, 3000 // batches))
    for _ in range(epochs):
        of_p = np.array_split(rng.permutation(len(positive)), batches)
        of_u = np.array_split(rng.permutation(len(unlabelled)), batches)
        for p, u in zip(of_p, of_u):
            if not len(p):
                p = rng.integers(0, len(positive), 16)
            xp, xu = positive[p].astype(np.float64), unlabelled[u].astype(np.float64)
            # loss(z, y) = sigmoid(-y z); its slope in z is -y s (1 - s).
            sp = 1 / (1 + np.exp(-np.clip(xp @ theta[:-1] + theta[-1], -30, 30)))
            su = 1 / (1 + np.exp(-np.clip(xu @ theta[:-1] + theta[-1], -30, 30)))
            negative = su.mean() - prior * sp.mean()
            gp, gu = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
            if negative >= 0:
                # prior * positives called negative, plus the negative risk.
                at_p, at_u = -2 * prior * gp, gu
            else:
                # Undo what was fitted beyond zero.
                at_p, at_u = prior * gp, -gu
            grad = np.r_[at_p @ xp + at_u @ xu, at_p.sum() + at_u.sum()]
            grad[:-1] += 1e-5 * theta[:-1]
            step += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            theta -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


_FEATURE_ROWS = pa.schema(
    [("positive", pa.int32()), ("features", pa.list_(pa.int64()))]
)
_SAMPLE_ROWS = pa.schema([*[(c, pa.int64()) for c in SAMPLED], *_FEATURE_ROWS])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = WordCache(word_features, most=16 << 20)
    for batch in sliced(batches, 4 << 20):
        rows = [[f for w in distinct_words(t) for f in found[w]] for t in batch["text"].to_pylist()]
        same = {c: batch[c] for c in (*SAMPLED, "positive")}
        yield columns_out(_SAMPLE_ROWS, same | {"features": rows})


def sample(docs: DataFrame, confirmed: DataFrame, most: tuple[int, int]) -> DataFrame:
    """Features of confirmed and of unlabelled documents, chosen by a hash of the id."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null")
    # Confirmed ones stay among the unlabelled: the prior is that of all text.
    drawn = []
    for source, flag, n in ((confirmed, 1, most[0]), (ids, 0, most[1])):
        chosen = hash_sample(source.select("doc_id").distinct(), n)
        texts = text_sample(docs, chosen, n).withColumn("positive", F.lit(flag))
        drawn.append(texts.select(*SAMPLED, "positive", "text"))
    fields = "doc_id bigint, _hash bigint, positive int, features array<bigint>"
    rows = drawn[0].union(drawn[1]).mapInArrow(_describe, fields)
    rows = rows.dropDuplicates([*SAMPLED, "positive"]).select("positive", "features")
    return written(rows, "toxicity-sample")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    most: tuple[int, int] = (MOST_POSITIVE, MOST_UNLABELLED),
) -> Classifier:
    """Learns from the ``labels`` given; unlabelled text is drawn from ``docs``."""
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    prior = known.agg(F.avg("label")).first()[0]
    if not prior:
        return Classifier({}, -np.inf)
    rows = sample(docs, known.filter("label = 1"), most)
    n = {r["positive"]: r["count"] for r in rows.groupBy("positive").count().collect()}
    if not n.get(0) or not n.get(1):
        prior = float(np.clip(prior, 1e-6, 1 - 1e-6))
        return Classifier({}, float(np.log(prior / (1 - prior))))

    # Documents with each feature in the two samples, and how far apart the shares are.
    once = rows.select("positive", F.explode(F.array_distinct("features")).alias("feature"))
    of = once.groupBy("feature").agg(
        F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u")
    )
    p, u = F.col("p") / n[1], F.col("u") / n[0]
    share = (F.col("p") + F.col("u")) / (n[0] + n[1])
    error = F.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
    best = (
        of.filter(F.col("p") + F.col("u") >= 3)
        .select("feature", (F.abs(p - u) / error).alias("gap"))
        .filter(F.col("gap") >= LEAST_GAP)
        .orderBy(F.col("gap").desc(), "feature")
        .limit(FEATURES)
        .collect()
    )
    column = {int(row["feature"]): i for i, row in enumerate(best)}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [[column[f] for f in row if f in column] for row in batch["features"].to_pylist()]
            yield columns_out(_FEATURE_ROWS, {"positive": batch["positive"], "features": kept})

    # At most sum(most) rows of the few features chosen.
    found = rows.mapInArrow(chosen, "positive int, features array<bigint>").toArrow()
    x = np.zeros((found.num_rows, max(1, len(column))), np.uint8)
    for i, row in enumerate(found["features"].to_pylist()):
        np.add.at(x[i], row, 1)
    is_positive = found["positive"].to_numpy() == 1
    # An order that does not hang on how the rows were dealt out.
    order = np.lexsort(x[:, : min(64, x.shape[1])].T)
    x, is_positive = x[order], is_positive[order]
    fits = [nn_pu(x[is_positive], x[~is_positive], prior, seed) for seed in range(CLASSIFIERS)]
    theta = np.mean([w for w, _ in fits], axis=0)
    weights = {f: float(theta[i]) for f, i in column.items()}
    return Classifier(weights, float(np.mean([b for _, b in fits])))


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id`` and the score of every whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adds = WordCache(shared.value.word)
        bias = shared.value.bias
        for batch in sliced(batches):
            texts = batch["text"].to_pylist()
            # Sorted, so that equal texts have equal sums.
            sums = [sum(sorted(map(adds.__getitem__, distinct_words(t)))) for t in texts]
            z = np.clip(np.array(sums, np.float64) + bias, -700, 700)
            found = np.where(np.isneginf(bias), 0.0, 1 / (1 + np.exp(-z)))
            yield columns_out(_SCORES, {"doc_id": batch["doc_id"], "score": found})

    return id_and_text(docs).mapInArrow(judge, "doc_id bigint, score double")
