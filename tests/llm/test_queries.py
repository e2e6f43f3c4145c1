"""The registered queries over the whole test tables, and the pipeline on odd ones."""

import math
import random
from zlib import crc32

import duckdb
import pytest

import corpus_pipeline
from flightloom.llm import queries
from tests.llm.test_operators import ODD, documents, labelled, shingle_set
from tests.test_oracle import normal

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        con.execute(f"create view {name_} as select * from '{FOLDER}/{name_}.parquet'")
    ours = queries.queries()[name](spark, FOLDER).toPandas()
    assert normal(ours) == normal(con.execute(queries.oracle_sql()[name]).df())


def test_names_are_as_agreed():
    names = [n for n in queries.queries() if n[:2] == "op"]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]


def held(doc_id, divisor, rest):
    return crc32(str(doc_id).encode()) % divisor == rest


def test_classifiers_and_model_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    quality = {r.doc_id: r for r in queries.op7_quality_classifier(spark, FOLDER).collect()}
    rows = [r for r in labels if held(r.doc_id, 3, 1)]
    assert all(quality[r.doc_id].held_out for r in rows)
    assert sum(quality[r.doc_id].predicted == r.quality for r in rows) > 0.95 * len(rows)
    toxic = {r.doc_id: r for r in queries.op9_toxicity(spark, FOLDER).collect()}
    rows = [r for r in labels if held(r.doc_id, 5, 0)]
    assert sum(toxic[r.doc_id].predicted == r.toxic for r in rows) > 0.9 * len(rows)
    scored = queries.op2_class_lm(spark, FOLDER).collect()
    assert len({r.train_tokens for r in scored}) == 1
    out = [r for r in scored if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_edited_texts_are_nearer_than_next_ones(spark):
    rows = queries.op3_simhash(spark, FOLDER).collect()
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_pipeline_stages(spark, path):
    """On odd rows: columns stay, each stage keeps part of what it gets, all of it is packed."""
    texts, labels = labelled(spark, 120)
    rng = random.Random(1)
    docs = documents(spark, [*ODD, *texts, *[rng.choice(texts) for _ in range(5)]])
    docs.write.parquet(path("t") + "/documents.parquet")
    labels.write.parquet(path("t") + "/labels.parquet")
    current = spark.read.parquet(path("t") + "/documents.parquet")
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, current, path("t"))
        assert out.columns == docs.columns, name
        out.write.parquet(path(name))
        before, current = current, spark.read.parquet(path(name))
        ids = [r.doc_id for r in current.collect()]
        assert len(set(ids)) == len(ids) and 0 < len(ids) <= before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, current, path("t")).collect()
    assert {r.doc_id for r in packed} == set(ids)
    assert len({r.sequence_id for r in packed}) >= math.ceil(sum(r.length for r in packed) / 1024)
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, path("t")).count() == 0


def test_pipeline_drops_near_copies_of_four_fifths(spark):
    """Pairs on both sides of 0.80 and between it and 0.85, against brute force."""
    rng = random.Random(9)
    texts = []
    for at in range(40):
        words = [f"p{at}x{k}" for k in range(200)]
        # Each change far from the others takes five shingles of 196 away.
        changed = words.copy()
        for k in rng.sample(range(4, 196, 6), 2 + at % 8):
            changed[k] = f"q{at}x{k}"
        texts += [" ".join(words), " ".join(changed)]
    sets = [shingle_set(t) for t in texts]
    likeness = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert sum(0.8 <= x < 0.85 for x in likeness) >= 5 and min(likeness) < 0.8
    docs = documents(spark, texts)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, FOLDER)
    expected = {2 * i for i in range(40)} | {2 * i + 1 for i in range(40) if likeness[i] < 0.8}
    assert {r.doc_id for r in kept.collect()} == expected


def test_pipeline_keeps_one_of_repeated_rows(spark):
    """Rows ingested twice, NULL ids, and several texts under one id."""
    near, other, alone = ([f"{x}{k}" for k in range(100)] for x in "nox")
    edited = " ".join([*near[:-1], "changed"])
    near, other, alone = map(" ".join, (near, other, alone))
    rows = [(3, near), (3, near), (3, near), (9, edited), (9, other), (None, other), (None, near),
            (None, alone), (None, alone), (None, None), (None, None), (7, ""), (7, "")]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = corpus_pipeline.near_dedup_stage(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([(3, near), (9, other), (None, alone), (None, None), (7, "")], key=repr)


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 1024
