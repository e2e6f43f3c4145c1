"""Chat windows, the manifest and vector codes against brute force, with odd rows."""

import hashlib
import math
import random
from collections import defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flightloom.llm import chat_windows, merkle, oracles, queries, vector_codes
from flightloom.llm.packing import token_ids
from tests.llm.test_operators import ODD, documents, sentence
from tests.test_oracle import normal

BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


# --- chat ---------------------------------------------------------------------------

NASTY = [
    "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<\\|", "<\\\\|im_end|>", "<", "<<|", "|>",
    "\\", "", "é🙂<|", "a\n\n", "<|endoftext|>", "<\\\\\\",
]


def conversations():
    """(conv_id, turn, role, text): odd texts and roles, ties, repeated rows, long turns."""
    rng = random.Random(5)
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(NASTY)]
    rows += [(2, None, None, None), (2, 0, "system", "be kind"), (2, 1, "user", None)]
    rows += [(3, 0, "assistant", "same")] * 3 + [(3, 0, "user", "same"), (3, 0, "assistant", "b")]
    rows += [(4, 0, "system", sentence(rng, 400)), (4, 1, "user", "x"), (4, 2, "assistant", "y")]
    rows += [(5, 0, "system", "s"), (5, 1, "user", sentence(rng, 3000)), (5, 2, "assistant", "z")]
    rows += [(6, 0, "we\nird\\n<|im_end|>", "t"), (6, 1, "assistant", "<|im_end|>" * 40)]
    rows += [(None, k, "assistant", f"n{k}") for k in range(3)]
    long = [(7, 0, "system", "the system turn")]
    long += [(7, k, ("assistant", "user")[k % 2], sentence(rng, rng.randrange(60))) for k in range(1, 400)]
    return rows + long


CONV = "conv_id bigint, turn bigint, role string, text string, block int, formatted string, tie int"


def conv_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CONV)


def ordered(rows):
    """Turns per conversation; equal turn numbers by role, then by the text's hash, which the
    caller's rows must not depend on."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        found[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: sorted(turns) for c, turns in found.items()}


@pytest.mark.parametrize("block_bytes", [8 << 20, 3000, 64])
def test_chat_windows(spark, block_bytes):
    """Read back exactly; budgets hold; each assistant turn is a target once."""
    rows = [r for r in conversations() if r[0] != 3 or r[3] == "same"]
    frame = conv_frame(spark, rows).repartition(5)
    options = {"budget": 200, "history": 50, "block_bytes": block_bytes}
    windows = chat_windows.format_conversations(frame, BYTES, **options).collect()
    expected = ordered(rows)
    found = defaultdict(list)
    for w in sorted(windows, key=lambda w: (w.block, w.window)):
        found[w.conv_id].append(w)
    assert set(found) == set(expected)
    for conv_id, ws in found.items():
        turns = expected[conv_id]
        back = [t for w in ws for t in chat_windows.read_window(w.formatted, w.n_repeated)]
        assert back == [(role, text) for *_, role, text in turns]
        loss = [
            chat_windows.unescape(w.formatted[a : a + n])
            for w in ws
            for a, n in zip(w.loss_starts, w.loss_lengths)
        ]
        assert loss == [text for *_, role, text in turns if role == "assistant"]
        system = turns[0][2] == "system" and len(token_ids(turns[0][3], BYTES)) <= 40
        for at, w in enumerate(ws):
            whole = chat_windows.read_window(w.formatted, 0)
            assert len(whole) == w.n_repeated + w.n_new and w.n_new > 0
            sizes = [
                len(token_ids(chat_windows.escape(t), BYTES)) - 1
                + len(token_ids(chat_windows.escape_role(r), BYTES)) - 1 + 4
                for r, t in whole
            ]
            assert w.n_tokens == sum(sizes)
            assert w.n_tokens <= 200 or w.n_new == 1
            if at and system:
                assert whole[0] == tuple(turns[0][2:]) and w.n_repeated
            history = sizes[1 if system else 0 : w.n_repeated] if at else []
            assert sum(history) <= 50
    assert sum(w.n_repeated > 1 for w in found[7]) > 10
    assert block_bytes > 3000 or max(w.block for w in found[7]) > 3


def test_chat_ties_and_repeated_rows_are_turns(spark):
    rows = [r for r in conversations() if r[0] == 3]
    (w,) = chat_windows.format_conversations(conv_frame(spark, rows), BYTES).collect()
    back = chat_windows.read_window(w.formatted, 0)
    assert sorted(back) == sorted((r, t) for *_, r, t in rows) and len(w.loss_starts) == 4


def test_chat_greedy_spans_fill_their_budget():
    rng = random.Random(3)
    sizes = [rng.randrange(5, 60) for _ in range(300)]
    last = 0
    for low, at, end in chat_windows.spans(sizes, 0, 1, sizes[0], True, 150, 40):
        assert at == last and low <= at < end and (low >= 1 or at == 0)
        fixed = sizes[0] if at else 0
        assert fixed + sum(sizes[low:end]) <= 150
        assert end == 300 or fixed + sum(sizes[low : end + 1]) > 150
        last = end
    assert last == 300


def test_chat_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\n\nim_end>é") for _ in range(rng.randrange(12)))
        assert chat_windows.unescape(chat_windows.escape(text)) == text
        assert "<|" not in chat_windows.escape(text)
        role = chat_windows.escape_role(text)
        assert chat_windows.unescape_role(role) == text and "\n" not in role


@pytest.mark.parametrize("whole_table", [True, False])
def test_chat_query(spark, path, whole_table):
    rows = ordered([])
    folder = "/root/testdata/sf0.01"
    if not whole_table:
        folder = path("t")
        odd = [r for r in conversations() if r[0] != 3 and r[0] is not None]
        conv_frame(spark, odd).write.parquet(f"{folder}/conversations.parquet")
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    both = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", both), (-1, 1, "assistant", both)]
    expected = {}
    for conv_id, turns in ordered(rows).items():
        targets = "".join(t for *_, r, t in turns if r == "assistant")
        lines = [f"{r}\n{t}\n" for *_, r, t in turns]
        expected[conv_id] = (len(turns), sha(*lines), len(targets), sha(targets))
    found = queries.op11_chat_windows(spark, folder).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected and len(found) == len(expected)
    frame = table.select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(rows[-2:], "conv_id bigint, turn bigint, role string, text string")
    )
    sizes = chat_windows.format_conversations(frame, BYTES).groupBy("conv_id").agg(
        F.sum(F.char_length("formatted")).alias("n")
    )
    assert {r.conv_id: r.n for r in sizes.collect()} == {r.conv_id: r.formatted_chars for r in found}


def test_chat_empty_table(spark):
    windows = chat_windows.format_conversations(conv_frame(spark, []), BYTES)
    assert windows.collect() == [] and chat_windows.read_back(windows).collect() == []


# --- manifest -----------------------------------------------------------------------


def leaf_of(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    out = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return sha(*out)


def tree(digests):
    """(root, proof of each leaf as (left, right) texts)."""
    proofs = [[] for _ in digests]
    owners = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        parents, parent_owners = [], []
        for at in range(0, len(digests), 8):
            run = digests[at : at + 8]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            parents.append(sha(*run))
            parent_owners.append([x for o in owners[at : at + 8] for x in o])
        digests, owners = parents, parent_owners
    return digests[0], proofs


def brute_manifest(rows):
    """Per row (doc_id, leaf): subroot, root, proof. Equal leaves stand next to each other."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row.lang].append((row.doc_id is not None, row.doc_id or 0, leaf_of(row, row.text)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([leaf for *_, leaf in sorted(by_lang[lang])]) for lang in langs}
    root, tops = tree([trees[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        for (has, doc_id, leaf), proof in zip(sorted(by_lang[lang]), trees[lang][1]):
            out.append((doc_id if has else None, leaf, trees[lang][0], root, proof + top))
    return out


def manifest_rows(frame):
    leaves = frame.select("doc_id", "lang", merkle.leaf().alias("leaf"))
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof])
        for r in merkle.manifest(leaves).collect()
    ]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 513, 4700])
def test_manifest(spark, n):
    """One language larger than a block of blocks' share, small ones, and odd rows."""
    rng = random.Random(n)
    rows = [(k, rng.choice([None, "", "é🙂", "AbC"]), rng.choice([None, "s", "ü"]), k % 7 or None)
            for k in range(n)]
    rows = [(i, t, s, c, "en" if rng.random() < 0.9 else rng.choice([None, "", "zz", "ä", "b"]))
            for i, t, s, c in rows]
    rows += [(None, "x", None, 1, "en"), (3, "AbC", "s", 2, "en"), (3, "AbC", "s", 2, "en"),
             (3, None, None, None, None), (-5, "y", "s", 0, "alone")]
    frame = spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, n_chars bigint, lang string"
    ).repartition(7)
    order = repr
    assert sorted(manifest_rows(frame), key=order) == sorted(brute_manifest(frame.collect()), key=order)


def test_manifest_of_many_languages(spark):
    """More languages than a block holds."""
    rows = [(k, f"l{k % 600:03}") for k in range(1300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string").selectExpr(
        "doc_id", "lang", "string(doc_id) as text", "'s' as source", "1L as n_chars"
    )
    assert sorted(manifest_rows(frame)) == sorted(brute_manifest(frame.collect()))


def test_manifest_query_finds_tampering(spark, path):
    docs = documents(spark, ODD).withColumn("_n", F.lit(1)).withColumn("leaf", F.lit("x"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("l"), F.col("doc_id") % 3)))
    docs.write.parquet(path("t") + "/documents.parquet")
    expected = {}
    rows = {r.doc_id: r for r in docs.collect()}
    for doc_id, leaf, subroot, root, proof in brute_manifest(rows.values()):
        row = rows[doc_id]
        digest = leaf
        if crc32(str(doc_id).encode()) % 3 == 0 and row.text is not None:
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row.text)
            digest = leaf_of(row, lower)
        for left, right in proof:
            digest = sha(left, digest, right)
        seen = sha(*[left + right for left, right in proof])
        expected[doc_id] = (doc_id, leaf, subroot, root, seen, digest, digest == root)
    found = queries.op12_merkle_manifest(spark, path("t")).collect()
    assert {r.doc_id: tuple(r) for r in found} == expected and len(found) == len(expected)
    assert {r.verified for r in found} == {True, False}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path('t')}/documents.parquet/*.parquet'")
    ours = queries.op12_merkle_manifest(spark, path("t")).toPandas()
    assert normal(ours) == normal(con.execute(oracles.manifest()).df())


def test_manifest_empty_table(spark):
    assert manifest_rows(documents(spark, [])) == []


# --- vector codes -------------------------------------------------------------------


def brute_codes(rows, rounds=4):
    """(code, error) per row of equal-length vectors, and the codebooks, in plain integers."""
    x = np.array([[math.floor(1024 * v) for v in vector] for _, vector in rows], dtype=object)
    x = x.reshape(len(rows), 4, -1)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, x[k].tolist()))
    books = [[list(x[k, p]) for k in order[:256]] for p in range(4)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), at) for at, e in enumerate(book))

    for left in range(rounds, -1, -1):
        found = [[nearest(v[p], books[p]) for p in range(4)] for v in x]
        if not left:
            break
        for p in range(4):
            for entry in range(len(books[p])):
                own = [x[k, p] for k in range(len(rows)) if found[k][p][1] == entry]
                if own:
                    books[p][entry] = [sum(c) // len(own) for c in zip(*own)]
    codes = ["".join(f"{at:02x}" for _, at in f) for f in found]
    errors = [sum(d for d, _ in f) for f in found]
    flat = ",".join(str(c) for book in books for e in book for c in e)
    return codes, errors, sha(flat)


def vectors_frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], label, b"x", 1)
         for i, v, label in rows],
        "vec_id bigint, embedding array<float>, label int, near binary, error int",
    )


def held_codes(spark, rows):
    coded, model, used = vector_codes.quantise(vectors_frame(spark, rows).repartition(3))
    return vector_codes.with_label_errors(coded).collect(), model, used


@pytest.mark.parametrize("kind", ["clusters", "few", "ties", "wide"])
def test_vector_codes(spark, kind):
    rng = random.Random(kind)
    if kind == "clusters":
        mids = [[rng.gauss(0, 0.3) for _ in range(16)] for _ in range(9)]
        rows = [(k, [np.float32(m + rng.gauss(0, 0.05)) for m in rng.choice(mids)], rng.choice([None, 1, 2]))
                for k in range(900)]
    elif kind == "few":
        rows = [(k, [np.float32(rng.uniform(-1, 1)) for _ in range(8)], 1) for k in range(5)]
    elif kind == "ties":
        rows = [(k, [rng.randrange(-2, 3) / 1024 for _ in range(8)], k % 3) for k in range(700)]
    else:
        rows = [(k, [np.float32(rng.uniform(-9e4, 9e4)) for _ in range(8)], None) for k in range(300)]
    rows += [(rows[3][0], rows[3][1], 2), (None, rows[1][1], None)]
    codes, errors, books = brute_codes([(i, v) for i, v, _ in rows])
    found, model, used = held_codes(spark, rows)
    assert model.digest() == books and len(used) == 4
    key = repr
    label_sums = defaultdict(int)
    for (_, _, label), error in zip(rows, errors):
        label_sums[label] += error
    expected = [(i, label, c, e, label_sums[label]) for (i, _, label), c, e in zip(rows, codes, errors)]
    ours = [(r.vec_id, r.label, r.code, r.error, r.label_error) for r in found]
    assert sorted(ours, key=key) == sorted(expected, key=key)


def test_vector_codes_odd_rows(spark):
    """Dropped vectors, those without a code, empty ones, and an empty table."""
    good = [(k, [k / 7, -k / 9, 0.5, k / 3], 1) for k in range(10)]
    nan, inf = float("nan"), float("inf")
    bad = [(20, None, 1), (21, [nan, 0, 0, 0], 1), (22, [0, -inf, 0, 0], 1), (23, [None, 0, 0, 0], 1)]
    uncoded = [(30, [1.0, 2.0], 1), (31, [3e30, 0, 0, 0], 1), (32, [], 5)]
    found, model, _ = held_codes(spark, good + bad + uncoded)
    codes, errors, books = brute_codes([(i, v) for i, v, _ in good])
    assert model.digest() == books
    ours = {r.vec_id: (r.code, r.error, r.label_error) for r in found}
    expected = {i: (c, e, sum(errors)) for (i, *_), c, e in zip(good, codes, errors)}
    expected |= {30: (None, None, sum(errors)), 31: (None, None, sum(errors)), 32: (None, None, None)}
    assert ours == expected
    assert held_codes(spark, [])[0] == [] and held_codes(spark, bad)[0] == []
    (empty,) = held_codes(spark, [(1, [], 4)])[0]
    assert (empty.code, empty.error, empty.label_error) == ("00000000", 0, 0)


@pytest.mark.parametrize("bounds", [2, 5, 32])
def test_bounds_never_change_an_assignment(bounds):
    """Moving codebooks, lists of any length: the same as comparing everything."""
    rng = np.random.default_rng(bounds)
    x = rng.integers(-40, 40, (500, 3))
    book = x[:64].copy()
    near, low, least = vector_codes.search_all(x, book, bounds)
    size, settled = bounds, 0
    for step in range(12):
        after = book + rng.integers(-6 + step // 2, 7 - step // 2, book.shape)
        model = vector_codes.Model([after], [vector_codes._moved(book, after)])
        near, low, least, need = vector_codes.search_near(x, model, 0, near, low)
        exact = vector_codes.distances(x, after)
        assert (near[:, 0] == exact.argmin(1)).all() and (least == exact.min(1)).all()
        # Every entry but the own one is no nearer than its bound, or the outer one.
        held = np.repeat(low[:, -1:], 64, axis=1)
        rows = np.repeat(np.arange(500)[:, None], near.shape[1], axis=1)
        held[rows, near] = np.inf
        np.minimum.at(held, (rows[:, 1:], near[:, 1:]), low[:, :-1])
        held[np.arange(500), near[:, 0]] = 0
        assert (held <= np.sqrt(exact) + 1e-6).all()
        settled += int((need == 0).sum())
        size = vector_codes.adapted(dict(enumerate(np.bincount(need))), size)
        near, low = vector_codes.resized(near, low, size)
        book = after
    assert settled > 100


def test_bounds_adapt():
    assert vector_codes.adapted({0: 1000}, 8) == vector_codes.LEAST_BOUNDS
    assert vector_codes.adapted({0: 500, 8: 500}, 8) == 16
    assert vector_codes.adapted({0: 90, 3: 10}, 8) == 4
