"""Operators against brute force on small tables, with odd rows in them."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flightloom.llm import (
    class_lm,
    line_dedup,
    minhash_dedup,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    sentencepiece_bpe,
    simhash,
    toxicity,
    url_filter,
)
from flightloom.llm.components import connected_components
from flightloom.llm.texts import (
    SAMPLED,
    WordCache,
    id_and_text,
    remainder,
    text_sample,
    window_hashes,
    word_hashes,
    written,
)
from tests.test_oracle import normal

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Extra columns bear names that the operators use themselves.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double,"
    " doc bigint, bitmap string, n_words int, bits int, row int, node int, _dropped int"
)


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [
        (i, t, None, "s", None if t is None else len(t), 1.5, 7, "b", 1, 2, 3, 4, 5)
        for i, t in zip(ids, texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, n, of=400):
    return " ".join(f"w{rng.randrange(of)}" for _ in range(n))


def corpus():
    """Copies, near copies, shared lines, empty, NULL and long texts; some in upper case."""
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "one", "Two words", "ÄÖ é 你好 🙂\x00", "a" * 3000]
    line = "A line that many documents share, here."
    for i in range(30):
        texts.append(sentence(rng, 20 + i) + "\n" + line + " \n" + sentence(rng, 10))
    base = [f"u{k}" for k in range(120)]
    for i in range(25):  # a chain of near copies
        base = base.copy()
        base[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(base))
    texts += [texts[10]] * 6 + [texts[12].upper()] + [sentence(rng, 9000)]
    return texts


ODD = corpus()


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD)


# --- near duplicates ---------------------------------------------------------------


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


# The second run has crowded nodes only and tiny blocks.
@pytest.mark.parametrize("levels, node, block", [(6, 256, 512), (2, 2, 4)])
def test_near_duplicates_match_brute_force(spark, odd, monkeypatch, levels, node, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    found = minhash_dedup.near_duplicates(odd, levels=levels, node_size=node).collect()
    component, size = brute_components(ODD)
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(component))
    assert {r.doc_id: r.n_shingles for r in found} == dict(enumerate(size))
    assert all(r.kept == (r.component_id == r.doc_id) for r in found)


def test_near_duplicates_of_null_ids_and_shared_ids(spark):
    text = "one two three four five six seven"
    docs = documents(spark, [text, text, text, "else", None], [None, None, 5, 5, 5])
    found = minhash_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.n_shingles) for r in found) == [
        (-1, -1, 3), (-1, -1, 3), (5, 5, 0), (5, 5, 1), (5, 5, 3)
    ]
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_intersections_are_exact():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 1, 50, 6000, 3000)]
    found = minhash_dedup.intersections(sets)
    for a in range(5):
        for b in range(5):
            assert found[a, b] == len(np.intersect1d(sets[a], sets[b]))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in found} == {
        **{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}
    }
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- lines -------------------------------------------------------------------------


def brute_lines(rows):
    docs_of, keeper = defaultdict(set), {}
    keyed = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
        keys = ["".join(c.lower() if c.isascii() else c for c in k) for k in keys]
        keyed.append((doc, lines, keys))
        for k in keys:
            docs_of[k].add(doc)
    for k, docs in docs_of.items():
        if len(k) >= 20 and len(docs) >= 3:
            keeper[k] = max(docs)
    return [
        (doc, "\n".join(x for x, k in zip(lines, keys) if keeper.get(k, doc) == doc))
        for doc, lines, keys in keyed
    ]


@pytest.mark.parametrize("partitions", ["1", "40"])
def test_lines_match_brute_force(spark, odd, partitions):
    """With many range partitions the run of the shared line is cut several times."""
    shared = "THIS line has more than twenty signs\x0b"
    texts = [*ODD, *[f"{shared}\n{shared.lower()}\nown {i}" for i in range(300)]]
    docs = documents(spark, texts)
    settings = {"spark.sql.shuffle.partitions": partitions,
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: r.text or "" for r in out} == dict(brute_lines(list(enumerate(texts))))


def test_lines_of_repeated_rows_and_null_ids(spark):
    line = "a line of more than twenty signs"
    docs = documents(spark, [line, line, line, f"{line}\nx", f"{line}\ny"], [None, 1, 1, 2, 2])
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [
        (0, ""), (1, ""), (1, ""), (2, f"{line}\nx"), (2, f"{line}\ny")
    ]
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert line_dedup.keep_bitmaps(docs.limit(0)).count() == 0


def test_bitmaps_round_trip():
    for n in (1, 8, 9, 1000):
        gone = list(range(0, n, 3))
        keep = line_dedup.unpack_bitmap(line_dedup.pack_bitmap(gone, n), n)
        assert np.flatnonzero(~keep).tolist() == gone


# --- rules -------------------------------------------------------------------------


def brute_repeats(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    return len({k for i, w in enumerate(windows) if n[w] > 1 for k in range(i, i + 8)})


def test_rules_ledger(spark, odd):
    rng = random.Random(2)
    texts = [*ODD, *[sentence(rng, 60, of=3) for _ in range(20)], "x " * 200]
    found = {r.doc_id: r for r in quality_rules.ledger(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        assert found[i].n_words == len(words)
        assert found[i].word_chars == sum(len(w.decode()) for w in words)
        assert found[i].n_repeat_words == brute_repeats(words)
    assert quality_rules.ledger(odd.limit(0)).count() == 0


def test_policies_and_ablation_use_the_bits(spark, odd):
    ledger = quality_rules.ledger(odd)
    rows = quality_rules.apply_policy(ledger, "v2").collect()
    assert all(r.kept == (r.rule_bits == 0) for r in rows)
    report = {r.rule: r for r in quality_rules.ablation(ledger, "v2").collect()}
    for bit, rule in enumerate(quality_rules.RULES):
        assert report[rule].n_failed == sum(r.rule_bits >> bit & 1 for r in rows)
        assert report[rule].n_only == sum(r.rule_bits == 1 << bit for r in rows)
    kept = quality_rules.keep_documents(odd, "v2")
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_rules_keep_a_long_clean_text(spark):
    """200,000 words as natural text has them: new words get rarer; and junk of that length."""
    rng = np.random.default_rng(7)
    ranks = np.minimum(rng.zipf(1.25, 200_000), 30_000)
    clean = [f"word{r}" for r in ranks]
    assert len(set(clean)) < 0.2 * len(clean)
    junk = [f"w{k}" for k in rng.integers(0, 150, 200_000)]
    docs = documents(spark, [" ".join(clean), " ".join(junk), " ".join(clean[:900])])
    policy = queries.RULES_POLICY
    rows = quality_rules.apply_policy(quality_rules.ledger(docs), policy).collect()
    assert {r.doc_id: r.kept for r in rows} == {0: True, 1: False, 2: True}
    kept = quality_rules.keep_documents(docs, corpus_pipeline.POLICY)
    assert {r.doc_id for r in kept.collect()} == {0, 2}
    by_id = {r.doc_id: r for r in rows}
    for i, words in enumerate((clean, junk, clean[:900])):
        parts = [words[at : at + 1000] for at in range(0, len(words), 1000)]
        assert by_id[i].n_window_distinct == sum(len(set(p)) for p in parts)


# --- tokens ------------------------------------------------------------------------


def test_sentencepiece_equals_the_library(spark, odd):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table = sentencepiece_bpe.prefix_table(PIECES)
    rng = random.Random(1)
    pieces = [p for p in table.ids][:4000]
    odds = ["▁a", "  a  b ", "\n\n", "a\u3000b\r\n", "<s>", "<0x41>", "Ⅷ" * 50, " " * 99]
    odds += ["".join(rng.choice(pieces) for _ in range(6)).replace("▁", " ") for _ in range(500)]
    odds += ["".join(rng.choice("ab ▁\n\té🙂#1") for _ in range(12)) for _ in range(500)]
    for text in [*(t or "" for t in ODD), *odds]:
        ids = model.encode(text, add_bos=True, add_eos=True)
        found = table.encode(text)
        assert np.frombuffer(found, "<u4").tolist() == ids, text
        assert table.decode(found) == model.decode(ids)
    out = {r.doc_id: r for r in sentencepiece_bpe.digests(odd, PIECES).collect()}
    for i, text in enumerate(ODD):
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        assert out[i].n_tokens == len(ids)
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    both = sentencepiece_bpe.decode(sentencepiece_bpe.encode(odd, PIECES), PIECES)
    assert {r.decoded for r in both.collect()} >= {"one", "Two words"}


def test_ids_of_texts_that_spell_out_special_tokens():
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    odds = [end, f"a {end} b", f"{end}{end}", f"  {end}\n\n {end} ", "<|endoftext", f"é{end}'s 🙂"]
    rng = random.Random(2)
    odds += ["".join(rng.choice([end, " ", "ab", "'s", "\n", "12", "é", "<|"]) for _ in range(9))
             for _ in range(300)]
    for text in odds:
        ids = tokens.encode(text, add_special_tokens=False).ids + [2]
        assert list(packing.token_ids(text, BYTES)) == ids, text


def test_ids_of_texts_with_very_long_runs():
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    blanks, rng = " \n\t\r\x0b\x0c\x85\xa0\u2003\u3000", random.Random(5)
    odds = ["".join(rng.choice([" ", " ", *blanks, "ab", "'s", "1", "é", "<|endoftext|>", "\x1c"])
                    for _ in range(40)) for _ in range(400)]
    for text in [*odds, "  ", "x   ", "   <|endoftext|>   y"]:
        ids = tokens.encode(text, add_special_tokens=False).ids + [2]
        assert list(packing.token_ids(text, BYTES, long=2)) == ids, text
    many = 1_500_000
    for text in (" " * many + "a", "b" + "\n" * many, "a" * many, "é" * many, "1" * many, "#" * many):
        ids = tokens.encode(text, add_special_tokens=False).ids + [2]
        assert list(packing.token_ids(text, BYTES)) == ids, text[:9]


def test_packing_places_every_piece_once(spark, odd):
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack_documents(odd, BYTES).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(ODD):
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.piece):
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32) == (at, crc32(part))
            assert r.length == 1024 or r.piece == 0
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        end = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 1024
    assert len(by_sequence) == math.ceil(sum(r.length for r in rows) / 1024)
    assert packing.pack_documents(odd.limit(0), BYTES).count() == 0


def test_bins_are_the_fullest_there_are():
    rng = random.Random(3)
    for _ in range(200):
        counts = Counter(rng.randrange(1, 31) for _ in range(rng.randrange(1, 12)))
        chosen = packing.fullest(dict(counts), 30)
        assert not Counter(chosen) - counts and max(counts) in chosen
        sums = {0}
        for length in (Counter(counts) - Counter([max(counts)])).elements():
            sums |= {s + length for s in sums}
        assert sum(chosen) == max(counts) + max(s for s in sums if s + max(counts) <= 30)
        used = Counter()
        for bin_, times in packing.plan(dict(counts), 30):
            assert sum(bin_) <= 30
            for length in bin_:
                used[length] += times
        assert used == counts


# --- SimHash -----------------------------------------------------------------------


def brute_bits(spark, text):
    words = (text or "").encode().split()
    words = (text or "").strip(" \t\n\x0b\x0c\r").lower().replace("\n", " ").split(" ")
    words = [w for w in words if w]
    size = min(5, len(words))
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] if words else []
    if not runs:
        return 0
    frame = spark.createDataFrame([(r,) for r in runs], "w array<string>")
    got = frame.select(F.xxhash64(*[F.get("w", k) for k in range(5)]).alias("h")).collect()
    bits = 0
    for bit in range(64):
        votes = sum(1 if r.h >> bit & 1 else -1 for r in got)
        bits |= (votes > 0) << bit
    return bits


def test_simhash_of_texts_and_edited_texts(spark):
    texts = [ODD[i] for i in (0, 1, 3, 4, 10, 20, 40, 41)]
    ids = [30, 20, 50, 100, 200, 250, 300, 400]
    rows = simhash.fingerprint_documents(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    by_id = {r.doc_id: r for r in rows}
    for at, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        lent = len(text) // 4
        edited = text[: len(text) - lent] + after[:lent]
        r = by_id[ids[i]]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = brute_bits(spark, text), brute_bits(spark, edited)
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (own, other)
        assert r.near_edited == 1 - (own ^ other).bit_count() / 64
        assert r.near_next == 1 - (own ^ brute_bits(spark, after)).bit_count() / 64


def test_simhash_of_repeated_rows_null_ids_and_one_document(spark):
    docs = documents(spark, ["a b", "a b", "c", None], [1, 1, None, None])
    rows = simhash.fingerprint_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == [(0, 0), (0, 1), (1, 3), (1, 3)]
    one = simhash.fingerprint_documents(documents(spark, ["a b c"], [50])).collect()
    assert (one[0].near_next, one[0].n_near) == (1.0, 1)
    assert simhash.fingerprint_documents(docs.limit(0)).count() == 0


def test_block_tables_find_all_near_fingerprints(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):
        x = rng.choice(values)
        for bit in rng.sample(range(64), rng.randrange(0, 6)):
            x ^= 1 << bit
        values.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in values]
    frame = spark.createDataFrame([(x,) for x in signed], "bits bigint")
    for radius, blocks in ((3, 6), (2, 3), (0, 1)):
        found = {(r.query, r.found) for r in simhash.near(frame, frame, radius, blocks).collect()}
        mask = (1 << 64) - 1
        assert found == {
            (a, b) for a in signed for b in signed if ((a ^ b) & mask).bit_count() <= radius
        }


def test_block_tables_carry_the_radius_of_wide_fingerprints(spark):
    rng = random.Random(10)
    values = [rng.getrandbits(128) for _ in range(60)]
    for _ in range(200):
        x = rng.choice(values[:60])
        for bit in rng.sample(range(128), rng.randrange(15, 30)):
            x ^= 1 << bit
        values.append(x)
    mask = (1 << 64) - 1
    signed = [[y - (1 << 64) if y >> 63 else y for y in (x & mask, x >> 64)] for x in values]
    frame = spark.createDataFrame(
        [(*x, i) for i, x in enumerate(signed)], "own bigint, more bigint, node bigint"
    )
    pairs = simhash.near(frame, frame, words=("own", "more"), name="node").collect()
    assert {(r.query, r.found) for r in pairs} == {
        (i, j) for i, a in enumerate(values) for j, b in enumerate(values)
        if (a ^ b).bit_count() <= simhash.RADIUS
    }


@pytest.mark.parametrize("spread", [6, 16, 30])
def test_near_copies_are_counted_by_clusters(spark, spread, monkeypatch):
    """Counts and components equal those of all pairs, which a crowd of near copies isn't made."""
    rng = random.Random(spread)
    centres = [rng.getrandbits(128) for _ in range(3)]
    values = {rng.getrandbits(128) for _ in range(100)} | set(centres)
    while len(values) < 900:
        x = rng.choice(centres)
        for bit in rng.sample(range(128), rng.randrange(1, spread)):
            x ^= 1 << bit
        values.add(x)
    mask = (1 << 64) - 1
    rows, values = [], sorted(values)
    for at, x in enumerate(values):
        bits = [y - (1 << 64) if y >> 63 else y for y in (x & mask, x >> 64)]
        rows.append((at, *bits, rng.randrange(1, 4), rng.random() < 0.1))
    fields = "node bigint, own bigint, more bigint, of bigint, asks boolean"
    index = written(spark.createDataFrame(rows, fields), "index")
    made = []
    monkeypatch.setattr(simhash, "written", lambda f, n: made.append((n, w := written(f, n))) or w)
    counts, links = simhash.near_groups(index)
    near = {
        a: [b for b, y in enumerate(values) if (values[a] ^ y).bit_count() <= simhash.RADIUS]
        for a, r in enumerate(rows) if r[4]
    }
    assert {r.node: r.n_near for r in counts.collect()} == {
        a: sum(rows[b][3] for b in found) for a, found in near.items()
    }

    def classes(pairs):
        top = {}

        def head(x):
            while top.setdefault(x, x) != x:
                x = top[x]
            return x

        for a, b in pairs:
            a, b = sorted((head(a), head(b)))
            top[b] = a
        return {x: head(x) for x in list(top)}

    pairs = [(a, b) for a, found in near.items() for b in found]
    assert classes((r.a, r.b) for r in links.collect()) == classes(pairs)
    if spread == 6:
        assert len(pairs) > 15_000
        assert sum(w.count() for n, w in made if n in ("met-clusters", "compared")) < 2_000
        assert links.count() < 3_000


def test_a_wide_group_of_near_copies_is_not_all_its_pairs(spark, monkeypatch):
    """Too wide for clusters: rows grow with the queries and blocks, not with the group's pairs."""
    rng = np.random.default_rng(12)
    met, pairs = [], []
    for size in (1000, 4000):
        bits = rng.random((size, 128)) < 0.1
        near = (bits[:60, None] ^ bits[None]).sum(axis=2) <= simhash.RADIUS
        words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
        of = rng.integers(1, 4, size)
        rows = [(at, *map(int, w), int(of[at]), at < 60) for at, w in enumerate(words)]
        fields = "node bigint, own bigint, more bigint, of bigint, asks boolean"
        index = written(spark.createDataFrame(rows, fields), "index")
        made = []
        monkeypatch.setattr(
            simhash, "written", lambda f, n: made.append((n, w := written(f, n))) or w
        )
        counts, links = simhash.near_groups(index)
        assert {r.node: r.n_near for r in counts.collect()} == dict(enumerate((near @ of).tolist()))
        linked = connected_components(links).collect()
        assert {r.id for r in linked} == set(np.flatnonzero(near.any(axis=0)).tolist()) - {0}
        assert {r.component for r in linked} == {0}
        met.append(sum(w.count() for n, w in made if n.startswith(("met-", "compared"))))
        pairs.append(int(near.sum()))
        assert links.count() < met[-1] + 8 * size
    assert pairs[1] > 3.5 * pairs[0]
    assert met[1] < pairs[1] / 4
    assert met[1] < 2.5 * met[0]


def test_near_dedup_shuffles_no_texts_for_rows_without_words(spark, monkeypatch):
    """NULL, empty and blank texts are found by themselves, not by a join of all texts."""
    texts = ["a b c d e f", "a b c d e f", None, "", " \t\n\x0b\x0c\r", " \t\n\x0b\x0c\r", "\x1f", "x"]
    ids = [1, 2, 3, 3, 4, 4, 5, None]
    made = {}

    def kept(frame, name, *rows):
        made[name] = frame
        return written(frame, name, *rows)

    monkeypatch.setattr(minhash_dedup, "written", kept)
    left = minhash_dedup.keep_one_each(documents(spark, texts, ids), 80)
    want = [(1, texts[0]), (4, texts[4]), (5, "\x1f"), (None, "x")]
    assert sorted(((r.doc_id, r.text) for r in left.collect() if r.doc_id != 3), key=str) == sorted(
        want, key=str
    )
    assert left.filter("doc_id = 3").count() == 1
    plan = made["near-gone"]._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "text#" in line]
    assert scans and all("rows-without-words" in line for line in scans)


def test_small_tables_are_not_written_in_as_many_files_as_partitions(spark):
    spread = spark.range(2000).repartition(40)
    assert len(written(spread, "small", 2000).inputFiles()) == 1
    assert len(written(spread, "unknown").inputFiles()) == 40
    assert written(spread, "larger", 30_000).count() == 2000
    pairs = [(k, k + 1) for k in range(300)]
    links = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert links.count() == 300 and len(links.inputFiles()) == 1


def test_simhash_finds_edited_copies_of_four_fifths(spark):
    """300 planted copies at a similarity of just 0.80, and unrelated texts."""
    rng = random.Random(11)
    texts, ids = [], []
    for at in range(300):
        words = sentence(rng, 400, of=5000).split()
        edited = words.copy()
        places = rng.sample(range(4, 390, 10), 8)
        # Eight edits take five shingles each, a ninth beside one of them four more.
        for k in [*places, places[0] + 4]:
            edited[k] = f"q{k}"
        a, b = shingle_set(" ".join(words)), shingle_set(" ".join(edited))
        assert 0.795 < len(a & b) / len(a | b) < 0.805
        texts += [" ".join(words), " ".join(edited), sentence(rng, 400, of=5000)]
        ids += [50 * at, 50 * at + 1, 50 * at + 2]
    rows = {r.doc_id: r for r in simhash.fingerprint_documents(documents(spark, texts, ids)).collect()}
    found = [at for at in range(0, 15000, 50) if rows[at + 1].near_class == at]
    assert len(found) >= 0.9 * 300
    for at in range(0, 3000, 50):
        assert rows[at].near_class == at and rows[at + 2].near_class == at + 2
        assert rows[at].n_near == (2 if at in found else 1)
        assert rows[at + 1].n_near is None


# --- models ------------------------------------------------------------------------


def test_window_hashes():
    words = [b"a", b"b", b"c", b"a", b"b", b"c"]
    found = window_hashes(word_hashes(words), 3)
    assert len(found) == 4 and found[0] == found[3] and len(set(found.tolist())) == 3
    assert len(window_hashes(word_hashes(words[:2]), 5)) == 1
    assert len(window_hashes(word_hashes([]), 5)) == 0


def test_class_model_is_a_distribution(spark, odd, monkeypatch):
    """The chances of all words and of an unseen one per class add up to one; base is exact."""
    monkeypatch.setattr(class_lm, "HEAD", 40)  # most words are rare ones
    training = id_and_text(odd).filter(remainder("doc_id", 5) != 1)
    model, counts = class_lm.fit(training)
    words = {bytes(r.word): r.n for r in counts.collect()}
    expected = Counter()
    for i, t in enumerate(ODD):
        if crc32(str(i).encode()) % 5 != 1:
            expected.update((t or "").encode().lower().split() + [class_lm.END])
    assert words == expected
    chance = np.zeros(class_lm.CLASSES)
    for word, n in words.items():
        if word == class_lm.END:
            chance[0] += 1
            continue
        at = model.head.get(word)
        kind = model.head_class[at] if at else model.ending_class[
            class_lm.ending(word) - 1 - class_lm.WORDS]
        chance[kind] += 10 ** (np.log10(n - model.discount) - model.class_total[kind])
    seen = chance > 0
    seen[0] = False
    chance[seen] += 10 ** (model.unseen - model.class_total)[seen]
    assert np.allclose(chance[seen], 1) and chance[0] == 1
    assert np.allclose((10**model.transition).sum(axis=1), 1)

    total, distinct = sum(expected.values()), len(expected)
    for r in class_lm.score(odd, model, counts).collect():
        tokens = (ODD[r.doc_id] or "").encode().lower().split() + [class_lm.END]
        base = sum(math.log10((expected[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(t in expected for t in tokens))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_class_model_without_training_text(spark, odd):
    model, counts = class_lm.fit(id_and_text(odd.limit(0)))
    rows = class_lm.score(odd, model, counts).collect()
    assert len(rows) == len(ODD) and all(r.n_known == 0 and r.score <= 0 for r in rows)
    assert class_lm.score(odd.limit(0), model, counts).count() == 0


def labelled(spark, n=400):
    """Every second text has its words shouted and one of a few bad words."""
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(n):
        text = sentence(rng, 40)
        bad = i % 2
        texts.append(f"{text.upper()} badword{rng.randrange(3)}!!" if bad else text)
        labels.append((i, 1 - bad, bad))
    return texts, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_classifier_learns(spark):
    texts, labels = labelled(spark)
    docs = documents(spark, [*texts, None, ""])
    seen = labels.filter(remainder("doc_id", 3) != 1)
    model = quality_classifier.fit(docs, seen)
    rows = quality_classifier.score(docs, model).collect()
    held = [r for r in rows if r.doc_id < 400 and crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 0) for r in held]) > 0.95
    assert len(rows) == 402 and all(0 <= r.score <= 1 for r in rows)
    again = quality_classifier.score(docs, quality_classifier.fit(docs, seen)).collect()
    assert {r.doc_id: round(r.score, 6) for r in rows} == {
        r.doc_id: round(r.score, 6) for r in again}
    kept = quality_classifier.keep_good(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.score >= 0.5}


def test_models_without_labels_or_text(spark, odd):
    _, labels = labelled(spark, 4)
    for some in (labels.limit(0), labels.filter("quality = 1")):
        model = quality_classifier.fit(odd, some)
        assert quality_classifier.score(odd, model).count() == len(ODD)
        model = toxicity.fit(odd, some)
        assert {r.score for r in toxicity.score(odd, model).collect()} == {0.0}
    nothing = odd.limit(0)
    assert quality_classifier.score(nothing, quality_classifier.fit(nothing, labels)).count() == 0
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).count() == 0


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    texts, labels = labelled(spark)
    docs = documents(spark, [*texts, None, ""])
    seen = remainder("doc_id", 5) != 0
    model = toxicity.fit(docs.filter(seen), labels.filter(seen))
    rows = toxicity.score(docs, model).collect()
    held = [r for r in rows if r.doc_id < 400 and crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in held]) > 0.95
    clean = [r.score for r in rows if r.doc_id >= 400]
    assert len(clean) == 2 and max(clean) < 0.5


# --- URLs --------------------------------------------------------------------------

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/")]


def test_url_parts_and_listed_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "https://myexample.com/de/": ("myexample.com", "/de/", None, "allow"),
        "x://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net?x=://b/": ("a.net", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame(
        [(i, url, "h", "host") for i, url in enumerate(cases)],
        "page_id bigint, url string, html string, host string",
    )
    none = spark.createDataFrame([], "page_id bigint, bad boolean")
    rows = sorted(url_filter.judge(pages, none, RULES).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == list(cases.values())
    assert url_filter.judge(pages.limit(0), none, []).count() == 0


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for i in range(600):
        host = rng.choice(["spam.one.com", "shop.one.com", "spam.two.org", "two.org"])
        url = f"https://{host}/{rng.choice(['en', 'de'])}/{i}" + rng.choice(["", "?ref=x"])
        rows.append((i, url, "spam" in host and "ref" in url))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, bad boolean")
    labels = pages.filter("page_id < 400").select("page_id", "bad")
    found = url_filter.judge(pages.drop("bad"), labels, []).collect()
    assert {r.page_id: r.verdict for r in found} == {
        i: "block" if bad else "allow" for i, _, bad in rows
    }
    tokened = url_filter.with_parts(pages).select("bad", url_filter.tokens().alias("tokens"))
    rules = url_filter.mine_rules(tokened).collect()
    # Nothing that only narrows another rule.
    assert [sorted(r["items"]) for r in rules] == [["host:spam", "key:ref"]]
    assert rules[0].confidence == 1.0


def judged(spark, urls, bad, **options):
    """Verdicts of all pages; ``bad`` has the label of the first ones."""
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    labels = spark.createDataFrame(list(enumerate(bad)), "page_id bigint, bad boolean")
    found = url_filter.judge(pages, labels, [], **options)
    return [r.verdict == "block" for r in sorted(found.collect())]


def test_rules_may_have_any_length(spark):
    """Pages that are bad only if six or nine query keys meet."""
    rng = random.Random(4)
    for n in (6, 9):
        urls, bad = [], []
        for k in range(260):
            keys = [f"k{i}" for i in range(n)]
            if k >= 30:
                keys.remove(rng.choice(keys))
            urls.append(f"http://a.org/{k}?" + "&".join(f"{x}=1" for x in keys))
            bad.append(k < 30)
        assert judged(spark, urls + urls, bad) == bad + bad


@pytest.mark.parametrize("others", [3_000, 12_000])
def test_a_small_bad_host_is_found_in_any_corpus(spark, others):
    urls = [f"http://bad.example.com/p/{k}" for k in range(12)]
    urls += [f"http://h{k % 50}.example.com/p/{k}" for k in range(others)]
    found = judged(spark, urls, [k < 12 for k in range(len(urls))])
    assert found == [k < 12 for k in range(len(urls))]


def test_many_shared_tokens_are_mined_quickly(spark):
    """Forty keys that pages of both labels share, and twenty-five that bad ones have alone."""
    shared, own = (["&".join(f"{x}{k}=1" for k in range(n)) for x, n in (("s", 40), ("b", 25))])
    urls = [f"http://x.org/{k}?{shared}" + ("" if k % 2 else f"&{own}") for k in range(300)]
    urls.append("http://other.net/?b7=1")
    assert judged(spark, urls, [k % 2 == 0 for k in range(300)]) == [k % 2 == 0 for k in range(301)]


def test_repeated_labels_and_pages_count_once(spark):
    urls = [f"http://a.org/x{'y' * k}" for k in range(4)] + ["http://b.com/z"]
    pages = spark.createDataFrame(
        [(k, u) for k, u in enumerate(urls)] * 5 + [(None, "http://a.org/x")], "page_id bigint, url string"
    )
    labels = [(k, k < 4) for k in range(5)] * 5 + [(None, True)] * 9 + [(4, None), (0, False)]
    labels = spark.createDataFrame(labels, "page_id bigint, bad boolean")
    rows = url_filter.judge(pages, labels, []).collect()
    assert {r.verdict for r in rows} == {"allow"} and len(rows) == 26
    rows = url_filter.judge(pages, labels, [], least_pages=4).collect()
    assert sum(r.verdict == "block" for r in rows) == 21


def test_rules_equal_all_sure_sets_without_sure_parts(spark):
    """Against counting every subset of every basket."""
    rng = random.Random(6)
    rows = []
    for _ in range(700):
        tokens = sorted({rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))})
        odds = 0.95 if {"a", "b"} <= set(tokens) else 0.85 if "c" in tokens else 0.1
        rows.append((tokens, rng.random() < odds))
    frame = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    counts = defaultdict(lambda: [0, 0])
    for tokens, bad in rows:
        for bits in range(1, 1 << len(tokens)):
            part = tuple(t for k, t in enumerate(tokens) if bits >> k & 1)
            counts[part][0] += 1
            counts[part][1] += bad
    sure = {p: b / n for p, (n, b) in counts.items() if b >= 5 and b / n >= 0.8}
    expected = {
        p: c for p, c in sure.items() if not any(set(q) < set(p) and d >= c for q, d in sure.items())
    }
    assert any(len(p) > 2 for p in expected)
    found = {tuple(sorted(r["items"])): r.confidence for r in url_filter.mine_rules(frame).collect()}
    assert found == expected


def test_long_chains_of_somewhat_alike_texts_are_taken_apart(spark, monkeypatch):
    """5,000 texts, each 0.80 like the next, that the short signatures hold in large groups."""
    monkeypatch.setattr(minhash_dedup, "LARGE", 2)
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(12 * 5000 + 106)]
    texts = [" ".join(words[11 * k : 11 * k + 106]) for k in range(5000)]
    a, b = shingle_set(texts[0]), shingle_set(texts[1])
    assert 0.8 < len(a & b) / len(a | b) < 0.81
    # Some of them also have a real near copy.
    texts += [texts[k].rsplit(" ", 3)[0] for k in range(0, 5000, 500)]
    docs = documents(spark, texts)
    described = id_and_text(docs).mapInArrow(
        minhash_dedup._describe,
        "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary",
    )
    reps = described.withColumnRenamed("doc_id", "rep")
    shape = (85, minhash_dedup.TREES, minhash_dedup.LEVELS, minhash_dedup.NODE)
    groups = minhash_dedup.candidate_groups(reps, *shape)
    largest = lambda g: g.groupBy("grp").count().agg(F.max("count")).first()[0]
    assert largest(groups) > 3 * minhash_dedup.BLOCK
    assert largest(minhash_dedup.refined_groups(docs, groups, *shape)) < minhash_dedup.BLOCK
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs).collect()}
    assert found == {k: k if k < 5000 else 500 * (k - 5000) for k in range(5010)}


def test_a_hot_length_is_packed_in_parts(spark, path):
    """Many pieces of one length, most of them equal rows: any number of parts packs them whole."""
    rows = [(1, 0, 0, 10, 5)] * 300 + [(k, 0, 0, 10, k) for k in range(200)]
    rows += [(k, 1, 0, 1 + k % 30, k) for k in range(100)]
    fields = ", ".join(f"{c} bigint" for c in ("doc_id", "piece", "start", "length", "ids_crc32"))
    spark.createDataFrame(rows, fields).repartition(3).write.parquet(path("pieces"))
    pieces = spark.read.parquet(path("pieces"))
    for part_rows in (1_000_000, 40):
        packed = packing.pack(pieces, 32, part_rows).collect()
        assert sorted(tuple(r)[:5] for r in packed) == sorted(rows)
        bins = defaultdict(list)
        for r in packed:
            bins[r.sequence_id].append((r.offset, r.length))
        for held in bins.values():
            ends = 0
            for offset, length in sorted(held):
                assert offset == ends
                ends += length
            assert ends <= 32
        assert len(bins) == sum(n for _, n in packing.plan(Counter(r[3] for r in rows), 32))


def test_rules_sql_is_the_query_on_long_texts(spark, path):
    """A text whose words repeat more than a book's, and others on both sides of each rule."""
    rng = random.Random(8)
    of = [f"word{k}" for k in range(700)]
    texts = [" ".join(rng.choice(of) for _ in range(n)) for n in (5_000, 30_000, 999, 1_000, 1_001)]
    texts += [" ".join(rng.choice(of[:k]) for _ in range(3_000)) for k in (50, 150, 200, 210, 220)]
    docs = documents(spark, [*ODD, *texts])
    docs.write.parquet(path("t") + "/documents.parquet")
    ours = queries.op10_quality_rules(spark, path("t")).toPandas()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path('t')}/documents.parquet/*.parquet'")
    assert normal(ours) == normal(con.execute(queries.oracle_sql()["op10_quality_rules"]).df())
    kept = dict(zip(ours["doc_id"], ours["kept"]))
    assert kept[len(ODD)] and not kept[len(ODD) + 5]
    ablated = queries.rules_ablation(spark, path("t")).toPandas()
    assert normal(ablated) == normal(con.execute(queries.oracle_sql()["rules_ablation"]).df())


def test_samples_are_bounded_by_rows(spark):
    """An id that bears most rows, equal and different ones, and labels that are repeated."""
    rng = random.Random(2)
    texts = [sentence(rng, 8) for _ in range(400)]
    rows = [(7, t) for t in texts] * 3 + [(8, texts[0])] * 500 + [(k, texts[k]) for k in range(9, 60)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    ids = spark.createDataFrame([(k,) for k in range(5, 60)], "doc_id bigint")
    for most in (10, 100, 1000):
        found = text_sample(docs, ids, most).select(*SAMPLED).distinct().count()
        assert found == min(most, 400 + 1 + 51)
    labels = spark.createDataFrame(
        [(7, 1), (7, 1), (7, 0), (8, 0), (8, 1), (9, 0), (9, 0)] * 50, "doc_id bigint, quality int"
    )
    sample = quality_classifier.labelled_sample(docs, labels, "quality", 1000)
    assert {(r.doc_id, r.label) for r in sample.collect()} == {(7, 1), (8, 1), (9, 0)}
    drawn = toxicity.sample(docs, labels.select("doc_id").filter("doc_id < 9"), (30, 50))
    n = {r["positive"]: r["count"] for r in drawn.groupBy("positive").count().collect()}
    assert n == {1: 30, 0: 50}


def test_caches_are_bounded_by_bytes():
    cache = WordCache(lambda word: word * 2, most=1 << 20)
    for k in range(40_000):
        assert cache[b"%030d" % k] == b"%030d" % k * 2
        cache[b"%0900d" % k]
    held = sum(len(k) + len(v) for part in (cache, cache.older) for k, v in part.items())
    assert held < 2 << 20 and max(map(len, cache)) <= WordCache.LONGEST
