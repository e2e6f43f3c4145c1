"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its five-word shingles. Equal sets are one class from the start.
Of every class a signature of minwise tokens is kept. In each of several independent trees a
class goes down a path: a node chooses, by its own hash, one minwise coordinate (sometimes a
second, ``1 / threshold`` on average), and the class moves to the child named by its token
there. Nodes of up to ``NODE`` classes are compared exhaustively on signatures, larger ones
branch again. What is still crowded at the last level has agreed on all tokens of its path
and counts as one candidate group whole. Trees are repeated so that a pair at the threshold is
missed with a chance of about 1e-4 where all its nodes are crowded, and 1e-9 elsewhere.

Candidates only form groups. Estimates of 64 tokens are rough, so texts that are only somewhat
alike may hang together in a chain: the members of a large group are given signatures eight
times as long and go through trees again, which leaves what is nearly alike. Within a group links are confirmed on the full sets, all
against all; a large group is cut into blocks, and each pair of blocks is a task's work, so
no partner is left out and no group must fit one task. Of a block pair's links a spanning
forest is kept, which has the same components.

Edge cases: texts without words have size 0 and are linked with nothing; so are rows with a
NULL id. Texts of fewer than five words are one shingle. Rows that share an id are one node:
each row's class keeps its own size, and their links join. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.components import connected_components
from flightloom.llm.texts import (
    BLANKS,
    columns_out,
    id_and_text,
    mix,
    sliced,
    window_hashes,
    with_totals,
    word_hashes,
    written,
)

SHINGLE = 5
PERCENT = 85
SIGNATURE = 64
# Pairs whose estimate is so many standard deviations off can't be at the threshold.
DEVIATIONS = 4.5
TREES, LEVELS, NODE = 12, 6, 256
# Groups of more blocks than this are looked at again, with signatures of so many tokens.
LARGE, LONG_SIGNATURE = 8, 512
# Blocks of a large group: most members, and most shingles in all.
BLOCK, BLOCK_SHINGLES = 512, 400_000

_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, LONG_SIGNATURE, np.uint64) * np.uint64(
    2
) + np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(window_hashes(word_hashes(text.lower().split()), SHINGLE))


def signature(found: np.ndarray, width: int = SIGNATURE) -> np.ndarray:
    """Per coordinate the least hash of the set's tokens."""
    least = np.full(width, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = np.multiply.outer(_FACTORS[:width], found[at : at + 2048])
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


_SETS = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_shingles", "k1", "k2")] + [("signature", pa.binary())]
)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            found = shingles(text)
            key = xxhash.xxh3_128_digest(found.tobytes())
            k1 = int.from_bytes(key[:8], "big", signed=True)
            k2 = int.from_bytes(key[8:], "big", signed=True)
            rows.append((doc_id, len(found), k1, k2, signature(found).tobytes()))
        yield columns_out(_SETS, dict(zip(_SETS.names, zip(*rows))))


# --- trees ------------------------------------------------------------------------


def branch(node: np.ndarray, signatures: np.ndarray, percent: int) -> tuple:
    """(row, child) of every branch that the nodes choose for their members."""
    rows, width = np.arange(len(node)), signatures.shape[1]
    choice = mix(node + np.uint64(0x5851F42D4C957F2D))
    first = (choice % np.uint64(width)).astype(np.int64)
    step = ((choice >> np.uint64(16)) % np.uint64(width - 1)).astype(np.int64) + 1
    # One branch always, a second so often that there are 100 / percent on average.
    again = (choice >> np.uint64(40)) % np.uint64(1000) < np.uint64(100_000 // percent - 1000)
    out = []
    for member, at in ((rows, first), (rows[again], ((first + step) % width)[again])):
        token = signatures[member, at].astype(np.uint64) | (at.astype(np.uint64) << np.uint64(32))
        out.append((member, mix(node[member] ^ mix(token + np.uint64(1)))))
    return np.concatenate([m for m, _ in out]), np.concatenate([c for _, c in out])


def _signatures(batch: pa.RecordBatch) -> np.ndarray:
    """One row per member; all signatures of a table have one length."""
    joined = b"".join(batch["signature"].to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(batch.num_rows, -1)


_NODES = "rep bigint, node bigint"


def _rows_of_nodes(rep: np.ndarray, member: np.ndarray, child: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rep[member]), pa.array(child.view(np.int64))], ["rep", "node"]
    )


def _roots(trees: int, percent: int):
    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rep, found = batch["rep"].to_numpy(), _signatures(batch)
                for tree in range(trees):
                    node = np.full(len(rep), mix(np.array([tree + 1], np.uint64))[0])
                    yield _rows_of_nodes(rep, *branch(node, found, percent))

    return start


def _descend(percent: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rep, node = batch["rep"].to_numpy(), batch["node"].to_numpy().view(np.uint64)
                yield _rows_of_nodes(rep, *branch(node, _signatures(batch), percent))

    return go


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut where ``names`` change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(whole.num_rows - 1, bool)
        for name in names:
            key = whole[name].to_numpy()
            change |= key[1:] != key[:-1]
        starts = np.r_[0, np.flatnonzero(change) + 1]
        for start, end in zip(starts[:-1], starts[1:]):
            yield whole.slice(start, end - start)
        held = whole.slice(starts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """(least member, member) over the components of a symmetric matrix of links."""
    n = len(linked)
    if n == 2:
        return [(0, 1)] if linked[0, 1] else []
    label = np.arange(n)
    while True:
        low = np.minimum(label, np.where(linked, label, n).min(axis=1))
        low = low[low]
        if (low == label).all():
            return [(int(a), b) for b, a in enumerate(label) if a != b]
        label = low


_EDGES = "a bigint, b bigint"
_EDGES_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges_out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return columns_out(_EDGES_ARROW, {"a": [a for a, _ in pairs], "b": [b for _, b in pairs]})


def _compare_nodes(candidate: float):
    """A spanning forest of the candidate pairs of each small node."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[int, int]] = []
        for rows in runs(batches, ["node"]):
            if rows.num_rows < 2:
                continue
            rep = rows["rep"].to_numpy()
            found = _signatures(rows.combine_chunks().to_batches()[0])
            same = np.zeros((len(rep), len(rep)), np.int32)
            for at in range(found.shape[1]):
                same += found[:, at, None] == found[None, :, at]
            pairs += [(rep[a], rep[b]) for a, b in forest(same >= candidate * found.shape[1])]
            if len(pairs) > 10_000:
                yield _edges_out(pairs)
                pairs = []
        yield _edges_out(pairs)

    return compare


def candidate_edges(
    reps: DataFrame,
    percent: int,
    trees: int,
    levels: int,
    node_size: int,
    width: int = SIGNATURE,
) -> DataFrame:
    """Edges (a, b) whose components hold all pairs that may reach the threshold.

    ``reps`` is a written table (rep, signature), one row per class; signatures have ``width``
    tokens.
    """
    share = percent / 100
    candidate = share - DEVIATIONS * (share * (1 - share) / width) ** 0.5
    rows = reps.select("rep", "signature").mapInArrow(_roots(trees, percent), _NODES)
    edges, total = None, reps.count()
    # Each level reads all signatures, of which tasks take no more than files have.
    most = total * trees
    for level in range(1, levels + 1):
        rows = written(rows, "nodes", max(total, most))
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        shared = written(with_totals(rows, sizes, "node"), "shared", max(total, most))
        small = shared.filter(F.col("size") <= node_size).join(reps, "rep")
        found = (
            small.select("node", "rep", "signature")
            .repartition("node")
            .sortWithinPartitions("node", "rep")
            .mapInArrow(_compare_nodes(candidate), _EDGES)
        )
        edges = found if edges is None else edges.union(found)
        crowded = shared.filter(F.col("size") > node_size)
        if level == levels:
            heads = crowded.groupBy("node").agg(F.min("rep").alias("a"))
            last = with_totals(crowded, heads, "node")
            edges = edges.union(last.select("a", F.col("rep").alias("b")))
        else:
            most = crowded.count()
            if not most:
                break
        rows = crowded.join(reps, "rep").select("rep", "node", "signature")
        rows = rows.mapInArrow(_descend(percent), _NODES)
    return edges


# --- confirmation -----------------------------------------------------------------


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted sets, exactly."""
    n = len(sets)
    if n == 2:
        common = np.intersect1d(sets[0], sets[1], assume_unique=True).size
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    counts = np.bincount(column, minlength=len(values))
    # A token of one member alone adds nothing to a pair.
    order = np.cumsum(counts > 1) - 1
    keep = counts[column] > 1
    owner, column = owner[keep], order[column[keep]]
    total = np.zeros((n, n), np.float64)
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        part = slice(*np.searchsorted(column, (low, low + 4096)))
        has = np.zeros((n, 4096), np.float32)
        has[owner[part], column[part] - low] = 1
        total += has @ has.T
    total = np.rint(total).astype(np.int64)
    np.fill_diagonal(total, [len(s) for s in sets])
    return total


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[int, int]] = []
        for rows in runs(batches, ["grp", "p", "q"]):
            ids, block = rows["rep"].to_numpy(), rows["block"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"].to_pylist()]
            if len(ids) < 2:
                continue
            common = intersections(sets)
            size = np.array([len(s) for s in sets])
            linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
            if rows["p"][0] != rows["q"][0]:
                linked &= block[:, None] != block[None, :]
            pairs += [(ids[a], ids[b]) for a, b in forest(linked)]
            if len(pairs) > 10_000:
                yield _edges_out(pairs)
                pairs = []
        yield _edges_out(pairs)

    return confirm


_FULL = pa.schema([("grp", pa.int64()), ("rep", pa.int64()), ("shingles", pa.binary())])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 4 << 20):
        sets = [shingles(text).tobytes() for text in batch["text"].to_pylist()]
        yield columns_out(_FULL, {"grp": batch["grp"], "rep": batch["rep"], "shingles": sets})


def _group_sizes(groups: DataFrame) -> DataFrame:
    return groups.groupBy("grp").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )


def candidate_groups(
    reps: DataFrame, percent: int, trees: int, levels: int, node_size: int, width: int = SIGNATURE
) -> DataFrame:
    """A written table (rep, grp, n_shingles) of the classes that have a candidate."""
    edges = candidate_edges(
        reps.select("rep", "signature"), percent, trees, levels, node_size, width
    )
    found = connected_components(edges)
    heads = found.select(F.col("component").alias("id"), "component").distinct()
    groups = found.union(heads).toDF("rep", "grp")
    # As each row of reps is in one group at most.
    return written(groups.join(reps.select("rep", "n_shingles"), "rep"), "groups", reps.count())


def _long_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 4 << 20):
        made = [signature(shingles(t), LONG_SIGNATURE).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["rep"], batch["n_shingles"], pa.array(made, pa.binary())],
            ["rep", "n_shingles", "signature"],
        )


def refined_groups(
    docs: DataFrame, groups: DataFrame, percent: int, trees: int, levels: int, node_size: int
) -> DataFrame:
    """The groups, of which the large ones are taken apart by longer signatures.

    A class without a candidate then is in no group any more.
    """
    sizes = written(_group_sizes(groups), "group-sizes", groups.count())
    large = sizes.filter(F.col("blocks") > LARGE).select("grp")
    if not large.take(1):
        return groups
    # Hot groups are split as they meet their mark.
    members = with_totals(groups, large, "grp").groupBy("rep")
    members = members.agg(F.max("n_shingles").alias("n_shingles"))
    texts = id_and_text(docs).join(members, F.col("doc_id") == F.col("rep"))
    signed = texts.select("rep", "n_shingles", "text").mapInArrow(
        _long_signatures, "rep bigint, n_shingles bigint, signature binary"
    )
    signed = written(signed, "long-signatures")
    again = candidate_groups(signed, percent, trees, levels, node_size, LONG_SIGNATURE)
    small = groups.join(large, "grp", "left_anti").select(*groups.columns)
    return written(small.unionByName(again.select(*groups.columns)), "refined-groups")


def confirmed_edges(docs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of links confirmed on full sets, enough to connect what is linked.

    ``groups`` has (rep, grp, n_shingles): the candidate group of each class.
    """
    size = _group_sizes(groups)
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = with_totals(groups, size, "grp").select("grp", "rep", "blocks", block.alias("block"))
    texts = id_and_text(docs).join(
        members.select("grp", "rep").distinct(), F.col("doc_id") == F.col("rep")
    )
    full = texts.select("grp", "rep", "text").mapInArrow(
        _full_sets, "grp bigint, rep bigint, shingles binary"
    )
    # Each member meets every block of its group once.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    meetings = members.distinct().select("rep", "block", other).select(
        "rep", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    )
    return (
        full.join(meetings, "rep")
        .repartition("grp", "p", "q")
        .sortWithinPartitions("grp", "p", "q", "rep")
        .select("grp", "p", "q", "block", "rep", "shingles")
        .mapInArrow(_confirm(percent), _EDGES)
    )


def near_duplicates(
    docs: DataFrame,
    percent: int = PERCENT,
    trees: int = TREES,
    levels: int = LEVELS,
    node_size: int = NODE,
) -> DataFrame:
    """One row per document: ``n_shingles``, ``component_id`` and ``kept``."""
    sets = written(
        id_and_text(docs).mapInArrow(
            _describe,
            "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary",
        ),
        "sets",
    )
    n = sets.count()
    real = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = written(real.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes", n)
    reps = written(
        real.join(classes, [real["k1"] == classes["k1"], real["k2"] == classes["k2"],
                            real["doc_id"] == classes["rep"]])
        .select(classes["rep"], real["k1"], real["k2"], "n_shingles", "signature")
        .dropDuplicates(["rep", "k1", "k2"]),
        "classes-signed",
        n,
    )
    groups = candidate_groups(reps, percent, trees, levels, node_size)
    groups = refined_groups(docs, groups, percent, trees, levels, node_size)
    links = connected_components(confirmed_edges(docs, groups, percent))
    named = classes.join(links, classes["rep"] == links["id"], "left").select(
        F.col("k1").alias("_k1"),
        F.col("k2").alias("_k2"),
        F.coalesce("component", "rep").alias("_component"),
    )
    known = [
        sets["k1"] == named["_k1"],
        sets["k2"] == named["_k2"],
        sets["n_shingles"] > 0,
        sets["doc_id"].isNotNull(),
    ]
    component = F.coalesce("_component", "doc_id")
    return sets.join(named, known, "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one_each(docs: DataFrame, percent: int, trees: int = TREES) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies.

    Of linked rows the one with the least id stays, one with a NULL id only if no other has an
    id. Rows are numbered once, so that an id may be NULL, be repeated or bear several texts.
    Texts without words are linked with nothing: of those with equal id and text one stays.
    """
    row = "_near_row"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    texts = numbered.select(F.col(row).alias("doc_id"), "text")
    found = written(near_duplicates(texts, percent, trees), "near-rows", numbered.count())
    tails = found.filter("not kept").select(F.col("doc_id").alias(row), "component_id")
    heads = tails.select(F.col("component_id").alias(row), "component_id").distinct()
    members = tails.unionByName(heads).join(numbered.select(row, "doc_id"), row)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    stays = members.groupBy("component_id").agg(F.min(rank).getField(row).alias(row))

    # Those without words are told by the text itself: a join would shuffle all texts for them.
    bare = numbered.select(row, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bare = written(bare.filter(F.btrim("text", F.lit(BLANKS)) == ""), "rows-without-words")
    first = bare.groupBy("doc_id", "text").agg(F.min(row).alias(row))
    linked = members.select(row).join(stays.select(row), row, "left_anti")
    gone = linked.union(bare.select(row).join(first.select(row), row, "left_anti"))
    return numbered.join(written(gone, "near-gone"), row, "left_anti").select(*docs.columns)
