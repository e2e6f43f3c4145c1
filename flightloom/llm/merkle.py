"""Merkle manifest of a dataset, by a nested-struct rollup.

Leaves are ranked within their language; the octal digits of a rank are grouped away one
after the other within blocks of 512 ranks, which nests the nodes of three levels as structs in
one row per block. The digests of the blocks go through the same again, until one is left per
language, and the languages' digests likewise give the root. On the way down each block gets
the path of its own digest, and a transform and an explode of the nested row give its leaves
their proofs; leaves are never joined.

A row holds 512 nodes at most, whatever the size of a language. Rows are ranked in
range-partitioned order, so a language may hold any share of them.

Edge cases: a NULL field counts as ``-``. NULL languages are one language, ahead of the others;
NULL ids come first in theirs. Rows with equal ids are ordered by their leaves; equal rows each
have a place. An empty table gives an empty manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.texts import written

# Children of a node, as a power of two; levels that lie nested in one row.
BITS, LEVELS = 3, 3
RUN, BLOCK_BITS = 1 << BITS, BITS * LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<left: string, right: string>>"


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(text: Column | None = None) -> Column:
    """The leaf of a document, with ``text`` in the place of its text if given."""

    def written_out(value: Column) -> Column:
        value = value.cast("string")
        size = F.octet_length(value).cast("string")
        return F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-"))

    values = [text if c == "text" and text is not None else F.col(c) for c in FIELDS]
    return _hash(F.concat(*[written_out(v) for v in values]))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``_rank`` (from 0) among the rows of a ``tree``, and their number ``_n``.

    Rows are sorted in ranges, so that a tree may spread over many tasks; what comes before a
    range is summed from one count per tree and range.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Range number and place within the range, as the sorted rows are written.
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn("_part", F.shiftrightunsigned("_at", 33))
    parts = placed.groupBy(F.col(tree).alias("_tree"), "_part").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = F.sum("_rows").over(Window.partitionBy("_tree").orderBy("_part"))
    shift = (earlier - F.col("_rows") - F.col("_first")).alias("_shift")
    n = F.sum("_rows").over(Window.partitionBy("_tree")).alias("_n")
    parts = written(parts.select("_tree", F.col("_part").alias("_range"), shift, n), "ranges")
    same = placed[tree].eqNullSafe(parts["_tree"]) & (placed["_part"] == parts["_range"])
    rank = (F.col("_at") + F.col("_shift")).alias("_rank")
    return placed.join(parts, same).select(*rows.columns, "_n", rank)


def _rolled_up(nodes: DataFrame, tree: str, level: int) -> DataFrame:
    """One row (tree, _n, _block, digest, children) per block, three levels nested.

    ``nodes`` has (tree, _n, _rank, digest, item). All groupings refine the one by block, so
    they share its shuffle.
    """
    keys = [tree, "_n", "_block"]
    digits = [f"_digit{k}" for k in range(LEVELS)]
    digit = [
        F.shiftright("_rank", BITS * k).bitwiseAND(RUN - 1).cast("int").alias(digits[k])
        for k in range(LEVELS)
    ]
    block = F.shiftright("_rank", BLOCK_BITS).alias("_block")
    frame = nodes.select(tree, "_n", block, *digit, "digest", "item").repartition(tree, "_block")
    below = "item"
    for k in range(LEVELS):
        child = F.struct(F.col(digits[k]).alias("digit"), "digest", below)
        frame = frame.groupBy(*keys, *digits[k + 1 :]).agg(
            F.array_sort(F.collect_list(child)).alias("children")
        )
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        # Beyond the root of a small tree nothing is hashed any more.
        more = F.col("_n") > RUN ** (level + k)
        only = F.element_at("children", 1)["digest"]
        frame = frame.withColumn("digest", F.when(more, _hash(joined)).otherwise(only))
        below = "children"
    return frame


def _up(nodes: DataFrame, tree: str, largest: int) -> list[DataFrame]:
    """The blocks of each height; the last has one row per tree, whose digest is its root."""
    heights: list[DataFrame] = []
    while not heights or largest > RUN ** (LEVELS * len(heights)):
        blocks = written(_rolled_up(nodes, tree, LEVELS * len(heights)), "blocks")
        heights.append(blocks)
        nodes = blocks.select(
            tree, "_n", F.col("_block").alias("_rank"), "digest", F.lit(0).alias("item")
        )
    return heights


def _siblings(nodes: Column, at: Column) -> Column:
    def digests(start: Column | int, size: Column | int) -> Column:
        return F.array_join(F.transform(F.slice(nodes, start, size), lambda c: c["digest"]), "")

    return F.struct(digests(F.lit(1), at).alias("left"), digests(at + 2, F.lit(RUN)).alias("right"))


def _down(heights: list[DataFrame], tree: str, above: DataFrame) -> DataFrame:
    """(tree, _rank, digest, item, above) per leaf; ``above.proof`` goes up to the last root.

    ``above`` has one row (tree, _block = 0, above) per tree; its struct has ``proof`` and
    whatever else all leaves of the tree are to carry.
    """
    carried = [f.name for f in above.schema["above"].dataType if f.name != "proof"]
    nothing = F.array().cast(_PROOF)
    for height in range(len(heights) - 1, -1, -1):
        blocks = heights[height].select(tree, "_n", "_block", "children")
        # Blocks meet their paths in a grouping, in which NULL trees are a tree too.
        both = blocks.unionByName(above, allowMissingColumns=True)
        met = both.groupBy(tree, "_block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("_n", "children", "above")]
        )

        def step(nodes: Column, at: Column, level: int) -> Column:
            more = F.col("_n") > RUN ** (LEVELS * height + level)
            return F.when(more, F.array(_siblings(nodes, at))).otherwise(nothing)

        def bottom(two: Column, c2: Column, i2: Column, c1: Column, i1: Column) -> Column:
            def node(c0: Column, i0: Column) -> Column:
                proof = F.concat(
                    step(c1["children"], i0, 0),
                    step(c2["children"], i1, 1),
                    step(two, i2, 2),
                    F.col("above.proof"),
                )
                place = i2 * RUN * RUN + i1 * RUN + i0
                rank = F.shiftleft("_block", BLOCK_BITS) + place
                up = F.struct(proof.alias("proof"), *[F.col(f"above.{c}") for c in carried])
                return F.struct(
                    rank.alias("_rank"), c0["digest"].alias("digest"),
                    c0["item"].alias("item"), up.alias("above"),
                )

            return F.transform(c1["children"], node)

        def middle(two: Column, c2: Column, i2: Column) -> Column:
            return F.flatten(
                F.transform(c2["children"], lambda c1, i1: bottom(two, c2, i2, c1, i1))
            )

        two = F.col("children")
        leaves = F.flatten(F.transform(two, lambda c2, i2: middle(two, c2, i2)))
        out = met.select(tree, F.inline(leaves))
        above = out.select(tree, F.col("_rank").alias("_block"), "above")
    return out


def manifest(leaves: DataFrame) -> DataFrame:
    """The leaves, all columns, with ``proof`` (the siblings' digests left and right of the
    path, level by level up to the root), ``subroot`` and ``root``.

    ``leaves`` has ``doc_id``, ``lang`` and ``leaf``; other columns come along as they are.
    """
    names = leaves.columns
    item = F.struct(*[F.col(c) for c in names])
    # Equal ids go by their leaves, of which 60 bits tell them apart; rows that are equal in
    # these too have a number, so that any number of them can be split.
    order = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint").alias("_order")
    row = F.monotonically_increasing_id().alias("_row")
    slim = leaves.select(
        F.col("lang").alias("_lang"), "doc_id", order, row, F.col("leaf").alias("digest"),
        item.alias("item"),
    )
    # Written, so that texts are read and hashed once, though ranges are found in two passes.
    nodes = ranked(written(slim, "leaves"), "_lang", ["doc_id", "_order", "_row"])
    largest = nodes.agg(F.max("_n")).first()[0] or 0
    heights = _up(nodes, "_lang", largest)
    roots = heights[-1].select(F.lit(0).alias("_all"), "_lang", "digest")

    langs = ranked(roots.withColumn("item", F.struct("_lang")), "_all", ["_lang"])
    tops = _up(langs, "_all", langs.agg(F.max("_n")).first()[0] or 0)
    start = F.struct(F.array().cast(_PROOF).alias("proof"), F.col("digest").alias("root"))
    whole = tops[-1].select("_all", "_block", start.alias("above"))
    ends = _down(tops, "_all", whole).select(
        F.col("item._lang").alias("_lang"),
        F.lit(0).cast("bigint").alias("_block"),
        F.struct("above.proof", F.col("digest").alias("subroot"), "above.root").alias("above"),
    )
    found = _down(heights, "_lang", ends)
    return found.select(*[F.col("item")[c].alias(c) for c in names], "above.*")


def fold(proof: Column | str, start: Column | str) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    start = F.col(start) if isinstance(start, str) else start
    return F.aggregate(
        proof, start, lambda digest, at: _hash(F.concat(at["left"], digest, at["right"]))
    )


def proof_digest(proof: Column | str) -> Column:
    """One digest of all siblings, from the leaf's level up, left to right."""
    each = F.transform(proof, lambda at: F.concat(at["left"], at["right"]))
    return _hash(F.array_join(each, ""))
