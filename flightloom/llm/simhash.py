"""SimHash fingerprints of documents, and block tables that find near ones.

All of it is DataFrame work. A term is a run of five words (or all words, if fewer), lower
case, weighted by how often it occurs. Its 64-bit hash votes on the bits: a set bit for, a
clear bit against. For each bit the votes for it are counted, two bits in one long, and the
bit is set if they are more than half of all.

Near ones are looked for by 128 bits, as 64 leave too few between edited copies and unrelated
texts: the second 64 are voted on by hashes of the hashes. At similarity 0.8 about 19 bits differ.
To find all fingerprints within a Hamming radius, the bits are cut into blocks, each the key of a
table with a radius of its own. These radii and one more per block but the last add up to the
whole radius: of two that differ in no more bits, not all blocks can differ in more than theirs.
A query asks each table for all such neighbours of its block, and candidates are compared in full.
What is found is linked, and the least id of what hangs together names the class. Near copies lie
close to a pivot, and queries ask for pivots: what is near is counted by distances from these.

Edge cases: a NULL text is an empty one, whose fingerprint is 0. Repeated rows (equal id and
text) are one document when the next one is looked for, and each is returned. A NULL id comes
before all others; rows that share an id are ordered by a hash of the text. A single document
is its own next one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.components import connected_components
from flightloom.llm.texts import BLANKS, with_totals, written

TERM = 5
BITS = 64
RADIUS, BLOCKS = 25, 8
# A block with more fingerprints is a crowd, in which clusters are looked for; so many of a
# cluster are compared at once; smaller clusters are taken for single fingerprints.
CROWD, CHUNK, CLUSTER = 32, 256, 64
# Fingerprints of a block that a query meets at once: bits of a positive long tell which are near.
ROW = 63
_PAIR = 0x1_0000_0001


def words_of(text: Column) -> Column:
    """The lower-case words; NULL if there are none."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare != "", F.split(F.lower(bare), "[\\x20\\x09-\\x0D]+"))


def terms(words: Column) -> Column:
    """The hashes of the terms, one per occurrence; NULL without words."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - TERM, F.lit(0)))
    hashes = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(TERM)])
    )
    return F.when(words.isNotNull(), hashes)


def with_fingerprints(texts: DataFrame, *key: str, again: bool = False) -> DataFrame:
    """``key`` columns and ``bits``, the fingerprint as a long, of the column ``text``.

    Rows with equal keys must have equal texts; the votes of such rows just add up. With
    ``again`` the terms' hashes are hashed once more, for 64 further bits.
    """
    cut = texts.select(*key, words_of(F.col("text")).alias("words")).select(
        *key, F.explode_outer(terms(F.col("words"))).alias("h")
    )
    if again:
        cut = cut.withColumn("h", F.when(F.col("h").isNotNull(), F.xxhash64("h")))
    votes = [
        F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_PAIR))).alias(f"v{i}")
        for i in range(BITS // 2)
    ]
    counted = cut.groupBy(*key).agg(F.count("h").alias("n"), *votes)
    bits = F.lit(0).cast("bigint")
    for i in range(BITS // 2):
        both = F.coalesce(f"v{i}", F.lit(0))
        low, high = both.bitwiseAND(F.lit(0xFFFF_FFFF)), F.shiftrightunsigned(both, 32)
        for votes_for, bit in ((low, i), (high, i + 32)):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            bits = bits.bitwiseOR(
                F.when(votes_for * 2 > F.col("n"), F.lit(value).cast("bigint")).otherwise(0)
            )
    return counted.select(*key, bits.alias("bits"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


# --- near fingerprints ------------------------------------------------------------


def neighbour_masks(width: int, most: int) -> list[int]:
    """All masks of ``width`` bits with at most ``most`` set."""
    sets = (c for n in range(most + 1) for c in combinations(range(width), n))
    return [sum(1 << i for i in c) for c in sets]


def block_radii(radius: int, blocks: int) -> list[int]:
    """How many bits each block may differ in; -1: its table need not be asked.

    If all blocks differed in more, the sum would be over ``radius``.
    """
    each, more = divmod(radius - blocks + 1, blocks)
    return [each + (i < more) for i in range(blocks)]


def _cuts(radius: int, blocks: int, words: int) -> list[tuple[int, int, int, int, int]]:
    """(table, number of the word, first bit, end, radius) of each block whose table is asked."""
    each, left = divmod(blocks, words)
    if radius < 0 or each < 1 or left or each > BITS or radius >= BITS * words:
        raise ValueError(f"no search with radius {radius}, {blocks} blocks of {words} longs")
    edges = [round(BITS * i / each) for i in range(each + 1)]
    cuts = [(word, low, high) for word in range(words) for low, high in zip(edges, edges[1:])]
    radii = block_radii(radius, blocks)
    return [(t, *cut, most) for t, (cut, most) in enumerate(zip(cuts, radii)) if most >= 0]


def _block(word: Column | str, low: int, high: int) -> Column:
    part = F.lit((1 << (high - low)) - 1 if high - low < BITS else -1).cast("bigint")
    return F.shiftrightunsigned(word, low).bitwiseAND(part)


def _blocks(
    frame: DataFrame, radius: int, blocks: int, words: Sequence[str], ask: bool
) -> DataFrame:
    """The rows once per table, with ``t`` and ``block``; to ``ask``, once per neighbour of it."""
    rows = []
    for t, word, low, high, most in _cuts(radius, blocks, len(words)):
        masks = neighbour_masks(high - low, most) if ask else [0]
        masks = F.array(*[F.lit(m).cast("bigint") for m in masks])
        block = _block(words[word], low, high)
        rows.append(F.struct(F.lit(t).alias("t"), block.alias("b"), masks.alias("m")))
    kept = frame.columns
    cut = frame.select(*kept, F.explode(F.array(*rows)).alias("k"))
    wide = cut.select(*kept, "k.t", "k.b", F.explode("k.m").alias("mask"))
    return wide.select(*kept, "t", F.col("b").bitwiseXOR(F.col("mask")).alias("block"))


def _apart(a: Sequence[Column | str], b: Sequence[Column | str]) -> Column:
    """How many bits differ."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    each = [F.bit_count(column(x).bitwiseXOR(column(y))) for x, y in zip(a, b)]
    return reduce(lambda x, y: x + y, each)


def near(
    queries: DataFrame,
    index: DataFrame,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    words: Sequence[str] = ("bits",),
    name: str = "bits",
) -> DataFrame:
    """(query, found): the ``name`` of all fingerprints of ``index`` within ``radius`` of a query's.

    A fingerprint is the longs ``words``. Distinct ones on both sides, so copies are met once.
    """

    def tables(frame: DataFrame, side: str, ask: bool) -> DataFrame:
        kept = dict.fromkeys([*words, name])
        cut = _blocks(frame.select(*kept).distinct(), radius, blocks, words, ask)
        of = [F.col(w).alias(f"{side}_{w}") for w in words]
        return cut.select(*of, F.col(name).alias(side), "t", "block")

    close = _apart([f"query_{w}" for w in words], [f"found_{w}" for w in words]) <= radius
    # Spark doesn't count that a table has many rows per fingerprint, and would broadcast it.
    asked = tables(queries, "query", True).hint("merge")
    met = asked.join(tables(index, "found", False), ["t", "block"]).filter(close)
    return met.select("query", "found").distinct()


# --- near fingerprints, counted and linked ------------------------------------------


def clustered(index: DataFrame, radius: int, blocks: int, words: Sequence[str]) -> DataFrame:
    """``index`` with each fingerprint's ``pivot``, the bits ``p_*`` of that, and how far ``away``.

    ``index`` is a written table: ``node``, ``words``, ``of`` and ``asks`` (is a query), one row
    per node. A fingerprint may join the pivot of the most crowded block it lies in if that is
    at most half of ``radius`` away, so that all of a cluster are near each other; else it is its
    own pivot. The pivot of a block is a query, if one calls that block its own.
    """
    keys = _blocks(index.select("node", *words), radius, blocks, words, False)
    keys = keys.select("node", F.struct("t", "block").alias("at"))
    counts = keys.groupBy("at").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD)
    most = F.max(F.struct("n", "at")).getField("at").alias("at")
    homes = with_totals(keys, counts, "at").groupBy("node").agg(most)
    lived = written(homes.join(index.select("node", "asks", *words), "node"), "homes")
    first = lived.groupBy("at").agg(F.min(F.struct(~F.col("asks"), "node", *words)).alias("p"))
    pivots = first.select(
        "at", F.col("p.node").alias("pivot"), *[F.col(f"p.{w}").alias(f"p_{w}") for w in words]
    )
    p_words = [f"p_{w}" for w in words]
    placed = with_totals(lived, pivots, "at").withColumn("away", _apart(words, p_words))
    placed = placed.filter(F.col("away") <= radius // 2).select("node", "pivot", *p_words, "away")
    return index.join(placed, "node", "left").select(
        *index.columns,
        F.coalesce("pivot", "node").alias("pivot"),
        *[F.coalesce(p, w).alias(p) for p, w in zip(p_words, words)],
        F.coalesce("away", F.lit(0)).alias("away"),
    )


def _rows(found: DataFrame) -> DataFrame:
    """``found`` by ``t`` and ``block``: arrays ``all`` of ``ROW`` at most, numbered by ``row``."""
    sizes = found.groupBy("t", "block").agg(F.count("*").alias("n"))
    large = written(sizes.filter(F.col("n") > CHUNK), "large-blocks")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.coalesce("n", F.lit(1)) / CHUNK)).alias("part")
    one = F.struct(*[c for c in found.columns if c not in ("t", "block")]).alias("one")
    parts = found.join(large, ["t", "block"], "left").select("t", "block", part, one)
    parts = parts.groupBy("t", "block", "part").agg(F.collect_list("one").alias("all"))
    at = F.explode(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / ROW).cast("int"))).alias("at")
    return parts.select("t", "block", "part", "all", at).select(
        "t", "block", F.struct("part", "at").alias("row"),
        F.slice("all", F.col("at") * ROW + 1, F.lit(ROW)).alias("all"),
    )


def _row_links(near_by: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges that connect what the queries' masks of ``near_by`` say is near them.

    Masks of a row that have a bit in common hang together by its fingerprint: they are joined, and
    what is left is a star per mask. Each query is linked to the first of its mask.
    """
    near_by = near_by.filter("mask <> 0")
    key = ["t", "block", "row"]
    masks = near_by.groupBy(*key).agg(F.collect_set("mask").alias("masks"))
    either = lambda x, y: x.bitwiseOR(y)
    apart = F.aggregate(
        "masks",
        F.array().cast("array<bigint>"),
        lambda done, m: F.concat(
            F.filter(done, lambda x: x.bitwiseAND(m) == 0),
            F.array(F.aggregate(F.filter(done, lambda x: x.bitwiseAND(m) != 0), m, either)),
        ),
    )
    named = rows.select(*key, F.transform("all", lambda one: one.getField("node")).alias("nodes"))
    bit = lambda mask, i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(1)
    stars = masks.select(*key, F.explode(apart).alias("mask")).filter(F.bit_count("mask") > 1)
    stars = stars.join(named, key).select(
        F.filter("nodes", lambda _, i: bit(F.col("mask"), i) == 1).alias("nodes")
    )
    stars = stars.select(F.get("nodes", F.lit(0)).alias("a"), F.explode("nodes").alias("b"))
    return near_by.select("query", "first").union(stars.filter("a <> b"))


def near_groups(
    index: DataFrame,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    words: Sequence[str] = ("own", "more"),
) -> tuple[DataFrame, DataFrame]:
    """Of the queries of ``index`` (see ``clustered``), how many are near, and links.

    The first table has (node, n_near), the sum of ``of`` within ``radius`` of each query. The
    second has edges (a, b) whose components are those of all (query, found) pairs.

    Queries meet clusters, not fingerprints, so a group of near copies does not become all its
    pairs. Those so close to the pivot that the two distances add up to ``radius`` at most are
    near, those whose distances differ by more are not; only what lies between is compared, in
    arrays of about ``CHUNK`` fingerprints. Fingerprints that are in no cluster are met in arrays,
    too, ``ROW`` of a block at once, so a group too wide for clusters isn't all its pairs either.
    """
    p_words, q_words = [f"p_{w}" for w in words], [f"q_{w}" for w in words]
    placed = written(clustered(index, radius, blocks, words), "clustered")
    steps = range(radius // 2 + 1)
    at_each = [F.sum(F.when(F.col("away") == d, F.col("of")).otherwise(0)) for d in steps]
    clusters = placed.groupBy("pivot").agg(
        F.max("away").alias("span"), F.count("*").alias("size"), F.array(*at_each).alias("sizes")
    )
    clusters = written(clusters.filter(F.col("size") >= CLUSTER), "clusters")
    members = with_totals(placed, clusters.select("pivot", "span"), "pivot")
    alone = placed.join(clusters.select("pivot"), "pivot", "left_anti")

    found = _blocks(members.select("pivot", *p_words, "span", *words), radius, blocks, words, False)
    # What stands for a cluster counts for none by itself; its sizes are added below.
    found = found.select(
        "t", "block", F.col("pivot").alias("node"),
        *[F.col(p).alias(w) for p, w in zip(p_words, words)],
        F.lit(0).cast("bigint").alias("of"), "span",
    ).distinct()
    single = _blocks(alone.select("node", *words, "of"), radius, blocks, words, False).select(
        "t", "block", "node", *words, "of", F.lit(0).alias("span")
    )
    rows = written(_rows(single.unionByName(found)), "rows-of-blocks")
    queries = index.filter("asks").select("node", *words)
    # Spark doesn't count that a table has many rows per fingerprint, and would broadcast it.
    asked = _blocks(queries, radius, blocks, words, True).select(
        F.col("node").alias("query"), *[F.col(w).alias(q) for w, q in zip(words, q_words)],
        "t", "block",
    ).hint("merge")

    def far(one: Column) -> Column:
        return _apart([F.col(q) for q in q_words], [one.getField(w) for w in words])

    def is_met(one: Column) -> Column:
        """Within reach, and, if not a cluster, in no table before this one."""
        differ = [F.col(q).bitwiseXOR(one.getField(w)) for q, w in zip(q_words, words)]
        early = [
            (F.col("t") > t) & (F.bit_count(_block(differ[word], low, high)) <= most)
            for t, word, low, high, most in _cuts(radius, blocks, len(words))
        ]
        first = (one.getField("of") == 0) | ~reduce(lambda x, y: x | y, early)
        return (far(one) <= radius + one.getField("span")) & first

    single = lambda one: (one.getField("of") > 0) & is_met(one)
    bit = lambda one, i: F.when(
        single(one), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)
    ).otherwise(F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    ones = F.filter("all", single)
    near_by = asked.join(rows, ["t", "block"]).filter(F.exists("all", is_met)).select(
        "query", *q_words, "t", "block", "row",
        F.aggregate(F.transform("all", bit), zero, lambda x, y: x.bitwiseOR(y)).alias("mask"),
        F.get(ones, F.lit(0)).getField("node").alias("first"),
        F.aggregate(ones, zero, lambda n, x: n + x.getField("of")).alias("n"),
        F.transform(
            F.filter("all", lambda one: (one.getField("of") == 0) & is_met(one)),
            lambda one: F.struct(
                one.getField("node").alias("pivot"), one.getField("span"), far(one).alias("far")
            ),
        ).alias("clusters"),
    )
    near_by = written(near_by, "met-rows")
    met = near_by.filter(F.size("clusters") > 0).select(
        "query", *q_words, F.explode("clusters").alias("c")
    ).select("query", *q_words, "c.*").toDF("query", *q_words, "pivot", "span", "far").distinct()
    met = written(met, "met-clusters")

    inner = with_totals(met.drop("span"), clusters.select("pivot", "sizes"), "pivot")
    sure = F.slice("sizes", F.lit(1), F.greatest(F.lit(0), radius - F.col("far") + 1))
    sure = F.aggregate(sure, F.lit(0).cast("bigint"), lambda total, n: total + n)
    counts = inner.select(F.col("query").alias("node"), sure.alias("n"))
    counts = counts.unionByName(near_by.select(F.col("query").alias("node"), "n"))
    # All of a cluster this far from its pivot hang together by the query that is next to it.
    reach = met.groupBy("pivot").agg((radius - F.min("far")).alias("reach"))
    reach = written(reach, "reach")

    partly = met.filter(F.col("far") + F.col("span") > radius)
    asked_for = partly.select("pivot").distinct().join(reach, "pivot").join(
        clusters.select("pivot", "size"), "pivot"
    )
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / CHUNK)).alias("part")
    one = F.struct("node", *words, "of", "away").alias("one")
    chunks = with_totals(members.filter("away > 0"), asked_for, "pivot").select(
        "pivot", "reach", part, one
    )
    chunks = chunks.groupBy("pivot", "reach", "part").agg(F.collect_list("one").alias("all"))

    def is_close(one: Column) -> Column:
        apart = _apart([F.col(q) for q in q_words], [one.getField(w) for w in words])
        return (one.getField("away") + F.col("far") > radius) & (apart <= radius)

    compared = partly.select("query", *q_words, "pivot", "far").join(chunks, "pivot").select(
        "query", "pivot", "reach", F.filter("all", is_close).alias("close")
    ).filter(F.size("close") > 0)
    compared = written(compared, "compared")
    more = F.aggregate(
        "close", F.lit(0).cast("bigint"), lambda total, one: total + one.getField("of")
    )
    counts = counts.unionByName(compared.select(F.col("query").alias("node"), more.alias("n")))
    counts = counts.groupBy("node").agg(F.sum("n").alias("n_near"))

    inside = F.exists("close", lambda one: one.getField("away") <= F.col("reach"))
    outside = F.filter("close", lambda one: one.getField("away") > F.col("reach"))
    links = (
        met.filter(F.col("far") <= radius).select("query", "pivot")
        .union(with_totals(members, reach, "pivot").filter("away <= reach").select("pivot", "node"))
        .union(compared.filter(inside).select("query", "pivot"))
        .union(compared.select("query", F.explode(outside).alias("o")).select("query", "o.node"))
        .union(_row_links(near_by, rows))
    )
    return counts, links.toDF("a", "b")


# --- each document and the next one -----------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, known, text_hash) names a document; NULL ids sort first."""
    text = F.coalesce("text", F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    return docs.select(
        F.coalesce(doc, F.lit(-(1 << 63))).alias("doc"),
        doc.isNotNull().cast("int").alias("known"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


_KEY = ["known", "doc", "text_hash"]


def neighbours(docs: DataFrame) -> DataFrame:
    """Per document: copies, code points, the next one's key, the last one's key and length."""
    named = _keyed(docs).select(*_KEY, F.char_length("text").cast("bigint").alias("n_chars"))
    distinct = named.groupBy(*_KEY).agg(
        F.max("n_chars").alias("n_chars"), F.count("*").alias("copies")
    )
    # Range partitions are in order; their numbers are fixed by writing them down.
    ranged = distinct.repartitionByRange(*_KEY).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "in-order")
    row = F.struct(*_KEY, "n_chars")
    within = Window.partitionBy("part").orderBy(*_KEY)
    # One row per partition: bounded by their number.
    edges = ranged.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    around = edges.select(
        "part",
        F.coalesce(F.lead("first").over(order), F.first("first").over(whole)).alias("after"),
        F.coalesce(F.lag("last").over(order), F.last("last").over(whole)).alias("before"),
    )
    return (
        ranged.withColumns({"next": F.lead(row).over(within), "last": F.lag(row).over(within)})
        .join(F.broadcast(around), "part")
        .select(
            *_KEY,
            "n_chars",
            "copies",
            F.coalesce("next", "after").alias("next"),
            F.coalesce("last", "before").alias("last"),
        )
    )


def edited_texts(docs: DataFrame) -> DataFrame:
    """Each text, and it with its last quarter replaced by the next document's beginning."""
    around = neighbours(docs).hint("shuffle_hash")
    texts = _keyed(docs).join(around, _KEY)
    lent = F.floor(F.col("last.n_chars") / 4).cast("int")
    heads = texts.select(
        *[F.col("last").getField(c).alias(c) for c in _KEY],
        F.substr("text", F.lit(1), lent).alias("head"),
    ).dropDuplicates(_KEY)
    gone = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substr("text", F.lit(1), (F.col("n_chars") - gone).cast("int"))
    return texts.join(heads, _KEY).withColumn("edited", F.concat(kept, "head"))


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of each text and its edited text, with likenesses.

    ``n_near`` tells how many documents lie within ``radius`` of 128 bits, itself included, where
    the id is divisible by 50 (the queries of the search); else it is NULL. ``near_class`` is the
    least id that these finds link a document to, or that of its exact copies.
    """
    next_key = [F.col("next").getField(c).alias(f"next_{c}") for c in _KEY]
    both = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")),
    )
    key = [*_KEY, "n_chars", "copies", *(f"next_{c}" for c in _KEY), "edited_sha256"]
    texts = (
        edited_texts(docs)
        .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
        .select(*_KEY, "n_chars", "copies", *next_key, "edited_sha256", F.explode(both).alias("t"))
        .select(*key, "t.kind", "t.text")
    )
    made = with_fingerprints(texts, *key, "kind")
    pair = made.groupBy(*key).agg(
        F.max(F.when(F.col("kind") == 0, F.col("bits"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("bits"))).alias("other"),
    )
    # Each written by itself, so that no task holds the texts and both sums.
    pair = written(pair, "fingerprints")
    more = with_fingerprints(_keyed(docs), *_KEY, again=True).withColumnRenamed("bits", "more")
    more = written(more, "more-bits")
    pair = pair.join(more, _KEY).withColumn("node", F.xxhash64("own", "more"))
    pair = written(pair, "wide-fingerprints")
    following = pair.select(
        *[F.col(c).alias(f"next_{c}") for c in _KEY], F.col("own").alias("next_own")
    )
    # Neither column is NULL here.
    is_query = (F.col("known") == 1) & (F.col("doc") % 50 == 0)
    nodes = pair.groupBy("node").agg(
        F.min(F.struct("own", "more")).alias("bits"),
        F.sum("copies").alias("of"),
        F.max(is_query).alias("asks"),
        F.min(F.when(F.col("known") == 1, F.col("doc"))).alias("least"),
    )
    nodes = written(nodes.select("node", "bits.*", "of", "asks", "least"), "nodes-of-fingerprints")
    sizes, edges = near_groups(nodes.drop("least"), radius)
    links = connected_components(edges)
    heads = links.select(F.col("component").alias("id"), "component").distinct()
    members = written(links.unionByName(heads).withColumnRenamed("id", "node"), "near-members")
    first = members.join(nodes, "node").groupBy("component").agg(F.min("least").alias("first"))
    classes = with_totals(members, first, "component").select("node", "first")
    told = nodes.join(classes, "node", "left").join(sizes, "node", "left").select(
        "node", "n_near", F.coalesce("first", "least").alias("near_class")
    )
    return (
        with_totals(pair, told, "node")
        .withColumn("n_near", F.when(is_query, F.col("n_near")))
        .join(following, [f"next_{c}" for c in _KEY])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            F.when(F.col("known") == 1, F.col("doc")).alias("doc_id"),
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("other")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
            "n_near",
            "near_class",
        )
    )
