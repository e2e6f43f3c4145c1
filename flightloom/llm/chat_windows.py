"""Chat formatting in budgeted windows.

Prefix sums of the turns' tokens choose spans of whole turns that fit a token budget. Each
window after the first starts with the system turn and as many of the turns before it as a
history limit allows; the loss mask covers the assistant turns that the window adds, so each is
a target once. Control strings in texts are escaped, so the template can be read back exactly.

A conversation is cut into blocks of about ``block_bytes`` of text before that, so that one
that holds a third of all rows is formatted by many tasks. Almost all have one block, and move
in one shuffle.

Edge cases: NULL texts and roles are empty ones. Rows go by turn (NULL first), then by role and
a hash of the text; repeated rows are turns of their own. Rows without a conversation id are one
conversation. A turn longer than the budget has a window of its own, which is longer than the
budget. A system turn of more than a quarter of the budget is not repeated. An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.packing import token_ids
from flightloom.llm.texts import columns_out, sliced, written

BUDGET, HISTORY = 1024, 256
BLOCK_BYTES = 8 << 20
# Turns that a block may repeat from the block before, or as its system turn, have at most so
# many bytes for each token allowed.
TOKEN_BYTES = 16
# Tokens of the template around a role and a text; bytes that stand for them.
MARKS, MARK_BYTES = 4, 32
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, TARGET = "system", "assistant"

_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_SYSTEM_KIND, _HISTORY_KIND, _OWN_KIND = range(3)


def escape(text: str) -> str:
    """Without any control string: ``<|`` gets a backslash in between, ``<\\|`` one more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def spans(
    sizes: list[int], first: int, floor: int, system: int, opening: bool, budget: int, history: int
) -> Iterator[tuple[int, int, int]]:
    """(start of the history, first new turn, end) per window, by prefix sums of ``sizes``.

    New turns begin at ``first``; history reaches back to ``floor`` at most. Each window but the
    one that opens the conversation also holds ``system`` tokens.
    """
    sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at, n = first, len(sizes)
    while at < n:
        starts = opening and at == 0
        left = budget - (0 if starts else system)
        room = min(history, left - sizes[at])
        low = at
        if room > 0 and not starts:
            low = max(floor, int(np.searchsorted(sums, sums[at] - room, "left")))
        end = int(np.searchsorted(sums, sums[low] + left, "right")) - 1
        end = max(at + 1, end)
        yield low, at, end
        at = end


_WINDOWS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("window", pa.int32()),
        ("n_repeated", pa.int32()),
        ("n_new", pa.int32()),
        ("n_tokens", pa.int64()),
        ("formatted", pa.string()),
        ("loss_starts", pa.list_(pa.int64())),
        ("loss_lengths", pa.list_(pa.int64())),
    ]
)
WINDOWS = (
    "conv_id bigint, block bigint, window int, n_repeated int, n_new int, n_tokens bigint,"
    " formatted string, loss_starts array<bigint>, loss_lengths array<bigint>"
)


def block_windows(
    conv_id: int | None, block: int, turns: list[tuple], path: str, budget: int, history: int
) -> Iterator[tuple]:
    """The windows of one block's (kind, role, text), which are in order."""
    made = [(f"{START}{escape_role(role)}\n", escape(text)) for _, role, text in turns]
    # Each count has an end token, which stands for a mark.
    sizes = [
        len(token_ids(escape_role(role), path)) + len(token_ids(body, path)) + MARKS - 2
        for (_, role, _), (_, body) in zip(turns, made)
    ]
    kind, role, text = turns[0]
    opening = block == 0
    leads = kind == _SYSTEM_KIND or opening and role == SYSTEM
    limit = budget // 4
    repeated = leads and sizes[0] <= limit and len(text.encode()) <= TOKEN_BYTES * limit
    first = sum(kind != _OWN_KIND for kind, _, _ in turns)
    found = spans(
        sizes, first, int(leads), sizes[0] if repeated else 0, opening, budget, history
    )
    for number, (low, at, end) in enumerate(found):
        shown = [*([0] if repeated and at > 0 else []), *range(low, end)]
        out, starts, lengths, size = [], [], [], 0
        for k in shown:
            head, body = made[k]
            if k >= at and turns[k][1] == TARGET:
                starts.append(size + len(head))
                lengths.append(len(body))
            out += head, body, END, "\n"
            size += len(head) + len(body) + len(END) + 1
        n_tokens = sum(sizes[k] for k in shown)
        n_new = end - at
        yield (
            conv_id, block, number, len(shown) - n_new, n_new, n_tokens, "".join(out),
            starts, lengths,
        )


def _format(batches: Iterator[pa.RecordBatch], path: str, budget: int, history: int):
    """Windows of sorted rows (conv_id, block, kind, role, text), a block at a time."""

    def rows() -> Iterator[tuple]:
        key, turns = None, []
        for batch in sliced(batches, 8 << 20):
            columns = [batch[c].to_pylist() for c in ("conv_id", "block", "kind", "role", "text")]
            for conv_id, block, *turn in zip(*columns):
                if (conv_id, block) != key:
                    if turns:
                        yield from block_windows(*key, turns, path, budget, history)
                    key, turns = (conv_id, block), []
                turns.append(tuple(turn))
        if turns:
            yield from block_windows(*key, turns, path, budget, history)

    out, size = [], 0
    for row in rows():
        out.append(row)
        size += len(row[6])
        if size > 4 << 20 or len(out) >= 10_000:
            yield columns_out(_WINDOWS, dict(zip(_WINDOWS.names, zip(*out))))
            out, size = [], 0
    if out:
        yield columns_out(_WINDOWS, dict(zip(_WINDOWS.names, zip(*out))))


_ORDER = ("conv_id", "block", "kind", "turn", "role", "tie")


def _formatted(rows: DataFrame, by: list[str], path: str, budget: int, history: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _format(batches, path, budget, history)

    sorted_rows = rows.repartition(*by).sortWithinPartitions(*_ORDER)
    return sorted_rows.select("conv_id", "block", "kind", "role", "text").mapInArrow(run, WINDOWS)


def _blocks(rows: DataFrame, block_bytes: int, budget: int, history: int) -> DataFrame:
    """Rows of long conversations with their block, and the turns that a block may repeat.

    Rows are sorted in ranges; a row's block follows from the bytes before it: those in its
    range, and one sum per conversation for each range before.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "tie")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), "long-turns")
    slim = placed.select("conv_id", F.shiftrightunsigned("at", 33).alias("part"), "at", "bytes")
    sums = slim.groupBy("conv_id", "part").agg(F.sum("bytes").alias("sum"))
    earlier = F.sum("sum").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("sum")
    sums = sums.select(F.col("conv_id").alias("conv"), F.col("part").alias("range"), earlier.alias("earlier"))
    within = F.sum("bytes").over(Window.partitionBy("conv_id", "part").orderBy("at"))
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("range"))
    before = slim.withColumn("before", within - F.col("bytes")).join(sums, same)
    before = before.select("at", (F.col("earlier") + F.col("before")).alias("before"))
    found = placed.join(before, "at").withColumns(
        {
            "block": F.floor(F.col("before") / block_bytes).cast("bigint"),
            "kind": F.lit(_OWN_KIND),
        }
    )
    found = written(found, "long-blocks")
    to_next = (F.col("block") + 1) * block_bytes - F.col("before")
    past = found.filter(to_next <= min(block_bytes, TOKEN_BYTES * history)).withColumns(
        {"block": F.col("block") + 1, "kind": F.lit(_HISTORY_KIND)}
    )
    later = found.filter("block > 0").select(F.col("conv_id").alias("conv"), F.col("block").alias("later")).distinct()
    small = F.octet_length("text") <= TOKEN_BYTES * (budget // 4)
    system = found.filter((F.col("before") == 0) & (F.col("role") == SYSTEM) & small)
    system = system.join(later, F.col("conv_id").eqNullSafe(F.col("conv"))).withColumns(
        {"block": F.col("later"), "kind": F.lit(_SYSTEM_KIND)}
    )
    # A block without rows of its own, after a very long turn, repeats nothing.
    past = past.join(
        later, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("block") == F.col("later")), "left_semi"
    )
    # The system turn is never part of the history as well.
    past = past.filter(~((F.col("before") == 0) & (F.col("role") == SYSTEM)))
    names = [*_ORDER, "text"]
    return found.select(names).unionByName(past.select(names)).unionByName(system.select(names))


def format_parts(
    rows: DataFrame,
    path: str,
    budget: int = BUDGET,
    history: int = HISTORY,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The windows of conversations of one block, in which a conversation's rows follow one
    another within a partition, and those of longer ones, in no order."""
    turns = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = F.octet_length("role") + F.octet_length("text") + MARK_BYTES
    sums = turns.groupBy("conv_id").agg(F.sum(size.cast("bigint")).alias("bytes"))
    long = sums.filter(F.col("bytes") > block_bytes).select(F.col("conv_id").alias("conv"))
    long = written(long, "long-conversations")
    turns = turns.withColumns({"bytes": size.cast("bigint"), "tie": F.xxhash64("text")})
    same = F.col("conv_id").eqNullSafe(F.col("conv"))
    short = turns.join(long, same, "left_anti").withColumns(
        {"block": F.lit(0).cast("bigint"), "kind": F.lit(_OWN_KIND)}
    )
    whole = _formatted(short, ["conv_id"], path, budget, history)
    blocks = _blocks(turns.join(long, same, "left_semi"), block_bytes, budget, history)
    return whole, _formatted(blocks, ["conv_id", "block"], path, budget, history)


def format_conversations(rows: DataFrame, path: str, **options: int) -> DataFrame:
    """All windows: text, loss mask (starts and lengths in code points), counts of turns.

    ``rows`` has conv_id, turn, role and text; ``path`` names the vocabulary that counts tokens.
    """
    whole, split = format_parts(rows, path, **options)
    return whole.unionByName(split)


def read_window(text: str, n_repeated: int) -> list[tuple[str, str]]:
    """The (role, text) of a window's new turns."""
    turns = _TURN.findall(text)[n_repeated:]
    return [(unescape_role(role), unescape(body)) for role, body in turns]


class _Digest:
    """What is read back of one conversation, window by window."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, text: str, n_repeated: int, starts: list[int], lengths: list[int]) -> None:
        for role, body in read_window(text, n_repeated):
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode())
        for start, length in zip(starts, lengths):
            target = unescape(text[start : start + length])
            self.loss_chars += len(target)
            self.loss.update(target.encode())
        self.formatted_chars += len(text)


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []

    def finish(key: int | None, d: _Digest) -> None:
        hashes = d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest()
        done.append((key, d.n_turns, *hashes, d.formatted_chars))

    key, digest = None, None
    names = ("conv_id", "formatted", "n_repeated", "loss_starts", "loss_lengths")
    for batch in batches:
        for conv_id, *window in zip(*[batch[c].to_pylist() for c in names]):
            if digest is None or conv_id != key:
                if digest is not None:
                    finish(key, digest)
                key, digest = conv_id, _Digest()
            digest.add(*window)
        if len(done) >= 10_000:
            yield columns_out(_READ, dict(zip(_READ.names, zip(*done))))
            done.clear()
    if digest is not None:
        finish(key, digest)
    if done:
        yield columns_out(_READ, dict(zip(_READ.names, zip(*done))))


READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint,"
    " loss_sha256 string, formatted_chars bigint"
)


def read_in_place(windows: DataFrame) -> DataFrame:
    """Digests per conversation, whose windows follow one another in a partition."""
    return windows.mapInArrow(_read, READ)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation. A digest of all turns takes a conversation's windows one after
    the other in one task, which holds one at a time."""
    by = windows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    return read_in_place(by)
