"""Quality rules as a ledger: every rule is evaluated once and leaves one bit.

``ledger`` stores measurements and failure bits per document. Policies are versioned bit
masks applied to the stored bits, and ablations count documents per bit pattern: neither
reads a text again.

Edge cases: a NULL text is an empty one, which has no words and fails ``few_words``. Rows
are judged one by one, so repeated rows and NULL ids are judged like any other; an empty
table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.texts import columns_out, id_and_text, sliced, window_hashes, word_hashes

# Bit numbers in the ledger; a new rule takes the next free bit.
RULES = (
    "few_words",
    "repeated_windows",
    "symbols",
    "duplicate_lines",
    "upper_case",
    "word_length",
    "few_distinct_words",
    "few_distinct_in_windows",
)
BASE = ("few_words", "repeated_windows")
# A policy rejects a document that fails one of its rules. The share of distinct words in a whole
# text falls with its length, so v3 has the one in windows in its place.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "duplicate_lines"),
    "v2": RULES[:7],
    "v3": (*RULES[:6], "few_distinct_in_windows"),
}

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 8
# Words in a window that distinct words are counted in.
DISTINCT_WINDOW = 1000

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_letters",
    "n_distinct_words",
    "n_window_distinct",
)


def mask(policy: str) -> int:
    return sum(1 << RULES.index(rule) for rule in POLICIES[policy])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of 8 words found twice or more."""
    if len(words) <= WINDOW:
        return 0
    windows = window_hashes(word_hashes(words), WINDOW)
    ranked = np.sort(windows)
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(windows, again))
    steps = np.zeros(len(words) + 1, np.int64)
    steps[at] += 1
    steps[at + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(steps[:-1])))


def window_distinct(words: list[bytes]) -> int:
    """Distinct words of each window, the last one maybe shorter, added up."""
    starts = range(0, len(words), DISTINCT_WINDOW)
    return sum(len(set(words[at : at + DISTINCT_WINDOW])) for at in starts)


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def measure(text: bytes) -> dict[str, int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = text.translate(None, _SPACES)
    upper = _count(text, _UPPER)
    return {
        "n_words": len(words),
        "word_chars": len(letters.decode("utf-8")),
        "n_symbols": _count(letters, _SYMBOLS),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "n_upper": upper,
        "n_letters": upper + _count(text, _LOWER),
        "n_distinct_words": len(set(words)),
        "n_window_distinct": window_distinct(words),
    }


def failures(m: dict[str, int]) -> int:
    """The rules in the order of ``RULES``, one bit each."""
    n = m["n_words"]
    failed = (
        n < 20,
        100 * m["n_repeat_words"] > 30 * n,
        100 * m["n_symbols"] > 20 * n,
        100 * m["n_dup_lines"] > 50 * m["n_lines"],
        100 * m["n_upper"] > 50 * m["n_letters"],
        not 2 * n <= m["word_chars"] <= 20 * n,
        n >= 50 and 100 * m["n_distinct_words"] < 20 * n,
        n >= 50 and 100 * m["n_window_distinct"] < 20 * n,
    )
    return sum(1 << bit for bit, bad in enumerate(failed) if bad)


_LEDGER = pa.schema(
    [("doc_id", pa.int64()), ("rule_bits", pa.int32()), *((m, pa.int64()) for m in MEASURES)]
)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        found = [measure(text) for text in batch["text"].to_pylist()]
        columns = {m: [x[m] for x in found] for m in MEASURES}
        columns |= {"doc_id": batch["doc_id"], "rule_bits": [failures(x) for x in found]}
        yield columns_out(_LEDGER, columns)


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: its measurements and ``rule_bits``."""
    fields = ", ".join(["doc_id bigint", "rule_bits int", *(f"{m} bigint" for m in MEASURES)])
    return id_and_text(docs).mapInArrow(_judge, fields)


def apply_policy(ledger: DataFrame, policy: str) -> DataFrame:
    """Adds ``base_failed`` and the policy's ``kept`` from the stored bits."""
    bits = F.col("rule_bits")
    return ledger.withColumns(
        {
            "base_failed": bits.bitwiseAND(mask("base")) != 0,
            "kept": bits.bitwiseAND(mask(policy) | mask("base")) == 0,
        }
    )


def ablation(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule: documents that fail it, and that it alone keeps out under the policy."""
    patterns = ledger.groupBy("rule_bits").agg(F.count("*").alias("n"))
    active = F.col("rule_bits").bitwiseAND(mask(policy))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << b).alias("bit"))
                                for b, r in enumerate(RULES)])).alias("r")
    failed = F.col("rule_bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("n", active.alias("active"), "rule_bits", rules)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("active") == F.col("r.bit"), F.col("n"))), F.lit(0))
            .alias("n_only"),
        )
    )


def keep_documents(docs: DataFrame, policy: str) -> DataFrame:
    """The rows of ``docs``, all columns, that the policy keeps."""
    rejects = mask(policy) | mask("base")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = (text.as_py() or "" for text in batch["text"])
            kept = [not failures(measure(text.encode())) & rejects for text in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
