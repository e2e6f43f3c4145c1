"""SentencePiece encoding of merge-type (BPE) models by a prefix table, and decoding.

Of every prefix of a text only the last token of its encoding is stored. A token that ends
where the prefix ends (an automaton finds all of them) is that one if what comes before it
ends in a token with which it is compatible: encoding the two texts together gives just these
two tokens. Exactly one token passes; the ids are read backwards from the end.

The text is cut where no token can reach across: before a run of spaces and around line ends,
as long as no token of the vocabulary has a space after another character. Equal parts are
encoded once per worker (a bounded cache).

Edge cases: a NULL text is an empty one, which has the begin and the end id only. Characters
without a token become byte tokens. Rows are encoded one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.texts import WordCache, columns_out, sliced

SPACE = "▁"  # stands for a space in the vocabulary


class PrefixTable:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end = model.bos_id(), model.eos_id()
        size = model.get_piece_size()
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = set(self.byte_ids)
        self.ids: dict[str, int] = {}
        self.pieces: dict[int, str] = {}
        self.rank: dict[str, float] = {}
        for i in range(size):
            if i in special or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            self.ids[piece], self.pieces[i], self.rank[piece] = i, piece, -model.get_score(i)
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            raise ValueError("a token has a space inside: texts can't be cut at spaces")
        ends = "" if any("\n" in piece for piece in self.ids) else "\n"
        self.parts = re.compile(f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+" + f"|{ends}+" * bool(ends))
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.cache = WordCache(self._part_bytes, most=48 << 20)

    def merged(self, text: str) -> list[str]:
        """Short texts by the definition: the best-ranked neighbours merge, leftmost first."""
        symbols = list(text)
        while len(symbols) > 1:
            pairs = [a + b for a, b in zip(symbols, symbols[1:])]
            best = min(pairs, key=lambda pair: self.rank.get(pair, np.inf))
            if best not in self.rank:
                break
            at = pairs.index(best)
            symbols[at : at + 2] = [best]
        return symbols

    def fit(self, left: int, right: int) -> bool:
        """Whether two neighbours stay apart; without a left one (-1): whether ``right`` is
        the encoding of its own text."""
        texts = [self.pieces[i] for i in (left, right) if i >= 0]
        if len(self.fits) >= 1_500_000:
            self.fits.clear()
        found = self.fits[left << 24 | right] = self.merged("".join(texts)) == texts
        return found

    def part_ids(self, text: str) -> list[int]:
        n = len(text)
        # Per prefix: its last token, or -1 for a character without one; and where it starts.
        last, begins = [-1] * (n + 1), list(range(-1, n))
        fits = self.fits
        for end, (i, length) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length]
            fit = fits.get(before << 24 | i)
            if fit or fit is None and self.fit(before, i):
                last[end], begins[end] = i, end - length
        ids: list[int] = []
        end = n
        while end:
            start = begins[end]
            if last[end] >= 0:
                ids.append(last[end])
            else:
                ids += [self.byte_ids[b] for b in reversed(text[start:end].encode("utf-8"))]
            end = start
        return ids[::-1]

    def _part_bytes(self, text: str) -> bytes:
        return np.array(self.part_ids(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """All ids, begin and end included, as little-endian unsigned 32-bit integers."""
        edge = np.array([self.begin, self.end], "<u4").tobytes()
        if not text:
            return edge
        parts = self.parts.findall(SPACE + text.replace(" ", SPACE))
        return edge[:4] + b"".join(map(self.cache.__getitem__, parts)) + edge[4:]

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    return PrefixTable(path)


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and all ids of every whole text, as little-endian 32-bit integers."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(path)
        for batch in sliced(batches):
            ids = [table.encode(text) for text in batch["text"].to_pylist()]
            yield columns_out(_IDS, {"doc_id": batch["doc_id"], "ids": ids})

    return _texts(docs).mapInArrow(encoded, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to (doc_id, ids)."""
    schema = pa.schema([*_IDS, ("decoded", pa.string())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(path)
        for batch in sliced(batches):
            texts = [table.decode(ids) for ids in batch["ids"].to_pylist()]
            columns = {"doc_id": batch["doc_id"], "ids": batch["ids"], "decoded": texts}
            yield columns_out(schema, columns)

    return encoded.select("doc_id", "ids").mapInArrow(
        decoded, "doc_id bigint, ids binary, decoded string"
    )


_DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded text.

    Encodes and decodes in one step, so that a task needs one worker and one table.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(path)
        for batch in sliced(batches):
            ids = [table.encode(text) for text in batch["text"].to_pylist()]
            columns = {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [sha256(table.decode(i).encode()).hexdigest() for i in ids],
            }
            yield columns_out(_DIGESTS, columns)

    fields = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _texts(docs).mapInArrow(both, fields)
