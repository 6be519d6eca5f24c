"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by the vocabulary's pattern; each is merged on its
own by the queue of rank_queue.py, all new ones of a batch together.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from seasonlab.llm.common import bound_batches, own_names
from seasonlab.llm.rank_queue import MergeTable, packed

#: Pieces of text whose ids a Python worker remembers (and at least those of the texts that are encoded together).
REMEMBERED = 240_000
#: Characters of text that are encoded together.
TOGETHER = 6_000_000
#: White space before which a single space is no start of a pre-token, and rarer white space.
AFTER_SPACE = (" \t", " \n", " \v", " \f", " \r")
RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Memory(dict):
    """Ids of pieces of text: a bounded cache that forgets all when it is full."""

    def __init__(self, most: int = REMEMBERED) -> None:
        super().__init__()
        self.most = most

    def unknown(self, rows: Iterable[Sequence]) -> list:
        """The distinct pieces of the rows that must be encoded and added, so that the memory holds all of them."""
        new = set(itertools.filterfalse(self.__contains__, itertools.chain.from_iterable(rows)))
        if new and len(self) + len(new) > self.most:
            self.clear()
            new = set(itertools.chain.from_iterable(rows))
        return list(new)


def slices(batch: pa.RecordBatch, column: int, most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes of the string column, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        before = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def gathered(batches: Iterable[pa.RecordBatch], column: int, most: int = TOGETHER) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about ``most`` bytes of the string column."""
    waiting, size = [], 0
    for batch in batches:
        for part in slices(batch, column, most):
            waiting.append(part)
            size += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if size >= most:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


class ByteBPE:
    """A byte-level vocabulary: token bytes and their ranks, which are also their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        of_id = {i: token for token, i in ranks.items()}
        self.token_bytes = pa.array([of_id.get(i) for i in range(max(of_id) + 1)], pa.large_binary())
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # the rank of a pair is that of the token its bytes make
        pairs = [
            (ranks[token[:cut]], ranks[token[cut:]], i)
            for token, i in ranks.items() for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.table = MergeTable(left, right, rank, np.arange(max(ranks.values()) + 1))
        self.words, self.pieces = Memory(), Memory()

    @classmethod
    @functools.lru_cache(maxsize=4)
    def load(cls, path: str, pattern: str) -> ByteBPE:
        """Read a rank file: a base64 token and its rank a line. Kept for the life of a worker."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        return cls(ranks, pattern)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of pre-tokens."""
        whole = np.frombuffer(b"".join(words), np.uint8)
        return packed(*self.table.merge(self.byte_ids[whole], np.array([len(w) for w in words], np.int64)))

    def _remember_words(self, rows: Sequence[Sequence[str]]) -> None:
        unknown = self.words.unknown(rows)
        self.words.update(zip(unknown, self.merge_words([w.encode("utf-8", "replace") for w in unknown]), strict=True))

    def _remember_pieces(self, rows: Sequence[Sequence[str]]) -> None:
        """Ids of pieces, each of which stands after a single space."""
        unknown = self.pieces.unknown(rows)
        if not unknown:
            return
        # one text again: a word of it starts with a space just where a piece does
        words = self.pattern.findall(" " + " ".join(unknown))
        self._remember_words([words])
        parts = list(map(self.words.__getitem__, words))
        starts = [i for i, w in enumerate(words) if w[0] == " "]
        self.pieces.update(
            (p, parts[a] if b - a == 1 else b"".join(parts[a:b])) for p, a, b in zip(unknown, starts, [*starts[1:], len(words)], strict=True)
        )

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of whole texts, each as little-endian 32-bit numbers.

        A single space before something else than white space always starts a
        pre-token, so what lies between such spaces is looked up whole; a text's
        first piece, and a text with longer runs of white space, are split by the
        pattern alone.
        """
        rows, plain = [], []
        for text in texts:
            row = text.split(" ")
            even = "" not in row and not any(s in text for s in AFTER_SPACE) and RARE_SPACE.search(text) is None
            plain.append(even)
            rows.append(row if even else self.pattern.findall(text))
        # a text's first piece, or all of it, by the pattern; its other pieces
        firsts = [self.pattern.findall(r[0]) if even else r for r, even in zip(rows, plain, strict=True)]
        rests = [r[1:] if even else () for r, even in zip(rows, plain, strict=True)]
        self._remember_words(firsts)
        heads = [b"".join(map(self.words.__getitem__, first)) for first in firsts]
        self._remember_pieces(rests)
        return [b"".join([head, *map(self.pieces.__getitem__, rest)]) for head, rest in zip(heads, rests, strict=True)]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes that each list of ids stands for; a null list stands for none, an unknown id raises."""
        offsets = ids.offsets.to_numpy()
        flat = ids.values.slice(offsets[0], offsets[-1] - offsets[0])
        if flat.null_count or (len(flat) and (pc.min(flat).as_py() < 0 or pc.max(flat).as_py() >= len(self.token_bytes))):
            raise ValueError("an id is in no token of the vocabulary")
        taken = self.token_bytes.take(flat)
        if taken.null_count:
            raise ValueError("an id is in no token of the vocabulary")
        # the tokens' bytes lie one after the other: a text ends where its last token does
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
        bounds = ends[offsets - offsets[0]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(bounds.tobytes()), taken.buffers()[2]]).cast(pa.binary())


def _lists(rows: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, *, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns with ``ids`` (array of int) of every whole text; null and empty texts have none.

    Rows that repeat are encoded each, and alike; very long texts whole; an empty table gives no
    rows. A ``keep`` column that bears the name ``ids`` raises ValueError.
    """
    own_names(docs, keep, ["ids"])
    bound_batches(docs.sparkSession)
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    names = rows.columns[:-1]
    schema = rows.drop("__text").schema.add("ids", ArrayType(IntegerType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.load(ranks_path, pattern)
        for parts in gathered(batches, len(names)):
            ids, at = bpe.encode([text for part in parts for text in part.column(len(names)).to_pylist()]), 0
            for part in parts:
                own = _lists(ids[at : at + part.num_rows])
                at += part.num_rows
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), own], [*names, "ids"])

    return rows.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str, *, ids_col: str = "ids") -> DataFrame:
    """All columns with ``decoded``: the bytes that the ids stand for. Null ids decode to nothing; an unknown id raises."""
    schema = encoded.withColumn("decoded", F.lit(b"")).schema
    at = encoded.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE.load(ranks_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([*part.columns, bpe.decode(part.column(at))], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(decode, schema)
