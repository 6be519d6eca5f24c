"""Packing tokenized documents into sequences by bounded-space online best fit.

Each task reads its documents once and keeps a fixed number of open windows. A
piece goes into the open window it fills best; if none has room, the fullest is
topped up by cutting the piece and emitted. What is still open at a task's end is
packed again the same way, many tasks' leftovers at a time, until one task is left.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.bpe import Memory, slices
from seasonlab.llm.common import bound_batches, scratch_table

OPEN_WINDOWS = 64
#: Tasks whose leftovers meet in one task of the next round.
FAN_IN = 16
#: A gap below this many tokens is padded, not filled with a scrap of the next document.
LEAST_CUT = 8
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, open boolean, bin bigint"
FLUSH_BYTES = 8 << 20
#: Stands between words that are encoded as one text; words that hold it are encoded one by one.
MARK, MARKED_TOGETHER = "\x01", 4096
#: Where a mark of ASCII punctuation (no apostrophe) follows a lower-case letter of Latin-1.
BEHIND_A_LETTER = re.compile(rb"(?:(?<=[a-z])|(?<=\xc3[\x9f-\xb6\xb8-\xbf]))(?=[!-&(-/:-@\[-`{-~])")
#: Capitals of Latin-1 outside ASCII, and what makes each lower case.
CAPITAL, SMALL = re.compile(rb"\xc3[\x80-\x96\x98-\x9e]"), {bytes([0xC3, b]): bytes([0xC3, b + 32]) for b in range(0x80, 0x9F)}
#: Distinct words whose ids a Python worker remembers (and at least those of the texts that are encoded together).
REMEMBERED_WORDS = 400_000


class Tokenizer:
    """Ids of whole texts by a ``tokenizers`` file.

    ``by_word``: the tokenizer composes characters (NFC), lower-cases, drops white space
    and never looks across it, nor from a letter to the punctuation behind it. Then each distinct
    word is encoded once, without case and punctuation where these can't matter, and
    remembered in a bounded cache. Otherwise whole texts are encoded.
    """

    def __init__(self, path: str, by_word: bool) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer as Library

        self.library, self.by_word, self.memory = Library.from_file(path), by_word, Memory(REMEMBERED_WORDS)
        mark = self.library.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    @classmethod
    @functools.lru_cache(maxsize=2)
    def load(cls, path: str, by_word: bool) -> Tokenizer:
        return cls(path, by_word)

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Many words in one text, with a mark between them whose id no word without it has."""
        if self.mark is None or len(words) == 1 or any(MARK in w for w in words):
            return self._encode(words)
        ids = np.array(self._encode_text(f" {MARK} ".join(words)), "<u4")
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(words) - 1:
            return self._encode(words)
        whole, stops = ids.tobytes(), (4 * ends).tolist()
        return [whole[a:b] for a, b in zip([0, *(s + 4 for s in stops)], [*stops, len(whole)], strict=True)]

    def _encode_text(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text."""
        if not self.by_word:
            return self._encode(texts)
        rows = pc.ascii_split_whitespace(pa.array([_spaced(t) for t in texts], pa.large_string()))
        words = rows.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.large_binary()).to_pylist()
        unknown = self.memory.unknown([distinct])
        for lo in range(0, len(unknown), MARKED_TOGETHER):
            some = unknown[lo : lo + MARKED_TOGETHER]
            self.memory.update(zip(some, self._encode_words([w.decode() for w in some]), strict=True))
        ids = pa.array([self.memory[w] for w in distinct], pa.large_binary()).take(words.indices)
        ends = np.r_[0, np.cumsum(pc.binary_length(ids).to_numpy())][rows.offsets.to_numpy()].tolist()
        whole = ids.buffers()[2].to_pybytes()[: ends[-1]] if ends[-1] else b""
        return [whole[a:b] for a, b in itertools.pairwise(ends)]


def _spaced(text: str) -> bytes:
    """The text such that a ``by_word`` tokenizer encodes its stretches between ASCII white space like the text.

    Capitals of Latin-1 become lower case, and a mark of punctuation behind a letter starts a stretch of
    its own, unless the text isn't composed (either way) or may hold a special token.
    """
    raw = text.encode("utf-8", "replace")
    lower = raw.lower()  # A-Z only
    if not raw.isascii():
        lower = CAPITAL.sub(lambda m: SMALL[m[0]], lower)
    plain = raw.isascii() or (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", lower.decode()))
    return BEHIND_A_LETTER.sub(b" ", lower) if plain and b"<|" not in raw else raw


class Packer:
    """Open windows of one task; rows of emitted windows gather in ``rows``."""

    def __init__(self, size: int, first_id: int, bin_: int, most: int = OPEN_WINDOWS) -> None:
        self.size, self.most, self.bin = size, most, bin_
        self.ids = itertools.count(first_id)
        self.gaps: list[tuple[int, int]] = []  # (room left, window), sorted
        self.windows: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []
        self.bytes = 0

    def _emit(self, window: int, pieces: list[tuple], open_: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, total, window, offset, open_, self.bin))
            self.bytes += len(ids)
            offset += n

    def _put(self, at: int, piece: tuple) -> None:
        """Into the open window at ``at`` of the gaps, which has room."""
        gap, window = self.gaps.pop(at)
        self.windows[window].append(piece)
        gap -= len(piece[2]) // 4
        if gap:
            bisect.insort(self.gaps, (gap, window))
        else:
            self._emit(window, self.windows.pop(window))

    def place(self, doc_id: int | None, start: int, ids: bytes, total: int) -> None:
        size = self.size
        while len(ids) // 4 >= size:
            self._emit(next(self.ids), [(doc_id, start, ids[: 4 * size], total)])
            start, ids = start + size, ids[4 * size :]
        while ids:
            n = len(ids) // 4
            at = bisect.bisect_left(self.gaps, (n, -1))
            if at < len(self.gaps):
                self._put(at, (doc_id, start, ids, total))
                return
            if len(self.windows) < self.most:
                window = next(self.ids)
                self.windows[window] = []
                bisect.insort(self.gaps, (size, window))
                continue
            gap, window = self.gaps[0]
            if gap >= LEAST_CUT:
                self._put(0, (doc_id, start, ids[: 4 * gap], total))
                start, ids = start + gap, ids[4 * gap :]
            else:
                self.gaps.pop(0)
                self._emit(window, self.windows.pop(window))

    def leave(self) -> None:
        """The open windows as leftovers."""
        for window, pieces in self.windows.items():
            self._emit(window, pieces, open_=True)
        self.windows, self.gaps = {}, []

    def close(self) -> None:
        """The open windows, the emptiest cut up to fill the fullest: only the last has padding to speak of."""
        while self.gaps:
            gap, window = self.gaps.pop(0)
            pieces = self.windows.pop(window)
            while gap and self.gaps:
                room, last = self.gaps.pop()
                doc_id, start, ids, total = self.windows[last].pop()
                n = min(gap, len(ids) // 4)
                pieces.append((doc_id, start, ids[: 4 * n], total))
                gap -= n
                if 4 * n < len(ids):
                    self.windows[last].append((doc_id, start + n, ids[4 * n :], total))
                if self.windows[last]:
                    bisect.insort(self.gaps, (room + n, last))
                else:
                    del self.windows[last]
            self._emit(window, pieces)

    def batch(self) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "open", "bin"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(names)
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        self.rows, self.bytes = [], 0
        return out


def pack_documents(
    docs: DataFrame, tokenizer_path: str, *, sequence_tokens: int = 2048, end_id: int = 1, by_word: bool = True, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``: the pieces of all documents.

    A document is its text's ids (null or empty: none), then ``end_id``; special
    tokens' strings in a text count as the tokenizer file has them. ``ids`` holds
    the piece's ids as little-endian unsigned 32-bit numbers. Within a sequence the
    pieces lie without gaps from offset 0. Repeated rows, rows with the same id and
    a null id are packed each on their own; other columns are not read.

    The packed table is written once to the shared folder, as which window a piece
    gets depends on the order of reading; at most OPEN_WINDOWS windows a task
    move on to the next round.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.load(tokenizer_path, by_word)
        task = TaskContext.get().partitionId()
        packer = Packer(sequence_tokens, task << 32, task)
        for batch in batches:
            for part in slices(batch, 1):
                for doc_id, ids in zip(part.column(0).to_pylist(), tokenizer.encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    packer.place(doc_id, 0, ids, len(ids) // 4)
                    if packer.bytes > FLUSH_BYTES:
                        yield packer.batch()
        packer.leave()
        yield packer.batch()

    table = scratch_table(rows.mapInArrow(pack, SCHEMA), "packed")
    columns = [F.col(c) for c in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")]
    done = table.where("NOT open").select(*columns)
    most = table.agg(F.max("bin").alias("most")).first()["most"]
    if most is None:
        return done
    tasks, turn = most + 1, 1
    while True:
        bins = -(-tasks // FAN_IN)
        table = scratch_table(_again(table, sequence_tokens, turn, bins), f"packed-{turn}")
        done = done.union(table.where("NOT open").select(*columns))
        if bins == 1:
            return done
        tasks, turn = bins, turn + 1


def _again(table: DataFrame, size: int, turn: int, bins: int) -> DataFrame:
    """Pack the leftovers of FAN_IN bins as one bin; the last bin closes its windows."""
    left = table.where("open").withColumn("bin", F.floor(F.col("bin") / FAN_IN))
    left = left.repartition(bins, "bin") if bins > 1 else left.coalesce(1)
    left = left.sortWithinPartitions("bin", F.col("length").desc(), "sequence_id", "offset")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None

        def end() -> pa.RecordBatch:
            packer.close() if bins == 1 else packer.leave()
            return packer.batch()

        for batch in batches:
            c = batch.to_pydict()
            for bin_, doc_id, start, ids, total in zip(c["bin"], c["doc_id"], c["start"], c["ids"], c["doc_tokens"], strict=True):
                if packer is None or packer.bin != bin_:
                    if packer is not None:
                        yield end()
                    packer = Packer(size, turn << 56 | bin_ << 32, bin_)
                packer.place(doc_id, start, ids, total)
                if packer.bytes > FLUSH_BYTES:
                    yield packer.batch()
        if packer is not None:
            yield end()

    return left.mapInArrow(pack, SCHEMA)
