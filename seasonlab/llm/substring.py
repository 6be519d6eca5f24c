"""Removing passages that repeat, by suffix automata of reference shards.

Whole corpora are each other's reference here, so sending every shard's automaton
to every document would cost the square of the corpus. Documents instead meet
the shards that can match them: every window of 35 words has the smallest hash of
its eight-word runs as its anchor, equal windows have equal anchors, and the
windows of one anchor form a shard. Anchors that occur once are dropped. A shard's
passages become one suffix automaton that counts occurrences; streaming a passage
through it gives, at every word, the longest repeated match, and matches that
reach the window's length mark the words that go. A shard with many different
passages is halved by how far into the window the anchor lies, again and again:
the windows of a half share more words, which name the smaller shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from seasonlab.llm.bpe import slices
from seasonlab.llm.common import bound_batches, cut, own_names, row_key, scratch_folder
from seasonlab.llm.words import TOGETHER, runs_of, words_of

WINDOW_WORDS = 35
ANCHOR_WORDS = 8
#: Different passages of a shard above which it is halved.
HOT_PASSAGES = 256
STRIPPED = StructType().add("n_words", "long").add("n_removed", "long").add("removed", ArrayType(ArrayType(IntegerType()))).add("kept_text", "string")


class SuffixAutomaton:
    """All substrings of the word sequences added, with the number of places at which each occurs."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]
        self.count = [0]

    def add(self, words: list[bytes], times: int) -> None:
        """A sequence that occurs ``times`` times."""
        length, link, following, count = self.length, self.link, self.next, self.count
        last = 0
        for word in words:
            known = following[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                count[last] += times
                continue
            if known is not None:
                last = self._split(last, word, known)
                count[last] += times
                continue
            state = len(length)
            length.append(length[last] + 1)
            link.append(0)
            following.append({})
            count.append(times)
            p = last
            while p >= 0 and word not in following[p]:
                following[p][word] = state
                p = link[p]
            if p >= 0:
                q = following[p][word]
                link[state] = q if length[q] == length[p] + 1 else self._split(p, word, q)
            last = state

    def _split(self, p: int, word: bytes, q: int) -> int:
        """A copy of state q that holds only what is reached through p."""
        length, link, following = self.length, self.link, self.next
        copy = len(length)
        length.append(length[p] + 1)
        link.append(link[q])
        following.append(dict(following[q]))
        self.count.append(0)
        link[q] = copy
        while p >= 0 and following[p].get(word) == q:
            following[p][word] = copy
            p = link[p]
        return copy

    def total(self) -> None:
        """Sum the counts over suffix links, once all sequences are added."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeats(self, words: list[bytes], least: int) -> list[int]:
        """Starts of the windows of ``least`` words of a streamed sequence that occur at two places or more."""
        length, link, following, count = self.length, self.link, self.next, self.count
        state = matched = 0
        found = []
        for i, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            after = following[state].get(word)
            if after is None:
                continue
            state, matched = after, matched + 1
            while length[link[state]] >= least:  # the window's own state
                state = link[state]
                matched = length[state]
            if matched >= least and count[state] > 1:
                found.append(i + 1 - least)
        return found


def repeated_windows(passages: list[tuple[list[bytes], int]], least: int) -> list[list[int]]:
    """For each passage and its number of occurrences: the starts of the windows that occur anywhere else too."""
    automaton = SuffixAutomaton()
    for words, times in passages:
        automaton.add(words, times)
    automaton.total()
    return [automaton.repeats(words, least) for words, _ in passages]


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """The minimum or maximum of every ``width`` consecutive numbers."""
    done = 1
    while done * 2 <= width:
        x = best(x[: len(x) - done], x[done:])
        done *= 2
    return best(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


class _Anchors:
    """The windows of a string column and their anchors."""

    def __init__(self, column: pa.Array, window: int, anchor: int) -> None:
        self.words = words_of(column)
        self.row = np.repeat(np.arange(len(column)), np.diff(np.r_[0, self.words.ends]))
        self.wide = window - anchor + 1
        n = len(self.row) - window + 1
        if n <= 0:
            self.runs = np.zeros(0, np.uint64)
            self.least = np.zeros(0, np.uint64)
            self.sound = np.zeros(0, bool)
            return
        self.runs = runs_of(self.words.hashes(), anchor)
        self.least = _slide(self.runs, self.wide, np.minimum)
        self.sound = self.row[:n] == self.row[window - 1 :]

    def chosen(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, anchor, places)``: how often a row's anchors occur in it."""
        if not len(self.least):
            return np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0, int)
        pad = np.zeros(self.wide - 1, np.uint64)
        most = _slide(np.r_[pad, np.where(self.sound, self.least, 0), pad], self.wide, np.maximum)
        at = np.flatnonzero(most == self.runs)
        row, value = self.row[at], self.runs[at]
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]) if len(row) else np.zeros(0, int)
        return row[first], value[first], np.diff(np.r_[first, len(row)])

    def passages(self, window: int, wanted: np.ndarray) -> Iterator[tuple[int, int, int, int, bytes]]:
        """``(row, first window, anchor, anchor's word, words)`` of each stretch of windows with one of the wanted anchors at one place.

        A window that holds its anchor twice counts the first.
        """
        if not len(self.least):
            return
        row = self.row[: len(self.least)]
        new = np.r_[True, (self.least[1:] != self.least[:-1]) | (row[1:] != row[:-1]) | (self.sound[1:] != self.sound[:-1])]
        start = np.flatnonzero(new)
        stop = np.r_[start[1:], len(row)]
        ok = self.sound[start] & np.isin(self.least[start], wanted)
        data = self.words.data.tobytes()
        first_word = np.r_[0, self.words.ends]
        for a, b in zip(start[ok].tolist(), stop[ok].tolist(), strict=True):
            value = self.least[a]
            for place in (np.flatnonzero(self.runs[a : b + self.wide - 1] == value) + a).tolist():
                end = min(b, place + 1)
                if end > a:
                    text = data[self.words.start[a] : self.words.stop[end + window - 2]]
                    yield int(row[a]), a - int(first_word[row[a]]), int(value.astype(np.int64)), place - a, b" ".join(text.split())
                    a = end


Table = Callable[[DataFrame, str], DataFrame]


def repeated_spans(keyed: DataFrame, table: Table, *, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """``(key, starts)``: the windows of each text that occur anywhere else, by their first words' numbers.

    ``keyed`` has key (string; rows that share it have the same text) and text (not
    null). ``table`` writes a step's table, which the result reads. Windows are judged on the input; a window that occurs twice in one text
    counts, and so does one in a repeated row.
    """
    lean = keyed.select(F.xxhash64("key").alias("k"), "text")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                row, value, places = _Anchors(part.column(1), window, anchor).chosen()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.astype(np.int64)), part.column(0).take(pa.array(row)), pa.array(places.astype(np.int32))], ["anchor", "k", "places"]
                )

    chosen = lean.mapInArrow(anchors, "anchor bigint, k bigint, places int")
    again = chosen.groupBy("anchor").agg(F.sum("places").alias("places")).where("places > 1").select("anchor")
    wanted = chosen.select("anchor", "k").join(again, "anchor", "left_semi").groupBy("k").agg(F.collect_set("anchor").alias("anchors"))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                keys = part.column(0).to_pylist()
                values = np.unique(part.column(2).flatten().to_numpy()).astype(np.uint64)
                found = list(_Anchors(part.column(1), window, anchor).passages(window, values))
                row, start, value, place, words = zip(*found, strict=True) if found else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[r] for r in row], pa.string()), pa.array(start, pa.int32()), pa.array(value, pa.int64()),
                        pa.array(place, pa.int32()), pa.array(words, pa.binary()),
                    ],
                    ["key", "start", "shard", "place", "words"],
                )

    touched = keyed.select("key", "text", F.xxhash64("key").alias("k")).join(wanted, "k").select("key", "text", "anchors")
    placed = touched.mapInArrow(passages, "key string, start int, shard bigint, place int, words binary")
    placed = table(placed.withColumn("passage", F.xxhash64("words", "place")), "passages")
    found = _found(_different(placed.withColumn("times", F.lit(1)), table), table, window, window - anchor + 1)
    spread = placed.select("key", "start", "shard", "passage").join(found, ["shard", "passage"])
    return spread.groupBy("key").agg(F.flatten(F.collect_list(F.transform("found", lambda o: o + F.col("start")))).alias("starts"))


def _different(passages: DataFrame, table: Table) -> DataFrame:
    return table(passages.groupBy("shard", "passage", "place", "words").agg(F.sum("times").alias("times")), "different")


def _found(different: DataFrame, table: Table, window: int, width: int) -> DataFrame:
    """``(shard, passage, found)``: the repeated windows of the different passages.

    In a shard's windows the anchor's place differs by less than ``width``.
    """
    hot = different.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > HOT_PASSAGES).select("shard")
    hot = cut(hot)
    if width == 1 or hot.isEmpty():  # one window a shard: its passages are one
        return _match(different, window)
    half = -(-width // 2)
    halves = different.join(hot, "shard", "left_semi").mapInArrow(
        _halve(window, half), "up_shard bigint, up_passage bigint, offset int, shard bigint, place int, words binary, times bigint"
    )
    halves = table(halves.withColumn("passage", F.xxhash64("words", "place")), "halves")
    below = _found(_different(halves, table), table, window, half)
    raised = halves.select("up_shard", "up_passage", "offset", "shard", "passage").join(below, ["shard", "passage"])
    raised = raised.groupBy(F.col("up_shard").alias("shard"), F.col("up_passage").alias("passage")).agg(
        F.flatten(F.collect_list(F.transform("found", lambda o: o + F.col("offset")))).alias("found")
    )
    return _match(different.join(hot, "shard", "left_anti"), window).union(raised)


def _halve(window: int, width: int):
    """Passages cut into stretches of windows in which the anchor's place is in the same range of ``width``, named by the words that all windows of the range share."""

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for shard, passage, place, text, times in zip(*(batch.column(c).to_pylist() for c in ("shard", "passage", "place", "words", "times")), strict=True):
                words = text.split(b" ")
                last = len(words) - window
                for part in range(max(0, place - last) // width, place // width + 1):
                    low, high = part * width, part * width + width - 1
                    a, b = max(0, place - high), min(last, place - low)
                    shared = b" ".join(words[place - low : place - high + window])
                    name = xxhash.xxh64_intdigest(b"%d %d %d " % (shard, width, part) + shared) - (1 << 63)
                    out.append((shard, passage, a, name, place - a, b" ".join(words[a : b + window]), times))
            columns = zip(*out, strict=True) if out else [[]] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
            names = ["up_shard", "up_passage", "offset", "shard", "place", "words", "times"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return halve


def _match(different: DataFrame, window: int) -> DataFrame:
    """Each shard's passages streamed through its automaton."""
    shards = different.repartition("shard").sortWithinPartitions("shard", "passage")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        shard, group, names = None, [], []

        def settle() -> None:
            for name, starts in zip(names, repeated_windows(group, window), strict=True):
                if starts:
                    out.append((shard, name, starts))

        def packed() -> pa.RecordBatch:
            a, b, c = zip(*out, strict=True) if out else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.list_(pa.int32()))], ["shard", "passage", "found"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                for now, name, words, times in zip(*(part.column(c).to_pylist() for c in ("shard", "passage", "words", "times")), strict=True):
                    if now != shard:
                        if group:
                            settle()
                        shard, group, names = now, [], []
                    group.append((words.split(b" "), times))
                    names.append(name)
                if len(out) > 1000:
                    yield packed()
                    out = []
        if group:
            settle()
        yield packed()

    return shards.mapInArrow(match, "shard bigint, passage bigint, found array<int>")


def remove_repeats(docs: DataFrame, *, keep: list[Column], window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``keep`` columns with ``n_words``, ``n_removed``, ``removed`` and ``kept_text``, for every row.

    A word goes if it lies in a window of ``window`` consecutive words whose
    sequence also starts anywhere else in the table, the same text included. Words
    are runs of other bytes than ASCII white space, unchanged. ``removed`` lists the
    maximal spans taken out as pairs of the first word's number and the number after the
    last; ``kept_text`` is the other words joined by one space. Null and empty
    texts, and texts of fewer words than a window, lose nothing; rows that repeat
    a text lose every window of it. An empty table gives no rows. A ``keep`` column that
    bears a result's name raises ValueError.
    """
    names = own_names(docs, keep, STRIPPED.names)
    bound_batches(docs.sparkSession)
    key = row_key(F.col(id_col), F.col(text_col))["b"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    with scratch_folder(docs.sparkSession, "repeats") as table:
        starts = cut(repeated_spans(docs.select(key.alias("key"), text.alias("text")), table, window=window))
    rows = docs.select(*keep, key.alias("__key"), text.alias("__text"))
    rows = rows.join(starts.select(F.col("key").alias("__key"), F.col("starts").alias("__starts")), "__key", "left")

    def strip(texts: pa.Array, starts: pa.Array) -> pa.Array:
        n_words, n_removed, removed, kept = [], [], [], []
        for text, found in zip(texts, starts, strict=True):
            words = text.as_py().encode("utf-8").split()
            spans = _spans(found.as_py() or [], window)
            stays = np.ones(len(words), bool)
            for a, b in spans:
                stays[a:b] = False
            n_words.append(len(words))
            n_removed.append(len(words) - int(stays.sum()))
            removed.append(spans)
            kept.append(b" ".join(compress(words, stays.tolist()) if spans else words).decode("utf-8"))
        columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed, pa.list_(pa.list_(pa.int32()))), pa.array(kept, pa.string())]
        return pa.StructArray.from_arrays(columns, STRIPPED.names)

    # the workers get text and windows alone; the other columns stay in the JVM
    stripped = rows.select(*names, F.arrow_udf(strip, STRIPPED)("__text", "__starts").alias("__stripped"))
    return stripped.select(*names, "__stripped.*")


def _spans(starts: list[int], window: int) -> list[list[int]]:
    """Windows as maximal spans of words."""
    spans: list[list[int]] = []
    for a in sorted(starts):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = a + window
        else:
            spans.append([a, a + window])
    return spans
