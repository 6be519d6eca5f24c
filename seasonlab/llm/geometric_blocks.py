"""Ranked lexical search over posting lists cut into geometric blocks.

The index holds, for every document, its terms and how often each occurs. A shard of
documents is searched at a time: the posting list of a term is clustered by the
documents' similarity (the nearest of some of its own documents, by a random projection
of their weighted terms) and each cluster, a block, is summed up by the largest impact
that any of its documents has for every term. The summary bounds the score of
all its documents, so a block is skipped only if that bound is below the score to beat.

An item's terms are taken from the rarest to the most frequent, and a document is
scored where the first of them lists it. So the bound of a block counts only the
terms from its own on, and the lists of frequent terms mostly fall away whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.bpe import slices
from seasonlab.llm.common import bound_batches, scratch_table
from seasonlab.llm.words import TOGETHER, words_of

#: Items whose terms are searched in one pass over the index, and their distinct terms (an item with more is a pass of its own).
ITEMS_TOGETHER, TERMS_TOGETHER = 1024, 16_384
#: Postings of one shard (a document with more is a shard of its own), and documents a block holds on average.
SHARD_POSTINGS = 400_000
BLOCK = 128
SKETCH = 16  # dimensions of the projection by which documents are clustered
SLACK = 1 + 1e-9  # a bound is computed in doubles and must not be rounded below the exact one


def _term_tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes that are in no term (ASCII other than letters and digits), and the lower case of A to Z."""
    apart, fold = np.ones(256, bool), np.arange(256, dtype=np.uint8)
    apart[128:] = False
    for first, last in (("0", "9"), ("A", "Z"), ("a", "z")):
        apart[ord(first) : ord(last) + 1] = False
    fold[ord("A") : ord("Z") + 1] += 32
    return apart, fold


APART, FOLD = _term_tables()


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(n, row, term, tf)``: the terms of each text with repeats, and the distinct ones (hashes) by row with how often each occurs."""
    words = words_of(texts, APART, FOLD)
    n = np.diff(np.r_[0, words.ends])
    term = words.hashes().view(np.int64) if len(words.start) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (term[1:] != term[:-1])]) if len(row) else np.zeros(0, int)
    return n, row[first], term[first], np.diff(np.r_[first, len(row)])


def index_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of every row: its number of terms, its distinct terms (64-bit hashes) and their occurrences.

    Terms are longest runs of ASCII letters and digits and of all characters above
    ASCII, A-Z in lower case. A null or empty text has none.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                n, row, term, tf = term_counts(part.column(1))
                ends = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term, tf.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(count, "doc_id bigint, n bigint, terms array<bigint>, tfs array<int>")


@dataclass
class Items:
    """A block of items: for each a row number, its id, its terms as places in ``vocabulary`` (sorted hashes) and their repeats."""

    rows: list[int]
    ids: list
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: np.ndarray

    @classmethod
    def of(cls, rows: list[int], ids: list, counted: list[tuple[np.ndarray, np.ndarray]]) -> Items:
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.int64), *(t for t, _ in counted)]))
        return cls(rows, ids, [np.searchsorted(vocabulary, t) for t, _ in counted], [r for _, r in counted], vocabulary)


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """Items in blocks of a bounded size, as the table's partitions are fetched one after the other."""
    rows, ids, counted, terms = [], [], [], 0
    for number, (item_id, text) in enumerate(items.select(id_col, text_col).toLocalIterator()):
        _, _, term, tf = term_counts(pa.array([text or ""]))
        if rows and (len(rows) == ITEMS_TOGETHER or terms + len(term) > TERMS_TOGETHER):
            yield Items.of(rows, ids, counted)
            rows, ids, counted, terms = [], [], [], 0
        if len(term):
            rows.append(number)
            ids.append(item_id)
            counted.append((term, tf))
            terms += len(term)
    if rows:
        yield Items.of(rows, ids, counted)


def _ragged(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its stop, in order."""
    size = stops - starts
    return np.arange(size.sum()) + np.repeat(starts - (np.cumsum(size) - size), size)


class Best:
    """An item's highest scores so far, equal ones by ascending id with missing ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.missing, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def to_beat(self) -> int:
        """A document must score this at least: 1, or the lowest of k scores."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, missing: np.ndarray, doc: np.ndarray) -> None:
        able = score >= self.to_beat
        if able.any():
            score, missing, doc = (np.concatenate(pair) for pair in ((self.score, score[able]), (self.missing, missing[able]), (self.doc, doc[able])))
            order = np.lexsort((doc, missing, -score))[: self.k]
            self.score, self.missing, self.doc = score[order], missing[order], doc[order]


class Search:
    """The items of a block against one shard of documents after the other.

    ``weight``: of each term of the vocabulary, not negative. A document's score for an item is
    the sum of weight x impact over the item's terms, with repeats.
    """

    def __init__(self, items: Items, weight: np.ndarray, k: int, block: int = BLOCK) -> None:
        self.items, self.weight, self.block = items, weight, block
        self.best = [Best(k) for _ in items.rows]
        self.order = np.lexsort((np.arange(len(weight)), -weight))  # rarest term first
        place = np.argsort(self.order)
        # each item's terms in that order, and weight x repeats of each
        self.terms, self.factor = [], []
        self.holders: list[list[tuple[int, int]]] = [[] for _ in weight]
        for i, (terms, repeats) in enumerate(zip(items.terms, items.repeats, strict=True)):
            by_place = np.argsort(place[terms])
            self.terms.append(terms[by_place])
            self.factor.append((weight[terms] * repeats)[by_place])
            for at, t in enumerate(self.terms[-1]):
                self.holders[t].append((i, at))
        self.projection = np.random.default_rng(0).standard_normal((len(weight), SKETCH)).astype(np.float32)
        self.blocks = self.blocks_scored = 0  # of all (item, block) pairs that met

    def shard(self, doc: np.ndarray, missing: np.ndarray, ends: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Search documents whose terms (places in the vocabulary, ascending) and impacts end at ``ends``."""
        starts = np.r_[0, ends[:-1]]
        owner = np.repeat(np.arange(len(doc)), ends - starts)
        by_term = np.argsort(term, kind="stable")
        listed = np.searchsorted(term[by_term], np.arange(len(self.weight) + 1))
        most = np.zeros(len(self.weight), np.int64)
        np.maximum.at(most, term, impact)
        sketch = self._sketch(starts, ends, term, impact)
        seen = np.zeros((len(self.items.rows), len(doc)), bool)
        for t in self.order:
            if not self.weight[t]:
                break  # and of those behind it none adds to a score
            posting = owner[by_term[listed[t] : listed[t + 1]]]
            if not len(posting):
                continue
            # the whole list's summary first
            able = [(i, at) for i, at in self.holders[t] if (self.factor[i][at:] @ most[self.terms[i][at:]].astype(float)) * SLACK >= self.best[i].to_beat]
            if not able:
                continue
            posting, bounds_of = self._clustered(posting, sketch)
            flat = _ragged(starts[posting], ends[posting])
            summary = np.zeros((len(bounds_of) - 1, len(self.weight)), np.int32)
            block_of = np.repeat(np.arange(len(bounds_of) - 1), np.diff(bounds_of))
            np.maximum.at(summary, (np.repeat(block_of, ends[posting] - starts[posting]), term[flat]), impact[flat].astype(np.int32))
            for i, at in able:
                bound = summary[:, self.terms[i][at:]] @ self.factor[i][at:].astype(float) * SLACK
                self._score(i, posting, bounds_of, bound, seen[i], (doc, missing, starts, ends, term, impact))

    def _sketch(self, starts: np.ndarray, ends: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), SKETCH), np.float32)
        filled = np.flatnonzero(ends > starts)
        if len(filled):
            rows = self.projection[term] * (self.weight[term] * impact).astype(np.float32)[:, None]
            out[filled] = np.add.reduceat(rows, starts[filled], axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)

    def _clustered(self, posting: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The posting list by block, and where each block starts (and the last one ends)."""
        if len(posting) <= self.block:
            return posting, np.array([0, len(posting)])
        own = sketch[posting]
        near = np.argmax(own @ own[:: self.block].T, axis=1)
        order = np.argsort(near, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(near[order]) > 0])
        return posting[order], np.r_[starts, len(posting)]

    def _score(self, i: int, posting: np.ndarray, bounds_of: np.ndarray, bound: np.ndarray, seen: np.ndarray, shard: tuple) -> None:
        """Score an item's documents of the blocks whose bound reaches what is to beat, the most promising ones first."""
        doc, missing, starts, ends, term, impact = shard
        best, factor = self.best[i], np.zeros(len(self.weight), np.int64)
        factor[self.terms[i]] = self.factor[i]
        self.blocks += len(bound)
        waiting = np.argsort(-bound, kind="stable")
        take = 1
        while len(waiting) and bound[waiting[0]] >= best.to_beat:
            some, waiting = waiting[:take], waiting[take:]
            some = some[bound[some] >= best.to_beat]
            self.blocks_scored += len(some)
            rows = posting[_ragged(bounds_of[some], bounds_of[some + 1])]
            rows = rows[~seen[rows]]
            if len(rows):
                seen[rows] = True
                flat = _ragged(starts[rows], ends[rows])
                offsets = np.cumsum(ends[rows] - starts[rows]) - (ends[rows] - starts[rows])
                best.add(np.add.reduceat(factor[term[flat]] * impact[flat], offsets), missing[rows], doc[rows])
            take *= 2


def _restricted(batch: pa.RecordBatch, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, tf)`` of the terms of an index batch that are in the vocabulary."""
    terms, tfs = batch.column(batch.schema.get_field_index("terms")), batch.column(batch.schema.get_field_index("tfs"))
    offsets = terms.offsets.to_numpy()
    term = terms.values.to_numpy()[offsets[0] : offsets[-1]]
    tf = tfs.values.to_numpy()[tfs.offsets[0].as_py() : tfs.offsets[-1].as_py()]
    place = np.searchsorted(vocabulary, term)
    place[place == len(vocabulary)] = 0
    known = vocabulary[place] == term
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    return row[known], place[known], tf[known].astype(np.int64)


def _document_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            held += np.bincount(_restricted(batch, vocabulary)[1], minlength=len(vocabulary))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["place", "held"])

    counts = index.select("terms", "tfs").mapInArrow(count, "place int, held bigint").groupBy("place").agg(F.sum("held").alias("held"))
    out = np.zeros(len(vocabulary), np.int64)
    for place, held in counts.collect():  # at most a row for each term of the block
        out[place] = held
    return out


def search(index: DataFrame, items: DataFrame, *, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for every row of ``items`` its ``k`` documents of the highest score above 0, all if there are fewer.

    With N documents that have a term, L terms in all, n terms of the document, df documents
    that hold a term, tf occurrences in the document (integers, div rounds down):
    a term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), the document's m is
    75 + (25 n N) div L, and its score the sum of weight x ((10^9 tf) div (1000 tf + 12 m))
    over the item's terms, repeats included. Equal scores are ranked by ascending id.

    Null and empty texts have no terms; rows that repeat an id are documents, or items, of their
    own; a null doc_id is ranked after all others of its score; an empty table on either side
    gives no rows. Other columns aren't read. Items pass the driver in blocks of at most
    ITEMS_TOGETHER rows, each block a pass over the index.
    """
    totals = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    found = None
    if totals["docs"]:
        for block in _item_blocks(items, id_col, text_col):
            part = _search_block(index, block, totals["docs"], totals["terms"], k)
            found = part if found is None else found.union(part)
    if found is None:
        found = index.sparkSession.createDataFrame([], "item bigint, item_id bigint, doc_id bigint, score bigint")
    first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, items: Items, docs: int, terms: int, k: int) -> DataFrame:
    held = _document_counts(index, items.vocabulary)
    weight = np.floor(1000 * np.log((2 * docs + 2) / (2 * held + 1))).astype(np.int64)
    names = ["item", "item_id", "doc_id", "score"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Search(items, weight, k)
        for batch in batches:
            row, place, tf = _restricted(batch, items.vocabulary)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy()
            n = batch.column(batch.schema.get_field_index("n")).to_numpy()
            order = np.lexsort((place, row))
            row, place, tf = row[order], place[order], tf[order]
            m = 75 + 25 * n * docs // terms
            impact = 10**9 * tf // (1000 * tf + 12 * m[row])
            ends = np.searchsorted(row, np.arange(batch.num_rows), side="right")
            lo = 0
            while lo < batch.num_rows:
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + SHARD_POSTINGS, side="right")))
                a, b = before, ends[hi - 1]
                filled = np.flatnonzero(np.diff(np.r_[a, ends[lo:hi]]))  # documents without a term of the items score 0
                own.shard(doc[lo:hi][filled], missing[lo:hi][filled], ends[lo:hi][filled] - a, place[a:b], impact[a:b])
                lo = hi
        for i, best in enumerate(own.best):
            if len(best.score):
                size = len(best.score)
                yield pa.RecordBatch.from_arrays([
                    pa.array([items.rows[i]] * size, pa.int64()), pa.array([items.ids[i]] * size, pa.int64()),
                    pa.array(best.doc, mask=best.missing), pa.array(best.score),
                ], names)

    # written, as the rows of a task are few and the window must not repeat the search
    return scratch_table(index.mapInArrow(find, "item bigint, item_id bigint, doc_id bigint, score bigint"), "found")
