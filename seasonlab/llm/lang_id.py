"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte pairs and triples; each
language has a few centroids, found by spherical k-means on a bounded sample of
labelled rows, and a text gets the language of the centroid with the largest
cosine. A text is rejected if its cosine is far below what rows of that language
and of about its length had to centroids that were fitted without them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seasonlab.llm.common import bound_batches, own_names

UNKNOWN = "und"
JUDGED = StructType().add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
#: Texts that are judged together.
TOGETHER = 64
BITS = 12  # of a hashed pair or triple
DIM = 2 << BITS
#: Labelled rows per language that a model is fitted on, at most.
FIT_ROWS_PER_LANGUAGE = 400
#: Parts of a language's rows that are cut down to as many each before they meet.
SPREAD = 64
CENTROIDS_PER_LANGUAGE = 3
#: A text is rejected below this share of a low quantile of the cosines that learned rows of its language and about its length have.
REJECT_SHARE = 0.7
REJECT_QUANTILE = 0.01
#: A class of length with fewer learned rows borrows the nearest lengths' rows.
LENGTH_ROWS = 50
#: Classes of length, a factor of two pairs and triples each; the last (256 bytes and more) is open, as cosines hardly grow from there on.
LENGTHS = 10
#: A centroid stands for this share of its language's rows at least, and rows so far out start none: mislabelled rows must not become one.
LEAST_SHARE = 0.05
#: Parts of a language's rows, each measured against centroids of the others.
FOLDS = 5
ROUNDS = 12


def _folded() -> np.ndarray:
    """Byte table: letters stay, all other ASCII is one space."""
    table = np.full(256, 0x20, np.uint8)
    for b in range(256):
        if chr(b).isalpha() or b >= 0x80:
            table[b] = b
    return table


FOLDED = _folded()


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte pairs and triples of a whole text, lower-cased; runs of other characters are one space."""
    b = FOLDED[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    b = b[np.flatnonzero((b != 0x20) | np.r_[True, b[:-1] != 0x20])].astype(np.uint32)
    pairs = b[:-1] << np.uint32(8) | b[1:]
    triples = pairs[:-1] << np.uint32(8) | b[2:]
    slots = np.concatenate([
        (pairs * np.uint32(2654435761)) >> np.uint32(32 - BITS),
        ((triples * np.uint32(2246822519)) >> np.uint32(32 - BITS)) + np.uint32(1 << BITS),
    ])
    return np.bincount(slots, minlength=DIM)


def _units(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def _centroids(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: start from the row nearest to the mean, then the row farthest from all chosen but for LEAST_SHARE of the rows."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    near = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argsort(near, kind="stable")[int(LEAST_SHARE * len(rows))]))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centers = rows[chosen]
    for _ in range(ROUNDS):
        own = np.argmax(rows @ centers.T, axis=1)
        after = np.stack([rows[own == c].mean(axis=0) if (own == c).any() else centers[c] for c in range(len(centers))])
        centers = _units(after)
    held = np.bincount(np.argmax(rows @ centers.T, axis=1), minlength=len(centers))
    return centers[held >= min(LEAST_SHARE * len(rows), held.max())]


def _log_length(counts: np.ndarray) -> np.ndarray:
    """Logarithm, base two, of the pairs and triples of each text."""
    return np.log2(np.maximum(counts.sum(axis=1, dtype=np.float64), 1))


def _unseen_cosines(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(place, cosine)`` of each row of a language to centroids fitted without it; none if there is but one row."""
    fold = np.arange(len(rows)) % FOLDS
    at, cosine = [np.zeros(0, int)], [np.zeros(0)]
    for f in range(min(FOLDS, len(rows)) if len(rows) > 1 else 0):
        own = np.flatnonzero(fold == f)
        at.append(own)
        cosine.append((rows[own] @ _centroids(rows[fold != f], CENTROIDS_PER_LANGUAGE).T).max(axis=1))
    return np.concatenate(at), np.concatenate(cosine)


def _cuts(length: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """The least cosine that each class of length accepts, from those of rows that the centroids had not seen.

    A class with fewer than LENGTH_ROWS rows takes the nearest rows. Those longer
    than the class count as if cut to its length: a text's cosine grows at
    most with the root of its length. No class is cut above the longer ones.
    Without rows nothing is rejected.
    """
    out = np.zeros(LENGTHS)
    if not len(cosine):
        return out
    for c in reversed(range(LENGTHS)):
        over = np.maximum(length - (c + 1), 0) if c < LENGTHS - 1 else np.zeros(len(length))
        away = np.maximum(over, c - length)
        near = away <= np.sort(away)[min(LENGTH_ROWS, len(away)) - 1]
        out[c] = min([REJECT_SHARE * np.quantile(cosine[near] * 2.0 ** (-over[near] / 2), REJECT_QUANTILE), *out[c + 1 : c + 2]])
    return out


@dataclass
class LanguageModel:
    """Centroids of a fitted model: at most CENTROIDS_PER_LANGUAGE x DIM floats a language."""

    languages: list[str]  # of each centroid
    centers: np.ndarray
    idf: np.ndarray
    cuts: np.ndarray  # of each centroid's language: the least accepted cosine by class of length

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _units(np.log1p(counts) * self.idf)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine (0 to 1) and whether the model accepts it."""
        langs, scores, accepted = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not self.languages:
            return langs, scores, accepted
        for lo in range(0, len(at), TOGETHER):
            part = at[lo : lo + TOGETHER]
            counts = np.stack([ngram_counts(texts[i]) for i in part]).astype(np.float32)
            cosine = self.vectors(counts) @ self.centers.T
            sized = np.minimum(_log_length(counts).astype(int), LENGTHS - 1)
            for i, best, row, size in zip(part, cosine.argmax(axis=1), cosine, sized, strict=True):
                langs[i], scores[i] = self.languages[best], float(min(1.0, max(0.0, row[best])))
                accepted[i] = bool(row[best] >= self.cuts[best, size])
        return langs, scores, accepted


def fit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key: Column, rows_per_language: int = FIT_ROWS_PER_LANGUAGE) -> LanguageModel:
    """Fit on at most ``rows_per_language`` labelled rows of each language: those whose hashed ``key`` is smallest, rows that repeat key and text once.

    Rows with a null or empty text or a null language aren't used. The sample's
    keys become distinct and are cut down before its texts are read by a second
    scan, and its vectors (a bounded number) are fitted on the driver.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(key).alias("h"))
    rows = rows.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    rows = rows.withColumn("t", F.xxhash64("text"))
    # a row for each key and text, or rows that repeat would bring more than the parameter
    taken = rows.select("lang", "h", "t").distinct().withColumn("s", F.pmod("t", F.lit(SPREAD)))
    for keys in (["lang", "s"], ["lang"]):  # a language's rows are cut down in parts first
        order = Window.partitionBy(*keys).orderBy("h", "t")
        taken = taken.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows_per_language)
    taken = taken.select("lang", "h", "t")
    sample = rows.join(F.broadcast(taken), ["lang", "h", "t"], "left_semi").groupBy("lang", "h", "t").agg(F.min("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, h in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "h")), strict=True):
                counts = ngram_counts(text)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang], pa.string()), "h": pa.array([h], pa.int64()),
                    "at": pa.array([at.astype("<u2").tobytes()], pa.binary()), "n": pa.array([counts[at].astype("<u4").tobytes()], pa.binary()),
                })

    got = sample.mapInArrow(vectors, "lang string, h bigint, at binary, n binary").collect()
    got = sorted(got, key=lambda r: (r["lang"], r["h"], bytes(r["at"]), bytes(r["n"])))
    counts = np.zeros((len(got), DIM), np.float32)
    for row, r in zip(counts, got, strict=True):
        row[np.frombuffer(bytes(r["at"]), "<u2")] = np.frombuffer(bytes(r["n"]), "<u4")
    return learn(counts, np.array([r["lang"] for r in got]))


def learn(counts: np.ndarray, named: np.ndarray) -> LanguageModel:
    """A model of rows of counts and their languages."""
    model = LanguageModel([], np.zeros((0, DIM), np.float32), np.ones(DIM, np.float32), np.zeros((0, LENGTHS)))
    if not len(counts):
        return model
    model.idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    vecs = model.vectors(counts)
    length = _log_length(counts)
    centers, cuts = [], []
    for lang in sorted(set(named)):
        rows = vecs[named == lang]
        own = _centroids(rows, CENTROIDS_PER_LANGUAGE)
        at, cosine = _unseen_cosines(rows)
        centers.append(own)
        cuts += [_cuts(length[named == lang][at], cosine)] * len(own)
        model.languages += [lang] * len(own)
    model.centers = np.concatenate(centers).astype(np.float32)
    model.cuts = np.stack(cuts)
    return model


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", keep: list[Column]) -> DataFrame:
    """The ``keep`` columns with lang_pred, score and accepted, for every row and the whole of each text.

    A null text, or one without a letter, is ``und`` with score 0 and not accepted;
    so is every text if no language was learned. Rows that repeat are judged each, and
    alike; an empty table gives no rows. A ``keep`` column that bears a result's name raises ValueError.
    """
    names = own_names(docs, keep, JUDGED.names)
    bound_batches(docs.sparkSession)

    def label(texts: pa.Array) -> pa.Array:
        langs, scores, accepted = [], [], []
        for lo in range(0, len(texts), TOGETHER):
            part = model.predict(texts.slice(lo, TOGETHER).to_pylist())
            for out, found in zip((langs, scores, accepted), part, strict=True):
                out += found
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())], JUDGED.names)

    # the workers get the texts alone; the other columns stay in the JVM
    judged = docs.select(*keep, F.arrow_udf(label, JUDGED)(F.col(text_col)).alias("__judged"))
    return judged.select(*names, "__judged.*")


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is neither held out nor learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
