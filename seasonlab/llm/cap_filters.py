"""Near-duplicate embeddings by spherical-cap filters.

Filter directions are structured: each is a pair of code vectors, one from the
random code of either half of the (randomly rotated) space, so a vector's largest
filters are found by list decoding two short lists instead of scanning all pairs.
A vector is stored in the cap it lies deepest in and looks for others in all
caps whose direction it exceeds by its own threshold. Stored and looking vectors
meet by an equi join on label and filter, and every meeting is verified exactly.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import cut, scratch_folder
from seasonlab.llm.components import connected_components

#: A vector looks into every filter whose score is within so many deviations of its best one's (tests measure recall).
DEVIATIONS = 3.5
#: Stored vectors of one filter that are compared in one block.
BLOCK = 1024
#: Looking vectors of one filter that meet a block in one group; they are read in slices of SLICE.
LOOKING = 16_384
SLICE = 1024
SEED = 20_240_607


@functools.lru_cache(maxsize=8)
def filter_code(dim: int, codes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A random rotation, and the code of either half: unit vectors, scaled so that their pairs are unit vectors."""
    rng = np.random.default_rng([SEED, dim, codes])
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    halves = [dim - dim // 2, dim // 2] if dim > 1 else [1]
    parts = []
    for width in halves:
        c = rng.normal(size=(codes, width))
        parts.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(len(halves)))
    return rotation, parts


def depth(threshold: float, dim: int) -> float:
    """How far below its best filter's score a vector looks.

    Vectors at the threshold differ by ``apart``, so the difference of their scores
    in two filters deviates by about sqrt(2 / dim) of it, and is at most twice it.
    """
    apart = math.sqrt(max(2 - 2 * threshold, 0))
    return max(min(DEVIATIONS * math.sqrt(2 / dim), 2) * apart, 1e-6)


def decode(vectors: np.ndarray, codes: int, depth: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """The best filter of each unit vector, and all filters within ``depth`` of the best score."""
    rotation, parts = filter_code(vectors.shape[1], codes)
    turned = vectors @ rotation
    short, at = [], 0
    for code in parts:
        score = turned[:, at : at + code.shape[1]] @ code.T
        at += code.shape[1]
        short.append(score.max(axis=1, keepdims=True) - score)
    best = sum(s.argmin(axis=1) * codes**i for i, s in enumerate(short))
    lists = []
    for rows in zip(*short, strict=True):
        ids, left = np.zeros(1, np.int64), np.zeros(1)
        for i, row in enumerate(rows):
            near = np.flatnonzero(row <= depth)
            total = left[:, None] + row[near]
            ok = total <= depth
            ids = (ids[:, None] + near * codes**i)[ok]
            left = total[ok]
        lists.append(ids)
    return best, lists


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, each scaled by a power of two to a largest component of 0.5 to 1 (cosines stay the same)."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Keys and slices of batches whose rows have the same keys; a group may go on in the next slice."""
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        lo = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[lo]:
                yield values[lo], batch.slice(lo, i - lo)
                lo = i


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with the same keys, of batches sorted by them."""
    waiting: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        lo = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[lo]:
                if now is not None and values[lo] != now:
                    yield pa.Table.from_batches(waiting)
                    waiting = []
                now = values[lo]
                waiting.append(batch.slice(lo, i - lo))
                lo = i
    if waiting:
        yield pa.Table.from_batches(waiting)


def _spread(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of a link matrix, the smallest row of its connected part (rows without a link: themselves; columns: -1)."""
    n = len(linked)
    row = np.arange(n)
    while True:
        column = np.where(linked.any(axis=0), np.where(linked, row[:, None], n).min(axis=0), -1)
        after = np.where(linked.any(axis=1), np.minimum(row, np.where(linked, column[None, :], n).min(axis=1)), row)
        if (after == row).all():
            return row, column
        row = after


def near_duplicate_vectors(
    vectors: DataFrame, *, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Rows are linked if their labels are equal and not null, their vectors have the
    same length and the cosine, in double precision, is at least ``threshold``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable by links and ``kept`` marks the row that bears it. A vector
    that is null, empty, zero or holds a null or non-finite component links with
    nothing, nor does one without a label.

    Exact copies are one node that carries their number, so they add no pairs. A
    filter with many vectors is split into blocks of stored and of looking ones, and
    a task holds one block of stored vectors and a slice of looking ones; a slice
    returns one row a vector: its number of links there and a spanning edge. Repeated ids: rows with
    the same id are rows of their own, each with its own links; null ids are null
    component names only where a whole component has no id.
    """
    # floats travel as floats and become doubles where they are multiplied
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    sound = (
        F.col("label").isNotNull() & (F.coalesce(F.size("v"), F.lit(0)) > 0)
        & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    )
    halves = F.xxhash64("label", "v"), F.xxhash64(F.lit(1), "v", "label")
    node = F.unhex(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in halves)))
    rows = cut(rows.withColumn("node", F.when(sound, node)))
    nodes = cut(
        rows.where("node IS NOT NULL").groupBy("node").agg(
            F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("least")
        )
    )
    n = nodes.count()
    codes = 1 << max(5, math.ceil(math.log2(max(n, 1)) / 2))
    with scratch_folder(vectors.sparkSession, "cap-filters") as table:
        links = _links(nodes, table, codes, threshold)
    members = connected_components(links.where("node <> leader"), "node", "leader")
    named = nodes.select("node", "least").join(members, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    counted = links.groupBy("node").agg(F.sum("n").alias("n_links"))
    facts = named.join(least, "component").join(counted, "node", "left").select("node", "component_id", "n_links")
    out = rows.select("vec_id", "node").join(facts, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.col("vec_id").isNull() & component.isNull()).alias("kept"),
    )


def _links(nodes: DataFrame, table, codes: int, threshold: float) -> DataFrame:
    """``(node, n, leader)``: links found in a block, as a number for the looking node, and a node that it is connected with."""

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for size in np.unique(sizes):
                for part in np.array_split(np.flatnonzero(sizes == size), -(-int((sizes == size).sum()) // 512)):
                    some = batch.take(pa.array(part))
                    v = _matrix(some.column("v"))
                    best, lists = decode(v / np.linalg.norm(v, axis=1, keepdims=True), codes, depth(threshold, int(size)))
                    count = np.array([len(x) for x in lists])
                    flat = np.concatenate(lists)
                    yield pa.RecordBatch.from_pydict({
                        "node": some.column("node").take(pa.array(np.repeat(np.arange(len(part)), count))),
                        "label": some.column("label").take(pa.array(np.repeat(np.arange(len(part)), count))),
                        "filter": pa.array(flat << 20 | int(size)), "stored": pa.array(flat == np.repeat(best, count)),
                    })

    label = nodes.schema["label"].dataType.simpleString()
    found = table(nodes.mapInArrow(filters, f"node binary, label {label}, filter bigint, stored boolean"), "filters")
    meeting = _meeting(found, nodes).repartition(*KEYS).sortWithinPartitions(*KEYS, F.col("stored").desc())
    met = meeting.mapInArrow(_verify(threshold), "node binary, n bigint, leader binary")
    return cut(met.where("n > 0 OR node <> leader"))


KEYS = ["label", "filter", "block", "part"]


def _meeting(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """The vectors of each filter by KEYS: every block of stored ones with every part of the looking ones."""
    at = ["label", "filter"]
    held = found.groupBy(*at).agg(F.count_if("stored").alias("held"), F.count("*").alias("looking")).where("held > 0")
    held = held.select(*at, F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("looking") / LOOKING).cast("int").alias("parts"))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def one(n: str):
        return F.pmod(F.xxhash64("node"), n).cast("int")

    rows = found.join(held, at)
    stored = rows.where("stored").select(*at, one("blocks").alias("block"), every("parts").alias("part"), "node", F.lit(True).alias("stored"))
    looking = rows.select(*at, every("blocks").alias("block"), one("parts").alias("part"), "node", F.lit(False).alias("stored"))
    return stored.union(looking).join(nodes.select("node", "v", "copies"), "node")


def _verify(threshold: float):
    """The links of sorted groups, of which only the stored vectors and a slice of the looking ones are held."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[bytes, int, bytes]] = []
        now, stored, held = None, [], None
        for key, rows in _runs(batches, KEYS):
            if key != now:
                now, stored, held = key, [], None
            first_looking = int(np.count_nonzero(rows.column("stored").to_numpy(zero_copy_only=False)))
            if first_looking:
                stored.append(rows.slice(0, first_looking))
            for lo in range(first_looking, rows.num_rows, SLICE):
                if held is None:
                    held = _held(stored)
                    stored = []
                gathered += _compare(held, rows.slice(lo, SLICE), threshold)
                if len(gathered) > 20_000:
                    yield _packed(gathered)
                    gathered = []
        yield _packed(gathered)

    return verify


def _held(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
    """Names, places, vectors, lengths and copies of a block of stored vectors."""
    names = [x for part in parts for x in part.column("node").to_pylist()]
    v = np.concatenate([_matrix(part.column("v")) for part in parts])
    copies = np.concatenate([part.column("copies").to_numpy() for part in parts])
    return np.array(names, object), {x: i for i, x in enumerate(names)}, v, np.linalg.norm(v, axis=1), copies


def _compare(held, looking: pa.RecordBatch, threshold: float) -> list[tuple[bytes, int, bytes]]:
    """Number of links of each looking vector, and spanning edges."""
    stored_names, place, stored, stored_length, copies = held
    names = np.array(looking.column("node").to_pylist(), object)
    v = _matrix(looking.column("v"))
    cosine = (v @ stored.T) / np.outer(np.linalg.norm(v, axis=1), stored_length)
    same = np.array([place.get(x, -1) for x in names])[:, None] == np.arange(len(stored))
    linked = (cosine >= threshold) | same
    number = linked @ copies - same.any(axis=1)
    row, column = _spread(linked)
    some, has = linked.any(axis=1), np.flatnonzero(column >= 0)
    found = list(zip(names[some].tolist(), number[some].tolist(), names[row][some].tolist(), strict=True))
    return found + list(zip(stored_names[has].tolist(), [0] * len(has), names[column[has]].tolist(), strict=True))


def _packed(rows: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
    node, n, leader = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(leader, pa.binary())], ["node", "n", "leader"])
