"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets, and buckets are cut into blocks. A
block of queries first meets the block of the longest vectors, which gives each
query a score to beat; then it meets every other block whose longest vector
could still reach it. In a block the score to beat becomes a cosine to beat: if
that is high, candidates must agree with the query in its largest coordinates,
otherwise their length alone can rule them out. What is left is multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.common import cut

#: Norms within an eighth of a power of two share a bucket.
BUCKETS_PER_OCTAVE = 8
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: From this cosine on coordinates are compared, below it lengths.
COORDINATE_COSINE = 0.8
COORDINATES = 4
SLACK = 1 - 1e-9  # bounds are doubles, and must not rule out what equals them
NO_ID = np.iinfo(np.int64).max  # stands for a null id: last among ties
NO_SCORE = np.iinfo(np.int64).min  # nothing to beat yet
LARGEST = 2.0**62  # of a scaled component
PACKED = "ids binary, m binary, width int, longest double"


def _packed(v: np.ndarray) -> tuple[bytes, int]:
    """Integers in the least of 2, 4 and 8 bytes that holds them all, and that width."""
    most = max(int(v.max()), -int(v.min())) if v.size else 0
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return v.astype(f"<i{width}").tobytes(), width


def _blocks(rows: DataFrame, most: int, name: str) -> DataFrame:
    """Rows as blocks of about ``most``: one row a block with its ids, its integer matrix and its largest norm."""
    sizes = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / most).cast("int"))
    spread = rows.join(sizes.select("dim", "bucket", "parts"), ["dim", "bucket"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), "parts").cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        ids = np.array([NO_ID if i is None else i for i in table.column("vec_id").to_pylist()], np.int64)
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.lexsort((ids, -np.linalg.norm(v.astype(float), axis=1)))
        ids, v = ids[order], v[order]
        matrix, width = _packed(v)
        first = {c: pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("dim", "bucket", "part")}
        return pa.table({
            **first, "ids": pa.array([ids.tobytes()], pa.binary()), "m": pa.array([matrix], pa.binary()), "width": pa.array([width], pa.int32()),
            "longest": pa.array([float(np.linalg.norm(v[:1].astype(float)))]),
        })

    packed = spread.groupBy("dim", "bucket", "part").applyInArrow(pack, f"dim int, bucket int, part int, {PACKED}")
    return cut(packed.withColumn(name, F.xxhash64("dim", "bucket", "part")))


def _agreeing(q: np.ndarray, cosine: float, v: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Candidates that agree with a query in its largest coordinates as vectors of at least that cosine must."""
    # of unit vectors with at least this cosine, coordinate f lies in q_f * c +- sqrt((1 - c*c)(1 - q_f*q_f))
    unit, c, at = q / np.linalg.norm(q), min(cosine, 1.0), np.arange(len(v))
    for f in np.argsort(-np.abs(unit))[:COORDINATES]:
        half = np.sqrt((1 - c * c) * max(0.0, 1 - unit[f] ** 2)) + 1e-9
        x = v[at, f] / norms[at]
        # above c the interval's centre moves on; its bound on the far side is then the query's own coordinate or 1
        lo, hi = c * unit[f] - half, c * unit[f] + half
        if unit[f] >= c:
            hi = 1.0 + 1e-9
        if -unit[f] >= c:
            lo = -1.0 - 1e-9
        at = at[(x >= lo) & (x <= hi)]
    return at


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as 64-bit integers; OverflowError if they may not fit."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    most = int(np.abs(q).max()) * int(np.abs(v).max()) * q.shape[1]
    if most < 1 << 53:  # doubles hold every partial sum
        return (q.astype(float) @ v.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return q @ v.T
    raise OverflowError("an inner product may not fit 64 bits; use a smaller scale")


def _top(score: np.ndarray, ids: np.ndarray, q_ids: np.ndarray, beat: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of each row's at most k best scores that reach ``beat``, ties to the smaller id, the row's own id left out."""
    by_id = np.argsort(ids, kind="stable")
    own = [np.searchsorted(ids[by_id], q_ids, side) for side in ("left", "right")]
    able = score >= beat[:, None]
    for row in np.flatnonzero(own[1] > own[0]):
        able[row, by_id[own[0][row] : own[1][row]]] = False
    row, column = np.nonzero(able)
    order = np.lexsort((ids[column], -score[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    best = np.arange(len(row)) - first < k
    return row[best], column[best]


def _best(q: np.ndarray, q_ids: np.ndarray, beat: np.ndarray, ids: np.ndarray, v: np.ndarray, norms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, score, id)`` of the at most k best candidates of a block that reach each query's ``beat``. ``v`` is sorted by descending norm."""
    length = np.linalg.norm(q.astype(float), axis=1)
    sought = beat > 0
    least = np.where(sought, beat * SLACK / np.maximum(length, 1e-300), -np.inf)  # the shortest candidate that can reach it
    cosine = least / max(float(norms[0]) if len(norms) else 0.0, 1e-300)
    agree = (cosine >= COORDINATE_COSINE) & (length > 0)
    found = []
    whole = np.flatnonzero(~agree & (~sought | (length > 0)))
    if len(whole):
        upto = int(np.searchsorted(-norms, -least[whole].min(), side="right"))
        score = _products(q[whole], v[:upto])
        row, column = _top(score, ids[:upto], q_ids[whole], beat[whole], k)
        found.append((whole[row], score[row, column], ids[column]))
    for n in np.flatnonzero(agree):
        upto = int(np.searchsorted(-norms, -least[n], side="right"))
        at = _agreeing(q[n].astype(float), float(cosine[n]), v[:upto], norms[:upto])
        score = _products(q[n : n + 1], v[at])
        row, column = _top(score, ids[at], q_ids[n : n + 1], beat[n : n + 1], k)
        found.append((np.full(len(row), n), score[row, column], ids[at][column]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _matrix(raw: bytes, width: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").reshape(-1, dim).astype(np.int64)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = (np.frombuffer(row[c], "<i8") for c in ("ids", "q_ids"))
                v, q = _matrix(row["m"], row["width"], row["dim"]), _matrix(row["q_m"], row["q_width"], row["dim"])
                beat = np.frombuffer(row["beat"], "<i8") if row["beat"] is not None else np.full(len(q_ids), NO_SCORE)
                n, score, vec_id = _best(q, q_ids, beat, ids, v, np.linalg.norm(v.astype(float), axis=1), k)
                block = np.full(len(n), row["q_block"], np.int64)
                columns = [block, n.astype(np.int32), q_ids[n], vec_id.astype(np.int64), score.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q_block", "n", "query_id", "vec_id", "score"])

    return search


FOUND = "q_block bigint, n int, query_id bigint, vec_id bigint, score bigint"


def top_k_products(vectors: DataFrame, queries: Column, *, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k largest integer inner products, ties to the smaller vec_id.

    Components become ``floor(scale * x)`` in double precision. ``queries`` (over the
    id column) picks the query rows; candidates are all rows of other ids whose
    vector has the query's length. Products are exact: blocks whose products may pass
    2**53 are multiplied as 64-bit integers, and the job fails if 64 bits may not hold one.
    Vectors that are null, empty or hold a null or non-finite component take no
    part. A null id is no query and, as a candidate, the last of a tie. Repeated
    rows are candidates each; a query that is repeated with the same vector is
    answered once, with another vector once for each, ranks running through all
    answers of the id.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"), F.coalesce(queries, F.lit(False)).alias("asks"))
    sound = (F.coalesce(F.size("x"), F.lit(0)) > 0) & F.coalesce(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    too_large = F.raise_error(F.lit(f"a component times {scale} doesn't fit 64 bits")).cast("bigint")
    scaled = F.transform("x", lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale).cast("long")).otherwise(too_large))
    rows = rows.where(sound).select("vec_id", "asks", scaled.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    bucket = F.floor(F.log2(F.greatest(square, F.lit(1.0))) / 2 * BUCKETS_PER_OCTAVE).cast("int")
    rows = cut(rows.select("vec_id", "asks", "v", F.size("v").alias("dim"), bucket.alias("bucket")))
    candidates = _blocks(rows.select("vec_id", "v", "dim", "bucket"), BLOCK_ROWS, "c_block")
    asking = rows.where("asks AND vec_id IS NOT NULL").select("vec_id", "v", "dim", "bucket").distinct()
    asking = _blocks(asking, QUERY_ROWS, "q_block").select(
        "dim", "q_block", F.col("ids").alias("q_ids"), F.col("m").alias("q_m"), F.col("width").alias("q_width"), F.col("longest").alias("q_longest")
    )

    # blocks of a dimension by falling largest norm: sizes only, a row a block
    falling = Window.partitionBy("dim").orderBy(F.col("longest").desc(), "c_block")
    places = cut(candidates.select("dim", "c_block", "longest", F.row_number().over(falling).alias("place")))
    matrices = candidates.join(places.drop("longest"), ["dim", "c_block"]).select("dim", "place", "ids", "m", "width")
    seeds = asking.join(matrices.where("place = 1"), "dim").withColumn("beat", F.lit(None).cast("binary"))
    seeded = cut(seeds.repartition("q_block").mapInArrow(_search(k), FOUND))

    def thresholds(table: pa.Table) -> pa.Table:
        n, score = table.column("n").to_numpy(), table.column("score").to_numpy()
        beat = np.full(table.column("size")[0].as_py(), NO_SCORE)
        order = np.lexsort((-score, n))
        n, score = n[order], score[order]
        last = np.flatnonzero(np.arange(len(n)) - np.searchsorted(n, n) == k - 1)  # of each query with k scores, the lowest
        beat[n[last]] = score[last]
        least = -np.inf if (beat == NO_SCORE).any() else float(beat.min())
        return pa.table({"q_block": pa.array([table.column("q_block")[0].as_py()], pa.int64()), "beat": pa.array([beat.astype("<i8").tobytes()], pa.binary()), "least": pa.array([least], pa.float64())})

    sized = seeded.join(asking.select("q_block", (F.length("q_ids") / 8).cast("int").alias("size")), "q_block")
    beats = cut(sized.groupBy("q_block").applyInArrow(thresholds, "q_block bigint, beat binary, least double"))
    # a query block meets the places up to the last block that could reach its least score: a join on the place, not on the dimension alone
    lengths = places.groupBy("dim").agg(F.array_sort(F.collect_list("longest")).alias("lengths"))
    meets = asking.select("dim", "q_block", "q_longest").join(beats.select("q_block", "least"), "q_block", "left").join(lengths, "dim")
    reach = F.filter("lengths", lambda x: F.coalesce("least", F.lit(float("-inf"))) * F.lit(SLACK) <= F.col("q_longest") * x)
    meets = meets.select("dim", "q_block", F.size(reach).alias("upto")).where("upto > 1").select("dim", "q_block", F.explode(F.sequence(F.lit(2), F.col("upto"))).alias("place"))
    rest = meets.join(matrices, ["dim", "place"]).join(asking.drop("q_longest", "dim"), "q_block").join(beats.drop("least"), "q_block", "left")
    found = seeded.union(rest.repartition("q_block", "place").mapInArrow(_search(k), FOUND))

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.select("query_id", "vec_id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(F.col("vec_id") != int(NO_ID), F.col("vec_id")).alias("vec_id"), "score")
