"""Ridge fits by a tall-skinny QR: rows shrink to triangles, triangles merge in a tree by group.

Every task reduces its rows ``[1, features, target]`` of a group to the triangle R of
their QR factorisation, a batch at a time. Triangles of a group, FAN_IN tasks at a
time, are stacked and reduced again, and once more for what is left. No product
of two columns is ever summed, so nearly collinear features (age and its square)
lose no digits, and a fit takes any number of features. The first row and column of a group's
triangle hold the means, the rest is the QR of the centred columns: ridge solves
min |R w - z|^2 + alpha |w|^2 there, in the task that holds the triangle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Tasks whose triangles of a group meet in one task of the first merge.
FAN_IN = 128
#: Numbers that the triangles of one task may hold before they are handed on.
HELD_NUMBERS = 4_000_000
OUT_ROWS, OUT_BYTES = 2048, 16 << 20
COUNTS = ("n_train", "n_test", "n_bad")


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of the rows' QR; rows fewer than their columns stay as they are."""
    return np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows


class _Group:
    """What is known of one group: counts, seasons of either side and rows that have the same Gram matrix as all its train rows."""

    __slots__ = ("counts", "seasons", "rows")

    def __init__(self, width: int) -> None:
        self.counts = np.zeros(len(COUNTS), np.int64)
        self.seasons: set[int] = set()
        self.rows = np.zeros((0, width))

    def add(self, counts: np.ndarray, seasons: set[int], rows: np.ndarray) -> None:
        self.counts += counts
        self.seasons |= seasons
        if len(rows):
            self.rows = _triangle(np.concatenate([self.rows, rows]))


def _schema(keys: list[T.StructField], with_seasons: bool) -> T.StructType:
    fields = [*keys, T.StructField("_bin", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in COUNTS)]
    if with_seasons:
        fields.append(T.StructField("seasons", T.ArrayType(T.LongType())))
    return T.StructType([*fields, T.StructField("triangle", T.BinaryType())])


def _row(key: tuple, bin_: int | None, own: _Group, with_seasons: bool) -> tuple:
    seasons = (sorted(own.seasons),) if with_seasons else ()
    return (*key, *(() if bin_ is None else (bin_,)), *own.counts.tolist(), *seasons, own.rows.astype("<f8").tobytes())


class _Out:
    """Rows that leave a task, as record batches of a bounded size."""

    def __init__(self, schema: T.StructType) -> None:
        self.schema, self.rows, self.bytes = to_arrow_schema(schema), [], 0

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += sum(len(x) for x in row if isinstance(x, bytes))
        if len(self.rows) == OUT_ROWS or self.bytes > OUT_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self.rows, self.bytes = [], 0


def partial_triangles(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, season_col: str, train_end_season: int,
                      group_cols: Sequence[str] = (), with_seasons: bool = True) -> DataFrame:
    """One row for each task and group: counts of train, test and unusable rows (a null, NaN or infinite feature or target), and a triangle.

    Rows without a season are on neither side and aren't counted.
    """
    keys, values = list(group_cols), [*feature_cols, target_col]
    rows = df.where(F.col(season_col).isNotNull()).select(
        *keys, F.col(season_col).cast("long").alias("_season"), *(F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(values)))
    key_fields = [df.schema[c] for c in keys]
    schema = _schema(key_fields, with_seasons)
    width = len(values) + 1

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, groups, held, out = TaskContext.get().partitionId(), {}, 0, _Out(schema)
        for batch in batches:
            season = batch.column(len(keys)).to_numpy()
            x = np.empty((batch.num_rows, width))
            x[:, 0] = 1
            for i in range(len(values)):  # a null becomes NaN
                x[:, i + 1] = batch.column(len(keys) + 1 + i).to_numpy(zero_copy_only=False)
            sound = np.isfinite(x).all(axis=1)
            train = season <= train_end_season
            if keys:
                encoded = [batch.column(i).dictionary_encode() for i in range(len(keys))]
                code = np.zeros(batch.num_rows, np.int64)
                for e in encoded:
                    code = code * (len(e.dictionary) + 1) + e.indices.fill_null(len(e.dictionary)).to_numpy()
                order = np.argsort(code, kind="stable")
                starts = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0])
            else:
                order, starts = np.arange(batch.num_rows), np.zeros(min(1, batch.num_rows), int)
            for at in np.split(order, starts[1:]) if len(starts) else []:
                key = tuple(batch.column(i)[int(at[0])].as_py() for i in range(len(keys)))
                own = groups.setdefault(key, _Group(width))
                on_train = train[at]
                counts = np.array([on_train.sum(), len(at) - on_train.sum(), (~sound[at]).sum()])
                seasons = set(np.unique(season[at]).tolist()) if with_seasons else set()
                before = len(own.rows)
                own.add(counts, seasons, x[at[on_train & sound[at]]])
                held += len(own.rows) - before
            if held * width > HELD_NUMBERS:
                for key, own in groups.items():
                    yield from out.add(_row(key, task, own, with_seasons))
                groups, held = {}, 0
        for key, own in groups.items():
            yield from out.add(_row(key, task, own, with_seasons))
        yield from out.flush()

    return rows.mapInArrow(reduce, schema)


def _merged(partial: DataFrame, keys: list[str], width: int, by: list[str], schema: T.StructType, finish) -> DataFrame:
    """Fold the rows that share ``by`` into one, which ``finish(key, bin, group)`` turns into a row of ``schema``; one group is held at a time."""
    with_seasons = "seasons" in partial.columns
    dealt = partial.repartition(*by).sortWithinPartitions(*by) if by else partial.repartition(1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, out = None, None, _Out(schema)
        for batch in batches:
            for row in batch.to_pylist():
                name = tuple(row[c] for c in by)
                if own is not None and name != last[0]:
                    yield from out.add(finish(*last[1:], own))
                    own = None
                if own is None:
                    last, own = (name, tuple(row[k] for k in keys), row["_bin"]), _Group(width)
                own.add(np.array([row[c] for c in COUNTS]), set(row["seasons"]) if with_seasons else set(),
                        np.frombuffer(row["triangle"], "<f8").reshape(-1, width))
        if own is not None:
            yield from out.add(finish(*last[1:], own))
        yield from out.flush()

    return dealt.mapInArrow(fold, schema)


def solve_triangle(rows: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Ridge weights and the unpenalised intercept from a group's triangle of ``[1, features, target]``."""
    p = rows.shape[1] - 2
    r = np.linalg.qr(rows, mode="r")
    means = r[0] / r[0, 0]
    x, y = r[1:, 1 : p + 1], r[1:, p + 1]
    stacked = np.concatenate([x, np.sqrt(alpha) * np.eye(p)])
    w = np.linalg.lstsq(stacked, np.concatenate([y, np.zeros(p)]), rcond=None)[0]
    return w, float(means[p + 1] - means[1 : p + 1] @ w)


def ridge_table(df: DataFrame, *, feature_cols: Sequence[str], target_col: str, season_col: str, train_end_season: int, alpha: float,
                group_cols: Sequence[str] = (), with_seasons: bool = True) -> DataFrame:
    """One row a group: its keys, n_train, n_test, n_bad, [seasons,] triangle, weights and intercept (null where there are no usable train or no test rows).

    The result is lazy and solved in the cluster; it has as many rows as there are groups.
    """
    keys = list(group_cols)
    width = len(feature_cols) + 2
    partial = partial_triangles(df, feature_cols=feature_cols, target_col=target_col, season_col=season_col, train_end_season=train_end_season,
                                group_cols=keys, with_seasons=with_seasons)
    partial = partial.withColumn("_bin", (F.col("_bin") / F.lit(FAN_IN)).cast("int"))
    merged = _merged(partial, keys, width, [*keys, "_bin"], partial.schema, lambda key, bin_, own: _row(key, bin_, own, with_seasons))
    schema = T.StructType([f for f in partial.schema.fields if f.name != "_bin"])
    schema = schema.add("weights", T.ArrayType(T.DoubleType())).add("intercept", T.DoubleType())

    def solve(key: tuple, bin_: int, own: _Group) -> tuple:
        w, b = solve_triangle(own.rows, alpha) if len(own.rows) and own.counts[1] else (None, None)
        return (*_row(key, None, own, with_seasons), None if w is None else w.tolist(), b)

    return _merged(merged, keys, width, keys, schema, solve)
