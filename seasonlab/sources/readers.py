"""Readers and sinks: weekly stats, roster, CSV round trips.

A "source" is any DataFrame with the weekly columns; these helpers cover the
usual storage: a (season-partitioned) parquet/ORC/CSV/JSON dataset or a catalog
table. Season selection is a predicate, so on a dataset
partitioned by ``season`` it becomes a partition filter and whole folders are
skipped; on other layouts it is pushed to the file scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seasonlab.session import ensure_checkpoint_dir


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet", *, schema: StructType | str | None = None,
                 options: dict | None = None, merge_schema: bool = False) -> DataFrame:
    """Scan a dataset. ``merge_schema`` reconciles parquet files written with
    different column sets (it reads every footer, so it is opt-in); an explicit
    ``schema`` is cheaper and also tolerates missing columns (read as null)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if fmt == "parquet" and merge_schema:
        reader = reader.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path) if fmt != "table" else spark.read.table(path)


# Columns of weekly rows that name things; of the rest, text whose name has one
# of these as a whole word (between underscores) is a statistic.
LABEL_COLUMNS = ("player_id", "player_display_name", "position", "season_type")
WHOLE_COLUMNS = ("season", "week", "game_id")
STATISTIC_WORDS = ("yards", "tds", "interceptions", "receptions", "fumble", "fumbles", "recoveries", "carries",
                   "targets", "attempts", "made", "sacks", "age")


def typed_weekly(df: DataFrame) -> DataFrame:
    """Weekly rows whose text columns have their types: seasons, weeks and games bigint, statistics double.

    Columns with a type keep it; ids and names stay text. Text that is no
    number becomes null.
    """
    casts = {}
    for f in df.schema.fields:
        if f.dataType.typeName() != "string" or f.name in LABEL_COLUMNS:
            continue
        if f.name in WHOLE_COLUMNS:
            casts[f.name] = F.expr(f"try_cast(`{f.name}` AS BIGINT)")
        elif set(f.name.lower().split("_")) & set(STATISTIC_WORDS):
            casts[f.name] = F.expr(f"try_cast(`{f.name}` AS DOUBLE)")
    return df.withColumns(casts) if casts else df


def load_weekly_player_stats(spark: SparkSession, path: str, seasons: int | Iterable[int] | None = None, *,
                             fmt: str = "parquet", season_col: str = "season", season_type: str | None = None,
                             season_type_col: str = "season_type", **kw) -> DataFrame:
    """Weekly rows of one season or several (one scan, no per-season loop).

    By default every game of the season is kept (regular season and
    playoffs alike); ``season_type`` (e.g. ``"REG"``) keeps one kind only.
    """
    df = typed_weekly(read_dataset(spark, path, fmt, **kw))
    if seasons is not None:
        wanted = [int(seasons)] if isinstance(seasons, int) else [int(s) for s in seasons]
        df = df.where(F.col(season_col).isin(wanted))
    if season_type is not None:
        df = df.where(F.col(season_type_col) == F.lit(season_type))
    return df


def load_players(spark: SparkSession, path: str, *, fmt: str = "parquet", **kw) -> DataFrame:
    """Roster dimension (one row per player)."""
    return read_dataset(spark, path, fmt, **kw)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing from a frame becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/seasonlab-{name}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV with a header, in the order of ``df``: one file if ``path`` ends with ``.csv``, else a folder of part files.

    The one file is written by one task, which streams the partitions one after
    the other: for tables bounded by a parameter, like a ranking. It is moved to its
    place when it is complete; with ``mode="error"`` a file that is there already is kept and raises.
    """
    if not path.endswith(".csv"):
        df.write.mode(mode).option("header", "true").csv(path)
        return
    if mode not in ("overwrite", "error", "errorifexists"):
        raise ValueError(f"one CSV file can be overwritten or refused, not written with mode {mode!r}")
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path
    target, parts = place(path), place(f"{path}.{uuid.uuid4().hex}.parts")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode != "overwrite" and files.exists(target):
        raise FileExistsError(path)
    try:
        df.coalesce(1).write.option("header", "true").csv(parts.toString())
        written = [f.getPath() for f in files.listStatus(parts) if f.getPath().getName().endswith(".csv")]
        if len(written) != 1:
            raise RuntimeError(f"{len(written)} part files instead of one for {path}")
        files.delete(target, True)
        if not files.rename(written[0], target):
            raise RuntimeError(f"the complete file could not be moved to {path}")
    finally:
        files.delete(parts, True)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def csv_round_trip(df: DataFrame, name: str = "csv", *, one_file: bool = False) -> DataFrame:
    """Write ``df`` as CSV to the shared scratch area and read it back with its schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name) + (".csv" if one_file else "")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)
