"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.session import ensure_checkpoint_dir


BATCH_BYTES, TEXT_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
DEFAULT_BATCH_BYTES = f"{64 << 20}b"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder (or at ``path`` there) and read it back.

    Later passes, and retries after a lost executor, read the written files
    instead of recomputing what led to them.
    """
    spark = df.sparkSession
    path = path or scratch_place(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_place(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables like scratch_table's for the steps of one operator, deleted when its result no longer reads them."""
    path = scratch_place(spark, name)
    counter = iter(range(1 << 30))

    def table(df: DataFrame, part: str) -> DataFrame:
        at = f"{path}/{next(counter)}-{part}"
        df.write.option("compression", "zstd").parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    try:
        yield table
    finally:
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch tables that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def bound_batches(spark: SparkSession) -> None:
    """Bound the record batches that hold whole texts in bytes, unless the session has a bound of its own.

    The default bounds rows; ten thousand long texts are more than a Python worker should hold.
    """
    if spark.conf.get(BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, TEXT_BATCH_BYTES)


def own_names(df: DataFrame, keep: list[Column], results: list[str]) -> list[str]:
    """The names of the ``keep`` columns; ValueError if one of them is a result's too."""
    names = df.select(*keep).columns
    clash = sorted({n.lower() for n in names} & {n.lower() for n in results})
    if clash:
        raise ValueError(f"keep columns bear the names of results: {clash}; rename them")
    return names


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_key(id_col: Column, text_col: Column) -> Column:
    """A key that two rows share only if both id and text are the same.

    Repeated rows share a key and have the same result, so joining results back
    by it is whole; a null id and a null text have keys of their own.
    """
    return F.struct(
        F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("\0null")), F.coalesce(text_col, F.lit("\0null"))).alias("a"),
        F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("\0null")), F.lit("\0"), F.coalesce(text_col, F.lit("\0null")))).alias("b"),
    )
