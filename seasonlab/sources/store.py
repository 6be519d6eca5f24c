"""A weekly store: partitioned by season, bucketed by player, refreshed a season at a time.

A season selection is a partition filter. Season totals and the pairing of seasons group and join
on the player, by which the files are bucketed, so they need no exchange on that key.
A manifest holds a fingerprint of each stored season; a delivery rewrites only the
seasons whose rows changed, and delivering the same rows again writes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.functions.columns import require_columns
from seasonlab.session import materialize
from seasonlab.sources.readers import scratch_path

#: Joins on the player and more keys use the buckets as they are.
CO_PARTITIONED = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.v2.bucketing.enabled": "true"}


def season_fingerprints(df: DataFrame, *, season_col: str = "season") -> DataFrame:
    """(season, rows, a, b) of each season: its number of rows and two sums of row hashes, which the order of rows and columns doesn't change."""
    names = sorted(df.columns)
    # a hash leaves nulls out, so their pattern is hashed too
    row = [*(F.col(c) for c in names), *(F.col(c).isNull() for c in names)]
    sums = [F.sum(F.xxhash64(F.lit(salt), *row).cast("decimal(38,0)")).alias(name) for salt, name in ((1, "a"), (2, "b"))]
    return df.groupBy(season_col).agg(F.count(F.lit(1)).alias("rows"), *sums)


@dataclass(frozen=True)
class WeeklyStore:
    """A stored table of weekly rows (or of what is derived from them by season) named ``table`` in the catalog.

    ``path``: a shared folder that holds its files; without one the warehouse does.
    """

    spark: SparkSession
    table: str
    path: str | None = None
    buckets: int = 64
    season_col: str = "season"
    player_id_col: str = "player_id"

    def __post_init__(self) -> None:
        if not re.fullmatch(r"(\w+\.)*\w+", self.table):
            raise ValueError(f"not a table name: {self.table!r}")

    @property
    def manifest(self) -> str:
        return f"{self.table}_manifest"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.manifest)

    def _save(self, df: DataFrame, name: str, part: str, bucketed: bool) -> None:
        writer = df.write.mode("overwrite").partitionBy(self.season_col).format("parquet")
        if bucketed:
            writer = writer.bucketBy(self.buckets, self.player_id_col).sortBy(self.player_id_col)
        if self.path:
            writer = writer.option("path", f"{self.path.rstrip('/')}/{part}")
        writer.saveAsTable(name)

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows dealt like the buckets, so that a task writes whole buckets: one file a bucket and season."""
        return df.repartition(self.buckets, self.player_id_col)

    def create(self, weekly: DataFrame) -> None:
        """Store all rows anew. Rows without a season are refused."""
        require_columns(weekly, [self.season_col, self.player_id_col])
        weekly = materialize(weekly)
        fingerprints = materialize(season_fingerprints(weekly, season_col=self.season_col))
        if not fingerprints.where(F.col(self.season_col).isNull()).isEmpty():
            raise ValueError(f"rows without a {self.season_col} can't be stored by season")
        self._save(self._dealt(weekly), self.table, "rows", True)
        self._save(fingerprints, self.manifest, "manifest", False)

    def read(self, seasons: Iterable[int] | None = None) -> DataFrame:
        """Stored rows of some seasons (None: all): a partition filter on a bucketed scan."""
        df = self.spark.read.table(self.table)
        return df if seasons is None else df.where(F.col(self.season_col).isin([int(s) for s in seasons]))

    def changed_seasons(self, delivered: DataFrame) -> list[int]:
        """Seasons of a delivery whose rows aren't those that are stored."""
        return self._changed(season_fingerprints(self._same_columns(delivered), season_col=self.season_col))

    def _changed(self, fingerprints: DataFrame) -> list[int]:
        stored = self.spark.read.table(self.manifest).select(*fingerprints.columns)
        rows = fingerprints.exceptAll(stored).select(self.season_col).collect()  # a row a season
        if any(r[0] is None for r in rows):
            raise ValueError(f"rows without a {self.season_col} can't be stored by season")
        return sorted(r[0] for r in rows)

    def _same_columns(self, delivered: DataFrame) -> DataFrame:
        stored = self.spark.read.table(self.table)
        require_columns(delivered, stored.columns, "columns of the store that the delivery lacks")
        return delivered.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema.fields))

    def refresh(self, delivered: DataFrame) -> list[int]:
        """Replace the seasons of a delivery that changed (a delivery holds whole seasons); returns them.

        Only their partitions are rewritten, rows first and the manifest after, so a
        refresh that died is repeated by delivering again.
        """
        delivered = materialize(self._same_columns(delivered))
        fingerprints = materialize(season_fingerprints(delivered, season_col=self.season_col))
        changed = self._changed(fingerprints)
        if changed:
            mine = F.col(self.season_col).isin(changed)
            self._replace(self._dealt(delivered.where(mine)), self.table)
            self._replace(fingerprints.where(mine), self.manifest)
        return changed

    def _replace(self, df: DataFrame, table: str) -> None:
        """Overwrite the partitions that occur in ``df`` and no others."""
        key, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(key)
        conf.set(key, "dynamic")  # an insert takes it from the session alone
        try:
            df.select(*self.spark.read.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            conf.set(key, before)
        self.spark.catalog.refreshTable(table)


def scratch_store(spark: SparkSession, name: str, *, buckets: int = 64, **columns: str) -> WeeklyStore:
    """A store in a fresh folder of the shared scratch area."""
    path = scratch_path(spark, name)
    return WeeklyStore(spark, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets, **columns)


def derived_refresh(source: WeeklyStore, derived: WeeklyStore, derive, changed: Iterable[int]) -> None:
    """Bring a store of what ``derive`` makes of each season's rows up to date for the seasons that changed."""
    changed = list(changed)
    if not derived.exists():
        derived.create(derive(source.read()))
    elif changed:
        derived.refresh(derive(source.read(changed)))
