"""Pluggable weekly-stats sources.

Anything with ``load_weekly_player_stats(season)`` is a source; the
pipelines that take a source also use ``load_weekly_seasons(seasons)`` when
present (one scan for many seasons instead of a per-season loop and union)
and ``load_players()`` for the roster.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from seasonlab.sources.readers import load_players, load_weekly_player_stats, union_by_name
from seasonlab.sources.testbed import roster_from_tables, weekly_from_tables


@runtime_checkable
class WeeklySource(Protocol):
    def load_weekly_player_stats(self, season: int) -> DataFrame: ...


def load_seasons(source: WeeklySource, seasons: Iterable[int] | None) -> DataFrame:
    """Weekly rows of several seasons (None: all that the source has): one scan if the source
    supports it, else the per-season frames stacked by column name (missing -> null)."""
    seasons = None if seasons is None else list(seasons)
    if hasattr(source, "load_weekly_seasons"):
        return source.load_weekly_seasons(seasons)
    if seasons is None:
        raise ValueError("this source loads one season at a time: name the seasons")
    return union_by_name(source.load_weekly_player_stats(s) for s in seasons)


class DatasetSource:
    """Weekly stats and roster stored as datasets (parquet/orc/csv/json/table).

    The weekly dataset is ideally partitioned by ``season``; a season
    selection is then a partition filter. ``read_options`` are the reader's
    (``schema=``, ``options=``, ``merge_schema=``) and hold for the weekly
    dataset, ``players_options`` for the roster. Text columns of a dataset
    without types (CSV) that hold ids, seasons or statistics are cast, see
    ``typed_weekly``.
    """

    def __init__(self, spark: SparkSession, weekly_path: str, players_path: str | None = None, *,
                 fmt: str = "parquet", players_fmt: str | None = None, season_type: str | None = None,
                 players_options: dict | None = None, **read_options):
        self.spark, self.weekly_path, self.players_path = spark, weekly_path, players_path
        self.fmt, self.players_fmt, self.read_options = fmt, players_fmt or fmt, read_options
        self.players_options = players_options or {}
        self.season_type = season_type  # None keeps playoff games too

    def load_weekly_player_stats(self, season: int) -> DataFrame:
        return self.load_weekly_seasons([season])

    def load_weekly_seasons(self, seasons: Iterable[int] | None) -> DataFrame:
        wanted = None if seasons is None else list(seasons)
        return load_weekly_player_stats(self.spark, self.weekly_path, wanted, fmt=self.fmt,
                                        season_type=self.season_type, **self.read_options)

    def load_players(self) -> DataFrame:
        if self.players_path is None:
            raise ValueError("no roster dataset configured")
        return load_players(self.spark, self.players_path, fmt=self.players_fmt, **self.players_options)


class TestbedSource:
    """Weekly stats and roster derived from the driver's order tables (see ``testbed``)."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def load_weekly_player_stats(self, season: int) -> DataFrame:
        return weekly_from_tables(self.spark, self.sf_dir, [season])

    def load_weekly_seasons(self, seasons: Iterable[int] | None) -> DataFrame:
        return weekly_from_tables(self.spark, self.sf_dir, None if seasons is None else list(seasons))

    def load_players(self) -> DataFrame:
        return roster_from_tables(self.spark, self.sf_dir)
