"""Sources and sinks (file/table scans, CSV) and the testbed derivation."""

from seasonlab.sources.base import DatasetSource, TestbedSource, WeeklySource, load_seasons
from seasonlab.sources.feed import FeedSource, SeasonFeed, write_feed
from seasonlab.sources.readers import (
    csv_round_trip,
    load_players,
    load_weekly_player_stats,
    read_csv,
    read_dataset,
    scratch_path,
    typed_weekly,
    union_by_name,
    write_csv,
)
from seasonlab.sources.store import WeeklyStore, derived_refresh, scratch_store
from seasonlab.sources.testbed import ROSTER_SQL, roster_from_tables, seasons_in_tables, table, weekly_from_tables, weekly_sql

__all__ = [
    "DatasetSource",
    "FeedSource",
    "SeasonFeed",
    "TestbedSource",
    "WeeklySource",
    "WeeklyStore",
    "load_seasons",
    "ROSTER_SQL",
    "csv_round_trip",
    "derived_refresh",
    "load_players",
    "load_weekly_player_stats",
    "read_csv",
    "read_dataset",
    "roster_from_tables",
    "scratch_path",
    "scratch_store",
    "seasons_in_tables",
    "table",
    "typed_weekly",
    "union_by_name",
    "weekly_from_tables",
    "weekly_sql",
    "write_csv",
    "write_feed",
]
