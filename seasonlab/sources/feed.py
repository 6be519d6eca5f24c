"""A season feed as a Spark data source: record streams that none of Spark's formats read.

The rows lie in Arrow streams, ``<folder>/season=<s>/<part>.arrows`` on any file system that Arrow
opens. ``spark.read.format("season_feed")`` plans one partition a stream, hands record batches to
Spark as they come, and takes filters on the season, so other seasons' streams aren't opened. A
subclass that overrides ``streams`` and ``batches`` reads a service or a database the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import StructType

from seasonlab.sources.readers import load_players, load_weekly_player_stats

NAME = "season_feed"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; a path without a scheme, or ``file:``, is a shared mount."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Stream(InputPartition):
    """One stream of one season."""

    season: int
    path: str


class SeasonFeedReader(DataSourceReader):
    def __init__(self, schema: StructType, folder: str, season_col: str) -> None:
        self.fields, self.folder, self.season_col = schema.names, folder, season_col
        self.seasons: set[int] | None = None  # None: all

    def pushFilters(self, filters: list) -> Iterator:
        """Keeps filters that name seasons; the others are Spark's."""
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if wanted is not None and f.attribute == (self.season_col,):
                self.seasons = wanted if self.seasons is None else self.seasons & wanted
            else:
                yield f

    def streams(self) -> Iterable[Stream]:
        """All streams of the feed, by name alone."""
        files, root = _opened(self.folder)
        for info in files.get_file_info(fs.FileSelector(root, recursive=True)):
            folder = info.path.rsplit("/", 2)[-2]
            if info.base_name.endswith(".arrows") and folder.startswith("season="):
                yield Stream(int(folder.removeprefix("season=")), info.path)

    def batches(self, stream: Stream) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(self.folder)
        with files.open_input_stream(stream.path) as raw, pa.ipc.open_stream(raw) as batches:
            yield from batches

    def partitions(self) -> list[Stream]:
        found = [s for s in self.streams() if self.seasons is None or s.season in self.seasons]
        return sorted(found, key=lambda s: (s.season, s.path))

    def read(self, partition: Stream) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no stream at all
            return
        for batch in self.batches(partition):
            yield batch.select(self.fields)


class SeasonFeed(DataSource):
    """Options: ``path`` (the folder) and ``season_col`` (default ``season``); the schema is the user's."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: StructType) -> SeasonFeedReader:
        return SeasonFeedReader(schema, self.options["path"], self.options.get("season_col", "season"))


def write_feed(weekly: DataFrame, folder: str, *, season_col: str = "season") -> int:
    """Write rows as a feed, each task its own streams of the seasons that it holds; returns the number of streams.

    Streams get their names when they are complete; a task that is tried again
    writes under other names, so only the streams that its last attempt reports stay.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _opened(folder)
        token, open_ = uuid.uuid4().hex, {}
        for batch in batches:
            season = batch.column(batch.schema.get_field_index(season_col))
            for s in season.unique().to_pylist():
                if s not in open_:
                    files.create_dir(f"{root}/season={s}", recursive=True)
                    raw = files.open_output_stream(f"{root}/season={s}/{token}.writing")
                    open_[s] = raw, pa.ipc.new_stream(raw, batch.schema)
                open_[s][1].write_batch(batch.filter(pc.equal(season, s)))
        for raw, stream in open_.values():
            stream.close()
            raw.close()
        if open_:
            yield pa.RecordBatch.from_pydict({"season": pa.array(list(open_), pa.int64()), "token": [token] * len(open_)})

    done = weekly.where(F.col(season_col).isNotNull()).mapInArrow(write, "season long, token string")
    files, root = _opened(folder)
    streams = 0
    for season, token in done.collect():  # a row a stream
        files.move(f"{root}/season={season}/{token}.writing", f"{root}/season={season}/{token}.arrows")
        streams += 1
    return streams


class FeedSource:
    """A pluggable weekly source over a feed; the roster is a stored dataset."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType | str, players_path: str | None = None) -> None:
        self.spark, self.folder, self.schema, self.players_path = spark, folder, schema, players_path
        spark.dataSource.register(SeasonFeed)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")

    def load_weekly_player_stats(self, season: int) -> DataFrame:
        return self.load_weekly_seasons([season])

    def load_weekly_seasons(self, seasons: Iterable[int] | None) -> DataFrame:
        return load_weekly_player_stats(self.spark, self.folder, None if seasons is None else list(seasons), fmt=NAME, schema=self.schema)

    def load_players(self) -> DataFrame:
        if self.players_path is None:
            raise ValueError("no roster dataset configured")
        return load_players(self.spark, self.players_path)
