"""A custom stream source that numbers its own rows and resumes where it stopped.

The offsets of the lanes are the source's state. Spark keeps them in the checkpoint of the
query, so a restarted query goes on after the last committed row of every lane.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "evstream_offsets"


class LaneRange(InputPartition):
    def __init__(self, lane: int, start: int, end: int):
        self.lane, self.start, self.end = lane, start, end


class OffsetReader(DataSourceStreamReader):
    def __init__(self, options):
        self.lanes = int(options.get("lanes", 2))
        self.available = int(options["available"])

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        return {"next": self.available}

    def partitions(self, start: dict, end: dict) -> list[LaneRange]:
        return [LaneRange(lane, start["next"], end["next"]) for lane in range(self.lanes)]

    def read(self, partition: LaneRange) -> Iterator[tuple]:
        for offset in range(partition.start, partition.end):
            yield (partition.lane, offset)

    def commit(self, end: dict) -> None:
        pass


class OffsetSource(DataSource):
    """Rows ``(lane, offset)`` for ``lanes`` lanes, of which the offsets below ``available`` can
    be read. Each lane is read by its own task."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "lane int, offset bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return OffsetReader(self.options)
