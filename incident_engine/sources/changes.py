"""Changed rows of a table as a stream whose offset is the high-water mark.

``spark.readStream.format("changes")`` reads a folder of Parquet files that only ever
gains files. The offset of the stream is the greatest value of the update column seen so
far, in that column's own type and in UTC, so the checkpoint is the mark and the two cannot
part: a micro-batch holds the rows with start < value <= end, a replayed one holds them again.

Options: ``path`` and ``update`` (the column). The schema is the user's; columns are found by
name, those that a file lacks are null. Files are skipped by the statistics in their footers,
row group by row group, and the footer of a file is read once. Each kept piece of a file is a
task of its own. Rows whose update value is null come with the first batch. A row that turns
up later with a value at or below the mark is not seen, as with any pull by a mark.

The files are read where ``pyarrow.fs`` can open the path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of one task.
SPLIT_ROWS = 1_000_000


def to_text(value) -> str | None:
    """A mark for the offset: times in UTC with microseconds."""
    if isinstance(value, datetime):
        value = value.astimezone(UTC) if value.tzinfo else value.replace(tzinfo=UTC)
        return value.isoformat(timespec="microseconds")
    return None if value is None else value.isoformat() if isinstance(value, date) else str(value)


def to_scalar(mark: str, kind: pa.DataType) -> pa.Scalar:
    """The mark in the type of the column, whatever zone a file or session has."""
    if pa.types.is_timestamp(kind):
        moment = datetime.fromisoformat(mark).astimezone(UTC)
        return pa.scalar(moment if kind.tz else moment.replace(tzinfo=None), kind)
    return pa.scalar(mark).cast(kind)


@dataclass(frozen=True)
class Piece(InputPartition):
    """Row groups of a file that may hold rows past ``start`` up to ``end``."""

    path: str
    groups: tuple[int, ...]
    start: str | None
    end: str


class ChangeReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, update: str):
        if update not in schema.fieldNames():
            raise ValueError(f"the schema has no column {update}")
        self.schema = to_arrow_schema(schema)
        self.update, self.location = update, path
        self.kind = self.schema.field(update).type
        #: file -> (length, changed at) and (rows, least, greatest) of each row group
        self.footers: dict[str, tuple[tuple, list[tuple]]] = {}

    def _files(self) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
        store, root = fs.FileSystem.from_uri(self.location) if ":/" in self.location \
            else (fs.LocalFileSystem(), self.location)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        hidden = lambda path: any(p[:1] in "._" for p in path[len(root):].split("/") if p)
        return store, sorted((f for f in found if f.is_file and not hidden(f.path)),
                             key=lambda f: f.path)

    def _groups(self, store: fs.FileSystem, file: fs.FileInfo) -> list[tuple]:
        known = (file.size, file.mtime_ns)
        if self.footers.get(file.path, (None,))[0] != known:
            opened = pq.ParquetFile(store.open_input_file(file.path))
            at = opened.schema_arrow.get_field_index(self.update)
            groups = []
            for i in range(opened.metadata.num_row_groups):
                group = opened.metadata.row_group(i)
                if at < 0:
                    groups.append((group.num_rows, None, None))
                    continue
                groups.append((group.num_rows, *map(self._typed, self._bounds(opened, i, at))))
            self.footers[file.path] = known, groups
        return self.footers[file.path][1]

    def _bounds(self, opened: pq.ParquetFile, group: int, at: int) -> tuple:
        """Least and greatest update value of a row group; read from the values themselves where
        the writer left none or left them in a form without statistics (96-bit times)."""
        bounds = opened.metadata.row_group(group).column(self._leaf(opened, at)).statistics
        try:
            if bounds is not None and bounds.has_min_max:
                return bounds.min, bounds.max
        except pa.ArrowNotImplementedError:
            pass
        column = opened.read_row_group(group, columns=[self.update]).column(0)
        return tuple(pc.min_max(column).as_py().values())

    @staticmethod
    def _leaf(opened: pq.ParquetFile, at: int) -> int:
        name = opened.schema_arrow.field(at).name
        paths = [opened.metadata.schema.column(i).path for i in range(len(opened.metadata.schema))]
        return paths.index(name)

    def _typed(self, value) -> pa.Scalar | None:
        return None if value is None else to_scalar(to_text(value), self.kind)

    def initialOffset(self) -> dict:
        return {"mark": None}

    def latestOffset(self) -> dict:
        store, files = self._files()
        highs = [high for f in files for _, _, high in self._groups(store, f) if high is not None]
        if not highs:
            return self.initialOffset()
        return {"mark": to_text(max(h.as_py() for h in highs))}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        if end["mark"] is None:  # no row has a mark yet
            return []
        store, files = self._files()
        above = start["mark"] and to_scalar(start["mark"], self.kind).as_py()
        upto = to_scalar(end["mark"], self.kind).as_py()
        out: list[Piece] = []
        for file in files:
            held: list[int] = []
            rows = 0
            for i, (n, low, high) in enumerate(self._groups(store, file)):
                first = start["mark"] is None
                if not first and (high is None or high.as_py() <= above) or \
                        not first and low.as_py() > upto:
                    continue
                if held and rows + n > SPLIT_ROWS:
                    out.append(Piece(file.path, tuple(held), start["mark"], end["mark"]))
                    held, rows = [], 0
                held.append(i)
                rows += n
            if held:
                out.append(Piece(file.path, tuple(held), start["mark"], end["mark"]))
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(self.location)[0] if ":/" in self.location \
            else fs.LocalFileSystem()
        file = pq.ParquetFile(store.open_input_file(partition.path))
        there = set(file.schema_arrow.names)
        wanted = [n for n in self.schema.names if n in there]
        for batch in file.iter_batches(row_groups=list(partition.groups), columns=wanted):
            table = pa.table({f.name: batch.column(f.name).cast(f.type) if f.name in there
                              else pa.nulls(batch.num_rows, f.type) for f in self.schema},
                             schema=self.schema)
            value = table[self.update]
            keep = pc.less_equal(value, to_scalar(partition.end, self.kind))
            if partition.start is None:
                keep = pc.fill_null(keep, True)
            else:
                keep = pc.and_(keep, pc.greater(value, to_scalar(partition.start, self.kind)))
            yield from table.filter(keep).to_batches()


class Changes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changes"

    def streamReader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(schema, self.options["path"], self.options["update"])


def stream_changes(spark: SparkSession, path: str, schema: StructType | str, update: str):
    """Stream of the rows of the table at ``path``; its checkpoint holds the mark."""
    spark.dataSource.register(Changes)
    return spark.readStream.format("changes").schema(schema).options(path=path, update=update).load()
