"""A partitioned message log read by offsets: every micro-batch covers a range of
offsets of each partition, as a broker's topic is read.

The log is a folder of Parquet segments, ``<log>/partition=<p>/<segment>``, each
sorted by offset (``write_offset_log``).  ``OffsetLogSource`` is a Python data
source for it: the driver plans ranges from the segments' footers, tasks read
theirs as Arrow batches, row groups outside a range skipped.

* **Offsets per partition.**  A batch's start and end are ``{partition: next
  offset}``.  Spark stores them in the checkpoint, so a restart goes on where the
  last planned batch ended, in the middle of a segment too, and a batch that was
  not finished is planned again with the same range.
* **Admission.**  ``maxOffsetsPerTrigger`` bounds a batch to so many offsets (or one of
  each partition, if there are more of these), dealt by what each has waiting.  Spark doesn't tell a Python source
  where the query stands when it asks for the latest offsets, so the bound needs the
  ``checkpoint`` option: the query's own checkpoint folder, whose newest entry is read.
* **Tasks.**  A partition's range is cut into pieces of ``maxOffsetsPerTask``.

Paths are opened through Arrow's file systems (``file:``, ``s3:``, ``hdfs:``, ...).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from fanwrite.sources.messages import MESSAGE_SCHEMA

TASK_OFFSETS = 1_000_000
COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields]

Offsets = dict[str, int]


class Segment(NamedTuple):
    path: str
    first: int
    end: int  # the offset after its last


def write_offset_log(messages: DataFrame, path: str) -> str:
    """Adds messages to a log, a folder for each partition, each file sorted by offset.

    Files are contiguous ranges of ``(partition, offset)``, as many as the shuffle
    sizes them.  An append must hold offsets above those already there.
    """
    by = ("partition", "offset")
    rows = messages.select(*COLUMNS).repartitionByRange(*by).sortWithinPartitions(*by)
    rows.write.mode("append").partitionBy("partition").parquet(path)
    return path


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


class SegmentIndex:
    """The segments of a log by partition, from their footers, each read once."""

    def __init__(self, path: str) -> None:
        self.fs, self.root = _open(path)
        self.known: dict[str, Segment | None] = {}

    def refresh(self) -> dict[str, list[Segment]]:
        found: dict[str, list[Segment]] = {}
        selector = pafs.FileSelector(self.root, recursive=True, allow_not_found=True)
        for info in self.fs.get_file_info(selector):
            parts = info.path[len(self.root) :].strip("/").split("/")
            if info.type != pafs.FileType.File or len(parts) != 2 or not parts[0].startswith("partition=") or parts[1][0] in "._":
                continue  # also what a writer has not committed yet
            if info.path not in self.known:
                self.known[info.path] = self._segment(info.path)
            if segment := self.known[info.path]:
                found.setdefault(parts[0].partition("=")[2], []).append(segment)
        return {p: sorted(segments, key=lambda s: s.first) for p, segments in found.items()}

    def _segment(self, path: str) -> Segment | None:
        footer = pq.read_metadata(path, filesystem=self.fs)
        column = footer.schema.names.index("offset")
        groups = [footer.row_group(g).column(column).statistics for g in range(footer.num_row_groups) if footer.row_group(g).num_rows]
        return Segment(path, min(s.min for s in groups), max(s.max for s in groups) + 1) if groups else None


def admitted(start: Offsets, waiting: Mapping[str, list[Segment]], limit: int | None) -> Offsets:
    """The end of the next batch: all that waits, or ``limit`` offsets of it: one of each
    partition that has any, the others in proportion to what each has."""
    ends = {p: max(start.get(p, 0), segments[-1].end) for p, segments in waiting.items()}
    ends |= {p: o for p, o in start.items() if p not in ends}
    lag = {p: n for p, segments in sorted(waiting.items()) if (n := _waiting(segments, start.get(p, 0)))}
    total = sum(lag.values())
    if limit is None or total <= limit:
        return ends
    rest, others, so_far, given = max(0, limit - len(lag)), total - len(lag), 0, 0
    for p, n in lag.items():
        so_far += n - 1
        share = rest * so_far // max(1, others) - given
        given += share
        ends[p] = _after(waiting[p], start.get(p, 0), 1 + share)
    return ends


def _waiting(segments: Sequence[Segment], start: int) -> int:
    return sum(max(0, s.end - max(s.first, start)) for s in segments)


def _after(segments: Sequence[Segment], start: int, n: int) -> int:
    """The offset after the next ``n`` of the segments' ranges from ``start`` on."""
    at = start
    for s in segments:
        if n > 0 and s.end > at:
            first = max(s.first, at)
            at = min(s.end, first + n)
            n -= at - first
    return at


def checkpointed(path: str) -> Offsets | None:
    """The end offsets of the newest batch that a query has planned (None: it is new)."""
    fs, root = _open(path.rstrip("/") + "/offsets")
    infos = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    batches = [(int(i.base_name), i.path) for i in infos if i.base_name.isdigit()]
    if not batches:
        return None
    with fs.open_input_stream(max(batches)[1]) as f:
        lines = f.read().decode("utf-8").splitlines()
    return json.loads(lines[2])  # version, metadata, then a line for each source


class Range(InputPartition):
    def __init__(self, partition: int, paths: Sequence[str], first: int, end: int):
        self.partition, self.paths, self.first, self.end = partition, list(paths), first, end


class OffsetLogReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int | None, per_task: int, checkpoint: str | None, starting: str) -> None:
        self.path, self.limit, self.per_task, self.checkpoint, self.starting = path, limit, per_task, checkpoint, starting
        self.index: SegmentIndex | None = None
        self.at: Offsets | None = None  # the end of the newest batch planned, once known

    def _segments(self) -> dict[str, list[Segment]]:
        self.index = self.index or SegmentIndex(self.path)
        return self.index.refresh()

    def initialOffset(self) -> Offsets:
        found = self._segments()
        self.at = {p: s[-1].end if self.starting == "latest" else s[0].first for p, s in found.items()}
        return self.at

    def latestOffset(self) -> Offsets:
        if self.limit is not None:
            planned = checkpointed(self.checkpoint)
            self.at = planned if planned is not None else self.at
        return admitted(self.at or {}, self._segments(), self.limit)

    def partitions(self, start: Offsets, end: Offsets) -> list[Range]:
        found = self._segments()
        ranges = []
        for p, stop in sorted(end.items()):
            first = start.get(p, 0)
            while first < stop:
                to = min(stop, _after(found.get(p, []), first, self.per_task))
                if to <= first:
                    break  # nothing lies between
                paths = [s.path for s in found[p] if s.first < to and s.end > first]
                ranges.append(Range(int(p), paths, first, to))
                first = to
        return ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        fields = [c for c in COLUMNS if c != "partition"]
        for path in partition.paths:
            with pq.ParquetFile(fs.open_input_file(path)) as file:
                at = file.metadata.schema.names.index("offset")
                stats = [file.metadata.row_group(g).column(at).statistics for g in range(file.num_row_groups)]
                groups = [g for g, s in enumerate(stats) if s and s.min < partition.end and s.max >= partition.first]
                for batch in file.iter_batches(row_groups=groups, columns=fields):
                    offset = batch.column("offset")
                    inside = pc.and_(pc.greater_equal(offset, partition.first), pc.less(offset, partition.end))
                    batch = batch.filter(inside)
                    if len(batch):
                        yield _message_batch(batch, partition.partition)

    def commit(self, end: Offsets) -> None:
        pass


ARROW = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
    ]
)


def _message_batch(batch: pa.RecordBatch, partition: int) -> pa.RecordBatch:
    columns = {n: batch.column(n) for n in batch.schema.names} | {"partition": pa.array([partition] * len(batch), pa.int32())}
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in ARROW], schema=ARROW)


class OffsetLogSource(DataSource):
    """Options: ``path``; ``maxOffsetsPerTrigger`` (with ``checkpoint``),
    ``maxOffsetsPerTask``, ``startingOffsets`` (``earliest``, the default, or
    ``latest``: for a new query only)."""

    @classmethod
    def name(cls) -> str:
        return "offset_log"

    def schema(self) -> str:
        return "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"

    def streamReader(self, schema) -> OffsetLogReader:
        limit, checkpoint = self.options.get("maxOffsetsPerTrigger"), self.options.get("checkpoint")
        if limit and not checkpoint:
            raise ValueError("maxOffsetsPerTrigger needs the option checkpoint: the query's checkpoint folder")
        starting = self.options.get("startingOffsets", "earliest")
        if starting not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets is earliest or latest, not {starting}")
        return OffsetLogReader(self.options["path"], int(limit) if limit else None, int(self.options.get("maxOffsetsPerTask", TASK_OFFSETS)), checkpoint, starting)


def offset_log_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Streaming read of a log written by :func:`write_offset_log`, in the form of the
    other message sources (see :class:`OffsetLogSource` for the options)."""
    spark.dataSource.register(OffsetLogSource)
    return spark.readStream.format("offset_log").options(path=path, **options).load().select(*(F.col(c) for c in COLUMNS))
