"""An endless scan over Parquet files as a Python data source: a stream with offsets of its own, or a batch of some cycles.

The files, in name order, are read again and again. A row's ``place`` numbers it in the endless
sequence, and ``cycle`` and ``part`` (the file) follow from it, so an offset is one number. A micro-batch
takes the next ``rows_per_batch`` places; they are planned as ranges of rows of a file, which tasks read by
row groups. Where a stream stands is Spark's own offset log; the places it has planned are also
kept in the folder ``progress``, because Spark asks a source for its latest offset without telling the
last one. The batch reader takes ``cycles`` of them and prunes ranges by filters on cycle, part and place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pfs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

PLACES = [("place", pa.int64()), ("cycle", pa.int64()), ("part", pa.int32())]


@dataclass
class Rows(InputPartition):
    """Rows first to last of a file, the first of which has this place."""

    path: str
    part: int
    first: int
    last: int
    place: int
    cycle: int


class Files:
    """The files of an endless scan and how many rows each has, from their footers."""

    def __init__(self, options: dict[str, str]):
        self.fs, root = _file_system(options["path"])
        info = self.fs.get_file_info(root)
        found = [info] if info.type == pfs.FileType.File else self.fs.get_file_info(pfs.FileSelector(root, recursive=True))
        self.paths = sorted(f.path for f in found if f.type == pfs.FileType.File and f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))
        if not self.paths:
            raise FileNotFoundError(f"{options['path']}: no Parquet files")
        self.columns = [c.strip() for c in options["columns"].split(",")] if options.get("columns") else None
        self.each = int(options.get("rows_per_task", 100_000))
        if self.each < 1:
            raise ValueError("rows_per_task must be over 0")

    def sizes(self) -> list[int]:
        return [pq.read_metadata(p, filesystem=self.fs).num_rows for p in self.paths]

    def schema(self) -> pa.Schema:
        whole = pq.read_schema(self.paths[0], filesystem=self.fs)
        return pa.schema([whole.field(c) for c in self.columns or whole.names])

    def ranges(self, start: int, end: int) -> list[Rows]:
        """The places from start up to end as ranges of rows."""
        sizes, out, place = self.sizes(), [], start
        total = sum(sizes)
        if not total and end > start:
            raise ValueError("an endless scan of files without rows")
        while place < end:
            cycle, at = divmod(place, total)
            part = 0
            while at >= sizes[part]:
                at -= sizes[part]
                part += 1
            n = min(self.each, sizes[part] - at, end - place)
            out.append(Rows(self.paths[part], part, at, at + n, place, cycle))
            place += n
        return out


def _file_system(path: str) -> tuple[pfs.FileSystem, str]:
    return pfs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pfs.LocalFileSystem(), path)


def read_rows(files: Files, r: Rows | None) -> Iterator[pa.RecordBatch]:
    """The rows of a range with their places, from the row groups that hold them; nothing for None, which stands for no range at all."""
    if r is None:
        return
    with pq.ParquetFile(r.path, filesystem=files.fs) as f:
        at = 0
        for g in range(f.metadata.num_row_groups):
            n = f.metadata.row_group(g).num_rows
            if at < r.last and at + n > r.first:
                for b in f.iter_batches(row_groups=[g], columns=files.columns, batch_size=8192):
                    lo, hi = max(0, r.first - at), min(len(b), r.last - at)
                    if lo < hi:
                        place = r.place + at + lo - r.first
                        own = [pa.array(range(place, place + hi - lo), pa.int64()), pa.array([r.cycle] * (hi - lo), pa.int64()), pa.array([r.part] * (hi - lo), pa.int32())]
                        names = files.columns or b.schema.names
                        yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in names), *own], [*names, *(c for c, _ in PLACES)])
                    at += len(b)
            else:
                at += n


class EndlessStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.files = Files(options)
        self.step = int(options.get("rows_per_batch", 1_000_000))
        if self.step < 1 or not options.get("progress"):
            raise ValueError("an endless stream needs rows_per_batch over 0 and a folder for its progress")
        self.fs, self.progress = _file_system(options["progress"])
        self.start = int(options.get("start_place", 0))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"place": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"place": self._planned() + self.step}

    def _planned(self) -> int:
        if self.fs.get_file_info(f"{self.progress}/planned.json").type == pfs.FileType.NotFound:
            return self.start
        with self.fs.open_input_stream(f"{self.progress}/planned.json") as f:
            return json.loads(f.read())["place"]

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if end["place"] < start["place"]:
            raise ValueError(f"the progress folder is behind the stream's checkpoint: {end} before {start}")
        self.fs.create_dir(self.progress, recursive=True)
        with self.fs.open_output_stream(f"{self.progress}/planned.new") as f:
            f.write(json.dumps({"place": end["place"]}).encode())
        self.fs.move(f"{self.progress}/planned.new", f"{self.progress}/planned.json")
        return self.files.ranges(start["place"], end["place"])

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        return read_rows(self.files, partition)


class EndlessBatch(DataSourceReader):
    """Some cycles of the scan; comparisons of place, cycle and part with a number choose the ranges to read."""

    _TESTS = {EqualTo: lambda lo, hi, v: lo <= v <= hi, GreaterThan: lambda lo, hi, v: hi > v, GreaterThanOrEqual: lambda lo, hi, v: hi >= v, LessThan: lambda lo, hi, v: lo < v, LessThanOrEqual: lambda lo, hi, v: lo <= v, In: lambda lo, hi, v: any(lo <= x <= hi for x in v)}

    def __init__(self, options: dict[str, str]):
        self.files, self.cycles, self.tests = Files(options), int(options.get("cycles", 1)), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if type(f) in self._TESTS and f.attribute in [(c,) for c, _ in PLACES]:
                self.tests.append((f.attribute[0], type(f), f.value))
            yield f  # a range may hold rows on both sides of a number, so Spark filters again

    def partitions(self) -> Sequence[InputPartition]:
        ranges = self.files.ranges(0, self.cycles * sum(self.files.sizes()))
        bounds = lambda r, c: (r.place, r.place + r.last - r.first - 1) if c == "place" else (getattr(r, c),) * 2
        return [r for r in ranges if all(self._TESTS[t](*bounds(r, c), v) for c, t, v in self.tests)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        return read_rows(self.files, partition)


class EndlessCorpus(DataSource):
    """Options: path, columns, rows_per_task; rows_per_batch, progress and start_place of a stream; cycles of a batch."""

    @classmethod
    def name(cls) -> str:
        return "endless_corpus"

    def schema(self) -> StructType:
        return from_arrow_schema(pa.schema([*Files(self.options).schema(), *(pa.field(c, t) for c, t in PLACES)]))

    def reader(self, schema: StructType) -> DataSourceReader:
        return EndlessBatch(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return EndlessStream(self.options)


def register(spark: SparkSession) -> None:
    """Make ``spark.read`` and ``spark.readStream`` know the format ``endless_corpus``."""
    spark.dataSource.register(EndlessCorpus)
