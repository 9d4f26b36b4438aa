"""A Spark data source that reads Parquet files by row group, and skips row groups that pushed filters rule out.

It stands for readers of formats that Spark lacks: one partition a unit of the file, filters judged by what the file says of its units. Files are listed
and read by Arrow, so paths have to be ones that Arrow's file systems know (local, s3, gs, hdfs); Spark's own Parquet reader is
the one to use for anything else. Use ``read``: Spark keeps one reader for all plans of a relation and asks it about filters only where a plan has some, so that a plan without any
would get what an earlier one left of the row groups. ``read`` therefore gives every plan a filter, on the number of the row group, and without that one nothing is skipped. Timestamps without a zone in the file (INT96 as well) are TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import IntegerType, StructType


NUMBER = "_row_group"


@dataclass
class Group(InputPartition):
    path: str
    number: int


def _files(path: str) -> tuple[fs.FileSystem, list[str]]:
    """Data files at a path, in order; names that begin with an underscore or a point are none."""
    store, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [at] if info.is_file else sorted(f.path for f in store.get_file_info(fs.FileSelector(at, recursive=True)) if f.is_file and f.size)
    return store, [f for f in found if not f[len(at) :].rsplit("/", 1)[-1].startswith(("_", "."))]


def may_hold(f: Filter, low: object, high: object) -> bool:
    """Whether a unit whose values lie from low to high can have a row that passes; true where it cannot be told."""
    try:
        if isinstance(f, EqualTo):
            return low <= f.value <= high
        if isinstance(f, In):
            return any(low <= v <= high for v in f.value)
        if isinstance(f, GreaterThan):
            return high > f.value
        if isinstance(f, GreaterThanOrEqual):
            return high >= f.value
        if isinstance(f, LessThan):
            return low < f.value
        if isinstance(f, LessThanOrEqual):
            return low <= f.value
    except TypeError:  # statistics of another type than the filter's value
        return True
    return True


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.filters, self.skips = path, schema, [], False

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Filters only rule out row groups, so Spark applies all of them to the rows as well."""
        filters = list(filters)
        self.skips = any(isinstance(f, GreaterThanOrEqual) and f.attribute == (NUMBER,) for f in filters)
        self.filters = [f for f in filters if isinstance(f, EqualTo | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual | IsNotNull) and len(f.attribute) == 1]
        yield from filters

    def _wanted(self, group: pq.RowGroupMetaData) -> bool:
        for k in range(group.num_columns):
            column = group.column(k)
            own = [f for f in self.filters if f.attribute[0] == column.path_in_schema]
            stats = column.statistics if own else None
            if stats is None:
                continue
            if stats.has_null_count and stats.null_count == group.num_rows:
                return False  # each of these filters passes values alone
            if stats.has_min_max and not all(may_hold(f, stats.min, stats.max) for f in own):
                return False
        return True

    def partitions(self) -> list[Group]:
        store, files = _files(self.path)
        out = []
        for name in files:
            meta = pq.read_metadata(name, filesystem=store)
            out += [Group(name, i) for i in range(meta.num_row_groups) if not self.skips or self._wanted(meta.row_group(i))]
        return out

    def read(self, partition: Group | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where no row group is left
            return
        store, _ = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), "")
        with store.open_input_file(partition.path) as f:
            names = [n for n in self.schema.names if n != NUMBER]
            for batch in pq.ParquetFile(f, coerce_int96_timestamp_unit="us").iter_batches(batch_size=8192, row_groups=[partition.number], columns=names):
                yield batch.select(names).append_column(NUMBER, pa.array(np.full(batch.num_rows, partition.number, np.int32)))


class RowGroups(DataSource):
    """The columns of the files at ``path``, and the number of each row's group in its file."""

    @classmethod
    def name(cls) -> str:
        return "rowgroups"

    def schema(self) -> StructType:
        store, files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no data files at {self.options['path']}")
        return from_arrow_schema(pq.read_schema(files[0], filesystem=store), prefer_timestamp_ntz=True).add(NUMBER, IntegerType())

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, one task a row group; the session gets to know the format, and pushes filters to data sources in Python."""
    spark.dataSource.register(RowGroups)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(RowGroups.name()).load(path).where(F.col(NUMBER) >= 0)
