"""The table of rejected texts as a data source of its own: what a run or micro-batch writes is there whole and once, or not at all.

    rejected.write.format("masthead_rejections").option("path", …).option("run", "run-17").mode("append").save()
    spark.read.format("masthead_rejections").option("path", …).load()

Tasks write Parquet files under names that nobody else uses. When all have succeeded, the driver puts down the list of the run's
files, in one step; readers see listed files only. A run that is written again replaces its own list, so a replay changes
nothing; files of failed tasks and aborted runs are in no list. The path must be in a file system that pyarrow can
open (a shared folder, HDFS).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from masthead.schema import REJECTIONS

NAME = "masthead_rejections"
_RUN = re.compile(r"[A-Za-z0-9._-]+")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    file: str | None  # None: the task had no rows


@dataclass
class OneFile(InputPartition):
    file: str


class RejectionTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return REJECTIONS

    def writer(self, schema, overwrite: bool) -> RunWriter:
        if overwrite:
            raise ValueError("a run replaces what it wrote itself; use append")
        return RunWriter(self.options["path"], self.options["run"])

    def reader(self, schema) -> ListedReader:
        return ListedReader(self.options["path"])


class RunWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str) -> None:
        if not _RUN.fullmatch(run):
            raise ValueError("a run is named with letters, digits, dots, dashes and underscores")
        self.path, self.run = path, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        files, root = _opened(self.path)
        writer = name = None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    name = f"data/{uuid.uuid4().hex}.parquet"
                    files.create_dir(f"{root}/data")
                    writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=files)
                writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _opened(self.path)
        listed = [m.file for m in messages if m is not None and m.file is not None]
        files.create_dir(f"{root}/runs")
        draft = f"{root}/runs/.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps(listed).encode())
        files.move(draft, f"{root}/runs/{self.run}.json")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _opened(self.path)
        for m in messages:
            if m is not None and m.file is not None:
                files.delete_file(f"{root}/{m.file}")


class ListedReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[OneFile]:
        files, root = _opened(self.path)
        found = files.get_file_info(fs.FileSelector(f"{root}/runs", allow_not_found=True))
        out: list[OneFile] = []
        for info in found:
            if info.base_name.endswith(".json") and not info.base_name.startswith("."):
                with files.open_input_stream(info.path) as stream:
                    out += [OneFile(name) for name in json.loads(stream.read())]
        return out or [OneFile("")]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        if partition.file:
            files, root = _opened(self.path)
            with pq.ParquetFile(f"{root}/{partition.file}", filesystem=files) as file:
                yield from file.iter_batches()


def write_rejections(rejected: DataFrame, path: str, run: str) -> None:
    """Write the rejections of one run or micro-batch. Repeating it, after a failure or not, leaves each of them once."""
    spark = rejected.sparkSession
    spark.dataSource.register(RejectionTable)
    rejected.write.format(NAME).option("path", path).option("run", run).mode("append").save()


def read_rejections(spark: SparkSession, path: str) -> DataFrame:
    """The rejections of all runs."""
    spark.dataSource.register(RejectionTable)
    return spark.read.format(NAME).option("path", path).load()
