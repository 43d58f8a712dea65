"""How sinks put a frame into a folder: Spark's own files, or a two-phase writer.

A writer is a function (frame, path, format, mode, partition_by). :func:`spark_files` is the
default. :func:`staged_files` is a Python data source with two phases: every task writes into
a hidden folder of the job and names its files in a commit message; when all tasks are done
the driver moves the named files to their places, and when one fails it removes the hidden
folder, so readers never see part of a job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

Writer = Callable[..., None]
TEXTS = ("json", "csv")
OPEN = "_open"


def spark_files(df: DataFrame, path: str, format: str = "parquet", mode: str = "append", partition_by: list[str] = ()) -> None:
    """Spark's file writer."""
    out = df.write.mode(mode)
    if partition_by:
        out = out.partitionBy(*partition_by)
    if format == "csv":
        out = out.option("header", True)
    out.format(format).save(path)


def staged_files(df: DataFrame, path: str, format: str = "parquet", mode: str = "append", partition_by: list[str] = ()) -> None:
    """All files of the job or none. The path must be one that pyarrow can open from every task."""
    register(df.sparkSession)
    options = {"path": path, "fileFormat": format, "partitionBy": json.dumps(list(partition_by))}
    if format in TEXTS:
        # Spark makes the lines, so that text files are the same from either writer.
        inner = [c for c in df.columns if c not in partition_by]
        line = F.to_json(F.struct(*inner)) if format == "json" else F.to_csv(F.struct(*inner))
        options["header"] = "" if format == "json" else ",".join(inner)
        df = df.select(line.alias("value"), *partition_by)
    if partition_by:
        # One file is open at a time.
        df = df.sortWithinPartitions(*partition_by)
    df.write.format("staged").options(**options).mode(mode).save()


def register(spark: SparkSession) -> None:
    """Make ``format("staged")`` known to the session."""
    spark.dataSource.register(StagedFiles)


class StagedFiles(DataSource):
    """Write-only source: options path, fileFormat (parquet, csv, json) and partitionBy."""

    @classmethod
    def name(cls) -> str:
        return "staged"

    def writer(self, schema: T.StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(
            self.options["path"], self.options.get("fileFormat", "parquet"),
            json.loads(self.options.get("partitionBy", "[]")), self.options.get("header", ""), overwrite,
        )


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, as (path below the root, rows)."""

    files: list[tuple[str, int]] = field(default_factory=list)


class StagedWriter(DataSourceArrowWriter):
    """Tasks write below ``_staging-<job>``; the driver moves or removes."""

    def __init__(self, path: str, format: str, partition_by: list[str], header: str, overwrite: bool) -> None:
        self.path, self.format, self.partition_by, self.header, self.overwrite = path, format, partition_by, header, overwrite
        self.job = uuid.uuid4().hex
        # Says that the job goes on; tasks that find it gone clear away what they made.
        system, root = self._place()
        system.create_dir(f"{root}/_staging-{self.job}", recursive=True)
        system.open_output_stream(f"{root}/_staging-{self.job}/{OPEN}").close()

    def _place(self) -> tuple[fs.FileSystem, str]:
        if "://" not in self.path and not self.path.startswith("file:"):
            return fs.LocalFileSystem(), self.path.rstrip("/")
        system, root = fs.FileSystem.from_uri(self.path.replace("file:/", "file:///", 1) if self.path.startswith("file:/") and not self.path.startswith("file://") else self.path)
        return system, root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = self._place()
        done = Written()
        current, sink, target = None, None, None
        # Names are new in every attempt, so one that failed leaves nothing with a name of value.
        attempt = uuid.uuid4().hex
        for batch in iterator:
            for folder, part in self._by_partition(batch):
                if folder != current:
                    if sink:
                        sink.close()
                    name = f"{folder}part-{attempt}-{len(done.files):05d}.{self.format}"
                    target = f"{root}/_staging-{self.job}/{name}"
                    system.create_dir(target.rpartition("/")[0], recursive=True)
                    stream = system.open_output_stream(target)
                    sink = _Lines(stream, self.header) if self.format in TEXTS else pa.parquet.ParquetWriter(stream, part.schema)
                    done.files.append((name, 0))
                    current = folder
                sink.write(part)
                name, rows = done.files[-1]
                done.files[-1] = (name, rows + part.num_rows)
        if sink:
            sink.close()
        # A task that was still running when the job was given up.
        if system.get_file_info(f"{root}/_staging-{self.job}/{OPEN}").type == fs.FileType.NotFound:
            self._forget(system, root)
            raise RuntimeError("the write was aborted")
        return done

    def _by_partition(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        """Stretches of equal partition values of a sorted batch, without those columns."""
        if not self.partition_by:
            yield "", batch
            return
        keys = list(zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in self.partition_by], strict=True))
        body = batch.select([c for c in batch.schema.names if c not in self.partition_by])
        start = 0
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                folder = "".join(f"{c}={_folder_value(v)}/" for c, v in zip(self.partition_by, keys[start], strict=True))
                yield folder, body.slice(start, end - start)
                start = end

    def commit(self, messages: list[Written | None]) -> None:
        system, root = self._place()
        names = [name for m in messages if m for name, _ in m.files]
        old = _visible(system, root) if self.overwrite else []
        for name in names:
            system.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            system.move(f"{root}/_staging-{self.job}/{name}", f"{root}/{name}")
        for name in old:
            system.delete_file(name)
        self._forget(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._forget(*self._place())

    def _forget(self, system: fs.FileSystem, root: str) -> None:
        staging = f"{root}/_staging-{self.job}"
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)


def _visible(system: fs.FileSystem, root: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return [f.path for f in found if f.is_file and not any(p.startswith(("_", ".")) for p in f.path[len(root) + 1 :].split("/"))]


def _folder_value(value: object) -> str:
    """A partition value as Spark spells it in a folder name."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^\x7f' or ord(c) < 32 else c for c in text)


class _Lines:
    """A file of lines from one text column."""

    def __init__(self, stream: pa.NativeFile, header: str) -> None:
        self.stream = stream
        if header:
            stream.write(f"{header}\n".encode())

    def write(self, batch: pa.RecordBatch) -> None:
        self.stream.write("".join(f"{t}\n" for t in batch.column(0).to_pylist()).encode())

    def close(self) -> None:
        self.stream.close()
