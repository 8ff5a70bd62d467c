"""A batched sink with a commit protocol: all rows of a run appear, or none.

A task opens a session at the target, sends batches of a stated number of rows and hands in a message. Only when every
task has handed one in does the driver publish the run, in one step. Attempts that failed, were lost with an executor or
ran twice handed in no message that counts, so their rows never show. A run that was published is not published again.

``FolderTarget`` keeps rows as parquet, a file per task with a row group per batch, and a manifest per run. A target in a
database implements the same methods: a staging table per session, and one transaction that moves what was handed in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from weftmart.sources.jdbc import WAREHOUSE_BATCH_ROWS


@dataclass
class Handed(WriterCommitMessage):
    place: str | None  # None: the task had no rows
    rows: int


class Session(Protocol):
    def send(self, batch: pa.RecordBatch) -> None: ...
    def finish(self) -> Handed: ...
    def drop(self) -> None: ...


class Target(Protocol):
    def open(self, run: str, schema: pa.Schema) -> Session: ...
    def published(self, run: str) -> bool: ...
    def publish(self, run: str, handed: Sequence[Handed], replace: bool) -> None: ...
    def discard(self, handed: Sequence[Handed]) -> None: ...


def batches_of(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of exactly ``size`` rows, the last one shorter; at most one batch more is held."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in rows:
        while batch.num_rows:
            part = batch.slice(0, size - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == size:
                yield _joined(held)
                held, count = [], 0
    if count:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class _FileSession:
    def __init__(self, folder: str, run: str, schema: pa.Schema):
        self.system, place = fs.FileSystem.from_uri(folder)
        self.system.create_dir(f"{place}/rows", recursive=True)
        # the name is the attempt's own, so that attempts of one task do not meet
        self.name = f"rows/{run}-{uuid.uuid4().hex}.parquet"
        self.place, self.rows = f"{place}/{self.name}", 0
        self.writer = pq.ParquetWriter(self.place, schema, filesystem=self.system)

    def send(self, batch: pa.RecordBatch) -> None:
        self.writer.write_batch(batch, row_group_size=batch.num_rows)
        self.rows += batch.num_rows

    def finish(self) -> Handed:
        self.writer.close()
        return Handed(self.name, self.rows)

    def drop(self) -> None:
        self.writer.close()
        self.system.delete_file(self.place)


@dataclass(frozen=True)
class FolderTarget:
    """A folder that every executor can reach. One run is published at a time."""

    folder: str

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder)

    def open(self, run: str, schema: pa.Schema) -> _FileSession:
        return _FileSession(self.folder, run, schema)

    def manifests(self) -> list[dict]:
        """The published runs in order."""
        system, place = self._place()
        found = system.get_file_info(fs.FileSelector(f"{place}/runs", allow_not_found=True))
        names = sorted(f.path for f in found if f.path.endswith(".json"))
        return [json.loads(system.open_input_file(name).read()) for name in names]

    def published(self, run: str) -> bool:
        return any(m["run"] == run for m in self.manifests())

    def publish(self, run: str, handed: Sequence[Handed], replace: bool) -> None:
        system, place = self._place()
        system.create_dir(f"{place}/runs", recursive=True)
        files = [{"file": h.place, "rows": h.rows} for h in handed if h.place]
        text = json.dumps({"run": run, "replace": replace, "files": files})
        # written aside under a name that readers skip, then named: it is there whole or not at all
        aside, number = f"{place}/runs/{uuid.uuid4().hex}.part", len(self.manifests())
        with system.open_output_stream(aside) as out:
            out.write(text.encode())
        system.move(aside, f"{place}/runs/{number:08d}.json")

    def discard(self, handed: Sequence[Handed]) -> None:
        system, place = self._place()
        for h in handed:
            if h and h.place:
                system.delete_file(f"{place}/{h.place}")

    def rows(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The rows of all published runs since the last one that replaced the others."""
        files: list[str] = []
        for manifest in self.manifests():
            files = ([] if manifest["replace"] else files) + [f"{self.folder}/{f['file']}" for f in manifest["files"]]
        return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


class _Writer(DataSourceArrowWriter):
    def __init__(self, target: Target, run: str, batch_rows: int, replace: bool):
        self.target, self.run, self.batch_rows, self.replace = target, run, batch_rows, replace

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Handed:
        session = None
        try:
            for batch in batches_of(iterator, self.batch_rows):
                session = session or self.target.open(self.run, batch.schema)
                session.send(batch)
        except BaseException:
            if session:
                session.drop()
            raise
        return session.finish() if session else Handed(None, 0)

    def commit(self, messages: list[Handed]) -> None:
        # the run may have been published by a driver that was lost before it could say so
        if self.target.published(self.run):
            self.target.discard(messages)
        else:
            self.target.publish(self.run, messages, self.replace)

    def abort(self, messages: list[Handed | None]) -> None:
        self.target.discard([m for m in messages if m])


def write_batched(df: DataFrame, target: Target, run: str, batch_rows: int = WAREHOUSE_BATCH_ROWS, replace: bool = False) -> None:
    """Add the rows of ``df`` to the target as the run of that name, or put them in place of all others."""
    if batch_rows < 1:
        raise ValueError("a batch has at least one row")
    if target.published(run):
        return

    class Batched(DataSource):
        @classmethod
        def name(cls) -> str:
            return "weftmart_batched"

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
            return _Writer(target, run, batch_rows, overwrite)

    df.sparkSession.dataSource.register(Batched)
    df.write.format("weftmart_batched").mode("overwrite" if replace else "append").save()
