"""A streaming sink with a two-phase commit.

``livetable_committed`` is a Data Source writer.  Phase one: every task writes its rows to
a file of its own under ``files/`` and sends the file's name as its commit message.  Phase
two, on the driver: ``commit`` puts the names of a batch's files into ``_commits/<batch>.json``
in one rename.  Readers take the files that a commit names, and no others:

* a task that is lost or runs twice leaves a file that no commit names;
* ``abort`` deletes the files of a batch that failed;
* a batch id that is committed already is refused: the replay's files are deleted, and the
  output stays as the first attempt left it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from livetable.session import ship_package
from livetable.sources.topic import list_json, open_fs, put_json

FORMAT = "livetable_committed"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its file (none where it had no rows) and the rows in it."""
    file: str | None
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_fs(f"{self.path}/files")
        name, out, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        for b in iterator:
            if not b.num_rows:
                continue
            if out is None:
                fs.create_dir(root, recursive=True)
                out = pq.ParquetWriter(f"{root}/{name}", b.schema, filesystem=fs)
            out.write_batch(b)
            rows += b.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list, batchId: int) -> None:
        files = [m for m in messages if m is not None and m.file]
        if batchId in list_json(f"{self.path}/_commits"):
            self._delete(files)
            return
        put_json(f"{self.path}/_commits/{batchId}.json", [{"file": m.file, "rows": m.rows} for m in files])

    def abort(self, messages: list, batchId: int) -> None:
        self._delete([m for m in messages if m is not None and m.file])

    def _delete(self, files: list) -> None:
        fs, root = open_fs(f"{self.path}/files")
        for m in files:
            fs.delete_file(f"{root}/{m.file}")


class CommittedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"])


def committed_sink(spark: SparkSession) -> str:
    """Register the sink with the session; returns its format name."""
    ship_package(spark)
    spark.dataSource.register(CommittedSink)
    return FORMAT


def commits(path: str) -> dict[int, list[dict]]:
    """Files and rows of each committed batch."""
    return list_json(f"{path}/_commits")


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    files = [f"{path}/files/{f['file']}" for batch in commits(path).values() for f in batch]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)
