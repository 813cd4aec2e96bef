"""The data source "tfrecord": files of framed records, one binary column value.

mode raw (framing=raw when writing) leaves the frames out; such records can't be told apart again.
"""

from __future__ import annotations

import glob
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from larkspur.functions.protobuf import crc32c_many, framed, unmask
from larkspur.sources.named import local_path


class File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class RecordReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = local_path(path)

    def partitions(self) -> list[File]:
        found = [self.path] if os.path.isfile(self.path) else glob.glob(os.path.join(self.path, "**", "*.tfrecord"), recursive=True)
        return [File(f) for f in sorted(found) if not os.path.basename(f).startswith(("_", "."))]

    def read(self, partition: File) -> Iterator:
        """Some thousand records, or some MB, at a time: a file needn't fit in memory. A head that isn't sound is found before its length is trusted beyond the file's."""
        import struct

        left = os.path.getsize(partition.path)
        with open(partition.path, "rb") as f:
            more = True
            while more:
                heads, bodies, sums, size = [], [], [], 0
                while len(bodies) < 4096 and size < 1 << 22:
                    head = f.read(12)
                    if not head:
                        more = False
                        break
                    (n,) = struct.unpack("<Q", head[:8]) if len(head) == 12 else (left,)
                    if n > left - 16:
                        raise ValueError(f"no record's head in {partition.path}")
                    body, tail = f.read(n), f.read(4)
                    left -= n + 16
                    heads.append(head)
                    bodies.append(body)
                    sums.append(struct.unpack("<I", tail)[0])
                    size += n
                for head, c in zip(heads, crc32c_many([h[:8] for h in heads]).tolist(), strict=True):
                    if unmask(struct.unpack("<I", head[8:])[0]) != c:
                        raise ValueError(f"no record's head in {partition.path}")
                for body, m, c in zip(bodies, sums, crc32c_many(bodies).tolist(), strict=True):
                    if unmask(m) != c:
                        raise ValueError(f"a wrong record in {partition.path}")
                    yield (body,)


@dataclass
class Written(WriterCommitMessage):
    at: str
    to: str


class RecordWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = local_path(options["path"]), overwrite
        self.raw = options.get("framing", "tfrecord") == "raw"

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        os.makedirs(self.path, exist_ok=True)
        name = f"part-{TaskContext.get().partitionId():05d}.tfrecord"
        at = os.path.join(self.path, f"_{uuid.uuid4().hex}")
        with open(at, "wb") as f:
            while some := [bytes(row[0]) for row in islice(iterator, 4096)]:
                f.write(b"".join(some if self.raw else framed(some)))
        return Written(at, os.path.join(self.path, name))

    def commit(self, messages: list) -> None:
        if self.overwrite:
            for f in glob.glob(os.path.join(self.path, "part-*.tfrecord")):
                os.remove(f)
        elif any(m and os.path.exists(m.to) for m in messages):
            self.abort(messages)
            raise FileExistsError(self.path)
        for m in messages:
            if m:
                os.rename(m.at, m.to)

    def abort(self, messages: list) -> None:
        for m in messages:
            if m and os.path.exists(m.at):
                os.remove(m.at)


class TFRecord(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return "value binary"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(TFRecord)
