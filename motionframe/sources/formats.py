"""Formats for spark.read and df.write: detections of videos, and clips under new names.

    register(spark)
    spark.read.format("detections").option("decoder", "my.module:decode").load(folder)
    clips.write.format("clips").mode("append").save(folder)

A decoder is a function of (path, first, last) that yields detections of the
frames from first up to last, which is None for all; it stands for a video
decoder and a pose tracker, neither of which is here.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from importlib import import_module
from typing import Any

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from .containers import properties
from .files import DETECTIONS
from .remote import Ranges, below, located

#: Rows that a reader hands over at once, and bytes that a writer copies at once.
ROWS, PIECE = 4096, 1 << 20


@dataclass
class Part(InputPartition):
    path: str
    first: int
    last: int | None

    def __init__(self, path: str, first: int, last: int | None):
        super().__init__((path, first, last))
        self.path, self.first, self.last = path, first, last


class Detections(DataSource):
    """Options: path, decoder (module:function), suffix (.mp4), and frames, the most that one task decodes (all).

    With `frames`, a file's header says where it is cut; a decoder whose
    tracker needs a video as a whole leaves it out.
    """

    @classmethod
    def name(cls) -> str:
        return "detections"

    def schema(self) -> str:
        return "path string, " + DETECTIONS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        for needed in ("path", "decoder"):
            if needed not in options:
                raise ValueError(f"the option {needed} is needed")
        self.options, self.schema, self.tests = options, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes those on the path, so that files they leave out aren't opened."""
        made = {
            EqualTo: lambda f: lambda p: p == f.value, In: lambda f: lambda p: p in set(f.value), StringStartsWith: lambda f: lambda p: p.startswith(f.value),
            StringEndsWith: lambda f: lambda p: p.endswith(f.value), StringContains: lambda f: lambda p: f.value in p,
        }
        for f in filters:
            if type(f) in made and tuple(f.attribute) == ("path",):
                self.tests.append(made[type(f)](f))
            else:
                yield f

    def partitions(self) -> list[Part]:
        most, out = int(self.options.get("frames", 0)), []
        for path, _ in below(self.options["path"], self.options.get("suffix", ".mp4")):
            if not all(t(path) for t in self.tests):
                continue
            if not most:
                out.append(Part(path, 0, None))
                continue
            with Ranges(path) as file:
                n = properties(file, file.size).frames
            out += [Part(path, at, min(at + most, n)) for at in range(0, n, most)]
        return out

    def read(self, part: Part | None) -> Iterator[pa.RecordBatch]:
        if part is None or not hasattr(part, "path"):  # nothing is left to read
            return
        module, _, function = self.options["decoder"].partition(":")
        decode = getattr(import_module(module), function)
        kinds, rows = to_arrow_schema(self.schema), []
        for row in decode(part.path, part.first, part.last):
            rows.append({"path": part.path} | row)
            if len(rows) == ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, str]]


class Clips(DataSource):
    """Writes rows(source, name) as copies of the files `source`, or rows(content, name) as files of that content, below the path.

    Tasks write to a hidden folder of their job; the commit moves its files to
    their names, in place of files of an earlier run, and an abort deletes it.
    So a job that fails changes nothing, and one that runs again ends the same.
    Two rows of one name are an error, as is a name with a folder in it.
    """

    @classmethod
    def name(cls) -> str:
        return "clips"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("clips are added to a folder; it isn't emptied")
        if "path" not in self.options:
            raise ValueError("the option path is needed")
        names = schema.names
        if "name" not in names or ("source" in names) == ("content" in names):
            raise ValueError("rows need a name, and either a source or a content")
        return _Writer(self.options["path"].rstrip("/"), "source" in names)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, copies: bool):
        self.path, self.copies = path, copies
        self.stage = f"{path}/_clips-{uuid.uuid4().hex}"
        files, stage = located(self.stage)
        files.create_dir(stage, recursive=True)

    def write(self, rows: Iterator[Any]) -> Staged:
        files, stage = located(self.stage)
        task, out = f"{stage}/{uuid.uuid4().hex}", []
        files.create_dir(task, recursive=False)  # a task that is still at work after an abort must not bring the folder back
        for k, row in enumerate(rows):
            if not row.name or "/" in row.name or row.name.startswith("_"):
                raise ValueError(f"{row.name!r} is no name for a clip")
            at = f"{task}/{k}"
            with files.open_output_stream(at) as to:
                if not self.copies:
                    to.write(row.content)
                else:
                    theirs, source = located(row.source)
                    with theirs.open_input_stream(source) as file:
                        while piece := file.read(PIECE):
                            to.write(piece)
            out.append((at, row.name))
        return Staged(out)

    def commit(self, messages: list[Staged | None]) -> None:
        files, path = located(self.path)
        moves = [x for m in messages if m is not None for x in m.files]
        names = [name for _, name in moves]
        if len(set(names)) < len(names):
            twice = sorted({n for n in names if names.count(n) > 1})[:3]
            self.abort(messages)
            raise ValueError(f"more than one clip has the name {', '.join(twice)}")
        for at, name in moves:
            to = f"{path}/{name}"
            if files.get_file_info(to).type == arrow_fs.FileType.File and not isinstance(files, arrow_fs.LocalFileSystem):
                files.delete_file(to)  # else a move replaces it
            files.move(at, to)
        self._forget()

    def abort(self, messages: list[Staged | None]) -> None:
        self._forget()

    def _forget(self) -> None:
        files, stage = located(self.stage)
        for last in (False, False, True):  # a task that is being stopped may add a file meanwhile
            if files.get_file_info(stage).type == arrow_fs.FileType.NotFound:
                return
            try:
                files.delete_dir(stage)
            except OSError:
                if last:
                    raise


def register(spark: SparkSession, push: bool = True) -> None:
    """Makes both formats known, and lets filters on the path reach the reader."""
    if push:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (Detections, Clips):
        spark.dataSource.register(source)


def detections_schema() -> StructType:
    return _parse_datatype_string("path string, " + DETECTIONS)
