"""Collections of JSON documents that are replaced whole or not at all.

A collection is a folder. Each overwrite writes its documents to a folder of its own, a file
a task; the driver then renames one small file into place that names the live folder and the
files in it. A task that fails is run again under another file name; a job that fails, or is
stopped, leaves the old collection as it was. Files of attempts that did not count are not
named, so no document is there twice.

The store is any folder that all executors and the driver see, in a file system that Arrow
can open (local or mounted paths, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "json_collection"
# The file that names the live folder.
LIVE = "live.json"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; a path without a scheme is a local or mounted one."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its file and the documents in it."""

    file: str
    n: int


class CollectionWriter(DataSourceWriter):
    """Tasks write to ``write-<id>/``; only ``commit`` makes that the collection."""

    def __init__(self, path: str, write: str):
        self.path, self.write_id = path, write

    def folder(self) -> str:
        return f"write-{self.write_id}"

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        files, root = opened(self.path)
        name, n = f"part-{uuid.uuid4().hex}.json", 0
        files.create_dir(f"{root}/{self.folder()}", recursive=True)
        with files.open_output_stream(f"{root}/{self.folder()}/{name}") as out:
            for row in rows:
                out.write(row[0].encode() + b"\n")
                n += 1
        return Written(name, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = opened(self.path)
        done = [m for m in messages if isinstance(m, Written) and m.n]
        files.create_dir(root, recursive=True)
        draft = f"{root}/.draft-{self.write_id}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps({
                "folder": self.folder(), "files": sorted(m.file for m in done),
                "documents": sum(m.n for m in done)}).encode())
        files.move(draft, f"{root}/{LIVE}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = opened(self.path)
        folder = f"{root}/{self.folder()}"
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)


class CollectionSource(DataSource):
    """The format ``json_collection``; takes one string column, a document a row."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not overwrite:
            raise ValueError("a collection is overwritten as a whole")
        if [f.dataType.typeName() for f in schema.fields] != ["string"]:
            raise ValueError("documents come as one column of JSON text")
        return CollectionWriter(self.options["path"], uuid.uuid4().hex)


def write_collection(rows: DataFrame, store: str, name: str) -> None:
    """Overwrite a collection with a document for each row; NULL fields are kept as null."""
    rows.sparkSession.dataSource.register(CollectionSource)
    documents = rows.select(F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"}
    ).alias("document"))
    documents.write.format(FORMAT).mode("overwrite").save(f"{store}/{name}")


def export_collections(tables: Mapping[str, DataFrame], store: str) -> None:
    """Write several frames, each as the collection of its name."""
    for name, rows in tables.items():
        write_collection(rows, store, name)


def live(store: str, name: str) -> dict:
    """Folder, files and number of documents of a collection; fails if there is none."""
    files, root = opened(f"{store}/{name}")
    with files.open_input_stream(f"{root}/{LIVE}") as stream:
        return json.loads(stream.read())


def read_collection(spark: SparkSession, store: str, name: str,
                    schema: StructType | str) -> DataFrame:
    """A collection as it was last written whole; a later overwrite does not touch what is read."""
    of = live(store, name)
    if not of["files"]:
        return spark.createDataFrame([], schema)
    paths = [f"{store}/{name}/{of['folder']}/{file}" for file in of["files"]]
    return spark.read.schema(schema).json(paths)


def clean(store: str, name: str) -> None:
    """Remove what the collection does not name; to be called when no job reads or writes it."""
    files, root = opened(f"{store}/{name}")
    keep = {LIVE, live(store, name)["folder"]}
    for entry in files.get_file_info(fs.FileSelector(root)):
        if entry.base_name not in keep:
            (files.delete_dir if entry.type == fs.FileType.Directory else files.delete_file)(entry.path)
