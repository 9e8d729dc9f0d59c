"""YAML as a data source: `spark.read.format("yaml")` and `df.write.format("yaml")`, once `register(spark)` was called.

A file is a row for each of its documents. With a schema, a column is the mapping's key of that name; `file` is the path below the
folder. Without one, rows are (file, document, json), with keys in the order of the file. Writing takes the same rows back:
one file a row, keys in the order of the schema or of the JSON, under an optional header of comments.

A write shows all of its files or none: tasks write aside, and the commit moves their files once all have ended. Paths go
through Arrow's file systems (local folders, hdfs and others by their scheme).
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

PLAIN = "file string, document int, json string"
#: Lines are not broken before this width (fixed value of the files at hand).
WIDTH = 1000


def _yaml():
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading or writing YAML needs the package yaml on driver and executors") from e
    return yaml


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def as_type(value, kind: T.DataType):
    """A YAML value as a value of a Spark type: scalars by their text where a string is asked for, null where it doesn't fit."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(as_type(value.get(f.name), f.dataType) for f in kind.fields) if isinstance(value, dict) else None
    if isinstance(kind, T.MapType):
        return {as_type(k, kind.keyType): as_type(v, kind.valueType) for k, v in value.items()} if isinstance(value, dict) else None
    if isinstance(kind, T.ArrayType):
        return [as_type(v, kind.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(kind, T.StringType):
        if isinstance(value, (dict, list)):
            return json.dumps(value, ensure_ascii=False, default=str)
        return str(value).lower() if isinstance(value, bool) else str(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return value if isinstance(value, datetime.date) else None
    number = float if isinstance(kind, (T.DoubleType, T.FloatType)) else int
    return number(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and (number is float or value == int(value)) else None


@dataclass
class FilePart(InputPartition):
    path: str
    name: str


class YamlReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, plain: bool):
        self.path, self.schema, self.plain = path, schema, plain

    def partitions(self) -> list[FilePart]:
        files, root = _open(self.path)
        info = files.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            return [FilePart(root, info.base_name)]
        below = files.get_file_info(fs.FileSelector(root, recursive=True))
        found = sorted(x.path for x in below if x.type == fs.FileType.File and x.extension in ("yaml", "yml") and "/_" not in x.path[len(root) :])
        return [FilePart(p, p[len(root) :].lstrip("/")) for p in found]

    def read(self, part: FilePart) -> Iterator[tuple]:
        files, _ = _open(self.path)
        with files.open_input_stream(part.path) as stream:
            documents = list(_yaml().safe_load_all(stream.read().decode("utf-8")))
        for k, document in enumerate(documents):
            if self.plain:
                yield part.name, k, json.dumps(document, ensure_ascii=False, default=str)
                continue
            if document is not None and not isinstance(document, dict):
                raise ValueError(f"{part.path}: document {k} is no mapping")
            held = {"file": part.name, "document": k} | (document or {})
            yield tuple(as_type(held.get(f.name), f.dataType) for f in self.schema.fields)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def plain_value(value):
    """A row's value as YAML's own types; keys keep their order."""
    if isinstance(value, T.Row):
        return {k: plain_value(v) for k, v in zip(value.__fields__, value, strict=True)}
    if isinstance(value, dict):
        return {k: plain_value(v) for k, v in value.items()}
    return [plain_value(v) for v in value] if isinstance(value, list) else value


class YamlWriter(DataSourceWriter):
    def __init__(self, path: str, schema: T.StructType, header: str, overwrite: bool):
        self.path, self.header, self.overwrite = path, header, overwrite
        self.names = [f.name for f in schema.fields]
        if "file" not in self.names:
            raise ValueError("a row says by its column `file` where it is written")
        self.plain = set(self.names) <= {"file", "document", "json"} and "json" in self.names
        self.aside = f"_yaml-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        yaml = _yaml()
        files, root = _open(self.path)
        part = uuid.uuid4().hex
        names = []
        for row in rows:
            held = {n: plain_value(v) for n, v in zip(self.names, row, strict=True)}
            name = held.pop("file")
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"{name!r} is no place below the folder")
            held.pop("document", None)
            body = yaml.safe_dump(json.loads(held["json"]) if self.plain else held, allow_unicode=True, sort_keys=False, width=WIDTH)
            at = f"{root}/{self.aside}/{part}/{name}"
            files.create_dir(at.rpartition("/")[0], recursive=True)
            with files.open_output_stream(at) as stream:
                stream.write((self.header + body).encode("utf-8"))
            names.append(f"{part}/{name}")
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        moved = {}
        for name in (n for m in messages if m is not None for n in m.names):
            moved.setdefault(name.partition("/")[2], []).append(name)
        twice = [n for n, c in Counter({n: len(x) for n, x in moved.items()}).items() if c > 1]
        held = [] if self.overwrite else [n for n in moved if files.get_file_info(f"{root}/{n}").type != fs.FileType.NotFound]
        if twice or held:
            self.abort(messages)
            raise ValueError(f"written by two rows: {sorted(twice)[:20]}; there already: {sorted(held)[:20]}")
        for name, (source,) in moved.items():
            files.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            files.move(f"{root}/{self.aside}/{source}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        if files.get_file_info(f"{root}/{self.aside}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.aside}")


class YamlSource(DataSource):
    """Options: path, and header (comment lines, for writing). Mode append refuses to replace a file, overwrite replaces those it writes."""

    @classmethod
    def name(cls) -> str:
        return "yaml"

    def schema(self) -> str:
        return PLAIN

    def reader(self, schema: T.StructType) -> YamlReader:
        return YamlReader(self.options["path"], schema, schema.names == [f.split()[0] for f in PLAIN.split(", ")])

    def writer(self, schema: T.StructType, overwrite: bool) -> YamlWriter:
        return YamlWriter(self.options["path"], schema, self.options.get("header", ""), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(YamlSource)


#: A book's catalogue and its files of rules, as far as operators read them.
VERSION = "struct<kind: string, language: string, content: string, pages: string, folder: string, split_pdf: string>"
BOOK = (
    "file string, id string, title string, web_title string, printed_page_offset int, page_count int, ethnic_groups array<string>, "
    "sources array<struct<pdf: string, pages: int>>, unassigned_pages string, ocr struct<include: string, exclude: string>, "
    f"works array<struct<id: string, title: string, ethnic_group: string, collection: string, genre: string, versions: array<{VERSION}>>>"
)
RULE = "array<struct<spelling: string, `except`: array<string>>>"
RULES = f"file string, words {RULE}, phrases {RULE}, depends array<array<string>>"
TITLES = "file string, titles array<struct<pdf: int, title: string>>"
