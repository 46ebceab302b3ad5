"""Published documents as versions: `df.write.format("published")` swaps them in at once.

Documents (a text column `value`) lie in one folder for each value of a key, in files of
bounded size that are named by their content. A task writes its files, then a list of them;
the commit names these lists in a new version and moves that into place. A write that fails
leaves the publication as it was, a file that a lost task left is named by no list, and a
file whose content did not change is not written again.

Readers take the newest version. The folders are partitions, so a query for some keys reads
only theirs.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote_plus

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from meshtally.sources.documents import json_rows

FILE_BYTES = 4 << 20
LISTED = "arquivo string, chave string, bytes bigint, sha512 string, documentos bigint, modificado timestamp"
VERSION = re.compile(r"(\d{12})\.json")


def _folder(key: str) -> str:
    """A key as a folder name of plain letters on every file system; `~` stands for `%`."""
    return quote_plus(key).replace("~", "%7E").replace("%", "~")


def _folder_column(key: Column) -> Column:
    """`_folder` as a column."""
    return F.replace(F.replace(F.url_encode(key), F.lit("*"), F.lit("%2A")), F.lit("%"), F.lit("~"))


def _place(path: str) -> tuple[fs.FileSystem, str]:
    system, root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return system, root.rstrip("/")


def _put(system: fs.FileSystem, path: str, content: bytes) -> None:
    """Write a file that is seen whole or not at all."""
    folder, name = path.rsplit("/", 1)
    system.create_dir(folder)
    draft = f"{folder}/.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(content)
    system.move(draft, f"{folder}/{name}")


def _newest(system: fs.FileSystem, root: str) -> int | None:
    found = system.get_file_info(fs.FileSelector(f"{root}/versoes", allow_not_found=True))
    numbers = [int(m[1]) for f in found if (m := VERSION.fullmatch(f.base_name))]
    return max(numbers, default=None)


def _lists(path: str) -> list[str]:
    system, root = _place(path)
    newest = _newest(system, root)
    if newest is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    with system.open_input_file(f"{root}/versoes/{newest:012d}.json") as f:
        return json.loads(f.read())["listas"]


@dataclass
class Written(WriterCommitMessage):
    """The list of a task's files, and how many documents they hold."""

    name: str | None
    documents: int


class PublishedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        keys = [n for n in schema.names if n != "value"]
        if "value" not in schema.names or len(keys) != 1 or any(f.dataType.simpleString() != "string" for f in schema):
            raise ValueError(f"documents have one key and a value, both text, not {schema.simpleString()}")
        self.path, self.key, self.overwrite = path, keys[0], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        self.system, self.root = _place(self.path)
        rows, open_key, held, size, documents = [], None, [], 0, 0
        for batch in iterator:
            keys = batch.column(batch.schema.get_field_index(self.key)).to_pylist()
            for key, value in zip(keys, batch.column(batch.schema.get_field_index("value")).to_pylist()):
                if not key or value is None:
                    raise ValueError("a document without a key or a text")
                line = value.encode() + b"\n"
                if held and (key != open_key or size + len(line) > FILE_BYTES):
                    rows.append(self._file(open_key, held))
                    held, size = [], 0
                open_key = key
                held.append(line)
                size += len(line)
                documents += 1
        if held:
            rows.append(self._file(open_key, held))
        if not rows:
            return Written(None, 0)
        name = f"{uuid.uuid4().hex}.jsonl"
        _put(self.system, f"{self.root}/listas/{name}", "".join(json.dumps(r) + "\n" for r in rows).encode())
        return Written(name, documents)

    def _file(self, key: str, lines: list[bytes]) -> dict:
        content = b"".join(lines)
        digest = hashlib.sha512(content).hexdigest()
        name = f"{self.key}={_folder(key)}/{digest[:40]}.jsonl"
        place = f"{self.root}/documentos/{name}"
        if self.system.get_file_info(place).type == fs.FileType.NotFound:
            _put(self.system, place, content)
        there = self.system.get_file_info(place)
        return {"arquivo": name, "chave": key, "bytes": len(content), "sha512": digest, "documentos": len(lines),
                "modificado": there.mtime.strftime("%Y-%m-%dT%H:%M:%S.%fZ")}

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _place(self.path)
        newest = _newest(system, root)
        lists = [] if self.overwrite or newest is None else _lists(self.path)
        lists += [m.name for m in messages if m and m.name]
        state = {"listas": lists, "documentos": sum(m.documents for m in messages if m)}
        _put(system, f"{root}/versoes/{0 if newest is None else newest + 1:012d}.json", json.dumps(state).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """No version names what the tasks wrote, so the publication is as before."""


class Published(DataSource):
    @classmethod
    def name(cls) -> str:
        return "published"

    def writer(self, schema: StructType, overwrite: bool) -> PublishedWriter:
        return PublishedWriter(self.options["path"], schema, overwrite)


def publish(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """Documents of the rows of `df` as the next version; NaN in one refuses all.

    `overwrite` replaces the publication, `append` adds to it. Equal rows give equal files
    where the same rows come to a task together. An empty frame publishes an empty version.
    """
    df.sparkSession.dataSource.register(Published)
    rows = json_rows(df.withColumn("_key", F.col(key).cast("string")), ["_key"]).select(F.col("_key").alias(key), "value")
    # Small folders come to one task, a huge one to many.
    rows = rows.hint("rebalance", key).sortWithinPartitions(key, "value")
    rows.write.format("published").mode(mode).save(path)


def published_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of the newest version, as `documents.publish_diff` and `integrity_audit` compare them."""
    root = path.rstrip("/")
    lists = [f"{root}/listas/{name}" for name in _lists(path)]
    if not lists:
        return spark.createDataFrame([], LISTED)
    return spark.read.schema(LISTED).json(lists).distinct()


def read_published(spark: SparkSession, path: str, key: str, asked: DataFrame | None = None) -> DataFrame:
    """(key, value) of the newest version; with `asked` only of the keys in its column of that name.

    The asked keys prune the folders while the query runs.
    """
    root = path.rstrip("/") + "/documentos"
    files = published_files(spark, path)
    system, place = _place(root)
    if system.get_file_info(place).type == fs.FileType.NotFound:
        return spark.createDataFrame([], f"{key} string, value string")
    text = spark.read.schema(f"value string, {key} string").text(root).select(
        F.col(key).alias("_folder"), "value", F.col("_metadata.file_name").alias("_file"))
    if asked is not None:
        # No folder has an empty name; saying so lets the planner prune by the asked ones.
        wanted = asked.select(_folder_column(F.col(key).cast("string")).alias("_folder")).distinct()
        text = text.join(wanted.where("_folder > ''"), "_folder", "left_semi")
    live = files.select(_folder_column(F.col("chave")).alias("_folder"), F.col("chave").alias(key),
                        F.element_at(F.split("arquivo", "/"), -1).alias("_file"))
    return text.join(live, ["_folder", "_file"]).select(key, "value")
