"""Landing jobs: delimited files inside ZIP archives to splittable tables.

A ZIP member cannot be split, so each member is one task that streams lines in
bounded batches; land it once as Parquet and work from there.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meshtally.operators.shares import with_totals

BATCH_LINES = 50_000


def _open(path: str):
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1)
                                           if path.startswith("file:") else f"file://{path}")
    return system.open_input_file(inner)


def archive_members(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(archive, member) of every file in the archives; a missing archive is an error."""
    # Only the path is read here, and Spark refuses a path that does not exist.
    listed = spark.read.format("binaryFile").load(list(paths)).select("path")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with _open(path) as raw, zipfile.ZipFile(raw) as z:
                    rows += [(path, i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
            yield pd.DataFrame(rows, columns=["archive", "member", "bytes"])

    return listed.mapInPandas(members, "archive string, member string, bytes bigint")


def choose_csv(members: DataFrame, national: bool = False) -> DataFrame:
    """CSV members to read: the per-state files, or with `national` the `_BRASIL` one.

    A national file repeats the state files; reading both would count twice. An
    archive with a single CSV is read whatever its name.
    """
    csv = members.where(F.lower("member").endswith(".csv"))
    repeat = F.upper("member").contains("BRASIL")
    if national:
        return csv.where(F.upper("member").endswith("_BRASIL.CSV"))
    return (with_totals(csv, ["archive"], _n=F.count("*"))
            .where((F.col("_n") == 1) | ~repeat).drop("_n"))


def read_members(members: DataFrame, schema: StructType, sep: str = ";",
                 encoding: str = "latin-1", batch: int = BATCH_LINES) -> DataFrame:
    """Rows of the chosen members, every column as text, only the schema's columns."""
    names = schema.names
    n = members.sparkSession.sparkContext.defaultParallelism

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for archive, member in zip(frame["archive"], frame["member"]):
                with _open(archive) as raw, zipfile.ZipFile(raw) as z, z.open(member) as f:
                    reader = pd.read_csv(io.TextIOWrapper(f, encoding=encoding), sep=sep, dtype=str,
                                         usecols=names, chunksize=batch)
                    for part in reader:
                        yield part[names].astype(object).where(part[names].notna(), None)

    return (members.select("archive", "member").repartition(n, "archive", "member")
            .mapInPandas(rows, schema))


def land(spark: SparkSession, paths: Sequence[str], schema: StructType, target: str,
         national: bool = False) -> DataFrame:
    """Archives to Parquet, once; returns the landed table."""
    read_members(choose_csv(archive_members(spark, paths), national), schema).write.mode(
        "overwrite").parquet(target)
    return spark.read.parquet(target)


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                   sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Delimited text that is already unpacked: splittable, all text, nothing inferred."""
    head = spark.read.csv(paths if isinstance(paths, str) else list(paths), sep=sep,
                          encoding=encoding, header=True, inferSchema=False)
    missing = [c for c in schema.names if c not in head.columns]
    if missing:
        raise ValueError(f"columns missing in {paths}: {missing}")
    return head.select(*schema.names)
