"""What several operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshtally.session import shared_dir

TEXT_SLICE = 4 << 20  # characters handled at a time inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_bytes(path: str) -> bytes:
    """A vocabulary file, read by the driver; tasks get its content with the job."""
    with open(path, "rb") as f:
        return f.read()


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a frame to the shared folder and continue from the table.

    The run's folder is removed when the driver ends.
    """
    spark = df.sparkSession
    run = f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(run)
    files = folder.getFileSystem(conf)
    files.mkdirs(folder)  # only what exists can be marked for removal
    files.deleteOnExit(folder)
    path = os.path.join(run, uuid.uuid4().hex)
    df.write.option("compression", "zstd").parquet(path, partitionBy=list(partition_by) or None)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: list[str | None], most: int = TEXT_SLICE) -> Iterator[list[str]]:
    """Consecutive runs of texts of bounded total length; null is empty."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: str, modulus: int) -> Column:
    """True where crc32 of the id as text leaves remainder 2; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == 2, F.lit(False))
