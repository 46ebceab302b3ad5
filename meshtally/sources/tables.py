"""Parquet tables between stages: pruned reads, checkpoints, replaceable slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshtally.operators import guards

CHECKPOINT_PARTITIONS = ["ano_referencia", "sg_uf"]


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | str | None = None) -> DataFrame:
    """Table with projection and predicate left to the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def write_partitions(df: DataFrame, path: str, by: Sequence[str] = tuple(CHECKPOINT_PARTITIONS)) -> None:
    """Replace only the partitions present in `df`; the others stay untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def stale_partitions(saved: DataFrame, regions: DataFrame, required: Sequence[str],
                     by: Sequence[str] = tuple(CHECKPOINT_PARTITIONS)) -> DataFrame:
    """Partitions to recompute: a column is missing, or a saved region now belongs to
    another municipality (ids are renumbered when the mesh changes)."""
    parts = saved.select(*by).distinct()
    if any(c not in saved.columns for c in required):
        return parts
    now = regions.select("id_regiao", F.col("cd_municipio_ibge").alias("_now"))
    pairs = saved.select(*by, "id_regiao", "cd_municipio_ibge").distinct()
    checked = pairs.join(now, "id_regiao", "left").groupBy(*by).agg(
        F.bool_and(F.col("cd_municipio_ibge").eqNullSafe(F.col("_now"))).alias("_ok"))
    return checked.where("not _ok").select(*by)


def replace_slice(df: DataFrame, path: str, keys: Sequence[str] = ("ano_eleicao", "turno")) -> None:
    """Put a converted (year, round) into the base table; running twice changes nothing.

    Other slices are not touched, and a base with other columns or types is refused.
    """
    spark = df.sparkSession
    try:
        base = spark.read.parquet(path)
    except AnalysisException:
        base = None
    if base is not None:
        guards.same_schema(df.select(*sorted(df.columns)), sorted(base.columns), "slice merge")
        # Partition values are read back with an inferred type; all other columns keep theirs.
        kinds = dict(base.dtypes)
        guards.same_types(df.drop(*keys), {c: k for c, k in kinds.items() if c not in keys}, "slice merge")
    write_partitions(df, path, keys)


def write_exceptions(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Sorted list of cases to look at, `;` separated, UTF-8 with a byte-order mark."""
    ordered = df.orderBy(*order)
    first = ordered.columns[0]
    # The mark sits in front of the header name, where spreadsheet programs expect it.
    ordered.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option(
        "sep", ";").option("header", True).csv(path)


def sample_per_group(df: DataFrame, group: Sequence[str], identity: Sequence[str], n: int,
                     seed: int = 42) -> DataFrame:
    """Reproducible sample of n distinct rows per group, by the order of a seeded digest."""
    from meshtally.operators.shares import top_n
    once = df.dropDuplicates(list(identity))
    tagged = once.withColumn("_id", F.concat_ws("|", *[F.col(c).cast("string") for c in identity])).withColumn(
        "_h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_id"))))
    return top_n(tagged, group, "_h", "_id", n, out="_r").drop("_h", "_id", "_r")
