"""Published JSON: strict writing and reading, file manifests, integrity audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshtally.operators import guards


def not_a_number(c: Column, kind: T.DataType) -> Column | None:
    """True where a value of any nesting holds NaN or an infinity; null if it cannot."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        d = c.cast("double")
        return F.coalesce(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(False))
    if isinstance(kind, T.ArrayType):
        if not_a_number(F.lit(None), kind.elementType) is None:
            return None
        return F.coalesce(F.exists(c, lambda x: not_a_number(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        if not_a_number(F.lit(None), kind.valueType) is None:
            return None
        return F.coalesce(F.exists(F.map_values(c), lambda x: not_a_number(x, kind.valueType)),
                          F.lit(False))
    if isinstance(kind, T.StructType):
        tests = [t for t in (not_a_number(c[f.name], f.dataType) for f in kind) if t is not None]
        out = None
        for t in tests:
            out = t if out is None else out | t
        return out
    return None


def json_rows(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, value): one compact JSON document per row; NaN stops the job.

    to_json would write NaN as text and a browser would refuse it later.
    """
    fields = [f for f in df.schema if f.name not in keys]
    bad = F.lit(False)
    for f in fields:
        test = not_a_number(F.col(f.name), f.dataType)
        if test is not None:
            bad = bad | test
    text = F.to_json(F.struct(*[F.col(f.name) for f in fields]), {"ignoreNullFields": "false"})
    return df.select(*keys, F.when(bad, F.raise_error(F.lit("NaN or infinity in a document")))
                     .otherwise(text).alias("value"))


def write_documents(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """One JSON line per row, in one folder per key value."""
    rows = json_rows(df, keys)
    if keys:
        # Small folders are gathered in one task, a huge one is split over many.
        rows = rows.hint("rebalance", *keys)
        rows.write.mode("overwrite").partitionBy(*keys).text(path)
    else:
        rows.write.mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType,
                   multiline: bool = False) -> DataFrame:
    """Strict JSON: malformed text, NaN and Infinity are refused, not turned into nulls."""
    return spark.read.schema(schema).json(path, mode="FAILFAST", multiLine=multiline,
                                          allowNonNumericNumbers=False)


def report_document(**parts: DataFrame | tuple[DataFrame, str]) -> DataFrame:
    """One-row report: scalars as structs, bounded tables (top-k, groups) as arrays.

    Give a frame for a one-row part, or (frame, order column) for a list part. Lists
    are top-k or one row per state, never a whole table.
    """
    out = None
    for name, part in parts.items():
        if isinstance(part, tuple):
            df, order = part
            item = F.struct(F.col(order).alias("_o"), F.struct(*df.columns).alias("_x"))
            row = df.agg(F.array_sort(F.collect_list(item)).alias("_l")).select(
                F.transform("_l", lambda x: x["_x"]).alias(name))
        else:
            row = part.select(F.struct(*part.columns).alias(name))
        out = row if out is None else out.join(F.broadcast(row))
    return out


def manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder with size and time; their content is not read."""
    root = path.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root))
    relative = F.regexp_replace("path", r"^.*" + _quoted(root) + "/", "")
    return files.select(relative.alias("arquivo"), F.col("length").alias("bytes"),
                        F.col("modificationTime").alias("modificado"))


def _quoted(text: str) -> str:
    import re
    return re.escape(text.split("://", 1)[-1])


def publish_diff(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Which outputs must be sent: new, changed (size, or newer here), or unchanged."""
    there = remote.select("arquivo", F.col("bytes").alias("_b"), F.col("modificado").alias("_m"))
    both = local.join(there, "arquivo", "left")
    return both.select(
        *local.columns,
        F.when(F.col("_b").isNull(), "novo")
        .when((F.col("bytes") != F.col("_b")) | (F.col("modificado") > F.col("_m")), "alterado")
        .otherwise("igual").alias("situacao"))


def integrity_audit(files: DataFrame, signed: DataFrame) -> DataFrame:
    """SHA-512 of each signed file: ok, different or missing.

    `files` has arquivo and content; `signed` has arquivo and sha512 (hex).
    """
    digests = files.select("arquivo", F.sha2("content", 512).alias("_d"))
    both = signed.join(digests, "arquivo", "left")
    return both.select(
        "arquivo", F.when(F.col("_d").isNull(), "ausente")
        .when(F.col("_d") == F.lower("sha512"), "ok").otherwise("diferente").alias("situacao"))


def audit_problems(audit: DataFrame) -> DataFrame:
    bad = audit.where("situacao <> 'ok'")
    return guards.problem_rows(bad, "integrity", "signed files",
                               F.concat("arquivo", F.lit(": "), "situacao"))
