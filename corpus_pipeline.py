"""A training-data pipeline over `documents`, stage by stage.

Every stage takes the documents that its predecessor kept. All but the last return the
columns of documents; `text` and `n_chars` hold what is left of a text. A null or empty
text passes all stages like any other; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshtally.llm import lines, minhash, packing, quality, secret_scan
from meshtally.llm.common import stored, table
from meshtally.llm.queries import BYTE_BPE

LEAST_QUALITY = 0.7


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """docs with another text, and the length that belongs to it."""
    changed = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return docs.select(*(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under LEAST_QUALITY go. The classifier learns from the labels table."""
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(F.col("text"), trees) >= LEAST_QUALITY)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the last of them only."""
    into = "kept_lines"
    while into in (c.lower() for c in docs.columns):
        into += "_"
    found = lines.dedup_lines(docs, into=into)
    return with_text(found, F.col(f"{into}.text")).select(*columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, 0.8) stays, one of the smallest doc_id.

    A doc_id that names one text is the row's id. Rows without doc_id, and rows of a doc_id
    that names several texts, are linked by an id made of their text, above most others so
    that a named document stays first; those of them without words all stay. Of rows that
    repeat both id and text the least in column order stays.
    """
    rows = docs.select(F.struct(*columns(docs)).alias("doc"), F.col("doc_id").cast("bigint").alias("own"), "text",
                       F.xxhash64("text").alias("hash"))
    # Stored, so that Spark sees that there are few or none.
    several = stored(rows.where("own IS NOT NULL").groupBy("own").agg(F.min("hash").alias("least"), F.max("hash").alias("most"))
                     .where("least <> most").select("own", F.lit(True).alias("several")))
    made = F.when(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.col("hash").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))
    named = F.col("own").isNotNull() & F.col("several").isNull()
    rows = rows.join(several, "own", "left").select("doc", "text", F.when(named, F.col("own")).otherwise(made).alias("id"))
    found = minhash.near_duplicates(rows, doc_id="id").where("doc_id IS NOT NULL")
    ids = stored(found.groupBy(F.col("doc_id").alias("id")).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
                 .where("NOT kept OR n > 1"))
    out = rows.join(ids.select("id"), "id", "left_anti").select("doc.*")
    repeated = ids.where("kept").select("id")
    if repeated.isEmpty():
        return out
    order = F.struct(*(F.col(f"doc.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"))
    again = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min_by("doc", order).alias("doc"))
    return out.unionByName(again.select("doc.*"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; their documents stay."""
    return with_text(docs, secret_scan.redacted(F.col("text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences, with their ids."""
    return packing.pack(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage), ("packing", packing_stage)]

# The classifier, shingle signatures and tokens of the stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each one's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
