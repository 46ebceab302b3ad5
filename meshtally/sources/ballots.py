"""Ballot reports and vote records as relations.

A report or record arrives as one row per line, with the codes of its format in `fase` and
`tipo`. One that could not be read is a single row with `erro`, so that a change of format
shows up as counted rejections. Decoding the files themselves is outside this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions.votes import code_name
from meshtally.schemas import BALLOT_ROWS, RECORD_ROWS


def report_lines(lines: DataFrame) -> DataFrame:
    """Lines of ballot reports (columns of BALLOT_ROWS) with phase and vote type by name."""
    phases = F.create_map(*[F.lit(x) for item in K.REPORT_PHASES.items() for x in item])
    phase = F.coalesce(F.try_element_at(phases, F.col("fase").cast("int")), F.lit("desconhecida"))
    read = F.col("erro").isNull()
    return (lines.withColumn("fase", F.when(read, phase))
            .withColumn("tipo", F.when(read, code_name(F.col("tipo"), K.REPORT_VOTE_TYPES)))
            .select(*[F.col(f.name).cast(f.dataType) for f in BALLOT_ROWS]))


def record_lines(lines: DataFrame) -> DataFrame:
    """Lines of vote records (columns of RECORD_ROWS) with the vote type by name."""
    named = F.when(F.col("erro").isNull(), code_name(F.col("tipo"), K.RECORD_VOTE_TYPES))
    return lines.withColumn("tipo", named).select(*[F.col(f.name).cast(f.dataType) for f in RECORD_ROWS])


def record_summary(records: DataFrame) -> DataFrame:
    return records.where("erro is null").groupBy("eleicao", "cargo", "tipo").agg(
        F.count("*").alias("votos"))
