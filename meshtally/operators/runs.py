"""Run-length index operators: runs, as-of lookup, nearest compatible run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.operators.ordered import last_known, previous_value


def heaviest_per_key(df: DataFrame, keys: Sequence[str], weight: str, tie: str,
                     keep: Sequence[str] = ()) -> DataFrame:
    """One row per key: largest weight, then smallest `tie`. Combines before the shuffle."""
    best = F.min_by(F.struct(tie, weight, *keep), F.struct(-F.col(weight), F.col(tie)))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def run_starts(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               block: Column) -> DataFrame:
    """Rows where `value` differs from the previous row of the key (gaps and islands)."""
    marked = previous_value(df, keys, order, value, block, out="_prev")
    first = F.col("_prev").isNull() & F.col(value).isNotNull()
    return marked.where(first | (F.col("_prev") != F.col(value))).drop("_prev")


def asof_backward(probes: DataFrame, facts: DataFrame, keys: Sequence[str], at: str, start: str,
                  payload: Sequence[str], width: int = 1000,
                  block: Column | None = None) -> DataFrame:
    """For each distinct (keys, at): the fact with the largest start <= at, or nulls.

    Equal probes are reduced to one row first, so many requests for one house
    number cost one. `block` may override the range of `_at` that shares a task.
    """
    asked = probes.select(*keys, F.col(at).alias("_at")).distinct()
    both = (asked.select(*keys, "_at", F.lit(1).alias("_probe"),
                         F.lit(None).cast(_payload_type(facts, start, payload)).alias("_pay"))
            .unionByName(facts.select(*keys, F.col(start).alias("_at"), F.lit(0).alias("_probe"),
                                      F.struct(F.col(start).alias("_start"), *payload)
                                      .alias("_pay"))))
    filled = last_known(both, keys, ["_at", "_probe"], "_pay",
                        F.floor(F.col("_at") / width) if block is None else block)
    return (filled.where("_probe = 1")
            .select(*keys, F.col("_at").alias(at), F.col("known._start").alias(f"_{start}"),
                    *[F.col(f"known.{p}").alias(p) for p in payload]))


def _payload_type(facts: DataFrame, start: str, payload: Sequence[str]):
    return facts.select(F.struct(F.col(start).alias("_start"), *payload).alias("p")).schema[0].dataType


def run_lookup(probes: DataFrame, runs: DataFrame, keys: Sequence[str], at: str, start: str,
               payload: Sequence[str], width: int = 1000) -> DataFrame:
    """Run that holds each probe; a probe below the first run falls into the first run."""
    found = asof_backward(probes, runs, keys, at, start, payload, width)
    first = runs.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(start).alias("_s"), *payload), start).alias("_first"))
    out = found.join(first, list(keys), "left")
    missing = F.col(f"_{start}").isNull()
    return out.select(
        *keys, at, F.when(missing, F.col("_first._s")).otherwise(F.col(f"_{start}")).alias(start),
        *[F.when(missing, F.col(f"_first.{p}")).otherwise(F.col(p)).alias(p) for p in payload])


def nearest_compatible(probes: DataFrame, compatible: DataFrame, keys: Sequence[str],
                       position: str, value: str, width: int = 1000) -> DataFrame:
    """Walk outwards from a position to the closest compatible run; left wins a tie."""
    left = asof_backward(probes, compatible, keys, position, "_pos", [value], width)
    flipped = compatible.withColumn("_neg", -F.col("_pos"))
    right = asof_backward(probes.withColumn("_from", -F.col(position)), flipped, keys, "_from",
                          "_neg", [value], width)
    both = (left.select(*keys, position, F.col(value).alias("_lv"),
                        (F.col(position) - F.col("__pos")).alias("_ld"))
            .join(right.select(*keys, (-F.col("_from")).alias(position), F.col(value).alias("_rv"),
                               (-F.col("__neg") + F.col("_from")).alias("_rd")),
                  [*keys, position], "full"))
    pick = (F.when(F.col("_rd").isNull() | (F.col("_ld") <= F.col("_rd")), F.col("_lv"))
            .otherwise(F.col("_rv")))
    return both.select(*keys, position, pick.alias(value)).where(F.col(value).isNotNull())
