"""Ordered operators that never put a whole key into one task.

A plain window over a key sorts all rows of that key in one task, so one hot
street or user would serialise the job. Here the caller also gives `block`:
columns that never decrease along the order (a house-number range, a day).
Windows run inside (key, block); only one summary row per block is then carried
along the key, and joined back. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _blocks(df: DataFrame, keys: Sequence[str], block: Column):
    """Rows with their piece `_key` (key and block in one column), and the two windows.

    One key column serves the window and the join after it, so rows are shuffled
    once; it is never null, and null parts of a key still match each other.
    """
    rows = df.withColumn("_key", F.struct(*keys, block.alias("_blk")))
    whole = [F.col(f"_key.{k}") for k in keys]
    across = (Window.partitionBy(*whole) if keys else Window.partitionBy()).orderBy("_key._blk")
    return rows, Window.partitionBy("_key"), across


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                   block: Column, out: str = "previous") -> DataFrame:
    """`value` of the row before this one in the order of its key (null on the first)."""
    rows, inside, across = _blocks(df, keys, block)
    inside = inside.orderBy(*order)
    rows = (rows.withColumn("_in", F.lag(value).over(inside))
            .withColumn("_first", F.row_number().over(inside) == 1))
    tails = (rows.groupBy("_key").agg(F.max_by(value, F.struct(*order)).alias("_tail"))
             .withColumn("_carry", F.lag("_tail").over(across)).drop("_tail"))
    return (rows.join(tails, "_key")
            .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_in")))
            .drop("_key", "_in", "_first", "_carry"))


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column,
            out: str = "position", start: int = 0) -> DataFrame:
    """Dense position of each row in the order of its key, from `start`.

    With no keys it numbers the whole table; only the block counts meet in one task.
    """
    rows, inside, across = _blocks(df, keys, block)
    inside = inside.orderBy(*order)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy("_key").agg(F.count("*").alias("_n"))
              .withColumn("_carry", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    rows = rows.withColumn("_in", F.row_number().over(inside))
    return (rows.join(counts, "_key")
            .withColumn(out, (F.col("_carry") + F.col("_in") - 1 + start).cast("bigint"))
            .drop("_key", "_in", "_carry"))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                block: Column, out: str = "running") -> DataFrame:
    """Sum of `value` up to and including this row; order keys must be unique per key."""
    rows, inside, across = _blocks(df, keys, block)
    inside = inside.orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.groupBy("_key").agg(F.sum(value).alias("_s"))
            .withColumn("_carry", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s"))
    rows = rows.withColumn("_in", F.sum(value).over(upto))
    return (rows.join(sums, "_key").withColumn(out, F.col("_carry") + F.col("_in"))
            .drop("_key", "_in", "_carry"))


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               block: Column, out: str = "known") -> DataFrame:
    """Latest non-null `value` at or before each row in the order of its key."""
    rows, inside, across = _blocks(df, keys, block)
    inside = inside.orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    position = F.when(F.col(value).isNotNull(), F.struct(*order))
    tails = (rows.groupBy("_key").agg(F.max_by(value, position).alias("_tail"))
             .withColumn("_carry", F.last("_tail", ignorenulls=True).over(before)).drop("_tail"))
    rows = rows.withColumn("_in", F.last(value, ignorenulls=True).over(upto))
    return (rows.join(tails, "_key").withColumn(out, F.coalesce("_in", "_carry"))
            .drop("_key", "_in", "_carry"))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                      edges: int = 256) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per key.

    Equal values are counted before the shuffle, and the running count is taken in
    value blocks cut at approximate quantiles, so no task holds a whole key.
    """
    values = df.where(F.col(value).isNotNull())
    counts = values.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    cuts = values.agg(F.percentile_approx(value, [i / edges for i in range(1, edges)], 1000)
                      .alias("q"))
    # One row of at most `edges` numbers: safe to send everywhere.
    counts = counts.join(F.broadcast(cuts))
    block = F.size(F.filter("q", lambda e: e <= F.col("_v")))
    ranked = running_sum(counts.withColumn("_b", block).drop("q"), keys, ["_v"], "_c", F.col("_b"),
                         out="_upto")
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    if keys:
        sizes = sizes.select(*[F.col(k).alias(f"_s_{k}") for k in keys], "_n")
        match = F.lit(True)
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        ranked = ranked.join(sizes, match).drop(*[f"_s_{k}" for k in keys])
    else:
        ranked = ranked.join(F.broadcast(sizes))
    picks, result = [], []
    for name, p in probs.items():
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        picks += [F.min(F.when(F.col("_upto") > F.floor(rank), F.col("_v"))).alias(f"_lo_{name}"),
                  F.min(F.when(F.col("_upto") > F.ceil(rank), F.col("_v"))).alias(f"_hi_{name}"),
                  F.max(rank - F.floor(rank)).alias(f"_w_{name}")]
        result.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
                       * F.col(f"_w_{name}")).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *result)


def chunked_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: Column,
                  block: Column, size: int = 1000, out: str = "items") -> DataFrame:
    """Ordered lists of at most `size` items: (keys, part, items).

    A list that fits has one part; a huge one spreads over many rows instead of
    growing inside one task.
    """
    placed = ordinal(df, keys, order, block, out="_pos")
    return (placed.withColumn("part", F.floor(F.col("_pos") / size).cast("bigint"))
            .groupBy(*keys, "part")
            .agg(F.array_sort(F.collect_list(F.struct("_pos", item.alias("item")))).alias("_l"))
            .select(*keys, "part", F.transform("_l", lambda x: x["item"]).alias(out)))
