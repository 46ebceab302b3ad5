"""Weights, fractions of a key, and the dominant member."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Attach aggregates of a key to each of its rows.

    Same result as a window over the key, but totals combine before the shuffle
    and the join can split a hot key.
    """
    sums = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        *[c.alias(name) for name, c in totals.items()])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(sums, match).drop(*[f"_k_{k}" for k in keys])


def weighted(df: DataFrame, keys: Sequence[str], preferred: str, fallback: str,
             out: str = "peso") -> DataFrame:
    """Weight = `preferred`, or `fallback` where the whole key has none of it."""
    return (with_totals(df, keys, _pref=F.sum(preferred))
            .withColumn(out, F.when(F.col("_pref") > 0, F.col(preferred)).otherwise(F.col(fallback)))
            .drop("_pref"))


def member_shares(df: DataFrame, keys: Sequence[str], member: str, weight: str = "peso",
                  fallback: str = "n_enderecos") -> DataFrame:
    """Fraction of a key's weight held by each member, and the number of members."""
    sums = df.groupBy(*keys, member).agg(F.sum(weight).alias("_w"), F.sum(fallback).alias("_f"))
    rows = with_totals(sums, keys, _tw=F.sum("_w"), _tf=F.sum("_f"), n_regioes=F.count("*"))
    use = F.col("_tw") > 0
    return (rows.withColumn(weight, F.when(use, F.col("_w")).otherwise(F.col("_f")))
            .withColumn("fracao", F.col(weight) / F.when(use, F.col("_tw")).otherwise(F.col("_tf")))
            .drop("_w", "_f", "_tw", "_tf"))


def dominant_member(shares: DataFrame, keys: Sequence[str], member: str,
                    weight: str = "peso") -> DataFrame:
    """Heaviest member per key, smallest id on a tie."""
    best = F.min_by(F.struct(F.col(member).alias(f"{member}_dominante"), "n_regioes", "fracao"),
                    F.struct(-F.col(weight), F.col(member)))
    return shares.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def top_n(df: DataFrame, keys: Sequence[str], by: str, tie: str, n: int,
          out: str = "rank") -> DataFrame:
    """Largest n rows per key. The rank filter is applied before the shuffle too."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.col(by).desc(), F.col(tie).asc())
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def fold_tail(df: DataFrame, keys: Sequence[str], name: str, votes: str, n: int = 5,
              extra: Sequence[str] = ()) -> DataFrame:
    """Keep the n largest and fold the rest into 'Outros'; n + 1 entries stay as they are.

    The folded row is the key's total minus its head, so the tail is never ranked.
    """
    head = top_n(df, keys, votes, name, n + 1, out="rank")
    whole = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(votes).alias("_t"),
                                  *[F.sum(x).alias(f"_t_{x}") for x in extra])
    joined = head.join(whole, list(keys))
    kept = joined.where((F.col("rank") <= n) | (F.col("_n") <= n + 1))
    rest = (joined.where((F.col("rank") <= n) & (F.col("_n") > n + 1)).groupBy(*keys)
            .agg((F.max("_t") - F.sum(votes)).alias(votes), F.lit(n + 1).alias("rank"),
                 F.lit("Outros").alias(name),
                 *[(F.max(f"_t_{x}") - F.sum(x)).alias(x) for x in extra]))
    cols = [*keys, "rank", name, votes, *extra]
    return kept.select(*cols).unionByName(rest.select(*cols))
