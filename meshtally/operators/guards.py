"""Data guards: each returns a frame of problems; `enforce` raises if there are any.

A guard aggregates, so the frame it returns is small or is itself a table of
offending keys; only the first examples are ever brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshtally import constants as K


class CheckFailed(ValueError):
    """A guard found problems; nothing after it may run."""


def problem_rows(df: DataFrame, check: str, context: str, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(context).alias("context"),
                     detail.cast("string").alias("detail"))


def enforce(*problems: DataFrame, examples: int = 20) -> None:
    """Raise with the first examples when any guard found something."""
    lines: list[str] = []
    for p in problems:
        for r in p.limit(examples + 1 - len(lines)).collect():
            lines.append(f"{r['check']} [{r['context']}]: {r['detail']}")
        if len(lines) > examples:
            break
    if lines:
        more = "\n  ..." if len(lines) > examples else ""
        raise CheckFailed("problems found:\n  " + "\n  ".join(lines[:examples]) + more)


def code_width(df: DataFrame, column: str, context: str, width: int = 5) -> DataFrame:
    bad = F.coalesce(F.length(column) != width, F.lit(True))
    found = df.where(bad).groupBy(F.length(column).alias("w")).agg(F.count("*").alias("n"))
    return problem_rows(found, "code width", context,
                        F.concat(F.col("n"), F.lit(f" value(s) of {column} with width "),
                                 F.coalesce(F.col("w").cast("string"), F.lit("null"))))


def single_round(df: DataFrame, context: str, column: str = "turno") -> DataFrame:
    """Votes of two rounds must never be summed together."""
    seen = df.agg(F.count_distinct(F.col(column).cast("string")).alias("n"),
                  F.min(F.col(column).cast("string")).alias("a"),
                  F.max(F.col(column).cast("string")).alias("b")).where("n > 1")
    return problem_rows(seen, "single round", context,
                        F.concat(F.col("n"), F.lit(" rounds, from "), "a", F.lit(" to "), "b"))


def unique_key(df: DataFrame, keys: Sequence[str], context: str) -> DataFrame:
    """Keys that occur more than once, with the number of extra rows."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    label = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    return problem_rows(twice, "unique key", context,
                        F.concat((F.col("_n") - 1).cast("string"), F.lit(" extra row(s) for "), label))


def sum_preserved(before: DataFrame, after: DataFrame, column: str, context: str,
                  tolerance: int = 0) -> DataFrame:
    a = before.agg(F.coalesce(F.sum(column), F.lit(0)).alias("a"))
    b = after.agg(F.coalesce(F.sum(column), F.lit(0)).alias("b"))
    both = a.join(F.broadcast(b)).where(F.abs(F.col("a") - F.col("b")) > tolerance)
    return problem_rows(both, "sum preserved", context,
                        F.concat(F.lit("before "), "a", F.lit(", after "), "b"))


def join_rate(left: DataFrame, right: DataFrame, on: Sequence[str], context: str,
              minimum: float = K.MIN_JOIN_RATE) -> DataFrame:
    """Share of left rows that find a partner; a weak join means mismatched keys."""
    marked = left.select(*on).join(
        right.select(*on).distinct().withColumn("_hit", F.lit(1)), list(on), "left")
    rate = marked.agg(F.count("*").alias("n"), F.count("_hit").alias("hit"))
    low = rate.where(F.coalesce(F.col("hit") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)) < minimum)
    return problem_rows(low, "join rate", context,
                        F.concat("hit", F.lit(" of "), "n", F.lit(f" matched, minimum {minimum:.0%}")))


def inside_country(df: DataFrame, lat: str, lon: str, context: str) -> DataFrame:
    """Known coordinates outside the country box: usually swapped axes."""
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    inside = F.col(lat).between(*K.LAT_BOX) & F.col(lon).between(*K.LON_BOX)
    out = df.agg(F.count_if(known & ~inside).alias("n")).where("n > 0")
    return problem_rows(out, "inside country", context,
                        F.concat("n", F.lit(" coordinate(s) outside the box")))


def constant_per_group(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                       context: str) -> DataFrame:
    """Groups in which a column takes more than one value."""
    # min <> max says "more than one" without holding the distinct values.
    spread = df.groupBy(*keys).agg(*[F.min(c).alias(f"_a_{c}") for c in columns],
                                   *[F.max(c).alias(f"_b_{c}") for c in columns])
    varies = F.lit(False)
    for c in columns:
        varies = varies | F.coalesce(F.col(f"_a_{c}") != F.col(f"_b_{c}"), F.lit(False))
    label = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    return problem_rows(spread.where(varies), "constant per group", context,
                        F.concat(F.lit(f"{', '.join(columns)} vary for "), label))


def official_totals(votes: DataFrame, official: DataFrame, context: str,
                    name: str = "nm_votavel") -> DataFrame:
    """National totals equal the published ones, matched on a part of the name.

    `votes`: ano_eleicao, turno, name, qt_votos; `official`: ano_eleicao, turno,
    parte, oficial. Rounds without a reference are left out by the join.
    """
    mine = votes.groupBy("ano_eleicao", "turno", name).agg(F.sum("qt_votos").alias("qt"))
    hit = (official.alias("o").join(
        mine.alias("v"), (F.col("v.ano_eleicao") == F.col("o.ano_eleicao"))
        & (F.col("v.turno") == F.col("o.turno")) & F.upper(F.col(f"v.{name}")).contains(F.col("o.parte")),
        "inner")
        .groupBy("o.ano_eleicao", "o.turno", "o.parte", "o.oficial")
        .agg(F.min_by("v.qt", F.col(f"v.{name}")).alias("qt")))
    rounds = votes.select("ano_eleicao", "turno").distinct()
    expected = official.join(rounds, ["ano_eleicao", "turno"], "left_semi")
    both = expected.join(hit, ["ano_eleicao", "turno", "parte", "oficial"], "left").where(
        F.col("qt").isNull() | (F.col("qt") != F.col("oficial")))
    return problem_rows(both, "official total", context, F.concat(
        F.col("ano_eleicao").cast("string"), F.lit("/"), "turno", F.lit(" "), "parte", F.lit(": "),
        F.coalesce(F.col("qt").cast("string"), F.lit("not found")), F.lit(" x "),
        F.col("oficial").cast("string")))


def official_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.OFFICIAL_TOTALS,
                                 "ano_eleicao int, turno string, parte string, oficial bigint")


def nominal_without_party(df: DataFrame, context: str) -> DataFrame:
    n = df.agg(F.count_if((F.col("tipo_voto") == "nominal") & F.col("sg_partido").isNull())
               .alias("n")).where("n > 0")
    return problem_rows(n, "nominal without party", context, F.concat("n", F.lit(" row(s)")))


def no_missing(df: DataFrame, columns: Sequence[str], context: str) -> DataFrame:
    """No null and no NaN: either would break the published JSON."""
    kinds = dict(df.dtypes)
    counts = [F.count_if(F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float")
                                              else F.lit(False))).alias(c) for c in columns]
    row = df.agg(*counts).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns])).alias("x"))
    bad = row.select("x.*").where("n > 0")
    return problem_rows(bad, "no missing", context, F.concat("n", F.lit(" missing in "), "c"))


def slice_present(df: DataFrame, year: int, round_: str, context: str) -> DataFrame:
    """A converted year and round really holds votes."""
    s = df.where((F.col("ano_eleicao") == year) & (F.col("turno") == round_)).agg(
        F.coalesce(F.sum("qt_votos"), F.lit(0)).alias("n")).where("n <= 0")
    return problem_rows(s, "slice present", context, F.lit(f"no votes for {year}/{round_}"))


def not_empty(df: DataFrame, context: str) -> DataFrame:
    n = df.limit(1).agg(F.count("*").alias("n")).where("n = 0")
    return problem_rows(n, "not empty", context, F.lit("no rows"))


def exactly_one(df: DataFrame, context: str) -> DataFrame:
    n = df.limit(2).agg(F.count("*").alias("n")).where("n <> 1")
    return problem_rows(n, "exactly one", context, F.concat(
        F.when(F.col("n") == 0, "none").otherwise("more than one"), F.lit(" found")))


def same_schema(df: DataFrame, expected: Sequence[str], context: str) -> None:
    """Column list must be equal, in order, before one table is merged into another."""
    if list(df.columns) != list(expected):
        raise CheckFailed(f"same schema [{context}]: got {df.columns}, expected {list(expected)}")


def same_types(df: DataFrame, expected: dict[str, str], context: str) -> None:
    """Column types must be equal before one table is merged into another."""
    wrong = {c: (k, expected.get(c)) for c, k in df.dtypes if expected.get(c) != k}
    if wrong:
        raise CheckFailed(f"same types [{context}]: {wrong}")


def require_columns(df: DataFrame, columns: Sequence[str], context: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise CheckFailed(f"columns [{context}]: missing {missing}")


PROBLEM_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("check", "context", "detail")])
