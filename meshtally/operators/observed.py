"""Guards whose figures are taken by the job that writes the guarded frame.

The figures are observed on top of the stored frame, so they belong to the tasks of the
writing stage. Spark adds such a task's figures once, also when an executor is lost and the
task runs again. Figures of an earlier stage can be added twice, so none are observed there:
what must be known of the rows before a shuffle is carried through it as an aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.operators.guards import CheckFailed
from meshtally.session import settle


@dataclass(frozen=True)
class Watch:
    """A guard on totals of a frame: `problems` reads the figures and names what is wrong."""

    check: str
    context: str
    figures: Mapping[str, Column]
    problems: Callable[[Mapping[str, Any]], Sequence[str]]


def settle_observed(df: DataFrame, **figures: Column) -> tuple[DataFrame, dict[str, Any]]:
    """Store a frame, and return with it the figures (aggregates) that the same job took."""
    seen = Observation(f"observed-{uuid.uuid4().hex}")
    stored = settle(df.observe(seen, *[c.alias(name) for name, c in figures.items()]))
    return stored, dict(seen.get)


def settle_watched(df: DataFrame, *watches: Watch) -> DataFrame:
    """Store a frame; raise `CheckFailed` with all problems if a watch found any."""
    named = {f"w{i}_{name}": c for i, w in enumerate(watches) for name, c in w.figures.items()}
    stored, got = settle_observed(df, **named)
    lines = [f"{w.check} [{w.context}]: {p}" for i, w in enumerate(watches)
             for p in w.problems({name: got[f"w{i}_{name}"] for name in w.figures})]
    if lines:
        raise CheckFailed("problems found:\n  " + "\n  ".join(lines))
    return stored


def whole(column: str) -> Column:
    """Sum of a column; no rows add up to 0."""
    return F.coalesce(F.sum(column), F.lit(0))


def total_is(expected: int, column: str, context: str, tolerance: int = 0) -> Watch:
    """As `guards.sum_preserved`, with the sum before already known."""
    return Watch("sum preserved", context, {"sum": whole(column)},
                 lambda g: [f"before {expected}, after {g['sum']}"] if abs(g["sum"] - expected) > tolerance else [])


def nominal_with_party(context: str) -> Watch:
    """As `guards.nominal_without_party`."""
    lacks = F.count_if((F.col("tipo_voto") == "nominal") & F.col("sg_partido").isNull())
    return Watch("nominal without party", context, {"n": lacks}, lambda g: [f"{g['n']} row(s)"] if g["n"] else [])


def nothing_missing(df: DataFrame, columns: Sequence[str], context: str) -> Watch:
    """As `guards.no_missing`."""
    kinds = dict(df.dtypes)
    figures = {c: F.count_if(F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False)))
               for c in columns}
    return Watch("no missing", context, figures, lambda g: [f"{g[c]} missing in {c}" for c in columns if g[c]])


def slice_present(year: int, round_: str, context: str) -> Watch:
    """As `guards.slice_present`."""
    mine = F.when((F.col("ano_eleicao") == year) & (F.col("turno") == round_), F.col("qt_votos"))
    return Watch("slice present", context, {"n": F.coalesce(F.sum(mine), F.lit(0))},
                 lambda g: [f"no votes for {year}/{round_}"] if g["n"] <= 0 else [])


def matched_share(rows: str, matched: str, context: str, minimum: float = K.MIN_JOIN_RATE) -> Watch:
    """As `guards.join_rate`: `rows` counts the left rows of an output row, `matched` says if they found a partner.

    Without any rows the share counts as 0.
    """
    figures = {"n": whole(rows), "hit": F.coalesce(F.sum(F.when(F.col(matched), F.col(rows))), F.lit(0))}

    def problems(g: Mapping[str, Any]) -> list[str]:
        low = (g["hit"] / g["n"] if g["n"] else 0.0) < minimum
        return [f"{g['hit']} of {g['n']} matched, minimum {minimum:.0%}"] if low else []

    return Watch("join rate", context, figures, problems)
