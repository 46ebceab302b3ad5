"""The builds of the chain behind their guards.

A build that breaks a rule raises `CheckFailed` before anything is published. What a guard
and its caller both read is stored once, and a guard on totals takes its figures from the job
that stores (`operators/observed.py`), not from one of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meshtally.operators import guards
from meshtally.operators import observed as OBS
from meshtally.operators import votes as VOTES
from meshtally.operators.guards import enforce
from meshtally.plans import convert as CONVERT
from meshtally.plans import mesh as MESH
from meshtally.plans import street_index as INDEX
from meshtally.session import settle


def regions(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`build_regions`, refused if a point lies in two municipalities or outside the country."""
    dimension, mapping = MESH.build_regions(places)
    mapping = settle(mapping)
    enforce(*MESH.region_guards(places, mapping))
    return dimension, mapping


def party(votes: DataFrame, register: DataFrame) -> DataFrame:
    """`attach_party`, refused if votes are lost or a nominal vote has no party."""
    votes, before = OBS.settle_observed(votes, total=OBS.whole("qt_votos"))
    return OBS.settle_watched(VOTES.attach_party(votes, register), OBS.nominal_with_party("party of a vote"),
                              OBS.total_is(before["total"], "qt_votos", "party of a vote"))


def region_votes(votes: DataFrame, mapping: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """`votes_per_region`, refused if too few vote rows belong to a place of the mesh."""
    counted = OBS.settle_watched(VOTES.counted_region_votes(votes, mapping, moved),
                                 OBS.matched_share("linhas", "casado", "votes by region"))
    return counted.where("casado").drop("casado", "linhas")


def index(counts: DataFrame) -> INDEX.StreetIndex:
    """`build_index` as stored tables, refused if a key repeats or a fraction is missing."""
    built = INDEX.build_index(counts)

    def stored(df: DataFrame, name: str) -> DataFrame:
        return OBS.settle_watched(df, OBS.nothing_missing(df, ["fracao"], name))

    out = INDEX.StreetIndex(
        runs=settle(built.runs), streets=stored(built.streets, "streets"),
        street_regions=stored(built.street_regions, "street regions"),
        street_localities=stored(built.street_localities, "street localities"),
        localities=stored(built.localities, "localities"))
    enforce(*out.key_guards())
    return out


def conversion(rows: DataFrame, offices: Sequence[int], state: str, year: int, round_: str,
               register: DataFrame) -> DataFrame:
    """Report lines to vote rows, refused if too many reports are rejected or votes are lost."""
    rejected = settle(CONVERT.rejections(rows))
    enforce(CONVERT.rejection_rate(rows, rejected))
    counts, before = OBS.settle_observed(
        CONVERT.ballot_counts(CONVERT.counted_rows(rows, rejected, offices)), total=OBS.whole("qt_votos"))
    return OBS.settle_watched(CONVERT.vote_rows(counts, state, year, round_, register),
                              OBS.total_is(before["total"], "qt_votos", "conversion"),
                              OBS.slice_present(year, round_, "conversion"))
