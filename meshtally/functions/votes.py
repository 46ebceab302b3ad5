"""Vote classification and the conventions of the vote tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meshtally import constants as K


def code_name(c: Column, names: dict[int, str]) -> Column:
    """Name of an enumerated code; unknown codes keep their number visible."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c.cast("int")),
                      F.concat(F.lit("desconhecido_"), c.cast("string")))


def vote_type(number: Column, seq: Column) -> Column:
    """branco, nulo, anulado, legenda or nominal, from the ballot number and sequence.

    A party-list vote has sequence -3, or an empty sequence with a two-digit number.
    """
    party_list = (seq == K.PARTY_LIST_SEQ) | (
        (seq == K.EMPTY_SEQ) & (F.length(F.trim(number)) == 2))
    return (F.when(number == K.BLANK_CODE, "branco").when(number == K.NULL_CODE, "nulo")
            .when(number == K.ANNULLED_CODE, "anulado").when(party_list, "legenda")
            .otherwise("nominal"))


def vote_type_from_name(name: Column) -> Column:
    """Vote type of a national total, which carries only the name."""
    upper = F.upper(name)
    special = upper.startswith("VOTO ")
    return (F.when(special & upper.contains("ANULADO"), "anulado")
            .when(special & upper.contains("NULO"), "nulo")
            .when(special & upper.contains("BRANCO"), "branco").otherwise("nominal"))


def one_blank_spelling(name: Column) -> Column:
    return F.when(name.isin(K.BLANK_SPELLINGS), K.BLANK_NAME).otherwise(name)


def electoral_unit(office: Column, state: Column, municipality: Column) -> Column:
    """Scope in which a ballot number names one candidate."""
    return (F.when(office.isin(K.NATIONAL_OFFICES), "BR")
            .when(office.isin(K.MUNICIPAL_OFFICES), municipality).otherwise(F.upper(state)))


def is_valid_vote(kind: Column) -> Column:
    return kind.isin("nominal", "legenda")


def suspect_source(to_centre_a: Column, to_centre_b: Column, name_a: str, name_b: str) -> Column:
    """Which of two coordinates lies implausibly further from the municipality's centre."""
    factor = F.lit(K.SUSPECT_FACTOR)
    return (F.when(to_centre_b > to_centre_a * factor, name_b)
            .when(to_centre_a > to_centre_b * factor, name_a).otherwise("indefinido"))


def is_settled(confidence: Column, n_options: Column, chosen: Column | None = None) -> Column:
    """A result may be shown: one option, an explicit choice, or a firm answer."""
    picked = F.lit(False) if chosen is None else F.coalesce(chosen, F.lit(False))
    return (n_options == 1) | picked | (confidence != "provavel")
