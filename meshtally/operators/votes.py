"""Vote tables: from raw section rows to place, region and territory results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import numbers, text, votes as V
from meshtally.operators import guards, shares
from meshtally.schemas import VOTE_COLUMNS

CONTEST = ["ano_eleicao", "turno", "cargo"]


def ordinary_only(df: DataFrame, column: str = "CD_TIPO_ELEICAO") -> DataFrame:
    """Only the ordinary election; supplementary ones share its year."""
    guards.require_columns(df, [column], "ordinary election")
    return df.where(F.trim(column) == K.ORDINARY_ELECTION)


def of_office(df: DataFrame, office: str, column: str = "DS_CARGO") -> DataFrame:
    return df.where(text.unaccented(F.col(column)) == text.unaccented(F.lit(office)))


def clean_votes(raw: DataFrame) -> DataFrame:
    """Typed, classified vote rows, all states, still one row per source row."""
    return raw.select(
        text.place_key(F.col("SG_UF"), F.col("CD_MUNICIPIO"), F.col("NR_ZONA"),
                       F.col("NR_LOCAL_VOTACAO")).alias("id_local_votacao"),
        F.trim("SG_UF").alias("sg_uf"), F.trim("ANO_ELEICAO").cast("int").alias("ano_eleicao"),
        text.round_text(F.col("NR_TURNO")).alias("turno"),
        text.unaccented(F.col("DS_CARGO")).alias("cargo"),
        F.col("SQ_CANDIDATO").alias("sq_candidato"), F.col("NR_VOTAVEL").alias("nr_votavel"),
        V.one_blank_spelling(F.col("NM_VOTAVEL")).alias("nm_votavel"),
        V.vote_type(F.col("NR_VOTAVEL"), F.col("SQ_CANDIDATO")).alias("tipo_voto"),
        numbers.count_or_zero(F.col("QT_VOTOS")).alias("qt_votos"))


def votes_per_place(clean: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Votes by place and votable, the wanted states only."""
    scope = clean.where(F.col("sg_uf").isin(list(states))) if states \
        else clean.where(F.col("sg_uf") != K.ABROAD)
    return scope.groupBy("id_local_votacao", "sg_uf", *CONTEST, "sq_candidato", "nr_votavel",
                         "nm_votavel", "tipo_voto").agg(F.sum("qt_votos").alias("qt_votos"))


def national_totals(clean: DataFrame) -> DataFrame:
    """Votes by name before any cut by state, so votes abroad are in."""
    return clean.groupBy(*CONTEST, "nm_votavel").agg(F.sum("qt_votos").alias("qt_votos"))


def attach_party(votes: DataFrame, register: DataFrame) -> DataFrame:
    """Party of each vote: by candidate sequence, or by party number on a list vote."""
    by_seq = register.groupBy(F.col("SQ_CANDIDATO").alias("sq_candidato")).agg(
        F.min_by("SG_PARTIDO", "NR_CANDIDATO").alias("_of_candidate"))
    by_number = register.groupBy(F.col("NR_PARTIDO").alias("nr_votavel")).agg(
        F.min("SG_PARTIDO").alias("_of_list"))
    # Both lookups are dimension tables; Spark broadcasts them if their size allows.
    return (votes.join(by_seq, "sq_candidato", "left").join(by_number, "nr_votavel", "left")
            .withColumn("sg_partido", F.when(F.col("tipo_voto") == "legenda", F.col("_of_list"))
                        .otherwise(F.col("_of_candidate")))
            .select(*VOTE_COLUMNS))


def votes_per_region(votes: DataFrame, place_region: DataFrame,
                     moved: DataFrame | None = None) -> DataFrame:
    """Votes by region; `moved` (id_regiao, destino) re-allocates inactive regions."""
    return _by_region(votes.join(place_region.select("id_local_votacao", "id_regiao"), "id_local_votacao"), moved,
                      qt_votos=F.sum("qt_votos"))


def counted_region_votes(votes: DataFrame, place_region: DataFrame,
                         moved: DataFrame | None = None) -> DataFrame:
    """`votes_per_region` with the rows of unknown places kept apart, and the vote rows counted.

    `casado` is false in rows whose places the mesh doesn't know; `linhas` counts each vote
    row once, also where a place stands in the mesh several times.
    """
    regions = place_region.groupBy("id_local_votacao").agg(
        F.collect_list(F.struct("id_regiao")).alias("_regions"))
    joined = votes.join(regions, "id_local_votacao", "left").select(
        *votes.columns, F.posexplode_outer("_regions").alias("_at", "_region")).select(
        *votes.columns, F.col("_region.id_regiao").alias("id_regiao"), "_at",
        F.col("_at").isNotNull().alias("casado"))
    return _by_region(joined, moved, ["casado"], qt_votos=F.sum("qt_votos"),
                      linhas=F.count_if(F.coalesce(F.col("_at"), F.lit(0)) == 0))


def _by_region(joined: DataFrame, moved: DataFrame | None, more: Sequence[str] = (), **sums: Column) -> DataFrame:
    if moved is not None:
        joined = (joined.join(moved.select("id_regiao", "destino"), "id_regiao", "left")
                  .withColumn("id_regiao", F.coalesce("destino", "id_regiao")).drop("destino"))
    keys = ["id_regiao", "sg_uf", *CONTEST, "sq_candidato", "nr_votavel", "nm_votavel",
            "sg_partido", "tipo_voto"]
    return joined.groupBy(*keys, *more).agg(*[c.alias(name) for name, c in sums.items()])


def outside_mesh(votes: DataFrame, place_region: DataFrame) -> DataFrame:
    """How many votes and places the mesh does not know; measured, never repaired."""
    lost = votes.join(place_region.select("id_local_votacao").distinct(), "id_local_votacao",
                      "left_anti")
    return lost.agg(F.coalesce(F.sum("qt_votos"), F.lit(0)).alias("votos_fora"),
                    F.count_distinct("id_local_votacao").alias("locais_fora"))


def contest_totals(votes: DataFrame, where: Sequence[str], list_votes_valid: bool = True) -> DataFrame:
    """Valid, total, blank and null votes per place and contest, in one pass."""
    kind, qt = F.col("tipo_voto"), F.col("qt_votos")
    valid = V.is_valid_vote(kind) if list_votes_valid else kind == "nominal"

    def of(condition):
        return F.coalesce(F.sum(F.when(condition, qt)), F.lit(0))

    rows = votes.groupBy(*where, *CONTEST).agg(
        of(valid).alias("validos"), F.sum(qt).alias("total"), of(kind == "branco").alias("brancos"),
        of(kind == "nulo").alias("nulos"))
    return (rows.withColumn("pct_brancos", numbers.percent(F.col("brancos"), F.col("total")))
            .withColumn("pct_nulos", numbers.percent(F.col("nulos"), F.col("total"))))


def candidate_results(votes: DataFrame, where: Sequence[str],
                      list_votes_valid: bool = True) -> DataFrame:
    """Votes and share of valid votes per candidate (nominal votes only)."""
    kind = F.col("tipo_voto")
    valid = V.is_valid_vote(kind) if list_votes_valid else kind == "nominal"
    keys = [*where, *CONTEST]
    rows = votes.where(kind == "nominal").groupBy(*keys, "nm_votavel", "sg_partido").agg(
        F.sum("qt_votos").alias("votos"))
    # The denominator is one small row per contest, summed from the same stored votes.
    whole = votes.where(valid).groupBy(*keys).agg(F.sum("qt_votos").alias("validos"))
    return rows.join(whole, keys).select(*rows.columns, "validos").withColumn(
        "pct", numbers.percent(F.col("votos"), F.col("validos")))


def top_candidates(results: DataFrame, where: Sequence[str], n: int) -> DataFrame:
    return shares.top_n(results, [*where, *CONTEST], "votos", "nm_votavel", n)


def territory_results(votes: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Candidate votes rolled up over nested territory levels and the whole (one scan).

    Adds `nivel`: the number of levels left in the row (0 = whole).
    """
    keys = [*CONTEST, "tipo_voto", "nm_votavel", "sg_partido"]
    fine = votes.groupBy(*levels, *keys).agg(F.sum("qt_votos").alias("qt_votos"))
    sets = [[*levels[:i], *keys] for i in range(len(levels), -1, -1)]
    rolled = fine.groupingSets([[F.col(c) for c in s] for s in sets], *levels, *keys).agg(
        F.sum("qt_votos").alias("qt_votos"),
        *[F.grouping(c).alias(f"_g_{c}") for c in levels])
    depth = F.lit(len(levels))
    for c in levels:
        depth = depth - F.col(f"_g_{c}")
    return rolled.withColumn("nivel", depth.cast("int")).drop(*[f"_g_{c}" for c in levels])


def country_votes(national: DataFrame, place_votes: DataFrame) -> DataFrame:
    """Votes behind the country row: national totals (with abroad), and for years
    without them all places."""
    party = (place_votes.where(F.col("tipo_voto") == "nominal")
             .groupBy("ano_eleicao", "nm_votavel").agg(F.min("sg_partido").alias("sg_partido")))
    with_type = (national.withColumn("tipo_voto", V.vote_type_from_name(F.col("nm_votavel")))
                 .join(party, ["ano_eleicao", "nm_votavel"], "left"))
    years = national.select("ano_eleicao").distinct()
    cols = [*CONTEST, "nm_votavel", "sg_partido", "tipo_voto", "qt_votos"]
    return with_type.select(*cols).unionByName(
        # A few years: sent everywhere, or all votes of a year would meet in one task.
        place_votes.join(F.broadcast(years), "ano_eleicao", "left_anti").select(*cols))


def levels_agree(states: DataFrame, municipalities: DataFrame) -> DataFrame:
    """State totals against the sum of their municipalities; problem rows."""
    low = municipalities.groupBy("sg_uf", *CONTEST).agg(F.sum("total").alias("soma"))
    both = states.join(low, ["sg_uf", *CONTEST], "full").where(
        ~F.col("total").eqNullSafe(F.col("soma")))
    return guards.problem_rows(both, "levels agree", "state x municipalities", F.concat(
        "sg_uf", F.lit(" "), F.col("ano_eleicao").cast("string"), F.lit("/"), "turno", F.lit(": "),
        F.coalesce(F.col("total").cast("string"), F.lit("none")), F.lit(" x "),
        F.coalesce(F.col("soma").cast("string"), F.lit("none"))))


def totals_by_type(votes: DataFrame, where: Sequence[str] = ()) -> DataFrame:
    """Our side of the official comparison: turnout, valid, blank, null."""
    kind, qt = F.col("tipo_voto"), F.col("qt_votos")
    return votes.groupBy(*where).agg(
        F.sum(qt).alias("comparecimento"),
        F.coalesce(F.sum(F.when(V.is_valid_vote(kind), qt)), F.lit(0)).alias("validos"),
        F.coalesce(F.sum(F.when(kind == "branco", qt)), F.lit(0)).alias("brancos"),
        F.coalesce(F.sum(F.when(kind == "nulo", qt)), F.lit(0)).alias("nulos"))


def votes_by_number(votes: DataFrame, where: Sequence[str] = ()) -> DataFrame:
    return (votes.where(V.is_valid_vote(F.col("tipo_voto")))
            .groupBy(*where, "tipo_voto", "nr_votavel").agg(F.sum("qt_votos").alias("votos")))


def abstention(voters: DataFrame, turnout: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Voters minus turnout; unknown turnout or a negative difference gives null."""
    both = voters.join(turnout, list(keys), "left")
    gap = F.col("qt_eleitores") - F.col("comparecimento")
    return both.withColumn("abstencao", F.when(gap >= 0, gap)).withColumn(
        "suprimida", F.coalesce(gap < 0, F.lit(False)))


def round_counters(votes: DataFrame) -> DataFrame:
    """Votes and rows present per year and round."""
    return votes.groupBy("ano_eleicao", "turno").agg(
        F.count("*").alias("linhas"), F.sum("qt_votos").alias("votos"))
