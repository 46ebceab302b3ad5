"""Results while ballots arrive, and the comparisons shown next to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import numbers, text
from meshtally.operators.ordered import chunked_lists
from meshtally.operators.shares import top_n
from meshtally.session import settle

SECTION = ["municipio", "zona", "secao"]


def valid_transmission(sent: DataFrame, keys: list[str], order: str = "ordem") -> DataFrame:
    """One transmission per section: the last totalized one, else the last received."""
    final = F.coalesce(F.lower("situacao").startswith("totaliz"), F.lit(False))
    rest = [c for c in sent.columns if c not in keys]
    return (sent.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(final, F.col(order))).alias("_t"))
            .select(*keys, "_t.*"))


def section_map(sections: DataFrame, mapping: DataFrame, regions: DataFrame,
                principal: DataFrame | None = None, contest: Sequence[str] = ()) -> DataFrame:
    """(municipality, region, zone, place, section) rows of sections with a ballot box.

    `principal` (cd_municipio_tse, nr_zona, nr_secao) leaves aggregated sections out.
    `contest` names the columns (year, round) that keep the maps of several elections apart.
    """
    rows = sections.join(mapping, "id_local_votacao").join(
        regions.select("id_regiao", "cd_municipio_ibge"), "id_regiao")
    if principal is not None:
        rows = rows.join(principal.distinct(), ["cd_municipio_tse", "nr_zona", "nr_secao"], "left_semi")
    return rows.select("cd_municipio_ibge", F.lower("sg_uf").alias("uf"), "cd_municipio_tse",
                       "id_regiao", "nr_zona", "nr_local", "nr_secao", *contest).distinct()


def section_map_counters(sections: DataFrame, mapping: DataFrame, principal: DataFrame) -> DataFrame:
    """Sections mapped, without a region, and aggregated into another section."""
    at = sections.join(mapping.select("id_local_votacao", F.lit(1).alias("_r")), "id_local_votacao", "left")
    at = at.join(principal.distinct().withColumn("_p", F.lit(1)),
                 ["cd_municipio_tse", "nr_zona", "nr_secao"], "left")
    known = F.col("_r").isNotNull()
    return at.agg(F.count_if(known & F.col("_p").isNotNull()).alias("mapeadas"),
                  F.count_if(~known).alias("fora_da_malha"),
                  F.count_if(known & F.col("_p").isNull()).alias("agregadas"))


def section_lists(mapped: DataFrame, contest: Sequence[str] = (), size: int = 1000) -> DataFrame:
    """Per region, its sorted [zone, place, section] triples, in parts of at most `size`."""
    rows = mapped.select("cd_municipio_ibge", "id_regiao", *contest, "nr_zona", "nr_local", "nr_secao").distinct()
    return chunked_lists(rows, ["cd_municipio_ibge", "id_regiao", *contest], ["nr_zona", "nr_local", "nr_secao"],
                         F.array("nr_zona", "nr_local", "nr_secao"), F.struct("nr_zona", "nr_local"), size,
                         "secoes").withColumnRenamed("part", "parte")


def live_votes(rows: DataFrame, mapped: DataFrame, contest: Sequence[str] = ()) -> DataFrame:
    """Ballot rows placed in a region: the declared place must belong to it, in the same `contest`.

    The columns with most values come first: a sort by them seldom compares the others.
    """
    at = mapped.select(F.col("cd_municipio_tse").alias("municipio"), F.col("nr_zona").alias("zona"),
                       F.col("nr_local").alias("local"), F.col("nr_secao").alias("secao"), "id_regiao", *contest)
    return rows.join(at, ["local", "secao", "zona", "municipio", *contest])


def register_votes(rows: DataFrame, sections: DataFrame, mapping: DataFrame, regions: DataFrame,
                   principal: DataFrame | None = None, contest: Sequence[str] = ()) -> DataFrame:
    """`live_votes` over the `section_map` of the same tables, for a map that nothing else reads.

    The place gives the region, and of the section only its presence in the register is asked. The
    register is shuffled once as it stands, neither made distinct nor stored, and both sides carry
    the number of the place instead of what names it.
    """
    key, spot = F.col("id_local_votacao"), ["uf", "municipio", "zona", "local", "id_regiao"]
    known = mapping.join(regions.select("id_regiao"), "id_regiao", "left_semi").select(
        key, F.lower(text.key_part(key, 0)).alias("uf"), text.key_part(key, 1).alias("municipio"),
        text.key_part(key, 2).cast("int").alias("zona"), text.key_part(key, 3).cast("int").alias("local"), "id_regiao")
    # Stored, so that both sides read the same numbers and the planner knows how few they are.
    places = settle(known.select(*spot).distinct().withColumn("_place", F.monotonically_increasing_id()))
    numbered = settle(known.join(places, spot).select("id_local_votacao", "_place").distinct())
    there = sections.join(numbered, "id_local_votacao")
    if principal is not None:
        there = there.join(principal.distinct(), ["cd_municipio_tse", "nr_zona", "nr_secao"], "left_semi")
    return (rows.join(places.drop("uf"), ["municipio", "zona", "local"])
            .join(there.select("_place", F.col("nr_secao").alias("secao"), *contest), ["_place", "secao", *contest], "left_semi")
            .drop("_place"))


def live_results(rows: DataFrame, contest: Sequence[str] = ("cargo",)) -> DataFrame:
    """Votes per region, contest and votable. `rows` come from `live_votes`.

    `contest` must hold the round too where the rows have more than one.

    A vote for an office without candidates is null, and a list vote goes by party,
    as in the batch chain.
    """
    kind = F.when(F.col("tipo") == "cargo_sem_candidato", "nulo").otherwise(F.col("tipo"))
    number = F.when(kind == "legenda", F.col("partido")).when(kind == "nominal", F.col("numero"))
    return rows.groupBy("id_regiao", *contest, kind.alias("tipo"), number.alias("numero")).agg(
        F.sum("quantidade").alias("votos"))


def live_shares(results: DataFrame, contest: Sequence[str] = ("cargo",)) -> DataFrame:
    """Shares over valid votes for votables, over turnout for blank and null."""
    valid = F.col("tipo").isin("nominal", "legenda")
    sums = results.groupBy("id_regiao", *contest).agg(
        F.sum(F.when(valid, F.col("votos"))).alias("validos"), F.sum("votos").alias("comparecimento"))
    both = results.join(sums, ["id_regiao", *contest])
    return both.withColumn("pct", numbers.percent(
        F.col("votos"), F.when(valid, F.col("validos")).otherwise(F.col("comparecimento"))))


def live_progress(rows: DataFrame, mapped: DataFrame, contest: Sequence[str] = ()) -> DataFrame:
    """Ballot boxes counted against expected per region and `contest`: none, partial, complete."""
    keys = ["id_regiao", *contest]
    used = rows.select(*keys, *SECTION).distinct().groupBy(*keys).agg(F.count("*").alias("urnas"))
    expected = mapped.groupBy(*keys).agg(F.count("*").alias("esperadas"))
    both = expected.join(used, keys, "left").fillna(0, ["urnas"])
    return both.withColumn("situacao", F.when(F.col("urnas") == 0, "sem")
                           .when(F.col("urnas") >= F.col("esperadas"), "completo").otherwise("parcial"))


def named_votables(results: DataFrame, candidates: DataFrame, unit: Column) -> DataFrame:
    """Number to name: candidate name, party for a list vote, or the number itself."""
    table = candidates.select("unidade", F.col("cargo").alias("_c"), F.col("numero").alias("_n"),
                              "nome", F.col("partido").alias("sigla"))
    party = candidates.groupBy("unidade", F.substring("numero", 1, 2).alias("_pn")).agg(
        F.min("partido").alias("_psg"))
    both = (results.withColumn("_u", unit).join(
        table, (F.col("unidade") == F.col("_u")) & (F.col("_c") == F.col("cargo"))
        & (F.col("_n") == F.col("numero").cast("string")), "left").drop("unidade")
        .join(party.withColumnRenamed("unidade", "_pu"),
              (F.col("_pu") == F.col("_u")) & (F.col("_pn") == F.col("numero").cast("string")), "left"))
    by_list = F.col("tipo") == "legenda"
    return both.select(
        *results.columns,
        F.when(by_list, F.coalesce("_psg", F.concat(F.lit("Partido "), F.col("numero").cast("string"))))
        .otherwise(F.coalesce("nome", F.concat(F.lit("Número "), F.col("numero").cast("string")))).alias("nome"),
        F.when(by_list, F.col("_psg")).otherwise(F.col("sigla")).alias("partido"))


def over_official(results: DataFrame, limits: DataFrame, keys: list[str], region: str = "id_regiao") -> DataFrame:
    """Regions where some name has more votes than in the whole municipality."""
    return (results.join(limits, [*keys, "nome"]).where(F.col("votos") > F.col("limite"))
            .select(region).distinct())


def withhold(results: DataFrame, limits: DataFrame, keys: list[str], region: str = "id_regiao") -> DataFrame:
    """One violation withholds the whole region."""
    return results.join(over_official(results, limits, keys, region), region, "left_anti")


def overlay(published: DataFrame, live: DataFrame, keys: list[str], top_deputies: int = K.TOP_DEPUTIES) -> DataFrame:
    """Published contests win; live ones only fill what is missing.

    `keys` identify a contest (region, office, year, round). Live deputies are cut to
    the same top list as published ones.
    """
    new = live.join(published.select(*keys).distinct(), keys, "left_anti")
    deputy = new.where("cargo <=> 'deputado_federal'")
    cut = top_n(deputy, keys, "votos", "nome", top_deputies, out="_r").drop("_r")
    rest = new.where("NOT (cargo <=> 'deputado_federal')")
    return (published.withColumn("parcial", F.lit(False))
            .unionByName(rest.unionByName(cut).withColumn("parcial", F.lit(True))))


def live_abstention(voters: DataFrame, turnout: DataFrame) -> DataFrame:
    """Voters minus live turnout; round 1 voters stand in where round 2 has none yet."""
    keys = ["id_regiao", "ano_eleicao"]
    wide = voters.groupBy(*keys).agg(
        *[F.max(F.when(F.col("turno") == t, F.col("qt_eleitores"))).alias(f"_t{t}") for t in "12"])
    both = turnout.join(wide, keys, "left")
    base = F.when(F.col("turno") == "2", F.coalesce("_t2", "_t1")).otherwise(F.col("_t1"))
    gap = base - F.col("comparecimento")
    return both.select(*turnout.columns, base.alias("qt_eleitores"), F.when(gap >= 0, gap).alias("abstencao"))


def compare_territories(local: DataFrame, territory: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    """Align a wider territory to the local top names, the rest as 'Outros', with the
    difference in percentage points.

    `local`: keys, nome, votos, pct; `territory`: keys, nome, pct.
    """
    head = top_n(local, keys, "votos", "nome", n)
    wide = territory.select(*keys, "nome", F.col("pct").alias("pct_territorio"))
    named = head.join(wide, [*keys, "nome"], "left").fillna(0.0, ["pct_territorio"]).select(
        *keys, "rank", "nome", "pct", "pct_territorio")
    whole = local.groupBy(*keys).agg(F.sum("pct").alias("_l")).join(
        territory.groupBy(*keys).agg(F.sum("pct").alias("_t")), keys, "left").fillna(0.0, ["_t"])
    shown = named.groupBy(*keys).agg(F.sum("pct").alias("_ls"), F.sum("pct_territorio").alias("_ts"))
    others = whole.join(shown, keys).select(
        *keys, F.lit(n + 1).alias("rank"), F.lit("Outros").alias("nome"),
        F.greatest(F.col("_l") - F.col("_ls"), F.lit(0.0)).alias("pct"),
        F.greatest(F.col("_t") - F.col("_ts"), F.lit(0.0)).alias("pct_territorio"))
    return named.unionByName(others).withColumn("diferenca_pp", F.col("pct") - F.col("pct_territorio"))


def leadership_change(results: DataFrame, keys: list[str]) -> DataFrame:
    """Leader in the first and in the last year (last round of each), and whether it changed."""
    ahead = F.min_by("nm_votavel", F.struct(-F.col("votos"), F.col("nm_votavel")))
    leaders = results.groupBy(*keys, "ano_eleicao", "turno").agg(ahead.alias("lider"))
    per_year = leaders.groupBy(*keys, "ano_eleicao").agg(F.max_by("lider", "turno").alias("lider"))
    return per_year.groupBy(*keys).agg(
        F.min("ano_eleicao").alias("ano_antes"), F.min_by("lider", "ano_eleicao").alias("lider_antes"),
        F.max("ano_eleicao").alias("ano_agora"), F.max_by("lider", "ano_eleicao").alias("lider_agora")
    ).withColumn("mudou", F.col("lider_antes") != F.col("lider_agora"))


def latest_contest(results: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the latest year, and in it the latest round, of each key."""
    last = results.groupBy(*keys).agg(F.max(F.struct("ano_eleicao", "turno")).alias("_m")).select(
        *keys, "_m.*")
    return results.join(last, [*keys, "ano_eleicao", "turno"])


def _score(candidates: Column, joiner: str) -> Column:
    return F.array_join(F.transform(
        F.slice(candidates, 1, 2), lambda c: F.concat(c["nome"], F.lit(" "), text.percent_br(c["pct"]))), joiner)


def preview_text(share: DataFrame) -> DataFrame:
    """Title and description of a shared link, from `share_summary` rows."""
    ready = F.size(F.coalesce("candidatos", F.array().cast(share.schema["candidatos"].dataType))) > 0
    title = F.concat("local", F.lit(" — "), "nm_municipio", F.lit(" ("), "sg_uf", F.lit(")"))
    told = F.concat(F.lit("Presidente "), "ano", F.lit(", "), "turno", F.lit("º turno: "),
                    _score(F.col("candidatos"), " × "))
    return share.withColumn("titulo", title).withColumn("placar", F.when(ready, told))


def share_text(share: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """Text sent with a link: place, two leaders, and how much is counted."""
    base = F.concat(F.lit("Como votou "), "local", F.lit(", em "), "nm_municipio", F.lit(" – "), "sg_uf")
    if progress is None:
        return share.withColumn("texto", base)
    both = share.join(progress.select(F.col("id_regiao").alias("regiao"), "urnas", "esperadas"),
                      "regiao", "left")
    done = F.concat(F.lit("apuração concluída neste local, "), F.col("urnas").cast("string"),
                    F.lit(" urnas processadas"))
    part = F.concat(F.lit("parcial, "), F.col("urnas").cast("string"), F.lit(" de "),
                    F.col("esperadas").cast("string"), F.lit(" urnas processadas"))
    full = F.concat(base, F.lit(": "), _score(F.col("candidatos"), ", "), F.lit(" — "),
                    F.when(F.col("urnas") == F.col("esperadas"), done).otherwise(part))
    return both.withColumn("texto", F.coalesce(full, base))


def dormant(day: Column, today: Column) -> Column:
    """True until election day; an unreadable date does not hold anything back."""
    return F.coalesce(F.try_to_date(day, "dd/MM/yyyy") > today, F.lit(False))


def preview_is_stale(year: Column, round_: Column, live_year: str, live_round: str, active: bool,
                     day: Column, today: Column) -> Column:
    """While a later contest is being counted, the old score must not be previewed."""
    other = (F.coalesce(year, F.lit("")) != live_year) | (F.coalesce(round_, F.lit("")) != live_round)
    return F.lit(active) & ~dormant(day, today) & other
