"""Published documents: one row per document, never one row per municipality.

A municipality is a folder of documents, so a huge one is many rows in many tasks.
Lists with no natural bound (runs, localities, names) are cut in parts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import text
from meshtally.operators import votes as VOTES
from meshtally.operators.ordered import chunked_lists
from meshtally.plans.mesh import public_keys
from meshtally.plans.street_index import NUMBER_BLOCK, StreetIndex
from meshtally.schemas import STREET
from meshtally.session import settle


def _slug() -> Column:
    return text.office_slug(F.col("cargo"))


def published_candidates(votes: DataFrame, where: list[str]) -> DataFrame:
    """Candidate rows that are published: all for president, the top few for deputy."""
    rows = VOTES.candidate_results(votes, where)
    president = rows.where("cargo = 'PRESIDENTE'")
    deputy = rows.where("cargo = 'DEPUTADO FEDERAL'")
    return president.unionByName(
        VOTES.top_candidates(deputy, where, K.TOP_DEPUTIES).drop("rank"))


def _nest(df: DataFrame, where: list[str], keys: list[str], value: Column, out: str) -> DataFrame:
    """Nested maps keyed by `keys` (outermost first), one level per aggregation."""
    rows, left = df.select(*where, *keys, value.alias(out)), list(keys)
    while left:
        last = left.pop()
        entry = F.struct(F.col(last).cast("string").alias("k"), F.col(out).alias("v"))
        rows = rows.groupBy(*where, *left).agg(F.map_from_entries(F.collect_list(entry)).alias(out))
    return rows


def candidate_list(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, candidatos): ranked list of name, party, votes, share."""
    item = F.struct((-F.col("votos")).alias("o"), "nm_votavel",
                    text.title_case(F.col("nm_votavel")).alias("nome"),
                    F.col("sg_partido").alias("partido"), "votos", "pct")
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_l")).select(
        *keys, F.transform("_l", lambda x: F.struct(
            x["nome"].alias("nome"), x["partido"].alias("partido"), x["votos"].alias("votos"),
            x["pct"].alias("pct"))).alias("candidatos"))


def region_results(votes: DataFrame, where: list[str] | None = None) -> DataFrame:
    """Nested results per region: office -> year -> round -> candidates, blanks, totals."""
    where = where or ["id_regiao"]
    keys = [*where, "cargo", "ano_eleicao", "turno"]
    lists = candidate_list(published_candidates(votes, where), keys).withColumn("cargo", _slug())
    totals = VOTES.contest_totals(votes, where).withColumn("cargo", _slug())
    levels = ["cargo", "ano_eleicao", "turno"]
    spare = F.struct(F.struct(F.col("brancos").alias("votos"), F.col("pct_brancos").alias("pct")).alias("branco"),
                     F.struct(F.col("nulos").alias("votos"), F.col("pct_nulos").alias("pct")).alias("nulo"))
    out = _nest(lists, where, levels, F.col("candidatos"), "resultados")
    out = out.join(_nest(totals, where, levels, spare, "nao_nominal"), where, "full")
    return out.join(_nest(totals, where, levels, F.col("total"), "total_votos"), where, "full")


def region_voters(voters: DataFrame, mapping: DataFrame, votes: DataFrame) -> DataFrame:
    """Voters and abstention per region, year and round (president turnout)."""
    keys = ["id_regiao", "ano_eleicao", "turno"]
    enrolled = voters.join(mapping, "id_local_votacao").groupBy(*keys).agg(
        F.sum("qt_eleitores").alias("qt_eleitores"))
    turnout = votes.where("cargo = 'PRESIDENTE'").groupBy(*keys).agg(
        F.sum("qt_votos").alias("comparecimento"))
    return VOTES.abstention(enrolled, turnout, keys)


def voter_maps(rows: DataFrame) -> DataFrame:
    key = ["id_regiao"]
    levels = ["ano_eleicao", "turno"]
    known = rows.where("abstencao is not null")
    return _nest(rows, key, levels, F.col("qt_eleitores"), "eleitorado").join(
        _nest(known, key, levels, F.col("abstencao"), "abstencao"), key, "left")


def region_documents(regions: DataFrame, mapping: DataFrame, votes: DataFrame,
                     voters: DataFrame, names: DataFrame | None = None, size: int = 1000) -> DataFrame:
    """One document per region, in its municipality's folder.

    A region with more than `size` other names goes on in further rows (`parte` 1, 2, ...),
    which hold names alone.
    """
    ids, _ = public_keys(regions, mapping)
    doc = (regions.join(ids.select("id_regiao", "id_publico"), "id_regiao")
           .join(region_results(votes), "id_regiao", "left")
           .join(voter_maps(region_voters(voters, mapping, votes)), "id_regiao", "left"))
    if names is not None:
        parts = chunked_lists(names, ["id_regiao"], ["nome"], F.col("nome"),
                              F.substring("nome", 1, 2), size, "outros_locais")
        doc = doc.join(parts, "id_regiao", "left")
    else:
        doc = doc.withColumn("outros_locais", F.array().cast("array<string>")).withColumn("part", F.lit(0))
    doc = doc.withColumn("parte", F.coalesce("part", F.lit(0)).cast("bigint"))
    return doc.select(
        "cd_municipio_ibge", "id_regiao", F.col("id_publico").alias("id"), "parte",
        F.col("nm_local_votacao").alias("local"), F.col("ds_endereco").alias("endereco"),
        F.round("latitude_final", 6).alias("lat"), F.round("longitude_final", 6).alias("lon"),
        F.coalesce("outros_locais", F.array().cast("array<string>")).alias("outros_locais"),
        *[F.when(F.col("parte") == 0, F.col(c)).alias(c) for c in
          ("resultados", "nao_nominal", "total_votos", "eleitorado", "abstencao")])


def share_summary(regions: DataFrame, mapping: DataFrame, votes: DataFrame) -> DataFrame:
    """Link preview per region: latest president contest (top two, valid sum) and the
    top deputy of the latest year. Regions without results stay, with nulls."""
    ids, _ = public_keys(regions, mapping)
    rows = settle(published_candidates(votes, ["id_regiao"]))
    pres = rows.where("cargo = 'PRESIDENTE'")
    latest = pres.groupBy("id_regiao").agg(F.max(F.struct("ano_eleicao", "turno")).alias("_m")).select(
        "id_regiao", "_m.*")
    at = pres.join(latest, ["id_regiao", "ano_eleicao", "turno"])
    keys = ["id_regiao", "ano_eleicao", "turno"]
    two = candidate_list(VOTES.top_candidates(at, ["id_regiao"], 2), keys).join(
        at.groupBy(*keys).agg(F.sum("votos").alias("validos")), keys)
    best = rows.where("cargo = 'DEPUTADO FEDERAL' and turno = '1'").groupBy("id_regiao").agg(
        F.min_by(F.struct(text.title_case(F.col("nm_votavel")).alias("nome"),
                          F.col("sg_partido").alias("partido"), "pct",
                          F.col("ano_eleicao").cast("string").alias("ano")),
                 F.struct(-F.col("ano_eleicao"), -F.col("votos"), F.col("nm_votavel"))).alias("deputado"))
    return (ids.join(regions.select("id_regiao", "nm_local_votacao", "ds_endereco", "nm_municipio",
                                    "sg_uf"), "id_regiao")
            .join(two, "id_regiao", "left").join(best, "id_regiao", "left")
            .select("cd_municipio_ibge", "nm_municipio", "sg_uf", F.col("id_publico").alias("chave"),
                    F.col("id_regiao").alias("regiao"), F.col("nm_local_votacao").alias("local"),
                    F.col("ds_endereco").alias("endereco"),
                    F.col("ano_eleicao").cast("string").alias("ano"), "turno", "candidatos",
                    "validos", F.when(F.col("ano_eleicao").isNotNull(), F.col("deputado")).alias("deputado")))


def street_documents(index: StreetIndex, size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(street documents, street x locality documents); long lists come in parts.

    Fractions are rounded to three decimals here and only here.
    """
    pair = F.struct("id_regiao", F.round("fracao", 3).alias("fracao"))
    runs = chunked_lists(index.runs, STREET, ["numero_inicial"],
                         F.struct("numero_inicial", "id_regiao"),
                         F.floor(F.col("numero_inicial") / NUMBER_BLOCK), size, "trechos")
    lists = chunked_lists(index.street_regions.withColumn("_o", -F.col("peso")), STREET,
                          ["_o", "id_regiao"], pair, _weight_block("peso"), size, "regioes")
    both = runs.join(lists, [*STREET, "part"], "full")
    docs = index.streets.join(both, STREET, "left").select(
        "cd_municipio_ibge", F.col("logradouro").alias("nome"),
        F.coalesce("part", F.lit(0)).cast("bigint").alias("parte"),
        F.col("id_regiao_dominante").alias("regiao_provavel"), F.col("n_regioes"),
        F.round("fracao", 3).alias("confianca"), "trechos", "regioes")
    key = [*STREET, "bairro"]
    local = chunked_lists(index.street_localities.withColumn("_o", -F.col("peso")), key,
                          ["_o", "id_regiao"], pair, _weight_block("peso"), size, "regioes")
    weight = index.street_localities.groupBy(*key).agg(F.sum("peso").alias("peso"))
    return docs, local.join(weight, key).select(
        "cd_municipio_ibge", F.col("logradouro").alias("nome"), "bairro",
        F.col("part").alias("parte"), "peso", "regioes")


def _weight_block(weight: str) -> Column:
    """Falling powers of two of the weight: a block order that matches heaviest first."""
    return -F.floor(F.log2(F.col(weight) + 1))


def locality_documents(index: StreetIndex, size: int = 1000) -> DataFrame:
    key = ["cd_municipio_ibge", "bairro"]
    pair = F.struct("id_regiao", F.round("fracao", 3).alias("fracao"))
    lists = chunked_lists(index.localities.withColumn("_o", -F.col("peso")), key,
                          ["_o", "id_regiao"], pair, _weight_block("peso"), size, "regioes")
    weight = index.localities.groupBy(*key).agg(F.sum("peso").alias("peso"))
    return lists.join(weight, key).select(
        "cd_municipio_ibge", F.col("bairro").alias("nome"), F.col("part").alias("parte"), "peso",
        "regioes")


def aggregate_documents(votes: DataFrame, where: list[str]) -> DataFrame:
    """President results of a territory level, as candidate lists per contest."""
    pres = votes.where("cargo = 'PRESIDENTE'")
    rows = VOTES.candidate_results(pres, where, list_votes_valid=False)
    keys = [*where, "ano_eleicao", "turno"]
    lists = candidate_list(rows, keys)
    totals = VOTES.contest_totals(pres, where, list_votes_valid=False).drop("cargo")
    return totals.join(lists, keys, "left")


def metadata(regions: DataFrame, votes: DataFrame, reference_year: int) -> DataFrame:
    """What exists in the base: rounds per office and year, counts, date of the build."""
    rounds = votes.groupBy(_slug().alias("cargo"), "ano_eleicao").agg(
        F.array_sort(F.collect_set("turno")).alias("turnos"))
    elections = _nest(rounds.withColumn("_one", F.lit(1)), ["_one"], ["cargo", "ano_eleicao"],
                      F.col("turnos"), "eleicoes").drop("_one")
    counts = regions.agg(F.count_distinct("sg_uf").alias("ufs"),
                         F.count_distinct("cd_municipio_ibge").alias("municipios"),
                         F.count("*").alias("regioes"))
    return counts.join(F.broadcast(elections)).select(
        F.lit(date.today().isoformat()).alias("gerado_em"),
        F.lit(reference_year).alias("ano_referencia_malha"), "eleicoes", "ufs", "municipios",
        "regioes", F.lit(K.TOP_DEPUTIES).alias("n_top_deputados"))


def municipality_index(regions: DataFrame) -> DataFrame:
    """Municipalities of each state, by name."""
    return regions.select("sg_uf", "cd_municipio_ibge", "nm_municipio").distinct()


def state_index(regions: DataFrame) -> DataFrame:
    """States with name, census code (two first digits) and number of municipalities."""
    names = F.create_map(*[F.lit(x) for p in K.STATE_NAMES.items() for x in p])
    return municipality_index(regions).groupBy("sg_uf").agg(
        F.count("*").alias("n_municipios"),
        F.substring(F.min("cd_municipio_ibge"), 1, 2).alias("cd")).select(
        F.col("sg_uf").alias("sigla"),
        F.coalesce(F.try_element_at(names, F.col("sg_uf")), F.col("sg_uf")).alias("nome"), "cd",
        "n_municipios")
