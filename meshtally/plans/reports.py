"""Quality reports: accuracy, divergence, distances, place comparison, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import geo, numbers, text, votes as V
from meshtally.operators import addresses
from meshtally.operators.ordered import exact_percentiles
from meshtally.plans.mesh import POINT
from meshtally.plans.resolve import resolve
from meshtally.plans.street_index import StreetIndex, ambiguous_coverage
from meshtally.session import settle
from meshtally.sources.documents import report_document
from meshtally.sources.tables import sample_per_group

PERCENTILES = {f"p{p}": p / 100 for p in (50, 75, 90, 95, 99)}
PATHS = {"so_rua": (False, False), "rua_bairro": (False, True), "rua_numero": (True, False),
         "completo": (True, True)}


def group_median(df: DataFrame, keys: Sequence[str], values: Sequence[str], suffix: str = "_mediana") -> DataFrame:
    """Attach the exact median of each value within its group; all values in one pass."""
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(v).alias("_name"), F.col(v).cast("double").alias("_value")) for v in values])).alias("_x"))
    med = exact_percentiles(long.select(*keys, "_x.*"), [*keys, "_name"], "_value", {"_med": 0.5})
    wide = med.groupBy(*[F.col(k).alias(f"_m_{k}") for k in keys]).agg(
        *[F.max(F.when(F.col("_name") == v, F.col("_med"))).alias(f"{v}{suffix}") for v in values])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_m_{k}"))
    return df.join(wide, match, "left").drop(*[f"_m_{k}" for k in keys])


def ratio_to_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "razao") -> DataFrame:
    """value / group median; nothing to divide by gives 0."""
    both = group_median(df, keys, [value], "_med")
    return both.withColumn(out, F.coalesce(F.col(value) / F.nullif(F.col(f"{value}_med"), F.lit(0.0)),
                                           F.lit(0.0))).drop(f"{value}_med")


def coordinate_divergence(mapping: DataFrame, regions: DataFrame, official: DataFrame) -> DataFrame:
    """Distance between our coordinate and the official one per place, and which is suspect.

    Only places whose own coordinate is independent of the official register.
    """
    ours = mapping.join(regions.where("origem_coordenada = 'cnefe'").select(
        "id_regiao", "latitude_final", "longitude_final", "cd_municipio_ibge", "nm_municipio", "sg_uf"),
        "id_regiao")
    both = settle(ours.join(official.select("id_local_votacao", "latitude", "longitude", "nm_local_votacao"),
                            "id_local_votacao"))
    points = ["latitude_final", "longitude_final", "latitude", "longitude"]
    med = group_median(both, ["cd_municipio_ibge"], points, "_c")
    rows = med.select(
        "id_local_votacao", "cd_municipio_ibge", "nm_municipio", "sg_uf", "nm_local_votacao",
        geo.great_circle(*[F.col(c) for c in points]).alias("distancia_m"),
        geo.great_circle(F.col("latitude_final"), F.col("longitude_final"), F.col("latitude_final_c"),
                         F.col("longitude_final_c")).alias("ao_centro_nosso"),
        geo.great_circle(F.col("latitude"), F.col("longitude"), F.col("latitude_c"),
                         F.col("longitude_c")).alias("ao_centro_tse"))
    return rows.withColumn("suspeito", V.suspect_source(
        F.col("ao_centro_nosso"), F.col("ao_centro_tse"), "nosso", "tse"))


def divergence_report(rows: DataFrame, worst: int = 50) -> DataFrame:
    """One-row report: percentiles, count beyond the limit, suspects, worst cases."""
    far = rows.where(F.col("distancia_m") > K.DIVERGENCE_M)
    return report_document(
        contagem=rows.agg(F.count("*").alias("locais_comparados"),
                          F.count_if(F.col("distancia_m") > K.DIVERGENCE_M).alias("divergentes")),
        percentis=exact_percentiles(rows, [], "distancia_m", PERCENTILES),
        suspeito=(far.groupBy("suspeito").agg(F.count("*").alias("locais")), "suspeito"),
        piores=(far.orderBy(F.desc("distancia_m"), "id_local_votacao").limit(worst)
                .withColumn("_o", -F.col("distancia_m")), "_o"))


def summarise_distances(rows: DataFrame, keys: Sequence[str] = ("sg_uf",)) -> DataFrame:
    """National and per-state distance figures from mergeable per-region sums.

    `nivel` is 0 for the nation. Figures are left unrounded.
    """
    total = F.sum("n_enderecos")
    g = rows.rollup(*keys).agg(
        F.grouping_id().alias("_g"), total.alias("enderecos"),
        (F.sum("soma_dist") / total).alias("distancia_media_m"),
        (F.sum("acima_5km") / total * 100).alias("pct_acima_5km"),
        (F.sum("acima_25km") / total * 100).alias("pct_acima_25km"), F.count("*").alias("regioes"),
        F.count_if(F.col("acima_25km") > 0).alias("regioes_com_endereco_acima_25km"),
        (F.max("dist_max") / 1000).alias("distancia_maxima_km"),
        F.count_if(F.col("dist_min") == 0).alias("regioes_com_endereco_na_coordenada_exata"))
    return g.withColumn("nivel", F.when(F.col("_g") == 0, len(keys)).otherwise(0)).drop("_g")


def distance_diagnostics(summary: DataFrame, regions: DataFrame, top: int = 30) -> dict[str, DataFrame]:
    """Regions whose coordinate looks wrong: three bounded lists, plus the summary."""
    rows = summary.join(regions.select("id_regiao", "sg_uf", "cd_municipio_ibge", "nm_municipio",
                                       "nm_local_votacao", "ds_endereco"), "id_regiao", "left")
    rows = settle(ratio_to_median(rows.withColumn("media", F.col("soma_dist") / F.col("n_enderecos")),
                                  ["cd_municipio_ibge"], "media", "razao_municipio"))
    return {
        "resumo": summarise_distances(rows),
        "sem_vizinho": rows.where("dist_min > 100").orderBy(F.desc("dist_min"), "id_regiao").limit(top),
        "mais_distantes": rows.where("acima_25km > 0").orderBy(
            F.desc("acima_25km"), F.desc("dist_max"), "id_regiao").limit(top),
        "destoantes": rows.where((F.col("n_enderecos") >= 100) & (F.col("media") >= K.FAR_M)).orderBy(
            F.desc("razao_municipio"), "id_regiao").limit(top)}


def classify_places(places: DataFrame, base: DataFrame) -> DataFrame:
    """A new year's places against the base: new, known without coordinate, same, changed.

    `places`: id_local_votacao, sg_uf, nome, endereco; two empty texts prove nothing.
    """
    known = base.select("id_local_votacao", F.lit(True).alias("_hit"),
                        F.col("nm_local_votacao_consolidado").alias("_n"),
                        F.col("ds_local_votacao_endereco_consolidado").alias("_e"),
                        F.col("latitude_final").alias("_lat"))
    both = places.join(known, "id_local_votacao", "left")

    def same(a: str, b: str) -> Column:
        x = text.comparable(F.col(a))
        return (x == text.comparable(F.col(b))) & (x != "")

    return both.withColumn(
        "situacao", F.when(F.col("_hit").isNull(), "id_novo")
        .when(F.col("_lat").isNull(), "id_conhecido_sem_coordenada")
        .when(same("nome", "_n") | same("endereco", "_e"), "mesmo_local")
        .otherwise("id_conhecido_nome_endereco_mudou")).drop("_hit", "_n", "_e", "_lat")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str], total: str = "total") -> DataFrame:
    """Counts with margins, and row percentages with one decimal."""
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    g = df.rollup(row).agg(F.grouping_id().alias("_g"), *counts, F.count("*").alias(total))
    share = [(F.floor((F.col(v) * 2000 + F.col(total)) / (F.col(total) * 2)) / 10).alias(f"pct_{v}")
             for v in values]
    return g.select(F.when(F.col("_g") == 1, total).otherwise(F.col(row)).alias(row), *values, total, *share)


def geocoding_coverage(base: DataFrame, official: DataFrame, mapping: DataFrame,
                       regions: DataFrame) -> DataFrame:
    """Known places with a coordinate, per state and in total (`sg_uf` null)."""
    both = base.select("id_local_votacao", "sg_uf", F.lit(0).alias("_p")).unionByName(
        official.select("id_local_votacao", "sg_uf", F.lit(1).alias("_p")))
    universe = both.groupBy("id_local_votacao").agg(F.min_by("sg_uf", F.struct("_p", "sg_uf")).alias("sg_uf"))
    universe = universe.where(F.col("sg_uf") != K.ABROAD)
    located = mapping.join(regions.select("id_regiao", "origem_coordenada"), "id_regiao")
    rows = universe.join(located.select("id_local_votacao", "origem_coordenada"), "id_local_votacao", "left")
    has = F.col("origem_coordenada")
    return rows.rollup("sg_uf").agg(
        F.count("*").alias("locais"), F.count(has).alias("com_coordenada"),
        F.count_if(has == "cnefe").alias("por_cnefe"), F.count_if(has == "tse").alias("por_tse"))


def vote_coverage(place_votes: DataFrame, region_votes: DataFrame) -> DataFrame:
    """Votes counted, and votes that fall inside some region."""
    a = place_votes.agg(F.sum("qt_votos").alias("votos_apurados"))
    b = region_votes.agg(F.sum("qt_votos").alias("votos_em_regiao"),
                         F.count_distinct("id_regiao").alias("regioes_com_voto"))
    return a.join(F.broadcast(b))


def sampled_truth(raw: DataFrame, regions: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n addresses of each state, with the nearest region of their municipality as the truth.

    `raw`: address file rows; `regions`: the region dimension. The sample follows a seeded
    digest of the address key, so it is the same in every run, and each task keeps only its
    own first n before the shuffle. Addresses without a coordinate, or in a municipality
    without regions, have no truth and are not drawn.
    """
    states = regions.groupBy("cd_municipio_ibge").agg(F.min("sg_uf").alias("sg_uf"))
    located = raw.where(numbers.number_or_null(F.col("LATITUDE")).isNotNull()
                        & numbers.number_or_null(F.col("LONGITUDE")).isNotNull())
    of_state = located.join(states, F.trim("COD_MUNICIPIO") == F.col("cd_municipio_ibge")).drop("cd_municipio_ibge")
    drawn = sample_per_group(of_state, ["sg_uf"], ["COD_UNICO_ENDERECO", "COD_ESPECIE"], n, seed)
    near = addresses.assign_to_regions(addresses.clean_addresses(drawn), addresses.with_metres(regions, *POINT))
    return near.join(states, "cd_municipio_ibge").select(
        F.xxhash64("cd_municipio_ibge", "logradouro", "numero", "latitude", "longitude").alias("id"), "sg_uf",
        "cd_municipio_ibge", "logradouro", "numero", "bairro", "domicilio", F.col("id_regiao").alias("verdade"))


def path_predictions(sample: DataFrame, index: StreetIndex) -> DataFrame:
    """The sample with the answer of each of the four query paths.

    `sample`: id, sg_uf, cd_municipio_ibge, logradouro, numero, bairro, domicilio, verdade.
    All four questions of a row go through one resolution.
    """
    asks = [F.struct(F.lit(name).alias("caminho"),
                     (F.col("numero") if number else F.lit(None)).cast("bigint").alias("numero"),
                     (F.col("bairro") if local else F.lit(None)).cast("string").alias("bairro"))
            for name, (number, local) in PATHS.items()]
    asked = sample.select("id", "sg_uf", "domicilio", "verdade",
                          F.col("cd_municipio_ibge").alias("cd_municipio"),
                          F.col("logradouro").alias("rua"), F.explode(F.array(*asks)).alias("q"))
    asked = asked.select("id", "sg_uf", "domicilio", "verdade", "cd_municipio", "rua", "q.*")
    return resolve(asked, index).select("id", "sg_uf", "domicilio", "verdade", "caminho", "id_regiao")


def accuracy(predictions: DataFrame) -> DataFrame:
    """Hit rate per state and path, for all addresses and for residences."""
    hit = F.coalesce(F.col("id_regiao") == F.col("verdade"), F.lit(False)).cast("int")
    home = F.col("domicilio")
    return predictions.groupBy("sg_uf", "caminho").agg(
        F.count("*").alias("amostra"), F.sum(hit).alias("acertos"),
        F.count_if(home).alias("amostra_domicilios"),
        F.coalesce(F.sum(F.when(home, hit)), F.lit(0)).alias("acertos_domicilios"),
        F.count_if(F.col("id_regiao").isNotNull()).alias("ruas_encontradas"))


def accuracy_overall(per_state: DataFrame) -> DataFrame:
    """Per path: the plain mean over states, and the mean weighted by sample size."""
    rate = F.col("acertos") / F.col("amostra") * 100
    homes = F.col("acertos_domicilios") / F.nullif(F.col("amostra_domicilios"), F.lit(0)) * 100
    return per_state.groupBy("caminho").agg(
        F.avg(rate).alias("acerto_pct"), F.avg(homes).alias("acerto_domicilios_pct"),
        (F.sum("acertos") / F.sum("amostra") * 100).alias("acerto_ponderado_pct"))


def coverage_report(geocoding: DataFrame, votes: DataFrame, counts: DataFrame,
                    per_path: DataFrame | None = None) -> DataFrame:
    """The coverage report as one nested row."""
    parts = {"geocodificacao": (geocoding, "sg_uf"), "voto": votes, "enderecos": ambiguous_coverage(counts)}
    if per_path is not None:
        parts["acerto_por_caminho"] = (per_path, "caminho")
    return report_document(**parts)
