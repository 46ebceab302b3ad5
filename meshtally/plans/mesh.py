"""The mesh: completing coordinates, grouping places into regions, active regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import text
from meshtally.operators import guards
from meshtally.operators.addresses import with_metres
from meshtally.operators.nearest import nearest_in_group, snap_to_existing
from meshtally.operators.ordered import ordinal

POINT = ["latitude_final", "longitude_final"]


def municipality_crosswalk(places: DataFrame) -> DataFrame:
    """Electoral municipality code to census code, learnt from places that carry both."""
    return (places.where(F.col("cd_municipio_ibge").isNotNull())
            .groupBy("sg_uf", text.key_part(F.col("id_local_votacao"), 1).alias("cd_municipio_tse"))
            .agg(F.min_by(F.struct(F.trim(F.col("cd_municipio_ibge").cast("string"))
                                   .alias("cd_municipio_ibge"), "nm_municipio"),
                          "id_local_votacao").alias("_m"))
            .select("sg_uf", "cd_municipio_tse", "_m.*"))


def complete_coordinates(base: DataFrame, official: DataFrame) -> DataFrame:
    """Fill missing coordinates from the official register and add its unknown places.

    A known coordinate always wins; a new place next to an existing one takes its
    point, and an official point shared by two municipalities is not adopted.
    """
    cols = base.columns
    origin = F.when(F.col("latitude_final").isNotNull(), "cnefe")
    known = base.withColumn("origem_coordenada", origin)
    off = official.select("id_local_votacao", F.col("latitude").alias("_lat"),
                          F.col("longitude").alias("_lon"))
    fill = F.col("latitude_final").isNull() & F.col("_lat").isNotNull()
    filled = (known.join(off, "id_local_votacao", "left").select(
        *[c for c in cols if c not in POINT],
        F.when(fill, F.col("_lat")).otherwise(F.col("latitude_final")).alias("latitude_final"),
        F.when(fill, F.col("_lon")).otherwise(F.col("longitude_final")).alias("longitude_final"),
        F.when(fill, "tse").otherwise(F.col("origem_coordenada")).alias("origem_coordenada")))
    new = (official.join(base.select("id_local_votacao"), "id_local_votacao", "left_anti")
           .drop("nm_municipio")
           .join(municipality_crosswalk(base), ["sg_uf", "cd_municipio_tse"])
           .select("id_local_votacao", "sg_uf", "nm_municipio", "cd_municipio_ibge",
                   F.col("nm_local_votacao").alias("nm_local_votacao_consolidado"),
                   F.col("ds_endereco").alias("ds_local_votacao_endereco_consolidado"),
                   F.lit("oficial_tse").alias("status_geocodificacao"),
                   F.col("latitude").alias("latitude_final"),
                   F.col("longitude").alias("longitude_final")))
    filled = filled.withColumn("cd_municipio_ibge",
                               F.trim(F.col("cd_municipio_ibge").cast("string")))
    snapped = snap_to_existing(new, filled, ["cd_municipio_ibge"], *POINT, "id_local_votacao",
                               K.SAME_BUILDING_M, taken="_snapped")
    new = snapped.withColumn("origem_coordenada", F.when(F.col("_snapped"), "cnefe")
                             .otherwise("tse")).drop("_snapped")
    return drop_ambiguous_points(filled.unionByName(new))


def unmatched_municipalities(base: DataFrame, official: DataFrame) -> DataFrame:
    """Official places without a census municipality: counted, then left out."""
    new = official.join(base.select("id_local_votacao"), "id_local_votacao", "left_anti")
    lost = new.join(municipality_crosswalk(base), ["sg_uf", "cd_municipio_tse"], "left_anti")
    return lost.agg(F.count("*").alias("locais"),
                    F.count_distinct("sg_uf", "cd_municipio_tse").alias("municipios"))


def drop_ambiguous_points(places: DataFrame) -> DataFrame:
    """An official point that falls in two municipalities loses its coordinate."""
    spread = (places.where(F.col("latitude_final").isNotNull()).groupBy(*POINT)
              .agg((F.min("cd_municipio_ibge") != F.max("cd_municipio_ibge")).alias("_amb"))
              .where("_amb"))
    rows = places.join(spread, POINT, "left")
    drop = F.coalesce(F.col("_amb"), F.lit(False)) & (F.col("origem_coordenada") == "tse")
    return rows.select(*[F.when(~drop, F.col(c)).alias(c)
                         if c in (*POINT, "origem_coordenada") else F.col(c)
                         for c in places.columns])


def mappable(places: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Places that can form a region: at home, with a coordinate."""
    out = places.where((F.col("sg_uf") != K.ABROAD) & F.col("latitude_final").isNotNull()
                       & F.col("longitude_final").isNotNull())
    return out.where(F.col("sg_uf").isin(states)) if states else out


def build_regions(places: DataFrame, band: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """(region dimension, place -> region). A region is one exact coordinate.

    Ids are dense and follow (state, municipality, latitude, longitude); they are
    numbered per latitude band so no single task sorts the country.
    """
    name, key = F.col("nm_local_votacao_consolidado"), F.col("id_local_votacao")
    address = F.col("ds_local_votacao_endereco_consolidado")
    by_name = F.struct(name.isNull(), name, key)
    points = places.groupBy(*POINT).agg(
        F.min("sg_uf").alias("sg_uf"), F.min("cd_municipio_ibge").alias("cd_municipio_ibge"),
        F.min("nm_municipio").alias("nm_municipio"),
        F.count_distinct("id_local_votacao").alias("n_locais_votacao"),
        # "cnefe" sorts before "tse", which is also the order of trust.
        F.min("origem_coordenada").alias("origem_coordenada"),
        F.min("nm_local_votacao_consolidado").alias("nm_local_votacao"),
        F.min_by(address, F.when(address.isNotNull(), by_name)).alias("ds_endereco"))
    order = ["sg_uf", "cd_municipio_ibge", *POINT]
    block: Column = F.struct("sg_uf", "cd_municipio_ibge", F.floor(F.col("latitude_final") / band))
    regions = ordinal(points, [], order, block, out="id_regiao", start=1)
    mapping = places.select("id_local_votacao", *POINT).join(
        regions.select("id_regiao", *POINT), POINT).select("id_local_votacao", "id_regiao")
    return regions.select("id_regiao", *[c for c in points.columns]), mapping


def other_names(places: DataFrame, mapping: DataFrame) -> DataFrame:
    """Other place names at a region's point: all distinct names but the shown one."""
    names = (places.join(mapping, "id_local_votacao")
             .select("id_regiao", F.col("nm_local_votacao_consolidado").alias("nome"))
             .where(F.col("nome").isNotNull()).distinct())
    shown = names.groupBy("id_regiao").agg(F.min("nome").alias("nome"))
    return names.join(shown, ["id_regiao", "nome"], "left_anti")


def region_guards(places: DataFrame, mapping: DataFrame) -> list[DataFrame]:
    return [guards.constant_per_group(places, POINT, ["cd_municipio_ibge", "sg_uf"], "regions"),
            guards.inside_country(places, *POINT, "regions"),
            guards.unique_key(mapping, ["id_local_votacao"], "place to region")]


def places_of_year(voters: DataFrame, year: int) -> DataFrame:
    return voters.where(F.col("ano_eleicao") == year).select("id_local_votacao").distinct()


def regions_of_year(voters: DataFrame, mapping: DataFrame, year: int) -> DataFrame:
    """Regions whose places operate in the year; empty when the year is unknown."""
    return mapping.join(places_of_year(voters, year), "id_local_votacao", "left_semi").select(
        "id_regiao").distinct()


def active_regions(region_votes: DataFrame, voters: DataFrame, mapping: DataFrame,
                   year: int) -> DataFrame:
    """Regions that exist in the year: with an operating place, or with votes."""
    voted = region_votes.where(F.col("ano_eleicao") == year).select("id_regiao")
    return voted.union(regions_of_year(voters, mapping, year)).distinct()


def displayable_regions(regions: DataFrame, region_votes: DataFrame, voters: DataFrame,
                        mapping: DataFrame, year: int) -> DataFrame:
    """Regions with a result to show, or present in the reference year's mesh."""
    ids = region_votes.select("id_regiao").union(regions_of_year(voters, mapping, year)).distinct()
    return regions.join(ids, "id_regiao", "left_semi")


def reallocation(regions: DataFrame, active: DataFrame) -> DataFrame:
    """(id_regiao, destino): inactive regions go to the nearest active one of their
    municipality; where none is active they stay."""
    metric = with_metres(regions, *POINT)
    marked = metric.join(active.withColumn("_active", F.lit(True)), "id_regiao", "left")
    idle = marked.where(F.col("_active").isNull())
    goal = marked.where(F.col("_active")).select("cd_municipio_ibge", "x", "y",
                                                 F.col("id_regiao").alias("destino"))
    moved = nearest_in_group(idle.select("id_regiao", "cd_municipio_ibge", "x", "y"), goal,
                             ["cd_municipio_ibge"], ("x", "y"), ("x", "y"), "destino")
    return moved.select("id_regiao", F.coalesce("destino", "id_regiao").alias("destino"),
                        F.col("distancia")).unionByName(
        marked.where(F.col("_active")).select("id_regiao", F.col("id_regiao").alias("destino"),
                                              F.lit(0.0).alias("distancia")))


def public_keys(regions: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(region -> public key, alias -> public key), both within a municipality.

    The public key is `zone-place` of the region's smallest place; the keys of its
    other places are aliases.
    """
    zone = text.key_part(F.col("id_local_votacao"), 2).cast("int")
    place = text.key_part(F.col("id_local_votacao"), 3).cast("int")
    keyed = mapping.select("id_regiao", zone.alias("zona"), place.alias("local"),
                           F.concat(zone, F.lit("-"), place).alias("chave"))
    first = keyed.groupBy("id_regiao").agg(F.min_by("chave", F.struct("zona", "local"))
                                           .alias("id_publico"))
    ids = regions.select("id_regiao", "cd_municipio_ibge").join(first, "id_regiao")
    aliases = (keyed.join(ids, "id_regiao").where(F.col("chave") != F.col("id_publico"))
               .select("cd_municipio_ibge", F.col("chave").alias("apelido"), "id_publico",
                       "id_regiao"))
    return ids, aliases


def resolve_public_key(asked: DataFrame, ids: DataFrame, aliases: DataFrame) -> DataFrame:
    """Canonical key -> itself; alias -> redirect; malformed or unknown -> not found.

    `asked` has cd_municipio_ibge and chave.
    """
    on = ["cd_municipio_ibge", "chave"]
    canon = ids.select("cd_municipio_ibge", F.col("id_publico").alias("chave"),
                       F.col("id_regiao").alias("_own"))
    alias = aliases.select("cd_municipio_ibge", F.col("apelido").alias("chave"),
                           F.col("id_publico").alias("_to"), F.col("id_regiao").alias("_there"))
    both = asked.join(canon, on, "left").join(alias, on, "left")
    shaped = F.col("chave").rlike(K.PUBLIC_KEY_FORMAT) & F.col("cd_municipio_ibge").rlike(r"^\d{7}$")
    return both.select(
        *asked.columns,
        F.when(~shaped, "invalido").when(F.col("_own").isNotNull(), "canonico")
        .when(F.col("_to").isNotNull(), "redireciona").otherwise("nao_encontrado").alias("situacao"),
        F.when(shaped, F.when(F.col("_own").isNotNull(), F.col("chave")).otherwise(F.col("_to")))
        .alias("id_publico"),
        F.when(shaped, F.coalesce("_own", "_there")).alias("id_regiao"))
