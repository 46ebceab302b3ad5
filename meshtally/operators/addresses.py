"""Addresses: from the raw national file to street x number x region counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import geo, numbers, text
from meshtally.operators.nearest import nearest_in_group
from meshtally.schemas import ADDRESS_COLUMNS


def clean_addresses(raw: DataFrame) -> DataFrame:
    """Distinct addresses with a coordinate, typed, with metres.

    The file's key is (address code, kind): one code serves a home and a shop.
    """
    once = raw.dropDuplicates(["COD_UNICO_ENDERECO", "COD_ESPECIE"])
    lat, lon = numbers.number_or_null(F.col("LATITUDE")), numbers.number_or_null(F.col("LONGITUDE"))
    typed = once.select(
        F.trim("COD_MUNICIPIO").alias("cd_municipio_ibge"),
        text.street_name(F.col("NOM_TIPO_SEGLOGR"), F.col("NOM_TITULO_SEGLOGR"),
                         F.col("NOM_SEGLOGR")).alias("logradouro"),
        text.locality(F.col("DSC_LOCALIDADE")).alias("bairro"),
        numbers.number_or_null(F.col("NUM_ENDERECO")).cast("bigint").alias("numero"),
        F.coalesce(F.col("COD_ESPECIE").isin(K.RESIDENCE_KINDS), F.lit(False)).alias("domicilio"),
        lat.alias("latitude"), lon.alias("longitude"))
    x, y = geo.polyconic(F.col("latitude"), F.col("longitude"))
    return typed.dropna(subset=["latitude", "longitude"]).withColumn("x", x).withColumn("y", y)


def with_metres(df: DataFrame, lat: str, lon: str) -> DataFrame:
    x, y = geo.polyconic(F.col(lat), F.col(lon))
    return df.withColumn("x", x).withColumn("y", y)


def assign_to_regions(addresses: DataFrame, regions: DataFrame, **options) -> DataFrame:
    """Each address to the nearest region of its own municipality, with the distance.

    Addresses of a municipality without regions are dropped, as they have no answer.
    """
    geo.require_metric(K.METRIC_CRS, "address assignment")
    found = nearest_in_group(addresses, regions, ["cd_municipio_ibge"], ("x", "y"), ("x", "y"),
                             "id_regiao", "distancia", **options)
    return found.where(F.col("id_regiao").isNotNull())


def address_counts(assigned: DataFrame) -> DataFrame:
    """Addresses and residences per street, locality, number and region; no number stays null."""
    return assigned.groupBy(*ADDRESS_COLUMNS[:5]).agg(
        F.count("*").alias("n_enderecos"), F.count_if("domicilio").alias("n_domicilios"))


def distance_summary(assigned: DataFrame, keys: list[str] | None = None,
                     distance: str = "distancia") -> DataFrame:
    """Mergeable distance figures per region."""
    d = F.col(distance)
    return assigned.groupBy(*(keys or ["id_regiao"])).agg(
        F.count("*").alias("n_enderecos"), F.sum(d).alias("soma_dist"), F.min(d).alias("dist_min"),
        F.max(d).alias("dist_max"), F.count_if(d > K.FAR_M).alias("acima_5km"),
        F.count_if(d > K.VERY_FAR_M).alias("acima_25km"))
