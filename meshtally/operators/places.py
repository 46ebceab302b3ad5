"""Places and voters from the section register (one row per section)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.functions import geo, numbers, text
from meshtally.operators import guards


def in_scope(df: DataFrame, states: list[str] | None = None, column: str = "SG_UF") -> DataFrame:
    """Drop votes abroad; keep only the wanted states when given."""
    out = df.where(F.trim(column) != K.ABROAD)
    return out.where(F.trim(column).isin(states)) if states else out


def clean_sections(raw: DataFrame) -> DataFrame:
    """Typed section rows with the place key and a coordinate that is real or null."""
    lat, lon = geo.clean_point(numbers.decimal_text(F.col("NR_LATITUDE")),
                               numbers.decimal_text(F.col("NR_LONGITUDE")))
    return raw.select(
        text.place_key(F.col("SG_UF"), F.col("CD_MUNICIPIO"), F.col("NR_ZONA"),
                       F.col("NR_LOCAL_VOTACAO")).alias("id_local_votacao"),
        F.trim("SG_UF").alias("sg_uf"), text.pad_code(F.col("CD_MUNICIPIO")).alias("cd_municipio_tse"),
        F.col("NM_MUNICIPIO").alias("nm_municipio"),
        F.trim("NR_ZONA").cast("int").alias("nr_zona"),
        F.trim("NR_LOCAL_VOTACAO").cast("int").alias("nr_local"),
        F.trim("NR_SECAO").cast("int").alias("nr_secao"),
        F.trim("AA_ELEICAO").cast("int").alias("ano_eleicao"),
        text.round_text(F.trim("NR_TURNO").cast("int")).alias("turno"),
        F.col("NM_LOCAL_VOTACAO").alias("nm_local_votacao"), F.col("DS_ENDERECO").alias("ds_endereco"),
        lat.alias("latitude"), lon.alias("longitude"),
        numbers.count_or_zero(F.col("QT_ELEITOR_ELEICAO_FEDERAL")).alias("qt_eleitores"))


def voters_per_place(sections: DataFrame) -> DataFrame:
    return sections.groupBy("id_local_votacao", "ano_eleicao", "turno").agg(
        F.sum("qt_eleitores").alias("qt_eleitores"))


def latest_places(sections: DataFrame) -> DataFrame:
    """One row per place with a coordinate: the latest point, and per other column the latest value known."""
    known = sections.where(F.col("latitude").isNotNull())
    when = F.struct("ano_eleicao", "turno")
    columns = ["sg_uf", "cd_municipio_tse", "nm_municipio", "nr_zona", "nr_local",
               "nm_local_votacao", "ds_endereco"]
    # A null has no order, so max_by skips it column by column. Equal moments are
    # settled by the value, which keeps the answer independent of row order.
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(when, F.col(c)))).alias(c)
              for c in columns]
    # Both coordinates come from one section. Sections of one moment settle by the point.
    point = F.struct("latitude", "longitude")
    return (known.groupBy("id_local_votacao")
            .agg(*latest, F.max_by(point, F.struct(when, point)).alias("_point"), F.max("ano_eleicao").alias("ano_referencia"))
            .select("id_local_votacao", *columns, "_point.latitude", "_point.longitude", "ano_referencia"))


def place_counters(sections: DataFrame) -> DataFrame:
    return sections.agg(
        F.count("*").alias("secoes"), F.count_distinct("id_local_votacao").alias("locais"),
        F.count_distinct(F.when(F.col("latitude").isNull(), F.col("id_local_votacao")))
        .alias("locais_sem_coordenada"))


def one_round(sections: DataFrame, round_: str) -> DataFrame:
    """Sections of one round; none at all is an error."""
    out = sections.where(F.col("turno") == round_)
    if out.isEmpty():
        raise guards.CheckFailed(f"no section of round {round_}")
    return out
