"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshtally.registry.scenario import Scenario, check_sql


@dataclass
class Query:
    run: Callable[[Scenario], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(Scenario(spark, sf_dir))


def query(run: Callable[[Scenario], DataFrame], body: str | None = None, /, **steps: str) -> Query:
    return Query(run, check_sql(body, **steps) if body else None)


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Whole numbers as bigint and floats rounded, so two engines can be compared."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind in ("double", "float"):
            c = F.round(c.cast("double"), digits)
        out.append(c.alias(name))
    return df.select(*out)


def poly_sql(lat: str, lon: str) -> tuple[str, str]:
    """Check-side text of the polyconic projection."""
    e2 = "6.694380022900787e-3"
    phi, dl = f"radians({lat})", f"radians(({lon}) + 54e0)"
    m = (f"6378137e0*({phi}*(1-{e2}/4-3*{e2}*{e2}/64-5*{e2}*{e2}*{e2}/256)"
         f"-sin(2*{phi})*(3*{e2}/8+3*{e2}*{e2}/32+45*{e2}*{e2}*{e2}/1024)"
         f"+sin(4*{phi})*(15*{e2}*{e2}/256+45*{e2}*{e2}*{e2}/1024)-sin(6*{phi})*(35*{e2}*{e2}*{e2}/3072))")
    n = f"(6378137e0/sqrt(1-{e2}*sin({phi})*sin({phi})))"
    arc = f"({dl}*sin({phi}))"
    x = f"5e6+{n}*cos({phi})/sin({phi})*sin({arc})"
    y = f"1e7+{m}+{n}*cos({phi})/sin({phi})*(1-cos({arc}))"
    return x, y


def haversine_sql(a: str, b: str, c: str, d: str) -> str:
    return (f"12742000.0*asin(sqrt(least(1.0, power(sin((radians({c})-radians({a}))/2),2)"
            f"+cos(radians({a}))*cos(radians({c}))*power(sin((radians({d})-radians({b}))/2),2))))")


def pct_sql(part: str, whole: str) -> str:
    return (f"CASE WHEN {whole} > 0 THEN CAST(({part}*20000+{whole}) // ({whole}*2) AS DOUBLE)/100.0"
            f" ELSE 0.0 END")


# Check-side steps used by several queries.
CLEAN_VOTE = """
    SELECT CONCAT(SG_UF,'_',LPAD(CD_MUNICIPIO,5,'0'),'_',NR_ZONA,'_',NR_LOCAL_VOTACAO) AS id_local_votacao,
           SG_UF AS sg_uf, CAST(ANO_ELEICAO AS INT) AS ano_eleicao, TRIM(NR_TURNO) AS turno,
           UPPER(DS_CARGO) AS cargo, SQ_CANDIDATO AS sq_candidato, NR_VOTAVEL AS nr_votavel,
           CASE WHEN NM_VOTAVEL='VOTO BRANCO' THEN 'VOTO EM BRANCO' ELSE NM_VOTAVEL END AS nm_votavel,
           CASE WHEN NR_VOTAVEL='95' THEN 'branco' WHEN NR_VOTAVEL='96' THEN 'nulo'
                WHEN NR_VOTAVEL='97' THEN 'anulado'
                WHEN SQ_CANDIDATO='-3' OR (SQ_CANDIDATO='-1' AND LENGTH(TRIM(NR_VOTAVEL))=2) THEN 'legenda'
                ELSE 'nominal' END AS tipo_voto,
           COALESCE(TRY_CAST(QT_VOTOS AS BIGINT),0) AS qt_votos
    FROM {vote_raw} WHERE TRIM(CD_TIPO_ELEICAO)='2'"""
REGION_DIM = """
    SELECT row_number() OVER (ORDER BY sg_uf, cd_municipio_ibge, latitude_final, longitude_final) AS id_regiao, *
    FROM (SELECT latitude_final, longitude_final, MIN(sg_uf) AS sg_uf, MIN(cd_municipio_ibge) AS cd_municipio_ibge,
                 MIN(nm_municipio) AS nm_municipio, COUNT(DISTINCT id_local_votacao) AS n_locais_votacao,
                 MIN(origem_coordenada) AS origem_coordenada,
                 MIN(nm_local_votacao_consolidado) AS nm_local_votacao,
                 (array_agg(ds_local_votacao_endereco_consolidado ORDER BY nm_local_votacao_consolidado,
                   id_local_votacao) FILTER (ds_local_votacao_endereco_consolidado IS NOT NULL))[1] AS ds_endereco
          FROM {located} GROUP BY latitude_final, longitude_final)"""
MAPPING = "SELECT id_local_votacao, id_regiao FROM {located} JOIN {region_dim} USING (latitude_final, longitude_final)"
REGION_VOTE = """
    SELECT id_regiao, sg_uf, ano_eleicao, turno, cargo, sq_candidato, nr_votavel, nm_votavel, sg_partido, tipo_voto,
           CAST(SUM(qt_votos) AS BIGINT) AS qt_votos
    FROM {vote} JOIN {mapping} USING (id_local_votacao) GROUP BY ALL"""
MESH = dict(region_dim=REGION_DIM, mapping=MAPPING)
SECTION = """
    SELECT CONCAT(SG_UF,'_',LPAD(CD_MUNICIPIO,5,'0'),'_',NR_ZONA,'_',NR_LOCAL_VOTACAO) AS id_local_votacao,
           SG_UF AS sg_uf, LPAD(CD_MUNICIPIO,5,'0') AS cd_municipio_tse, NM_MUNICIPIO AS nm_municipio,
           CAST(NR_ZONA AS INT) AS nr_zona, CAST(NR_LOCAL_VOTACAO AS INT) AS nr_local, CAST(NR_SECAO AS INT) AS nr_secao,
           CAST(AA_ELEICAO AS INT) AS ano_eleicao, NR_TURNO AS turno, NM_LOCAL_VOTACAO AS nm_local_votacao,
           DS_ENDERECO AS ds_endereco, CASE WHEN ok THEN la END AS latitude, CASE WHEN ok THEN lo END AS longitude, qt_eleitores
    FROM (SELECT *, ABS(la) >= 0.001 AND ABS(lo) >= 0.001 AND la BETWEEN -34.0 AND 5.3 AND lo BETWEEN -74.0 AND -34.7 AS ok,
                 COALESCE(TRY_CAST(QT_ELEITOR_ELEICAO_FEDERAL AS BIGINT),0) AS qt_eleitores
          FROM (SELECT *, TRY_CAST(REPLACE(NR_LATITUDE,',','.') AS DOUBLE) AS la,
                       TRY_CAST(REPLACE(NR_LONGITUDE,',','.') AS DOUBLE) AS lo FROM {section_raw}))"""
VOTER = """SELECT id_local_votacao, ano_eleicao, turno, CAST(SUM(qt_eleitores) AS BIGINT) AS qt_eleitores
           FROM {section} GROUP BY ALL"""
