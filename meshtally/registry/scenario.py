"""The territorial tables, derived from the given star-schema tables.

Suppliers become polling places, line items votes and sections, orders addresses,
parts candidacies. The derivation is one SQL text per relation in the common
subset of Spark SQL and ANSI SQL, so the check engine derives the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from meshtally.session import settle

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_UF = ("CASE n_regionkey WHEN 0 THEN 'RO' WHEN 1 THEN 'AM' WHEN 2 THEN 'BA' WHEN 3 THEN 'SP' "
       "ELSE 'RS' END")
_M = "(l_partkey % 20)"

FRAGMENTS = {
    # One polling place per supplier; a municipality has at most 48 distinct points.
    "place": f"""
        SELECT s_suppkey, {_UF} AS sg_uf, n_nationkey,
               LPAD(CAST(n_nationkey AS STRING), 5, '0') AS cd_municipio_tse,
               CONCAT('11', LPAD(CAST(n_nationkey AS STRING), 5, '0')) AS cd_municipio_ibge,
               n_name AS nm_municipio, s_suppkey % 7 + 1 AS nr_zona, s_suppkey AS nr_local,
               CONCAT({_UF}, '_', LPAD(CAST(n_nationkey AS STRING), 5, '0'), '_',
                      CAST(s_suppkey % 7 + 1 AS STRING), '_', CAST(s_suppkey AS STRING)) AS id_local_votacao,
               CONCAT('Escola São João ', CAST(s_suppkey % 50 AS STRING)) AS nome,
               CONCAT('Rua ', CAST(s_suppkey % 13 AS STRING), ', ', CAST(s_suppkey % 300 AS STRING)) AS endereco,
               CAST(-3000 + n_nationkey * 120 + (s_suppkey * 37) % 8 * 5 AS DOUBLE) / 100 AS lat,
               CAST(-7000 + n_nationkey * 120 + (s_suppkey * 53) % 6 * 5 AS DOUBLE) / 100 AS lon
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    # Places whose coordinate is known, in the schema the mesh is built from.
    "located": """
        SELECT id_local_votacao, sg_uf, cd_municipio_ibge, nm_municipio,
               nome AS nm_local_votacao_consolidado,
               CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE endereco END AS ds_local_votacao_endereco_consolidado,
               lat AS latitude_final, lon AS longitude_final,
               CASE WHEN s_suppkey % 4 = 0 THEN 'tse' ELSE 'cnefe' END AS origem_coordenada
        FROM {place}""",
    # The imported base lacks some places, and some of its coordinates.
    "base": """
        SELECT id_local_votacao, sg_uf, nm_municipio, cd_municipio_ibge,
               nome AS nm_local_votacao_consolidado,
               endereco AS ds_local_votacao_endereco_consolidado,
               CASE WHEN s_suppkey % 4 = 1 THEN 'sem' ELSE 'ok' END AS status_geocodificacao,
               CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE lat END AS latitude_final,
               CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE lon END AS longitude_final
        FROM {place} WHERE s_suppkey % 5 <> 2""",
    "official": """
        SELECT id_local_votacao, sg_uf, cd_municipio_tse, nm_municipio,
               CONCAT('ESCOLA SAO JOAO ', CAST(s_suppkey % 49 AS STRING)) AS nm_local_votacao,
               endereco AS ds_endereco, lat + CAST(s_suppkey % 3 AS DOUBLE) * 3 / 10000 AS latitude, lon AS longitude
        FROM {place} WHERE s_suppkey % 9 <> 1""",
    "section_raw": """
        SELECT CAST(2018 + l_orderkey % 3 * 4 AS STRING) AS AA_ELEICAO,
               CAST(l_linenumber % 2 + 1 AS STRING) AS NR_TURNO, sg_uf AS SG_UF,
               CAST(n_nationkey AS STRING) AS CD_MUNICIPIO, nm_municipio AS NM_MUNICIPIO,
               CAST(nr_zona AS STRING) AS NR_ZONA, CAST(l_orderkey % 400 + 1 AS STRING) AS NR_SECAO,
               CAST(nr_local AS STRING) AS NR_LOCAL_VOTACAO,
               CONCAT(nome, CASE WHEN l_orderkey % 3 = 2 THEN ' NOVA' ELSE '' END) AS NM_LOCAL_VOTACAO,
               CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE endereco END AS DS_ENDERECO,
               CASE WHEN l_orderkey % 7 = 0 THEN '-1' WHEN s_suppkey % 11 = 0 THEN '48,27'
                    WHEN l_orderkey % 2 = 0 THEN REPLACE(CAST(lat AS STRING), '.', ',')
                    ELSE CAST(lat AS STRING) END AS NR_LATITUDE,
               CASE WHEN l_orderkey % 7 = 0 THEN '-1' ELSE REPLACE(CAST(lon AS STRING), '.', ',') END AS NR_LONGITUDE,
               CASE WHEN l_orderkey % 97 = 0 THEN 'n/d' ELSE CAST(CAST(l_quantity AS BIGINT) * 2 AS STRING) END
                   AS QT_ELEITOR_ELEICAO_FEDERAL
        FROM {lineitem} JOIN {place} ON l_suppkey = s_suppkey""",
    "vote_raw": f"""
        SELECT CAST(2018 + l_orderkey % 3 * 4 AS STRING) AS ANO_ELEICAO,
               CONCAT(' ', CAST(l_linenumber % 2 + 1 AS STRING)) AS NR_TURNO, sg_uf AS SG_UF,
               CAST(n_nationkey AS STRING) AS CD_MUNICIPIO, CAST(nr_zona AS STRING) AS NR_ZONA,
               CAST(l_orderkey % 400 + 1 AS STRING) AS NR_SECAO,
               CASE WHEN l_linestatus = 'O' THEN 'Presidente' ELSE 'Deputado Federal' END AS DS_CARGO,
               CASE {_M} WHEN 0 THEN '95' WHEN 1 THEN '96' WHEN 2 THEN '97' WHEN 3 THEN '17' WHEN 4 THEN '18'
                    ELSE CAST({_M} + 1000 AS STRING) END AS NR_VOTAVEL,
               CASE {_M} WHEN 0 THEN CASE WHEN l_orderkey % 3 = 0 THEN 'VOTO BRANCO' ELSE 'VOTO EM BRANCO' END
                    WHEN 1 THEN 'VOTO NULO' WHEN 2 THEN 'VOTO ANULADO' WHEN 3 THEN 'P2' WHEN 4 THEN 'P3'
                    ELSE CONCAT('CANDIDATO D''' , CAST({_M} AS STRING)) END AS NM_VOTAVEL,
               CASE WHEN l_orderkey % 89 = 0 THEN 'x' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS QT_VOTOS,
               CAST(nr_local AS STRING) AS NR_LOCAL_VOTACAO,
               CASE {_M} WHEN 3 THEN '-3' WHEN 4 THEN '-1' WHEN 0 THEN '-1' WHEN 1 THEN '-1' WHEN 2 THEN '-1'
                    ELSE CONCAT('28', CAST({_M} AS STRING)) END AS SQ_CANDIDATO,
               CASE WHEN l_orderkey % 50 = 0 THEN '1' ELSE '2' END AS CD_TIPO_ELEICAO
        FROM {{lineitem}} JOIN {{place}} ON l_suppkey = s_suppkey""",
    # Votes by place in the final vote schema, with all states.
    "vote": f"""
        SELECT id_local_votacao, sg_uf, CAST(2018 + l_orderkey % 3 * 4 AS INT) AS ano_eleicao,
               CAST(l_linenumber % 2 + 1 AS STRING) AS turno,
               CASE WHEN l_linestatus = 'O' THEN 'PRESIDENTE' ELSE 'DEPUTADO FEDERAL' END AS cargo,
               CAST({_M} AS STRING) AS sq_candidato, CAST({_M} + 1000 AS STRING) AS nr_votavel,
               CASE {_M} WHEN 0 THEN 'VOTO EM BRANCO' WHEN 1 THEN 'VOTO NULO' WHEN 2 THEN 'P2'
                    ELSE CONCAT('CANDIDATO D''', CAST({_M} AS STRING)) END AS nm_votavel,
               CASE WHEN {_M} > 1 THEN CONCAT('P', CAST({_M} % 5 AS STRING)) END AS sg_partido,
               CASE {_M} WHEN 0 THEN 'branco' WHEN 1 THEN 'nulo'
                    WHEN 2 THEN CASE WHEN l_linestatus = 'O' THEN 'nominal' ELSE 'legenda' END
                    ELSE 'nominal' END AS tipo_voto,
               CAST(l_quantity AS BIGINT) AS qt_votos
        FROM {{lineitem}} JOIN {{place}} ON l_suppkey = s_suppkey""",
    "register": """
        SELECT DISTINCT CAST(NULL AS STRING) AS SG_UF, 'PRESIDENTE' AS DS_CARGO,
               CONCAT('28', CAST(p_partkey % 20 AS STRING)) AS SQ_CANDIDATO,
               CAST(p_partkey % 20 + 1000 AS STRING) AS NR_CANDIDATO, 'BR' AS SG_UE,
               CONCAT('CANDIDATO D''', CAST(p_partkey % 20 AS STRING)) AS NM_URNA_CANDIDATO,
               CAST(15 + p_partkey % 20 % 5 AS STRING) AS NR_PARTIDO,
               CONCAT('P', CAST(p_partkey % 20 % 5 AS STRING)) AS SG_PARTIDO,
               'APTO' AS DS_SITUACAO_CANDIDATURA, '#NULO' AS DS_SIT_TOT_TURNO
        FROM {part}""",
    # Several candidacies share a number; only one went to the ballot.
    "candidacy": """
        SELECT 'XX' AS SG_UF, CASE WHEN p_size % 2 = 0 THEN 'Prefeito' ELSE 'Presidente' END AS DS_CARGO,
               CAST(p_partkey AS STRING) AS SQ_CANDIDATO, CAST(p_partkey % 40 + 10 AS STRING) AS NR_CANDIDATO,
               CASE WHEN p_size % 2 = 0 THEN LPAD(CAST(p_partkey % 25 AS STRING), 5, '0') ELSE 'BR' END AS SG_UE,
               UPPER(p_name) AS NM_URNA_CANDIDATO, CAST(p_partkey % 40 % 5 + 10 AS STRING) AS NR_PARTIDO,
               CONCAT('P', CAST(p_partkey % 40 % 5 AS STRING)) AS SG_PARTIDO,
               CASE WHEN p_size % 3 = 0 THEN 'INAPTO' ELSE 'Apto' END AS DS_SITUACAO_CANDIDATURA,
               CASE WHEN p_size % 4 = 0 THEN 'Não eleito' WHEN p_size % 4 = 1 THEN '#NULO' END AS DS_SIT_TOT_TURNO
        FROM {part}""",
    "address_raw": """
        SELECT CAST(o_orderkey AS STRING) AS COD_UNICO_ENDERECO,
               CONCAT('11', LPAD(CAST(n_nationkey AS STRING), 5, '0')) AS COD_MUNICIPIO,
               'Rua' AS NOM_TIPO_SEGLOGR, CASE WHEN o_custkey % 3 = 0 THEN ' Doutor ' END AS NOM_TITULO_SEGLOGR,
               CONCAT('São  Zé ', CAST(o_custkey % 30 AS STRING)) AS NOM_SEGLOGR,
               CASE WHEN o_orderkey % 11 = 0 THEN 'SN' WHEN o_orderkey % 13 = 0 THEN '0'
                    ELSE CAST(o_orderkey * 7 % 300 + 1 AS STRING) END AS NUM_ENDERECO,
               CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE CAST(CAST(-300000 + n_nationkey * 12000
                    + o_orderkey * 7919 % 4000 AS DOUBLE) / 10000 AS STRING) END AS LATITUDE,
               CAST(CAST(-700000 + n_nationkey * 12000 + o_orderkey * 104729 % 3000 AS DOUBLE) / 10000 AS STRING)
                    AS LONGITUDE,
               CAST(o_orderkey % 4 + 1 AS STRING) AS COD_ESPECIE,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CONCAT(' Bairro ', CAST(o_orderkey % 4 AS STRING)) END
                    AS DSC_LOCALIDADE
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    # Address counts per street, number and (arbitrary) region: input of the index.
    "counts": """
        SELECT CONCAT('11', LPAD(CAST(c_nationkey AS STRING), 5, '0')) AS cd_municipio_ibge,
               CONCAT('RUA SÃO ', CAST(o_custkey % 12 AS STRING)) AS logradouro,
               CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CONCAT('BAIRRO ', CAST(o_orderkey % 4 AS STRING)) END AS bairro,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 0
                    ELSE o_orderkey * 7 % 300 + 1 END AS numero,
               CAST(c_nationkey * 100 + CAST(FLOOR((o_orderkey * 7 % 300) / 60) AS BIGINT)
                    + CASE WHEN o_orderkey % 17 = 0 THEN 3 ELSE 0 END AS BIGINT) AS id_regiao,
               COUNT(*) AS n_enderecos,
               CAST(SUM(CASE WHEN o_custkey % 12 = 5 THEN 0 WHEN o_orderkey % 4 < 2 THEN 1 ELSE 0 END) AS BIGINT)
                    AS n_domicilios
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        GROUP BY 1, 2, 3, 4, 5""",
    "request": """
        SELECT o_orderkey AS id, CONCAT('11', LPAD(CAST(c_nationkey AS STRING), 5, '0')) AS cd_municipio,
               CASE WHEN o_orderkey % 3 = 0 THEN CONCAT('rua sao ', CAST(o_custkey % 13 AS STRING))
                    ELSE CONCAT('RUA SÃO ', CAST(o_custkey % 12 AS STRING)) END AS rua,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey * 31 % 320 END AS numero,
               CASE WHEN o_orderkey % 4 = 1 THEN CONCAT('bairro ', CAST(o_orderkey % 6 AS STRING)) END AS bairro
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # One report per order: its line items are votes; the last sent of a section counts.
    "transmission": """
        SELECT user_id AS secao, event_id AS ordem,
               CASE event_type WHEN 'purchase' THEN CASE WHEN user_id % 4 = 0 THEN 'Recebido' ELSE 'Totalizado' END WHEN 'error' THEN 'Rejeitado' ELSE 'Recebido' END
                    AS situacao, value AS valor
        FROM {events}""",
    "ballot": """
        SELECT CAST(o_orderkey AS STRING) AS arquivo, c_nationkey AS municipio, o_custkey % 90 + 1 AS zona,
               o_custkey AS local, o_orderkey % 9000 + 1 AS secao,
               CASE WHEN o_orderkey % 40 = 0 THEN 1 ELSE 2 END AS fase,
               CASE WHEN o_orderkey % 60 = 1 THEN 1 ELSE 0 END AS quebra,
               CASE WHEN o_orderkey % 70 = 2 THEN 1 ELSE 0 END AS desvio,
               l_linenumber AS linha, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 11 END AS cargo,
               CASE l_partkey % 10 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE 1 END AS tipo,
               CASE l_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE l_partkey % 40 % 5 + 10 END AS partido,
               CASE l_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN l_partkey % 40 % 5 + 10
                    ELSE l_partkey % 40 + 10 END AS numero,
               CAST(l_quantity AS BIGINT) AS quantidade
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
}


def needs(sql: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", sql)


class Scenario:
    """Lazy frames of the given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self._known = spark, sf_dir.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            if name in TABLES:
                self._known[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            else:
                sql = FRAGMENTS[name]
                frame = self.spark.sql(sql, **{n: getattr(self, n) for n in needs(sql)})
                # Stored, so that the planner knows the size of the dimension it joins.
                self._known[name] = settle(frame) if name == "place" else frame
        return self._known[name]

    def sql(self, text: str) -> DataFrame:
        """Ad-hoc derivation with {name} for any given or derived table."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in needs(text)})


def check_sql(body: str, **steps: str) -> str:
    """Body with {name} references to one statement with its derivations as CTEs.

    `steps` adds named relations of the check itself, in order.
    """
    known = {**FRAGMENTS, **steps}
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for n in needs(known[name]):
            add(n)
        ordered.append(name)

    for n in needs(body):
        add(n)

    def plain(sql: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", sql)

    ctes = ",\n".join(f"{n} AS MATERIALIZED ({plain(known[n])})" for n in ordered)
    return (f"WITH {ctes}\n" if ctes else "") + plain(body)
