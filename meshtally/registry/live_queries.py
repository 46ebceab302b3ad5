"""Sources, ballots, reconciliation and streams on the given and derived tables."""

from __future__ import annotations

import os
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Window
from pyspark.sql import functions as F

from meshtally import constants as K
from meshtally.operators import votes as V
from meshtally.plans import convert as C
from meshtally.plans import live as L
from meshtally.plans import reconcile as REC
from meshtally.plans import validate as VAL
from meshtally.plans import publish as PUB
from meshtally.registry.common import MESH, SECTION, pct_sql, query, tidy
from meshtally.registry.index_queries import IDX, stored_index
from meshtally.registry.mesh_queries import mesh, sections
from meshtally.schemas import OFFICIAL_RESULT
from meshtally.session import run_dir, settle
from meshtally.sources import archive_source as ZIP
from meshtally.sources import ballots as B
from meshtally.sources import documents as D
from meshtally.sources import official as O
from meshtally.sources import published as PUBLISHED
from meshtally.sources import tables as T
from meshtally.streaming import ballots as ST


def scratch(s, name: str) -> str:
    """A fresh folder of this run."""
    return os.path.join(run_dir(s.spark), f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- ballots

def unread(s):
    """One row for each report or record of which nothing can be read (`quebra`)."""
    return s.ballot.where("quebra = 1").select("arquivo", F.lit("cut short").alias("erro")).distinct()


def decoded(s):
    """Lines of the `ballot` relation as reports; `desvio` declares one voter too many for each office."""
    office = Window.partitionBy("arquivo", "cargo")  # the lines of one report
    lines = s.ballot.where("quebra = 0").select(
        "arquivo", F.lpad(F.col("municipio").cast("string"), 5, "0").alias("municipio"), "zona", "local", "secao",
        F.lit(1).alias("pleito"), F.col("fase").cast("string").alias("fase"), F.lit(619).alias("eleicao"), F.lit(0).alias("grupo"),
        F.lit(0).alias("ordem"), "cargo", (F.sum("quantidade").over(office) + F.col("desvio")).alias("comparecimento"),
        F.col("tipo").cast("string").alias("tipo"), "quantidade", "partido", "numero", F.lit(None).cast("string").alias("erro"))
    return settle(B.report_lines(lines.unionByName(unread(s), allowMissingColumns=True)))


def recorded(s):
    """The same lines as vote records, which number the vote types differently."""
    lines = s.ballot.where("quebra = 0").select(
        "arquivo", F.lit(619).alias("eleicao"), "cargo", F.col("linha").alias("ordem"),
        F.expr("CAST(ELT(tipo, 2, 3, 4, 1) AS STRING)").alias("tipo"), F.col("numero").cast("string").alias("digitacao"),
        F.lit(None).cast("string").alias("erro"))
    return B.record_lines(lines.unionByName(unread(s), allowMissingColumns=True))


_GOOD = "fase = 2 AND quebra = 0 AND desvio = 0"
_TYPE = "CASE tipo WHEN 1 THEN 'nominal' WHEN 2 THEN 'branco' WHEN 3 THEN 'nulo' ELSE 'legenda' END"
BALLOT_COUNT = f"""
    SELECT LPAD(CAST(municipio AS STRING), 5, '0') AS municipio, CAST(zona AS BIGINT) AS zona, CAST(local AS BIGINT) AS local, CAST(cargo AS BIGINT) AS cargo,
           {_TYPE} AS tipo, partido, numero, CAST(SUM(quantidade) AS BIGINT) AS qt_votos
    FROM {{ballot}} WHERE {_GOOD} GROUP BY 1,2,3,4,5,6,7"""


def counts(s):
    rows = decoded(s)
    return C.ballot_counts(C.counted_rows(rows, settle(C.rejections(rows)), [1, 11]))


PREFERRED = """
    SELECT *, UPPER(TRIM(DS_CARGO)) AS cargo FROM {candidacy} QUALIFY row_number() OVER (PARTITION BY UPPER(TRIM(DS_CARGO)), SG_UE, NR_CANDIDATO
      ORDER BY COALESCE(DS_SIT_TOT_TURNO, '') NOT IN ('#NULO', '#NE', '') DESC, UPPER(DS_SITUACAO_CANDIDATURA) = 'APTO' DESC, SQ_CANDIDATO DESC) = 1"""


def _rejected(s):
    r = C.rejections(decoded(s))
    return r.select("arquivo", "classe")


# ---------------------------------------------------------------- official documents

def official_documents(s):
    """One nested result document per state, written from the votes of its candidates."""
    pres = s.vote.where("cargo = 'PRESIDENTE' and turno = '1'")
    cand = pres.where("tipo_voto = 'nominal'").groupBy("sg_uf", "sg_partido", "nr_votavel", "nm_votavel").agg(F.sum("qt_votos").alias("q"))
    party = cand.groupBy("sg_uf", "sg_partido").agg(F.collect_list(F.struct(
        F.col("nr_votavel").alias("n"), F.col("nm_votavel").alias("nmu"), F.col("q").cast("string").alias("vap"))).alias("cand"))
    lists = party.groupBy("sg_uf").agg(F.collect_list(F.struct(
        F.substring("sg_partido", 2, 2).alias("n"), F.col("sg_partido").alias("sg"),
        F.when(F.col("sg_partido") == "P1", "7").otherwise("0").alias("tvtl"), "cand")).alias("par"))
    t = V.totals_by_type(pres, ["sg_uf"])
    text = {c: F.col(c).cast("string") for c in t.columns}
    v = F.struct(*[x.alias(n) for n, x in [
        ("tv", text["comparecimento"]), ("vvc", (F.col("validos") - 3).cast("string")), ("vv", F.lit(None).cast("string")), ("vnom", text["validos"]),
        ("vl", F.lit("0")), ("van", F.lit("0")), ("vansj", F.lit("0")), ("vb", text["brancos"]), ("tvn", text["nulos"]), ("vn", text["nulos"]),
        ("vnt", F.when(F.col("sg_uf") == "SP", "2").otherwise("0"))]])
    return t.join(lists, "sg_uf").select(
        "sg_uf", v.alias("v"), F.struct(text["comparecimento"].alias("c")).alias("e"),
        F.struct(F.lit("100").alias("ts"), F.lit("99").alias("st"), F.lit("99,5").alias("pst")).alias("s"),
        F.array(F.struct(F.array(F.struct("par")).alias("agr"))).alias("carg"))


def strict_documents(s):
    """The documents through text and the strict reader's schema, as they arrive."""
    rows = D.json_rows(official_documents(s), ["sg_uf"])
    return rows.select("sg_uf", F.from_json("value", OFFICIAL_RESULT, {"mode": "FAILFAST"}).alias("d")).select("sg_uf", "d.*")


STATE_TYPE = """
    SELECT sg_uf, CAST(SUM(qt_votos) AS BIGINT) AS comparecimento, CAST(SUM(qt_votos) FILTER (tipo_voto IN ('nominal', 'legenda')) AS BIGINT) AS validos,
           CAST(SUM(qt_votos) FILTER (tipo_voto = 'branco') AS BIGINT) AS brancos, CAST(SUM(qt_votos) FILTER (tipo_voto = 'nulo') AS BIGINT) AS nulos
    FROM {vote} WHERE cargo = 'PRESIDENTE' AND turno = '1' GROUP BY 1"""
NAMED = """
    SELECT sg_uf, 'nominal' AS tipo_voto, nr_votavel, nm_votavel AS nome, sg_partido AS partido, CAST(SUM(qt_votos) AS BIGINT) AS votos FROM {vote}
    WHERE cargo = 'PRESIDENTE' AND turno = '1' AND tipo_voto = 'nominal' GROUP BY 1,2,3,4,5"""


def reconciled(s):
    """Votes against documents: one state lost a ballot box, another gained votes."""
    mine = s.sql("""SELECT v.* FROM {vote} v WHERE cargo = 'PRESIDENTE' AND turno = '1'
                    AND NOT (sg_uf = 'BA' AND id_local_votacao LIKE '%5' AND ano_eleicao = 2018)
                    UNION ALL SELECT v.* FROM {vote} v WHERE cargo = 'PRESIDENTE' AND turno = '1' AND sg_uf = 'AM' AND nr_votavel = '1005'""")
    docs = settle(official_documents(s))
    return REC.reconcile(mine, O.result_totals(docs, ["sg_uf"]), O.result_votables(docs, ["sg_uf"]), ["sg_uf"])


MINE = """
    SELECT * FROM {vote} WHERE cargo = 'PRESIDENTE' AND turno = '1' AND NOT (sg_uf = 'BA' AND id_local_votacao LIKE '%5' AND ano_eleicao = 2018)
    UNION ALL SELECT * FROM {vote} WHERE cargo = 'PRESIDENTE' AND turno = '1' AND sg_uf = 'AM' AND nr_votavel = '1005'"""
OFFICIAL_TOTAL = """SELECT sg_uf, comparecimento, validos + CASE WHEN sg_uf = 'SP' THEN 2 ELSE 0 END AS validos, brancos,
                    nulos - CASE WHEN sg_uf = 'SP' THEN 2 ELSE 0 END AS nulos FROM {state_type}"""
MY_TOTAL = STATE_TYPE.replace("FROM {vote} WHERE cargo = 'PRESIDENTE' AND turno = '1'", "FROM {mine}")
_UNPIVOT = "SELECT sg_uf, t AS total, v AS valor, tv FROM (SELECT *, comparecimento AS tv FROM {%s}) UNPIVOT (v FOR t IN (comparecimento, validos, brancos, nulos))"
OFFICIAL = dict(state_type=STATE_TYPE, official_total=OFFICIAL_TOTAL, named=NAMED, mine=MINE, my_total=MY_TOTAL,
                a=_UNPIVOT % "my_total", b=_UNPIVOT % "official_total", compared="""
    SELECT a.sg_uf, a.total, b.valor AS oficial, a.valor AS nosso, a.valor - b.valor AS diferenca, b.tv - a.tv AS falta,
                  CASE WHEN a.valor = b.valor THEN ' ' WHEN b.tv > a.tv AND a.valor - b.valor BETWEEN a.tv - b.tv AND 0 THEN '~' ELSE 'x' END AS marca
           FROM {a} a JOIN {b} b ON a.sg_uf = b.sg_uf AND a.total = b.total""", compared_names="""
    SELECT sg_uf, tipo_voto, nr_votavel, COALESCE(o, 0) AS oficial, COALESCE(n, 0) AS nosso, COALESCE(n, 0) - COALESCE(o, 0) AS diferenca,
                  CASE WHEN ABS(COALESCE(n, 0) - COALESCE(o, 0)) <= GREATEST(10.0, COALESCE(o, 0) * 0.0001) THEN ' ' ELSE 'x' END AS marca
           FROM (SELECT sg_uf, tipo_voto, nr_votavel, votos AS o FROM {named} UNION ALL SELECT DISTINCT sg_uf, 'legenda', '1', 7 FROM {named} WHERE partido = 'P1') x
           FULL JOIN (SELECT sg_uf, tipo_voto, nr_votavel, CAST(SUM(qt_votos) AS BIGINT) AS n FROM {mine} WHERE tipo_voto = 'nominal' GROUP BY 1,2,3) y USING (sg_uf, tipo_voto, nr_votavel)""")


# ---------------------------------------------------------------- three levels

def level_votes(s):
    return s.vote.withColumn("cd_municipio", F.split("id_local_votacao", "_")[1])


def level_documents(s):
    """One nested result document per contest and territory of each level; one municipality isn't published."""
    kinds = {t: F.when(c, F.col("qt_votos")).otherwise(0) for t, c in [
        ("tv", F.lit(True)), ("vnom", F.col("tipo_voto") == "nominal"), ("vl", F.col("tipo_voto") == "legenda"),
        ("vb", F.col("tipo_voto") == "branco"), ("tvn", F.col("tipo_voto") == "nulo")]}
    votes = level_votes(s)
    sums = REC.by_level(votes.select(*REC.CONTEST, *REC.TERRITORY, *[c.alias(t) for t, c in kinds.items()]), [], list(kinds))
    cand = REC.by_level(votes.where("tipo_voto IN ('nominal', 'legenda')"), ["tipo_voto", "sg_partido", "nr_votavel", "nm_votavel"], ["qt_votos"])
    # As many as candidates stand.
    party = cand.groupBy(*REC.LEVELS, "sg_partido").agg(
        F.max(F.when(F.col("tipo_voto") == "legenda", F.col("nr_votavel"))).alias("lista"),
        F.sum(F.when(F.col("tipo_voto") == "legenda", F.col("qt_votos"))).cast("string").alias("tvtl"),
        F.collect_list(F.when(F.col("tipo_voto") == "nominal", F.struct(
            F.col("nr_votavel").alias("n"), F.col("nm_votavel").alias("nmu"), F.col("qt_votos").cast("string").alias("vap")))).alias("cand"))
    lists = party.groupBy(*REC.LEVELS).agg(F.collect_list(F.struct(
        F.coalesce("lista", F.substring("sg_partido", 2, 2)).alias("n"), F.col("sg_partido").alias("sg"), "tvtl", "cand")).alias("par"))
    text = {c: F.col(c).cast("string") for c in kinds}
    v = F.struct(text["tv"].alias("tv"), (F.col("vnom") + F.col("vl")).cast("string").alias("vvc"), F.lit(None).cast("string").alias("vv"),
                 text["vnom"].alias("vnom"), text["vl"].alias("vl"), F.lit("0").alias("van"), F.lit("0").alias("vansj"), text["vb"].alias("vb"),
                 text["tvn"].alias("tvn"), text["tvn"].alias("vn"), F.lit("0").alias("vnt"))
    return sums.join(lists, REC.LEVELS).where("NOT (cd_municipio = '00003' AND ano_eleicao = 2026)").select(
        *REC.LEVELS, v.alias("v"), F.struct(text["tv"].alias("c")).alias("e"),
        F.struct(F.lit("100").alias("ts"), F.lit("100").alias("st"), F.lit("100,0").alias("pst")).alias("s"),
        F.array(F.struct(F.array(F.struct("par")).alias("agr"))).alias("carg"))


_LEVEL_MINE = """
    SELECT *, split_part(id_local_votacao, '_', 2) AS cd_municipio FROM {vote}
    WHERE NOT (sg_uf = 'BA' AND id_local_votacao LIKE '%5' AND ano_eleicao = 2018) AND NOT (id_local_votacao LIKE '%_00012_%' AND ano_eleicao = 2022 AND turno = '2')
    UNION ALL SELECT *, split_part(id_local_votacao, '_', 2) AS cd_municipio FROM {vote} WHERE sg_uf = 'AM' AND nr_votavel = '1005' AND cargo = 'PRESIDENTE'"""


def reconciled_levels(s):
    """A state lost ballot boxes, another gained votes, a municipality is missing on our side and one on the official side."""
    docs = settle(level_documents(s))
    return REC.reconcile_levels(s.sql(_LEVEL_MINE), O.result_totals(docs, REC.LEVELS), O.result_votables(docs, REC.LEVELS))


_C = "ano_eleicao, turno, cargo"
_L = "nivel, ano_eleicao, turno, cargo, sg_uf, cd_municipio"


def _level_sql(src: str, keys: str, values: str) -> str:
    k = f"{_C}{keys}"
    return f"""SELECT 2 - GROUPING(sg_uf) - GROUPING(cd_municipio) AS nivel, {k}, COALESCE(sg_uf, '') AS sg_uf, COALESCE(cd_municipio, '') AS cd_municipio, {values}
               FROM {{{src}}} GROUP BY GROUPING SETS (({k}), ({k}, sg_uf), ({k}, sg_uf, cd_municipio))"""


_FOUR = "CAST(SUM(qt_votos) AS BIGINT) AS comparecimento, " + ", ".join(
    f"CAST(COALESCE(SUM(qt_votos) FILTER (tipo_voto IN ({k})), 0) AS BIGINT) AS {t}" for t, k in (("validos", "'nominal', 'legenda'"), ("brancos", "'branco'"), ("nulos", "'nulo'")))
_FLAT = f"SELECT {_L}, t AS total, v AS valor, tv FROM (SELECT *, comparecimento AS tv FROM {{%s}}) UNPIVOT (v FOR t IN (comparecimento, validos, brancos, nulos))"
_UNPUBLISHED = "WHERE NOT (cd_municipio = '00003' AND ano_eleicao = 2026)"
_AT = """CASE nivel WHEN 0 THEN 'BR' WHEN 1 THEN sg_uf ELSE sg_uf || '/' || cd_municipio END || ' ' || ano_eleicao || '/' || turno || '/' || cargo"""
LEVEL = dict(
    l_all="SELECT *, split_part(id_local_votacao, '_', 2) AS cd_municipio FROM {vote}", l_mine=_LEVEL_MINE,
    l_off=f"SELECT * FROM ({_level_sql('l_all', '', _FOUR)}) {_UNPUBLISHED}", l_our=_level_sql("l_mine", "", _FOUR), l_a=_FLAT % "l_our", l_b=_FLAT % "l_off",
    l_cmp=f"""SELECT {_L}, total, b.valor AS oficial, COALESCE(a.valor, 0) AS nosso, COALESCE(a.valor, 0) - b.valor AS diferenca, b.tv - COALESCE(a.tv, 0) AS falta,
                     CASE WHEN b.valor IS NULL THEN '?' WHEN a.valor IS NULL THEN 'x' WHEN a.valor = b.valor THEN ' '
                          WHEN b.tv > a.tv AND a.valor - b.valor BETWEEN a.tv - b.tv AND 0 THEN '~' ELSE 'x' END AS marca
              FROM {{l_a}} a FULL JOIN {{l_b}} b USING ({_L}, total)""",
    l_low=f"""SELECT nivel - 1 AS nivel, {_C}, CASE WHEN nivel = 2 THEN sg_uf ELSE '' END AS sg_uf, '' AS cd_municipio, SUM(falta) AS falta_abaixo
              FROM {{l_cmp}} WHERE total = 'comparecimento' AND nivel > 0 AND oficial IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    l_tot=f"""SELECT c.*, CAST(falta_abaixo AS BIGINT) AS falta_abaixo, COALESCE(falta > 0 AND falta = falta_abaixo, false) AS explicada
              FROM {{l_cmp}} c LEFT JOIN {{l_low}} USING ({_L})""",
    l_name=f"""SELECT {_L}, tipo_voto, nr_votavel, COALESCE(o, 0) AS oficial, COALESCE(n, 0) AS nosso, COALESCE(n, 0) - COALESCE(o, 0) AS diferenca,
                      CASE WHEN ABS(COALESCE(n, 0) - COALESCE(o, 0)) <= GREATEST(10.0, COALESCE(o, 0) * 0.0001) THEN ' ' ELSE 'x' END AS marca
               FROM (SELECT * FROM ({_level_sql('l_all', ', tipo_voto, nr_votavel', "CAST(SUM(qt_votos) FILTER (tipo_voto IN ('nominal', 'legenda')) AS BIGINT) AS o")}) {_UNPUBLISHED} AND o IS NOT NULL) x
               FULL JOIN (SELECT * FROM ({_level_sql('l_mine', ', tipo_voto, nr_votavel', "CAST(SUM(qt_votos) FILTER (tipo_voto IN ('nominal', 'legenda')) AS BIGINT) AS n")}) WHERE n IS NOT NULL) y
               USING ({_L}, tipo_voto, nr_votavel)""",
    l_sum=f"""SELECT nivel - 1 AS nivel, {_C}, CASE WHEN nivel = 2 THEN sg_uf ELSE '' END AS sg_uf, '' AS cd_municipio, total, SUM(valor) AS s
              FROM {{l_b}} WHERE nivel > 0 GROUP BY 1, 2, 3, 4, 5, 7""")
_LEVEL_PROBLEMS = f"""
    SELECT 'levels agree' AS "check", 'official' AS context, {_AT} || ': ' || total || ' ' || CAST(valor AS BIGINT) || ' x ' || CAST(s AS BIGINT) AS detail
    FROM {{l_b}} JOIN {{l_sum}} USING ({_L}, total) WHERE valor <> s
    UNION ALL SELECT 'reconcile', 'official', {_AT} || d FROM (
      SELECT {_L}, ': nothing to compare with' AS d FROM {{l_tot}} WHERE total = 'comparecimento' AND oficial IS NULL
      UNION ALL SELECT {_L}, ': ' || total || ' differs by ' || CAST(diferenca AS BIGINT) FROM {{l_tot}} WHERE marca = 'x' AND NOT explicada
      UNION ALL SELECT {_L}, ': short of ' || CAST(falta AS BIGINT) || ' votes' FROM {{l_tot}}
                WHERE total = 'comparecimento' AND falta > 0 AND NOT explicada AND falta / GREATEST(oficial, 1) > {K.MISSING_LIMIT}
      UNION ALL SELECT {_L}, ': more votes than the official count' FROM {{l_tot}} WHERE total = 'comparecimento' AND falta < 0
      UNION ALL SELECT {_L}, ', number ' || nr_votavel || ' differs by ' || CAST(diferenca AS BIGINT) FROM {{l_name}} WHERE marca = 'x')"""


# ---------------------------------------------------------------- sections

def config_documents(s):
    """Section config nested as published: state, municipality, zone, section."""
    sec = sections(s).select("sg_uf", "cd_municipio_tse", "nm_municipio", "nr_zona", "nr_secao").distinct()
    item = F.struct(F.col("nr_secao").cast("string").alias("ns"), F.when(F.col("nr_secao") % 10 == 0, "1").alias("nsp"),
                    F.when(F.col("nr_secao") % 3 > 0, "04/10/2026").alias("da"), F.lit("17:01").alias("ha"))
    zone = sec.groupBy("sg_uf", "cd_municipio_tse", "nm_municipio", "nr_zona").agg(F.collect_list(item).alias("sec"))
    town = zone.groupBy("sg_uf", "cd_municipio_tse", "nm_municipio").agg(
        F.collect_list(F.struct(F.lpad(F.col("nr_zona").cast("string"), 4, "0").alias("cd"), "sec")).alias("zon"))
    return town.groupBy("sg_uf").agg(F.collect_list(F.struct(
        F.col("cd_municipio_tse").alias("cd"), F.col("nm_municipio").alias("nm"), "zon")).alias("mu")).select(
        F.array(F.struct(F.col("sg_uf").alias("cd"), "mu")).alias("abr"))


def principal(s):
    """Stored, so that the planner knows how few they are and leaves the register where it lies."""
    return settle(O.sections(config_documents(s)).select(
        F.col("municipio").alias("cd_municipio_tse"), F.col("zona").cast("int").alias("nr_zona"), F.col("secao").cast("int").alias("nr_secao")))


ELECTION = ["ano_eleicao", "turno"]


def mapped(s):
    regions, mapping = mesh(s)
    return L.section_map(sections(s), mapping, regions, principal(s), ELECTION)


def placed(s):
    regions, mapping = mesh(s)
    return L.register_votes(section_rows(s), sections(s), mapping, regions, principal(s), ELECTION)


SECTION_MAP = dict(
    **MESH, section=SECTION,
    section_map="""SELECT DISTINCT r.cd_municipio_ibge, LOWER(s.sg_uf) AS uf, s.cd_municipio_tse, m.id_regiao, CAST(nr_zona AS BIGINT) AS nr_zona,
                          CAST(nr_local AS BIGINT) AS nr_local, CAST(nr_secao AS BIGINT) AS nr_secao, CAST(ano_eleicao AS BIGINT) AS ano_eleicao, turno
                   FROM {section} s JOIN {mapping} m USING (id_local_votacao) JOIN {region_dim} r USING (id_regiao)
                   WHERE nr_secao % 10 <> 0""")


def section_rows(s):
    """Vote lines of the sections on the map: one per raw vote row of an ordinary election."""
    return s.sql("""SELECT LPAD(CD_MUNICIPIO, 5, '0') AS municipio, CAST(NR_ZONA AS INT) AS zona, CAST(NR_LOCAL_VOTACAO AS INT) AS local, CAST(NR_SECAO AS INT) AS secao,
                           CASE WHEN DS_CARGO = 'Presidente' THEN 1 ELSE 6 END AS cargo,
                           CASE NR_VOTAVEL WHEN '95' THEN 'branco' WHEN '96' THEN 'nulo' WHEN '97' THEN 'cargo_sem_candidato' WHEN '17' THEN 'legenda' WHEN '18' THEN 'legenda' ELSE 'nominal' END AS tipo,
                           COALESCE(TRY_CAST(QT_VOTOS AS BIGINT), 0) AS quantidade, CAST(NR_VOTAVEL AS BIGINT) AS partido, CAST(NR_VOTAVEL AS BIGINT) AS numero,
                           CAST(ANO_ELEICAO AS INT) AS ano_eleicao, TRIM(NR_TURNO) AS turno
                    FROM {vote_raw} WHERE TRIM(CD_TIPO_ELEICAO) = '2'""")


CONTEST = [*ELECTION, "cargo"]
LIVE = dict(**SECTION_MAP, live="""
    SELECT id_regiao, m.ano_eleicao, m.turno, CASE WHEN DS_CARGO = 'Presidente' THEN 1 ELSE 6 END AS cargo,
           CASE NR_VOTAVEL WHEN '95' THEN 'branco' WHEN '96' THEN 'nulo' WHEN '97' THEN 'nulo' WHEN '17' THEN 'legenda' WHEN '18' THEN 'legenda' ELSE 'nominal' END AS tipo,
           CASE WHEN NR_VOTAVEL IN ('95', '96', '97') THEN NULL ELSE CAST(NR_VOTAVEL AS BIGINT) END AS numero, COALESCE(TRY_CAST(QT_VOTOS AS BIGINT), 0) AS q,
           m.cd_municipio_tse AS municipio, m.nr_zona AS zona, m.nr_secao AS secao
    FROM {vote_raw} v JOIN {section_map} m ON LPAD(v.CD_MUNICIPIO, 5, '0') = m.cd_municipio_tse AND CAST(v.NR_ZONA AS INT) = m.nr_zona AND CAST(v.NR_SECAO AS INT) = m.nr_secao
         AND CAST(v.NR_LOCAL_VOTACAO AS INT) = m.nr_local AND CAST(v.ANO_ELEICAO AS INT) = m.ano_eleicao AND TRIM(v.NR_TURNO) = m.turno
    WHERE TRIM(CD_TIPO_ELEICAO) = '2'""")


# ---------------------------------------------------------------- streams

def staged(s, df, files: int = 4):
    """Several files of a frame in a folder, to arrive one after another."""
    path = scratch(s, "arriving")
    df.repartition(files).write.parquet(path)
    return ST.arriving(s.spark, path, df.schema, per_batch=1)


def sink(s, stream, mode: str):
    """All rows a stream emits, with the number of the batch."""
    out, check = scratch(s, "out"), scratch(s, "check")
    ST.run_pass(stream, check, lambda b, i: b.withColumn("_batch", F.lit(i)).write.mode("overwrite").parquet(f"{out}/b={i}"), mode)
    return s.spark.read.parquet(out).drop("b")


def newest(df, keys):
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, "_r.*").drop("_batch")


def reports(s):
    """Each event is a transmission of the section of its user."""
    return s.sql("""SELECT '00310' AS municipio, 1 AS zona, CAST(secao AS INT) AS secao, CAST(secao % 7 AS INT) AS local, situacao, ordem,
                           ARRAY(NAMED_STRUCT('cargo', 1, 'tipo', 'nominal', 'quantidade', CAST(FLOOR(valor * 10) AS BIGINT), 'partido', 13L, 'numero', 13L),
                                 NAMED_STRUCT('cargo', 1, 'tipo', 'branco', 'quantidade', CAST(ordem % 5 AS BIGINT), 'partido', CAST(NULL AS BIGINT), 'numero', CAST(NULL AS BIGINT))) AS votos
                    FROM {transmission}""")


def stream_map(s):
    """Users are the sections; those ending in 9 declare a place that is not theirs."""
    return s.sql("""SELECT DISTINCT CAST(user_id % 3 AS STRING) AS cd_municipio_ibge, 'ro' AS uf, '00310' AS cd_municipio_tse, user_id % 5 AS id_regiao, 1 AS nr_zona,
                           CAST(CASE WHEN user_id % 10 = 9 THEN 99 ELSE user_id % 7 END AS INT) AS nr_local, CAST(user_id AS INT) AS nr_secao FROM {events}""").where("id_regiao < 5")


def live_stream(s, table: str, mapped=None, limits=None, published=None, files: int = 3):
    folder = scratch(s, "live")
    m = settle(stream_map(s).withColumn("cd_municipio_ibge", F.lit("1")) if mapped is None else mapped)
    limits = s.spark.createDataFrame([], "cd_municipio_ibge string, nome string, limite bigint") if limits is None else limits
    stream = ST.corrections(staged(s, reports(s), files))
    ST.run_pass(stream, scratch(s, "check"), ST.live_step(folder, m, limits, published=published, year=2026))
    return ST.latest(s.spark, folder, table)


def with_silent(s):
    """The stream's map with sections that never report."""
    m = stream_map(s).withColumn("cd_municipio_ibge", F.lit("1"))
    return m.unionByName(m.where("nr_secao % 25 = 3").withColumn("nr_secao", (F.col("nr_secao") + 1_000_000).cast("int")))


def _stream_guarded(s):
    """No name may have more votes in a region than a fifth of all; regions beyond are withheld."""
    limits = s.sql("""SELECT '1' AS cd_municipio_ibge, '13' AS nome, CAST(SUM(CAST(FLOOR(valor * 10) AS BIGINT)) AS BIGINT) AS q
                      FROM (SELECT secao, MAX_BY(valor, (IF(situacao = 'Totalizado', 1, 0), ordem)) AS valor FROM {transmission} GROUP BY secao) WHERE secao % 10 <> 9""")
    limits = settle(limits.select("cd_municipio_ibge", "nome", F.floor(F.col("q") / 5).alias("limite")))
    return tidy(live_stream(s, "resultados", limits=limits, files=2).select("id_regiao", "tipo", "numero", "votos", "nome"))


def _stream_served(s):
    """Published contests of all regions, of the live election's contest in one; live ones elsewhere."""
    published = s.sql("""SELECT DISTINCT user_id % 5 AS id_regiao, 'presidente' AS cargo, 2022 AS ano_eleicao, '1' AS turno, 'ANTES' AS nome, 9L AS votos FROM {events}
                         UNION ALL SELECT DISTINCT 2L, 'presidente', 2026, '1', 'JA', 3L FROM {events}""")
    return tidy(live_stream(s, "servido", published=settle(published), files=2))


VALID_SECTION = """SELECT secao, situacao, ordem, valor, secao % 5 AS id_regiao FROM {transmission}
    QUALIFY row_number() OVER (PARTITION BY secao ORDER BY situacao = 'Totalizado' DESC, ordem DESC) = 1"""


_SUMS = """SELECT id_regiao, CAST(SUM(CAST(FLOOR(valor * 10) AS BIGINT)) AS BIGINT) AS n, CAST(SUM(ordem % 5) AS BIGINT) AS b FROM {valid}
           WHERE secao % 10 <> 9 GROUP BY 1"""


def _stream_once(s):
    rows = s.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return sink(s, ST.once_per_section(staged(s, rows), ["user_id"], "ts", "4000 days"), "append").select("user_id")


def _stream_rate(s):
    rows = s.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    got = newest(sink(s, ST.arrival_rate(staged(s, rows), "ts", "1 hour", "4000 days"), "update"), ["inicio", "fim"])
    return got.select(F.date_format("inicio", "yyyy-MM-dd HH:mm").alias("inicio"), "boletins")


def _documents(s):
    """Files in the folder here and on the server: some new, some changed, some the same."""
    here = s.sql("SELECT CONCAT('d', CAST(doc_id AS STRING)) AS arquivo, n_chars AS bytes, TIMESTAMP'2026-10-05 00:00:00' AS modificado FROM {documents}")
    there = s.sql("""SELECT CONCAT('d', CAST(doc_id AS STRING)) AS arquivo, n_chars + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS bytes,
                            CASE WHEN doc_id % 7 = 0 THEN TIMESTAMP'2026-10-04 00:00:00' ELSE TIMESTAMP'2026-10-06 00:00:00' END AS modificado
                     FROM {documents} WHERE doc_id % 11 <> 0""")
    return D.publish_diff(here, there).select("arquivo", "situacao")


def _publish_twice(s):
    """Two versions of customer documents by nation, the files of the second against those of the first.

    Between them nations 0 to 3 lose their customers, and those of 4 to 9 move by one.
    """
    path = scratch(s, "published")
    first = s.sql("SELECT CAST(c_nationkey AS STRING) AS nacao, c_custkey, c_acctbal FROM {customer}")
    PUBLISHED.publish(first, path, "nacao")
    before = settle(PUBLISHED.published_files(s.spark, path))
    second = s.sql("""SELECT CAST(c_nationkey AS STRING) AS nacao, c_custkey + CASE WHEN c_nationkey < 10 THEN 1 ELSE 0 END AS c_custkey, c_acctbal
                      FROM {customer} WHERE c_nationkey > 3""")
    PUBLISHED.publish(second, path, "nacao")
    return path, before, PUBLISHED.published_files(s.spark, path)


def _published_versions(s):
    """Which nations must be sent: those with a file that the first version lacks."""
    _, before, after = _publish_twice(s)
    return tidy(D.publish_diff(after, before).groupBy(F.col("chave").alias("nacao")).agg(
        F.max((F.col("situacao") == "novo").cast("int")).alias("novo"), F.sum("documentos").alias("documentos")))


def _published_asked(s):
    """Documents of the nations of one region's suppliers, from the second version."""
    path, _, _ = _publish_twice(s)
    asked = s.sql("SELECT CAST(s_nationkey AS STRING) AS nacao FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE n_regionkey = 1")
    rows = PUBLISHED.read_published(s.spark, path, "nacao", asked)
    return tidy(rows.select("nacao", F.from_json("value", "c_custkey bigint, c_acctbal double").alias("d")).select("nacao", "d.*"))


def _audit(s):
    pages = s.pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("arquivo"), F.col("html").cast("binary").alias("content"), "page_id")
    signed = pages.select("arquivo", F.sha2(F.when(F.col("page_id") % 3 == 1, F.lit("altered").cast("binary")).otherwise(F.col("content")), 512).alias("sha512"))
    return D.integrity_audit(pages.where("page_id % 4 <> 2"), signed)


def _stale(s):
    """Saved assignments whose region moved to another municipality, by partition."""
    saved = s.sql("SELECT 2026 AS ano_referencia, CAST(c_nationkey % 5 AS STRING) AS sg_uf, c_custkey AS id_regiao, CAST(c_nationkey AS STRING) AS cd_municipio_ibge FROM {customer}")
    now = s.sql("SELECT c_custkey AS id_regiao, CAST(CASE WHEN c_custkey % 100 = 7 AND c_nationkey % 5 < 2 THEN c_nationkey + 1 ELSE c_nationkey END AS STRING) AS cd_municipio_ibge FROM {customer}")
    return tidy(T.stale_partitions(saved, now, ["id_regiao", "cd_municipio_ibge"]))


def _slices(s):
    """A base of three years; one (year, round) slice is replaced twice, the rest stays."""
    path = scratch(s, "slices")
    base = s.vote.groupBy("ano_eleicao", "turno", "sg_uf").agg(F.sum("qt_votos").alias("qt_votos"))
    T.replace_slice(base, path)
    new = base.where("ano_eleicao = 2026 and turno = '1'").withColumn("qt_votos", F.col("qt_votos") + 1)
    T.replace_slice(new, path)
    T.replace_slice(new, path)
    return tidy(s.spark.read.parquet(path).select(F.col("ano_eleicao").cast("bigint").alias("ano_eleicao"), F.col("turno").cast("string").alias("turno"), "sg_uf", "qt_votos"))


PARTS = 4  # archives of a state and year


def _zip_lines(s, folder: str):
    """Vote lines to archives by year, state and part, as a publisher would have put them there."""
    system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")
    system.create_dir(root)
    head = "id_local_votacao;cargo;nm_votavel;qt_votos;SOBRA\r\n"

    def write(batches):
        name = last = archive = member = out = temporary = None

        def close():
            member.close()
            archive.close()
            out.close()
            system.move(f"{root}/{temporary}", f"{root}/{name}.zip")  # a task that runs again puts the same file there

        for batch in batches:
            for name_, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name_ != last:
                    if last:
                        close()
                    name = last = name_
                    temporary = f"{name}-{uuid.uuid4().hex}.partial"
                    out = system.open_output_stream(f"{root}/{temporary}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    member = archive.open(f"{name}.csv", "w", force_zip64=True)
                    member.write(head.encode("latin-1"))
                member.write(line.encode("latin-1"))
        if last:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.string())], ["arquivo"])

    quoted = F.concat(F.lit('"'), F.replace(F.col("nm_votavel"), F.lit('"'), F.lit('""')), F.lit('"'))
    rows = s.vote.select(
        F.concat_ws("_", F.lit("votos"), F.col("ano_eleicao").cast("string"), "sg_uf",
                    F.pmod(F.xxhash64("id_local_votacao", "sq_candidato", "qt_votos"), F.lit(PARTS)).cast("string")).alias("arquivo"),
        F.concat(F.concat_ws(";", "id_local_votacao", "cargo", quoted, F.col("qt_votos").cast("string")), F.lit(";x\r\n")).alias("linha"))
    rows.repartition("arquivo").sortWithinPartitions("arquivo").mapInArrow(write, "arquivo string").write.format("noop").mode("overwrite").save()


def _archives(s):
    """Votes read back from archives found by year, state and part."""
    folder = scratch(s, "zips")
    _zip_lines(s, folder)
    states = [r.sg_uf for r in s.place.select("sg_uf").distinct().collect()]  # five at most
    rows = ZIP.read_archives(s.spark, folder + "/votos_{ano}_{uf}_{parte}.zip",
                             "ano bigint, uf string, cargo string, nm_votavel string, qt_votos string",
                             ano=[2018, 2022, 2026], uf=states, parte=range(PARTS))
    return rows.groupBy("ano", "uf", "cargo", "nm_votavel").agg(
        F.count("*").alias("linhas"), F.sum(F.col("qt_votos").cast("bigint")).alias("votos"))


def _rules(s):
    """Rules of the published street documents, with some regions withdrawn from the mesh."""
    index = stored_index(s)
    docs, local = PUB.street_documents(index)
    docs = settle(docs.withColumn("trechos", F.coalesce("trechos", F.array().cast(docs.schema["trechos"].dataType))))
    regions = s.sql("SELECT DISTINCT cd_municipio_ibge, id_regiao FROM {counts}").where("id_regiao % 25 <> 3")
    return VAL.street_problems(docs, settle(local), regions).groupBy("check", "context").agg(F.count("*").alias("problemas"))


QUERIES = {
    "ballot_votes": query(lambda s: tidy(counts(s)), "SELECT * FROM {ballot_count}", ballot_count=BALLOT_COUNT),
    "ballot_rejections": query(
        _rejected,
        """SELECT DISTINCT arquivo, CASE WHEN quebra = 1 THEN 'estrutura' WHEN fase <> 2 THEN 'fase' ELSE 'conta' END AS classe
           FROM {ballot} WHERE quebra = 1 OR fase <> 2 OR desvio = 1"""),
    "rejection_rate_gate": query(
        lambda s: (lambda r: C.rejection_rate(r, C.rejections(r)))(decoded(s)),
        """SELECT 'rejection rate' AS "check", 'ballot reports' AS context, CONCAT(CAST(bad AS STRING), ' of ', CAST(n AS STRING), ' rejected, limit ', limite) AS detail
           FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (ruim) AS bad, '0.005' AS limite, 0.005 AS l FROM {files}
                 UNION ALL SELECT COUNT(*), COUNT(*) FILTER (ruim), '0.5', 0.5 FROM (SELECT * FROM {files} ORDER BY arquivo LIMIT 200) HAVING COUNT(*) >= 200)
           WHERE n > 0 AND bad / n > l""", files="SELECT arquivo, bool_or(quebra = 1 OR fase <> 2 OR desvio = 1) AS ruim FROM {ballot} GROUP BY 1"),
    "vote_records": query(
        lambda s: tidy(B.record_summary(recorded(s))),
        f"SELECT 619 :: BIGINT AS eleicao, CAST(cargo AS BIGINT) AS cargo, {_TYPE} AS tipo, COUNT(*) AS votos FROM {{ballot}} WHERE quebra = 0 GROUP BY 2, 3"),
    "ballot_conversion": query(
        lambda s: tidy(C.vote_rows(counts(s), "xx", 2026, "1", s.candidacy)),
        """SELECT CONCAT('XX_', c.municipio, '_', c.zona, '_', c.local) AS id_local_votacao, 'XX' AS sg_uf, 2026::BIGINT AS ano_eleicao, '1' AS turno,
                  CASE c.cargo WHEN 1 THEN 'PRESIDENTE' ELSE 'PREFEITO' END AS cargo,
                  CASE c.tipo WHEN 'legenda' THEN '-3' WHEN 'nominal' THEN p.SQ_CANDIDATO ELSE '-1' END AS sq_candidato,
                  CASE c.tipo WHEN 'branco' THEN '95' WHEN 'nulo' THEN '96' ELSE CAST(c.numero AS STRING) END AS nr_votavel,
                  CASE c.tipo WHEN 'branco' THEN 'VOTO EM BRANCO' WHEN 'nulo' THEN 'VOTO NULO' WHEN 'legenda' THEN l.sg ELSE p.NM_URNA_CANDIDATO END AS nm_votavel,
                  CASE c.tipo WHEN 'legenda' THEN l.sg WHEN 'nominal' THEN p.SG_PARTIDO END AS sg_partido, c.tipo AS tipo_voto, c.qt_votos
           FROM {ballot_count} c
           LEFT JOIN {preferred} p ON p.cargo = CASE c.cargo WHEN 1 THEN 'PRESIDENTE' ELSE 'PREFEITO' END AND p.SG_UE = CASE c.cargo WHEN 1 THEN 'BR' ELSE c.municipio END
                AND p.NR_CANDIDATO = CAST(c.numero AS STRING)
           LEFT JOIN (SELECT NR_PARTIDO, MIN(SG_PARTIDO) AS sg FROM {candidacy} GROUP BY 1) l ON l.NR_PARTIDO = CAST(c.partido AS STRING)""",
        ballot_count=BALLOT_COUNT, preferred=PREFERRED),
    "preferred_candidacies": query(
        lambda s: C.preferred_candidacies(s.candidacy).select("cargo", "SG_UE", "NR_CANDIDATO", "SQ_CANDIDATO", "DS_SIT_TOT_TURNO"),
        "SELECT cargo, SG_UE, NR_CANDIDATO, SQ_CANDIDATO, DS_SIT_TOT_TURNO FROM {preferred}", preferred=PREFERRED),
    "candidate_map": query(
        lambda s: C.candidate_map(s.candidacy, [1, 11]).select("unidade", "cargo", "numero", "partido"),
        "SELECT CASE WHEN cargo = 'PRESIDENTE' THEN 'presidente' ELSE SG_UE END AS unidade, LOWER(cargo) AS cargo, NR_CANDIDATO AS numero, SG_PARTIDO AS partido FROM {preferred}", preferred=PREFERRED),
    "official_votables": query(
        lambda s: tidy(O.result_votables(strict_documents(s), ["sg_uf"])),
        """SELECT * FROM {named} UNION ALL SELECT DISTINCT sg_uf, 'legenda', '1', 'P1 (legenda)', 'P1', 7 FROM {named} WHERE partido = 'P1'""", named=NAMED),
    "official_totals": query(
        lambda s: tidy(O.result_totals(strict_documents(s), ["sg_uf"]).select("sg_uf", *REC.TOTALS, F.size("avisos").alias("avisos"), F.array_join("notas", "|").alias("notas"))),
        """SELECT o.*, 0::BIGINT AS avisos, CONCAT('summary ', s.validos - 3, ' differs from its parts ', s.validos) AS notas
           FROM {official_total} o JOIN {state_type} s USING (sg_uf)""", state_type=STATE_TYPE, official_total=OFFICIAL_TOTAL),
    "official_maximum": query(
        lambda s: tidy(O.official_maximum(strict_documents(s), ["sg_uf"])), "SELECT sg_uf, nome, MAX(votos) AS limite FROM {named} GROUP BY 1, 2", named=NAMED),
    "counting_progress": query(
        lambda s: tidy(O.counting_progress(strict_documents(s), ["sg_uf"])),
        "SELECT sg_uf, 100::BIGINT AS secoes, 99::BIGINT AS totalizadas, 99.5::DOUBLE AS pct FROM {state_type}", state_type=STATE_TYPE),
    "reconcile_totals": query(
        lambda s: tidy(reconciled(s)[1].select("sg_uf", "total", "oficial", "nosso", "diferenca", "marca")),
        "SELECT sg_uf, total, oficial, nosso, diferenca, marca FROM {compared}", **OFFICIAL),
    "reconcile_votables": query(
        lambda s: tidy(reconciled(s)[2].select("sg_uf", "tipo_voto", "nr_votavel", "oficial", "nosso", "diferenca", "marca")),
        "SELECT * FROM {compared_names}", **OFFICIAL),
    "reconcile_problems": query(
        lambda s: reconciled(s)[0],
        f"""SELECT 'reconcile' AS "check", 'official' AS context, sg_uf || ': ' || detail AS detail FROM (
              SELECT sg_uf, total || ' differs by ' || diferenca AS detail FROM {{compared}} WHERE marca = 'x'
              UNION ALL SELECT sg_uf, 'short of ' || falta || ' votes' FROM {{compared}}
                        WHERE total = 'comparecimento' AND falta > 0 AND falta / GREATEST(oficial, 1) > {K.MISSING_LIMIT}
              UNION ALL SELECT sg_uf, 'more votes than the official count' FROM {{compared}} WHERE total = 'comparecimento' AND falta < 0)
            UNION ALL SELECT 'reconcile', 'official', sg_uf || ', number ' || nr_votavel || ' differs by ' || diferenca
                      FROM {{compared_names}} WHERE marca = 'x'""", **OFFICIAL),
    "reconcile_levels": query(
        lambda s: tidy(reconciled_levels(s)[1].select(*REC.LEVELS, "total", "oficial", "nosso", "diferenca", "falta", "falta_abaixo", "explicada", "marca")),
        f"SELECT {_L}, total, oficial, nosso, diferenca, falta, falta_abaixo, explicada, marca FROM {{l_tot}}", **LEVEL),
    "reconcile_level_votables": query(
        lambda s: tidy(reconciled_levels(s)[2].select(*REC.LEVELS, "tipo_voto", "nr_votavel", "oficial", "nosso", "diferenca", "marca")),
        "SELECT * FROM {l_name}", **LEVEL),
    "reconcile_level_problems": query(lambda s: reconciled_levels(s)[0], _LEVEL_PROBLEMS, **LEVEL),
    "section_config": query(
        lambda s: O.sections(config_documents(s), announced_only=True),
        """SELECT DISTINCT sg_uf AS uf, cd_municipio_tse AS municipio, nm_municipio AS municipio_nome, LPAD(CAST(nr_zona AS STRING), 4, '0') AS zona,
                  CAST(nr_secao AS STRING) AS secao, '04/10/2026' AS data_aux, '17:01' AS hora_aux FROM {section} WHERE nr_secao % 10 <> 0 AND nr_secao % 3 > 0""", section=SECTION),
    "section_map": query(lambda s: tidy(mapped(s)), "SELECT * FROM {section_map}", **SECTION_MAP),
    "section_lists": query(
        lambda s: tidy(L.section_lists(mapped(s), ELECTION, size=50).select(
            "cd_municipio_ibge", "id_regiao", *ELECTION, "parte", F.array_join(F.transform("secoes", lambda x: F.array_join(x.cast("array<string>"), "-")), " ").alias("secoes"))),
        """SELECT cd_municipio_ibge, id_regiao, ano_eleicao, turno, parte, string_agg(CONCAT(nr_zona, '-', nr_local, '-', nr_secao), ' ' ORDER BY i) AS secoes
           FROM (SELECT *, i // 50 AS parte FROM (
                 SELECT *, row_number() OVER (PARTITION BY cd_municipio_ibge, id_regiao, ano_eleicao, turno ORDER BY nr_zona, nr_local, nr_secao) - 1 AS i FROM {section_map}))
           GROUP BY 1, 2, 3, 4, 5""", **SECTION_MAP),
    "section_map_counters": query(
        lambda s: tidy(L.section_map_counters(sections(s), mesh(s)[1].where("id_regiao % 4 <> 0"), principal(s))),
        """SELECT COUNT(*) FILTER (id_regiao % 4 <> 0 AND nr_secao % 10 <> 0) AS mapeadas, COUNT(*) FILTER (id_regiao % 4 = 0) AS fora_da_malha,
                  COUNT(*) FILTER (id_regiao % 4 <> 0 AND nr_secao % 10 = 0) AS agregadas FROM {section} JOIN {mapping} USING (id_local_votacao)""", **MESH, section=SECTION),
    "live_results": query(
        lambda s: tidy(L.live_shares(L.live_results(placed(s), CONTEST), CONTEST)),
        f"""SELECT id_regiao, ano_eleicao, turno, CAST(cargo AS BIGINT) AS cargo, tipo, numero, votos, validos, comparecimento,
                   CASE WHEN tipo IN ('nominal', 'legenda') THEN {pct_sql('votos', 'validos')} ELSE {pct_sql('votos', 'comparecimento')} END AS pct
            FROM (SELECT *, CAST(SUM(votos) FILTER (tipo IN ('nominal', 'legenda')) OVER w AS BIGINT) AS validos, CAST(SUM(votos) OVER w AS BIGINT) AS comparecimento FROM
                  (SELECT id_regiao, ano_eleicao, turno, cargo, tipo, numero, CAST(SUM(q) AS BIGINT) AS votos FROM {{live}} GROUP BY 1,2,3,4,5,6)
                  WINDOW w AS (PARTITION BY id_regiao, ano_eleicao, turno, cargo))""", **LIVE),
    "live_progress": query(
        lambda s: (lambda m: tidy(L.live_progress(L.live_votes(section_rows(s), m, ELECTION), m, ELECTION)))(settle(mapped(s))),
        """SELECT id_regiao, ano_eleicao, turno, esperadas, COALESCE(urnas, 0) AS urnas, CASE WHEN COALESCE(urnas, 0) = 0 THEN 'sem' WHEN urnas >= esperadas THEN 'completo' ELSE 'parcial' END AS situacao
           FROM (SELECT id_regiao, ano_eleicao, turno, COUNT(*) AS esperadas FROM {section_map} GROUP BY 1, 2, 3)
           LEFT JOIN (SELECT id_regiao, ano_eleicao, turno, COUNT(DISTINCT (municipio, zona, secao)) AS urnas FROM {live} GROUP BY 1, 2, 3)
                USING (id_regiao, ano_eleicao, turno)""", **LIVE),
    "valid_transmission": query(
        lambda s: tidy(L.valid_transmission(s.transmission, ["secao"])), "SELECT secao, ordem, situacao, ROUND(valor, 4) AS valor FROM {valid}", valid=VALID_SECTION),
    "stream_valid_transmission": query(
        lambda s: tidy(newest(sink(s, ST.running_valid(staged(s, s.transmission), ["secao"], ["situacao", "ordem", "valor"], "ordem"), "update"), ["secao"])),
        "SELECT secao, ordem, situacao, ROUND(valor, 4) AS valor FROM {valid}", valid=VALID_SECTION),
    "stream_running_totals": query(
        lambda s: tidy(newest(sink(s, ST.running_totals(staged(s, s.sql("SELECT event_type, CAST(FLOOR(value * 10) AS BIGINT) AS q FROM {events}")), ["event_type"], "q"), "update"), ["event_type"])),
        "SELECT event_type, COUNT(*) AS linhas, CAST(SUM(CAST(FLOOR(value * 10) AS BIGINT)) AS BIGINT) AS soma FROM events GROUP BY 1"),
    "stream_once_per_section": query(_stream_once, "SELECT DISTINCT user_id FROM events"),
    "stream_arrival_rate": query(_stream_rate, "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS inicio, COUNT(*) AS boletins FROM events GROUP BY 1"),
    "stream_live_results": query(
        lambda s: tidy(live_stream(s, "resultados").where("votos <> 0").select("id_regiao", "tipo", "votos", "pct")),
        f"""SELECT id_regiao, tipo, votos, {pct_sql('votos', 'base')} AS pct FROM (SELECT id_regiao, 'nominal' AS tipo, n AS votos, n AS base FROM {{sums}}
            UNION ALL SELECT id_regiao, 'branco', b, n + b FROM {{sums}}) WHERE votos <> 0""", valid=VALID_SECTION,
        sums=_SUMS),
    "stream_pending": query(
        lambda s: tidy(live_stream(s, "pendentes").select("secao", "motivo")),
        "SELECT secao, 'não totalizada' AS motivo FROM {valid} WHERE situacao <> 'Totalizado'", valid=VALID_SECTION),
    "stream_progress": query(
        lambda s: tidy(live_stream(s, "progresso", with_silent(s), files=2)),
        """SELECT id_regiao, esperadas, COALESCE(urnas, 0) AS urnas, CASE WHEN COALESCE(urnas, 0) = 0 THEN 'sem' WHEN urnas >= esperadas THEN 'completo' ELSE 'parcial' END AS situacao
           FROM (SELECT id_regiao, COUNT(*) + COUNT(*) FILTER (secao % 25 = 3) AS esperadas FROM {section_known} GROUP BY 1)
           LEFT JOIN (SELECT id_regiao, COUNT(*) AS urnas FROM {valid} WHERE secao % 10 <> 9 GROUP BY 1) USING (id_regiao)""", valid=VALID_SECTION,
        section_known="SELECT DISTINCT user_id AS secao, user_id % 5 AS id_regiao FROM {events}"),
    "stream_pending_reasons": query(
        lambda s: tidy(live_stream(s, "pendentes", with_silent(s), files=2).select("municipio", "zona", "secao", "motivo")),
        """SELECT '00310' AS municipio, 1::BIGINT AS zona, secao, 'não totalizada' AS motivo FROM {valid} WHERE situacao <> 'Totalizado'
           UNION ALL SELECT DISTINCT '00310', 1::BIGINT, user_id + 1000000, 'sem boletim' FROM {events} WHERE user_id % 25 = 3""", valid=VALID_SECTION),
    "stream_guarded_results": query(
        _stream_guarded,
        """SELECT id_regiao, tipo, numero, votos, nome FROM (
             SELECT id_regiao, 'nominal' AS tipo, 13::BIGINT AS numero, n AS votos, '13' AS nome, n FROM {sums} UNION ALL SELECT id_regiao, 'branco', NULL, b, NULL, n FROM {sums})
           WHERE votos <> 0 AND n <= (SELECT SUM(n) // 5 FROM {sums})""", valid=VALID_SECTION, sums=_SUMS),
    "stream_served": query(
        _stream_served,
        """SELECT DISTINCT user_id % 5 AS id_regiao, 'presidente' AS cargo, 2022::BIGINT AS ano_eleicao, '1' AS turno, 'ANTES' AS nome, 9::BIGINT AS votos, false AS parcial FROM {events}
           UNION ALL SELECT 2, 'presidente', 2026, '1', 'JA', 3, false
           UNION ALL SELECT id_regiao, 'presidente', 2026, '1', '13', n, true FROM {sums} WHERE n > 0 AND id_regiao <> 2""", valid=VALID_SECTION, sums=_SUMS),
    "event_properties": query(
        lambda s: tidy(s.events.select("event_type", F.from_json("props", "k bigint", {"mode": "FAILFAST", "allowNonNumericNumbers": "false"}).alias("p"))
                       .groupBy("event_type").agg(F.sum("p.k").alias("soma"), F.max("p.k").alias("maximo"))),
        "SELECT event_type, CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS soma, MAX(CAST(json_extract(props, '$.k') AS BIGINT)) AS maximo FROM events GROUP BY 1"),
    "json_lines": query(
        lambda s: D.json_rows(s.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), ["o_orderkey"]),
        """SELECT o_orderkey, '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}' AS value FROM orders"""),
    "publish_diff": query(
        _documents,
        """SELECT 'd' || doc_id AS arquivo, CASE WHEN doc_id % 11 = 0 THEN 'novo' WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN 'alterado' ELSE 'igual' END AS situacao FROM documents"""),
    "integrity_audit": query(
        _audit, "SELECT 'p' || page_id AS arquivo, CASE WHEN page_id % 4 = 2 THEN 'ausente' WHEN page_id % 3 = 1 THEN 'diferente' ELSE 'ok' END AS situacao FROM pages"),
    "stale_partitions": query(
        _stale, """SELECT DISTINCT 2026::BIGINT AS ano_referencia, CAST(c_nationkey % 5 AS STRING) AS sg_uf FROM customer WHERE c_custkey % 100 = 7 AND c_nationkey % 5 < 2"""),
    "replace_slice": query(
        _slices, """SELECT CAST(ano_eleicao AS BIGINT) AS ano_eleicao, turno, sg_uf, CAST(SUM(qt_votos) AS BIGINT) + CASE WHEN ano_eleicao = 2026 AND turno = '1' THEN 1 ELSE 0 END AS qt_votos
                    FROM {vote} GROUP BY 1, 2, 3, ano_eleicao"""),
    "published_versions": query(
        _published_versions, """SELECT CAST(c_nationkey AS STRING) AS nacao, CAST(c_nationkey < 10 AS BIGINT) AS novo, COUNT(*) AS documentos
                                FROM customer WHERE c_nationkey > 3 GROUP BY c_nationkey"""),
    "published_asked": query(
        _published_asked, """SELECT CAST(c_nationkey AS STRING) AS nacao, c_custkey + CASE WHEN c_nationkey < 10 THEN 1 ELSE 0 END AS c_custkey, ROUND(c_acctbal, 4) AS c_acctbal
                             FROM customer WHERE c_nationkey > 3 AND c_nationkey IN (SELECT s_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1)"""),
    "archive_votes": query(
        _archives, """SELECT CAST(ano_eleicao AS BIGINT) AS ano, sg_uf AS uf, cargo, nm_votavel, COUNT(*) AS linhas, CAST(SUM(qt_votos) AS BIGINT) AS votos
                      FROM {vote} GROUP BY 1, 2, 3, 4"""),
    "sample_per_nation": query(
        lambda s: T.sample_per_group(s.sql("SELECT c_nationkey, c_custkey, c_acctbal FROM {customer}"), ["c_nationkey"], ["c_custkey"], 20),
        """SELECT c_nationkey, c_custkey, c_acctbal FROM customer
           QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('42|' || c_custkey) DESC, c_custkey) <= 20"""),
    "street_document_rules": query(
        _rules,
        """SELECT "check", context, COUNT(*) AS problemas FROM (
             SELECT DISTINCT 'unknown region' AS "check", 'street' AS context, cd_municipio_ibge, logradouro AS nome, '' AS bairro, id_regiao FROM (
               SELECT cd_municipio_ibge, logradouro, id_regiao_dominante AS id_regiao FROM {street}
               UNION ALL SELECT cd_municipio_ibge, logradouro, id_regiao FROM {run}
               UNION ALL SELECT cd_municipio_ibge, logradouro, id_regiao FROM {by_street} WHERE n_regioes > 1
               UNION ALL SELECT cd_municipio_ibge, logradouro, id_regiao FROM {by_local}) WHERE id_regiao % 25 = 3
             UNION ALL SELECT 'fractions', 'street', cd_municipio_ibge, logradouro, '', NULL FROM {by_street} WHERE n_regioes > 1
               GROUP BY cd_municipio_ibge, logradouro HAVING ABS(SUM(ROUND(fracao, 3)) - 1) > GREATEST(%(slack)s, COUNT(*) * %(each)s)
             UNION ALL SELECT 'fractions', 'street locality', cd_municipio_ibge, logradouro, bairro, NULL FROM {by_local}
               GROUP BY cd_municipio_ibge, logradouro, bairro HAVING ABS(SUM(ROUND(fracao, 3)) - 1) > GREATEST(%(slack)s, COUNT(*) * %(each)s))
           GROUP BY 1, 2""".replace("%(slack)s", str(K.SHARE_SLACK)).replace("%(each)s", str(K.SHARE_SLACK_PER_ITEM)), **IDX),
}
