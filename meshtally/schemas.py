"""Column contracts between stages."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _I, _B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


def _strings(*names: str) -> T.StructType:
    return _schema(**{n: _S for n in names})


# Raw files: every column is text, so nothing is inferred.
RAW_PLACES = _strings(
    "AA_ELEICAO", "NR_TURNO", "SG_UF", "CD_MUNICIPIO", "NM_MUNICIPIO", "NR_ZONA", "NR_SECAO",
    "NR_LOCAL_VOTACAO", "NM_LOCAL_VOTACAO", "DS_ENDERECO", "NR_LATITUDE", "NR_LONGITUDE",
    "QT_ELEITOR_ELEICAO_FEDERAL")
RAW_VOTES = _strings(
    "ANO_ELEICAO", "NR_TURNO", "SG_UF", "CD_MUNICIPIO", "NR_ZONA", "NR_SECAO", "DS_CARGO",
    "NR_VOTAVEL", "NM_VOTAVEL", "QT_VOTOS", "NR_LOCAL_VOTACAO", "SQ_CANDIDATO", "CD_TIPO_ELEICAO")
RAW_ADDRESSES = _strings(
    "COD_UNICO_ENDERECO", "COD_MUNICIPIO", "NOM_TIPO_SEGLOGR", "NOM_TITULO_SEGLOGR",
    "NOM_SEGLOGR", "NUM_ENDERECO", "LATITUDE", "LONGITUDE", "COD_ESPECIE", "DSC_LOCALIDADE")
RAW_CANDIDATES = _strings(
    "SG_UF", "DS_CARGO", "SQ_CANDIDATO", "NR_CANDIDATO", "SG_UE", "NM_URNA_CANDIDATO",
    "NR_PARTIDO", "SG_PARTIDO", "DS_SITUACAO_CANDIDATURA", "DS_SIT_TOT_TURNO")

VOTE_COLUMNS = ["id_local_votacao", "sg_uf", "ano_eleicao", "turno", "cargo", "sq_candidato",
                "nr_votavel", "nm_votavel", "sg_partido", "tipo_voto", "qt_votos"]
ADDRESS_COLUMNS = ["cd_municipio_ibge", "logradouro", "bairro", "numero", "id_regiao",
                   "n_enderecos", "n_domicilios"]
STREET = ["cd_municipio_ibge", "logradouro"]

# One row per vote of a decoded ballot report; a rejected file is one row with `erro`.
BALLOT_ROWS = _schema(
    arquivo=_S, municipio=_S, zona=_I, local=_I, secao=_I, pleito=_L, fase=_S, eleicao=_L,
    grupo=_I, ordem=_I, cargo=_I, comparecimento=_L, tipo=_S, quantidade=_L, partido=_L,
    numero=_L, erro=_S)
RECORD_ROWS = _schema(arquivo=_S, eleicao=_L, cargo=_I, ordem=_I, tipo=_S, digitacao=_S, erro=_S)

_SECTION = _schema(ns=_S, nsp=_S, da=_S, ha=_S)
_ZONE = _schema(cd=_S, sec=T.ArrayType(_SECTION))
_TOWN = _schema(cd=_S, nm=_S, zon=T.ArrayType(_ZONE))
SECTION_CONFIG = _schema(abr=T.ArrayType(_schema(cd=_S, mu=T.ArrayType(_TOWN))))

CATALOGUE = _schema(pl=T.ArrayType(_schema(
    c=_S, cd=_S, dt=_S, e=T.ArrayType(_schema(cd=_S, nm=_S, t=_S)))))

_CANDIDATE = _schema(n=_S, nmu=_S, vap=_S)
_PARTY = _schema(n=_S, sg=_S, tvtl=_S, cand=T.ArrayType(_CANDIDATE))
OFFICIAL_RESULT = _schema(
    v=_strings("tv", "vvc", "vv", "vnom", "vl", "van", "vansj", "vb", "tvn", "vn", "vnt"),
    e=_strings("c"), s=_strings("ts", "st", "pst"),
    carg=T.ArrayType(_schema(agr=T.ArrayType(_schema(par=T.ArrayType(_PARTY))))))
