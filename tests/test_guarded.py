"""Builds that refuse bad input."""

import pytest
from pyspark.sql import functions as F

from meshtally import schemas
from meshtally.operators import observed as OBS
from meshtally.operators.guards import CheckFailed
from meshtally.operators.votes import votes_per_region
from meshtally.plans import guarded
from meshtally.sources import ballots

PLACE = ("id_local_votacao string, sg_uf string, cd_municipio_ibge string, nm_municipio string, nm_local_votacao_consolidado string, "
         "ds_local_votacao_endereco_consolidado string, latitude_final double, longitude_final double, origem_coordenada string")
REGISTER = ("SG_UF string, DS_CARGO string, SQ_CANDIDATO string, NR_CANDIDATO string, SG_UE string, NM_URNA_CANDIDATO string, NR_PARTIDO string, "
            "SG_PARTIDO string, DS_SITUACAO_CANDIDATURA string, DS_SIT_TOT_TURNO string")


def place(key, town="11", lat=-7.5, lon=-50.25):
    return (key, "XX", town, "T", "N " + key, "A", lat, lon, "tse")


def test_regions(spark):
    good = [place("a"), place("b"), place("c", "12", -8.0)]
    dimension, mapping = guarded.regions(spark.createDataFrame(good, PLACE))
    assert dimension.count() == 2 and mapping.count() == 3
    for bad in (place("d", "12"), place("d", "13", 48.0), place("a")):
        with pytest.raises(CheckFailed):
            guarded.regions(spark.createDataFrame([*good, bad], PLACE))


def votes(spark, *rows):
    full = [(p, "XX", 2028, "1", "PREFEITO", seq, num, "N", kind, n) for p, seq, num, kind, n in rows]
    return spark.createDataFrame(full, "id_local_votacao string, sg_uf string, ano_eleicao int, turno string, cargo string, sq_candidato string, "
                                       "nr_votavel string, nm_votavel string, tipo_voto string, qt_votos bigint")


def register(spark):
    return spark.createDataFrame([("XX", "Prefeito", "31", "62", "00077", "UMA", "62", "P62", "APTO", None)], REGISTER)


def test_party(spark):
    rows = [("a", "31", "62", "nominal", 8), ("a", "-1", "95", "branco", 2)]
    assert {r.sg_partido for r in guarded.party(votes(spark, *rows), register(spark)).collect()} == {"P62", None}
    with pytest.raises(CheckFailed, match="without party"):
        guarded.party(votes(spark, *rows, ("a", "32", "71", "nominal", 1)), register(spark))


def test_region_votes(spark):
    mapping = spark.createDataFrame([("a", 1)], "id_local_votacao string, id_regiao bigint")
    cast = [(k, "31", "62", "nominal", 8) for k in "aabbb"]
    base = votes(spark, *cast).selectExpr("*", "'P62' AS sg_partido")
    assert guarded.region_votes(base.where("id_local_votacao = 'a'"), mapping).first().qt_votos == 16
    with pytest.raises(CheckFailed, match="join rate"):
        guarded.region_votes(base, mapping)


def test_index(spark):
    kind = "cd_municipio_ibge string, logradouro string, bairro string, numero double, id_regiao bigint, n_enderecos bigint, n_domicilios bigint"
    good = [("11", "RUA Z", "B", 4.0, 1, 2, 2), ("11", "RUA Z", "B", 9.0, 2, 1, 1)]
    assert guarded.index(spark.createDataFrame(good, kind)).runs.count() == 2


def test_conversion(spark):
    line = ("00077", 3, 21, 8, 1, "2", 900, 0, 0, 11, 9, "1", 9, 62, 62, None)
    good = [(f"u{i}", *line) for i in range(5)]

    def run(rows):
        lines = ballots.report_lines(spark.createDataFrame(rows, schemas.BALLOT_ROWS))
        return guarded.conversion(lines, [11], "xx", 2028, "1", register(spark))

    assert [(r.qt_votos, r.nm_votavel) for r in run(good).collect()] == [(45, "UMA")]
    with pytest.raises(CheckFailed, match="rejection rate"):
        run([*good, ("w", *[None] * 15, "cut short")])
    with pytest.raises(CheckFailed, match="slice present"):
        run([])


def test_totals_need_no_job_of_their_own(spark, monkeypatch):
    """Guards on totals read the figures of the storing jobs."""
    mapping = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id_local_votacao string, id_regiao bigint")
    rows = [(k, "31", "62", "nominal", 8) for k in "a" * 9 + "b" * 10] + [("z", "-1", "95", "branco", 1)]
    with_party = votes(spark, *rows).selectExpr("*", "'P62' AS sg_partido")
    plain = sorted(map(tuple, votes_per_region(with_party, mapping).collect()))

    def refuse(*_):
        raise AssertionError("a guard ran a job")

    with monkeypatch.context() as patch:
        patch.setattr(type(with_party), "collect", refuse)
        party = guarded.party(votes(spark, *rows), register(spark))
        counted = guarded.region_votes(with_party, mapping)
        none = OBS.settle_observed(with_party.limit(0), n=F.count("*"), total=OBS.whole("qt_votos"))
    assert party.count() == 20 and sorted(map(tuple, counted.collect())) == plain
    assert none[1] == {"n": 0, "total": 0} and none[0].count() == 0


def test_a_place_of_two_regions_counts_once_in_the_rate(spark):
    mapping = spark.createDataFrame([("a", i) for i in range(40)], "id_local_votacao string, id_regiao bigint")
    base = votes(spark, *[(k, "31", "62", "nominal", 8) for k in "abb"]).selectExpr("*", "'P62' AS sg_partido")
    with pytest.raises(CheckFailed, match="1 of 3 matched"):
        guarded.region_votes(base, mapping)
    with pytest.raises(CheckFailed, match="0 of 0 matched"):
        guarded.region_votes(base.limit(0), mapping)


def test_watches_name_every_problem(spark):
    df = spark.createDataFrame([(1.5, None, 2), (float("nan"), "x", 3)], "a double, b string, n int")
    with pytest.raises(CheckFailed) as found:
        OBS.settle_watched(df, OBS.nothing_missing(df, ["a", "b", "n"], "t"), OBS.total_is(6, "n", "t"), OBS.total_is(5, "n", "u"))
    assert [line.strip() for line in str(found.value).split("\n")[1:]] == [
        "no missing [t]: 1 missing in a", "no missing [t]: 1 missing in b", "sum preserved [t]: before 6, after 5"]
