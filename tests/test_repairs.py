"""Rows and values that must not be lost or invented."""

import pytest

from meshtally.operators import places
from meshtally.operators.guards import CheckFailed
from meshtally.operators.nearest import nearest_in_group
from meshtally.plans import live, reconcile
from meshtally.sources.tables import replace_slice


def test_a_place_takes_both_coordinates_from_one_section(spark):
    points = [(-10.0, -60.0), (-12.0, -50.0), (-9.0, -70.0)]
    rows = [("p", 2022, "1", "X", "1", "N", 1, 2, "L", "E", *p) for p in points]
    df = spark.createDataFrame(rows, "id_local_votacao string, ano_eleicao int, turno string, sg_uf string, cd_municipio_tse string, "
                                     "nm_municipio string, nr_zona int, nr_local int, nm_local_votacao string, ds_endereco string, "
                                     "latitude double, longitude double")
    (r,) = places.latest_places(df).collect()
    assert (r.latitude, r.longitude) in points


def test_overlay_keeps_rows_without_an_office(spark):
    schema = "regiao int, cargo string, nome string, votos bigint"
    out = live.overlay(spark.createDataFrame([], schema), spark.createDataFrame([(1, None, "a", 5), (1, "deputado_federal", "b", 2)], schema),
                       ["regiao", "cargo"])
    assert sorted(r.nome for r in out.collect()) == ["a", "b"]


def test_a_territory_missing_on_our_side_is_wrong(spark):
    schema = "uf string, comparecimento bigint, validos bigint, brancos bigint, nulos bigint"
    ours = spark.createDataFrame([("A", 10, 8, 1, 1)], schema)
    theirs = spark.createDataFrame([("A", 10, 8, 1, 1), ("B", 5, 5, 0, 0)], schema)
    marks = {(r.uf, r.marca) for r in reconcile.compare_totals(ours, theirs, ["uf"]).collect()}
    assert marks == {("A", " "), ("B", "x")}


def test_nearest_with_an_empty_side_and_nan(spark):
    targets = spark.createDataFrame([("g", float(i), float(i % 7), i) for i in range(300)], "g string, x double, y double, id int")
    none = spark.createDataFrame([], "g string, a double, b double")
    assert nearest_in_group(none, targets, ["g"], ("a", "b"), ("x", "y"), "id").count() == 0
    some = spark.createDataFrame([("g", 5.1, 5.0), ("g", float("nan"), 1.0), ("h", 1.0, 1.0)], "g string, a double, b double")
    got = sorted(((r.a, r.id) for r in nearest_in_group(some, targets, ["g"], ("a", "b"), ("x", "y"), "id").collect()), key=str)
    assert [i for _, i in got] == [None, 5, None]


def test_a_slice_of_other_types_is_refused(spark, tmp_path):
    path = str(tmp_path / "base")
    replace_slice(spark.createDataFrame([(2022, "1", 5)], "ano_eleicao int, turno string, qt_votos bigint"), path)
    with pytest.raises(CheckFailed):
        replace_slice(spark.createDataFrame([(2026, "1", "5")], "ano_eleicao int, turno string, qt_votos string"), path)
    assert spark.read.parquet(path).count() == 1


def test_sections_of_two_rounds_stay_apart(spark):
    mapped = spark.createDataFrame([("c", "ro", "m", 1, 1, 1, s, t) for s in range(5) for t in ("1", "2")],
                                   "cd_municipio_ibge string, uf string, cd_municipio_tse string, id_regiao int, nr_zona int, "
                                   "nr_local int, nr_secao int, turno string")
    parts = live.section_lists(mapped, ["turno"], size=2).collect()
    assert sorted((r.turno, r.parte, [x[2] for x in r.secoes]) for r in parts) == [
        (t, p, s) for t in ("1", "2") for p, s in enumerate([[0, 1], [2, 3], [4]])]
    rows = spark.createDataFrame([("m", 1, 1, 0, "1"), ("m", 1, 1, 1, "1"), ("m", 1, 1, 0, "2")],
                                 "municipio string, zona int, local int, secao int, turno string")
    placed = live.live_votes(rows, mapped, ["turno"])
    got = {r.turno: (r.esperadas, r.urnas, r.situacao) for r in live.live_progress(placed, mapped, ["turno"]).collect()}
    assert got == {"1": (5, 2, "parcial"), "2": (5, 1, "parcial")}
