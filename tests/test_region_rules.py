"""Composed rules of region results, and the round that must exist."""

import pytest

from meshtally.operators import guards as G
from meshtally.operators import places as P
from meshtally.plans import validate as VAL


def test_region_rules_compose(spark):
    regions = spark.createDataFrame([("7", "3-12"), ("7", "3-13"), ("8", "3-12")], "cd_municipio_ibge string, id_publico string")
    cand = spark.createDataFrame([(1, "A", 3, 75.0), (1, "B", 1, 25.0)], "onde int, nome string, votos bigint, pct double")
    away = spark.createDataFrame([(1, 9, 2), (2, 9, None)], "onde int, qt_eleitores bigint, abstencao bigint")
    G.enforce(VAL.region_problems(regions, cand, away, ["onde"]))
    wrong = VAL.region_problems(regions.union(regions.limit(1)).union(spark.createDataFrame([("8", "a1")], regions.schema)),
                                cand.withColumn("pct", cand.pct + 1), away.withColumn("abstencao", away.qt_eleitores + 1), ["onde"])
    assert {r.check for r in wrong.collect()} == {"key format", "unique key", "percent", "abstention"}
    open_ = VAL.region_problems(regions, cand.where("nome = 'A'"), away, ["onde"], closes=cand.votos > 99)
    assert open_.count() == 0  # shares that needn't close


def test_one_round_must_have_sections(spark):
    sections = spark.createDataFrame([("1", 5)], "turno string, secao int")
    assert P.one_round(sections, "1").count() == 1
    with pytest.raises(G.CheckFailed):
        P.one_round(sections, "2")
