"""Reconciliation at country, state and municipality: residuals, missing sides, no null details."""

import pytest

from meshtally.plans import reconcile as REC

VOTES = "ano_eleicao int, turno string, cargo string, sg_uf string, cd_municipio string, tipo_voto string, nr_votavel string, qt_votos bigint"
BOTH = {("XA", "1"): 400, ("XA", "2"): 300, ("XB", "7"): 500}


def votes_of(towns, turn="1"):
    rows = []
    for (uf, town), n in towns.items():
        rows += [(2022, turn, "PREFEITO", uf, town, "nominal", "21", n), (2022, turn, "PREFEITO", uf, town, "branco", "95", 9)]
    return rows


def official(spark, rows):
    """Totals and votables as published at each level."""
    df = spark.createDataFrame(rows, VOTES)
    flat = df.selectExpr("*", "qt_votos AS comparecimento", "IF(tipo_voto = 'nominal', qt_votos, 0L) AS validos",
                         "IF(tipo_voto = 'branco', qt_votos, 0L) AS brancos", "0L AS nulos")
    totals = REC.by_level(flat, [], REC.TOTALS).selectExpr("*", "CAST(array() AS array<string>) AS avisos")
    names = REC.by_level(df.where("tipo_voto = 'nominal'").withColumnRenamed("qt_votos", "votos"), ["tipo_voto", "nr_votavel"], ["votos"])
    return totals, names.selectExpr("*", "'X' AS nome")


def details(problems):
    return sorted(r.detail for r in problems.collect())


def test_a_shortage_is_reported_where_it_is(spark):
    totals, names = official(spark, votes_of(BOTH))
    mine = spark.createDataFrame(votes_of({("XA", "1"): 400, ("XA", "2"): 250, ("XB", "7"): 500}), VOTES)
    problems, compared, _ = REC.reconcile_levels(mine, totals, names)
    found = details(problems)
    assert "XA/2 2022/1/PREFEITO: short of 50 votes" in found
    assert not [d for d in found if "short" in d and not d.startswith("XA/2 ")]  # explained below
    assert {(r.nivel, r.sg_uf) for r in compared.where("explicada").collect()} == {(0, ""), (1, "XA")}
    assert {r.marca for r in compared.where("total = 'validos' AND sg_uf = 'XA' AND cd_municipio IN ('', '2')").collect()} == {"~"}


@pytest.mark.parametrize("gone", [("XA", "2"), ("XB", "7")])
def test_a_territory_missing_on_our_side_is_short_of_all(spark, gone):
    totals, names = official(spark, votes_of(BOTH))
    mine = spark.createDataFrame(votes_of({k: n for k, n in BOTH.items() if k != gone}), VOTES)
    problems, compared, _ = REC.reconcile_levels(mine, totals, names)
    found = details(problems)
    assert None not in found
    assert f"{gone[0]}/{gone[1]} 2022/1/PREFEITO: short of {BOTH[gone] + 9} votes" in found
    rows = compared.where(f"cd_municipio = '{gone[1]}'").collect()
    assert {r.marca for r in rows} == {"x"} and all(r.diferenca == -r.oficial for r in rows)


def test_a_territory_missing_on_the_official_side(spark):
    totals, names = official(spark, votes_of(BOTH))
    problems, _, _ = REC.reconcile_levels(spark.createDataFrame(votes_of(BOTH), VOTES), totals.where("cd_municipio <> '7'"), names)
    assert details(problems) == ["XB/7 2022/1/PREFEITO: nothing to compare with"]


def test_rounds_are_compared_apart_and_official_levels_must_agree(spark):
    rows = votes_of(BOTH) + votes_of(BOTH, "2")
    totals, names = official(spark, rows)
    problems, _, _ = REC.reconcile_levels(spark.createDataFrame(rows, VOTES), totals, names)
    assert details(problems) == []
    raised = totals.selectExpr(*[c if c != "nulos" else "IF(nivel = 0 AND turno = '2', 4L, nulos) AS nulos" for c in totals.columns])
    problems, _, _ = REC.reconcile_levels(spark.createDataFrame(rows, VOTES), raised, names)
    assert details(problems) == ["BR 2022/2/PREFEITO: nulos 4 x 0", "BR 2022/2/PREFEITO: nulos differs by -4"]


def test_one_level_has_no_null_details_either(spark):
    mine = spark.createDataFrame([("A", "nominal", "21", 5)], "uf string, tipo_voto string, nr_votavel string, qt_votos bigint")
    totals = spark.createDataFrame([("A", 5, 5, 0, 0, []), ("B", 8, 6, 1, 1, [])],
                                   "uf string, comparecimento long, validos long, brancos long, nulos long, avisos array<string>")
    names = spark.createDataFrame([("A", "nominal", "21", "X", 5)], "uf string, tipo_voto string, nr_votavel string, nome string, votos bigint")
    problems, _, _ = REC.reconcile(mine, totals, names, ["uf"])
    assert details(problems) == ["B: brancos differs by -1", "B: comparecimento differs by -8", "B: nulos differs by -1", "B: short of 8 votes",
                                 "B: validos differs by -6"]
