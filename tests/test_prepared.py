"""The stored street index answers like the plain one, without shuffling its tables."""

import random

import pytest

from meshtally.plans import prepared as P
from meshtally.plans import resolve as R
from meshtally.plans import street_index as SI

COUNTS = "cd_municipio_ibge string, logradouro string, bairro string, numero bigint, id_regiao bigint, n_enderecos bigint, n_domicilios bigint"
ASKED = "id bigint, cd_municipio string, rua string, numero bigint, bairro string"


def some_counts(rng):
    rows = []
    for town in ("5001", "5002", "6001"):
        for street in ("AVENIDA IPÊ", "AVENIDA IPE", "BECO Ñ", "LARGO", "TRAVESSA 1", "TRAVESSA 2"):
            spread = rng.choice([1, 1, 3, 6])
            for _ in range(rng.randint(1, 90)):
                rows.append((town, street, rng.choice(["", None, "PORTO", "PÔRTO", "SERRA", "VALE"]), rng.choice([None, 0, rng.randint(1, 4000)]),
                             rng.randint(1, spread), rng.randint(1, 5), rng.randint(0, 3)))
    return rows


def some_requests(rng):
    names = ["AVENIDA IPÊ", "avenida ipe", "Beco ñ", "LARGO", "largo ", "TRAVESSA 1", "travessa 2", "RUA NENHUMA", None]
    return [(i, rng.choice(["5001", "5002", "6001", "9999", None]), rng.choice(names), rng.choice([None, 0, -3, rng.randint(1, 4200)]),
             rng.choice([None, "", "porto", "Serra", "vale", "LONGE"])) for i in range(600)]


@pytest.fixture(scope="module")
def indexes(spark):
    counts = spark.createDataFrame(some_counts(random.Random(3)), COUNTS)
    return SI.build_index(counts)


@pytest.mark.parametrize("piece,small,towns", [(128, 100_000, 256), (3, 0, 0), (1, 100_000, 2)])
def test_prepared_answers_equal_the_plain_ones(spark, indexes, monkeypatch, piece, small, towns):
    monkeypatch.setattr(P, "PIECE", piece)
    asked = spark.createDataFrame(some_requests(random.Random(piece)), ASKED)
    stored = P.open_index(spark, P.store_index(indexes))
    want = R.resolve(asked, indexes)
    got = P.resolve_prepared(asked, stored, small_batch=small, few_towns=towns).select(*want.columns)
    key = lambda r: r["id"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[want.columns.index("id")]) == [tuple(r) for r in sorted(want.collect(), key=key)]
    kinds = {r.confianca for r in got.collect()}
    assert kinds == {"exata", "interpolada", "provavel", None}


def test_runs_of_regions_that_a_street_does_not_offer(spark):
    from tests.test_resolve import index_of
    index = index_of(spark, {"RUA X": dict(trechos=[[1, 7], [100, 8], [200, 9]], regioes=[[7, .6], [9, .4]])})
    asked = spark.createDataFrame([(i, "1", "RUA X", n, None) for i, n in enumerate([1, 120, 100, 200, 900])], ASKED)
    got = P.resolve_prepared(asked, P.open_index(spark, P.store_index(index)))
    want = R.resolve(asked, index).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_empty_index_and_batch(spark, indexes):
    stored = P.open_index(spark, P.store_index(indexes))
    assert P.resolve_prepared(spark.createDataFrame([], ASKED), stored).count() == 0
    nothing = P.open_index(spark, P.store_index(SI.build_index(spark.createDataFrame([], COUNTS))))
    asked = spark.createDataFrame([(1, "5001", "LARGO", 3, None)], ASKED)
    assert [r.id_regiao for r in P.resolve_prepared(asked, nothing).collect()] == [None]


def test_an_index_is_not_overwritten_and_must_be_whole(spark, indexes, tmp_path):
    folder = P.store_index(indexes, f"{tmp_path}/index")
    with pytest.raises(Exception, match="(?i)exist"):
        P.store_index(indexes, folder)
    spark.createDataFrame([], "nome string, baldes bigint, colunas string").write.json(f"{tmp_path}/none/descricao")
    with pytest.raises(ValueError, match="missing"):
        P.open_index(spark, f"{tmp_path}/none")


def ancestors_of_scans(plan):
    """For each table scan, the nodes between it and the next join above."""
    lines = [(len(x) - len(x.lstrip(" +-:*")), x.strip(" +-:*")) for x in plan.splitlines() if x.strip()]
    for k, (depth, line) in enumerate(lines):
        if "Bucketed" in line:
            above = []
            for d, other in reversed(lines[:k]):
                if d < depth:
                    depth = d
                    above.append(other)
                    if "Join" in other:
                        break
            yield above


@pytest.mark.parametrize("small", [True, False])
def test_no_table_of_the_index_is_shuffled(spark, indexes, small):
    stored = P.open_index(spark, P.store_index(indexes))
    batch = spark.createDataFrame([("5001", "LARGO", "LARGO", "SERRA", "SERRA", i) for i in range(10)],
                                  "cd_municipio_ibge string, logradouro string, nome string, nome_local string, bairro string, pedaco bigint")
    for name in P.KEYS:
        found = P._Lookup(stored, small, ["5001"] if small else None).ask(batch, name)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = list(ancestors_of_scans(plan))
        assert scans and not any("Exchange" in node for above in scans for node in above), plan
        assert not small or "PushedFilters: [" in plan and "cd_municipio_ibge" in plan.split("PushedFilters: [")[1].split("]")[0]
