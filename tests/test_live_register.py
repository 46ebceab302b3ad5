"""Live results straight from the register: as over the section map, which is not built."""

from meshtally.plans import live
from meshtally.registry import live_queries
from test_against_sql import agree


def test_the_register_gives_what_its_map_gives(spark):
    places = [("RO_00001_1_10", 1), ("RO_00001_1_11", 1), ("ro_00001_1_11", 1), ("ro_00001_1_12", 2), ("AM_00001_1_11", 3), ("RO_00001_1_13", 9)]
    mapping = spark.createDataFrame(places + places[:1], "id_local_votacao string, id_regiao bigint")
    regions = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id_regiao bigint, cd_municipio_ibge string")
    register = [(f"{uf}_00001_1_{local}", uf, "00001", 1, local, n, turn) for uf in ("RO", "ro", "AM") for local in range(10, 15)
                for n in range(4) for turn in ("1", "2") if (uf, n, turn) != ("RO", 3, "2")]
    sections = spark.createDataFrame(register + register[:30], "id_local_votacao string, sg_uf string, cd_municipio_tse string, nr_zona int, "
                                                               "nr_local int, nr_secao int, turno string")
    principal = spark.createDataFrame([("00001", 1, n) for n in (1, 2, 3, 3)], "cd_municipio_tse string, nr_zona int, nr_secao int")
    lines = [("00001", 1, local, n, turn, q) for local in (10, 11, 12, 13, 15, None) for n in range(5) for turn in ("1", "2", None) for q in (5, 5, 7)]
    rows = spark.createDataFrame(lines, "municipio string, zona int, local int, secao int, turno string, quantidade bigint")
    for counted in (principal, None):
        over_map = live.live_votes(rows, live.section_map(sections, mapping, regions, counted, ["turno"]), ["turno"])
        straight = live.register_votes(rows, sections, mapping, regions, counted, ["turno"])
        want = sorted(tuple(r) for r in over_map.select(straight.columns).collect())
        assert want and sorted(tuple(r) for r in straight.collect()) == want


def test_live_results_store_nothing_of_the_register(spark, tmp_path, monkeypatch):
    stored, settle = [], live_queries.settle
    for module in (live, live_queries):
        monkeypatch.setattr(module, "settle", lambda df: stored.append(df.columns) or settle(df), raising=False)
    nation = spark.sql("SELECT CAST(n AS INT) AS n_nationkey, CONCAT('N', n) AS n_name, CAST(n % 5 AS INT) AS n_regionkey FROM VALUES 1, 2 AS t(n)")
    supplier = spark.range(12).selectExpr("id AS s_suppkey", "CAST(id % 2 + 1 AS INT) AS s_nationkey")
    lineitem = spark.range(3000).selectExpr("id DIV 3 AS l_orderkey", "id * 7 AS l_partkey", "id % 13 AS l_suppkey", "CAST(id % 3 AS INT) AS l_linenumber",
                                            "CAST(id % 50 AS DOUBLE) AS l_quantity", "IF(id % 4 = 0, 'O', 'F') AS l_linestatus")
    assert agree(spark, tmp_path, "live_results", nation=nation, supplier=supplier, lineitem=lineitem.unionAll(lineitem))
    assert stored and not [columns for columns in stored if {"nr_secao", "nr_local"} <= set(columns)]
