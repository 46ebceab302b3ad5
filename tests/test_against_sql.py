"""Queries and their check SQL on tables that the small given ones don't resemble."""

import duckdb

from meshtally.operators import votes as V
from meshtally.registry import registered


def agree(spark, folder, name, **tables):
    """Rows of a query, which are those of its SQL over the same tables."""
    for table, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    base = duckdb.connect()
    for table in tables:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    query = registered()[name]
    got = query(spark, str(folder))
    want = base.execute(query.sql)
    names = [c[0] for c in want.description]
    assert got.columns == names
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(want.fetchall())
    return rows


def test_region_rules_of_keys_beyond_the_format(spark, tmp_path):
    # Numbers of five and of six digits; the format takes no more than five.
    customer = spark.range(99_900, 100_200).selectExpr("id AS c_custkey", "CAST(id % 2 AS INT) AS c_nationkey")
    orders = spark.range(99_900, 100_200).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus")
    rows = agree(spark, tmp_path, "region_rules", customer=customer, orders=orders)
    assert dict((r[0], r[2]) for r in rows)["key format"] > 190


def test_search_places_of_one_address(spark, tmp_path):
    # 20 of 60 places on the same address, the smallest keys last in the file.
    supplier = spark.range(60).selectExpr("10 + 195000 * (60 - id) AS s_suppkey", "CAST(0 AS INT) AS s_nationkey").coalesce(1)
    nation = spark.sql("SELECT CAST(0 AS INT) AS n_nationkey, 'N' AS n_name, CAST(0 AS INT) AS n_regionkey")
    rows = agree(spark, tmp_path, "search_places", supplier=supplier, nation=nation)
    assert [r[0] for r in rows] == [10 + 195000 * k for k in range(1, 21)]


def test_country_votes_never_meet_by_year(spark):
    """All votes of a year in one task is what a shuffle by the year would give."""
    columns = "id_local_votacao string, ano_eleicao int, turno string, cargo string, nm_votavel string, sg_partido string, tipo_voto string, qt_votos bigint"
    votes = spark.createDataFrame([("a", y, "1", "X", "N", "P", "nominal", 1) for y in (2018, 2022, 2026)], columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = V.country_votes(V.national_totals(votes.where("ano_eleicao < 2026")), votes)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.ano_eleicao for r in out.collect()) == [2018, 2022, 2026]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [line for line in plan.splitlines() if "LeftAnti" in line and "BroadcastHashJoin" in line]
