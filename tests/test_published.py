"""Versions of published documents."""

import json

import pytest
from pyspark.sql import functions as F

from meshtally.sources import published as P
from meshtally.sources.documents import publish_diff

KIND = "cd string, nome string, peso double"
FIRST = [("11001", "a", 1.0), ("11001", "b", 2.5), ("11/02 é", "c", 3.0)]


def read(spark, path, asked=None):
    return sorted((r.cd, json.loads(r.value)["nome"]) for r in P.read_published(spark, path, "cd", asked).collect())


def test_versions_swap_at_once(spark, tmp_path):
    path = str(tmp_path / "site")
    with pytest.raises(FileNotFoundError):
        P.published_files(spark, path)
    P.publish(spark.createDataFrame(FIRST, KIND), path, "cd")
    assert read(spark, path) == sorted((c, n) for c, n, _ in FIRST)
    before = P.published_files(spark, path).collect()
    # One bad row of many: tasks that succeeded have put their files, but the version stays.
    bad = spark.createDataFrame([(str(i), "x", 1.0) for i in range(50)] + [("7", "y", float("nan"))], KIND)
    with pytest.raises(Exception, match="NaN"):
        P.publish(bad.repartition(8), path, "cd")
    assert read(spark, path) == sorted((c, n) for c, n, _ in FIRST)
    assert P.published_files(spark, path).collect() == before
    # Another second version: one folder the same, one changed, one new.
    P.publish(spark.createDataFrame([*FIRST[:2], ("11/02 é", "d", 3.0), ("3", "e", 1.0)], KIND), path, "cd")
    assert read(spark, path) == [("11/02 é", "d"), ("11001", "a"), ("11001", "b"), ("3", "e")]
    old = spark.createDataFrame(before, P.LISTED)
    diff = {r.arquivo.split("/")[0]: r.situacao for r in publish_diff(P.published_files(spark, path), old).collect()}
    assert diff == {"cd=11001": "igual", "cd=11~2F02+~C3~A9": "novo", "cd=3": "novo"}


def test_append_and_empty(spark, tmp_path):
    path = str(tmp_path / "site")
    df = spark.createDataFrame(FIRST, KIND)
    P.publish(df.limit(0), path, "cd")
    assert read(spark, path) == []
    P.publish(df, path, "cd", mode="append")
    P.publish(spark.createDataFrame([("11001", "z", 1.0)], KIND), path, "cd", mode="append")
    assert read(spark, path) == sorted([*((c, n) for c, n, _ in FIRST), ("11001", "z")])
    with pytest.raises(Exception, match="without a key"):
        P.publish(spark.createDataFrame([(None, "z", 1.0)], KIND), path, "cd")


def test_large_folders_have_several_files(spark, tmp_path):
    path = str(tmp_path / "site")
    rows = spark.range(3000).select(F.lit("k").alias("cd"), F.repeat(F.lit("nome"), 1000).alias("nome"), F.col("id").cast("double").alias("peso"))
    P.publish(rows, path, "cd")
    files = P.published_files(spark, path).collect()
    assert len(files) > 2 and max(f.bytes for f in files) <= P.FILE_BYTES and sum(f.documentos for f in files) == 3000
    assert P.read_published(spark, path, "cd").count() == 3000


def test_asked_keys_prune_folders(spark, tmp_path):
    path = str(tmp_path / "site")
    P.publish(spark.range(200).select(F.col("id").cast("string").alias("cd"), F.lit("n").alias("nome")), path, "cd")
    asked = spark.createDataFrame([("7",), ("7",), ("199",), ("none",), (None,)], "cd string")
    got = P.read_published(spark, path, "cd", asked)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.cd for r in got.collect()) == ["199", "7"]


def test_folder_names_agree(spark):
    keys = ["a b", "*~%", "é/ü", "x=y:z?", "+-_.", "日本"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(P._folder_column(F.col("k"))).collect()
    assert [r[0] for r in got] == [P._folder(k) for k in keys]
