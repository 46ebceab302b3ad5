"""Served tables as levels of runs: a batch writes what it changes, old runs are merged now and then.

A table is either a sum (signed deltas by key) or keyed rows (a key's newest rows replace
its older ones; a key without rows is marked gone). Each batch adds one run. `FAN` runs of
a level become one of the next, so after n batches a reader meets about FAN * log(n) runs,
and each row is rewritten log(n) times. A manifest names the live runs; it is written last
and moved into place at once, so a batch that fails or is repeated changes nothing served.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 4
BATCH, GONE = "_lote", "_fora"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class Levels:
    """The tables below a folder, as of a manifest."""

    def __init__(self, spark: SparkSession, folder: str, before: int | None = None, fan: int = FAN):
        """The newest state, or the one that batch `before` builds on."""
        self.spark, self.folder, self.fan = spark, folder.rstrip("/"), fan
        numbers = [n for n in self._manifests() if before is None or n < before]
        self.last = max(numbers, default=None)
        self.state: dict = {"tables": {}, "old": []}
        if self.last is not None:
            text = spark.read.text(f"{self.folder}/manifesto/{self.last:012d}.json", wholetext=True).first()[0]
            self.state = json.loads(text)

    def _manifests(self) -> list[int]:
        files, path = _file_system(self.spark, f"{self.folder}/manifesto")
        if not files.exists(path):
            return []
        return [int(f.getPath().getName()[:12]) for f in files.listStatus(path) if f.getPath().getName().endswith(".json")]

    @property
    def fresh(self) -> bool:
        return self.last is None

    def _write(self, name: str, df: DataFrame) -> str:
        path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def add_sums(self, name: str, keys: Sequence[str], value: str, rows: DataFrame) -> None:
        """A run of signed rows: keys and value."""
        spec = {"kind": "sum", "keys": list(keys), "value": value, "runs": []}
        table = self.state["tables"].setdefault(name, spec)
        self._run(table, name, rows.groupBy(*keys).agg(F.sum(value).alias(value)).where(F.col(value) != 0))

    def add_rows(self, name: str, keys: Sequence[str], batch: int, rows: DataFrame, touched: DataFrame | None = None) -> None:
        """A run of the newest rows of their keys; touched keys without rows are gone."""
        table = self.state["tables"].setdefault(name, {"kind": "rows", "keys": list(keys), "runs": []})
        new = rows.withColumn(GONE, F.lit(False)).withColumn(BATCH, F.lit(batch).cast("bigint"))
        self._run(table, name, new)
        if touched is not None:
            path = table["runs"][-1]["path"]
            there = self.spark.read.schema(new.schema).parquet(path)  # once written, not computed again
            gone = touched.select(*keys).distinct().join(there.select(*keys).distinct(), list(keys), "left_anti")
            marked = gone.withColumn(GONE, F.lit(True)).withColumn(BATCH, F.lit(batch).cast("bigint"))
            there.limit(0).unionByName(marked, allowMissingColumns=True).write.mode("append").parquet(path)

    def _run(self, table: dict, name: str, rows: DataFrame) -> None:
        table["runs"].append({"path": self._write(name, rows), "level": 0})

    def _merged(self, table: dict, runs: list[dict]) -> DataFrame:
        frames = [self.spark.read.parquet(r["path"]) for r in runs]
        rows = frames[0]
        for f in frames[1:]:
            rows = rows.unionByName(f)
        keys = table["keys"]
        if table["kind"] == "sum":
            value = table["value"]
            return rows.groupBy(*keys).agg(F.sum(value).alias(value)).where(F.col(value) != 0)
        if len(frames) == 1:
            return rows
        newest = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(BATCH).alias("_newest"))
        same = F.col(BATCH) == F.col("_newest")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return rows.join(newest, same, "left_semi")

    def read(self, name: str) -> DataFrame:
        """The table as it stands, runs of this batch included."""
        table = self.state["tables"][name]
        rows = self._merged(table, table["runs"])
        return rows if table["kind"] == "sum" else rows.where(~F.col(GONE)).drop(GONE, BATCH)

    def commit(self, batch: int) -> None:
        """Merge full levels, then publish the batch's state."""
        drop, self.state["old"] = self.state["old"], []
        for name, table in self.state["tables"].items():
            runs = table["runs"]
            while len(runs) >= self.fan and len({r["level"] for r in runs[-self.fan:]}) == 1:
                last, rest = runs[-self.fan:], runs[:-self.fan]
                merged = self._merged(table, last)
                if table["kind"] == "rows" and not rest:
                    merged = merged.where(~F.col(GONE))  # nothing older is left to hide
                runs[:] = [*rest, {"path": self._write(name, merged), "level": last[0]["level"] + 1}]
                self.state["old"] += [r["path"] for r in last]
        files, place = _file_system(self.spark, f"{self.folder}/manifesto/{batch:012d}.json")
        _, draft = _file_system(self.spark, f"{self.folder}/manifesto/.{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()
        files.delete(place, False)  # of an earlier try of this batch
        files.rename(draft, place)
        # Runs merged a batch ago: readers of the last manifest don't name them any more.
        for path in drop:
            self._delete(path)
        for n in self._manifests():
            if n < batch - 1:
                self._delete(f"{self.folder}/manifesto/{n:012d}.json")
        self.last = batch

    def _delete(self, path: str) -> None:
        files, p = _file_system(self.spark, path)
        files.delete(p, True)
