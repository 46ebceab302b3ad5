"""The street index stored for lookups: bucketed tables, short sorted pieces, block heads.

Everything that depends on the index alone is computed when it is stored: names without
accents, options of each locality, positions of runs. Runs lie in pieces of at most
`PIECE`; a street carries the first number of each of its pieces, so a house number
becomes a piece number and meets one row. Each table is bucketed and sorted by the key it
is asked by. A batch is reduced to distinct keys before every step: a small batch is sent
to the tables, a large one is shuffled to their buckets; the tables themselves are never
shuffled, and with few municipalities asked only their row groups are read.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshtally.functions import text
from meshtally.operators.ordered import ordinal
from meshtally.plans.resolve import ASK, candidates
from meshtally.plans.street_index import NUMBER_BLOCK, StreetIndex
from meshtally.schemas import STREET
from meshtally.session import run_dir, settle

PIECE = 128                  # runs of one row
BUCKET_ROWS = 1_000_000      # rows of a bucket, about
LEAST_BUCKETS = 8
SMALL_BATCH = 100_000        # distinct keys that are sent to every task; about 10 MB
FEW_TOWNS = 256              # municipality codes that become a filter of the scan

KEYS = {"nomes": ["cd_municipio_ibge", "nome"], "ruas": STREET, "locais": [*STREET, "nome_local"],
        "trechos": [*STREET, "pedaco"], "compativeis": [*STREET, "bairro", "pedaco"]}


@dataclass
class PreparedIndex:
    """Tables by name, each bucketed by KEYS."""

    nomes: DataFrame         # name without accents -> street
    ruas: DataFrame          # street: regions, answer without number, heads of its pieces
    locais: DataFrame        # street, locality without accents: options, heads of its pieces
    trechos: DataFrame       # street, piece: runs by number
    compativeis: DataFrame   # street, locality, piece: runs of the locality's regions by position
    baldes: dict[str, int]   # buckets of each table


def _pieces(rows: DataFrame, keys: list[str], at: Column, order: str, item: Column) -> DataFrame:
    """Rows as lists of at most PIECE items in order, `at` being their dense position."""
    return (rows.withColumn("pedaco", F.floor(at / PIECE).cast("bigint")).groupBy(*keys, "pedaco")
            .agg(F.array_sort(F.collect_list(item)).alias("itens"), F.min(order).alias("cabeca")))


def _heads(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """One number for each PIECE runs of a key."""
    return pieces.groupBy(*keys).agg(F.array_sort(F.collect_list("cabeca")).alias("cabecas"))


def prepared_tables(index: StreetIndex) -> dict[str, DataFrame]:
    """The five tables of an index, not stored yet."""
    streets = settle(index.streets)
    members = settle(candidates(index))
    loose = streets.groupBy("cd_municipio_ibge", text.unaccented(F.col("logradouro")).alias("nome")).agg(
        F.max("logradouro").alias("logradouro"))

    heads = members.groupBy(*STREET, "_local").agg(
        F.count("*").alias("n_opcoes"), F.min_by("id_regiao", F.struct(-F.col("peso"), F.col("id_regiao"))).alias("primeira"))
    ambiguous = streets.where("n_regioes > 1").select(*STREET)
    runs = ordinal(index.runs.join(ambiguous, STREET, "left_semi"), STREET, ["numero_inicial"],
                   F.floor(F.col("numero_inicial") / NUMBER_BLOCK), out="posicao")
    runs = settle(runs)
    by_number = settle(_pieces(runs, STREET, F.col("posicao"), "numero_inicial", F.struct("numero_inicial", "id_regiao", "posicao")))

    # Runs whose region a locality may have, numbered within the locality. A street as a whole
    # needs the list only if it has runs of regions that it doesn't offer.
    local = [*STREET, "bairro"]
    offered = members.select(*STREET, F.col("_local").alias("bairro"), "id_regiao")
    stray = runs.join(offered.where("bairro = ''"), [*STREET, "id_regiao"], "left_anti").select(*STREET).distinct()
    allowed = offered.where("bairro <> ''").unionByName(offered.where("bairro = ''").join(stray, STREET, "left_semi"))
    inside = ordinal(runs.join(allowed, [*STREET, "id_regiao"]), local, ["posicao"], F.floor(F.col("posicao") / NUMBER_BLOCK), out="_k")
    by_place = settle(_pieces(inside, local, F.col("_k"), "posicao", F.struct("posicao", "id_regiao")))
    place_heads = settle(_heads(by_place, local))
    whole = heads.where("_local = ''").drop("_local")
    several = F.col("n_regioes") > 1
    ruas = (streets.join(whole, STREET, "left").join(_heads(by_number, STREET), STREET, "left")
            .join(place_heads.where("bairro = ''").select(*STREET, F.col("cabecas").alias("cabecas_sem_bairro")), STREET, "left")
            .select(*STREET, "n_regioes", F.when(several, F.col("n_opcoes")).otherwise(1).cast("bigint").alias("n_opcoes"),
                    F.when(several, F.col("primeira")).otherwise(F.col("id_regiao_dominante")).alias("primeira"), "cabecas",
                    "cabecas_sem_bairro"))
    following = by_place.select(*local, (F.col("pedaco") - 1).alias("pedaco"), F.col("itens")[0].alias("proximo"))
    known = (index.street_localities.groupBy(*local).agg(F.sum("peso").alias("_p"))
             .groupBy(*STREET, text.unaccented(F.col("bairro")).alias("nome_local"))
             .agg(F.min_by("bairro", F.struct(-F.col("_p"), F.col("bairro"))).alias("bairro")))
    locais = known.join(heads.withColumnRenamed("_local", "bairro"), local, "left").join(place_heads, local, "left")
    return {"nomes": loose, "ruas": ruas, "locais": locais, "trechos": by_number.drop("cabeca"),
            "compativeis": by_place.drop("cabeca").join(following, [*local, "pedaco"], "left")}


def store_index(index: StreetIndex, folder: str | None = None) -> str:
    """Write the prepared tables below a folder that all executors reach; returns the folder.

    One file a bucket, sorted by the key. A folder that holds an index is refused.
    """
    spark = index.runs.sparkSession
    folder = folder or os.path.join(run_dir(spark), f"street-index-{uuid.uuid4().hex}")
    described = []
    for name, table in prepared_tables(index).items():
        table = settle(table)
        buckets = max(LEAST_BUCKETS, table.count() // BUCKET_ROWS + 1)
        catalog = f"prepared_{uuid.uuid4().hex}"
        (table.repartition(buckets, *KEYS[name]).write.bucketBy(buckets, *KEYS[name]).sortBy(*KEYS[name])
         .option("path", os.path.join(folder, name)).mode("error").saveAsTable(catalog))
        described.append((name, buckets, json.dumps(table.schema.jsonValue())))
    spark.createDataFrame(described, "nome string, baldes bigint, colunas string").coalesce(1).write.mode("error").json(
        os.path.join(folder, "descricao"))
    return folder


def open_index(spark: SparkSession, folder: str) -> PreparedIndex:
    """The tables of a stored index, in any session."""
    from pyspark.sql.types import StructType

    tables, buckets = {}, {}
    for r in spark.read.schema("nome string, baldes bigint, colunas string").json(os.path.join(folder, "descricao")).collect():  # five rows
        keys = ", ".join(KEYS[r.nome])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(r.colunas)))
        catalog = f"prepared_{uuid.uuid4().hex}"
        location = os.path.join(folder, r.nome).replace("'", "''")
        spark.sql(f"CREATE TABLE {catalog} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {r.baldes} BUCKETS "
                  f"LOCATION '{location}'")
        tables[r.nome], buckets[r.nome] = spark.table(catalog), r.baldes
    missing = set(KEYS) - set(tables)
    if missing:
        raise ValueError(f"no street index in {folder}: {sorted(missing)} missing")
    return PreparedIndex(**tables, baldes=buckets)


class _Lookup:
    """Asks tables with the distinct keys of a batch."""

    def __init__(self, index: PreparedIndex, small: bool, towns: list[str] | None):
        self.index, self.small, self.towns = index, small, towns

    def ask(self, batch: DataFrame, name: str) -> DataFrame:
        """Rows of the named table whose key the batch holds."""
        table, keys = getattr(self.index, name), KEYS[name]
        if self.towns is not None:
            table = table.where(F.col("cd_municipio_ibge").isin(self.towns))
        wanted = batch.select(*keys).dropna()
        if self.small:
            return table.join(F.broadcast(wanted.distinct()), keys)
        # In the table's own number of buckets, else Spark may shuffle the table to the batch.
        return table.hint("merge").join(wanted.repartition(self.index.baldes[name], *keys).distinct(), keys)


def _piece_of(heads: Column, at: Column) -> Column:
    """Number of the piece that holds a value; values below the first belong to the first."""
    return F.greatest(F.lit(0), F.size(F.filter(heads, lambda h: h <= at)) - 1).cast("bigint")


def _last(items: Column, test) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(-1))


def resolve_prepared(requests: DataFrame, index: PreparedIndex, small_batch: int = SMALL_BATCH, few_towns: int = FEW_TOWNS) -> DataFrame:
    """Requests as `resolve` answers them, from a stored index."""
    asked = (requests
             .withColumn("_numero", F.when(F.col("numero") > 0, F.col("numero").cast("bigint")).otherwise(F.lit(0).cast("bigint")))
             .withColumn("_bairro", F.coalesce("bairro", F.lit(""))))
    questions = settle(asked.select(*ASK).distinct())
    small = questions.limit(small_batch + 1).count() <= small_batch
    towns = [r[0] for r in questions.select("cd_municipio").dropna().distinct().limit(few_towns + 1).collect()]
    answers = _answers(questions, _Lookup(index, small, sorted(towns) if len(towns) <= few_towns else None))
    return asked.join(answers, ASK, "left").drop("_numero", "_bairro")


def _answers(questions: DataFrame, lookup: _Lookup) -> DataFrame:
    # The street: its exact name, else the name without accents.
    q = questions.withColumnRenamed("cd_municipio", "cd_municipio_ibge")
    exact = lookup.ask(q.withColumnRenamed("rua", "logradouro"), "ruas")
    q = settle(q.join(exact.withColumnRenamed("logradouro", "rua").withColumn("logradouro", F.col("rua")), ["cd_municipio_ibge", "rua"], "left"))
    columns = [c for c in exact.columns if c not in STREET]
    rest = q.where("logradouro IS NULL").select(*(c for c in ("cd_municipio_ibge", "rua", "_numero", "_bairro"))).withColumn(
        "nome", text.unaccented(F.col("rua")))
    named = rest.join(lookup.ask(rest, "nomes"), KEYS["nomes"]).drop("nome")
    named = named.join(lookup.ask(named, "ruas"), STREET)
    shown = ["cd_municipio_ibge", "rua", "_numero", "_bairro", "logradouro", *columns]
    q = q.where("logradouro IS NOT NULL").select(*shown).unionByName(named.select(*shown))

    # The locality, where the street has several regions.
    several = F.col("n_regioes") > 1
    q = q.withColumn("nome_local", F.when(several & (F.col("_bairro") != ""), text.unaccented(F.col("_bairro"))))
    local = lookup.ask(q, "locais").select(
        *KEYS["locais"], F.col("bairro").alias("_local"), F.col("n_opcoes").alias("_n"), F.col("primeira").alias("_first"),
        F.col("cabecas").alias("_heads"))
    q = q.join(local, KEYS["locais"], "left")
    at_local = F.col("_local").isNotNull()
    q = settle(q.withColumn("bairro_ignorado", F.col("nome_local").isNotNull() & ~at_local)
               .withColumn("n_opcoes", F.when(at_local, F.col("_n")).otherwise(F.col("n_opcoes")))
               .withColumn("primeira", F.when(at_local, F.col("_first")).otherwise(F.col("primeira")))
               .withColumn("_heads", F.when(at_local, F.col("_heads")).otherwise(F.col("cabecas_sem_bairro")))
               .withColumn("_local", F.coalesce("_local", F.lit(""))).drop("_n", "_first", "nome_local", "cabecas_sem_bairro"))

    # The run that holds the number: one piece, and the last run in it that starts no later.
    by_number = F.col("_numero") > 0
    open_ = q.where(several & (F.col("n_opcoes") > 1) & by_number).select(
        *STREET, "_numero", "_local", "_heads", _piece_of(F.col("cabecas"), F.col("_numero")).alias("pedaco")).dropDuplicates(
        [*STREET, "_numero", "_local"])
    held = open_.join(lookup.ask(open_, "trechos"), KEYS["trechos"])
    run = F.coalesce(_last(F.col("itens"), lambda t: t["numero_inicial"] <= F.col("_numero")), F.col("itens")[0])
    held = settle(held.select(*STREET, "_numero", "_local", "_heads", run.alias("run")))
    whole = held.where("_local = '' AND _heads IS NULL").select(
        *STREET, "_numero", "_local", F.col("run.id_regiao").alias("_run"), (F.col("run.numero_inicial") == F.col("_numero")).alias("_sharp"))

    # In a locality: the closest run of one of its regions; the left one wins a tie.
    near = held.where("_heads IS NOT NULL").select(*STREET, "_numero", F.col("_local").alias("bairro"), "run",
                                             _piece_of(F.col("_heads"), F.col("run.posicao")).alias("pedaco"))
    near = near.join(lookup.ask(near, "compativeis"), KEYS["compativeis"])
    here = F.col("run.posicao")
    left = _last(F.col("itens"), lambda t: t["posicao"] <= here)
    right = F.coalesce(F.try_element_at(F.filter("itens", lambda t: t["posicao"] > here), F.lit(1)), F.col("proximo"))
    near = near.select(*STREET, "_numero", F.col("bairro").alias("_local"), "run", left.alias("left"), right.alias("right"))
    pick = F.when(F.col("left").isNull(), F.col("right")).when(
        F.col("right").isNull() | (here - F.col("left.posicao") <= F.col("right.posicao") - here), F.col("left")).otherwise(F.col("right"))
    near = near.select(*STREET, "_numero", "_local", pick["id_regiao"].alias("_run"),
                       ((pick["posicao"] == here) & (F.col("run.numero_inicial") == F.col("_numero"))).alias("_sharp"))

    q = q.join(whole.unionByName(near), [*STREET, "_numero", "_local"], "left")
    settled, hit = F.col("n_opcoes") == 1, F.col("_run").isNotNull()
    return q.select(
        F.col("cd_municipio_ibge").alias("cd_municipio"), "rua", "_numero", "_bairro", "logradouro",
        F.when(~settled & hit, F.col("_run")).otherwise(F.col("primeira")).alias("id_regiao"),
        F.when(settled, "exata").when(hit & F.col("_sharp"), "exata").when(hit, "interpolada").otherwise("provavel").alias("confianca"),
        "n_opcoes", "n_regioes", "bairro_ignorado", (~settled & by_number & ~hit & (F.col("_local") != "")).alias("conflito_numero_bairro"),
        F.when(F.col("_local") != "", F.col("_local")).alias("bairro_usado"))
