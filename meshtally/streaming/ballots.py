"""Ballots as a stream: new reports, retransmissions, running results, progress.

A section may transmit again. Keyed state keeps the valid transmission of each
section, and a replacement comes out as a pair of signed rows: minus the old one,
plus the new one. Everything downstream is then a plain sum of small deltas, kept in
levels (`levels.py`), so a micro-batch costs what it brings and the regions it touches,
never the whole election.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

from meshtally.constants import OFFICES
from meshtally.functions.text import office_slug
from meshtally.plans import live
from meshtally.streaming.levels import Levels

LINES = ("array<struct<cargo:int,tipo:string,quantidade:bigint,partido:bigint,numero:bigint>>")
REPORT = f"municipio string, zona int, secao int, local int, situacao string, ordem bigint, votos {LINES}"


def arriving(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
             glob: str = "*", per_batch: int | None = None) -> DataFrame:
    """Stream of files appearing in a folder; each file is picked up exactly once."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def run_pass(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None],
             mode: str = "append") -> StreamingQuery:
    """One collection pass: everything new since the last pass, then stop.

    The checkpoint remembers what was read, so a pass can be repeated or resumed.
    """
    q = (stream.writeStream.foreachBatch(each).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def once_per_section(stream: DataFrame, keys: Sequence[str], at: str, delay: str = "2 days") -> DataFrame:
    """First report of a section within the watermark; repeats are dropped."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def running_totals(stream: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Running sum per key, for input that never retransmits (update or complete mode)."""
    return stream.groupBy(*keys).agg(F.count("*").alias("linhas"), F.sum(value).alias("soma"))


def running_valid(stream: DataFrame, keys: Sequence[str], payload: Sequence[str], order: str) -> DataFrame:
    """Running valid transmission per section: the last totalized, else the last received."""
    final = F.coalesce(F.lower("situacao").startswith("totaliz"), F.lit(False))
    return stream.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(final, F.col(order))).alias("_t")).select(*keys, "_t.*")


def arrival_rate(stream: DataFrame, at: str, window: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Reports per time window."""
    return (stream.withWatermark(at, delay).groupBy(F.window(at, window)).agg(F.count("*").alias("boletins"))
            .select(F.col("window.start").alias("inicio"), F.col("window.end").alias("fim"), "boletins"))


_KEYS = live.SECTION
_OUT = f"municipio string, zona int, secao int, local int, situacao string, sinal int, votos {LINES}"
_SIGNED = Row(*(c.split()[0] for c in _OUT.split(", ")))
_STATE = f"final boolean, ordem bigint, local int, situacao string, votos {LINES}, fechada boolean"
_LINE = [f.split(":")[0] for f in LINES[len("array<struct<"):-2].split(",")]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSE_MS = 30 * 24 * 3600 * 1000


def _lines(votes: list) -> list[tuple]:
    """Vote lines as plain tuples, which the state takes."""
    return [tuple(line[f] for f in _LINE) for line in votes]


class ValidTransmission(StatefulProcessor):
    """State of one section: its valid transmission, typed, or the mark that it is closed.

    Some time after a section was totalized (by the time of arrival), a timer drops its vote lines and keeps the
    mark: reports that come later are not counted. So state doesn't outlast an election.

    Each call of the state goes to the JVM and back, so a section without news costs one, and one with news two,
    and a third for the timer of a totalized one. Rows come and go as rows: a frame for each section costs more than its work.
    """

    def __init__(self, close_ms: int):
        self.close_ms = close_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.valid = handle.getValueState("valid", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        best, rank, last = None, None, 0
        for row in rows:  # one section's reports of one batch, never held together
            at = ((row["situacao"] or "").lower().startswith("totaliz"), row["ordem"])
            if rank is None or at > rank:
                best, rank = row, at
            last = max(last, row["recebido_ms"])
        old = self.valid.get()
        if old is not None and (old[5] or rank <= tuple(old[:2])):
            return
        new = (*rank, best["local"], best["situacao"], _lines(best["votos"]))
        self.valid.update((*new, False))
        if new[0]:
            if old is not None and old[0]:  # only a totalized section has a timer
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
            self.handle.registerTimer(last + self.close_ms)
        if old is not None:
            yield _SIGNED(*key, old[2], old[3], -1, [dict(zip(_LINE, line)) for line in old[4]])
        yield _SIGNED(*key, new[2], new[3], 1, [dict(zip(_LINE, line)) for line in new[4]])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        old = self.valid.get()
        if old is not None:
            self.valid.update((*old[:4], [], True))
        return iter(())

    def close(self) -> None:
        pass


def corrections(stream: DataFrame, close_ms: int = CLOSE_MS) -> DataFrame:
    """Reports (schema REPORT) to signed section rows: a retransmission takes back the
    section's earlier row. Rows carry their vote lines in `votos`.

    Keyed state needs the RocksDB provider, which this sets for the session's streams. Time
    is that of arrival: timers of processing time would keep a collection pass from ending.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    timed = stream.select(*_KEYS, "local", "situacao", "ordem", "votos", F.current_timestamp().alias("recebido")).withColumn(
        "recebido_ms", F.unix_millis("recebido"))
    return (timed.withWatermark("recebido", "0 seconds").groupBy(*_KEYS)
            .transformWithState(ValidTransmission(close_ms), _OUT, "append", "eventTime"))


def latest(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A served table after the newest finished batch, even when it is empty by then."""
    return Levels(spark, folder).read(name)


def live_step(folder: str, mapped: DataFrame, limits: DataFrame, candidates: DataFrame | None = None,
              published: DataFrame | None = None, year: int | None = None,
              round_: str = "1") -> Callable[[DataFrame, int], None]:
    """Micro-batch step over `corrections`: add deltas, then serve the regions that they touch.

    `mapped` is the section map; `limits` (cd_municipio_ibge, nome, limite) withholds
    a region in which a name exceeds the official count of its municipality. With
    `published` (id_regiao, cargo, ano_eleicao, turno, nome, votos), `servido` holds the
    published contests plus the live ones of `year` and `round_` where they are missing.

    A batch reads what it brings, and of the stored sums only the regions touched.
    """
    folder = folder.rstrip("/")

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        tables = Levels(spark, folder, before=number)
        at = mapped.select(F.col("cd_municipio_tse").alias("municipio"), F.col("nr_zona").alias("zona"),
                           F.col("nr_local").alias("local"), F.col("nr_secao").alias("secao"), "id_regiao")
        # A report counts where the place it declares belongs to the region. Stored, so that the
        # keyed state is asked once; repeating the batch writes the same rows over it.
        arrived = f"{folder}/chegadas"
        batch.join(at, [*_KEYS, "local"], "left").write.mode("overwrite").parquet(arrived)
        placed = spark.read.parquet(arrived)
        if not tables.fresh and placed.isEmpty():
            return  # a batch that only moves time on
        inside = placed.where("id_regiao is not null")
        lines = inside.select("id_regiao", "sinal", F.explode("votos").alias("v")).select(
            "id_regiao", "v.cargo", "v.tipo", "v.partido", "v.numero",
            (F.col("v.quantidade") * F.col("sinal")).alias("quantidade"))
        tables.add_sums("somas", ["id_regiao", "cargo", "tipo", "numero"], "votos", live.live_results(lines))
        signed = F.col("sinal").cast("bigint")
        tables.add_sums("urnas", ["id_regiao"], "urnas", inside.select("id_regiao", signed.alias("urnas")))
        tables.add_sums("situacoes", ["situacao"], "secoes", placed.select("situacao", signed.alias("secoes")))

        expected = mapped.groupBy("id_regiao").agg(F.count("*").alias("esperadas"))
        if tables.fresh:
            tables.add_rows("pendentes", _KEYS, -1, mapped.select(
                F.col("cd_municipio_tse").alias("municipio"), F.col("nr_zona").alias("zona"), F.col("nr_secao").alias("secao"),
                F.lit("sem boletim").alias("motivo")).distinct())
            tables.add_rows("progresso", ["id_regiao"], -1, _progress(expected.withColumn("urnas", F.lit(0).cast("bigint"))))
            if published is not None:
                tables.add_rows("servido", ["id_regiao"], -1, published.withColumn("parcial", F.lit(False)))
        final = F.coalesce(F.lower("situacao").startswith("totaliz"), F.lit(False))
        valid = placed.where("sinal > 0")
        tables.add_rows("pendentes", _KEYS, number, valid.where(~final).select(*_KEYS, F.lit("não totalizada").alias("motivo")), valid)

        touched = inside.select("id_regiao").distinct()
        sums = tables.read("somas").join(touched, "id_regiao", "left_semi")
        results = shown_results(sums, mapped, limits, candidates)
        tables.add_rows("resultados", ["id_regiao"], number, results, touched)
        counted = expected.join(touched, "id_regiao", "left_semi").join(tables.read("urnas"), "id_regiao", "left").fillna(0, ["urnas"])
        tables.add_rows("progresso", ["id_regiao"], number, _progress(counted), touched)
        if published is not None:
            shown = results.where(F.col("tipo").isin("nominal", "legenda") & (F.col("votos") > 0)).select(
                "id_regiao", "cargo", F.lit(year).cast(published.schema["ano_eleicao"].dataType).alias("ano_eleicao"),
                F.lit(round_).alias("turno"), "nome", "votos")
            tables.add_rows("servido", ["id_regiao"], number, live.overlay(
                published.join(touched, "id_regiao", "left_semi"), shown, ["id_regiao", "cargo", "ano_eleicao", "turno"]), touched)
        tables.commit(number)

    return step


def shown_results(sums: DataFrame, mapped: DataFrame, limits: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Shares and names of summed votes, without regions that break a limit."""
    towns = mapped.select("id_regiao", "cd_municipio_ibge", "uf").distinct()
    results = live.live_shares(sums).join(towns, "id_regiao").withColumn(
        "cargo", office_slug(F.try_element_at(F.create_map(*[F.lit(x) for o in OFFICES.items() for x in o]),
                                              F.col("cargo"))))
    if candidates is None:
        results = results.withColumn("nome", F.col("numero").cast("string"))
    else:
        unit = F.when(F.col("cargo") == "presidente", "presidente").otherwise(F.upper("uf"))
        results = live.named_votables(results, candidates, unit)
    return live.withhold(results, limits, ["cd_municipio_ibge"])


def _progress(counted: DataFrame) -> DataFrame:
    return counted.select("id_regiao", "esperadas", "urnas", F.when(F.col("urnas") == 0, "sem").when(
        F.col("urnas") >= F.col("esperadas"), "completo").otherwise("parcial").alias("situacao"))


def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Sections by the situation of their valid report."""
    return latest(spark, folder, "situacoes")
