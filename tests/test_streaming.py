"""Streaming: incremental pick-up, retransmission, guards, pending sections."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from meshtally.streaming import ballots as B


def report(sec, situ, order, lines, local=10, mun="00310", zona=1):
    return (mun, zona, sec, local, situ, order, [dict(zip(("cargo", "tipo", "quantidade", "partido", "numero"), l)) for l in lines])


def test_retransmission_replaces_and_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("in", "out", "ck"))
    mapped = spark.createDataFrame(
        [("1100015", "ro", "00310", 1, 1, 10, 1), ("1100015", "ro", "00310", 1, 1, 10, 2),
         ("1100015", "ro", "00310", 2, 1, 20, 3)],
        "cd_municipio_ibge string, uf string, cd_municipio_tse string, id_regiao bigint, "
        "nr_zona int, nr_local int, nr_secao int")
    limits = spark.createDataFrame([("1100015", "13", 500), ("1100015", "22", 5)],
                                   "cd_municipio_ibge string, nome string, limite bigint")

    published = spark.createDataFrame([(1, "presidente", 2022, "1", "ANTES", 9), (2, "presidente", 2026, "1", "JA", 3)],
                                      "id_regiao bigint, cargo string, ano_eleicao int, turno string, nome string, votos bigint")

    def put(rows):
        spark.createDataFrame(rows, B.REPORT).coalesce(1).write.mode("append").parquet(src)

    def one_pass():
        stream = B.arriving(spark, src, spark.createDataFrame([], B.REPORT).schema)
        B.run_pass(B.corrections(stream), ck, B.live_step(out, mapped, limits, published=published, year=2026))

    def votes():
        return {(r.id_regiao, r.tipo, r.numero): r.votos for r in B.latest(spark, out, "resultados").collect()}

    put([report(1, "Recebido", 1, [(1, "nominal", 60, 13, 13), (1, "branco", 4, None, None)]),
         report(1, "Rejeitado", 2, [(1, "nominal", 99, 13, 13)]),
         # declares another place than the one of its section: not counted
         report(3, "Totalizado", 1, [(1, "nominal", 7, 13, 13)], local=99)])
    one_pass()
    assert votes() == {(1, "nominal", 13): 99}
    assert {r.id_regiao: r.situacao for r in B.latest(spark, out, "progresso").collect()} == {1: "parcial", 2: "sem"}

    put([report(1, "Totalizado", 1, [(1, "nominal", 50, 13, 13), (1, "branco", 10, None, None)]),
         report(2, "Totalizado", 1, [(1, "nominal", 5, 13, 13)])])
    one_pass()
    one_pass()      # nothing new: nothing changes
    assert {k: v for k, v in votes().items() if v} == {(1, "nominal", 13): 55, (1, "branco", None): 10}
    assert {r.id_regiao: r.situacao for r in B.latest(spark, out, "progresso").collect()} == {1: "completo", 2: "sem"}
    assert [(r.secao, r.motivo) for r in B.latest(spark, out, "pendentes").collect()] == []
    assert {r.situacao: r.secoes for r in B.status_counts(spark, out).collect()} == {"Totalizado": 3}

    shown = {(r.id_regiao, r.ano_eleicao, r.nome, r.votos, r.parcial) for r in B.latest(spark, out, "servido").collect()}
    assert shown == {(1, 2022, "ANTES", 9, False), (2, 2026, "JA", 3, False), (1, 2026, "13", 55, True)}
    people = spark.createDataFrame([("presidente", "presidente", "13", "Fulana", "PT")],
                                   "unidade string, cargo string, numero string, nome string, partido string")
    named = {r.numero: r.nome for r in B.shown_results(B.latest(spark, out, "somas"), mapped, limits, people).where("tipo = 'nominal'").collect()}
    assert named == {13: "Fulana"}

    # a region with more votes for a name than its municipality is withheld
    put([report(2, "Totalizado", 5, [(1, "nominal", 5, 13, 13), (1, "nominal", 6, 22, 22)])])
    one_pass()
    assert votes() == {}


def test_once_per_section_and_rate(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("a", "2026-10-04 17:00:10"), ("a", "2026-10-04 17:00:20"), ("b", "2026-10-04 17:00:40"),
            ("c", "2026-10-04 17:01:30")]
    df = spark.createDataFrame(rows, "secao string, quando string").select("secao", F.col("quando").cast("timestamp").alias("ts"))
    df.coalesce(1).write.parquet(src)
    stream = B.arriving(spark, src, df.schema)
    got = []
    B.run_pass(B.once_per_section(stream, ["secao"], "ts"), str(tmp_path / "c1"),
               lambda b, i: got.extend(r.secao for r in b.collect()))
    assert sorted(got) == ["a", "b", "c"]
    rate = {}
    B.run_pass(B.arrival_rate(stream, "ts"), str(tmp_path / "c2"),
               lambda b, i: rate.update({r.inicio.minute: r.boletins for r in b.collect()}), mode="update")
    assert rate == {0: 3, 1: 1}


def test_running_valid_matches_batch(spark, tmp_path):
    from meshtally.plans.live import valid_transmission
    src = str(tmp_path / "in")
    df = spark.createDataFrame([("s", "Recebido", 1), ("s", "Totalizado", 2), ("s", "Rejeitado", 3), ("t", "Recebido", 1),
                                ("t", "Rejeitado", 2)], "secao string, situacao string, ordem bigint")
    df.write.parquet(src)
    seen = {}
    B.run_pass(B.running_valid(B.arriving(spark, src, df.schema), ["secao"], ["situacao", "ordem"], "ordem"),
               str(tmp_path / "ck"), lambda b, i: seen.update({r.secao: r.ordem for r in b.collect()}), mode="update")
    batch = {r.secao: r.ordem for r in valid_transmission(df, ["secao"]).collect()}
    assert seen == batch == {"s": 2, "t": 2}


class Handle:
    """The state of one section, and how often it is asked."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def listTimers(self):
        self.calls += 1
        return iter(list(self.timers))

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


def test_a_section_costs_few_state_calls_and_closes():
    handle, state = Handle(), B.ValidTransmission(1000)
    state.init(handle)
    line = Row(cargo=1, tipo="branco", quantidade=2, partido=None, numero=None)

    def send(*sent):
        handle.calls = 0
        rows = (Row(local=7, situacao=s, ordem=o, votos=[line], recebido_ms=at) for s, o, at in sent)
        return [(r.situacao, r.sinal) for r in state.handleInputRows(("00310", 1, 1), rows, None)], handle.calls

    assert send(("Recebido", 1, 5), ("Rejeitado", 3, 5), ("Recebido", 2, 5)) == ([("Rejeitado", 1)], 2)
    assert send(("Recebido", 2, 6)) == ([], 1)                      # nothing new: asked once
    assert send(("Totalizado", 1, 9)) == ([("Rejeitado", -1), ("Totalizado", 1)], 3)
    assert handle.timers == [1009]
    assert send(("Totalizado", 4, 20))[0] == [("Totalizado", -1), ("Totalizado", 1)]
    assert handle.timers == [1020]
    assert list(state.handleExpiredTimer(("00310", 1, 1), None, None)) == []
    assert handle.value[4] == []                                    # only the mark stays
    assert send(("Totalizado", 9, 2000)) == ([], 1)
