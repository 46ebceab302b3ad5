"""Sources and sinks: archives, tables, documents, official documents, ballots."""

import hashlib
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from meshtally import schemas
from meshtally.operators.guards import CheckFailed, enforce
from meshtally.plans import convert as C
from meshtally.sources import archives, ballots, documents, official, tables

HEAD = ";".join(schemas.RAW_PLACES.names) + ";EXTRA\n"
LINE = "2022;1;RO;310;ALTA FLORESTA;17;{};1074;ESCOLA SÃO X;RUA Y, 10;-12,129643;-61,993019;{};z\n"


def put_zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text.encode("latin-1"))


def test_archive_prefers_states_and_never_counts_twice(spark, tmp_path):
    put_zip(tmp_path / "a.zip", {"x_RO.csv": HEAD + LINE.format(1, 250), "x_AC.csv": HEAD + LINE.format(2, 180),
                                 "x_BRASIL.csv": HEAD + LINE.format(1, 250) + LINE.format(2, 180), "leia.pdf": "x"})
    put_zip(tmp_path / "b.zip", {"x_BRASIL.csv": HEAD + LINE.format(3, 20)})
    paths = [str(tmp_path / "a.zip"), str(tmp_path / "b.zip")]
    rows = archives.land(spark, paths, schemas.RAW_PLACES, str(tmp_path / "landed"))
    assert rows.columns == schemas.RAW_PLACES.names
    assert sorted(r.NR_SECAO for r in rows.collect()) == ["1", "2", "3"]
    assert rows.first().NM_LOCAL_VOTACAO == "ESCOLA SÃO X"
    national = archives.choose_csv(archives.archive_members(spark, paths), national=True)
    assert {r.member for r in national.collect()} == {"x_BRASIL.csv"}
    with pytest.raises(Exception):
        archives.archive_members(spark, [str(tmp_path / "missing.zip")]).collect()


def test_delimited_reads_text_only(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes((HEAD + LINE.format("01", 250)).encode("latin-1"))
    row = archives.read_delimited(spark, str(tmp_path / "p.csv"), schemas.RAW_PLACES).first()
    assert row.NR_SECAO == "01" and row.NM_LOCAL_VOTACAO == "ESCOLA SÃO X"


def test_replace_slice_is_idempotent_and_guards_schema(spark, tmp_path):
    path = str(tmp_path / "base")
    base = spark.createDataFrame([(2022, "1", 5), (2026, "1", 7), (2026, "2", 9)], "ano_eleicao int, turno string, qt bigint")
    tables.replace_slice(base, path)
    new = spark.createDataFrame([(2026, "1", 70)], "ano_eleicao int, turno string, qt bigint")
    for _ in range(2):
        tables.replace_slice(new, path)
    got = {(r.ano_eleicao, str(r.turno)): r.qt for r in spark.read.parquet(path).collect()}
    assert got == {(2022, "1"): 5, (2026, "1"): 70, (2026, "2"): 9}
    with pytest.raises(CheckFailed):
        tables.replace_slice(new.withColumnRenamed("qt", "outra"), path)


def test_stale_partitions(spark):
    saved = spark.createDataFrame([(2026, "RO", 1, "a"), (2026, "AC", 2, "b")],
                                  "ano_referencia int, sg_uf string, id_regiao int, cd_municipio_ibge string")
    now = spark.createDataFrame([(1, "a"), (2, "c")], "id_regiao int, cd_municipio_ibge string")
    assert [r.sg_uf for r in tables.stale_partitions(saved, now, []).collect()] == ["AC"]
    assert tables.stale_partitions(saved, now, ["bairro"]).count() == 2


def test_exceptions_file_has_mark_and_separator(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "id string, n int")
    tables.write_exceptions(df, str(tmp_path / "x"), ["id"])
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "x").glob("*.csv")))
    assert text.startswith("﻿id;n".encode()) and b"a;2" in text


def test_sample_is_reproducible(spark):
    df = spark.range(2000).select((F.col("id") % 2).alias("g"), "id")
    a, b = (sorted(r.id for r in tables.sample_per_group(df, ["g"], ["id"], 50).collect()) for _ in range(2))
    assert a == b and len(a) == 100


def test_documents_refuse_nan_anywhere(spark, tmp_path):
    ok = spark.createDataFrame([("m", [Row(f=0.5)], {"a": 1.0})], "cd string, l array<struct<f:double>>, m map<string,double>")
    documents.write_documents(ok, str(tmp_path / "d"), ["cd"])
    back = documents.read_documents(spark, str(tmp_path / "d"), ok.schema).first()
    assert back.l[0].f == 0.5 and back.cd == "m"
    for bad in ("array(struct(double('nan') as f))", "array(struct(double('inf') as f))"):
        with pytest.raises(Exception, match="NaN or infinity"):
            documents.json_rows(spark.sql(f"select 'm' as cd, {bad} as l")).collect()
    (tmp_path / "n.json").write_text('{"x": NaN}\n')
    strict = spark.createDataFrame([], "x double").schema
    with pytest.raises(Exception):
        documents.read_documents(spark, str(tmp_path / "n.json"), strict).collect()


def test_manifest_diff_and_audit(spark, tmp_path):
    for side in ("here", "there"):
        (tmp_path / side).mkdir()
    (tmp_path / "here" / "a").write_text("1")
    (tmp_path / "here" / "b").write_text("22")
    (tmp_path / "there" / "b").write_text("2")
    diff = documents.publish_diff(documents.manifest(spark, str(tmp_path / "here")), documents.manifest(spark, str(tmp_path / "there")))
    assert {r.arquivo: r.situacao for r in diff.collect()} == {"a": "novo", "b": "alterado"}
    signed = spark.createDataFrame([("a", hashlib.sha512(b"1").hexdigest()), ("b", "00"), ("c", "00")], "arquivo string, sha512 string")
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"22"))], "arquivo string, content binary")
    audit = documents.integrity_audit(files, signed)
    assert {r.arquivo: r.situacao for r in audit.collect()} == {"a": "ok", "b": "diferente", "c": "ausente"}
    with pytest.raises(CheckFailed):
        enforce(documents.audit_problems(audit))


def test_catalogue_picks_one_election(spark):
    rows = [("ele2026", "3220", "04/10/2026", [("619", "Eleição Ordinária Federal", "1"), ("620", "Eleição Ordinária Estadual", "1"),
                                                ("700", "Eleição Suplementar Federal", "1")])]
    cat = spark.createDataFrame([Row(pl=[Row(c=c, cd=p, dt=d, e=[Row(cd=a, nm=b, t=t) for a, b, t in e]) for c, p, d, e in rows])], schemas.CATALOGUE)
    found = official.elections(cat)
    assert official.federal_election(found, 2026).first().codigo == "619"
    assert {r.cargo: r.codigo for r in official.election_per_office(found, 2026).collect()} == {1: "619", 3: "620", 5: "620", 6: "620", 7: "620"}
    with pytest.raises(CheckFailed):
        official.federal_election(found, 2022)
    with pytest.raises(CheckFailed):
        official.federal_election(found.unionAll(found), 2026)


def result(**v):
    return Row(uf="X", v=Row(**{c: v.get(c) for c in ("tv", "vvc", "vv", "vnom", "vl", "van", "vansj", "vb", "tvn", "vn", "vnt")}),
               e=Row(c=v["c"]), s=None, carg=[])


def test_official_totals_as_the_box_recorded(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("uf", StringType()), *schemas.OFFICIAL_RESULT.fields])
    docs = spark.createDataFrame([result(vnom="300", vansj="40", vb="7", vn="13", c="360", tv="360", vvc="300"),
                                  result(vnom="500", vvc="500", vb="6", vn="20", vnt="1", tvn="21", c="527", tv="527"),
                                  result(vnom="10", vvc="10", vb="0", vn="0", c="12", tv="11")], schema)
    a, b, c = official.result_totals(docs, ["uf"]).collect()
    assert (a.validos, a.nulos, a.avisos, len(a.notas)) == (340, 13, [], 1)
    assert (b.validos, b.nulos, b.avisos) == (501, 20, [])
    assert len(c.avisos) == 2


# ---------------------------------------------------------------- ballots

def reports(spark, *lines):
    """Report lines from (file, phase, office, turnout, vote type, votes, number) or (file, error)."""
    rows = []
    for name, *rest in lines:
        if len(rest) == 1:
            rows.append((name, *[None] * 15, rest[0]))
        else:
            phase, office, turnout, kind, votes, number = rest
            rows.append((name, "00077", 3, 21, 8, 1, str(phase), 900, 0, 0, office, turnout, str(kind), votes, number, number, None))
    return ballots.report_lines(spark.createDataFrame(rows, schemas.BALLOT_ROWS))


def test_report_lines_are_named(spark):
    rows = reports(spark, ("a", 2, 1, 30, 1, 20, 71), ("a", 2, 1, 30, 2, 10, None), ("b", 1, 1, 5, 4, 5, 71), ("c", 8, 1, 2, 9, 2, None), ("d", "cut short"))
    got = {(r.arquivo, r.fase, r.tipo, r.erro) for r in rows.collect()}
    assert got == {("a", "oficial", "nominal", None), ("a", "oficial", "branco", None), ("b", "simulado", "legenda", None),
                   ("c", "desconhecida", "desconhecido_9", None), ("d", None, None, "cut short")}
    assert rows.schema.names == schemas.BALLOT_ROWS.names


def test_rejection_policy(spark):
    many = [(f"u{i:03}", 2, 11, 9, 1, 9, 62) for i in range(260)]
    rows = reports(spark, *many, ("w", "unreadable")).cache()
    bad = C.rejections(rows)
    enforce(C.rejection_rate(rows, bad))                      # 1 of 261 is under the limit
    assert sum(r.qt_votos for r in C.ballot_counts(C.counted_rows(rows, bad, [11])).collect()) == 260 * 9
    worse = reports(spark, *[(f"w{i}", "unreadable") for i in range(4)])
    with pytest.raises(CheckFailed):
        enforce(C.rejection_rate(worse, C.rejections(worse)))
    odd = reports(spark, ("trial", 1, 1, 9, 1, 9, 62), ("uneven", 2, 1, 31, 1, 30, 62), ("two seats", 2, 5, 15, 1, 30, 621),
                  ("new type", 2, 1, 6, 9, 6, None), ("no number", 2, 1, 6, 1, 6, None), ("cut", "cut short"))
    assert {r.arquivo: r.classe for r in C.rejections(odd).collect()} == {
        "trial": "fase", "uneven": "conta", "new type": "conta", "no number": "conta", "cut": "estrutura"}


def test_vote_record_lines(spark):
    lines = [("a", 900, 1, 1, "2", "62", None), ("a", 900, 1, 2, "3", None, None), ("b", 900, 1, 1, "2", "71", None), ("c", None, None, None, None, None, "cut short")]
    rows = ballots.record_lines(spark.createDataFrame(lines, schemas.RECORD_ROWS))
    assert {(r.arquivo, r.ordem, r.tipo) for r in rows.collect()} == {("a", 1, "nominal"), ("a", 2, "branco"), ("b", 1, "nominal"), ("c", None, None)}
    assert {(r.tipo, r.votos) for r in ballots.record_summary(rows).collect()} == {("nominal", 2), ("branco", 1)}


def register(spark):
    cols = "SG_UF DS_CARGO SQ_CANDIDATO NR_CANDIDATO SG_UE NM_URNA_CANDIDATO NR_PARTIDO SG_PARTIDO DS_SITUACAO_CANDIDATURA DS_SIT_TOT_TURNO".split()
    rows = [("XX", "Prefeito", "81", "62", "00077", "PRIMEIRA", "62", "P62", "APTO", "#NULO"),
            ("XX", "Prefeito", "82", "62", "00077", "SEGUNDA", "62", "P62", "INAPTO", "Eleito"),
            ("XX", "Prefeito", "70", "62", "00078", "VIZINHA", "62", "P62", "APTO", "#NE"),
            ("XX", "Prefeito", "91", "71", "00077", "RETIRADA", "71", "P71", "INAPTO", None),
            ("XX", "Prefeito", "90", "71", "00077", "FIRME", "71", "P71", "APTO", None),
            ("XX", "Prefeito", "95", "53", "00077", "ANTIGA", "53", "P53", "APTO", None),
            ("XX", "Prefeito", "96", "53", "00077", "RECENTE", "53", "P53", "APTO", None)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_conversion_to_vote_rows(spark):
    best = {(r.SG_UE, r.NR_CANDIDATO): r.NM_URNA_CANDIDATO for r in C.preferred_candidacies(register(spark)).collect()}
    assert best == {("00077", "62"): "SEGUNDA", ("00078", "62"): "VIZINHA", ("00077", "71"): "FIRME", ("00077", "53"): "RECENTE"}
    counts = spark.createDataFrame([("00077", 3, 21, 11, "nominal", 62, 62, 40), ("00077", 3, 21, 11, "branco", None, None, 6),
                                    ("00077", 3, 21, 11, "cargo_sem_candidato", None, None, 4), ("00077", 3, 21, 11, "legenda", 71, 71, 9)],
                                   "municipio string, zona int, local int, cargo int, tipo string, partido int, numero int, qt_votos bigint")
    df = C.vote_rows(counts, "xx", 2028, "2", register(spark))
    assert df.columns == schemas.VOTE_COLUMNS
    got = {r.tipo_voto: (r.id_local_votacao, r.sq_candidato, r.nr_votavel, r.nm_votavel, r.sg_partido, r.qt_votos) for r in df.collect()}
    place = "XX_00077_3_21"
    assert got == {"nominal": (place, "82", "62", "SEGUNDA", "P62", 40), "branco": (place, "-1", "95", "VOTO EM BRANCO", None, 6),
                   "cargo_sem_candidato": (place, "-1", "96", "VOTO NULO", None, 4), "legenda": (place, "-3", "71", "P71", "P71", 9)}
