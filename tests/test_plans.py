"""Mesh, votes, publication, validation, reconciliation and live results on small fixtures."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from meshtally.functions import numbers, text
from meshtally.functions import votes as FV
from meshtally.operators import guards as G
from meshtally.operators import places as P
from meshtally.operators import votes as V
from meshtally.plans import live as L
from meshtally.plans import mesh as M
from meshtally.plans import publish as PUB
from meshtally.plans import reconcile as REC
from meshtally.plans import reports as R
from meshtally.plans import validate as VAL
from meshtally.schemas import RAW_PLACES


def one(spark, **columns):
    df = spark.createDataFrame([Row(i=1)]).select(*[c.alias(n) for n, c in columns.items()])
    return df.first()


def test_text_and_numbers(spark):
    lit = F.lit
    r = one(spark, a=text.unaccented(lit(" Rua Dr. Brandão\n")), b=text.comparable(lit("Av. São-João,  10")), c=text.pad_code(lit(" 310")),
            d=text.pad_code(lit("123456")), e=text.title_case(lit("D'AVILA-SOUZA DA SILVA")), f=numbers.decimal_text(lit("-12,5")),
            g=numbers.decimal_text(lit("x")), h=numbers.percent(lit(1), lit(3)), i=numbers.percent(lit(1), lit(0)),
            j=text.number_br(lit(1234567)), k=text.percent_br(lit(72.64)), l=text.place_key(lit("AM "), lit("702"), lit("004"), lit(" 33")),
            m=text.street_name(lit("Rua"), lit(None).cast("string"), lit(" das  Flores")), n=numbers.percent(lit(535), lit(20000)),
            o=FV.code_name(lit(9), {1: "um"}), p=text.place_key(lit("RO"), lit(None).cast("string"), lit("1"), lit("1")))
    assert r.a == "RUA DR. BRANDAO" and r.b == "AV SAO JOAO 10" and r.c == "00310" and r.d == "123456"
    assert r.e == "D'Avila-Souza Da Silva" and r.f == -12.5 and r.g is None and (r.h, r.i) == (33.33, 0.0)
    assert r.j == "1.234.567" and r.k == "72,6%" and r.l == "AM_00702_4_33" and r.m == "RUA DAS FLORES"
    assert r.n == 2.68 and r.o == "desconhecido_9" and r.p is None


@pytest.mark.parametrize("number,seq,kind", [("95", "-1", "branco"), ("96", "77", "nulo"), ("97", "-3", "anulado"), ("44", "-3", "legenda"),
                                             ("61", "-1", "legenda"), ("44551", "-1", "nominal"), ("61", "90210", "nominal"), ("5", "-1", "nominal")])
def test_vote_type(spark, number, seq, kind):
    assert one(spark, t=FV.vote_type(F.lit(number), F.lit(seq))).t == kind


def raw(spark, *rows):
    base = dict(AA_ELEICAO="2018", NR_TURNO="2", SG_UF="AM", CD_MUNICIPIO="702", NM_MUNICIPIO="PORTO AZUL", NR_ZONA="4", NR_SECAO="8", NR_LOCAL_VOTACAO="33",
                NM_LOCAL_VOTACAO="GINASIO VELHO", DS_ENDERECO="TRAVESSA DO CAIS, 7", NR_LATITUDE="-3,41", NR_LONGITUDE="-60,125", QT_ELEITOR_ELEICAO_FEDERAL="61")
    return spark.createDataFrame([tuple({**base, **r}[c] for c in RAW_PLACES.names) for r in rows], RAW_PLACES)


def test_sections_places_voters(spark):
    df = P.clean_sections(raw(spark, {}, {"NR_SECAO": "9", "QT_ELEITOR_ELEICAO_FEDERAL": "40", "NR_LATITUDE": "-3.41", "NR_LONGITUDE": "-60.125"},
                              {"NR_SECAO": "10", "QT_ELEITOR_ELEICAO_FEDERAL": "sem dado"},
                              {"AA_ELEICAO": "2022", "NM_LOCAL_VOTACAO": "GINASIO REFORMADO", "DS_ENDERECO": None},
                              {"NR_LOCAL_VOTACAO": "34", "NR_LATITUDE": "-1", "NR_LONGITUDE": "-1"}, {"NR_LOCAL_VOTACAO": "35", "NR_LATITUDE": "0,0", "NR_LONGITUDE": "-60"},
                              {"NR_LOCAL_VOTACAO": "36", "NR_LATITUDE": "41,9", "NR_LONGITUDE": "12,5"}, {"NR_LOCAL_VOTACAO": "37", "NR_LATITUDE": "", "NR_LONGITUDE": None}))
    voters = {(r.id_local_votacao, r.ano_eleicao): r.qt_eleitores for r in P.voters_per_place(df).collect()}
    assert voters["AM_00702_4_33", 2018] == 101 and voters["AM_00702_4_33", 2022] == 61
    latest = P.latest_places(df).collect()
    assert [(r.id_local_votacao, r.nm_local_votacao, r.ds_endereco, r.ano_referencia) for r in latest] == [("AM_00702_4_33", "GINASIO REFORMADO", "TRAVESSA DO CAIS, 7", 2022)]
    assert (latest[0].latitude, latest[0].longitude) == (-3.41, -60.125)
    G.enforce(G.sum_preserved(df, P.voters_per_place(df), "qt_eleitores", "voters"))


PLACE = ("id_local_votacao string, sg_uf string, cd_municipio_ibge string, nm_municipio string, nm_local_votacao_consolidado string, "
         "ds_local_votacao_endereco_consolidado string, latitude_final double, longitude_final double, origem_coordenada string")


def test_ambiguous_point_and_regions(spark):
    places = spark.createDataFrame([("RO_00310_17_1", "RO", "1100015", "A", "B ESC", None, -12.1, -61.9, "cnefe"), ("RO_00320_18_1", "RO", "1100023", "C", "X", "e", -12.1, -61.9, "tse"),
                                    ("RO_00310_17_2", "RO", "1100015", "A", "A ESC", None, -12.1, -61.9, "tse"), ("RO_00310_2_5", "RO", "1100015", "A", "A ESC", "rua", -12.1, -61.9, "tse"),
                                    ("RO_00310_17_9", "RO", "1100015", "A", "Z", "r", -12.0, -61.0, "tse")], PLACE)
    kept = M.drop_ambiguous_points(places)
    lost = {r.id_local_votacao for r in kept.where("latitude_final is null").collect()}
    assert lost == {"RO_00320_18_1", "RO_00310_17_2", "RO_00310_2_5"}
    clean = places.where("cd_municipio_ibge = '1100015'")
    regions, mapping = M.build_regions(clean)
    rows = {r.id_regiao: r for r in regions.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].nm_local_votacao, rows[1].ds_endereco, rows[1].n_locais_votacao, rows[1].origem_coordenada) == ("A ESC", "rua", 3, "cnefe")
    assert [r.nome for r in M.other_names(clean, mapping).collect()] == ["B ESC"]
    G.enforce(*M.region_guards(clean, mapping))
    with pytest.raises(G.CheckFailed):
        G.enforce(*M.region_guards(places, M.build_regions(places)[1]))
    ids, aliases = M.public_keys(regions, mapping)
    assert {r.id_regiao: r.id_publico for r in ids.collect()} == {1: "2-5", 2: "17-9"}
    assert {r.apelido: r.id_publico for r in aliases.collect()} == {"17-1": "2-5", "17-2": "2-5"}
    asked = spark.createDataFrame([("1100015", k) for k in ("2-5", "17-1", "9-9", "../x")], "cd_municipio_ibge string, chave string")
    got = {r.chave: (r.situacao, r.id_publico) for r in M.resolve_public_key(asked, ids, aliases).collect()}
    assert got == {"2-5": ("canonico", "2-5"), "17-1": ("redireciona", "2-5"), "9-9": ("nao_encontrado", None), "../x": ("invalido", None)}


def test_mesh_of_year(spark):
    mapping = spark.createDataFrame([("RO_00310_17_1074", 1), ("RO_00310_17_1082", 1), ("RO_00310_17_1090", 2), ("RO_00310_17_1104", 3)], "id_local_votacao string, id_regiao bigint")

    def regions(*places, year=2026):
        v = spark.createDataFrame([(f"RO_00310_17_{p}", 2026, "1", 5) for p in places], "id_local_votacao string, ano_eleicao int, turno string, qt_eleitores bigint")
        return {r.id_regiao for r in M.regions_of_year(v, mapping, year).collect()}

    assert regions("1074", "1090") == {1, 2} and regions("1074", "1082") == {1} and regions("1074", year=2030) == set()


VOTE = "id_regiao bigint, sg_uf string, ano_eleicao int, turno string, cargo string, sq_candidato string, nr_votavel string, nm_votavel string, sg_partido string, tipo_voto string, qt_votos bigint"


def votes(spark, *rows):
    return spark.createDataFrame([(r, "RO", a, t, c, "1", "1", n, p, k, q) for r, a, t, c, n, p, k, q in rows], VOTE)


@pytest.fixture(scope="module")
def contest(spark):
    return votes(spark, (1, 2022, "1", "PRESIDENTE", "FULANA D'ÁVILA", "AA", "nominal", 60), (1, 2022, "1", "PRESIDENTE", "SICRANO", "BB", "nominal", 40),
                 (1, 2022, "1", "PRESIDENTE", "VOTO EM BRANCO", None, "branco", 10), (1, 2022, "1", "PRESIDENTE", "VOTO NULO", None, "nulo", 15),
                 (1, 2022, "2", "PRESIDENTE", "SICRANO", "BB", "nominal", 55), (1, 2018, "2", "PRESIDENTE", "FULANA D'ÁVILA", "AA", "nominal", 9),
                 (1, 2022, "1", "DEPUTADO FEDERAL", "AA", "AA", "legenda", 20),
                 *[(1, 2022, "1", "DEPUTADO FEDERAL", f"DEP {i}", "AA", "nominal", 10 * i) for i in range(1, 6)]).cache()


def test_results_shares_and_documents(spark, contest):
    res = {(r.ano_eleicao, r.turno, r.nm_votavel): r.pct for r in V.candidate_results(contest.where("cargo = 'PRESIDENTE'"), ["id_regiao"]).collect()}
    assert res[2022, "1", "FULANA D'ÁVILA"] == 60.0
    t = V.contest_totals(contest.where("cargo = 'PRESIDENTE' and turno = '1'"), ["id_regiao"]).first()
    assert (t.validos, t.total, t.brancos, t.pct_brancos, t.pct_nulos) == (100, 125, 10, 8.0, 12.0)
    doc = PUB.region_results(contest).first()
    pres = doc.resultados["presidente"]["2022"]["1"]
    assert [(c.nome, c.votos) for c in pres] == [("Fulana D'Ávila", 60), ("Sicrano", 40)]
    dep = doc.resultados["deputado_federal"]["2022"]["1"]
    assert [c.nome for c in dep] == ["Dep 5", "Dep 4", "Dep 3"] and dep[0].pct == round(50 / 170 * 100, 2)
    assert doc.total_votos["presidente"]["2022"]["1"] == 125 and doc.nao_nominal["presidente"]["2022"]["1"].branco.votos == 10
    change = L.leadership_change(V.candidate_results(contest.where("cargo = 'PRESIDENTE'"), ["id_regiao"]), ["id_regiao"]).first()
    assert (change.lider_antes, change.lider_agora, change.mudou) == ("FULANA D'ÁVILA", "SICRANO", True)


def test_share_keeps_regions_without_results(spark, contest):
    regions = spark.createDataFrame([(1, "1100015", "RO", "A", "Esc", "rua"), (2, "1100015", "RO", "A", "Nova", None)],
                                    "id_regiao bigint, cd_municipio_ibge string, sg_uf string, nm_municipio string, nm_local_votacao string, ds_endereco string")
    mapping = spark.createDataFrame([("RO_00310_1_10", 1), ("RO_00310_1_20", 2)], "id_local_votacao string, id_regiao bigint")
    share = PUB.share_summary(regions, mapping, contest)
    rows = {r.regiao: r for r in share.collect()}
    assert (rows[1].ano, rows[1].turno, rows[1].validos, rows[1].candidatos[0].nome, rows[1].deputado.nome) == ("2022", "2", 55, "Sicrano", "Dep 5")
    assert rows[2].ano is None and rows[2].candidatos is None and rows[2].chave == "1-20"
    texts = {r.regiao: r for r in L.preview_text(share).collect()}
    assert texts[1].titulo == "Esc — A (RO)" and texts[1].placar == "Presidente 2022, 2º turno: Sicrano 100,0%" and texts[2].placar is None
    progress = spark.createDataFrame([(1, 2, 3)], "id_regiao bigint, urnas bigint, esperadas bigint")
    told = {r.regiao: r.texto for r in L.share_text(share, progress).collect()}
    assert told[1].endswith("Sicrano 100,0% — parcial, 2 de 3 urnas processadas") and told[2] == "Como votou Nova, em A – RO"
    ids, aliases = M.public_keys(regions, mapping)
    keyed = regions.join(ids.select("id_regiao", "id_publico"), "id_regiao")
    G.enforce(VAL.share_problems(share, aliases, keyed))
    wrong = share.withColumn("regiao", F.lit(2).cast("bigint"))
    assert VAL.share_problems(wrong, aliases, keyed).where("check = 'share region'").count() == 1


def test_territory_levels_and_country(spark):
    v = votes(spark, (1, 2022, "1", "PRESIDENTE", "LULA X", "PT", "nominal", 100), (2, 2022, "1", "PRESIDENTE", "LULA X", "PT", "nominal", 50),
              (1, 2026, "1", "PRESIDENTE", "NOVA", "N", "nominal", 7)).withColumn("cd", F.col("id_regiao").cast("string"))
    rolled = {(r.sg_uf, r.cd, r.ano_eleicao): (r.qt_votos, r.nivel) for r in V.territory_results(v, ["sg_uf", "cd"]).collect()}
    assert rolled["RO", None, 2022] == (150, 1) and rolled[None, None, 2022] == (150, 0) and rolled["RO", "2", 2022] == (50, 2)
    national = spark.createDataFrame([(2022, "1", "PRESIDENTE", "LULA X", 160), (2022, "1", "PRESIDENTE", "VOTO NULO", 3)], "ano_eleicao int, turno string, cargo string, nm_votavel string, qt_votos bigint")
    got = {(r.ano_eleicao, r.nm_votavel): (r.qt_votos, r.sg_partido, r.tipo_voto) for r in V.country_votes(national, v).collect()}
    assert got == {(2022, "LULA X"): (160, "PT", "nominal"), (2022, "VOTO NULO"): (3, None, "nulo"), (2026, "NOVA"): (7, "N", "nominal")}
    official = spark.createDataFrame([(2022, "1", "LULA", 160), (2018, "1", "HADDAD", 1)], "ano_eleicao int, turno string, parte string, oficial bigint")
    G.enforce(G.official_totals(national, official, "brasil"))
    with pytest.raises(G.CheckFailed):
        G.enforce(G.official_totals(national.withColumn("qt_votos", F.col("qt_votos") + 1), official, "brasil"))


def test_abstention_is_suppressed_not_invented(spark):
    voters = spark.createDataFrame([(1, 100), (2, 100), (3, 100)], "id bigint, qt_eleitores bigint")
    turnout = spark.createDataFrame([(1, 80), (2, 120)], "id bigint, comparecimento bigint")
    got = {r.id: (r.abstencao, r.suprimida) for r in V.abstention(voters, turnout, ["id"]).collect()}
    assert got == {1: (20, False), 2: (None, True), 3: (None, False)}


def doc_rows(spark, regioes, trechos=((1, 10),), n=2, provavel=10):
    return spark.createDataFrame([Row(cd_municipio_ibge="1", nome="R", parte=0, regiao_provavel=provavel, n_regioes=n, confianca=.5,
                                      trechos=[Row(numero_inicial=a, id_regiao=b) for a, b in trechos],
                                      regioes=[Row(id_regiao=a, fracao=b) for a, b in regioes] if regioes else None)],
                                 "cd_municipio_ibge string, nome string, parte bigint, regiao_provavel bigint, n_regioes bigint, confianca double, "
                                 "trechos array<struct<numero_inicial:bigint,id_regiao:bigint>>, regioes array<struct<id_regiao:bigint,fracao:double>>")


@pytest.mark.parametrize("regioes,trechos,n,bad", [
    (((10, .6), (20, .4)), ((1, 10), (9, 20)), 2, set()), (((10, .6), (20, .2)), ((1, 10),), 2, {"fractions"}),
    (((20, .4), (10, .6)), ((1, 10),), 2, {"order"}), (((10, .6), (20, .4)), ((1, 99),), 2, {"unknown region"}),
    (None, ((1, 10),), 2, {"ambiguous street"}), (None, ((1, 10),), 1, set())])
def test_street_rules(spark, regioes, trechos, n, bad):
    regions = spark.createDataFrame([("1", 10), ("1", 20)], "cd_municipio_ibge string, id_regiao bigint")
    local = spark.createDataFrame([], "cd_municipio_ibge string, nome string, bairro string, parte bigint, peso bigint, regioes array<struct<id_regiao:bigint,fracao:double>>")
    assert {r.check for r in VAL.street_problems(doc_rows(spark, regioes, trechos, n), local, regions).collect()} == bad


def test_result_rules(spark):
    def cand(*rows):
        return spark.createDataFrame([("X", n, v, p) for n, v, p in rows], "onde string, nome string, votos bigint, pct double")

    totals = spark.createDataFrame([("X", 100)], "onde string, total bigint")

    def checks(df):
        return {r.check for r in VAL.aggregate_problems(df, totals, ["onde"], "t").collect()}

    assert checks(cand(("A", 60, 60.0), ("B", 40, 40.0))) == set()
    assert checks(cand(("A", 60, 60.0), ("A", 40, 40.0))) == {"repeated candidate"}
    assert checks(cand(("A", 90, 60.0), ("B", 40, 40.0))) == {"valid votes"}
    assert checks(cand(("A", 60, 60.0), ("B", 10, 10.0))) == {"percent"}
    assert checks(cand(("A", -1, 120.0))) == {"range", "percent"}
    assert checks(cand(*[(f"C{i}", 2, 2.0) for i in range(50)])) == {"too many candidates"}
    ab = spark.createDataFrame([(1, 10, -1), (2, None, 3), (3, 5, 9), (4, 5, 2)], "id int, qt_eleitores bigint, abstencao bigint")
    assert VAL.abstention_problems(ab, ["id"]).count() == 3
    br = spark.createDataFrame([("2022", 1000)], "ano string, total bigint")
    for ufs, n in ((1001, 1), (995, 0), (980, 1)):
        assert VAL.country_covers_states(br, spark.createDataFrame([("2022", ufs)], "ano string, total bigint"), ["ano"]).count() == n
    keys = spark.createDataFrame([("1-20",), ("12345-1",), (None,), ("a-1",)], "k string")
    assert VAL.key_format(keys, "k", "t").count() == 3


def test_reconcile_marks(spark):
    ours = spark.createDataFrame([("A", 100, 80, 10, 10), ("B", 99, 79, 10, 10), ("C", 100, 81, 9, 10), ("D", 1, 1, 0, 0)], "uf string, comparecimento bigint, validos bigint, brancos bigint, nulos bigint")
    theirs = spark.createDataFrame([(u, 100, 80, 10, 10) for u in "ABC"], "uf string, comparecimento bigint, validos bigint, brancos bigint, nulos bigint")
    marks = {(r.uf, r.total): r.marca for r in REC.compare_totals(ours, theirs, ["uf"]).collect()}
    assert marks["A", "validos"] == " " and marks["B", "validos"] == "~" and marks["C", "brancos"] == "x" and marks["D", "nulos"] == "?"
    a = spark.createDataFrame([("A", "nominal", "13", 120), ("A", "nominal", "22", 5), ("A", "nominal", "99", 11)], "uf string, tipo_voto string, nr_votavel string, votos bigint")
    b = spark.createDataFrame([("A", "nominal", "13", "X", 100), ("A", "nominal", "22", "Y", 9), ("A", "nominal", "30", "Z", 11)], "uf string, tipo_voto string, nr_votavel string, nome string, votos bigint")
    got = {r.nr_votavel: r.marca for r in REC.compare_votables(a, b, ["uf"]).collect()}
    assert got == {"13": "x", "22": " ", "99": "x", "30": "x"}


def test_guards_accept_and_reject(spark):
    df = spark.createDataFrame([("1", "a", 1.0, 5), ("1", "b", None, 6)], "turno string, k string, f double, q bigint")
    G.enforce(G.single_round(df, "t"), G.unique_key(df, ["k"], "t"), G.sum_preserved(df, df, "q", "t"), G.not_empty(df, "t"))
    G.same_schema(df, df.columns, "t")
    for bad in (G.no_missing(df, ["f"], "t"), G.unique_key(df, ["turno"], "t"), G.code_width(df, "k", "t", 5), G.exactly_one(df, "t"),
                G.not_empty(df.where("false"), "t"), G.join_rate(df, df.where("false"), ["k"], "t"), G.constant_per_group(df, ["turno"], ["k"], "t")):
        with pytest.raises(G.CheckFailed):
            G.enforce(bad)
    with pytest.raises(G.CheckFailed):
        V.ordinary_only(df)
    with pytest.raises(ValueError):
        from meshtally.functions.geo import require_metric
        require_metric("EPSG:4674", "t")


def test_live_pieces(spark):
    sent = spark.createDataFrame([("s", "Recebido", 1), ("s", "Totalizado", 2), ("s", "Rejeitado", 3), ("t", None, 1), ("t", "Recebido", 2)], "secao string, situacao string, ordem bigint")
    assert {r.secao: r.ordem for r in L.valid_transmission(sent, ["secao"]).collect()} == {"s": 2, "t": 2}
    rows = spark.createDataFrame([(1, 1, "nominal", 13, 13), (1, 1, "legenda", 77, 77)], "id_regiao bigint, cargo int, tipo string, partido bigint, numero bigint")
    named = L.named_votables(rows.drop("partido").withColumn("cargo", F.lit("presidente")), spark.createDataFrame([("presidente", "presidente", "13", "Fulana", "PT")], "unidade string, cargo string, numero string, nome string, partido string"), F.lit("presidente"))
    assert {r.numero: (r.nome, r.partido) for r in named.collect()} == {13: ("Fulana", "PT"), 77: ("Partido 77", None)}
    today = F.lit("2026-10-04").cast("date")
    r = one(spark, a=L.dormant(F.lit("05/10/2026"), today), b=L.dormant(F.lit("04/10/2026"), today), c=L.dormant(F.lit("?"), today),
            d=FV.is_settled(F.lit("provavel"), F.lit(2)), e=FV.is_settled(F.lit("provavel"), F.lit(1)), f=FV.is_settled(F.lit("interpolada"), F.lit(5)))
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (True, False, False, False, True, True)


def test_divergence_points_at_the_far_source(spark):
    mapping = spark.createDataFrame([(f"p{i}", i) for i in range(5)], "id_local_votacao string, id_regiao bigint")
    regions = spark.createDataFrame([(i, -12.0 - i / 1000, -62.0, "1", "A", "RO", "cnefe") for i in range(5)],
                                    "id_regiao bigint, latitude_final double, longitude_final double, cd_municipio_ibge string, nm_municipio string, sg_uf string, origem_coordenada string")
    official = spark.createDataFrame([(f"p{i}", "n", -12.0 - i / 1000, -62.0 + (1.0 if i == 3 else 0.0)) for i in range(5)],
                                     "id_local_votacao string, nm_local_votacao string, latitude double, longitude double")
    rows = {r.id_local_votacao: r for r in R.coordinate_divergence(mapping, regions, official).collect()}
    assert rows["p3"].suspeito == "tse" and rows["p3"].distancia_m > 100_000 and rows["p0"].distancia_m == 0
