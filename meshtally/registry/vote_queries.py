"""Vote tables, territory results and comparisons on the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshtally.functions import text
from meshtally.functions import votes as FV
from meshtally.operators import shares, votes as V
from meshtally.plans import guarded as GRD
from meshtally.plans import live as L
from meshtally.plans import mesh as M
from meshtally.plans import publish as PUB
from meshtally.registry.common import (CLEAN_VOTE, MESH, REGION_VOTE, SECTION, VOTER, pct_sql, query, tidy)
from meshtally.registry.mesh_queries import mesh, voters
from meshtally.session import settle

RV = dict(**MESH, region_vote=REGION_VOTE)


def cand_sql(where: str, src: str, kinds: str = "'nominal','legenda'") -> str:
    return (f"SELECT {where}, ano_eleicao, turno, cargo, nm_votavel, sg_partido, CAST(SUM(qt_votos) AS BIGINT) AS votos, "
            f"ANY_VALUE(validos) AS validos FROM (SELECT *, CAST(SUM(qt_votos) OVER (PARTITION BY {where}, ano_eleicao, turno, cargo) "
            f"AS BIGINT) AS validos FROM {{{src}}} WHERE tipo_voto IN ({kinds})) WHERE tipo_voto = 'nominal' "
            f"GROUP BY {where}, ano_eleicao, turno, cargo, nm_votavel, sg_partido")


def clean(s):
    return V.clean_votes(V.ordinary_only(s.vote_raw))


def region_votes(s):
    """Votes by region as later steps find them: a stored table."""
    return settle(V.votes_per_region(s.vote, mesh(s)[1]))


def placed(s):
    """Votes with their municipality."""
    return s.vote.withColumn("cd_municipio_tse", text.key_part(F.col("id_local_votacao"), 1))


TOWN_VOTE = "SELECT *, split_part(id_local_votacao, '_', 2) AS cd_municipio_tse FROM {vote}"
_Y = "CAST(ano_eleicao AS BIGINT) AS ano_eleicao"


def _moved(s):
    """Every region of an even id moves one down: an arbitrary but complete re-allocation."""
    _, mapping = mesh(s)
    moved = mapping.select("id_regiao").distinct().withColumn(
        "destino", F.col("id_regiao") - F.when(F.col("id_regiao") % 2 == 0, 1).otherwise(0))
    return V.votes_per_region(s.vote, mapping, moved)


def _national(s):
    """National totals exist for all but the last year, and include abroad."""
    return V.national_totals(s.vote.where("ano_eleicao < 2026"))


COUNTRY = """
    SELECT n.ano_eleicao, n.turno, n.cargo, n.nm_votavel, p.sg_partido,
           CASE WHEN UPPER(n.nm_votavel) LIKE 'VOTO %NULO%' THEN 'nulo' WHEN UPPER(n.nm_votavel) LIKE 'VOTO %BRANCO%' THEN 'branco'
                ELSE 'nominal' END AS tipo_voto, n.qt_votos
    FROM (SELECT ano_eleicao, turno, cargo, nm_votavel, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos FROM {vote} WHERE ano_eleicao < 2026 GROUP BY ALL) n
    LEFT JOIN (SELECT ano_eleicao, nm_votavel, MIN(sg_partido) AS sg_partido FROM {vote} WHERE tipo_voto = 'nominal' GROUP BY 1, 2) p
         USING (ano_eleicao, nm_votavel)
    UNION ALL SELECT ano_eleicao, turno, cargo, nm_votavel, sg_partido, tipo_voto, qt_votos FROM {vote} WHERE ano_eleicao >= 2026"""


def _territories(s):
    """Local (municipality) against state shares for president."""
    pres = placed(s).where("cargo = 'PRESIDENTE'")
    key = ["sg_uf", "cd_municipio_tse", "ano_eleicao", "turno"]
    low = V.candidate_results(pres, ["sg_uf", "cd_municipio_tse"]).select(
        *key, F.col("nm_votavel").alias("nome"), "votos", "pct")
    high = V.candidate_results(pres, ["sg_uf"]).select(
        "sg_uf", "ano_eleicao", "turno", F.col("nm_votavel").alias("nome"), "pct")
    wide = low.select(*key).distinct().join(high, ["sg_uf", "ano_eleicao", "turno"])
    return tidy(L.compare_territories(low, wide, key))


def _bound(s):
    """Customers' spending limits a region of the catalogue: some exceed and are withheld."""
    rows = s.sql("""SELECT c_nationkey AS id_regiao, CAST(c_nationkey % 5 AS STRING) AS cd_municipio_ibge, o_orderpriority AS nome,
                           COUNT(*) AS votos FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2, 3""")
    limits = s.sql("""SELECT CAST(c_nationkey % 5 AS STRING) AS cd_municipio_ibge, o_orderpriority AS nome, CAST(FLOOR(COUNT(*) * 230 / 1000) AS BIGINT) AS limite
                      FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2""")
    return tidy(L.withhold(rows, limits, ["cd_municipio_ibge"]))


def _overlay(s):
    rows = V.candidate_results(placed(s), ["cd_municipio_tse"]).withColumn("cargo", text.office_slug(F.col("cargo")))
    rows = rows.select("cd_municipio_tse", "cargo", "ano_eleicao", "turno", F.col("nm_votavel").alias("nome"), "votos")
    keys = ["cd_municipio_tse", "cargo", "ano_eleicao", "turno"]
    return tidy(L.overlay(rows.where("ano_eleicao < 2026"), rows.where("ano_eleicao >= 2022").withColumn("votos", F.col("votos") + 1), keys))


def _live_abstention(s):
    """Round-2 voters are missing in 2026, so round 1 stands in."""
    enrolled = voters(s).join(mesh(s)[1], "id_local_votacao").where("not (ano_eleicao = 2026 and turno = '2')")
    enrolled = enrolled.groupBy("id_regiao", "ano_eleicao", "turno").agg(F.sum("qt_eleitores").alias("qt_eleitores"))
    turnout = region_votes(s).where("cargo = 'PRESIDENTE'").groupBy("id_regiao", "ano_eleicao", "turno").agg(F.sum("qt_votos").alias("comparecimento"))
    return tidy(L.live_abstention(enrolled, turnout))


REGION_VOTER = """SELECT id_regiao, ano_eleicao, turno, CAST(SUM(qt_eleitores) AS BIGINT) AS qt_eleitores
                  FROM {voter} JOIN {mapping} USING (id_local_votacao) GROUP BY ALL"""
SHARE = """
    SELECT id_regiao, ano_eleicao, turno, nm_votavel, sg_partido, votos, validos, row_number() OVER (PARTITION BY id_regiao ORDER BY votos DESC, nm_votavel) AS r,
           SUM(votos) OVER (PARTITION BY id_regiao)::BIGINT AS soma
    FROM (SELECT *, rank() OVER (PARTITION BY id_regiao ORDER BY ano_eleicao DESC, turno DESC) AS k FROM {cand} WHERE cargo = 'PRESIDENTE') WHERE k = 1"""


def _share(s):
    regions, mapping = mesh(s)
    df = PUB.share_summary(regions, mapping, V.votes_per_region(s.vote, mapping))
    c = F.col("candidatos")
    return tidy(df.select("regiao", "ano", "turno", "validos", F.size(c).alias("n"), c[0]["nome"].alias("primeiro"),
                          c[0]["pct"].alias("pct1"), F.get(c, F.lit(1))["nome"].alias("segundo"),
                          F.col("deputado.nome").alias("deputado"), F.col("deputado.ano").alias("ano_dep")))


QUERIES = {
    "votes_per_place": query(
        lambda s: tidy(V.attach_party(V.votes_per_place(clean(s)), s.register)),
        f"""SELECT id_local_votacao, sg_uf, {_Y}, turno, cargo, sq_candidato, nr_votavel, nm_votavel,
                   CASE WHEN tipo_voto = 'legenda' THEN l.sg ELSE c.sg END AS sg_partido, tipo_voto, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos
            FROM {{clean_vote}} LEFT JOIN (SELECT SQ_CANDIDATO AS sq_candidato, MIN(SG_PARTIDO) AS sg FROM {{register}} GROUP BY 1) c USING (sq_candidato)
            LEFT JOIN (SELECT NR_PARTIDO AS nr_votavel, MIN(SG_PARTIDO) AS sg FROM {{register}} GROUP BY 1) l USING (nr_votavel)
            GROUP BY 1,2,3,4,5,6,7,8,9,10""", clean_vote=CLEAN_VOTE),
    "national_totals": query(
        lambda s: tidy(V.national_totals(clean(s))),
        f"SELECT {_Y}, turno, cargo, nm_votavel, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos FROM {{clean_vote}} GROUP BY 1,2,3,4",
        clean_vote=CLEAN_VOTE),
    "vote_types": query(
        lambda s: tidy(s.vote_raw.select(FV.vote_type(F.col("NR_VOTAVEL"), F.col("SQ_CANDIDATO")).alias("tipo_voto"),
                                         FV.vote_type_from_name(F.col("NM_VOTAVEL")).alias("tipo_nome"))
                       .groupBy("tipo_voto", "tipo_nome").agg(F.count("*").alias("linhas"))),
        """SELECT CASE WHEN NR_VOTAVEL='95' THEN 'branco' WHEN NR_VOTAVEL='96' THEN 'nulo' WHEN NR_VOTAVEL='97' THEN 'anulado'
                       WHEN SQ_CANDIDATO='-3' OR (SQ_CANDIDATO='-1' AND LENGTH(NR_VOTAVEL)=2) THEN 'legenda' ELSE 'nominal' END AS tipo_voto,
                  CASE WHEN NM_VOTAVEL LIKE 'VOTO %ANULADO' THEN 'anulado' WHEN NM_VOTAVEL LIKE 'VOTO %NULO' THEN 'nulo'
                       WHEN NM_VOTAVEL LIKE 'VOTO %BRANCO' THEN 'branco' ELSE 'nominal' END AS tipo_nome, COUNT(*) AS linhas
           FROM {vote_raw} GROUP BY 1, 2"""),
    "one_office": query(
        lambda s: tidy(V.of_office(s.vote_raw, "Presidénte").groupBy("SG_UF").agg(F.count("*").alias("linhas"))),
        "SELECT SG_UF, COUNT(*) AS linhas FROM {vote_raw} WHERE UPPER(DS_CARGO) = 'PRESIDENTE' GROUP BY 1"),
    "votes_per_region": query(
        lambda s: tidy(V.votes_per_region(s.vote, mesh(s)[1])),
        f"SELECT id_regiao, sg_uf, {_Y}, turno, cargo, sq_candidato, nr_votavel, nm_votavel, sg_partido, tipo_voto, qt_votos FROM {{region_vote}}", **RV),
    "guarded_region_votes": query(
        lambda s: tidy(GRD.region_votes(s.vote, mesh(s)[1]).groupBy("id_regiao", "ano_eleicao", "turno", "cargo").agg(F.sum("qt_votos").alias("qt_votos"))),
        f"SELECT id_regiao, {_Y}, turno, cargo, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos FROM {{region_vote}} GROUP BY 1, ano_eleicao, 3, 4", **RV),
    "guarded_party_votes": query(
        lambda s: tidy(GRD.party(V.votes_per_place(clean(s)), s.register).groupBy("sg_partido", "tipo_voto").agg(F.sum("qt_votos").alias("qt_votos"))),
        """SELECT CASE WHEN tipo_voto = 'legenda' THEN l.sg ELSE c.sg END AS sg_partido, tipo_voto, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos FROM {clean_vote}
           LEFT JOIN (SELECT SQ_CANDIDATO AS sq_candidato, MIN(SG_PARTIDO) AS sg FROM {register} GROUP BY 1) c USING (sq_candidato)
           LEFT JOIN (SELECT NR_PARTIDO AS nr_votavel, MIN(SG_PARTIDO) AS sg FROM {register} GROUP BY 1) l USING (nr_votavel) GROUP BY 1, 2""", clean_vote=CLEAN_VOTE),
    "reallocated_votes": query(
        lambda s: tidy(_moved(s)),
        f"""SELECT id_regiao - (id_regiao + 1) % 2 AS id_regiao, sg_uf, {_Y}, turno, cargo, sq_candidato, nr_votavel, nm_votavel, sg_partido,
                   tipo_voto, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos FROM {{region_vote}} GROUP BY 1,2,3,4,5,6,7,8,9,10""", **RV),
    "votes_outside_mesh": query(
        lambda s: tidy(V.outside_mesh(s.vote, mesh(s)[1].join(s.place.where("s_suppkey % 4 <> 0"), "id_local_votacao", "left_semi"))),
        """SELECT CAST(COALESCE(SUM(qt_votos), 0) AS BIGINT) AS votos_fora, COUNT(DISTINCT id_local_votacao) AS locais_fora FROM {vote}
           JOIN {place} USING (id_local_votacao) WHERE s_suppkey % 4 = 0"""),
    "contest_totals": query(
        lambda s: tidy(V.contest_totals(placed(s), ["cd_municipio_tse"])),
        f"""SELECT *, {pct_sql('brancos', 'total')} AS pct_brancos, {pct_sql('nulos', 'total')} AS pct_nulos FROM (
              SELECT cd_municipio_tse, {_Y}, turno, cargo,
                CAST(COALESCE(SUM(qt_votos) FILTER (tipo_voto IN ('nominal','legenda')),0) AS BIGINT) AS validos, CAST(SUM(qt_votos) AS BIGINT) AS total,
                CAST(COALESCE(SUM(qt_votos) FILTER (tipo_voto = 'branco'),0) AS BIGINT) AS brancos,
                CAST(COALESCE(SUM(qt_votos) FILTER (tipo_voto = 'nulo'),0) AS BIGINT) AS nulos FROM {{town_vote}} GROUP BY 1,2,3,4)""", town_vote=TOWN_VOTE),
    "candidate_results": query(
        lambda s: tidy(V.candidate_results(region_votes(s), ["id_regiao"])),
        f"SELECT id_regiao, {_Y}, turno, cargo, nm_votavel, sg_partido, votos, validos, {pct_sql('votos', 'validos')} AS pct FROM {{cand}}",
        **RV, cand=cand_sql("id_regiao", "region_vote")),
    "top_candidates": query(
        lambda s: tidy(V.top_candidates(V.candidate_results(region_votes(s), ["id_regiao"]), ["id_regiao"], 3).drop("pct", "validos")),
        f"""SELECT id_regiao, {_Y}, turno, cargo, nm_votavel, sg_partido, votos, row_number() OVER (PARTITION BY id_regiao, ano_eleicao, turno, cargo
                   ORDER BY votos DESC, nm_votavel) AS rank FROM {{cand}} QUALIFY rank <= 3""", **RV, cand=cand_sql("id_regiao", "region_vote")),
    "territory_rollup": query(
        lambda s: tidy(V.territory_results(placed(s), ["sg_uf", "cd_municipio_tse"])),
        f"""SELECT sg_uf, cd_municipio_tse, {_Y}, turno, cargo, tipo_voto, nm_votavel, sg_partido, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos,
                   CAST(2 - GROUPING(sg_uf) - GROUPING(cd_municipio_tse) AS BIGINT) AS nivel
            FROM (SELECT * REPLACE (CAST(ano_eleicao AS BIGINT) AS ano_eleicao) FROM {{town_vote}})
            GROUP BY GROUPING SETS ((sg_uf, cd_municipio_tse, ano_eleicao, turno, cargo, tipo_voto, nm_votavel, sg_partido),
              (sg_uf, ano_eleicao, turno, cargo, tipo_voto, nm_votavel, sg_partido), (ano_eleicao, turno, cargo, tipo_voto, nm_votavel, sg_partido))""",
        town_vote=TOWN_VOTE),
    "region_nation_rollup": query(
        lambda s: tidy(s.sql("""SELECT r_name, n_name, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS centavos FROM {orders} JOIN {customer} ON o_custkey = c_custkey
                                JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""")
                       .rollup("r_name", "n_name").agg(F.count("*").alias("pedidos"), F.sum("centavos").alias("centavos"),
                                                       F.grouping_id().alias("nivel"))),
        """SELECT r_name, n_name, COUNT(*) AS pedidos, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS centavos,
                  CAST(GROUPING(r_name) * 2 + GROUPING(n_name) AS BIGINT) AS nivel
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           GROUP BY ROLLUP (r_name, n_name)"""),
    "country_votes": query(
        lambda s: tidy(V.country_votes(_national(s), s.vote).groupBy("ano_eleicao", "turno", "cargo", "nm_votavel", "sg_partido", "tipo_voto")
                       .agg(F.sum("qt_votos").alias("qt_votos"))),
        f"SELECT {_Y}, turno, cargo, nm_votavel, sg_partido, tipo_voto, CAST(SUM(qt_votos) AS BIGINT) AS qt_votos FROM {{country}} GROUP BY 1,2,3,4,5,6",
        country=COUNTRY),
    "levels_agree": query(
        # The state side lacks one municipality, so its states disagree.
        lambda s: V.levels_agree(V.contest_totals(placed(s).where("cd_municipio_tse <> '00003'"), ["sg_uf"]).select("sg_uf", *V.CONTEST, "total"),
                                 V.contest_totals(placed(s), ["sg_uf", "cd_municipio_tse"])),
        """SELECT 'levels agree' AS "check", 'state x municipalities' AS context,
                  CONCAT(sg_uf, ' ', ano_eleicao, '/', turno, ': ', COALESCE(CAST(a AS STRING), 'none'), ' x ', b) AS detail
           FROM (SELECT sg_uf, ano_eleicao, turno, cargo, SUM(qt_votos) FILTER (cd_municipio_tse <> '00003') AS a, SUM(qt_votos) AS b
                 FROM {town_vote} GROUP BY 1,2,3,4) WHERE a IS DISTINCT FROM b""", town_vote=TOWN_VOTE),
    "abstention": query(
        lambda s: tidy(PUB.region_voters(voters(s), mesh(s)[1], region_votes(s))),
        f"""SELECT id_regiao, {_Y}, turno, qt_eleitores, comparecimento, CASE WHEN qt_eleitores >= comparecimento THEN qt_eleitores - comparecimento END AS abstencao,
                   COALESCE(qt_eleitores < comparecimento, FALSE) AS suprimida
            FROM {{region_voter}} LEFT JOIN (SELECT id_regiao, ano_eleicao, turno, CAST(SUM(qt_votos) AS BIGINT) AS comparecimento FROM {{region_vote}}
              WHERE cargo = 'PRESIDENTE' GROUP BY 1,2,3) USING (id_regiao, ano_eleicao, turno)""", **RV, section=SECTION, voter=VOTER, region_voter=REGION_VOTER),
    "live_abstention": query(
        _live_abstention,
        f"""SELECT t.id_regiao, CAST(t.ano_eleicao AS BIGINT) AS ano_eleicao, t.turno, t.comparecimento, e.qt AS qt_eleitores,
                   CASE WHEN e.qt >= t.comparecimento THEN e.qt - t.comparecimento END AS abstencao
            FROM (SELECT id_regiao, ano_eleicao, turno, CAST(SUM(qt_votos) AS BIGINT) AS comparecimento FROM {{region_vote}} WHERE cargo = 'PRESIDENTE' GROUP BY 1,2,3) t
            LEFT JOIN (SELECT id_regiao, ano_eleicao, tt AS turno, COALESCE(MAX(qt_eleitores) FILTER (turno = tt AND NOT (ano_eleicao = 2026 AND turno = '2')),
                              MAX(qt_eleitores) FILTER (turno = '1')) AS qt FROM {{region_voter}} CROSS JOIN (VALUES ('1'), ('2')) v(tt) GROUP BY 1,2,3) e
            USING (id_regiao, ano_eleicao, turno)""", **RV, section=SECTION, voter=VOTER, region_voter=REGION_VOTER),
    "fold_tail": query(
        lambda s: tidy(shares.fold_tail(s.sql("""SELECT n_name, p_brand, CAST(SUM(l_quantity) AS BIGINT) AS votos FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
            JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey GROUP BY 1, 2"""), ["n_name"], "p_brand", "votos", 5)),
        """SELECT n_name, CASE WHEN r <= 5 OR n <= 6 THEN r ELSE 6 END AS rank, CASE WHEN r <= 5 OR n <= 6 THEN p_brand ELSE 'Outros' END AS p_brand,
                  CAST(SUM(votos) AS BIGINT) AS votos
           FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY votos DESC, p_brand) AS r, COUNT(*) OVER (PARTITION BY n_name) AS n
                 FROM (SELECT n_name, p_brand, CAST(SUM(l_quantity) AS BIGINT) AS votos FROM lineitem JOIN part ON l_partkey = p_partkey
                       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)) GROUP BY 1,2,3"""),
    "compare_territories": query(
        _territories,
        f"""SELECT sg_uf, cd_municipio_tse, {_Y}, turno, CASE WHEN r <= 3 THEN r ELSE 4 END AS rank, CASE WHEN r <= 3 THEN nm_votavel ELSE 'Outros' END AS nome,
                   ROUND(SUM(COALESCE(lp, 0.0)), 4) AS pct, ROUND(SUM(COALESCE(hp, 0.0)), 4) AS pct_territorio,
                   ROUND(SUM(COALESCE(lp, 0.0)) - SUM(COALESCE(hp, 0.0)), 4) AS diferenca_pp
            FROM (SELECT k.*, nm_votavel, hp, l.pct AS lp, COALESCE(l.r, 99) AS r FROM (SELECT DISTINCT sg_uf, cd_municipio_tse, ano_eleicao, turno FROM {{low}}) k
                  JOIN (SELECT sg_uf, ano_eleicao, turno, nm_votavel, {pct_sql('votos', 'validos')} AS hp FROM {{high}}) h USING (sg_uf, ano_eleicao, turno)
                  LEFT JOIN (SELECT *, {pct_sql('votos', 'validos')} AS pct, row_number() OVER (PARTITION BY sg_uf, cd_municipio_tse, ano_eleicao, turno
                             ORDER BY votos DESC, nm_votavel) AS r FROM {{low}}) l USING (sg_uf, cd_municipio_tse, ano_eleicao, turno, nm_votavel))
            GROUP BY 1,2,3,4,5,6""", town_vote=TOWN_VOTE, pres="SELECT * FROM {town_vote} WHERE cargo = 'PRESIDENTE'",
        low=cand_sql("sg_uf, cd_municipio_tse", "pres"), high=cand_sql("sg_uf", "pres")),
    "leadership_change": query(
        lambda s: tidy(L.leadership_change(V.candidate_results(region_votes(s), ["id_regiao"]).where("cargo = 'PRESIDENTE'"), ["id_regiao"])),
        """SELECT id_regiao, CAST(MIN(ano_eleicao) AS BIGINT) AS ano_antes, arg_min(nm_votavel, ano_eleicao) AS lider_antes,
                  CAST(MAX(ano_eleicao) AS BIGINT) AS ano_agora, arg_max(nm_votavel, ano_eleicao) AS lider_agora,
                  arg_min(nm_votavel, ano_eleicao) <> arg_max(nm_votavel, ano_eleicao) AS mudou
           FROM (SELECT * FROM {cand} WHERE cargo = 'PRESIDENTE' QUALIFY row_number() OVER (PARTITION BY id_regiao, ano_eleicao
                 ORDER BY turno DESC, votos DESC, nm_votavel) = 1) GROUP BY 1""", **RV, cand=cand_sql("id_regiao", "region_vote")),
    "latest_contest": query(
        lambda s: tidy(L.latest_contest(V.candidate_results(region_votes(s), ["id_regiao"]), ["id_regiao"]).drop("pct", "validos")),
        f"""SELECT id_regiao, {_Y}, turno, cargo, nm_votavel, sg_partido, votos FROM {{cand}}
            QUALIFY rank() OVER (PARTITION BY id_regiao ORDER BY ano_eleicao DESC, turno DESC) = 1""", **RV, cand=cand_sql("id_regiao", "region_vote")),
    "upper_bound_guard": query(
        _bound,
        """WITH r AS (SELECT c_nationkey AS id_regiao, CAST(c_nationkey % 5 AS STRING) AS cd_municipio_ibge, o_orderpriority AS nome, COUNT(*) AS votos
                      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1,2,3),
                l AS (SELECT CAST(c_nationkey % 5 AS STRING) AS cd_municipio_ibge, o_orderpriority AS nome, CAST(FLOOR(COUNT(*) * 230 / 1000) AS BIGINT) AS limite
                      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1,2)
           SELECT CAST(id_regiao AS BIGINT) AS id_regiao, cd_municipio_ibge, nome, votos FROM r WHERE id_regiao NOT IN
             (SELECT id_regiao FROM r JOIN l USING (cd_municipio_ibge, nome) WHERE votos > limite)"""),
    "partial_overlay": query(
        _overlay,
        f"""SELECT cd_municipio_tse, REPLACE(LOWER(cargo),' ','_') AS cargo, {_Y}, turno, nm_votavel AS nome,
                   votos + CASE WHEN ano_eleicao >= 2026 THEN 1 ELSE 0 END AS votos, ano_eleicao >= 2026 AS parcial FROM {{cand}}
            QUALIFY ano_eleicao < 2026 OR cargo = 'PRESIDENTE' OR row_number() OVER (PARTITION BY cd_municipio_tse, cargo, ano_eleicao, turno
              ORDER BY votos DESC, nm_votavel) <= 3""", town_vote=TOWN_VOTE, cand=cand_sql("cd_municipio_tse", "town_vote")),
    "share_summary": query(
        _share,
        f"""SELECT id_regiao AS regiao, CAST(ano_eleicao AS STRING) AS ano, turno, soma AS validos, n, primeiro, pct1, segundo,
                   CASE WHEN deputado LIKE 'CANDIDATO %' THEN 'Candidato ' || deputado[11:] ELSE deputado END AS deputado, ano_dep FROM (
              SELECT id_regiao, ANY_VALUE(ano_eleicao) AS ano_eleicao, ANY_VALUE(turno) AS turno, ANY_VALUE(soma) AS soma, COUNT(*) AS n,
                     MAX(CASE WHEN nm_votavel LIKE 'CANDIDATO %' THEN 'Candidato ' || nm_votavel[11:] ELSE nm_votavel END) FILTER (r = 1) AS primeiro, MAX({pct_sql('votos', 'validos')}) FILTER (r = 1) AS pct1,
                     MAX(CASE WHEN nm_votavel LIKE 'CANDIDATO %' THEN 'Candidato ' || nm_votavel[11:] ELSE nm_votavel END) FILTER (r = 2) AS segundo FROM {{share}} WHERE r <= 2 GROUP BY 1)
            LEFT JOIN (SELECT id_regiao, nm_votavel AS deputado, CAST(ano_eleicao AS STRING) AS ano_dep FROM {{cand}}
                       WHERE cargo = 'DEPUTADO FEDERAL' AND turno = '1' QUALIFY row_number() OVER (PARTITION BY id_regiao
                       ORDER BY ano_eleicao DESC, votos DESC, nm_votavel) = 1) USING (id_regiao)""",
        **RV, cand=cand_sql("id_regiao", "region_vote"), share=SHARE),
    "round_counters": query(
        lambda s: tidy(V.round_counters(s.vote)),
        f"SELECT {_Y}, turno, COUNT(*) AS linhas, CAST(SUM(qt_votos) AS BIGINT) AS votos FROM {{vote}} GROUP BY 1, 2"),
    "region_documents": query(
        lambda s: tidy(PUB.region_documents(*mesh(s), region_votes(s), voters(s))
                       .select("cd_municipio_ibge", "id_regiao", "local", "total_votos", "nao_nominal", "eleitorado", F.explode("resultados").alias("cargo", "anos"))
                       .select("*", F.explode("anos").alias("ano", "turnos")).select("*", F.explode("turnos").alias("turno", "candidatos"))
                       .select("cd_municipio_ibge", "id_regiao", "local", "cargo", "ano", "turno", F.col("total_votos")[F.col("cargo")][F.col("ano")][F.col("turno")].alias("total"),
                               F.col("nao_nominal")[F.col("cargo")][F.col("ano")][F.col("turno")]["branco"]["votos"].alias("brancos"),
                               F.col("eleitorado")[F.col("ano")][F.col("turno")].alias("eleitores"), F.posexplode("candidatos").alias("posicao", "c"))
                       .select("*", "c.*").drop("c")),
        f"""SELECT cd_municipio_ibge, id_regiao, nm_local_votacao AS local, CASE WHEN cargo = 'PRESIDENTE' THEN 'presidente' ELSE 'deputado_federal' END AS cargo,
                   CAST(ano_eleicao AS STRING) AS ano, turno, total, brancos, qt_eleitores AS eleitores, r - 1 AS posicao,
                   CASE WHEN nm_votavel LIKE 'CANDIDATO %' THEN 'Candidato ' || nm_votavel[11:] ELSE nm_votavel END AS nome, sg_partido AS partido, votos,
                   {pct_sql('votos', 'validos')} AS pct
            FROM (SELECT *, row_number() OVER (PARTITION BY id_regiao, cargo, ano_eleicao, turno ORDER BY votos DESC, nm_votavel) AS r FROM {{cand}})
            JOIN {{region_dim}} USING (id_regiao)
            JOIN (SELECT id_regiao, cargo, ano_eleicao, turno, CAST(SUM(qt_votos) AS BIGINT) AS total, CAST(COALESCE(SUM(qt_votos) FILTER (tipo_voto = 'branco'), 0) AS BIGINT) AS brancos
                  FROM {{region_vote}} GROUP BY 1, 2, 3, 4) USING (id_regiao, cargo, ano_eleicao, turno)
            LEFT JOIN (SELECT id_regiao, ano_eleicao, turno, CAST(SUM(qt_eleitores) AS BIGINT) AS qt_eleitores FROM {{voter}} JOIN {{mapping}} USING (id_local_votacao)
                       GROUP BY 1, 2, 3) USING (id_regiao, ano_eleicao, turno)
            WHERE cargo = 'PRESIDENTE' OR r <= 3""", **RV, section=SECTION, voter=VOTER, cand=cand_sql("id_regiao", "region_vote")),
    "region_document_names": query(
        lambda s: (lambda m: tidy(PUB.region_documents(*m, region_votes(s), voters(s), M.other_names(s.located, m[1]), size=1)
                                  .select("id_regiao", "parte", F.explode("outros_locais").alias("nome"))))(mesh(s)),
        """SELECT id_regiao, row_number() OVER (PARTITION BY id_regiao ORDER BY nome) - 1 AS parte, nome FROM (
             SELECT DISTINCT id_regiao, nm_local_votacao_consolidado AS nome FROM {located} JOIN {mapping} USING (id_local_votacao)
             QUALIFY nm_local_votacao_consolidado <> MIN(nm_local_votacao_consolidado) OVER (PARTITION BY id_regiao))""", **MESH),
    "aggregate_documents": query(
        lambda s: tidy(PUB.aggregate_documents(placed(s), ["sg_uf"]).select(
            "sg_uf", "ano_eleicao", "turno", "validos", "total", F.posexplode_outer("candidatos").alias("posicao", "c"))
            .select("sg_uf", "ano_eleicao", "turno", "validos", "total", "posicao", "c.*")),
        f"""SELECT sg_uf, {_Y}, turno, validos, total, row_number() OVER (PARTITION BY sg_uf, ano_eleicao, turno ORDER BY votos DESC, nm_votavel) - 1 AS posicao,
                   CASE WHEN nm_votavel LIKE 'CANDIDATO %' THEN 'Candidato ' || nm_votavel[11:] ELSE nm_votavel END AS nome, sg_partido AS partido, votos,
                   {pct_sql('votos', 'validos')} AS pct
            FROM {{cand}} JOIN (SELECT sg_uf, ano_eleicao, turno, CAST(SUM(qt_votos) AS BIGINT) AS total FROM {{pres}} GROUP BY 1, 2, 3) USING (sg_uf, ano_eleicao, turno)""",
        pres="SELECT * FROM {vote} WHERE cargo = 'PRESIDENTE'", cand=cand_sql("sg_uf", "pres", "'nominal'")),
}
