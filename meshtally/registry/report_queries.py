"""Quality reports and text operators on the given and derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshtally.functions import numbers, text
from meshtally.operators import guards as G
from meshtally.operators import places as P
from meshtally.operators import votes as V
from meshtally.operators.addresses import distance_summary
from meshtally.operators.nearest import nearest_in_group
from meshtally.operators.ordered import exact_percentiles
from meshtally.operators.shares import weighted, member_shares
from meshtally.plans import live as L
from meshtally.plans import publish as PUB
from meshtally.plans import reports as R
from meshtally.plans import resolve as RES
from meshtally.plans import validate as VAL
from meshtally.registry.common import MESH, REGION_VOTE, SECTION, haversine_sql, pct_sql, query, tidy
from meshtally.registry.mesh_queries import mesh
from meshtally.session import settle

_HAV = haversine_sql("la", "lo", "lb", "lc")


def divergence(s):
    # Two registers of the same points: the second is shifted, some by far.
    regions, mapping = mesh(s)
    other = s.sql("""SELECT id_local_votacao, nome AS nm_local_votacao, lat + CAST(s_suppkey % 9 AS DOUBLE) / 100 AS latitude,
                            lon - CASE WHEN s_suppkey % 8 = 3 THEN 0.5 ELSE 0.0 END AS longitude FROM {place}""")
    return R.coordinate_divergence(mapping, regions, other)


DIVERGENCE = dict(
    **MESH,
    pair="""SELECT m.id_local_votacao, r.cd_municipio_ibge, r.latitude_final AS la, r.longitude_final AS lo,
                   p.lat + CAST(s_suppkey % 9 AS DOUBLE) / 100 AS lb, p.lon - CASE WHEN s_suppkey % 8 = 3 THEN 0.5 ELSE 0.0 END AS lc
            FROM {mapping} m JOIN {region_dim} r USING (id_regiao) JOIN {place} p USING (id_local_votacao) WHERE r.origem_coordenada = 'cnefe'""",
    measured=f"""
        SELECT id_local_votacao, cd_municipio_ibge, {_HAV} AS distancia_m,
               {haversine_sql('la', 'lo', 'ma', 'mo')} AS ao_centro_nosso, {haversine_sql('lb', 'lc', 'mb', 'mc')} AS ao_centro_tse
        FROM {{pair}} JOIN (SELECT cd_municipio_ibge, median(la) AS ma, median(lo) AS mo, median(lb) AS mb, median(lc) AS mc FROM {{pair}} GROUP BY 1)
             USING (cd_municipio_ibge)""")


def distances(s):
    """Distance from customers to the nearest supplier of their nation, per supplier."""
    near = nearest_in_group(
        s.sql("SELECT c_custkey, c_nationkey AS n, c_acctbal * 3 AS x, CAST(c_custkey % 997 AS DOUBLE) AS y FROM {customer}"),
        s.sql("SELECT s_suppkey AS id_regiao, s_nationkey AS n, s_acctbal * 3 AS x, CAST(s_suppkey % 997 AS DOUBLE) AS y FROM {supplier}"),
        ["n"], ("x", "y"), ("x", "y"), "id_regiao")
    return settle(distance_summary(near.where("id_regiao is not null")))


def _regions(s):
    return s.sql("""SELECT s_suppkey AS id_regiao, CAST(n_regionkey AS STRING) AS sg_uf, CAST(n_nationkey AS STRING) AS cd_municipio_ibge,
                           n_name AS nm_municipio, s_name AS nm_local_votacao, s_name AS ds_endereco FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""")


DIST = dict(
    near="""SELECT s_suppkey AS id_regiao, sqrt(d2) AS d FROM (SELECT c_custkey, s_suppkey, power(c_acctbal*3-s_acctbal*3,2)+power(c_custkey%997-s_suppkey%997,2) AS d2
            FROM {customer} JOIN {supplier} ON c_nationkey = s_nationkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d2, s_suppkey) = 1)""",
    dist="""SELECT n.*, CAST(n_regionkey AS STRING) AS sg_uf, n_nationkey, soma_dist / n_enderecos AS media FROM (SELECT id_regiao, COUNT(*) AS n_enderecos, SUM(d) AS soma_dist,
              MIN(d) AS dist_min, MAX(d) AS dist_max, COUNT(*) FILTER (d > 5000) AS acima_5km, COUNT(*) FILTER (d > 25000) AS acima_25km FROM {near} GROUP BY 1) n
            JOIN {supplier} ON s_suppkey = id_regiao JOIN {nation} ON s_nationkey = n_nationkey""",
    ratio="""SELECT d.*, COALESCE(media / NULLIF(median(media) OVER (PARTITION BY n_nationkey), 0), 0.0) AS razao FROM {dist} d""")


def _classified(s):
    """Places of a new year whose texts sometimes changed, against the imported base."""
    new = s.sql("""SELECT id_local_votacao, sg_uf, CASE WHEN s_suppkey % 3 = 0 THEN 'ESCOLA NOVA' ELSE UPPER(nome) END AS nome,
                          CASE WHEN s_suppkey % 7 < 3 THEN NULL WHEN s_suppkey % 7 = 3 THEN 'outra rua' ELSE CONCAT(' ', endereco, ' . ') END AS endereco FROM {place}""")
    return R.classify_places(new, s.base)


SITUATIONS = ["id_conhecido_nome_endereco_mudou", "id_conhecido_sem_coordenada", "id_novo", "mesmo_local"]
CLASSIFIED = """SELECT id_local_votacao, sg_uf, CASE WHEN NOT known THEN 'id_novo' WHEN k4 = 1 THEN 'id_conhecido_sem_coordenada'
                       WHEN k3 <> 0 OR k7 > 3 THEN 'mesmo_local' ELSE 'id_conhecido_nome_endereco_mudou' END AS situacao
                FROM (SELECT *, s_suppkey % 5 <> 2 AS known, s_suppkey % 4 AS k4, s_suppkey % 3 AS k3, s_suppkey % 7 AS k7 FROM {place})"""


def _guards(s):
    """Table guards over the whole given tables, all problem rows in one frame."""
    line = s.lineitem
    out = G.unique_key(line, ["l_orderkey", "l_linenumber"], "lineitem")
    for p in (G.constant_per_group(line, ["l_partkey"], ["l_suppkey"], "lineitem"),
              G.code_width(s.sql("SELECT CAST(c_custkey AS STRING) AS c FROM {customer}"), "c", "customer", 3),
              G.single_round(s.sql("SELECT o_orderstatus AS turno FROM {orders}"), "orders"),
              G.sum_preserved(line, line.where("l_returnflag <> 'N'"), "l_linenumber", "lineitem"),
              G.join_rate(s.labels, s.documents.where("doc_id % 3 = 0"), ["doc_id"], "labels"),
              G.inside_country(s.sql("SELECT lat + 8 AS a, lon FROM {place}"), "a", "lon", "place"),
              G.no_missing(s.sql("SELECT NULLIF(o_orderpriority, '5-LOW') AS p, o_totalprice AS t FROM {orders}"), ["p", "t"], "orders"),
              G.slice_present(s.vote, 2026, "1", "vote"), G.slice_present(s.vote, 2030, "1", "vote"),
              G.nominal_without_party(s.vote.withColumn("sg_partido", F.nullif("sg_partido", F.lit("P1"))), "vote")):
        out = out.unionByName(p)
    return out


GUARDS = """
    SELECT 'unique key' AS "check", 'lineitem' AS context, CONCAT(n - 1, ' extra row(s) for ', l_orderkey, ', ', l_linenumber) AS detail
      FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'constant per group', 'lineitem', CONCAT('l_suppkey vary for ', l_partkey) FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING MIN(l_suppkey) <> MAX(l_suppkey))
    UNION ALL SELECT 'code width', 'customer', CONCAT(COUNT(*), ' value(s) of c with width ', LENGTH(CAST(c_custkey AS STRING))) FROM customer
      WHERE LENGTH(CAST(c_custkey AS STRING)) <> 3 GROUP BY LENGTH(CAST(c_custkey AS STRING))
    UNION ALL SELECT 'single round', 'orders', CONCAT(COUNT(DISTINCT o_orderstatus), ' rounds, from ', MIN(o_orderstatus), ' to ', MAX(o_orderstatus)) FROM orders
    UNION ALL SELECT 'sum preserved', 'lineitem', CONCAT('before ', SUM(l_linenumber), ', after ', SUM(l_linenumber) FILTER (l_returnflag <> 'N')) FROM lineitem
    UNION ALL SELECT 'join rate', 'labels', CONCAT(COUNT(*) FILTER (doc_id % 3 = 0), ' of ', COUNT(*), ' matched, minimum 50%') FROM labels
    UNION ALL SELECT 'inside country', 'place', CONCAT(COUNT(*), ' coordinate(s) outside the box') FROM {place} WHERE lat + 8 > 5.3
    UNION ALL SELECT 'no missing', 'orders', CONCAT(COUNT(*), ' missing in p') FROM orders WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT 'slice present', 'vote', 'no votes for 2030/1'
    UNION ALL SELECT 'nominal without party', 'vote', CONCAT(COUNT(*), ' row(s)') FROM {vote} WHERE tipo_voto = 'nominal' AND sg_partido = 'P1'"""


def _coverage(s):
    """The coverage report's row, its lists unfolded."""
    regions, mapping = mesh(s)
    per_path = s.sql("SELECT o_orderpriority AS caminho, CAST(COUNT(*) AS BIGINT) AS amostra FROM {orders} GROUP BY 1")
    row = R.coverage_report(R.geocoding_coverage(s.base, s.official, mapping, regions),
                            R.vote_coverage(s.vote, V.votes_per_region(s.vote, mapping.where("id_regiao % 3 <> 0"))), s.counts, per_path)
    lists = F.array_join(F.transform("geocodificacao", lambda g: F.concat_ws(":", F.coalesce(g["sg_uf"], F.lit("total")), g["locais"], g["com_coordenada"])), " ")
    paths = F.array_join(F.transform("acerto_por_caminho", lambda p: F.concat_ws(":", p["caminho"], p["amostra"])), " ")
    return tidy(row.select(lists.alias("geocodificacao"), "voto.*", "enderecos.*", paths.alias("caminhos")))


def _region_rules(s):
    """Customers as regions, their orders as votes; keys, shares and abstention are wrong here and there."""
    regions = s.sql("""SELECT CAST(c_nationkey AS STRING) AS cd_municipio_ibge, CASE WHEN c_custkey % 97 = 5 THEN CONCAT('x-', c_custkey)
                              WHEN c_custkey % 101 = 7 THEN '1-1' ELSE CONCAT(c_custkey % 40 + 2, '-', c_custkey) END AS id_publico FROM {customer}""")
    rows = s.sql("SELECT o_custkey AS onde, o_orderstatus AS nome, COUNT(*) AS votos FROM {orders} GROUP BY 1, 2")
    whole = rows.groupBy("onde").agg(F.sum("votos").alias("t"))
    odd = F.when(F.col("onde") % 50 == 0, 3.0).otherwise(0.0)
    cand = rows.join(whole, "onde").select("onde", "nome", F.when(F.col("onde") % 75 == 1, -F.col("votos")).otherwise(F.col("votos")).alias("votos"),
                                           (numbers.percent(F.col("votos"), F.col("t")) + odd).alias("pct"))
    away = s.sql("""SELECT c_custkey AS onde, CASE WHEN c_custkey % 60 = 2 THEN NULL ELSE c_custkey % 9 END AS qt_eleitores,
                           CASE WHEN c_custkey % 60 = 1 THEN -1 WHEN c_custkey % 60 = 3 THEN c_custkey % 9 + 1 WHEN c_custkey % 60 = 4 THEN NULL ELSE c_custkey % 9 END AS abstencao
                    FROM {customer}""")
    return VAL.region_problems(regions, cand, away, ["onde"]).groupBy("check", "context").agg(F.count("*").alias("problemas"))


def _missing_documents(s):
    """Municipalities of the index without documents of their streets or localities."""
    towns = PUB.municipality_index(mesh(s)[0])
    streets = s.sql("SELECT DISTINCT cd_municipio_ibge FROM {counts} WHERE CAST(cd_municipio_ibge AS BIGINT) % 3 <> 0")
    local = s.sql("SELECT DISTINCT cd_municipio_ibge FROM {counts} WHERE CAST(cd_municipio_ibge AS BIGINT) % 7 <> 1")
    return VAL.documents_present(towns, ruas=streets, bairros=local)


def _preview(s):
    rows = s.sql("""SELECT n_name, c_mktsegment, COUNT(*) AS votos FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1, 2""")
    share = rows.groupBy("n_name").agg(F.sum("votos").alias("t"), F.array_sort(F.collect_list(
        F.struct((-F.col("votos")).alias("o"), F.col("c_mktsegment").alias("nome"), "votos"))).alias("l")).select(
        F.lit("São José").alias("local"), F.col("n_name").alias("nm_municipio"), F.lit("RO").alias("sg_uf"), F.lit("2022").alias("ano"),
        F.lit("2").alias("turno"), F.transform("l", lambda x: F.struct(
            x["nome"].alias("nome"), numbers.percent(x["votos"], F.col("t")).alias("pct"))).alias("candidatos"),
        F.hash("n_name").alias("regiao"))
    return L.preview_text(share).select("nm_municipio", "titulo", "placar")


def _rules(s):
    """Segment counts per nation as results: some shares do not close, some totals are short."""
    rows = s.sql("""SELECT c_nationkey AS onde, c_mktsegment AS nome, COUNT(*) AS votos FROM {customer} GROUP BY 1, 2""")
    whole = rows.groupBy("onde").agg(F.sum("votos").alias("t"))
    cand = rows.join(whole, "onde").select("onde", "nome", "votos", (
        numbers.percent(F.col("votos"), F.col("t")) + F.when(F.col("onde") % 4 == 0, 1.0).otherwise(0.0)).alias("pct"))
    totals = whole.select("onde", (F.col("t") - F.when(F.col("onde") % 5 == 0, 1).otherwise(0)).alias("total"))
    return VAL.aggregate_problems(cand, totals, ["onde"], "nation").groupBy("check").agg(F.count("*").alias("problemas"))


def _index_counts(s):
    regions = mesh(s)[0]
    states = PUB.state_index(regions).withColumn("n_municipios", F.col("n_municipios") + F.when(F.col("sigla") == "RO", 1).otherwise(0))
    return VAL.index_counts(states, PUB.municipality_index(regions))


def _accuracy(s):
    return tidy(R.accuracy_overall(s.sql("""SELECT o_orderstatus AS sg_uf, o_orderpriority AS caminho, COUNT(*) AS amostra,
        CAST(SUM(CASE WHEN o_orderkey % 3 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS acertos, CAST(SUM(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS amostra_domicilios,
        CAST(SUM(CASE WHEN o_orderkey % 6 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS acertos_domicilios FROM {orders} GROUP BY 1, 2""")))


_NORM = "trim(regexp_replace(regexp_replace(strip_accents(upper(replace(replace(text, 'ß', 'ss'), 'ẞ', 'ss'))), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"

QUERIES = {
    "coordinate_divergence": query(
        lambda s: tidy(divergence(s).select("id_local_votacao", "cd_municipio_ibge", "distancia_m", "ao_centro_nosso", "ao_centro_tse", "suspeito"), 3),
        """SELECT id_local_votacao, cd_municipio_ibge, ROUND(distancia_m,3) AS distancia_m, ROUND(ao_centro_nosso,3) AS ao_centro_nosso,
                  ROUND(ao_centro_tse,3) AS ao_centro_tse, CASE WHEN ao_centro_tse > ao_centro_nosso * 3 THEN 'tse'
                  WHEN ao_centro_nosso > ao_centro_tse * 3 THEN 'nosso' ELSE 'indefinido' END AS suspeito FROM {measured}""", **DIVERGENCE),
    "divergence_percentiles": query(
        lambda s: tidy(exact_percentiles(settle(divergence(s)), [], "distancia_m", R.PERCENTILES), 3),
        "SELECT " + ", ".join(f"ROUND(quantile_cont(distancia_m, {p / 100}), 3) AS p{p}" for p in (50, 75, 90, 95, 99)) + " FROM {measured}", **DIVERGENCE),
    "worst_divergences": query(
        lambda s: tidy(divergence(s).where("distancia_m > 5000").orderBy(F.desc("distancia_m"), "id_local_votacao").limit(50).select("id_local_votacao", "distancia_m"), 3),
        "SELECT id_local_votacao, ROUND(distancia_m,3) AS distancia_m FROM {measured} WHERE distancia_m > 5000 ORDER BY distancia_m DESC, id_local_votacao LIMIT 50", **DIVERGENCE),
    "divergence_report": query(
        lambda s: tidy(R.divergence_report(settle(divergence(s))).select(
            "contagem.*", "percentis.*", F.array_join(F.transform("suspeito", lambda x: F.concat_ws("=", x["suspeito"], x["locais"].cast("string"))), " ").alias("suspeitos"),
            F.array_join(F.array_sort(F.transform("piores", lambda x: x["id_local_votacao"])), " ").alias("piores")), 3),
        f"""SELECT COUNT(*) AS locais_comparados, COUNT(*) FILTER (distancia_m > 5000) AS divergentes,
                   {', '.join(f"ROUND(quantile_cont(distancia_m, {p / 100}), 3) AS p{p}" for p in (50, 75, 90, 95, 99))},
                   (SELECT COALESCE(string_agg(suspeito || '=' || n, ' ' ORDER BY suspeito), '') FROM (
                      SELECT CASE WHEN ao_centro_tse > ao_centro_nosso * 3 THEN 'tse' WHEN ao_centro_nosso > ao_centro_tse * 3 THEN 'nosso' ELSE 'indefinido' END AS suspeito,
                             COUNT(*) AS n FROM {{measured}} WHERE distancia_m > 5000 GROUP BY 1)) AS suspeitos,
                   (SELECT COALESCE(string_agg(id_local_votacao, ' ' ORDER BY id_local_votacao), '') FROM (
                      SELECT id_local_votacao FROM {{measured}} WHERE distancia_m > 5000 ORDER BY distancia_m DESC, id_local_votacao LIMIT 50)) AS piores
            FROM {{measured}}""", **DIVERGENCE),
    "distance_levels": query(
        lambda s: tidy(R.summarise_distances(distances(s).join(_regions(s).select("id_regiao", "sg_uf"), "id_regiao")), 3),
        """SELECT sg_uf, CAST(SUM(n_enderecos) AS BIGINT) AS enderecos, ROUND(SUM(soma_dist)/SUM(n_enderecos),3) AS distancia_media_m,
                  ROUND(SUM(acima_5km)/SUM(n_enderecos)*100,3) AS pct_acima_5km, ROUND(SUM(acima_25km)/SUM(n_enderecos)*100,3) AS pct_acima_25km,
                  COUNT(*) AS regioes, COUNT(*) FILTER (acima_25km > 0) AS regioes_com_endereco_acima_25km, ROUND(MAX(dist_max)/1000,3) AS distancia_maxima_km,
                  COUNT(*) FILTER (dist_min = 0) AS regioes_com_endereco_na_coordenada_exata, CAST(1 - GROUPING(sg_uf) AS BIGINT) AS nivel
           FROM {dist} GROUP BY ROLLUP (sg_uf)""", **DIST),
    "distance_outliers": query(
        lambda s: (lambda d: tidy(d["sem_vizinho"].withColumn("lista", F.lit("sem_vizinho")).unionByName(d["mais_distantes"].withColumn("lista", F.lit("mais_distantes")))
                                  .unionByName(d["destoantes"].withColumn("lista", F.lit("destoantes"))).select("lista", "id_regiao", "n_enderecos", "razao_municipio"), 3))(
            R.distance_diagnostics(distances(s), _regions(s))),
        """(SELECT 'sem_vizinho' AS lista, id_regiao, n_enderecos, ROUND(razao,3) AS razao_municipio FROM {ratio} WHERE dist_min > 100 ORDER BY dist_min DESC, id_regiao LIMIT 30)
           UNION ALL (SELECT 'mais_distantes', id_regiao, n_enderecos, ROUND(razao,3) FROM {ratio} WHERE acima_25km > 0 ORDER BY acima_25km DESC, dist_max DESC, id_regiao LIMIT 30)
           UNION ALL (SELECT 'destoantes', id_regiao, n_enderecos, ROUND(razao,3) FROM {ratio} WHERE n_enderecos >= 100 AND media >= 5000 ORDER BY razao DESC, id_regiao LIMIT 30)""", **DIST),
    "ratio_to_nation_median": query(
        lambda s: tidy(R.ratio_to_median(s.customer.select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], "c_acctbal")),
        """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, ROUND(c_acctbal,4) AS c_acctbal,
                  ROUND(COALESCE(c_acctbal / NULLIF(median(c_acctbal) OVER (PARTITION BY c_nationkey), 0), 0.0), 4) AS razao FROM customer"""),
    "classify_places": query(lambda s: _classified(s).select("id_local_votacao", "sg_uf", "situacao"), "SELECT * FROM {classified}", classified=CLASSIFIED),
    "place_crosstab": query(
        lambda s: tidy(R.crosstab(_classified(s), "sg_uf", "situacao", SITUATIONS)),
        "SELECT *, " + ", ".join(f"CAST(({v} * 2000 + total) // (total * 2) AS DOUBLE) / 10 AS pct_{v}" for v in SITUATIONS) + " FROM (SELECT COALESCE(sg_uf, 'total') AS sg_uf, "
        + ", ".join(f"COUNT(*) FILTER (situacao = '{v}') AS {v}" for v in SITUATIONS) + ", COUNT(*) AS total FROM {classified} GROUP BY ROLLUP (sg_uf))", classified=CLASSIFIED),
    "segment_crosstab": query(
        lambda s: tidy(R.crosstab(s.sql("SELECT n_name, c_mktsegment FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"), "n_name", "c_mktsegment",
                                  ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])),
        "SELECT *, " + ", ".join(f"CAST(({v} * 2000 + total) // (total * 2) AS DOUBLE) / 10 AS pct_{v}" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
        + " FROM (SELECT COALESCE(n_name, 'total') AS n_name, " + ", ".join(f"COUNT(*) FILTER (c_mktsegment = '{v}') AS {v}" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
        + ", COUNT(*) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name))"),
    "geocoding_coverage": query(
        lambda s: tidy(R.geocoding_coverage(s.base, s.official, *reversed(mesh(s)))),
        """SELECT sg_uf, COUNT(*) AS locais, COUNT(o) AS com_coordenada, COUNT(*) FILTER (o = 'cnefe') AS por_cnefe, COUNT(*) FILTER (o = 'tse') AS por_tse
           FROM (SELECT DISTINCT u.id_local_votacao, u.sg_uf, r.origem_coordenada AS o FROM (SELECT id_local_votacao, sg_uf FROM {base} UNION SELECT id_local_votacao, sg_uf FROM {official}) u
                 LEFT JOIN {mapping} USING (id_local_votacao) LEFT JOIN {region_dim} r USING (id_regiao)) GROUP BY ROLLUP (sg_uf)""", **MESH),
    "vote_coverage": query(
        lambda s: tidy(R.vote_coverage(s.vote, V.votes_per_region(s.vote, mesh(s)[1].where("id_regiao % 3 <> 0")))),
        """SELECT CAST((SELECT SUM(qt_votos) FROM {vote}) AS BIGINT) AS votos_apurados, CAST(SUM(qt_votos) AS BIGINT) AS votos_em_regiao,
                  COUNT(DISTINCT id_regiao) AS regioes_com_voto FROM {region_vote} WHERE id_regiao % 3 <> 0""", **MESH, region_vote=REGION_VOTE),
    "coverage_report": query(
        _coverage,
        """SELECT (SELECT string_agg(COALESCE(sg_uf, 'total') || ':' || locais || ':' || com, ' ' ORDER BY sg_uf NULLS FIRST) FROM (
                     SELECT sg_uf, COUNT(*) AS locais, COUNT(o) AS com
                     FROM (SELECT DISTINCT u.id_local_votacao, u.sg_uf, r.origem_coordenada AS o FROM (SELECT id_local_votacao, sg_uf FROM {base} UNION SELECT id_local_votacao, sg_uf FROM {official}) u
                           LEFT JOIN {mapping} USING (id_local_votacao) LEFT JOIN {region_dim} r USING (id_regiao)) GROUP BY ROLLUP (sg_uf))) AS geocodificacao,
                  (SELECT CAST(SUM(qt_votos) AS BIGINT) FROM {vote}) AS votos_apurados, v.*, e.*,
                  (SELECT string_agg(c || ':' || n, ' ' ORDER BY c) FROM (SELECT o_orderpriority AS c, COUNT(*) AS n FROM orders GROUP BY 1)) AS caminhos
           FROM (SELECT CAST(SUM(qt_votos) AS BIGINT) AS votos_em_regiao, COUNT(DISTINCT id_regiao) AS regioes_com_voto FROM {region_vote} WHERE id_regiao % 3 <> 0) v,
                (SELECT CAST(SUM(n) AS BIGINT) AS enderecos, CAST(SUM(n) FILTER (numero = 0) AS BIGINT) AS sem_numero,
                        CAST(SUM(n) FILTER (k > 1 AND numero IS NOT NULL) AS BIGINT) AS em_chave_ambigua
                 FROM (SELECT numero, SUM(n_enderecos) AS n, COUNT(DISTINCT id_regiao) AS k FROM {counts} GROUP BY cd_municipio_ibge, logradouro, numero)) e""",
        **MESH, region_vote=REGION_VOTE),
    "region_rules": query(
        _region_rules,
        f"""WITH r AS (SELECT c_nationkey AS m, CASE WHEN c_custkey % 97 = 5 THEN 'x-' || c_custkey WHEN c_custkey % 101 = 7 THEN '1-1' ELSE (c_custkey % 40 + 2) || '-' || c_custkey END AS k FROM customer),
                 c AS (SELECT onde, CASE WHEN onde % 75 = 1 THEN -votos ELSE votos END AS votos, {pct_sql('votos', 't')} + CASE WHEN onde % 50 = 0 THEN 3 ELSE 0 END AS pct
                       FROM (SELECT o_custkey AS onde, o_orderstatus, COUNT(*) AS votos, CAST(SUM(COUNT(*)) OVER (PARTITION BY o_custkey) AS BIGINT) AS t FROM orders GROUP BY 1, 2))
            SELECT * FROM (
              SELECT 'key format' AS "check", 'region' AS context, COUNT(*) AS problemas FROM r WHERE NOT regexp_full_match(k, '[0-9]{{1,4}}-[0-9]{{1,5}}')
              UNION ALL SELECT 'unique key', 'public key', COUNT(*) FROM (SELECT m, k FROM r GROUP BY m, k HAVING COUNT(*) > 1)
              UNION ALL SELECT 'range', 'region', COUNT(*) FROM c WHERE pct NOT BETWEEN 0 AND 100 OR votos < 0
              UNION ALL SELECT 'percent', 'region', COUNT(*) FROM (SELECT onde FROM c GROUP BY onde HAVING ABS(SUM(pct) - 100) > 0.5)
              UNION ALL SELECT 'abstention', 'region', COUNT(*) FROM customer WHERE c_custkey % 60 IN (1, 2, 3)) WHERE problemas > 0"""),
    "documents_missing": query(
        _missing_documents,
        """SELECT 'missing documents' AS "check", context, cd_municipio_ibge AS detail FROM (
             SELECT DISTINCT cd_municipio_ibge, 'ruas' AS context FROM {region_dim} WHERE cd_municipio_ibge NOT IN (SELECT cd_municipio_ibge FROM {counts} WHERE CAST(cd_municipio_ibge AS BIGINT) % 3 <> 0)
             UNION ALL SELECT DISTINCT cd_municipio_ibge, 'bairros' FROM {region_dim} WHERE cd_municipio_ibge NOT IN (SELECT cd_municipio_ibge FROM {counts} WHERE CAST(cd_municipio_ibge AS BIGINT) % 7 <> 1))""", **MESH),
    "votes_in_scope": query(
        lambda s: tidy(P.in_scope(s.vote_raw.withColumn("SG_UF", F.expr("CASE WHEN NR_ZONA = '4' THEN ' ZZ' ELSE CONCAT(SG_UF, ' ') END")), ["SP", "BA", "ZZ"])
                       .groupBy(F.trim("SG_UF").alias("sg_uf")).agg(F.count("*").alias("linhas"))),
        "SELECT SG_UF AS sg_uf, COUNT(*) AS linhas FROM {vote_raw} WHERE NR_ZONA <> '4' AND SG_UF IN ('SP', 'BA') GROUP BY 1"),
    "sections_of_round": query(
        lambda s: tidy(P.one_round(P.clean_sections(s.section_raw), "2").groupBy("sg_uf", "turno").agg(F.count("*").alias("secoes"), F.sum("qt_eleitores").alias("eleitores"))),
        "SELECT sg_uf, turno, COUNT(*) AS secoes, CAST(SUM(qt_eleitores) AS BIGINT) AS eleitores FROM {section} WHERE turno = '2' GROUP BY 1, 2", section=SECTION),
    "metadata": query(
        lambda s: tidy(PUB.metadata(mesh(s)[0], s.vote, 2026).select("ufs", "municipios", "regioes", F.explode("eleicoes").alias("cargo", "anos"))
                       .select("ufs", "municipios", "regioes", "cargo", F.explode("anos").alias("ano", "turnos"))
                       .select("ufs", "municipios", "regioes", "cargo", "ano", F.array_join("turnos", ",").alias("turnos"))),
        """SELECT ufs, municipios, regioes, cargo, ano, turnos FROM (SELECT COUNT(DISTINCT sg_uf) AS ufs, COUNT(DISTINCT cd_municipio_ibge) AS municipios, COUNT(*) AS regioes FROM {region_dim})
           CROSS JOIN (SELECT LOWER(REPLACE(cargo, ' ', '_')) AS cargo, CAST(ano_eleicao AS STRING) AS ano, string_agg(DISTINCT turno, ',' ORDER BY turno) AS turnos FROM {vote} GROUP BY 1, 2)""", **MESH),
    "state_index": query(
        lambda s: tidy(PUB.state_index(mesh(s)[0])),
        """SELECT sg_uf AS sigla, CASE sg_uf WHEN 'RO' THEN 'Rondônia' WHEN 'AM' THEN 'Amazonas' WHEN 'BA' THEN 'Bahia' WHEN 'SP' THEN 'São Paulo' ELSE 'Rio Grande do Sul' END AS nome,
                  MIN(cd_municipio_ibge)[1:2] AS cd, COUNT(DISTINCT cd_municipio_ibge) AS n_municipios FROM {region_dim} GROUP BY 1""", **MESH),
    "municipality_index": query(lambda s: PUB.municipality_index(mesh(s)[0]),
                                "SELECT DISTINCT sg_uf, cd_municipio_ibge, nm_municipio FROM {region_dim}", **MESH),
    "supplier_shares": query(
        lambda s: tidy(member_shares(weighted(s.sql("""SELECT l_partkey, l_suppkey, COUNT(*) AS n_enderecos, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS dom
            FROM {lineitem} GROUP BY 1, 2"""), ["l_partkey"], "dom", "n_enderecos"), ["l_partkey"], "l_suppkey")),
        """SELECT l_partkey, l_suppkey, CAST(w AS BIGINT) AS peso, ROUND(CAST(w AS DOUBLE) / SUM(w) OVER (PARTITION BY l_partkey), 4) AS fracao, COUNT(*) OVER (PARTITION BY l_partkey) AS n_regioes
           FROM (SELECT *, CASE WHEN SUM(dom) OVER (PARTITION BY l_partkey) > 0 THEN dom ELSE n END AS w FROM
                 (SELECT l_partkey, l_suppkey, COUNT(*) AS n, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS dom FROM lineitem GROUP BY 1, 2))"""),
    "table_guards": query(_guards, GUARDS),
    "official_total_guard": query(
        lambda s: G.official_totals(s.sql("SELECT CAST(year(o_orderdate) AS INT) AS ano_eleicao, '1' AS turno, o_orderpriority AS nm_votavel, COUNT(*) AS qt_votos FROM {orders} GROUP BY 1, 2, 3"),
                                    s.sql("""SELECT CAST(year(o_orderdate) AS INT) AS ano_eleicao, '1' AS turno, 'URGENT' AS parte, COUNT(*) AS oficial FROM {orders}
                                             WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 50 <> 7 GROUP BY 1, 2"""), "orders"),
        """SELECT 'official total' AS "check", 'orders' AS context, CONCAT(year(o_orderdate), '/1 URGENT: ', COUNT(*), ' x ', COUNT(*) FILTER (o_orderkey % 50 <> 7)) AS detail
           FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY year(o_orderdate) HAVING COUNT(*) FILTER (o_orderkey % 50 = 7) > 0"""),
    "customers_without_orders": query(
        lambda s: s.customer.join(s.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey"),
        "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    # The given tables have an order for every customer; not every one has an urgent order.
    "customers_without_urgent_orders": query(
        lambda s: s.customer.join(s.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey",
                                  "left_anti").select("c_custkey"),
        "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"),
    "known_places": query(
        lambda s: s.base.select("id_local_votacao").union(s.official.select("id_local_votacao")).distinct(),
        "SELECT id_local_votacao FROM {base} UNION SELECT id_local_votacao FROM {official}"),
    "comparable_text": query(
        lambda s: tidy(s.documents.select("doc_id", F.md5(text.comparable(F.col("text"))).alias("digest"), F.length(text.comparable(F.col("text"))).alias("n"))),
        f"SELECT doc_id, md5({_NORM}) AS digest, LENGTH({_NORM}) AS n FROM documents"),
    "title_case": query(
        lambda s: s.part.select("p_partkey", text.title_case(F.col("p_name")).alias("nome"), text.title_case(F.concat("p_type", F.lit("-d'"), "p_name")).alias("tipo")),
        """SELECT p_partkey, list_aggregate(list_transform(string_split(lower(p_name), ' '), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') AS nome,
                  upper(p_type[1]) || lower(p_type[2:]) || '-D''' || list_aggregate(list_transform(string_split(lower(p_name), ' '), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') AS tipo FROM part"""),
    "padded_codes": query(
        lambda s: s.customer.select("c_custkey", text.pad_code(F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).alias("codigo"),
                                    text.key_part(F.concat(F.lit("A_"), "c_mktsegment"), 1).alias("parte"), text.office_slug(F.concat("c_mktsegment", F.lit(" X"))).alias("slug")),
        """SELECT c_custkey, CASE WHEN LENGTH(CAST(c_custkey AS STRING)) < 5 THEN LPAD(CAST(c_custkey AS STRING), 5, '0') ELSE CAST(c_custkey AS STRING) END AS codigo,
                  c_mktsegment AS parte, LOWER(c_mktsegment) || '_x' AS slug FROM customer"""),
    "brazilian_numbers": query(
        lambda s: s.orders.select("o_orderkey", text.number_br(F.col("o_totalprice"), 2).alias("valor"), text.number_br(F.col("o_orderkey") * 1000).alias("chave")),
        "SELECT o_orderkey, translate(printf('%,.2f', o_totalprice), ',.', '.,') AS valor, translate(printf('%,d', o_orderkey * 1000), ',', '.') AS chave FROM orders"),
    "search_places": query(
        lambda s: tidy(RES.search_names(s.place.select("s_suppkey", "nome", "endereco"), ["nome", "endereco"], "joão 1", "endereco", 20).select("s_suppkey", "nome", "endereco")),
        """SELECT s_suppkey, nome, endereco FROM {place} WHERE strip_accents(upper(nome || ' ' || endereco)) LIKE '%JOAO 1%' ORDER BY endereco, s_suppkey, nome LIMIT 20"""),
    "match_street_names": query(
        lambda s: tidy(RES.match_names(
            s.sql("SELECT DISTINCT cd_municipio AS m, rua AS q FROM {request} UNION SELECT DISTINCT cd_municipio, REPLACE(rua, 'RUA ', '') FROM {request}"),
            s.sql("SELECT DISTINCT cd_municipio_ibge AS m, logradouro FROM {counts}"), ["m"], "q", "logradouro")),
        """SELECT a.m, a.q, COALESCE(MAX(n.logradouro) FILTER (n.logradouro = a.q), MIN(n.logradouro) FILTER (nn = aa), MIN(n.logradouro) FILTER (contains(nn, aa))) AS encontrado,
                  CAST(CASE WHEN COUNT(*) FILTER (n.logradouro = a.q) > 0 THEN 1 WHEN COUNT(*) FILTER (nn = aa) > 0 THEN 2 WHEN COUNT(*) FILTER (contains(nn, aa)) > 0 THEN 3 END AS BIGINT) AS nivel
           FROM (SELECT *, strip_accents(upper(q)) AS aa FROM (SELECT cd_municipio AS m, rua AS q FROM {request} UNION SELECT cd_municipio, REPLACE(rua, 'RUA ', '') FROM {request})) a
           LEFT JOIN (SELECT DISTINCT cd_municipio_ibge AS m, logradouro, strip_accents(upper(logradouro)) AS nn FROM {counts}) n ON n.m = a.m GROUP BY 1, 2"""),
    "share_preview": query(
        _preview,
        """SELECT n_name AS nm_municipio, 'São José — ' || n_name || ' (RO)' AS titulo, 'Presidente 2022, 2º turno: ' ||
                  string_agg(c_mktsegment || ' ' || replace(printf('%.1f', p), '.', ',') || '%', ' × ' ORDER BY votos DESC, c_mktsegment) AS placar
           FROM (SELECT *, CAST((votos * 20000 + t) // (t * 2) AS DOUBLE) / 100 AS p FROM (SELECT n_name, c_mktsegment, COUNT(*) AS votos, CAST(SUM(COUNT(*)) OVER (PARTITION BY n_name) AS BIGINT) AS t,
                 row_number() OVER (PARTITION BY n_name ORDER BY COUNT(*) DESC, c_mktsegment) AS r FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) WHERE r <= 2) GROUP BY 1"""),
    "aggregate_rules": query(
        _rules,
        """SELECT * FROM (SELECT 'percent' AS "check", COUNT(DISTINCT c_nationkey) AS problemas FROM customer WHERE c_nationkey % 4 = 0
           UNION ALL SELECT 'valid votes', COUNT(DISTINCT c_nationkey) FROM customer WHERE c_nationkey % 5 = 0) WHERE problemas > 0"""),
    "index_counts": query(
        _index_counts,
        """SELECT 'index counts' AS "check", 'states' AS context, CONCAT('RO: index ', n + 1, ', list ', n) AS detail
           FROM (SELECT COUNT(DISTINCT cd_municipio_ibge) AS n FROM {region_dim} WHERE sg_uf = 'RO') WHERE n > 0""", **MESH),
    "accuracy_overall": query(
        _accuracy,
        """SELECT caminho, ROUND(AVG(a / n * 100), 4) AS acerto_pct, ROUND(AVG(h / NULLIF(m, 0) * 100), 4) AS acerto_domicilios_pct, ROUND(SUM(a) / SUM(n) * 100, 4) AS acerto_ponderado_pct
           FROM (SELECT o_orderstatus, o_orderpriority AS caminho, COUNT(*) AS n, COUNT(*) FILTER (o_orderkey % 3 > 0) AS a, COUNT(*) FILTER (o_orderkey % 2 = 0) AS m,
                        COUNT(*) FILTER (o_orderkey % 6 = 2) AS h FROM orders GROUP BY 1, 2) GROUP BY 1"""),
}
