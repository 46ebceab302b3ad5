"""Places, mesh and address assignment on the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshtally.operators import addresses as A
from meshtally.operators import places as P
from meshtally.operators.nearest import nearest_in_group
from meshtally.plans import guarded as GRD
from meshtally.plans import mesh as M
from meshtally.registry.common import MAPPING, MESH, REGION_DIM, REGION_VOTE, SECTION, VOTER, poly_sql, query, tidy
from meshtally.operators import votes as V
from meshtally.session import settle


def mesh(s):
    """(regions, mapping), stored once because every later step reads them."""
    regions, mapping = M.build_regions(s.located)
    regions = settle(regions)
    return regions, settle(s.located.select("id_local_votacao", *M.POINT).join(
        regions.select("id_regiao", *M.POINT), M.POINT).select("id_local_votacao", "id_regiao"))


def sections(s):
    return P.clean_sections(s.section_raw)


def voters(s):
    return P.voters_per_place(sections(s))


def _completed(s):
    return tidy(M.complete_coordinates(s.base, s.official).select(
        "id_local_votacao", "cd_municipio_ibge", "nm_municipio", "nm_local_votacao_consolidado",
        "latitude_final", "longitude_final", "origem_coordenada"), 6)


_COMPLETE = dict(
    filled="""
        SELECT b.id_local_votacao, b.sg_uf, b.nm_municipio, b.cd_municipio_ibge, b.nm_local_votacao_consolidado,
               COALESCE(b.latitude_final, o.latitude) AS lat, COALESCE(b.longitude_final, o.longitude) AS lon,
               CASE WHEN b.latitude_final IS NOT NULL THEN 'cnefe' WHEN o.latitude IS NOT NULL THEN 'tse' END AS origem
        FROM {base} b LEFT JOIN {official} o USING (id_local_votacao)""",
    crosswalk="""
        SELECT sg_uf, split_part(id_local_votacao, '_', 2) AS cd_municipio_tse, MIN(cd_municipio_ibge) AS cd_municipio_ibge,
               MIN(nm_municipio) AS nm_municipio FROM {base} GROUP BY 1, 2""",
    fresh="""
        SELECT o.id_local_votacao, o.sg_uf, c.nm_municipio, c.cd_municipio_ibge, o.nm_local_votacao, o.latitude AS lat,
               o.longitude AS lon
        FROM {official} o JOIN {crosswalk} c ON o.sg_uf = c.sg_uf AND o.cd_municipio_tse = c.cd_municipio_tse
        WHERE o.id_local_votacao NOT IN (SELECT id_local_votacao FROM {base})""",
    centre="SELECT cd_municipio_ibge, AVG(lat) AS mean_lat FROM {filled} WHERE lat IS NOT NULL GROUP BY 1",
    snapped="""
        SELECT f.id_local_votacao, f.cd_municipio_ibge, f.nm_municipio, f.nm_local_votacao, f.lat, f.lon, k.lat AS klat, k.lon AS klon,
               sqrt(power((radians(f.lon)-radians(k.lon))*6371000.0*cos(radians(mean_lat)),2)
                    + power((radians(f.lat)-radians(k.lat))*6371000.0,2)) AS d
        FROM {fresh} f LEFT JOIN {centre} USING (cd_municipio_ibge)
        LEFT JOIN (SELECT DISTINCT cd_municipio_ibge, lat, lon FROM {filled} WHERE lat IS NOT NULL) k USING (cd_municipio_ibge)
        QUALIFY row_number() OVER (PARTITION BY f.id_local_votacao ORDER BY d, k.lat, k.lon) = 1""",
    joined="""
        SELECT id_local_votacao, cd_municipio_ibge, nm_municipio, nm_local_votacao_consolidado, lat, lon, origem FROM {filled}
        UNION ALL
        SELECT id_local_votacao, cd_municipio_ibge, nm_municipio, nm_local_votacao, CASE WHEN d <= 50 THEN klat ELSE lat END,
               CASE WHEN d <= 50 THEN klon ELSE lon END, CASE WHEN d <= 50 THEN 'cnefe' ELSE 'tse' END FROM {snapped}""",
    shared="SELECT lat, lon FROM {joined} WHERE lat IS NOT NULL GROUP BY 1, 2 HAVING COUNT(DISTINCT cd_municipio_ibge) > 1",
)

_x, _y = poly_sql("latitude", "longitude")
_rx, _ry = poly_sql("latitude_final", "longitude_final")
ADDRESS = """
    SELECT COD_MUNICIPIO AS cd_municipio_ibge, COD_UNICO_ENDERECO AS codigo,
           UPPER(TRIM(regexp_replace(CONCAT(NOM_TIPO_SEGLOGR, ' ', COALESCE(TRIM(NOM_TITULO_SEGLOGR), ''), ' ', NOM_SEGLOGR), '\\s+', ' ', 'g'))) AS logradouro,
           UPPER(TRIM(COALESCE(DSC_LOCALIDADE, ''))) AS bairro, TRY_CAST(NUM_ENDERECO AS BIGINT) AS numero,
           COD_ESPECIE IN ('1', '2') AS domicilio, TRY_CAST(LATITUDE AS DOUBLE) AS latitude, TRY_CAST(LONGITUDE AS DOUBLE) AS longitude
    FROM {address_raw} WHERE TRY_CAST(LATITUDE AS DOUBLE) IS NOT NULL"""
ASSIGNED = f"""
    SELECT a.*, r.id_regiao, sqrt(power(a.x - r.x, 2) + power(a.y - r.y, 2)) AS distancia
    FROM (SELECT *, {_x} AS x, {_y} AS y FROM {{address}}) a
    JOIN (SELECT id_regiao, cd_municipio_ibge, {_rx} AS x, {_ry} AS y FROM {{region_dim}}) r USING (cd_municipio_ibge)
    QUALIFY row_number() OVER (PARTITION BY a.codigo ORDER BY power(a.x - r.x, 2) + power(a.y - r.y, 2), r.id_regiao) = 1"""
ASSIGN = dict(region_dim=REGION_DIM, address=ADDRESS, assigned=ASSIGNED)


def assigned(s):
    regions, _ = M.build_regions(s.located)
    return A.assign_to_regions(A.clean_addresses(s.address_raw), A.with_metres(regions, *M.POINT))


def _reallocation(s):
    regions, mapping = mesh(s)
    # Only places founded late operate in the reference year.
    open_ = mapping.join(s.place.where("s_suppkey % 3 = 0").select("id_local_votacao"), "id_local_votacao", "left_semi")
    return tidy(M.reallocation(regions, open_.select("id_regiao").distinct()))


QUERIES = {
    "clean_sections": query(
        lambda s: tidy(sections(s).groupBy("id_local_votacao", "cd_municipio_tse", "ano_eleicao", "turno").agg(
            F.count("*").alias("secoes"), F.count("latitude").alias("com_coordenada"), F.min("latitude").alias("lat_min"),
            F.max("longitude").alias("lon_max"), F.sum("qt_eleitores").alias("qt_eleitores"))),
        """SELECT id_local_votacao, cd_municipio_tse, CAST(ano_eleicao AS BIGINT) AS ano_eleicao, turno, COUNT(*) AS secoes,
                  COUNT(latitude) AS com_coordenada, ROUND(MIN(latitude),4) AS lat_min, ROUND(MAX(longitude),4) AS lon_max,
                  CAST(SUM(qt_eleitores) AS BIGINT) AS qt_eleitores FROM {section} GROUP BY 1,2,3,4""", section=SECTION),
    "voters_per_place": query(
        lambda s: tidy(voters(s)),
        "SELECT id_local_votacao, CAST(ano_eleicao AS BIGINT) AS ano_eleicao, turno, qt_eleitores FROM {voter}",
        section=SECTION, voter=VOTER),
    "latest_places": query(
        lambda s: tidy(P.latest_places(sections(s))),
        """SELECT id_local_votacao, arg_max(sg_uf, ano_eleicao) AS sg_uf, arg_max(cd_municipio_tse, ano_eleicao) AS cd_municipio_tse,
                  arg_max(nm_municipio, ano_eleicao) AS nm_municipio, CAST(MIN(nr_zona) AS BIGINT) AS nr_zona,
                  CAST(MIN(nr_local) AS BIGINT) AS nr_local,
                  (array_agg(nm_local_votacao ORDER BY ano_eleicao DESC, turno DESC, nm_local_votacao DESC))[1] AS nm_local_votacao,
                  (array_agg(ds_endereco ORDER BY ano_eleicao DESC, turno DESC, ds_endereco DESC)
                     FILTER (ds_endereco IS NOT NULL))[1] AS ds_endereco,
                  ROUND(MIN(latitude),4) AS latitude, ROUND(MIN(longitude),4) AS longitude,
                  CAST(MAX(ano_eleicao) AS BIGINT) AS ano_referencia
           FROM {section} WHERE latitude IS NOT NULL GROUP BY id_local_votacao""", section=SECTION),
    "place_counters": query(
        lambda s: tidy(P.place_counters(sections(s))),
        """SELECT COUNT(*) AS secoes, COUNT(DISTINCT id_local_votacao) AS locais,
                  COUNT(DISTINCT CASE WHEN latitude IS NULL THEN id_local_votacao END) AS locais_sem_coordenada
           FROM {section}""", section=SECTION),
    "complete_coordinates": query(
        _completed,
        """SELECT id_local_votacao, cd_municipio_ibge, nm_municipio, nm_local_votacao_consolidado,
                  ROUND(CASE WHEN amb THEN NULL ELSE lat END, 6) AS latitude_final,
                  ROUND(CASE WHEN amb THEN NULL ELSE lon END, 6) AS longitude_final,
                  CASE WHEN amb THEN NULL ELSE origem END AS origem_coordenada
           FROM (SELECT j.*, origem = 'tse' AND s.lat IS NOT NULL AS amb FROM {joined} j LEFT JOIN {shared} s
                 ON j.lat = s.lat AND j.lon = s.lon)""", **_COMPLETE),
    "drop_ambiguous_points": query(
        # Customers of one segment share coarse points across nations.
        lambda s: tidy(M.drop_ambiguous_points(s.sql(
            """SELECT CAST(c_custkey AS STRING) AS id, CAST(c_nationkey AS STRING) AS cd_municipio_ibge,
                      CAST(c_custkey % 400 AS DOUBLE) AS latitude_final, CAST(c_custkey % 300 AS DOUBLE) AS longitude_final,
                      CASE WHEN c_custkey % 2 = 0 THEN 'tse' ELSE 'cnefe' END AS origem_coordenada FROM {customer}"""))),
        """SELECT id, cd_municipio_ibge, CASE WHEN amb AND o = 'tse' THEN NULL ELSE a END AS latitude_final,
                  CASE WHEN amb AND o = 'tse' THEN NULL ELSE b END AS longitude_final,
                  CASE WHEN amb AND o = 'tse' THEN NULL ELSE o END AS origem_coordenada
           FROM (SELECT *, MIN(cd_municipio_ibge) OVER w <> MAX(cd_municipio_ibge) OVER w AS amb FROM
                 (SELECT CAST(c_custkey AS STRING) AS id, CAST(c_nationkey AS STRING) AS cd_municipio_ibge,
                      CAST(c_custkey % 400 AS DOUBLE) AS a, CAST(c_custkey % 300 AS DOUBLE) AS b,
                      CASE WHEN c_custkey % 2 = 0 THEN 'tse' ELSE 'cnefe' END AS o FROM customer)
                 WINDOW w AS (PARTITION BY a, b))"""),
    "region_dimension": query(lambda s: tidy(M.build_regions(s.located)[0]), """
        SELECT id_regiao, ROUND(latitude_final,4) AS latitude_final, ROUND(longitude_final,4) AS longitude_final, sg_uf,
               cd_municipio_ibge, nm_municipio, n_locais_votacao, origem_coordenada, nm_local_votacao, ds_endereco
        FROM {region_dim}""", **MESH),
    "place_to_region": query(lambda s: tidy(M.build_regions(s.located)[1]), "SELECT * FROM {mapping}", **MESH),
    "guarded_place_to_region": query(lambda s: tidy(GRD.regions(s.located)[1]), "SELECT * FROM {mapping}", **MESH),
    "other_place_names": query(
        lambda s: tidy(M.other_names(s.located, M.build_regions(s.located)[1])),
        """SELECT DISTINCT id_regiao, nm_local_votacao_consolidado AS nome FROM {located} JOIN {mapping} USING (id_local_votacao)
           QUALIFY nm_local_votacao_consolidado <> MIN(nm_local_votacao_consolidado) OVER (PARTITION BY id_regiao)""", **MESH),
    "active_regions": query(
        lambda s: tidy(M.active_regions(V.votes_per_region(s.vote, mesh(s)[1]), voters(s), mesh(s)[1], 2026)),
        """SELECT DISTINCT id_regiao FROM {mapping} WHERE id_local_votacao IN (SELECT id_local_votacao FROM {voter} WHERE ano_eleicao = 2026)
           OR id_regiao IN (SELECT id_regiao FROM {region_vote} WHERE ano_eleicao = 2026)""",
        **MESH, region_vote=REGION_VOTE, section=SECTION, voter=VOTER),
    "displayable_regions": query(
        lambda s: tidy(M.displayable_regions(mesh(s)[0], V.votes_per_region(s.vote.where("cargo = 'PRESIDENTE'"), mesh(s)[1]),
                                             voters(s), mesh(s)[1], 2026).select("id_regiao", "sg_uf")),
        """SELECT id_regiao, sg_uf FROM {region_dim} WHERE id_regiao IN (SELECT id_regiao FROM {region_vote} WHERE cargo = 'PRESIDENTE')
           OR id_regiao IN (SELECT id_regiao FROM {mapping} WHERE id_local_votacao IN
                            (SELECT id_local_votacao FROM {voter} WHERE ano_eleicao = 2026))""",
        **MESH, region_vote=REGION_VOTE, section=SECTION, voter=VOTER),
    "region_reallocation": query(_reallocation, f"""
        SELECT i.id_regiao, COALESCE(a.id_regiao, i.id_regiao) AS destino,
               ROUND(CASE WHEN i.aberta THEN 0.0 ELSE sqrt(power(i.x-a.x,2)+power(i.y-a.y,2)) END, 4) AS distancia
        FROM {{metric}} i LEFT JOIN {{metric}} a ON i.cd_municipio_ibge = a.cd_municipio_ibge AND a.aberta
             AND (NOT i.aberta OR i.id_regiao = a.id_regiao)
        QUALIFY row_number() OVER (PARTITION BY i.id_regiao ORDER BY power(i.x-a.x,2)+power(i.y-a.y,2), a.id_regiao) = 1""",
        **MESH, metric=f"""SELECT id_regiao, cd_municipio_ibge, {_rx} AS x, {_ry} AS y,
            id_regiao IN (SELECT id_regiao FROM {{mapping}} JOIN {{place}} USING (id_local_votacao) WHERE s_suppkey % 3 = 0) AS aberta
            FROM {{region_dim}}"""),
    "clean_addresses": query(
        lambda s: tidy(A.clean_addresses(s.address_raw).drop("x", "y")),
        """SELECT cd_municipio_ibge, logradouro, bairro, numero, domicilio, ROUND(latitude,4) AS latitude,
                  ROUND(longitude,4) AS longitude FROM {address}""", address=ADDRESS),
    "projected_points": query(
        lambda s: tidy(A.with_metres(s.place, "lat", "lon").select("s_suppkey", "x", "y"), 3),
        f"SELECT s_suppkey, ROUND({poly_sql('lat', 'lon')[0]},3) AS x, ROUND({poly_sql('lat', 'lon')[1]},3) AS y FROM {{place}}"),
    "nearest_region_per_address": query(
        lambda s: tidy(assigned(s).select("cd_municipio_ibge", "logradouro", "numero", "latitude", "longitude",
                                          "id_regiao", F.round("distancia", 2).alias("distancia"))),
        """SELECT cd_municipio_ibge, logradouro, numero, ROUND(latitude,4) AS latitude, ROUND(longitude,4) AS longitude,
                  id_regiao, ROUND(distancia,2) AS distancia FROM {assigned}""", **ASSIGN),
    "address_counts": query(
        lambda s: tidy(A.address_counts(assigned(s))),
        """SELECT cd_municipio_ibge, logradouro, bairro, numero, id_regiao, COUNT(*) AS n_enderecos,
                  COUNT(*) FILTER (domicilio) AS n_domicilios FROM {assigned} GROUP BY 1,2,3,4,5""", **ASSIGN),
    "distance_per_region": query(
        lambda s: tidy(A.distance_summary(assigned(s)), 2),
        """SELECT id_regiao, COUNT(*) AS n_enderecos, ROUND(SUM(distancia),2) AS soma_dist, ROUND(MIN(distancia),2) AS dist_min,
                  ROUND(MAX(distancia),2) AS dist_max, COUNT(*) FILTER (distancia > 5000) AS acima_5km,
                  COUNT(*) FILTER (distancia > 25000) AS acima_25km FROM {assigned} GROUP BY 1""", **ASSIGN),
    "nearest_supplier_per_customer": query(
        lambda s: tidy(nearest_in_group(
            s.sql("""SELECT c_custkey, n_regionkey, c_acctbal AS x, CAST(c_custkey % 997 AS DOUBLE) AS y
                     FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""),
            s.sql("""SELECT s_suppkey, n_regionkey, s_acctbal AS x, CAST(s_suppkey % 997 AS DOUBLE) AS y
                     FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""),
            ["n_regionkey"], ("x", "y"), ("x", "y"), "s_suppkey").select("c_custkey", "s_suppkey", "distancia")),
        """SELECT c_custkey, s_suppkey, ROUND(sqrt(d2),4) AS distancia FROM (
             SELECT c_custkey, s_suppkey, power(c_acctbal-s_acctbal,2)+power(c_custkey%997-s_suppkey%997,2) AS d2
             FROM customer JOIN nation cn ON c_nationkey=cn.n_nationkey
             LEFT JOIN (supplier JOIN nation sn ON s_nationkey=sn.n_nationkey) ON cn.n_regionkey=sn.n_regionkey
             QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d2, s_suppkey)=1)"""),
    # Some hundreds of targets in a group, and thousands at larger scale: the grid and its search tree.
    "nearest_customer_per_order": query(
        lambda s: tidy(nearest_in_group(
            s.sql("""SELECT o_orderkey, n_regionkey, CAST(o_orderkey * 613 % 10007 AS DOUBLE) / 10 AS x, CAST(o_orderkey * 1013 % 10009 AS DOUBLE) / 10 - 200 AS y
                     FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""),
            s.sql("""SELECT c_custkey, n_regionkey, CAST(c_custkey * 7919 % 10007 AS DOUBLE) / 10 AS x,
                            CAST(c_custkey * 104729 % CASE WHEN c_custkey % 3 = 0 THEN 97 ELSE 8009 END AS DOUBLE) / 10 AS y
                     FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_nationkey <> 7"""),
            ["n_regionkey"], ("x", "y"), ("x", "y"), "c_custkey").select("o_orderkey", "c_custkey", "distancia")),
        """WITH q AS (SELECT o_orderkey, n_regionkey, CAST(o_orderkey * 613 % 10007 AS DOUBLE) / 10 AS x, CAST(o_orderkey * 1013 % 10009 AS DOUBLE) / 10 - 200 AS y
                      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
                t AS (SELECT c_custkey, n_regionkey, CAST(c_custkey * 7919 % 10007 AS DOUBLE) / 10 AS x,
                             CAST(c_custkey * 104729 % CASE WHEN c_custkey % 3 = 0 THEN 97 ELSE 8009 END AS DOUBLE) / 10 AS y
                      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey <> 7)
           SELECT o_orderkey, b.c AS c_custkey, ROUND(sqrt(b.d), 4) AS distancia
           FROM (SELECT o_orderkey, min({'d': (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y), 'c': c_custkey}) AS b
                 FROM q LEFT JOIN t USING (n_regionkey) GROUP BY 1)"""),
    "public_keys": query(
        lambda s: tidy(M.public_keys(*mesh(s))[0]),
        """SELECT id_regiao, cd_municipio_ibge, (array_agg(CONCAT(nr_zona,'-',nr_local) ORDER BY nr_zona, nr_local))[1] AS id_publico
           FROM {mapping} JOIN {place} USING (id_local_votacao) GROUP BY 1, 2""", **MESH),
    "resolve_public_key": query(
        lambda s: tidy(M.resolve_public_key(s.sql(
            """SELECT cd_municipio_ibge, CASE WHEN s_suppkey % 10 = 0 THEN CONCAT('x', CAST(nr_local AS STRING))
                 WHEN s_suppkey % 10 = 1 THEN '9-99999' ELSE CONCAT(CAST(nr_zona AS STRING), '-', CAST(nr_local AS STRING)) END AS chave
               FROM {place}"""), *M.public_keys(*mesh(s)))),
        """SELECT cd_municipio_ibge, chave, CASE WHEN ruim THEN 'invalido' WHEN first IS NULL THEN 'nao_encontrado'
                  WHEN first = chave THEN 'canonico' ELSE 'redireciona' END AS situacao,
                  CASE WHEN NOT ruim THEN first END AS id_publico, CASE WHEN NOT ruim THEN id_regiao END AS id_regiao
           FROM (SELECT cd_municipio_ibge, CASE WHEN s_suppkey % 10 = 0 THEN CONCAT('x', nr_local) WHEN s_suppkey % 10 = 1 THEN '9-99999'
                        ELSE CONCAT(nr_zona, '-', nr_local) END AS chave, s_suppkey % 10 = 0 AS ruim FROM {place})
           LEFT JOIN (SELECT cd_municipio_ibge, CONCAT(nr_zona,'-',nr_local) AS chave, id_regiao,
                             first_value(CONCAT(nr_zona,'-',nr_local)) OVER (PARTITION BY id_regiao ORDER BY nr_zona, nr_local) AS first
                      FROM {mapping} JOIN {place} USING (id_local_votacao)) USING (cd_municipio_ibge, chave)""", **MESH),
}
