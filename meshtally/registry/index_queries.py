"""Street index, resolution and ordered lookups on the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshtally.operators import addresses as A
from meshtally.operators import runs as R
from meshtally.operators.ordered import exact_percentiles, ordinal
from meshtally.plans import guarded as GRD
from meshtally.plans import mesh as M
from meshtally.plans import prepared as PRE
from meshtally.plans import publish as PUB
from meshtally.plans import reports as REP
from meshtally.plans import resolve as RES
from meshtally.plans import street_index as SI
from meshtally.registry.common import query, tidy
from meshtally.registry.mesh_queries import ASSIGN, assigned
from meshtally.session import settle

_ROWS = """
    SELECT *, CASE WHEN SUM(n_domicilios) OVER (PARTITION BY cd_municipio_ibge, logradouro) > 0 THEN n_domicilios ELSE n_enderecos END AS peso
    FROM (SELECT cd_municipio_ibge, logradouro, COALESCE(bairro, '') AS bairro, CAST(COALESCE(numero, 0) AS BIGINT) AS numero, id_regiao,
                 n_enderecos, n_domicilios FROM {%s} WHERE logradouro <> '')"""
_RUN = """
    SELECT cd_municipio_ibge, logradouro, numero AS numero_inicial, id_regiao FROM (
      SELECT *, LAG(id_regiao) OVER (PARTITION BY cd_municipio_ibge, logradouro ORDER BY numero) AS antes FROM (
        SELECT cd_municipio_ibge, logradouro, numero, id_regiao, SUM(peso) AS p FROM {rows_} GROUP BY 1,2,3,4
        QUALIFY row_number() OVER (PARTITION BY cd_municipio_ibge, logradouro, numero ORDER BY SUM(peso) DESC, id_regiao) = 1))
    WHERE antes IS NULL OR antes <> id_regiao"""


def _share(keys: str, where: str = "", src: str = "rows_") -> str:
    return f"""
    SELECT {keys}, id_regiao, CAST(CASE WHEN tw > 0 THEN w ELSE f END AS BIGINT) AS peso,
           CAST(CASE WHEN tw > 0 THEN w ELSE f END AS DOUBLE) / CASE WHEN tw > 0 THEN tw ELSE tf END AS fracao, n_regioes
    FROM (SELECT *, SUM(w) OVER k AS tw, SUM(f) OVER k AS tf, COUNT(*) OVER k AS n_regioes
          FROM (SELECT {keys}, id_regiao, SUM(peso) AS w, SUM(n_enderecos) AS f FROM {{{src}}} {where} GROUP BY {keys}, id_regiao)
          WINDOW k AS (PARTITION BY {keys}))"""


STREET_KEYS = "cd_municipio_ibge, logradouro"


def index_steps(src: str = "counts") -> dict[str, str]:
    return dict(
        rows_=_ROWS % src, run=_RUN, by_street=_share(STREET_KEYS),
        street=f"""SELECT {STREET_KEYS}, arg_min(id_regiao, -peso * 1000000 + id_regiao) AS id_regiao_dominante, MAX(n_regioes) AS n_regioes,
                   arg_min(fracao, -peso * 1000000 + id_regiao) AS fracao FROM {{by_street}} GROUP BY 1, 2""",
        split_rows=f"""SELECT * FROM {{rows_}} WHERE bairro <> '' AND ({STREET_KEYS}) IN
            (SELECT ({STREET_KEYS}) FROM {{rows_}} WHERE bairro <> '' GROUP BY {STREET_KEYS} HAVING COUNT(DISTINCT bairro) > 1)
            AND ({STREET_KEYS}) IN (SELECT ({STREET_KEYS}) FROM {{street}} WHERE n_regioes > 1)""",
        by_local=_share(f"{STREET_KEYS}, bairro", src="split_rows"),
        by_town=_share("cd_municipio_ibge, bairro", "WHERE bairro <> ''"))


IDX = index_steps()
RESOLVE = dict(
    **IDX,
    runpos=f"SELECT *, row_number() OVER (PARTITION BY {STREET_KEYS} ORDER BY numero_inicial) - 1 AS pos FROM {{run}}",
    asked="""SELECT DISTINCT cd_municipio, rua, CASE WHEN numero > 0 THEN numero ELSE 0 END AS numero, COALESCE(bairro, '') AS bairro FROM {request}""",
    matched="""
        SELECT a.*, COALESCE(e.logradouro, l.logradouro) AS logradouro FROM {asked} a
        LEFT JOIN {street} e ON e.cd_municipio_ibge = a.cd_municipio AND e.logradouro = a.rua
        LEFT JOIN (SELECT cd_municipio_ibge, strip_accents(upper(trim(logradouro))) AS n, MAX(logradouro) AS logradouro FROM {street} GROUP BY 1, 2) l
               ON l.cd_municipio_ibge = a.cd_municipio AND l.n = strip_accents(upper(trim(a.rua)))""",
    q="""
        SELECT m.*, s.n_regioes, s.id_regiao_dominante, b.bairro AS usado, m.bairro <> '' AND s.n_regioes > 1 AND b.bairro IS NULL AS ignorado
        FROM {matched} m JOIN {street} s ON s.cd_municipio_ibge = m.cd_municipio AND s.logradouro = m.logradouro
        LEFT JOIN (SELECT DISTINCT cd_municipio_ibge, logradouro, bairro FROM {by_local}) b ON b.cd_municipio_ibge = m.cd_municipio
             AND b.logradouro = m.logradouro AND upper(b.bairro) = upper(m.bairro) AND s.n_regioes > 1""",
    cand="""
        SELECT cd_municipio_ibge, logradouro, '' AS usado, id_regiao, peso FROM {by_street} WHERE n_regioes > 1
        UNION ALL SELECT cd_municipio_ibge, logradouro, bairro, id_regiao, peso FROM {by_local}""",
    head="""SELECT cd_municipio_ibge, logradouro, usado, COUNT(*) AS n, arg_min(id_regiao, -peso * 1000000 + id_regiao) AS primeiro FROM {cand} GROUP BY 1,2,3""",
    found="""
        SELECT q.cd_municipio, q.rua, q.numero, q.bairro, r.id_regiao, r.pos = p.p0 AND r.numero_inicial = q.numero AS nitido
        FROM {q} q JOIN {runpos} r ON r.cd_municipio_ibge = q.cd_municipio AND r.logradouro = q.logradouro
        JOIN {cand} c ON c.cd_municipio_ibge = q.cd_municipio AND c.logradouro = q.logradouro AND c.usado = COALESCE(q.usado, '') AND c.id_regiao = r.id_regiao
        JOIN (SELECT q.cd_municipio, q.rua, q.numero, q.bairro, COALESCE(MAX(pos) FILTER (numero_inicial <= q.numero), 0) AS p0 FROM {q} q
              JOIN {runpos} r ON r.cd_municipio_ibge = q.cd_municipio AND r.logradouro = q.logradouro GROUP BY 1,2,3,4) p
             ON p.cd_municipio = q.cd_municipio AND p.rua = q.rua AND p.numero = q.numero AND p.bairro = q.bairro
        WHERE q.numero > 0 AND q.n_regioes > 1
        QUALIFY row_number() OVER (PARTITION BY q.cd_municipio, q.rua, q.numero, q.bairro ORDER BY ABS(r.pos - p.p0), r.pos) = 1""",
    answer="""
        SELECT q.cd_municipio, q.rua, q.numero, q.bairro, q.logradouro, q.n_regioes, q.usado AS bairro_usado, q.ignorado AS bairro_ignorado,
               CASE WHEN q.n_regioes = 1 THEN 1 ELSE h.n END AS n_opcoes,
               CASE WHEN q.n_regioes = 1 THEN q.id_regiao_dominante WHEN h.n = 1 OR f.id_regiao IS NULL THEN h.primeiro ELSE f.id_regiao END AS id_regiao,
               CASE WHEN q.n_regioes = 1 OR h.n = 1 THEN 'exata' WHEN f.id_regiao IS NULL THEN 'provavel' WHEN f.nitido THEN 'exata' ELSE 'interpolada' END AS confianca,
               q.n_regioes > 1 AND h.n > 1 AND q.numero > 0 AND f.id_regiao IS NULL AND q.usado IS NOT NULL AS conflito_numero_bairro
        FROM {q} q LEFT JOIN {head} h ON h.cd_municipio_ibge = q.cd_municipio AND h.logradouro = q.logradouro AND h.usado = COALESCE(q.usado, '')
        LEFT JOIN {found} f ON f.cd_municipio = q.cd_municipio AND f.rua = q.rua AND f.numero = q.numero AND f.bairro = q.bairro""")


def index(s):
    return SI.build_index(s.counts)


def stored_index(s):
    """The index as its readers see it: five stored tables."""
    i = index(s)
    return SI.StreetIndex(settle(i.runs), settle(i.streets), i.street_regions, settle(i.street_localities), i.localities)


def prepared(s):
    """The index stored for lookups, opened as another session would."""
    return PRE.open_index(s.spark, PRE.store_index(stored_index(s)))


def _prepared_runs(s):
    return tidy(prepared(s).trechos.select("cd_municipio_ibge", "logradouro", F.posexplode("itens").alias("i", "t"), "pedaco").select(
        "cd_municipio_ibge", "logradouro", "t.*", (F.col("pedaco") * PRE.PIECE + F.col("i")).alias("lugar")))


def _accuracy(s):
    """Index built from half of the assignment rule, judged on all requests."""
    sample = s.sql("""SELECT o_orderkey AS id, CAST(n_regionkey AS STRING) AS sg_uf, CONCAT('11', LPAD(CAST(c_nationkey AS STRING), 5, '0')) AS cd_municipio_ibge,
               CONCAT('RUA SÃO ', CAST(o_custkey % 12 AS STRING)) AS logradouro, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey * 7 % 300 + 1 END AS numero,
               CONCAT('BAIRRO ', CAST(o_orderkey % 4 AS STRING)) AS bairro, o_orderkey % 4 < 2 AS domicilio,
               CAST(c_nationkey * 100 + CAST(FLOOR((o_orderkey * 7 % 300) / 60) AS BIGINT) AS BIGINT) AS verdade
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""")
    return tidy(REP.accuracy(REP.path_predictions(sample, stored_index(s))))


def _measured(s):
    """Accuracy end to end: addresses to their nearest regions, the index of all of them, and a sample of each state judged."""
    regions = settle(M.build_regions(s.located)[0])
    index = GRD.index(A.address_counts(assigned(s)))
    truth = settle(REP.sampled_truth(s.address_raw, regions, SAMPLE))
    return REP.accuracy(REP.path_predictions(truth, index))


SAMPLE = 200  # addresses of each state
_MEASURED = {
    **ASSIGN, **RESOLVE,
    "tallied": """SELECT cd_municipio_ibge, logradouro, bairro, numero, id_regiao, COUNT(*) AS n_enderecos, COUNT(*) FILTER (domicilio) AS n_domicilios
                  FROM {assigned} GROUP BY 1,2,3,4,5""",
    "rows_": _ROWS % "tallied",
    "drawn": f"""SELECT r.COD_UNICO_ENDERECO, p.sg_uf FROM {{address_raw}} r
                 JOIN (SELECT cd_municipio_ibge, MIN(sg_uf) AS sg_uf FROM {{region_dim}} GROUP BY 1) p ON p.cd_municipio_ibge = r.COD_MUNICIPIO
                 WHERE TRY_CAST(LATITUDE AS DOUBLE) IS NOT NULL
                 QUALIFY row_number() OVER (PARTITION BY p.sg_uf ORDER BY md5('42|' || COD_UNICO_ENDERECO || '|' || COD_ESPECIE) DESC) <= {SAMPLE}""",
    "judged": """SELECT sg_uf, a.cd_municipio_ibge AS cd_municipio, a.logradouro AS rua, domicilio, id_regiao AS verdade, caminho,
                        CASE WHEN caminho IN ('rua_numero', 'completo') AND numero > 0 THEN numero END AS numero,
                        CASE WHEN caminho IN ('rua_bairro', 'completo') THEN bairro END AS bairro
                 FROM {drawn} JOIN {assigned} a ON a.codigo = COD_UNICO_ENDERECO
                 CROSS JOIN (VALUES ('so_rua'), ('rua_bairro'), ('rua_numero'), ('completo')) v(caminho)""",
    "asked": "SELECT DISTINCT cd_municipio, rua, COALESCE(numero, 0) AS numero, COALESCE(bairro, '') AS bairro FROM {judged}",
    "measured": """SELECT sg_uf, caminho, COUNT(*) AS amostra, CAST(COUNT(*) FILTER (id_regiao = verdade) AS BIGINT) AS acertos,
                          COUNT(*) FILTER (domicilio) AS amostra_domicilios, CAST(COUNT(*) FILTER (domicilio AND id_regiao = verdade) AS BIGINT) AS acertos_domicilios,
                          COUNT(id_regiao) AS ruas_encontradas
                   FROM {judged} j LEFT JOIN {answer} a ON a.cd_municipio = j.cd_municipio AND a.rua = j.rua
                        AND a.numero = COALESCE(j.numero, 0) AND a.bairro = COALESCE(j.bairro, '') GROUP BY 1, 2"""}


def _runs_events(s):
    return R.run_starts(s.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
                        "event_type", F.date_trunc("day", F.col("ts")))


def _asof_events(s):
    """Purchases of a user looked up in the runs of the same user, by event number."""
    starts = _runs_events(s).select("user_id", "event_id", "event_type")
    probes = s.events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("at"))
    return tidy(R.run_lookup(probes, starts, ["user_id"], "at", "event_id", ["event_type"], width=500))


def _flat(lists):
    return lists.select("cd_municipio_ibge", "nome", "parte", F.posexplode("trechos").alias("i", "t")).select(
        "cd_municipio_ibge", "nome", (F.col("parte") * 50 + F.col("i")).alias("posicao"), "t.numero_inicial", "t.id_regiao")


_EVENT_RUN = """SELECT user_id, ts, event_id, event_type FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
                WHERE p IS NULL OR p <> event_type"""

_RESOLVED = """SELECT r.id, r.cd_municipio, r.rua, r.numero, r.bairro, a.logradouro, a.id_regiao, a.confianca, a.n_opcoes, a.n_regioes, a.bairro_ignorado,
                  a.conflito_numero_bairro, a.bairro_usado
           FROM {request} r LEFT JOIN {answer} a ON a.cd_municipio = r.cd_municipio AND a.rua = r.rua
                AND a.numero = CASE WHEN r.numero > 0 THEN r.numero ELSE 0 END AND a.bairro = COALESCE(r.bairro, '')"""

QUERIES = {
    "index_runs": query(lambda s: tidy(SI.build_runs(SI.usable_rows(s.counts))), "SELECT * FROM {run}", **IDX),
    "index_streets": query(lambda s: tidy(index(s).streets),
                           "SELECT cd_municipio_ibge, logradouro, id_regiao_dominante, n_regioes, ROUND(fracao,4) AS fracao FROM {street}", **IDX),
    "guarded_index_runs": query(lambda s: tidy(GRD.index(s.counts).runs), "SELECT * FROM {run}", **IDX),
    "index_street_regions": query(lambda s: tidy(index(s).street_regions), """
        SELECT cd_municipio_ibge, logradouro, id_regiao, ROUND(fracao,4) AS fracao, peso FROM {by_street} WHERE n_regioes > 1""", **IDX),
    "index_street_localities": query(lambda s: tidy(index(s).street_localities), """
        SELECT cd_municipio_ibge, logradouro, bairro, id_regiao, ROUND(fracao,4) AS fracao, peso FROM {by_local}""", **IDX),
    "index_localities": query(lambda s: tidy(index(s).localities), """
        SELECT cd_municipio_ibge, bairro, id_regiao, ROUND(fracao,4) AS fracao, peso FROM {by_town}""", **IDX),
    "index_from_assignment": query(
        lambda s: tidy(SI.build_runs(SI.usable_rows(A.address_counts(assigned(s))))), "SELECT * FROM {run}",
        **ASSIGN, tallied="""SELECT cd_municipio_ibge, logradouro, bairro, numero, id_regiao, COUNT(*) AS n_enderecos,
                             COUNT(*) FILTER (domicilio) AS n_domicilios FROM {assigned} GROUP BY 1,2,3,4,5""", rows_=_ROWS % "tallied", run=_RUN),
    "ambiguous_coverage": query(lambda s: tidy(SI.ambiguous_coverage(s.counts)), """
        SELECT CAST(SUM(n) AS BIGINT) AS enderecos, CAST(SUM(n) FILTER (numero = 0) AS BIGINT) AS sem_numero,
               CAST(SUM(n) FILTER (k > 1 AND numero IS NOT NULL) AS BIGINT) AS em_chave_ambigua
        FROM (SELECT numero, SUM(n_enderecos) AS n, COUNT(DISTINCT id_regiao) AS k FROM {counts} GROUP BY cd_municipio_ibge, logradouro, numero)"""),
    "resolve_addresses": query(lambda s: tidy(RES.resolve(s.request, stored_index(s))), _RESOLVED, **RESOLVE),
    "resolve_prepared": query(lambda s: tidy(PRE.resolve_prepared(s.request, prepared(s))), _RESOLVED, **RESOLVE),
    # As a large batch asks: every key is shuffled to the buckets of the tables.
    "resolve_prepared_in_bulk": query(lambda s: tidy(PRE.resolve_prepared(s.request, prepared(s), small_batch=0, few_towns=0)), _RESOLVED, **RESOLVE),
    "prepared_runs": query(_prepared_runs, """
        SELECT r.cd_municipio_ibge, r.logradouro, numero_inicial, r.id_regiao, pos AS posicao, pos AS lugar FROM {runpos} r
        JOIN {street} s ON s.cd_municipio_ibge = r.cd_municipio_ibge AND s.logradouro = r.logradouro AND s.n_regioes > 1""", **RESOLVE),
    "resolve_options": query(
        lambda s: (lambda i: tidy(RES.options(RES.resolve(s.request, i), i).select(
            "cd_municipio_ibge", "logradouro", "bairro", "id_regiao", "fracao", "ordem")))(stored_index(s)),
        """SELECT c.cd_municipio_ibge, c.logradouro, NULLIF(c.usado, '') AS bairro, c.id_regiao, ROUND(c.fracao, 4) AS fracao,
                  row_number() OVER (PARTITION BY c.cd_municipio_ibge, c.logradouro, c.usado ORDER BY c.fracao DESC, c.id_regiao) AS ordem
           FROM (SELECT cd_municipio_ibge, logradouro, '' AS usado, id_regiao, fracao FROM {by_street}
                 UNION ALL SELECT cd_municipio_ibge, logradouro, bairro, id_regiao, fracao FROM {by_local}) c
           WHERE (c.cd_municipio_ibge, c.logradouro, c.usado) IN (SELECT (cd_municipio, logradouro, COALESCE(bairro_usado, '')) FROM {answer})""", **RESOLVE),
    "resolve_by_locality": query(
        lambda s: tidy(RES.resolve_by_locality(s.request.select("cd_municipio", "bairro").where("bairro is not null"), settle(index(s).localities))),
        """SELECT r.cd_municipio, r.bairro, h.bairro AS bairro_usado, h.primeiro AS id_regiao, h.n AS n_opcoes,
                  CASE WHEN h.n = 1 THEN 'exata' WHEN h.n > 1 THEN 'provavel' END AS confianca
           FROM {request} r LEFT JOIN (SELECT cd_municipio_ibge, bairro, COUNT(*) AS n, arg_min(id_regiao, -peso * 1000000 + id_regiao) AS primeiro
                FROM {by_town} GROUP BY 1, 2) h ON h.cd_municipio_ibge = r.cd_municipio AND h.bairro = UPPER(r.bairro)
           WHERE r.bairro IS NOT NULL""", **IDX),
    "index_accuracy": query(
        _accuracy,
        """SELECT sg_uf, caminho, COUNT(*) AS amostra, CAST(SUM(CASE WHEN id_regiao = verdade THEN 1 ELSE 0 END) AS BIGINT) AS acertos,
                  COUNT(*) FILTER (domicilio) AS amostra_domicilios,
                  CAST(COALESCE(SUM(CASE WHEN id_regiao = verdade THEN 1 ELSE 0 END) FILTER (domicilio), 0) AS BIGINT) AS acertos_domicilios,
                  COUNT(id_regiao) AS ruas_encontradas
           FROM {judged} j LEFT JOIN {answer} a ON a.cd_municipio = j.cd_municipio AND a.rua = j.rua
                AND a.numero = COALESCE(j.numero, 0) AND a.bairro = COALESCE(j.bairro, '') GROUP BY 1, 2""",
        **{**RESOLVE,
           "truth": """SELECT CAST(n_regionkey AS STRING) AS sg_uf, CONCAT('11', LPAD(CAST(c_nationkey AS STRING), 5, '0')) AS cd_municipio,
               CONCAT('RUA SÃO ', CAST(o_custkey % 12 AS STRING)) AS rua, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey * 7 % 300 + 1 END AS numero,
               CONCAT('BAIRRO ', CAST(o_orderkey % 4 AS STRING)) AS bairro, o_orderkey % 4 < 2 AS domicilio,
               CAST(c_nationkey * 100 + CAST(FLOOR((o_orderkey * 7 % 300) / 60) AS BIGINT) AS BIGINT) AS verdade
               FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
           "judged": """SELECT sg_uf, cd_municipio, rua, domicilio, verdade, caminho, CASE WHEN caminho IN ('rua_numero', 'completo') THEN numero END AS numero,
               CASE WHEN caminho IN ('rua_bairro', 'completo') THEN bairro END AS bairro
               FROM {truth} CROSS JOIN (VALUES ('so_rua'), ('rua_bairro'), ('rua_numero'), ('completo')) v(caminho)""",
           "asked": "SELECT DISTINCT cd_municipio, rua, COALESCE(numero, 0) AS numero, COALESCE(bairro, '') AS bairro FROM {judged}"}),
    "accuracy_end_to_end": query(lambda s: tidy(_measured(s)), "SELECT * FROM {measured}", **_MEASURED),
    "accuracy_rates": query(
        lambda s: tidy(REP.accuracy_overall(settle(_measured(s)))),
        """SELECT caminho, ROUND(AVG(acertos * 100e0 / amostra), 4) AS acerto_pct, ROUND(AVG(acertos_domicilios * 100e0 / NULLIF(amostra_domicilios, 0)), 4) AS acerto_domicilios_pct,
                  ROUND(SUM(acertos) * 100e0 / SUM(amostra), 4) AS acerto_ponderado_pct FROM {measured} GROUP BY 1""", **_MEASURED),
    "street_documents": query(
        lambda s: tidy(_flat(PUB.street_documents(stored_index(s), size=50)[0])),
        f"""SELECT cd_municipio_ibge, logradouro AS nome, row_number() OVER (PARTITION BY {STREET_KEYS} ORDER BY numero_inicial) - 1 AS posicao,
                   numero_inicial, id_regiao FROM {{run}}""", **IDX),
    "locality_documents": query(
        lambda s: tidy(PUB.locality_documents(stored_index(s)).select(
            "cd_municipio_ibge", "nome", "peso", F.size("regioes").alias("n"), F.col("regioes")[0]["id_regiao"].alias("primeira"),
            F.col("regioes")[0]["fracao"].alias("fracao"))),
        """SELECT cd_municipio_ibge, bairro AS nome, CAST(SUM(peso) AS BIGINT) AS peso, COUNT(*) AS n, arg_min(id_regiao, -peso * 1000000 + id_regiao) AS primeira,
                  ROUND(MAX(fracao), 3) AS fracao FROM {by_town} GROUP BY 1, 2""", **IDX),
    "run_starts_events": query(lambda s: tidy(_runs_events(s)), _EVENT_RUN),
    "asof_events": query(
        _asof_events,
        f"""SELECT user_id, e.event_id AS at, r.event_id, r.event_type FROM events e ASOF JOIN ({_EVENT_RUN}) r
            ON e.user_id = r.user_id AND e.event_id >= r.event_id WHERE e.event_type = 'purchase'""".replace("SELECT user_id, e.", "SELECT e.user_id, e.")),
    "ordinal_orders": query(
        lambda s: tidy(ordinal(s.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                               F.date_trunc("month", F.col("o_orderdate"))).select("o_custkey", "o_orderkey", "position")),
        "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders"),
    "order_price_percentiles": query(
        lambda s: tidy(exact_percentiles(s.orders, [], "o_totalprice", REP.PERCENTILES), 3),
        "SELECT " + ", ".join(f"ROUND(quantile_cont(o_totalprice, {p / 100}), 3) AS p{p}" for p in (50, 75, 90, 95, 99)) + " FROM orders"),
    "price_percentiles_per_priority": query(
        lambda s: tidy(exact_percentiles(s.orders, ["o_orderpriority"], "o_totalprice", {"mediana": 0.5, "p90": 0.9}), 3),
        """SELECT o_orderpriority, ROUND(quantile_cont(o_totalprice, 0.5), 3) AS mediana, ROUND(quantile_cont(o_totalprice, 0.9), 3) AS p90
           FROM orders GROUP BY 1"""),
}
