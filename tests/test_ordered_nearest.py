"""Ordered and spatial operators against brute force in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meshtally.functions import geo
from meshtally.operators import nearest, ordered, runs, shares


@pytest.fixture(scope="module")
def series(spark):
    rnd = random.Random(7)
    rows = []
    for key, n in (("hot", 900), ("a", 40), ("b", 1)):
        for pos in sorted(rnd.sample(range(5000), n)):
            rows.append((key, pos, rnd.choice(["x", "y", None]), rnd.randint(0, 9)))
    return rows, spark.createDataFrame(rows, "k string, n bigint, v string, w bigint")


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


def test_ordered_matches_plain_window(series):
    rows, df = series
    block = F.floor(F.col("n") / 200)
    got = ordered.previous_value(df, ["k"], ["n"], "v", block)
    got = ordered.ordinal(got, ["k"], ["n"], block)
    got = ordered.running_sum(got, ["k"], ["n"], "w", block)
    got = ordered.last_known(got, ["k"], ["n"], "v", block)
    found = {(r.k, r.n): (r.previous, r.position, r.running, r.known) for r in got.collect()}
    for key, items in by_key(rows).items():
        prev = known = None
        total = 0
        for i, (_, n, v, w) in enumerate(items):
            total += w
            known = v if v is not None else known
            assert found[key, n] == (prev, i, total, known)
            prev = v


def test_ordinal_without_keys_numbers_everything(series):
    rows, df = series
    got = ordered.ordinal(df, [], ["k", "n"], F.struct("k", F.floor(F.col("n") / 500)), start=1)
    expect = {(k, n): i for i, (k, n, *_) in enumerate(sorted(rows, key=lambda r: r[:2]), 1)}
    assert {(r.k, r.n): r.position for r in got.collect()} == expect


def test_run_starts(spark, series):
    rows, df = series
    df = df.where("v is not null")
    got = {(r.k, r.n) for r in runs.run_starts(df, ["k"], ["n"], "v", F.floor(F.col("n") / 300)).collect()}
    want = set()
    for key, items in by_key([r for r in rows if r[2]]).items():
        prev = None
        for _, n, v, _ in items:
            if v != prev:
                want.add((key, n))
            prev = v
    assert got == want


def test_region_that_returns_makes_three_runs(spark):
    df = spark.createDataFrame([("r", 1, 87), ("r", 520, 88), ("r", 1200, 87), ("r", 1300, 87)],
                               "k string, n bigint, v bigint")
    got = runs.run_starts(df, ["k"], ["n"], "v", F.floor(F.col("n") / 1000)).orderBy("n").collect()
    assert [(r.n, r.v) for r in got] == [(1, 87), (520, 88), (1200, 87)]


def test_asof_lookup_clamps_below_first_run(spark):
    rnd = random.Random(3)
    facts = {k: sorted(rnd.sample(range(10, 9000), 60)) for k in "ab"}
    rows = [(k, s, s * 7) for k, starts in facts.items() for s in starts]
    probes = [(k, rnd.randint(0, 10000)) for k in "ab" for _ in range(300)]
    got = runs.run_lookup(spark.createDataFrame(probes, "k string, at bigint"),
                          spark.createDataFrame(rows, "k string, start bigint, v bigint"),
                          ["k"], "at", "start", ["v"], width=700)
    found = {(r.k, r["at"]): (r.start, r.v) for r in got.collect()}
    assert set(found) == set(probes)
    for (k, at), (start, v) in found.items():
        want = max([s for s in facts[k] if s <= at] or [facts[k][0]])
        assert (start, v) == (want, want * 7)


def test_walk_prefers_left_on_tie(spark):
    compat = spark.createDataFrame([("s", 2, 10), ("s", 6, 20), ("t", 5, 30)],
                                   "k string, _pos bigint, r bigint")
    probes = spark.createDataFrame([("s", 4), ("s", 5), ("s", 0), ("t", 9), ("u", 1)],
                                   "k string, p bigint")
    got = {(r.k, r.p): r.r for r in
           runs.nearest_compatible(probes, compat, ["k"], "p", "r", width=2).collect()}
    assert got == {("s", 4): 10, ("s", 5): 20, ("s", 0): 10, ("t", 9): 30}


def test_exact_percentiles(spark):
    import numpy as np
    rnd = random.Random(5)
    rows = [(g, round(rnd.lognormvariate(3, 2), 1)) for g in "aaab" for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p50": .5, "p90": .9, "p99": .99}
    for keys in ([], ["g"]):
        for r in ordered.exact_percentiles(df, keys, "v", probs, edges=16).collect():
            vals = [v for g, v in rows if not keys or g == r["g"]]
            for name, p in probs.items():
                assert r[name] == pytest.approx(float(np.percentile(vals, p * 100)))


def test_chunked_lists(series):
    rows, df = series
    got = ordered.chunked_lists(df, ["k"], ["n"], F.col("n"), F.floor(F.col("n") / 500), size=100)
    parts = {}
    for r in got.orderBy("k", "part").collect():
        assert len(r["items"]) <= 100
        parts.setdefault(r.k, []).extend(r["items"])
    assert parts == {k: [x[1] for x in v] for k, v in by_key(rows).items()}


def test_morton_keys_are_intervals_of_cells(spark):
    rows = spark.sql("SELECT x, y FROM (SELECT explode(sequence(0L, 15L)) AS x) CROSS JOIN (SELECT explode(sequence(0L, 15L)) AS y)")
    keys = {(r.x, r.y): r.k for r in rows.select("x", "y", nearest.morton(F.col("x"), F.col("y")).alias("k")).collect()}
    assert sorted(keys.values()) == list(range(256))
    assert all(keys[x, y] >> 2 * b == keys[x >> b, y >> b] for x, y in keys for b in range(5))


@pytest.mark.parametrize("limit,node", [(1_000_000, 64), (0, 3)])
def test_nearest_equals_brute_force(spark, limit, node, monkeypatch):
    monkeypatch.setattr(nearest, "NODE", node)
    rnd = random.Random(11)
    targets, queries = [], []
    for g in range(3):
        for i in range(150 if g == 0 else 6):
            # Group 0 holds a tight cluster, duplicates and a few far points.
            cx = 100.0 if i % 3 else rnd.uniform(0, 1000)
            targets.append((g, g * 1000 + i, round(cx + rnd.random(), 2), round(rnd.uniform(0, 3), 2)))
        targets.append((g, g * 1000 + 900, targets[-1][2], targets[-1][3]))
    for q in range(600):
        queries.append((q, rnd.choice([0, 0, 0, 1, 2, 9]), rnd.uniform(-200, 1500), rnd.uniform(-50, 60)))
    queries.append((9999, 0, None, 1.0))
    got = nearest.nearest_in_group(
        spark.createDataFrame(queries, "q int, g int, x double, y double"),
        spark.createDataFrame(targets, "g int, t int, x double, y double"),
        ["g"], ("x", "y"), ("x", "y"), "t", "d", leaf_targets=5, broadcast_limit=limit).collect()
    assert len(got) == len(queries)
    found = {r.q: (r.t, r.d) for r in got}
    for q, g, x, y in queries:
        near = [((x - tx) ** 2 + (y - ty) ** 2, t) for tg, t, tx, ty in targets if tg == g] \
            if x is not None else []
        if not near:
            assert found[q] == (None, None)
            continue
        d2, t = min(near)
        assert found[q][0] == t and found[q][1] == pytest.approx(math.sqrt(d2))


def test_snap_within_fifty_metres(spark):
    schema = "mun string, id string, lat double, lon double"
    base = spark.createDataFrame([("1", "b", -12.129643, -61.993019)], schema)
    new = spark.createDataFrame([("1", "near", -12.129823, -61.993019),
                                 ("1", "far", -12.2, -61.993019),
                                 ("2", "other", -12.129823, -61.993019)], schema)
    got = {r.id: (r.lat, r.moved) for r in
           nearest.snap_to_existing(new, base, ["mun"], "lat", "lon", "id", 50.0, "moved").collect()}
    assert got == {"near": (-12.129643, True), "far": (-12.2, False), "other": (-12.129823, False)}


def test_shares_fall_back_to_addresses(spark):
    rows = [("s", 1, 0, 4), ("s", 2, 0, 6), ("t", 1, 3, 9), ("t", 2, 1, 1)]
    df = spark.createDataFrame(rows, "rua string, r bigint, dom bigint, n_enderecos bigint")
    w = shares.weighted(df, ["rua"], "dom", "n_enderecos")
    got = {(r.rua, r.r): (r.fracao, r.n_regioes) for r in shares.member_shares(w, ["rua"], "r").collect()}
    assert got == {("s", 1): (.4, 2), ("s", 2): (.6, 2), ("t", 1): (.75, 2), ("t", 2): (.25, 2)}
    best = {r.rua: r.r_dominante for r in
            shares.dominant_member(shares.member_shares(w, ["rua"], "r"), ["rua"], "r").collect()}
    assert best == {"s": 2, "t": 1}


def test_fold_tail(spark):
    rows = [("a", f"n{i}", 100 - i) for i in range(8)] + [("b", f"n{i}", 10) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, nome string, votos bigint")
    got = shares.fold_tail(df, ["k"], "nome", "votos", n=5).orderBy("k", "rank").collect()
    a = [(r.nome, r.votos) for r in got if r.k == "a"]
    assert a[-1] == ("Outros", 95 + 94 + 93) and len(a) == 6
    assert len([r for r in got if r.k == "b"]) == 3
    df6 = df.where("k = 'a' and nome < 'n6'")
    assert shares.fold_tail(df6, ["k"], "nome", "votos", n=5).where("nome = 'Outros'").count() == 0


def test_polyconic_analytic_points(spark):
    pts = [(0.0, -54.0), (0.0, -44.0), (-15.0, -54.0), (-15.0, -50.0), (-15.0, -58.0)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    x, y = geo.polyconic(F.col("lat"), F.col("lon"))
    r = {(a.lat, a.lon): (a.x, a.y) for a in df.select("lat", "lon", x.alias("x"), y.alias("y")).collect()}
    assert r[0.0, -54.0] == (5e6, 1e7)
    assert r[0.0, -44.0] == (pytest.approx(5e6 + 6378137 * math.radians(10)), 1e7)
    assert r[-15.0, -54.0] == (pytest.approx(5e6), pytest.approx(1e7 + geo.meridian_arc(-15)))
    east, west = r[-15.0, -50.0], r[-15.0, -58.0]
    assert east[0] - 5e6 == pytest.approx(5e6 - west[0]) and east[1] == pytest.approx(west[1])
    # Parallels of the polyconic grid keep their true length.
    assert east[0] - 5e6 == pytest.approx(
        6378137 / math.sqrt(1 - 0.00669438 * math.sin(math.radians(15)) ** 2)
        * math.cos(math.radians(15)) * math.radians(4), rel=2e-4)


def test_nearest_of_far_points_over_many_tiles(spark, monkeypatch):
    """A dense strip with ties, asked from far away: tiles, chunks and ids of any type, few rows met."""
    monkeypatch.setattr(nearest, "CHUNK", 50)
    targets = spark.range(4000).selectExpr("concat('t', id) AS t", "CAST(id % 2 AS INT) AS g", "CAST(id * 7919 % 1009 AS DOUBLE) / 2 AS x",
                                           "CAST(id * 31 % 7 AS DOUBLE) / 4 AS y")
    queries = spark.range(1500).selectExpr("id AS q", "IF(id = 7, NULL, CAST(id % 3 AS INT)) AS g", "CAST(id * 613 % 1000 AS DOUBLE) / 2 AS x",
                                           "CAST(id * 17 % 400 - 600 AS DOUBLE) AS y")
    met = []
    real = nearest._met
    monkeypatch.setattr(nearest, "_met", lambda asked, goal: met.append(asked.count()) or real(asked, goal))
    got = nearest.nearest_in_group(queries, targets, ["g"], ("x", "y"), ("x", "y"), "t", "d", leaf_targets=4)
    found = {r.q: (r.t, r.d) for r in got.collect()}
    spots = [(r.g, r.x, r.y, r.t) for r in targets.collect()]
    assert len(found) == 1500
    for q in queries.collect():
        near = min((((q.x - x) ** 2 + (q.y - y) ** 2, t) for g, x, y, t in spots if g == q.g), default=None)
        assert found[q.q] == ((near[1], math.sqrt(near[0])) if near else (None, None))
    assert len(met) == 2 and met[1] < 20 * met[0]


def test_nearest_asks_few_other_tiles(spark, monkeypatch):
    """Points far from a dense band, or amid a sparse field, ask hardly more than the tile of the nearest box."""
    targets = spark.range(9000).selectExpr("id AS t", "1 AS g", "CAST(id * 7919 % 10007 AS DOUBLE) / 10 AS x",
                                           "CAST(id * 104729 % IF(id % 3 = 0, 97, 8009) AS DOUBLE) / 10 AS y")
    queries = spark.range(3000).selectExpr("id AS q", "1 AS g", "CAST(id % 1500 * 613 % 10007 AS DOUBLE) / 10 AS x",
                                           "CAST(id % 1500 * 1013 % 10009 AS DOUBLE) / 10 - 200 AS y")
    met = []
    real = nearest._met
    monkeypatch.setattr(nearest, "_met", lambda asked, goal: met.append(asked.count()) or real(asked, goal))
    got = nearest.nearest_in_group(queries, targets, ["g"], ("x", "y"), ("x", "y"), "t", "d", leaf_targets=8)
    found = {r.q: (r.t, r.d) for r in got.collect()}
    spots = targets.orderBy("t").toPandas()
    for q in queries.where("q < 1500").collect():
        d2 = ((q.x - spots.x) ** 2 + (q.y - spots.y) ** 2).to_numpy()
        assert found[q.q] == found[q.q + 1500] == (d2.argmin(), math.sqrt(d2.min()))
    assert len(found) == 3000 and len(met) == 2 and met[1] < met[0] / 2


def test_nearest_of_repeated_and_extreme_points(spark, monkeypatch):
    """Each row is answered once, whether its point is repeated over tasks, signed zero or infinite."""
    monkeypatch.setattr(nearest, "CHUNK", 20)
    targets = spark.range(1000).selectExpr("id AS t", "1 AS g", "CAST(id % 40 AS DOUBLE) - 20 AS x", "CAST(id DIV 40 AS DOUBLE) AS y")
    queries = spark.range(0, 300, 1, 6).selectExpr("id AS q", "1 AS g", """CASE id % 3 WHEN 0 THEN -0.0D WHEN 1 THEN 0.0D ELSE DOUBLE('Infinity') END AS x""",
                                                   "-0.5D AS y")
    got = nearest.nearest_in_group(queries, targets, ["g"], ("x", "y"), ("x", "y"), "t", "d", leaf_targets=3).collect()
    assert sorted((r.q, r.t, r.d) for r in got) == [(q, 0, math.inf) if q % 3 == 2 else (q, 20, .5) for q in range(300)]
