"""URL filter, quality classifier, near-duplicates, scores, vectors and the pipeline against plain versions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshtally.llm import components, minhash, quality, scoring, urls, vectors
from meshtally.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    for c in "?#":
        path = path.split(c)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path


def ruled(host, path):
    best = None
    for verdict, rule in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (not best or len(rule) > len(best[0])):
            best = rule, verdict
    return best


def plain_verdicts(rows):
    """page rows to verdicts by counting triples in dictionaries."""
    known = {}
    for _, url in rows:
        host, path = parts(url)
        known[host + path] = ruled(host, path)

    def triples(address):
        s = urls.START * 2 + "".join(c if "!" <= c <= "~" else urls.OTHER for c in address) + urls.END
        return [s[i:i + 3] for i in range(len(s) - 2)]

    counts = {}
    for side in ("allow", "block"):
        c = Counter(t for a, r in known.items() if r and r[1] == side for t in triples(a))
        counts[side] = c, *(Counter() for _ in range(4)), sum(c.values())
        for t, n in c.items():
            for k, key in enumerate((t[1:], t[2], t[:2], t[1])):
                counts[side][k + 1][key] += n

    def chance(side, t):
        three, pair, one, ctx2, ctx1, total = counts[side]
        p = (one[t[2]] + urls.PRIOR / urls.ALPHABET) / (total + urls.PRIOR)
        p = (pair[t[1:]] + urls.PRIOR * p) / (ctx1[t[1]] + urls.PRIOR)
        return (three[t] + urls.PRIOR * p) / (ctx2[t[:2]] + urls.PRIOR)

    score = {a: np.mean([math.log(chance("allow", t)) - math.log(chance("block", t)) for t in triples(a)]) for a in known}
    sides = {s: [score[a] for a, r in known.items() if r and r[1] == s] for s in ("allow", "block")}
    least = 0.0
    if all(sides.values()):
        (ma, sa), (mb, sb) = ((np.mean(v), np.std(v)) for v in sides.values())
        least = (ma * sb + mb * sa) / (sa + sb) if sa + sb else (ma + mb) / 2
    out = []
    for page, url in rows:
        host, path = parts(url)
        r = known[host + path]
        out.append((page, host, path, r and r[0], r[1] if r else "allow" if score[host + path] >= least - 1e-8 else "block"))
    return out


def test_urls_equal_a_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    rows += [(-1, None), (-2, "no scheme"), (-3, "http://WWW.Example.com/en/x?y"), (-4, "http://a.com"), (-5, "x://É.net/es/a#b"),
             (-6, "http://example.com/en/q"), (-7, "://"), (-8, "http://h?://q/p"), (-9, "http://notexample.com/en/"), (-1, None)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, address string")
    got = [tuple(r)[:5] for r in urls.judge(pages, URL_RULES).collect()]
    assert sorted(got, key=str) == sorted(plain_verdicts(rows), key=str)
    assert {"allow", "block"} == {g[4] for g in got if g[3] is None}
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def test_the_url_query_scores_whole_urls(spark, tmp_path):
    rows = [(i, f"http://a.com/p{i}?good=yes") for i in range(20)] + [(100 + i, f"http://a.net/es/p{i}?junk=x#zz") for i in range(20)]
    rows += [(200, "http://b.org/p?good=yes"), (201, "http://b.org/p?junk=x#zz"), (202, "good=yes"), (203, "junk=x#zz"), (204, None), (205, None)]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in QUERIES["op3_urls"](spark, str(tmp_path)).collect()}
    assert [got[i].verdict for i in (200, 201, 202, 203)] == ["allow", "block", "allow", "block"]
    assert (got[201].host, got[201].path, got[201].rule) == ("b.org", "/p", None) and got[119].rule == "net/es/"
    assert got[204].verdict == got[205].verdict


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op4_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.93
    good, bad = ([r.score for r in held if labels[r.doc_id] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_trees_walk_as_a_loop_would(spark):
    rng = np.random.default_rng(5)
    x = rng.random((500, 4))
    y = (x[:, 0] + x[:, 1] > 1).astype(float)
    trees = quality.grow(x, y)

    def one(row):
        total = trees.base
        for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + (row[feature[at]] > limit[at])
            total += value[at - len(feature)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(trees.score(x), [one(r) for r in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 100000), (None, "x")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality.scores(docs, none).collect()
    assert len(got) == 4 and all(r.score == 0.5 for r in got)
    assert quality.scores(docs.limit(0), none).count() == 0


def plain_components(ids, links):
    label = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(1000, 1060)] + [(0, i) for i in range(5, 300)] + [(7, 7)] + [
        (rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = plain_components({x for l in links for x in l}, links)
    assert {k: v for k, v in want.items() if got.get(k, k) != v} == {}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text, n):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(60)]
    texts = []
    for d in range(60):  # a family that is alike in part only, so stars leave something undecided
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(60)] = word()
        texts.append(" ".join(t))
    texts += [" ".join(word() for _ in range(50)) for _ in range(20)]
    texts += [texts[3], texts[3].upper(), "", None, "  \n", "one", "ONE", "a b c d", "a b c d e", "a b c d e f g h", "a b c d e f g h i",
              "é b c d e f g h", " ".join(word() for _ in range(40000))]
    rows = [(i * 3 % 101 + 1000 * (i > 100), t, "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, band string, node int").repartition(5)
    sets = {d: shingles(t, 4) for d, t, *_ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = plain_components(sets, links)
    got = minhash.near_duplicates(docs.unionByName(docs.limit(1)), words=4).collect()
    assert len(got) == len(rows) + 1 and len(links) > 60
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    none = minhash.near_duplicates(spark.createDataFrame([(None, "a b c d e"), (None, None)], "doc_id bigint, text string"), words=4)
    assert [(r.component_id, r.kept) for r in none.collect()] == [(None, False)] * 2
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(8)
    sign = minhash.Signer()
    for size in (5, 400):
        hits = []
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
            hits.append((sign(a) == sign(a[:-1] if size == 5 else a)).mean())
        assert np.mean(hits) > (0.08 if size == 5 else 0.99)


def test_blocks_compare_what_one_comparison_would(spark, monkeypatch):
    rng = random.Random(9)
    sets = [np.unique(np.array([rng.randrange(40) for _ in range(25)], np.uint64)) for _ in range(30)]
    nodes = list(range(30))
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 60 * len(np.union1d(a, b))
    comps = np.array([n % 7 for n in nodes])
    got = {(a, comps[b]) for a, b in minhash.across(nodes, comps, np.zeros(30), sets, 60)}
    assert got == {(a, comps[b]) for a in nodes for b in nodes if comps[a] < comps[b] and alike(sets[a], sets[b])}


def test_blocks_of_a_bucket_follow_its_shingles(spark):
    most = minhash.BLOCK_SHINGLES
    rows = [(1, d, 10) for d in range(8)] + [(2, d, most // 2) for d in range(8)] + [(3, 1, 5), (3, 2, 5)]
    members = spark.createDataFrame(rows, "band bigint, node bigint, n bigint")
    links = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    got = minhash.undecided(members, links).select("band", "blocks").distinct().collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 4)]


@pytest.mark.parametrize("block_size", [500, scoring.BLOCK])
def test_scores_equal_brute_force(spark, block_size):
    rng = random.Random(10)
    vocabulary = ["The", "the", "cat", "É", "sat\x1con"] + [f"w{i}" for i in range(12)]
    rows = [(d, " ".join(rng.choice(vocabulary) + rng.choice(["", "", "\n"]) for _ in range(rng.randint(0, 40)))) for d in range(150)]
    rows += [(500, None), (501, "unheard of"), (None, "the cat"), (502, "the cat " * 30000), (503, "the cat É w1 " * 9)]
    rows += [(None, "over and over")] * 40 + [(7, rows[7][1])]  # repeated rows, some without id
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id bigint, text string, block string, tokens string").repartition(3)
    lower = lambda t: [w for w in (t or "").encode().lower().decode().replace("\n", " ").split(" ") if w]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts, texts = Counter(), 0
    for d, t in rows:
        if not held(d):
            words = ["<>", *lower(t), "</>"]
            for k in (1, 2, 3):
                counts.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
            texts += 1
    one = {w[0]: n for w, n in counts.items() if len(w) == 1 and w[0] != "<>"}
    total, kinds = sum(one.values()), len(one)

    def chance(*gram):
        """Of the last word after the others."""
        if len(gram) == 1:
            return (one.get(gram[0], 0) + 1) / (total + kinds + 1)
        return (counts[gram] + scoring.PRIOR * chance(*gram[1:])) / (counts[gram[:-1]] + scoring.PRIOR)

    got = sorted(scoring.scores(docs, block_size=block_size).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.score))
    want = []
    for d, t in rows:
        words = ["<>", *lower(t), "</>"]
        want.append((d, held(d), len(words) - 1, sum(one.get(w, 0) > 0 for w in words[1:]), total,
                     sum(math.log10(chance(w)) for w in words[1:]),
                     sum(math.log10(chance(*words[max(0, i - 2):i + 1])) for i in range(1, len(words)))))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    assert len(got) == len(want)
    for r, w in zip(got, want):
        assert tuple(r)[:5] == w[:5] and r.base_score == pytest.approx(w[5], rel=1e-9) and r.score == pytest.approx(w[6], rel=1e-9)
    for h in (("cat",), ("<>",), ("the", "cat"), ("unheard", "the")):  # one unseen word more makes each state's sum 1
        assert sum(chance(*h, w) for w in [*one, "never seen"]) == pytest.approx(1)
    assert scoring.scores(docs.limit(0)).count() == 0
    assert {r.n_known for r in scoring.scores(docs.where("doc_id = 501"), modulus=1 << 40).collect()} == {3}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((1500, 64)).astype(np.float32)
    near = [base[i % 40] + rng.standard_normal(64) * rng.uniform(0, 0.35) for i in range(500)]
    rows = [[float(v) for v in r] for r in [*base, *near, base[0], base[0] * 2]]
    rows += [None, [], [0.0] * 64, [float("nan")] * 64, [None] + [1.0] * 63, [1.0, 2.0]]
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], "vec_id bigint, embedding array<float>, node int").repartition(4)
    x = np.array(rows[:2002], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = x @ x.T >= 0.95
    np.fill_diagonal(links, False)
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    assert len(got) == len(rows)
    mine = np.array([got[i].n_links for i in range(len(x))])
    assert (mine <= links.sum(axis=1)).all() and mine.sum() >= 0.99 * links.sum() > 0
    want = plain_components(range(len(x)), np.argwhere(links).tolist())
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) > 0.99
    for i in range(2002, len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_a_link_found_from_one_side_counts_for_both(spark):
    angles = [-0.1, 0.0, 0.2, 0.25]
    rows = [(i, 2 if i == 3 else 1, np.array([np.cos(a), np.sin(a)]).tobytes()) for i, a in enumerate(angles)]
    nodes = spark.createDataFrame([(i, w, bytearray(u)) for i, w, u in rows], "node bigint, weight bigint, unit binary")
    x = vectors.stack([u for _, _, u in rows])
    q = vectors.Quantiser(x, 1)
    q.coarse = np.array([[1.0, -0.1], [1.0, 0.25]])  # the first two vectors in list 0, the others in list 1
    q.coarse /= np.linalg.norm(q.coarse, axis=1)[:, None]
    q.between = np.sqrt(vectors.squared(q.coarse, q.coarse))
    coded = vectors.coded(nodes, q)
    assert dict(coded.select("node", "list").collect()) == {0: 0, 1: 0, 2: 1, 3: 1}
    coded = coded.withColumn("probes", F.expr("IF(list = 0, array(0L, 1L), array(1L))"))
    got = dict(vectors.found(coded, q, 0.95).groupBy("node").agg(F.sum("links")).collect())
    want = {i: sum(w for j, w, _ in rows if j != i and x[i] @ x[j] >= 0.95) for i in range(4)}
    assert got == want and want[2] == 4 and want[3] == 2


def test_vectors_of_every_width_are_linked(spark):
    rows = [(i, [float(i), 1.0, 0.0]) for i in range(1, 4)] + [(10, [1.0, 1.0]), (11, [2.0, 2.0]), (12, [1.0, 1.01]), (13, [-1.0, 1.0]), (20, [5.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(table).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (1, 2), 10: (2, 10), 11: (2, 10), 12: (2, 10), 13: (0, 13), 20: (0, 20)}


def test_pipeline_keeps_its_contract(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        seen.append(name)
        if name != "packing":
            assert docs.columns == columns and docs.count() <= before.count()
            assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
        if name == "quality":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in kept for d in good) > 0.95 * len(good)
        if name == "secrets":
            from meshtally.llm.secret_scan import scan
            assert not any(scan(r.text) for r in docs.select("text").collect())
    assert seen == ["quality", "lines", "near_duplicates", "secrets", "packing"]
    total = F.sum("length")  # cuts depend on the number of partitions, the ids don't
    assert corpus_pipeline.run(spark, sf).agg(total).first() == docs.agg(total).first()
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline
    rng = random.Random(12)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a), (1, a), (1, a), (2, a), (None, a), (None, a.upper()), (None, a + " more"), (3, b), (3, b), (4, c),
            (None, d), (None, d), (None, d.upper()), (None, e), (None, ""), (None, None), (None, " "), (5, ""), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    got = Counter((r.doc_id, r.text.lower() if r.text else r.text) for r in out.collect())
    assert out.columns == docs.columns
    assert got == Counter([(1, a), (3, b), (4, c), (None, d), (None, e), (None, ""), (None, None), (None, " "), (5, ""), (6, None)])


def test_stages_keep_unlike_texts_of_one_id_and_clashing_columns(spark):
    import corpus_pipeline
    texts = [" ".join(f"{a}{i}" for i in range(30)) for a in "pqrst"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[3]), (3, texts[3]), (4, texts[0]), (None, texts[4]), (None, texts[4]),
            (None, texts[1]), (5, ""), (5, None), (6, "one two"), (6, "two one"), (None, "")]
    clash = ["_id", "id", "own", "hash", "doc", "several", "_lost_by", "lost_by", "_lost_keys", "keys", "_kept_lines", "kept_lines", "node",
             "label", "set_hash", "kept", "a.b"]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or ""), *[k * 10 + c for c in range(len(clash))]) for k, (d, t) in enumerate(rows)],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                  + ", ".join(f"`{c}` bigint" for c in clash)).repartition(3)
    out = corpus_pipeline.near_duplicate_stage(spark, frame, SF)
    assert out.columns == frame.columns
    got = sorted(r["_id"] // 10 for r in out.collect())
    # 0 goes into 5 (named, exact copy), 4 repeats 3, 7 repeats 6, 8 is a copy of 1; texts without words stay.
    assert [k for k in got if k not in (1, 8)] == [2, 3, 5, 6, 9, 10, 11, 12, 13] and len({1, 8} & set(got)) == 1 and len(got) == 10
    assert all(r["_id"] % 10 == 0 and r["a.b"] == r["_id"] + 16 for r in out.collect())

    line = "This line stands in three documents."
    docs = frame.withColumn("text", F.concat_ws("\n", F.lit(line), "text")).where("doc_id IS NOT NULL")
    kept = corpus_pipeline.line_stage(spark, docs, SF)
    assert kept.columns == frame.columns and kept.count() == docs.count()
    for r in kept.collect():
        assert (line in r.text) == (r.doc_id == 6) and r.n_chars == len(r.text) and r["_lost_keys"] == r["_id"] + 8
    safe = corpus_pipeline.secret_stage(spark, frame, SF)
    assert safe.columns == frame.columns and safe.count() == frame.count()
