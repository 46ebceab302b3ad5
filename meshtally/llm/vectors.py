"""Embedding near-duplicates by product quantisation.

A coarse quantiser makes inverted lists; residuals are coded by subspace. Every vector is
in the index. A query probes its nearest lists and all those whose border passes within a
margin of it. In a list, distances to the codes are looked up in the query's own tables;
whatever could be close enough, by each vector's own coding error, is compared exactly.
Equal vectors are one class. Lists are worked on in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import stored
from meshtally.llm.components import components

SAMPLE = 20_000  # most vectors that the quantisers are fitted on
MOST_LISTS = 4096
PARTS, WORDS = 8, 256  # subspaces, codewords of each
ROUNDS = 8
LEAST_PROBES = 4
MARGIN = 0.12  # distance from a list's border within which a query probes beyond it
BLOCK = 1024  # vectors of a block
SLACK = 1e-9


def centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k means of rows; fewer rows than that are repeated."""
    c = x[rng.permutation(np.arange(max(k, len(x))) % len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = nearest(x, c)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1))


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


class Quantiser:
    """Coarse centres and residual codewords, fitted on unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 10):
        rng = np.random.default_rng(seed)
        self.coarse = centres(sample, lists, rng)
        self.between = np.sqrt(squared(self.coarse, self.coarse))
        rest = sample - self.coarse[nearest(sample, self.coarse)]
        self.cuts = np.linspace(0, sample.shape[1], min(PARTS, sample.shape[1]) + 1).astype(int)
        self.words = [centres(rest[:, a:b], WORDS, rng) for a, b in zip(self.cuts, self.cuts[1:])]

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, code and coding error (distance to what the code stands for) of unit vectors."""
        at = nearest(x, self.coarse)
        rest = x - self.coarse[at]
        parts = list(zip(self.cuts, self.cuts[1:], self.words))
        codes = np.stack([nearest(rest[:, a:b], w) for a, b, w in parts], axis=1).astype(np.uint8)
        error = sum(((rest[:, a:b] - w[codes[:, j]]) ** 2).sum(1) for j, (a, b, w) in enumerate(parts))
        return at, codes, np.sqrt(error)

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each vector is looked up in."""
        d = squared(x, self.coarse)
        own = d.argmin(1)
        # Distance to the border with another list's cell, along the line between the centres.
        near = d - d.min(1)[:, None] <= 2 * MARGIN * self.between[own]
        few = np.argpartition(d, min(LEAST_PROBES, d.shape[1]) - 1, axis=1)[:, :LEAST_PROBES]
        near[np.arange(len(x))[:, None], few] = True
        return [np.flatnonzero(n) for n in near]

    def lookup(self, x: np.ndarray, list_: int, codes: np.ndarray) -> np.ndarray:
        """Distance of each query to each member's code, by table look-up."""
        rest = x - self.coarse[list_]
        out = np.zeros((len(x), len(codes)))
        for j, (a, b, w) in enumerate(zip(self.cuts, self.cuts[1:], self.words)):
            out += squared(rest[:, a:b], w)[:, codes[:, j]]
        return np.sqrt(out)


def unit_vectors(table: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """vec_id, the vector at length one (little-endian doubles) or null, its dimension and hash."""
    @F.arrow_udf("struct<unit:binary,width:bigint,class:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for v in batch.to_pylist():
                x = np.array(v, float) if v and None not in v else np.zeros(1)
                top = np.abs(x).max()
                good = np.isfinite(x).all() and top > 0
                u = (x / top) / np.linalg.norm(x / top) if good else x
                raw = (u + 0.0).astype("<f8").tobytes()
                rows.append({"unit": raw, "width": len(u), "class": xxhash.xxh3_128_hexdigest(raw)} if good else
                            {"unit": None, "width": None, "class": None})
            yield pa.array(rows, pa.struct([("unit", pa.binary()), ("width", pa.int64()), ("class", pa.string())]))

    return table.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), run(F.col(f"`{vector}`")).alias("_v")).select("vec_id", "_v.*")


def stack(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def fitted(nodes: DataFrame, n: int) -> Quantiser:
    """Quantisers from a bounded sample, those of the least hashed ids."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("unit").collect()
    return Quantiser(stack([bytes(r.unit) for r in rows]), int(min(MOST_LISTS, max(1, len(rows) // 8), max(1, n ** 0.5 / 2))))


def coded(nodes: DataFrame, quantiser: Quantiser) -> DataFrame:
    """nodes with list, codes, error and the lists to probe."""
    shared = nodes.sparkSession.sparkContext.broadcast(quantiser)

    @F.arrow_udf("struct<list:bigint,codes:binary,error:double,probes:array<bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        q = shared.value
        kind = pa.struct([("list", pa.int64()), ("codes", pa.binary()), ("error", pa.float64()), ("probes", pa.list_(pa.int64()))])
        for batch in batches:
            raw, rows = batch.to_pylist(), []
            for i in range(0, len(raw), BLOCK):
                x = stack(raw[i:i + BLOCK])
                at, codes, error = q.code(x)
                rows += [{"list": int(a), "codes": c.tobytes(), "error": float(e), "probes": p}
                         for a, c, e, p in zip(at, codes, error, q.probes(x))]
            yield pa.array(rows, kind)

    return nodes.select("*", run("unit").alias("_q")).select("node", "weight", "unit", "_q.*")


def found(index: DataFrame, quantiser: Quantiser, cosine: float) -> DataFrame:
    """(node, links, other): links counts the vectors linked within a block; node and other connect the linked ones.

    A pair counts for the asker, and for the member too where the member doesn't ask the asker's list.
    """
    shared = index.sparkSession.sparkContext.broadcast(quantiser)
    asks = index.select(F.col("node").alias("asker"), F.col("weight").alias("heft"), F.col("unit").alias("ask"),
                        F.col("list").alias("home"), F.explode("probes").alias("list"))
    blocks = {"m": index.groupBy("list").count(), "q": asks.groupBy("list").count()}
    sizes = None
    for side, count in blocks.items():
        count = count.select("list", F.ceil(F.col("count") / BLOCK).alias(f"{side}_blocks"))
        sizes = count if sizes is None else sizes.join(count, "list")
    sizes = F.broadcast(sizes)  # MOST_LISTS rows
    members = (index.select("node", "weight", "unit", "codes", "error", "probes", "list").join(sizes, "list")
               .withColumn("m", F.pmod(F.xxhash64("node", F.lit(1)), "m_blocks")).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1))))
    asks = (asks.join(sizes, "list")
            .withColumn("q", F.pmod(F.xxhash64("asker", F.lit(1)), "q_blocks")).withColumn("m", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1))))
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK

    def run(queries: pa.Table, held: pa.Table) -> pa.Table:
        out = ([], [], [])
        if queries.num_rows and held.num_rows:
            q = shared.value
            x, y = stack(queries.column("ask").to_pylist()), stack(held.column("unit").to_pylist())
            ids, others = queries.column("asker").to_numpy(), held.column("node").to_numpy()
            codes = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(len(y), -1)
            close = q.lookup(x, held.column("list")[0].as_py(), codes) <= reach + held.column("error").to_numpy()
            i, j = np.nonzero(close & (ids[:, None] != others))
            exact = np.concatenate([np.einsum("ab,ab->a", x[i[k:k + 65536]], y[j[k:k + 65536]])
                                    for k in range(0, len(i), 65536)] or [np.zeros(0)])
            i, j = i[exact >= cosine], j[exact >= cosine]
            links = np.bincount(i, held.column("weight").to_numpy()[j], len(x)).astype(np.int64)
            # A member that doesn't probe the asker's list won't find the pair itself.
            homes, home = np.unique(queries.column("home").to_numpy(), return_inverse=True)
            probed = held.column("probes").combine_chunks()
            owner, wanted = np.repeat(np.arange(len(y)), probed.value_lengths().to_numpy()), probed.flatten().to_numpy()
            at = np.minimum(np.searchsorted(homes, wanted), len(homes) - 1)
            asks_back = np.zeros((len(y), len(homes)), bool)
            asks_back[owner[homes[at] == wanted], at[homes[at] == wanted]] = True
            alone = ~asks_back[j, home[i]]
            back = np.bincount(j[alone], queries.column("heft").to_numpy()[i[alone]], len(y)).astype(np.int64)
            # Connect each block's linked vectors by stars: labels fall until they agree.
            label_q, label_m = ids.copy(), others.copy()
            while len(i):
                old_q, old_m = label_q.copy(), label_m.copy()
                np.minimum.at(label_m, j, label_q[i])
                np.minimum.at(label_q, i, label_m[j])
                if (old_q == label_q).all() and (old_m == label_m).all():
                    break
            a, b = np.unique(i), np.unique(j)
            out = (np.concatenate([ids[a], others[b]]), np.concatenate([links[a], back[b]]),
                   np.concatenate([label_q[a], label_m[b]]))
        return pa.table([pa.array(c, pa.int64()) for c in out], ["node", "links", "other"])

    keys = ("list", "q", "m")
    return (asks.select(*keys, "asker", "heft", "home", "ask").groupBy(*keys)
            .cogroup(members.select(*keys, "node", "weight", "unit", "codes", "error", "probes").groupBy(*keys))
            .applyInArrow(run, "node bigint, links bigint, other bigint"))


def near_vectors(table: DataFrame, cosine: float = 0.95, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of table.

    Vectors with a cosine of `cosine` or more, in double precision, are linked if the index
    brings them together; none below it are. Vectors that are null, empty, zero or hold null
    or non-finite components, or whose vec_id is null, link with nothing. Vectors of
    different dimensions are not linked; each dimension has an index of its own. vec_id
    names one vector; rows that repeat it count as further vectors. Other columns are not read.
    """
    rows = stored(unit_vectors(table, vector, vec_id))
    good = rows.where("vec_id IS NOT NULL AND unit IS NOT NULL")
    nodes = stored(good.groupBy("class", "width").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"),
                                                      F.first("unit").alias("unit")))
    links = None
    for width, n in nodes.groupBy("width").count().where("count > 1").orderBy("width").collect():  # one row a dimension
        mine = nodes.where(F.col("width") == width)
        quantiser = fitted(mine, n)
        part = stored(found(stored(coded(mine, quantiser)), quantiser, cosine)).withColumn("width", F.lit(width).cast("bigint"))
        links = part if links is None else links.unionByName(part)
    if links is not None:
        labels = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
        counts = links.groupBy("node", "width").agg(F.sum("links").alias("links"))
        nodes = nodes.join(counts, ["node", "width"], "left").join(labels, "node", "left")
    else:
        nodes = nodes.withColumns({"links": F.lit(0), "label": F.col("node")})
    known = stored(nodes.select("class", "width", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                F.coalesce("label", "node").alias("label")))
    mine = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("class")).alias("class"), "width")
    component = F.coalesce("label", "vec_id")
    return (mine.join(known, ["class", "width"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept")))
