"""Nearest neighbour inside a group, exact, without comparing all pairs.

Groups of few targets are short lists, joined to the query rows. The targets of other
groups lie in tiles of bounded number: slabs along x, each cut along y, so that their boxes
meet at edges only. A query point is first sent to the tile whose box is nearest, which gives
a real target and its distance; then to those other tiles whose box is not farther than that,
mostly none. Inside a tile, points and boxes of points are searched by the same two steps. So
a point far from all targets costs no more than one amid them, and the work grows with the
queries, times the depth of the tree.

Only the boxes of the tiles of groups with several tiles (one row for some thousand targets)
pass through the driver. A tile that many query points ask is met by them in chunks. The
least possible distance to a box never exceeds, rounded as it is, the distance computed
to a point in it, so pruning cannot lose a neighbour to rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshtally.operators.ordered import ordinal
from meshtally.session import settle

LEAF_TARGETS = 128     # where no group has more targets, each is one short list
TILE = 16              # targets of a tile, in times that
BLOCKS = 4096          # parts along x that are ordered apart
NODE = 8               # boxes in a node of a search tree
CHUNK = 200_000        # query points that meet a tile in one task
TASK = 20_000          # fewest query points for which another task is worth while
SLICE = 2048           # query points searched at once
BROADCAST_CANDIDATES = 1_000_000   # about 40 MB of lists; beyond it, a shuffled join


# The masks that spread 32 bits over the even bits of 64.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
           (1, 0x5555555555555555))


def morton(x: Column, y: Column) -> Column:
    """Key of a cell along the Z curve: the bits of both numbers in turn."""
    def spread(c: Column) -> Column:
        for bits, mask in _SPREAD:
            c = c.bitwiseOR(F.shiftleft(c, bits)).bitwiseAND(F.lit(mask))
        return c
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def nearest_in_group(queries: DataFrame, targets: DataFrame, group: Sequence[str],
                     query_xy: tuple[str, str], target_xy: tuple[str, str], target_id: str,
                     distance: str = "distancia", leaf_targets: int = LEAF_TARGETS,
                     broadcast_limit: int = BROADCAST_CANDIDATES) -> DataFrame:
    """Every query row plus the id of the nearest target of its group and the distance.

    Euclidean in the unit of the coordinates; the smallest id wins a tie. Rows without
    a coordinate (null or NaN), or in a group without targets, keep nulls.
    """
    g = list(group)
    qx, qy = (F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in query_xy)
    goal = (targets.select(*g, F.nanvl(F.col(target_xy[0]).cast("double"), F.lit(None).cast("double")).alias("_tx"),
                           F.nanvl(F.col(target_xy[1]).cast("double"), F.lit(None).cast("double")).alias("_ty"),
                           F.col(target_id).alias("_tid"))
            .dropna(subset=[*g, "_tx", "_ty"])
            # Targets on one spot are one candidate: the smallest id answers for it.
            .groupBy(*g, "_tx", "_ty").agg(F.min("_tid").alias("_tid")))
    goal = settle(goal)
    sizes = goal.groupBy(*g).agg(F.count("*").alias("_n")).agg(F.max("_n"), F.count("*"), F.sum("_n")).first()
    kind = goal.schema["_tid"].dataType
    if sizes[0] is None:
        return queries.select("*", F.lit(None).cast(kind).alias(target_id), F.lit(None).cast("double").alias(distance))
    if sizes[0] <= leaf_targets:
        # Every group is one short list: a single lookup, no tiles.
        lists = goal.groupBy(*g).agg(F.collect_list(F.struct(
            F.col("_tx").alias("x"), F.col("_ty").alias("y"), F.col("_tid").alias("id"))).alias("_cand"))
        table = F.broadcast(lists) if sizes[1] + sizes[2] <= broadcast_limit else lists
        found = queries.join(table, g, "left").withColumn("_best", _closest(qx, qy))
        return found.select(*[F.col(c) for c in queries.columns], F.col("_best.id").alias(target_id),
                            F.sqrt("_best.d2").alias(distance))

    # One text names a group; it is null where a part of it is, which matches nothing.
    names = [F.col(c).cast("string") for c in g]
    key = names[0] if len(g) == 1 else F.when(F.concat(*names).isNotNull(), F.to_json(F.array(*names)))
    goal = _tiled(goal.select(key.alias("_g"), "_tx", "_ty", "_tid"), TILE * leaf_targets)
    zero = F.lit(0.0)  # added, it makes one number of 0 and -0
    placed = queries.select("*", key.alias("_g"), (qx + zero).alias("_qx"), (qy + zero).alias("_qy"))
    point = ["_qx", "_qy", "_g"]  # numbers sort faster than names
    asked = placed.select(*point).dropna()
    boxes = _boxes(goal)
    near = _met(settle(_homes(asked, boxes)), goal)
    best = F.struct("_d2", "_tid")
    if not boxes:
        found = placed.join(near.select(*point, best.alias("_best")), point, "left")
    else:
        near = settle(_with_others(near, boxes))
        others = near.select("_g", "_qx", "_qy", F.explode("_others").alias("_tile"), F.col("_d2").alias("_limit"))
        second = _met(settle(others), goal).groupBy(*point).agg(F.min(best).alias("_second"))
        found = (placed.join(near.select(*point, best.alias("_first")), point, "left").join(second, point, "left")
                 .withColumn("_best", F.least("_first", "_second")))
    return found.select(*[F.col(c) for c in queries.columns], F.col("_best._tid").alias(target_id),
                        F.sqrt("_best._d2").alias(distance))


def _tiled(goal: DataFrame, tile: int) -> DataFrame:
    """Targets with the number of their tile, of at most `tile` of them, and their rank in it by id."""
    sizes = goal.groupBy("_g").agg(F.count("*").alias("_size"), F.min("_tx").alias("_low"), F.max("_tx").alias("_high"))
    rows = settle(goal.join(sizes, "_g"))
    one = rows.where(F.col("_size") <= tile).withColumn("_tile", F.lit(0).cast("bigint"))
    part = F.floor((F.col("_tx") - F.col("_low")) / F.greatest(F.col("_high") - F.col("_low"), F.lit(1e-9)) * F.lit(BLOCKS))
    across = F.ceil(F.sqrt(F.col("_size") / F.lit(tile)))  # full tiles in a slab
    several = ordinal(rows.where(F.col("_size") > tile), ["_g"], ["_tx", "_ty"], part, out="_at")
    several = several.withColumn("_slab", F.floor(F.col("_at") / (across * tile)))
    up = F.row_number().over(Window.partitionBy("_g", "_slab").orderBy("_ty", "_tx"))
    several = several.withColumn("_tile", (F.col("_slab") * across + F.floor((up - 1) / tile)).cast("bigint"))
    tiles = several.drop("_at", "_slab").unionByName(one).drop("_low", "_high")
    return settle(tiles.withColumn("_rank", F.row_number().over(Window.partitionBy("_g", "_tile").orderBy("_tid"))))


def _boxes(goal: DataFrame) -> dict[str, Tree]:
    """Search trees over the boxes of the tiles, for the groups that have several."""
    rows = (goal.groupBy("_g", "_tile").agg(F.min("_tx"), F.max("_tx"), F.min("_ty"), F.max("_ty"), F.max("_size").alias("_size"), F.count("*").alias("_c"))
            .where("_c < _size").drop("_size", "_c").orderBy("_g", "_tile").toPandas())
    return {name: Tree(part.iloc[:, 2:].to_numpy(float).T, NODE) for name, part in rows.groupby("_g", sort=False)}


def _homes(asked: DataFrame, boxes: dict[str, Tree]) -> DataFrame:
    """Query points, once in a batch, with the tile of the nearest box, and no limit yet."""
    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(_once(batch["_g"].dictionary_encode().indices, batch["_qx"], batch["_qy"])))
            x, y, home = np.asarray(batch["_qx"]), np.asarray(batch["_qy"]), np.zeros(batch.num_rows, np.int64)
            for rows, tree in _of_groups(batch, boxes):
                row, tile, _ = _closest_in(tree, x[rows], y[rows], np.full(len(rows), np.inf))
                first = _starts(row)
                home[rows[row[first]]] = tile[first]
            yield pa.RecordBatch.from_arrays([batch["_g"], batch["_qx"], batch["_qy"], pa.array(home), pa.array(np.full(len(home), np.inf))], names=_ASKED)

    return asked.select("_g", "_qx", "_qy").mapInArrow(homes, _ASKED_TYPE)


def _with_others(near: DataFrame, boxes: dict[str, Tree]) -> DataFrame:
    """Query points with the other tiles whose box is not farther than the target found."""
    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, d2, home = (np.asarray(batch[c]) for c in ("_qx", "_qy", "_d2", "_tile"))
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for rows, tree in _of_groups(batch, boxes):
                row, tile, _ = _within(tree, x[rows], y[rows], d2[rows])
                away = tile != home[rows][row]
                found.append((rows[row[away]], tile[away]))
            row, tile = (np.concatenate(part) for part in zip(*found))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tile[np.argsort(row, kind="stable")]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "_others"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in near.schema)
    return near.mapInArrow(others, f"{kinds}, _others array<bigint>")


_ASKED = ["_g", "_qx", "_qy", "_tile", "_limit"]
_ASKED_TYPE = "_g string, _qx double, _qy double, _tile bigint, _limit double"


def _of_groups(batch: pa.RecordBatch, boxes: dict[str, Tree]) -> Iterator[tuple[np.ndarray, Tree]]:
    """Rows of a batch by slices of one group, with the tree of its tiles; groups of one tile are left out."""
    names = batch["_g"].dictionary_encode()
    codes = np.asarray(names.indices)
    for code, name in enumerate(names.dictionary.to_pylist()):
        if name in boxes:
            rows = np.flatnonzero(codes == code)
            for at in range(0, len(rows), SLICE):
                yield rows[at:at + SLICE], boxes[name]


def _met(asked: DataFrame, goal: DataFrame) -> DataFrame:
    """Points, each once, with the target of the asked tile that is nearest, and not beyond the limit; of those that tie, the smallest id."""
    node, keys = NODE, ["_key", "_g", "_tile", "_chunk"]
    hot = settle(asked.groupBy("_g", "_tile").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("_k")).where("_k > 1"))
    chunks = F.coalesce("_k", F.lit(1))
    key = F.xxhash64("_g", "_tile", "_chunk").alias("_key")  # sorts by one number first
    rows = asked.count()
    parts = max(1, min(rows // TASK, max(3 * asked.sparkSession.sparkContext.defaultParallelism, rows // CHUNK)))
    points = (asked.join(F.broadcast(hot), ["_g", "_tile"], "left")
              .withColumn("_chunk", F.pmod(F.xxhash64("_qx", "_qy"), chunks).cast("int")).select(key, "_chunk", *_ASKED))
    tiles = (goal.join(F.broadcast(hot), ["_g", "_tile"], "left")
             .withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
             .select(key, "_chunk", "_g", "_tile", "_tx", "_ty", "_tid", "_rank"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(pa.array(_once(left["_qx"], left["_qy"])))
        order = _side_by_side(right["_tx"].to_numpy(), right["_ty"].to_numpy(), node)
        tx, ty, rank = (right[c].to_numpy()[order] for c in ("_tx", "_ty", "_rank"))
        x, y, limit = (left[c].to_numpy() for c in ("_qx", "_qy", "_limit"))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        tree = Tree(np.stack([tx, tx, ty, ty]), node) if len(tx) else None
        for at in range(0, len(x) if tree else 0, SLICE):
            some = slice(at, at + SLICE)
            row, item, d2 = _closest_in(tree, x[some], y[some], limit[some])
            least = rank[item] == _per_row(np.minimum, row, rank[item])
            found.append((row[least] + at, item[least], d2[least]))
        row, item, d2 = (np.concatenate(part) for part in zip(*found))
        asked_rows = left.select(["_g", "_qx", "_qy", "_tile"]).take(pa.array(row))
        return asked_rows.append_column("_d2", pa.array(d2)).append_column("_tid", right["_tid"].take(pa.array(order[item])))

    out = f"_g string, _qx double, _qy double, _tile bigint, _d2 double, _tid {goal.schema['_tid'].dataType.simpleString()}"
    points, tiles = (side.repartition(parts, *keys).groupBy(*keys) for side in (points, tiles))
    return points.cogroup(tiles).applyInArrow(meet, out)


def _once(*columns: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Where each combination of numbers stands first, in their order."""
    columns = [np.asarray(c) for c in columns]
    order = np.lexsort(columns[::-1])
    if not len(order):
        return order
    return order[np.concatenate([[True], np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])])]


def _side_by_side(x: np.ndarray, y: np.ndarray, node: int) -> np.ndarray:
    """Order of points by slabs along x, and along y in each: every `node` of them lie close."""
    slab = np.empty(len(x), np.int64)
    slab[np.lexsort((y, x))] = np.arange(len(x)) // (math.ceil(math.sqrt(len(x) / node)) * node or 1)
    return np.lexsort((x, y, slab))


class Tree:
    """Boxes (least and most x, least and most y) in order, and levels of boxes around `node` of them each.

    A level has rows of `node` boxes, the last one filled up with boxes that are infinitely far.
    """

    def __init__(self, boxes: np.ndarray, node: int) -> None:
        self.node, self.levels, self.counts = node, [], []
        while True:
            self.counts.append(boxes.shape[1])
            fill = ((0, 0), (0, -boxes.shape[1] % node))
            self.levels.append(np.pad(boxes, fill, constant_values=np.inf).reshape(4, -1, node))
            if boxes.shape[1] <= node:
                break
            rows = np.pad(boxes, fill, mode="edge").reshape(4, -1, node)
            boxes = np.stack([f(b, axis=1) for f, b in zip((np.min, np.max) * 2, rows)])

    def down(self) -> Iterator[tuple[np.ndarray, int]]:
        """Levels and their numbers of boxes, from the top."""
        return zip(reversed(self.levels), reversed(self.counts))


def _least(boxes: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance from points to the boxes of a row each; to a point, the distance as it is."""
    x, y = x[:, None], y[:, None]
    dx = np.maximum(np.maximum(boxes[0][at] - x, x - boxes[1][at]), 0.0)
    dy = np.maximum(np.maximum(boxes[2][at] - y, y - boxes[3][at]), 0.0)
    return dx * dx + dy * dy


def _starts(row: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.diff(row, prepend=-1))


def _per_row(f: np.ufunc, row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """At each value, what `f` makes of all values of its row; rows ascend."""
    starts = _starts(row)
    return np.repeat(f.reduceat(values, starts), np.diff(starts, append=len(row))) if len(row) else values


def _first(tree: Tree, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of each point to one box of the bottom, by the nearest box of each level: near, not always nearest."""
    at = np.zeros(len(x), np.int64)
    for boxes, count in tree.down():
        d2 = _least(boxes, at, x, y)
        best = np.minimum(np.argmin(d2, axis=1), count - 1 - at * tree.node)
        at = at * tree.node + best
    return d2[np.arange(len(x)), best]


def _within(tree: Tree, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """All pairs of a point and a box of the bottom not beyond the point's limit, with the squared distance; points ascend."""
    row, at, d2 = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
    for boxes, count in tree.down():
        d2 = _least(boxes, at, x[row], y[row])
        some, box = np.nonzero(d2 <= limit[row][:, None])
        row, at, d2 = row[some], at[some] * tree.node + box, d2[some, box]
        if np.isinf(d2).any():  # not the boxes that fill up a row
            row, at, d2 = (v[at < count] for v in (row, at, d2))
    return row, at, d2


def _closest_in(tree: Tree, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs of each point and the items nearest to it, ties included, not beyond the limit; points ascend."""
    row, at, d2 = _within(tree, x, y, np.minimum(limit, _first(tree, x, y)))
    tied = d2 == _per_row(np.minimum, row, d2)
    return row[tied], at[tied], d2[tied]


def _closest(qx: Column, qy: Column) -> Column:
    """(d2, id) of the candidate closest to the row's point; null without either."""
    return F.when(qx.isNotNull() & qy.isNotNull(), F.array_min(F.transform("_cand", lambda t: F.struct(
        ((qx - t["x"]) * (qx - t["x"]) + (qy - t["y"]) * (qy - t["y"])).alias("d2"), t["id"].alias("id")))))


def snap_to_existing(new: DataFrame, base: DataFrame, group: Sequence[str], lat: str, lon: str,
                     key: str, limit_m: float, taken: str | None = None) -> DataFrame:
    """New points within `limit_m` of an existing point of their group take its coordinate.

    `taken` names a column set to true where the point moved.
    """
    from meshtally.functions.geo import local_metres
    known = base.where(F.col(lat).isNotNull())
    centre = known.groupBy(*group).agg(F.avg(lat).alias("_mean"))
    tx, ty = local_metres(F.col(lat), F.col(lon), F.col("_mean"))
    # One target per spot, named by its own coordinates.
    spots = (known.join(centre, list(group)).select(
        *group, tx.alias("_bx"), ty.alias("_by"),
        F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")).alias("_spot")).distinct())
    rows = (new.join(centre, list(group), "left")
            .withColumn("_nx", tx).withColumn("_ny", ty))
    near = nearest_in_group(rows, spots, group, ("_nx", "_ny"), ("_bx", "_by"), "_spot", "_d")
    moved = F.coalesce(F.col("_d") <= limit_m, F.lit(False))
    out = (near.withColumn(lat, F.when(moved, F.col("_spot.lat")).otherwise(F.col(lat)))
           .withColumn(lon, F.when(moved, F.col("_spot.lon")).otherwise(F.col(lon))))
    if taken:
        out = out.withColumn(taken, moved)
    return out.drop("_mean", "_nx", "_ny", "_spot", "_d")
