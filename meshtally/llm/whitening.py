"""Embedding whitening by a bidiagonal qd solver.

Vectors become whole numbers; the distinct ones are the fit list. Each task reduces its
centred rows blockwise to a triangle R by QR, and a tree of QRs joins the triangles, so no
task holds more than a few of them and the products of columns are never formed. One
task for each vector width then works on R alone: Householder reflections make it
bidiagonal, differential qd steps with shifts find all squared singular values to high
relative accuracy, and twisted factorisations give the leading directions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import stored

BLOCK = 32 << 20  # bytes of centred rows that one QR takes
HELD = 256 << 20  # bytes of triangles that a task keeps
FAN = 32 << 20  # bytes of triangles that one step of the tree joins, two at least
TINY = 1e-31  # a qd off-diagonal below this share of its neighbour is nothing
FAINT = 1e-11  # singular values below this share of the whole have no certain direction
MASK = (1 << 32) - 1


# --- the solver, on one triangle -------------------------------------------------------

def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v and the value left when x is reflected along v onto its first entry."""
    size = float(np.linalg.norm(x))
    if size == 0.0 or not len(x[1:]) or not x[1:].any():
        return np.zeros_like(x), float(x[0])
    left = -math.copysign(size, x[0])
    v = x.copy()
    v[0] -= left
    return v / np.linalg.norm(v), left


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and right reflectors of a matrix with as many columns as rows or more."""
    w = r.shape[1]
    a = np.zeros((w, w))
    a[:len(r)] = r
    right = []
    for k in range(w):
        v, a[k, k] = reflector(a[k:, k].copy())
        a[k + 1:, k] = 0
        a[k:, k + 1:] -= 2 * np.outer(v, v @ a[k:, k + 1:])
        if k + 1 < w:
            v, first = reflector(a[k, k + 1:].copy())
            a[k, k + 1] = first
            a[k, k + 2:] = 0
            a[k + 1:, k + 1:] -= 2 * np.outer(a[k + 1:, k + 1:] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int, float]:
    """One differential qd step with shift; place and value of the first negative d, or len(q)."""
    out_q, out_e, d = [], [], q[0] - shift
    for i, (low, nxt) in enumerate(zip(e, q[1:])):
        if d < 0:
            return out_q, out_e, i, d
        whole = d + low
        if whole == 0.0:
            whole = 1e-300
        part = nxt / whole
        out_q.append(whole)
        out_e.append(low * part)
        d = d * part - shift
    out_q.append(d)
    return out_q, out_e, len(q) if d >= 0 else len(q) - 1, d


def pair_values(q: float, e: float, p: float) -> tuple[float, float]:
    """Both eigenvalues of a qd array of two, the larger first."""
    large = (q + p + e + math.hypot(q - p + e, 2 * math.sqrt(p * e))) / 2
    return large, (q / large * p if large else 0.0)


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squared singular values of a bidiagonal matrix, descending, by dqds with deflation and splitting."""
    found: list[float] = []
    scale = max([0.0, *np.abs(a), *np.abs(b)])
    if scale == 0.0:
        return [0.0] * len(a)
    blocks = [([float(x / scale) ** 2 for x in a], [float(x / scale) ** 2 for x in b], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        if len(q) == 1:
            found.append(moved + q[0])
            continue
        if len(q) == 2:
            found += (moved + v for v in pair_values(q[0], e[0], q[1]))
            continue
        cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= TINY * (moved + min(q[i], q[i + 1]))
                    or e[i] <= TINY * TINY), None)
        if cut is not None:
            blocks += ((q[:cut + 1], e[:cut], moved), (q[cut + 1:], e[cut + 1:], moved))
            continue
        if 1.5 * q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        # The trailing pair bounds the least value from above; a d that turns negative only at
        # the end says by how much, and any failure falls back to smaller shifts and to none.
        shift = pair_values(q[-2], e[-1], q[-1])[1]
        for fall in (1.0, 1.0, 0.25, 0.0625, 0.0):
            tried = max(0.0, shift * fall)
            new_q, new_e, at, d = qd_step(q, e, tried)
            if at == len(q):
                blocks.append((new_q, new_e, moved + tried))
                break
            if at == len(q) - 1 and fall == 1.0:
                shift = max(0.0, (tried + d) * (1 - 1e-15))
    return sorted((v * scale * scale for v in found), reverse=True)


def twisted_vectors(a: np.ndarray, b: np.ndarray, value: float) -> Iterator[np.ndarray]:
    """Unit vectors of B'B near a value, from the twists with the least pivots first."""
    n, q, e = len(a), a * a, b * b
    least = np.finfo(float).eps * max(value, q.max(), e.max(initial=0.0)) * 1e-3 or 1e-300

    def safe(x: float) -> float:
        return x if abs(x) > least else math.copysign(least, x)

    down, up = np.empty(n), np.empty(n)  # s of the stationary, p of the progressive transform
    low, high = np.empty(n - 1), np.empty(n - 1)
    s = -value
    for i in range(n - 1):
        down[i] = s
        d = safe(s + q[i])
        low[i] = a[i] * b[i] / d
        s = e[i] / d * s - value
    down[n - 1] = s
    p = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = p
        d = safe(e[i] + p)
        high[i] = a[i] * b[i] / d
        p = p * (q[i] / d) - value
    up[0] = p
    for twist in np.argsort(np.abs(down + up + value), kind="stable"):
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -low[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -high[i] * z[i]
        size = np.linalg.norm(z)
        if np.isfinite(size):
            yield z / size


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to `most` leading eigenvalues of R'R and unit eigenvectors as columns, largest entry positive."""
    a, b, right = bidiagonal(r)
    values = squared_singular_values(a, b)
    whole = float((r * r).sum())
    take = [v for v in values if v > FAINT * FAINT * whole]
    count = min(most, len(take))
    # Values close to the last wanted one belong to its cluster.
    wide = count
    while 0 < wide < len(take) and wide < 2 * most + 4 and take[wide] > take[count - 1] * (1 - 1e-6):
        wide += 1
    basis: list[np.ndarray] = []
    for value in take[:wide]:
        best, length = None, 0.0
        for z in twisted_vectors(a, b, value):
            for _ in range(2):
                for y in basis:
                    z = z - (y @ z) * y
                rest = float(np.linalg.norm(z))
                if rest < 1e-8:
                    break
                z = z / rest
            if rest > length:
                best, length = z, rest
            if rest > 0.5:
                break
        if best is not None:
            basis.append(best)
    if not basis:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    y = np.array(basis).T
    image = a[:, None] * y
    image[:-1] += b[:, None] * y[1:]  # B y
    _, turn = np.linalg.eigh(image.T @ image)  # at most a dozen columns: turns vectors of close values apart
    y = y @ turn[:, ::-1]
    for k in range(len(right) - 1, -1, -1):
        y[k + 1:] -= 2 * np.outer(right[k], right[k] @ y[k + 1:])
    y = y[:, :count]
    y *= np.sign(y[np.argmax(np.abs(y), axis=0), np.arange(y.shape[1])])
    return np.array(take[:y.shape[1]]), y


# --- the jobs --------------------------------------------------------------------------

def whole_numbers(vector: Column) -> Column:
    """floor(256 c) of each entry; null if the vector or an entry is null or not finite."""
    usable = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * 256)))


def by_width(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """width, row numbers and the rows' matrix, for each width of a batch."""
    widths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        part = lists if len(at) == len(widths) else lists.take(pa.array(at))
        yield w, at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), w)


def partial_sums(points: DataFrame) -> DataFrame:
    """width, n and the sums of both halves of the entries, one row for each task and width."""
    names = ["width", "n", "high", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for w, at, x in by_width(batch.column(0)):
                own = sums.setdefault(w, [0, np.zeros(w, np.int64), np.zeros(w, np.int64)])
                own[0] += len(at)
                own[1] += (x >> 32).sum(axis=0)
                own[2] += (x & MASK).sum(axis=0)
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int64()), pa.array([s[0] for s in sums.values()], pa.int64()),
            pa.array([s[1] for s in sums.values()], lists), pa.array([s[2] for s in sums.values()], lists)], names)

    return points.select("x").mapInArrow(run, "width bigint, n bigint, high array<bigint>, low array<bigint>")


def centres(points: DataFrame) -> DataFrame:
    """width, n, and the sum of each dimension as high * 2**32 + low, 0 <= low < 2**32."""
    parts = stored(partial_sums(points))
    each = parts.select("width", F.posexplode(F.arrays_zip("high", "low")).alias("dim", "s"))
    each = each.groupBy("width", "dim").agg(F.sum("s.high").alias("high"), F.sum("s.low").alias("low"))
    each = each.select("width", "dim", (F.col("high") + F.shiftright("low", 32)).alias("high"), F.col("low").bitwiseAND(F.lit(MASK)).alias("low"))
    sums = each.groupBy("width").agg(F.array_sort(F.collect_list(F.struct("dim", "high", "low"))).alias("s"))  # as many as dimensions
    return parts.groupBy("width").agg(F.sum("n").alias("n")).join(sums, "width").select(
        "width", "n", F.col("s.high").alias("high"), F.col("s.low").alias("low"))


def scaled_deviations(x: np.ndarray, n: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """n * x - sum, exact: whole numbers of 64 bits, or Python's where those don't suffice."""
    most = int(np.abs(high).max(initial=0)) + 1
    if most < 1 << 30 and n * int(np.abs(x.astype(float)).max(initial=0)) < 1 << 61:
        return n * x - ((high << 32) + low)
    return n * x.astype(object) - (high.astype(object) * (1 << 32) + low.astype(object))


def squares(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares by row; null beyond 64 bits."""
    if d.dtype != object and (np.square(d.astype(float)).sum(axis=1) < 2.0 ** 62).all():
        return np.square(d).sum(axis=1).tolist()
    return [s if (s := sum(v * v for v in row)) < 1 << 63 else None for row in d.tolist()]


TRIANGLE = "width bigint, part bigint, rows bigint, r binary"


def triangles(points: DataFrame) -> DataFrame:
    """QR triangles of the centred rows of each task, by width. points: x, n, high, low."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        part = TaskContext.get().partitionId() << 32

        def reduced(w: int) -> np.ndarray:
            held[w] = [np.linalg.qr(np.concatenate(held[w]), mode="r")]
            return held[w][0]

        def given() -> Iterator[pa.RecordBatch]:
            nonlocal part
            for w in list(held):
                r = reduced(w)
                part += 1
                yield pa.RecordBatch.from_pydict({"width": [w], "part": [part], "rows": [len(r)], "r": [r.tobytes()]})
            held.clear()

        for batch in batches:
            for w, at, x in by_width(batch.column("x")):
                if w:
                    first = {c: batch.column(c)[int(at[0])] for c in ("n", "high", "low")}
                    d = scaled_deviations(x, first["n"].as_py(), *(np.array(first[c].as_py(), np.int64) for c in ("high", "low")))
                    held.setdefault(w, []).append((d / first["n"].as_py()).astype(float))
                    if sum(m.nbytes for m in held[w]) > max(BLOCK, 16 * w * w):
                        reduced(w)
            if sum(m.nbytes for own in held.values() for m in own) > HELD:
                yield from given()
        yield from given()

    return points.select("x", "n", "high", "low").mapInArrow(run, TRIANGLE)


def joined(parts: DataFrame) -> DataFrame:
    """One triangle for each width: a tree of QRs, its fan bounded by bytes."""
    def run(group: pa.Table) -> pa.Table:
        w = group.column("width")[0].as_py()
        r = np.concatenate([np.frombuffer(r, float).reshape(n, w) for n, r in
                            zip(*(group.column(c).to_pylist() for c in ("rows", "r")))])
        r = np.linalg.qr(r, mode="r")
        return pa.table({"width": [w], "part": [group.column("part")[0].as_py()], "rows": [len(r)], "r": [r.tobytes()]})

    parts = stored(parts)
    fan = F.greatest(F.lit(2), F.least(F.lit(64), F.floor(F.lit(FAN) / (8 * F.col("width") * F.col("width")))))
    while True:
        counts = parts.groupBy("width").agg(F.count("*").alias("of"))
        if (counts.agg(F.max("of")).first()[0] or 0) <= 1:
            return parts
        dealt = parts.join(counts, "width").withColumn("bucket", F.pmod(F.xxhash64("part"), F.ceil(F.col("of") / fan)))
        parts = stored(dealt.select("width", "part", "rows", "r", "bucket").groupBy("width", "bucket").applyInArrow(run, TRIANGLE))


def solved(parts: DataFrame, components: int) -> DataFrame:
    """width, and the value, share and direction of up to `components` components, from one triangle."""
    names = ["width", "values", "shares", "directions"]

    def run(group: pa.Table) -> pa.Table:
        w, n, rows = (group.column(c)[0].as_py() for c in ("width", "n", "rows"))
        r = np.frombuffer(group.column("r")[0].as_py(), float).reshape(rows, w)
        values, y = leading(r, components)
        whole = float((r * r).sum())
        flat = pa.list_(pa.float64())
        return pa.table([pa.array([w], pa.int64()), pa.array([(values / n).tolist()], flat),
                         pa.array([(values / whole).tolist() if len(values) else []], flat), pa.array([y.T.ravel().tolist()], flat)], names)

    return parts.groupBy("width").applyInArrow(
        run, "width bigint, values array<double>, shares array<double>, directions array<double>")


MEASURED = "struct<deviation:bigint,whitened:array<double>>"


def measured(*columns: str) -> Column:
    """Exact deviation and whitened coordinates of x, from n, high, low, values and directions of its width."""
    @F.arrow_udf(MEASURED)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])
        for x, n, high, low, values, directions in batches:
            out: list[dict] = [{}] * len(x)
            for w, at, rows in by_width(x):
                k = int(at[0])
                count = n[k].as_py()
                d = scaled_deviations(rows, count, *(np.array(c[k].as_py(), np.int64) for c in (high, low)))
                e = np.array(values[k].as_py(), float)
                y = np.array(directions[k].as_py(), float).reshape(len(e), w)
                whitened = (d / count).astype(float) @ y.T / np.sqrt(e)
                for i, s, t in zip(at.tolist(), squares(d), whitened.tolist()):
                    out[i] = {"deviation": s, "whitened": t}
            yield pa.array(out, kind)

    return run(*columns)


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each usable vector and component.

    Null vectors and those with null or non-finite entries are left out. Entries are taken
    as floor(256 c). Each width is fitted by itself, on its distinct vectors: repeated rows
    weigh nothing, but each has its rows. A width has at most as many components as its
    vectors vary in (none for a single vector); directions of less than 1e-11 of the whole
    spread are left out. Components of equal values are any orthogonal directions of their
    space. deviation is null beyond 64 bits. One task holds a width * width matrix. An
    empty table gives no row; other columns are not read.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), whole_numbers(F.col(f"`{vector}`")).alias("x"))
    rows = stored(rows.where("x IS NOT NULL").withColumn("width", F.size("x").cast("bigint")))
    points = stored(rows.select("x", "width").distinct())
    centre = stored(centres(points))
    fitted = solved(joined(triangles(points.join(centre, "width"))).join(centre.select("width", "n"), "width"), components)
    model = stored(fitted.join(centre, "width"))

    def seen(of: DataFrame) -> DataFrame:
        parts = ("n", "high", "low", "values", "directions")
        return of.join(model, "width").withColumn("m", measured("x", *parts))

    held = seen(points)
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    errors = held.groupBy("width").agg(*(
        F.covar_pop(F.get("m.whitened", F.lit(i)), F.get("m.whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs))
    error = F.array_max(F.array(*(F.abs(F.col(f"c{i}_{j}") - int(i == j)) for i, j in pairs)))
    errors = stored(errors.select("width", error.alias("identity_error")))
    each = seen(rows).join(errors, "width").select(
        "vec_id", "n", "m.deviation", "identity_error", F.posexplode(F.arrays_zip("m.whitened", "shares")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.shares").alias("explained"), "identity_error")
