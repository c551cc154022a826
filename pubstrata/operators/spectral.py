"""Spectral initialisation: leading eigenvectors of a normalised neighbour graph.

The operator is A = (I + D^-1/2 W D^-1/2) / 2, whose spectrum lies in [0, 1]; sqrt(degree) is its
eigenvector to 1 and is projected out. Subspace iteration with a Chebyshev filter: a round applies a
polynomial of A that stays within [-1, 1] on the unwanted part of the spectrum and grows beyond it, so that
``degree`` sparse products separate the wanted vectors as far as some hundred plain ones. The polynomial is taken factor by factor, its
zeros in Leja order (stable, and no product needs the one before the last), so the state is one block of columns.

* The points are dealt into few parts (``MIN_PARTS``, more beyond ``PART_ROWS`` points each). A part keeps its edges as packed
  arrays, cached where its task runs; a product moves the state only: a part's own rows, and to every other
  part one packed message with the rows that its edges reach. So what a product shuffles grows with the points, not with the
  edges, and a round's products are one Spark job.
* The columns of the state do not meet inside a round, so groups of them (``GROUPS``) are tasks of their own on each part.
* The products of a large graph are in single precision as long as that brings the residual down, then in double precision. The last product
  of a round, the Rayleigh-Ritz step and the residual that ends the rounds are in double precision always.
* Orthonormalisation is a tall-skinny QR: every task reduces its rows to one triangle, groups of ``FAN`` triangles are
  stacked and reduced again until few are left. The same pass sums the small Gram matrices for the Rayleigh-Ritz step.
* Only p x p matrices reach the driver (p = 2 dim), two jobs a round; the residual of the wanted vectors
  ends the rounds.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubstrata.deploy import ship_package
from pubstrata.session import cut_lineage, free

#: triangles reduced by one task of the QR tree
FAN = 64
#: a round's polynomial is to grow by e to this from the unwanted part to the last wanted value
SEPARATION = 5.0
#: parts of the points at least, points of a part beyond which there are more parts
MIN_PARTS, PART_ROWS = 2, 1 << 19
#: groups of columns at most, points for each of them; beyond one group the products begin in single precision
GROUPS, GROUP_ROWS = 4, 1 << 15
#: edges of a part multiplied at a time (and one row's): their rows stay in the processor's cache
EDGES = 1 << 12


def _rows(col: pd.Series) -> np.ndarray:
    return np.vstack(col.to_numpy())


def _partial_qr(batches):
    """One row per task: triangle of [d, y] and the sums y'ay, ay'ay."""
    from pyspark import TaskContext

    r = g = h = None
    for pdf in batches:
        if pdf.empty:
            continue
        y, ay = _rows(pdf["y"]), _rows(pdf["ay"])
        block = np.column_stack([pdf["d"].to_numpy(), y])
        r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
        g = y.T @ ay if g is None else g + y.T @ ay
        h = ay.T @ ay if h is None else h + ay.T @ ay
    if r is not None:
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "r": [r.ravel()], "g": [g.ravel()], "h": [h.ravel()]})


def _merge_qr(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        r = np.linalg.qr(np.vstack([np.reshape(x, (-1, width)) for x in pdf["r"]]), mode="r")
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN], "r": [r.ravel()], "g": [np.sum(pdf["g"].tolist(), axis=0)],
                             "h": [np.sum(pdf["h"].tolist(), axis=0)]})
    return run


def tall_skinny_qr(table: DataFrame, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(R of [d, y], y'ay, ay'ay) of a table (d, y, ay) with p columns in y and ay."""
    schema = "part int, r array<double>, g array<double>, h array<double>"
    parts = table.select("d", "y", "ay").mapInPandas(_partial_qr, schema)
    left = table.rdd.getNumPartitions()
    while left > FAN:
        parts = parts.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(_merge_qr(p + 1), schema)
        left = math.ceil(left / FAN)
    got = sorted(parts.collect(), key=lambda x: x.part)
    r = np.linalg.qr(np.vstack([np.reshape(x.r, (-1, p + 1)) for x in got]), mode="r")
    return r, np.sum([x.g for x in got], axis=0).reshape(p, p), np.sum([x.h for x in got], axis=0).reshape(p, p)


_FIXED = "part int, ids binary, d binary, n binary, src binary, dst binary, m binary, send binary, send_n binary"
_STATE = "part int, src int, grp int, cur binary"
_TABLE = "part int, id long, d double, y array<double>, ay array<double>"


def _fixed_arrays(parts: int):
    """(edges of a part, its points and those that others want of it) -> one row: what does not change from product to product.

    ``dst`` numbers the part's own rows, then the rows that come from other parts, by part and id; ``send`` lists
    the own rows that go to each other part, by id. ``n`` are the rows that an id has in the table of points.
    """
    def run(edges: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        part = int(points["part"].iloc[0])
        own = points[points["dest"] < 0].sort_values("id")
        ids = own["id"].to_numpy(np.int64)
        wanted = points[points["dest"] >= 0].sort_values(["dest", "id"])
        send = np.searchsorted(ids, wanted["id"].to_numpy(np.int64))
        send_n = np.bincount(wanted["dest"].to_numpy(np.int64), minlength=parts)
        edges = edges.sort_values(["i", "j"])
        j, home = edges["j"].to_numpy(np.int64), edges["pj"].to_numpy(np.int64)
        dst = np.searchsorted(ids, j)
        away = home != part
        others = pd.DataFrame({"home": home[away], "j": j[away]}).drop_duplicates().sort_values(["home", "j"])["j"].to_numpy(np.int64)
        order = np.argsort(others)
        dst[away] = len(ids) + order[np.searchsorted(others[order], j[away])]
        arrays = {"ids": ids, "d": own["d"].to_numpy(np.float64), "n": own["n"].to_numpy(np.int64), "src": np.searchsorted(ids, edges["i"].to_numpy(np.int64)).astype(np.int32),
                  "dst": dst.astype(np.int32), "m": edges["m"].to_numpy(np.float64), "send": send.astype(np.int32), "send_n": send_n.astype(np.int64)}
        return pd.DataFrame({"part": [part]} | {c: [x.tobytes()] for c, x in arrays.items()})

    return run


def _messages(fixed: pd.Series, cur: np.ndarray, grp: int = 0) -> pd.DataFrame:
    """The state's rows of one part (and group of columns): its own, and the rows that other parts want."""
    part = int(fixed["part"])
    rows = [(part, part, grp, cur.tobytes())]
    ends = np.cumsum(np.frombuffer(fixed["send_n"], np.int64))
    send = np.frombuffer(fixed["send"], np.int32)
    for dest, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
        if b > a:
            rows.append((dest, part, grp, cur[send[a:b]].tobytes()))
    return pd.DataFrame(rows, columns=["part", "src", "grp", "cur"])


def _sparse_times(src: np.ndarray, dst: np.ndarray, m: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Row sums of m x[dst] by ``src`` (sorted), a bounded run of edges at a time."""
    out = np.zeros((n, x.shape[1]), dtype=x.dtype)
    if len(src) == 0:
        return out
    starts = np.flatnonzero(np.append(True, src[1:] != src[:-1]))
    rows, m = src[starts], m.astype(x.dtype, copy=False)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(src), EDGES)), len(rows)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = starts[a], starts[b] if b < len(rows) else len(src)
        far = np.take(x, dst[lo:hi], axis=0, mode="clip")
        far *= m[lo:hi, None]
        out[rows[a:b]] = np.add.reduceat(far, starts[a:b] - lo, axis=0)
    return out


def _pack(fixed: pd.DataFrame, rows: pd.DataFrame, groups: int = 1, kind=np.float64) -> pd.DataFrame:
    """(fixed arrays, rows of a part) -> the first state of a round; the rows of an id that has several add up."""
    f, rows = fixed.iloc[0], rows.sort_values("id")
    ids, starts = np.unique(rows["id"].to_numpy(np.int64), return_index=True)
    cur = np.add.reduceat(_rows(rows["cur"]), starts, axis=0)
    return pd.concat([_messages(f, np.ascontiguousarray(c, dtype=kind), g) for g, c in enumerate(np.array_split(cur, groups, axis=1))])


def _first(groups: int, kind):
    return lambda fixed, rows: _pack(fixed, rows, groups, kind)


def _step(alpha: float, beta: float, zero: float, last: bool, kind=np.float64):
    """cur -> (alpha A + beta - zero) cur of a part; the last product of a round takes all groups of columns and returns its rows (y, A y)."""
    def run(fixed: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        f = fixed.iloc[0]
        ids, part = np.frombuffer(f["ids"], np.int64), int(f["part"])
        state = state.sort_values(["src", "grp"])
        own = state[state["src"] == part]
        width = {g: len(x) // (np.dtype(kind).itemsize * len(ids)) for g, x in zip(own["grp"], own["cur"])}
        sides = {src: np.hstack([np.frombuffer(x, kind).reshape(-1, width[g]) for g, x in zip(rows["grp"], rows["cur"])]) for src, rows in state.groupby("src")}
        cur = sides.pop(part)
        x = np.vstack([cur, *sides.values()])  # those of other parts by part
        if last:
            cur, x = cur.astype(np.float64), x.astype(np.float64)
        n = np.frombuffer(f["n"], np.int64)  # every row of an id has a loop
        ax = _sparse_times(np.frombuffer(f["src"], np.int32), np.frombuffer(f["dst"], np.int32), np.frombuffer(f["m"]), x, len(ids))
        new = alpha * ax + n.astype(cur.dtype)[:, None] * ((0.5 * alpha + beta - zero) * cur)
        if last:
            each = np.repeat(np.arange(len(ids)), n)
            return pd.DataFrame({"part": part, "id": ids[each], "d": np.frombuffer(f["d"])[each], "y": list(cur[each]), "ay": list(new[each])})
        return _messages(f, new.astype(kind, copy=False), int(own["grp"].iloc[0]))

    return run


def _product(fixed: DataFrame, state: DataFrame, by: str, slots: int, alpha: float, beta: float, zero: float, kind, last: bool = False) -> DataFrame:
    """One factor of the polynomial on the packed state; ``by``: a part, or a slot of a part and a group of columns."""
    return fixed.groupBy(by).cogroup(state.repartitionById(slots, F.col(by)).groupBy(by)).applyInPandas(
        _step(alpha, beta, zero, last, kind), _TABLE if last else _STATE)


def _rotated(table: DataFrame, m: np.ndarray, out: str) -> DataFrame:
    """[d, y] @ m per row."""
    @F.pandas_udf("array<double>")
    def mul(d: pd.Series, y: pd.Series) -> pd.Series:
        if len(y) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.column_stack([d.to_numpy(), _rows(y)]) @ m))

    return table.withColumn(out, mul("d", "y"))


def _next_filter(wanted: float, last: float, degree: int) -> tuple[int, float]:
    """(products, end of the unwanted part) for the last wanted value and the block's last value.

    The polynomial is to grow by e to ``SEPARATION`` between them, within 2 ``degree`` products. Where the block's
    values are so close together that it cannot (a graph of many parts repeats the value 1), the end moves down.
    """
    mu, most = min(max(last, 0.05), 0.9999), 2 * degree
    apart = math.acosh(max(2.0 * wanted / mu - 1.0, 1.0))
    if apart * most < 1.5:
        return most, max(2.0 * wanted / (1.0 + math.cosh(SEPARATION / most)), 0.05)
    return min(max(degree, math.ceil(SEPARATION / apart)), most), mu


def filter_zeros(degree: int) -> np.ndarray:
    """Zeros of the Chebyshev polynomial of ``degree``, each as far as possible (by the product of distances) from those before it."""
    left = list(np.cos((2.0 * np.arange(degree) + 1.0) * math.pi / (2.0 * degree)))
    taken = [left.pop(0)]
    while left:
        taken.append(left.pop(int(np.argmax([np.log(np.abs(x - np.array(taken))).sum() for x in left]))))
    return np.array(taken)


def spectral_init(graph: DataFrame, ids: DataFrame, dim: int = 16, iters: int = 30, seed: int = 42, degree: int = 12,
                  tol: float = 1e-6, stats: list | None = None) -> DataFrame:
    """(id, y array<double>[dim]): leading non-trivial eigenvectors of the graph (i, j, w), largest coordinate 10.

    At most ``iters`` rounds of ``degree`` to 2 ``degree`` products; they end when every wanted vector's residual
    |A x - theta x| is at most ``tol``. ``stats`` (optional list) receives the largest residual of each round. Points without edges
    have eigenvalue 1/2 and coordinates near 0.
    """
    spark = graph.sparkSession
    ship_package(spark)
    ids = ids.select(F.col("id").cast("long").alias("id")).where("id IS NOT NULL")
    deg = cut_lineage(graph.groupBy(F.col("i").alias("id")).agg(F.sum("w").alias("deg")), "degree")
    once = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    d = cut_lineage(once.join(deg, "id", "left").select("id", "n", F.sqrt(F.coalesce("deg", F.lit(0.0))).alias("d")), "degree")
    n = d.count()
    parts = max(MIN_PARTS, math.ceil(n / PART_ROWS))
    d = d.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    e = graph.join(d.select(F.col("id").alias("i"), F.col("d").alias("di"), F.col("n").alias("ni"), F.col("part").alias("pi")), "i").join(
        d.select(F.col("id").alias("j"), F.col("d").alias("dj"), F.col("n").alias("nj"), F.col("part").alias("pj")), "j")
    e = cut_lineage(e.select(F.col("pi").alias("part"), F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "pj",
                             (0.5 * F.col("w") / (F.col("di") * F.col("dj")) * F.col("ni") * F.col("nj")).alias("m")), "spectral_edges")
    wanted = e.where("part <> pj").select(F.col("pj").alias("part"), F.col("part").alias("dest"), F.col("j").alias("id"), F.lit(0.0).alias("d"), F.lit(0).cast("long").alias("n")).distinct()
    points = d.select("part", F.lit(-1).alias("dest"), "id", "d", "n").unionByName(wanted)

    def dealt(rows: DataFrame):
        return rows.repartitionById(parts, F.col("part"))

    groups = max(1, min(GROUPS, math.ceil(n / GROUP_ROWS)))
    slot = (F.col("part") * groups + F.col("grp")).cast("int")
    fixed = cut_lineage(dealt(e).groupBy("part").cogroup(dealt(points).groupBy("part")).applyInPandas(_fixed_arrays(parts), _FIXED), "spectral_fixed")
    copies = fixed.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("slot", slot)
    fixed, copies = dealt(fixed).persist(StorageLevel.DISK_ONLY), copies.repartitionById(parts * groups, F.col("slot")).persist(StorageLevel.DISK_ONLY)
    table = None
    try:
        fixed.count(), copies.count()  # so that every product finds them dealt out already
        p = 2 * dim
        start = [(F.xxhash64(F.lit(seed), F.lit(c), F.col("id")).cast("double") / float(2**63)).alias(f"c{c}") for c in range(p)]
        y = d.select("part", "id", F.explode(F.array_repeat(F.array(*start), F.col("n").cast("int"))).alias("cur"))
        steps, mu = degree, 0.5  # the unwanted part of the spectrum is [0, mu]; a random graph's bulk lies around one half
        kind, before = np.float32 if n > GROUP_ROWS else np.float64, math.inf
        for _ in range(max(1, iters)):
            if kind is np.float32:
                y = y.withColumn("cur", F.col("cur").cast("array<float>"))
            state = fixed.groupBy("part").cogroup(dealt(y).groupBy("part")).applyInPandas(_first(groups, kind), _STATE)
            for zero in filter_zeros(steps):
                state = _product(copies, state.withColumn("slot", slot), "slot", parts * groups, 4.0 / mu, -2.0, 2.0 * zero, kind)
            # A y beside y, for the Rayleigh-Ritz step
            old, table = table, cut_lineage(_product(fixed, state, "part", parts, 1.0, 0.0, 0.0, kind, last=True), "spectral")
            free(old)
            r, g1, g2 = tall_skinny_qr(table, p)
            # the first column of [d, y] takes the trivial vector out of y: y - d c, triangle r1
            c, r1, dd = r[0, 1:] / r[0, 0] if r[0, 0] else np.zeros(p), r[1:, 1:], r[0, 0] ** 2
            inv = np.linalg.pinv(r1, rcond=1e-13)
            h = inv.T @ (g1 - dd * np.outer(c, c)) @ inv
            theta, v = np.linalg.eigh((h + h.T) / 2.0)
            theta, v = theta[::-1], v[:, ::-1]
            m = inv @ v
            square = np.einsum("ij,ik,kj->j", m, g2 - dd * np.outer(c, c), m)
            residual = float(np.sqrt(np.maximum(square - theta**2, 0.0))[:dim].max())
            if stats is not None:
                stats.append(residual)
            rotate = np.vstack([-(c @ m), m])
            if residual <= tol:
                break
            if not residual < before / 2.0:
                kind = np.float64  # single precision brings it no further
            before = residual
            steps, mu = _next_filter(float(theta[dim - 1]), float(theta[-1]), degree)
            y = _rotated(table, rotate, "cur").select("part", "id", "cur")
        out = cut_lineage(_rotated(table, rotate[:, :dim], "e").select("id", "e"), "spectral")
    finally:
        fixed.unpersist()
        copies.unpersist()
        free(table)
    # scale like the original initialisation: largest coordinate 10
    mx = out.select(F.array_max(F.transform("e", F.abs)).alias("x")).agg(F.max("x")).first()[0]
    return out.select("id", F.transform("e", lambda x: x * (10.0 / max(mx or 0.0, 1e-12))).alias("y"))
