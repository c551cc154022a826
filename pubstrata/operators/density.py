"""Density clustering (HDBSCAN*) as distributed table jobs.

Steps (Campello, Moulavi, Sander 2013; McInnes, Healy 2017):

1. core distance of every point from the exact kNN (``neighbors.knn``);
2. minimum spanning tree of the mutual-reachability graph
   mr(a, b) = max(core(a), core(b), d(a, b)) by Boruvka rounds. Each round
   takes the edges it can certify from the kNN lists, then scans only the
   points that could still improve their component's best edge (query points
   x all points in groups of at most 2 * block_rows, NumPy inside), emitting
   per task only each component's best edge; one aggregation keeps the best
   per component, which hooks components together, and pointer jumping
   relabels them. Ties are broken by (weight, smaller id, larger id),
   which keeps the chosen edges a forest;
3. the cluster hierarchy from the tree edges in increasing weight, cut into
   ranges of bounded size. Ranges are split in halves level by level: the
   heavy half works on the components of the light half, so after log2(ranges)
   levels all ranges are independent and one job runs union-find over the
   component representatives of each. It emits merge events, the points that
   fall out of a cluster (per representative) and each range's shares in the
   stability sums of cluster lineages. A lineage is a condensed-tree cluster: it is
   born when two components of at least ``min_cluster_size`` merge (top-down:
   a true split) or when two small ones form a large one, absorbs small
   components (top-down: points falling out) and ends when it meets another
   large component;
4. cluster selection (excess of mass or leaf) over the lineage tree by rake
   and compress, O(log n) rounds; labels, probabilities lambda_p / lambda_max (half rounded) and the
   core flag (label != -1, frozen before any periphery attachment).

Stability of a lineage C (sizes s, merge weights w, lambda = 1 / w):
    s_form * lambda_form + sum(absorbed s * lambda) - size_end * lambda_birth
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.deploy import ship_package
from pubstrata.operators.neighbors import block_count, core_distances, knn, narrow_vector
from pubstrata.session import cut_lineage, free

I64 = np.iinfo(np.int64).max


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage: a written table in the shared folder named by spark.checkpoint.dir."""
    return cut_lineage(df, "density")


# --- minimum spanning tree (Boruvka) -------------------------------------------------------

def _best_per_row(mr: np.ndarray, ids_r: np.ndarray, ids_c: np.ndarray):
    """Row-wise lexicographic minimum of (mr, lo, hi); returns (mask, mr, other id)."""
    rowmin = mr.min(axis=1)
    ok = np.isfinite(rowmin)
    lo = np.minimum(ids_r[:, None], ids_c[None, :])
    hi = np.maximum(ids_r[:, None], ids_c[None, :])
    tie = mr == rowmin[:, None]
    lo_b = np.where(tie, lo, I64).min(axis=1)
    tie &= lo == lo_b[:, None]
    hi_b = np.where(tie, hi, I64).min(axis=1)
    other = np.where(lo_b == ids_r, hi_b, lo_b)
    return ok, rowmin, other


#: entries of a distance matrix inside a scan task
TILE_CELLS = 1 << 21


def _scan_fn():
    """(query block, data block) task: each component's best outgoing edge from its query points."""

    def run(pdf):
        q = pdf[pdf["side"] == 0]
        dd = pdf[pdf["side"] == 1]
        empty = pd.DataFrame({"comp": [], "mr": [], "lo": [], "hi": [], "ocomp": []})
        if len(q) == 0 or len(dd) == 0:
            return empty
        iq, idd = q["id"].to_numpy(np.int64), dd["id"].to_numpy(np.int64)
        cq, cd = q["comp"].to_numpy(np.int64), dd["comp"].to_numpy(np.int64)
        kq, kd = q["core"].to_numpy(), dd["core"].to_numpy()
        xq, xd = (np.vstack(s["v"].to_numpy()).astype(np.float64) for s in (q, dd))
        nq, nd = (xq * xq).sum(1), (xd * xd).sum(1)
        found = []
        step = max(1, TILE_CELLS // len(dd))
        for a in range(0, len(q), step):  # the matrices of a slice of the query points are bounded
            t = slice(a, a + step)
            sq = nq[t, None] + nd[None, :] - 2.0 * (xq[t] @ xd.T)
            d = np.sqrt(np.maximum(sq, 0.0))
            mr = np.maximum(d, np.maximum(kq[t, None], kd[None, :]))
            mr[cq[t, None] == cd[None, :]] = np.inf
            found.append(_best_per_row(mr, iq[t], idd))
        ok, m, o = (np.concatenate(x) for x in zip(*found))
        if not ok.any():
            return empty
        comp_of = dict(zip(idd.tolist(), cd.tolist()))
        rows = pd.DataFrame({
            "comp": cq[ok], "mr": m[ok], "lo": np.minimum(iq[ok], o[ok]), "hi": np.maximum(iq[ok], o[ok]),
            "ocomp": np.array([comp_of[x] for x in o[ok].tolist()], dtype=np.int64),
        }).sort_values(["comp", "mr", "lo", "hi"], kind="stable")
        return rows.drop_duplicates("comp", keep="first")

    return run


def _pointer_jump(parent: DataFrame) -> DataFrame:
    """(c, p) forest with self-loops at roots -> (c, root), by pointer jumping in O(log depth) rounds."""
    cur = _cut(parent.withColumn("moved", F.lit(True)))
    while cur.where("moved").limit(1).count() > 0:
        cur = _cut(cur.alias("a").join(cur.alias("b"), F.col("a.p") == F.col("b.c")).select(
            F.col("a.c").alias("c"), F.col("b.p").alias("p"), (F.col("b.p") != F.col("a.p")).alias("moved")
        ))
    return cur.select("c", "p")


def mutual_reachability_mst(points: DataFrame, core: DataFrame, vec_col: str = "embedding",
                            block_rows: int = 2048, min_blocks: int = 4,
                            knn_edges: DataFrame | None = None, stats: list | None = None) -> DataFrame:
    """(lo, hi, w): the exact minimum spanning tree of the mutual-reachability graph.

    ``stats`` (optional list) receives (components, scanned points) per round.

    With ``knn_edges`` (each point's k nearest others, k above the core rank)
    a round first takes every point's best edge among its listed neighbours in
    other components. Any unlisted partner r has mr >= d(p, r) >= d_k(p), so a
    listed best strictly below d_k(p) is exact ("certified"), and a point that
    is not certified can only improve its component's best edge if
    d_k(p) <= that edge's weight. Only such points enter the quadratic scan
    (query points x all points in bounded block pairs); without kNN lists all
    points do.
    """
    ship_package(points.sparkSession)
    base = points.select(F.col("id").cast("long").alias("id"), narrow_vector(points, vec_col).alias("v")).join(
        core.select("id", F.col("core_distance").alias("core")), "id"
    )
    n = base.count()  # loop-control count
    nb = block_count(n, block_rows, min_blocks)
    base = _cut(base.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int")))
    comp = _cut(base.select("id", F.col("id").alias("comp")))
    if knn_edges is not None:
        kk = knn_edges.agg(F.max("rank")).first()[0]  # list length k (loop-control scalar)
        dk = _cut(knn_edges.groupBy("id").agg(
            F.when(F.count(F.lit(1)) < kk, F.lit(float("inf"))).otherwise(F.max("distance")).alias("dk")))
        cs = base.select("id", "core")
        lists = _cut(knn_edges.select("id", "neighbor", "distance").join(cs, "id").join(
            cs.select(F.col("id").alias("neighbor"), F.col("core").alias("cn")), "neighbor").select(
            "id", "neighbor", F.greatest("distance", "core", "cn").alias("mr")))
    key = F.struct("mr", "lo", "hi", "ocomp")
    edges: list[DataFrame] = []
    n_comp = n
    while n_comp > 1:
        cur = base.join(comp, "id")
        certified = None
        if knn_edges is not None:
            # an edge inside a component stays there: it is left out from the next round on
            of = comp.distinct()
            old, lists = lists, _cut(lists.select("id", "neighbor", "mr").join(of, "id").join(
                of.select(F.col("id").alias("neighbor"), F.col("comp").alias("ocomp")), "neighbor"
            ).where(F.col("comp") != F.col("ocomp")))
            free(old)
            ke = lists.select("id", "comp", "ocomp", "mr", F.least("id", "neighbor").alias("lo"), F.greatest("id", "neighbor").alias("hi"))
            per_pt = _cut(ke.groupBy("id", "comp").agg(F.min(key).alias("e")).join(dk, "id"))
            certified = per_pt.where(F.col("e.mr") < F.col("dk")).groupBy("comp").agg(F.min("e").alias("x"))
            flags = cur.join(dk, "id").join(per_pt.select("id", (F.col("e.mr") < F.col("dk")).alias("cert")), "id", "left") \
                .join(certified.select("comp", F.col("x.mr").alias("cmr")), "comp", "left")
            need = F.coalesce(~F.col("cert"), F.lit(True)) & (F.col("cmr").isNull() | (F.col("dk") <= F.col("cmr")))
            query = flags.where(need).select("id", "v", "core", "comp")
        else:
            query = cur.select("id", "v", "core", "comp")
        nq = query.count()  # the scan runs only when some point can still improve its component
        if stats is not None:
            stats.append((n_comp, nq))
        parts = []
        if certified is not None:
            parts.append(certified.select("comp", F.col("x.mr").alias("mr"), F.col("x.lo").alias("lo"),
                                          F.col("x.hi").alias("hi"), F.col("x.ocomp").alias("ocomp")))
        if nq > 0:
            nbq = block_count(nq, block_rows, 1)
            qrows = query.select("id", "v", "core", "comp",
                                 F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(nbq)).cast("int").alias("qb"),
                                 F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("b"), F.lit(0).alias("side"))
            drows = cur.select("id", "v", "core", "comp", F.explode(F.sequence(F.lit(0), F.lit(nbq - 1))).alias("qb"),
                               "b", F.lit(1).alias("side"))
            # a pair of blocks per task: few bytes, much work
            pairs = qrows.unionByName(drows).withColumn("pair", (F.col("qb") * nb + F.col("b")).cast("int"))
            parts.append(pairs.repartitionById(nbq * nb, F.col("pair")).groupBy("pair").applyInPandas(
                _scan_fn(), "comp long, mr double, lo long, hi long, ocomp long"))
        cand = parts[0]
        for x in parts[1:]:
            cand = cand.unionByName(x)
        best_c = _cut(cand.groupBy("comp").agg(F.min(key).alias("x")).select(
            "comp", F.col("x.mr").alias("w"), F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"),
            F.col("x.ocomp").alias("ocomp"),
        ))
        edges.append(best_c.select("lo", "hi", "w").distinct())
        # hook: parent = the other component; mutual choices (2-cycles) root at the smaller id
        par = best_c.select(F.col("comp").alias("c"), F.col("ocomp").alias("p"))
        pp = par.alias("x").join(par.alias("y"), F.col("x.p") == F.col("y.c")).select(
            F.col("x.c").alias("c"),
            F.when((F.col("y.p") == F.col("x.c")) & (F.col("x.c") < F.col("x.p")), F.col("x.c"))
            .otherwise(F.col("x.p")).alias("p"),
        )
        roots = _pointer_jump(pp)
        n_comp = roots.where(F.col("c") == F.col("p")).count()
        comp = _cut(comp.join(roots.withColumnRenamed("c", "comp"), "comp").select("id", F.col("p").alias("comp")))
    if not edges:
        return base.sparkSession.createDataFrame([], "lo long, hi long, w double")
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


# --- hierarchy: weight ranges split in halves, then all ranges at once ------------------------

_CHUNK_SCHEMA = (
    "kind int, chunk int, eid long, rep long, lo long, hi long, ptr long, parent long, size long, size2 long, x double, lam double"
)
_CHUNK_COLS = [c.split()[0] for c in _CHUNK_SCHEMA.split(", ")]
K_MERGE, K_FALL, K_SHARE, K_END, K_TOP = 1, 2, 3, 4, 5


def _chunk_fn(min_cluster_size: int):
    """Union-find over one weight range.

    An edge brings its ends as they are when the range begins: representative, size and heaviest edge inside. A large
    representative's lineage is not known here; the number of its heaviest edge stands for it until the ranges are linked.
    """
    mcs = int(min_cluster_size)

    def run(pdf):
        pdf = pdf.sort_values("eid", kind="stable")
        chunk = int(pdf["chunk"].iloc[0])
        ids = {c: pdf[c].to_numpy(np.int64).tolist() for c in ("eid", "lo", "hi", "a", "b", "size_a", "size_b")}
        tops = [[None if pd.isna(t) else int(t) for t in pdf[c]] for c in ("top_a", "top_b")]
        size, lin, last, parent, members = {}, {}, {}, {}, {}
        share: dict[int, list] = {}  # lineage -> [sum of size * lambda, size, lambda at its formation]
        out = []

        def row(kind, eid=None, rep=None, lo=None, hi=None, ptr=None, up=None, n=None, n2=None, x=None, lam=None):
            out.append((kind, chunk, eid, rep, lo, hi, ptr, up, n, n2, x, lam))

        def find(x):
            root = x
            while parent[root] != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for e, lo, hi, a, b, na, nb, ta, tb, w in zip(*ids.values(), *tops, pdf["w"].to_numpy(np.float64).tolist()):
            for r, n, t in ((a, na, ta), (b, nb, tb)):
                if r not in parent:
                    parent[r], size[r], members[r], last[r] = r, n, [r], t
                    lin[r] = t if n >= mcs else None
            ra, rb = find(a), find(b)
            lam = math.inf if w <= 0 else 1.0 / w
            sa, sb = size[ra], size[rb]
            row(K_MERGE, eid=e, lo=lo, hi=hi, n=sa, n2=sb, x=w)
            big = [r for r in (ra, rb) if size[r] >= mcs]
            small = [r for r in (ra, rb) if size[r] < mcs]
            if len(big) == 1:
                now = lin[big[0]]
                old = share.setdefault(now, [0.0, 0, None])
                old[0] += size[small[0]] * lam
                old[1] = sa + sb
            elif big or sa + sb >= mcs:
                for r in big:
                    row(K_END, ptr=lin[r], up=e, n=size[r], lam=lam)
                now = e
                share[e] = [(sa + sb) * lam, sa + sb, lam]
            else:
                now = None
            if now is not None:
                for r in small:
                    for m in members[r]:
                        row(K_FALL, rep=m, ptr=now, lam=lam)
            keep, gone = (ra, rb) if len(members[ra]) >= len(members[rb]) else (rb, ra)
            # the members of a large component have fallen already
            members[keep] = [] if now is not None else members[keep] + members[gone]
            members.pop(gone)
            parent[gone] = keep
            size[keep], lin[keep], last[keep] = sa + sb, now, e
        for r in members:
            if lin[r] is not None:
                row(K_TOP, eid=last[r], ptr=lin[r])
        for ptr, (x, n, lam) in share.items():
            row(K_SHARE, ptr=ptr, n=n, x=x, lam=lam)
        df = pd.DataFrame(out, columns=_CHUNK_COLS)
        for c in ("eid", "rep", "lo", "hi", "ptr", "parent", "size", "size2"):
            # from the list of Python numbers: a detour over float64 would round those above 2^53
            df[c] = pd.array([t[_CHUNK_COLS.index(c)] for t in out], dtype="Int64")
        for c in ("x", "lam"):
            df[c] = df[c].astype("float64")
        return df.astype({"kind": "int32", "chunk": "int32"})

    return run


def _light_components(light: DataFrame) -> DataFrame:
    """(seg, v, label, size, top): the components that each segment's ``light`` edges form.

    One row per end of an edge; a component has the id of one of its vertices, the sum of their sizes and its heaviest
    edge. Every vertex hooks to the other end of its lightest edge, pointer jumping finds the roots, and the rest of
    the edges goes on between the roots: O(log n) rounds, whatever the shape of the forest.
    """
    def key(v):
        return F.struct(F.col("seg").alias("s"), F.col(v).alias("v"))

    ends = light.select("seg", F.col("a").alias("v"), F.col("size_a").alias("size")).union(light.select("seg", "b", "size_b")).distinct()
    lab = _cut(ends.withColumn("label", F.col("v")))
    cur = light.select("seg", "eid", "a", "b")
    while not cur.isEmpty():
        sides = cur.select(key("a").alias("c"), F.struct("eid", key("b").alias("o")).alias("x")).union(
            cur.select(key("b").alias("c"), F.struct("eid", key("a").alias("o")).alias("x")))
        hook = _cut(sides.groupBy("c").agg(F.min("x").alias("x")).select("c", F.col("x.o").alias("p")))
        back = hook.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        own = (F.col("pp") == F.col("c")) & (F.col("c") < F.col("p"))  # two that chose each other: the smaller is the root
        roots = _pointer_jump(hook.join(back, "p").select("c", F.when(own, F.col("c")).otherwise(F.col("p")).alias("p")))
        to = roots.select(F.col("c.s").alias("seg"), F.col("c.v").alias("v"), F.col("p.v").alias("to"))
        lab = _cut(lab.join(to.withColumnRenamed("v", "label"), ["seg", "label"], "left").select(
            "seg", "v", "size", F.coalesce("to", "label").alias("label")))
        cur = _cut(cur.join(to.select("seg", F.col("v").alias("a"), F.col("to").alias("ra")), ["seg", "a"])
                   .join(to.select("seg", F.col("v").alias("b"), F.col("to").alias("rb")), ["seg", "b"])
                   .where("ra <> rb").select("seg", "eid", F.col("ra").alias("a"), F.col("rb").alias("b")))
    whole = lab.groupBy("seg", "label").agg(F.sum("size").alias("size"))
    top = light.select("seg", "eid", F.col("a").alias("v")).join(lab.select("seg", "v", "label"), ["seg", "v"]).groupBy("seg", "label").agg(F.max("eid").alias("top"))
    return _cut(lab.drop("size").join(whole, ["seg", "label"]).join(top, ["seg", "label"]))


@dataclass
class Hierarchy:
    merges: DataFrame    # (lo, hi, w, size_a, size_b): single-linkage merges
    falls: DataFrame     # (id, lin, lam): the lineage each point leaves and its lambda
    lineages: DataFrame  # (lin, parent, size, acc, lam_form, lam_birth, stability)


def build_hierarchy(mst: DataFrame, ids: DataFrame, min_cluster_size: int, chunk_edges: int = 200_000) -> Hierarchy:
    """Single-linkage merges, point fall-outs and condensed-tree lineages from the tree edges.

    The edges are numbered by (w, lo, hi) and cut into ranges of about ``chunk_edges``. Segments of ranges are split in
    halves, all segments of a level at once: the light half keeps its ends, the heavy half gets them contracted to the
    components of the light half (``_light_components``). After log2(ranges) levels every range knows its
    ends' representatives, sizes and heaviest edges, so all ranges run union-find side by side. A point goes to the light
    half if its component reaches ``min_cluster_size`` there, else to the heavy half; it ends in the one range where it
    falls. Lineages that pass through several ranges are linked by pointer jumping. A level moves each edge and point once.
    """
    ship_package(mst.sparkSession)
    n_chunks = max(1, math.ceil(mst.count() / chunk_edges))
    levels = (n_chunks - 1).bit_length()
    e = mst.select(F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), F.col("w").cast("double").alias("w"))
    e = e.repartitionByRange(n_chunks, "w", "lo", "hi").sortWithinPartitions("w", "lo", "hi")
    one, none = F.lit(1).cast("long"), F.lit(None).cast("long")
    e = _cut(e.select("lo", "hi", "w", F.monotonically_increasing_id().alias("eid"), F.spark_partition_id().alias("chunk"), F.lit(0).alias("seg"),
                      F.col("lo").alias("a"), F.col("hi").alias("b"), one.alias("size_a"), one.alias("size_b"), none.alias("top_a"), none.alias("top_b")))
    pts = ids.select(F.col("id").cast("long").alias("id"), F.lit(0).alias("seg"), F.col("id").cast("long").alias("rep"))
    for half in [1 << k for k in reversed(range(levels))]:
        is_light = F.col("chunk") < F.col("seg") + half
        comp = _light_components(e.where(is_light))
        heavy = e.where(~is_light)
        for v in ("a", "b"):
            c = comp.select("seg", F.col("v").alias(v), F.col("label").alias("to"), F.col("size").alias("n"), F.col("top").alias("t"))
            heavy = heavy.join(c, ["seg", v], "left").withColumns({
                v: F.coalesce("to", v), f"size_{v}": F.coalesce("n", f"size_{v}"), f"top_{v}": F.coalesce("t", f"top_{v}")}).drop("to", "n", "t")
        e = _cut(e.where(is_light).unionByName(heavy.withColumn("seg", F.col("seg") + half)))
        grown = F.coalesce(F.col("size") >= min_cluster_size, F.lit(False))
        pts = _cut(pts.join(comp.withColumnRenamed("v", "rep"), ["seg", "rep"], "left").select(
            "id", F.when(grown, F.col("seg")).otherwise(F.col("seg") + half).alias("seg"),
            F.when(grown, F.col("rep")).otherwise(F.coalesce("label", "rep")).alias("rep")))
    res = _cut(e.drop("seg").groupBy("chunk").applyInPandas(_chunk_fn(min_cluster_size), _CHUNK_SCHEMA))
    if levels:
        formed = res.where((F.col("kind") == K_SHARE) & F.col("lam").isNotNull()).select(F.col("ptr").alias("c"), F.col("ptr").alias("p"))
        tops = res.where((F.col("kind") == K_TOP)).select(F.col("eid").alias("c"), F.col("ptr").alias("p"))
        links = _pointer_jump(tops.union(formed).distinct()).select(F.col("c").alias("ptr"), F.col("p").alias("lin"))
        res = _cut(res.join(links, "ptr", "left"))
    else:
        res = res.withColumn("lin", F.col("ptr"))  # one range: every lineage was formed in it

    def of(kind):
        return res.where(F.col("kind") == kind)

    ends = of(K_END).select("lin", "parent", F.col("lam").alias("lam_birth"))
    lineages = of(K_SHARE).groupBy("lin").agg(F.max("size").alias("size"), F.sum("x").alias("acc"), F.max("lam").alias("lam_form")).join(ends, "lin", "left")
    lineages = lineages.withColumn("lam_birth", F.coalesce("lam_birth", F.lit(0.0))).select(
        "lin", "parent", "size", "acc", "lam_form", "lam_birth", (F.col("acc") - F.col("size") * F.col("lam_birth")).alias("stability"))
    falls = pts.join(of(K_FALL).select(F.col("chunk").alias("seg"), "rep", "lin", "lam"), ["seg", "rep"])
    return Hierarchy(
        merges=of(K_MERGE).select("lo", "hi", F.col("x").alias("w"), F.col("size").alias("size_a"), F.col("size2").alias("size_b")),
        falls=_cut(falls.select("id", "lin", "lam")),
        lineages=_cut(lineages),
    )


# --- selection and labels -----------------------------------------------------------------

def _best_totals(lin: DataFrame) -> DataFrame:
    """(lin, csum): the best total of every lineage's children, by raking leaves and compressing chains.

    A lineage's best total is max(stability, sum of its children's best totals); for the root the sum alone. A lineage
    whose children are known is known. One with a single unknown child is a function max(a, best(child) + c) of it, and
    such functions compose, so a chain halves its length every round: O(log n) rounds however deep the tree is.
    """
    root = F.col("parent").isNull()
    kids = lin.where("parent IS NOT NULL").groupBy(F.col("parent").alias("k")).agg(F.count(F.lit(1)).alias("kids"), F.min("lin").alias("one"))
    # a root has no total of its own, and an undefined stability never beats the children: -infinity takes no part in the maximum
    own = F.when(root | (F.isnan("stability") & F.col("kids").isNotNull()), F.lit(float("-inf"))).otherwise(F.col("stability"))
    node = lin.join(kids, F.col("lin") == F.col("k"), "left").select(
        "lin", "parent", own.alias("own"), F.coalesce("kids", F.lit(0)).alias("unknown"), F.lit(0.0).alias("csum"),
        F.when(F.coalesce("kids", F.lit(0)) == 0, own).alias("best"), F.when(F.col("kids") == 1, F.col("one")).alias("to"),
        own.alias("a"), F.lit(0.0).alias("c"))
    node = _cut(node)
    while not node.where("best IS NULL").isEmpty():
        # rake: known children, told to their parents once; the smallest unknown child is the chain's next lineage
        told = node.where("parent IS NOT NULL").groupBy(F.col("parent").alias("k")).agg(
            F.count(F.when(F.col("best").isNull(), 1)).alias("left"), F.sum("best").alias("sum"), F.min(F.when(F.col("best").isNull(), F.col("lin"))).alias("next"))
        n = node.join(told, F.col("lin") == F.col("k"), "left")
        csum = F.coalesce("sum", F.lit(0.0))
        open_ = F.col("best").isNull()
        first = open_ & (F.col("left") == 1) & F.col("to").isNull()
        n = n.select(
            "lin", "parent", "own", F.coalesce("left", F.lit(0)).alias("unknown"), csum.alias("csum"),
            F.when(~open_, F.col("best")).when(F.coalesce("left", F.lit(0)) == 0, F.greatest("own", csum)).alias("best"),
            F.when(first, F.col("next")).otherwise(F.col("to")).alias("to"), "a", F.when(first, csum).otherwise(F.col("c")).alias("c"))
        n = _cut(n)
        # compress: jump over the chain's next lineage, or take its best total if it is known
        after = n.select(F.col("lin").alias("t"), F.col("best").alias("t_best"), F.col("to").alias("t_to"), F.col("a").alias("t_a"), F.col("c").alias("t_c"))
        j = n.join(after, F.col("to") == F.col("t"), "left")
        jump = F.col("best").isNull() & F.col("t_to").isNotNull() & F.col("t_best").isNull()
        node = _cut(j.select(
            "lin", "parent", "own", "unknown", "csum",
            F.when(F.col("best").isNull() & F.col("t_best").isNotNull(), F.greatest("a", F.col("t_best") + F.col("c"))).otherwise(F.col("best")).alias("best"),
            F.when(jump, F.col("t_to")).otherwise(F.col("to")).alias("to"),
            F.when(jump, F.greatest("a", F.col("t_a") + F.col("c"))).otherwise(F.col("a")).alias("a"),
            F.when(jump, F.col("c") + F.col("t_c")).otherwise(F.col("c")).alias("c")))
    total = node.where("parent IS NOT NULL").groupBy(F.col("parent").alias("lin")).agg(F.sum("best").alias("csum"))
    return node.select("lin").join(total, "lin", "left").select("lin", F.col("csum"))


def select_clusters(lineages: DataFrame, method: str = "eom") -> DataFrame:
    """(lin, selected, sel): selected lineages and, per lineage, its selected ancestor-or-self.

    EOM: a lineage is kept when its stability is at least the best total of its
    descendants; the root is never selected. Leaf: lineages without children.
    One path for trees of any size and depth: totals by rake and compress, then pointer jumping towards the root.
    """
    if method not in ("eom", "leaf"):
        raise ValueError("cluster_selection_method must be 'eom' or 'leaf'")
    lin = _cut(lineages.select("lin", "parent", "stability"))
    if method == "leaf":
        parents = lin.where("parent IS NOT NULL").select(F.col("parent").alias("lin")).distinct().withColumn("inner", F.lit(True))
        local = lin.join(parents, "lin", "left").select("lin", "parent", (F.col("parent").isNotNull() & F.col("inner").isNull()).alias("local"))
    else:
        good = F.col("csum").isNull() | (~F.isnan("stability") & (F.col("stability") >= F.col("csum")))
        local = lin.join(_best_totals(lin), "lin").select("lin", "parent", (F.col("parent").isNotNull() & good).alias("local"))
    # top: the locally best lineage nearest the root among those passed so far
    walk = _cut(local.select("lin", F.col("parent").alias("up"), F.when(F.col("local"), F.col("lin")).alias("top")))
    while not walk.where("up IS NOT NULL").isEmpty():
        above = walk.select(F.col("lin").alias("u"), F.col("up").alias("u_up"), F.col("top").alias("u_top"))
        walk = _cut(walk.join(above, F.col("up") == F.col("u"), "left").select(
            "lin", F.col("u_up").alias("up"), F.coalesce("u_top", "top").alias("top")))
    return walk.select("lin", F.coalesce(F.col("top") == F.col("lin"), F.lit(False)).alias("selected"), F.col("top").alias("sel"))


def cluster_numbering(selection: DataFrame, lineages: DataFrame) -> DataFrame:
    """(sel, topic, lam_max_form): dense labels 0..K-1 of the selected lineages, in lineage-id order.

    Lineage ids are (range << 33) | position, so the rank is two-level: counts
    per chunk (one row per chunk) give offsets, and a row_number runs inside
    each chunk only - no single task orders all clusters.
    """
    sel = selection.where("selected").join(lineages.select("lin", "lam_form"), "lin") \
        .withColumn("__ch", F.shiftright("lin", 33))
    counts = sel.groupBy("__ch").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__ch").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)))  # one row per chunk
    w = Window.partitionBy("__ch").orderBy("lin")
    return sel.join(F.broadcast(offsets.select("__ch", "__off")), "__ch").select(
        F.col("lin").alias("sel"), (F.col("__off") + F.row_number().over(w) - 1).cast("int").alias("topic"),
        F.col("lam_form").alias("lam_max_form"),
    )


def label_points(h: Hierarchy, selection: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, topic, is_core, probability): dense labels over the selected lineages, noise -1."""
    from pubstrata.functions.vectors import half_round_scalar

    num = cluster_numbering(selection, h.lineages).withColumnRenamed("lam_max_form", "lam_max")
    per_lin = selection.select("lin", "sel").where(F.col("sel").isNotNull()).join(num, "sel")
    pts = ids.select(F.col("id").cast("long").alias("id")).join(h.falls, "id", "left").join(per_lin, "lin", "left")
    prob = F.when(
        F.col("topic").isNull(), F.lit(0.0)
    ).when(
        ~F.isnan(F.col("lam_max")) & (F.col("lam_max") > 0) & (F.col("lam_max") < float("inf")),
        F.least(F.col("lam"), F.col("lam_max")) / F.col("lam_max"),
    ).otherwise(F.lit(1.0))
    topic = F.coalesce(F.col("topic"), F.lit(-1)).cast("int")
    return pts.select(
        "id", topic.alias("topic"), (topic != -1).alias("is_core"),
        half_round_scalar(prob).alias("probability"),
    )


def hdbscan(points: DataFrame, min_cluster_size: int = 100, min_samples: int = 25, method: str = "eom",
            vec_col: str = "embedding", block_rows: int = 2048, chunk_edges: int = 200_000,
            details: bool = False, certify: bool = True):
    """Cluster table (id, topic, is_core, probability); with ``details`` also (mst, hierarchy, selection).

    ``certify``: take Boruvka edges from kNN lists where they are provably
    minimal; without it every round scans all points.
    """
    if min_samples < 1 or min_cluster_size < 2:
        raise ValueError("min_samples must be >= 1 and min_cluster_size >= 2")
    pts = _cut(points.select(F.col("id").cast("long").alias("id"), F.col(vec_col).alias(vec_col)))
    # with certification the lists are longer than the core rank: they also bound unlisted partners
    k = max(2 * min_samples, 8) if certify else max(min_samples - 1, 1)
    kn = _cut(knn(pts, k, "euclidean", vec_col=vec_col, block_rows=block_rows))
    core = core_distances(kn, min_samples, include_self=True)
    if min_samples == 1:
        core = pts.select("id", F.lit(0.0).alias("core_distance"))
    mst = _cut(mutual_reachability_mst(pts, core, vec_col, block_rows, knn_edges=kn if certify else None))
    h = build_hierarchy(mst, pts.select("id"), min_cluster_size, chunk_edges)
    selection = select_clusters(h.lineages, method)
    labels = label_points(h, selection, pts.select("id"))
    if details:
        return labels, mst, h, selection
    return labels


# --- soft membership over the selected clusters (C8) ---------------------------------------

def _ancestors(lineages: DataFrame) -> DataFrame:
    """(lin, anc, depth_anc): every lineage with each of its ancestors (itself included).

    Expanded one tree level per round; the lineage tree has at most
    2n / min_cluster_size nodes.
    """
    par = _cut(lineages.select("lin", "parent"))
    acc = par.select("lin", F.col("lin").alias("anc"), F.col("parent").alias("up"))
    out = acc
    frontier = acc
    while True:
        frontier = _cut(frontier.where(F.col("up").isNotNull()).select("lin", F.col("up").alias("anc"))
                        .join(par.select(F.col("lin").alias("anc"), F.col("parent").alias("up")), "anc"))
        if frontier.limit(1).count() == 0:
            break
        out = out.unionByName(frontier.select("lin", "anc", "up"))
    out = _cut(out.select("lin", "anc"))
    depth = out.groupBy(F.col("lin").alias("anc")).agg((F.count(F.lit(1)) - 1).alias("depth"))
    return _cut(out.join(depth, "anc"))


def membership_vectors(h: Hierarchy, selection: DataFrame, distance_membership) -> DataFrame:
    """(id, topic, p): soft membership of every point in every selected cluster.

    p = normalise(distance share * tree share) * P(in some cluster), where
    * distance share: ``distance_membership`` (id, topic, p), e.g. from
      ``periphery.membership_distance`` (inverse distance to each cluster's
      nearest exemplar, normalised);
    * tree share: softmax over clusters of lam_max(c) / (lam_max(c) - m(p, c)),
      m(p, c) = the largest lambda at which p and c are still one component
      (p's own lambda inside c; otherwise min(lambda_p, split lambda of the
      lowest common ancestor)); lam_max(c) = largest lambda of a point in c;
    * P(in some cluster) = lambda_p / max(lambda_p, lam_max(c*)), c* the
      cluster with the largest m(p, c).

    With the distances themselves (``membership_distance(..., table=False)``) the tasks that find them weigh them, and no row
    of a point and cluster is shuffled. A lineage tree too large to broadcast, or a table of shares, is joined.
    """
    from pubstrata.operators import membership as M
    from pubstrata.operators import shares

    num = cluster_numbering(selection, h.lineages)
    if isinstance(distance_membership, shares.Distances):
        tree = M.lineage_tree(h, selection, num)
        if tree is not None:
            return shares.memberships(distance_membership, h.falls, tree, num)
        distance_membership = shares.memberships(distance_membership)
    anc = _ancestors(h.lineages)
    lin = h.lineages.select("lin", "lam_form")
    # lam_max per selected cluster: largest lambda of a point falling from it or a descendant
    fa = h.falls.join(anc, "lin").join(num.select(F.col("sel").alias("anc")), "anc")
    lam_max = fa.groupBy(F.col("anc").alias("sel")).agg(F.max("lam").alias("lam_max"))
    # lowest common ancestor of every lineage with every selected cluster
    sel_anc = anc.join(num.select(F.col("sel").alias("lin")), "lin").select(
        F.col("lin").alias("sel"), "anc", F.col("depth").alias("d"))
    pairs = anc.select("lin", "anc").join(sel_anc, "anc").groupBy("lin", "sel").agg(
        F.max_by("anc", "d").alias("lca"))
    pairs = pairs.join(lin.select(F.col("lin").alias("lca"), F.col("lam_form").alias("lca_form")), "lca")
    pts = h.falls.join(pairs, "lin").join(num, "sel").join(lam_max, "sel")
    inside = F.col("lca") == F.col("sel")
    m = F.when(inside, F.col("lam")).otherwise(F.least(F.col("lam"), F.col("lca_form")))
    pts = pts.select("id", "topic", "lam", "lam_max", m.alias("m"))
    gap = F.col("lam_max") - F.col("m")
    score = F.when(gap > 0, F.col("lam_max") / gap).otherwise(F.lit(float("inf")))
    pts = pts.withColumn("score", score)
    w = Window.partitionBy("id")  # one row per selected cluster: bounded by the number of clusters
    best = F.max("score").over(w)
    # numerically stable softmax; an infinite score takes all the mass
    ex = F.when(F.col("score") == float("inf"), F.lit(1.0)).when(best == float("inf"), F.lit(0.0)).otherwise(
        F.exp(F.col("score") - best))
    pts = pts.withColumn("tree", ex / F.sum(ex).over(w))
    cstar = F.max_by("lam_max", F.struct(F.col("m"), -F.col("topic"))).over(w)
    pts = pts.withColumn("p_in", F.col("lam") / F.greatest(F.col("lam"), cstar))
    j = pts.join(distance_membership.select("id", "topic", F.col("p").alias("dist")), ["id", "topic"])
    prod = F.col("dist") * F.col("tree")
    return j.select(
        "id", "topic",
        (prod / F.sum(prod).over(w) * F.col("p_in")).alias("p"),
    )
