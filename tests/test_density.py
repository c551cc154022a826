"""Density clustering against a small sequential implementation written here.

The reference follows the textbook construction: Prim's tree on the
mutual-reachability graph, a dendrogram built edge by edge, the condensed tree
built top-down from the root, excess-of-mass / leaf selection and
probabilities from the largest lambda of each selected cluster.
"""

import numpy as np
import pytest

from pubstrata.operators import density as D


def _pairwise(X):
    return np.sqrt(np.maximum(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1), 0))


def ref_mst_weight(X, ms):
    d = _pairwise(X)
    core = np.sort(d, axis=1)[:, ms - 1]
    mr = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    n = len(X)
    seen = np.zeros(n, bool)
    seen[0] = True
    best = mr[0].copy()
    total = 0.0
    for _ in range(n - 1):
        b = np.where(seen, np.inf, best)
        j = int(np.argmin(b))
        total += b[j]
        seen[j] = True
        best = np.minimum(best, mr[j])
    return total


def ref_labels(n, edges, mcs, method="eom"):
    """edges: (lo, hi, w) sorted by (w, lo, hi). Returns labels (cluster ids) and probabilities."""
    parent = list(range(n))
    node_of = list(range(n))
    size = {i: 1 for i in range(n)}
    kids = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nxt = n
    for lo, hi, w in edges:
        a, b = find(lo), find(hi)
        na, nb = node_of[a], node_of[b]
        kids[nxt] = (na, nb, w)
        size[nxt] = size[na] + size[nb]
        parent[b] = a
        node_of[a] = nxt
        nxt += 1
    root = nxt - 1

    def leaves(x):
        out, st = [], [x]
        while st:
            y = st.pop()
            if y < n:
                out.append(y)
            else:
                st.extend(kids[y][:2])
        return out

    rows = []  # (parent cluster, child, lam, child size, is_cluster)
    label = {root: 0}
    birth = {0: 0.0}
    new = 1
    queue = [root]
    while queue:
        x = queue.pop(0)
        if x < n:
            continue
        l, r, w = kids[x]
        lam = np.inf if w <= 0 else 1.0 / w
        c = label[x]
        sl, sr = size[l], size[r]
        if sl >= mcs and sr >= mcs:
            for y, s in ((l, sl), (r, sr)):
                label[y] = new
                birth[new] = lam
                rows.append((c, new, lam, s, True))
                new += 1
                queue.append(y)
        elif sl < mcs and sr < mcs:
            for p in leaves(l) + leaves(r):
                rows.append((c, p, lam, 1, False))
        else:
            small, big = (l, r) if sl < mcs else (r, l)
            for p in leaves(small):
                rows.append((c, p, lam, 1, False))
            label[big] = c
            queue.append(big)
    clusters = sorted(birth)
    stab = {c: 0.0 for c in clusters}
    children = {c: [] for c in clusters}
    death = {c: 0.0 for c in clusters}
    for p, ch, lam, s, isc in rows:
        stab[p] += (lam - birth[p]) * s
        death[p] = max(death[p], lam)
        if isc:
            children[p].append(ch)
    selected = set()
    if method == "leaf":
        selected = {c for c in clusters if not children[c] and c != 0}
    else:
        best = {}
        for c in sorted(clusters, reverse=True):
            csum = sum(best[k] for k in children[c])
            if c != 0 and (not children[c] or stab[c] >= csum):
                best[c] = stab[c]
                selected.add(c)
                st = list(children[c])
                while st:
                    k = st.pop()
                    selected.discard(k)
                    st.extend(children[k])
            else:
                best[c] = csum
    par = {ch: p for p, ch, _, _, isc in rows if isc}
    lab = np.full(n, -1)
    prob = np.zeros(n)
    for p, pt, lam, s, isc in rows:
        if isc:
            continue
        c = p
        while c not in selected and c in par:
            c = par[c]
        if c in selected:
            lab[pt] = c
            prob[pt] = 1.0 if not np.isfinite(lam) else min(lam, death[c]) / death[c]
    return lab, prob


def same_partition(a, b):
    m = {}
    for x, y in zip(a, b):
        if (x == -1) != (y == -1):
            return False
        if x != -1 and m.setdefault(x, y) != y:
            return False
    return len(set(m.values())) == len(m)


def _data(seed, n_blob=40, noise=15, dim=4):
    rng = np.random.default_rng(seed)
    centers = rng.uniform(-4, 4, (3, dim))
    X = np.vstack([c + rng.normal(0, rng.uniform(0.2, 0.6), (n_blob, dim)) for c in centers]
                  + [rng.uniform(-6, 6, (noise, dim))])
    return X


@pytest.mark.parametrize("seed,mcs,ms,method,certify", [(1, 8, 4, "eom", True), (2, 12, 6, "eom", False),
                                                        (3, 6, 3, "leaf", True), (5, 10, 5, "eom", False)])
def test_hdbscan_equals_sequential(spark, seed, mcs, ms, method, certify):
    X = _data(seed)
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, embedding array<double>")
    lab, mst, h, sel = D.hdbscan(df, min_cluster_size=mcs, min_samples=ms, method=method, details=True,
                                 block_rows=40, chunk_edges=30, certify=certify)
    edges = sorted((r.lo, r.hi, r.w) for r in mst.collect())
    edges.sort(key=lambda e: (e[2], e[0], e[1]))
    assert len(edges) == len(X) - 1
    assert sum(w for _, _, w in edges) == pytest.approx(ref_mst_weight(X, ms), rel=1e-9)
    rows = lab.collect()
    assert len(rows) == len(X) and len({r.id for r in rows}) == len(X)
    assert h.falls.count() == h.falls.select("id").distinct().count()
    got = {r.id: r for r in rows}
    want_lab, want_prob = ref_labels(len(X), edges, mcs, method)
    g = np.array([got[i].topic for i in range(len(X))])
    assert same_partition(g, want_lab)
    gp = np.array([got[i].probability for i in range(len(X))])
    assert np.allclose(gp, want_prob.astype(np.float16).astype(np.float64), atol=1e-3)
    assert all(got[i].is_core == (got[i].topic != -1) for i in got)


def test_blobs_recovered(spark):
    rng = np.random.default_rng(0)
    centers = np.array([[0.0] * 16, [3.0] + [0.0] * 15, [0.0, 3.0] + [0.0] * 14])
    X = np.vstack([c + rng.normal(0, 0.05, (60, 16)) for c in centers] + [rng.uniform(-1, 4, (20, 16))])
    truth = np.repeat([0, 1, 2, -1], [60, 60, 60, 20])
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, embedding array<double>")
    got = {r.id: r.topic for r in D.hdbscan(df, min_cluster_size=15, min_samples=5).collect()}
    pred = np.array([got[i] for i in range(len(X))])
    core = truth != -1
    assert same_partition(pred[core], truth[core])


def _plain_selection(parent, stab, method):
    """Children before parents, then parents before children."""
    kids = {x: [y for y in parent if parent[y] == x] for x in parent}
    order, stack = [], [x for x in parent if parent[x] is None]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += kids[x]
    best, local = {}, {}
    for x in reversed(order):
        total = sum(best[k] for k in kids[x])
        good = not kids[x] or (stab[x] >= total and method == "eom")
        local[x] = parent[x] is not None and good
        best[x] = stab[x] if local[x] else total
    sel = {}
    for x in order:
        above = sel.get(parent[x])
        sel[x] = above if above is not None else x if local[x] else None
    return {x: (sel[x] == x, sel[x]) for x in parent}


def _plain_hierarchy(n, edges, mcs):
    """Merges, falls and lineages edge after edge; lineages are named by the place of the edge that formed them."""
    comp = {i: [i] for i in range(n)}
    of = list(range(n))
    lin, lineages, falls, merges = {}, {}, {}, []
    for e, (w, lo, hi) in enumerate(sorted(edges)):
        a, b = of[lo], of[hi]
        lam = np.inf if w <= 0 else 1 / w
        merges.append((lo, hi, w, tuple(sorted((len(comp[a]), len(comp[b]))))))
        big = [x for x in (a, b) if len(comp[x]) >= mcs]
        small = [x for x in (a, b) if len(comp[x]) < mcs]
        total = len(comp[a]) + len(comp[b])
        if len(big) == 1:
            now = lin[big[0]]
            lineages[now]["acc"] += len(comp[small[0]]) * lam
            lineages[now]["size"] = total
        elif big or total >= mcs:
            for x in big:
                lineages[lin[x]].update(parent=e, birth=lam)
            now = e
            lineages[e] = {"acc": total * lam, "size": total, "form": lam, "parent": None, "birth": 0.0}
        else:
            now = None
        if now is not None:
            falls.update({p: (now, lam) for x in small for p in comp[x]})
        comp[a] += comp.pop(b)
        for p in comp[a]:
            of[p] = a
        lin[a] = now
    return sorted(merges), falls, lineages


def _forest():
    """Random trees, stars and paths with ties and zero weights, weights that only grow, and single points, as one forest."""
    rng = np.random.default_rng(11)
    weights = (lambda i: float(rng.integers(1, 4)), lambda i: float(rng.uniform(0.1, 3)), lambda i: float(rng.integers(0, 2)), float)
    shapes = (lambda i: int(rng.integers(0, i)), lambda i: 0, lambda i: i - 1)
    edges, n = [], 3
    for up in shapes:
        for w in weights:
            edges += [(w(i), n + up(i), n + i) for i in range(1, 40)]
            n += 40
    return n, edges


@pytest.mark.parametrize("chunk", [130, 100_000])
def test_hierarchy_of_split_ranges_equals_edge_after_edge(spark, chunk):
    """Several ranges (three levels of halves) and one give what a walk over the sorted edges gives; ids above 2^53."""
    base = 2**60 + 1
    n, edges = _forest()
    mst = spark.createDataFrame([(base + lo, base + hi, w) for w, lo, hi in edges], "lo long, hi long, w double")
    h = D.build_hierarchy(mst, spark.range(base, base + n), 4, chunk)
    merges, falls, lineages = _plain_hierarchy(n, edges, 4)
    got = sorted((r.lo - base, r.hi - base, r.w, tuple(sorted((r.size_a, r.size_b)))) for r in h.merges.collect())
    assert got == merges
    rows = {r.lin: r for r in h.lineages.collect()}
    assert len(rows) == len(lineages)
    place = dict(zip(sorted(rows), sorted(lineages)))  # both are numbered in the order of the edges
    for lin, r in rows.items():
        want = lineages[place[lin]]
        assert (r.size, r.lam_form, r.lam_birth) == (want["size"], want["form"], want["birth"])
        assert (None if r.parent is None else place[r.parent]) == want["parent"]
        assert r.acc == pytest.approx(want["acc"])
    assert {r.id - base: (place[r.lin], r.lam) for r in h.falls.collect()} == falls


def test_hierarchy_without_edges(spark):
    h = D.build_hierarchy(spark.createDataFrame([], "lo long, hi long, w double"), spark.range(3), 4)
    assert h.merges.isEmpty() and h.falls.isEmpty() and h.lineages.isEmpty()


@pytest.mark.parametrize("method", ["eom", "leaf"])
def test_selection_by_rake_and_compress_equals_a_plain_walk(spark, method, monkeypatch):
    rng = np.random.default_rng(6)
    trees = {"chain": [None] + list(range(63)), "caterpillar": [None] + [2 * ((i - 1) // 2) for i in range(1, 60)],
             "random": [None] + [int(rng.integers(0, i)) for i in range(1, 50)], "star": [None] + [0] * 30, "one": [None]}
    parent, stab = {}, {}
    for t, up in enumerate(trees.values()):  # a forest: every tree with its own root
        for i, p in enumerate(up):
            parent[1000 * t + i] = None if p is None else 1000 * t + p
            stab[1000 * t + i] = float(rng.integers(0, 6)) * (1.0 if t else 2.0 ** -(i // 8))
    stab[1007] = float("inf")
    rounds = []
    cut = D._cut
    monkeypatch.setattr(D, "_cut", lambda df: rounds.append(1) or cut(df))
    df = spark.createDataFrame([(x, parent[x], stab[x]) for x in parent], "lin long, parent long, stability double")
    got = {r.lin: (r.selected, r.sel) for r in D.select_clusters(df, method).collect()}
    assert got == _plain_selection(parent, stab, method)
    assert len(rounds) < 30  # a chain of 64 lineages in far fewer rounds than levels


def test_undefined_stability_never_beats_the_children(spark):
    df = spark.createDataFrame([(0, None, 0.0), (1, 0, float("nan")), (2, 1, 1.0), (3, 1, 2.0)], "lin long, parent long, stability double")
    assert {r.lin: r.sel for r in D.select_clusters(df).collect()} == {0: None, 1: None, 2: 2, 3: 3}


def test_membership_vectors(spark):
    from pubstrata.operators import periphery as P

    X = _data(1)
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, embedding array<double>")
    lab, mst, h, sel = D.hdbscan(df, min_cluster_size=8, min_samples=4, details=True)
    dist = P.membership_distance(df, lab)
    mem = D.membership_vectors(h, sel, dist).toPandas()
    labels = {r.id: r.topic for r in lab.collect()}
    k = len({t for t in labels.values() if t != -1})
    assert mem.groupby("id").size().eq(k).all() and len(mem.id.unique()) == len(X)
    tot = mem.groupby("id").p.sum()
    assert (tot <= 1 + 1e-9).all() and (tot >= 0).all()
    best = mem.loc[mem.groupby("id").p.idxmax()].set_index("id").topic
    core = [i for i, t in labels.items() if t != -1]
    assert np.mean([best[i] == labels[i] for i in core]) > 0.9
