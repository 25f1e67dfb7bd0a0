import itertools
import math

import numpy as np

from textsieve.llm import graph_dedup
from textsieve.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, n int"


def brute(rows, least=0.93):
    def unit(v):
        if v is None or not len(v) or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            return None
        x = np.array(v, dtype=float)
        return x / np.linalg.norm(x)
    units = [unit(r[1]) for r in rows]
    n = len(rows)
    link = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2]:
                link[i][j] = len(units[i]) == len(units[j]) and units[i] @ units[j] >= least
    group = list(range(n))
    for _ in range(n):
        new = [min([group[i], *(group[j] for j in range(n) if link[i][j])]) for i in range(n)]
        if new == group:
            break
        group = new
    least_id = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in set(group)}
    return sorted((str(r[0]), sum(link[i]), str(least_id[group[i]] if r[0] is not None or sum(link[i]) else None)) for i, r in enumerate(rows))


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)
    got = graph_dedup.near_vectors(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got), [r.recall for r in got]


def vectors(seed, groups=8, each=25, dim=16, noise=0.06):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(each):
            rows.append((len(rows) * 3 % 1009, (centre + noise * rng.normal(size=dim) * np.linalg.norm(centre)).astype("float32").tolist(), g % 2))
    rows += [(2000 + i, rng.normal(size=dim).astype("float32").tolist(), i % 3) for i in range(100)]
    return rows


def test_equals_brute_force_in_one_and_many_shards(spark):
    rows = vectors(0)
    want = brute(rows)
    got, recall = run(spark, rows)
    assert got == want and recall[0] == 1.0 and sum(r[1] for r in got) > 1000
    got, _ = run(spark, rows, size=48)
    there, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert 0.95 * there <= found <= there
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0, 0.0], 0), (10, [1.0, 0.0], 0), (None, [1.0, 0.1], 0), (11, [1.0, 0.0], 1),
            (12, [1.0, 0.0, 0.0], 0), (13, [1e-30, 0.0], 0), (14, [-1.0, 0.0], 0)]
    got, _ = run(spark, rows)
    assert got == brute(rows)
    assert run(spark, [])[0] == []


def test_graph_reaches_every_row():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = graph_dedup.build_graph(x)
    assert max(map(len, links)) < 120
    found = graph_dedup.range_search(x, links, x, [np.array([0])] * 300, 0.8)
    there = x @ x.T >= 0.8
    assert not (found & ~there).any() and found.sum() >= 0.99 * there.sum()
    assert graph_dedup.build_graph(x[:1])[0].size == 0


def on_circle(degrees):
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]


def test_chains_stay_whole_in_every_order_of_ids(spark):
    """Four vectors in a chain, of which only neighbours are linked: in one shard, and in two that share a vector."""
    orders = list(itertools.permutations(range(4)))
    rows, chains = [], []
    for k, order in enumerate(orders):
        for places in (["s"] * 4, ["s", "s", "t", "t"], ["s", "st", "t", "t"], ["s", "s", "st", "t"]):
            chain = [4 * len(chains) + c for c in order]
            rows += [(chain[j], on_circle(20.0 * j), 1, f"{len(chains)}{s}") for j in range(4) for s in places[j]]
            chains.append((chain, places))
    dealt = spark.createDataFrame(rows, "cid long, vec array<double>, n long, shard string")
    counts, links = graph_dedup.search(dealt, graph_dedup.united_graph(dealt), 0.9)
    root = {r.node: r.root for r in components(links).collect()}
    split = [c for c, places in chains if places != ["s", "s", "t", "t"] and len({root.get(x, x) for x in c}) > 1]
    assert split == []
    # nothing joins shards that share no vector
    assert all(root[c[0]] == root[c[1]] != root[c[2]] == root[c[3]] for c, places in chains if places == ["s", "s", "t", "t"])


def test_components_of_sparse_groups_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    ids = rng.permutation(600).tolist()
    rows = [(ids[k], on_circle(float(rng.uniform(0, 360))), k % 60) for k in range(600)]
    want = brute(rows, 0.9)
    got, _ = run(spark, rows, least=0.9)
    assert got == want and len({w[2] for w in want}) > 60


def test_unite_equals_brute_force():
    rng = np.random.default_rng(6)
    for n, m in ((1, 0), (2, 1), (50, 20), (50, 45), (300, 200), (300, 900)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        want = np.arange(n)
        for _ in range(n):
            for x, y in zip(a, b):
                want[x] = want[y] = min(want[x], want[y])
        root = np.arange(n)
        for at in range(0, m, 64):
            root = graph_dedup.unite(root, a[at:at + 64], b[at:at + 64])
        assert (root == want).all()
