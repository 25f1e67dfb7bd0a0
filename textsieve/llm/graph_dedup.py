"""Embedding near-dedup over a robust-pruned flat graph.

Equal vectors of a label fold into one class first. Classes are dealt to
overlapping cluster shards of bounded size: clusters come from a bounded sample
of each cell, cells that are too large are clustered again, and every class
goes to its nearest two. Each shard builds a robust-pruned neighbour graph; the
adjacency lists of a class from all its shards are united. Every class is then
a query: greedy search from the medoids of its shards, then expansion of the
range over all links of nodes that lie in it. A query that reaches a node which
also lives in other shards goes on there, round by round, until none is new.
Every link is verified in double precision; recall is audited against brute
force on a bounded sample of queries that holds a stated number of links, and
the search repeated wider if it is below the target. If the widest still misses
more than is accepted, there is an error with the figure, and no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import read, write_table
from textsieve.llm.components import components

#: Bounds of a task's memory: classes of a shard, and rows that teach a cell its clusters.
SHARD, SAMPLE = 4096, 4096
#: Rows of a cell that find their clusters in one task.
PART = 8192
#: Of a node: nearest classes considered, links kept, and how much nearer a kept link must be to stand in for another.
NEAREST, DEGREE, ALPHA = 48, 24, 1.2
BEAM = 24
#: Queries of the recall audit, how many links there are it must rest on, and the most queries it draws for that; the recall
#: to search for, and the one below which there is no result.
AUDIT, AUDIT_LINKS, AUDIT_MOST, TARGET, ACCEPTED = 256, 500, 1 << 14, 0.95, 0.9


# -- one shard ------------------------------------------------------------------

def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``k`` clusters of unit rows; starts from evenly spaced rows, so reruns agree."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            own = x[near == j]
            if len(own):
                m = own.sum(axis=0)
                length = np.linalg.norm(m)
                c[j] = m / length if length else own[0]
    return c


def build_graph(x: np.ndarray, nearest: int = NEAREST, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Robust-pruned adjacency of unit rows: of each row's nearest rows and some spread over the shard, the nearest is
    kept and stands in for all that are ``alpha`` times nearer to it than to the row; and so on up to ``degree``. A row
    also links back to the nearest ``degree`` rows that link to it."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, dtype=np.int64) for _ in range(n)]
    k = min(nearest, n - 1)
    spread = np.unique(np.linspace(0, n - 1, min(16, n)).astype(int))
    src, dst, far = [], [], []
    for at in range(0, n, 256):
        own = np.arange(at, min(n, at + 256))
        sims = x[own] @ x.T
        sims[np.arange(len(own)), own] = -3
        cand = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        cand = np.concatenate([cand, np.broadcast_to(spread, (len(own), len(spread)))], axis=1)
        dist = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(sims, cand, axis=1)))
        order = np.argsort(dist, axis=1, kind="stable")
        cand, dist = np.take_along_axis(cand, order, axis=1), np.take_along_axis(dist, order, axis=1)
        # a row is no link of its own, and a candidate counts once
        alive = cand != own[:, None]
        for j in range(1, cand.shape[1]):
            alive[:, j] &= ~(cand[:, :j] == cand[:, j:j + 1]).any(axis=1)
        v = x[cand]
        rows = np.arange(len(own))
        for _ in range(degree):
            left = alive.any(axis=1)
            if not left.any():
                break
            pick = alive.argmax(axis=1)
            src.append(own[left])
            dst.append(cand[rows[left], pick[left]])
            far.append(dist[rows[left], pick[left]])
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("rkd,rd->rk", v, v[rows, pick])))
            alive &= alpha * between > dist
            alive[rows, pick] = False
    a, b, far = np.concatenate(src), np.concatenate(dst), np.concatenate(far)
    order = np.lexsort((a, far, b))  # the rows that link to each row, nearest first
    back = order[_runs(b[order]) < degree]
    # and its nearest row links back to every row, so that none is out of reach
    own = np.lexsort((b, far, a))
    back = np.union1d(back, own[_runs(a[own]) == 0])
    pair = np.unique(np.concatenate([a * n + b, b[back] * n + a[back]]))
    return np.split(pair % n, np.searchsorted(pair // n, np.arange(1, n)))


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal keys."""
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    first = np.flatnonzero(new)
    return np.arange(len(sorted_keys)) - np.repeat(first, np.diff([*first, len(sorted_keys)]))


def _padded(links: list[np.ndarray], n: int) -> np.ndarray:
    """Adjacency as a matrix; the place after the last row means none."""
    width = max([1, *(len(a) for a in links)])
    out = np.full((n, width), n, dtype=np.int64)
    for i, a in enumerate(links):
        out[i, :len(a)] = a
    return out


def range_search(x: np.ndarray, links: list[np.ndarray], queries: np.ndarray, entries: list[np.ndarray], least: float,
                 beam: int = BEAM) -> np.ndarray:
    """``found[q, i]``: whether row ``i`` of ``x`` was reached from ``entries[q]`` and has a product of ``least`` or more.

    Greedy search with a beam comes first; then all links of the rows in range are followed until none is new.
    """
    n, m = len(x), len(queries)
    adj = np.vstack([_padded(links, n), np.full((1, max([1, *(len(a) for a in links)])), n)])
    seen = np.zeros((m, n + 1), dtype=bool)
    seen[:, n] = True
    sims = np.full((m, n + 1), -3.0)
    done = np.zeros((m, n + 1), dtype=bool)

    def visit(q: np.ndarray, i: np.ndarray) -> None:
        fresh = ~seen[q, i]
        q, i = q[fresh], i[fresh]
        if len(q):
            pair = np.unique(q * (n + 1) + i)
            q, i = pair // (n + 1), pair % (n + 1)
            seen[q, i] = True
            for at in range(0, len(q), 1 << 14):
                a, b = q[at:at + (1 << 14)], i[at:at + (1 << 14)]
                sims[a, b] = np.einsum("rd,rd->r", queries[a], x[b])

    visit(np.repeat(np.arange(m), [len(e) for e in entries]), np.concatenate(entries).astype(np.int64))
    active = np.arange(m)
    while len(active):
        # the best row of each query's beam that is not expanded yet
        width = min(beam, n)
        top = np.argpartition(-sims[active], width - 1, axis=1)[:, :width]
        s = np.where(done[active[:, None], top] | (top == n), -9.0, sims[active[:, None], top])
        best = s.argmax(axis=1)
        go = s[np.arange(len(active)), best] > -2
        active, node = active[go], top[np.arange(len(top)), best][go]
        done[active, node] = True
        width = adj.shape[1]
        visit(np.repeat(active, width), adj[node].ravel())
    while True:
        q, i = np.nonzero((sims >= least) & ~done)
        if not len(q):
            return sims[:, :n] >= least
        done[q, i] = True
        step = max(1, (1 << 18) // adj.shape[1])  # links looked at together
        for at in range(0, len(q), step):
            a, b = q[at:at + step], i[at:at + step]
            visit(np.repeat(a, adj.shape[1]), adj[b].ravel())


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (the least member of each place's group) once the groups of ``a[k]`` and ``b[k]`` are one, for every k."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


# -- the passes -----------------------------------------------------------------

def unit_classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``cid, grp, vec, n, first_id``: a row per distinct usable vector of a label; ``vec`` has length 1."""
    v = F.col("v")
    good = F.col("l").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.col(label_col).alias("l"))
    rows = rows.where(F.coalesce(good, F.lit(False)))
    # the largest component first, so that no square overflows or vanishes
    largest = F.array_max(F.transform(v, F.abs))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, c: a + (c / F.col("m")) * (c / F.col("m"))))
    classes = (rows.withColumn("m", largest).where("m > 0").groupBy("l", "v", "m")
               .agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
               .withColumn("len", length)
               .select(F.monotonically_increasing_id().alias("cid"),
                       F.concat_ws("/", F.col("l").cast("string"), F.size("v").cast("string")).alias("grp"),
                       F.transform("v", lambda c: c / F.col("m") / F.col("len")).alias("vec"), "n", "first_id", "l", "v"))
    return write_table(classes)


def shards(classes: DataFrame, size: int = SHARD, overlap: int = 2, sample: int = SAMPLE) -> DataFrame:
    """``cid, vec, n, shard``: each class in its nearest ``overlap`` clusters, of about ``size`` classes at most.

    Level by level, each cell that is too large teaches its clusters from a sample of ``sample`` rows at most, drawn by
    hash, in a task of its own; a cell has at most 64 clusters, so its centres are one small row.
    """
    def to_nearest(key, table, centres):
        """The rows of one cell's part, each in its nearest clusters."""
        if not table.num_rows or not centres.num_rows:
            return pa.schema([("cid", pa.int64()), ("vec", pa.list_(pa.float64())), ("n", pa.int64()), ("cell", pa.string())]).empty_table()
        c = np.array(centres.column("centres")[0].as_py())
        x = np.stack(table.column("vec").to_numpy(zero_copy_only=False))
        near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :overlap]
        out = table.select(["cid", "vec", "n"]).take(pa.array(np.repeat(np.arange(len(x)), near.shape[1])))
        return out.append_column("cell", pa.array([f"{key[0].as_py()}.{k}" for k in near.ravel()], pa.string()))

    def centres_of(key, table):
        x = np.stack(table.column("vec").to_numpy(zero_copy_only=False))
        order = np.argsort(table.column("h").to_numpy())
        total = table.column("total")[0].as_py()
        k = int(min(64, max(2, np.ceil(2.0 * overlap * total / size))))
        return pa.table({"cell": [key[0].as_py()], "centres": pa.array([k_means(x[order], k).tolist()], pa.list_(pa.list_(pa.float64())))})

    open_cells, done = classes.select("cid", "vec", "n", F.col("grp").alias("cell")), []
    for _ in range(24):
        counted = write_table(open_cells.groupBy("cell").agg(F.count("*").alias("total")))
        large = counted.where(F.col("total") > size)
        done.append(open_cells.join(counted.where(F.col("total") <= size), "cell").select(
            "cid", "vec", "n", F.col("cell").alias("shard")))
        if large.isEmpty():
            break
        h = F.pmod(F.xxhash64("cid"), F.lit(1 << 30))
        drawn = (open_cells.join(large, "cell").withColumn("h", h)
                 .where(F.col("h") * F.col("total") < F.lit(sample * 0.9 * (1 << 30))))
        centres = write_table(drawn.select("cell", "vec", "h", "total").groupBy("cell").applyInArrow(
            centres_of, "cell string, centres array<array<double>>"))
        # a large cell is dealt in parts of bounded size; its centres go once to each part
        parts = F.ceil(F.col("total") / PART).cast("int")
        rows = open_cells.join(large, "cell").select("cell", F.pmod(F.xxhash64(F.lit(3), "cid"), parts).cast("int").alias("part"), "cid", "vec", "n")
        sent = centres.join(large, "cell").select("cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "centres")
        open_cells = write_table(rows.groupBy("cell", "part").cogroup(sent.groupBy("cell", "part")).applyInArrow(
            to_nearest, "cid long, vec array<double>, n long, cell string"))
    else:
        done.append(open_cells.select("cid", "vec", "n", F.col("cell").alias("shard")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # a class may come to one cell by two ways
    return write_table(out.groupBy("cid", "shard").agg(F.first("vec").alias("vec"), F.first("n").alias("n")))


def united_graph(dealt: DataFrame) -> DataFrame:
    """``cid, nbrs, homes``: a class's links from all its shards, and these shards."""
    def build(key, table):
        cids = table.column("cid").to_numpy()
        order = np.argsort(cids)
        x = np.stack(table.column("vec").to_numpy(zero_copy_only=False))[order]
        cids = cids[order]
        links = build_graph(x)
        return pa.table({"cid": pa.array(cids, pa.int64()), "shard": pa.array([key[0].as_py()] * len(cids), pa.string()),
                         "nbrs": pa.array([cids[a].tolist() for a in links], pa.list_(pa.int64()))})

    built = dealt.select("shard", "cid", "vec").groupBy("shard").applyInArrow(build, "cid long, shard string, nbrs array<long>")
    return write_table(built.groupBy("cid").agg(
        F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"), F.array_sort(F.collect_list("shard")).alias("homes")))


def search(dealt: DataFrame, graph: DataFrame, least: float, beam: int = BEAM) -> tuple[DataFrame, DataFrame]:
    """``cid, found`` (classes counted with their copies, in parts) and links ``a, b`` that join what was found: of each
    shard's run, every class that all its pairs together join to a lesser one, with the least of them."""
    nodes = write_table(dealt.join(graph, "cid").select("shard", "cid", "vec", "n", "nbrs", "homes"))
    result = "kind int, cid long, found long, a long, b long, shard string, visited array<string>, vec array<double>"
    schema = pa.schema([("kind", pa.int32()), ("cid", pa.int64()), ("found", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                        ("shard", pa.string()), ("visited", pa.list_(pa.string())), ("vec", pa.list_(pa.float64()))])

    def run(shard: str, table: pa.Table, guests: pa.Table | None) -> pa.Table:
        order = np.argsort(table.column("cid").to_numpy())
        cids = table.column("cid").to_numpy()[order]
        dim = len(table.column("vec")[0])
        x = table.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)[order]
        n = table.column("n").to_numpy()[order]
        homes = table.column("homes").take(pa.array(order)).to_pylist()
        links = []
        for nb in table.column("nbrs").take(pa.array(order)).to_numpy(zero_copy_only=False):
            at = np.minimum(np.searchsorted(cids, nb), len(cids) - 1)
            links.append(at[cids[at] == nb])
        first = guests is None
        if first:
            q_cid, q_vec, visited = cids, x, homes
            mean = x.sum(axis=0)
            entries = [np.array([int((x @ mean).argmax())])] * len(x)
        else:
            q_cid = guests.column("cid").to_numpy()
            q_vec = guests.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            visited = guests.column("visited").to_pylist()
            entries = [np.searchsorted(cids, np.array(e)) for e in guests.column("entries").to_pylist()]
        rows = {c: [] for c in schema.names}

        def put(**row):
            for c in rows:
                rows[c].append(row.get(c))

        # groups of the shard's rows and, after them, its guests
        root = np.arange(len(cids) + (0 if first else len(q_cid)))
        rules: dict[tuple, tuple] = {}

        def rule(been: tuple) -> tuple[np.ndarray, dict[str, np.ndarray]]:
            """For queries that visit the shards ``been`` in this order: which rows count here, as this is the first
            of their shards, and which rows also live in each shard not visited."""
            if been not in rules:
                here = np.array([next((s for s in been if s in h), None) == shard for h in homes])
                more = sorted({s for h in homes for s in h} - set(been))
                rules[been] = here, {s: np.array([s in h for h in homes]) for s in more}
            return rules[been]

        for at in range(0, len(q_cid), 256):
            part = slice(at, at + 256)
            found = range_search(x, links, q_vec[part], entries[part], least, beam)
            pairs_q, pairs_i = np.nonzero(found)
            # verified: the full cosine in double precision, some pairs at a time
            sure = np.zeros(len(pairs_q), dtype=bool)
            for k in range(0, len(sure), 1 << 14):
                u, v = q_vec[part][pairs_q[k:k + (1 << 14)]], x[pairs_i[k:k + (1 << 14)]]
                squares = np.einsum("rd,rd->r", u, u) * np.einsum("rd,rd->r", v, v)
                sure[k:k + (1 << 14)] = np.einsum("rd,rd->r", u, v) / np.sqrt(squares) >= least
            pairs_q, pairs_i = pairs_q[sure], pairs_i[sure]
            own = q_cid[part]
            other = cids[pairs_i] != own[pairs_q]
            pairs_q, pairs_i = pairs_q[other], pairs_i[other]
            root = unite(root, pairs_q + at + (0 if first else len(cids)), pairs_i)
            for q in np.unique(pairs_q).tolist():
                hits = pairs_i[pairs_q == q]
                here, onward = rule(tuple(visited[at + q]))
                put(kind=0, cid=int(own[q]), found=int(n[hits][here[hits]].sum()))
                for s, there in onward.items():
                    if there[hits].any():
                        put(kind=2, cid=int(own[q]), shard=s, a=int(cids[hits[there[hits]]].min()),
                            visited=list(visited[at + q]), vec=q_vec[at + q].tolist())
        node = cids if first else np.concatenate([cids, q_cid])
        for k in np.flatnonzero(root != np.arange(len(root))).tolist():
            put(kind=1, a=int(node[k]), b=int(node[root[k]]))
        return pa.table({c: pa.array(v, schema.field(c).type) for c, v in rows.items()}, schema=schema)

    def at_home(key, table):
        return run(key[0].as_py(), table, None)

    def visiting(key, table, guests):
        if not table.num_rows or not guests.num_rows:
            return schema.empty_table()
        return run(key[0].as_py(), table, guests)

    parts = [write_table(nodes.groupBy("shard").applyInArrow(at_home, result))]
    while True:
        last = parts[-1].where("kind = 2")
        # a query goes to a shard once; in one round it may be sent to several, which then know of each other
        sent = write_table(
            last.groupBy("cid", "shard").agg(F.collect_set("a").alias("entries"), F.first("vec").alias("vec"),
                                             F.max("visited").alias("visited")))
        if sent.isEmpty():
            break
        # all that a query sends in a round have the same list; the order of the list is that of the visits
        per_query = sent.groupBy("cid").agg(
            F.concat(F.max("visited"), F.array_sort(F.collect_set("shard"))).alias("visited"))
        guests = sent.select("cid", "shard", "entries", "vec").join(per_query, "cid")
        # shards without guests stay where they are
        visited = nodes.join(sent.select("shard").distinct(), "shard", "left_semi")
        parts.append(write_table(visited.groupBy("shard").cogroup(guests.groupBy("shard")).applyInArrow(visiting, result)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.where("kind = 0").select("cid", "found"), every.where("kind = 1").select("a", "b")


def audit(classes: DataFrame, counts: DataFrame, least: float, queries: int = AUDIT) -> float:
    """Links found over links there are, for classes drawn by hash, against all classes in blocks: at first ``queries`` of
    them, then eight times as many and again, until they have ``AUDIT_LINKS`` links, or all or ``AUDIT_MOST`` are drawn."""
    total = classes.count()
    while True:
        found, there = audited(classes, counts, least, queries, total)
        if there >= AUDIT_LINKS or queries >= min(total, AUDIT_MOST):
            return found / there if there else 1.0
        queries = min(8 * queries, AUDIT_MOST)


def audited(classes: DataFrame, counts: DataFrame, least: float, queries: int, total: int) -> tuple[int, int]:
    """Links found and links there are, copies counted, of about ``queries`` classes."""
    if not total:
        return 0, 0
    drawn = (classes.withColumn("h", F.pmod(F.xxhash64("cid", F.lit(1)), F.lit(1 << 30)))
             .where(F.col("h") * F.lit(total) < F.lit(queries * (1 << 30))).select("cid", "grp", "vec").limit(2 * queries))
    asked = [(r["cid"], r["grp"], r["vec"]) for r in drawn.collect()]
    shared = classes.sparkSession.sparkContext.broadcast(asked)

    def scan(batches):
        by: dict[str, tuple[list, np.ndarray]] = {}
        for g in {a[1] for a in shared.value}:
            own = [a for a in shared.value if a[1] == g]
            by[g] = ([a[0] for a in own], np.array([a[2] for a in own]))
        hits: dict[int, int] = {}
        for batch in batches:
            grp = np.array(batch.column("grp").to_pylist(), dtype=object)
            for g in set(grp.tolist()) & set(by):
                at = np.flatnonzero(grp == g)
                own, q = by[g]
                step = max(1, (1 << 21) // len(own))  # products held together
                for some in np.split(at, np.arange(step, len(at), step)):
                    x = np.stack(batch.column("vec").take(pa.array(some)).to_numpy(zero_copy_only=False))
                    near = ((q @ x.T) >= least) * np.asarray(batch.column("n").take(pa.array(some)))[None, :]
                    same = np.array(own)[:, None] == np.asarray(batch.column("cid").take(pa.array(some)))[None, :]
                    for c, k in zip(own, (near * ~same).sum(axis=1).tolist()):
                        hits[c] = hits.get(c, 0) + k
        yield pa.RecordBatch.from_pydict({"cid": pa.array(list(hits), pa.int64()), "there": pa.array(list(hits.values()), pa.int64())})

    there = classes.select("cid", "grp", "vec", "n").mapInArrow(scan, "cid long, there long").groupBy("cid").agg(F.sum("there").alias("there"))
    both = there.join(counts, "cid", "left").agg(F.sum("there").alias("t"), F.sum(F.least("there", F.coalesce("found", F.lit(0)))).alias("f")).first()
    return both["f"] or 0, both["t"] or 0


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 least: float = 0.93, size: int = SHARD, target: float = TARGET) -> DataFrame:
    """``id, n_links, component_id, kept, recall`` of each row of ``vectors``.

    Rows are compared only if their labels are equal and not null and their vectors are as long. A vector that is
    null, empty, zero or holds null or non-finite components links with nothing. Equal vectors link with each other.
    ``recall`` is the audit's. ``component_id`` of a row without links is its own id; null ids are passed over when the
    smallest id is taken. An empty table gives an empty table.
    """
    classes = unit_classes(vectors, id_col, vec_col, label_col)
    overlap, beam = 2, BEAM
    while True:
        dealt = shards(classes, size, overlap)
        counts, links = search(dealt, united_graph(dealt), least, beam)
        counts = write_table(counts.groupBy("cid").agg(F.sum("found").alias("found")))
        recall = audit(classes, counts, least)
        if recall >= target or overlap >= 6:
            break
        overlap, beam = overlap + 2, 2 * beam
    if recall < ACCEPTED:
        raise RuntimeError(f"the graph finds only {recall:.3f} of the links that brute force finds")
    roots = components(links)
    rooted = write_table(classes.select("cid", "n", "first_id", "l", "v").join(roots, classes["cid"] == roots["node"], "left")
                         .join(counts, "cid", "left")
                         .select("l", "v", "first_id", F.coalesce("root", "cid").alias("root"),
                                 (F.col("n") - 1 + F.coalesce("found", F.lit(0))).alias("n_links")))
    least_id = write_table(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    known = write_table(rooted.join(least_id, "root").select("l", "v", "n_links", "component_id"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).alias("lab"))
    out = rows.join(known, (F.col("lab") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
                      F.lit(float(recall)).alias("recall"))


def op9_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector: its links, the smallest vec_id reachable, whether it is that one, and the audit's recall."""
    return near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES = {"op9_graph_dedup": op9_graph_dedup}
ORACLES: dict[str, str] = {}
