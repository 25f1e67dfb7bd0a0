import itertools
import random

import xxhash
from pyspark.sql import functions as F

from textsieve.llm import simhash
from textsieve.llm.components import components

from .data import EDGES, documents, table


def plain_fingerprint(text):
    words, one = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, one = words + [one] if one else words, ""
        else:
            one += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(items, linked):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        root[find(a)] = find(b)
    return {x: find(x) for x in items}


def check(spark, rows):
    got = simhash.near_duplicates(table(spark, rows, ["fingerprint", "component_id", "fp", "body"])).collect()
    want = [(r[0], plain_fingerprint(r[1])) for r in rows]
    assert sorted((str(r[0]), r[1]) for r in got) == sorted((str(i), f"{f:016x}") for i, f in want)
    fps = sorted({f for _, f in want})
    root = groups(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if bin(a ^ b).count("1") <= 3])
    least = {}
    for i, f in want:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert all(r[2] == least.get(root[int(r[1], 16)]) for r in got)
    return root, want, least


def test_near_duplicates_equal_brute_force(spark):
    check(spark, documents(3, 60, (0, 25)))


def test_edges_and_one_of_each(spark):
    root, want, least = check(spark, EDGES)
    kept = simhash.one_of_each(table(spark, EDGES, ["id", "nth", "a"]))
    assert kept.columns[-3:] == ["id", "nth", "a"]
    rows = kept.collect()
    assert len(rows) == len(set(root.values()))
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(least.values())
    assert simhash.near_duplicates(table(spark, [])).collect() == []
    assert simhash.one_of_each(table(spark, [])).collect() == []


def test_links_are_whole_however_small_the_buckets(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for b in rng.sample(range(64), rng.randrange(6)):
                x ^= 1 << b
            fps.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = {(a, b) for a, b in itertools.combinations(sorted(fps), 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    for bucket in (256, 4):
        assert {(min(r), max(r)) for r in simhash.links(df, 3, bucket).collect()} == want


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (500, 500), (3, 2), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(31)}) == 1 and len({got[i] for i in range(100, 120)}) == 1
    assert got[500] == 500 and len(set(got.values())) == 3
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_exploded_fingerprints_are_not_broadcast(spark):
    """A small table by its estimate, whose probes are 34 times its rows."""
    fps = spark.range(5000).select((F.xxhash64("id")).alias("fp"))
    plan = simhash.links(simhash.write_table(fps))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
